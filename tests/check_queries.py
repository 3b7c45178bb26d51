"""Compare queries with their oracles at any scale: python tests/check_queries.py SF_DIR [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
from oracle import connect, oracle_rows, spark_rows
from transitloom.session import get_session


def main() -> int:
    sf_dir, *wanted = sys.argv[1:]
    spark = get_session("check", "local[8]", spark__sql__shuffle__partitions="8",
                        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted or entry.queries():
        start = time.time()
        try:
            ours, theirs = spark_rows(spark, name, sf_dir), oracle_rows(con, name)
        except Exception as error:
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        bad += ours != theirs
        print(f"{'ok   ' if ours == theirs else 'DIFF '} {name} {len(ours[1])} rows {time.time() - start:.1f}s",
              flush=True)
        if ours != theirs:
            print("  columns", ours[0], theirs[0], "counts", len(ours[1]), len(theirs[1]))
            for a, b in [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b][:3]:
                print("   spark ", a, "\n   duckdb", b)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
