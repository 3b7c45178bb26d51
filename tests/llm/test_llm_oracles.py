"""Queries that SQL can express, against DuckDB; and the entry points without the part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from transitloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    got = entry.queries()[name](spark, sf_dir)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == sorted(cursor.fetchall())


def test_each_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_entry_points_work_without_the_part(tmp_path):
    root = Path(entry.__file__).parent
    for part in root.glob("*"):
        if part.name not in ("corpus_pipeline.py", "transitloom", ".git"):
            (tmp_path / part.name).symlink_to(part)
    (tmp_path / "transitloom").mkdir()
    for part in (root / "transitloom").glob("*"):
        if part.name != "llm":
            (tmp_path / "transitloom" / part.name).symlink_to(part)
    said = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op1') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    out = subprocess.run([sys.executable, "-B", "-c", said], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[1:] == ["False", "True"]
