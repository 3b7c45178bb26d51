"""Landing zone: raw documents and one directory of parsed rows per run."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom.functions.clock import run_stamp
from transitloom.session import SPARK_ERRORS, remove_folder
from transitloom.sources.documents import BODY

log = logging.getLogger(__name__)

def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """One document per file, with the file it came from."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias(BODY), F.col("_metadata.file_path").alias("arquivo_origem")
    )


def _landed(keys: Sequence[str] | T.StructType) -> T.StructType:
    """Columns of landed documents; keys named without a type are text."""
    fields = keys.fields if isinstance(keys, T.StructType) else [T.StructField(k, T.StringType()) for k in keys]
    return T.StructType([T.StructField(BODY, T.StringType()), *fields])


def _with_origin(landed: DataFrame) -> DataFrame:
    origin = [] if "arquivo_origem" in landed.columns else [F.col("_metadata.file_path").alias("arquivo_origem")]
    return landed.select(BODY, *origin, *(c for c in landed.columns if c != BODY))


def read_landed(spark: SparkSession, path: str, keys: Sequence[str] | T.StructType = ()) -> DataFrame:
    """Documents written by :func:`land_raw`, with the key columns named; the file is the origin unless that is a key."""
    return _with_origin(spark.read.schema(_landed(keys)).json(path))


def stream_landed(spark: SparkSession, path: str, files_per_batch: int | None = None,
                  keys: Sequence[str] | T.StructType = ()) -> DataFrame:
    """Streaming form of :func:`read_landed`. ``path`` may be a pattern over the folders of several runs.

    Documents that lie there already must have the keys: a stream that reads nulls for a misspelt one is refused.
    """
    schema = _landed(keys)
    first = spark.read.text(path).limit(1).select(F.json_object_keys("value").alias("names")).first()
    missing = set(schema.names) - set(first.names or ()) if first else set()
    if missing:
        raise ValueError(f"documents landed at {path} have no {', '.join(sorted(missing))}")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _with_origin(reader.json(path))


def land_raw(docs: DataFrame, path: str, keys: Sequence[str] = (), replace: bool = False,
             part: str | None = None, parts: Sequence[str] = ()) -> bool:
    """Write raw bodies unchanged, one JSON object per line with the body as text and the columns named (request keys, origin).

    Documents are dealt out evenly, however many keys there are: a folder has few files. ``replace`` empties the folder, so
    that a piece of a run that is landed again replaces itself. Documents of several pieces tell theirs in the key ``part``:
    each of ``parts`` has a folder of its own under ``path`` and is replaced alone. A failure is logged and reported, it does
    not stop the run.
    """
    rows = docs.select(BODY, *keys).filter(F.col(BODY).isNotNull())
    try:
        if part is not None:
            _land_parts(rows, path, part, parts)
        else:
            rows.hint("rebalance").write.mode("overwrite" if replace else "append").option("ignoreNullFields", False).json(path)
        return True
    except SPARK_ERRORS as error:
        log.warning("raw documents not landed at %s: %s", path, error)
        return False


def _land_parts(rows: DataFrame, path: str, part: str, parts: Sequence[str], nulls: bool = True) -> None:
    """Write rows to the folders of their parts, in place of what these hold."""
    for value in parts:
        remove_folder(rows.sparkSession, f"{path}/{part}={value}")
    rows.hint("rebalance", part).write.mode("append").partitionBy(part).option("ignoreNullFields", not nulls).json(path)


def land_rows(rows: DataFrame, root: str, name: str, run_time: datetime, part: str | None = None, parts: Sequence[str] = ()) -> str:
    """Write parsed rows as JSON in a directory of this run, by ``part`` if it is named; returns the directory."""
    path = f"{root}/{name}_{run_stamp(run_time)}.json"
    if part is not None:
        _land_parts(rows, path, part, parts, nulls=False)
    else:
        rows.write.mode("overwrite").json(path)
    return path


def moment(run_time: datetime) -> Column:
    """A run's start as a literal; without an offset it is read in the session time zone."""
    return F.lit(run_time.isoformat()).cast("timestamp")


def stamp(rows: DataFrame, run_time: datetime, origin: str | None = None) -> DataFrame:
    """Audit columns: one ingest time for the whole run and the origin name, if not already there."""
    stamped = rows.withColumn("dt_ingestao", moment(run_time))
    if origin is not None:
        stamped = stamped.withColumn("arquivo_origem", F.lit(origin))
    return stamped
