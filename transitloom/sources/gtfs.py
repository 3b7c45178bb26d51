"""Static schedule files (comma-separated text with a header)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom import schemas
from transitloom.session import SPARK_ERRORS
from transitloom.sources.landing import moment

STATUS = "file string, rows bigint, rejected bigint, error string"


def read_file(spark: SparkSession, folder: str, name: str, run_time: datetime | None = None,
              infer: bool = False) -> DataFrame:
    """One file with its lineage columns.

    Columns are matched to the header by name, so files with extra, missing or reordered columns load;
    the standard columns come first with their types, others follow as text. ``infer`` guesses types
    instead, at the price of another pass over the file.
    """
    path = f"{folder.rstrip('/')}/{name}.txt"
    reader = spark.read.option("header", True).option("sep", ",")
    if infer:
        rows = reader.option("inferSchema", True).csv(path)
    else:
        rows = _typed(reader.csv(path), T.StructType.fromDDL(schemas.GTFS[name]))
    rows = rows.withColumn("arquivo_origem", F.col("_metadata.file_path"))
    if run_time is not None:
        rows = rows.withColumn("dt_ingestao", moment(run_time))
    return rows


def _header(text_rows: DataFrame) -> dict[str, str]:
    """Clean column names and those in the file; a byte order mark may stick to the first."""
    return {c.lstrip("﻿").strip().strip('"'): c for c in text_rows.columns}


def _typed(text_rows: DataFrame, schema: T.StructType) -> DataFrame:
    found = _header(text_rows)
    if not set(found) & set(schema.names):
        raise ValueError(f"no known column in header {sorted(found)}")
    known = [
        (F.trim(F.col(f"`{found[f.name]}`")).try_cast(f.dataType) if f.name in found
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    others = [F.col(f"`{raw}`").alias(clean) for clean, raw in found.items() if clean not in schema.names]
    return text_rows.select(*known, *others)


def _cells(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, dict[str, tuple[Column, Column]]]:
    """A file as text, and by typed column the cell and whether it holds text but no value of the column's type."""
    rows = spark.read.option("header", True).option("sep", ",").csv(f"{folder.rstrip('/')}/{name}.txt")
    schema = T.StructType.fromDDL(schemas.GTFS[name])
    found = _header(rows)
    cells = {f.name: F.trim(F.col(f"`{found[f.name]}`")) for f in schema if f.name in found and f.dataType != T.StringType()}
    kinds = {f.name: f.dataType for f in schema}
    return rows, {c: (cell, (cell != "") & cell.try_cast(kinds[c]).isNull()) for c, cell in cells.items()}


def rejects(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """(column, rejected): cells of one file that hold text but no value of their column's type."""
    rows, cells = _cells(spark, folder, name)
    if not cells:
        return spark.createDataFrame([], "column string, rejected bigint")
    counts = rows.agg(*(F.count_if(bad).alias(c) for c, (_, bad) in cells.items()))
    return counts.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, cells)), F.array(*cells))).alias("column", "rejected"))


def rejected_cells(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """(file, column, cell, line): every such cell, with its line as a JSON object of texts."""
    rows, cells = _cells(spark, folder, name)
    each = F.array(*(F.when(bad, F.struct(F.lit(c).alias("column"), cell.alias("cell"))) for c, (cell, bad) in cells.items()))
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)))
    return rows.select(F.col("_metadata.file_path").alias("file"), line.alias("line"), F.explode(F.array_compact(each)).alias("bad")).select(
        "file", "bad.*", "line")


def load_files(spark: SparkSession, folder: str, write: Callable[[str, DataFrame], int],
               run_time: datetime, names: Iterable[str] = tuple(schemas.GTFS)) -> DataFrame:
    """Load each file through ``write(name, rows)``, which returns the number of rows written.

    A missing or unreadable file is recorded with its error and the others still load. Returns one
    status row per file, with the number of cells that became null because they hold no value of their type.
    """
    report = []
    for name in names:
        try:
            rows = write(name, read_file(spark, folder, name, run_time))
            bad = rejects(spark, folder, name).agg(F.coalesce(F.sum("rejected"), F.lit(0))).first()[0]
            report.append((name, rows, bad, None))
        except (*SPARK_ERRORS, ValueError) as error:
            report.append((name, None, None, str(error).splitlines()[0]))
    return spark.createDataFrame(report, STATUS)
