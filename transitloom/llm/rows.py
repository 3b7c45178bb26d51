"""Documents by a key that no null, repeated id or clashing column name upsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id.
SMALLEST = -(1 << 63)


def key_columns(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """``_doc`` and ``_tie``: the id without null, and what tells rows of one id with different texts apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    return (
        F.coalesce(F.col(doc_id).cast("long"), F.lit(SMALLEST)).alias("_doc"),
        F.shiftright(F.xxhash64(F.lit(2), body), 33).cast("int").alias("_tie"),
    )


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_doc, _tie, _text, _same, _same2): key, text without null, and two hashes of the text."""
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        *key_columns(doc_id, text), body.alias("_text"), F.xxhash64(body).alias("_same"), F.xxhash64(F.lit(1), body).alias("_same2"))


def without(docs: DataFrame, keys: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs whose key (_doc, _tie) is not among keys, with the columns they had."""
    rows = docs.select(F.struct("*").alias("_row"), *key_columns(doc_id, text))
    return rows.join(keys.select("_doc", "_tie"), ["_doc", "_tie"], "left_anti").select("_row.*")


def id_again(name: str = "doc_id", key: str = "_doc") -> Column:
    return F.when(F.col(key) != SMALLEST, F.col(key)).alias(name)


def small_batches(spark: SparkSession, rows: int = 500, size: int = 4 << 20) -> None:
    """Bound what one batch to a Python task holds: long texts would otherwise fill its memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
