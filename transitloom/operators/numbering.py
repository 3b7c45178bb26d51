"""Request keys, request grids and fixed-size lots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Keys are 32-bit integers and distinct, so a block of 2**16 consecutive values holds at most 2**16
# rows and there are at most 2**16 blocks: both windows below are bounded whatever the table size.
_BLOCK = 1 << 16


def distinct_keys(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Distinct non-null keys of an earlier table; they stay distributed."""
    name = name or column
    return df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull()).distinct()


def integer_keys(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct keys that parse as integers; the rest are dropped."""
    return distinct_keys(df.select(F.col(column).try_cast("int").alias(name)), name)


def in_lots(keys: DataFrame, column: str, size: int) -> DataFrame:
    """Number distinct integer keys in key order and cut them into lots of exactly ``size``.

    A row number over the whole table would pull it into one task. Keys are numbered inside blocks
    of consecutive values and each block is shifted by the number of keys in the blocks before it.
    """
    if size < 1:
        raise ValueError("size must be positive")
    column_type = keys.schema[column].dataType.simpleString()
    if column_type not in ("int", "smallint", "tinyint"):
        raise ValueError(f"{column} is {column_type}: lots need 32-bit integer keys")
    blocks = keys.withColumn("__block", F.floor(F.col(column) / F.lit(_BLOCK)))
    sizes = blocks.groupBy("__block").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col("__block"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__shift")
    )
    inside = Window.partitionBy("__block").orderBy(column)
    position = F.col("__shift") + F.row_number().over(inside) - 1
    return (
        blocks.join(shifts, "__block")
        .withColumn("lote", F.floor(position / F.lit(size)).cast("long"))
        .drop("__block", "__shift")
    )


def request_grid(spark: SparkSession, terms: int = 9, directions: int = 2) -> DataFrame:
    """Search requests: every term with every direction."""
    return (
        spark.range(1, terms + 1, numPartitions=1).select(F.col("id").cast("int").alias("term"))
        .withColumn("direction", F.explode(F.sequence(F.lit(1), F.lit(directions))))
    )

