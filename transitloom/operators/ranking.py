"""One deterministic row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], by: str | None = None,
                  newest: bool = False) -> DataFrame:
    """One row per key: the one with the lowest ``by`` (highest with ``newest``).

    Rows of one ingestion run share their ingest time, so ties are normal; they are broken by every
    remaining column in table order, so the survivor does not depend on how rows are spread over tasks.
    The rank filter becomes a WindowGroupLimit below the shuffle: each map task sends at most one
    row per key, however large the key.
    """
    lead = [] if by is None else [F.col(by).desc_nulls_last() if newest else F.col(by).asc_nulls_last()]
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys and c != by]
    window = Window.partitionBy(*keys).orderBy(*lead, *ties)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after removing duplicates of ``keys``, and how many go, in one pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )
    return totals.withColumn("duplicates", F.col("rows_before") - F.col("rows_after"))
