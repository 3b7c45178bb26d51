"""Previous or next row of an ordered group, also when one group holds much of the data.

``lag`` over a vehicle's whole history sorts that history in a single task, and one vehicle or shape may own
a large share of all rows. So rows are windowed by (group, slice of their position), always and with a width
that the caller states. What a slice's first row needs from before it is its predecessor's last row; those
last rows are an aggregate, combined before its shuffle, with one row per slice. They are shifted by one
slice and put in front of the slice they belong to. Every row passes one shuffle and one sort.

No job runs while the plan is built, and the plan does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PLACE, _SLICE, _TIE, _CARRIED, _NEAR = "__place", "__slice", "__tie", "__carried", "__near"


def with_previous(df: DataFrame, keys: Sequence[str], place: Column, width: int, names: dict[str, str]) -> DataFrame:
    """Add, for each ``source: new`` in ``names``, the value of the preceding row of the group.

    ``place`` is a whole number that orders a group; ``width`` bounds the places that one task sorts. Rows at
    one place are ordered by a hash of all columns, so they pair up the same way on every run. Rows without
    a place neither have nor are neighbours.
    """
    return _with_neighbour(df, keys, place, width, names, True)


def with_next(df: DataFrame, keys: Sequence[str], place: Column, width: int, names: dict[str, str]) -> DataFrame:
    """As :func:`with_previous`, for the following row."""
    return _with_neighbour(df, keys, place, width, names, False)


def _with_neighbour(df, keys, place, width, names, before) -> DataFrame:
    placed = df.withColumns({
        _PLACE: place.cast("bigint"), _SLICE: F.floor(place / F.lit(width)), _CARRIED: F.lit(False),
        _TIE: F.shiftrightunsigned(F.xxhash64(*df.columns), 2),
    })
    # place and tie in one number: fixed width, so the aggregate hashes and does not sort
    rank = F.col(_PLACE).cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)") + F.col(_TIE).cast("decimal(19,0)")
    outermost = F.max_by if before else F.min_by
    edges = placed.filter(F.col(_PLACE).isNotNull()).groupBy(*keys, _SLICE).agg(
        *(outermost(F.col(c), rank).alias(c) for c in names), F.lit(True).alias(_CARRIED))
    beside = Window.partitionBy(*keys).orderBy(_SLICE)
    shift = F.lag if before else F.lead
    values = F.struct(*names, _CARRIED)
    carried = edges.select(*keys, _SLICE, shift(values).over(beside).alias(_NEAR)).filter(F.col(_NEAR).isNotNull()).select(
        *keys, _SLICE, f"{_NEAR}.*")
    first = F.col(_CARRIED).desc() if before else F.col(_CARRIED).asc()
    inside = Window.partitionBy(*keys, _SLICE).orderBy(first, _PLACE, _TIE)
    near = F.when(F.col(_PLACE).isNotNull(), shift(F.struct(*names)).over(inside))
    joined = placed.unionByName(carried, allowMissingColumns=True).withColumn(_NEAR, near).filter(~F.col(_CARRIED))
    return joined.withColumns({new: F.col(_NEAR)[source] for source, new in names.items()}).drop(
        _PLACE, _SLICE, _TIE, _CARRIED, _NEAR)
