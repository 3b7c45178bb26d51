from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitloom import testviews
from transitloom.operators import adjacent, numbering, ranking


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_per_key_takes_oldest_or_newest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")], "k string, t int, v string")
    assert rows(ranking.first_per_key(df, ["k"], "t")) == [("a", 1, "x"), ("b", 5, "z")]
    assert rows(ranking.first_per_key(df, ["k"], "t", newest=True)) == [("a", 2, "y"), ("b", 5, "z")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 9)), min_size=1, max_size=60),
       st.randoms(use_true_random=False))
def test_first_per_key_ignores_input_order_and_is_idempotent(spark, data, rng):
    schema = "k int, t int, v int"
    shuffled = data[:]
    rng.shuffle(shuffled)
    first = rows(ranking.first_per_key(spark.createDataFrame(data, schema), ["k"], "t"))
    again = rows(ranking.first_per_key(spark.createDataFrame(shuffled, schema).repartition(3), ["k"], "t"))
    assert first == again
    assert rows(ranking.first_per_key(spark.createDataFrame(first, schema), ["k"], "t")) == first
    best = {}
    for row in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        best.setdefault(row[0], row)
    assert first == sorted(best.values())


def test_duplicate_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(ranking.duplicate_counts(df, ["k"])) == [(3, 2, 1)]
    assert rows(ranking.duplicate_counts(df.limit(0), ["k"])) == [(0, 0, 0)]


def reference_neighbours(data, step):
    out, groups = [], {}
    for key, place, value in data:
        groups.setdefault(key, []).append((place, value))
    for key, items in groups.items():
        items.sort()
        for i, (place, value) in enumerate(items):
            j = i + step
            out.append((key, place, value, items[j][1] if 0 <= j < len(items) else None))
    return sorted(out, key=str)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 200)), min_size=1, max_size=80, unique=True),
       st.sampled_from([1, 7, 1000]))
def test_neighbours_do_not_depend_on_slices(spark, places, width):
    data = [(k, p, i) for i, (k, p) in enumerate(places)]
    df = spark.createDataFrame(data, "k int, p int, v int")
    for operator, step in ((adjacent.with_previous, -1), (adjacent.with_next, 1)):
        got = operator(df, ["k"], F.col("p"), width, {"v": "near"})
        assert got.columns == ["k", "p", "v", "near"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == reference_neighbours(data, step)


def largest_sorted_group(df, width):
    """Rows of the largest group that a task sorts, carried row included."""
    return df.groupBy("k", F.floor(F.col("p") / width)).count().agg(F.max("count")).first()[0] + 1


def test_one_key_with_a_third_of_all_rows_is_split(spark):
    rng = random.Random(1)
    hot = [(0, i, i) for i in range(1000)]
    cold = [(1 + rng.randrange(200), 2000 + i, i) for i in range(2000)]
    df = spark.createDataFrame(hot + cold, "k int, p int, v int")
    assert largest_sorted_group(df, 50) <= 51
    got = adjacent.with_previous(df, ["k"], F.col("p"), 50, {"v": "near"})
    assert sorted((tuple(r) for r in got.collect()), key=str) == reference_neighbours(hot + cold, -1)


def test_a_burst_is_split_by_a_narrower_width(spark):
    burst = [(0, 500_000 + i, i) for i in range(1000)] + [(0, p, p) for p in range(0, 400_000, 40_000)]
    df = spark.createDataFrame(burst, "k int, p int, v int")
    assert largest_sorted_group(df, 86_400) > 1000
    assert largest_sorted_group(df, 100) <= 101
    got = adjacent.with_previous(df, ["k"], F.col("p"), 100, {"v": "near"})
    assert sorted((tuple(r) for r in got.collect()), key=str) == reference_neighbours(burst, -1)


def test_rows_pass_one_window_and_only_slice_ends_a_second(spark):
    df = spark.range(1000).selectExpr("int(id % 10) k", "int(id) p", "int(id) v")
    got = adjacent.with_previous(df, ["k"], F.col("p"), 500, {"v": "near"})
    plan = got._jdf.queryExecution().executedPlan()
    got.collect()
    text = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # one window over rows by key and slice, one over the slices of a key; only hashing aggregates
    assert text.count("Window [") == 2 and "SortAggregate" not in text
    assert plan.toString().count("max_by") >= 1


def test_rows_without_a_place_have_no_neighbours(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 1, 2), ("a", 2, 3), ("a", None, 4)], "k string, p int, v int")
    got = adjacent.with_previous(df, ["k"], F.col("p"), 10, {"v": "near"})
    assert sorted((tuple(r)[2:] for r in got.collect())) == [(1, None), (2, None), (3, 2), (4, None)]


def test_neighbours_of_nothing(spark):
    assert adjacent.with_next(spark.createDataFrame([], "k int, p int"), ["k"], F.col("p"), 5, {"p": "near"}).count() == 0


def test_ties_pair_up_the_same_way(spark):
    data = [("a", 1, v) for v in "dcab"]
    got = set()
    for width in (1, 10):
        for seed in range(3):
            order = data[:]
            random.Random(seed).shuffle(order)
            df = spark.createDataFrame(order, "k string, p int, v string").repartition(2)
            got.add(tuple(rows(adjacent.with_previous(df, ["k"], F.col("p"), width, {"v": "near"})
                               .select("v", F.coalesce("near", F.lit("-"))))))
    assert len(got) == 1
    pairs = dict(got.pop())
    assert sorted(pairs) == list("abcd") and sorted(pairs.values())[0] == "-" and len(set(pairs.values())) == 4


def test_keys(spark):
    df = spark.createDataFrame([("12",), ("0012",), ("x",), (None,), ("7",)], "id string")
    assert rows(numbering.integer_keys(df, "id", "cp")) == [(7,), (12,)]
    assert rows(numbering.distinct_keys(df, "id")) == [("0012",), ("12",), ("7",), ("x",)]


def test_lots_are_full_and_in_key_order(spark):
    keys = random.Random(3).sample(range(-300_000, 300_000), 1003)
    df = spark.createDataFrame([(k,) for k in keys], "cp int").repartition(5)
    got = dict(rows(numbering.in_lots(df, "cp", 100)))
    assert got == {k: i // 100 for i, k in enumerate(sorted(keys))}


def test_lots_refuse_wide_keys_and_bad_size(spark):
    with pytest.raises(ValueError):
        numbering.in_lots(spark.range(3), "id", 10)
    with pytest.raises(ValueError):
        numbering.in_lots(spark.createDataFrame([(1,)], "cp int"), "cp", 0)


def test_request_grid(spark):
    assert rows(numbering.request_grid(spark)) == [(t, d) for t in range(1, 10) for d in (1, 2)]


def test_spread_terms(spark):
    df = spark.createDataFrame([("a1b2",), ("none",)], "s string")
    assert rows(testviews.spread_terms(df, F.col("s"))) == [("a1b2", 1), ("a1b2", 2)]
