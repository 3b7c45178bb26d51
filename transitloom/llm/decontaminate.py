"""Benchmark passages in documents, by a distributed positional inverted index.

``build_index`` stores the postings of the test terms: document, terms and positions, one row per document.
A phrase is looked up from its rarest terms: their posting lists, each shifted by the term's offset in the
phrase, are intersected on (document, start); what is left is compared word by word with the stored postings.

The terms and word pairs of the test set travel to the tasks in blocks of at most BLOCK_WORDS words, so what
is broadcast has a fixed bound however large the test set; a larger set is looked up block after block.

Meaning of odd input: a null text has no words; an item without words has no window; a null document id is a
document of its own; a null item id counts as a hit but names no item; equal item ids are one item; rows
equal in id and text get the same answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitloom.llm import tokens as tk
from transitloom.llm.graph import stored
from transitloom.llm.rows import id_again, keyed, without

#: Words of test items whose terms are broadcast at a time: about 16 MB.
BLOCK_WORDS = 1 << 20
#: Posting lists that are intersected before the rest of a phrase is compared.
RAREST = 3
_INDEX = "_doc long, _tie int, n_words long, terms array<long>, at array<int>"


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind))


def _pairs(h: np.ndarray) -> np.ndarray:
    return tk.mix(h[:-1] * tk.U(0x9E3779B97F4A7C15) + h[1:])


class _Terms:
    """Membership in a sorted set of hashes: a table of bits first, a search for the few that pass."""

    BITS = 24

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(values)
        self.table = np.zeros(1 << self.BITS, dtype=bool)
        self.table[(self.values >> tk.U(64 - self.BITS)).astype(np.int64)] = True

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = self.table[(h >> tk.U(64 - self.BITS)).astype(np.int64)]
        some = np.flatnonzero(out)
        out[some] = np.isin(h[some], self.values)
        return out


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words): the hashes of each test item's words; items without a word are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "_text"):
            _, _, _, h, first = tk.words_of(batch, "_text", tk.ALNUM)
            yield pa.RecordBatch.from_arrays([batch.column("item"), _lists(h.view(np.int64), np.diff(first), pa.int64())], ["item", "words"])

    rows = items.select(F.col(item_id).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return rows.mapInArrow(run, "item string, words array<long>").filter(F.size("words") > 0)


def windows(words: DataFrame, size: int) -> DataFrame:
    """(item, window, terms): each run of size words of an item, the whole item if it is shorter."""
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    cut = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("terms"))
    return cut.select("item", F.xxhash64("terms").alias("window"), "terms")


def build_index(rows: DataFrame, terms: np.ndarray, pairs: np.ndarray, shortest: int) -> DataFrame:
    """Postings of the given terms in rows of ``keyed``: (_doc, _tie, n_words, terms, at).

    With ``shortest`` 1 every posting is stored. Beyond that, a posting is stored only where at least that
    many words follow each other in pairs that the test set has too; no phrase can stand elsewhere.
    """
    sets = rows.sparkSession.sparkContext.broadcast((terms, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in tk.groups(batches, "_text"):
            known = known or tuple(map(_Terms, sets.value))
            _, _, _, h, first = tk.words_of(batch, "_text", tk.ALNUM)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            if shortest > 1:
                linked = np.zeros(len(h) + 1, dtype=bool)  # whether a word and the one before it are a known pair
                if len(h) > 1:
                    linked[1:-1] = known[1].holds(_pairs(h)) & (row[1:] == row[:-1])
                edge = np.diff(linked.astype(np.int8))
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # words begin..end stand in one run
                long = end - begin + 1 >= shortest
                near = np.zeros(len(h) + 1, dtype=np.int8)
                near[begin[long]] = 1
                near[end[long] + 1] -= 1
                here = np.flatnonzero(np.cumsum(near[:-1]))
            else:
                here = np.flatnonzero(known[0].holds(h))
            count = np.bincount(row[here], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("_doc"), batch.column("_tie"), pa.array(np.diff(first).astype(np.int64)),
                _lists(h[here].view(np.int64), count, pa.int64()),
                _lists((here - first[row[here]]).astype(np.int32), count, pa.int32()),
            ], ["_doc", "_tie", "n_words", "terms", "at"])

    return rows.select("_doc", "_tie", "_text").mapInArrow(run, _INDEX)


def postings(index: DataFrame) -> DataFrame:
    """(term, _doc, _tie, at): the inverted lists of an index."""
    return index.filter(F.size("terms") > 0).select(
        "_doc", "_tie", F.explode(F.arrays_zip("terms", "at")).alias("p")
    ).select(F.col("p.terms").alias("term"), "_doc", "_tie", F.col("p.at").alias("at"))


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(_doc, _tie, item, start, length): the exact occurrences of phrases (item, window, terms)."""
    lists = postings(index)
    length = F.size("terms")
    terms = phrases.dropDuplicates(["window"]).select("window", length.alias("length"), F.posexplode("terms").alias("offset", "term"))
    counted = terms.join(lists.groupBy("term").count(), "term", "left")  # no list: the phrase stands nowhere
    order = Window.partitionBy("window").orderBy(F.col("count").asc_nulls_first(), "offset")
    rare = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= RAREST).filter("count is not null")
    shifted = lists.join(rare, "term").select("window", "_doc", "_tie", (F.col("at") - F.col("offset")).alias("start"), "length")
    found = shifted.groupBy("window", "_doc", "_tie", "start").agg(F.count("*").alias("met"), F.first("length").alias("length"))
    # repeated rows of a document bring each posting once per row
    found = found.filter(F.col("met") >= F.least("length", F.lit(RAREST))).filter("start >= 0").select("window", "_doc", "_tie", "start")
    stored = index.filter(F.size("terms") > 0).dropDuplicates(["_doc", "_tie"]).select(
        "_doc", "_tie", F.col("terms").alias("have"), "at")
    first = F.array_position("at", F.col("start"))
    same = (
        found.join(stored, ["_doc", "_tie"]).withColumn("first", first.cast("int")).filter("first > 0")
        .join(phrases, "window").withColumn("length", length)
        .filter(F.slice("have", F.col("first"), F.col("length")) == F.col("terms"))
        .filter(F.element_at("at", F.col("first") + F.col("length") - 1) == F.col("start") + F.col("length") - 1)
    )
    return same.select("_doc", "_tie", "item", "start", "length")


def proximity_matches(index: DataFrame, groups: DataFrame, terms: int, span: int) -> DataFrame:
    """(_doc, _tie, group, first, last): the places where all terms of a group stand within span words.

    ``groups`` has (group, number, term), the terms of a group numbered from 0 below ``terms``; the index must hold
    every posting (``shortest`` 1). A place ends at each word that completes a group.
    """
    met = postings(index).dropDuplicates().join(groups, "term")
    so_far = Window.partitionBy("group", "_doc", "_tie").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.max(F.when(F.col("number") == i, F.col("at"))).over(so_far) for i in range(terms)]
    first = F.least(*last) if terms > 1 else last[0]
    seen = met.select("group", "_doc", "_tie", "at", first.alias("first"), F.array(*last).alias("all"))
    whole = seen.filter(~F.exists("all", lambda x: x.isNull())).filter(F.col("at") - F.col("first") < span)
    return whole.select("_doc", "_tie", "group", "first", F.col("at").alias("last")).distinct()


def _blocks(words: DataFrame, block_words: int) -> list[DataFrame]:
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, math.ceil(total / block_words))
    return [words.filter(F.pmod(F.xxhash64("words"), F.lit(n)) == i) for i in range(n)]


def _sets(block: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Terms and pairs of one block, and its shortest window; the block bounds what reaches the driver."""
    rows = [np.array(r.words, dtype=np.int64).view(tk.U) for r in block.select("words").collect()]
    none = np.zeros(0, dtype=tk.U)
    return (
        np.unique(np.concatenate([none, *rows])), np.unique(np.concatenate([none, *map(_pairs, rows)])),
        min([size, *map(len, rows)]),
    )


def judged(rows: DataFrame, items: DataFrame, size: int = 13, percent: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(_doc, _tie, n_words, n_hit, items, contaminated) for every row of ``keyed``."""
    # items and matches are read several times: stored, so that no plan holds their steps twice
    words = stored(item_words(items), "items")
    found, counts = None, None
    for block in _blocks(words, block_words):
        terms, pairs, shortest = _sets(block, size)
        index = stored(build_index(rows, terms, pairs, shortest), "postings")
        matches = stored(phrase_matches(index, windows(block, size)), "matches")
        found = matches if found is None else found.unionByName(matches)
        counts = counts or index
    key = ["_doc", "_tie"]
    per_doc = _hits(found).join(_named(found), key)
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counts.select(*key, "n_words").join(per_doc, key, "left").select(
        *key, "n_words", hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((hit > 0) & (hit * 100 >= F.col("n_words") * percent)).alias("contaminated"))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 13,
                  percent: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) for every document.

    A word is hit if it lies in an occurrence of a window of an item; a document is contaminated if at least
    ``percent`` of its words, and one at least, are hit. ``items`` lists the ids, sorted as strings.
    """
    found = judged(keyed(docs, doc_id, text), items, size, percent, block_words)
    return found.select(id_again(doc_id), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "contaminated")


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not contaminated."""
    return without(docs, judged(keyed(docs, doc_id, text), items).filter("contaminated"), doc_id, text)


def _hits(matches: DataFrame) -> DataFrame:
    """Words inside any occurrence, by adding up what each reaches beyond all before it."""
    key = ["_doc", "_tie"]
    spans = matches.groupBy(*key, "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = F.max("end").over(Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    return spans.withColumn("new", new).groupBy(*key).agg(F.sum("new").alias("n_hit"))


def _named(matches: DataFrame) -> DataFrame:
    return matches.groupBy("_doc", "_tie").agg(F.array_sort(F.collect_set("item")).alias("items"))
