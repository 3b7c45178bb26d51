"""Repeated runs of words, found through anchors at the positions of a difference cover.

A set D is a difference cover modulo a period v if every shift between two places can be undone by some step
below v that puts both on positions whose remainder lies in D. So two equal runs of ``window`` words always
share an equal, equally placed anchor of ``window - v + 1`` words that starts at a cover position of both
documents. Only anchors at cover positions (4 of 13 by default) are hashed and shuffled. Around anchors
that stand in two texts, or twice in one, the full windows are hashed in turn; those decide.

Meaning of odd input: a null text has no words; a null id counts as the smallest id; rows equal in id and
text are one document and get the same answer; rows equal in id only are ordered by a hash of the text;
columns of other names pass through untouched.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitloom.llm import tokens as tk
from transitloom.llm.rows import id_again, keyed

def difference_cover(period: int) -> tuple[int, ...]:
    """The smallest set of remainders, with 0, whose differences make up every remainder."""
    for size in range(1, period + 1):
        for rest in itertools.combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError(period)


class _Cover:
    """Anchors of a batch of texts."""

    def __init__(self, window: int, period: int) -> None:
        self.window, self.period, self.anchor = window, period, window - period + 1
        if self.anchor < 1:
            raise ValueError("the period may not exceed the window")
        self.in_cover = np.isin(np.arange(period), difference_cover(period))

    def of_words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of one document's anchors."""
        a = tk.runs(h, self.anchor)
        at = np.flatnonzero(self.in_cover[np.arange(len(a)) % self.period])
        return at, a[at]

    def of_batch(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """Each text's distinct anchors: hash, hash of the text, first position; -1 - position if it stands there twice."""
        _, _, _, h, first = tk.words_of(batch, "_text", tk.PLAIN)
        same = batch.column("_same").to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(first))
        at = np.arange(len(h)) - first[row]
        ok = self.in_cover[at % self.period] & (at + self.anchor <= np.diff(first)[row])
        new = np.zeros(batch.num_rows, dtype=bool)  # copies of a text in this batch add nothing
        new[np.unique(same, return_index=True)[1]] = True
        ok &= new[row]
        here = np.flatnonzero(ok[: max(0, len(h) - self.anchor + 1)])
        a = tk.runs(h, self.anchor)[here]
        pick, n = tk.firsts(tk.mix(a + row[here].astype(tk.U) * tk.U(0x9E3779B97F4A7C15)))
        here, a = here[pick], a[pick]
        return pa.RecordBatch.from_arrays(
            [tk.signed(a), pa.array(same[row[here]]), pa.array(np.where(n > 1, -1 - at[here], at[here]).astype(np.int32))],
            ["anchor", "_same", "at"],
        )

    def _in_reach(self, at: np.ndarray, n: int) -> np.ndarray:
        """For each of n windows, how many of the positions it can start an anchor at are given."""
        here = np.zeros(n + self.period, dtype=np.int64)
        here[at + 1] = 1
        total = np.cumsum(here)
        return total[self.period :] - total[:n]

    def windows(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Windows that hold a listed anchor, once per text, and runs of later copies within their own text.

        ``at`` is the start, plus 2**32 times the length of a run of starts that go in any case.
        """
        _, _, _, h, first = tk.words_of(batch, "_text", tk.PLAIN)
        docs, ties = batch.column("_doc").to_numpy(), batch.column("_tie").to_numpy()
        listed = batch.column("listed")
        ends = listed.offsets.to_numpy()
        flat = listed.values.to_numpy()
        out: list[list[np.ndarray]] = []
        for i in range(batch.num_rows):
            x = h[first[i] : first[i + 1]]
            n = len(x) - self.window + 1
            if n <= 0:
                continue
            at, a = self.of_words(x)
            places = flat[ends[i] : ends[i + 1]]
            shifted = places < 0
            places = np.where(shifted, -1 - places, places)
            shared = np.isin(a, a[np.isin(at, places)])
            moved = np.isin(a, a[np.isin(at, places[shifted])])
            # equal windows at one remainder share all their anchors, others share one that stands at two remainders
            whole = self._in_reach(at[shared], n) == self.in_cover.sum()
            starts = np.flatnonzero(whole | (self._in_reach(at[moved], n) > 0))
            if not len(starts):
                continue
            w = tk.runs(x, self.window)[starts]
            check = (tk.runs(x, self.window, seed=1)[starts] >> tk.U(33)).astype(np.int32)
            new = np.zeros(len(starts), dtype=bool)
            new[np.unique(w, return_index=True)[1]] = True
            begin, length = _ranges(starts[~new])
            # a run has a key of its own, which keeps it out of any shared group
            own = tk.mix(begin.astype(tk.U) + tk.U(hash((int(docs[i]), int(ties[i]))) % (1 << 64)))
            w, check = np.concatenate([w[new], own]), np.concatenate([check[new], np.zeros(len(own), np.int32)])
            at = np.concatenate([starts[new], begin + (length << 32)])
            out.append([w, check, np.full(len(w), docs[i]), np.full(len(w), ties[i]), at])
        if out:
            w, check, d, s, at = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [tk.signed(w), pa.array(check), pa.array(d), pa.array(s), pa.array(at)], ["w", "w2", "_doc", "_tie", "at"],
            )


def _ranges(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and length of each run of consecutive numbers."""
    cut = np.flatnonzero(np.diff(x, prepend=x[:1] - 2) != 1)
    return x[cut], np.diff(np.append(cut, len(x)))


def repeated_starts(rows: DataFrame, window: int = 20, period: int = 13) -> DataFrame:
    """For rows of ``keyed``: (_doc, _tie, copy, starts), the windows of each text that occur earlier.

    A start is a position, plus 2**32 times the number of starts from there on if it stands for more than one.

    Whole copies of a text are told apart by hash alone: ``copy`` is true for all but the one with the
    smallest id, and only that one is searched. Texts without a repeated window have no row.
    """
    cover = _Cover(window, period)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(cover.of_batch, tk.groups(batches, "_text"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "_text"):
            yield from cover.windows(batch)

    ids = rows.select("_doc", "_tie", "_same", "_same2")
    firsts = ids.groupBy("_same", "_same2").agg(F.min("_doc").alias("_first"))
    marked = ids.distinct().join(firsts, ["_same", "_same2"])
    copies = marked.filter("_doc > _first").select("_doc", "_tie", F.lit(True).alias("copy"), F.lit(None).cast("long").alias("at"))
    leaders = marked.filter("_doc = _first").select("_doc", "_tie", "_same")

    found = rows.select("_same", "_text").mapInArrow(anchors, "anchor long, _same long, at int")
    group = Window.partitionBy("anchor")
    rest = F.pmod("place", F.lit(period))
    # listed as -1 - place if the anchor stands at several remainders of the period; dealt out before the
    # remainder is worked out, so that three columns are shuffled
    shared = (
        found.repartition("anchor").withColumn("place", F.expr("if(at < 0, -1 - at, at)"))
        .select("anchor", "_same", "at", "place", F.min("_same").over(group).alias("low"), F.max("_same").over(group).alias("high"),
                ((F.min("at").over(group) < 0) | (F.min(rest).over(group) < F.max(rest).over(group))).alias("moved"))
        .filter("at < 0 or low < high")
        .groupBy("_same").agg(F.collect_set(F.expr("if(moved, -1 - place, place)")).alias("listed"))
    )
    # one text per group of copies is read again; both joins read the same exchange of the texts
    listed = shared.join(leaders, "_same").select("_doc", "_tie", "listed")
    near = texts_by_key(rows).join(listed, ["_doc", "_tie"]).select("_doc", "_tie", "_text", "listed")
    cut = near.mapInArrow(windows, "w long, w2 int, _doc long, _tie int, at long")
    place = F.rank().over(Window.partitionBy("w", "w2").orderBy("_doc", "_tie"))
    removed = cut.withColumn("place", place).filter("place > 1 or at >= 4294967296").select("_doc", "_tie", F.lit(False).alias("copy"), "at")
    return removed.unionByName(copies).groupBy("_doc", "_tie").agg(
        F.max("copy").alias("copy"), F.collect_set("at").alias("starts")
    )


def texts_by_key(rows: DataFrame) -> DataFrame:
    return rows.select("_doc", "_tie", "_text").repartition("_doc", "_tie")


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in tk.groups(batches, "_text"):
        counts, gone, kept = [], [], []
        copies, starts = batch.column("copy").to_pylist(), batch.column("starts")
        for i, text in enumerate(batch.column("_text")):
            words = text.as_py().encode().split()  # splits at the same six bytes as tokens.BLANKS
            n = len(words)
            keep = np.ones(n, dtype=bool)
            if copies[i] and n >= window:
                keep[:] = False
            elif starts[i].is_valid and n >= window:
                near = np.zeros(n + 1, dtype=np.int64)
                at = starts[i].values.to_numpy()
                first, more = at & 0xFFFFFFFF, np.maximum(at >> 32, 1)
                np.add.at(near, first, 1)
                np.add.at(near, first + more - 1 + window, -1)
                keep = np.cumsum(near[:n]) == 0
            left = words if keep.all() else list(itertools.compress(words, keep))
            counts.append(n)
            gone.append(n - len(left))
            kept.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
            ["_doc", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, period: int = 13) -> DataFrame:
    """Each document's words that no earlier document, and no earlier place of its own, has within an equal window.

    Returns (doc_id, n_words, n_removed, kept): kept words are joined by one space. An empty table gives an
    empty result; a text shorter than the window is never cut.
    """
    rows = keyed(docs, doc_id, text)
    cut = repeated_starts(rows, window, period)
    out = texts_by_key(rows).join(cut, ["_doc", "_tie"], "left").select("_doc", "_text", "copy", "starts").mapInArrow(
        lambda batches: _kept(batches, window), "_doc long, n_words long, n_removed long, kept string"
    )
    return out.select(id_again(doc_id), "n_words", "n_removed", "kept")
