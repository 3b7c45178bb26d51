"""Periodic runs of words, from suffix classes united by decreasing common prefix.

A run is a longest stretch of words that repeats itself with its smallest period. The suffixes of a text are sorted,
and every suffix is tied to its neighbour in that order by the length of their longest common prefix (LCP). The ties are
taken from the longest down, as Kruskal does: each unites two classes, and a class is the ordered set of the places
that share a prefix of at least the current LCP. When two classes merge, places become neighbours that were in
different classes before; if such neighbours i < j lie within the LCP of each other, the words from i on repeat with
period j - i for j - i + LCP words, and unless the word before continues it that is a run. Every run is found so: its
first two periods begin at places whose common prefix ends with the run, and a third place of their class
between them would give it a smaller period. For the same reason no pair found has a period that is not smallest.

Only runs that reach the stated length and number of periods are wanted, which bounds their LCP from below; places whose
words up to that bound stand nowhere else in the text take no part, so most texts need no sorting.

Meaning of odd input: a null text has no words; words are told apart by 64-bit hashes; a null id reaches ``order`` as
None; repeated rows get the same answer each; no documents give no rows; other columns are ignored.
A task holds the words of a megabyte of text, or of one longer text.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from transitloom.llm import tokens as tk
from transitloom.llm.rows import SMALLEST, id_again, keyed

#: (start, length, period) in words.
Run = tuple[int, int, int]
Order = Callable[[int | None, int], np.ndarray | None]
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def least_prefix(least: int, times: int) -> int:
    """The shortest common prefix that two places one period apart have at the head of a wanted run."""
    return min(max(least - p, (times - 1) * p) for p in range(1, max(least, 1) + 1))


def _blocks(x: np.ndarray, width: int) -> np.ndarray:
    """A hash of the words x[i : i + width] for every i; beyond the end the last word goes on."""
    at, out, size = np.arange(len(x)), x, 1
    while size < width:
        step = min(size, width - size)
        out, size = tk.mix(out * tk.U(0x9E3779B97F4A7C15) + out[np.minimum(at + step, len(x) - 1)] + tk.U(step)), size + step
    return out


def _repeated(values: np.ndarray) -> np.ndarray:
    """Which values stand more than once."""
    order = np.argsort(values)
    same = values[order][1:] == values[order][:-1]
    out = np.zeros(len(values), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def sorted_suffixes(x: np.ndarray) -> np.ndarray:
    """The places of x in the order of their suffixes, by doubling the length they are ranked by.

    The last value of x must stand there only. Values are ordered as numbers; only places whose rank is shared
    are ranked again.
    """
    n = len(x)
    order = np.argsort(x, kind="stable")
    rank = np.zeros(n, dtype=np.int64)
    at, key, length = np.arange(n), x[order], 1
    while True:
        new = np.ones(len(at), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        rank[order[at]] = np.maximum.accumulate(np.where(new, at, 0))
        shared = ~new
        shared[:-1] |= ~new[1:]
        at = at[shared]
        if not len(at):
            return order
        place = order[at]
        key = rank[place] * n + rank[place + length]
        again = np.argsort(key, kind="stable")
        order[at], key = place[again], key[again]
        length *= 2


def _ties(x: np.ndarray, part: np.ndarray, order: np.ndarray, width: int) -> tuple[list[int], list[int], list[int]]:
    """(LCP, place, place) of neighbours in the order of suffixes whose LCP is width or more.

    In the order of the text the LCP falls by at most one from place to place, so the words are read once.
    """
    mine = order[part[order]]
    before = np.full(len(x), -1, dtype=np.int64)
    before[mine[1:]] = mine[:-1]
    words, others = x.tolist(), before.tolist()
    lcps, left, right, length, last = [], [], [], 0, -2
    for i in np.flatnonzero(part).tolist():
        j = others[i]
        # a neighbour with a shorter common prefix takes no part, and says nothing about the next place
        length = length - 1 if i == last + 1 and length > width else 0
        last = i
        if j < 0:
            length = 0
            continue
        while words[i + length] == words[j + length]:
            length += 1
        if length >= width:
            lcps.append(length)
            left.append(j)
            right.append(i)
    return lcps, left, right


class Classes:
    """Disjoint ordered sets of places."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.places: dict[int, list[int]] = {}

    def find(self, i: int) -> int:
        parent = self.parent
        if i not in parent:
            parent[i] = i
            self.places[i] = [i]
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def unite(self, i: int, j: int) -> Iterator[tuple[int, int]]:
        """Merge the classes of two places, the smaller into the larger; yields the places that become neighbours."""
        a, b = self.find(i), self.find(j)
        if a == b:
            return
        large, small = self.places[a], self.places[b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        for k, place in enumerate(small):
            at = bisect_left(large, place)
            if at and (not k or small[k - 1] < large[at - 1]):
                yield large[at - 1], place
            if at < len(large) and (k + 1 == len(small) or small[k + 1] > large[at]):
                yield place, large[at]
        if len(small) * 16 < len(large):
            for place in small:
                insort(large, place)
        else:
            large += small
            large.sort()
        self.parent[b] = a
        del self.places[b]


def find_runs(h: np.ndarray, first: np.ndarray, least: int = 24, times: int = 3) -> dict[int, list[Run]]:
    """The runs of each text that has some, by start and period.

    ``h`` has the hashes of the words of all texts, ``first`` the first word of each and the end.
    """
    width = least_prefix(least, times)
    texts = len(first) - 1
    number = np.repeat(np.arange(texts), np.diff(first))
    # every text ends with a word of its own, and its words are like no other text's
    x = np.empty(len(h) + texts, dtype=tk.U)
    x[np.arange(len(h)) + number] = tk.mix(h ^ tk.mix((number + 1).astype(tk.U)))
    ends = first[1:] + np.arange(texts)
    x[ends] = tk.mix(~np.arange(texts, dtype=tk.U))
    number = np.repeat(np.arange(texts), np.diff(first) + 1)
    part = _repeated(_blocks(x, width))
    some = np.unique(number[part])
    if not len(some):
        return {}
    inside = np.isin(number, some)
    x, part, number = x[inside], part[inside], number[inside]
    begin = np.searchsorted(number, some)

    lcps, left, right = _ties(x, part, sorted_suffixes(x), width)
    classes, found = Classes(), []
    for t in np.argsort(-np.array(lcps, dtype=np.int64), kind="stable").tolist():
        lcp = lcps[t]
        for i, j in classes.unite(left[t], right[t]):
            period = j - i
            if lcp + period >= max(least, times * period) and (i == 0 or x[i - 1] != x[j - 1]):
                found.append((i, lcp + period, period))
    out: dict[int, list[Run]] = {}
    for start, length, period in sorted(found, key=lambda run: (run[0], run[2])):
        k = int(np.searchsorted(begin, start, "right")) - 1
        out.setdefault(int(some[k]), []).append((start - int(begin[k]), length, period))
    return out


def strongest(runs: list[Run]) -> Run | None:
    """The run with most periods, compared exactly; then the first, then that of the smallest period."""
    return max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=None)


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay if every run keeps its first period only."""
    depth = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def collapse_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 24, times: int = 3,
                  order: Order | None = None) -> DataFrame:
    """(doc_id, runs, strongest, collapsed) of every document.

    ``runs`` are the longest stretches of at least ``least`` words and ``times`` periods, ``collapsed`` the words without
    the repeats after the first period of any run. ``order`` may name, for an id and a number of words, the places from
    which the words are read instead of their own.
    """
    if least < 1 or times < 2:
        raise ValueError("a run has at least one word and two periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "_text"):
            _, _, _, h, first = tk.words_of(batch, "_text", tk.PLAIN)
            orders = {}
            for k, doc in enumerate(batch.column("_doc").to_pylist() if order else ()):
                places = order(None if doc == SMALLEST else doc, int(first[k + 1] - first[k]))
                if places is not None:
                    orders[k] = places
                    h[first[k] : first[k + 1]] = h[first[k] : first[k + 1]][places]
            runs = find_runs(h, first, least, times)
            texts = []
            for k, body in enumerate(batch.column("_text").cast(pa.large_binary())):
                words = body.as_py().split()
                if k in orders:
                    words = [words[i] for i in orders[k].tolist()]
                if k in runs:
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs[k])).tolist()]
                texts.append(b" ".join(words))
            each = [runs.get(k, []) for k in range(batch.num_rows)]
            named = [[dict(zip(("start", "length", "period"), r)) for r in some] for some in each]
            best = [strongest(some) for some in each]
            yield pa.RecordBatch.from_arrays([
                batch.column("_doc"), pa.array(named, pa.list_(_RUN)),
                pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], _RUN),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ], ["_doc", "runs", "strongest", "collapsed"])

    one = "struct<start:long,length:long,period:long>"
    found = keyed(docs, doc_id, text).select("_doc", "_text").mapInArrow(
        run, f"_doc long, runs array<{one}>, strongest {one}, collapsed string")
    return found.select(id_again(doc_id), "runs", "strongest", "collapsed")
