"""Documents with nearly the same n-grams, from a blocked product of the document by n-gram matrix.

Documents with equal n-gram sets are one row of the matrix, a class. Its columns are dealt into blocks by
hash. Two sets whose Jaccard similarity is at least t differ in at most (1 - t) / (1 + t) * (|a| + |b|)
n-grams; with more blocks than that they agree on a whole block. So each row is cut into that many blocks,
as its size demands, and only rows with an equal block meet. (Sizes fall into levels of ratio t; a row takes
part in the grid of its own level and in that of the next.) For rows that meet, sketches bound the overlap from
above; where they leave room for a link it is counted in full, and the pair is kept or discarded by the bound that
the two sizes set.

Rows of one block are not all paired with each other. The one that meets most others over all blocks is
compared with the rest; then the next with those that no link has yet joined to it, for PIVOTS rounds. Rows of
blocks that still hold several components are compared where they share a rare n-gram, as a link demands.
Every pair left out is in one component already or below the bound, so components are exact.

Each step is stored before the next: the exchanges of a plan start together, and the driver holds buffers for every
one of them, so many small plans take less of it than a few wide ones. Steps without rows are left out.

Meaning of odd input: a null text is empty; an empty set is linked with nothing; a null id counts as the
smallest id; rows equal in id and text get the same answer; classes are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitloom.llm import tokens as tk
from transitloom.llm.graph import stars, stored
from transitloom.llm.rows import id_again, keyed, without

#: Rounds in which the next row of each block is compared with the others.
PIVOTS = 2
#: Blocks beyond the bound and those likely to be empty; a row with still more empty blocks keeps them as blocks like any other.
SPARE = 2
#: How often rows with too few open blocks are put aside.
NARROWINGS = 3
#: Counts of a row's sketch.
BUCKETS = 256


def ngrams(h: np.ndarray, size: int) -> np.ndarray:
    """The distinct n-grams of a text's word hashes, sorted; fewer words than that are one n-gram."""
    if not len(h):
        return h
    return np.unique(tk.runs(h, min(size, len(h))))


class Grid:
    """Size levels and the blocks of each, for a similarity of percent / 100."""

    def __init__(self, percent: int) -> None:
        if not 0 < percent <= 100:
            raise ValueError("the similarity must be above 0 and at most 100 percent")
        self.percent = percent
        self.bounds = [1, 2]  # level k holds the sizes from bounds[k] below bounds[k + 1]
        self.cuts: dict[int, np.ndarray | None] = {}
        self.spare: dict[int, int] = {}

    def level(self, n: int) -> int:
        while self.bounds[-1] <= n:
            last = self.bounds[-1]
            self.bounds.append(max(last + 1, (last - 1) * 100 // self.percent + 1))
        return int(np.searchsorted(self.bounds, n, "right")) - 1

    def blocks(self, level: int) -> np.ndarray | None:
        """Where the blocks of a level's grid begin in the space of hashes; None if only equal sets are alike."""
        if level not in self.cuts:
            self.level(1 if level < 0 else self.bounds[min(level, len(self.bounds) - 1)])
            while len(self.bounds) < level + 2:
                self.level(self.bounds[-1])
            most = self.bounds[level + 1] - 1
            apart = 2 * most * (100 - self.percent) // (100 + self.percent)
            empty = (apart + 1) * math.exp(-self.bounds[level] / (apart + 1))  # of the smallest row of the level, on average
            self.spare[level] = SPARE + math.ceil(empty + 4 * math.sqrt(empty))
            n = apart + 1 + self.spare[level]
            self.cuts[level] = np.array([(i << 64) // n for i in range(n)], dtype=tk.U) if apart else None
        return self.cuts[level]

    def signatures(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One hash per block of the row in the grids of its level and the next; for each the number of the grid (0, 1)
        and how many blocks of that grid a row that is linked to this one has in common with it, at least."""
        level = self.level(len(grams))
        sums = np.concatenate([np.zeros(1, tk.U), np.cumsum(tk.mix(grams ^ tk.U(0xA5A5A5A5)))])
        out, grid, need = [], [], []
        for g in (level, level + 1):
            cuts = self.blocks(g)
            if cuts is None:
                continue
            at = np.append(np.searchsorted(grams, cuts), len(grams))
            full = np.diff(at) > 0
            sig = tk.mix((sums[at[1:]] - sums[at[:-1]]) + np.arange(len(cuts), dtype=tk.U) * tk.U(0x9E3779B97F4A7C15) + tk.U(g << 40))
            empty = int(len(cuts) - full.sum())
            # blocks that are empty in both rows agree too, but are left out if they are few
            few = empty <= self.spare[g]
            out.append(sig[full] if few else sig)
            grid.append(np.full(len(out[-1]), g - level, dtype=np.int8))
            need.append(np.full(len(out[-1]), max(1, self.spare[g] + 1 - empty), dtype=np.int32))
        if not out:
            return np.zeros(0, tk.U), np.zeros(0, np.int8), np.zeros(0, np.int32)
        return np.concatenate(out), np.concatenate(grid), np.concatenate(need)


def _class(grams: np.ndarray) -> int:
    return int(tk.mix(tk.mix(grams).sum(dtype=tk.U, keepdims=True) + tk.U(len(grams))).view(np.int64)[0])


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """(_doc, _tie, n, class): the number of n-grams of each document and the hash of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "_text"):
            _, _, _, h, first = tk.words_of(batch, "_text", tk.LOWER)
            sets = [ngrams(h[a:b], size) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("_doc"), batch.column("_tie"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_class(s) if len(s) else None for s in sets], pa.int64()),
            ], ["_doc", "_tie", "n", "class"])

    return rows.select("_doc", "_tie", "_text").mapInArrow(run, "_doc long, _tie int, n long, class long")


def _signed_blocks(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(block, class, n, grid, need): the block hashes of every row of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = Grid(percent)
        for batch in tk.groups(batches, "_text"):
            _, _, _, h, first = tk.words_of(batch, "_text", tk.LOWER)
            seen, blocks, classes, sizes, grids, needs = set(), [], [], [], [], []
            for a, b in zip(first[:-1], first[1:]):
                grams = ngrams(h[a:b], size)
                c = _class(grams) if len(grams) else None
                if c is None or c in seen:  # copies within a batch add nothing
                    continue
                seen.add(c)
                sig, which, need = grid.signatures(grams)
                blocks.append(sig)
                grids.append(which)
                needs.append(need)
                classes.append(np.full(len(sig), c))
                sizes.append(np.full(len(sig), len(grams), dtype=np.int32))
            if blocks:
                yield pa.RecordBatch.from_arrays(
                    [tk.signed(np.concatenate(blocks)), pa.array(np.concatenate(classes), pa.int64()),
                     *(pa.array(np.concatenate(c)) for c in (sizes, grids, needs))], ["block", "class", "n", "grid", "need"])

    return rows.select("_text").mapInArrow(run, "block long, class long, n int, grid byte, need int")


def sketch(grams: np.ndarray) -> np.ndarray:
    """How many n-grams fall into each of BUCKETS, up to 255: two rows share at most the sum of the smaller counts."""
    return np.minimum(np.bincount((grams >> tk.U(24)).astype(np.int64) % BUCKETS, minlength=BUCKETS), 255).astype(np.uint8)


def _sketched(texts: DataFrame, size: int) -> DataFrame:
    """(class, text, n, sketch) of the rows of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "text"):
            _, _, _, h, first = tk.words_of(batch, "text", tk.LOWER)
            sets = [ngrams(h[a:b], size) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
            ], ["class", "text", "n", "sketch"])

    return texts.select("class", "text").mapInArrow(run, "class long, text string, n long, sketch binary")


def _possible(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches leave room for a link; texts are sent for these only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, BUCKETS) for c in ("sketch_a", "sketch_b"))
            less = np.minimum(x, y)
            most = less.sum(axis=1, dtype=np.int64)
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            keep = ((less == 255).any(axis=1)) | (most * (100 + percent) >= percent * both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def side(name: str) -> DataFrame:
        return texts.select(F.col("class").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(
        run, "a long, b long")


def _overlaps(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, linked): the product of the two rows of each pair, against the bound of their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, set_b = None, None
        for whole in batches:
            for batch in tk.groups(iter([whole]), "text_a"):
                _, _, _, h, first = tk.words_of(batch, "text_a", tk.LOWER)
                bs, linked = batch.column("b").to_pylist(), []
                for i, b in enumerate(bs):
                    if b != name:  # pairs come sorted by b
                        row = batch.slice(i, 1)
                        name, set_b = b, ngrams(tk.words_of(row, "text_b", tk.LOWER)[3], size)
                    set_a = ngrams(h[first[i] : first[i + 1]], size)
                    x, y = len(set_a), len(set_b)
                    met = 0
                    if 100 * min(x, y) >= percent * max(x, y):
                        met = len(np.intersect1d(set_a, set_b, assume_unique=True))
                    linked.append(met > 0 and 100 * met >= percent * (x + y - met))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked)], ["a", "b", "linked"])

    def side(name: str) -> DataFrame:
        asked = pairs.select(F.col(name).alias("class")).distinct()
        return texts.select("class", "text").join(asked, "class", "left_semi").select(F.col("class").alias(name), F.col("text").alias(f"text_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean")


def _close(x: str, y: str, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def linked_classes(rows: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame | None:
    """(node, root): classes joined by links to smaller ones, and the smallest class of their component; None without links."""
    blocks = _signed_blocks(rows, size, percent)
    by = Window.partitionBy("block")
    met = blocks.withColumn("low", F.min("class").over(by)).withColumn("high", F.max("class").over(by)).filter("low < high")
    met = met.dropDuplicates(["block", "class"]).withColumn("rows", F.count("*").over(by))
    met = stored(met.select("block", "class", "n", "grid", "need", "rows"), "blocks")
    # a text that others are edits of meets more rows than any of them: it is compared first
    hubs = met.groupBy("class").agg(F.sum("rows").alias("hub"))
    order = by.orderBy(F.col("hub").desc(), "class")
    met = met.join(hubs, "class").select("block", "class", "n", "grid", "need", F.row_number().over(order).alias("place"))
    met = stored(met, "blocks")

    one = sets.groupBy("class").agg(F.min(F.struct("_doc", "_tie")).alias("one"))
    one = met.select("class").distinct().join(one, "class").select("class", "one.*")
    texts = one.join(rows, ["_doc", "_tie"]).groupBy("class").agg(F.first("_text").alias("text"))
    texts = stored(_sketched(texts, size), "rows")

    done = roots = None
    for turn in range(1, PIVOTS + 2):
        now = _rooted(met.filter(F.col("place") >= turn), roots)
        pairs = _against_pivot(now, turn, percent) if turn <= PIVOTS else _against_rare(now, texts, size, percent)
        if pairs is None:
            continue
        pairs = pairs.distinct() if done is None else pairs.distinct().join(done, ["a", "b"], "left_anti")
        pairs = stored(pairs, "met")
        if pairs.isEmpty():
            continue
        # stored, so that their size is known: few pairs fetch their texts without a shuffle of all texts
        pairs = stored(_possible(pairs, texts, percent), "pairs")
        if pairs.isEmpty():
            continue
        found = stored(_overlaps(pairs, texts, size, percent), "links")
        done = found.select("a", "b") if done is None else done.unionByName(found.select("a", "b"))
        links = found.filter("linked").select("a", "b")
        if links.isEmpty():  # the components stay as they are
            continue
        if roots is not None:
            links = links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = stars(links)
    return roots


def _rooted(met: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The rows of the blocks, each with the smallest class of its component."""
    if roots is None:
        return met.withColumn("root", F.col("class"))
    now = met.join(roots, met["class"] == roots["node"], "left").select(*met.columns, F.coalesce("root", "class").alias("root"))
    return stored(now, "rooted")


def _against_pivot(now: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): in every block, the rows after the one in turn, with that one."""
    low = now.filter(F.col("place") == turn).select(
        "block", F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"))
    return now.filter(F.col("place") > turn).join(low, "block").filter("root <> root_b").filter(
        _close("n", "n_b", percent)).select(F.col("class").alias("a"), "b")


def _against_rare(now: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame | None:
    """(a, b): of blocks with several components left, the rows that may still be linked; None if there are no such blocks.

    A row shares as many of its blocks with one that it is linked to as ``need`` says, and all of those are still open, or
    the two would have been compared; rows with fewer open blocks are done. Of the others, two that are linked share one
    of the rarest n-grams of each, as many of them as a link leaves unshared and one more. N-grams that one row has alone,
    and those before the first shared one, cannot count towards an overlap; that bounds it from above.
    """
    left = now.filter(F.col("place") > PIVOTS).select("block", "class", "n", "grid", "need", "root")
    for _ in range(NARROWINGS):  # rows that go may close further blocks
        open_ = left.groupBy("block").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
        left = stored(left.join(open_, "block", "left_semi"), "open")
        able = left.groupBy("class", "grid").agg(F.count("*").alias("blocks"), F.max("need").alias("most")).filter("blocks >= most")
        left = stored(left.join(able, ["class", "grid"], "left_semi"), "open")
        if left.isEmpty():
            return None
    rows = left.select("class", "n", "root").distinct()
    grams = _grams(texts.join(rows, "class", "left_semi"), size)
    counted = grams.join(grams.groupBy("gram").agg(F.count("*").alias("rows")), "gram")
    by_class = Window.partitionBy("class")
    ranked = counted.withColumn("place", F.row_number().over(by_class.orderBy("rows", "gram"))).withColumn(
        "own", F.sum((F.col("rows") == 1).cast("int")).over(by_class))
    unshared = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rare = ranked.join(rows, "class").filter((F.col("rows") > 1) & (F.col("place") <= unshared)).select(
        "gram", "class", "n", "root", F.least(F.col("n") - F.col("own"), F.col("n") - F.col("place") + 1).alias("most"))
    rare = stored(rare, "rare")
    other = rare.select("gram", *(F.col(c).alias(f"{c}_b") for c in ("class", "n", "root", "most")))
    # 100 * overlap >= percent * (n + n_b - overlap), at the first n-gram that both have
    enough = F.least("most", "most_b") * (100 + percent) >= (F.col("n") + F.col("n_b")) * percent
    return rare.join(other, "gram").filter(F.col("class") < F.col("class_b")).filter("root <> root_b").filter(
        _close("n", "n_b", percent) & enough).select(F.col("class").alias("a"), F.col("class_b").alias("b"))


def _grams(texts: DataFrame, size: int) -> DataFrame:
    """(class, gram): the matrix entries of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "text"):
            _, _, _, h, first = tk.words_of(batch, "text", tk.LOWER)
            sets = [ngrams(h[a:b], size) for a, b in zip(first[:-1], first[1:])]
            names = np.repeat(batch.column("class").to_numpy(), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(names), tk.signed(np.concatenate([np.zeros(0, tk.U), *sets]))], ["class", "gram"])

    return texts.select("class", "text").mapInArrow(run, "class long, gram long")


def components_of(rows: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(_doc, _tie, n, component) for every row of ``keyed``."""
    sets = stored(_sets(rows, size), "sets")
    roots = linked_classes(rows, sets, size, percent)
    named = sets.filter("n > 0").groupBy("class").agg(F.min("_doc").alias("low"))
    if roots is None:  # each class is a component
        named = named.select("class", F.col("low").alias("component"))
        return sets.join(named, "class", "left").select("_doc", "_tie", "n", F.coalesce("component", "_doc").alias("component"))
    named = stored(named.join(roots, named["class"] == roots["node"], "left").select(
        "class", "low", F.coalesce("root", "class").alias("root")), "named")
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    named = named.join(lowest, "root").select("class", "component")
    return sets.join(named, "class", "left").select("_doc", "_tie", "n", F.coalesce("component", "_doc").alias("component"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document.

    Documents are linked if ``percent`` of the n-grams that either has stand in both; the component is named by
    its smallest id.
    """
    found = components_of(keyed(docs, doc_id, text), size, percent)
    return found.select(id_again(doc_id), F.col("n").alias("n_shingles"), id_again("component_id", "component"))


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """The documents that have the smallest id of their component; rows equal in id and text stay or go together."""
    found = stored(components_of(keyed(docs, doc_id, text), size, percent).filter("n > 0"), "components")
    # a component bears the id of its first document; of several texts with that id the smallest tie stays
    named = found.filter("_doc = component")
    first = named.groupBy("component").agg(F.min("_tie").alias("first"))
    again = named.join(first, "component").filter("_tie > first").select("_doc", "_tie")
    gone = found.filter("_doc > component").select("_doc", "_tie").unionByName(again)
    return without(docs, gone, doc_id, text)
