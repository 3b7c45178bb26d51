"""Near copies by fingerprints that differ in few bits, compared bit plane by bit plane.

A fingerprint bit tells whether most shingles of a text have that bit set in their hash. Equal fingerprints are
one row. Two that differ in at most ``radius`` bits agree on a whole part of any cut into more parts than that;
with two parts more they agree on two parts at once, so rows meet by pairs of equal parts and only there.

Rows that meet are compared vertically: a block of sorted rows is stored as 64 planes, plane b holding bit b of
every row, eight rows to a byte. The block is laid over itself shifted by one row, by two rows, and so on as far
as its longest group reaches. For a shift, each plane is XORed with its shifted self, and the differing bits are
added to carry-save counters, which count for all rows of the block at once; rows beyond the radius are marked,
and the block is left as soon as no row is within it. Rows that a link has already joined start as marked, so a
dense group costs no more links than it has rows.

A group larger than CHUNK is dealt into chunks by hash, and every two of its chunks meet in a group of their own:
no task holds more than two chunks, and no pair of rows is left out.

Meaning of odd input: a null text is empty; a text without words has fingerprint zero and is linked like any
other; a null id counts as the smallest id; repeated rows get the same answer; no documents give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.llm import tokens as tk
from transitloom.llm.graph import components, stored
from transitloom.llm.rows import id_again, keyed, small_batches

BITS = 64
SEED = 42
#: Rows of a group that one task compares, and rows of a block.
CHUNK, BLOCK = 2048, 4096
#: Bytes of a text that are cut into words at a time.
_PIECE = 1 << 17
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: A fingerprint with more than one in HOT of all rows is hot: there are fewer than HOT of them.
HOT = 1000


def fingerprint(text: bytes, size: int = 3) -> int:
    """The bits that more than half of a text's shingles have in their hash; long texts are taken piece by piece."""
    set_, n, words, at = np.zeros(BITS, dtype=np.int64), 0, [], 0
    while at < len(text):
        end = _BLANK.search(text, at + _PIECE)
        stop = end.start() if end else len(text)
        words += text[at:stop].lower().split()  # both know the ASCII letters and blanks only
        at = stop
        if len(words) >= size or at == len(text) and not n and words:
            h = _hashes(words, min(size, len(words)))
            set_ += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            n += len(h)
            words = words[len(words) - size + 1 :] if len(words) >= size else []
    return int.from_bytes(np.packbits(2 * set_ > n).tobytes(), "big")


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], dtype=">u8")


def fingerprints(rows: DataFrame, size: int = 3) -> DataFrame:
    """(_doc, fp): the fingerprint of every row of ``keyed``, as a long of the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "_text"):
            body = batch.column("_text").cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py(), size) for t in body], dtype=tk.U)
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), tk.signed(found)], ["_doc", "fp"])

    return rows.select("_doc", "_text").mapInArrow(run, "_doc long, fp long")


# -- where rows meet -------------------------------------------------------------------------------

def _parts(radius: int) -> list[tuple[int, int]]:
    """First bit and width of each part: two more than the radius leaves untouched."""
    n = radius + 2
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _keys(radius: int) -> Column:
    """One key for each pair of parts: its number and the bits of both."""
    parts = _parts(radius)

    def bits(part: tuple[int, int]) -> Column:
        return F.shiftrightunsigned("fp", part[0]).bitwiseAND(F.lit((1 << part[1]) - 1))

    pairs = [(i, j) for i in range(len(parts)) for j in range(i + 1, len(parts))]
    return F.array(*(
        F.struct(F.lit(n).cast("byte").alias("pair"), F.shiftleft(bits(parts[i]), parts[j][1]).bitwiseOR(bits(parts[j])).alias("both"))
        for n, (i, j) in enumerate(pairs)))


def meetings(distinct: DataFrame, radius: int, chunk: int = CHUNK) -> DataFrame:
    """(pair, both, a, b, fp): the groups in which fingerprints are compared; of a chunked one, two chunks at a time."""
    keyed_ = distinct.select("fp", F.explode(_keys(radius)).alias("key")).select("fp", "key.*")
    size = keyed_.groupBy("pair", "both").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed_.join(size, ["pair", "both"])
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    mine = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    met = met.select("pair", "both", "fp", chunks.alias("chunks"), mine.alias("mine"))
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: (c != F.col("mine")) | (F.col("chunks") == 1))
    return met.select("pair", "both", "fp", "mine", F.explode(others).alias("other")).select(
        "pair", "both", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp")


# -- the bit-sliced comparison ---------------------------------------------------------------------

class Planes:
    """The bits of a block of fingerprints by plane, packed once for each of the eight offsets within a byte."""

    def __init__(self, fps: np.ndarray) -> None:
        rows = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        # the order of planes is without meaning: those that tell most rows apart come first
        uneven = np.abs(2 * rows.sum(axis=0, dtype=np.int64) - len(fps))
        bits = np.ascontiguousarray(rows.T[np.argsort(uneven, kind="stable")])
        self.width = -(-len(fps) // 8)
        self.moved = np.zeros((BITS, 8, self.width), dtype=np.uint8)
        for offset in range(min(8, len(fps))):
            packed = np.packbits(bits[:, offset:], axis=1)
            self.moved[:, offset, : packed.shape[1]] = packed

    def within(self, bytes_: int, radius: int, asked: np.ndarray) -> np.ndarray:
        """For the eight shifts from 8 * bytes_ on: which rows of those asked differ in at most radius bits from the row
        that the shift lays over them."""
        width = self.width - bytes_
        beyond = ~np.packbits(asked, axis=1)[:, :width]
        counters = np.zeros((radius.bit_length(), 8, width), dtype=np.uint8)  # bit j of every count
        for plane in self.moved:
            carry = plane[:1, :width] ^ plane[:, bytes_:]
            for counter in counters:  # carry-save: what a bit of the counts cannot hold goes on to the next
                counter[:], carry = counter ^ carry, counter & carry
            beyond |= carry
            if (radius + 1) & radius:  # the counters hold radius + 1 and more
                beyond |= self._above(counters, radius)
            if beyond.min(initial=255) == 255:
                break
        return np.unpackbits(~beyond, axis=1, count=asked.shape[1]).astype(bool) if width else np.zeros_like(asked)

    @staticmethod
    def _above(counters: np.ndarray, radius: int) -> np.ndarray:
        """Where the counts exceed the radius, told from the highest bit down."""
        more, same = np.zeros_like(counters[0]), np.full_like(counters[0], 255)
        for j in reversed(range(len(counters))):
            if radius >> j & 1:
                same &= counters[j]
            else:
                more |= same & counters[j]
                same &= ~counters[j]
        return more


def links(fps: np.ndarray, groups: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning set of the links between rows of equal group, groups lying side by side: places (i, j)."""
    found, n, root = [], len(fps), np.arange(len(fps))
    planes = Planes(fps)
    longest = int(np.unique(groups, return_counts=True)[1].max()) if n else 0
    for first in range(0, longest, 8):
        asked = np.zeros((8, planes.width * 8), dtype=bool)
        for by in range(max(first, 1), min(first + 8, n)):
            np.logical_and(groups[:-by] == groups[by:], root[:-by] != root[by:], out=asked[by - first, : n - by])
        if not asked.any():
            continue
        near = planes.within(first // 8, radius, asked[:, : (planes.width - first // 8) * 8])
        for offset, i in zip(*(at.tolist() for at in np.nonzero(near))):
            j = i + first + offset
            a, b = int(root[i]), int(root[j])
            if a != b:
                found.append((i, j))
                root[root == max(a, b)] = min(a, b)
    return found


def linked(met: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that span every component of fingerprints within the radius."""
    by = ["pair", "both", "a", "b"]

    def compared(table: pa.Table) -> pa.RecordBatch:
        fps = table.column("fp").to_numpy().view(tk.U)
        at = links(fps, _numbered(table, by), radius)
        return pa.RecordBatch.from_arrays(
            [tk.signed(fps[[i for i, _ in at]]), tk.signed(fps[[j for _, j in at]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)])
            if held.num_rows < BLOCK:
                continue
            number = _numbered(held, by)
            whole = int(np.searchsorted(number, number[-1]))  # the last group may go on
            if whole:
                yield compared(held.slice(0, whole))
                held = held.slice(whole).combine_chunks()
        if held is not None and held.num_rows:
            yield compared(held)

    groups = met.repartition(*by).sortWithinPartitions(*by, "fp")
    return groups.select(*by, "fp").mapInArrow(run, "a long, b long")


def _numbered(table: pa.Table, by: list[str]) -> np.ndarray:
    """Numbers from 0 of the groups of a sorted table."""
    new = np.zeros(table.num_rows, dtype=bool)
    for name in by:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


# -- components ------------------------------------------------------------------------------------

def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, radius: int = 2,
                chunk: int = CHUNK) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document; the component bears the smallest id that links reach."""
    if not 0 <= radius < BITS // 2 or size < 1 or chunk < 1:
        raise ValueError("the radius must lie in 0 to 31, shingle and chunk sizes must be positive")
    rows = stored(fingerprints(keyed(docs, doc_id, text), size), "fingerprints")
    small_batches(docs.sparkSession, rows=BLOCK)
    distinct = stored(rows.groupBy("fp").agg(F.min("_doc").alias("low"), F.count("*").alias("n")), "distinct")
    roots = components(linked(meetings(distinct, radius, chunk), radius))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    named = stored(named.join(lowest, "root").select("fp", "n", "component"), "components")
    # rows of a hot fingerprint meet its component where they lie; the others by a shuffle
    total = distinct.agg(F.sum("n").alias("n"))
    hot = F.broadcast(named.filter(F.col("n") * HOT > total.scalar()).select("fp", "component"))  # fewer than HOT rows
    found = rows.join(hot, "fp").unionByName(rows.join(hot, "fp", "left_anti").join(named.select("fp", "component"), "fp"))
    return found.select(
        id_again(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), id_again("component_id", "component"))
