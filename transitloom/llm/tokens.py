"""Words and their 64-bit hashes, worked out over whole Arrow batches at once.

Texts are UTF-8, and every separator used here is an ASCII byte, so bytes can be classed by a table of
256 entries. A word's hash is a polynomial over its bytes taken from prefix sums modulo 2**64, then mixed;
the hash of a run of words is a polynomial over word hashes, mixed again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes handled at a time: bounds the working memory of a task, whatever the length of a text.
SLICE_BYTES = 1 << 18
#: Bytes of text of a group of documents that are handled together.
GROUP_BYTES = 1 << 20
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, SLICE_BYTES + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), SLICE_BYTES + 1)


class Words:
    """A way to cut words: bytes that part words, and whether A-Z count as a-z."""

    def __init__(self, parts: Iterable[int], lower: bool = False) -> None:
        self.inside = np.ones(256, dtype=bool)
        self.inside[list(parts)] = False
        letters = np.arange(256, dtype=U)
        if lower:
            letters[65:91] += U(32)
        self.value = mix((letters + U(1)) * U(_STEP))

    def spans(self, data: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words in data; cuts are places where a word ends in any case."""
        inside = self.inside[data]
        edge = np.empty(len(data) + 1, dtype=bool)
        edge[0], edge[-1] = inside[:1].any(), inside[-1:].any()
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
        if cuts is None or not len(cuts):
            at = np.flatnonzero(edge)
            return at[::2], at[1::2]
        # a cut between two bytes that both lie inside a word ends one word and begins another
        inner = cuts[(cuts > 0) & (cuts < len(data))]
        inner = np.unique(inner[inside[inner] & inside[inner - 1]])
        at = np.flatnonzero(edge)
        if len(inner):
            at = np.sort(np.concatenate([at, inner, inner]))
        return at[::2], at[1::2]

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of every word; its bytes are summed slice by slice."""
        out = np.zeros(len(starts), dtype=U)
        first = 0
        while first < len(starts):
            base = int(starts[first])
            last = max(first + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
            stop = int(ends[last - 1])
            if stop - base > SLICE_BYTES:  # one word longer than a slice: fold it piece by piece
                h = 0
                for at in range(base, stop, SLICE_BYTES):
                    piece = self.value[data[at : min(stop, at + SLICE_BYTES)]]
                    h = int(mix(np.array([(h + int((piece * _UP[: len(piece)]).sum(dtype=U))) % (1 << 64)], dtype=U))[0])
                out[first] = h
            else:
                sums = np.zeros(stop - base + 1, dtype=U)
                np.cumsum(self.value[data[base:stop]] * _UP[: stop - base], out=sums[1:])
                s, e = starts[first:last] - base, ends[first:last] - base
                out[first:last] = (sums[e] - sums[s]) * _DOWN[s]
            first = last
        return mix(out + (ends - starts).astype(U) * U(_STEP))


#: Words split at space, tab and the line and page breaks; the bytes are fixed values.
BLANKS = (0x20, *range(0x09, 0x0E))
PLAIN = Words(BLANKS)
LOWER = Words(BLANKS, lower=True)
#: Lower-cased words of letters, digits and everything beyond ASCII; the ranges are fixed values.
ALNUM = Words((*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)), lower=True)


def runs(h: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The hash of each run of size consecutive words, by its start."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    out = np.zeros(n, dtype=U)
    base = U((_BASE + 2 * seed) % (1 << 64))
    for i in range(size):
        out *= base
        out += h[i : i + n]
    return mix(out ^ U((size * _STEP + seed) % (1 << 64)))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and where each text begins in them; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_held: dict[object, object] = {}


def held(key: object, make: Callable[[], object]) -> object:
    """What a worker keeps from task to task: one operator's tables, until another operator runs there."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def groups(batches: Iterator[pa.RecordBatch], text: str, hold: bool = False) -> Iterator[pa.RecordBatch]:
    """Each batch cut into rows that hold about GROUP_BYTES of text together, one row at least.

    An operator that holds no tables of its own lets go of those that another left.
    """
    if not hold:
        _held.clear()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        which = np.cumsum(size) // GROUP_BYTES
        edges = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def words_of(batch: pa.RecordBatch, text: str, kind: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts, word ends, word hashes, and the first word of each row (one entry more than rows)."""
    data, offsets = texts(batch.column(text))
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, none, np.zeros(0, U), np.zeros(batch.num_rows + 1, np.int64)
    starts, ends = kind.spans(data, offsets)
    return data, starts, ends, kind.hashes(data, starts, ends), np.searchsorted(starts, offsets)


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's long."""
    return pa.array(x.view(np.int64))


def firsts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each value, and how often it stands there."""
    _, at, n = np.unique(h, return_index=True, return_counts=True)
    return at, n
