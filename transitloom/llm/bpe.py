"""Byte-level BPE by an automaton: merges compiled by gadgets, encoding by transitions, decoding by arc labels.

The automaton starts as one state with an arc per byte. Each merge (a, b) -> ab, taken in order of rank, is
put in by a gadget: the paths that read ``a`` then ``b`` lose that second arc from the moment of the merge
on, and gain the arc ``ab``. After the last merge every text has exactly one accepted path, and its arcs are
the tokens. A state is what the next arc must know of the last token: which pieces stood at its right edge,
and from which rank to which. An arc carries the same about its left edge. So the gadgets of all merges live
in one sparse table (pair of pieces -> rank), and a transition is allowed if no merge joined two pieces that
met at the border while both stood there. Transitions are worked out on first use and kept in a table.

Texts are cut by added tokens first and by the usual byte-level pattern then, so a word is short; words
already seen come from a bounded table.

Meaning of odd input: a null text is empty and has no tokens; ids are null where an id column holds null;
repeated rows give repeated rows; other columns are left out.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.llm import tokens as tk
from transitloom.llm.rows import small_batches

#: How byte-level tokenizers cut a text (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a table of words or transitions holds before its older half is dropped.
TABLE_ENTRIES = 300_000
_NEVER = 1 << 30
_TOKEN, _NONE = -1, -2


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Automaton:
    """States and arcs of a vocabulary; tokens carry the ids of the file."""

    def __init__(self, spec: str) -> None:
        data = json.loads(spec)
        model, pre = data["model"], data["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or data["normalizer"]:
            raise ValueError("a byte-level BPE file without prefix space or normalizer is needed")
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.label = labels(spec)
        ids = model["vocab"]
        self.gadget: dict[tuple[int, int], int] = {}  # the pair of pieces that a merge joins -> its rank
        # pieces at the right edge after a token, and at the left edge of an arc: (piece, first rank, last rank)
        self.right: dict[int, tuple] = {}
        self.left: dict[int, tuple] = {}
        self.root: dict = {}  # arcs by their labels: byte -> node, and _TOKEN -> the arc that ends there
        for c in byte_letters():
            self._arc(ids[c], ((ids[c], -1, _NEVER),), ((ids[c], -1, _NEVER),))
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self._merge(rank, ids[a], ids[b], ids[a + b])
        self.shorter = self._prefixes()
        self.size = {t: len(label) for t, label in self.label.items()}

    def _arc(self, token: int, right: tuple, left: tuple) -> None:
        self.right[token], self.left[token] = right, left
        node = self.root
        for byte in self.label[token]:
            node = node.setdefault(byte, {})
        node[_TOKEN] = token

    def _prefixes(self) -> dict[int, int]:
        """The longest other arc that every arc's label begins with; -1 if there is none."""
        found, todo = {}, [(self.root, -1)]
        while todo:
            node, above = todo.pop()
            token = node.get(_TOKEN)
            if token is not None:
                found[token] = above
                above = token
            todo += [(child, above) for key, child in node.items() if key != _TOKEN]
        return found

    def _merge(self, rank: int, a: int, b: int, ab: int) -> None:
        """The gadget of one merge: from this rank on, no path reads a and then b; the arc ab takes their place."""
        reachable = a in self.right and b in self.right and not self._joined(a, b, rank)
        self.gadget[a, b] = rank
        if reachable:
            # both edges of ab: its outermost part up to this rank, itself from now on
            self._arc(ab, _edge(ab, rank, self.right[b]), _edge(ab, rank, self.left[a]))

    def _joined(self, u: int, v: int, before: int = _NEVER) -> bool:
        """Whether some merge joins two pieces across the border of u and v, both standing there at its rank.

        Of equal pairs the left one merges first: a piece that its own left neighbour takes at that rank is gone,
        one that its right neighbour would take still stands.
        """
        for q, q_from, q_to in self.left[v]:
            for p, p_from, p_to in self.right[u]:
                r = self.gadget.get((p, q), _NEVER)
                if r < before and p_from < r < p_to and q_from < r <= q_to:
                    return True
        return False


def _edge(token: int, rank: int, part: tuple) -> tuple:
    """An edge of a merged token: itself from its rank on, its outer part up to then."""
    piece, first, _ = part[0]
    return ((token, rank, _NEVER), (piece, first, rank), *part[1:])


def labels(spec: str) -> dict[int, bytes]:
    """The bytes of every arc and added token."""
    data, letter = json.loads(spec), byte_letters()
    found = {i: bytes(letter[c] for c in t) for t, i in data["model"]["vocab"].items()}
    return found | {t["id"]: t["content"].encode() for t in data["added_tokens"]}


class Encoder:
    """An automaton with its tables of transitions and words."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton
        self.cut = regex.compile(PATTERN)
        self.added = regex.compile("|".join(map(regex.escape, sorted(automaton.added, key=len, reverse=True)))) if automaton.added else None
        self.allowed: dict[int, bool] = {}
        self.words = _Table(self._word)

    def _word(self, word: str) -> bytes:
        """The accepted path of a word: the longest arc first, shorter ones where no transition allows it.

        A place is reached by one path only, so a place without a way on is never tried again.
        """
        a, data = self.automaton, word.encode()
        n, root, allowed, shorter, size = len(data), a.root, self.allowed, a.shorter, a.size
        if len(allowed) > TABLE_ENTRIES:
            allowed.clear()
        path: list[int] = []
        dead: set[int] = set()
        at, t = 0, -1
        while at < n:
            if t < 0:
                node, i = root, at
                while i < n:
                    node = node.get(data[i])
                    if node is None:
                        break
                    t = node.get(_TOKEN, t)
                    i += 1
            while t >= 0:
                end = at + size[t]
                if end not in dead:
                    if not path:
                        break
                    key = path[-1] << 20 | t
                    ok = allowed.get(key)
                    if ok is None:
                        ok = allowed[key] = not a._joined(path[-1], t)
                    if ok:
                        break
                t = shorter[t]
            if t >= 0:
                path.append(t)
                at, t = end, -1
            else:
                dead.add(at)
                t = path.pop()
                at -= size[t]
                t = shorter[t]
                if t < 0:  # nothing shorter here either: go further back
                    t = _NONE
            if t == _NONE:
                t = -1
                while t < 0:
                    dead.add(at)
                    t = path.pop()
                    at -= size[t]
                    t = shorter[t]
        return array("i", path).tobytes()

    def encode(self, text: str) -> bytes:
        """Token ids of a text as 32-bit numbers."""
        if self.added is None or not any(t in text for t in self.automaton.added):
            return b"".join(map(self.words.__getitem__, self.cut.findall(text)))
        out, at = [], 0
        for found in self.added.finditer(text):
            out += map(self.words.__getitem__, self.cut.findall(text[at : found.start()]))
            out.append(array("i", [self.automaton.added[found[0]]]).tobytes())
            at = found.end()
        out += map(self.words.__getitem__, self.cut.findall(text[at:]))
        return b"".join(out)


class _Table(dict):
    """Results by word; of two generations, the older goes when the newer is full."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        if len(self) >= TABLE_ENTRIES:
            self.old = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


def read_spec(path: str) -> str:
    """The tokenizer file, read by the driver; its size is that of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", decoded: str | None = None) -> DataFrame:
    """(doc_id, ids): the token ids of every text, in order. ``decoded`` names a column for what the ids decode to."""
    small_batches(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = table = None
        for batch in tk.groups(batches, "_text", hold=True):
            encoder = encoder or tk.held(("bpe", hash(spec.value)), lambda: Encoder(Automaton(spec.value)))
            parts = [encoder.encode(t.as_py() or "") for t in batch.column("_text")]
            ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))
            if decoded is None:
                yield pa.RecordBatch.from_arrays([batch.column("_id"), ids], [doc_id, "ids"])
                continue
            table = table or _Labels(encoder.automaton.label)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), ids, table.texts(ids)], [doc_id, "ids", decoded])

    schema = f"`{doc_id}` {docs.schema[doc_id].dataType.simpleString()}, ids array<int>" + (f", `{decoded}` string" if decoded else "")
    return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with ``text`` in place of ``ids``: the labels of the arcs, one after the other.

    Bytes that are not UTF-8 become U+FFFD; a null list is an empty text.
    """
    small_batches(coded.sparkSession)
    spec = coded.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for whole in batches:
            table = table or _Labels(labels(spec.value))
            for batch in _by_ids(whole):
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], table.texts(batch.columns[-1])], names)

    rest = coded.drop(ids)
    names = [*rest.columns, text]
    return coded.select(*rest.columns, ids).mapInArrow(run, rest.schema.add(text, "string"))


class _Labels:
    """All arc labels end to end, so that many tokens are looked up at once."""

    def __init__(self, labels: dict[int, bytes]) -> None:
        self.size = np.zeros(max(labels) + 1, dtype=np.int64)
        for i, label in labels.items():
            self.size[i] = len(label)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(labels[i] for i in sorted(labels)), dtype=np.uint8)

    def texts(self, lists: pa.ListArray) -> pa.Array:
        each = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        n = self.size[each]
        to = np.concatenate([[0], np.cumsum(n)])
        data = self.flat[np.repeat(self.begin[each] - to[:-1], n) + np.arange(to[-1])].tobytes()
        edges = to[np.concatenate([[0], np.cumsum(_lengths(lists))])].tolist()
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(edges, edges[1:])], pa.string())


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _by_ids(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about a million ids together, one row at least."""
    which = np.cumsum(_lengths(batch.columns[-1])) >> 20
    edges = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)
