"""Token counts of a unigram vocabulary, worked out once per shared prefix of the pre-tokens.

The distinct pre-tokens of a batch of documents, sorted, are the paths of a trie in depth-first order. For every
trie node the best score of the prefix and its number of pieces are worked out from the nodes above it, so a
prefix that many pre-tokens share costs once; the count at a terminal node is that of the pre-token. Pre-tokens
met before come from a bounded table.

A pre-token is a word between white space, with the mark of a word start before it. Its segmentation is the one
with the highest sum of piece scores, fewest pieces among equals; a character that no piece covers counts one
token per byte.

Meaning of odd input: a null text is empty and has no tokens; ids may be null or repeated, every row is counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.llm import tokens as tk
from transitloom.llm.rows import small_batches

#: The mark of a word start in the vocabulary (fixed value).
START = "▁"
#: Pre-tokens that a task remembers, in two generations.
TABLE_ENTRIES = 300_000


def read_pieces(path: str) -> dict[str, float]:
    """Pieces and unigram scores of a vocabulary file, read by the driver.

    Files that give merge ranks instead of probabilities get the scores of Zipf's law over the ranks.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in pieces}
    if max(map(abs, scores.values()), default=0) > 1000:
        total = math.log(sum(1 / k for k in range(1, len(scores) + 1)))
        order = sorted(scores, key=lambda p: (-scores[p], p))
        return {p: -math.log(k) - total for k, p in enumerate(order, 1)}
    return scores


class Counter:
    """Counts by pre-token, with the scores of the trie path in hand."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def learn(self, words: set[str]) -> None:
        """Counts of all words not yet known, in the order of the trie."""
        known = self.old
        fresh = []
        for w in words:
            n = known.get(w)
            if n is None:
                fresh.append(w)
            else:
                self.new[w] = n
        fresh.sort()
        path, score, count = "", [0.0], [0]
        pieces, longest, unknown = self.pieces, self.longest, self.unknown
        for w in fresh:
            marked = START + w
            # the nodes that the last word's path shares with this one stay as they are
            n, most = 0, min(len(path), len(marked))
            while n < most and path[n] == marked[n]:
                n += 1
            del score[n + 1 :], count[n + 1 :]
            for j in range(n + 1, len(marked) + 1):
                best, fewest = score[j - 1] + unknown, count[j - 1] + len(marked[j - 1].encode())
                for i in range(max(0, j - longest), j):
                    s = pieces.get(marked[i:j])
                    if s is not None:
                        s += score[i]
                        c = count[i] + 1
                        if s > best or (s == best and c < fewest):
                            best, fewest = s, c
                score.append(best)
                count.append(fewest)
            path = marked
            self.new[w] = count[-1]

    def counts(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """Words and tokens of each text."""
        words = [(t or "").split() for t in texts]
        distinct = {w for ws in words for w in ws}
        if len(self.new) > TABLE_ENTRIES:
            self.old, self.new = self.new, {}
        distinct -= self.new.keys()
        self.learn(distinct)
        known = self.new.__getitem__
        return [len(ws) for ws in words], [sum(map(known, ws)) for ws in words]


def count_tokens(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, ``n_words`` and ``n_tokens`` of every row."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(read_pieces(path))
    rows = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in tk.groups(batches, "_text"):
            counter = counter or Counter(sent.value)
            n_words, n_tokens = counter.counts(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], [*keep, "n_words", "n_tokens"])

    return rows.mapInArrow(run, rows.drop("_text").schema.add("n_words", "long").add("n_tokens", "long"))
