"""Document quality by co-training: what a text holds and what its page says of it teach each other.

One view is worked out from the text (shares of signs, repetition, word lengths), the other from metadata
(source, language, stated length). Each view has an additive logistic classifier over binned features. Both
start from labelled documents; over ROUNDS each marks the unlabelled documents that it is surest of, a share that
grows by SHARE each round, and the other learns them too. A labelled fold that no round has used calibrates the two views and their
combination, which then scores every document.

At most LABELLED labelled documents, by a hash of their features, come to the driver. Bin edges, marks and what a view
learns from them cover all documents: tasks add up histograms and the sums of a Newton step, whose sizes are fixed.
Together the marked documents weigh no more than the labelled ones, at every size of the corpus.

Meaning of odd input: a null text is empty; null metadata is a value of its own; null labels are left out, of
several labels of one id the lowest counts; without labels of both kinds every score is the share of good labels
(0.5 without any); ids may be null or repeated, every row is scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.llm import tokens as tk
from transitloom.llm.graph import stored
from transitloom.llm.rows import small_batches

#: Labelled documents that the fit takes at most.
LABELLED = 6000
#: Rounds and Newton steps in each, the share of the unlabelled documents that a round adds, and the least chance of a mark.
ROUNDS, STEPS, SHARE, SURE = 5, 2, 0.05, 0.95
#: Histogram bins per unit of a logit.
FINE = 50
BINS, BUCKETS = 10, 32

TEXT = ("words", "word_length", "longest", "symbols", "capitals", "digits", "marks", "beyond_ascii", "distinct_words", "distinct_pairs", "lines", "distinct_lines")


def _classes() -> np.ndarray:
    """The kind of each byte: 0 letters, 1 symbols, 2 capitals, 3 digits, 4 marks, 5 beyond ASCII, 6 blanks."""
    kind = np.full(256, 1)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 0, 2, 3, 5
    kind[[ord(c) for c in ".,;:!?'\"()-"]] = 4
    kind[list(tk.BLANKS)] = 6
    return kind


_KIND = _classes()
_LINES = tk.Words((0x0A,))


def text_features(batch: pa.RecordBatch, text: str = "_text") -> np.ndarray:
    """One row of TEXT per document of a batch."""
    data, starts, ends, h, first = tk.words_of(batch, text, tk.PLAIN)
    _, offsets = tk.texts(batch.column(text))
    n, words = batch.num_rows, np.diff(first)
    row_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(row_of_byte * 7 + _KIND[data], minlength=7 * n).reshape(n, 7)
    row = np.repeat(np.arange(n), words)
    length = ends - starts
    longest = np.zeros(n)
    np.maximum.at(longest, row, length)
    inside = np.maximum(kinds[:, :6].sum(axis=1), 1)
    pair = np.zeros_like(h)
    pair[1:] = h[:-1]

    def distinct(x: np.ndarray, of: np.ndarray, total: np.ndarray) -> np.ndarray:
        _, one = np.unique(tk.mix(x + of.astype(tk.U) * tk.U(0x9E3779B97F4A7C15)), return_index=True)
        return np.bincount(of[one], minlength=n) / np.maximum(total, 1)

    line_start, line_end = _LINES.spans(data, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
    line_hash = _LINES.hashes(data, line_start, line_end)
    line_first = np.searchsorted(line_start, offsets)
    lines = np.diff(line_first)
    return np.stack([
        np.log1p(words), inside / np.maximum(words, 1), np.log1p(longest), *(kinds[:, k] / inside for k in (1, 2, 3, 4, 5)),
        distinct(h, row, words), distinct(tk.mix(pair) + h, row, words), np.log1p(lines) - np.log1p(words),
        distinct(line_hash, np.repeat(np.arange(n), lines), lines),
    ], axis=1)


def features(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
             meta: tuple[str, ...] = ("source", "lang"), size: str = "n_chars") -> DataFrame:
    """The kept columns, ``content`` (text view) and ``page`` (metadata view: hashed values, stated length)."""
    small_batches(docs.sparkSession)
    bucket = lambda c: F.when(F.col(c).isNull(), BUCKETS).otherwise(F.pmod(F.xxhash64(c), F.lit(BUCKETS)))
    page = F.array(*(bucket(c).cast("double") for c in meta), F.log1p(F.greatest(F.coalesce(F.col(size).cast("double"), F.lit(0.0)), F.lit(0.0))))
    rows = docs.select(*keep, page.alias("page"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.groups(batches, "_text"):
            x = text_features(batch)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * x.shape[1])
            content = pa.ListArray.from_arrays(ends, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], content], [*keep, "page", "content"])

    return rows.mapInArrow(run, _schema(rows))


def _schema(rows: DataFrame):
    from pyspark.sql import types as T

    return rows.drop("_text").schema.add("content", T.ArrayType(T.DoubleType()))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, turns: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = _chance(x @ w)
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class View:
    """An additive classifier: one weight per bin of each number and per value of each category."""

    edges: list[np.ndarray]  # per feature: where its bins end; empty for a category
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def design(self, x: np.ndarray) -> np.ndarray:
        parts = [np.ones((len(x), 1))]
        for i, edges in enumerate(self.edges):
            width = len(edges) + 1 if len(edges) else BUCKETS + 1
            at = np.searchsorted(edges, x[:, i], "right") if len(edges) else np.clip(x[:, i], 0, BUCKETS).astype(int)
            part = np.zeros((len(x), width))
            part[np.arange(len(x)), at] = 1
            parts.append(part)
        return np.concatenate(parts, axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights


@dataclass
class Model:
    content: View | None = None
    page: View | None = None
    #: slope and offset of each view alone, and offset and slopes of both together
    alone: list[np.ndarray] = field(default_factory=list)
    both: np.ndarray = field(default_factory=lambda: np.zeros(3))
    prior: float = 0.5

    def scores(self, content: np.ndarray, page: np.ndarray) -> np.ndarray:
        """Columns: text view, metadata view, both."""
        if self.content is None:
            return np.full((len(content), 3), self.prior)
        z = np.stack([np.ones(len(content)), self.content.logit(content), self.page.logit(page)], axis=1)
        return np.stack([_chance(z[:, [0, 1]] @ self.alone[0]), _chance(z[:, [0, 2]] @ self.alone[1]), _chance(z @ self.both)], axis=1)


def _views(rows: DataFrame, width: int, categories: int) -> list[View]:
    """Both views, without weights: bin edges are quantiles over all rows."""
    cuts = [float(c) for c in np.linspace(0, 1, BINS + 1)[1:-1]]
    at = [("content", i) for i in range(width)] + [("page", categories)]
    got = rows.agg(*(F.percentile_approx(F.get(c, F.lit(i)), cuts, 1000).alias(f"q{k}") for k, (c, i) in enumerate(at))).first()
    edges = [np.unique(np.array(q, dtype=float)) for q in got]
    return [View(edges[:-1]), View([np.zeros(0)] * categories + edges[-1:])]


def _added_up(rows: DataFrame, one: Callable[[np.ndarray, np.ndarray], dict[int, np.ndarray]]) -> dict[int, dict[int, float]]:
    """Per view the sums over all rows of what ``one`` makes of a batch's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                content, page = (np.stack(batch.column(c).to_numpy(zero_copy_only=False)).astype(float) for c in ("content", "page"))
                for v, x in one(content, page).items():
                    total[v] = total[v] + x if v in total else x
        for v, x in total.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), v, np.int32)), pa.array(at.astype(np.int32)), pa.array(x[at])], ["view", "at", "value"])

    got = rows.select("content", "page").mapInArrow(run, "view int, at int, value double").groupBy("view", "at").agg(F.sum("value").alias("value"))
    out: dict[int, dict[int, float]] = {0: {}, 1: {}}
    for r in got.collect():
        out[r["view"]][r["at"]] = r["value"]
    return out


def _bin(z: np.ndarray) -> np.ndarray:
    return np.floor((np.clip(z, -30, 30) + 30) * FINE).astype(int)


def _surest(found: dict[int, float], most: dict[int, float]) -> tuple[int, int, float]:
    """The highest bin marked bad, the lowest marked good, and how many rows both hold; equal rows go together."""
    sure = np.log(SURE / (1 - SURE))
    low, high, n = -1, 60 * FINE + 1, 0.0
    for good in (1, 0):
        taken = 0.0
        for at in sorted(found, reverse=bool(good)):
            if taken >= most[good] or (at < _bin(sure) if good else at > _bin(-sure)):
                break
            low, high = (low, at) if good else (at, high)
            taken += found[at]
        n += taken
    return low, high, n


def co_train(content: np.ndarray, page: np.ndarray, y: np.ndarray, rows: DataFrame, pool: DataFrame) -> Model:
    """Labelled features and labels; the features of all rows, and those of the unlabelled ones."""
    model = Model(prior=float(y.mean()) if len(y) else 0.5)
    fold = np.array([zlib.crc32(c.tobytes() + p.tobytes()) % 4 == 0 for c, p in zip(content, page)], dtype=bool)
    if not all(len(np.unique(y[f])) == 2 for f in (fold, ~fold)):
        return model
    views = _views(rows, content.shape[1], page.shape[1] - 1)
    known = [views[0].design(content[~fold]), views[1].design(page[~fold])]
    target = y[~fold]
    for view, x in zip(views, known):
        view.weights = np.round(_logistic(x, target), 6)
    for turn in range(1, ROUNDS + 1):
        teachers = [View(v.edges, v.weights) for v in views]
        seen = _added_up(pool, lambda c, p: {
            v: np.bincount(_bin(teachers[v].logit(x)), minlength=60 * FINE + 1).astype(float) for v, x in ((0, c), (1, p))})
        total = sum(seen[0].values())
        # of each kind the surest, in the proportion of the labels
        share = {1: total * SHARE * turn * model.prior, 0: total * SHARE * turn * (1 - model.prior)}
        cuts = [_surest(seen[v], share) for v in (0, 1)]
        for _ in range(STEPS):
            now = [View(v.edges, v.weights) for v in views]

            def sums(c: np.ndarray, p: np.ndarray) -> dict[int, np.ndarray]:
                out = {}
                for v, x, other in ((0, c, p), (1, p, c)):
                    low, high, _ = cuts[1 - v]
                    at = _bin(teachers[1 - v].logit(other))
                    marked = (at <= low) | (at >= high)
                    d = now[v].design(x[marked])
                    chance = _chance(d @ now[v].weights)
                    h = (d * (chance * (1 - chance))[:, None]).T @ d
                    out[v] = np.concatenate([h.ravel(), d.T @ ((at[marked] >= high) - chance)])
                return out

            learnt = _added_up(pool, sums) if cuts[0][2] or cuts[1][2] else {0: {}, 1: {}}
            for v in (0, 1):
                w, x, k = views[v].weights, known[v], len(views[v].weights)
                extra = np.zeros(k * k + k)
                extra[list(learnt[v])] = list(learnt[v].values())
                extra *= min(1.0, len(target) / max(cuts[1 - v][2], 1.0))
                chance = _chance(x @ w)
                h = (x * (chance * (1 - chance) + 1e-6)[:, None]).T @ x + extra[: k * k].reshape(k, k) + np.eye(k)
                # rounded, so that the order of the sums does not show
                views[v].weights = np.round(w + np.linalg.solve(h, x.T @ (target - chance) + extra[k * k :] - w), 6)
    z = np.stack([np.ones(fold.sum()), views[0].logit(content[fold]), views[1].logit(page[fold])], axis=1)
    model.content, model.page = views
    model.alone = [_logistic(z[:, [0, 1]], y[fold], 0.1), _logistic(z[:, [0, 2]], y[fold], 0.1)]
    model.both = _logistic(z, y[fold], 0.1)
    return model


def train(found: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", label: str = "quality",
          labelled: int = LABELLED) -> Model:
    """Fit on a bounded sample of the labelled rows of ``features`` and all unlabelled ones, none of them held out."""
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).alias("_y"))
    rows = found.filter(~held_out).join(known, F.col(doc_id) == F.col("_id"), "left")
    rows = stored(rows.select("content", "page", "_y"), "training")
    order = F.xxhash64(F.lit(7), "content", "page")
    got = rows.filter("_y is not null").select("content", "page", "_y", order.alias("o")).distinct().orderBy("o", "_y").limit(labelled).collect()
    if not got:
        return Model()
    content, page = (np.array([r[c] for r in got], dtype=float) for c in ("content", "page"))
    return co_train(content, page, np.array([float(r["_y"] > 0) for r in got]), rows, rows.filter("_y is null"))


def score(found: DataFrame, model: Model) -> DataFrame:
    """The rows of ``features`` without them, with ``content_score``, ``page_score`` and ``score``, all from 0 to 1."""
    sent = found.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in found.columns if c not in ("content", "page")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                content, page = (np.stack(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("content", "page"))
                out = sent.value.scores(content.astype(float), page.astype(float))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), *(pa.array(out[:, i]) for i in range(3))], [*keep, "content_score", "page_score", "score"])

    schema = found.select(*keep).schema.add("content_score", "double").add("page_score", "double").add("score", "double")
    return found.select(*keep, "content", "page").mapInArrow(run, schema)
