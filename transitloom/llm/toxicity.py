"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels mark documents, so token labels come first: a word or a prefix is a seed if it stands in many distinct
contexts of toxic documents and in next to none of clean ones, beyond what chance explains after correction for
the number of candidates. Words of toxic documents that hold a seed are labelled toxic, all other words clean.
The field has two states; a word's own form, its prefixes and endings and the forms beside it weigh in, and the
state before it. Forward-backward marginals give the spans; sums of them per document, calibrated against the
document labels, give the score.

The field is fitted by a task on a bounded sample of labelled documents: ``per_class`` of each label by a hash of the id,
of which those up to LONGEST bytes are taken until they hold SAMPLE_BYTES of a label. Only the weights reach the
driver. Every document is scored whole, by tasks that hold the weights only.

Meaning of odd input: null or blank text has no words and gets the score of a document without marginals; null
labels are left out; of several labels of one id the highest counts; without labels of both kinds every score is
the share of toxic labels (0.5 without any); other columns pass through if asked for.
"""

from __future__ import annotations

import math
import pickle
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom.llm import tokens as tk
from transitloom.llm.rows import small_batches

#: Documents of each label that the fit takes: toxic, clean.
PER_CLASS = (800, 1600)
#: Bytes of text of one label that the fit takes, and of one document.
SAMPLE_BYTES, LONGEST = 8 << 20, 1 << 17
#: Contexts in toxic documents that a seed needs, and its highest chance of being one by accident.
SEED_CONTEXTS, SEED_CHANCE = 5, 1e-3
EPOCHS = 40
#: Occurrences in the sample that a feature needs: of the word itself, and of a form beside it.
RARE, BESIDE = 3, 10
#: Distinct word forms that a task remembers.
TABLE_ENTRIES = 200_000
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def form(word: str) -> str:
    """A word in lower case without the signs around it."""
    return _EDGE.sub("", word).lower()


def features(word: str) -> list[str]:
    """What the field knows of a word by itself."""
    w = form(word)
    if not w:
        return ["-"]
    out = [f"w{w}", f"z{w[-3:]}", f"n{min(len(w), 12)}"]
    out += [f"{k}{w[:k]}" for k in (3, 4, 5) if len(w) >= k]
    if word[:1].isupper():
        out.append("A")
    return out


def _ends(word: str) -> bool:
    return word[-1:] in ".!?"


@dataclass
class Model:
    """Weights by feature (own, left neighbour, right neighbour), transitions and the calibration."""

    own: dict[str, float] = field(default_factory=dict)
    left: dict[str, float] = field(default_factory=dict)
    right: dict[str, float] = field(default_factory=dict)
    start: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    calibration: np.ndarray = field(default_factory=lambda: np.zeros(5))
    prior: float = 0.5


class Field:
    """The chain over sentences, all positions of equal rank worked out together."""

    def __init__(self, ends: np.ndarray) -> None:
        """ends: whether a sentence ends with each token."""
        n = len(ends)
        starts = np.flatnonzero(np.concatenate([[True], ends[:-1]])) if n else np.zeros(0, np.int64)
        length = np.diff(np.append(starts, n))
        order = np.argsort(-length, kind="stable")
        self.starts, self.length, self.n = starts[order], length[order], n
        self.active = np.searchsorted(-self.length, -np.arange(1, (self.length[0] if n else 0) + 1), "right")
        self.first = np.zeros(n, dtype=bool)
        self.first[starts] = True

    def marginals(self, e: np.ndarray, start: float, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals, and the forward and backward ratios of the two states."""
        E, M = np.exp(np.clip(e, -20, 20), dtype=np.float32), np.exp(moves).astype(np.float32)
        r, q = np.empty(self.n, np.float32), np.empty(self.n, np.float32)
        for t, k in enumerate(self.active):
            at = self.starts[:k] + t
            if t == 0:
                r[at] = math.exp(start) * E[at]
            else:
                p = r[at - 1]
                r[at] = np.minimum(E[at] * (M[0, 1] + p * M[1, 1]) / (M[0, 0] + p * M[1, 0]), np.float32(1e15))
        if self.n:
            q[self.starts + self.length - 1] = 1.0
        for t in range(len(self.active) - 1, 0, -1):
            at = self.starts[: self.active[t]] + t
            x = E[at] * q[at]
            q[at - 1] = (M[1, 0] + M[1, 1] * x) / (M[0, 0] + M[0, 1] * x)
        odds = r * q
        return odds / (1 + odds), r, q

    def steps(self, e: np.ndarray, moves: np.ndarray, r: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Expected transitions."""
        M, at = np.exp(moves), np.flatnonzero(~self.first)
        x = np.exp(np.clip(e[at], -20, 20), dtype=np.float32) * q[at]
        p = r[at - 1]
        w = [np.full(len(at), M[0, 0], dtype=np.float32), M[0, 1].astype(np.float32) * x, p * M[1, 0].astype(np.float32), M[1, 1].astype(np.float32) * p * x]
        whole = w[0] + w[1] + w[2] + w[3]
        return np.array([(part / whole).sum(dtype=float) for part in w]).reshape(2, 2)


def _summary(m: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document: what the calibration takes from the marginals."""
    none = np.bincount(doc, np.log1p(-np.minimum(m, 1 - 1e-9)), n_docs)  # log of the chance of no toxic word
    any_ = -np.expm1(none)
    top = np.zeros(n_docs)
    np.maximum.at(top, doc, m)
    mean = np.bincount(doc, m, n_docs)
    n = np.bincount(doc, minlength=n_docs)
    return np.stack([np.ones(n_docs), any_, top, np.log1p(mean), mean / np.maximum(n, 1)], axis=1)


def _seeds(forms: np.ndarray, doc: np.ndarray, words: list[str], toxic: np.ndarray) -> np.ndarray:
    """Which distinct words hold a form or prefix whose contexts lie in toxic documents only.

    Contexts (the forms on both sides) are counted once, so copies of a document say no more than one of them.
    """
    names: dict[str, int] = {}
    feature, begin = array("q"), array("q", [0])
    for w in words:
        if w:
            feature.extend(names.setdefault(f, len(names)) for f in (f"w{w}", *(f"{k}{w[:k]}" for k in (4, 5) if len(w) >= k)))
        begin.append(len(feature))
    feature, begin = np.array(feature), np.array(begin)
    edge = np.concatenate([[True], np.diff(doc) != 0, [True]])
    before = np.where(edge[:-1], -1, np.concatenate([[-1], forms[:-1]]))
    after = np.where(edge[1:], -1, np.concatenate([forms[1:], [-1]]))
    context = tk.mix(tk.mix(before.astype(tk.U)) + after.astype(tk.U) * tk.U(0x9E3779B97F4A7C15) + forms.astype(tk.U))

    def counts(at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        size = np.diff(begin)[forms[at]]
        where = np.repeat(begin[forms[at]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        f, c = feature[where], np.repeat(context[at], size)
        f, c = f[wanted[f]], c[wanted[f]]
        _, one = np.unique(tk.mix(c + f.astype(tk.U) * tk.U(0x9E3779B97F4A7C15)), return_index=True)
        return np.bincount(f[one], minlength=len(names))

    in_bad = toxic[doc] > 0
    share = min(max(in_bad.mean(), 1e-6), 0.9)
    every = np.ones(len(names), dtype=bool)
    bad = counts(np.flatnonzero(in_bad), every)
    limit = max(SEED_CONTEXTS, math.log(SEED_CHANCE / max(1, (bad > 0).sum())) / math.log(share))
    seeds = bad >= limit
    seeds &= counts(np.flatnonzero(~in_bad), seeds) * 50 <= bad
    held = np.concatenate([[0], np.cumsum(seeds[feature])])
    return held[begin[1:]] > held[begin[:-1]]


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """The field and the calibration from whole labelled documents."""
    toxic = np.asarray(toxic, dtype=float)
    model = Model(prior=float(toxic.mean()) if len(toxic) else 0.5)
    model.calibration[0] = math.log(max(model.prior, 1e-3) / max(1 - model.prior, 1e-3))
    if not 0 < model.prior < 1:
        return model
    table: dict[str, int] = {}
    ids, length = array("i"), []
    for text in texts:
        words = (text or "").split()
        ids.extend(table.setdefault(w, len(table)) for w in words)
        length.append(len(words))
    ids = np.array(ids, dtype=np.int32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), length)
    forms: dict[str, int] = {}
    form_of = np.array([forms.setdefault(form(w), len(forms)) for w in table], dtype=np.int32)
    seeded = _seeds(form_of[ids], doc, list(forms), toxic) if len(ids) else np.zeros(0, bool)
    if not seeded.any():
        return model
    y = seeded[form_of[ids]] & (toxic[doc] > 0)
    breaks = np.array([_ends(w) for w in table])[ids]
    breaks[np.flatnonzero(np.diff(doc))] = True
    chain = Field(breaks)

    names: dict[str, int] = {}
    word_of, feature_of = array("i"), array("i")
    for i, w in enumerate(table):
        for f in features(w):
            word_of.append(i)
            feature_of.append(names.setdefault(f, len(names)))
    word_of, feature_of = np.array(word_of), np.array(feature_of)
    # what stands a few times only says nothing of other documents
    seen_word = np.bincount(ids, minlength=len(table))
    often = np.bincount(feature_of, seen_word[word_of], len(names)) >= RARE
    word_of, feature_of = word_of[often[feature_of]], (np.cumsum(often) - 1)[feature_of[often[feature_of]]]
    names = [f for f, some in zip(names, often) if some]
    common = np.bincount(form_of, seen_word, len(forms)) >= BESIDE
    beside = np.where(common, np.cumsum(common) - 1, -1)[form_of]
    forms = [f for f, some in zip(forms, common) if some]
    before = np.concatenate([[-1], beside[ids[:-1]]])
    before[chain.first] = -1
    after = np.concatenate([beside[ids[1:]], [-1]])
    after[breaks] = -1
    has_l, has_r = (np.flatnonzero(x >= 0).astype(np.int32) for x in (before, after))
    left_of, right_of = before[has_l], after[has_r]
    del before, after

    sizes = [len(names), len(forms), len(forms), 1, 4]
    cut = np.cumsum(sizes)[:-1]
    w = np.zeros(sum(sizes))
    w[cut[2]] = -3.0
    at = np.flatnonzero(~chain.first)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    first_y = float(y[chain.first].sum())
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for epoch in range(1, EPOCHS + 1):
        own, left, right, start, moves = np.split(w, cut)
        by_word = np.bincount(word_of, own[feature_of], len(table)).astype(np.float32)
        e = by_word[ids]
        e[has_l] += left[left_of]
        e[has_r] += right[right_of]
        m, r, q = chain.marginals(e, float(start[0]), moves.reshape(2, 2))
        miss = y - m
        by_word = np.bincount(ids, miss, len(table))
        g = np.concatenate([
            np.bincount(feature_of, by_word[word_of], len(names)), np.bincount(left_of, miss[has_l], len(forms)),
            np.bincount(right_of, miss[has_r], len(forms)), [first_y - m[chain.first].sum()],
            (seen - chain.steps(e, moves.reshape(2, 2), r, q)).ravel(),
        ]) - 0.1 * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        w += 0.3 * (m1 / (1 - 0.9**epoch)) / (np.sqrt(m2 / (1 - 0.99**epoch)) + 1e-6) / math.sqrt(epoch / 4 + 1)
    own, left, right, start, moves = np.split(w, cut)
    keep = lambda names, values, least: {n: float(v) for n, v in zip(names, values) if abs(v) > least}
    model.own, model.left, model.right = keep(names, own, 5e-3), keep(forms, left, 5e-3), keep(forms, right, 5e-3)
    model.start, model.moves = float(start[0]), moves.reshape(2, 2)
    x = _summary(m, doc, len(texts))
    model.calibration = _logistic(x, toxic)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, turns: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


class Scorer:
    """A model with a table of the word forms met so far."""

    def __init__(self, model: Model) -> None:
        self.model, self.table = model, {}
        self.weights = np.zeros((1024, 4))

    def ids(self, words: list[str]) -> np.ndarray:
        table = self.table
        try:
            return np.array([table[w] for w in words], dtype=np.int64)
        except KeyError:
            return np.array([table[w] if w in table else self._new(w) for w in words], dtype=np.int64)

    def _new(self, word: str) -> int:
        i = self.table[word] = len(self.table)
        if i >= len(self.weights):
            self.weights = np.concatenate([self.weights, np.zeros_like(self.weights)])
        m, w = self.model, form(word)
        self.weights[i] = sum(m.own.get(f, 0.0) for f in features(word)), m.left.get(w, 0.0), m.right.get(w, 0.0), _ends(word)
        return i

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores of whole texts, and their toxic spans in code points."""
        if len(self.table) > TABLE_ENTRIES:
            self.table.clear()
        words = [(t or "").split() for t in texts]
        doc = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        ids = self.ids([w for ws in words for w in ws])
        own, left, right, ends = self.weights[ids].T if len(ids) else np.zeros((4, 0))
        breaks = ends > 0
        breaks[np.flatnonzero(np.diff(doc))] = True
        chain = Field(breaks)
        e = own.copy()
        inner = np.flatnonzero(~chain.first)
        e[inner] += left[inner - 1]
        e[inner - 1] += right[inner]
        m = chain.marginals(e, self.model.start, self.model.moves)[0]
        x = _summary(m, doc, len(texts))
        p = 1 / (1 + np.exp(-np.clip(x @ self.model.calibration, -30, 30)))
        spans: list[list[dict]] = [[] for _ in texts]
        bad = np.flatnonzero(m >= 0.5)
        first = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        for i in np.unique(doc[bad]).tolist():
            places = [f.span() for f in re.finditer(r"\S+", texts[i] or "")]
            for t in (bad[doc[bad] == i] - first[i]).tolist():
                a, b = places[t] if len(places) == len(words[i]) else (None, None)
                spans[i].append({"start": a, "end": b, "marginal": float(m[first[i] + t])})
        return p, spans


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: tuple[int, int] = PER_CLASS) -> Model:
    """Fit on at most per_class labelled documents of each kind outside the held-out fold."""
    known = labels.filter(F.col(label).isNotNull() & ~held_out(doc_id)).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_y"))
    order = F.xxhash64("_id")
    taken = [
        known.filter(F.col("_y") > 0 if bad else F.col("_y") <= 0).orderBy(order, "_id").limit(n) for bad, n in ((True, per_class[0]), (False, per_class[1]))
    ]
    # only ids, at most sum(per_class) of them, are broadcast; the texts stay with the tasks
    few = F.broadcast(taken[0].unionByName(taken[1]))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).filter(F.octet_length("_text").between(1, LONGEST))
    rows = rows.join(few, "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.first("_y").alias("_y"))
    so_far = F.sum(F.octet_length("_text")).over(Window.partitionBy(F.col("_y") > 0).orderBy(order, "_id"))
    sample = rows.withColumn("_bytes", so_far).filter(F.col("_bytes") <= SAMPLE_BYTES).select("_id", "_text", "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_text = {}
        for batch in batches:
            by_text.update(zip(batch.column("_text").to_pylist(), ((y or 0) > 0 for y in batch.column("_y").to_pylist())))
        model = fit(list(by_text), np.array(list(by_text.values()), dtype=float))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # one task: the sample is at most two times SAMPLE_BYTES
    found = sample.repartition(1).sortWithinPartitions("_id").mapInArrow(run, "model binary").first()
    return pickle.loads(found["model"]) if found else fit([], np.zeros(0))


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, ``score`` from 0 to 1 and ``spans`` (start, end, marginal)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in tk.groups(batches, "_text"):
            scorer = scorer or Scorer(sent.value)
            p, found = scorer.score(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p), pa.array(found, spans)], [*keep, "score", "spans"])

    span = T.StructType().add("start", "integer").add("end", "integer").add("marginal", "double")
    schema = rows.drop("_text").schema.add("score", "double").add("spans", T.ArrayType(span))
    return rows.mapInArrow(run, schema)
