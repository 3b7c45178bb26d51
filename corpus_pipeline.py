"""The corpus pipeline: toxic documents go, one of each group of near copies stays, benchmark passages go,
personal data is redacted, and what is left becomes tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the stage before it kept.
All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.llm import bpe, decontaminate, ngramjoin, pii, queries, toxicity
from transitloom.llm.graph import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5."""
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    columns = docs.columns
    body = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_body"))
    scored = toxicity.score(body, model, text="_body", keep=("_row",))
    return scored.filter("score < 0.5").select(*(F.col("_row")[c].alias(c) for c in columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: five-word n-grams, similarity of 0.8 or more."""
    return ngramjoin.first_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage that makes up a twentieth of them."""
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; texts are searched once, for the fit and the redaction."""
    found = stored(pii.searched(docs), "candidates")
    return pii.redact_found(found, pii.fit(found))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with hashes of the ids and of the text that they decode to."""
    return queries.coded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal),
    ("bpe", to_tokens),
]

#: SQL expresses neither the fitted models nor the tokenizer; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
