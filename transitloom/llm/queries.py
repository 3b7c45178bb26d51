"""Queries of the corpus operators, and DuckDB text for those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.llm import (
    bpe, centroids, classifier, decontaminate, extract, ngramjoin, oracles, periodic, pii, quality, simhash, substring, tokencount,
    toxicity,
)
from transitloom.llm.graph import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = dict(oracles.BY_QUERY)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public tokenizer file lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def coded(docs: DataFrame) -> DataFrame:
    """Digests of the token ids of every document, and of the text that the ids decode to."""
    found = bpe.encode(docs, vocabulary(), decoded="decoded")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op1_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(quality.statistics(table(spark, sf_dir, "documents")), "statistics")
    judged = quality.verdicts(stats, quality.cutoffs(stats, table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken", ",").alias("broken"))


@query
def op2_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(pii.find(table(spark, sf_dir, "documents")), "candidates")
    spans = pii.choose(found, pii.fit(found))
    count = [pii.count("base", kind).alias(f"n_{kind}") for kind in pii.BASE]
    return spans.select("doc_id", *count, F.sha2(pii.as_text("base"), 256).alias("base_sha256"), pii.as_text("spans").alias("spans"))


@query
def op6_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(classifier.features(table(spark, sf_dir, "documents")), "features")
    held_out = toxicity.held_out()
    scored = classifier.score(found, classifier.train(found, table(spark, sf_dir, "labels"), held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "content_score", "page_score", "score", (F.col("score") >= 0.5).alias("kept"))


@query
def op11_simhash_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Where the words of a document with a planted repeat are read: its end goes on in the words of its first period."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else None
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(table(spark, sf_dir, "documents"), order=planted)
    best = F.col("strongest")
    line = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_centroid_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))
