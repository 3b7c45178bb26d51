"""Odd documents that every operator must take, and plain versions of shared rules."""

from __future__ import annotations

import re

ASCII_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _doc string, _text string, _row string, score string, n int"

PASSAGE = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def odd_rows() -> list[tuple]:
    texts = [
        (1, "plain words of a short text that nobody else has written"), (2, None), (3, ""), (4, " \t\n\x0b\f\r "), (None, "no id here " + PASSAGE),
        (5, PASSAGE), (5, PASSAGE), (5, "another text of the same id " + PASSAGE), (6, LONG), (7, "a " * 5000), (8, "ünïcödé ß 中文 😀 " * 5),
        (9, PASSAGE.upper()), (10, PASSAGE + " tail"), (11, "x" * 70_000), (12, "<|endoftext|> +1 (555) 010-9999 a@b.co 1.2.3.4 or 4111 1111 1111 1111"),
    ]
    return [(i, t, None if k % 3 else "en", None if k % 4 else "src", None if k % 5 else 7, "d", "t", "r", "s", k) for k, (i, t) in enumerate(texts)]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, doc string")


def items(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string, terms string")


def blank_words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
