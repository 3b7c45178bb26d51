"""The first label that each of many prompts matches, without trying every prompt on every label.

Patterns meet labels over an inverted index of three-character pieces. A pattern's literals, which every match must
hold, give its pieces; the rarest of them names the labels on which the pattern is tried. A piece that no label has
ends the search. Patterns without a literal of three characters are tried on all labels, in blocks.

Plain texts are looked for by an automaton: a block of prompts and a chunk of labels meet once, and one pass over
each label finds all prompts of the block in it, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prompts of a block that every label is tried on; prompts and labels that one automaton and one pass take.
SCANNED, AUTOMATON, CHUNK = 256, 8192, 4096
IGNORE_CASE = "(?iu)"  # accented letters too
#: Stands where a literal ends; a label that holds it is none the worse, since matches are tried in full.
_BREAK = "\u0001"
_PIECE = 3


def required_literals(pattern: Column) -> Column:
    """Texts that whatever a regular expression finds must hold; none where that takes more than a look at its signs.

    Groups, alternatives and codes of several characters are not looked into. A literal ends at a class, a wildcard, an
    escape or an anchor, and a character that is repeated is given up unless it must stand at least once.
    """
    plain = F.regexp_replace(pattern, r"\\[^A-Za-z0-9]|\\[dDsSwWbBhHvVtnrfae]", _BREAK)
    plain = F.regexp_replace(plain, r"\[\^?\]?[^\]\[\\&]*\]", _BREAK)
    open_ = plain.rlike(r"[(|)\[\\]")
    plain = F.regexp_replace(plain, r"(?s).(?:[*?]|\{[0-9,]*\})[?+]*", _BREAK)
    parts = F.split(F.regexp_replace(plain, r"[+.^$]", _BREAK), _BREAK)
    none = F.array().cast("array<string>")
    return F.when(open_ | F.contains(plain, F.lit("{")), none).otherwise(F.filter(parts, lambda p: p != ""))


def _folded(text: Column) -> Column:
    """What is left if letters that match each other become one and others beyond ASCII go.

    The four characters are those beyond ASCII that match an ASCII letter when case is ignored (fixed values).
    """
    ascii_ = F.translate(text, "İıſK", "iisk")
    return F.lower(F.regexp_replace(ascii_, r"[^\x00-\x7F]", ""))


def _pieces(text: Column) -> Column:
    n = F.char_length(text)
    places = F.when(n >= _PIECE, F.sequence(F.lit(1), n - (_PIECE - 1)))
    return F.coalesce(F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(_PIECE)))), F.array().cast("array<string>"))


def valid(pattern: Column) -> Column:
    """Whether a regular expression compiles where it will run."""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.concat(F.lit(IGNORE_CASE), pattern)).isNotNull()


def _found(label: Column, pattern: Column) -> Column:
    return F.regexp_like(label, F.concat(F.lit(IGNORE_CASE), pattern))


def first_by_pattern(labels: DataFrame, prompts: DataFrame) -> DataFrame:
    """(prompt, label): the smallest label in which each valid pattern is found, whatever the case; no row if in none."""
    labels = labels.select("label").filter(F.col("label").isNotNull()).distinct()
    asked = prompts.select("prompt").filter(F.col("prompt").isNotNull()).distinct()
    index = labels.select("label", F.explode(_pieces(_folded(F.col("label")))).alias("piece"))
    counts = index.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    literals = asked.select("prompt", required_literals(F.col("prompt")).alias("literals"))
    wanted = literals.select("prompt", F.explode_outer(
        F.flatten(F.transform("literals", lambda x: _pieces(_folded(x))))).alias("piece"))
    rarest = wanted.filter(F.col("piece").isNotNull()).join(counts, "piece", "left").groupBy("prompt").agg(
        F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), F.col("piece"))).alias("piece"))
    tried = rarest.join(index, "piece").select("prompt", "label").filter(_found(F.col("label"), F.col("prompt")))

    rest = wanted.filter(F.col("piece").isNull()).select("prompt")
    numbers, gathered = _gathered(rest, SCANNED)
    met = labels.withColumn("block", F.explode(numbers)).join(gathered, "block")
    scanned = met.select("label", F.explode(F.filter("prompts", lambda p: _found(F.col("label"), p))).alias("prompt"))
    return tried.unionByName(scanned).groupBy("prompt").agg(F.min("label").alias("label"))


def _gathered(prompts: DataFrame, size: int) -> tuple[Column, DataFrame]:
    """The numbers of the blocks of about so many prompts, and (block, prompts)."""
    blocks = F.greatest(prompts.agg(F.ceil(F.count(F.lit(1)) / size).cast("int")).scalar(), F.lit(1))
    dealt = prompts.withColumn("block", F.pmod(F.xxhash64("prompt"), blocks).cast("int"))
    return F.sequence(F.lit(0), blocks - 1), dealt.groupBy("block").agg(F.collect_list("prompt").alias("prompts"))


def first_by_text(labels: DataFrame, prompts: DataFrame) -> DataFrame:
    """(prompt, label): the smallest label that holds each prompt, both in lower case; no row if none does."""
    labels = labels.select("label").filter(F.col("label").isNotNull()).distinct()
    asked = prompts.select("prompt").filter(F.col("prompt").isNotNull()).distinct()
    chunks = F.greatest(labels.agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int")).scalar(), F.lit(1))
    chunked = labels.withColumn("chunk", F.pmod(F.xxhash64("label"), chunks)).groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("label", F.lower("label").alias("low")))).alias("labels"))
    numbers, gathered = _gathered(asked, AUTOMATON)
    gathered = gathered.withColumn("needles", F.transform("prompts", lambda p: F.lower(p)))
    met = chunked.withColumn("block", F.explode(numbers)).join(gathered, "block").select("labels", "prompts", "needles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, automaton = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                prompts_, needles = (batch.column(c)[k].as_py() for c in ("prompts", "needles"))
                if needles != last:
                    last, automaton = needles, _automaton(needles)
                first: dict[int, str] = {}
                for label in batch.column("labels")[k].as_py():  # smallest first
                    for which in _in(automaton, label["low"], needles):
                        first.setdefault(which, label["label"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([prompts_[i] for i in first], pa.string()), pa.array(list(first.values()), pa.string())], ["prompt", "label"])

    return met.mapInArrow(run, "prompt string, label string").groupBy("prompt").agg(F.min("label").alias("label"))


def _automaton(needles: list[str]) -> ahocorasick.Automaton:
    """All needles in one automaton; a needle's value is the list of its places."""
    places: dict[str, list[int]] = {}
    for i, needle in enumerate(needles):
        places.setdefault(needle, []).append(i)
    automaton = ahocorasick.Automaton()
    for needle, at in places.items():
        if needle:
            automaton.add_word(needle, at)
    automaton.make_automaton()
    return automaton


def _in(automaton: ahocorasick.Automaton, text: str, needles: list[str]) -> Iterator[int]:
    for i, needle in enumerate(needles if "" in needles else ()):
        if not needle:  # stands in every text
            yield i
    if len(automaton):
        for _, at in automaton.iter(text):
            yield from at
