"""Rule statistics of texts, and cutoffs whose false rejections are limited by exact binomial bounds.

Everything is a built-in expression: no Python runs on the executors.

Each rule rejects a document whose measure reaches a cutoff. For every stratum (length class) and rule the
cutoffs are tried from lenient to strict on labelled good documents. A cutoff passes if so few of them would
be rejected that a false-rejection rate of RISK / number of rules or more is refuted by the exact binomial test
at level CHANCE / (strata * rules). The strictest cutoff before the first failure is taken: testing in that fixed
order needs no further correction, and the other two factors (Bonferroni) make up for the many tests. So with
probability 1 - CHANCE no stratum loses more than RISK of its good documents.

Meaning of odd input: a null text is empty; an empty text has no words and fails the base rules; null labels are
left out, copies of a labelled text count once, of several labels of one id the lowest counts; a stratum without
enough labels has no cutoffs and rejects by the base rules only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: White space between words (fixed value).
BLANKS = " \t\n\x0b\f\r"
#: Signs counted as symbols (fixed value).
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words in a window, for repeated words.
WINDOW = 5
#: The share of good documents that may be rejected in a stratum, and the chance that more are.
RISK, CHANCE = 0.02, 0.05
#: Strata by number of words: below each bound, and the rest.
LENGTHS = (50, 500)

#: Measures that grow with the fault, and the cutoffs tried, lenient first.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_share": tuple(x / 100 for x in range(60, 1, -2)),
    "dup_line_share": tuple(x / 100 for x in range(95, 4, -5)),
    "repeat_share": tuple(x / 100 for x in range(19, 0, -1)),
    "capital_share": tuple(x / 100 for x in range(90, 9, -5)),
    "long_words": tuple(float(x) for x in range(40, 9, -2)),
}


def _removed(text: Column, signs: str) -> Column:
    return F.char_length(F.translate(text, signs, ""))


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, _same, n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words) per row."""
    body = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    trimmed = F.btrim("_text", F.lit(BLANKS))
    cut = body.select(
        doc_id, F.xxhash64("_text").alias("_same"),
        F.char_length("_text").alias("_chars"), _removed(F.col("_text"), BLANKS).alias("word_chars"),
        _removed(F.col("_text"), SYMBOLS).alias("_no_symbols"), _removed(F.col("_text"), CAPITALS).alias("_no_capitals"),
        F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("_lines"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t\n\x0B\f\r]+")).alias("_words"),
    )
    word = F.col("_words")
    window = F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*(F.get(word, i + k) for k in range(WINDOW))))
    wide = cut.select(
        doc_id, "_same", F.size("_words").cast("long").alias("n_words"), "word_chars",
        (F.col("_chars") - F.col("_no_symbols")).alias("n_symbols"), (F.col("_chars") - F.col("_no_capitals")).alias("n_capitals"),
        F.size("_lines").alias("n_lines"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.when(F.size("_words") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    # most texts repeat no window; only the others are sorted by window
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    wide = wide.withColumn("_placed", F.when(again, placed))
    at = F.col("_placed")
    twin = F.filter(
        F.sequence(F.lit(0), F.size("_placed") - 1),
        lambda k: F.coalesce(F.get(at, k)["h"] == F.get(at, k + 1)["h"], F.lit(False))
        | F.coalesce(F.get(at, k)["h"] == F.get(at, k - 1)["h"], F.lit(False)),
    )
    wide = wide.withColumn("_twins", F.when(F.col("_placed").isNotNull(), twin))
    wide = wide.withColumn("_starts", F.sort_array(F.transform("_twins", lambda k: F.get(at, k)["i"])))
    start = F.col("_starts")
    reach = F.aggregate(
        F.sequence(F.lit(1), F.size("_starts") - 1), F.lit(WINDOW).cast("long"),
        lambda total, k: total + F.least(F.lit(WINDOW), F.get(start, k) - F.get(start, k - 1)),
    )
    repeated = F.when(F.size("_starts") > 1, reach).otherwise(F.lit(0).cast("long"))
    longs = [F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines")]
    return wide.select(doc_id, "_same", "n_words", *longs, F.coalesce(repeated, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    """Too few words, or more than a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def stratum() -> Column:
    out = F.when(F.col("n_words") < LENGTHS[0], F.lit(0))
    for i, bound in enumerate(LENGTHS[1:], 1):
        out = out.when(F.col("n_words") < bound, F.lit(i))
    return out.otherwise(F.lit(len(LENGTHS)))


def measures() -> dict[str, Column]:
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    return {
        "symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "capital_share": share("n_capitals", "word_chars"),
        "long_words": share("word_chars", "n_words"),
    }


def _at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial variable: exact, summed from logarithms of its terms."""
    odds = math.log(p / (1 - p))
    zero = F.struct((n * math.log1p(-p)).alias("log"), F.exp(n * math.log1p(-p)).alias("sum"))

    def add(so_far: Column, i: Column) -> Column:
        log = so_far["log"] + F.log((n - i + 1) / i) + odds
        return F.struct(log.alias("log"), (so_far["sum"] + F.exp(log)).alias("sum"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, zero, add, lambda x: x["sum"])


def cutoffs(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality",
            risk: float = RISK, chance: float = CHANCE) -> DataFrame:
    """(stratum, rule, n, wrong, bound, cutoff): the strictest safe cutoff of each rule, where there is one."""
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).alias("_y")).filter("_y = 1")
    good = stats.join(known, F.col(doc_id) == F.col("_id")).filter(~base_failed()).dropDuplicates(["_same"])
    measure = measures()
    counts = good.groupBy(stratum().alias("stratum")).agg(
        F.count("*").alias("n"),
        *(F.sum((measure[r] >= c).cast("long")).alias(f"{r}_{i}") for r, grid in RULES.items() for i, c in enumerate(grid)),
    )
    each = F.array(*(
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), F.col(f"{r}_{i}").alias("wrong"))
        for r, grid in RULES.items() for i, c in enumerate(grid)
    ))
    tried = counts.select("stratum", "n", F.explode(each).alias("t")).select("stratum", "n", "t.*")
    level = chance / (len(RULES) * (len(LENGTHS) + 1))
    p = risk / len(RULES)
    bound = F.when(F.col("wrong") < F.col("n") * p, _at_most(F.col("wrong"), F.col("n"), p)).otherwise(F.lit(1.0))
    in_order = Window.partitionBy("stratum", "rule").orderBy("step")
    safe = tried.withColumn("bound", bound).withColumn("safe", F.min(F.col("bound") <= level).over(in_order)).filter("safe")
    strictest = F.row_number().over(Window.partitionBy("stratum", "rule").orderBy(F.col("step").desc()))
    return safe.withColumn("place", strictest).filter("place = 1").select("stratum", "rule", "n", "wrong", "bound", "cutoff")


def verdicts(stats: DataFrame, chosen: DataFrame) -> DataFrame:
    """The statistics with base_failed, broken (the rules a document breaks) and kept.

    The cutoffs are one row per stratum, and there are len(LENGTHS) + 1 strata: that is all that is broadcast.
    """
    per = chosen.groupBy("stratum").pivot("rule", list(RULES)).agg(F.min("cutoff")).withColumnRenamed("stratum", "_stratum")
    per = per.select("_stratum", *(F.col(r).alias(f"_{r}") for r in RULES))
    joined = stats.withColumn("stratum", stratum()).join(F.broadcast(per), F.col("stratum") == F.col("_stratum"), "left")
    broken = F.filter(F.array(*(F.when(m >= F.col(f"_{r}"), F.lit(r)) for r, m in measures().items())), lambda x: x.isNotNull())
    return joined.withColumn("base_failed", base_failed()).withColumn("broken", broken).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0)).drop("_stratum", *(f"_{r}" for r in RULES))
