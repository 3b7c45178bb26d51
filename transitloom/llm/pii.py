"""Personal data: wide generators propose spans, boosted trees on format and context choose among them.

Everything that touches the texts is a built-in expression: patterns give matches and the gaps between them,
whose lengths add up to code-point offsets, and the fitted trees become arrays of numbers that an expression walks. Patterns use
possessive repeats and one fixed start per run, so no text makes them backtrack.

``base`` spans (email, ip, card, phone) pass strict checks and always stay. The generators are looser and
overlap; a candidate counts as true for the fit if a strict check of its kind confirms it. The trees see its
shape and surroundings, not the check, and a cutoff per kind is calibrated on candidates that the fit has
not seen: the lowest with at least PRECISION confirmed among those above. Candidates above it that meet no
base span are added, the leftmost of those that overlap; a secret of strict form may also cover base spans, since
digits inside a long key can look like a card.

Meaning of odd input: a null text is empty and has no spans; ids may be null or repeated, every row gets its own
answer; without confirmed and refuted candidates no span is added.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds in the order of their spans.
KINDS = ("email", "ip", "card", "phone", "secret")
#: Strict patterns (fixed values, with possessive repeats).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth trying.
HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), "phone": lambda t: t.rlike(r"\+[0-9]"),
}
#: Loose patterns: kind, hint, pattern.
WIDE = (
    ("email", r"(?i)[\[({]\s?at\s?[\])}]|@", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?(?:@|[\[({]\s?at\s?[\])}])\s?[A-Za-z0-9-]++(?:\s?(?:\.|[\[({]\s?dot\s?[\])}])\s?[A-Za-z0-9-]++)*+"),
    ("ip", r"[0-9]{1,4}[.:][0-9]", r"(?<![0-9])[0-9]{1,4}+(?:[.:][0-9]{1,4}+){3,7}+"),
    ("card", r"[0-9](?:[\x20._/-]{0,2}[0-9]){11}", r"[0-9](?:[\x20._/-]{0,2}+[0-9]){11,23}+"),
    ("phone", r"[0-9](?:[\x20()./-]{0,2}[0-9]){6}", r"(?:\+|(?<![0-9]))[0-9(](?:[\x20()./-]{0,2}+[0-9]){6,15}+"),
    ("secret", r"(?i)(?:key|token|secret|passw)", r"(?i)(?:key|token|secret|passw(?:or)?d)[\"']?\s{0,3}[:=]\s{0,3}[\"']?[^\s\"']{8,}+"),
)
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"
SECRET = r"[:=]\s{0,3}[\"']?(?:[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[A-Za-z0-9+/_-]{40,}={0,2})$"
#: Words beside a span that speak for a kind (fixed values).
CONTEXT = {
    "email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|pay|account|credit",
    "phone": "phone|tel|call|fax|mobile", "secret": "token|key|secret|passw",
}
#: Code points kept on either side of a span as its context.
BEFORE, AFTER = 24, 4
#: Candidates that the fit takes, at most, and what the calibration over all others asks for.
SAMPLE, PRECISION, SUPPORT = 20_000, 0.95, 20
TREES, DEPTH = 10, 3

_SPAN = "array<struct<kind:int,start:int,end:int>>"
_CANDIDATE = "array<struct<kind:int,start:int,end:int,good:boolean,x:array<double>>>"


def _found(text: Column, pattern: str, hint: Column) -> tuple[Column, Column]:
    """Matches of a pattern, and the gaps before, between and after them."""
    return (
        F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))),
        F.when(hint, F.split(text, pattern, -1)),
    )


def _placed(hits: Column, gaps: Column) -> Column:
    """The start of every match, in code points: gaps and matches before it, added up."""
    def step(so_far: Column, i: Column) -> Column:
        start = so_far["at"] + F.char_length(F.get(gaps, i))
        return F.struct((start + F.char_length(F.get(hits, i))).alias("at"), F.concat(so_far["out"], F.array(start)).alias("out"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.when(F.size(hits) > 0, F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), none, step, lambda x: x["out"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(backwards, i + 1, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), add) % 10 == 0


def _strict(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(OCTETS)
    if kind == "card":
        n = F.char_length(_digits(hit))
        return F.when(n.between(16, 19), _luhn(_digits(hit))).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(_digits(hit)).between(8, 15)
    return F.lit(True)


#: The features of a candidate, in order.
FEATURES = (
    "kind", "length", "digits", "digit_share", "letters", "separators", "dots", "dashes", "blanks", "plus", "leading_zero",
    "first_group", "last_group", "letter_before", "digit_before", "sign_before", "letter_after", "digit_after", "context", "any_context",
)


def _features(kind: int, hit: Column, before: Column, after: Column) -> Column:
    n = F.char_length(hit)
    count = lambda pattern: n - F.char_length(F.regexp_replace(hit, pattern, ""))
    digits = count("[0-9]")
    near = F.lower(before)
    x = [
        F.lit(kind), n, digits, digits / n, count("[A-Za-z]"), count("[^A-Za-z0-9]"), count(r"\."), count("-"), count(" "),
        hit.startswith("+").cast("int"), hit.rlike("^[+(]?0").cast("int"),
        F.char_length(F.regexp_extract(hit, "^[^0-9]*([0-9]*)", 1)), F.char_length(F.regexp_extract(hit, "([0-9]*)[^0-9]*$", 1)),
        before.rlike("[A-Za-z]$").cast("int"), before.rlike("[0-9]$").cast("int"), before.rlike(r"[^A-Za-z0-9\s]$").cast("int"),
        after.rlike("^[A-Za-z]").cast("int"), after.rlike("^[0-9]").cast("int"),
        near.rlike(CONTEXT[KINDS[kind]]).cast("int"), near.rlike("|".join(CONTEXT.values())).cast("int"),
    ]
    return F.array(*(c.cast("double") for c in x))


def _join_arrays(parts: list[Column], kind: str) -> Column:
    return F.concat(*(F.coalesce(p, F.array().cast(kind)) for p in parts))


def _span(i: int, kind: str, j: Column) -> tuple[Column, ...]:
    start = F.get(F.col(f"_s{i}"), j)
    return F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + F.char_length(F.get(F.col(f"_h{i}"), j))).alias("end")


def _each(i: int) -> Column:
    hits = F.col(f"_h{i}")
    return F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1))


def _checked(i: int, kind: str) -> Column:
    """The matches of pattern i that pass the strict check."""
    good = F.filter(_each(i), lambda j: _strict(kind, F.get(F.col(f"_h{i}"), j)))
    return F.transform(good, lambda j: F.struct(*_span(i, kind, j)))


def _candidates(i: int, kind: str) -> Column:
    """The matches of pattern i with their features."""
    hits, gaps = F.col(f"_h{i}"), F.col(f"_g{i}")
    return F.transform(_each(i), lambda j: F.struct(
        *_span(i, kind, j), F.get(hits, j).rlike(SECRET).alias("good"),
        _features(KINDS.index(kind), F.get(hits, j), F.right(F.get(gaps, j), F.lit(BEFORE)), F.left(F.get(gaps, j + 1), F.lit(AFTER))).alias("x"),
    ))


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, the base spans and the candidates of every row."""
    body = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    t = F.col("_text")
    searched = [(k, BASE[k], HINTS[k](t)) for k in BASE] + [(k, p, t.rlike(h)) for k, h, p in WIDE]
    columns = []
    for i, (_, pattern, hint) in enumerate(searched):
        hits, gaps = _found(t, pattern, hint)
        columns += [hits.alias(f"_h{i}"), gaps.alias(f"_g{i}")]
    split = body.select(*keep, *columns)
    starts = [_placed(F.col(f"_h{i}"), F.col(f"_g{i}")).alias(f"_s{i}") for i in range(len(searched))]
    placed = split.select(*keep, *(f"_h{i}" for i in range(len(searched))), *(f"_g{i}" for i in range(len(searched))), *starts)

    base = [_checked(i, kind) for i, (kind, _, _) in enumerate(searched[: len(BASE)])]
    wide = [_candidates(i, kind) for i, (kind, _, _) in enumerate(searched) if i >= len(BASE)]
    found = placed.select(*keep, _join_arrays(base, _SPAN).alias("base"), _join_arrays(wide, _CANDIDATE).alias("wide"))
    # confirmed: a strict span of its kind lies in it (secrets have a strict form of their own)
    secret = KINDS.index("secret")
    confirmed = F.transform("wide", lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"),
        F.when(c["kind"] == secret, c["good"]).otherwise(F.exists("base", lambda b: (b["kind"] == c["kind"]) & (b["start"] < c["end"]) & (b["end"] > c["start"]))).alias("good"),
        c["x"].alias("x")))
    return found.select(*keep, "base", F.when(F.size("wide") > 0, confirmed).otherwise(F.col("wide")).alias("wide"))


@dataclass
class Model:
    """Trees as nested (feature, cutoff, low, high) with leaves as numbers, their weights, and a margin per kind."""

    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    least: dict = field(default_factory=dict)

    def margin(self, x: Column) -> Column:
        """The weighted sum of the trees' leaves: all nodes are arrays of numbers, walked down from each root."""
        nodes: list[tuple] = []

        def lay(node) -> int:
            at = len(nodes)
            nodes.append(())
            if isinstance(node, float):
                nodes[at] = (0, 0.0, at, at, node)  # a leaf leads to itself
            else:
                feature, cutoff, low, high = node
                nodes[at] = (feature, cutoff, lay(low), lay(high), 0.0)
            return at

        roots = [lay(t) for t in self.trees]
        if not roots:
            return F.lit(0.0)
        feature, cutoff, low, high, value = (F.array(*map(F.lit, column)) for column in zip(*nodes))
        steps = F.array(*(F.lit(i) for i in range(DEPTH)))

        def down(node: Column, _: Column) -> Column:
            return F.when(F.get(x, F.get(feature, node)) <= F.get(cutoff, node), F.get(low, node)).otherwise(F.get(high, node))

        trees = F.array(*(F.struct(F.lit(r).alias("root"), F.lit(float(w)).alias("weight")) for r, w in zip(roots, self.weights)))
        return F.aggregate(trees, F.lit(0.0), lambda total, t: total + F.get(value, F.aggregate(steps, t["root"], down)) * t["weight"])


def _tree(node) -> float | tuple:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def fit(found: DataFrame, sample: int = SAMPLE) -> Model:
    """Boosted trees from a bounded sample of the candidates of ``find``, cutoffs from all candidates outside it."""
    each = found.filter(F.size("wide") > 0).select(F.explode("wide").alias("c")).select("c.kind", "c.good", "c.x")
    each = each.withColumn("o", F.xxhash64("kind", "x", "good")).withColumn("half", F.pmod(F.xxhash64("o"), F.lit(2)))
    # equal candidates are one row with a weight
    rows = each.filter("half = 0").groupBy("kind", "good", "x", "o").agg(F.count("*").cast("double").alias("weight"))
    taken = rows.orderBy("o").limit(sample).select("o", F.col("good").cast("double").alias("label"), "x", "weight").persist()
    try:
        ends = {r.label: r.last for r in taken.groupBy("label").agg(F.max("o").alias("last")).collect()}
        if not {0.0, 1.0} <= set(ends):
            return Model()
        boosted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, featuresCol="v", weightCol="weight", stepSize=0.3).fit(
            taken.select("label", "weight", array_to_vector("x").alias("v")))
        model = Model([_tree(t._call_java("rootNode")) for t in boosted.trees], list(boosted.treeWeights))
        # from the highest margin down, the share confirmed so far; bins add up before they are shuffled
        unseen = each.filter((F.col("half") == 1) | (F.col("o") > max(ends.values())))
        bins = unseen.select("kind", F.col("good").cast("double").alias("label"), F.round(model.margin(F.col("x")), 2).alias("margin"))
        bins = bins.groupBy("kind", "margin").agg(F.sum("label").alias("good"), F.count("*").alias("n"))
        down = Window.partitionBy("kind").orderBy(F.col("margin").desc())
        sums = bins.select("kind", "margin", F.sum("good").over(down).alias("good"), F.sum("n").over(down).alias("n"))
        safe = sums.filter((F.col("good") >= F.col("n") * PRECISION) & (F.col("n") >= SUPPORT))
        model.least = {r.kind: r.least for r in safe.groupBy("kind").agg(F.min("margin").alias("least")).collect()}
        return model
    finally:
        taken.unpersist()


def choose(found: DataFrame, model: Model) -> DataFrame:
    """``found`` with the spans taken: ``added`` of the candidates, and ``spans`` of base and added by kind and start."""
    if not model.least:
        return found.withColumn("added", F.array().cast(_SPAN)).withColumn("spans", F.col("base"))
    cut = lambda kind: F.coalesce(*(F.when(kind == k, F.lit(m)) for k, m in model.least.items()))
    strict = lambda c: c["good"] & (c["kind"] == KINDS.index("secret"))
    passed = F.filter("wide", lambda c: F.coalesce(F.round(model.margin(c["x"]), 2) >= cut(c["kind"]), F.lit(False)) & ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"]) & ~(strict(c) & (b["start"] >= c["start"]) & (b["end"] <= c["end"]))))
    by_start = F.sort_array(F.transform(passed, lambda c: F.struct(
        c["start"].alias("start"), (-c["end"]).alias("back"), c["kind"].alias("kind"))))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(so_far: Column, c: Column) -> Column:
        span = F.struct(c["kind"].alias("kind"), c["start"].alias("start"), (-c["back"]).alias("end"))
        taken = F.struct((-c["back"]).alias("at"), F.concat(so_far["out"], F.array(span)).alias("out"))
        return F.when(c["start"] >= so_far["at"], taken).otherwise(so_far)

    added = F.when(F.size("_passed") > 0, F.aggregate("_passed", none, step, lambda x: x["out"])).otherwise(F.array().cast(_SPAN))
    return found.withColumn("_passed", by_start).withColumn("added", added).withColumn(
        "spans", F.sort_array(F.concat("base", "added"))).drop("_passed")


def count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def as_text(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def searched(docs: DataFrame, text: str = "text") -> DataFrame:
    """``find`` with whole rows kept, for a fit and a redaction that search the texts once between them."""
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_body"))
    return find(rows, ("_row",), "_body")


def redact(docs: DataFrame, model: Model, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows with every span of the text replaced by its kind in brackets, and ``length`` brought up to date.

    Where spans of two kinds overlap, the one that starts first gives its kind, and what the other covers beyond it goes too.
    """
    return redact_found(searched(docs, text), model, text, length)


def redact_found(found: DataFrame, model: Model, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``redact`` of the rows that ``searched`` has gone through."""
    kinds = {f.name: f.dataType for f in found.schema["_row"].dataType}
    body = F.col("_row")[text]
    marked = choose(found, model)
    by_start = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    none = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(so_far: Column, s: Column) -> Column:
        more = F.concat(so_far["out"], F.substring(body, so_far["at"] + 1, s["start"] - so_far["at"]), F.get(names, s["kind"]))
        whole = F.struct(s["end"].alias("at"), more.alias("out"))
        partly = F.struct(F.greatest(so_far["at"], s["end"]).alias("at"), so_far["out"].alias("out"))
        return F.when(s["start"] >= so_far["at"], whole).otherwise(partly)

    tail = lambda x: F.concat(x["out"], F.substring(body, x["at"] + 1, F.char_length(body)))
    clean = F.when(F.size("spans") > 0, F.aggregate("_order", none, step, tail)).otherwise(body)
    out = marked.withColumn("_order", by_start).withColumn("_clean", clean)
    new = {text: F.col("_clean")}
    if length in kinds:
        new[length] = F.when(F.size("spans") > 0, F.char_length("_clean").cast(kinds[length])).otherwise(F.col("_row")[length])
    return out.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in kinds))
