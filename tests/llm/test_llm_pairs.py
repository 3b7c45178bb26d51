"""Substring removal, near copies, contamination and components against plain versions."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from cases import ASCII_LOWER, LONG, PASSAGE, blank_words, documents, empty, items, odd, odd_rows, rows

import __spark_entry__ as entry
from transitloom.llm import decontaminate, graph, ngramjoin, substring, tokens
from transitloom.llm.rows import keyed


# -- words and hashes ----------------------------------------------------------------------------

@pytest.mark.parametrize("kind, pattern, lower", [
    (tokens.PLAIN, r"[^\x20\x09-\x0D]+", False), (tokens.LOWER, r"[^\x20\x09-\x0D]+", True),
    (tokens.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)])
def test_words_are_those_of_the_pattern(kind, pattern, lower):
    rng = random.Random(4)
    texts = ["", None, " ", "a", "A b", *("".join(rng.choice("aB \n\t\x0b.é中-9_😀\x1c\x85") for _ in range(rng.randrange(60))) for _ in range(300))]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])
    data, starts, ends, h, first = tokens.words_of(batch, "t", kind)
    raw = data.tobytes()
    seen = {}
    for i, text in enumerate(texts):
        text = (text or "").translate(ASCII_LOWER) if lower else (text or "")
        want = re.findall(pattern, text)
        got = [raw[a:b].decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert [g.translate(ASCII_LOWER) if lower else g for g in got] == want
        for word, value in zip(want, h[first[i] : first[i + 1]]):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_a_word_longer_than_a_slice_has_one_hash(monkeypatch):
    text = np.frombuffer(b"ab" * 5000 + b" " + b"ab" * 5000 + b" x", dtype=np.uint8)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 64)
    starts, ends = tokens.PLAIN.spans(text)
    h = tokens.PLAIN.hashes(text, starts, ends)
    assert len(h) == 3 and h[0] == h[1] != h[2]


# -- substrings ----------------------------------------------------------------------------------

def plain_removal(docs, window):
    seen, out = set(), []
    for key, text in docs:
        words = blank_words(text)
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            run = tuple(words[a : a + window])
            if run in seen:
                gone[a : a + window] = [True] * window
            seen.add(run)
        out.append((key, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


@pytest.mark.parametrize("period", [3, 7, 13, 21])
def test_difference_covers_undo_every_shift(period):
    cover = substring.difference_cover(period)
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_removal_equals_the_plain_version(spark, sf_dir):
    got = {r[0]: r[1:] for r in entry.queries()["op3_substring_dedup"](spark, sf_dir).collect()}
    docs = sorted((r.doc_id, r.text) for r in documents(spark, sf_dir).select("doc_id", "text").collect())
    want = {k: (n, m, hashlib.sha256(kept.encode()).hexdigest()) for k, n, m, kept in plain_removal(docs, 20)}
    assert got == want and any(m for _, m, _ in want.values())


@pytest.mark.parametrize("seed", range(3))
def test_removal_of_random_texts(spark, seed):
    rng = random.Random(seed)
    base = [rng.choice("abc") for _ in range(400)]
    docs = [(i, " ".join(base[a : a + rng.randrange(60)] if rng.random() < 0.7 else [rng.choice("ab") for _ in range(rng.randrange(50))]))
            for i in range(40) for a in [rng.randrange(380)]]
    got = rows(substring.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), window=8, period=5))
    assert got == sorted(plain_removal(docs, 8), key=str)


def test_removal_takes_odd_documents(spark):
    got = [tuple(r) for r in substring.remove_repeats(odd(spark)).collect()]
    assert len(got) == len(odd_rows())
    by_id = collections.defaultdict(list)
    for i, n, gone, kept in got:
        by_id[i].append((n, gone, kept))
    # a null id comes first, so the passage stays there and goes from every other text
    assert by_id[None] == [(63, 0, "no id here " + PASSAGE)]
    assert sorted(by_id[5]) == [(60, 60, ""), (60, 60, ""), (66, 60, "another text of the same id")]
    assert by_id[2] == by_id[3] == by_id[4] == [(0, 0, "")]
    assert by_id[6] == [(30_000, *plain_removal([(0, LONG)], 20)[0][2:])]
    assert by_id[7][0][1] == plain_removal([(0, "a " * 5000)], 20)[0][2]
    assert by_id[10] == [(61, 60, "tail")]
    assert substring.remove_repeats(empty(spark)).count() == 0


# -- near copies ---------------------------------------------------------------------------------

def shingles(text, size=3):
    words = blank_words((text or "").translate(ASCII_LOWER))
    return {tuple(words[a : a + size]) for a in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def plain_components(docs, percent=90, size=3):
    sets = [(k, shingles(t, size)) for k, t in docs]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    index = collections.defaultdict(list)
    for i, (_, s) in enumerate(sets):
        met = collections.Counter(j for g in s for j in index[g])
        for g in s:
            index[g].append(i)
        for j, n in met.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                up[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (k, _) in enumerate(sets):
        low[root(i)] = min(low.get(root(i), k), k)
    return [(k, len(s), low[root(i)]) for i, (k, s) in enumerate(sets)]


def test_components_equal_the_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]
    want = plain_components(docs)
    assert rows(entry.queries()["op10_ngram_jaccard"](spark, sf_dir)) == sorted(want, key=str)
    assert len({c for _, _, c in want}) < len(docs)


@pytest.mark.parametrize("seed, edits", [(0, 1), (1, 3), (2, 6)])
def test_components_of_a_group_of_edits(spark, seed, edits):
    """Copies with edits: some are linked through others only, some not at all."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(70)]
    docs = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], [f"e{rng.randrange(40)}"], [words[at], "more"]])
        docs.append((i, " ".join(words)))
    got = rows(ngramjoin.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == sorted(plain_components(docs), key=str)


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_components_at_other_similarities(spark, percent):
    rng = random.Random(percent)
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(14)))) for i in range(60)]
    got = rows(ngramjoin.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=percent))
    assert got == sorted(plain_components(docs, percent), key=str)


@pytest.mark.parametrize("percent", [50, 80, 90, 99])
def test_levels_of_linked_sizes_are_neighbours(percent):
    grid = ngramjoin.Grid(percent)
    for n in range(1, 700):
        assert grid.level(n * 100 // percent) - grid.level(n) in (0, 1)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_rows_have_the_needed_blocks_in_common(percent):
    rng, grid, linked = np.random.default_rng(percent), ngramjoin.Grid(percent), 0
    for n in [*range(1, 60), *range(60, 3000, 97)]:
        for _ in range(6):
            a = np.unique(rng.integers(1, 1 << 63, n).astype(np.uint64))
            gone = int(rng.integers(0, n * (100 - percent) // 100 + 1))
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[gone:]], rng.integers(1, 1 << 63, rng.integers(0, gone + 1)).astype(np.uint64)]))
            met = len(np.intersect1d(a, b))
            if 100 * met < percent * (len(a) + len(b) - met) or len(a) == len(b) == met:
                continue
            linked += 1
            both = np.minimum(ngramjoin.sketch(a), ngramjoin.sketch(b)).sum(dtype=int)
            assert both >= met
            x, y = grid.signatures(a), grid.signatures(b)
            common = set(x[0].tolist()) & set(y[0].tolist())
            for sig, which, need in (x, y):
                shared = [g for s, g in zip(sig.tolist(), which.tolist()) if s in common]
                assert any(shared.count(g) >= need[which == g].max() for g in set(which.tolist()))
    assert linked > 200


def test_components_take_odd_documents(spark):
    least = -(1 << 63)  # a null id is the smallest
    named = [(least if i is None else i, t) for i, t in (r[:2] for r in odd_rows())]
    want = [tuple(None if x == least else x for x in r) for r in plain_components(named)]
    got = rows(ngramjoin.near_duplicates(odd(spark)))
    assert got == sorted(want, key=str)
    assert (9, 58, None) in got and (10, 59, None) in got and (2, 0, 2) in got  # upper case, a longer tail, no words
    assert ngramjoin.near_duplicates(empty(spark)).count() == 0


def test_one_of_each_group_stays_with_its_columns(spark):
    docs = odd(spark)
    left = ngramjoin.first_of_each(docs)
    assert left.columns == docs.columns
    kept = collections.Counter(r.doc_id for r in left.collect())
    assert kept[9] == kept[10] == 0 and kept[None] == kept[1] == kept[2] == kept[3] == kept[4] == 1
    assert ngramjoin.first_of_each(empty(spark)).count() == 0


def inputs(df):
    """How many tables a plan reads, as often as it reads them."""
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_no_step_of_the_join_is_a_wide_plan(spark, monkeypatch):
    """The exchanges of a plan start together, and each takes memory of the driver."""
    read, kept = [], ngramjoin.stored
    monkeypatch.setattr(ngramjoin, "stored", lambda df, purpose: read.append((purpose, inputs(df))) or kept(df, purpose))
    rng = random.Random(5)
    base = [f"w{i}" for i in range(70)]
    docs = [(i, " ".join(w if rng.random() < 0.96 else f"e{rng.randrange(40)}" for w in base)) for i in range(60)]
    left = ngramjoin.first_of_each(spark.createDataFrame(docs, "doc_id long, text string"), size=5, percent=80)
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in plain_components(docs, 80, 5)})
    assert {"links", "rare", "rooted"} <= {purpose for purpose, _ in read}
    assert max([n for _, n in read] + [inputs(left)]) <= 5


def test_steps_without_rows_are_left_out(spark, monkeypatch):
    made, kept = [], ngramjoin.stored
    monkeypatch.setattr(ngramjoin, "stored", lambda df, purpose: made.append(purpose) or kept(df, purpose))
    docs = [(i, " ".join(f"w{i}-{k}" for k in range(40))) for i in range(8)] + [(9, " ".join(f"w3-{k}" for k in range(40)))]
    got = ngramjoin.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(got) == sorted(plain_components(docs), key=str)
    assert not {"pairs", "links", "rare"} & set(made)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200), (None, 3)]
    got = dict(rows(graph.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 300: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_turn_is_spent_on_stars(spark, monkeypatch):
    turns, kept = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, purpose: turns.append(purpose) or kept(df, purpose))
    star = [(1, 9), (9, 1), (5, 1), (4, 3), (3, 4), (7, 3), (6, 6), (None, 2)]
    got = graph.components(spark.createDataFrame(star, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [(1, 1), (3, 3), (4, 3), (5, 1), (7, 3), (9, 1)]
    assert len(turns) == 1
    # one turn for a star whose middle is the largest node, and none after it
    turns.clear()
    got = graph.components(spark.createDataFrame([(9, k) for k in range(9)], "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [(k, 0) for k in range(10)]
    assert len(turns) == 2


# -- contamination -------------------------------------------------------------------------------

def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def plain_contamination(docs, tests, size=13):
    windows = collections.defaultdict(set)
    for item, text in tests:
        words = bench_words(text)
        for a in range(max(1, len(words) - size + 1) if words else 0):
            windows[tuple(words[a : a + size])].add(item)
    out = []
    for key, text in docs:
        words, hit, found = bench_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for a in range(len(words) - n + 1):
                met = windows.get(tuple(words[a : a + n]))
                if met:
                    found |= met
                    hit.update(range(a, a + n))
        names = sorted({str(i) for i in found if i is not None})
        out.append((key, len(words), len(hit), len(names), names, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def test_contamination_equals_the_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()]
    tests = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(*r[:4], hashlib.sha256(",".join(r[4]).encode()).hexdigest(), r[5]) for r in plain_contamination(docs, tests)]
    assert rows(entry.queries()["op8_decontamination"](spark, sf_dir)) == sorted(want, key=str)
    assert any(r[-1] for r in want)


TESTS = [(1, PASSAGE), (2, "one"), (3, "two words"), (4, None), (5, ""), (None, "a a a a a a a a a a a a a a"), (6, "plain words of a short text"), (6, "中文 ß")]


@pytest.mark.parametrize("block", [1 << 20, 15])
def test_contamination_takes_odd_documents_and_short_items(spark, block):
    extra = [(20, "one"), (21, "two one Words two words"), (22, "one two")]
    docs = [r[:2] for r in odd_rows()] + extra
    table = odd(spark).select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = decontaminate.contamination(table, items(spark, [(*t, "x") for t in TESTS]), block_words=block)
    assert rows(got) == sorted(plain_contamination(docs, TESTS), key=str)


def test_no_step_of_contamination_is_a_wide_plan(spark, monkeypatch):
    read, kept = [], decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, purpose: read.append(inputs(df)) or kept(df, purpose))
    left = decontaminate.clean(odd(spark), items(spark))
    left.collect()
    assert max([*read, inputs(left)]) <= 6


def test_contamination_of_nothing(spark):
    none = items(spark)
    assert decontaminate.contamination(empty(spark), none).count() == 0
    found = decontaminate.contamination(odd(spark), none)
    assert found.filter("n_hit > 0 or contaminated").count() == 0 and found.count() == len(odd_rows())


def test_clean_documents_stay_with_their_columns(spark):
    docs = odd(spark)
    left = decontaminate.clean(docs, items(spark, [(1, PASSAGE, "x")]))
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {1, 2, 3, 4, 6, 7, 8, 11, 12}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red cat sat on blue mat"), (2, "red x x x x x x cat"), (3, "cat red")], "doc_id long, text string")
    vocab = [np.array(r.words).view(np.uint64)[0] for r in decontaminate.item_words(items(spark, [(i, w, "") for i, w in enumerate(("red", "cat"))])).orderBy("item").collect()]
    index = decontaminate.build_index(keyed(docs), np.array(vocab), np.zeros(0, np.uint64), 1)
    groups = spark.createDataFrame([("pair", k, int(v.view(np.int64))) for k, v in enumerate(vocab)], "group string, number int, term long")
    got = decontaminate.proximity_matches(index, groups, terms=2, span=3)
    assert sorted((r._doc, r["first"], r["last"]) for r in got.collect()) == [(1, 0, 1), (3, 0, 1)]
