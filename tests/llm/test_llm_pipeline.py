"""The pipeline, stage by stage, against plain versions over what each stage was given."""

from __future__ import annotations

import random
import re

import pytest
from cases import documents, empty, odd, rows
from test_llm_pairs import plain_components, plain_contamination
from test_llm_texts import coded_by_library, library, plain_spans  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline
from transitloom.llm import queries
from transitloom.llm.graph import stored


@pytest.fixture(scope="module")
def passed(spark, sf_dir):
    """The documents before the first stage and after each."""
    docs, out = documents(spark, sf_dir), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"test-{name}")
        out.append(docs)
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(passed):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "pii", "bpe"]
    assert all(df.columns == passed[0].columns for df in passed[1:-1])
    assert passed[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_toxic_documents_go(spark, sf_dir, passed):
    scores = {r.doc_id: r.score for r in entry.queries()["op1_toxicity_crf"](spark, sf_dir).collect()}
    assert set(by_id(passed[1])) == {i for i, s in scores.items() if s < 0.5}
    assert len(by_id(passed[1])) < len(by_id(passed[0]))


def test_one_of_each_group_stays(passed):
    before = [(r.doc_id, r.text) for r in passed[1].collect()]
    assert set(by_id(passed[2])) == {k for k, _, c in plain_components(before, 80, 5) if k == c}


def test_edited_and_longer_copies_go(spark, sf_dir):
    rng = random.Random(6)
    docs = []
    for base in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        edits = list(words)
        for k in rng.sample(range(300), 3 + base):  # five-word similarity from about 0.9 down to 0.6
            edits[k] = f"e{k}"
        docs += [(base * 10, " ".join(words)), (base * 10 + 1, " ".join(words + [f"t{rng.randrange(5000)}" for _ in range(20 + 5 * base)])),
                 (base * 10 + 2, " ".join(edits))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    left = set(by_id(corpus_pipeline.drop_near_copies(spark, table, sf_dir)))
    assert left == {k for k, _, c in plain_components(docs, 80, 5) if k == c}
    narrow = {k for k, _, c in plain_components(docs) if k == c}
    assert left < narrow and 12 < len(left)


def test_contaminated_documents_go(spark, sf_dir, passed):
    tests = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    before = [(r.doc_id, r.text) for r in passed[2].collect()]
    assert set(by_id(passed[3])) == {r[0] for r in plain_contamination(before, tests) if not r[-1]}


def test_personal_data_is_redacted(passed):
    before, after = by_id(passed[3]), by_id(passed[4])
    assert set(before) == set(after)
    changed = 0
    for i, r in after.items():
        spans = plain_spans(before[i].text)
        changed += bool(spans)
        assert not plain_spans(r.text) and len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", r.text)) <= len(spans)
        assert r.n_chars == len(r.text) if spans else r.text == before[i].text or "[SECRET]" in r.text
    assert changed


def test_tokens_of_what_is_left(passed, library):  # noqa: F811
    want = [(r.doc_id, *coded_by_library(library, r.text)) for r in passed[4].collect()]
    assert rows(passed[5]) == sorted(want, key=str)


def test_run_gives_the_last_stage(spark, sf_dir, passed):
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(passed[5])


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_documents(spark, sf_dir, k):
    stage = corpus_pipeline.STAGES[k][1]
    out = stage(spark, odd(spark), sf_dir)
    assert out.count() > 0
    assert stage(spark, empty(spark), sf_dir).count() == 0
    if k < 4:
        assert out.columns == odd(spark).columns
