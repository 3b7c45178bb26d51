from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transitloom import schemas
from transitloom.session import SPARK_ERRORS
from transitloom.sources import documents


def docs(spark, *bodies, **keys):
    columns = "".join(f", {k} int" for k in keys)
    return spark.createDataFrame([(b if isinstance(b, str) or b is None else json.dumps(b), *keys.values()) for b in bodies],
                                 "body string" + columns)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


VEHICLE = {"p": "123", "a": True, "ta": "2024-01-01T00:00:00Z", "py": -23.5, "px": -46.6}


def test_positions_flatten_and_skip_what_is_missing(spark):
    line = {"c": "1-1", "cl": 7, "sl": 1, "lt0": "A", "lt1": "B", "qv": 1}
    full = {"hr": "10:00", "l": [{**line, "vs": [VEHICLE, None]}, None, line, {**line, "vs": None}, {**line, "vs": []}]}
    no_hour = {"l": [{**line, "vs": [VEHICLE]}]}
    out = documents.positions(docs(
        spark, full, no_hour, {"hr": "1"}, {"hr": "1", "l": None}, {"hr": "1", "l": []}, "not json", "", None))
    want = (7, "1-1", 1, "B", "A", "123", True, "2024-01-01T00:00:00Z", -23.5, -46.6)
    assert got(out) == [("00:00", *want), ("10:00", *want)]
    assert out.columns == schemas.BRONZE["posicao_veiculos"].names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.BRONZE["posicao_veiculos"]]


def test_numbers_sent_for_text_become_text(spark):
    out = documents.positions(docs(spark, {"l": [{"cl": 1, "vs": [{"p": 123}, {"p": None}]}]}))
    assert [r.p for r in out.orderBy("p").collect()] == [None, "123"]


def test_companies_take_an_object_or_a_list(spark):
    one = {"hr": "1", "e": [{"a": 4, "e": [{"c": 9, "n": "X"}, None]}, {"a": 5, "e": None}, None]}
    assert got(documents.companies(docs(spark, one))) == [("1", 4, 9, "X")]
    assert got(documents.companies(docs(spark, [one, None, {"hr": "2"}, one]))) == [("1", 4, 9, "X")] * 2


@pytest.mark.parametrize("wrap", [lambda p: p, lambda p: [p], lambda p: [p, None]])
def test_forecast_stop_comes_alone_or_in_a_list(spark, wrap):
    due = {**VEHICLE, "t": "10:05"}
    line = {"c": "1-1", "cl": 7, "sl": 2, "lt0": "A", "lt1": "B", "qv": 1, "vs": [due]}
    head = {"cp": 5, "np": "S", "py": 1.0, "px": 2.0}
    by_stop = documents.stop_forecast(docs(spark, {"hr": "9", "p": wrap({**head, "l": [line, {**line, "vs": []}]})}))
    tail = ("123", "10:05", True, "2024-01-01T00:00:00Z", -23.5, -46.6)
    assert got(by_stop) == [("9", 5, "S", 1.0, 2.0, "1-1", 7, 2, "A", "B", 1, *tail)]
    assert by_stop.columns == schemas.BRONZE["previsao_chegada_parada"].names
    by_line = documents.line_forecast(docs(spark, {"hr": "9", "ps": wrap({**head, "vs": [due]})}, cod_linha=77))
    assert got(by_line) == [(77, "9", 5, "S", 1.0, 2.0, *tail)]


@pytest.mark.parametrize("body", [{"hr": "9"}, {"hr": "9", "p": None}, {"hr": "9", "p": []}, {"hr": "9", "p": {"cp": 1}},
                                  {"hr": "9", "p": [{"cp": 1, "l": None}]}, "broken", None])
def test_forecast_without_vehicles_gives_no_rows(spark, body):
    assert got(documents.stop_forecast(docs(spark, body))) == []


def test_flat_lists_keep_the_request_key(spark):
    out = documents.stops(docs(spark, [{"cp": 1, "np": "A", "ed": "B", "py": 1.0, "px": 2.0}, None], cod_corredor=8))
    assert got(out) == [(8, 1, "A", "B", 1.0, 2.0)]
    lines = documents.lines(docs(spark, [{"cl": 1, "lc": False, "lt": "10", "sl": 1, "tl": 10, "tp": "X", "ts": "Y"}], []))
    assert got(lines) == [(1, False, "10", 1, 10, "X", "Y")]


def test_corridors_fail_on_a_bad_document(spark):
    assert got(documents.corridors(docs(spark, [{"cc": 1, "nc": "N"}]))) == [(1, "N")]
    with pytest.raises(SPARK_ERRORS):
        documents.corridors(docs(spark, [{"cc": 1, "nc": "N"}], "{broken")).collect()


def test_unreadable(spark):
    df = docs(spark, {"hr": "1"}, [], "broken", "", None).withColumn("bad", documents.is_unreadable(F.col("body")))
    assert [r.bad for r in df.collect()] == [False, False, True, True, True]


vehicle = st.fixed_dictionaries({
    "p": st.text("abc0123 é\"\\", min_size=1, max_size=6), "a": st.booleans(), "ta": st.just("t"),
    "py": st.floats(-90, 90), "px": st.floats(-180, 180),
})
line = st.fixed_dictionaries({"cl": st.integers(0, 99), "c": st.text("x-9", max_size=4), "sl": st.integers(1, 2),
                              "lt0": st.just("A"), "lt1": st.just("B"), "vs": st.lists(vehicle, max_size=4)})


@settings(max_examples=8, deadline=None)
@given(st.lists(st.fixed_dictionaries({"hr": st.text("0123:", min_size=1, max_size=5), "l": st.lists(line, max_size=4)}),
                min_size=1, max_size=4))
def test_flatten_of_nested_is_identity(spark, nested):
    flat = [(d["hr"], l["cl"], l["c"], l["sl"], l["lt1"], l["lt0"], v["p"], v["a"], v["ta"], v["py"], v["px"])
            for d in nested for l in d["l"] for v in l["vs"]]
    assert got(documents.positions(docs(spark, *nested))) == sorted(flat, key=str)
