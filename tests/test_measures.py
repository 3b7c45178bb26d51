"""Cleaning, measures and dashboard on hand-made rows."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from transitloom.operators import matching
from transitloom.plans import gold, serving, silver

RAW = "p string, ta string, cl int, sl int, a boolean, py double, px double, dt_ingestao timestamp"
FACT = ("data_hora_sp timestamp_ntz, prefixo_veiculo int, cod_linha int, latitude double, longitude double, "
        "sentido_desc string, is_acessivel boolean, data_referencia date")
LINES = ("cod_linha int, is_circular boolean, letreiro_completo string, nome_api_tp_ts string, "
         "nome_api_ts_tp string, sentido_api int, letreiro_gtfs string, nome_rota_oficial string")
T1, T2 = datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)


def ping(when, vehicle=1, line=7, lat=0.0, lon=0.0, direction="Ida", accessible=True):
    when = datetime.fromisoformat(when)
    return (when, vehicle, line, lat, lon, direction, accessible, when.date())


def fact(spark, *pings):
    return spark.createDataFrame(list(pings), FACT)


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), LINES)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# -- silver -------------------------------------------------------------------------------------

def test_fact_keeps_the_first_ingest(spark):
    raw = spark.createDataFrame([
        ("10", "2024-01-01T02:30:00Z", 1, 2, False, 9.0, 9.0, T2),
        ("10", "2024-01-01T02:30:00Z", 1, 1, True, 1.0, 2.0, T1),
        ("10", "2024-01-01T02:31:00Z", 1, None, True, 1.0, 2.0, T1),
    ], RAW)
    got = [tuple(r) for r in silver.position_fact(raw).orderBy("data_hora_sp").collect()]
    assert got == [
        (datetime(2023, 12, 31, 23, 30), 10, 1, 1.0, 2.0, "Ida", True, date(2023, 12, 31)),
        (datetime(2023, 12, 31, 23, 31), 10, 1, 1.0, 2.0, "Volta", True, date(2023, 12, 31)),
    ]


def test_tied_ingests_have_one_survivor(spark):
    tied = [("10", "2024-01-01T02:30:00Z", c, 1, True, float(c), 0.0, T1) for c in (3, 1, 2)]
    got = {silver.position_fact(spark.createDataFrame(order, RAW).repartition(3)).first().cod_linha
           for order in (tied, tied[::-1], tied[1:] + tied[:1])}
    assert got == {1}


def test_odd_vehicle_ids_and_times_become_null_and_are_counted(spark):
    raw = spark.createDataFrame([
        ("12A", "2024-01-01T02:30:00Z", 1, 1, True, 1.0, 1.0, T1),
        ("12", "soon", 1, 1, True, 1.0, None, T1),
        (None, "2024-01-01T02:30:00Z", 1, 1, True, 1.0, 1.0, T1),
    ], RAW)
    quality = silver.fact_quality(silver.position_fact(raw)).first()
    assert quality[:] == (3, 2, 1, 1)


def test_directions(spark):
    got = spark.createDataFrame([(1,), (2,), (3,), (None,)], "sl int").select(silver.direction_name(F.col("sl")))
    assert [r[0] for r in got.collect()] == ["Ida", "Volta", "Volta", "Volta"]


def test_line_dimension_takes_the_last_version_and_one_route(spark):
    raw = spark.createDataFrame([
        (1, False, "10", 1, 5, "old", "old", T1), (1, True, "10", 1, 5, "new", "new", T2),
        (2, False, "20", 1, None, "a", "b", T1), (3, False, "30", 2, 1, "a", "b", T1),
    ], "cl int, lc boolean, lt string, sl int, tl int, tp string, ts string, dt_ingestao timestamp")
    routes = spark.createDataFrame([("10-5", "B"), ("10-5", "A"), (None, "N"), ("99-9", "Z")],
                                   "route_short_name string, route_long_name string")
    got = sorted(tuple(r) for r in silver.line_dimension(raw, routes).collect())
    assert got == [(1, True, "10-5", "new", "new", 1, "10-5", "A"), (2, False, None, "a", "b", 1, None, None),
                   (3, False, "30-1", "a", "b", 2, None, None)]


def test_company_in_two_areas(spark):
    raw = spark.createDataFrame([(1, "X", 4, T1), (1, "X", 5, T1), (1, "X", 4, T2), (2, "Y", 1, T1)],
                                "c int, n string, a int, dt_ingestao timestamp")
    assert sorted(tuple(r) for r in silver.company_dimension(raw).collect()) == [(1, "X", 4), (2, "Y", 1)]
    assert sorted(tuple(r) for r in silver.company_dimension(raw, keys=("c", "a")).collect()) == [
        (1, "X", 4), (1, "X", 5), (2, "Y", 1)]


def test_map_labels_each_route_once(spark):
    shapes = spark.createDataFrame([("s", 1.0, 2.0, 1), ("s", 1.1, 2.1, 2), ("lonely", 0.0, 0.0, 1)],
                                   "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int")
    trips = spark.createDataFrame([("r1", "s", "b"), ("r1", "s", "a"), ("r2", "s", "c")],
                                  "route_id string, shape_id string, trip_headsign string")
    got = sorted(tuple(r) for r in silver.route_map(shapes, trips).collect())
    assert got == [("r1", "s", 1.0, 2.0, 1, "a"), ("r1", "s", 1.1, 2.1, 2, "a"),
                   ("r2", "s", 1.0, 2.0, 1, "c"), ("r2", "s", 1.1, 2.1, 2, "c")]


# -- speed --------------------------------------------------------------------------------------

# 0.1 degree of latitude is 11.1195 km
PINGS = [
    ping("2024-01-01 23:30:00", lat=0.0), ping("2024-01-02 00:00:00", lat=0.1, line=8),  # over midnight
    ping("2024-01-02 00:00:00", vehicle=2), ping("2024-01-02 00:00:00", vehicle=2, lat=0.1),  # no time between
    ping("2024-01-02 00:30:00", vehicle=None), ping("2024-01-02 00:45:00", vehicle=None, lat=0.1),
    ping("2024-01-02 06:00:00", vehicle=3), ping("2024-01-02 06:05:00", vehicle=3, lat=0.1),  # 133 km/h
    ping("2024-01-02 07:00:00", vehicle=4), ping("2024-01-02 08:00:00", vehicle=4, lat=0.01),  # 1 km/h
    ping("2024-01-02 09:00:00", vehicle=5), ping("2024-01-02 09:30:00", vehicle=5, lat=None),
    ping("2024-01-02 10:00:00", vehicle=5, lat=0.1),
]


@pytest.mark.parametrize("width", [60, 3_600, gold.SLICE_SECONDS])
def test_ping_speed(spark, width):
    got = gold.ping_speed(fact(spark, *PINGS), width).select("prefixo_veiculo", "dist_km", "velocidade_kmh")
    assert sorted(tuple(r) for r in got.collect() if r.dist_km is not None) == [
        (1, 11.1195, 22.2), (2, 11.1195, None), (3, 11.1195, 133.4), (4, 1.1119, 1.1)]


def test_a_pair_counts_for_the_later_ping(spark):
    known = lines(spark, (8, False, "8-1", "A", "B", 1, "8-1", "R"))
    got = gold.line_speed(fact(spark, *PINGS), known).collect()
    assert [(r.cod_linha, r.sentido_desc, r.data_referencia, r.velocidade_media, r.letreiro_completo) for r in got] == [
        (8, "Ida", date(2024, 1, 2), 22.2, "8-1")]
    assert got[0].lat_centroide == pytest.approx(0.1)


def test_bounds_are_excluded(spark):
    speeds = spark.createDataFrame([(5.0,), (5.1,), (109.9,), (110.0,), (None,)], "velocidade_kmh double")
    assert [r[0] for r in gold.plausible(speeds).collect()] == [5.1, 109.9]


def test_unknown_lines_stay_and_gaps_can_be_cut(spark):
    pings = fact(spark, ping("2024-01-01 00:00:00"), ping("2024-01-01 00:30:00", lat=0.1), ping("2024-01-01 10:30:00", lat=0.8))
    row = gold.line_speed(pings, lines(spark)).first()
    assert (row.cod_linha, row.letreiro_completo) == (7, None)
    assert row.velocidade_media == pytest.approx((22.2 + 7.8) / 2)
    assert gold.line_speed(pings, lines(spark), max_gap_hours=1).first().velocidade_media == 22.2


def test_carried_pings_pair_but_do_not_count(spark):
    before, day = fact(spark, ping("2024-01-01 23:30:00")), fact(spark, ping("2024-01-02 00:00:00", lat=0.1))
    assert gold.ping_speed(day).count() == 0
    got = gold.ping_speed(day, carried=before).collect()
    assert [(r.data_referencia, r.velocidade_kmh) for r in got] == [(date(2024, 1, 2), 22.2)]


def test_empty_inputs_give_typed_empty_results(spark):
    empty, none = fact(spark), lines(spark)
    speed, snapshot = gold.line_speed(empty, none), gold.fleet_snapshot(empty)
    shapes = spark.createDataFrame([], "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int")
    profile = gold.route_profile(shapes, spark.createDataFrame([], "route_id string, shape_id string"))
    day = serving.dashboard_day(speed, snapshot, profile)
    for df in (speed, snapshot, profile, day, gold.accessibility(empty, none), serving.slowest(day)):
        assert df.count() == 0
    assert serving.network_kpis(day).first()[:4] == (0, 0, None, 0.0)
    assert [r.outcome for r in serving.arrival_answers(day, ["x"]).collect()] == ["no line"]


# -- other measures -----------------------------------------------------------------------------

def test_accessibility_counts_pings(spark):
    pings = fact(spark, ping("2024-01-01 00:00:00"), ping("2024-01-01 00:01:00", accessible=False),
                 ping("2024-01-01 00:02:00", accessible=None), ping("2024-01-01 00:03:00", vehicle=None))
    row = gold.accessibility(pings, lines(spark, (7, False, "7-1", "A", "B", 1, None, None))).first()
    assert row[:] == ("A", "7-1", 66.67, 3, date(2024, 1, 1))


def test_snapshot_looks_at_all_history(spark):
    pings = fact(spark, ping("2024-01-01 10:00:00", line=1), ping("2024-01-03 10:00:00", line=3),
                 ping("2024-01-02 10:00:00", vehicle=2, line=2), ping("2024-01-02 10:00:00", vehicle=None))
    assert sorted((r.prefixo_veiculo, r.cod_linha) for r in gold.fleet_snapshot(pings).collect()) == [(1, 3), (2, 2)]
    assert sorted((r.prefixo_veiculo, r.cod_linha) for r in gold.fleet_snapshot(pings, as_of="2024-01-02").collect()) == [
        (1, 1), (2, 2)]


def test_route_length_is_weighted_by_trips(spark):
    shapes = spark.createDataFrame(
        [("short", 0.0, 0.0, 10), ("short", 0.0, 0.1, 30), ("long", 0.0, 0.0, 1), ("long", 0.2, 0.0, 5),
         ("long", 0.4, 0.0, 9), ("dot", 1.0, 1.0, 1)],
        "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int")
    trips = spark.createDataFrame([("r", "short")] * 2 + [("r", "long"), ("r", "dot"), ("r", None), ("q", "dot")],
                                  "route_id string, shape_id string")
    for width in (1, 4, gold.SLICE_POINTS):
        lengths = {r.shape_id: r.extensao_km for r in gold.shape_length(shapes, width).collect()}
        assert lengths == {"short": Decimal("11.12"), "long": Decimal("44.48")}
    profile = gold.route_profile(shapes, trips)
    assert dict(profile.dtypes)["extensao_km"] == "decimal(14,6)"
    # (11.12 * 2 + 44.48) / 3 and three stops per km, cut
    assert [tuple(r) for r in profile.collect()] == [("r", Decimal("22.240000"), 66)]


def test_weighted_mean_equals_average_over_trips(spark):
    lengths = spark.createDataFrame([(i, Decimal(f"{(i * 37) % 100}.{i % 100:02d}")) for i in range(50)],
                                    "shape_id int, extensao_km decimal(10,2)")
    plain = lengths.agg(F.avg("extensao_km")).first()[0]
    weight = F.lit(1).cast("decimal(20,0)")
    ours = lengths.agg(F.try_divide(F.sum(F.col("extensao_km") * weight), F.sum(weight)).cast("decimal(14,6)")).first()[0]
    assert ours == plain


# -- dashboard ----------------------------------------------------------------------------------

SPEED = ("cod_linha int, letreiro_completo string, nome_rota_oficial string, velocidade_media double, "
         "sentido_desc string, data_referencia date")
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture
def gold_tables(spark):
    speed = spark.createDataFrame([
        (1, "1-1", "North", 20.0, "Ida", D2), (1, "1-1", "North", 10.0, "Volta", D2), (2, "2-1", "South", 0.0, "Ida", D2),
        (3, "3-1", "West", 50.0, "Ida", D2), (4, None, "Ghost", 9.0, "Ida", D2), (5, "5-1", None, 9.0, "Ida", D2),
        (6, "6-1", "Idle", 9.0, "Ida", D2), (1, "1-1", "North", 99.0, "Ida", D1),
    ], SPEED)
    snapshot = fact(
        spark, *[ping("2024-01-02 10:00:00", vehicle=v, line=1, accessible=True) for v in (1, 2)],
        ping("2024-01-02 10:00:00", vehicle=3, line=2, accessible=True),
        ping("2024-01-02 10:00:00", vehicle=4, line=2, accessible=False),
        ping("2024-01-02 10:00:00", vehicle=5, line=3, accessible=None),
        ping("2024-01-02 10:00:00", vehicle=6, line=4), ping("2024-01-02 10:00:00", vehicle=7, line=5),
        ping("2024-01-01 10:00:00", vehicle=8, line=6))
    profile = spark.createDataFrame([("1-1", Decimal("30"), 90), ("9-9", Decimal("10"), 30)],
                                    "letreiro_gtfs string, extensao_km decimal(14,6), qtd_paradas_estimada int")
    return speed, snapshot, profile


def test_dashboard_of_the_newest_day(spark, gold_tables):
    got = {(r.cod_linha, r.sentido_desc): r for r in serving.dashboard_day(*gold_tables).collect()}
    assert sorted(got) == [(1, "Ida"), (1, "Volta"), (2, "Ida"), (3, "Ida")]
    north, south, west = got[1, "Ida"], got[2, "Ida"], got[3, "Ida"]
    assert (north.Rota, north.Qtd_Veiculos, north.extensao_km, north.tempo_estimado_h) == ("1-1 | North", 2, 30.0, 1.5)
    assert (north.Perc_Acessivel, north.Status_Acessibilidade) == (100.0, "full")
    # no profile: the mean of all profiles; no speed: no time
    assert (south.extensao_km, south.tempo_estimado_h, south.Perc_Acessivel, south.Status_Acessibilidade) == (
        20.0, None, 50.0, "partial")
    assert (west.Perc_Acessivel, west.Status_Acessibilidade) == (0.0, "none")


def test_dashboard_options(spark, gold_tables):
    speed, snapshot, profile = gold_tables
    assert {r.cod_linha for r in serving.dashboard_day(*gold_tables, accessible_only=True).collect()} == {1, 2}
    everything = serving.dashboard_day(*gold_tables, hide_ghosts=False)
    assert everything.count() == 7
    idle = everything.filter("cod_linha = 6").first()
    assert (idle.Qtd_Veiculos, idle.Status_Acessibilidade) == (0, "none")
    assert serving.dashboard_day(*gold_tables, day="2024-01-01").count() == 0  # its vehicles were seen since
    no_profile = serving.dashboard_day(speed, snapshot, profile.limit(0))
    assert {r.extensao_km for r in no_profile.collect()} == {15.0}
    assert serving.dashboard_day(speed, snapshot.limit(0), profile).count() == 0


def test_kpis_rankings_and_table(spark, gold_tables):
    day = serving.dashboard_day(*gold_tables)
    assert serving.network_kpis(day).first()[:] == (4, 7, 20.0, 100.0, "20.0 km/h", "100 km")
    assert [r.Rota for r in serving.slowest(day, 2).collect()] == ["2-1 | South", "1-1 | North"]
    assert [tuple(r) for r in serving.fastest(day, 2).collect()] == [("3-1 | West", 50.0), ("1-1 | North", 15.0)]
    assert [r.velocidade_media for r in serving.operations_table(day).collect()] == [0.0, 10.0, 20.0, 50.0]
    assert [r[0] for r in serving.date_choices(gold_tables[0]).collect()] == [D2, D1]


def test_status_never_rounds_up(spark):
    df = spark.createDataFrame([(3, 3), (999999, 1000000), (0, 5), (0, 0)], "a long, n long")
    got = [r[0] for r in df.select(serving.access_status(F.col("a"), F.col("n"))).collect()]
    assert got == ["full", "partial", "none", "none"]


def test_arrival_answers(spark, gold_tables):
    day = serving.dashboard_day(*gold_tables)
    got = {r.prompt: tuple(r)[1:] for r in serving.arrival_answers(day, ["NORTH", "^2", "w.st", "nowhere", "NORTH"]).collect()}
    assert got == {
        "NORTH": ("1-1 | North", 2, 20.0, 3, 15, "ok"),
        "^2": ("2-1 | South", 2, 0.0, None, None, "no speed"),
        "w.st": ("3-1 | West", 1, 50.0, 1, 6, "ok"),
        "nowhere": (None, None, None, None, None, "no line"),
    }
    literal = serving.arrival_answers(day, ["w.st", "-1 |"], literal=True)
    assert {r.prompt: r.outcome for r in literal.collect()} == {"w.st": "no line", "-1 |": "ok"}
    assert serving.arrival_answers(day, []).count() == 0
    asked = spark.createDataFrame([("north",), (None,), ("north",)], "prompt string")
    assert [r.prompt for r in serving.arrival_answers(day, asked).collect()] == ["north"]
    java = serving.arrival_answers(day, [r"^\p{L}*1"])  # valid where it runs
    assert [r.outcome for r in java.collect()] == ["ok"]
    with pytest.raises(ValueError):
        serving.arrival_answers(day, ["(?P<x>TERM)"])  # valid elsewhere only
    with pytest.raises(ValueError):
        serving.arrival_answers(day, ["("])


def test_prompts_with_accents_and_in_any_number(spark, gold_tables):
    day = serving.dashboard_day(*gold_tables).withColumn("Rota", F.concat("Rota", F.lit(" SÃO MATEUS")))
    assert [r.outcome for r in serving.arrival_answers(day, ["são mateus"]).collect()] == ["ok"]

    def nodes(prompts):
        plan = serving.arrival_answers(day, prompts)._jdf.queryExecution().optimizedPlan().toString()
        return len(plan.splitlines())

    many = spark.createDataFrame([(f"prompt {i}",) for i in range(1000)] + [("north",)], "prompt string")
    assert nodes(many) == nodes(spark.createDataFrame([("north",)], "prompt string"))
    got = serving.arrival_answers(day, many)
    assert got.count() == 1001 and got.filter("outcome <> 'no line'").select("prompt").collect() == [("north",)]


def test_bad_prompts_are_rows(spark, gold_tables):
    day = serving.dashboard_day(*gold_tables)
    asked = spark.createDataFrame([("(",), ("north",), ("[z-a]",), ("a**b",), (r"\p{X}",)], "prompt string")
    got = {r.prompt: (r.Rota, r.outcome) for r in serving.arrival_answers(day, asked).collect()}
    assert got.pop("north") == ("1-1 | North", "ok") and set(got.values()) == {(None, "bad prompt")}
    assert {r.outcome for r in serving.arrival_answers(day, asked, literal=True).collect()} == {"ok", "no line"}


def random_label(rng, letters="abcIKS é ſKİı-1"):
    return "".join(rng.choice(letters) for _ in range(rng.randrange(12)))


def test_texts_in_one_pass_equal_contains(spark, monkeypatch):
    rng = random.Random(4)
    labels = spark.createDataFrame([(random_label(rng),) for _ in range(300)] + [(None,)], "label string")
    prompts = spark.createDataFrame([(random_label(rng)[: rng.randrange(5)],) for _ in range(400)] + [(None,)], "prompt string")
    want = prompts.distinct().join(labels, F.contains(F.lower("label"), F.lower("prompt"))).groupBy("prompt").agg(F.min("label").alias("label"))
    assert rows(matching.first_by_text(labels, prompts)) == rows(want)
    monkeypatch.setattr(matching, "AUTOMATON", 50)
    monkeypatch.setattr(matching, "CHUNK", 40)
    assert rows(matching.first_by_text(labels, prompts)) == rows(want)


def test_patterns_by_index_equal_all_tries(spark):
    rng = random.Random(5)
    parts = ["abc", "a.c", "[abc]b", "a?bc", "ab+c", "b{2}", "b{0,2}", r"\.", r"\d", "(ab)?c", "x|abc", "^a", "1$", "é", "ſki", "ISK", r"\p{L}ab", r"\x61b", "KİI", " "]
    labels = [(random_label(rng),) for _ in range(400)] + [("aſKi",), ("straße",)]
    prompts = {"".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(300)} | {"", "stra.e", "STRA", "zzz", r"\Qabc\E"}
    labels = spark.createDataFrame(labels, "label string")
    asked = spark.createDataFrame([(p,) for p in prompts], "prompt string").filter(matching.valid(F.col("prompt")))
    tries = asked.join(labels, F.regexp_like("label", F.concat(F.lit(matching.IGNORE_CASE), F.col("prompt"))))
    want = tries.groupBy("prompt").agg(F.min("label").alias("label"))
    got = rows(matching.first_by_pattern(labels, asked))
    assert got == rows(want) and 20 < len(got) < len(prompts)


def test_literals_that_a_match_must_hold(spark):
    want = {
        "abc": ["abc"], "ab?c": ["a", "c"], "ab+c": ["ab", "c"], "a.b": ["a", "b"], r"a\.b": ["a", "b"], r"a\db": ["a", "b"], "a|b": [],
        "(ab)c": [], "ab[cd]e": ["ab", "e"], "ab[^]]c": ["ab", "c"], "ab{2}c": ["a", "c"], "ab{0,2}?c": ["a", "c"], "^ab$": ["ab"], r"\Qab\E": [],
        r"a\p{L}bc": [], r"a\x41b": [], "": [], "a[b[c]]d": [], "x[ab]?yz": ["x", "yz"], "ab++c": ["ab", "c"], r"a\\b": ["a", "b"]}
    table = spark.createDataFrame([(p,) for p in want], "prompt string")
    got = table.select("prompt", matching.required_literals(F.col("prompt")).alias("literals")).collect()
    assert {r.prompt: r.literals for r in got} == want
