"""The table jobs from landed documents to gold, in full and day by day."""

from __future__ import annotations

import json
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from transitloom import schemas
from transitloom.operators import numbering
from transitloom.plans import gold, jobs, serving
from transitloom.sources import landing, tables

DAYS = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]


def document(hour, pings):
    """pings: (vehicle, line, direction, ta, lat)"""
    return json.dumps({"hr": hour, "l": [
        {"c": f"{line}-1", "cl": line, "sl": direction, "lt0": "A", "lt1": "B", "qv": 1,
         "vs": [{"p": str(vehicle), "a": vehicle % 2 == 0, "ta": ta, "py": lat, "px": -46.0}]}
        for vehicle, line, direction, ta, lat in pings]})


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    prefix = "jobs_"
    tables.create_layers(spark, str(root), prefix)
    made = jobs.Layers(spark, prefix)

    def docs(*bodies, **key):
        columns = "".join(f", {k} int" for k in key)
        return spark.createDataFrame([(b, *key.values()) for b in bodies], "body string" + columns)

    run = datetime(2024, 1, 4)
    for n, day in enumerate(DAYS):
        for hour in range(0, 24, 3):
            # the local day starts at 03:00 UTC; every vehicle moves 0.1 degree in 3 hours
            at = f"{day}T{hour:02d}:30:00Z"
            pings = [(v, 100 + v % 3, 1 + v % 2, at, round(-23 + 0.2 * (8 * n + hour // 3) * (1 + v / 10), 6)) for v in range(6)]
            seen = datetime(day.year, day.month, day.day, hour, 35)
            jobs.ingest(made, "posicao_veiculos", docs(document(at, pings)), seen, landing_root=str(root / "landing"))
            late = [(v, 999, 1, ta, 0.0) for v, _, _, ta, _ in pings[:2]]  # repeats of known signals
            jobs.ingest(made, "posicao_veiculos", docs(document(at, late)), datetime(day.year, day.month, day.day, hour, 50))
    lines = [{"cl": c, "lc": False, "lt": str(c), "sl": 1, "tl": 1, "tp": f"P{c}", "ts": f"S{c}"} for c in (100, 101, 102)]
    for _ in range(2):  # each run replaces the last
        jobs.ingest(made, "buscar_linhas", docs(json.dumps(lines)), run)
    jobs.ingest(made, "empresas", docs(json.dumps({"hr": "1", "e": [{"a": 1, "e": [{"c": 5, "n": "X"}]}]})), run)
    stops = json.dumps([{"cp": 1, "np": "A", "ed": "1 2", "py": 1.0, "px": 2.0}])
    jobs.ingest(made, "buscar_paradas", docs(stops, stops, "[]"), run)
    jobs.ingest(made, "paradas_por_linha", docs(stops, cod_linha=100), run)

    folder = root / "upload"
    folder.mkdir()
    (folder / "routes.txt").write_text("route_id,route_short_name,route_long_name\n1,100-1,North\n2,101-1,South\n")
    (folder / "shapes.txt").write_text("shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\ns,0,0,1\ns,0.1,0,2\n")
    (folder / "trips.txt").write_text("route_id,trip_id,shape_id,trip_headsign\n100-1,t1,s,Centre\n100-1,t2,s,Centre\n")
    status = jobs.ingest_schedule(made, str(folder), run)
    assert {r.file for r in status.filter("error is null").collect()} == {"routes", "shapes", "trips"}
    jobs.build_silver(made)
    jobs.build_gold(made)
    yield made
    for layer in schemas.LAYERS:
        spark.sql(f"DROP SCHEMA {prefix}{layer} CASCADE")


def test_bronze(layers):
    assert layers.read("bronze", "posicao_veiculos").count() == 3 * 8 * (6 + 2)
    assert layers.read("bronze", "buscar_linhas").count() == 3
    assert layers.read("bronze", "buscar_paradas").count() == 1
    assert layers.read("bronze", "paradas_por_linha").first().cod_linha == 100
    stamped = layers.read("bronze", "empresas").first()
    assert (stamped.dt_ingestao, stamped.arquivo_origem) == (datetime(2024, 1, 4), "empresas_20240104_000000.json")


def test_silver_and_gold(layers):
    fact = layers.read("silver", "fato_posicao_veiculos")
    assert fact.count() == 3 * 8 * 6
    assert fact.filter("cod_linha = 999").count() == 0
    assert layers.read("gold", "snapshot_frota_atual").count() == 6
    assert [(r.letreiro_gtfs, float(r.extensao_km)) for r in layers.read("gold", "perfil_rota_estatico").collect()] == [
        ("100-1", 11.12)]
    assert layers.read("silver", "dim_linhas").count() == 3
    # six vehicles on six line and direction pairs; the first of the four local days has first pings only
    assert layers.read("gold", "velocidade_linhas").count() == 6 * 3
    day = serving.dashboard_day(
        layers.read("gold", "velocidade_linhas"), layers.read("gold", "snapshot_frota_atual"),
        layers.read("gold", "perfil_rota_estatico"))
    assert {r.Rota for r in day.collect()} == {"100-1 | North", "101-1 | South"}


@pytest.mark.parametrize("chosen", ["2024-01-02", None])
def test_dashboard_reads_one_day(layers, chosen):
    speed = layers.read("gold", "velocidade_linhas")
    day = serving.dashboard_day(speed, layers.read("gold", "snapshot_frota_atual"),
                                layers.read("gold", "perfil_rota_estatico"), day=chosen)
    plan = day._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "velocidade_media" in line and "FileScan" in line)
    # the newest day is a subquery, evaluated before the files are listed
    wanted = "2024-01-02" if chosen else "Subquery"
    assert re.search(rf"PartitionFilters: \[isnotnull\(data_referencia#\d+\), \(data_referencia#\d+ = {wanted}", scan)


def test_fact_by_day_equals_rebuild(layers):
    name = layers.name("silver", "fato_posicao_veiculos")
    before = rows(layers.read("silver", "fato_posicao_veiculos"))
    for day in DAYS:
        assert day in jobs.refresh_fact(layers, day, day)
    assert rows(layers.spark.table(name)) == before
    assert jobs.refresh_fact(layers, date(2030, 1, 1)) == []


def test_a_refresh_reads_the_ingest_days_it_needs(layers):
    raw = layers.read("bronze", "posicao_veiculos").filter(F.col(jobs.INGEST_DAY).isin([DAYS[0]]))
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dia_ingestao", plan)


def test_late_signals_and_emptied_days_equal_a_rebuild(layers, spark):
    """A signal a week late, one without a time, and a day whose signals are gone."""
    def docs(*bodies):
        return spark.createDataFrame([(b,) for b in bodies], "body string")

    late = [(7, 100, 1, "2024-01-01T12:30:00Z", -20.0), (8, 100, 1, "soon", -20.0)]
    report = jobs.ingest(layers, "posicao_veiculos", docs(document("x", late)), datetime(2024, 1, 8, 12))
    assert report.first()[:] == ("posicao_veiculos", 1, 0, 0, 2)
    fact = layers.name("silver", "fato_posicao_veiculos")
    gone = date(2023, 12, 25)
    extra = spark.table(fact).limit(1).withColumn(jobs.DAY, F.lit(gone))
    tables.replace_partitions(extra, fact, jobs.DAY)
    layers.spark.createDataFrame([(gone, date(2024, 1, 8))], f"{jobs.DAY} date, dia_ingestao date").write.insertInto(
        layers.name("bronze", "dias_sinal"))
    assert jobs.refresh_fact(layers, date(2024, 1, 8)) == [None, gone, date(2024, 1, 1)]
    after = rows(spark.table(fact))
    jobs.build_silver(layers)
    assert rows(spark.table(fact)) == after
    jobs.build_gold(layers)


def test_a_missing_previous_day_is_refused(layers):
    with pytest.raises(ValueError, match="refresh that day first"):
        jobs.refresh_day(layers, DAYS[1], date(1999, 1, 1))


def test_reports_count_what_cannot_be_used(layers, spark):
    bodies = ['{"hr": "1", "l": 5}', "not json", "[]", "{}", '{"hr": "1", "l": []}', document("1", [(1, 1, 1, "2024-01-02T00:00:00Z", 1.0)])]
    made = jobs.Layers(spark, "reports_")
    spark.sql("CREATE SCHEMA IF NOT EXISTS reports_bronze")
    try:
        docs = spark.createDataFrame([(b,) for b in bodies], "body string")
        report = jobs.ingest(made, "posicao_veiculos", docs, datetime(2024, 1, 2))
        assert report.first()[:] == ("posicao_veiculos", 6, 1, 1, 1)
        # a column the table does not know yet
        docs = spark.createDataFrame([(bodies[-1], "north")], "body string, depot string")
        jobs.ingest(made, "posicao_veiculos", docs, datetime(2024, 1, 3))
        got = made.read("bronze", "posicao_veiculos").orderBy("dt_ingestao").select("p", "depot").collect()
        assert [tuple(r) for r in got] == [("1", None), ("1", "north")]
    finally:
        spark.sql("DROP SCHEMA reports_bronze CASCADE")


def test_increments_equal_rebuild(layers):
    spark = layers.spark
    names = ("velocidade_linhas", "acessibilidade", "snapshot_frota_atual")

    def timed(name):  # signals without a time belong to no day
        return rows(layers.read("gold", name).filter(f"{jobs.DAY} is not null"))

    want = {n: timed(n) for n in names}
    for n in names:
        tables.drop_table(spark, layers.name("gold", n))
    fact = layers.read("silver", "fato_posicao_veiculos")
    days = [r[0] for r in fact.filter(f"{jobs.DAY} is not null").select(jobs.DAY).distinct().orderBy(jobs.DAY).collect()]
    assert len(days) == 4
    for previous, day in zip([None, *days], days):
        jobs.refresh_day(layers, day, previous)
    jobs.refresh_day(layers, days[-1], days[-2])  # the same day again changes nothing
    got = {n: timed(n) for n in names}
    assert {n: [[v if not isinstance(v, float) else round(v, 9) for v in r] for r in t] for n, t in got.items()} == \
        {n: [[v if not isinstance(v, float) else round(v, 9) for v in r] for r in t] for n, t in want.items()}


def test_a_day_reads_its_own_partition(layers):
    fact = layers.read("silver", "fato_posicao_veiculos").filter(F.col(jobs.DAY) == F.lit(DAYS[1]))
    plan = gold.accessibility(fact, layers.read("silver", "dim_linhas"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_referencia" in plan


def test_sweeps_land_stamp_and_name_their_lots(layers, tmp_path):
    spark, run = layers.spark, datetime(2024, 1, 5, 6, 30)

    def by_line(key):
        if key == 102:
            raise TimeoutError("slow")
        return json.dumps({"hr": "1", "ps": {"cp": key, "vs": [{"p": key, "t": "06:40"}]}}) if key != 101 else "[]"

    keys = numbering.distinct_keys(layers.read("bronze", "buscar_linhas"), "cl")
    summary = jobs.ingest_sweep(layers, "previsao_chegada_linha", keys, by_line, run, str(tmp_path / "a"),
                                lot_size=1, tasks=2, wait_seconds=0)
    assert {r.status: r.requests for r in summary.collect()} == {"ok": 1, "empty": 1, "failed": 1}
    row = layers.read("bronze", "previsao_chegada_linha").first()
    assert (row.cod_linha, row.cp, row.p, row.arquivo_origem) == (100, 100, "100", "batch_0_20240105_063000.json")

    def by_stop(key):
        return json.dumps({"hr": "1", "p": {"cp": key, "l": [{"cl": 1, "vs": [{"p": "9"}]}]}})

    stops = spark.createDataFrame([(1,), (2,), (3,)], "cp int")
    jobs.ingest_sweep(layers, "previsao_chegada_parada", stops, by_stop, run, str(tmp_path / "b"), lot_size=2, tasks=2)
    got = layers.read("bronze", "previsao_chegada_parada").select("cp", "arquivo_origem")
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "gtfs_batch_0_20240105_063000.json"), (2, "gtfs_batch_0_20240105_063000.json"),
        (3, "gtfs_batch_2_20240105_063000.json")]
    # nothing left to ask: a resumed sweep adds no requests
    again = jobs.ingest_sweep(layers, "paradas_por_corredor", stops, lambda k: f'[{{"cp": {k}}}]', run,
                              str(tmp_path / "c"), wait_seconds=0)
    resumed = jobs.ingest_sweep(layers, "paradas_por_corredor", stops, None, run, str(tmp_path / "c"), resume=True)
    assert again.collect() == resumed.collect()
    assert sorted(tuple(r) for r in layers.read("bronze", "paradas_por_corredor").select("cod_corredor", "cp").collect()) == [
        (1, 1), (2, 2), (3, 3)]
    # the key that failed is asked again; nothing else is, and no row is written twice
    asked = []

    def now(key):
        asked.append(key)
        return json.dumps({"hr": "2", "ps": {"cp": key, "vs": [{"p": key, "t": "07:00"}]}})

    summary = jobs.ingest_sweep(layers, "previsao_chegada_linha", keys, now, run, str(tmp_path / "a"), lot_size=1, tasks=2,
                                resume=True, wait_seconds=0, landing_root=str(tmp_path / "landing"))
    assert {r.status: r.requests for r in summary.collect()} == {"ok": 2, "empty": 1}
    got = layers.read("bronze", "previsao_chegada_linha").select("cod_linha", "arquivo_origem")
    assert sorted(tuple(r) for r in got.collect()) == [
        (100, "batch_0_20240105_063000.json"), (102, "batch_2_20240105_063000.json")]
    landed = landing.read_landed(spark, str(tmp_path / "landing" / "previsao_chegada_linha" / "raw_*"), ["cod_linha", "arquivo_origem"])
    assert [tuple(r) for r in landed.select("cod_linha", "arquivo_origem").collect()] == [("102", "batch_2_20240105_063000.json")]


def test_a_run_written_again_replaces_itself(layers, tmp_path):
    spark = layers.spark
    made = jobs.Layers(spark, "again_")
    tables.create_layers(spark, str(tmp_path), "again_")
    root, first, second = str(tmp_path / "landing"), datetime(2024, 1, 5, 6), datetime(2024, 1, 5, 7)

    def one(key, body):
        return spark.createDataFrame([(body, key)], "body string, cod_linha int")

    forecast = json.dumps({"hr": "1", "ps": {"cp": 7, "vs": [{"p": 1, "t": "07:00"}]}})
    for _ in range(2):  # a piece of a run, landed and written twice
        report = jobs.ingest(made, "previsao_chegada_linha", one(3, forecast), first, landing_root=root, part="p1")
        assert report.first()[1:] == (1, 0, 0, 1)
    assert made.read("bronze", "previsao_chegada_linha").count() == 1
    positions = [document("1", [(1, 100, 1, "2024-01-05T05:59:00Z", -23.0)]), document("2", [(2, 100, 1, "2024-01-05T06:59:00Z", -23.0)])]
    stops = json.dumps([{"cp": 1, "np": "A", "ed": "1 2", "py": 1.0, "px": 2.0}])
    for landing_root in (root, None, root):  # whole runs, of a table by day and of one without partitions
        for run, body in zip((first, second), positions):
            jobs.ingest(made, "posicao_veiculos", one(1, body).select("body"), run, landing_root=landing_root)
            jobs.ingest(made, "paradas_por_linha", one(run.hour, stops), run, landing_root=landing_root)
    assert sorted((r.p, r.dt_ingestao.hour) for r in made.read("bronze", "posicao_veiculos").collect()) == [("1", 6), ("2", 7)]
    assert sorted((r.cod_linha, r.dt_ingestao.hour) for r in made.read("bronze", "paradas_por_linha").collect()) == [(6, 6), (7, 7)]
    assert landing.read_landed(spark, f"{root}/posicao_veiculos/raw_*").count() == 2


def test_documents_are_evaluated_once(layers, tmp_path):
    spark = layers.spark
    made = jobs.Layers(spark, "once_")
    tables.create_layers(spark, str(tmp_path), "once_")
    asked = spark.sparkContext.accumulator(0)

    def ask(batches):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([('[{"cp": 1}]', 1)], "body string, cod_linha int").mapInArrow(ask, "body string, cod_linha int")
    for n, root in enumerate((None, str(tmp_path / "landing"))):
        jobs.ingest(made, "paradas_por_linha", docs, datetime(2024, 1, 5 + n), landing_root=root)
        assert asked.value == n + 1


def test_many_keys_land_in_few_files(spark, tmp_path):
    docs = spark.range(20_000).selectExpr("concat('{\"cp\": ', id, '}') as body", "cast(id as int) as cp", "if(id % 2 = 0, null, 'x') as note")
    path = str(tmp_path / "landed")
    for _ in range(2):
        assert landing.land_raw(docs, path, ["cp", "note"], replace=True)
    assert 0 < len(list((tmp_path / "landed").glob("*.json"))) < 50
    assert landing.read_landed(spark, path, ["cp"]).filter("body = concat('{\"cp\": ', cp, '}')").count() == 20_000
    with pytest.raises(ValueError, match="have no line"):
        landing.stream_landed(spark, path, keys=["cp", "line"])
    assert landing.stream_landed(spark, path, keys=["cp", "note"]).columns == ["body", "arquivo_origem", "cp", "note"]


def test_snapshots_come_from_the_chain(spark, tmp_path):
    made = jobs.Layers(spark, "chain_")
    tables.create_layers(spark, str(tmp_path), "chain_")
    schema = ("data_hora_sp timestamp_ntz, prefixo_veiculo int, cod_linha int, latitude double, longitude double, "
              "sentido_desc string, is_acessivel boolean, data_referencia date")

    def fact(late):
        pings = [(datetime(2024, 1, d, h), v, 7, float(d), 0.0, "Ida", True, date(2024, 1, d))
                 for d in range(1, 9) for h in (6, 18) for v in range(1, 6) if (d + v) % 3 == 0 or late and v == 4 and d == 3]
        return spark.createDataFrame(pings, schema)

    def snapshots():
        return {d: rows(jobs.snapshot_as_of(made, date(2024, 1, d))) for d in (1, 3, 4, 6, 8)}

    def wanted(df):
        return {d: rows(gold.fleet_snapshot(df, as_of=f"2024-01-0{d}")) for d in (1, 3, 4, 6, 8)}

    name, chain = made.name("silver", "fato_posicao_veiculos"), made.name("silver", jobs.LAST_PINGS)
    tables.replace_table(fact(False), name, jobs.DAY)
    assert snapshots() == wanted(fact(False))  # no chain yet
    for day in (date(2024, 1, 3), date(2024, 1, 6)):
        tables.replace_partitions(gold.fleet_snapshot(fact(False), as_of=str(day)).withColumn(jobs.UNTIL, F.lit(day)), chain, jobs.UNTIL, [day])
    assert snapshots() == wanted(fact(False))
    assert len(jobs.snapshot_as_of(made, date(2024, 1, 6)).inputFiles()) <= 4  # the day's partition of the chain alone
    tables.replace_table(fact(True), name, jobs.DAY)
    assert snapshots() != wanted(fact(True))
    assert jobs.repair_chain(made, date(2024, 1, 3)) == [date(2024, 1, 3), date(2024, 1, 6)]
    assert snapshots() == wanted(fact(True))


def test_refused_documents_are_kept_and_replayed(layers, tmp_path):
    spark = layers.spark
    made = jobs.Layers(spark, "refused_")
    tables.create_layers(spark, str(tmp_path), "refused_")
    stop = '[{"cp": %d, "np": "A", "ed": "1 2", "py": 1.0, "px": 2.0}]'
    docs = spark.createDataFrame(
        [(stop % 1, 10), ((stop % 2)[:-1], 20), ('{"cp": 3', 30), ('[1, 2]', 40), ("[]", 50), (stop % 4, None), ((stop % 5)[:-1], None)],
        "body string, cod_linha int")
    run = datetime(2024, 1, 5, 6)
    for root in (None, str(tmp_path / "landing")):  # a run written again is refused once
        report = jobs.ingest(made, "paradas_por_linha", docs, run, landing_root=root).first()
        held = made.read("bronze", jobs.QUARANTINE)
        assert (report.unreadable, report.wrong_shape) == (3, 1)
        assert held.count() == report.unreadable + report.wrong_shape
    assert sorted((r.motivo, r.corpo, r.chaves["cod_linha"]) for r in held.collect() if r.corpo[:2] != "[{") == [
        ("unreadable", '{"cp": 3', "30"), ("wrong shape", "[1, 2]", "40")]

    def stops():
        return sorted((r.cp, r.cod_linha) for r in made.read("bronze", "paradas_por_linha").collect())

    assert stops() == [(1, 10), (4, None)]
    assert jobs.replay(made, "paradas_por_linha", datetime(2024, 1, 6)).first()[1:] == (4, 0, 4)
    mend = lambda text: F.when(text.endswith("}"), F.concat(text, F.lit("]"))).otherwise(text)
    assert jobs.replay(made, "paradas_por_linha", datetime(2024, 1, 6), mend).first()[1:] == (4, 2, 2)
    assert stops() == [(1, 10), (2, 20), (4, None), (5, None)]
    assert jobs.replay(made, "paradas_por_linha", datetime(2024, 1, 7), mend).first()[1:] == (2, 0, 2)
    assert jobs.replay(made, "buscar_linhas", datetime(2024, 1, 7)).first()[1:] == (0, 0, 0)
    # a table whose runs replace each other keeps its rows
    lines = json.dumps([{"cl": 1, "lc": False, "lt": "1", "sl": 1, "tl": 1, "tp": "P", "ts": "S"}])
    jobs.ingest(made, "buscar_linhas", spark.createDataFrame([(lines,), (lines.replace("1", "2")[:-1],)], "body string"), run)
    assert jobs.replay(made, "buscar_linhas", datetime(2024, 1, 8), mend).first()[1:] == (1, 1, 0)
    assert sorted(r.cl for r in made.read("bronze", "buscar_linhas").collect()) == [1, 2]


def test_refused_cells_are_kept_with_their_line(layers, tmp_path):
    made = jobs.Layers(layers.spark, "cells_")
    tables.create_layers(layers.spark, str(tmp_path / "lake"), "cells_")
    (tmp_path / "shapes.txt").write_text("shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\n1,north,2.0,3\n1,1.0,2.0,x\n1,1.0,2.0,4\n")
    for _ in range(2):
        status = jobs.ingest_schedule(made, str(tmp_path), datetime(2024, 1, 5))
        assert status.filter("file = 'shapes'").first().rejected == 2
    held = made.read("bronze", jobs.QUARANTINE).collect()
    assert sorted((r.motivo, json.loads(r.corpo)["shape_pt_sequence"], dict(r.chaves)) for r in held) == [
        ("cell shape_pt_lat", "3", {"shape_pt_lat": "north"}), ("cell shape_pt_sequence", "x", {"shape_pt_sequence": "x"})]


def test_many_commits_are_written_in_few_steps(spark, tmp_path, monkeypatch):
    run, table = datetime(2024, 3, 5, 6, 30), "paradas_por_linha"
    tables.create_layers(spark, str(tmp_path / "lake"), "steps_")
    layers = jobs.Layers(spark, "steps_")
    steps, ingest = [], jobs.ingest
    monkeypatch.setattr(jobs, "ingest", lambda *a, **k: steps.append(k["parts"]) or ingest(*a, **k))
    keys = spark.createDataFrame([(k,) for k in range(7)], "cl int")
    root = str(tmp_path / "landing")
    jobs.ingest_sweep(layers, table, keys, lambda k: f'[{{"cp": {k}}}]', run, str(tmp_path / "many"), lot_size=1,
                      tasks=2, lots_per_commit=1, landing_root=root)
    assert [len(s) for s in steps] == [1, 2, 4]
    replies = spark.read.parquet(str(tmp_path / "many" / "replies"))
    commits = sorted(r[0] for r in replies.select("commit").distinct().collect())
    assert len(commits) == 7
    for again in (commits[2], commits[:3]):  # written again, one and several replace themselves
        jobs.write_commit(layers, table, replies, "cl", again, 1, run, root) if isinstance(again, list) else jobs.write_commit(
            layers, table, replies.filter(F.col("commit") == again), "cl", again, 1, run, root)
    mine = layers.read("bronze", table).filter(F.col("arquivo_origem").contains("20240305_063000"))
    assert sorted((r.cod_linha, r.cp) for r in mine.collect()) == [(k, k) for k in range(7)]
    assert mine.select(jobs.PART).distinct().count() == 7
    assert landing.read_landed(spark, f"{root}/{table}/raw_*").count() == 7
