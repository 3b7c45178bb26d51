from __future__ import annotations

import time
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom import schemas
from transitloom.session import shared_folder, side_by_side
from transitloom.sources import documents, gtfs, landing, sweep, tables

RUN = datetime(2024, 2, 1, 6, 30)


# -- scratch folder -----------------------------------------------------------------------------

def test_shared_folder_follows_the_cluster_setting(spark):
    parent = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "a"), shared_folder(spark, "a")
    assert first.startswith(f"{parent}/a-") and first != second


# -- landing ------------------------------------------------------------------------------------

def test_raw_documents_survive_verbatim(spark, tmp_path):
    bodies = ['{"a": 1}', '{\n  "a": "é",\r\n "b": 2\n}', "[]", "not json"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert landing.land_raw(df, str(tmp_path / "raw"))
    assert landing.land_raw(df.limit(1), str(tmp_path / "raw"))
    back = landing.read_landed(spark, str(tmp_path / "raw"))
    assert sorted(r.body for r in back.collect()) == sorted([*bodies, bodies[0]])
    assert all("/raw/part-" in r.arquivo_origem for r in back.collect())


def test_landing_failure_is_reported_not_raised(spark, tmp_path):
    (tmp_path / "taken").write_text("a file, not a folder")
    df = spark.createDataFrame([("{}",)], "body string")
    assert landing.land_raw(df, str(tmp_path / "taken" / "raw")) is False


def test_one_document_per_file(spark, tmp_path):
    (tmp_path / "posicao_1.json").write_text('{\n"hr": "1",\n"l": [{"cl": 1, "vs": [{"p": "9"}]}]}')
    (tmp_path / "posicao_2.json").write_text('{"hr": "2", "l": []}')
    rows = documents.positions(landing.read_document_files(spark, str(tmp_path))).collect()
    assert [(r.hr, r.p, r.arquivo_origem.rsplit("/", 1)[1]) for r in rows] == [("1", "9", "posicao_1.json")]


def test_rows_of_one_run_share_one_ingest_time(spark, tmp_path):
    rows = landing.stamp(spark.range(5), RUN, "x.json")
    path = landing.land_rows(rows, str(tmp_path), "linhas", RUN)
    assert path.endswith("/linhas_20240201_063000.json")
    landing.land_rows(rows, str(tmp_path), "linhas", RUN)
    back = spark.read.schema(rows.schema).json(path)
    assert back.count() == 5
    assert back.select("dt_ingestao", "arquivo_origem").distinct().count() == 1


# -- static files -------------------------------------------------------------------------------

@pytest.fixture
def schedule(tmp_path):
    (tmp_path / "stops.txt").write_text('﻿stop_id,stop_name,zone\n0012,"A, B",1\n7,C,2\n')
    (tmp_path / "stop_times.txt").write_text("trip_id,arrival_time,stop_sequence\nt1,08:00:00,1\nt1,25:10:00,x\n")
    (tmp_path / "shapes.txt").write_text("shape_id,shape_pt_lon,shape_pt_lat,shape_pt_sequence\ns1,-46.5,-23.5,1\n")
    (tmp_path / "agency.txt").write_text("\x00\x01\x02 not a schedule file\n")
    return str(tmp_path)


def test_schedule_types_and_lineage(spark, schedule):
    stops = gtfs.read_file(spark, schedule, "stops", RUN).orderBy("stop_id").collect()
    assert [(s.stop_id, s.stop_name, s.stop_lat, s.zone) for s in stops] == [("0012", "A, B", None, "1"), ("7", "C", None, "2")]
    assert all(s.arquivo_origem.endswith("/stops.txt") and s.dt_ingestao == RUN for s in stops)
    times = gtfs.read_file(spark, schedule, "stop_times").orderBy("arrival_time").collect()
    assert [(t.arrival_time, t.stop_sequence) for t in times] == [("08:00:00", 1), ("25:10:00", None)]
    shape = gtfs.read_file(spark, schedule, "shapes").first()
    assert (shape.shape_pt_lat, shape.shape_pt_lon) == (-23.5, -46.5)


def test_schedule_inference_is_on_offer(spark, schedule):
    rows = gtfs.read_file(spark, schedule, "shapes", infer=True)
    assert rows.schema["shape_pt_sequence"].dataType == T.IntegerType()


def test_bad_files_do_not_stop_the_load(spark, schedule):
    loaded = {}

    def write(name, rows):
        loaded[name] = rows.count()
        return loaded[name]

    report = gtfs.load_files(spark, schedule, write, RUN).collect()
    assert {r.file: r.rejected for r in report if r.rows is not None} == {"stops": 0, "stop_times": 1, "shapes": 0}
    status = {r.file: (r.rows, r.error) for r in report}
    assert set(status) == set(schemas.GTFS)
    assert loaded == {"stops": 2, "stop_times": 2, "shapes": 1}
    assert status["stops"] == (2, None)
    assert status["routes"][0] is None and "routes.txt" in status["routes"][1]
    assert status["agency"][0] is None and "no known column" in status["agency"][1]


# -- sweep --------------------------------------------------------------------------------------

def test_sweep_retries_and_records_every_key(spark):
    def fetch(key):
        state = fetch.__dict__.setdefault("tries", {})
        state[key] = state.get(key, 0) + 1
        if key == 1 and state[key] < 3 or key == 2:
            raise ConnectionError("down")
        return {3: "[]", 4: None}.get(key, f'[{{"cp": {key}}}]')

    keys = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5)], "cp int")
    replies = sweep.sweep(keys, "cp", fetch, tasks=2, attempts=3, wait_seconds=0)
    # one run of the requests: the replies are landed before they are looked at
    out = shared_folder(spark, "replies")
    replies.write.parquet(out)
    replies = spark.read.parquet(out)
    assert sorted((r.cp, r.status, r.attempt, r.error) for r in replies.collect()) == [
        (1, "ok", 3, None), (2, "failed", 3, "down"), (3, "empty", 1, None), (4, "empty", 1, None), (5, "ok", 1, None)]
    assert sorted(r.cp for r in documents.stops(replies.filter("status = 'ok'").select("body")).collect()) == [1, 5]
    summary = {r.status: (r.requests, r.attempts) for r in sweep.attempts_summary(replies).collect()}
    assert summary == {"ok": (2, 4), "failed": (1, 3), "empty": (2, 2)}


def test_sweep_with_more_keys_than_one_flush(spark):
    keys = spark.range(1000).select(F.col("id").cast("int").alias("k"))
    replies = sweep.sweep(keys, "k", lambda k: f"[{k}]", tasks=3, wait_seconds=0)
    assert replies.agg(F.count("k"), F.countDistinct("body")).first()[:] == (1000, 1000)


def test_lots_are_committed_one_by_one_and_resumed(spark, tmp_path):
    requests, replies, checkpoint = (str(tmp_path / n) for n in ("requests", "replies", "checkpoint"))
    keys = spark.range(25).select(F.col("id").cast("int").alias("cp"))
    sweep.write_lots(keys, "cp", 10, requests)

    def run():
        sweep.sweep_lots(spark, requests, "cp", lambda k: f"[{k}]", replies, checkpoint, tasks=2,
                         wait_seconds=0).awaitTermination()

    run()
    assert len(list((tmp_path / "replies").glob("commit=*"))) == 3
    got = spark.read.parquet(replies)
    assert sorted((r.cp, r.lote, r.body) for r in got.collect()) == [(k, k // 10, f"[{k}]") for k in range(25)]
    assert {r[0] for r in got.select(sweep.lot_origin(F.col("lote"), 10, "run")).distinct().collect()} == {
        "batch_0_run.json", "batch_10_run.json", "batch_20_run.json"}
    # the last commit is lost: only that lot is asked for again, into the same folder
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    assert len(list((tmp_path / "replies").glob("commit=*"))) == 3
    assert spark.read.parquet(replies).count() == 25


def test_failed_keys_are_queued_in_one_file_per_lot(spark, tmp_path):
    requests, replies = str(tmp_path / "requests"), str(tmp_path / "replies")
    asked = spark.range(400).select(
        F.col("id").cast("int").alias("cp"), F.expr("id div 100").alias("lote"), F.lit("failed").alias("status"), F.lit(0).alias("commit"))
    asked.write.partitionBy("commit").parquet(replies)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # as many tasks as on larger tables
    try:
        sweep.ask_again(spark, requests, "cp", replies)
    finally:
        spark.conf.set(name, before)
    assert len(list((tmp_path / "requests").glob("lote=*/*.parquet"))) == 4
    assert spark.read.parquet(requests).count() == 400


def test_lots_share_files_of_requests(spark, tmp_path):
    requests, replies, checkpoint = (str(tmp_path / n) for n in ("requests", "replies", "checkpoint"))
    keys, lots = spark.range(300).select(F.col("id").cast("int").alias("cp")), 150
    sweep.write_lots(keys, "cp", 2, requests)
    files = -(-lots // sweep.LOTS_IN_FILE)
    assert len(list((tmp_path / "requests").rglob("*.parquet"))) == files

    def down(key):
        if key % 2:
            raise TimeoutError("down")
        return f"[{key}]"

    for fetch in (down, lambda k: f"[{k}]"):
        sweep.sweep_lots(spark, requests, "cp", fetch, replies, checkpoint, tasks=2, lots_per_commit=4, attempts=1,
                         wait_seconds=0).awaitTermination()
        sweep.ask_again(spark, requests, "cp", replies)
    # one commit in four lots, each time; the failed keys lie in as few files, and nothing is queued when none is left
    assert len(list((tmp_path / "requests").rglob("*.parquet"))) == 2 * files
    assert len(list((tmp_path / "replies").glob("commit=*"))) == 2 * -(-lots // 4)
    last = sweep.last_replies(spark, replies, "cp").collect()
    assert sorted((r.cp, r.lote, r.status) for r in last) == [(k, k // 2, "ok") for k in range(300)]


def test_a_queue_of_single_lots_goes_on(spark, tmp_path):
    requests, replies, checkpoint = (str(tmp_path / n) for n in ("requests", "replies", "checkpoint"))
    keys = spark.range(40).select(F.col("id").cast("int").alias("cp"), F.expr("id div 10").alias("lote"))
    keys.repartition("lote").write.partitionBy("lote").parquet(requests)

    def down(key):
        raise TimeoutError("down")

    for fetch in (down, lambda k: f"[{k}]"):
        sweep.sweep_lots(spark, requests, "cp", fetch, replies, checkpoint, tasks=2, lots_per_commit=2, attempts=1,
                         wait_seconds=0).awaitTermination()
        sweep.ask_again(spark, requests, "cp", replies)
    assert len(list((tmp_path / "requests").glob("lote=*/*.parquet"))) == 8
    last = sweep.last_replies(spark, replies, "cp").collect()
    assert sorted((r.cp, r.lote, r.status) for r in last) == [(k, k // 10, "ok") for k in range(40)]


# -- catalog ------------------------------------------------------------------------------------

@pytest.fixture
def layers(spark, tmp_path):
    prefix = f"t{abs(hash(str(tmp_path))) % 10**8}_"
    tables.create_layers(spark, str(tmp_path), prefix)
    yield prefix
    for layer in schemas.LAYERS:
        spark.sql(f"DROP SCHEMA {prefix}{layer} CASCADE")


def test_layers_sit_at_their_folders(spark, layers, tmp_path):
    tables.create_layers(spark, str(tmp_path), layers)  # again is harmless
    spark.range(1).write.saveAsTable(f"{layers}silver.x")
    assert (tmp_path / "silver" / "x").is_dir()


@pytest.mark.parametrize("name", sorted(schemas.BRONZE))
def test_bronze_tables_carry_types_and_comments(spark, layers, name):
    table = f"{layers}bronze.{name}"
    schema = schemas.with_audit(schemas.BRONZE[name])
    tables.create_table(spark, table, schema)
    tables.create_table(spark, table, schema)
    made = spark.table(table).schema
    assert [(f.name, f.dataType, f.metadata["comment"]) for f in made] == \
        [(f.name, f.dataType, f.metadata["comment"]) for f in schema]
    assert made.names[-2:] == ["dt_ingestao", "arquivo_origem"]


def test_comments_describe_and_drop(spark, layers, tmp_path):
    table = f"{layers}bronze.corredores"
    tables.create_table(spark, table, schemas.BRONZE["corredores"])
    tables.comment_table(spark, table, "Corridors; it's a list")
    report = tables.comment_columns(spark, table, {"cc": "the code's", "zz": "no such column"}).collect()
    assert [(r.column, r.error is None) for r in report] == [("cc", True), ("zz", False)]
    described = {r.col_name: (r.data_type, r.comment) for r in tables.describe(spark, table).collect()}
    assert described["cc"] == ("int", "the code's")
    assert described["Comment"][0] == "Corridors; it's a list"
    tables.drop_table(spark, table)
    tables.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)
    assert not (tmp_path / "bronze" / "corredores").exists()


def test_register_existing_files(spark, layers, tmp_path):
    spark.range(3).withColumn("data_referencia", F.lit("2024-01-01").cast("date")).write.partitionBy(
        "data_referencia").parquet(str(tmp_path / "gold" / "velocidade_linhas"))
    spark.range(2).write.parquet(str(tmp_path / "gold" / "perfil_rota_estatico"))
    report = {r.table: r.error for r in tables.register_tables(spark, str(tmp_path), layers).collect()}
    assert len(report) == 21 + 5 + 4
    assert report[f"{layers}gold.velocidade_linhas"] is None
    assert spark.table(f"{layers}gold.velocidade_linhas").count() == 3
    assert spark.table(f"{layers}gold.perfil_rota_estatico").count() == 2
    # nothing written yet: reported, not raised
    assert report[f"{layers}silver.dim_linhas"] is not None


def test_replace_changes_schema_unless_told_not_to(spark, layers):
    name = f"{layers}gold.x"
    tables.replace_table(spark.range(2), name)
    tables.replace_table(spark.range(3).withColumn("more", F.lit("x")), name)
    assert spark.table(name).columns == ["id", "more"]
    with pytest.raises(ValueError):
        tables.replace_table(spark.range(1), name, same_schema=True)
    tables.replace_table(spark.range(1).withColumn("more", F.lit("y")), name, same_schema=True)
    assert spark.table(name).count() == 1


def test_replace_only_the_days_at_hand(spark, layers):
    name = f"{layers}silver.days"

    def day(d, *values):
        return spark.createDataFrame([(v, d) for v in values], "v int, d string").withColumn("d", F.col("d").cast("date"))

    tables.replace_partitions(day("2024-01-01", 1, 2), name, "d")
    tables.replace_partitions(day("2024-01-02", 3), name, "d")
    tables.replace_partitions(day("2024-01-01", 9).select("d", "v"), name, "d")
    def held():
        return sorted((tuple(r) for r in spark.table(name).select("v", F.col("d").cast("string")).collect()), key=str)

    assert held() == [(3, "2024-01-02"), (9, "2024-01-01")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    # days named without rows are emptied, a table may be read for its own replacement, new columns are taken
    tables.replace_partitions(day("2024-01-03", 4), name, "d", [date(2024, 1, 1), date(2024, 1, 3)])
    assert held() == [(3, "2024-01-02"), (4, "2024-01-03")]
    tables.replace_partitions(spark.table(name).withColumn("v", F.col("v") + 1), name, "d")
    tables.replace_partitions(day(None, 7), name, "d")
    assert held() == [(4, "2024-01-02"), (5, "2024-01-03"), (7, None)]
    tables.replace_partitions(day(None), name, "d", [None])
    tables.replace_partitions(day("2024-01-02", 8).withColumn("w", F.lit("new")), name, "d")
    assert held() == [(5, "2024-01-03"), (8, "2024-01-02")]
    assert sorted((tuple(r) for r in spark.table(name).select("v", "w").collect()), key=str) == [(5, None), (8, "new")]


def test_days_replaced_side_by_side_keep_all_others(spark, layers):
    name = f"{layers}silver.side"
    days = [date(2024, 1, n) for n in range(1, 7)]
    tables.replace_partitions(spark.createDataFrame([(0, d) for d in days], "v int, d date"), name, "d")
    side_by_side(spark, *(
        lambda d=d: tables.replace_partitions(spark.createDataFrame([(1, d)], "v int, d date"), name, "d", [d]) for d in days[:4]))
    assert sorted(tuple(r) for r in spark.table(name).select("d", "v").collect()) == [(d, int(i < 4)) for i, d in enumerate(days)]


def test_append_takes_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_evolving(spark.createDataFrame([(1,)], "a int"), path)
    tables.append_evolving(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert sorted(tuple(r) for r in tables.read_evolving(spark, path).select("a", "b").collect()) == [(1, None), (2, "x")]


def test_preview_is_repeatable(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in tables.preview(df, "id", 3).collect()] == [0, 1, 2]


def test_append_to_a_table_refuses_other_types(spark, layers):
    name = f"{layers}bronze.corredores"
    tables.create_table(spark, name, schemas.BRONZE["corredores"])
    with pytest.raises(PySparkException):
        spark.createDataFrame([("x", "y", "z")], "cc string, nc string, more string").write.mode("append").saveAsTable(name)


def test_tasks_keep_to_a_common_rate():
    """Slow, late and retrying tasks, each with a clock of its own in place of waiting, share the slots of a second."""
    sent = []
    for task in range(4):
        now = [100.0 + 3 * (task == 1)]  # the second starts late

        def sleep(seconds):
            now[0] += seconds

        pace = sweep.Pace(5, 4, task, clock=lambda: now[0], sleep=sleep)
        while now[0] < 120:
            pace.wait()
            sent.append(now[0])
            now[0] += 2.5 if task == 2 and len(sent) % 7 == 0 else 0.01
    sent.sort()
    assert min(b - a for a, b in zip(sent, sent[1:])) > 1 / 5 - 1e-6
    assert len(sent) > 60


def test_a_sweep_waits_for_its_slots(spark):
    def fetch(key):
        if key == 3:
            raise TimeoutError("slow")
        return "{}x"

    keys = spark.createDataFrame([(i,) for i in range(6)], "cp int")
    start = time.perf_counter()
    got = sweep.sweep(keys, "cp", fetch, tasks=1, attempts=3, wait_seconds=0, per_second=5).collect()
    assert time.perf_counter() - start > 7 / 5  # six keys and two retries
    assert {r.status for r in got} == {"ok", "failed"}
    with pytest.raises(ValueError):
        sweep.Pace(0, 1, 0)
