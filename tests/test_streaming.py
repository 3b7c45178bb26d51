"""Streams fed file by file against their batch forms."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from transitloom import testviews as tv
from transitloom.plans import gold, silver
from transitloom.schemas import columns
from transitloom.sources import documents, landing
from transitloom.streaming import positions as live
from transitloom.streaming import state

RAW = "p string, ta string, dt_ingestao timestamp, cl int, py double, px double, sl int, a boolean"


def rows(df, columns=None):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


class Feed:
    """A folder a stream reads; each ``add`` is one file, read as one micro-batch run."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.all = spark, str(folder), schema, []

    def add(self, data, run):
        self.all += data
        self.spark.createDataFrame(data, self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        run()

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.folder)

    def batch(self):
        return self.spark.createDataFrame(self.all, self.schema)


def signals(rng, start, n, ingest):
    made = []
    for i in range(n):
        at = start + timedelta(seconds=30 * i)
        made.append((str(rng.randrange(5)), at.strftime("%Y-%m-%dT%H:%M:%SZ"), ingest, rng.randrange(3),
                     rng.random(), rng.random(), rng.choice([1, 2, None]), rng.choice([True, False, None])))
    return made


def test_first_signal_is_the_batch_one_whatever_the_arrival_order(spark, tmp_path):
    rng = random.Random(5)
    feed = Feed(spark, tmp_path / "raw", RAW)
    out, late, checkpoint = (str(tmp_path / n) for n in ("out", "late", "checkpoint"))

    def run():
        live.keep_fact(feed.stream(), out, late, checkpoint).awaitTermination()
        got = live.fact_so_far(spark, out)
        want = silver.position_fact(feed.batch())
        assert rows(got, want.columns) == rows(want)  # after every batch, open signals included

    start = datetime(2024, 1, 1, 12)
    first = signals(rng, start, 60, datetime(2024, 1, 1, 13))
    again = [(p, ta, datetime(2024, 1, 1, 14), 9, 9.0, 9.0, 1, True) for p, ta, *_ in first]
    tied = [(p, ta, datetime(2024, 1, 1, 13), cl, py + 1, px, sl, a) for p, ta, _, cl, py, px, sl, a in first[:20]]
    feed.add(again[:40] + first[:10], run)  # later ingests arrive before the first ones
    feed.add(first[10:] + tied, run)
    feed.add(again[40:], run)
    feed.add(signals(rng, start + timedelta(hours=30), 10, datetime(2024, 1, 1, 18)), run)
    bad = [(str(i % 3), None if i % 2 else "soon", datetime(2024, 1, 1, 19), 1, 0.0, 0.0, 1, True) for i in range(8)]
    feed.add(bad, run)  # no time, or none that parses
    feed.add(signals(rng, start - timedelta(hours=3), 5, datetime(2024, 1, 1, 19)) + bad[:3], run)  # late
    assert live.late_counts(spark, late).first()[:] == (70 + 60 + 20 + 8 + 5 + 3, 5, 11)


@pytest.fixture
def days(spark, sf_dir):
    """The fact in time order, cut into five files."""
    fact = tv.view(spark, sf_dir, "fact")
    data = [tuple(r) for r in fact.orderBy("data_hora_sp").collect()]
    cuts = [0, 300, 301, 550, 900, len(data)]
    return fact, [data[a:b] for a, b in zip(cuts, cuts[1:])]


def test_snapshot_stream(spark, tmp_path, days):
    fact, parts = days
    feed = Feed(spark, tmp_path / "fact", fact.schema)
    state = str(tmp_path / "state")
    for part in random.Random(2).sample(parts, len(parts)):  # order of arrival does not matter
        feed.add(part, lambda: live.keep_snapshot(feed.stream(), state, str(tmp_path / "checkpoint")).awaitTermination())
    got = live.latest_state(spark, state)
    assert rows(got, fact.columns) == rows(gold.fleet_snapshot(fact))


@pytest.mark.parametrize("width", [3600, gold.SLICE_SECONDS])
def test_speed_stream(spark, tmp_path, days, width):
    fact, parts = days
    feed = Feed(spark, tmp_path / "fact", fact.schema)
    speeds, late, state = (str(tmp_path / n) for n in ("speeds", "late", "state"))

    def run():
        live.keep_speeds(feed.stream(), speeds, late, state, str(tmp_path / "checkpoint"), width).awaitTermination()

    for part in parts:
        feed.add(part, run)
    want = gold.ping_speed(fact)
    assert rows(live.speeds_so_far(spark, speeds), want.columns) == rows(want)
    assert live.latest_state(spark, late).first()[:] == (fact.count(), 0, 0)
    # pings that come again are late, and pair like any others
    feed.add(parts[1] + parts[2][:10], run)
    assert rows(live.speeds_so_far(spark, speeds), want.columns) == rows(gold.ping_speed(feed.batch()))
    assert live.latest_state(spark, late).first()["late_pings"] == 11


def test_late_pings_are_paired_with_their_neighbours(spark, tmp_path):
    """Arrival in any order: within a day, before all others, on a day of their own, on both sides of idle days."""
    rng = random.Random(9)
    schema = ("data_hora_sp timestamp_ntz, prefixo_veiculo int, cod_linha int, latitude double, longitude double, "
              "sentido_desc string, is_acessivel boolean, data_referencia date")
    pings = []
    for vehicle in (1, 2, 3, None):
        for day in rng.sample(range(1, 20), 6):
            for _ in range(rng.randrange(1, 5)):
                at = datetime(2024, 1, day, rng.randrange(24), rng.randrange(60))
                pings.append((at, vehicle, rng.randrange(3), rng.random(), rng.random(), "Ida", True, at.date()))
    pings += [(None, 1, 1, 0.5, 0.5, "Ida", True, None), pings[0], (*pings[1][:2], 7, 0.1, 0.2, "Volta", None, pings[1][7])]
    rng.shuffle(pings)
    feed = Feed(spark, tmp_path / "fact", schema)
    speeds, late, folder, changes, windows = (str(tmp_path / n) for n in ("speeds", "late", "state", "changes", "windows"))
    held = {}

    def run():
        live.keep_speeds(feed.stream(), speeds, late, folder, str(tmp_path / "checkpoint"), changes=changes).awaitTermination()
        want = rows(gold.ping_speed(feed.batch()))
        assert rows(live.speeds_so_far(spark, speeds), gold.ping_speed(feed.batch()).columns) == want
        # adding up what the batches changed gives the same
        told = live.state.all_versions(spark, changes).groupBy(*live.CHANGES.names[:-1]).agg(F.sum("saldo").alias("n")).filter("n <> 0")
        assert sorted([tuple(r)[:-1] for r in told.collect() for _ in range(r.n)], key=str) == want
        now = {r for r in want}
        held["undone"] = held.get("undone", 0) + len([r for r in held.get("rows", ()) if r not in now])
        held["rows"] = want

    cuts = [0, 5, 12, 30, 31, 45, len(pings)]
    for a, b in zip(cuts, cuts[1:]):
        feed.add(pings[a:b], run)
    timed = [p for p in pings if p[0] and p[1]]
    pings_, late_, revised = live.latest_state(spark, late).first()
    assert pings_ == len(timed) and 0 < late_ < pings_ and revised >= held["undone"] > 0

    source = live.stream_rows(spark, live.CHANGES, f"{changes}/lote=*", files_per_batch=3)
    live.keep_windows(source, windows, str(tmp_path / "w_late"), str(tmp_path / "w_checkpoint")).awaitTermination()
    want = live.speed_windows(gold.ping_speed(feed.batch()))
    assert rows(live.windows_so_far(spark, windows), want.columns) == rows(want)


def test_a_repeated_batch_writes_the_same_files(spark, tmp_path, days):
    """Losing the last commit makes the stream run its last batch again."""
    fact, parts = days
    feed = Feed(spark, tmp_path / "fact", fact.schema)
    speeds, late, state = (str(tmp_path / n) for n in ("speeds", "late", "state"))

    def run():
        live.keep_speeds(feed.stream(), speeds, late, state, str(tmp_path / "checkpoint")).awaitTermination()

    def found():
        return rows(live.speeds_so_far(spark, speeds)), rows(live.latest_state(spark, late)), rows(live.latest_state(spark, f"{state}/veiculos"))

    for part in (parts[0], parts[2], parts[1] + parts[3][:50]):  # the last one brings a late ping
        feed.add(part, run)
    before = found()
    assert before[1][0][1] > 0
    lose_last_commit(tmp_path / "checkpoint")
    run()
    assert found() == before


def lose_last_commit(checkpoint):
    commits = sorted((checkpoint / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)


def test_a_batch_opens_the_days_it_touches(spark, tmp_path):
    """After many batches a day has one version, old ones are gone, and reading it opens its own files only."""
    folder = str(tmp_path / "parts")
    schema = columns("k int, dia date")
    days = [datetime(2024, 1, d).date() for d in range(1, 6)] + [None]
    for n in range(50):
        touched = [days[n % 6], days[0]]
        held = state.read_parts(spark, folder, schema, "dia", touched, below=n)
        new = held.unionByName(spark.createDataFrame([(n, d) for d in set(touched)], schema))
        state.put_parts(new.coalesce(1), folder, n, "dia", set(touched))
        state.expire_parts(spark, folder, n, "dia")
    want = {d: sorted(n for n in range(50) if d in (days[n % 6], days[0])) for d in days}
    for day in days:
        one = state.read_parts(spark, folder, schema, "dia", [day])
        assert sorted(r.k for r in one.collect()) == want[day] and {r.dia for r in one.collect()} == {day}
        assert len(one.inputFiles()) == 1
    assert state.read_parts(spark, folder, schema, "dia").count() == sum(map(len, want.values()))
    kept = list((tmp_path / "parts" / "dados").glob("lote=*/dia=*"))
    assert len(kept) <= 8 and len(list((tmp_path / "parts" / "ponteiros").glob("lote=*"))) == 2
    # the batch before, run again, still finds what it found the first time
    assert sorted(r.k for r in state.read_parts(spark, folder, schema, "dia", [days[0]], below=49).collect()) == list(range(49))


def test_sums_of_many_batches_lie_in_few_folders(spark, tmp_path):
    folder = str(tmp_path / "sums")

    def add(df):
        return df.groupBy("k").agg(F.sum("n").alias("n"))

    for n in range(203):
        state.put_folded(spark.createDataFrame([(n % 3, 1)], "k int, n bigint").coalesce(1), folder, n, add)
        if n in (0, 8, 9, 10, 98, 99, 100, 202):
            found = state.folded(spark, folder)
            assert rows(add(found)) == sorted((k, len(range(k, n + 1, 3))) for k in range(min(3, n + 1)))
            assert len({f.rpartition("/")[0] for f in found.inputFiles()}) == sum(map(int, str(n + 1)))
    assert len(list((tmp_path / "sums").glob("nivel=*/lote=*"))) <= 2 * sum(map(int, "203"))
    # a batch run again overwrites its own folders
    state.put_folded(spark.createDataFrame([(202 % 3, 1)], "k int, n bigint"), folder, 202, add)
    assert rows(add(state.folded(spark, folder))) == [(k, len(range(k, 203, 3))) for k in range(3)]


def test_windows_are_those_of_the_batch_after_every_part(spark, tmp_path, days):
    fact, parts = days
    speeds = gold.ping_speed(fact)
    data = [tuple(r) for r in speeds.orderBy("data_hora_sp").collect()]
    feed = Feed(spark, tmp_path / "speeds", speeds.schema)
    out, late = str(tmp_path / "windows"), str(tmp_path / "late")
    keys = ["inicio", "fim", "cod_linha", "pings", "pings_em_movimento", F.round("velocidade_media", 6)]

    def run():
        live.keep_windows(feed.stream(), out, late, str(tmp_path / "checkpoint")).awaitTermination()
        assert rows(live.windows_so_far(spark, out), keys) == rows(live.speed_windows(feed.batch()), keys)

    feed.add(data[200:], run)
    feed.add(data[:200], run)
    newest = data[-1][0] - timedelta(hours=1)
    assert live.late_counts(spark, late).first()[:] == (len(data), sum(r[0] < newest for r in data[:200]), 0)


def test_old_versions_go_and_another_stream_is_refused(spark, tmp_path, days):
    fact, parts = days
    feed = Feed(spark, tmp_path / "fact", fact.schema)
    folder = str(tmp_path / "state")

    def run(checkpoint="checkpoint"):
        live.keep_snapshot(feed.stream(), folder, str(tmp_path / checkpoint)).awaitTermination()

    for part in parts:
        feed.add(part, run)
    assert state.versions(spark, folder) == [3, 4]
    with pytest.raises(Exception, match="state of another stream"):
        run("another")
    assert rows(live.latest_state(spark, folder), fact.columns) == rows(gold.fleet_snapshot(fact))


def test_landed_documents_stream(spark, tmp_path, sf_dir):
    docs = tv.position_docs(spark, sf_dir).repartition(3)
    landing.land_raw(docs, str(tmp_path / "landed"))
    stream = documents.positions(landing.stream_landed(spark, str(tmp_path / "landed"), files_per_batch=1))
    out = str(tmp_path / "out")
    live.append_to(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
    want = documents.positions(docs)
    assert rows(spark.read.schema(stream.schema).parquet(out), want.columns) == rows(want)
