"""Position path as Structured Streaming.

Each query gives what its batch form gives on the same rows, after every micro-batch, in whatever order they arrive and
with nothing left out: open signals and open windows are published and revised as more arrives, rows without a time
stay, and rows that come late are merged like any others and counted. The speed of the ping after a late one is
published anew, and the change reaches the windows.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from transitloom.functions.clock import LOCAL_ZONE, instant, local_clock
from transitloom.operators.ranking import first_per_key
from transitloom.plans import gold
from transitloom.plans.silver import clean_positions
from transitloom.schemas import columns
from transitloom.streaming import state

_PING_STATE = ["data_hora_sp", "prefixo_veiculo", "cod_linha", "latitude", "longitude", "sentido_desc",
               "is_acessivel", "data_referencia"]
_PING_DDL = ("data_hora_sp timestamp_ntz, prefixo_veiculo int, cod_linha int, latitude double, longitude double, "
             "sentido_desc string, is_acessivel boolean, data_referencia date")
_SIGNAL = ["p", "ta", "dt_ingestao", "cl", "py", "px", "sl", "a"]
#: Files that a micro-batch reads, so that a backlog comes in bounded parts.
FILES_PER_BATCH = 1000


def stream_rows(spark: SparkSession, schema: T.StructType, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A folder of parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a stream over everything available now, appending to a folder."""
    return (
        stream.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _each_batch(stream: DataFrame, step, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# -- late rows ------------------------------------------------------------------------------------

_COUNTS = "rows bigint, late bigint, untimed bigint, newest timestamp"


def _count_late(rows: DataFrame, time: str, folder: str, batch_id: int, delay: str) -> None:
    """Add up rows, those older than the newest time of earlier batches less the delay, and those without a time."""
    spark = rows.sparkSession
    known = state.before(spark, folder, batch_id, _COUNTS).agg(
        *(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("rows", "late", "untimed")), F.max("newest").alias("newest"))
    limit = known.select(F.col("newest") - F.expr(f"interval {delay}")).scalar()
    # one row of earlier counts for one row of new ones: kept apart from the rows themselves
    new = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(time) < limit).alias("late"),
        F.count_if(F.col(time).isNull()).alias("untimed"), F.max(time).alias("newest"))
    state.put(new.unionByName(known).agg(
        *(F.sum(c).alias(c) for c in ("rows", "late", "untimed")), F.max("newest").alias("newest")), folder, batch_id)
    state.expire(spark, folder, batch_id)


def late_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, late rows and rows without a time of all batches so far."""
    return state.latest(spark, folder).drop("newest")


# -- fact: the first copy of every signal, by day --------------------------------------------------
#
# A batch touches the days of its signals. It merges them with what those days held, which it opens by their pointers, and
# writes them anew under its own number. Rows without a time are a day of their own.

_FACT = columns(
    "p string, ta string, dt_ingestao timestamp, cl int, py double, px double, sl int, a boolean, dia date")


def keep_fact(raw: DataFrame, folder: str, late: str, checkpoint: str, delay: str = "1 hour",
              zone: str = LOCAL_ZONE) -> StreamingQuery:
    """Maintain the earliest-ingested copy of each (vehicle, signal time); read it with :func:`fact_so_far`."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state.start(spark, f"{folder}/ponteiros", batch_id)
        rows = batch.select(*_SIGNAL, instant(F.col("ta")).alias("signal"))
        _count_late(rows, "signal", late, batch_id, delay)
        new = rows.withColumn("dia", F.to_date(local_clock(F.col("signal"), zone))).drop("signal")
        days = state.values_of(new, "dia")
        held = state.read_parts(spark, folder, _FACT, "dia", days, below=batch_id)
        first = first_per_key(new.select(*_FACT.names).unionByName(held), ["p", "ta"], "dt_ingestao")
        state.put_parts(first.hint("rebalance", "dia"), folder, batch_id, "dia", days)
        state.expire_parts(spark, folder, batch_id, "dia")

    return _each_batch(raw, merge, checkpoint)


def fact_so_far(spark: SparkSession, folder: str, zone: str = LOCAL_ZONE, days: Iterable[date] | None = None) -> DataFrame:
    """Cleaned fact rows of all signals seen, or of some days."""
    return clean_positions(state.read_parts(spark, folder, _FACT, "dia", days), zone)


# -- windows ---------------------------------------------------------------------------------------
#
# Speeds have one decimal, so their sums are exact decimals: parts add up to the same number in any order, and a
# retracted speed leaves nothing behind.

def window_parts(speeds: DataFrame, width: str = "15 minutes", low: float = gold.MIN_SPEED,
                 high: float = gold.MAX_SPEED) -> DataFrame:
    """Sums by line and tumbling window; sums of several parts add up.

    ``saldo``, if there, tells how often a row holds; it is negative for a speed that is taken back.
    """
    moving = gold.is_plausible(F.col("velocidade_kmh"), low, high)
    times = F.col("saldo") if "saldo" in speeds.columns else F.lit(1)
    parts = speeds.withColumn("momento", F.col("data_hora_sp").cast("timestamp")).withColumns({
        "janela": F.window("momento", width), "pings": times.cast("bigint"),
        "pings_em_movimento": F.when(moving, times).otherwise(0).cast("bigint"),
        "soma": F.when(moving, F.col("velocidade_kmh").cast("decimal(9,1)") * times.cast("decimal(9,0)")).cast("decimal(28,1)"),
    })
    return _summed(parts.select(
        F.col("janela.start").alias("inicio"), F.col("janela.end").alias("fim"), "cod_linha", "pings", "pings_em_movimento", "soma"))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("inicio", "fim", "cod_linha").agg(
        F.sum("pings").alias("pings"), F.sum("pings_em_movimento").alias("pings_em_movimento"),
        F.sum("soma").cast("decimal(28,1)").alias("soma"))


def add_windows(parts: DataFrame) -> DataFrame:
    """Pings, moving pings and mean speed by line and window; windows whose pings were all taken back are gone."""
    mean = F.try_divide(F.col("soma").cast("double"), F.col("pings_em_movimento").cast("double"))
    return _summed(parts).filter("pings <> 0").withColumn("velocidade_media", mean).drop("soma")


def speed_windows(speeds: DataFrame, width: str = "15 minutes") -> DataFrame:
    """The windows of a batch."""
    return add_windows(window_parts(speeds, width))


def keep_windows(speeds: DataFrame, folder: str, late: str, checkpoint: str, width: str = "15 minutes",
                 delay: str = "1 hour") -> StreamingQuery:
    """Add every batch's sums to the windows; read them with :func:`windows_so_far`, open ones included."""
    def add(batch: DataFrame, batch_id: int) -> None:
        state.start(batch.sparkSession, f"{folder}/nivel=0", batch_id)
        timed = batch.withColumn("momento", F.col("data_hora_sp").cast("timestamp"))
        _count_late(timed, "momento", late, batch_id, delay)
        state.put_folded(window_parts(batch, width), folder, batch_id, _summed)

    return _each_batch(speeds, add, checkpoint)


def windows_so_far(spark: SparkSession, folder: str) -> DataFrame:
    return add_windows(state.folded(spark, folder))


# -- snapshot --------------------------------------------------------------------------------------

def keep_snapshot(fact: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Maintain the last ping of every vehicle; read it with :func:`latest_state`."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state.start(spark, folder, batch_id)
        rows = batch.select(*_PING_STATE)
        known = state.before(spark, folder, batch_id, rows.schema)
        state.put(gold.fleet_snapshot(known.unionByName(rows)), folder, batch_id)
        state.expire(spark, folder, batch_id)

    return _each_batch(fact, merge, checkpoint)


# -- speeds ----------------------------------------------------------------------------------------
#
# Pings are kept by day, ``pings/dia=d/lote=n``, and never rewritten. ``veiculos`` has one row per vehicle: its newest ping
# and the days on which it has any.
#
# A ping newer than all of its vehicle pairs with the newest one: its speed is added to ``linhas/dia=d/lote=n``. A late
# ping changes its own speed and that of the ping after it, which may lie on a later day. So the vehicle's day is paired
# anew, and the next day that it has: the pings of those vehicle-days are read, and the last ping before each. What comes
# out is their newer version, and ``substituidos/dia=d/lote=n`` says which vehicle-days it replaces.

_VEHICLE = "prefixo_veiculo"
_FLEET = _PING_DDL + ", dias array<date>"
_REPLACED = "prefixo_veiculo int, dia date"
_PINGS = columns(_PING_DDL + ", dia date")
_SPEEDS = columns(
    "data_hora_sp timestamp_ntz, prefixo_veiculo int, cod_linha int, latitude double, longitude double, sentido_desc string, "
    "data_referencia date, lat_prev double, lon_prev double, time_prev timestamp_ntz, dist_km double, tempo_horas double, "
    "velocidade_kmh double, dia date")
#: What a batch changes: speeds with the number of times that they hold more, or less.
CHANGES = T.StructType([*(f for f in _SPEEDS if f.name != "dia"), T.StructField("saldo", T.IntegerType())])
_REPORT = "pings bigint, late_pings bigint, revised bigint"


def keep_speeds(fact: DataFrame, speeds: str, late: str, folder: str, checkpoint: str,
                slice_seconds: int = gold.SLICE_SECONDS, changes: str | None = None) -> StreamingQuery:
    """Speed of every ping against the vehicle's previous one, in whatever order pings arrive.

    Read the speeds with :func:`speeds_so_far`. ``late`` adds up the pings, those not newer than what the vehicle had
    before their batch, and the published speeds that such a ping made untrue. ``changes``, if given, gets what each
    batch changes, one folder per batch: speeds with ``saldo``, which is negative where they no longer hold.
    """
    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state.start(spark, f"{folder}/veiculos", batch_id)
        rows = batch.select(*(F.col(f.name).cast(f.dataType) for f in _PINGS if f.name != "dia")).filter(
            F.col(_VEHICLE).isNotNull() & F.col("data_hora_sp").isNotNull()).withColumn("dia", F.to_date("data_hora_sp"))
        state.add_days(rows.hint("rebalance", "dia"), f"{folder}/pings", batch_id)
        days = state.values_of(rows, "dia")
        rows = state.read_days(spark, f"{folder}/pings", _PINGS, days).filter(F.col(state.VERSION) == batch_id).drop(state.VERSION)

        known = state.before(spark, f"{folder}/veiculos", batch_id, _FLEET)
        is_late = F.coalesce(F.col("data_hora_sp") <= F.col("stored"), F.lit(False))
        marked = rows.join(known.select(_VEHICLE, F.col("data_hora_sp").alias("stored")), _VEHICLE, "left").withColumn("late", is_late)
        state.put(_fleet(known, rows), f"{folder}/veiculos", batch_id)
        both = gold.ping_speed(marked.filter(~F.col("late")).select(*_PING_STATE), slice_seconds, carried=known.drop("dias"))
        both, replaced = both.withColumn("dia", F.to_date("data_hora_sp")), None
        if not marked.filter("late").isEmpty():
            state.put(_again(marked.filter("late"), state.latest(spark, f"{folder}/veiculos")), f"{folder}/afetados", batch_id)
            again = state.latest(spark, f"{folder}/afetados")
            replaced = again.select(_VEHICLE, "dia")
            both = both.join(replaced, [_VEHICLE, "dia"], "left_anti").unionByName(
                _paired_again(spark, folder, again, batch_id, slice_seconds))
            state.add_days(replaced, f"{speeds}/substituidos", batch_id)
        state.add_days(both.hint("rebalance", "dia"), f"{speeds}/linhas", batch_id)

        zero = F.lit(0).cast("bigint")
        report = marked.agg(F.count(F.lit(1)).alias("pings"), F.count_if("late").alias("late_pings")).withColumn("revised", zero)
        if changes or replaced is not None:
            changed = _changes(spark, speeds, replaced, days, batch_id)
            if changes:
                state.put(changed, changes, batch_id)
                changed = spark.read.schema(changed.schema).parquet(f"{changes}/{state.VERSION}={batch_id}")
            undone = changed.agg(F.coalesce(F.sum(F.greatest(-F.col("saldo"), zero)), zero).alias("revised"))
            report = report.unionByName(undone.withColumns({"pings": zero, "late_pings": zero}))
        report = report.unionByName(state.before(spark, late, batch_id, _REPORT))
        state.put(report.agg(*(F.sum(c).alias(c) for c in ("pings", "late_pings", "revised"))), late, batch_id)
        for kept in (late, f"{folder}/veiculos", f"{folder}/afetados"):
            state.expire(spark, kept, batch_id)

    return _each_batch(fact, advance, checkpoint)


def _fleet(known: DataFrame, rows: DataFrame) -> DataFrame:
    """The newest ping of every vehicle and the days it has."""
    newest = gold.last_pings(known.drop("dias").unionByName(rows.drop("dia")), _VEHICLE)
    none = F.array().cast("array<date>")
    return newest.join(known.select(_VEHICLE, "dias"), _VEHICLE, "left").join(
        rows.groupBy(_VEHICLE).agg(F.collect_set("dia").alias("novos")), _VEHICLE, "left",
    ).withColumn("dias", F.array_sort(F.array_union(F.coalesce("dias", none), F.coalesce("novos", none)))).drop("novos")


def _again(late: DataFrame, fleet: DataFrame) -> DataFrame:
    """(vehicle, dia, antes, fora): days of late pings and each vehicle's next day after them; ``antes`` is the day that
    the vehicle has before, ``fora`` whether that one is not paired anew."""
    touched = late.groupBy(_VEHICLE).agg(F.collect_set("dia").alias("tocados")).join(fleet.select(_VEHICLE, "dias"), _VEHICLE)
    after = F.transform("tocados", lambda day: F.get(F.filter("dias", lambda other: other > day), F.lit(0)))
    touched = touched.withColumn("todos", F.array_union("tocados", F.array_compact(after)))
    before = F.array_max(F.filter("dias", lambda other: other < F.col("dia")))
    each = touched.select(_VEHICLE, "dias", "todos", F.explode("todos").alias("dia")).withColumn("antes", before)
    outside = F.col("antes").isNotNull() & ~F.coalesce(F.array_contains("todos", F.col("antes")), F.lit(False))
    return each.select(_VEHICLE, "dia", "antes", outside.alias("fora"))


def _paired_again(spark: SparkSession, folder: str, again: DataFrame, batch_id: int, slice_seconds: int) -> DataFrame:
    """Speeds of the vehicle-days to be paired anew, from all their pings and the last one before each."""
    pair, pings = [_VEHICLE, "dia"], f"{folder}/pings"
    rows = state.read_days(spark, pings, _PINGS, state.values_of(again, "dia"), batch_id).join(again, pair, "left_semi")
    ends = again.filter("fora").select(_VEHICLE, F.col("antes").alias("dia")).distinct()
    ends = state.read_days(spark, pings, _PINGS, state.values_of(ends, "dia"), batch_id).join(ends, pair, "left_semi")
    found = gold.ping_speed(rows.select(*_PING_STATE), slice_seconds, carried=gold.last_pings(ends.select(*_PINGS.names), *pair))
    return found.withColumn("dia", F.to_date("data_hora_sp"))


def _changes(spark: SparkSession, speeds: str, replaced: DataFrame | None, days: list[date], batch_id: int) -> DataFrame:
    """What a batch makes of the published speeds: rows with the number of times that they hold more, or less."""
    again = [] if replaced is None else state.values_of(replaced, "dia")
    new = state.read_days(spark, f"{speeds}/linhas", _SPEEDS, {*days, *again}).filter(F.col(state.VERSION) == batch_id)
    new = new.select(*CHANGES.names[:-1], F.lit(1).alias("saldo"))
    if replaced is None:
        return new
    old = speeds_so_far(spark, speeds, again, batch_id - 1).join(replaced, [_VEHICLE, "dia"], "left_semi")
    both = new.unionByName(old.select(*CHANGES.names[:-1], F.lit(-1).alias("saldo")))
    return both.groupBy(*CHANGES.names[:-1]).agg(F.sum("saldo").cast("int").alias("saldo")).filter("saldo <> 0")


def speeds_so_far(spark: SparkSession, speeds: str, days: Iterable[date] | None = None, upto: int | None = None) -> DataFrame:
    """The speeds that hold, of some days only if they are named, and as they stood after a batch."""
    days = None if days is None else list(days)
    rows = state.read_days(spark, f"{speeds}/linhas", _SPEEDS, days, upto)
    since = state.read_days(spark, f"{speeds}/substituidos", _REPLACED, days, upto).groupBy(_VEHICLE, "dia").agg(
        F.max(state.VERSION).alias("desde"))
    return rows.join(since, [_VEHICLE, "dia"], "left").filter(
        F.col("desde").isNull() | (F.col(state.VERSION) >= F.col("desde"))).select(*_SPEEDS.names)


latest_state = state.latest
