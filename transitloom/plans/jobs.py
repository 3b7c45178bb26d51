"""Jobs that read and write the layer tables: full rebuild and day-by-day increments."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom import schemas
from transitloom.functions.clock import run_stamp
from transitloom.operators.ranking import first_per_key
from transitloom.plans import gold, silver
from transitloom.session import remove_folder, shared_folder, side_by_side
from transitloom.sources import documents, gtfs, landing, sweep, tables

DAY = "data_referencia"


@dataclass(frozen=True)
class Layers:
    """Names of the layer schemas, e.g. prefix ``city_`` for city_bronze, city_silver, city_gold."""

    spark: SparkSession
    prefix: str = ""

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))


# bronze table -> parser of its documents, and whether each run replaces what was there
PARSERS = {
    "posicao_veiculos": (documents.positions, False),
    "buscar_linhas": (documents.lines, True),
    "buscar_linhas_sentido": (documents.lines, True),
    "buscar_paradas": (documents.stops, True),
    "paradas_por_corredor": (documents.stops, True),
    "paradas_por_linha": (documents.stops, False),
    "corredores": (documents.corridors, True),
    "empresas": (documents.companies, True),
    "previsao_chegada_parada": (documents.stop_forecast, False),
    "previsao_chegada_linha": (documents.line_forecast, False),
}
# fixed values: what a table holds, for the catalog
COMMENTS = {
    "posicao_veiculos": "Vehicle positions as reported", "buscar_linhas": "Lines found by search term",
    "buscar_linhas_sentido": "Lines found by term and direction", "buscar_paradas": "Stops found by search term",
    "paradas_por_corredor": "Stops of each corridor", "paradas_por_linha": "Stops of each line", "corredores": "Corridors",
    "empresas": "Operating companies", "previsao_chegada_parada": "Expected arrivals by stop",
    "previsao_chegada_linha": "Expected arrivals by line",
}
# The day of the run that brought a row, and the run's part: positions are read by the first, sweeps replaced by the second.
INGEST_DAY, PART = "dia_ingestao", "execucao"
REPORT = "tabela string, documents bigint, unreadable bigint, wrong_shape bigint, rows bigint"


def ingest(layers: Layers, table: str, docs: DataFrame, run_time: datetime, origin: str | None = None,
           landing_root: str | None = None, part: str | None = None, adds: bool = False,
           parts: Sequence[str] | None = None) -> DataFrame:
    """Land documents, parse them and write the bronze table of one run; returns one row that tells how it went.

    ``docs`` has ``body`` and, for keyed requests, the key column of the table. The documents are evaluated once: landed under
    ``landing_root`` or else staged, and parsed and judged from there; the parsed rows are landed too. Columns the table does
    not know yet are added to it. ``part`` names the piece of a run that is written. A piece or run that is written again
    replaces its own documents and rows, whatever the first attempt has left. Several pieces are written at once if ``parts``
    names them and ``docs`` tells the piece of each document in the column ``execucao``. ``adds`` keeps the rows of a table
    that a run would replace. Documents that cannot be parsed are kept in the quarantine table, from which :func:`replay` takes them.
    """
    parse, replaces = PARSERS[table]
    spark = layers.spark
    keys = [c for c in docs.columns if c != documents.BODY]
    staged = None
    path = f"{landing_root}/{table}/raw_{run_stamp(run_time)}" + (f"_{part}" if part else "")
    pieces = (PART, parts) if parts is not None else ()
    if landing_root and landing.land_raw(docs, path, keys, True, *pieces):
        docs = landing.read_landed(spark, path, docs.select(*keys).schema).select(documents.BODY, *keys)
        if pieces:
            docs = docs.filter(F.col(PART).isin(*parts))
    else:
        staged = shared_folder(spark, "documents")
        docs.select(documents.BODY, *keys).write.parquet(staged)
        docs = spark.read.schema(docs.select(documents.BODY, *keys).schema).parquet(staged)
    schema = schemas.with_audit(schemas.BRONZE[table])
    rows = parse(docs)
    if table == "buscar_paradas":
        # the same stop answers several search terms
        rows = first_per_key(rows, ["cp"])
    if origin is None and "arquivo_origem" not in rows.columns:
        origin = f"{table}_{run_stamp(run_time)}.json"
    rows = landing.stamp(rows, run_time, origin)
    rows = rows.select(*schema.names, *(c for c in rows.columns if c not in schema.names))
    by = INGEST_DAY if table == "posicao_veiculos" else PART if part is not None or pieces else None
    if by == INGEST_DAY:
        rows = rows.withColumn(INGEST_DAY, F.lit(run_time.date()))
    elif by == PART and not pieces:
        rows = rows.withColumn(PART, F.lit(part))
    name = layers.name("bronze", table)
    if replaces and part is None and not pieces and not adds:
        tables.drop_table(spark, name)
    if not spark.catalog.tableExists(name):
        tables.create_table(spark, name, T.StructType([*schema.fields, *(f for f in rows.schema if f.name not in schema.names)]), by)
        tables.comment_table(spark, name, COMMENTS[table])
    mine = F.col("dt_ingestao") == landing.moment(run_time)
    if by == PART:
        tables.replace_partitions(rows, name, PART, parts if pieces else [part])
    elif spark.table(name).filter(_of_run(by, run_time) & mine).isEmpty():
        tables.append_table(rows, name)
    else:
        _replace_run(spark, rows, name, by, run_time, mine)
    written = spark.table(name).filter(mine & (F.col(PART).isin(*(parts if pieces else [part])) if by == PART else _of_run(by, run_time)))
    if landing_root:
        landed = written.drop(*([by] if by and not pieces else []))
        landing.land_rows(landed, f"{landing_root}/{table}", f"{table}{'_' + part if part else ''}", run_time, *pieces)
    if table == "posicao_veiculos":
        _note_days(layers, written, run_time)
    body = F.col(documents.BODY)
    faults = docs.agg(F.count(F.lit(1)).alias("documents"), F.count_if(documents.is_unreadable(body)).alias("unreadable"),
                      F.count_if(documents.wrong_shape(body, parse.__name__)).alias("wrong_shape")).first()
    _refuse(layers, table, docs, run_time, part, faults.unreadable + faults.wrong_shape, parts)
    report = spark.createDataFrame([(table, *faults, written.count())], REPORT)
    if staged:
        remove_folder(spark, staged)
    return report


def _of_run(by: str | None, run_time: datetime) -> Column:
    return F.col(by) == F.lit(run_time.date()) if by == INGEST_DAY else F.lit(True)


def _replace_run(spark: SparkSession, rows: DataFrame, name: str, by: str | None, run_time: datetime, mine: Column) -> None:
    """Write a run's rows again: the other rows of its ingest day, or of the table, stay."""
    others = spark.table(name).filter(_of_run(by, run_time) & ~F.coalesce(mine, F.lit(False)))
    both = others.unionByName(rows, allowMissingColumns=True)
    if by:
        tables.replace_partitions(both, name, by, [run_time.date()])
    else:
        tables.replace_rows(both, name)


# -- quarantine: what could not be parsed, by the run that brought it ------------------------------

QUARANTINE, RUN = "quarentena", "execucao"
_REFUSED = T.StructType([
    *(T.StructField(n, T.StringType()) for n in ("tabela", "motivo", "origem", "corpo")),
    T.StructField("chaves", T.MapType(T.StringType(), T.StringType())), T.StructField("dt_ingestao", T.TimestampType()),
    T.StructField(RUN, T.StringType()),
])


def _keep_refused(layers: Layers, rows: DataFrame, runs: list[str], any_: bool) -> None:
    """Write the refused texts of some runs; without any, what an earlier attempt of the runs has left goes."""
    name = layers.name("bronze", QUARANTINE)
    if not layers.spark.catalog.tableExists(name):
        if not any_:
            return
        tables.create_table(layers.spark, name, _REFUSED, RUN)
    if any_ or not layers.spark.table(name).filter(F.col(RUN).isin(*runs)).isEmpty():
        tables.replace_partitions(rows.select(*_REFUSED.names), name, RUN, runs)


def _refuse(layers: Layers, table: str, docs: DataFrame, run_time: datetime, part: str | None, refused: int,
            parts: Sequence[str] | None = None) -> None:
    body, parse = F.col(documents.BODY), PARSERS[table][0].__name__
    why = F.when(documents.is_unreadable(body), F.lit("unreadable")).when(documents.wrong_shape(body, parse), F.lit("wrong shape"))
    run = f"{table}_{run_stamp(run_time)}"
    piece = F.lit(run + (f"_{part}" if part else "")) if parts is None else F.concat(F.lit(f"{run}_"), F.col(PART))
    runs = [run + (f"_{part}" if part else "")] if parts is None else [f"{run}_{p}" for p in parts]
    keys = [c for c in docs.columns if c != documents.BODY and (parts is None or c != PART)]
    none = F.lit(None).cast("string")
    rows = docs.select(
        F.lit(table).alias("tabela"), why.alias("motivo"), (F.col("arquivo_origem") if "arquivo_origem" in keys else none).alias("origem"),
        body.alias("corpo"), F.create_map(*(x for k in keys for x in (F.lit(k), F.col(k).cast("string")))).cast("map<string,string>").alias("chaves"),
        landing.moment(run_time).alias("dt_ingestao"), piece.alias(RUN)).filter(F.col("motivo").isNotNull())
    _keep_refused(layers, rows, runs, refused > 0)


def replay(layers: Layers, table: str, run_time: datetime, repair: Callable[[Column], Column] | None = None) -> DataFrame:
    """Parse a table's quarantined documents again and take those that succeed out of the quarantine.

    ``repair`` may mend their text; what the parsers have learnt since counts too. The documents that can be read are
    ingested as a run of their own with their request keys, so a replay that was interrupted may be repeated with the same
    ``run_time``. Returns one row (tabela, tried, replayed, remaining).
    """
    spark, name = layers.spark, layers.name("bronze", QUARANTINE)
    done = "tabela string, tried bigint, replayed bigint, remaining bigint"
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([(table, 0, 0, 0)], done)
    held = spark.table(name).filter((F.col("tabela") == table))
    body = repair(F.col("corpo")) if repair else F.col("corpo")
    good = ~documents.is_unreadable(body) & ~documents.wrong_shape(body, PARSERS[table][0].__name__)
    staged = shared_folder(spark, "replay")
    held.withColumns({"lido": F.coalesce(good, F.lit(False)), documents.BODY: body}).write.parquet(staged)
    tried = spark.read.parquet(staged)
    counts = tried.agg(F.count(F.lit(1)).alias("tried"), F.count_if("lido").alias("replayed")).first()
    if counts.replayed:
        keys = [r[0] for r in tried.select(F.explode(F.map_keys("chaves"))).distinct().collect()]  # names of columns
        kinds = {f.name: f.dataType for f in schemas.with_audit(schemas.BRONZE[table])}
        ready = tried.filter("lido").select(documents.BODY, *(
            F.col("chaves")[k].cast(kinds.get(k, T.StringType())).alias(k) for k in sorted(keys)))
        bronze = layers.name("bronze", table)
        by_part = spark.catalog.tableExists(bronze) and PART in spark.table(bronze).columns
        ingest(layers, table, ready, run_time, part=f"replay_{run_stamp(run_time)}" if by_part else None, adds=True)
        runs = [r[0] for r in tried.filter("lido").select(RUN).distinct().collect()]  # one row per run that refused some
        rest = tried.filter(F.col(RUN).isin(runs) & ~F.col("lido")).select(*_REFUSED.names)
        tables.replace_partitions(rest, name, RUN, runs)
    remove_folder(spark, staged)
    return spark.createDataFrame([(table, counts.tried, counts.replayed, counts.tried - counts.replayed)], done)


def _note_days(layers: Layers, written: DataFrame, run_time: datetime) -> None:
    """Note on which local days the signals of a run lie: a refresh of those days reads the ingest days noted for them."""
    name = layers.name("bronze", "dias_sinal")
    days = written.select(silver.signal_day().alias(DAY)).distinct().withColumn(INGEST_DAY, F.lit(run_time.date()))
    if not layers.spark.catalog.tableExists(name):
        tables.create_table(layers.spark, name, days.schema)
    days.coalesce(1).write.insertInto(name)


# bronze table -> key column the request stamps on its rows (none where the document has it) and
# prefix of the lineage name (fixed values)
SWEEPS = {
    "paradas_por_corredor": ("cod_corredor", "paradas_corredor"),
    "paradas_por_linha": ("cod_linha", "paradas_linha"),
    "previsao_chegada_linha": ("cod_linha", "batch"),
    "previsao_chegada_parada": (None, "gtfs_batch"),
}


def ingest_sweep(layers: Layers, table: str, keys: DataFrame, fetch: Callable[[object], str | None],
                 run_time: datetime, work: str, lot_size: int = 500, tasks: int = 32,
                 lots_per_commit: int = 8, resume: bool = False, landing_root: str | None = None, **options) -> DataFrame:
    """Ask for every key in lots, keep the replies under ``work`` and write the bronze table, each commit as a part of its own.

    ``keys`` has one column of distinct integers. ``resume`` goes on with an interrupted sweep in the same ``work``
    folder and asks again for the keys that failed. A commit that is repeated replaces its own rows, so nothing is
    written twice. Returns how the requests ended, the last answer of each key counting.
    """
    (key,) = keys.columns
    spark = layers.spark
    if not resume:
        sweep.write_lots(keys, key, lot_size, f"{work}/requests")
        if PARSERS[table][1]:
            tables.drop_table(spark, layers.name("bronze", table))
    else:
        sweep.ask_again(spark, f"{work}/requests", key, f"{work}/replies")

    def write(replies: DataFrame, commits: list[int]) -> None:
        write_commit(layers, table, replies, key, commits, lot_size, run_time, landing_root)

    sweep.sweep_lots(
        spark, f"{work}/requests", key, fetch, f"{work}/replies", f"{work}/checkpoint", tasks,
        lots_per_commit, written=write, **options,
    ).awaitTermination()
    return sweep.attempts_summary(sweep.last_replies(spark, f"{work}/replies", key))


#: Commits that one write takes.
COMMITS_AT_ONCE = 512


def write_commit(layers: Layers, table: str, replies: DataFrame, key: str, commit: int | Sequence[int], lot_size: int,
                 run_time: datetime, landing_root: str | None = None) -> DataFrame:
    """Write the replies of one commit of a sweep, or of several by their column ``commit``.

    Writing a commit again replaces what it wrote, and nothing of the others. Returns one row per COMMITS_AT_ONCE of them.
    """
    stamped, prefix = SWEEPS[table]
    stamp = run_stamp(run_time)
    if isinstance(commit, int):
        replies, commit = replies.withColumn("commit", F.lit(commit)), [commit]
    reports = []
    for start in range(0, len(commit), COMMITS_AT_ONCE):
        some = [int(c) for c in commit[start:start + COMMITS_AT_ONCE]]
        docs = replies.filter(F.col("commit").isin(*some) & (F.col("status") == "ok")).select(
            documents.BODY, *([F.col(key).alias(stamped)] if stamped else []),
            sweep.lot_origin(F.col("lote"), lot_size, stamp, prefix).alias("arquivo_origem"),
            F.concat(F.lit(f"{stamp}_"), F.lpad(F.col("commit").cast("string"), F.greatest(F.lit(5), F.length(F.col("commit").cast("string"))), F.lit("0"))).alias(PART),
        )
        reports += ingest(layers, table, docs, run_time, landing_root=landing_root, parts=[f"{stamp}_{c:05d}" for c in some]).collect()
    return layers.spark.createDataFrame(reports, REPORT)


def ingest_schedule(layers: Layers, folder: str, run_time: datetime) -> DataFrame:
    """Load the static files into bronze; returns one status row per file. Lines with refused cells are quarantined."""
    def write(name: str, rows: DataFrame) -> int:
        table = layers.name("bronze", f"gtfs_{name}")
        tables.replace_table(rows, table)
        return layers.spark.table(table).count()

    status = gtfs.load_files(layers.spark, folder, write, run_time)
    for row in status.filter("rejected is not null").collect():  # one row per file
        if row.rejected:
            refused = gtfs.rejected_cells(layers.spark, folder, row.file).select(
                F.lit(f"gtfs_{row.file}").alias("tabela"), F.concat(F.lit("cell "), F.col("column")).alias("motivo"), F.col("file").alias("origem"),
                F.col("line").alias("corpo"), F.create_map(F.col("column"), F.col("cell")).alias("chaves"), landing.moment(run_time).alias("dt_ingestao"))
        else:
            refused = layers.spark.createDataFrame([], _REFUSED).drop(RUN)
        run = f"gtfs_{row.file}_{run_stamp(run_time)}"
        _keep_refused(layers, refused.withColumn(RUN, F.lit(run)), [run], bool(row.rejected))
    return status


def build_silver(layers: Layers) -> None:
    """Rebuild the fact and the dimensions from all of bronze."""
    tables.replace_table(
        silver.position_fact(layers.read("bronze", "posicao_veiculos")),
        layers.name("silver", "fato_posicao_veiculos"), DAY,
    )
    build_dimensions(layers)


def refresh_fact(layers: Layers, since: date, until: date | None = None) -> list[date | None]:
    """Bring the fact up to date with what was ingested from ``since`` to ``until`` (both included; open by default).

    Every local day that one of those signals lies on is rebuilt from all its signals, whenever they were ingested, so the
    result is that of a full rebuild. The days come from the notes of the ingests, and so do the ingest days that are
    read for them. Returns the days rebuilt.
    """
    noted = layers.read("bronze", "dias_sinal").distinct()
    recent = F.col(INGEST_DAY) >= F.lit(since)
    if until is not None:
        recent = recent & (F.col(INGEST_DAY) <= F.lit(until))
    days = [r[0] for r in noted.filter(recent).select(DAY).distinct().collect()]
    if not days:
        return []
    touched = _is_one_of(F.col(DAY), days)
    sources = [r[0] for r in noted.filter(touched).select(INGEST_DAY).distinct().collect()]
    raw = layers.read("bronze", "posicao_veiculos").filter(F.col(INGEST_DAY).isin(sources)).filter(_is_one_of(silver.signal_day(), days))
    tables.replace_partitions(silver.position_fact(raw), layers.name("silver", "fato_posicao_veiculos"), DAY, days)
    return sorted(days, key=lambda d: (d is not None, d))


def _is_one_of(column: Column, days: list[date | None]) -> Column:
    """Whether a day, or its absence, is in a list."""
    known = [d for d in days if d is not None]
    among = column.isin(known) if known else F.lit(False)
    return among | column.isNull() if None in days else F.coalesce(among, F.lit(False))


def build_dimensions(layers: Layers) -> None:
    tables.replace_table(
        silver.line_dimension(layers.read("bronze", "buscar_linhas"), layers.read("bronze", "gtfs_routes")),
        layers.name("silver", "dim_linhas"),
    )
    tables.replace_table(
        silver.company_dimension(layers.read("bronze", "empresas")), layers.name("silver", "dim_empresas")
    )
    tables.replace_table(
        silver.route_map(layers.read("bronze", "gtfs_shapes"), layers.read("bronze", "gtfs_trips")),
        layers.name("silver", "mapa_shapes_gtfs"),
    )


def build_gold(layers: Layers) -> None:
    """Rebuild every measure from all of silver."""
    fact, lines = layers.read("silver", "fato_posicao_veiculos"), layers.read("silver", "dim_linhas")
    side_by_side(
        layers.spark,
        lambda: tables.replace_table(gold.line_speed(fact, lines), layers.name("gold", "velocidade_linhas"), DAY),
        lambda: tables.replace_table(gold.accessibility(fact, lines), layers.name("gold", "acessibilidade"), DAY),
        lambda: tables.replace_table(
            gold.fleet_snapshot(fact), layers.name("gold", "snapshot_frota_atual"), same_schema=True),
        lambda: build_profile(layers),
    )


def build_profile(layers: Layers) -> None:
    tables.replace_table(
        gold.route_profile(layers.read("bronze", "gtfs_shapes"), layers.read("bronze", "gtfs_trips")),
        layers.name("gold", "perfil_rota_estatico"),
    )


LAST_PINGS, UNTIL = "ultimo_ping", "ate_dia"


def chained_days(layers: Layers) -> list[date]:
    """The days up to which last pings are stored, oldest first."""
    name = layers.name("silver", LAST_PINGS)
    if not layers.spark.catalog.tableExists(name):
        return []
    return sorted(r[0] for r in layers.spark.table(name).select(UNTIL).distinct().collect())  # one row per day


def _last_pings(layers: Layers, until: date) -> DataFrame:
    return layers.read("silver", LAST_PINGS).filter(F.col(UNTIL) == F.lit(until)).drop(UNTIL)


def snapshot_as_of(layers: Layers, day: date) -> DataFrame:
    """The last ping of every vehicle up to a day, whatever the length of the history.

    It is what the chain of last pings holds for the newest stored day that is not later, and the fact of the days since:
    none if the day itself is stored. Before the first stored day the fact alone is read, up to the day.
    """
    fact = layers.read("silver", "fato_posicao_veiculos").filter(F.col(DAY) <= F.lit(day))
    stored = [d for d in chained_days(layers) if d <= day]
    if not stored:
        return gold.fleet_snapshot(fact)
    known = _last_pings(layers, stored[-1])
    if stored[-1] == day:
        return known
    return gold.fleet_snapshot(known.unionByName(fact.filter(F.col(DAY) > F.lit(stored[-1])).select(*known.columns)))


def repair_chain(layers: Layers, since: date) -> list[date]:
    """Bring the stored last pings up to date after days from ``since`` on were rebuilt; returns the days written.

    Each stored day follows from the one stored before it and the fact of the days between, so a day reads its own
    partitions only, and links before ``since`` stay.
    """
    days = chained_days(layers)
    known = [d for d in days if d < since]
    last, written = (known[-1] if known else None), []
    fact = layers.read("silver", "fato_posicao_veiculos")
    for day in [d for d in days if d >= since]:
        rows = fact.filter(F.col(DAY) <= F.lit(day))
        if last is not None:
            rows = rows.filter(F.col(DAY) > F.lit(last))
            held = _last_pings(layers, last)
            rows = held.unionByName(rows.select(*held.columns))
        tables.replace_partitions(
            gold.fleet_snapshot(rows).withColumn(UNTIL, F.lit(day)), layers.name("silver", LAST_PINGS), UNTIL, [day])
        last = day
        written.append(day)
    return written


def refresh_day(layers: Layers, day: date, previous: date | None = None) -> None:
    """Bring the day's measures up to date, reading that day's fact partition only.

    Each run stores the last ping of every vehicle up to its day in ``silver.ultimo_ping``. The first
    ping of the next day pairs with it, so increments equal a full rebuild. ``previous`` is the day of
    the run to continue from (none for the first day); without its stored pings the run is refused.
    """
    spark = layers.spark
    fact = layers.read("silver", "fato_posicao_veiculos").filter(F.col(DAY) == F.lit(day))
    lines = layers.read("silver", "dim_linhas")
    last_pings = layers.name("silver", "ultimo_ping")
    carried = None
    if previous is not None:
        if not spark.catalog.tableExists(last_pings) or spark.table(last_pings).filter(F.col("ate_dia") == F.lit(previous)).isEmpty():
            raise ValueError(f"no last pings are stored for {previous}: refresh that day first")
        carried = spark.table(last_pings).filter(F.col("ate_dia") == F.lit(previous)).drop("ate_dia")

    tables.replace_partitions(
        gold.line_speed(fact, lines, carried=carried), layers.name("gold", "velocidade_linhas"), DAY, [day])
    tables.replace_partitions(gold.accessibility(fact, lines), layers.name("gold", "acessibilidade"), DAY, [day])
    known = fact if carried is None else carried.unionByName(fact)
    tables.replace_partitions(
        gold.fleet_snapshot(known).withColumn("ate_dia", F.lit(day)), last_pings, "ate_dia", [day])
    tables.replace_table(
        spark.table(last_pings).filter(F.col("ate_dia") == F.lit(day)).drop("ate_dia"),
        layers.name("gold", "snapshot_frota_atual"),
    )
