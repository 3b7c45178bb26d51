"""Every query by name, with its DuckDB oracle.

Timestamps leave as TIMESTAMP_NTZ and days as text, so both engines print them alike; means are
rounded because the order of a floating-point sum is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom import schemas
from transitloom import testviews as tv
from transitloom.functions.clock import run_stamp, stamp_of
from transitloom.operators import numbering, ranking
from transitloom.plans import gold, jobs, serving, silver
from transitloom.session import shared_folder, side_by_side
from transitloom.sources import documents, gtfs, landing, sweep, tables
from transitloom.streaming import positions as live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN = datetime(2024, 2, 1, 6, 30, 0)
PROMPTS = ("101", "asia nation_1[0-9]", "-3 |", "zzz", "são asia")


def query(oracle: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = tv.oracle(oracle)
        return function

    return register


def _rounded(column: str) -> Column:
    # the nudge keeps an exact half from falling either way with the order of the sum
    return F.round(F.col(column).cast("double") + 1e-9, 6).alias(column)


def _day(column: str = "data_referencia") -> Column:
    return F.col(column).cast("string").alias(column)


# -- inputs -------------------------------------------------------------------------------------

def _fact(spark, sf):
    return tv.view(spark, sf, "fact")


def _lines(spark, sf):
    return silver.line_dimension(tv.view(spark, sf, "raw_lines"), tv.view(spark, sf, "gtfs_routes"))


def _profile(spark, sf):
    return gold.route_profile(tv.view(spark, sf, "shapes"), tv.view(spark, sf, "trips"))


def _raw_positions(spark, sf):
    return tv.view(spark, sf, "raw_pings").withColumn("ta", tv.iso("signal_ts"))


_GOLD: dict[tuple[str, str], tuple[DataFrame, DataFrame, DataFrame]] = {}


def _gold(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Speeds by day, snapshot and profile, built once for a session and its data."""
    key = spark.sparkContext.applicationId, sf
    if key not in _GOLD:
        root, fact = shared_folder(spark, "gold"), _fact(spark, sf)

        def stored(name: str, measure: DataFrame, by: str | None = None) -> DataFrame:
            writer = tables.balanced(measure, by).write
            (writer.partitionBy(by) if by else writer).parquet(f"{root}/{name}")
            return spark.read.schema(measure.schema).parquet(f"{root}/{name}")

        _GOLD[key] = tuple(side_by_side(
            spark,
            lambda: stored("velocidade_linhas", gold.line_speed(fact, _lines(spark, sf)), "data_referencia"),
            lambda: stored("snapshot_frota_atual", gold.fleet_snapshot(fact)),
            lambda: stored("perfil_rota_estatico", _profile(spark, sf)),
        ))
    return _GOLD[key]


def _dashboard(spark, sf, **options):
    """The dashboard reads stored measures, and of the speeds one day."""
    return serving.dashboard_day(*_gold(spark, sf), **options)


# -- gold ---------------------------------------------------------------------------------------

_SPEED_COLUMNS = """cod_linha, sentido_desc, cast(data_referencia as varchar) as data_referencia,
    round(velocidade_media + 1e-9, 6) as velocidade_media, round(lat_centroide + 1e-9, 6) as lat_centroide,
    round(lon_centroide + 1e-9, 6) as lon_centroide, is_circular, letreiro_completo, nome_api_tp_ts,
    nome_api_ts_tp, sentido_api, letreiro_gtfs, nome_rota_oficial"""


def _speed_output(df: DataFrame) -> DataFrame:
    return df.select(
        "cod_linha", "sentido_desc", _day(), _rounded("velocidade_media"), _rounded("lat_centroide"),
        _rounded("lon_centroide"), "is_circular", "letreiro_completo", "nome_api_tp_ts", "nome_api_ts_tp",
        "sentido_api", "letreiro_gtfs", "nome_rota_oficial",
    )


@query(f"select {_SPEED_COLUMNS} from {{velocidade}}")
def line_speed_kpi(spark, sf):
    return _speed_output(gold.line_speed(_fact(spark, sf), _lines(spark, sf)))


_PING_SPEED = """select data_hora_sp, prefixo_veiculo, cod_linha, sentido_desc, latitude, longitude,
    lat_prev, lon_prev, time_prev, dist_km, round(tempo_horas + 1e-9, 6) as tempo_horas,
    velocidade_kmh from {ping_speed}"""


def _ping_speed_output(df: DataFrame) -> DataFrame:
    return df.select(
        "data_hora_sp", "prefixo_veiculo", "cod_linha", "sentido_desc", "latitude", "longitude",
        "lat_prev", "lon_prev", "time_prev", "dist_km", _rounded("tempo_horas"), "velocidade_kmh",
    )


@query(_PING_SPEED)
def ping_speed(spark, sf):
    return _ping_speed_output(gold.ping_speed(_fact(spark, sf)))


@query(f"select {_SPEED_COLUMNS} from {{velocidade}} order by velocidade.velocidade_media desc, cod_linha, "
       "sentido_desc, velocidade.data_referencia limit 10")
def fastest_lines10(spark, sf):
    return _speed_output(gold.fastest_lines(gold.line_speed(_fact(spark, sf), _lines(spark, sf))))


_ACCESS = """select nome_api_tp_ts, letreiro_completo, percentual_acessibilidade,
    total_veiculos_reportados, cast(data_referencia as varchar) as data_referencia from {acessibilidade}"""


def _access(spark, sf):
    return gold.accessibility(_fact(spark, sf), _lines(spark, sf))


@query(_ACCESS)
def accessibility_kpi(spark, sf):
    return _access(spark, sf).withColumn("data_referencia", _day())


@query(_ACCESS + """ order by percentual_acessibilidade nulls first, letreiro_completo nulls first,
    acessibilidade.data_referencia, total_veiculos_reportados desc, nome_api_tp_ts nulls first limit 10""")
def accessibility_bottom10(spark, sf):
    return gold.least_accessible(_access(spark, sf)).withColumn("data_referencia", _day())


@query("""select data_hora_sp, prefixo_veiculo, cod_linha, latitude, longitude, sentido_desc, is_acessivel,
    cast(data_referencia as varchar) as data_referencia from {snapshot}""")
def fleet_snapshot(spark, sf):
    return gold.fleet_snapshot(_fact(spark, sf)).withColumn("data_referencia", _day())


@query("""select data_hora_sp, prefixo_veiculo, cod_linha, latitude, longitude, sentido_desc, is_acessivel,
    cast(data_referencia as varchar) as data_referencia from {fact} where data_referencia <= date '2024-01-15'
    qualify row_number() over (partition by prefixo_veiculo order by data_hora_sp desc) = 1""")
def fleet_snapshot_as_of(spark, sf):
    return gold.fleet_snapshot(_fact(spark, sf), as_of="2024-01-15").withColumn("data_referencia", _day())


@query("""select data_hora_sp, prefixo_veiculo, cod_linha, latitude, longitude, sentido_desc, is_acessivel,
    cast(data_referencia as varchar) as data_referencia from {fact} where data_referencia <= date '2024-01-15'
    qualify row_number() over (partition by prefixo_veiculo order by data_hora_sp desc) = 1""")
def job_snapshot_as_of(spark, sf):
    """From the stored last pings of a week before and the days since; an earlier link was stored from a fact that lacked rows."""
    layers, _ = _lake(spark)
    fact = _fact(spark, sf)
    tables.replace_table(fact, layers.name("silver", "fato_posicao_veiculos"), jobs.DAY)
    chain = layers.name("silver", jobs.LAST_PINGS)
    for day in (date(2024, 1, 5), date(2024, 1, 8)):
        poor = fact.filter((F.col(jobs.DAY) <= F.lit(day)) & (F.col("cod_linha") % 3 != 0))
        tables.replace_partitions(gold.fleet_snapshot(poor).withColumn(jobs.UNTIL, F.lit(day)), chain, jobs.UNTIL, [day])
    jobs.repair_chain(layers, date(2024, 1, 2))
    return jobs.snapshot_as_of(layers, date(2024, 1, 15)).withColumn("data_referencia", _day())


@query("select shape_id, cast(extensao_km as double) as extensao_km from {comprimento}")
def shape_length(spark, sf):
    return gold.shape_length(tv.view(spark, sf, "shapes")).withColumn("extensao_km", F.col("extensao_km").cast("double"))


@query("select letreiro_gtfs, extensao_km, qtd_paradas_estimada from {perfil}")
def route_profile(spark, sf):
    return _profile(spark, sf).withColumn("extensao_km", F.col("extensao_km").cast("double"))


# -- silver -------------------------------------------------------------------------------------

# São Paulo kept UTC-3 all through the days of the test data
_FACT_CLEAN = """select signal_ts - interval '3' hour as data_hora_sp, cast(p as int) as prefixo_veiculo,
    cl as cod_linha, py as latitude, px as longitude, case when sl = 1 then 'Ida' else 'Volta' end as sentido_desc,
    a as is_acessivel, cast(cast(signal_ts - interval '3' hour as date) as varchar) as data_referencia
    from {raw_pings} qualify row_number() over (partition by p, signal_ts order by dt_ingestao) = 1"""


@query(_FACT_CLEAN)
def fact_clean(spark, sf):
    return silver.position_fact(_raw_positions(spark, sf)).withColumn("data_referencia", _day())


@query(f"select * from ({_FACT_CLEAN}) where data_referencia = '2024-01-15'")
def fact_partition_day(spark, sf):
    path = shared_folder(spark, "fact")
    fact = silver.position_fact(_raw_positions(spark, sf))
    tables.balanced(fact, "data_referencia").write.partitionBy("data_referencia").parquet(path)
    day = spark.read.schema(fact.schema).parquet(path).filter(F.col("data_referencia") == F.lit("2024-01-15").cast("date"))
    return day.withColumn("data_referencia", _day())


def _bad_raw(spark, sf):
    raw = tv.view(spark, sf, "raw_bad")
    return raw.withColumn("ta", F.coalesce("odd_time", tv.iso("signal_ts")))


_FACT_BAD = """select signal_ts - interval '3' hour as data_hora_sp, try_cast(p as int) as prefixo_veiculo,
    cl as cod_linha, py as latitude, px as longitude, case when sl = 1 then 'Ida' else 'Volta' end as sentido_desc,
    a as is_acessivel, cast(cast(signal_ts - interval '3' hour as date) as varchar) as data_referencia
    from {raw_bad} qualify row_number() over (partition by p, coalesce(odd_time, cast(signal_ts as varchar))
      order by dt_ingestao, cl nulls last, py nulls last, px nulls last, sl nulls last, a nulls last) = 1"""


@query(f"""select count(*) as rows, count(*) filter (where prefixo_veiculo is null) as without_vehicle,
    count(*) filter (where data_hora_sp is null) as without_time,
    count(*) filter (where latitude is null or longitude is null) as without_place from ({_FACT_BAD})""")
def fact_quality(spark, sf):
    return silver.fact_quality(silver.position_fact(_bad_raw(spark, sf)))


@query("""select cod_linha, is_circular, letreiro_completo, nome_api_tp_ts, nome_api_ts_tp, sentido_api,
    letreiro_gtfs, nome_rota_oficial from {dim_linhas}""")
def line_dimension(spark, sf):
    return _lines(spark, sf)


@query("""select c as cod_empresa, n as nome_empresa, a as cod_area_operacao from {raw_companies}
    qualify row_number() over (partition by c order by dt_ingestao desc) = 1""")
def company_dimension(spark, sf):
    return silver.company_dimension(tv.view(spark, sf, "raw_companies"))


@query("""select route_id as letreiro_completo, shape_id, shape_pt_lat as latitude, shape_pt_lon as longitude,
    shape_pt_sequence as sequencia, trip_headsign as destino_escrito
    from {shapes} join (select route_id, shape_id, min(trip_headsign) as trip_headsign from {trips} group by 1, 2)
    using (shape_id)""")
def route_map_points(spark, sf):
    return silver.route_map(tv.view(spark, sf, "shapes"), tv.view(spark, sf, "trips"))


# -- dashboard ----------------------------------------------------------------------------------

_DAY_COLUMNS = """cod_linha, letreiro_completo, nome_rota_oficial, "Rota", round(velocidade_media + 1e-9, 6) as
    velocidade_media, sentido_desc, data_referencia, "Qtd_Veiculos", "Acessiveis", qtd_paradas_estimada,
    round(extensao_km + 1e-9, 6) as extensao_km, round(tempo_estimado_h + 1e-9, 6) as tempo_estimado_h,
    round("Perc_Acessivel" + 1e-9, 6) as "Perc_Acessivel", "Status_Acessibilidade" """


def _day_output(df: DataFrame) -> DataFrame:
    return df.select(
        "cod_linha", "letreiro_completo", "nome_rota_oficial", "Rota", _rounded("velocidade_media"),
        "sentido_desc", _day(), "Qtd_Veiculos", "Acessiveis", "qtd_paradas_estimada", _rounded("extensao_km"),
        _rounded("tempo_estimado_h"), _rounded("Perc_Acessivel"), "Status_Acessibilidade",
    )


@query(f"select {_DAY_COLUMNS} from {{painel}}")
def dashboard_day(spark, sf):
    return _day_output(_dashboard(spark, sf))


@query(f'select {_DAY_COLUMNS} from {{painel}} where "Acessiveis" > 0')
def dashboard_accessible_only(spark, sf):
    return _day_output(_dashboard(spark, sf, accessible_only=True))


@query("""select cast(cod_linha as varchar) as linha, count(prefixo_veiculo) as "Qtd_Veiculos",
    count(*) filter (where is_acessivel) as "Acessiveis" from {snapshot} group by 1""")
def fleet_counts(spark, sf):
    return serving.fleet_counts(gold.fleet_snapshot(_fact(spark, sf)))


@query("""select count(*) as linhas, cast(sum("Qtd_Veiculos") as bigint) as frota,
    round(avg(velocidade_media) + 1e-9, 6) as velocidade, round(sum(extensao_km), 4) as extensao,
    format('{:.1f}', round(avg(velocidade_media) + 1e-9, 6)) || ' km/h' as velocidade_txt,
    format('{:,.0f}', round(sum(extensao_km), 4)) || ' km' as extensao_txt from {painel}""")
def network_kpis(spark, sf):
    return serving.network_kpis(_dashboard(spark, sf)).withColumns({
        "velocidade": _rounded("velocidade"), "extensao": F.round("extensao", 4)})


_ROUTE_SPEED = '''select "Rota", round(avg(velocidade_media) + 1e-9, 6) as velocidade_media from {painel}
    group by 1 order by avg(velocidade_media) %s, "Rota" limit 10'''


@query(_ROUTE_SPEED % "asc")
def slowest10(spark, sf):
    return serving.slowest(_dashboard(spark, sf)).select("Rota", _rounded("velocidade_media"))


@query(_ROUTE_SPEED % "desc")
def fastest10(spark, sf):
    return serving.fastest(_dashboard(spark, sf)).select("Rota", _rounded("velocidade_media"))


@query("""select "Rota", round(velocidade_media + 1e-9, 6) as velocidade_media, round(extensao_km + 1e-9, 6) as extensao_km,
    round(tempo_estimado_h + 1e-9, 6) as tempo_estimado_h, "Qtd_Veiculos", "Status_Acessibilidade" from {painel}""")
def operations_table(spark, sf):
    return serving.operations_table(_dashboard(spark, sf)).select(
        "Rota", _rounded("velocidade_media"), _rounded("extensao_km"), _rounded("tempo_estimado_h"),
        "Qtd_Veiculos", "Status_Acessibilidade")


@query("select distinct cast(data_referencia as varchar) as data_referencia from {fact}")
def date_choices(spark, sf):
    return serving.date_choices(_fact(spark, sf)).select(_day())


def _answers_sql(test: str) -> str:
    prompts = ", ".join(f"('{p}')" for p in PROMPTS)
    return f"""select q.prompt, "Rota", "Qtd_Veiculos" as frota, round(velocidade_media + 1e-9, 6) as velocidade_media,
      cast(trunc(1 / velocidade_media * 60) as int) as min_1km,
      cast(trunc(5 / velocidade_media * 60) as int) as min_5km,
      case when "Rota" is null then 'no line' else 'ok' end as outcome
    from (values {prompts}) q(prompt) left join (
      select prompt, "Rota", "Qtd_Veiculos", velocidade_media
      from {{painel}} join (values {prompts}) x(prompt) on {test}
      qualify row_number() over (partition by prompt order by "Rota", cod_linha, sentido_desc) = 1) f
    on q.prompt = f.prompt"""


@query(_answers_sql("""regexp_matches("Rota", prompt, 'i')"""))
def arrival_answers(spark, sf):
    return serving.arrival_answers(_dashboard(spark, sf), PROMPTS).withColumn(
        "velocidade_media", _rounded("velocidade_media"))


@query("""select q.prompt, "Rota", case when "Rota" is null then 'no line' when velocidade_media > 0 then 'ok' else 'no speed' end as outcome
    from (values ('nation_1'), ('asia')) q(prompt) left join (
      select prompt, "Rota", case when cod_linha % 2 = 1 then velocidade_media end as velocidade_media
      from {painel} join (values ('nation_1'), ('asia')) x(prompt) on contains(lower("Rota"), prompt)
      qualify row_number() over (partition by prompt order by "Rota", cod_linha, sentido_desc) = 1) f using (prompt)""")
def arrival_answers_no_speed(spark, sf):
    day = _dashboard(spark, sf)
    slow = day.withColumn("velocidade_media", F.when(F.col("cod_linha") % 2 == 1, F.col("velocidade_media")))
    prompts = spark.createDataFrame([("nation_1",), ("asia",)], "prompt string")
    return serving.arrival_answers(slow, prompts).select("prompt", "Rota", "outcome")


_MANY_PROMPTS = """(select 'nation_' || cast(s_suppkey as varchar) as prompt from {supplier}
      union all select s_name from {supplier} union all select '(' union all select 'a**b')"""


@query(f"""select q.prompt, first as "Rota", case when q.prompt in ('(', 'a**b') then 'bad prompt' when first is null then 'no line' else 'ok' end as outcome
    from {_MANY_PROMPTS} q left join (
      select prompt, min("Rota") as first from {_MANY_PROMPTS} x join (select distinct "Rota" from {{painel}}) p
      on prompt not in ('(', 'a**b') and contains(lower("Rota"), lower(prompt)) group by 1) f on q.prompt = f.prompt""")
def arrival_answers_bad_prompt(spark, sf):
    """Prompts made from all suppliers, and some that are no regular expressions."""
    supplier = spark.read.parquet(f"{sf}/supplier.parquet")
    prompts = supplier.select(F.concat(F.lit("nation_"), F.col("s_suppkey")).alias("prompt")).unionByName(
        supplier.select(F.col("s_name").alias("prompt"))).unionByName(spark.createDataFrame([("(",), ("a**b",)], "prompt string"))
    return serving.arrival_answers(_dashboard(spark, sf), prompts).select("prompt", "Rota", "outcome")


@query(_answers_sql("""contains(lower("Rota"), lower(prompt))"""))
def arrival_answers_literal(spark, sf):
    return serving.arrival_answers(_dashboard(spark, sf), PROMPTS, literal=True).withColumn(
        "velocidade_media", _rounded("velocidade_media"))


# -- documents ----------------------------------------------------------------------------------

_POSITIONS = """select case when (event_id // 500) % 7 = 0 then '00:00'
      else cast(event_id // 500 as varchar) || ':' || cast(run as varchar) end as hr,
    cl, 'S' || cast(cl as varchar) as c, sl, 'U' || cast(cl as varchar) as lt1, 'T' || cast(cl as varchar) as lt0,
    p, a, strftime(signal_ts, '%Y-%m-%dT%H:%M:%S.%fZ') as ta, py, px from {raw_pings}"""


@query(_POSITIONS)
def flatten_positions(spark, sf):
    return documents.positions(tv.position_docs(spark, sf))


@query("""select sum(case when page % 4 = 0 then 5 else 1 end)::bigint as documents,
    sum(case when page % 4 = 0 then 1 else 0 end)::bigint as unreadable
    from (select distinct event_id // 500 as page, run from {raw_pings})""")
def unreadable_documents(spark, sf):
    docs = tv.position_docs(spark, sf)
    return docs.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(documents.is_unreadable(F.col("body"))).alias("unreadable")
    )


@query("select strftime(dt_ingestao, '%d/%m') as hr, a, c, n from {raw_companies}")
def flatten_companies(spark, sf):
    return documents.companies(tv.company_docs(spark, sf)).drop("dt_ingestao")


_STOP_HEAD = """cp, 'stop ' || cast(cp as varchar) as np, cp / 10 as py_parada, -cp / 10 as px_parada"""
_DUE = """p, 't' || cast(event_id as varchar) as t, a, 'e' || cast(event_id as varchar) as ta, py, -py as px"""


@query(f"""select cast(page as varchar) as hr, {_STOP_HEAD}, 'S' || cast(cl as varchar) as c, cl,
    cast(1 + cl % 2 as int) as sl, 'T' || cast(cl as varchar) as lt0, 'U' || cast(cl as varchar) as lt1,
    cast(count(*) over (partition by page, cp, cl) as int) as qv, {_DUE} from {{forecasts}}""")
def flatten_stop_forecast(spark, sf):
    return documents.stop_forecast(tv.stop_forecast_docs(spark, sf))


@query(f"select cl as cod_linha, cast(page as varchar) as hr, {_STOP_HEAD}, {_DUE} from {{forecasts}}")
def flatten_line_forecast(spark, sf):
    return documents.line_forecast(tv.line_forecast_docs(spark, sf))


@query("select distinct cast(page as varchar) as hr, cp from {forecasts}")
def object_or_array(spark, sf):
    docs = tv.stop_forecast_docs(spark, sf)
    return docs.select(
        F.from_json("body", "struct<hr string>")["hr"].alias("hr"),
        F.inline_outer(documents.object_or_array(F.col("body"), "p", "struct<cp int>")),
    )


_TERMS = "(select unnest(range(1, 10))::int as term) terms"
_LINE_HITS = f"""select term, cl, lc, lt, sl, tl, tp, ts from {{raw_lines}}
    join {_TERMS} on contains(lt, cast(term as varchar))"""


@query(_LINE_HITS)
def line_terms(spark, sf):
    return documents.lines(tv.line_docs(spark, sf)).drop("dt_ingestao")


@query(f"""select term, direction, count(cl) as linhas, cast(coalesce(sum(cl), 0) as bigint) as soma
    from (select term, direction from {_TERMS} cross join (values (1), (2)) d(direction)) grid
    left join (select term, sl as direction, cl from ({_LINE_HITS})) using (term, direction) group by 1, 2""")
def line_direction_grid(spark, sf):
    found = documents.lines(tv.line_docs(spark, sf, by_direction=True)).groupBy("term", "direction").agg(
        F.count("cl").alias("linhas"), F.sum("cl").alias("soma"))
    # requests without an answer stay in the report
    return numbering.request_grid(spark).join(found, ["term", "direction"], "left").na.fill(0, ["linhas", "soma"])


def _stops_found(spark, sf):
    return documents.stops(tv.stop_docs(spark, sf, "term")).drop("term")


@query(f"""select distinct cp, np, ed, py, px from {{stops}} join {_TERMS} on contains(ed, cast(term as varchar))""")
def stops_by_term(spark, sf):
    return ranking.first_per_key(_stops_found(spark, sf), ["cp"])


@query(f"""select count(*) as rows_before, count(distinct cp) as rows_after,
    count(*) - count(distinct cp) as duplicates
    from {{stops}} join {_TERMS} on contains(ed, cast(term as varchar))""")
def stop_duplicates(spark, sf):
    return ranking.duplicate_counts(_stops_found(spark, sf), ["cp"])


@query("select cod_corredor, cp, np, ed, py, px from {stops}")
def stops_by_corridor(spark, sf):
    return documents.stops(tv.stop_docs(spark, sf, "cod_corredor"))


@query("select cast(cp % 27 as int) as cod_linha, cp, np, ed, py, px from {stops}")
def stops_by_line(spark, sf):
    return documents.stops(tv.stop_docs(spark, sf, "cod_linha"))


@query("select distinct cod_corredor as cc, 'Corridor ' || cast(cod_corredor as varchar) as nc from {stops}")
def corridor_list(spark, sf):
    return documents.corridors(tv.corridor_docs(spark, sf)).distinct()


# -- keys, lots and sweeps ----------------------------------------------------------------------

@query("select distinct cast(stop_id as int) as cp from {stops} where regexp_full_match(stop_id, '[0-9]+')")
def numeric_ids(spark, sf):
    return numbering.integer_keys(tv.view(spark, sf, "stops"), "stop_id", "cp")


@query("""select cp, cast(floor((row_number() over (order by cp) - 1) / 500) as bigint) as lote from (
    select distinct cast(stop_id as int) as cp from {stops} where regexp_full_match(stop_id, '[0-9]+'))""")
def request_lots(spark, sf):
    return numbering.in_lots(numbering.integer_keys(tv.view(spark, sf, "stops"), "stop_id", "cp"), "cp", 500)


def _canned_service():
    """Replies made from the key; some keys fail at first or always, some have nothing."""
    asked: dict[int, int] = {}

    def fetch(key):
        asked[key] = asked.get(key, 0) + 1
        if key % 11 == 0 or (key % 3 == 0 and asked[key] == 1):
            raise TimeoutError(f"no reply for {key}")
        return "[]" if key % 5 == 0 else f'[{{"cp": {key}, "np": "stop {key}"}}]'

    return fetch


@query("""select cp, case when cp % 11 = 0 then 'failed' when cp % 5 = 0 then 'empty' else 'ok' end as status,
    cast(case when cp % 11 = 0 then 3 when cp % 3 = 0 then 2 else 1 end as int) as attempt,
    case when cp % 11 <> 0 and cp % 5 <> 0 then 'stop ' || cast(cp as varchar) end as np
    from (select distinct cast(stop_id as int) as cp from {stops} where regexp_full_match(stop_id, '[0-9]+'))""")
def sweep_fetch(spark, sf):
    keys = numbering.integer_keys(tv.view(spark, sf, "stops"), "stop_id", "cp")
    replies = sweep.sweep(keys, "cp", _canned_service(), tasks=8, attempts=3, wait_seconds=0)
    names = F.from_json("body", "array<struct<cp int, np string>>")
    return replies.select("cp", "status", "attempt", F.get(names, F.lit(0))["np"].alias("np"))


@query("""select cp, case when cp % 11 = 0 then 'failed' when cp % 5 = 0 then 'empty' else 'ok' end as status,
    'gtfs_batch_' || cast(500 * floor((row_number() over (order by cp) - 1) / 500)::bigint as varchar)
      || '_20240201_063000.json' as arquivo_origem
    from (select distinct cast(stop_id as int) as cp from {stops} where regexp_full_match(stop_id, '[0-9]+'))""")
def sweep_in_lots(spark, sf):
    requests, replies = shared_folder(spark, "requests"), shared_folder(spark, "replies")
    keys = numbering.integer_keys(tv.view(spark, sf, "stops"), "stop_id", "cp")
    sweep.write_lots(keys, "cp", 500, requests)
    _finish(sweep.sweep_lots(
        spark, requests, "cp", _canned_service(), replies, shared_folder(spark, "checkpoint"), tasks=8,
        lots_per_commit=32, wait_seconds=0))
    origin = sweep.lot_origin(F.col("lote"), 500, run_stamp(RUN), "gtfs_batch")
    return spark.read.parquet(replies).select("cp", "status", origin.alias("arquivo_origem"))


# -- checks and round trips ---------------------------------------------------------------------

@query("select sentido_desc, count(*) as count from {fact} group by 1")
def direction_distribution(spark, sf):
    return gold.count_by(_fact(spark, sf), "sentido_desc")


@query(" union all ".join(
    f"select '{t}' as tabela, count(*) as linhas from {t}" for t in ("events", "lineitem", "orders", "part")))
def table_counts(spark, sf):
    counts = [
        tv.table(spark, sf, t).agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(t).alias("tabela"), "linhas")
        for t in ("events", "lineitem", "orders", "part")
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


def _schedule_folder(spark, sf) -> str:
    folder = shared_folder(spark, "gtfs")
    as_text = {"shape_id": F.col("shape_id").cast("string")}
    files = {
        "routes": tv.view(spark, sf, "gtfs_routes"),
        "shapes": tv.view(spark, sf, "shapes").withColumns(as_text),
        "trips": tv.view(spark, sf, "trips").withColumns(as_text),
        "stops": tv.view(spark, sf, "stops").select(
            F.lpad("stop_id", 9, "0").alias("stop_id"), F.col("np").alias("stop_name")),
        "stop_times": tv.view(spark, sf, "trips").select(
            "trip_id", F.concat((F.col("trip_id") % 30).cast("string"), F.lit(":10:00")).alias("arrival_time")),
        "agency": tv.table(spark, sf, "region").select(F.col("r_name").alias("unknown_column")),
    }
    for name, rows in files.items():
        rows.write.option("header", True).csv(f"{folder}/{name}.txt")
    return folder


@query("""select cast(shape_id as varchar) as shape_id, shape_pt_lat, shape_pt_lon, shape_pt_sequence from {shapes}""")
def gtfs_scan(spark, sf):
    return gtfs.read_file(spark, _schedule_folder(spark, sf), "shapes").select(
        "shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence")


@query("""select file, rows, rows is null as failed from (
    select 'routes' as file, count(*) as rows from {gtfs_routes}
    union all select 'shapes', count(*) from {shapes} union all select 'trips', count(*) from {trips}
    union all select 'stops', count(*) from {stops} union all select 'stop_times', count(*) from {trips}
    union all select unnest(['agency', 'calendar', 'fare_attributes', 'fare_rules', 'frequencies']), null)""")
def gtfs_load_status(spark, sf):
    folder, out = _schedule_folder(spark, sf), shared_folder(spark, "gtfs-tables")

    def write(name: str, rows: DataFrame) -> int:
        rows.write.parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}").count()

    return gtfs.load_files(spark, folder, write, RUN).select("file", "rows", F.col("error").isNotNull().alias("failed"))


@query("""select cp, np, case when cp % 2 = 1 then ed end as ed, timestamp '2024-02-01 06:30:00' as dt_ingestao,
    '20240201_063000' as carimbo from {stops}""")
def append_evolve(spark, sf):
    path = shared_folder(spark, "stops")
    stops = landing.stamp(tv.view(spark, sf, "stops"), RUN)
    tables.append_evolving(stops.filter("cp % 2 = 0").select("cp", "np", "dt_ingestao"), path)
    tables.append_evolving(stops.filter("cp % 2 = 1").select("cp", "np", "ed", "dt_ingestao"), path)
    merged = tables.read_evolving(spark, path)
    return merged.select(
        "cp", "np", "ed", F.col("dt_ingestao").cast("timestamp_ntz").alias("dt_ingestao"),
        stamp_of(F.col("dt_ingestao")).alias("carimbo"),
    )


@query("select cp, np, ed, py, px, 'paradas_20240201_063000.json' as arquivo_origem from {stops}")
def json_roundtrip(spark, sf):
    stops = tv.view(spark, sf, "stops").select(*tv.STOP_COLUMNS)
    path = landing.land_rows(stops, shared_folder(spark, "landing"), "paradas", RUN)
    back = spark.read.schema(stops.schema).json(path)
    return back.withColumn("arquivo_origem", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


@query(_POSITIONS)
def landed_positions(spark, sf):
    path = shared_folder(spark, "landing")
    landing.land_raw(tv.position_docs(spark, sf), path)
    return documents.positions(landing.read_landed(spark, path)).drop("arquivo_origem")


# -- jobs and catalog -----------------------------------------------------------------------------

def _lake(spark) -> tuple[jobs.Layers, str]:
    """Fresh layers under the shared folder."""
    root = shared_folder(spark, "lake")
    prefix = f"lake_{root[-12:]}_"
    tables.create_layers(spark, root, prefix)
    return jobs.Layers(spark, prefix), root


def _ingested(spark, sf) -> jobs.Layers:
    """Three ingests: most pages, then a fifth of them a week late, then the repeated signals. The fact knows the first."""
    layers, _ = _lake(spark)
    docs = tv.position_docs(spark, sf, "page", "run")
    late = F.col("page") % 5 == 0
    jobs.ingest(layers, "posicao_veiculos", docs.filter((F.col("run") == 1) & ~late).select("body"), datetime(2024, 2, 1))
    tables.replace_table(
        silver.position_fact(layers.read("bronze", "posicao_veiculos")), layers.name("silver", "fato_posicao_veiculos"), jobs.DAY)
    jobs.ingest(layers, "posicao_veiculos", docs.filter((F.col("run") == 1) & late).select("body"), datetime(2024, 2, 8))
    jobs.ingest(layers, "posicao_veiculos", docs.filter(F.col("run") == 2).select("body"), datetime(2024, 2, 9))
    return layers


@query(_FACT_CLEAN)
def job_refresh_fact(spark, sf):
    layers = _ingested(spark, sf)
    jobs.refresh_fact(layers, date(2024, 2, 8))
    return layers.read("silver", "fato_posicao_veiculos").withColumn("data_referencia", _day())


@query(f"select {_SPEED_COLUMNS} from {{velocidade}}")
def job_refresh_day(spark, sf):
    """All days but the newest from a full build, the newest from the increment that goes on from the day before."""
    layers, _ = _lake(spark)
    fact = _fact(spark, sf)
    newest, before = (r[0] for r in fact.select(jobs.DAY).distinct().orderBy(F.col(jobs.DAY).desc()).limit(2).collect())
    lines = layers.name("silver", "dim_linhas")
    tables.replace_table(fact, layers.name("silver", "fato_posicao_veiculos"), jobs.DAY)
    tables.replace_table(_lines(spark, sf), lines)
    older = fact.filter(F.col(jobs.DAY) <= F.lit(before))
    tables.replace_table(gold.line_speed(older, spark.table(lines)), layers.name("gold", "velocidade_linhas"), jobs.DAY)
    tables.replace_table(
        gold.fleet_snapshot(older).withColumn("ate_dia", F.lit(before)), layers.name("silver", "ultimo_ping"), "ate_dia")
    jobs.refresh_day(layers, newest, before)
    return _speed_output(layers.read("gold", "velocidade_linhas"))


@query("""select cast(documents as bigint) as documents, cast(unreadable as bigint) as unreadable, cast(wrong as bigint) as wrong_shape,
    rows from (select sum(case when page % 4 = 0 then 5 else 1 end) + 1 as documents,
      sum(case when page % 4 = 0 then 1 else 0 end) as unreadable, 1 as wrong
      from (select distinct event_id // 500 as page, run from {raw_pings})), (select count(*) as rows from {raw_pings})""")
def job_ingest_status(spark, sf):
    layers, root = _lake(spark)
    docs = tv.position_docs(spark, sf).unionByName(spark.createDataFrame([('{"hr":"1","l":5}',)], "body string"))
    return jobs.ingest(layers, "posicao_veiculos", docs, RUN, landing_root=f"{root}/landing").drop("tabela")


@query(_POSITIONS)
def job_quarantine_replay(spark, sf):
    """Documents that arrive cut short are refused, kept, mended and parsed again."""
    layers, root = _lake(spark)
    docs = tv.position_docs(spark, sf)
    body = F.col("body")
    cut = F.when(F.pmod(F.xxhash64("body"), F.lit(3)) == 0, F.substring(body, F.lit(1), F.char_length(body) - 1)).otherwise(body)
    jobs.ingest(layers, "posicao_veiculos", docs.withColumn("body", cut), RUN, landing_root=f"{root}/landing")
    jobs.replay(layers, "posicao_veiculos", datetime(2024, 2, 2), lambda text: F.concat(text, F.lit("}")))
    columns = [f.name for f in schemas.BRONZE["posicao_veiculos"]]
    return layers.read("bronze", "posicao_veiculos").select(*columns)


@query("""select cp, np, ed, cast(cp % 27 as int) as cod_linha, case when cp % 2 = 1 then 'R' || cast(cp as varchar) end as zona from {stops}""")
def job_bronze_evolves(spark, sf):
    """The second run brings a column that the table does not know."""
    layers, root = _lake(spark)
    docs = tv.stop_docs(spark, sf, "cod_linha").select("body", "cod_linha")
    one = F.from_json("body", "array<struct<cp int>>")
    each = docs.withColumn("cp", F.explode(F.transform(one, lambda x: x["cp"])))
    item = F.get(F.filter(F.from_json("body", schemas.STOPS), lambda x: x["cp"] == F.col("cp")), 0)
    single = each.select(F.to_json(F.array(item)).alias("body"), "cod_linha", "cp")
    jobs.ingest(layers, "paradas_por_linha", single.filter("cp % 2 = 0").select("body", "cod_linha"), RUN, landing_root=f"{root}/landing")
    odd = single.filter("cp % 2 = 1").withColumn("zona", F.concat(F.lit("R"), F.col("cp").cast("string"))).drop("cp")
    jobs.ingest(layers, "paradas_por_linha", odd, datetime(2024, 2, 2))
    return layers.read("bronze", "paradas_por_linha").select("cp", "np", "ed", "cod_linha", "zona")


def _flaky(good: bool):
    """Replies made from the key; every eleventh key fails unless the service is well."""
    def fetch(key):
        if key % 11 == 0 and not good:
            raise TimeoutError(f"no reply for {key}")
        return f'{{"hr": "1", "p": {{"cp": {key}, "l": [{{"cl": 1, "vs": [{{"p": "{key}"}}]}}]}}}}'

    return fetch


@query("""select cp, cast(cp as varchar) as p, count(*) as copies from (
    select distinct cast(stop_id as int) as cp from {stops} where regexp_full_match(stop_id, '[0-9]+')) group by 1, 2""")
def job_sweep_resumed(spark, sf):
    """A sweep with failed keys, resumed twice when the service is well again."""
    layers, root = _lake(spark)
    keys = numbering.integer_keys(tv.view(spark, sf, "stops"), "stop_id", "cp")
    for turn in range(3):
        jobs.ingest_sweep(layers, "previsao_chegada_parada", keys, _flaky(turn > 0), RUN, f"{root}/sweep", tasks=8,
                          lots_per_commit=64, resume=turn > 0, attempts=1, wait_seconds=0)
    return layers.read("bronze", "previsao_chegada_parada").groupBy("cp", "p").agg(F.count(F.lit(1)).alias("copies"))


@query("""select cp, cast(cp as varchar) as p, count(*) as copies from (
    select distinct cast(stop_id as int) as cp from {stops} where regexp_full_match(stop_id, '[0-9]+')) group by 1, 2""")
def job_sweep_repeated_commit(spark, sf):
    """A sweep that lands what it gets, and whose commits are all written twice."""
    layers, root = _lake(spark)
    keys = numbering.integer_keys(tv.view(spark, sf, "stops"), "stop_id", "cp")
    table, stamp = "previsao_chegada_parada", run_stamp(RUN)
    jobs.ingest_sweep(layers, table, keys, _flaky(True), RUN, f"{root}/sweep", tasks=8, lots_per_commit=4, lot_size=200,
                      landing_root=f"{root}/landing", attempts=1, wait_seconds=0)
    replies = spark.read.parquet(f"{root}/sweep/replies")
    commits = sorted(r[0] for r in replies.select("commit").distinct().collect())
    jobs.write_commit(layers, table, replies, "cp", commits, 200, RUN, f"{root}/landing")
    return layers.read("bronze", table).groupBy("cp", "p").agg(F.count(F.lit(1)).alias("copies"))


@query("""select count(distinct cp) as keys, count(distinct cp) as documents, true as few_files from (
    select cast(stop_id as int) as cp from {stops} where regexp_full_match(stop_id, '[0-9]+'))""")
def job_landing_files(spark, sf):
    """Documents of one request per key lie in files of even size, not in one for each key."""
    path = shared_folder(spark, "landing")
    keys = numbering.integer_keys(tv.view(spark, sf, "stops"), "stop_id", "cp")
    docs = keys.withColumn("body", F.concat(F.lit('{"cp": '), F.col("cp"), F.lit("}")))
    for _ in range(2):
        landing.land_raw(docs, path, ["cp"], replace=True)
    back = landing.read_landed(spark, path, ["cp"])
    return back.agg(F.count_distinct("cp").alias("keys"), F.count(F.lit(1)).alias("documents"),
                    (F.count_distinct("arquivo_origem") <= 64).alias("few_files"))


@query("""select 'shapes' as file, column_name as "column", rejected from (
    select 'shape_pt_lat' as column_name, count(*) filter (where shape_id % 50 = 0) as rejected from {shapes}
    union all select 'shape_pt_lon', 0 union all select 'shape_dist_traveled', 0
    union all select 'shape_pt_sequence', count(*) filter (where shape_id % 70 = 0) from {shapes}) where column_name <> 'shape_dist_traveled'""")
def gtfs_rejects(spark, sf):
    folder = shared_folder(spark, "gtfs")
    bad = tv.view(spark, sf, "shapes").withColumns({
        "shape_pt_lat": F.when(F.col("shape_id") % 50 == 0, F.lit("north")).otherwise(F.col("shape_pt_lat").cast("string")),
        "shape_pt_sequence": F.when(F.col("shape_id") % 70 == 0, F.lit("1.x")).otherwise(F.col("shape_pt_sequence").cast("string")),
    })
    bad.write.option("header", True).csv(f"{folder}/shapes.txt")
    return gtfs.rejects(spark, folder, "shapes").select(F.lit("shapes").alias("file"), "column", "rejected")


@query("""select c.col as "column", c.kind as type, (select count(*) from {shapes}) as rows
    from (values ('shape_id', 'int'), ('shape_pt_lat', 'double'), ('shape_pt_lon', 'double'), ('shape_pt_sequence', 'int')) c(col, kind)""")
def gtfs_inferred(spark, sf):
    rows = gtfs.read_file(spark, _schedule_folder(spark, sf), "shapes", infer=True)
    kinds = [(c, t) for c, t in rows.dtypes if c.startswith("shape_")]
    named = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("type")) for c, t in kinds))
    return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(named).alias("c"), "rows").select("c.*", "rows")


@query("""select c.col as "column", c.kind as type, c.said as comment, 'Stops found by search term' as of_table,
    (select count(*) from {stops}) as rows
    from (values ('cp', 'int', 'Stop code'), ('np', 'string', 'the name''s text'), ('ed', 'string', 'Stop address'),
      ('py', 'double', 'Latitude of the stop'), ('px', 'double', 'Longitude of the stop')) c(col, kind, said)""")
def catalog_comments(spark, sf):
    """A typed table with comments, filled and described."""
    layers, _ = _lake(spark)
    name = layers.name("bronze", "buscar_paradas")
    tables.create_table(spark, name, schemas.BRONZE["buscar_paradas"])
    tables.append_table(tv.view(spark, sf, "stops").select(*tv.STOP_COLUMNS), name)
    tables.comment_table(spark, name, jobs.COMMENTS["buscar_paradas"])
    tables.comment_columns(spark, name, {"np": "the name's text", "zz": "no such column"})
    described = tables.describe(spark, name)
    said = described.filter("col_name = 'Comment'").select("data_type").scalar()
    rows = spark.table(name).agg(F.count(F.lit(1))).scalar()
    return described.filter(F.col("col_name").isin(*tv.STOP_COLUMNS)).select(
        F.col("col_name").alias("column"), F.col("data_type").alias("type"), "comment", said.alias("of_table"), rows.alias("rows"))


@query("""select 'gold.perfil_rota_estatico' as tabela, (select count(*) from {perfil}) as linhas
    union all select 'silver.dim_linhas', (select count(*) from {dim_linhas})
    union all select 'silver.ultimo_ping', (select count(*) from {snapshot})""")
def job_register(spark, sf):
    """Layers whose catalog was lost: the files are found again, a dropped table is not, and no other is there."""
    layers, root = _lake(spark)
    tables.replace_table(_profile(spark, sf), layers.name("gold", "perfil_rota_estatico"))
    tables.replace_table(_lines(spark, sf), layers.name("silver", "dim_linhas"))
    tables.replace_table(gold.fleet_snapshot(_fact(spark, sf)).withColumn("ate_dia", F.lit("2024-02-01").cast("date")),
                         layers.name("silver", "ultimo_ping"), "ate_dia")
    tables.replace_table(tv.view(spark, sf, "stops"), layers.name("gold", "acessibilidade"))
    tables.drop_table(spark, layers.name("gold", "acessibilidade"))
    again = f"again_{layers.prefix}"
    tables.create_layers(spark, root, again)
    found = [r.table for r in tables.register_tables(spark, root, again).filter("error is null").orderBy("table").collect()]
    counts = [spark.table(t).agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(t.removeprefix(again)).alias("tabela"), "linhas")
              for t in found]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


@query("""select cp, np, case when cp % 2 = 0 then 'even' else 'odd' end as side, true as refused from {stops}""")
def catalog_replace(spark, sf):
    """A table made from a query, replaced with one more column, refused with fewer, read through a view."""
    layers, _ = _lake(spark)
    name, stops = layers.name("gold", "paradas"), tv.view(spark, sf, "stops")
    tables.replace_table(stops.select("cp"), name)
    tables.replace_table(stops.select("cp", "np"), name)
    more = stops.select("cp", "np", F.when(F.col("cp") % 2 == 0, "even").otherwise("odd").alias("side"))
    tables.replace_table(more, name)
    try:
        tables.replace_table(stops.select("cp"), name, same_schema=True)
        refused = False
    except ValueError:
        refused = True
    tables.replace_table(more, name, same_schema=True)
    view = f"paradas_{layers.prefix}"
    tables.temporary_view(layers.read("gold", "paradas"), view)
    return spark.sql(f"select *, {refused} as refused from `{view}`")


@query("select cp, np from {stops} order by cp limit 10")
def catalog_preview(spark, sf):
    layers, _ = _lake(spark)
    tables.replace_table(tv.view(spark, sf, "stops").select("cp", "np"), layers.name("bronze", "paradas"))
    return tables.preview(layers.read("bronze", "paradas"), "cp")


# -- streaming ----------------------------------------------------------------------------------

def _finish(stream) -> None:
    stream.awaitTermination()


@query(_POSITIONS)
def stream_positions(spark, sf):
    landed, out = shared_folder(spark, "landing"), shared_folder(spark, "positions")
    landing.land_raw(tv.position_docs(spark, sf), landed)
    rows = documents.positions(landing.stream_landed(spark, landed))
    _finish(live.append_to(rows, out, shared_folder(spark, "checkpoint")))
    return spark.read.schema(rows.schema).parquet(out).drop("arquivo_origem")


@query("select cast(cp % 27 as int) as cod_linha, cp, np, ed, py, px from {stops}")
def stream_stops_by_line(spark, sf):
    """Answers to requests by line, as a stream that keeps the key asked for."""
    landed, out = shared_folder(spark, "landing"), shared_folder(spark, "stops")
    landing.land_raw(tv.stop_docs(spark, sf, "cod_linha"), landed, ["cod_linha"])
    rows = documents.stops(landing.stream_landed(spark, landed, keys=schemas.columns("cod_linha int")))
    _finish(live.append_to(rows, out, shared_folder(spark, "checkpoint")))
    return spark.read.schema(rows.schema).parquet(out).drop("arquivo_origem")


def _streamed_signals(spark, sf, raw: DataFrame) -> tuple[str, str]:
    """Folders of the fact and of the late counts, after a first run and a second with the repeated signals."""
    landed, folder, late, checkpoint = (shared_folder(spark, n) for n in ("raw", "fact", "late", "checkpoint"))
    columns = raw.select("p", "ta", "dt_ingestao", "cl", "py", "px", "sl", "a")
    columns = columns.withColumn("dt_ingestao", F.col("dt_ingestao").cast("timestamp"))
    for run in (1, 2):
        columns.where(raw["run"] == run).write.mode("append").parquet(landed)
        _finish(live.keep_fact(live.stream_rows(spark, columns.schema, landed), folder, late, checkpoint))
    return folder, late


@query(_FACT_CLEAN)
def stream_dedup(spark, sf):
    folder, _ = _streamed_signals(spark, sf, _raw_positions(spark, sf))
    return live.fact_so_far(spark, folder).withColumn("data_referencia", _day())


@query(_FACT_BAD)
def stream_dedup_bad_times(spark, sf):
    folder, _ = _streamed_signals(spark, sf, _bad_raw(spark, sf))
    return live.fact_so_far(spark, folder).withColumn("data_referencia", _day())


@query("""select count(*) as rows, count(*) filter (where run = 2 and signal_ts < (
      select max(signal_ts) - interval '1' hour from {raw_bad} where run = 1)) as late,
    count(*) filter (where signal_ts is null) as untimed from {raw_bad}""")
def stream_late_counts(spark, sf):
    _, late = _streamed_signals(spark, sf, _bad_raw(spark, sf))
    return live.late_counts(spark, late)


def _streamed_fact(spark, sf) -> DataFrame:
    landed = shared_folder(spark, "fact")
    fact = _fact(spark, sf)
    fact.write.parquet(landed)
    return live.stream_rows(spark, fact.schema, landed)


@query("""select data_hora_sp, prefixo_veiculo, cod_linha, latitude, longitude, sentido_desc, is_acessivel,
    cast(data_referencia as varchar) as data_referencia from {snapshot}""")
def stream_snapshot(spark, sf):
    state = shared_folder(spark, "snapshot")
    _finish(live.keep_snapshot(_streamed_fact(spark, sf), state, shared_folder(spark, "checkpoint")))
    return live.latest_state(spark, state).withColumn("data_referencia", _day())


def _streamed_speeds(spark, sf, parts: int = 1, changes: str | None = None) -> str:
    """The folder of the speeds, after pings that came in ``parts`` files dealt out by hash."""
    landed, speeds, late, state, checkpoint = (
        shared_folder(spark, n) for n in ("fact", "speeds", "late", "state", "checkpoint"))
    fact = _fact(spark, sf)
    dealt = fact.withColumn("parte", F.pmod(F.xxhash64("prefixo_veiculo", "data_hora_sp"), F.lit(parts)))
    for part in range(parts):
        dealt.filter(F.col("parte") == part).drop("parte").write.mode("append").parquet(landed)
        _finish(live.keep_speeds(
            live.stream_rows(spark, fact.schema, landed), speeds, late, state, checkpoint, changes=changes))
    return speeds


@query(_PING_SPEED)
def stream_speed(spark, sf):
    return _ping_speed_output(live.speeds_so_far(spark, _streamed_speeds(spark, sf)))


@query(_PING_SPEED)
def stream_speed_shuffled(spark, sf):
    """The same with pings that arrive in three parts, each from all of the time: most are late."""
    return _ping_speed_output(live.speeds_so_far(spark, _streamed_speeds(spark, sf, parts=3)))


_WINDOWS = """select time_bucket(interval '15 minutes', data_hora_sp) as inicio,
    time_bucket(interval '15 minutes', data_hora_sp) + interval '15 minutes' as fim, cod_linha, count(*) as pings,
    count(*) filter (where velocidade_kmh > 5 and velocidade_kmh < 110) as pings_em_movimento,
    round(avg(velocidade_kmh) filter (where velocidade_kmh > 5 and velocidade_kmh < 110) + 1e-9, 6) as velocidade_media
    from {ping_speed} group by 1, 2, 3"""


def _streamed_windows(spark, sf, parts: int) -> DataFrame:
    changes, out = shared_folder(spark, "changes"), shared_folder(spark, "windows")
    _streamed_speeds(spark, sf, parts, changes)
    source = live.stream_rows(spark, live.CHANGES, f"{changes}/lote=*")
    _finish(live.keep_windows(source, out, shared_folder(spark, "late"), shared_folder(spark, "checkpoint")))
    return live.windows_so_far(spark, out).select(
        F.col("inicio").cast("timestamp_ntz").alias("inicio"), F.col("fim").cast("timestamp_ntz").alias("fim"),
        "cod_linha", "pings", "pings_em_movimento", _rounded("velocidade_media"))


@query(_WINDOWS)
def stream_window15(spark, sf):
    return _streamed_windows(spark, sf, 1)


@query(_WINDOWS)
def stream_window15_revised(spark, sf):
    """Windows whose speeds were revised by late pings."""
    return _streamed_windows(spark, sf, 2)
