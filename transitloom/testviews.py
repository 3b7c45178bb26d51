"""Input shapes derived from the generated test tables.

Each view is one SQL text that DuckDB and, but for two spellings, Spark run, so a query and its
oracle read the same rows. In the texts ``{name}`` stands for a generated table or an earlier view.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}

VIEWS = {
    # Bronze positions. Every tenth event is reported again later with other values; some directions
    # are null.
    "raw_pings": """
        select event_id, 1 as run, cast(user_id as string) as p, cast(event_id % 27 as int) as cl,
          cast(case when event_id % 97 = 0 then null else 1 + event_id % 2 end as int) as sl,
          event_type in ('click', 'view') as a, ts as signal_ts,
          cast(-23.55 as double) + (value - 250) / 100 as py,
          cast(-46.63 as double) + cast((event_id * 37) % 500 - 250 as double) / 100 as px,
          ts + interval '15' minute as dt_ingestao
        from {events}
        union all
        select event_id, 2, cast(user_id as string), cast(event_id % 27 as int), 2, false, ts,
          cast(-23.0 as double), cast(-46.0 as double), ts + interval '30' minute
        from {events} where event_id % 10 = 0""",
    # The same with ids that are no numbers, times missing or unreadable, and places missing.
    "raw_bad": """
        select event_id, run, case when event_id % 31 = 0 then 'x' || p else p end as p, cl, sl, a,
          case when event_id % 50 < 2 then null else signal_ts end as signal_ts,
          case when event_id % 50 = 1 then 'soon' end as odd_time,
          case when event_id % 41 = 0 then null else py end as py, px, dt_ingestao
        from {raw_pings}""",
    # Cleaned fact, no shift of the clock. Some lines are not in the dimension.
    "fact": """
        select ts as data_hora_sp, cast(user_id as int) as prefixo_veiculo,
          cast(event_id % 27 as int) as cod_linha,
          cast(-23.55 as double) + (value - 250) / 100 as latitude,
          cast(-46.63 as double) + cast((event_id * 37) % 500 - 250 as double) / 100 as longitude,
          case when event_id % 97 <> 0 and event_id % 2 = 0 then 'Ida' else 'Volta' end as sentido_desc,
          event_type in ('click', 'view') as is_acessivel, cast(ts as date) as data_referencia
        from {events}""",
    # Two runs per line, the latest wins; some signs are null.
    "raw_lines": """
        select cast(s_suppkey as int) as cl, s_suppkey % 7 = 0 as lc,
          cast(1000 + s_suppkey as string) as lt, cast(1 + s_suppkey % 2 as int) as sl,
          cast(case when s_suppkey % 11 = 10 then null else s_nationkey end as int) as tl,
          s_name || ' A v' || cast(v as string) as tp, s_name || ' B v' || cast(v as string) as ts,
          case when v = 1 then timestamp '2024-01-01 00:00:00'
               else timestamp '2024-01-02 00:00:00' end as dt_ingestao
        from (select *, unnest([1, 2]) as v from {supplier}) runs where s_suppkey % 13 <> 12""",
    # Some signs missing, some twice.
    "gtfs_routes": """
        select cast(1000 + s_suppkey as string) || '-' || cast(s_nationkey as string) as route_short_name,
          case when s_suppkey % 4 = 0 then 'SÃO ' else '' end || r_name || ' ' || n_name as route_long_name
        from {supplier} join {nation} on s_nationkey = n_nationkey
          join {region} on n_regionkey = r_regionkey where s_suppkey % 5 <> 4
        union all
        select cast(1000 + s_suppkey as string) || '-' || cast(s_nationkey as string),
          case when s_suppkey % 4 = 0 then 'SÃO ' else '' end || r_name || ' ' || n_name || ' alt'
        from {supplier} join {nation} on s_nationkey = n_nationkey
          join {region} on n_regionkey = r_regionkey where s_suppkey % 5 <> 4 and s_suppkey % 3 = 0""",
    # Two runs, the area differs between them.
    "raw_companies": """
        select cast(s_suppkey as int) as c, s_name as n, cast((s_nationkey + v) % 8 as int) as a,
          case when v = 1 then timestamp '2024-01-01 00:00:00'
               else timestamp '2024-01-02 00:00:00' end as dt_ingestao
        from (select *, unnest([1, 2]) as v from {supplier}) runs""",
    # Polylines, some of a single point.
    "shapes": """
        select l_orderkey as shape_id,
          cast(row_number() over (partition by l_orderkey
            order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as int)
            as shape_pt_sequence,
          cast(-23.55 as double) + (l_quantity - 25) / 500 as shape_pt_lat,
          cast(-46.63 as double) + cast(l_partkey % 100 - 50 as double) / 500 as shape_pt_lon
        from {lineitem}""",
    # Trips; some have no shape. Routes carry the signs of the lines.
    "trips": """
        select o_orderkey as trip_id, o_orderkey as shape_id,
          cast(1000 + s_suppkey as string) || '-' || cast(s_nationkey as string) as route_id,
          o_orderpriority as trip_headsign
        from {orders} join {supplier} on o_custkey % (select count(*) from {supplier}) = s_suppkey""",
    "stops": """
        select cast(p_partkey as int) as cp, p_name as np, p_brand || ' ' || p_type as ed,
          cast(-23.55 as double) + cast(p_size as double) / 100 as py,
          cast(-46.63 as double) + cast(p_partkey % 97 as double) / 100 as px,
          cast(p_size % 10 as int) as cod_corredor,
          case when p_partkey % 13 = 0 then 'X' || cast(p_partkey as string)
               else cast(p_partkey as string) end as stop_id
        from {part}""",
    # Arrivals: stop, line and vehicle of each event; documents hold at most 500 of them.
    "forecasts": """
        select event_id, event_id // 500 as page, cast(user_id % 50 as int) as cp,
          cast(event_id % 25 as int) as cl, cast(user_id as string) as p,
          event_type in ('click', 'view') as a, value as py
        from {events}""",
}


_SPARK_SPELLING = {"//": "div", "unnest([1, 2])": "explode(array(1, 2))"}


def _names_in(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    sql = VIEWS[name]
    for duck, ours in _SPARK_SPELLING.items():
        sql = sql.replace(duck, ours)
    return spark.sql(sql, **{t: (table if t in TABLES else view)(spark, sf_dir, t) for t in _names_in(sql)})


def spread_terms(df: DataFrame, text: Column, terms: int = 9) -> DataFrame:
    """One row per search term (1 to ``terms``) found in ``text``; rows without a hit vanish."""
    hits = F.filter(F.sequence(F.lit(1), F.lit(terms)), lambda t: F.contains(text, t.cast("string")))
    return df.withColumn("term", F.explode(hits))


def oracle(sql: str) -> str:
    """DuckDB text: ``{view}`` references in ``sql`` become common table expressions."""
    parts = {}

    def add(text: str) -> None:
        for name in _names_in(text):
            if name in VIEWS and name not in parts:
                add(VIEWS[name])
                parts[name] = VIEWS[name]
            elif name in ORACLE_PLANS and name not in parts:
                add(ORACLE_PLANS[name])
                parts[name] = ORACLE_PLANS[name]

    add(sql)
    ctes = ",\n".join(f"{name} as ({body})" for name, body in parts.items())
    text = (f"with {ctes}\n" if ctes else "") + sql
    return re.sub(r"\{(\w+)\}", r"\1", text)


# The measures in SQL, for the oracles only.
ORACLE_PLANS = {
    "dim_linhas": """
        select l.*, r.letreiro_gtfs, r.nome_rota_oficial from (
          select cl as cod_linha, lc as is_circular, lt || '-' || cast(tl as varchar) as letreiro_completo,
            tp as nome_api_tp_ts, ts as nome_api_ts_tp, sl as sentido_api
          from {raw_lines} qualify row_number() over (partition by cl order by dt_ingestao desc) = 1) l
        left join (
          select route_short_name as letreiro_gtfs, min(route_long_name) as nome_rota_oficial
          from {gtfs_routes} group by 1) r on l.letreiro_completo = r.letreiro_gtfs""",
    # Distance by the chord between two points of the unit sphere, not by the formula of the library.
    "ping_points": """
        select *, cos(radians(latitude)) * cos(radians(longitude)) as ux, cos(radians(latitude)) * sin(radians(longitude)) as uy,
          sin(radians(latitude)) as uz from {fact}""",
    "ping_speed": """
        select data_hora_sp, prefixo_veiculo, cod_linha, latitude, longitude, sentido_desc, data_referencia,
          prev.latitude as lat_prev, prev.longitude as lon_prev, prev.data_hora_sp as time_prev, dist_km, tempo_horas,
          round(dist_km / nullif(tempo_horas, 0), 1) as velocidade_kmh
        from (
          select *, round(2 * 6371 * asin(least(1, sqrt((ux - prev.ux) ** 2 + (uy - prev.uy) ** 2 + (uz - prev.uz) ** 2) / 2)), 4) as dist_km,
            date_diff('second', date_trunc('second', prev.data_hora_sp), date_trunc('second', data_hora_sp)) / 3600 as tempo_horas
          from (select p.*, lag(p) over (partition by prefixo_veiculo order by data_hora_sp) as prev from {ping_points} p)
          where prev.latitude is not null)""",
    "velocidade": """
        select k.*, d.* exclude (cod_linha) from (
          select cod_linha, sentido_desc, data_referencia, avg(velocidade_kmh) as velocidade_media,
            avg(latitude) as lat_centroide, avg(longitude) as lon_centroide
          from {ping_speed} where velocidade_kmh > 5 and velocidade_kmh < 110 group by all) k
        left join {dim_linhas} d on k.cod_linha = d.cod_linha""",
    "acessibilidade": """
        select d.nome_api_tp_ts, d.letreiro_completo, k.cod_linha,
          round(acc / nullif(total, 0) * 100, 2) as percentual_acessibilidade,
          total as total_veiculos_reportados, data_referencia
        from (select cod_linha, data_referencia, count(prefixo_veiculo) as total,
                count(*) filter (where is_acessivel) as acc from {fact} group by all) k
        left join {dim_linhas} d on k.cod_linha = d.cod_linha""",
    "snapshot": """
        select * from {fact}
        qualify row_number() over (partition by prefixo_veiculo order by data_hora_sp desc) = 1""",
    "shape_points": """
        select shape_id, shape_pt_sequence as place, cos(radians(shape_pt_lat)) * cos(radians(shape_pt_lon)) as ux,
          cos(radians(shape_pt_lat)) * sin(radians(shape_pt_lon)) as uy, sin(radians(shape_pt_lat)) as uz from {shapes}""",
    "comprimento": """
        select a.shape_id, cast(sum(2 * 6371 * asin(least(1, sqrt((a.ux - b.ux) ** 2 + (a.uy - b.uy) ** 2 + (a.uz - b.uz) ** 2) / 2)))
            as decimal(10, 2)) as extensao_km
        from {shape_points} a join {shape_points} b on a.shape_id = b.shape_id and b.place = a.place + 1
        group by a.shape_id""",
    "perfil": """
        select route_id as letreiro_gtfs,
          round(cast(sum(extensao_km) as double) / count(*), 6) as extensao_km,
          cast(floor(round(cast(sum(extensao_km) as double) / count(*), 6) * 3) as int)
            as qtd_paradas_estimada
        from {trips} join {comprimento} using (shape_id) group by 1""",
    "painel_tudo": """
        select v.cod_linha, v.sentido_desc, cast(v.data_referencia as varchar) as data_referencia,
          coalesce(v.letreiro_completo, '?') as letreiro_completo,
          coalesce(v.nome_rota_oficial, 'Desc. Indisponível') as nome_rota_oficial,
          coalesce(v.letreiro_completo, '?') || ' | ' || coalesce(v.nome_rota_oficial, 'Desc. Indisponível')
            as "Rota",
          v.velocidade_media, coalesce(f.n, 0) as "Qtd_Veiculos", coalesce(f.acc, 0) as "Acessiveis",
          coalesce(p.extensao_km, (select avg(extensao_km) from {perfil}), 15.0) as extensao_km,
          p.qtd_paradas_estimada
        from {velocidade} v
        left join (select cod_linha, count(prefixo_veiculo) as n, count(*) filter (where is_acessivel) as acc
                   from {snapshot} where data_referencia = (select max(data_referencia) from {velocidade})
                   group by 1) f on v.cod_linha = f.cod_linha
        left join {perfil} p on v.letreiro_completo = p.letreiro_gtfs
        where v.data_referencia = (select max(data_referencia) from {velocidade})""",
    "painel": """
        select *, extensao_km / nullif(velocidade_media, 0) as tempo_estimado_h,
          coalesce("Acessiveis" / nullif("Qtd_Veiculos", 0), 0) * 100 as "Perc_Acessivel",
          case when "Acessiveis" >= "Qtd_Veiculos" and "Qtd_Veiculos" > 0 then 'full'
               when "Acessiveis" > 0 and "Qtd_Veiculos" > 0 then 'partial' else 'none' end
            as "Status_Acessibilidade"
        from {painel_tudo}
        where letreiro_completo <> '?' and nome_rota_oficial <> 'Desc. Indisponível' and "Qtd_Veiculos" > 0""",
}


# -- nested documents ---------------------------------------------------------------------------
# A document holds one page of consecutive events, stops, lines or companies, so its size is bounded.
# Some arrays end with a null element, some documents lack the array, and a single element may come
# as a lone object.

EVENTS_PER_DOC = 500
ITEMS_PER_DOC = 200


def iso(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _text(value: Column) -> Column:
    return value.cast("string")


def _some_null(items: Column, when: Column) -> Column:
    return F.when(when, F.concat(items, F.array(F.lit(None)))).otherwise(items)


def position_docs(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """Positions of one page of events and one report run: lines, each with vehicles. ``keys``: page, run."""
    line = (
        view(spark, sf_dir, "raw_pings")
        .withColumn("page", F.expr(f"event_id div {EVENTS_PER_DOC}"))
        .groupBy("page", "run", "cl", "sl")
        .agg(F.collect_list(F.struct("p", "a", iso("signal_ts").alias("ta"), "py", "px")).alias("vs"))
    )
    cl = _text(F.col("cl"))
    doc = line.groupBy("page", "run").agg(F.collect_list(F.struct(
        F.concat(F.lit("S"), cl).alias("c"), "cl", "sl", F.concat(F.lit("T"), cl).alias("lt0"),
        F.concat(F.lit("U"), cl).alias("lt1"), F.size("vs").alias("qv"),
        _some_null(F.col("vs"), F.col("cl") % 5 == 0).alias("vs"),
    )).alias("l"))
    hr = F.when(F.col("page") % 7 != 0, F.concat(_text(F.col("page")), F.lit(":"), _text(F.col("run"))))
    full = F.to_json(F.struct(hr.alias("hr"), _some_null(F.col("l"), F.col("page") % 3 == 0).alias("l")))
    hollow = F.array(full, F.lit('{"hr":"12:00"}'), F.lit('{"hr":"12:00","l":null}'),
                     F.lit('{"hr":"12:00","l":[{"cl":1},{"cl":2,"vs":null}]}'), F.lit("not json"))
    return doc.select(*keys, F.explode(F.when(F.col("page") % 4 == 0, hollow).otherwise(F.array(full))).alias("body"))


def company_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies of one page: areas, each with companies; alternating a lone object and a list."""
    area = (
        view(spark, sf_dir, "raw_companies")
        .withColumn("page", F.expr(f"c div {ITEMS_PER_DOC}"))
        .groupBy("page", "dt_ingestao", "a").agg(F.collect_list(F.struct("c", "n")).alias("e"))
    )
    doc = area.groupBy("page", "dt_ingestao").agg(F.collect_list(F.struct("a", "e")).alias("e"))
    single = F.struct(F.date_format("dt_ingestao", "dd/MM").alias("hr"), "e")
    lone = F.col("page") + F.dayofmonth("dt_ingestao")
    return doc.select(
        F.when(lone % 2 == 0, F.to_json(single))
        .otherwise(F.to_json(F.array(single, F.lit(None)))).alias("body"),
        "dt_ingestao",
    )


def _vehicle_due() -> Column:
    return F.struct(
        "p", F.concat(F.lit("t"), _text(F.col("event_id"))).alias("t"), "a",
        F.concat(F.lit("e"), _text(F.col("event_id"))).alias("ta"), "py", (-F.col("py")).alias("px"),
    )


def _stop_head() -> list[Column]:
    return [F.col("cp"), F.concat(F.lit("stop "), _text(F.col("cp"))).alias("np"),
            (F.col("cp") / 10).alias("py"), (-F.col("cp") / 10).alias("px")]


def _lone_or_list(hr: Column, field: str) -> Column:
    return F.when(
        F.size(field) == 1, F.to_json(F.struct(hr.alias("hr"), F.col(field)[0].alias(field)))
    ).otherwise(F.to_json(F.struct(hr.alias("hr"), F.col(field))))


def stop_forecast_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals by stop. Every third page asks stop by stop, so its documents hold a lone object."""
    line = (
        view(spark, sf_dir, "forecasts")
        .withColumn("asked", F.when(F.col("page") % 3 == 0, F.col("cp")).otherwise(-1))
        .groupBy("page", "asked", "cp", "cl").agg(F.collect_list(_vehicle_due()).alias("vs"))
    )
    cl = _text(F.col("cl"))
    stop = line.groupBy("page", "asked", "cp").agg(F.collect_list(F.struct(
        F.concat(F.lit("S"), cl).alias("c"), "cl", (1 + F.col("cl") % 2).cast("int").alias("sl"),
        F.concat(F.lit("T"), cl).alias("lt0"), F.concat(F.lit("U"), cl).alias("lt1"),
        F.size("vs").alias("qv"), "vs",
    )).alias("l"))
    doc = stop.groupBy("page", "asked").agg(F.collect_list(F.struct(*_stop_head(), "l")).alias("p"))
    return doc.select(_lone_or_list(_text(F.col("page")), "p").alias("body"))


def line_forecast_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals by line, with the line asked for as a column of its own."""
    stop = (
        view(spark, sf_dir, "forecasts").groupBy("page", "cl", "cp")
        .agg(F.collect_list(_vehicle_due()).alias("vs"))
    )
    doc = stop.groupBy("page", "cl").agg(F.collect_list(F.struct(*_stop_head(), "vs")).alias("ps"))
    return doc.select(F.col("cl").alias("cod_linha"), _lone_or_list(_text(F.col("page")), "ps").alias("body"))


def list_docs(rows: DataFrame, keys: list[str], page_of: str, *columns: str) -> DataFrame:
    """Flat list documents by key, a bounded page of rows each."""
    paged = rows.withColumn("page", F.expr(f"{page_of} div {ITEMS_PER_DOC}"))
    return paged.groupBy(*keys, "page").agg(
        F.to_json(_some_null(F.collect_list(F.struct(*columns)), F.min("page") % 2 == 0)).alias("body")
    ).drop("page")


LINE_COLUMNS = ("cl", "lc", "lt", "sl", "tl", "tp", "ts")
STOP_COLUMNS = ("cp", "np", "ed", "py", "px")


def line_docs(spark: SparkSession, sf_dir: str, by_direction: bool = False) -> DataFrame:
    """Line search results by term, or by term and direction."""
    found = spread_terms(view(spark, sf_dir, "raw_lines"), F.col("lt"))
    keys = ["term", "dt_ingestao"]
    if by_direction:
        found, keys = found.withColumn("direction", F.col("sl")), [*keys, "direction"]
    return list_docs(found, keys, "cl", *LINE_COLUMNS)


def stop_docs(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Stop search results by ``term``, ``cod_corredor`` or ``cod_linha``."""
    stops = view(spark, sf_dir, "stops")
    if key == "term":
        stops = spread_terms(stops, F.col("ed"))
    elif key == "cod_linha":
        stops = stops.withColumn("cod_linha", (F.col("cp") % 27).cast("int"))
    return list_docs(stops, [key], "cp", *STOP_COLUMNS)


def corridor_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corridor lists, one per page of stops."""
    found = view(spark, sf_dir, "stops").select(
        F.expr(f"cp div {ITEMS_PER_DOC}").alias("page"), F.col("cod_corredor").alias("cc"),
        F.concat(F.lit("Corridor "), _text(F.col("cod_corredor"))).alias("nc"),
    ).distinct()
    return found.groupBy("page").agg(F.to_json(F.collect_list(F.struct("cc", "nc"))).alias("body")).drop("page")
