"""Cleaned fact, dimensions and map geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.functions.clock import LOCAL_ZONE, instant, local_clock
from transitloom.functions.text import sign_code
from transitloom.operators.ranking import first_per_key


# fixed values: names of the two directions
OUTBOUND, RETURN = "Ida", "Volta"


def direction_name(direction: Column) -> Column:
    """1 is outbound; anything else, null included, is the return."""
    return F.when(direction == 1, F.lit(OUTBOUND)).otherwise(F.lit(RETURN))


def clean_positions(rows: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Raw positions (one per vehicle and signal) to typed fact columns on local time."""
    moment = local_clock(instant(F.col("ta")), zone)
    return rows.select(
        moment.alias("data_hora_sp"),
        F.col("p").try_cast("int").alias("prefixo_veiculo"),
        F.col("cl").try_cast("int").alias("cod_linha"),
        F.col("py").alias("latitude"),
        F.col("px").alias("longitude"),
        direction_name(F.col("sl")).alias("sentido_desc"),
        F.col("a").alias("is_acessivel"),
    ).withColumn("data_referencia", F.to_date("data_hora_sp"))


def signal_day(zone: str = LOCAL_ZONE) -> Column:
    """The local day of a raw signal; null when its time does not parse."""
    return F.to_date(local_clock(instant(F.col("ta")), zone))


def position_fact(raw: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Position fact: the same signal of a vehicle is kept once, from its earliest ingest."""
    needed = raw.select("p", "ta", "dt_ingestao", "cl", "py", "px", "sl", "a")
    return clean_positions(first_per_key(needed, ["p", "ta"], "dt_ingestao"), zone)


def fact_quality(fact: DataFrame) -> DataFrame:
    """Rows the per-vehicle measures leave out, in one row."""
    return fact.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("prefixo_veiculo").isNull()).alias("without_vehicle"),
        F.count_if(F.col("data_hora_sp").isNull()).alias("without_time"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("without_place"),
    )


def line_dimension(raw_lines: DataFrame, routes: DataFrame) -> DataFrame:
    """Latest version of each line, with the official route name where the sign is known."""
    latest = first_per_key(
        raw_lines.select("cl", "dt_ingestao", "lc", "lt", "tl", "tp", "ts", "sl"),
        ["cl"], "dt_ingestao", newest=True,
    )
    lines = latest.select(
        F.col("cl").alias("cod_linha"),
        F.col("lc").alias("is_circular"),
        sign_code(F.col("lt"), F.col("tl")).alias("letreiro_completo"),
        F.col("tp").alias("nome_api_tp_ts"),
        F.col("ts").alias("nome_api_ts_tp"),
        F.col("sl").alias("sentido_api"),
    )
    names = first_per_key(
        routes.select(
            F.col("route_short_name").alias("letreiro_gtfs"),
            F.col("route_long_name").alias("nome_rota_oficial"),
        ),
        ["letreiro_gtfs"],
    )
    return lines.join(names, F.col("letreiro_completo") == F.col("letreiro_gtfs"), "left")


def company_dimension(raw_companies: DataFrame, keys: tuple[str, ...] = ("c",)) -> DataFrame:
    """Latest version of each company; ``keys=('c', 'a')`` keeps one row per company and area."""
    latest = first_per_key(
        raw_companies.select("c", "dt_ingestao", "n", "a"), list(keys), "dt_ingestao", newest=True
    )
    return latest.select(
        F.col("c").try_cast("int").alias("cod_empresa"),
        F.col("n").alias("nome_empresa"),
        F.col("a").try_cast("int").alias("cod_area_operacao"),
    )


def route_map(shapes: DataFrame, trips: DataFrame) -> DataFrame:
    """Polyline points labelled with the routes that run on them, one label per route and shape."""
    labels = first_per_key(trips.select("route_id", "shape_id", "trip_headsign"), ["route_id", "shape_id"])
    points = shapes.select("shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence")
    return points.join(labels, "shape_id").select(
        F.col("route_id").alias("letreiro_completo"),
        "shape_id",
        F.col("shape_pt_lat").alias("latitude"),
        F.col("shape_pt_lon").alias("longitude"),
        F.col("shape_pt_sequence").alias("sequencia"),
        F.col("trip_headsign").alias("destino_escrito"),
    )
