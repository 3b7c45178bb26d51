"""Table and document schemas. All columns are nullable; px is longitude, py is latitude."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(), "date": T.DateType(),
}


def columns(names: str) -> T.StructType:
    """Columns as "name type, name type", for schemas that are needed before a session is there."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in names.split(","))])


def _table(*columns: tuple[str, str, str]) -> T.StructType:
    """Columns as (name, type, comment); the comment travels into the table DDL."""
    return T.StructType([
        T.StructField(name, _TYPES[kind], True, {"comment": comment}) for name, kind, comment in columns
    ])


AUDIT = (
    ("dt_ingestao", "timestamp", "When the run that brought the row started"),
    ("arquivo_origem", "string", "File or request the row came from"),
)
_HR = ("hr", "string", "Reference time given by the service")
_STOP = (
    ("cp", "int", "Stop code"),
    ("np", "string", "Stop name"),
    ("ed", "string", "Stop address"),
    ("py", "double", "Latitude of the stop"),
    ("px", "double", "Longitude of the stop"),
)
_FORECAST_STOP = (
    ("cp", "int", "Stop code"),
    ("np", "string", "Stop name"),
    ("py_parada", "double", "Latitude of the stop"),
    ("px_parada", "double", "Longitude of the stop"),
)
_FORECAST_VEHICLE = (
    ("p", "string", "Vehicle prefix"),
    ("t", "string", "Expected arrival time"),
    ("a", "boolean", "Vehicle is accessible"),
    ("ta", "string", "UTC time of the position, ISO 8601"),
    ("py", "double", "Latitude of the vehicle"),
    ("px", "double", "Longitude of the vehicle"),
)
_LINE = (
    ("cl", "int", "Line code"),
    ("lc", "boolean", "Line is circular"),
    ("lt", "string", "First part of the sign"),
    ("sl", "int", "Direction: 1 main to secondary terminal, 2 the reverse"),
    ("tl", "int", "Second part of the sign"),
    ("tp", "string", "Sign text, main to secondary terminal"),
    ("ts", "string", "Sign text, secondary to main terminal"),
)

# Flat tables made from the documents, without the audit columns.
BRONZE = {
    "posicao_veiculos": _table(
        _HR,
        ("cl", "int", "Line code"),
        ("c", "string", "Full sign"),
        ("sl", "int", "Direction: 1 main to secondary terminal, 2 the reverse"),
        ("lt1", "string", "Main terminal"),
        ("lt0", "string", "Secondary terminal"),
        ("p", "string", "Vehicle prefix"),
        ("a", "boolean", "Vehicle is accessible"),
        ("ta", "string", "UTC time of the position, ISO 8601"),
        ("py", "double", "Latitude of the vehicle"),
        ("px", "double", "Longitude of the vehicle"),
    ),
    "buscar_linhas": _table(*_LINE),
    "buscar_linhas_sentido": _table(*_LINE),
    "buscar_paradas": _table(*_STOP),
    "paradas_por_corredor": _table(*_STOP, ("cod_corredor", "int", "Corridor code asked for")),
    "paradas_por_linha": _table(*_STOP, ("cod_linha", "int", "Line code asked for")),
    "corredores": _table(("cc", "int", "Corridor code"), ("nc", "string", "Corridor name")),
    "empresas": _table(
        _HR,
        ("a", "int", "Operating area"),
        ("c", "int", "Company code"),
        ("n", "string", "Company name"),
    ),
    "previsao_chegada_parada": _table(
        _HR, *_FORECAST_STOP,
        ("c", "string", "Full sign"),
        ("cl", "int", "Line code"),
        ("sl", "int", "Direction: 1 main to secondary terminal, 2 the reverse"),
        ("lt0", "string", "Destination"),
        ("lt1", "string", "Origin"),
        ("qv", "int", "Vehicles located"),
        *_FORECAST_VEHICLE,
    ),
    "previsao_chegada_linha": _table(
        _HR, ("cod_linha", "int", "Line code asked for"), *_FORECAST_STOP, *_FORECAST_VEHICLE
    ),
}


def with_audit(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *_table(*AUDIT).fields])


# Nested documents as the service returns them.
VEHICLE_NOW = "struct<p string, a boolean, ta string, py double, px double>"
VEHICLE_DUE = "struct<p string, t string, a boolean, ta string, py double, px double>"
_LINE_HEAD = "c string, cl int, sl int, lt0 string, lt1 string, qv int"
_STOP_HEAD = "cp int, np string, py double, px double"

POSITIONS = f"struct<hr string, l array<struct<{_LINE_HEAD}, vs array<{VEHICLE_NOW}>>>>"
COMPANIES = "array<struct<hr string, e array<struct<a int, e array<struct<c int, n string>>>>>>"
STOP_FORECAST = f"struct<{_STOP_HEAD}, l array<struct<{_LINE_HEAD}, vs array<{VEHICLE_DUE}>>>>"
LINE_FORECAST = f"struct<{_STOP_HEAD}, vs array<{VEHICLE_DUE}>>"
LINES = "array<struct<cl int, lc boolean, lt string, sl int, tl int, tp string, ts string>>"
STOPS = "array<struct<cp int, np string, ed string, py double, px double>>"
CORRIDORS = "array<struct<cc int, nc string>>"

# Public columns of the ten static schedule files. Ids and times stay text: ids may have leading
# zeros and times run past 24:00:00.
GTFS = {
    "agency": "agency_id string, agency_name string, agency_url string, agency_timezone string, "
              "agency_lang string",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, "
                "saturday int, sunday int, start_date string, end_date string",
    "fare_attributes": "fare_id string, price double, currency_type string, payment_method int, "
                       "transfers int, transfer_duration int",
    "fare_rules": "fare_id string, route_id string, origin_id string, destination_id string, "
                  "contains_id string",
    "frequencies": "trip_id string, start_time string, end_time string, headway_secs int",
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, "
              "route_type int, route_color string, route_text_color string",
    "shapes": "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, "
              "shape_dist_traveled double",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, "
                  "stop_sequence int",
    "stops": "stop_id string, stop_name string, stop_desc string, stop_lat double, stop_lon double",
    "trips": "route_id string, service_id string, trip_id string, trip_headsign string, "
             "direction_id int, shape_id string",
}

# Every table by layer; the static files land in bronze with a gtfs_ prefix.
LAYERS = {
    "bronze": [*BRONZE, *(f"gtfs_{name}" for name in GTFS), "dias_sinal"],
    "silver": ["fato_posicao_veiculos", "dim_linhas", "dim_empresas", "mapa_shapes_gtfs", "ultimo_ping"],
    "gold": ["velocidade_linhas", "acessibilidade", "snapshot_frota_atual", "perfil_rota_estatico"],
}
