"""Nested service documents to flat rows.

Every parser takes a DataFrame with a text column ``body`` and any other columns (request key, ingest
time, source file). Those travel along unchanged in front of the parsed columns. Null or absent arrays give no rows,
null elements are skipped, an unreadable document gives no rows (see :func:`is_unreadable`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom import schemas

BODY = "body"


def _carried(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != BODY]


def _unnest(df: DataFrame, array: Column, name: str) -> DataFrame:
    """One row per non-null element of ``array``.

    The outer form, because a plain explode makes Spark test the array for emptiness below the
    projection that parses it, and so parse every document twice.
    """
    return df.withColumn(name, F.explode_outer(array)).filter(F.col(name).isNotNull())


def _fields(struct: str, *names: str) -> list[Column]:
    return [F.col(struct)[n].alias(n) for n in names]


def object_or_array(body: Column, field: str, element: str) -> Column:
    """Array under ``field`` of a document whose service sends a lone object for one element."""
    many = F.from_json(body, f"struct<{field}: array<{element}>>")[field]
    single = F.from_json(body, f"struct<{field}: {element}>")[field]
    return F.coalesce(many, _as_array(single))


def positions(docs: DataFrame) -> DataFrame:
    """Position document (lines, each with vehicles) to one row per vehicle."""
    keep = _carried(docs)
    doc = docs.select(*keep, F.from_json(BODY, schemas.POSITIONS).alias("doc")).select(
        *keep, F.coalesce("doc.hr", F.lit("00:00")).alias("hr"), F.col("doc.l").alias("lines")
    )
    line = _unnest(doc, F.col("lines"), "line").drop("lines")
    vehicle = _unnest(line, F.col("line.vs"), "v")
    return vehicle.select(
        *keep, "hr", *_fields("line", "cl", "c", "sl", "lt1", "lt0"), *_fields("v", "p", "a", "ta", "py", "px")
    )


def companies(docs: DataFrame) -> DataFrame:
    """Company document (areas, each with companies), one document or a list of them."""
    keep = _carried(docs)
    root = _unnest(docs.select(*keep, F.from_json(BODY, schemas.COMPANIES).alias("roots")), F.col("roots"), "root")
    area = _unnest(root.select(*keep, "root.hr", F.col("root.e").alias("areas")), F.col("areas"), "area")
    company = _unnest(area, F.col("area.e"), "company")
    return company.select(*keep, "hr", *_fields("area", "a"), *_fields("company", "c", "n"))


def _forecast_stops(docs: DataFrame, field: str, element: str) -> DataFrame:
    # one parse when the field is an array; only documents with a lone object are parsed again
    keep = _carried(docs)
    body = F.col(BODY)
    many = docs.select(*keep, BODY, F.from_json(body, f"struct<hr string, {field}: array<{element}>>").alias("doc"))
    lone = F.from_json(body, f"struct<hr string, {field}: {element}>")
    doc = many.select(*keep, F.when(F.col("doc")[field].isNotNull(), F.col("doc")).otherwise(
        F.struct(lone["hr"].alias("hr"), _as_array(lone[field]).alias(field))).alias("doc"))
    head = doc.select(*keep, F.col("doc.hr").alias("hr"), F.col("doc")[field].alias("stops"))
    return _unnest(head, F.col("stops"), "stop").drop("stops")


def _as_array(single: Column) -> Column:
    return F.when(single.isNotNull(), F.array(single))


def _stop_fields() -> list[Column]:
    return [
        *_fields("stop", "cp", "np"),
        F.col("stop.py").alias("py_parada"), F.col("stop.px").alias("px_parada"),
    ]


def stop_forecast(docs: DataFrame) -> DataFrame:
    """Arrivals at a stop (stops, lines, vehicles) to one row per expected vehicle."""
    keep = _carried(docs)
    line = _unnest(_forecast_stops(docs, "p", schemas.STOP_FORECAST), F.col("stop.l"), "line")
    vehicle = _unnest(line, F.col("line.vs"), "v")
    return vehicle.select(
        *keep, "hr", *_stop_fields(), *_fields("line", "c", "cl", "sl", "lt0", "lt1", "qv"),
        *_fields("v", "p", "t", "a", "ta", "py", "px"),
    )


def line_forecast(docs: DataFrame) -> DataFrame:
    """Arrivals of a line (stops, vehicles); the line key comes with the document row."""
    keep = _carried(docs)
    vehicle = _unnest(_forecast_stops(docs, "ps", schemas.LINE_FORECAST), F.col("stop.vs"), "v")
    return vehicle.select(*keep, "hr", *_stop_fields(), *_fields("v", "p", "t", "a", "ta", "py", "px"))


def _flat_list(docs: DataFrame, schema: str, options: dict[str, str] | None = None) -> DataFrame:
    keep = _carried(docs)
    parsed = docs.select(*keep, F.from_json(BODY, schema, options).alias("items"))
    return _unnest(parsed, F.col("items"), "item").select(*keep, "item.*")


def lines(docs: DataFrame) -> DataFrame:
    """Line search result."""
    return _flat_list(docs, schemas.LINES)


def stops(docs: DataFrame) -> DataFrame:
    """Stop search result; by corridor or by line, the key comes with the document row."""
    return _flat_list(docs, schemas.STOPS)


def corridors(docs: DataFrame) -> DataFrame:
    """Corridor list; an unreadable document fails the job."""
    return _flat_list(docs, schemas.CORRIDORS, {"mode": "FAILFAST"})


def is_unreadable(body: Column) -> Column:
    """True for a document that is missing or not JSON, for the run report."""
    return body.isNull() | F.try_parse_json(body).isNull()


def wrong_shape(body: Column, parse: str) -> Column:
    """True for a readable document whose list is there but not a list of what the parser expects.

    ``parse`` is one of SHAPES; null and empty answers are no fault.
    """
    field, shape = SHAPES[parse]
    given = F.get_json_object(body, f"$.{field}" if field else "$")
    blank = given.isNull() | F.trim(given).isin("[]", "{}", "null", "")
    found = F.from_json(body, shape)
    found = found[field] if field else found
    some = found.isNotNull() & ~F.forall(found, lambda x: x.isNull())
    if field in ("p", "ps"):  # a lone object stands for a list of one
        some = some | F.coalesce(given.startswith("{"), F.lit(False))
    return ~is_unreadable(body) & ~blank & ~F.coalesce(some, F.lit(False))


#: By parser: the field of its list (none if the document is the list), and how the list is read.
SHAPES = {
    "positions": ("l", schemas.POSITIONS), "companies": ("", schemas.COMPANIES),
    "stop_forecast": ("p", f"struct<p: array<{schemas.STOP_FORECAST}>>"), "line_forecast": ("ps", f"struct<ps: array<{schemas.LINE_FORECAST}>>"),
    "lines": ("", schemas.LINES), "stops": ("", schemas.STOPS), "corridors": ("", schemas.CORRIDORS),
}
