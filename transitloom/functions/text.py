"""Text, key and display expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: shown for a missing sign or route name, and tested for when hiding ghost lines
UNKNOWN_SIGN = "?"
UNKNOWN_ROUTE = "Desc. Indisponível"


def sign_code(number: Column, kind: Column) -> Column:
    """Sign shown on the bus, such as 1012-10; null when either part is null."""
    return F.concat(number, F.lit("-"), kind.cast("string"))


def route_label(sign: Column, route: Column) -> Column:
    """Display label: sign, bar, route name, with placeholders for missing parts."""
    return F.concat(
        F.coalesce(sign, F.lit(UNKNOWN_SIGN)), F.lit(" | "), F.coalesce(route, F.lit(UNKNOWN_ROUTE))
    )


def key_text(value: Column) -> Column:
    """Key of any type as comparable text: cut at the first dot and trimmed (123.0 -> 123)."""
    return F.trim(F.substring_index(value.cast("string"), ".", 1))


def is_truthy(value: Column) -> Column:
    """True for a boolean, or its text or number form; false for null."""
    return F.coalesce(F.lower(value.cast("string")).isin("true", "1"), F.lit(False))


def number_or_null(value: Column) -> Column:
    """Lenient numeric parse."""
    return value.try_cast("double")


def fixed_point(value: Column, places: int) -> Column:
    """Number as text without grouping, e.g. 12.3."""
    return F.replace(F.format_number(value, places), F.lit(","), F.lit(""))


def grouped(value: Column, places: int = 0) -> Column:
    """Number as text with thousands separators, e.g. 1,234."""
    return F.format_number(value, places)
