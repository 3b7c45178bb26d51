"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the zone of the service, and the stamp of a run in names
LOCAL_ZONE = "America/Sao_Paulo"


def instant(text: Column) -> Column:
    """ISO-8601 text to a TIMESTAMP; null when it does not parse."""
    return F.try_to_timestamp(text)


def local_clock(moment: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall clock of ``zone`` at an instant, as TIMESTAMP_NTZ.

    The one-zone form of convert_timezone reads the instant in the session zone and shifts from
    that same zone, so the answer is the same whatever the session zone is.
    """
    return F.convert_timezone(None, F.lit(zone), moment)


def elapsed_hours(start: Column, end: Column) -> Column:
    """Whole seconds between two times, as a fraction of hours."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600


def run_stamp(run_time: datetime) -> str:
    """Stamp of one run, used in file and lineage names."""
    return run_time.strftime("%Y%m%d_%H%M%S")


def stamp_of(moment: Column) -> Column:
    """The same stamp for a timestamp column."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")
