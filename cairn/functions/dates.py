"""Date helpers matching the SQL forms used by the reference."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(ts: Column) -> Column:
    """``DATE_TRUNC('day', ts)`` / ``DATE(ts)`` as a DATE."""
    return F.to_date(ts)


def month_start(d: Column) -> Column:
    """``DATE_TRUNC('month', d)`` as a DATE (``date_trunc`` gives a timestamp)."""
    return F.trunc(d, "month")


def parse_iso_millis(text: Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'`` text to TIMESTAMP; malformed -> NULL."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
