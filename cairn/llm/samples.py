"""Bounded samples that do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = 1 << 40


def bounded_sample(rows: DataFrame, keys: list[str], bound: int) -> DataFrame:
    """The at most ``bound`` rows with the smallest hash of ``keys``.

    A threshold on the hash, from the number of rows, leaves little more than
    ``bound`` rows before they are sorted in one place. ``rows`` is read
    twice, so it should be a table.
    """
    n = rows.count()
    place = F.pmod(F.xxhash64(*keys), F.lit(SPACE))
    if n > 2 * bound:
        rows = rows.where(place < int(SPACE * min(1.0, 1.2 * bound / n + 100 / n)))
    return rows.orderBy(place, *keys).limit(bound)
