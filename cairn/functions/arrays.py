"""Array helpers with PostgreSQL-like semantics on top of Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_arrays(left: Column, right: Column) -> Column:
    """``a || b`` where a NULL side counts as empty (Spark's concat is NULL)."""
    return F.concat(F.coalesce(left, F.array()), F.coalesce(right, F.array()))


def append_if(arr: Column, cond: Column, element: Column) -> Column:
    """``coalesce(arr, []) || CASE WHEN cond THEN [element] ELSE [] END``."""
    return F.concat(
        F.coalesce(arr, F.array()),
        F.when(cond, F.array(element)).otherwise(F.array()),
    )


def at1(arr: Column, i) -> Column:
    """1-based subscript, NULL when out of range (never raises in ANSI mode)."""
    idx = i if isinstance(i, Column) else F.lit(i)
    return F.try_element_at(arr, idx)


def last(arr: Column) -> Column:
    """Last element or NULL for an empty/NULL array."""
    return F.try_element_at(arr, F.lit(-1))


def fill(value: Column, n: Column) -> Column:
    """``ARRAY_FILL(value, ARRAY[n])``; n <= 0 gives an empty array."""
    return F.array_repeat(value, F.greatest(n, F.lit(0)))


def render(arr: Column, null_text: str = "null", sep: str = ",") -> Column:
    """Deterministic text form of a scalar array (for comparison outputs)."""
    return F.concat_ws(
        sep, F.transform(arr, lambda x: F.coalesce(x.cast("string"), F.lit(null_text)))
    )


def render_dates(arr: Column, sep: str = ",") -> Column:
    """Sorted ``yyyy-MM-dd`` list of a date array."""
    return F.concat_ws(
        sep, F.transform(F.array_sort(arr), lambda d: F.date_format(d, "yyyy-MM-dd"))
    )
