"""Reduced facts: one array slot per day of the month.

``*_step`` functions are the daily loads (yesterday's month row FULL OUTER
JOIN today's aggregate). ``monthly_arrays`` builds the same month rows in
one pass: daily counts are aggregated first (partial, map-side), then each
(key, month) collects at most 31 (day, value) entries and lays them out on
the month's calendar, so a hot key never ships more than 31 values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.arrays import fill


def daily_metric(events: DataFrame, keys, value, name: str, time_col: str = "event_time") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (
        events.where(F.col(keys[0]).isNotNull())
        .groupBy(*keys, F.to_date(time_col).alias("day"))
        .agg(value.alias(name))
    )


def one_day_metric(events: DataFrame, key: str, day, value, name: str, time_col: str = "event_time") -> DataFrame:
    """One day's metric per key, grouped by the key alone (the day is a
    constant), so the result is partitioned on the join key of the step."""
    d = F.lit(day).cast("date")
    return (
        events.where(F.col(key).isNotNull() & (F.to_date(time_col) == d))
        .groupBy(key)
        .agg(value.alias(name))
        .withColumn("day", d)
    )


def monthly_arrays(daily: DataFrame, keys, metrics: list[str], anchor, fill_value=None) -> DataFrame:
    """Month rows ``(keys, month_start, first_found_date, <metric>_array...)``
    with one slot per day from the month start to the month end or
    ``anchor``. Idle days get ``fill_value`` (NULL or 0)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    a = F.lit(anchor).cast("date")
    per_month = (
        daily.where(F.col("day") <= a)
        .withColumn("month_start", F.trunc("day", "month"))
        .groupBy(*keys, "month_start")
        .agg(
            F.min("day").alias("first_found_date"),
            *[F.map_from_entries(F.collect_list(F.struct("day", m))).alias(f"_{m}") for m in metrics],
        )
    )
    days = F.sequence(F.col("month_start"), F.least(F.last_day("month_start"), a), F.expr("INTERVAL 1 DAY"))

    def layout(m):
        slot = lambda d: F.try_element_at(F.col(f"_{m}"), d)
        if fill_value is None:
            return F.transform(days, slot)
        return F.transform(days, lambda d: F.coalesce(slot(d), F.lit(fill_value)))

    return per_month.select(
        *keys, "month_start", "first_found_date", *[layout(m).alias(f"{m}_array") for m in metrics]
    )


def hits_array_step(prev: DataFrame, events: DataFrame, key: str, day, time_col: str = "event_time") -> DataFrame:
    """One day of ``monthly_user_site_hits`` (reference C17).

    ``prev`` is yesterday's partition; only its rows of the same month are
    carried (a month roll-over starts new arrays). Idle days are NULL;
    ``first_found_date`` keeps the earliest day (``least`` skips NULLs).
    """
    d = F.lit(day).cast("date")
    ms = F.trunc(d, "month")
    y = prev.where((F.col("date_partition") == F.date_sub(d, 1)) & (F.col("month_start") == ms)).alias("y")
    t = one_day_metric(events, key, d, F.count(F.lit(1)), "num_hits", time_col).alias("t")
    return y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full").select(
        F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
        F.concat(
            F.coalesce(F.col("y.hit_array"), fill(F.lit(None).cast("long"), F.datediff(d, ms))),
            F.array(F.col("t.num_hits")),
        ).alias("hit_array"),
        ms.alias("month_start"),
        F.least(F.col("y.first_found_date"), F.col("t.day")).alias("first_found_date"),
        d.alias("date_partition"),
    )


def metric_array_upsert_step(existing: DataFrame, events: DataFrame, key: str, day, metric_name: str,
                             time_col: str = "event_time") -> DataFrame:
    """One day of ``array_metrics`` (reference C18): zero-filled arrays keyed
    by (key, month_start, metric_name). Returns the month's rows to upsert.

    Idempotent: a row whose array already covers ``day`` is left as it is,
    so re-running a day does not append twice.
    """
    d = F.lit(day).cast("date")
    ms = F.trunc(d, "month")
    offset = F.datediff(d, ms)
    ya = existing.where((F.col("month_start") == ms) & (F.col("metric_name") == metric_name)).alias("ya")
    da = one_day_metric(events, key, d, F.count(F.lit(1)), "n", time_col).alias("da")
    today = F.array(F.coalesce(F.col("da.n"), F.lit(0)).cast("long"))
    arr = (
        F.when(F.col("ya.metric_array").isNull(), F.concat(fill(F.lit(0).cast("long"), offset), today))
        .when(F.size("ya.metric_array") == offset, F.concat("ya.metric_array", today))
        .otherwise(F.col("ya.metric_array"))
    )
    return da.join(ya, F.col(f"da.{key}") == F.col(f"ya.{key}"), "full").select(
        F.coalesce(F.col(f"da.{key}"), F.col(f"ya.{key}")).alias(key),
        ms.alias("month_start"),
        F.lit(metric_name).alias("metric_name"),
        arr.alias("metric_array"),
    )


def zero_filled_step(existing: DataFrame, today: DataFrame, key: str, metrics: list[str], day) -> DataFrame:
    """One day of a month table with one zero-filled array per metric.

    ``existing`` holds (key, month_start, <metric>_array...), ``today`` one
    row per active key with the day's metrics. Returns the month's rows; an
    array that already covers ``day`` stays as it is, so a day can be run
    again.
    """
    d = F.lit(day).cast("date")
    ms = F.trunc(d, "month")
    offset = F.datediff(d, ms)
    y = existing.where(F.col("month_start") == ms).alias("y")
    t = today.alias("t")

    def appended(m):
        old, value = F.col(f"y.{m}_array"), F.array(F.coalesce(F.col(f"t.{m}"), F.lit(0)).cast("long"))
        fresh = F.concat(fill(F.lit(0).cast("long"), offset), value)
        return F.when(old.isNull(), fresh).when(F.size(old) == offset, F.concat(old, value)).otherwise(old)

    return y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full").select(
        F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
        *[appended(m).alias(f"{m}_array") for m in metrics],
        ms.alias("month_start"),
    )


def array_to_daily(arrays: DataFrame, array_col: str, group_cols: list[str], start_col: str = "month_start") -> DataFrame:
    """Element-wise sums of arrays to one row per date (reference C19):
    ``posexplode`` + partial aggregation; the array length is unbounded."""
    exploded = arrays.select(*group_cols, start_col, F.posexplode(array_col).alias("pos", "v"))
    return exploded.groupBy(*group_cols, start_col, "pos").agg(
        F.sum(F.coalesce("v", F.lit(0))).alias("value")
    ).select(*group_cols, F.date_add(start_col, F.col("pos")).alias("adjusted_date"), "value")


def positional_sums(arrays: DataFrame, array_col: str, group_col: str, names: list[str]) -> DataFrame:
    """``SUM(COALESCE(get(a, i), 0))`` for fixed positions (reference C20)."""
    return arrays.groupBy(group_col).agg(
        *[F.sum(F.coalesce(F.get(array_col, i), F.lit(0))).alias(n) for i, n in enumerate(names)]
    )
