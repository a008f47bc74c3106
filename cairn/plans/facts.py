"""Registered queries: date lists, bit masks, monthly array metrics."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from cairn.functions import bits
from cairn.functions.arrays import render, render_dates
from cairn.operators import array_metrics as am
from cairn.operators import cumulative, datelist
from cairn.plans import oracle_sql as O
from cairn.plans import standins
from cairn.plans.registry import input_key, register, scalar
from cairn.session import cut_lineage

ANCHOR = "(SELECT max(CAST(event_time AS DATE)) FROM web_events)"
USER_DAYS = f"""user_days AS (
    SELECT DISTINCT user_id, CAST(event_time AS DATE) AS d FROM web_events
    WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= {ANCHOR}
)"""


def _events(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    anchor = scalar(ev, F.max(F.to_date("event_time")), input_key(sf_dir, "events", "max_day"))
    return ev, anchor


def _cumulated_view(df, keys):
    return df.select(
        *keys,
        F.size("dates_active").cast("long").alias("n_dates"),
        render_dates(F.col("dates_active")).alias("dates_active"),
        "date",
    )


USERS_CUMULATED_SQL = O.with_(O.WEB_EVENTS, USER_DAYS) + f"""
SELECT user_id, count(*) AS n_dates, string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d) AS dates_active,
       {ANCHOR} AS date
FROM user_days GROUP BY user_id"""


@register("users_cumulated", USERS_CUMULATED_SQL, ids=("C14", "S08", "F14", "F15"))
def users_cumulated(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    return _cumulated_view(cumulative.dates_cumulated(ev, "user_id", anchor), ["user_id"])


@register("users_cumulated_daily_load", USERS_CUMULATED_SQL, ids=("C14", "J01", "F01", "F17", "P05"))
def users_cumulated_daily_load(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    prev = cut_lineage(cumulative.dates_cumulated(ev, "user_id", anchor - timedelta(days=1)))
    return _cumulated_view(cumulative.dates_cumulated_step(prev, ev, "user_id", anchor), ["user_id"])


DAYS_BACK = f"date_diff('day', d, {ANCHOR})"


@register("users_cumulated_bucketed_load", USERS_CUMULATED_SQL, ids=("C14", "S15", "S22", "J12"))
def users_cumulated_bucketed_load(spark, sf_dir):
    """The snapshot two days before the anchor is stored as a table
    partitioned by date and bucketed by user; the last two days then run
    through ``run_daily_bucketed``, whose joins read yesterday as a bucketed
    scan and shuffle only the new day. Returns the anchor day's partition."""
    import uuid

    from cairn.plans.increments import run_daily_bucketed, write_bucketed_partition

    ev, anchor = _events(spark, sf_dir)
    table = f"users_cumulated_{uuid.uuid4().hex[:8]}"
    seed = cumulative.dates_cumulated(ev, "user_id", anchor - timedelta(days=2))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed_partition(seed, table, "user_id", buckets)
    run_daily_bucketed(
        spark, table, lambda prev, day: cumulative.dates_cumulated_step(prev, ev, "user_id", day),
        anchor - timedelta(days=1), anchor, seed.schema, "user_id", buckets,
    )
    final = spark.table(table).where(F.col("date") == F.lit(anchor))
    return _cumulated_view(final, ["user_id"])


def _bits_sql(days_expr: str) -> str:
    return (
        f"CAST(sum(CASE WHEN {days_expr} BETWEEN 0 AND 31 THEN CAST(1 AS BIGINT) << (31 - {days_expr}) ELSE 0 END) AS BIGINT)"
    )


@register(
    "user_datelist_int",
    O.with_(O.WEB_EVENTS, USER_DAYS)
    + f"SELECT user_id, {_bits_sql(DAYS_BACK)} AS datelist_int, {ANCHOR} AS date FROM user_days GROUP BY user_id",
    ids=("C15", "A07", "F09", "F18", "F20", "J09"),
)
def user_datelist_int(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    cum = cumulative.dates_cumulated(ev, "user_id", anchor)
    return datelist.datelist_int(cum, "user_id", anchor)


FLAGS_SQL = O.with_(O.WEB_EVENTS, USER_DAYS) + f""", masks AS (
    SELECT user_id, {_bits_sql(DAYS_BACK)} AS datelist_int FROM user_days GROUP BY user_id
)
SELECT user_id, datelist_int, lpad(bin(datelist_int), 32, '0') AS datelist_bits,
       bit_count(datelist_int) > 0 AS monthly_active,
       CAST(bit_count(datelist_int) AS INTEGER) AS l32,
       bit_count(datelist_int & {bits.mask(0, 7)}) > 0 AS weekly_active,
       CAST(bit_count(datelist_int & {bits.mask(0, 7)}) AS INTEGER) AS l7,
       bit_count(datelist_int & {bits.mask(7, 7)}) > 0 AS weekly_active_previous_week
FROM masks"""


@register("datelist_activity_flags", FLAGS_SQL, ids=("C16", "F21", "F22"))
def datelist_activity_flags(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    masks = datelist.datelist_int_from_events(ev, "user_id", anchor)
    return datelist.activity_flags(masks, "user_id").withColumn("datelist_bits", bits.bit_string(F.col("datelist_int")))


BROWSER_DAYS = f"""browser_days AS (
    SELECT DISTINCT e.user_id, coalesce(dv.browser_type, 'unknown') AS browser_type, CAST(e.event_time AS DATE) AS d
    FROM web_events e JOIN devices dv ON e.device_id = dv.device_id
    WHERE e.user_id IS NOT NULL AND CAST(e.event_time AS DATE) <= {ANCHOR}
)"""


USER_DEVICES_SQL = (
    O.with_(O.DEVICES, BROWSER_DAYS)
    + f"""SELECT user_id, browser_type, count(*) AS n_dates,
       string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d) AS dates_active, {ANCHOR} AS date
FROM browser_days GROUP BY user_id, browser_type"""
)


@register("user_devices_cumulated", USER_DEVICES_SQL, ids=("C32",))
def user_devices_cumulated(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    dv = standins.devices(spark, sf_dir)
    m = cumulative.device_activity_datelist(ev, dv, anchor)
    exploded = m.select("user_id", "date", F.explode("device_activity_datelist").alias("browser_type", "dates_active"))
    return _cumulated_view(exploded, ["user_id", "browser_type"])


@register(
    "user_devices_datelist_int",
    O.with_(O.DEVICES, BROWSER_DAYS)
    + f"""SELECT user_id, browser_type, {_bits_sql(DAYS_BACK)} AS datelist_int, {ANCHOR} AS date
FROM browser_days GROUP BY user_id, browser_type""",
    ids=("C33",),
)
def user_devices_datelist_int(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    dv = standins.devices(spark, sf_dir).select("device_id", F.coalesce("browser_type", F.lit("unknown")).alias("browser_type"))
    joined = ev.join(dv, "device_id")
    return datelist.datelist_int_from_events(joined, ["user_id", "browser_type"], anchor)


HOSTS_CUMULATED_SQL = (
    O.with_(O.WEB_EVENTS)
    + f""", host_days AS (
    SELECT DISTINCT host, CAST(event_time AS DATE) AS d FROM web_events
    WHERE host IS NOT NULL AND CAST(event_time AS DATE) <= {ANCHOR}
)
SELECT host, count(*) AS n_dates, string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d) AS dates_active, {ANCHOR} AS date
FROM host_days GROUP BY host"""
)


@register("hosts_cumulated", HOSTS_CUMULATED_SQL, ids=("C34",))
def hosts_cumulated(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    return _cumulated_view(cumulative.dates_cumulated(ev, "host", anchor), ["host"])


def _daily_load(spark, seed, step, anchor, name):
    """Store ``seed`` (two days before the anchor), load the last two days
    through partitioned storage, the last one twice, and read its partition."""
    from cairn.plans.increments import run_daily
    from cairn.session import scratch_path
    from cairn.sources.catalog import write_partition

    path = scratch_path(spark, f"{name}_{uuid.uuid4().hex}")
    write_partition(seed, path, ["date"])
    run_daily(spark, path, step, anchor - timedelta(days=1), anchor, seed.schema)
    run_daily(spark, path, step, anchor, anchor, seed.schema)  # a re-run replaces its day
    return spark.read.parquet(path).where(F.col("date") == F.lit(anchor))


@register("hosts_cumulated_daily_load", HOSTS_CUMULATED_SQL, ids=("C34", "J01", "S15"))
def hosts_cumulated_daily_load(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    seed = cumulative.dates_cumulated(ev, "host", anchor - timedelta(days=2))
    step = lambda prev, day: cumulative.dates_cumulated_step(prev, ev, "host", day)
    return _cumulated_view(_daily_load(spark, seed, step, anchor, "hosts_cumulated"), ["host"])


@register("user_devices_cumulated_daily_load", USER_DEVICES_SQL, ids=("C32", "J01", "S15"))
def user_devices_cumulated_daily_load(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    dv = standins.devices(spark, sf_dir).select("device_id", F.coalesce("browser_type", F.lit("unknown")).alias("browser_type"))
    used, keys = ev.join(dv, "device_id"), ["user_id", "browser_type"]
    seed = cumulative.dates_cumulated(used, keys, anchor - timedelta(days=2))
    step = lambda prev, day: cumulative.dates_cumulated_step(prev, used, keys, day)
    return _cumulated_view(_daily_load(spark, seed, step, anchor, "user_devices_cumulated"), keys)


def _month_slots(key_sql: str, daily: str) -> str:
    """SQL: one row per (key, month, day slot) for months with activity."""
    return f"""months AS (
    SELECT {key_sql}, date_trunc('month', day) AS month_start, min(day) AS first_found_date FROM {daily}
    GROUP BY ALL
),
slots AS (
    SELECT {key_sql}, CAST(month_start AS DATE) AS month_start, first_found_date,
           CAST(unnest(generate_series(month_start, least(last_day(month_start), {ANCHOR}), INTERVAL 1 DAY)) AS DATE) AS day
    FROM months
)"""


HOST_ACTIVITY_SQL = (
    O.with_(O.WEB_EVENTS)
    + f""", host_daily AS (
    SELECT host, CAST(event_time AS DATE) AS day, count(*) AS hits, count(DISTINCT user_id) AS visitors
    FROM web_events WHERE host IS NOT NULL AND CAST(event_time AS DATE) <= {ANCHOR} GROUP BY ALL
),
{_month_slots("host", "host_daily")}
SELECT s.host, s.month_start,
       string_agg(CAST(coalesce(h.hits, 0) AS VARCHAR), ',' ORDER BY s.day) AS hit_array,
       string_agg(CAST(coalesce(h.visitors, 0) AS VARCHAR), ',' ORDER BY s.day) AS unique_visitors
FROM slots s LEFT JOIN host_daily h ON h.host = s.host AND h.day = s.day
GROUP BY s.host, s.month_start"""
)


def _host_daily(ev):
    return ev.where(F.col("host").isNotNull()).groupBy("host", F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), F.count_distinct("user_id").alias("visitors")
    )


def _host_activity_view(m):
    return m.select(
        "host", "month_start", render(F.col("hits_array")).alias("hit_array"),
        render(F.col("visitors_array")).alias("unique_visitors"),
    )


@register("host_activity_reduced", HOST_ACTIVITY_SQL, ids=("C35", "A03"))
def host_activity_reduced(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    return _host_activity_view(am.monthly_arrays(_host_daily(ev), "host", ["hits", "visitors"], anchor, fill_value=0))


@register("host_activity_reduced_daily_load", HOST_ACTIVITY_SQL, ids=("C35", "J01", "S15"))
def host_activity_reduced_daily_load(spark, sf_dir):
    """The table is partitioned by month; a day reads and overwrites its
    month only. The last day is loaded twice, which changes nothing."""
    from cairn.session import scratch_path
    from cairn.sources.catalog import write_partition

    ev, anchor = _events(spark, sf_dir)
    daily, metrics = _host_daily(ev), ["hits", "visitors"]
    path = scratch_path(spark, f"host_activity_{uuid.uuid4().hex}")
    seed = am.monthly_arrays(daily, "host", metrics, anchor - timedelta(days=2), fill_value=0)
    write_partition(seed.select("host", "hits_array", "visitors_array", "month_start"), path, ["month_start"])
    for back in (1, 0, 0):
        day = anchor - timedelta(days=back)
        today = daily.where(F.col("day") == F.lit(day))
        month = am.zero_filled_step(spark.read.parquet(path), today, "host", metrics, day)
        write_partition(cut_lineage(month, "host_month"), path, ["month_start"])
    return _host_activity_view(spark.read.parquet(path))


USER_DAILY = f"""user_daily AS (
    SELECT user_id, CAST(event_time AS DATE) AS day, count(*) AS n FROM web_events
    WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= {ANCHOR} GROUP BY ALL
)"""

MONTHLY_HITS_SQL = O.with_(O.WEB_EVENTS, USER_DAILY) + f""",
{_month_slots("user_id", "user_daily")}
SELECT s.user_id, s.month_start, s.first_found_date,
       string_agg(coalesce(CAST(u.n AS VARCHAR), 'null'), ',' ORDER BY s.day) AS hit_array,
       {ANCHOR} AS date_partition
FROM slots s LEFT JOIN user_daily u ON u.user_id = s.user_id AND u.day = s.day
GROUP BY s.user_id, s.month_start, s.first_found_date"""


def _monthly_hits(ev, anchor):
    daily = am.daily_metric(ev, "user_id", F.count(F.lit(1)), "n")
    return am.monthly_arrays(daily, "user_id", ["n"], anchor).select(
        "user_id", "month_start", "first_found_date", F.col("n_array").alias("hit_array"),
        F.lit(anchor).cast("date").alias("date_partition"),
    )


def _hits_view(df):
    return df.select("user_id", "month_start", "first_found_date", render(F.col("hit_array")).alias("hit_array"), "date_partition")


@register("monthly_user_site_hits", MONTHLY_HITS_SQL, ids=("C17", "F08"))
def monthly_user_site_hits(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    return _hits_view(_monthly_hits(ev, anchor))


@register("monthly_user_site_hits_daily_load", MONTHLY_HITS_SQL, ids=("C17", "J01"))
def monthly_user_site_hits_daily_load(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    prev = cut_lineage(_monthly_hits(ev, anchor - timedelta(days=1)))
    return _hits_view(am.hits_array_step(prev, ev, "user_id", anchor))


ARRAY_METRICS_SQL = O.with_(O.WEB_EVENTS, USER_DAILY) + f""",
{_month_slots("user_id", "user_daily")}
SELECT s.user_id, s.month_start, 'site_hits' AS metric_name,
       string_agg(CAST(coalesce(u.n, 0) AS VARCHAR), ',' ORDER BY s.day) AS metric_array
FROM slots s LEFT JOIN user_daily u ON u.user_id = s.user_id AND u.day = s.day
GROUP BY s.user_id, s.month_start"""


def _array_metrics(ev, anchor):
    daily = am.daily_metric(ev, "user_id", F.count(F.lit(1)), "n")
    return am.monthly_arrays(daily, "user_id", ["n"], anchor, fill_value=0).select(
        "user_id", "month_start", F.lit("site_hits").alias("metric_name"), F.col("n_array").alias("metric_array")
    )


@register("array_metrics", ARRAY_METRICS_SQL, ids=("C18", "S16"))
def array_metrics(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    return _array_metrics(ev, anchor).withColumn("metric_array", render(F.col("metric_array")))


@register("array_metrics_daily_upsert", ARRAY_METRICS_SQL, ids=("C18", "S16", "J01"))
def array_metrics_daily_upsert(spark, sf_dir):
    from cairn.sources.catalog import upsert

    ev, anchor = _events(spark, sf_dir)
    existing = cut_lineage(_array_metrics(ev, anchor - timedelta(days=1)))
    incoming = am.metric_array_upsert_step(existing, ev, "user_id", anchor, "site_hits")
    merged = upsert(existing, incoming, ["user_id", "month_start", "metric_name"], partition_col="month_start",
                    partitions=[anchor.replace(day=1)])
    return merged.withColumn("metric_array", render(F.col("metric_array")))


@register(
    "array_metrics_daily",
    O.with_(O.WEB_EVENTS, USER_DAILY)
    + f""",
{_month_slots("user_id", "user_daily")}
SELECT 'site_hits' AS metric_name, s.day AS adjusted_date, CAST(sum(coalesce(u.n, 0)) AS BIGINT) AS value
FROM slots s LEFT JOIN user_daily u ON u.user_id = s.user_id AND u.day = s.day
GROUP BY s.month_start, s.day""",
    ids=("C19", "A10", "F11", "J10", "A13", "V3"),
)
def array_metrics_daily(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    return am.array_to_daily(_array_metrics(ev, anchor), "metric_array", ["metric_name"])


@register(
    "monthly_hits_by_position",
    O.with_(O.WEB_EVENTS, USER_DAILY)
    + f""",
{_month_slots("user_id", "user_daily")}
SELECT s.month_start,
       CAST(sum(CASE WHEN s.day = s.month_start THEN coalesce(u.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_first_day,
       CAST(sum(CASE WHEN s.day = s.month_start + 1 THEN coalesce(u.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_second_day,
       CAST(sum(CASE WHEN s.day = s.month_start + 2 THEN coalesce(u.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_third_day
FROM slots s LEFT JOIN user_daily u ON u.user_id = s.user_id AND u.day = s.day
GROUP BY s.month_start""",
    ids=("C20", "F05"),
)
def monthly_hits_by_position(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    hits = _monthly_hits(ev, anchor).where(F.col("date_partition") == F.lit(anchor).cast("date"))
    return am.positional_sums(hits, "hit_array", "month_start", ["num_hits_first_day", "num_hits_second_day", "num_hits_third_day"])
