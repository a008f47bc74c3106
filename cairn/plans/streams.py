"""Registered queries: event-time windows and sessions (batch), and the
streaming aggregation job run end to end over a JSON file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cairn.plans import oracle_sql as O
from cairn.plans import standins
from cairn.plans.registry import register
from cairn.session import scratch_path
from cairn.streaming import aggregation, jobs
from cairn.streaming.sources import events_as_json, json_file_stream

TUMBLING_HOST_SQL = O.with_(O.WEB_EVENTS) + """SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host,
       count(host) AS num_hits
FROM web_events GROUP BY 1, 2"""


@register("tumbling_host_counts", TUMBLING_HOST_SQL, ids=("C30", "T03", "T10"))
def tumbling_host_counts(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    return aggregation.tumbling_counts(ev, "event_time", ["host"], "5 minutes", watermark=None)


TUMBLING_REFERRER_SQL = (
    O.with_(O.WEB_EVENTS)
    + """SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host, referrer, count(host) AS num_hits
FROM web_events GROUP BY 1, 2, 3"""
)


@register("tumbling_host_referrer_counts", TUMBLING_REFERRER_SQL, ids=("C30", "T04"))
def tumbling_host_referrer_counts(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    return aggregation.tumbling_counts(ev, "event_time", ["host", "referrer"], "5 minutes", watermark=None)


SESSIONS_SQL = O.with_(O.WEB_EVENTS) + """, marked AS (
    SELECT ip, host, event_time,
           CASE WHEN lag(event_time) OVER w IS NULL OR event_time - lag(event_time) OVER w > INTERVAL 5 MINUTE
                THEN 1 ELSE 0 END AS new_session
    FROM web_events WINDOW w AS (PARTITION BY ip, host ORDER BY event_time)
),
numbered AS (
    SELECT *, sum(new_session) OVER (PARTITION BY ip, host ORDER BY event_time
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM marked
),
sessions AS (
    SELECT ip, host, min(event_time) AS session_start, max(event_time) + INTERVAL 5 MINUTE AS session_end,
           count(*) AS num_events
    FROM numbered GROUP BY ip, host, sid
)
"""


@register("host_sessions", SESSIONS_SQL + "SELECT * FROM sessions", ids=("C40", "T08"))
def host_sessions(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    return aggregation.sessions(ev, "event_time", ["ip", "host"], "5 minutes", watermark=None)


@register(
    "session_summary_by_host",
    SESSIONS_SQL
    + """SELECT host, count(*) AS sessions, CAST(sum(num_events) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_events_per_session
FROM sessions GROUP BY host""",
    ids=("C40", "T08"),
)
def session_summary_by_host(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    return aggregation.session_summary(aggregation.sessions(ev, "event_time", ["ip", "host"], "5 minutes", watermark=None))


def _stream_source_with_sentinel(spark, ev, tag):
    src = scratch_path(spark, f"stream_src_{tag}")
    events_as_json(ev).write.mode("overwrite").text(f"{src}/part=0")
    sentinel = ev.limit(1).select(
        *[c for c in ev.columns if c != "event_time"], F.lit("2999-01-01 00:00:00").cast("timestamp_ntz").alias("event_time")
    )
    events_as_json(sentinel).write.mode("overwrite").text(f"{src}/part=1")
    return json_file_stream(spark, f"{src}/*")


@register(
    "stream_tumbling_host_counts",
    TUMBLING_HOST_SQL,
    ids=("C30", "T01", "T02", "T05", "T07", "F19"),
)
def stream_tumbling_host_counts(spark, sf_dir):
    """The streaming aggregation job over the events rendered as JSON files
    plus one far-future sentinel record that moves the watermark past every
    real window. Runs with ``availableNow`` (all files in one micro-batch,
    so file order cannot make records late) and returns what the by-host
    sink received. The sentinel's own window stays open and is never
    emitted."""
    res = _aggregation_outputs(spark, sf_dir, "by_host")
    return res.select(F.col("event_hour").cast("timestamp_ntz").alias("event_hour"), "host", "num_hits")


@register("stream_tumbling_referrer_counts", TUMBLING_REFERRER_SQL, ids=("C30", "T04", "T05"))
def stream_tumbling_referrer_counts(spark, sf_dir):
    """What the second sink of the same job, by host and referrer, received."""
    res = _aggregation_outputs(spark, sf_dir, "by_host_referrer")
    return res.select(F.col("event_hour").cast("timestamp_ntz").alias("event_hour"), "host", "referrer", "num_hits")


def _aggregation_outputs(spark, sf_dir, sink):
    ev = standins.web_events(spark, sf_dir)
    tag = uuid.uuid4().hex[:8]
    raw = _stream_source_with_sentinel(spark, ev, tag)
    out = scratch_path(spark, f"stream_out_{tag}")
    queries = jobs.aggregation_job(spark, raw, out, scratch_path(spark, f"stream_ckpt_{tag}"),
                                   trigger={"availableNow": True})
    jobs.await_all(queries)
    return spark.read.parquet(f"{out}/{sink}")


@register(
    "stream_ip_geo_enrichment",
    O.with_(O.WEB_EVENTS)
    + """, loc AS (
    SELECT (CAST(n_nationkey AS BIGINT) * 8 + 1) * 16777216 AS start_ip,
           (CAST(n_nationkey AS BIGINT) * 8 + 1 + 8) * 16777216 - 1 AS end_ip,
           n_name AS country, r_name AS state, n_name || ' city' AS city
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
ev AS (
    SELECT *, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
              + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS ipn
    FROM web_events
)
SELECT ev.ip, date_trunc('millisecond', ev.event_time) AS event_timestamp, ev.referrer, ev.host, ev.url,
       CASE WHEN loc.country IS NULL THEN '{}'
            ELSE json_object('country', loc.country, 'state', loc.state, 'city', loc.city)::VARCHAR END AS geodata
FROM ev LEFT JOIN loc ON ev.ipn BETWEEN loc.start_ip AND loc.end_ip""",
    ids=("C29", "S10", "T06", "X01"),
)
def stream_ip_geo_enrichment(spark, sf_dir):
    """The enrichment job over the events rendered as JSON records (no
    watermark: stateless), run with ``availableNow``; returns what the
    processed-events sink received."""
    from cairn.streaming.sources import enrichment_records

    ev = standins.web_events(spark, sf_dir)
    tag = uuid.uuid4().hex[:8]
    src = scratch_path(spark, f"enrich_src_{tag}")
    enrichment_records(ev).write.mode("overwrite").text(src)
    out = scratch_path(spark, f"enrich_out_{tag}")
    queries = jobs.enrichment_job(
        spark, json_file_stream(spark, src), standins.ip_locations(spark, sf_dir), out,
        scratch_path(spark, f"enrich_ckpt_{tag}"), trigger={"availableNow": True},
    )
    jobs.await_all(queries)
    res = spark.read.parquet(f"{out}/processed_events")
    return res.select(
        "ip", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "referrer", "host", "url", "geodata"
    )


@register(
    "stream_host_sessions",
    O.with_(O.WEB_EVENTS) + """, ms AS (SELECT ip, host, date_trunc('millisecond', event_time) AS event_time FROM web_events),
marked AS (
    SELECT ip, host, event_time,
           CASE WHEN lag(event_time) OVER w IS NULL OR event_time - lag(event_time) OVER w > INTERVAL 5 MINUTE
                THEN 1 ELSE 0 END AS new_session
    FROM ms WINDOW w AS (PARTITION BY ip, host ORDER BY event_time)
),
numbered AS (
    SELECT *, sum(new_session) OVER (PARTITION BY ip, host ORDER BY event_time
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM marked
)
SELECT ip, host, min(event_time) AS session_start, max(event_time) + INTERVAL 5 MINUTE AS session_end,
       count(*) AS num_events
FROM numbered GROUP BY ip, host, sid""",
    ids=("C40", "T08", "T02"),
)
def stream_host_sessions(spark, sf_dir):
    """Session windows over the JSON event stream (5-minute gap, 15-second
    watermark, append mode), with a far-future sentinel that closes every
    real session; the sentinel's own session stays open and is not emitted.
    Event times travel as millisecond text, so the oracle truncates too."""
    ev = standins.web_events(spark, sf_dir)
    tag = uuid.uuid4().hex[:8]
    raw = _stream_source_with_sentinel(spark, ev, tag)
    out = scratch_path(spark, f"sess_out_{tag}")
    jobs.await_all(jobs.session_job(spark, raw, out, scratch_path(spark, f"sess_ckpt_{tag}"), trigger={"availableNow": True}))
    res = spark.read.parquet(f"{out}/sessions")
    return res.select(
        "ip", "host",
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"),
        "num_events",
    )
