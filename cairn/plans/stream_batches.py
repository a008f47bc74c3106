"""Registered streams over many micro-batches: lateness, restarts, sessions
across batches, replays, one read for several outputs, a refreshed lookup.

The events table is rendered as JSON records, dealt into slices of ten
days, and streamed a slice at a time, in order of arrival. Where a query
asks for lateness, events whose id leaves 7 (8) by 20 arrive one (two) slices
late. In production the source is the topic itself.
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.plans import oracle_sql as O
from cairn.plans import standins
from cairn.plans.registry import register
from cairn.session import cut_lineage, scratch_path
from cairn.streaming import aggregation, jobs, ledger, sinks
from cairn.streaming.sources import AGGREGATION_EVENT, enrichment_records, events_as_json, json_file_stream, parse_events

SLICE_DAYS = 10
NOW = {"availableNow": True}


def _slice() -> Column:
    return F.coalesce(F.floor(F.datediff(F.to_date("event_time"), F.lit("1970-01-01").cast("date")) / SLICE_DAYS), F.lit(0))


def _delay() -> Column:
    return F.when(F.col("event_id") % 20 == 7, 1).when(F.col("event_id") % 20 == 8, 2).otherwise(0)


def stream_slices(records: DataFrame, files: int = 1) -> DataFrame:
    """``records`` (value, arrives) as a stream that takes one arrival slice
    a micro-batch. A slice is written as ``files`` files, one slice after the
    other, and as many files make a batch."""
    spark = records.sparkSession
    src = scratch_path(spark, f"slices_{uuid.uuid4().hex[:8]}")
    records.write.partitionBy("arrives").parquet(f"{src}/all")
    table = spark.read.parquet(f"{src}/all")
    for k in sorted(r["arrives"] for r in table.select("arrives").distinct().collect()):  # one a slice of time
        table.where(F.col("arrives") == k).select("value").repartition(files).write.text(f"{src}/slices/slice={k}")
    return json_file_stream(spark, f"{src}/slices/*", files)


def _run_folders(spark, tag: str) -> tuple[str, str]:
    run = uuid.uuid4().hex[:8]
    return scratch_path(spark, f"{tag}_out_{run}"), scratch_path(spark, f"{tag}_ckpt_{run}")


def _ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


SLICED = (
    O.WEB_EVENTS
    + f""",
sliced AS (
    SELECT *, date_trunc('millisecond', event_time) AS t,
           coalesce((CAST(event_time AS DATE) - DATE '1970-01-01') // {SLICE_DAYS}, 0) AS slice
    FROM web_events
)"""
)
ARRIVED = SLICED + """,
arrived AS (
    SELECT *, slice + CASE event_id % 20 WHEN 7 THEN 1 WHEN 8 THEN 2 ELSE 0 END AS arrives,
           time_bucket(INTERVAL 5 MINUTE, t) AS event_hour
    FROM sliced
),
tops AS (SELECT arrives, max(t) AS top FROM arrived GROUP BY arrives)"""


@register(
    "stream_late_events",
    O.with_(
        ARRIVED
        + """,
marks AS (
    -- a batch drops what had closed when the batch before it started
    SELECT arrives, max(top) OVER (ORDER BY arrives ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 15 SECOND AS mark
    FROM tops
)"""
    )
    + """SELECT event_hour, host, count(host) AS num_hits
FROM arrived JOIN marks USING (arrives)
WHERE t IS NOT NULL AND (mark IS NULL OR event_hour + INTERVAL 5 MINUTE > mark)
  AND event_hour + INTERVAL 5 MINUTE <= (SELECT max(top) FROM tops) - INTERVAL 15 SECOND
GROUP BY 1, 2""",
    ids=("T01", "T02", "T03", "C30", "F19"),
)
def stream_late_events(spark, sf_dir):
    """Tumbling counts by host over time-ordered batches, a tenth of the
    events late by days: the watermark advances from batch to batch, closes
    windows, emits each once and drops the events that come after that."""
    ev = standins.web_events(spark, sf_dir)
    records = events_as_json(ev.withColumn("arrives", _slice() + _delay()), keep=["arrives"])
    good, _ = parse_events(stream_slices(records), AGGREGATION_EVENT)
    by_host = aggregation.tumbling_counts(good, "event_timestamp", ["host"])
    out, checkpoint = _run_folders(spark, "late")
    sinks.start(by_host, sinks.parquet_batch_writer(f"{out}/by_host"), checkpoint, NOW).awaitTermination()
    return spark.read.parquet(f"{out}/by_host").select(_ntz("event_hour"), "host", "num_hits")


def fail_once(writer, at: int, tripped: list):
    """``writer`` that raises after it has written batch ``at``, the first
    time: the batch stands, but the stream has not committed it."""

    def write(batch, batch_id):
        writer(batch, batch_id)
        if batch_id == at and not tripped:
            tripped.append(at)
            raise RuntimeError(f"injected failure after batch {at}")

    return write


def run_through_failure(start) -> int:
    """Run ``start()`` until its stream ends by itself; restarts it from its
    checkpoint after a failure. The number of restarts."""
    for restarts in range(3):
        query = start()
        try:
            query.awaitTermination()
            return restarts
        except StreamingQueryException as error:
            if "injected failure" not in str(error):
                raise
    raise RuntimeError("the stream fails again after each restart")


@register(
    "stream_restart_dead_letters",
    O.with_(SLICED)
    + """, counted AS (
    SELECT 'by_host' AS output, time_bucket(INTERVAL 5 MINUTE, t) AS event_hour, host AS key, count(host) AS n
    FROM sliced WHERE t IS NOT NULL AND event_id % 50 > 1 GROUP BY 1, 2, 3
    HAVING event_hour + INTERVAL 5 MINUTE
           <= (SELECT max(t) FROM sliced WHERE event_id % 50 > 1) - INTERVAL 15 SECOND
)
SELECT output, event_hour, key, n FROM counted
UNION ALL
SELECT 'dead_letter', NULL, if(event_id % 50 = 0, 'unparsable_json', 'bad_event_time'), count(*)
FROM sliced WHERE event_id % 50 <= 1 OR t IS NULL GROUP BY 3""",
    ids=("T07", "T11", "C30"),
)
def stream_restart_dead_letters(spark, sf_dir):
    """Windowed counts and dead letters of a stream that fails in its third
    batch, after the batch's output and before its commit, and is started
    again from the checkpoint with its state. One record in 50 is cut off, one
    has a text for a time. The result is that of an uninterrupted run."""
    ev = standins.web_events(spark, sf_dir)
    records = events_as_json(ev.withColumn("arrives", _slice()), keep=["event_id", "arrives"])
    damaged = F.when(F.col("event_id") % 50 == 0, F.expr("substring(value, 1, length(value) - 9)")).otherwise(
        F.when(F.col("event_id") % 50 == 1, F.regexp_replace("value", '"event_time":"[^"]*"', '"event_time":"yesterday"')).otherwise(F.col("value"))
    )
    raw = stream_slices(records.select(damaged.alias("value"), "arrives"))
    out, checkpoint = _run_folders(spark, "restart")
    good, bad = parse_events(raw, AGGREGATION_EVENT)
    by_host = aggregation.tumbling_counts(good, "event_timestamp", ["host"])
    for name, frame in (("by_host", by_host), ("dead_letter", bad)):
        writer = fail_once(sinks.parquet_batch_writer(f"{out}/{name}"), 2, [])
        run_through_failure(lambda f=frame, w=writer, n=name: sinks.start(f, w, f"{checkpoint}/{n}", NOW))
    windows = spark.read.parquet(f"{out}/by_host").select(F.lit("by_host").alias("output"), _ntz("event_hour"), F.col("host").alias("key"), F.col("num_hits").alias("n"))
    letters = spark.read.parquet(f"{out}/dead_letter").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return windows.unionByName(
        letters.select(F.lit("dead_letter").alias("output"), F.lit(None).cast("timestamp_ntz").alias("event_hour"), F.col("reason").alias("key"), "n")
    )


@register(
    "stream_sessions_across_batches",
    O.with_(SLICED)
    + """, marked AS (
    SELECT ip, host, t, CASE WHEN t - lag(t) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
    FROM sliced WHERE t IS NOT NULL WINDOW w AS (PARTITION BY ip, host ORDER BY t)
),
numbered AS (
    SELECT *, sum(opens) OVER (PARTITION BY ip, host ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM marked
)
SELECT ip, host, min(t) AS session_start, max(t) + INTERVAL 6 HOUR AS session_end, count(*) AS num_events
FROM numbered GROUP BY ip, host, k""",
    ids=("T08", "C40", "T02"),
)
def stream_sessions_across_batches(spark, sf_dir):
    """Sessions with a gap of six hours whose events arrive in up to three
    batches: open sessions wait as state, and a late event that lies between
    two of them joins them. The watermark waits three slices, so no event is
    dropped; a record of the year 2999 closes the last sessions."""
    ev = standins.web_events(spark, sf_dir).withColumn("arrives", _slice() + _delay())
    last = ev.agg(F.max("arrives").alias("k")).first()["k"] or 0
    end = ev.limit(1).withColumn("event_time", F.lit("2999-01-01 00:00:00").cast("timestamp_ntz")).withColumn("arrives", F.lit(last + 1))
    raw = stream_slices(events_as_json(ev.unionByName(end), keep=["arrives"]))
    out, checkpoint = _run_folders(spark, "sessions")
    jobs.await_all(jobs.session_job(spark, raw, out, checkpoint, NOW, gap="6 hours", watermark=f"{3 * SLICE_DAYS} days"))
    return spark.read.parquet(f"{out}/sessions").select("ip", "host", _ntz("session_start"), _ntz("session_end"), "num_events")


@register(
    "stream_replayed_batches",
    O.with_(SLICED) + "SELECT ip, host, url, t AS event_timestamp, count(*) AS n FROM sliced WHERE t IS NOT NULL GROUP BY ALL",
    ids=("S12", "C29", "T07"),
)
def stream_replayed_batches(spark, sf_dir):
    """A table that only appends, as a JDBC sink does, behind a commit ledger.
    The stream runs, its checkpoint is lost, and a second run replays every
    batch: the ledger knows them and the table stays as it is."""
    ev = standins.web_events(spark, sf_dir)
    raw = stream_slices(events_as_json(ev.withColumn("arrives", _slice()), keep=["arrives"]))
    good, _ = parse_events(raw, AGGREGATION_EVENT)
    out, checkpoint = _run_folders(spark, "replay")
    writer = ledger.once_per_batch(f"{out}/ledger", sinks.append_writer(f"{out}/table"))
    for run in ("first", "again"):
        sinks.start(good, writer, f"{checkpoint}/{run}", NOW).awaitTermination()
    table = spark.read.parquet(f"{out}/table")
    return table.groupBy("ip", "host", "url", _ntz("event_timestamp")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "stream_two_outputs",
    O.with_(
        ARRIVED
        + """,
marks AS (
    SELECT arrives, max(top) OVER (ORDER BY arrives ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 15 SECOND AS mark
    FROM tops
),
taken AS (
    SELECT arrived.* FROM arrived JOIN marks USING (arrives)
    WHERE t IS NOT NULL AND (mark IS NULL OR event_hour + INTERVAL 5 MINUTE > mark)
      AND event_hour + INTERVAL 5 MINUTE <= (SELECT max(top) FROM tops) - INTERVAL 15 SECOND
)"""
    )
    + """SELECT 'by_host' AS output, event_hour, host, NULL AS referrer, count(host) AS num_hits FROM taken GROUP BY 2, 3
UNION ALL
SELECT 'by_host_referrer', event_hour, host, referrer, count(host) FROM taken GROUP BY 2, 3, 4""",
    ids=("T05", "T03", "T04", "C30"),
)
def stream_two_outputs(spark, sf_dir):
    """Counts by host and by host and referrer from one query that reads and
    parses each batch once, with late events left out by the ledger's mark."""
    ev = standins.web_events(spark, sf_dir)
    records = events_as_json(ev.withColumn("arrives", _slice() + _delay()), keep=["arrives"])
    out, checkpoint = _run_folders(spark, "shared")
    jobs.await_all(jobs.shared_aggregation_job(spark, stream_slices(records), out, checkpoint, NOW))
    hosts, referrers = (jobs.window_counts(spark, out, name) for name in ("by_host", "by_host_referrer"))
    columns = [_ntz("event_hour"), "host", "referrer", "num_hits"]
    hosts = hosts.withColumn("referrer", F.lit(None).cast("string"))
    return hosts.select(F.lit("by_host").alias("output"), *columns).unionByName(
        referrers.select(F.lit("by_host_referrer").alias("output"), *columns)
    )


@register(
    "stream_refreshed_lookup",
    O.with_(
        SLICED
        + """,
loc AS (
    SELECT (CAST(n_nationkey AS BIGINT) * 8 + 1) * 16777216 AS start_ip,
           (CAST(n_nationkey AS BIGINT) * 8 + 1 + 8) * 16777216 - 1 AS end_ip,
           n_name AS country, r_name AS state, n_nationkey
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
batches AS (SELECT slice, row_number() OVER (ORDER BY slice) - 1 AS batch FROM (SELECT DISTINCT slice FROM sliced)),
ev AS (
    SELECT *, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
              + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS ipn
    FROM sliced JOIN batches USING (slice)
)"""
    )
    + """SELECT ev.ip, t AS event_timestamp, ev.host, ev.url,
       CASE WHEN loc.country IS NULL OR n_nationkey % 4 = batch % 4 THEN '{}'
            ELSE json_object('country', loc.country, 'state', loc.state, 'city', 'seen by batch ' || batch)::VARCHAR END AS geodata
FROM ev LEFT JOIN loc ON ev.ipn BETWEEN loc.start_ip AND loc.end_ip WHERE t IS NOT NULL""",
    ids=("T06", "X01", "C29", "S10"),
)
def stream_refreshed_lookup(spark, sf_dir):
    """The enrichment job while its range table changes: before each batch
    the table is published anew, with other names and without a quarter of
    the ranges, and the batch must see that state and no earlier one."""
    ev = standins.web_events(spark, sf_dir)
    raw = stream_slices(enrichment_records(ev.withColumn("arrives", _slice()), keep=["arrives"]))
    out, checkpoint = _run_folders(spark, "lookup")
    ranges = cut_lineage(standins.ip_locations(spark, sf_dir), "ip_locations")
    table = f"{out}/ip_locations"

    def publish_and_load(own, batch_id):
        nation = F.floor((F.shiftright("start_ip", 24) - 1) / standins.IP_BLOCKS_PER_NATION)
        state = own.read.parquet(*ranges.inputFiles()).where(nation % 4 != batch_id % 4)
        state.withColumn("city", F.lit(f"seen by batch {batch_id}")).write.mode("overwrite").parquet(table)
        return own.read.parquet(table)

    jobs.await_all(jobs.enrichment_job(spark, raw, publish_and_load, out, checkpoint, NOW))
    res = ledger.committed_rows(spark, f"{out}/processed_events", f"{out}/ledger")
    return res.select("ip", _ntz("event_timestamp"), "host", "url", "geodata")
