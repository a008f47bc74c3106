"""The reference's two streaming jobs, re-expressed.

* ``aggregation_job``: one source, two tumbling aggregations (by host and
  by host+referrer), each with its own sink and checkpoint; both queries
  are awaited (the reference only waits for the second).
* ``shared_aggregation_job``: the same two aggregations from one query that
  reads and parses every batch once.
* ``enrichment_job``: stateless enrichment of every event with geodata via
  the IP-range lookup, then a sink. The lookup table may be reloaded for
  every batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.enrich import enrich_ip
from cairn.streaming import aggregation, ledger, sinks
from cairn.streaming.sources import AGGREGATION_EVENT, ENRICHMENT_EVENT, parse_events, parse_records


def aggregation_job(spark: SparkSession, raw: DataFrame, out_dir: str, checkpoint_dir: str,
                    trigger: dict | None = None, window: str = "5 minutes", watermark: str = "15 seconds"):
    good, bad = parse_events(raw, AGGREGATION_EVENT)
    by_host = aggregation.tumbling_counts(good, "event_timestamp", ["host"], window, watermark)
    by_ref = aggregation.tumbling_counts(good, "event_timestamp", ["host", "referrer"], window, watermark)
    queries = [
        sinks.start(by_host, sinks.parquet_batch_writer(f"{out_dir}/by_host"), f"{checkpoint_dir}/by_host", trigger),
        sinks.start(by_ref, sinks.parquet_batch_writer(f"{out_dir}/by_host_referrer"), f"{checkpoint_dir}/by_host_referrer", trigger),
        sinks.start(bad, sinks.parquet_batch_writer(f"{out_dir}/dead_letter"), f"{checkpoint_dir}/dead_letter", trigger),
    ]
    return queries


def shared_aggregation_job(spark: SparkSession, raw: DataFrame, out_dir: str, checkpoint_dir: str,
                           trigger: dict | None = None, window: str = "5 minutes", watermark: str = "15 seconds"):
    """Both tumbling aggregations and the dead letters from one read.

    Each batch is parsed once, into ``parsed/batch_id=``; everything else
    reads that table. Partial counts by window, host and referrer combine
    before their shuffle; the counts by host are rolled up from them. All
    outputs of a batch stand under its id and count once the ledger has it,
    so a replayed batch replaces its own rows. Records whose window ended
    ``watermark`` before the latest event time of the earlier batches are
    late: they are left out of the counts and kept in ``late``.
    ``window_counts`` adds up the committed partial counts of a window.
    """
    log = f"{out_dir}/ledger"

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        if ledger.entry(own, log, batch_id) is not None:
            return  # the checkpoint was behind the ledger: all outputs stand
        here = lambda name: f"{out_dir}/{name}/batch_id={batch_id}"
        parse_records(batch, AGGREGATION_EVENT).write.mode("overwrite").parquet(here("parsed"))
        rows = own.read.parquet(here("parsed"))
        rows.where("reason IS NOT NULL").select("value", "reason").write.mode("overwrite").parquet(here("dead_letter"))

        before = (ledger.entry(own, log, batch_id - 1) or {}).get("latest")
        end = F.window("event_timestamp", window)["end"]
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
        late = F.coalesce(end <= mark, F.lit(False))
        good = rows.where("reason IS NULL").withColumn("late", late)
        good.where("late").drop("late", "reason").write.mode("overwrite").parquet(here("late"))
        on_time = good.where("NOT late")
        counts = aggregation.tumbling_counts(on_time, "event_timestamp", ["host", "referrer"], window, watermark=None)
        counts.write.mode("overwrite").parquet(here("by_host_referrer"))
        counts = own.read.parquet(here("by_host_referrer"))
        by_host = counts.groupBy("event_hour", "host").agg(F.sum("num_hits").alias("num_hits"))
        by_host.write.mode("overwrite").parquet(here("by_host"))

        latest = rows.agg(F.max("event_timestamp").cast("string").alias("t")).first()["t"]
        ledger.commit(own, log, batch_id, {"latest": max(filter(None, (before, latest)), default=None)})

    return [sinks.start(raw, write, f"{checkpoint_dir}/shared", trigger)]


def window_counts(spark: SparkSession, out_dir: str, output: str, window: str = "5 minutes",
                  watermark: str | None = "15 seconds") -> DataFrame:
    """Counts of the closed windows in ``output`` (``by_host`` or
    ``by_host_referrer``) of ``shared_aggregation_job``; ``watermark=None``
    gives the open ones too."""
    rows = ledger.committed_rows(spark, f"{out_dir}/{output}", f"{out_dir}/ledger").drop("batch_id")
    total = rows.groupBy(*[c for c in rows.columns if c != "num_hits"]).agg(F.sum("num_hits").alias("num_hits"))
    if watermark is None:
        return total
    latest = spark.read.json(f"{out_dir}/ledger").agg(F.max("latest").cast("timestamp").alias("t")).first()["t"]
    closed = F.col("event_hour") + F.expr(f"INTERVAL {window}") <= F.lit(latest) - F.expr(f"INTERVAL {watermark}")
    return total.where(closed)


def enrichment_job(spark: SparkSession, raw: DataFrame, locations: DataFrame | Callable[[SparkSession, int], DataFrame],
                   out_dir: str, checkpoint_dir: str, trigger: dict | None = None):
    """``locations`` is the range table, or a function of (session, batch id)
    that loads it anew for every batch. A batch is parsed once and enriched
    as a static frame, so adaptive execution splits a hot address block."""
    log = f"{out_dir}/ledger"
    load = locations if callable(locations) else lambda *_: locations

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        if ledger.entry(own, log, batch_id) is not None:
            return
        here = lambda name: f"{out_dir}/{name}/batch_id={batch_id}"
        parse_records(batch, ENRICHMENT_EVENT).write.mode("overwrite").parquet(here("parsed"))
        rows = own.read.parquet(here("parsed"))
        rows.where("reason IS NOT NULL").select("value", "reason").write.mode("overwrite").parquet(here("dead_letter"))
        good = rows.where("reason IS NULL")
        enriched = enrich_ip(good, load(own, batch_id)).select("ip", "event_timestamp", "referrer", "host", "url", "geodata")
        enriched.write.mode("overwrite").parquet(here("processed_events"))
        ledger.commit(own, log, batch_id, {})

    return [sinks.start(raw, write, f"{checkpoint_dir}/enrichment", trigger)]


def await_all(queries) -> None:
    for q in queries:
        q.awaitTermination()


def session_job(spark: SparkSession, raw: DataFrame, out_dir: str, checkpoint_dir: str,
                trigger: dict | None = None, gap: str = "5 minutes", watermark: str = "15 seconds"):
    """Sessions per (ip, host) with a gap, emitted when the watermark closes
    them (append mode); dead letters as in the aggregation job."""
    good, bad = parse_events(raw, AGGREGATION_EVENT)
    sess = aggregation.sessions(good, "event_timestamp", ["ip", "host"], gap, watermark)
    return [
        sinks.start(sess, sinks.parquet_batch_writer(f"{out_dir}/sessions"), f"{checkpoint_dir}/sessions", trigger),
        sinks.start(bad, sinks.parquet_batch_writer(f"{out_dir}/dead_letter"), f"{checkpoint_dir}/dead_letter", trigger),
    ]
