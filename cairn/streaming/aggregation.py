"""Event-time aggregations that run unchanged on batch and streaming frames.

With a watermark, append mode emits a window once the watermark passes its
end; records later than the watermark are dropped, as in the reference's
job (15 s bounded out-of-orderness). Streams need a TIMESTAMP event time
(``withWatermark`` rejects TIMESTAMP_NTZ).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_watermark(df: DataFrame, time_col: str, delay: str | None) -> DataFrame:
    return df.withWatermark(time_col, delay) if delay and df.isStreaming else df


def tumbling_counts(df: DataFrame, time_col: str, keys: list[str], size: str = "5 minutes",
                    watermark: str | None = "15 seconds", count_col: str = "host") -> DataFrame:
    """Hits per tumbling window and keys; ``event_hour`` is the window start.
    ``count(host)`` ignores NULL hosts, as the reference's ``host.count``."""
    src = with_watermark(df, time_col, watermark)
    g = src.groupBy(F.window(time_col, size).alias("w"), *keys).agg(F.count(count_col).alias("num_hits"))
    return g.select(F.col("w.start").alias("event_hour"), *keys, "num_hits")


def sessions(df: DataFrame, time_col: str, keys: list[str], gap: str = "5 minutes",
             watermark: str | None = "15 seconds") -> DataFrame:
    """Sessions per keys: events closer than ``gap`` (inclusive) share one.

    On a batch frame the events of a tumbling window of length ``gap`` are one
    session for certain; they are merged by a plain aggregation, so they
    combine before the shuffle, and only these partial sessions meet by keys.
    A stream keeps open sessions as state; a late event may join two of them.
    """
    if not df.isStreaming:
        return _batch_sessions(df, time_col, keys, gap)
    src = with_watermark(df, time_col, watermark)
    g = src.groupBy(F.session_window(time_col, gap).alias("s"), *keys).agg(F.count(F.lit(1)).alias("num_events"))
    return g.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "num_events")


def _batch_sessions(df: DataFrame, time_col: str, keys: list[str], gap: str) -> DataFrame:
    length = F.expr(f"INTERVAL {gap}")
    part = df.where(F.col(time_col).isNotNull()).groupBy(F.window(time_col, gap).alias("w"), *keys)
    part = part.agg(F.min(time_col).alias("a"), F.max(time_col).alias("b"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys).orderBy("a")
    opens = part.withColumn("opens", F.when(F.col("a") <= F.lag("b").over(order) + length, 0).otherwise(1))
    numbered = opens.withColumn("k", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*keys, "k").agg(
        F.min("a").alias("session_start"), (F.max("b") + length).alias("session_end"), F.sum("n").alias("num_events")
    )
    return merged.select(*keys, "session_start", "session_end", "num_events")


def session_summary(sess: DataFrame, key: str = "host") -> DataFrame:
    """Average events per session, per host (batch over closed sessions)."""
    return sess.groupBy(key).agg(
        F.count(F.lit(1)).alias("sessions"),
        (F.sum("num_events").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_events_per_session"),
    )
