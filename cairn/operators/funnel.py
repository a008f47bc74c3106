"""Funnel conversion by page.

Reference semantics: for each distinct hit, look at the same user's hits
later the same day; the hit counts if any later hit exists (the inner
self join drops the last hit of a day) and converts if a later hit is on
the target page. A self join is quadratic in hits per user-day; here the
two facts "some later hit" and "some later target hit" are the maxima of
the user-day, computed by one partial aggregation and joined back on
(user, day). A hot user-day is then a single aggregated row, and the
join back is a skew-splittable equi join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def funnel_conversion(events: DataFrame, target_url: str, min_hits: int = 100,
                      include_last: bool = False) -> DataFrame:
    hits = (
        events.where(F.col("user_id").isNotNull())
        .select("url", "host", "user_id", "event_time")
        .distinct()
        .withColumn("event_date", F.to_date("event_time"))
    )
    per_day = hits.groupBy("user_id", "event_date").agg(
        F.max("event_time").alias("_last_hit"),
        F.max(F.when(F.col("url") == target_url, F.col("event_time"))).alias("_last_target"),
    )
    marked = hits.join(per_day, ["user_id", "event_date"]).select(
        "user_id",
        "event_time",
        "url",
        (F.col("_last_hit") > F.col("event_time")).alias("_has_later"),
        F.coalesce(F.col("_last_target") > F.col("event_time"), F.lit(False)).alias("_converted"),
    )
    if not include_last:
        marked = marked.where("_has_later")
    # one row per (user, time, url) as in the reference's GROUP BY
    per_hit = marked.groupBy("user_id", "event_time", "url").agg(F.max("_converted").cast("int").alias("converted"))
    out = per_hit.groupBy("url").agg(
        F.count(F.lit(1)).alias("hits"),
        (F.sum("converted").cast("double") / F.count(F.lit(1)).cast("double")).alias("conversion_rate"),
    )
    return out.where((F.col("conversion_rate") > 0) & (F.col("hits") > min_hits))
