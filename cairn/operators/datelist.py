"""Date lists to 32-day bit masks and activity flags.

The reference crosses every user with 32 generated days and sums powers
of two. Here the mask is folded straight out of each row's date array
(``aggregate`` over the array: no join, no shuffle), or out of the
events with one partial ``bit_or`` aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import bits


def datelist_int(cumulated: DataFrame, keys, anchor, dates_col: str = "dates_active") -> DataFrame:
    """``datelist_int`` per row of a date-list snapshot (reference C15)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    a = F.lit(anchor).cast("date")
    folded = F.aggregate(
        dates_col,
        F.lit(0).cast("long"),
        lambda acc, d: acc.bitwiseOR(bits.day_bit(F.datediff(a, d))),
    )
    return cumulated.select(*keys, folded.alias("datelist_int"), a.alias("date"))


def datelist_int_from_events(events: DataFrame, keys, anchor, time_col: str = "event_time") -> DataFrame:
    """Same masks straight from events: one ``bit_or`` per key (partial agg)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    a = F.lit(anchor).cast("date")
    days = F.datediff(a, F.to_date(time_col))
    return (
        events.where(F.col(keys[0]).isNotNull() & (F.to_date(time_col) <= a))
        .groupBy(*keys)
        .agg(F.bit_or(bits.day_bit(days)).alias("datelist_int"))
        .withColumn("date", a)
    )


def activity_flags(masks: DataFrame, keys) -> DataFrame:
    """Monthly / weekly activity from the mask (reference C16)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    this_week = bits.mask(0, 7)
    prev_week = bits.mask(7, 7)
    m = F.col("datelist_int")
    return masks.select(
        *keys,
        "datelist_int",
        (bits.count_in(m) > 0).alias("monthly_active"),
        bits.count_in(m).alias("l32"),
        (bits.count_in(m, this_week) > 0).alias("weekly_active"),
        bits.count_in(m, this_week).alias("l7"),
        (bits.count_in(m, prev_week) > 0).alias("weekly_active_previous_week"),
    )
