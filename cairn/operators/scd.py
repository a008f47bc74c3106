"""Slowly changing dimension, type 2: backfill and increment.

Change detection is null-safe over a list of tracked columns (``<=>``), so
a change from or to NULL is a change; the first row of an entity always
starts a streak, and streak ids start at 1.

Both forms take the *dense* cumulative snapshot (one row per entity per
period from its first period on, as the cumulative operators produce);
on dense input the increment equals the backfill.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _changed(tracked: list[str], w) -> F.Column:
    first = F.row_number().over(w) == 1
    diffs = [~F.col(c).eqNullSafe(F.lag(c, 1).over(w)) for c in tracked]
    return reduce(lambda a, b: a | b, diffs, first)


def scd_backfill(
    snapshots: DataFrame,
    key: str,
    period: str,
    tracked: list[str],
    as_of: int | None = None,
    start_name: str = "start_period",
    end_name: str = "end_period",
    as_of_name: str | None = "current_period",
    carry: list[str] | None = None,
) -> DataFrame:
    """Streaks of unchanged tracked values per entity (reference C05/C06).
    ``carry`` columns ride along and must be constant per entity.

    One shuffle: the window's hash partitioning on ``key`` also serves the
    group-by on ``(key, streak)``.
    """
    df = snapshots if as_of is None else snapshots.where(F.col(period) <= as_of)
    carry = carry or []
    w = Window.partitionBy(key).orderBy(period)
    flagged = df.select(key, period, *tracked, *carry, _changed(tracked, w).cast("int").alias("_chg"))
    streaks = flagged.withColumn(
        "streak_identifier",
        F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    # tracked values are constant within a streak and ``carry`` columns are
    # constant per entity, so they are grouping keys (NULL groups with NULL);
    # that keeps every aggregate buffer fixed-width (hash aggregation)
    out = streaks.groupBy(key, "streak_identifier", *tracked, *carry).agg(
        F.min(period).alias(start_name),
        F.max(period).alias(end_name),
    )
    cols = [key, *carry, *tracked, start_name, end_name]
    if as_of_name and as_of is not None:
        out = out.withColumn(as_of_name, F.lit(as_of))
        cols.append(as_of_name)
    return out.select(*cols, "streak_identifier")


def scd_increment(
    prev_scd: DataFrame,
    snapshot: DataFrame,
    key: str,
    period: str,
    tracked: list[str],
    new_period: int,
    start_name: str = "start_period",
    end_name: str = "end_period",
    as_of_name: str = "current_period",
) -> DataFrame:
    """Previous SCD (as of ``new_period - 1``) + this period's snapshot.

    Records still open last period are joined to this period's rows once
    (a FULL OUTER join on ``key``); each pair then emits one or two records:

    * unchanged: the open record is extended to ``new_period``;
    * changed: the open record is closed as it was, a new one starts;
    * new entity: a new record starts;
    * entity absent this period: the open record is kept unchanged.

    Closed (historical) records are passed through without a shuffle.
    """
    prev_p = new_period - 1
    cols = [key, *tracked, start_name, end_name]
    historical = prev_scd.where(F.col(end_name) < prev_p).select(*cols)
    last = prev_scd.where(F.col(end_name) == prev_p).select(*cols).alias("l")
    this = snapshot.where(F.col(period) == new_period).select(key, *tracked).alias("t")

    same = reduce(
        lambda a, b: a & b,
        [F.col(f"l.{c}").eqNullSafe(F.col(f"t.{c}")) for c in tracked],
    )
    has_l = F.col(f"l.{key}").isNotNull()
    has_t = F.col(f"t.{key}").isNotNull()

    def rec(src: str, start, end):
        return F.struct(
            *[F.col(f"{src}.{c}").alias(c) for c in tracked],
            start.alias(start_name),
            end.alias(end_name),
        )

    old_closed = rec("l", F.col(f"l.{start_name}"), F.col(f"l.{end_name}"))
    extended = rec("t", F.col(f"l.{start_name}"), F.lit(new_period))
    fresh = rec("t", F.lit(new_period), F.lit(new_period))
    records = (
        F.when(has_l & has_t & same, F.array(extended))
        .when(has_l & has_t, F.array(old_closed, fresh))
        .when(has_t, F.array(fresh))
        .otherwise(F.array(old_closed))
    )
    joined = last.join(this, F.col(f"l.{key}") == F.col(f"t.{key}"), "full").select(
        F.coalesce(F.col(f"l.{key}"), F.col(f"t.{key}")).alias(key),
        F.inline(records),
    )
    return historical.unionByName(joined.select(*cols)).withColumn(as_of_name, F.lit(new_period))


def scd_overlaps(scd: DataFrame, key: str, start_name: str, end_name: str) -> DataFrame:
    """Validation (V2): records whose start is not after the previous end,
    or that leave a gap. Empty on a well-formed SCD over dense snapshots."""
    w = Window.partitionBy(key).orderBy(start_name)
    prev_end = F.lag(end_name).over(w)
    checked = scd.select(key, start_name, end_name, prev_end.alias("prev_end"))
    return checked.where(
        F.col("prev_end").isNotNull() & (F.col(start_name) != F.col("prev_end") + 1)
    ).withColumn(
        "problem", F.when(F.col(start_name) <= F.col("prev_end"), "overlap").otherwise("gap")
    )
