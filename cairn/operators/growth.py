"""Growth accounting, retention and player state tracking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.arrays import append_if


# The state names below are part of the results.
def _daily_state(has_y, today, y_last, y_date):
    return (
        F.when(~has_y, "New")
        .when(y_last == F.date_sub(today, 1), "Retained")
        .when(y_last < F.date_sub(today, 1), "Resurrected")
        .when(today.isNull() & (y_last == y_date), "Churned")
        .otherwise("Stale")
    )


def _weekly_state(has_y, today, y_last, y_date):
    # As written in the reference: compares with yesterday's date, so weekly
    # "Churned" fires 8 days after the last activity.
    return (
        F.when(~has_y, "New")
        .when(y_last < F.date_sub(today, 7), "Resurrected")
        .when(today.isNull() & (y_last == F.date_sub(y_date, 7)), "Churned")
        .when(F.date_add(F.coalesce(today, y_last), 7) >= y_date, "Retained")
        .otherwise("Stale")
    )


def growth_accounting_step(prev: DataFrame, events: DataFrame, day, key: str = "user_id",
                           time_col: str = "event_time") -> DataFrame:
    """One day of ``users_growth_accounting`` from yesterday's rows."""
    d = F.lit(day).cast("date")
    y = prev.where(F.col("date") == F.date_sub(d, 1)).alias("y")
    # one day: distinct on the key alone keeps today's side partitioned on the join key
    t = (
        events.where(F.col(key).isNotNull() & (F.to_date(time_col) == d))
        .select(key)
        .distinct()
        .withColumn("today_date", d)
        .alias("t")
    )
    has_y = F.col(f"y.{key}").isNotNull()
    today = F.col("t.today_date")
    y_last = F.col("y.last_active_date")
    y_date = F.col("y.date")
    return t.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full").select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.coalesce(F.col("y.first_active_date"), today).alias("first_active_date"),
        F.coalesce(today, y_last).alias("last_active_date"),
        _daily_state(has_y, today, y_last, y_date).alias("daily_active_state"),
        _weekly_state(has_y, today, y_last, y_date).alias("weekly_active_state"),
        append_if(F.col("y.dates_active"), today.isNotNull(), today).alias("dates_active"),
        F.coalesce(today, F.date_add(y_date, 1)).alias("date"),
    )


def growth_accounting(events: DataFrame, end_day, key: str = "user_id", time_col: str = "event_time",
                      with_dates: bool = True) -> DataFrame:
    """All days at once: every user x day from the first active day to
    ``end_day``, equal to looping ``growth_accounting_step``.

    The grid is the output table itself (one row per user per day); the
    activity is reduced to distinct (user, day) before the join, and one
    window per user carries the last active day forward. ``with_dates``
    adds the running date list, which is quadratic in days per user; for
    one day's rows use ``growth_snapshot``.
    """
    end = F.lit(end_day).cast("date")
    days = (
        events.where(F.col(key).isNotNull() & (F.to_date(time_col) <= end))
        .select(key, F.to_date(time_col).alias("date"))
        .distinct()
        .withColumn("_active", F.lit(True))
    )
    firsts = days.groupBy(key).agg(F.min("date").alias("first_active_date"))
    grid = firsts.select(key, "first_active_date", F.explode(F.sequence("first_active_date", end, F.expr("INTERVAL 1 DAY"))).alias("date"))
    dense = grid.join(days, [key, "date"], "left")
    w = Window.partitionBy(key).orderBy("date")
    upto_prev = w.rowsBetween(Window.unboundedPreceding, -1)
    upto_now = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active_day = F.when(F.col("_active"), F.col("date"))
    s = dense.select(
        key,
        "date",
        "first_active_date",
        active_day.alias("_today"),
        F.max(active_day).over(upto_prev).alias("_y_last"),
        F.max(active_day).over(upto_now).alias("last_active_date"),
        *([F.collect_list(active_day).over(upto_now).alias("dates_active")] if with_dates else
          [F.count(active_day).over(upto_now).alias("n_dates_active")]),
    )
    has_y = F.col("date") > F.col("first_active_date")
    y_date = F.date_sub(F.col("date"), 1)
    cols = [
        key,
        "first_active_date",
        "last_active_date",
        _daily_state(has_y, F.col("_today"), F.col("_y_last"), y_date).alias("daily_active_state"),
        _weekly_state(has_y, F.col("_today"), F.col("_y_last"), y_date).alias("weekly_active_state"),
        "dates_active" if with_dates else "n_dates_active",
        "date",
    ]
    return s.select(*cols)


def _active_days(events: DataFrame, end, key: str, time_col: str) -> DataFrame:
    """Distinct active days per user, with the first and the next one."""
    days = (
        events.where(F.col(key).isNotNull() & (F.to_date(time_col) <= end))
        .select(key, F.to_date(time_col).alias("day"))
        .distinct()
    )
    mine = Window.partitionBy(key)
    return days.select(
        key,
        "day",
        F.min("day").over(mine).alias("first"),
        F.lag("day").over(mine.orderBy("day")).alias("previous"),
        F.lead("day").over(mine.orderBy("day")).alias("following"),
    )


def retention_curve(events: DataFrame, end_day, key: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """Share of users active N days after their first active day (C13).

    Users whose first day is N days or more before the end count for N; the
    active ones are their active days at that distance. No row per user and
    idle day: users are counted by first day, then one row per day of it.
    """
    end = F.lit(end_day).cast("date")
    days = _active_days(events, end, key, time_col)
    n = "days_since_first_active"
    active = days.groupBy(F.datediff("day", "first").alias(n)).agg(F.count(F.lit(1)).alias("active"))
    by_first = days.where(F.col("day") == F.col("first")).groupBy("first").agg(F.count(F.lit(1)).alias("users"))
    reach = by_first.select("users", F.explode(F.sequence(F.lit(0), F.datediff(end, "first"))).alias(n))
    users = reach.groupBy(n).agg(F.sum("users").alias("num_users"))
    return users.join(active, n, "left").select(
        n, (F.coalesce("active", F.lit(0)).cast("double") / F.col("num_users").cast("double")).alias("pct_active"), "num_users"
    )


def daily_state_counts(events: DataFrame, end_day, key: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """Users per day and daily state, without a row per user and idle day.

    An active day is New, Retained or Resurrected by the one before it; the
    day after it is Churned unless active; the days from then to the next
    active one (or the end) are Stale, which are counted as +1 where they
    begin and -1 where they end, summed up over the calendar.
    """
    end = F.lit(end_day).cast("date")
    days = _active_days(events, end, key, time_col)
    state = (
        F.when(F.col("previous").isNull(), "New")
        .when(F.col("previous") == F.date_sub("day", 1), "Retained")
        .otherwise("Resurrected")
    )
    until = F.coalesce("following", F.date_add(end, 1))  # exclusive
    churned = F.when(until > F.date_add("day", 1), F.date_add("day", 1))
    stale = F.when(until > F.date_add("day", 2), F.date_add("day", 2))
    marks = F.array(
        F.struct(F.col("day").alias("date"), state.alias("state"), F.lit(1).alias("n")),
        F.struct(churned.alias("date"), F.lit("Churned").alias("state"), F.lit(1).alias("n")),
        F.struct(stale.alias("date"), F.lit("Stale").alias("state"), F.lit(1).alias("n")),
        F.struct(F.when(stale.isNotNull(), until).alias("date"), F.lit("Stale").alias("state"), F.lit(-1).alias("n")),
    )
    counts = (
        days.select(F.inline(marks)).where(F.col("date").isNotNull()).groupBy("date", "state").agg(F.sum("n").alias("n"))
    )  # a few rows a day
    plain = counts.where(F.col("state") != "Stale").select("date", F.col("state").alias("daily_active_state"), F.col("n").alias("users"))
    calendar = counts.agg(F.min("date").alias("a")).where(F.col("a").isNotNull()).select(F.explode(F.sequence("a", end)).alias("date"))
    change = counts.where(F.col("state") == "Stale").select("date", "n")
    total = F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("date"))  # one row a day
    stale_days = calendar.join(change, "date", "left").select("date", F.lit("Stale").alias("daily_active_state"), total.alias("users"))
    return plain.unionByName(stale_days.where(F.col("users") > 0))


def season_states(players: DataFrame, key: str = "player_id", period: str = "current_season",
                  active: str = "is_active") -> DataFrame:
    """New / Retired / Continued Playing / Returned from Retirement /
    Stayed Retired from the previous period's activity (homework W13)."""
    w = Window.partitionBy(key).orderBy(period)
    prev = F.lag(active).over(w)
    state = (
        F.when(prev.isNull(), F.when(F.col(active), "New").otherwise("Stayed Retired"))
        .when(prev & F.col(active), "Continued Playing")
        .when(prev & ~F.col(active), "Retired")
        .when(~prev & F.col(active), "Returned from Retirement")
        .otherwise("Stayed Retired")
    )
    return players.select(key, period, active, state.alias("season_state"))


def growth_snapshot(events: DataFrame, day, key: str = "user_id", time_col: str = "event_time") -> DataFrame:
    """The ``growth_accounting`` rows of one day, computed directly: every
    state depends only on the first active day, the last active day before
    ``day`` and activity on ``day``, so one aggregation per user suffices
    (no dense user x day grid, no running window). This is what a daily
    load reads as its previous partition when none is stored yet."""
    d = F.lit(day).cast("date")
    days = (
        events.where(F.col(key).isNotNull() & (F.to_date(time_col) <= d))
        .select(key, F.to_date(time_col).alias("_day"))
        .distinct()
    )
    per_user = days.groupBy(key).agg(
        F.min("_day").alias("first_active_date"),
        F.max("_day").alias("last_active_date"),
        F.max(F.when(F.col("_day") < d, F.col("_day"))).alias("_y_last"),
        F.max(F.when(F.col("_day") == d, F.col("_day"))).alias("_today"),
        F.array_sort(F.collect_list("_day")).alias("dates_active"),
    )
    has_y = d > F.col("first_active_date")
    y_date = F.date_sub(d, 1)
    return per_user.select(
        key,
        "first_active_date",
        "last_active_date",
        _daily_state(has_y, F.col("_today"), F.col("_y_last"), y_date).alias("daily_active_state"),
        _weekly_state(has_y, F.col("_today"), F.col("_y_last"), y_date).alias("weekly_active_state"),
        "dates_active",
        d.alias("date"),
    )
