"""Cumulative (snapshot) tables: yesterday FULL OUTER JOIN today.

Two forms per table:

* ``*_step``: one period, reads the previous snapshot and this period's
  facts. This is the daily production job; write its result as one new
  partition (``cairn.sources.catalog.write_partition``) so the next run
  reads a materialised table, not a growing lineage.
* ``*_backfill``: all periods in one plan. The entity x period grid is
  made with ``explode(sequence(first, last))`` (no theta join), and the
  history array with a running window. Tests prove it equal to looping
  the step.

The join key is the only shuffle key; both sides are pre-aggregated to
one row per entity before the join, so a hot entity adds one row, not
its raw event count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.arrays import append_if, concat_arrays
from cairn.functions.banding import QUALITY_BANDS, SCORING_BANDS, band

SEASON_FIELDS = ("season", "gp", "pts")


def _season_struct(prefix: str = "") -> F.Column:
    return F.struct(*[F.col(prefix + f).alias(f) for f in SEASON_FIELDS])


def players_step(prev: DataFrame, seasons: DataFrame, period: int, key: str = "player_id") -> DataFrame:
    """One season of the players table (reference C01).

    ``prev``: players snapshot (``current_season`` column); ``seasons``:
    per-player season facts (``season``, ``gp``, ``pts``).
    """
    y = prev.where(F.col("current_season") == period - 1).alias("y")
    t = seasons.where(F.col("season") == period).alias("t")
    active = F.col("t.season").isNotNull()
    return y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full").select(
        F.coalesce(F.col(f"y.{key}"), F.col(f"t.{key}")).alias(key),
        append_if(F.col("y.seasons"), active, _season_struct("t.")).alias("seasons"),
        F.when(active, band(F.col("t.pts"), SCORING_BANDS)).otherwise(F.col("y.scoring_class")).alias("scoring_class"),
        F.when(active, F.lit(0)).otherwise(F.col("y.years_since_last_active") + 1).alias("years_since_last_active"),
        active.alias("is_active"),
        F.lit(period).alias("current_season"),
    )


def players_backfill(seasons: DataFrame, last_period: int, key: str = "player_id") -> DataFrame:
    """Every player x season from the player's first season up to
    ``last_period`` (reference C02).

    The running ``collect_list`` is quadratic in periods per entity, which
    is fine for seasons/years; for daily periods use ``players_step``.
    """
    seasons = seasons.where(F.col("season") <= last_period)
    firsts = seasons.groupBy(key).agg(F.min("season").alias("_first"))
    grid = firsts.select(key, F.explode(F.sequence(F.col("_first"), F.lit(last_period))).alias("current_season"))
    facts = seasons.select(key, F.col("season").alias("current_season"), "season", "gp", "pts")
    dense = grid.join(facts, [key, "current_season"], "left")
    w = Window.partitionBy(key).orderBy("current_season").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = dense.withColumn(
        "seasons", F.collect_list(F.when(F.col("season").isNotNull(), _season_struct())).over(w)
    )
    last = F.try_element_at(F.col("seasons"), F.lit(-1))
    return hist.select(
        key,
        "seasons",
        band(last["pts"], SCORING_BANDS).alias("scoring_class"),
        (F.col("current_season") - last["season"]).alias("years_since_last_active"),
        (last["season"] == F.col("current_season")).alias("is_active"),
        "current_season",
    )


def actor_year_films(films: DataFrame, key: str = "actorid") -> DataFrame:
    """Films of one actor-year as a sorted array plus the average rating."""
    return films.groupBy(key, "year").agg(
        F.max("actor").alias("actor"),
        F.array_sort(F.collect_list(F.struct("filmid", "film", "votes", "rating"))).alias("films"),
        F.avg("rating").alias("avg_rating"),
    )


def actors_step(prev: DataFrame, films: DataFrame, year: int, key: str = "actorid") -> DataFrame:
    """One year of the actors table (reference C08)."""
    y = prev.where(F.col("current_year") == year - 1).alias("y")
    t = actor_year_films(films.where(F.col("year") == year), key).alias("t")
    active = F.col("t.year").isNotNull()
    return t.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full").select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.coalesce(F.col("t.actor"), F.col("y.actor")).alias("actor"),
        concat_arrays(F.col("y.films"), F.col("t.films")).alias("films"),
        F.when(active, band(F.col("t.avg_rating"), QUALITY_BANDS)).otherwise(F.col("y.quality_class")).alias("quality_class"),
        active.alias("is_active"),
        F.coalesce(F.col("t.year"), F.col("y.current_year") + 1).alias("current_year"),
    )


def actors_history_step(prev: DataFrame, films: DataFrame, year: int, key: str = "actorid") -> DataFrame:
    """One year of the actors history: as ``actors_step``, but a row holds
    only this year's films (``new_films``, empty in an idle year), so its
    size does not grow with an actor's career."""
    empty = F.expr("CAST(array() AS array<struct<filmid:string,film:string,votes:int,rating:int>>)")
    y = prev.where(F.col("current_year") == year - 1).withColumn("films", F.lit(None)).drop("new_films")
    step = actors_step(y.withColumn("films", empty), films, year, key)
    return step.withColumnRenamed("films", "new_films").select(key, "actor", "new_films", "quality_class", "is_active", "current_year")


def actors_history(films: DataFrame, last_year: int, key: str = "actorid") -> DataFrame:
    """Every actor x year from the actor's first film year, one plan; each
    row holds the films of its year alone. ``actors_snapshot`` puts the whole
    list together for the year that is asked for."""
    per_year = actor_year_films(films.where(F.col("year") <= last_year), key)
    firsts = per_year.groupBy(key).agg(F.min("year").alias("_first"))
    grid = firsts.select(key, F.explode(F.sequence(F.col("_first"), F.lit(last_year))).alias("current_year"))
    dense = grid.join(per_year.withColumnRenamed("year", "current_year").withColumn("_y", F.col("current_year")),
                      [key, "current_year"], "left")
    w = Window.partitionBy(key).orderBy("current_year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dense.select(
        key,
        # last non-NULL per running frame carries the class and name forward
        F.last("actor", ignorenulls=True).over(w).alias("actor"),
        concat_arrays(F.col("films"), F.lit(None)).alias("new_films"),
        F.last(F.when(F.col("_y").isNotNull(), band(F.col("avg_rating"), QUALITY_BANDS)), ignorenulls=True)
        .over(w)
        .alias("quality_class"),
        F.col("_y").isNotNull().alias("is_active"),
        "current_year",
    )


def actors_snapshot(history: DataFrame, year: int, key: str = "actorid") -> DataFrame:
    """The actors table of one year with whole film lists, from the history:
    an actor's years are put together once, in order."""
    upto = history.where(F.col("current_year") <= year)
    found = upto.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.size("new_films") > 0, F.struct("current_year", "new_films")))).alias("years"),
        F.max_by(F.struct("actor", "quality_class", "is_active", "current_year"), "current_year").alias("now"),
    )
    return found.where(F.col("now.current_year") == year).select(
        key, "now.actor", F.flatten(F.transform("years", lambda y: y["new_films"])).alias("films"),
        "now.quality_class", "now.is_active", "now.current_year",
    )


def actors_backfill(films: DataFrame, last_year: int, key: str = "actorid") -> DataFrame:
    """The actors table of ``last_year`` in one pass over all films."""
    return actors_snapshot(actors_history(films, last_year, key), last_year, key)


def dates_cumulated_step(prev: DataFrame, events: DataFrame, key, day, time_col: str = "event_time") -> DataFrame:
    """One day of a date-list table (users_cumulated / hosts_cumulated /
    user_devices_cumulated). ``key`` is a column or a list of them; rows
    whose first key is NULL are left out, further keys may be NULL.

    ``prev`` holds the keys, ``dates_active`` and ``date`` for ``day - 1``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    d = F.lit(day).cast("date")
    y = prev.where(F.col("date") == F.date_sub(d, 1)).alias("y")
    # one day: distinct on the keys alone, so today's side is hash-partitioned
    # on the join keys (one shuffle; none on a snapshot bucketed by the key)
    t = (
        events.where(F.col(keys[0]).isNotNull() & (F.to_date(time_col) == d))
        .select(*keys)
        .distinct()
        .withColumn("active_date", d)
        .alias("t")
    )
    on = F.col(f"t.{keys[0]}") == F.col(f"y.{keys[0]}")
    for k in keys[1:]:
        on = on & F.col(f"t.{k}").eqNullSafe(F.col(f"y.{k}"))
    return t.join(y, on, "full").select(
        *[F.coalesce(F.col(f"t.{k}"), F.col(f"y.{k}")).alias(k) for k in keys],
        append_if(F.col("y.dates_active"), F.col("t.active_date").isNotNull(), F.col("t.active_date")).alias("dates_active"),
        F.coalesce(F.col("t.active_date"), F.date_add(F.col("y.date"), 1)).alias("date"),
    )


def dates_cumulated(events: DataFrame, key, as_of, time_col: str = "event_time") -> DataFrame:
    """Date-list snapshot at ``as_of`` in one pass (equal to looping the step
    from the first event day): ascending distinct active days per key."""
    keys = [key] if isinstance(key, str) else list(key)
    days = (
        events.where(F.col(keys[0]).isNotNull())
        .where(F.to_date(time_col) <= F.lit(as_of).cast("date"))
        .select(*keys, F.to_date(time_col).alias("active_date"))
        .distinct()
    )
    return days.groupBy(*keys).agg(F.array_sort(F.collect_list("active_date")).alias("dates_active")).withColumn(
        "date", F.lit(as_of).cast("date")
    )


def device_activity_datelist(events: DataFrame, devices: DataFrame, as_of) -> DataFrame:
    """Per user a ``MAP<browser_type, ARRAY<DATE>>`` of active days (reference
    homework: user_devices_cumulated)."""
    joined = events.join(devices.select("device_id", "browser_type"), "device_id").withColumn(
        "browser_type", F.coalesce("browser_type", F.lit("unknown"))
    )
    per_browser = dates_cumulated(joined, ["user_id", "browser_type"], as_of)
    return per_browser.groupBy("user_id", "date").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("browser_type", "dates_active")))).alias(
            "device_activity_datelist"
        )
    )
