"""Window analyses: grouping-set dashboards, winners, referrer trends.

Per-key ordered sequences (rolling stretches, streaks) are in
``cairn.operators.sequences``, which stays parallel for a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import cut_lineage

OVERALL = "(overall)"
TASK_ROWS = 250_000  # of game details in one task of the grouping sets

# Referrer classification rules of the reference (first match
# wins; anything else keeps the raw referrer). The reference's own-site
# patterns name its author's sites and are passed in by the caller instead.
REFERRER_RULES = (
    ("%linkedin%", "Linkedin"),
    ("%t.co%", "Twitter"),
    ("%google%", "Google"),
    ("%lnkd%", "Linkedin"),
)


def classify_referrer(ref, rules=REFERRER_RULES, own_site_patterns=(), own_site_label: str = "On Site"):
    expr = None
    for pattern, label in list(rules) + [(p, own_site_label) for p in own_site_patterns]:
        cond = ref.like(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(ref)


def with_devices(events: DataFrame, devices: DataFrame) -> DataFrame:
    """events JOIN devices with 'unknown' for missing attributes."""
    d = devices.select(
        "device_id",
        F.coalesce("os_type", F.lit("unknown")).alias("os_type"),
        F.coalesce("device_type", F.lit("unknown")).alias("device_type"),
        F.coalesce("browser_type", F.lit("unknown")).alias("browser_type"),
    )
    return events.join(d, "device_id", "inner")


def device_hits_dashboard(augmented: DataFrame) -> DataFrame:
    """GROUPING SETS ((browser, device, os), (browser), (os), (device)) with
    a level label from ``grouping()``; one partial aggregation."""
    g = augmented.groupingSets(
        [["browser_type", "device_type", "os_type"], ["browser_type"], ["os_type"], ["device_type"]],
        "browser_type", "device_type", "os_type",
    ).agg(
        F.count(F.lit(1)).alias("number_of_hits"),
        F.grouping("os_type").alias("_g_os"),
        F.grouping("device_type").alias("_g_dev"),
        F.grouping("browser_type").alias("_g_br"),
    )
    level = (
        F.when((F.col("_g_os") == 0) & (F.col("_g_dev") == 0) & (F.col("_g_br") == 0), "os_type__device_type__browser")
        .when(F.col("_g_br") == 0, "browser_type")
        .when(F.col("_g_dev") == 0, "device_type")
        .when(F.col("_g_os") == 0, "os_type")
    )
    return g.select(
        level.alias("aggregation_level"),
        F.coalesce("os_type", F.lit(OVERALL)).alias("os_type"),
        F.coalesce("device_type", F.lit(OVERALL)).alias("device_type"),
        F.coalesce("browser_type", F.lit(OVERALL)).alias("browser_type"),
        "number_of_hits",
    )


def game_winners(details: DataFrame) -> DataFrame:
    """Per (game, team): team points and ``won`` (most points in the game,
    lowest team id on a tie)."""
    per_team = details.groupBy("game_id", "team_id").agg(
        F.sum("pts").alias("team_pts"), F.min("game_date").alias("game_date")
    )
    w = Window.partitionBy("game_id").orderBy(F.desc("team_pts"), "team_id")
    return per_team.withColumn("won", F.row_number().over(w) == 1)


def game_details_grouping_sets(details: DataFrame) -> DataFrame:
    """GROUPING SETS ((player, team), (player, season), (team)): points,
    games and games won, each game counted once per group.

    Two plain aggregations instead of ``count_distinct``: the grouping sets
    first run at (set keys, game) grain, where the partial aggregation
    collapses a game's rows (several players of one team) before the
    shuffle; the second level then counts games per group. Spark's rewrite
    of two distinct aggregates would replicate every input row once more
    per distinct expression.

    The join, its sorts and the first aggregation hold all rows of a task,
    three times over for the grouping sets, so their tasks are as many as
    the rows need: about ``TASK_ROWS`` each.
    """
    details = cut_lineage(details.select("player_id", "team_id", "game_id", "game_date", "pts"), "game_details")
    tasks = details.count() // TASK_ROWS + 1
    near = lambda df: df.repartition(tasks, "game_id", "team_id")
    winners = near(game_winners(details).select("game_id", "team_id", "won"))
    df = near(details).join(winners, ["game_id", "team_id"]).withColumn("season", F.year("game_date"))
    keys = ["player_id", "team_id", "season", "game_id"]
    per_game = df.groupingSets(
        [["player_id", "team_id", "game_id"], ["player_id", "season", "game_id"], ["team_id", "game_id"]], *keys
    ).agg(
        F.grouping_id(*keys).alias("_gid"),
        F.sum("pts").alias("_pts"),
        F.max(F.col("won").cast("int")).alias("_won"),
    )
    g = per_game.groupBy("_gid", "player_id", "team_id", "season").agg(
        F.sum("_pts").alias("total_pts"),
        F.count(F.lit(1)).alias("games"),
        F.sum("_won").cast("long").alias("games_won"),
    )
    # grouping_id bits over (player, team, season, game): 2 = season rolled
    # up, 4 = team rolled up, 10 = player and season rolled up
    level = F.when(F.col("_gid") == 2, "player__team").when(F.col("_gid") == 4, "player__season").otherwise("team")
    return g.select(level.alias("aggregation_level"), "player_id", "team_id", "season", "total_pts", "games", "games_won")


def grouping_set_leaders(sets: DataFrame) -> DataFrame:
    """Top answer of each grouping-set question (ties by answer text):
    most points for one team, most points in one season, most games won by
    a team. Top-1 is the feature; each is a global TakeOrderedAndProject."""

    def top(level, question, answer, metric):
        return (
            sets.where(F.col("aggregation_level") == level)
            .select(answer.alias("answer"), metric.cast("double").alias("metric"))
            .orderBy(F.desc("metric"), F.asc("answer"))
            .limit(1)
            .select(F.lit(question).alias("question"), "answer", "metric")
        )

    pid = F.col("player_id").cast("string")
    return (
        top("player__team", "most_points_for_one_team", F.concat_ws("@", pid, F.col("team_id").cast("string")), F.col("total_pts"))
        .unionByName(top("player__season", "most_points_in_one_season", F.concat_ws("@", pid, F.col("season").cast("string")), F.col("total_pts")))
        .unionByName(top("team", "most_games_won_by_team", F.col("team_id").cast("string"), F.col("games_won")))
    )


def referrer_trends(augmented: DataFrame, min_total: int = 500, prev_week=(-13, -7)) -> DataFrame:
    """Daily hits per (referrer, url) with rolling, monthly and total sums.

    Aggregated to (url, referrer, day) first, so each window partition has
    one row per day. ``prev_week`` is the ROWS frame of the previous week;
    the reference's text uses (-13, -6), which overlaps the current week.
    """
    daily = augmented.groupBy("url", "referrer", F.to_date("event_time").alias("event_date")).agg(
        F.count(F.lit(1)).alias("count")
    )
    by_ru = Window.partitionBy("referrer", "url")
    ordered = by_ru.orderBy("event_date")
    month = Window.partitionBy("referrer", "url", F.trunc("event_date", "month"))
    w = daily.select(
        "referrer",
        "url",
        "event_date",
        "count",
        F.sum("count").over(month).alias("monthly_cumulative_sum"),
        F.sum("count").over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("rolling_cumulative_sum"),
        F.sum("count").over(by_ru).alias("total_cumulative_sum"),
        F.sum("count").over(ordered.rowsBetween(-6, 0)).alias("weekly_rolling_count"),
        F.sum("count").over(ordered.rowsBetween(*prev_week)).alias("previous_weekly_rolling_count"),
    )
    return w.where((F.col("total_cumulative_sum") > min_total) & F.col("referrer").isNotNull()).select(
        "referrer",
        "url",
        "event_date",
        "count",
        "weekly_rolling_count",
        "previous_weekly_rolling_count",
        "rolling_cumulative_sum",
        (F.col("count").cast("double") / F.col("monthly_cumulative_sum")).alias("pct_of_month"),
        (F.col("count").cast("double") / F.col("total_cumulative_sum")).alias("pct_of_total"),
    )


def calendar_rolling(daily: DataFrame, keys: list[str], day_col: str, value_col: str,
                     frames: dict[str, tuple[int, int]]) -> DataFrame:
    """Sums of ``value_col`` over frames of calendar days: a frame (-6, 0) is
    the day and the six days before it, whether or not they have a row. One
    row per keys and day is expected; a frame without any row gives NULL, a
    row with a NULL day sums over the rows with a NULL day."""
    day = F.datediff(day_col, F.lit("1970-01-01").cast("date"))
    order = Window.partitionBy(*keys).orderBy(day)
    sums = [F.sum(value_col).over(order.rangeBetween(a, b)).alias(name) for name, (a, b) in frames.items()]
    return daily.select("*", *sums)
