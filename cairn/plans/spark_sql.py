"""Registered queries written as Spark SQL text over named frames, plus
small checks and readouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import cumulative, experiments, joins, quality
from cairn.plans import oracle_sql as O
from cairn.plans import standins
from cairn.plans.analytics import ASSIGN_SQL, _assignment
from cairn.plans.dimensional import TEAMS_SQL, _players, players_summary
from cairn.plans.facts import USER_DAILY, _array_metrics, _events, _month_slots, _monthly_hits
from cairn.plans.registry import register
from cairn.sources.views import run_sql

# Streaks over a table with one row per player and season: within a player
# and class, season minus rank is the same for seasons that follow each other.
PLAYERS_SCD_SPARK_SQL = """
WITH ranked AS (
    SELECT player_id, scoring_class, current_season,
           current_season - rank() OVER (PARTITION BY player_id, scoring_class ORDER BY current_season) AS streak
    FROM {players}
),
spans AS (
    SELECT player_id, scoring_class, array_agg(current_season) AS seasons
    FROM ranked
    GROUP BY player_id, scoring_class, streak
)
SELECT player_id, scoring_class, array_min(seasons) AS start_season, array_max(seasons) AS end_season
FROM spans
"""

@register(
    "players_scd_sql",
    "WITH " + O.PLAYERS_DENSE + """,
flags AS (
    SELECT player_id, current_season, scoring_class,
           CASE WHEN row_number() OVER w = 1 OR scoring_class IS DISTINCT FROM lag(scoring_class) OVER w
                THEN 1 ELSE 0 END AS chg
    FROM players WINDOW w AS (PARTITION BY player_id ORDER BY current_season)
),
streaks AS (
    SELECT *, sum(chg) OVER (PARTITION BY player_id ORDER BY current_season
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM flags
)
SELECT player_id, scoring_class, min(current_season) AS start_season, max(current_season) AS end_season
FROM streaks GROUP BY player_id, sid, scoring_class""",
    ids=("C05", "S18", "P03"),
)
def players_scd_sql(spark, sf_dir):
    seasons, last = _players(spark, sf_dir)
    players = players_summary(cumulative.players_backfill(seasons, last))
    return run_sql(spark, PLAYERS_SCD_SPARK_SQL, players=players)


# The best-ranked source row of a team, by an aggregate (no window, no sort).
TEAM_VERTEX_SPARK_SQL = """
FROM {teams}
|> AGGREGATE min_by(struct(abbreviation, nickname, city, arena, yearfounded), source_rank) AS t GROUP BY team_id
|> SELECT team_id AS identifier, 'team' AS `type`,
          to_json(named_struct('abbreviation', t.abbreviation, 'nickname', t.nickname, 'city', t.city,
                               'arena', t.arena, 'year_founded', string(t.yearfounded))) AS properties
"""

@register(
    "team_vertices_sql",
    "WITH " + TEAMS_SQL + """
SELECT team_id AS identifier, 'team' AS type,
       json_object('abbreviation', abbreviation, 'nickname', nickname, 'city', city,
                   'arena', arena, 'year_founded', CAST(yearfounded AS VARCHAR))::VARCHAR AS properties
FROM (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY source_rank) AS rn FROM teams) WHERE rn = 1""",
    ids=("C10",),
)
def team_vertices_sql(spark, sf_dir):
    return run_sql(spark, TEAM_VERTEX_SPARK_SQL, teams=standins.teams(spark, sf_dir))


# Slots as rows, then a pivot of the first three positions; a month without
# such a slot counts 0.
MONTHLY_SITE_HITS_SPARK_SQL = """
WITH slots AS (
    SELECT month_start, pos, hits
    FROM {monthly} LATERAL VIEW OUTER posexplode(hit_array) AS pos, hits
    WHERE date_partition = :ds
)
SELECT month_start, coalesce(num_hits_first_day, 0) AS num_hits_first_day,
       coalesce(num_hits_second_day, 0) AS num_hits_second_day, coalesce(num_hits_third_day, 0) AS num_hits_third_day
FROM slots
PIVOT (sum(hits) FOR pos IN (0 AS num_hits_first_day, 1 AS num_hits_second_day, 2 AS num_hits_third_day))
"""

@register(
    "monthly_site_hits_sql",
    O.with_(O.WEB_EVENTS, USER_DAILY)
    + f""",
{_month_slots("user_id", "user_daily")}
SELECT s.month_start,
       CAST(sum(CASE WHEN s.day = s.month_start THEN coalesce(u.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_first_day,
       CAST(sum(CASE WHEN s.day = s.month_start + 1 THEN coalesce(u.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_second_day,
       CAST(sum(CASE WHEN s.day = s.month_start + 2 THEN coalesce(u.n, 0) ELSE 0 END) AS BIGINT) AS num_hits_third_day
FROM slots s LEFT JOIN user_daily u ON u.user_id = s.user_id AND u.day = s.day
GROUP BY s.month_start""",
    ids=("C20", "P04"),
)
def monthly_site_hits_sql(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    return run_sql(spark, MONTHLY_SITE_HITS_SPARK_SQL, {"ds": anchor}, monthly=_monthly_hits(ev, anchor))


@register(
    "array_metrics_cardinality",
    O.with_(O.WEB_EVENTS, USER_DAILY)
    + f""",
{_month_slots("user_id", "user_daily")}
SELECT cardinality, count(*) AS rows FROM (
    SELECT user_id, month_start, CAST(count(*) AS INTEGER) AS cardinality FROM slots GROUP BY 1, 2
) GROUP BY 1""",
    ids=("A13", "V3"),
)
def array_metrics_cardinality(spark, sf_dir):
    ev, anchor = _events(spark, sf_dir)
    return quality.array_length_histogram(_array_metrics(ev, anchor), "metric_array")


@register(
    "daily_hits_moving_average",
    O.with_(O.WEB_EVENTS)
    + """, daily AS (SELECT url, CAST(event_time AS DATE) AS day, count(*) AS hits FROM web_events GROUP BY 1, 2)
SELECT url, day, hits,
       avg(hits) OVER (PARTITION BY url ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS hits_7d_avg
FROM daily""",
    ids=("W14",),
)
def daily_hits_moving_average(spark, sf_dir):
    from pyspark.sql import Window

    ev = standins.web_events(spark, sf_dir)
    daily = ev.groupBy("url", F.to_date("event_time").alias("day")).agg(F.count(F.lit(1)).alias("hits"))
    w = Window.partitionBy("url").orderBy("day").rowsBetween(-6, 0)
    return daily.select("url", "day", "hits", F.avg("hits").over(w).alias("hits_7d_avg"))


@register(
    "experiment_z_test",
    O.with_(O.WEB_EVENTS, ASSIGN_SQL)
    + """, conv AS (
    SELECT DISTINCT user_id FROM web_events WHERE event_type = 'purchase' AND user_id IS NOT NULL
),
cell_stats AS (
    SELECT c.cell, CAST(count(*) AS DOUBLE) AS n, CAST(count(v.user_id) AS DOUBLE) AS x
    FROM cells c LEFT JOIN conv v ON c.user_id = v.user_id GROUP BY c.cell
),
both_cells AS (
    SELECT max(CASE WHEN cell = 'control' THEN n END) AS n1, max(CASE WHEN cell = 'control' THEN x END) AS x1,
           max(CASE WHEN cell = 'treatment' THEN n END) AS n2, max(CASE WHEN cell = 'treatment' THEN x END) AS x2
    FROM cell_stats
)
SELECT x1 / n1 AS control_rate, x2 / n2 AS treatment_rate,
       CASE WHEN se = 0 THEN NULL ELSE (x2 / n2 - x1 / n1) / se END AS z
FROM (SELECT *, sqrt(((x1 + x2) / (n1 + n2)) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2)) AS se
      FROM both_cells)""",
    ids=("E03",),
)
def experiment_z_test(spark, sf_dir):
    ev, assignment = _assignment(spark, sf_dir)
    return experiments.z_test(experiments.readout(assignment, ev, "purchase"))


@register(
    "match_star_join_rows",
    """WITH md AS (
    SELECT l_orderkey AS match_id, 'gamer-' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
           CAST(l_quantity AS INTEGER) AS player_total_kills
    FROM lineitem
),
mmp AS (
    SELECT l_orderkey AS match_id, 'gamer-' || CAST(l_suppkey AS VARCHAR) AS player_gamertag, l_partkey AS medal_id
    FROM lineitem
)
SELECT md.match_id, md.player_gamertag, md.player_total_kills, o.o_orderpriority AS playlist_id,
       n.n_name AS map_name, p.p_type AS medal_name
FROM md JOIN orders o ON o.o_orderkey = md.match_id
LEFT JOIN mmp ON mmp.match_id = md.match_id AND mmp.player_gamertag = md.player_gamertag
LEFT JOIN part p ON p.p_partkey = mmp.medal_id
LEFT JOIN nation n ON n.n_nationkey = CAST(o.o_custkey % 25 AS INTEGER)""",
    ids=("J16", "J02", "J03"),
)
def match_star_join_rows(spark, sf_dir):
    j = joins.match_star_join(
        standins.match_details(spark, sf_dir).select("match_id", "player_gamertag", "player_total_kills"),
        standins.matches(spark, sf_dir).select("match_id", "playlist_id", "mapid"),
        standins.medals_matches_players(spark, sf_dir).select("match_id", "player_gamertag", "medal_id"),
        standins.medals(spark, sf_dir),
        standins.maps(spark, sf_dir),
    )
    return j.select("match_id", "player_gamertag", "player_total_kills", "playlist_id", "map_name", "medal_name")
