"""Registered queries: cumulative tables, SCD type 2, graph model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.operators import cumulative, graph, scd
from cairn.plans import oracle_sql as O
from cairn.plans import standins
from cairn.plans.registry import input_key, register, scalar
from cairn.session import cut_lineage


def _players(spark, sf_dir):
    seasons = standins.player_seasons(spark, sf_dir)
    last = scalar(seasons, F.max("season"), input_key(sf_dir, "orders", "max_season"))
    return seasons, last


def players_summary(players: DataFrame) -> DataFrame:
    """Scalar view of the players table; the array as text, an entry
    ``season:games:points`` a season."""
    season = lambda s: F.concat_ws(":", s["season"].cast("string"), s["gp"].cast("string"), F.round(s["pts"] * s["gp"]).cast("long").cast("string"))
    return players.select(
        "player_id",
        "current_season",
        F.size("seasons").cast("long").alias("n_seasons"),
        F.aggregate("seasons", F.lit(0).cast("long"), lambda acc, s: acc + s["gp"]).alias("total_gp"),
        "scoring_class",
        "years_since_last_active",
        "is_active",
        F.array_join(F.transform("seasons", season), ",").alias("seasons"),
    )


PLAYERS_COLS = "player_id, current_season, n_seasons, total_gp, scoring_class, years_since_last_active, is_active, seasons"


@register("players_cumulated", O.with_(O.PLAYERS_DENSE) + f"SELECT {PLAYERS_COLS} FROM players", ids=("C02", "S07", "J06", "W05", "F06", "F07"))
def players_cumulated(spark, sf_dir):
    seasons, last = _players(spark, sf_dir)
    return players_summary(cumulative.players_backfill(seasons, last))


@register(
    "players_season_load",
    O.with_(O.PLAYERS_DENSE) + f"SELECT {PLAYERS_COLS} FROM players WHERE current_season = (SELECT max(season) FROM player_seasons)",
    ids=("C01", "J01", "F01", "P08", "P09", "P10"),
)
def players_season_load(spark, sf_dir):
    seasons, last = _players(spark, sf_dir)
    # the previous season's snapshot is all the step reads (one partition in production)
    prev = cut_lineage(cumulative.players_backfill(seasons, last - 1).where(F.col("current_season") == last - 1))
    return players_summary(cumulative.players_step(prev, seasons, last))


@register(
    "players_first_last_ratio",
    O.with_(O.PLAYERS_DENSE)
    + """SELECT player_id, last_pts / CASE WHEN first_pts = 0 THEN 1 ELSE first_pts END AS ratio_most_recent_to_first
FROM players WHERE current_season = (SELECT max(season) FROM player_seasons)""",
    ids=("C03", "F04", "F25"),
)
def players_first_last_ratio(spark, sf_dir):
    seasons, last = _players(spark, sf_dir)
    p = cumulative.players_backfill(seasons, last).where(F.col("current_season") == last)
    first = F.try_element_at("seasons", F.lit(1))["pts"]
    latest = F.try_element_at("seasons", F.lit(-1))["pts"]
    return p.select(
        "player_id",
        (latest / F.when(first == 0, F.lit(1.0)).otherwise(first)).alias("ratio_most_recent_to_first"),
    )


@register(
    "players_seasons_unnest",
    O.with_(O.PLAYER_SEASONS) + "SELECT player_id, season, gp, pts FROM player_seasons",
    ids=("C04", "F10"),
)
def players_seasons_unnest(spark, sf_dir):
    seasons, last = _players(spark, sf_dir)
    p = cumulative.players_backfill(seasons, last).where(F.col("current_season") == last)
    return p.select("player_id", F.inline("seasons")).select("player_id", "season", "gp", "pts")


SCD_ONE = """,
flags AS (
    SELECT player_id, current_season, scoring_class,
           CASE WHEN row_number() OVER w = 1 OR scoring_class IS DISTINCT FROM lag(scoring_class) OVER w
                THEN 1 ELSE 0 END AS chg
    FROM players WINDOW w AS (PARTITION BY player_id ORDER BY current_season)
),
streaks AS (
    SELECT *, sum(chg) OVER (PARTITION BY player_id ORDER BY current_season
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak_identifier
    FROM flags
)
SELECT player_id, scoring_class, min(current_season) AS start_season, max(current_season) AS end_season,
       (SELECT max(season) FROM player_seasons) AS current_season, CAST(streak_identifier AS BIGINT) AS streak_identifier
FROM streaks GROUP BY player_id, streak_identifier, scoring_class"""


@register("players_scd", "WITH " + O.PLAYERS_DENSE + SCD_ONE, ids=("C05", "W03", "W04", "P11", "A02", "P17"))
def players_scd(spark, sf_dir):
    seasons, last = _players(spark, sf_dir)
    players = cumulative.players_backfill(seasons, last)
    return scd.scd_backfill(
        players, "player_id", "current_season", ["scoring_class"], as_of=last,
        start_name="start_season", end_name="end_season", as_of_name="current_season",
    )


SCD_TWO_PLAYERS = """,
flags AS (
    SELECT player_id, current_season, scoring_class, is_active,
           CASE WHEN row_number() OVER w = 1
                  OR scoring_class IS DISTINCT FROM lag(scoring_class) OVER w
                  OR is_active IS DISTINCT FROM lag(is_active) OVER w
                THEN 1 ELSE 0 END AS chg
    FROM players WINDOW w AS (PARTITION BY player_id ORDER BY current_season)
),
streaks AS (
    SELECT *, sum(chg) OVER (PARTITION BY player_id ORDER BY current_season
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak_identifier
    FROM flags
)
SELECT player_id, scoring_class, is_active, min(current_season) AS start_season, max(current_season) AS end_season,
       (SELECT max(season) FROM player_seasons) AS current_season
FROM streaks GROUP BY player_id, streak_identifier, scoring_class, is_active"""


@register("players_scd_increment", "WITH " + O.PLAYERS_DENSE + SCD_TWO_PLAYERS, ids=("C07", "J05", "U01", "P02", "P16", "F03"))
def players_scd_increment(spark, sf_dir):
    seasons, last = _players(spark, sf_dir)
    players = cumulative.players_backfill(seasons, last)
    tracked = ["scoring_class", "is_active"]
    prev = cut_lineage(
        scd.scd_backfill(players, "player_id", "current_season", tracked, as_of=last - 1,
                         start_name="start_season", end_name="end_season", as_of_name="current_season")
    )
    return scd.scd_increment(
        prev, players, "player_id", "current_season", tracked, last,
        start_name="start_season", end_name="end_season", as_of_name="current_season",
    ).select("player_id", "scoring_class", "is_active", "start_season", "end_season", "current_season")


def _actors(spark, sf_dir):
    films = standins.actor_films(spark, sf_dir)
    last = scalar(films, F.max("year"), input_key(sf_dir, "lineitem", "max_film_year"))
    return films, last


def films_text(films: str) -> F.Column:
    """An array of films as text, ``filmid:votes:rating`` each."""
    film = lambda f: F.concat_ws(":", f["filmid"], f["votes"].cast("string"), f["rating"].cast("string"))
    return F.array_join(F.transform(films, film), ",")


def _votes(films: str) -> F.Column:
    return F.aggregate(films, F.lit(0).cast("long"), lambda acc, f: acc + f["votes"])


def history_summary(history: DataFrame) -> DataFrame:
    """The actors table by year with running totals and each year's films."""
    upto = Window.partitionBy("actorid").orderBy("current_year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # totals of a year first: the windows sort no arrays
    rows = history.select("*", F.size("new_films").cast("long").alias("n"), _votes("new_films").alias("v"), films_text("new_films").alias("text"))
    return rows.select(
        "actorid", "actor", "current_year", F.sum("n").over(upto).alias("n_films"), F.sum("v").over(upto).alias("total_votes"),
        "quality_class", "is_active", F.col("text").alias("new_films"),
    )


ACTOR_COLS = "actorid, actor, current_year, n_films, total_votes, quality_class, is_active"


@register("actors_cumulated", "WITH " + O.ACTORS_DENSE + f"\nSELECT {ACTOR_COLS}, new_films FROM actors", ids=("C08", "A05", "F02"))
def actors_cumulated(spark, sf_dir):
    films, last = _actors(spark, sf_dir)
    return history_summary(cumulative.actors_history(films, last))


@register(
    "actors_year_load",
    "WITH " + O.ACTORS_DENSE + f"""
SELECT {ACTOR_COLS}, films
FROM actors JOIN (SELECT actorid, string_agg(films, ',' ORDER BY year) AS films FROM actor_year GROUP BY actorid) USING (actorid)
WHERE current_year = (SELECT max(year) FROM actor_films)""",
    ids=("C08", "C09", "J01", "A05", "F01"),
)
def actors_year_load(spark, sf_dir):
    """This year's load on last year's snapshot, with whole film lists."""
    films, last = _actors(spark, sf_dir)
    prev = cut_lineage(cumulative.actors_backfill(films, last - 1))
    now = cumulative.actors_step(prev, films, last)
    return now.select(
        "actorid", "actor", "current_year", F.size("films").cast("long").alias("n_films"), _votes("films").alias("total_votes"),
        "quality_class", "is_active", films_text("films").alias("films"),
    )


@register(
    "actors_upsert_load",
    "WITH " + O.ACTORS_DENSE + f"\nSELECT {ACTOR_COLS}, new_films FROM actors",
    ids=("C09", "S16", "J01"),
)
def actors_upsert_load(spark, sf_dir):
    """The stored actors table with this year's rows upserted on its key
    (actorid, current_year), as INSERT ... ON CONFLICT DO UPDATE does. Half
    of this year's rows are stored already, from an early load that saw no
    films; they conflict and are updated. The table keeps a year's films."""
    from cairn.sources.catalog import upsert

    films, last = _actors(spark, sf_dir)
    history = cut_lineage(cumulative.actors_history(films, last - 1), "actors_table")
    incoming = cut_lineage(cumulative.actors_history_step(history, films, last), "actors_year")
    early = cumulative.actors_history_step(history, films.where("year < 0"), last).where(F.col("actorid") % 2 == 0)
    stored = history.unionByName(early)
    merged = upsert(stored, incoming, ["actorid", "current_year"], partition_col="current_year", partitions=[last])
    return history_summary(merged)


ACTORS_SCD = """,
flags AS (
    SELECT actorid, actor, current_year, quality_class, is_active,
           CASE WHEN row_number() OVER w = 1
                  OR quality_class IS DISTINCT FROM lag(quality_class) OVER w
                  OR is_active IS DISTINCT FROM lag(is_active) OVER w
                THEN 1 ELSE 0 END AS chg
    FROM actors WINDOW w AS (PARTITION BY actorid ORDER BY current_year)
),
streaks AS (
    SELECT *, sum(chg) OVER (PARTITION BY actorid ORDER BY current_year
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak_identifier
    FROM flags
)
SELECT actorid, max(actor) AS actor, quality_class, is_active, min(current_year) AS start_year, max(current_year) AS end_year,
       (SELECT max(year) FROM actor_films) AS current_year, CAST(streak_identifier AS BIGINT) AS streak_identifier
FROM streaks GROUP BY actorid, streak_identifier, quality_class, is_active"""


@register("actors_history_scd", "WITH " + O.ACTORS_DENSE + ACTORS_SCD, ids=("C06",))
def actors_history_scd(spark, sf_dir):
    films, last = _actors(spark, sf_dir)
    actors = cumulative.actors_history(films, last)
    return scd.scd_backfill(
        actors, "actorid", "current_year", ["quality_class", "is_active"], as_of=last,
        start_name="start_year", end_name="end_year", as_of_name="current_year", carry=["actor"],
    )


ACTORS_SCD_NO_STREAK = """,
flags AS (
    SELECT actorid, actor, current_year, quality_class, is_active,
           CASE WHEN row_number() OVER w = 1
                  OR quality_class IS DISTINCT FROM lag(quality_class) OVER w
                  OR is_active IS DISTINCT FROM lag(is_active) OVER w
                THEN 1 ELSE 0 END AS chg
    FROM actors WINDOW w AS (PARTITION BY actorid ORDER BY current_year)
),
runs AS (
    SELECT *, sum(chg) OVER (PARTITION BY actorid ORDER BY current_year
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_no
    FROM flags
)
SELECT actorid, quality_class, is_active, min(current_year) AS start_year, max(current_year) AS end_year,
       (SELECT max(year) FROM actor_films) AS current_year
FROM runs GROUP BY actorid, run_no, quality_class, is_active"""


@register("actors_scd_increment", "WITH " + O.ACTORS_DENSE + ACTORS_SCD_NO_STREAK, ids=("C07", "C06"))
def actors_scd_increment(spark, sf_dir):
    """Last year's actors_history_scd plus this year's actors snapshot."""
    films, last = _actors(spark, sf_dir)
    actors = cumulative.actors_history(films, last)
    tracked = ["quality_class", "is_active"]
    prev = cut_lineage(
        scd.scd_backfill(actors, "actorid", "current_year", tracked, as_of=last - 1,
                         start_name="start_year", end_name="end_year", as_of_name="current_year")
    )
    return scd.scd_increment(
        prev, actors, "actorid", "current_year", tracked, last,
        start_name="start_year", end_name="end_year", as_of_name="current_year",
    ).select("actorid", "quality_class", "is_active", "start_year", "end_year", "current_year")


# --- graph ---------------------------------------------------------------

TEAMS_SQL = """teams AS (
    SELECT n.n_nationkey AS team_id, 'T' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS abbreviation,
           n.n_name AS nickname, r.r_name AS city, s.s_name AS arena,
           CAST(1900 + n.n_nationkey AS BIGINT) AS yearfounded, s.s_suppkey AS source_rank
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


@register(
    "team_vertices",
    "WITH " + TEAMS_SQL + """
SELECT team_id AS identifier, 'team' AS type,
       json_object('abbreviation', abbreviation, 'nickname', nickname, 'city', city,
                   'arena', arena, 'year_founded', yearfounded)::VARCHAR AS properties
FROM (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY source_rank) AS rn FROM teams) WHERE rn = 1""",
    ids=("C10", "W01", "F13"),
)
def team_vertices(spark, sf_dir):
    return graph.team_vertices(standins.teams(spark, sf_dir))


@register(
    "team_vertices_map",
    "WITH " + TEAMS_SQL + """
SELECT team_id AS identifier, 'team' AS type,
       concat_ws(';', 'abbreviation=' || abbreviation, 'arena=' || arena, 'city=' || city, 'nickname=' || nickname,
                 'year_founded=' || CAST(yearfounded AS VARCHAR)) AS properties
FROM (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY source_rank) AS rn FROM teams) WHERE rn = 1""",
    ids=("C10", "F12"),
)
def team_vertices_map(spark, sf_dir):
    """Team vertices with a MAP of properties; the map as text by key."""
    v = graph.team_vertices(standins.teams(spark, sf_dir), as_map=True)
    shown = F.transform(F.array_sort(F.map_entries("properties")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return v.select("identifier", "type", F.array_join(shown, ";").alias("properties"))


def _dedup_details(spark, sf_dir):
    """Deduplicated game details. The dedup runs on the line items before
    the player columns are attached (they depend on the player only): the
    aggregation reduces each task's rows before the shuffle, and the join
    then sees one row per (player, game), so a hot player cannot pile raw
    rows into one join task."""
    lines = standins.game_detail_lines(spark, sf_dir)
    one = graph.dedup(lines, ["player_id", "game_id"], list(standins.DEDUP_ORDER))
    return standins.attach_players(one, spark, sf_dir)


@register(
    "game_details_dedup",
    "WITH " + O.GAME_DETAILS + """
SELECT game_id, team_id, team_abbreviation, player_id, player_name, start_position, pts, game_date
FROM game_details_dedup""",
    ids=("C31", "A08"),
)
def game_details_dedup(spark, sf_dir):
    return _dedup_details(spark, sf_dir).select(
        "game_id", "team_id", "team_abbreviation", "player_id", "player_name", "start_position", "pts", "game_date"
    )


@register(
    "player_game_edges",
    "WITH " + O.GAME_DETAILS + """
SELECT player_id AS subject_identifier, 'player' AS subject_type, game_id AS object_identifier,
       'game' AS object_type, 'plays_in' AS edge_type,
       json_object('start_position', start_position, 'pts', pts, 'team_id', team_id,
                   'team_abbreviation', team_abbreviation)::VARCHAR AS properties
FROM game_details_dedup""",
    ids=("C11",),
)
def player_game_edges(spark, sf_dir):
    return graph.player_game_edges(_dedup_details(spark, sf_dir))


@register(
    "player_player_edges",
    "WITH " + O.GAME_DETAILS + """
, rosters AS (
    SELECT list({'id': player_id, 'name': player_name, 'team': team_abbreviation, 'pts': pts} ORDER BY player_id) AS r
    FROM game_details_dedup GROUP BY game_id
),
firsts AS (SELECT r, unnest(range(2, len(r) + 1)) AS i FROM rosters),
pairs AS (SELECT r[i] AS s, unnest(r[1:i - 1]) AS o FROM firsts)
SELECT s.id AS subject_identifier, s.name AS subject_name, o.id AS object_identifier, o.name AS object_name,
       if(s.team = o.team, 'shares_team', 'plays_against') AS edge_type,
       count(*) AS num_games, sum(s.pts) AS subject_points, sum(o.pts) AS object_points
FROM pairs WHERE s.name <> o.name GROUP BY ALL""",
    ids=("C12", "J08", "A11", "J17"),
)
def player_player_edges(spark, sf_dir):
    return graph.player_player_edges(_dedup_details(spark, sf_dir))
