"""The stand-in rules of ``cairn.plans.standins`` written as DuckDB SQL CTEs.

Registered oracle queries start with ``WITH`` + the CTEs they need. Keep
these in step with ``standins.py``: they are the independent statement of
the same rules.
"""

from cairn.plans.standins import BROWSERS, DEVICE_TYPES, HOSTS, OSES, REFERRERS

PLAYER_SEASONS = """player_seasons AS (
    SELECT o_custkey AS player_id,
           CAST(year(o_orderdate) AS INTEGER) AS season,
           count(*) AS gp,
           CAST(sum(floor(o_totalprice / CAST(16000.0 AS DOUBLE))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS pts
    FROM orders
    WHERE o_custkey IS NOT NULL
    GROUP BY 1, 2
)"""

SCORING = "CASE WHEN {v} > 20 THEN 'star' WHEN {v} > 15 THEN 'good' WHEN {v} > 10 THEN 'average' ELSE 'bad' END"
QUALITY = "CASE WHEN {v} > 8 THEN 'star' WHEN {v} > 7 THEN 'good' WHEN {v} > 6 THEN 'average' ELSE 'bad' END"

# dense players table: every player x season from the first season to the last
PLAYERS_DENSE = PLAYER_SEASONS + """,
player_firsts AS (
    SELECT player_id, min(season) AS first_season FROM player_seasons GROUP BY 1
),
player_grid AS (
    SELECT player_id,
           CAST(unnest(generate_series(first_season, (SELECT max(season) FROM player_seasons))) AS INTEGER) AS current_season
    FROM player_firsts
),
player_hist AS (
    SELECT g.player_id, g.current_season,
           count(s.season) OVER w AS n_seasons,
           sum(s.gp) OVER w AS total_gp,
           string_agg(s.season || ':' || s.gp || ':' || CAST(round(s.pts * s.gp) AS BIGINT), ',') OVER w AS seasons,
           last_value(s.pts IGNORE NULLS) OVER w AS last_pts,
           first_value(s.pts IGNORE NULLS) OVER w AS first_pts,
           max(s.season) OVER w AS last_season
    FROM player_grid g
    LEFT JOIN player_seasons s ON s.player_id = g.player_id AND s.season = g.current_season
    WINDOW w AS (PARTITION BY g.player_id ORDER BY g.current_season
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
players AS (
    SELECT player_id, current_season,
           CAST(n_seasons AS BIGINT) AS n_seasons,
           CAST(total_gp AS BIGINT) AS total_gp,
           """ + SCORING.format(v="last_pts") + """ AS scoring_class,
           current_season - last_season AS years_since_last_active,
           last_season = current_season AS is_active,
           last_pts, first_pts, seasons
    FROM player_hist
)"""

ACTOR_FILMS = """actor_films AS (
    SELECT l_partkey AS actorid,
           'actor-' || CAST(l_partkey AS VARCHAR) AS actor,
           CAST(l_quantity AS INTEGER) AS votes,
           CAST(round(l_discount * 100) AS INTEGER) AS rating,
           CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS filmid,
           CAST(year(l_shipdate) AS INTEGER) AS year
    FROM lineitem
)"""

ACTORS_DENSE = ACTOR_FILMS + """,
actor_year AS (
    SELECT actorid, year, max(actor) AS actor, count(*) AS n_films, sum(votes) AS votes, avg(rating) AS avg_rating,
           string_agg(filmid || ':' || votes || ':' || rating, ',' ORDER BY filmid, votes, rating) AS films
    FROM actor_films GROUP BY 1, 2
),
actor_grid AS (
    SELECT actorid,
           CAST(unnest(generate_series(min(year), (SELECT max(year) FROM actor_films))) AS INTEGER) AS current_year
    FROM actor_year GROUP BY actorid
),
actor_hist AS (
    SELECT g.actorid, g.current_year,
           last_value(a.actor IGNORE NULLS) OVER w AS actor,
           sum(a.n_films) OVER w AS n_films,
           sum(a.votes) OVER w AS total_votes,
           last_value(CASE WHEN a.year IS NOT NULL THEN """ + QUALITY.format(v="a.avg_rating") + """ END IGNORE NULLS)
               OVER w AS quality_class,
           a.year IS NOT NULL AS is_active, coalesce(a.films, '') AS new_films
    FROM actor_grid g
    LEFT JOIN actor_year a ON a.actorid = g.actorid AND a.year = g.current_year
    WINDOW w AS (PARTITION BY g.actorid ORDER BY g.current_year
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
actors AS (
    SELECT actorid, actor, current_year, CAST(n_films AS BIGINT) AS n_films,
           CAST(total_votes AS BIGINT) AS total_votes, quality_class, is_active, new_films
    FROM actor_hist
)"""

GAME_DETAILS = """game_details AS (
    SELECT l.l_orderkey AS game_id, s.s_nationkey AS team_id,
           'T' || lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS team_abbreviation,
           l.l_suppkey AS player_id, s.s_name AS player_name,
           l.l_returnflag AS start_position, l.l_quantity AS pts,
           CAST(l.l_shipdate AS DATE) AS game_date,
           l.l_linenumber, l.l_partkey, l.l_extendedprice, l.l_discount, l.l_tax, l.l_linestatus
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
game_details_dedup AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY player_id, game_id
            ORDER BY l_linenumber, l_partkey, pts, l_extendedprice, l_discount, l_tax,
                     start_position, l_linestatus, game_date) AS rn
        FROM game_details)
    WHERE rn = 1
)"""

def _case(index_sql: str, values) -> str:
    parts = []
    for i, v in enumerate(values):
        lit = "NULL" if v is None else "'" + v + "'"
        parts.append(f"WHEN {i} THEN {lit}")
    return f"CASE {index_sql} " + " ".join(parts) + " END"


WEB_EVENTS = """web_events AS (
    SELECT event_id,
           '/' || event_type AS url,
           """ + _case("(CAST(json_extract_string(props, '$.k') AS INTEGER) % 6)", REFERRERS) + """ AS referrer,
           user_id,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS device_id,
           """ + _case("(user_id % 3)", HOSTS) + """ AS host,
           CAST((user_id * 7) % 223 + 1 AS VARCHAR) || '.' || CAST((user_id * 13) % 256 AS VARCHAR) || '.' ||
           CAST((user_id * 17) % 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
           ts AS event_time,
           event_type,
           value
    FROM events
)"""

DEVICES = WEB_EVENTS + """,
devices AS (
    SELECT device_id,
           CASE WHEN device_id % 13 = 0 THEN NULL ELSE """ + _case("(device_id % 4)", BROWSERS) + """ END AS browser_type,
           """ + _case("(device_id % 5)", OSES) + """ AS os_type,
           CASE WHEN device_id % 17 = 0 THEN NULL ELSE """ + _case("(device_id % 3)", DEVICE_TYPES) + """ END AS device_type
    FROM (SELECT DISTINCT device_id FROM web_events WHERE device_id IS NOT NULL)
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
