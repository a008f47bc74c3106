"""Registered queries: star join answers, bucketed and broadcast joins,
shared intermediates, enrichment, layout and validation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cairn.functions.banding import SCORING_DOMAIN
from cairn.operators import cumulative, enrich, joins, scd
from cairn.plans import oracle_sql as O
from cairn.plans import standins
from cairn.plans.dimensional import ACTORS_SCD_NO_STREAK, _actors, _players
from cairn.plans.facts import _events
from cairn.plans.registry import register
from cairn.session import cut_lineage
from cairn.sources.catalog import file_stats

MEDAL = "ECONOMY"

MATCH_SQL = """md AS (
    SELECT l_orderkey AS match_id, 'gamer-' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
           CAST(l_quantity AS INTEGER) AS kills
    FROM lineitem
),
m AS (SELECT DISTINCT o_orderkey AS match_id, o_orderpriority AS playlist_id, CAST(o_custkey % 25 AS INTEGER) AS mapid FROM orders)"""


@register(
    "match_leaderboard",
    "WITH " + MATCH_SQL + f""",
q1 AS (SELECT 'most_kills_per_game' AS question, player_gamertag AS answer,
              CAST(sum(kills) AS DOUBLE) / CAST(count(DISTINCT match_id) AS DOUBLE) AS metric
       FROM md GROUP BY 2 ORDER BY metric DESC, answer LIMIT 1),
q2 AS (SELECT 'most_played_playlist' AS question, playlist_id AS answer, CAST(count(*) AS DOUBLE) AS metric
       FROM m GROUP BY 2 ORDER BY metric DESC, answer LIMIT 1),
q3 AS (SELECT 'most_played_map' AS question, n.n_name AS answer, CAST(count(*) AS DOUBLE) AS metric
       FROM m JOIN nation n ON m.mapid = n.n_nationkey GROUP BY 2 ORDER BY metric DESC, answer LIMIT 1),
q4 AS (SELECT 'most_{MEDAL.lower()}_medals_map' AS question, n.n_name AS answer, CAST(count(*) AS DOUBLE) AS metric
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey AND p.p_type = '{MEDAL}'
       JOIN m ON m.match_id = l.l_orderkey JOIN nation n ON n.n_nationkey = m.mapid
       GROUP BY 2 ORDER BY metric DESC, answer LIMIT 1)
SELECT * FROM q1 UNION ALL SELECT * FROM q2 UNION ALL SELECT * FROM q3 UNION ALL SELECT * FROM q4""",
    ids=("C39", "J16", "A15", "O07", "J13", "O01", "O08", "U02"),
)
def match_leaderboard(spark, sf_dir):
    return joins.match_answers(
        standins.match_details(spark, sf_dir),
        standins.matches(spark, sf_dir),
        standins.medals_matches_players(spark, sf_dir),
        standins.medals(spark, sf_dir),
        standins.maps(spark, sf_dir),
        MEDAL,
    )


@register(
    "bucketed_match_kills",
    """SELECT o.o_orderkey AS match_id, CAST(o.o_orderdate AS DATE) AS completion_date, o.o_orderpriority AS playlist_id,
       count(*) AS players, CAST(sum(CAST(l.l_quantity AS INTEGER)) AS BIGINT) AS total_kills
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2, 3""",
    ids=("C28", "S22", "J12", "S13"),
)
def bucketed_match_kills(spark, sf_dir):
    matches, details = joins.bucketed_pair(
        spark,
        standins.matches(spark, sf_dir).select("match_id", "completion_date", "playlist_id"),
        standins.match_details(spark, sf_dir).select("match_id", "player_gamertag", "player_total_kills"),
        "match_id",
        name="matches",
    )
    # the merge hint keeps the bucketed plan where the planner would broadcast
    joined = details.join(matches.hint("merge"), "match_id")
    return joined.groupBy("match_id", "completion_date", "playlist_id").agg(
        F.count(F.lit(1)).alias("players"), F.sum("player_total_kills").cast("long").alias("total_kills")
    )


@register(
    "broadcast_match_details",
    """SELECT l.l_orderkey AS match_id, 'gamer-' || CAST(l.l_suppkey AS VARCHAR) AS player_gamertag,
       CAST(l.l_quantity AS INTEGER) AS player_total_kills, strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') AS ds
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    ids=("J13", "F27"),
)
def broadcast_match_details(spark, sf_dir):
    m = standins.matches(spark, sf_dir).select(
        "match_id", F.split(F.col("completion_date").cast("string"), " ").getItem(0).alias("ds")
    )
    m_side, _ = joins.broadcast_if_small(m)
    return standins.match_details(spark, sf_dir).join(m_side, "match_id").select(
        "match_id", "player_gamertag", "player_total_kills", "ds"
    )


@register(
    "busy_match_details",
    """SELECT match_id, player_gamertag, player_total_kills, total FROM (
    SELECT l_orderkey AS match_id, 'gamer-' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
           CAST(l_quantity AS INTEGER) AS player_total_kills,
           CAST(sum(CAST(l_quantity AS INTEGER)) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total
    FROM lineitem WHERE l_orderkey IS NOT NULL) WHERE total >= 200""",
    ids=("J14",),
)
def busy_match_details(spark, sf_dir):
    """Details of the matches with 200 kills or more; the join is broadcast
    or shuffled by the measured size of their totals."""
    details = standins.match_details(spark, sf_dir).select("match_id", "player_gamertag", "player_total_kills")
    return joins.totals_above(details, "match_id", "player_total_kills", 200)


@register(
    "user_device_rollup",
    O.with_(O.WEB_EVENTS)
    + """, agg AS (SELECT user_id, device_id, count(*) AS event_counts FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2)
SELECT user_id, max(event_counts) AS total_hits, count(*) AS n_devices,
       string_agg(CAST(device_id AS VARCHAR), ',' ORDER BY device_id) AS devices
FROM agg GROUP BY user_id""",
    ids=("C25", "A06"),
)
def user_device_rollup(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    users = joins.users_with_devices(joins.user_device_aggregate(ev))
    return users.select(
        "user_id", "total_hits", F.size("devices").cast("long").alias("n_devices"),
        F.concat_ws(",", F.transform("devices", lambda d: d.cast("string"))).alias("devices"),
    )


@register(
    "device_user_rollup",
    O.with_(O.DEVICES)
    + """, agg AS (SELECT user_id, device_id, count(*) AS event_counts FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2)
SELECT d.device_id, d.device_type, count(*) AS num_users, CAST(sum(a.event_counts) AS BIGINT) AS events
FROM devices d JOIN agg a ON d.device_id = a.device_id GROUP BY 1, 2""",
    ids=("C25", "A06"),
)
def device_user_rollup(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    return joins.devices_with_users(joins.user_device_aggregate(ev), standins.devices(spark, sf_dir))


@register(
    "events_with_devices",
    O.with_(O.DEVICES)
    + """SELECT e.user_id, e.device_id, upper(d.browser_type) AS browser_type, d.os_type, d.device_type,
       coalesce(e.referrer, 'unknown') AS referrer, e.host, e.url, e.event_time
FROM web_events e JOIN devices d ON e.device_id = d.device_id
WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""",
    ids=("C26", "P06", "J15", "F28", "F29", "P01", "P14", "P15"),
)
def events_with_devices(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    return joins.events_with_devices(ev, standins.devices(spark, sf_dir))


@register(
    "ip_geo_enrichment",
    O.with_(O.WEB_EVENTS)
    + """, loc AS (
    SELECT (CAST(n_nationkey AS BIGINT) * 8 + 1) * 16777216 AS start_ip,
           (CAST(n_nationkey AS BIGINT) * 8 + 1 + 8) * 16777216 - 1 AS end_ip,
           n_name AS country, r_name AS state, n_name || ' city' AS city
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
ev AS (
    SELECT *, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
              + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS ipn
    FROM web_events
)
SELECT ev.event_id, ev.ip, ev.event_time AS event_timestamp, ev.referrer, ev.host, ev.url,
       CASE WHEN loc.country IS NULL THEN '{}'
            ELSE json_object('country', loc.country, 'state', loc.state, 'city', loc.city)::VARCHAR END AS geodata
FROM ev LEFT JOIN loc ON ev.ipn BETWEEN loc.start_ip AND loc.end_ip""",
    ids=("C29", "X01", "T06", "F30"),
)
def ip_geo_enrichment(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    out = enrich.enrich_ip(ev, standins.ip_locations(spark, sf_dir))
    return out.select("event_id", "ip", F.col("event_time").alias("event_timestamp"), "referrer", "host", "url", "geodata")


# sort keys of the layouts; ties go by event_id
LAYOUTS = {
    "scattered": ["scramble"],
    "by_date_host": ["event_date", "host"],
    "by_date_host_url_browser": ["event_date", "host", "url", "browser_family"],
    "by_host_url_browser_os_date": ["host", "url", "browser_family", "os_family", "event_date"],
}
LAYOUT_COLUMNS = ["event_date", "host", "url", "referrer", "browser_family", "os_family"]
ROWS_PER_FILE = 4_000_000


def _layout_runs_sql(name: str, keys: list[str]) -> str:
    """Runs of equal values over all columns of a layout, in its order."""
    runs = " + ".join(f"sum(CASE WHEN {c} IS DISTINCT FROM p_{c} OR k = 1 THEN 1 ELSE 0 END)" for c in LAYOUT_COLUMNS)
    lags = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in LAYOUT_COLUMNS)
    order = ", ".join(f"{k} NULLS FIRST" for k in keys)
    return f"""SELECT '{name}' AS layout, count(*) AS rows_written, count(DISTINCT event_date) AS days, {runs} AS runs
FROM (SELECT *, row_number() OVER w AS k, {lags} FROM joined WINDOW w AS (ORDER BY {order}, event_id))"""


@register(
    "layout_file_sizes",
    O.with_(O.DEVICES)
    + """, joined AS (
    SELECT e.event_id, (e.event_id * 7919) % 100003 AS scramble, CAST(e.event_time AS DATE) AS event_date, e.host, e.url, e.referrer,
           d.browser_type AS browser_family, d.os_type AS os_family
    FROM web_events e LEFT JOIN devices d ON d.device_id = e.device_id
),
measured AS (
"""
    + "\nUNION ALL\n".join(_layout_runs_sql(name, keys) for name, keys in LAYOUTS.items())
    + """
)
SELECT layout, rows_written, days, CAST(row_number() OVER (ORDER BY runs) AS INTEGER) AS size_rank FROM measured""",
    ids=("C27", "O03", "O04", "O05", "O06", "S23", "J03", "U02", "P14"),
)
def layout_file_sizes(spark, sf_dir):
    """Writes events JOIN devices in several orders and ranks the layouts by
    the bytes of their files. A layout is range-partitioned by its sort keys
    (a day is in few files, a hot day in as many as it needs) and sorted
    within. The fewer runs of equal values its columns have, the smaller it
    should be; the oracle ranks by runs. ``layout_sizes`` has the bytes."""
    sizes = layout_sizes(spark, sf_dir)
    by_size = Window.orderBy("total_bytes", "layout")  # one row a layout
    return sizes.select("layout", "rows_written", "days", F.row_number().over(by_size).alias("size_rank"))


def layout_sizes(spark, sf_dir):
    """layout, rows_written, days, total_bytes, num_files."""
    out = None
    for name, df in written_layouts(spark, sf_dir):
        rows = df.agg(F.count(F.lit(1)).alias("rows_written"), F.count_distinct("event_date").alias("days"))
        both = rows.unionByName(file_stats(df), allowMissingColumns=True)  # two one-row frames become one row
        got = both.agg(*[F.max(c).alias(c) for c in both.columns]).select(F.lit(name).alias("layout"), *both.columns)
        out = got if out is None else out.unionByName(got)
    return cut_lineage(out, "layout_sizes")  # a row a layout


def written_layouts(spark, sf_dir):
    ev = standins.web_events(spark, sf_dir)
    joined = ev.join(standins.devices(spark, sf_dir), on="device_id", how="left").withColumnsRenamed(
        {"browser_type": "browser_family", "os_type": "os_family"}
    )
    joined = joined.withColumn("event_date", F.to_date("event_time")).withColumn("scramble", F.col("event_id") * 7919 % 100003)
    # every layout reads it: joined and written once
    df = cut_lineage(joined.select("event_id", "scramble", *LAYOUT_COLUMNS), "layout_input")
    files = -(-df.count() // ROWS_PER_FILE) or 1
    for name, keys in LAYOUTS.items():
        sort = [*keys, "event_id"]
        yield name, cut_lineage(df.repartitionByRange(files, *sort).sortWithinPartitions(*sort).select(*LAYOUT_COLUMNS), f"layout_{name}")


@register(
    "players_key_check",
    "WITH " + O.PLAYERS_DENSE + """
SELECT player_id, current_season, 'duplicate_key' AS problem FROM players WHERE player_id % 7 = 0
UNION ALL
SELECT player_id, current_season, 'scoring_class_domain' FROM players WHERE player_id % 11 = 0
UNION ALL
SELECT player_id, current_season, 'scoring_class_domain' FROM players WHERE player_id % 77 = 0""",
    ids=("V1", "P12"),
)
def players_key_check(spark, sf_dir):
    """The key and domain checks on a table with derived defects: players
    whose id 7 divides are loaded twice, those 11 divides without a class."""
    from cairn.operators.quality import domain_violations, key_violations

    seasons, last = _players(spark, sf_dir)
    p = cumulative.players_backfill(seasons, last).select("player_id", "current_season", "scoring_class")
    p = p.withColumn("scoring_class", F.when(F.col("player_id") % 11 != 0, F.col("scoring_class")))
    p = cut_lineage(p.unionByName(p.where(F.col("player_id") % 7 == 0)), "defective_players")
    keys = ["player_id", "current_season"]
    return key_violations(p, keys).unionByName(domain_violations(p, keys, "scoring_class", SCORING_DOMAIN))


@register(
    "actors_scd_overlap_check",
    "WITH history AS (WITH " + O.ACTORS_DENSE + ACTORS_SCD_NO_STREAK + """),
later AS (
    SELECT *, CASE WHEN actorid % 5 = 0 THEN -1 WHEN actorid % 3 = 0 THEN 1 ELSE 0 END AS shift FROM history
    WHERE start_year > (SELECT min(start_year) FROM history f WHERE f.actorid = history.actorid)
)
SELECT actorid, CAST(start_year + shift AS INTEGER) AS start_year, end_year, CAST(start_year - 1 AS INTEGER) AS prev_end,
       if(shift < 0, 'overlap', 'gap') AS problem
FROM later WHERE shift <> 0""",
    ids=("V2",),
)
def actors_scd_overlap_check(spark, sf_dir):
    """The overlap check on a history with derived defects: the records of
    actors whose id 5 divides start a year early, those 3 divides a year late."""
    films, last = _actors(spark, sf_dir)
    history = scd.scd_backfill(cumulative.actors_history(films, last), "actorid", "current_year",
                               ["quality_class", "is_active"], as_of=last, start_name="start_year", end_name="end_year")
    shift = F.when(F.col("actorid") % 5 == 0, -1).when(F.col("actorid") % 3 == 0, 1).otherwise(0)
    shifted = history.withColumn("start_year", (F.col("start_year") + shift).cast("int"))
    return scd.scd_overlaps(shifted, "actorid", "start_year", "end_year")
