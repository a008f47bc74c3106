"""Reference roles mapped onto the driver's tables.

The reference works on basketball seasons, films, web events and game
matches. The driver's data is a TPC-H-like star schema plus an ``events``
log, so every role is derived from those tables by a fixed rule. The same
rules are spelled out in SQL in ``cairn.plans.oracle_sql`` for the DuckDB check.

Rules (all exact in both engines: integer-valued sums, IEEE divisions):

* player_seasons: player = ``o_custkey``, season = ``year(o_orderdate)``,
  gp = orders in the year, pts = average of ``floor(o_totalprice / 16000)``.
* actor_films: actor = ``l_partkey`` (name ``actor-<partkey>``), film = line item,
  year = ``year(l_shipdate)``, votes = quantity, rating = ``round(100*discount)``.
* game_details: game = ``l_orderkey``, player = ``l_suppkey``, team = the
  supplier's nation, pts = ``l_quantity``, start_position = ``l_returnflag``.
* web events: user = ``user_id``, url = ``'/' || event_type``, device =
  ``props.k``, host and ip from ``user_id``, referrer from ``props.k``.
* devices: one row per device id seen in events, attributes by rule.
* matches: match = order (playlist = priority, map = ``o_custkey % 25``),
  match_details = line items, medals = parts (medal name = ``p_type``).
* ip_locations: one /8-aligned block of 8 first octets per nation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources.tables import read_table

# Fixed values of the stand-in rules (invented for this data set).
HOSTS = ("www.shop.example", "blog.shop.example", "docs.shop.example")
REFERRERS = (
    "https://www.linkedin.com/feed/",
    "https://lnkd.in/a1",
    "https://www.google.com/search",
    "https://t.co/x9",
    "https://news.example.org/",
    None,
)
BROWSERS = ("Chrome", "Firefox", "Safari", "Edge")
OSES = ("Windows", "Mac OS X", "Linux", "iOS", "Android")
DEVICE_TYPES = ("Desktop", "Mobile", "Tablet")
PTS_DIVISOR = 16000.0
MAP_COUNT = 25
IP_BLOCKS_PER_NATION = 8


def pick(values, index: Column) -> Column:
    """``CASE index WHEN 0 THEN v0 WHEN 1 THEN v1 ... END`` over a fixed list."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    return (
        o.where(F.col("o_custkey").isNotNull())
        .groupBy(
            F.col("o_custkey").alias("player_id"),
            F.year("o_orderdate").alias("season"),
        )
        .agg(
            F.count(F.lit(1)).alias("gp"),
            F.sum(F.floor(F.col("o_totalprice") / F.lit(PTS_DIVISOR))).alias("_pts_sum"),
        )
        .select(
            "player_id",
            "season",
            "gp",
            (F.col("_pts_sum").cast("double") / F.col("gp").cast("double")).alias("pts"),
        )
    )


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(
        spark,
        sf_dir,
        "lineitem",
        ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_shipdate"],
    )
    return li.select(
        F.col("l_partkey").alias("actorid"),
        F.concat(F.lit("actor-"), F.col("l_partkey").cast("string")).alias("actor"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("film"),
        F.col("l_quantity").cast("int").alias("votes"),
        F.round(F.col("l_discount") * 100).cast("int").alias("rating"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("filmid"),
        F.year("l_shipdate").alias("year"),
    )


def game_detail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item part of game details (no supplier columns yet)."""
    li = read_table(
        spark,
        sf_dir,
        "lineitem",
        [
            "l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate",
        ],
    )
    return li.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("player_id"),
        F.col("l_returnflag").alias("start_position"),
        F.col("l_quantity").alias("pts"),
        F.to_date("l_shipdate").alias("game_date"),
        # total order for dedup among rows of one (player, game)
        "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
    )


def attach_players(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player name and team (the supplier's nation) for each detail row."""
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    joined = lines.join(s, lines.player_id == s.s_suppkey, "inner")
    return joined.select(
        "game_id",
        F.col("s_nationkey").alias("team_id"),
        F.concat(F.lit("T"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("team_abbreviation"),
        "player_id",
        F.col("s_name").alias("player_name"),
        *[c for c in lines.columns if c not in ("game_id", "player_id")],
    )


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach_players(game_detail_lines(spark, sf_dir), spark, sf_dir)


DEDUP_ORDER = (
    "l_linenumber", "l_partkey", "pts", "l_extendedprice", "l_discount", "l_tax",
    "start_position", "l_linestatus", "game_date",
)


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    # parse the JSON once; the derived columns below read the parsed value
    parsed = e.select("*", F.get_json_object("props", "$.k").cast("int").alias("_k"))
    k = F.col("_k")
    uid = F.col("user_id")
    octets = [
        (uid * 7) % 223 + 1,
        (uid * 13) % 256,
        (uid * 17) % 256,
        uid % 256,
    ]
    return parsed.select(
        "event_id",
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        pick(REFERRERS, k % len(REFERRERS)).alias("referrer"),
        uid.alias("user_id"),
        k.cast("long").alias("device_id"),
        pick(HOSTS, uid % len(HOSTS)).alias("host"),
        F.concat_ws(".", *[o.cast("string") for o in octets]).alias("ip"),
        F.col("ts").alias("event_time"),
        "event_type",
        "value",
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device dimension: every device id seen in events, attributes by rule.

    Some attributes are NULL on purpose (``unknown`` handling downstream).
    """
    ids = web_events(spark, sf_dir).select("device_id").where(F.col("device_id").isNotNull()).distinct()
    d = F.col("device_id")
    return ids.select(
        "device_id",
        F.when(d % 13 == 0, F.lit(None).cast("string")).otherwise(pick(BROWSERS, d % len(BROWSERS))).alias("browser_type"),
        pick(OSES, d % len(OSES)).alias("os_type"),
        F.when(d % 17 == 0, F.lit(None).cast("string")).otherwise(pick(DEVICE_TYPES, d % len(DEVICE_TYPES))).alias("device_type"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier, so a team (nation) appears several times."""
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return joined.select(
        F.col("n_nationkey").alias("team_id"),
        F.concat(F.lit("T"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("abbreviation"),
        F.col("n_name").alias("nickname"),
        F.col("r_name").alias("city"),
        F.col("s_name").alias("arena"),
        (F.lit(1900) + F.col("n_nationkey")).cast("long").alias("yearfounded"),
        F.col("s_suppkey").alias("source_rank"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"])
    return o.select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_team_game"),
        F.col("o_orderpriority").alias("playlist_id"),
        (F.col("o_custkey") % MAP_COUNT).cast("int").alias("mapid"),
        F.to_date("o_orderdate").alias("completion_date"),
    )


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_quantity", "l_tax"])
    return li.select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("gamer-"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
        F.col("l_quantity").cast("int").alias("player_total_kills"),
        F.round(F.col("l_tax") * 100).cast("int").alias("player_total_deaths"),
    )


def medals_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_partkey"])
    return li.select(
        F.col("l_orderkey").alias("match_id"),
        F.concat(F.lit("gamer-"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
        F.col("l_partkey").alias("medal_id"),
        F.lit(1).cast("int").alias("count"),
    )


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    return p.select(F.col("p_partkey").alias("medal_id"), F.col("p_type").alias("name"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return n.select(F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("name"))


def ip_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    block = F.lit(1 << 24).cast("long")
    first = F.col("n_nationkey").cast("long") * IP_BLOCKS_PER_NATION + 1
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        (first * block).alias("start_ip"),
        ((first + IP_BLOCKS_PER_NATION) * block - 1).alias("end_ip"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("state"),
        F.concat(F.col("n_name"), F.lit(" city")).alias("city"),
    )
