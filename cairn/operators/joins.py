"""Join strategies: size-checked broadcast, bucketed (co-located) joins, the
match star join, and shared intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.session import cut_lineage, scratch_path
from cairn.sources.catalog import write_bucketed

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Bytes of a row once it is in memory, from above: 8 a column and 32 a
    row, strings and binaries by their length, nested values by three times
    their JSON text."""
    size = F.lit(32 + 8 * len(df.columns))
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary", "char", "varchar"):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind in ("struct", "array", "map"):
            size = size + 3 * F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return size


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and (if given) at most
    ``max_bytes`` in memory. One partial aggregation: a row per task reaches
    the final sum, however large the input."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return stats["n"] <= max_rows and (max_bytes is None or (stats["b"] or 0) <= max_bytes)


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast hint only behind a proven bound on rows and bytes; otherwise
    the plain frame (shuffle join, or AQE's runtime conversion when it turns
    out small). The side is written first, so check and join read the result
    and not its plan."""
    df = cut_lineage(df, "broadcast_side")
    if has_at_most(df, max_rows, max_bytes):
        return F.broadcast(df), True
    return df, False


def totals_above(details: DataFrame, key: str, value: str, least: int) -> DataFrame:
    """Rows of ``details`` whose key has a total of ``least`` or more, with
    that total. Nobody knows the size of the totals before they are there:
    the plan shuffles both sides, and adaptive execution broadcasts the totals
    instead when they turn out smaller than the session's
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``. No hint, no count."""
    totals = details.groupBy(key).agg(F.sum(value).alias("total")).where(F.col("total") >= least)
    return details.join(totals, key)


def bucketed_pair(
    spark: SparkSession,
    left: DataFrame,
    right: DataFrame,
    key: str,
    buckets: int | None = None,
    name: str = "bucketed",
) -> tuple[DataFrame, DataFrame]:
    """Write both sides bucketed (and sorted) on ``key`` with the same bucket
    count (by default the session's shuffle partitions, which follow the
    input on a cluster) into the shared folder, and return the two tables. A
    join or aggregation on ``key`` between them then plans without an Exchange."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tag = f"{name}_{uuid.uuid4().hex[:8]}"
    tables = []
    for side, df in (("l", left), ("r", right)):
        table = f"{tag}_{side}"
        write_bucketed(df, table, buckets, key, path=scratch_path(spark, table))
        tables.append(spark.table(table))
    return tables[0], tables[1]


def match_answers(details: DataFrame, matches: DataFrame, medals_mp: DataFrame, medals: DataFrame,
                  maps: DataFrame, medal_name: str, max_dim_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The four match questions, each the top answer (ties by name):

    * player with the highest average kills per game,
    * playlist played most, map played most (matches counted once),
    * map with the most ``medal_name`` medals.

    Each fact is reduced to match level before any join, so the star join
    never fans out player rows against medal rows; the small dimensions
    (medals, maps) are broadcast behind a row-count check.
    """
    per_player = details.groupBy("player_gamertag").agg(
        (F.sum("player_total_kills").cast("double") / F.count_distinct("match_id")).alias("metric")
    )
    # three questions read the distinct matches: written once
    m = cut_lineage(matches.select("match_id", "playlist_id", "mapid").distinct(), "matches")
    playlists = m.groupBy("playlist_id").agg(F.count(F.lit(1)).cast("double").alias("metric"))
    maps_b, _ = broadcast_if_small(maps, max_dim_rows)
    map_plays = m.groupBy("mapid").agg(F.count(F.lit(1)).cast("double").alias("metric")).join(maps_b, "mapid")
    medals_b, _ = broadcast_if_small(medals.where(F.col("name") == medal_name).select("medal_id"), max_dim_rows)
    medal_counts = (
        medals_mp.join(medals_b, "medal_id")
        .groupBy("match_id")
        .agg(F.sum("count").alias("n"))
        .join(m, "match_id")
        .groupBy("mapid")
        .agg(F.sum("n").cast("double").alias("metric"))
        .join(maps_b, "mapid")
    )

    def top(df, question, answer):
        # top-1 is the feature: a global TakeOrderedAndProject, ties by name
        return (
            df.select(F.col(answer).cast("string").alias("answer"), "metric")
            .orderBy(F.desc("metric"), F.asc("answer"))
            .limit(1)
            .select(F.lit(question).alias("question"), "answer", "metric")
        )

    return (
        top(per_player, "most_kills_per_game", "player_gamertag")
        .unionByName(top(playlists, "most_played_playlist", "playlist_id"))
        .unionByName(top(map_plays, "most_played_map", "name"))
        .unionByName(top(medal_counts, f"most_{medal_name.lower()}_medals_map", "name"))
    )


def match_star_join(details: DataFrame, matches: DataFrame, medals_mp: DataFrame, medals: DataFrame,
                    maps: DataFrame, max_dim_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The literal homework join: details JOIN matches JOIN medal rows on
    (match, player), plus broadcast medals and maps. Use ``match_answers``
    for aggregates; this frame has one row per player-medal in a match."""
    medals_b, _ = broadcast_if_small(medals, max_dim_rows)
    maps_b, _ = broadcast_if_small(maps.withColumnRenamed("name", "map_name"), max_dim_rows)
    return (
        details.join(matches, "match_id")
        .join(medals_mp, ["match_id", "player_gamertag"], "left")
        .join(medals_b.withColumnRenamed("name", "medal_name"), "medal_id", "left")
        .join(maps_b, "mapid", "left")
    )


def user_device_aggregate(events: DataFrame) -> DataFrame:
    """(user, device) rows with event counts and the sorted distinct hosts;
    the shared intermediate that both rollups below read (cache it with
    ``cairn.sources.catalog.persisted`` when both are computed)."""
    return (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id", "device_id")
        .agg(F.count(F.lit(1)).alias("event_counts"), F.array_sort(F.collect_set("host")).alias("host_array"))
    )


def users_with_devices(agg: DataFrame) -> DataFrame:
    """Per user: the largest per-device hit count and the device list (one
    entry per device the user used, so bounded by the device count)."""
    return agg.groupBy("user_id").agg(
        F.max("event_counts").alias("total_hits"),
        F.array_sort(F.collect_list("device_id")).alias("devices"),
    )


def devices_with_users(agg: DataFrame, devices: DataFrame) -> DataFrame:
    """Per device: how many users used it. The reference collects the user
    list; that list grows with the user base (a popular device would hold a
    large share of all users in one row), so the (device, user) pairs stay
    as rows in ``agg`` and the rollup keeps the count."""
    return devices.select("device_id", "device_type").join(agg, "device_id").groupBy("device_id", "device_type").agg(
        F.count(F.lit(1)).alias("num_users"), F.sum("event_counts").alias("events")
    )


def events_with_devices(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Typed events JOIN devices (reference Dataset notebook), as column
    expressions: non-null ids only, upper-case browser, 'unknown' referrer."""
    e = events.where(F.col("user_id").isNotNull() & F.col("device_id").isNotNull())
    return e.join(devices, "device_id", "inner").select(
        "user_id",
        "device_id",
        F.upper("browser_type").alias("browser_type"),
        "os_type",
        "device_type",
        F.coalesce("referrer", F.lit("unknown")).alias("referrer"),
        "host",
        "url",
        "event_time",
    )
