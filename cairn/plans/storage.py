"""Registered queries about storage: text files read back in three ways,
partitioned tables loaded by position, a stored dashboard."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from cairn.operators import joins, windows
from cairn.plans import oracle_sql as O
from cairn.plans import standins
from cairn.plans.analytics import DASHBOARD_SQL
from cairn.plans.registry import register
from cairn.session import cut_lineage, scratch_path
from cairn.sources import catalog, files
from cairn.sources.catalog import persisted
from cairn.sources.tables import read_table


@register(
    "customers_from_csv",
    """SELECT reading, count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys, CAST(sum(c_nationkey) AS BIGINT) AS nations,
       count(DISTINCT c_mktsegment) AS segments
FROM customer, (VALUES ('inferred'), ('strings'), ('positions')) AS r(reading) GROUP BY reading""",
    ids=("S01", "S02", "S03", "U02"),
)
def customers_from_csv(spark, sf_dir):
    """The customers written as text with and without a header, read with
    inferred types, as strings that are then cast, and by position."""
    cols = ["c_custkey", "c_nationkey", "c_mktsegment"]
    src = read_table(spark, sf_dir, "customer", cols)
    tag = uuid.uuid4().hex
    headed, bare = scratch_path(spark, f"csv_headed_{tag}"), scratch_path(spark, f"csv_bare_{tag}")
    src.write.option("header", "true").csv(headed)
    src.write.csv(bare)
    types = {"c_custkey": "long", "c_nationkey": "long"}
    readings = {
        "inferred": files.read_csv(spark, headed, infer_schema=True),
        "strings": files.try_cast_columns(files.read_csv(spark, headed), types),
        "positions": files.try_cast_columns(files.read_csv(spark, bare, header=False, columns=cols), types),
    }
    out = None
    for name, df in readings.items():
        got = df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("c_custkey").cast("long")).alias("keys"),
            F.sum(F.col("c_nationkey").cast("long")).alias("nations"),
            F.count_distinct("c_mktsegment").alias("segments"),
        ).select(F.lit(name).alias("reading"), "*")
        out = got if out is None else out.unionByName(got)
    return out


@register(
    "orders_by_year_table",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS ds,
       count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers
FROM orders GROUP BY 1, 2""",
    ids=("S05", "S14", "S19", "S20", "S21"),
)
def orders_by_year_table(spark, sf_dir):
    """A table partitioned by the year of a date and by a text, made empty,
    then loaded by position twice (a re-run replaces its partitions)."""
    day = F.col("o_orderdate").cast("date")
    src = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select(
        F.date_format(day, "yyyy-MM").alias("ds"), F.year(day).alias("order_year"), "o_custkey", "o_orderkey"
    )
    catalog.ensure_database(spark, "cairn_orders")
    table = f"cairn_orders.by_year_{uuid.uuid4().hex}"
    empty = files.empty_table(spark, src.select("o_orderkey", "o_custkey", "order_year", "ds").schema)
    catalog.overwrite_table(empty, table, ["order_year", "ds"])
    for _ in range(2):
        catalog.insert_partition(src, table)
    stored = cut_lineage(
        spark.table(table).groupBy("order_year", "ds").agg(
            F.count(F.lit(1)).alias("orders"), F.sum("o_custkey").cast("long").alias("customers")
        ),
        "orders_by_year",
    )
    catalog.drop_table(spark, table)
    return stored


@register("device_hits_table", DASHBOARD_SQL + "\nORDER BY number_of_hits DESC, aggregation_level, os_type, device_type, browser_type",
          ids=("S17", "O02", "S04", "C23"))
def device_hits_table(spark, sf_dir):
    """The dashboard stored as a table and read in the order of its hits."""
    aug = windows.with_devices(standins.web_events(spark, sf_dir), standins.devices(spark, sf_dir))
    table = f"device_hits_{uuid.uuid4().hex}"
    catalog.overwrite_table(windows.device_hits_dashboard(aug), table)
    stored = cut_lineage(spark.table(table), "device_hits")
    catalog.drop_table(spark, table)
    return stored.orderBy(F.desc("number_of_hits"), "aggregation_level", "os_type", "device_type", "browser_type")


@register(
    "first_film_year",
    "SELECT CAST(min(year(l_shipdate)) AS INTEGER) AS first_year, CAST(max(year(l_shipdate)) AS INTEGER) AS last_year FROM lineitem",
    ids=("A12",),
)
def first_film_year(spark, sf_dir):
    """The first and the last period a load has to cover."""
    films = standins.actor_films(spark, sf_dir)
    return films.agg(F.min("year").cast("int").alias("first_year"), F.max("year").cast("int").alias("last_year"))


@register(
    "bucketed_details_since",
    """SELECT l.l_orderkey AS match_id, 'gamer-' || CAST(l.l_suppkey AS VARCHAR) AS player_gamertag,
       o.o_orderpriority AS playlist_id, CAST(o.o_orderdate AS DATE) AS completion_date
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey AND CAST(o.o_orderdate AS DATE) = DATE '1996-01-02'""",
    ids=("J11", "J12", "J03"),
)
def bucketed_details_since(spark, sf_dir):
    """LEFT join of two bucketed tables with a date in its condition: all
    details, and the match where it ended on the day. Merge join without an
    exchange, whatever the sizes."""
    matches, details = joins.bucketed_pair(
        spark,
        standins.matches(spark, sf_dir).select("match_id", F.col("completion_date").cast("date").alias("completion_date"), "playlist_id"),
        standins.match_details(spark, sf_dir).select("match_id", "player_gamertag"),
        "match_id",
        name="matches_on",
    )
    m = matches.hint("merge")
    day = F.lit("1996-01-02").cast("date")
    return details.join(m, (details["match_id"] == m["match_id"]) & (m["completion_date"] == day), "left").select(
        details["match_id"], "player_gamertag", "playlist_id", "completion_date"
    )


USER_DEVICE_SQL = (
    O.with_(O.DEVICES)
    + """, agg AS (
    SELECT user_id, device_id, count(*) AS n, string_agg(DISTINCT host, ',' ORDER BY host) AS hosts
    FROM web_events WHERE user_id IS NOT NULL GROUP BY ALL
)
SELECT 'user' AS level, user_id AS id, max(n) AS hits, count(*) AS others, max(hosts) AS hosts FROM agg GROUP BY user_id
UNION ALL
SELECT 'device', a.device_id, CAST(sum(n) AS BIGINT), count(*), max(hosts) FROM agg a JOIN devices USING (device_id) GROUP BY a.device_id"""
)


@register("user_device_shared", USER_DEVICE_SQL, ids=("C25", "A06"))
def user_device_shared(spark, sf_dir):
    """One aggregate with its distinct hosts, computed once and read by both
    rollups (written, so that it outlives its executors)."""
    return _user_device_rollups(spark, sf_dir, cut_lineage(_user_devices(spark, sf_dir), "user_device"))


@register("user_device_cached", USER_DEVICE_SQL, ids=("C25", "S24"))
def user_device_cached(spark, sf_dir):
    """The same two rollups from a cached intermediate, which is given back
    once the result is written. A lost block is computed again."""
    with persisted(_user_devices(spark, sf_dir), StorageLevel.MEMORY_AND_DISK) as agg:
        return cut_lineage(_user_device_rollups(spark, sf_dir, agg), "user_device_cached")


def _user_devices(spark, sf_dir):
    agg = joins.user_device_aggregate(standins.web_events(spark, sf_dir))
    return agg.withColumn("hosts", F.array_join("host_array", ","))


def _user_device_rollups(spark, sf_dir, agg):
    users = agg.groupBy(F.lit("user").alias("level"), F.col("user_id").alias("id")).agg(
        F.max("event_counts").alias("hits"), F.count(F.lit(1)).alias("others"), F.max("hosts").alias("hosts")
    )
    known = agg.join(standins.devices(spark, sf_dir).select("device_id"), "device_id")
    devices = known.groupBy(F.lit("device").alias("level"), F.col("device_id").alias("id")).agg(
        F.sum("event_counts").alias("hits"), F.count(F.lit(1)).alias("others"), F.max("hosts").alias("hosts")
    )
    return users.unionByName(devices)
