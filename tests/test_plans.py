"""Physical-plan checks: the strategies the operators promise."""

import pytest
from pyspark.sql import functions as F

from cairn.operators import cumulative, enrich, joins, scd
from cairn.plans import standins


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_has_no_exchange(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        m, d = joins.bucketed_pair(
            spark,
            standins.matches(spark, sf_small).select("match_id", "playlist_id"),
            standins.match_details(spark, sf_small).select("match_id", "player_total_kills"),
            "match_id",
            buckets=16,
        )
        joined = d.join(m, "match_id").groupBy("match_id").agg(F.sum("player_total_kills"))
        p = plan(joined)
        assert "SortMergeJoin" in p
        assert "Exchange" not in p
        plain = standins.match_details(spark, sf_small).join(standins.matches(spark, sf_small), "match_id")
        assert plan(plain).count("Exchange") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_broadcast_only_behind_row_check(spark, sf_small):
    maps = standins.maps(spark, sf_small)
    small, ok = joins.broadcast_if_small(maps, max_rows=100)
    assert ok
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = standins.matches(spark, sf_small).join(small, "mapid")
        assert "BroadcastHashJoin" in plan(j)
        big, ok2 = joins.broadcast_if_small(standins.match_details(spark, sf_small), max_rows=100)
        assert not ok2
        assert "BroadcastHashJoin" not in plan(standins.matches(spark, sf_small).join(big, "match_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.fixture(params=["10485760", "-1"])
def threshold(spark, request):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(names[0], "10485760")
    spark.conf.unset(names[1])


def test_ip_enrichment_is_an_equi_join_on_both_sides_of_the_threshold(spark, sf_small, threshold):
    ev = standins.web_events(spark, sf_small)
    out = enrich.enrich_ip(ev, standins.ip_locations(spark, sf_small))
    p = plan(out)
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert ("BroadcastHashJoin" in p) == (threshold != "-1")
    assert out.count() == ev.count()
    assert out.where("geodata != '{}'").count() > 0


def test_measured_side_is_broadcast_below_the_threshold(spark, sf_small, threshold):
    """Nothing is known when the plan is made; the final plan follows the
    threshold."""
    details = standins.match_details(spark, sf_small).select("match_id", "player_gamertag", "player_total_kills")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the planner's own estimate stays out of it
    out = joins.totals_above(details, "match_id", "player_total_kills", 300)
    assert "SortMergeJoin" in plan(out)
    rows = out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ("BroadcastHashJoin" in final) == (threshold != "-1")
    assert rows and all(r.total >= 300 for r in rows)


def test_scd_backfill_shuffles_once(spark, sf_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        seasons = spark.read.parquet(f"{sf_small}/orders.parquet").select(
            F.col("o_custkey").alias("player_id"), F.year("o_orderdate").alias("current_season"),
            F.col("o_orderstatus").alias("scoring_class"),
        )
        out = scd.scd_backfill(seasons, "player_id", "current_season", ["scoring_class"], as_of=2001)
        assert plan(out).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_prunes_columns_and_pushes_filters(spark, sf_small):
    seasons = standins.player_seasons(spark, sf_small)
    p = plan(cumulative.players_backfill(seasons, 2000).where(F.col("current_season") == 2000))
    import re

    needed = {"o_custkey:bigint", "o_orderdate:timestamp_ntz", "o_totalprice:double"}
    schemas = [set(s.split(",")) for s in re.findall(r"ReadSchema: struct<([^>]*)>", p)]
    assert schemas and all(s <= needed for s in schemas)  # every scan pruned
    assert set().union(*schemas) == needed
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    assert any("IsNotNull(o_custkey)" in f for f in pushed)


def test_broadcast_check_bounds_bytes_too(spark):
    wide = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 10_000).alias("payload"))
    _, ok_rows_only = joins.broadcast_if_small(wide, max_rows=1000, max_bytes=None)
    _, ok_bytes = joins.broadcast_if_small(wide, max_rows=1000, max_bytes=100_000)
    assert ok_rows_only and not ok_bytes


def test_funnel_has_one_equi_join_and_no_self_join(spark, sf_small):
    from cairn.operators import funnel

    ev = standins.web_events(spark, sf_small)
    p = plan(funnel.funnel_conversion(ev, "/purchase"))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    joins_found = [line for line in p.splitlines() if "HashJoin" in line or "SortMergeJoin" in line]
    assert len(joins_found) == 1
    assert "user_id" in joins_found[0] and "event_date" in joins_found[0]


def test_kafka_options():
    from cairn.streaming.sources import kafka_options

    plain = kafka_options("broker:9092", "events")
    assert plain["subscribe"] == "events" and plain["startingOffsets"] == "latest"
    secured = kafka_options("broker:9092", "events", group_id="g", username="u", password="p")
    assert secured["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in secured["kafka.sasl.jaas.config"]


def test_size_check_has_no_single_partition_of_rows(spark, sf_small):
    """Each task sends one row of sums; the rows themselves stay."""
    df = standins.match_details(spark, sf_small)
    p = plan(df.agg(F.count(F.lit(1)), F.sum(joins._row_bytes(df))))
    below = p[p.index("Exchange SinglePartition"):]
    assert "partial_count" in below.splitlines()[1] or "partial_count" in below
    assert "Limit" not in p
    wide = spark.createDataFrame([("x" * 1000, [1] * 10)] * 50, "s string, a array<int>")
    assert joins.has_at_most(wide, 50, 80_000) and not joins.has_at_most(wide, 50, 50_000)
    assert not joins.has_at_most(wide, 49)


def test_narrowest_range_wins_and_no_event_multiplies(spark, threshold):
    loc = spark.createDataFrame(
        [(0, 2**32 - 1, "W", None, None), (167772160, 184549375, "TEN", "s", "c"), (167772160, 167772415, None, "n", "n"),
         (167772300, 167772500, "O", "o", "o"), (9, 3, "bad", "b", "b")],
        "start_ip long, end_ip long, country string, state string, city string",
    )
    ev = spark.createDataFrame([(i, ip) for i, ip in enumerate(["10.0.0.5", "10.0.0.150", "10.0.1.0", "10.9.9.9", "8.8.8.8", "x", None])], "event_id long, ip string")
    want = ['{"state":"n","city":"n"}', '{"country":"O","state":"o","city":"o"}', '{"country":"O","state":"o","city":"o"}',
            '{"country":"TEN","state":"s","city":"c"}', '{"country":"W"}', "{}", "{}"]
    out = sorted(enrich.enrich_ip(ev, loc).collect(), key=lambda r: r.event_id)
    assert [r.geodata for r in out] == want


def test_referrers_are_parsed_once(spark, sf_small):
    """The trends read a written column; no rule is left in their plan."""
    from cairn.plans.analytics import referrer_trends

    p = referrer_trends(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in p and "linkedin" not in p


def test_growth_counts_have_no_row_per_idle_day(spark, sf_small):
    from datetime import timedelta

    from cairn.operators import growth

    ev = standins.web_events(spark, sf_small)
    last = ev.agg(F.max(F.to_date("event_time"))).first()[0]
    for end in (last, last - timedelta(days=9)):
        grid = growth.growth_accounting(ev, end, with_dates=False)
        want = {tuple(r) for r in grid.groupBy("date", "daily_active_state").count().collect()}
        assert {tuple(r) for r in growth.daily_state_counts(ev, end).collect()} == want
        n = F.datediff("date", "first_active_date")
        active = F.col("daily_active_state").isin("New", "Retained", "Resurrected")
        want = {tuple(r) for r in grid.groupBy(n.alias("n")).agg(F.avg(active.cast("double")), F.count("*")).collect()}
        got = {tuple(r) for r in growth.retention_curve(ev, end).collect()}
        assert {(a, round(b, 9), c) for a, b, c in got} == {(a, round(b, 9), c) for a, b, c in want}


def test_no_nested_loop_in_the_layout_report(spark, sf_small):
    from cairn.plans.joins import layout_file_sizes

    p = plan(layout_file_sizes(spark, sf_small))
    assert "NestedLoop" not in p and "Cartesian" not in p
