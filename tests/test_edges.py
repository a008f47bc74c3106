"""Edge rows from FIXTURES.md section C."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from cairn.functions import bits
from cairn.functions.arrays import at1, concat_arrays, last
from cairn.functions.banding import QUALITY_BANDS, band
from cairn.operators import datelist, scd
from cairn.streaming import aggregation


def test_band_is_strict_on_boundaries(spark):
    df = spark.createDataFrame([(20.0,), (20.01,), (15.0,), (10.0,), (10.5,), (None,)], "v double")
    got = [r[0] for r in df.select(band(F.col("v"))).collect()]
    assert got == ["good", "star", "average", "bad", "average", "bad"]
    q = spark.createDataFrame([(8.0,), (7.0,), (6.0,), (6.1,)], "v double")
    assert [r[0] for r in q.select(band(F.col("v"), QUALITY_BANDS)).collect()] == ["good", "average", "bad", "average"]


def test_bit_mask_edges(spark):
    anchor = date(2023, 3, 31)
    rows = [(1, [anchor - timedelta(days=d) for d in (0, 6, 7, 13, 14, 31, 32)])]
    cum = spark.createDataFrame(rows, "user_id long, dates_active array<date>")
    masks = datelist.datelist_int(cum, "user_id", anchor)
    value = masks.first().datelist_int
    assert value == sum(1 << (31 - d) for d in (0, 6, 7, 13, 14, 31))  # day 32 is outside
    flags = datelist.activity_flags(masks, "user_id").first()
    assert flags.l32 == 6 and flags.l7 == 2 and flags.weekly_active and flags.weekly_active_previous_week
    assert masks.select(bits.bit_string(F.col("datelist_int"))).first()[0] == format(value, "032b")


def test_array_helpers_null_and_empty(spark):
    df = spark.createDataFrame([(None, [1, 2]), ([], None), ([0, 5], [])], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(concat_arrays(F.col("a"), F.col("b"))).collect()]
    assert got == [[1, 2], [], [0, 5]]
    one = df.select(at1(F.col("a"), 1).alias("f"), last(F.col("a")).alias("l"), at1(F.col("a"), 9).alias("x")).collect()
    assert [(r.f, r.l, r.x) for r in one] == [(None, None, None), (None, None, None), (0, 5, None)]


def test_scd_null_first_row_and_null_change(spark):
    df = spark.createDataFrame(
        [("p", 1, None), ("p", 2, None), ("p", 3, "a"), ("p", 4, None)], "k string, p int, c string"
    )
    out = scd.scd_backfill(df, "k", "p", ["c"], as_of=4).orderBy("start_period").collect()
    assert [(r.c, r.start_period, r.end_period, r.streak_identifier) for r in out] == [
        (None, 1, 2, 1), ("a", 3, 3, 2), (None, 4, 4, 3)
    ]


def test_session_gap_equal_to_gap_merges(spark):
    t0 = datetime(2024, 1, 1, 10, 0, 0)
    five = timedelta(minutes=5)
    us = timedelta(microseconds=1)
    rows = [
        ("a", t0), ("a", t0 + five),                      # exactly the gap: one session
        ("b", t0), ("b", t0 + five + us),                 # 1 us more: two sessions
        ("c", t0), ("c", t0 + five - us),                 # 1 us less: one session
    ]
    df = spark.createDataFrame(rows, "ip string, event_time timestamp").withColumn("host", F.lit("h"))
    s = aggregation.sessions(df, "event_time", ["ip", "host"], "5 minutes", watermark=None)
    counts = {r.ip: r.n for r in s.groupBy("ip").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"a": 1, "b": 2, "c": 1}


def test_tumbling_counts_ignore_null_host(spark):
    t0 = datetime(2024, 1, 1, 10, 0, 0)
    df = spark.createDataFrame(
        [("h", t0), (None, t0 + timedelta(seconds=10)), ("h", t0 + timedelta(minutes=5))],
        "host string, event_time timestamp",
    )
    out = aggregation.tumbling_counts(df, "event_time", [], "5 minutes", watermark=None).orderBy("event_hour").collect()
    assert [(r.event_hour, r.num_hits) for r in out] == [(t0, 1), (t0 + timedelta(minutes=5), 1)]


def test_players_step_three_join_branches_and_zero_guard(spark):
    from cairn.operators import cumulative

    season_t = "struct<season:int,gp:long,pts:double>"
    prev = spark.createDataFrame(
        [
            (1, [(2000, 3, 0.0)], "bad", 0, True, 2000),   # yesterday only: first pts 0
            (2, [(2000, 2, 12.0)], "average", 0, True, 2000),  # in both
        ],
        f"player_id long, seasons array<{season_t}>, scoring_class string, years_since_last_active int, "
        "is_active boolean, current_season int",
    )
    seasons = spark.createDataFrame(
        [(2, 2001, 4, 21.0), (3, 2001, 1, 15.0)], "player_id long, season int, gp long, pts double"
    )  # 3: today only; 15.0 sits on a boundary
    out = {r.player_id: r for r in cumulative.players_step(prev, seasons, 2001).collect()}
    assert (out[1].is_active, out[1].scoring_class, out[1].years_since_last_active, len(out[1].seasons)) == (False, "bad", 1, 1)
    assert (out[2].is_active, out[2].scoring_class, len(out[2].seasons)) == (True, "star", 2)
    assert (out[3].is_active, out[3].scoring_class, len(out[3].seasons)) == (True, "average", 1)
    assert {r.current_season for r in out.values()} == {2001}
    # first-to-last ratio with the zero guard: first pts 0 divides by 1
    first = F.try_element_at("seasons", F.lit(1))["pts"]
    latest = F.try_element_at("seasons", F.lit(-1))["pts"]
    ratio = cumulative.players_step(prev, seasons, 2001).select(
        "player_id", (latest / F.when(first == 0, F.lit(1.0)).otherwise(first)).alias("r")
    )
    got = {r.player_id: r.r for r in ratio.collect()}
    assert got == {1: 0.0, 2: 21.0 / 12.0, 3: 1.0}


def test_json_object_keeps_nulls_and_map_casts(spark):
    from cairn.functions.structs import json_object, string_map

    df = spark.createDataFrame([("G", None, 23.0, 7)], "pos string, abbr string, pts double, team long")
    row = df.select(
        json_object(start_position=F.col("pos"), team_abbreviation=F.col("abbr"), pts=F.col("pts"), team_id=F.col("team")).alias("j"),
        string_map(pts=F.col("pts"), team_id=F.col("team")).alias("m"),
    ).first()
    assert row.j == '{"start_position":"G","team_abbreviation":null,"pts":23.0,"team_id":7}'
    assert row.m == {"pts": "23.0", "team_id": "7"}


def test_render_helpers(spark):
    from datetime import date

    from cairn.functions.arrays import render, render_dates

    df = spark.createDataFrame([([1, None, 3], [date(2024, 1, 3), date(2024, 1, 1)])], "a array<long>, d array<date>")
    r = df.select(render(F.col("a")).alias("a"), render_dates(F.col("d")).alias("d")).first()
    assert r.a == "1,null,3" and r.d == "2024-01-01,2024-01-03"


def test_quality_checks_flag_problems(spark):
    from cairn.functions.banding import SCORING_DOMAIN
    from cairn.operators.quality import array_length_histogram, domain_violations, key_violations

    df = spark.createDataFrame(
        [(1, 2000, "good", [1]), (1, 2000, "good", [1, 2]), (2, 2000, "legend", []), (3, 2000, None, [5])],
        "player_id long, current_season int, scoring_class string, a array<long>",
    )
    keys = ["player_id", "current_season"]
    assert [tuple(r) for r in key_violations(df, keys).collect()] == [(1, 2000, "duplicate_key")]
    bad = sorted(r.player_id for r in domain_violations(df, keys, "scoring_class", SCORING_DOMAIN).collect())
    assert bad == [2, 3]
    hist = {r.cardinality: r.rows for r in array_length_histogram(df, "a").collect()}
    assert hist == {1: 2, 2: 1, 0: 1}


def test_scd_overlap_check_flags_overlap_and_gap(spark):
    df = spark.createDataFrame(
        [(1, 2000, 2002), (1, 2002, 2003), (2, 2000, 2000), (2, 2003, 2004), (3, 2000, 2001), (3, 2002, 2002)],
        "k long, start_period int, end_period int",
    )
    got = {(r.k, r.problem) for r in scd.scd_overlaps(df, "k", "start_period", "end_period").collect()}
    assert got == {(1, "overlap"), (2, "gap")}
