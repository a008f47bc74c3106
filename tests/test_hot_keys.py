"""Hot keys: one key holding most rows must give the same answers when its
sequence is split over many partitions (prefix sums with block offsets),
and dedup of a huge duplicate group must keep exactly one row."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.operators import graph, sequences


def _brute_stretch(flags, length):
    best = 0
    for i in range(len(flags)):
        best = max(best, sum(flags[max(0, i - length + 1): i + 1]))
    return best


def _brute_streak(oks):
    best = cur = 0
    for ok in oks:
        cur = cur + 1 if ok else 0
        best = max(best, cur)
    return best


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_prefix_totals_across_blocks(spark, partitions):
    rnd = random.Random(7)
    rows = [("hot", i, rnd.random() < 0.6) for i in range(3000)]
    rows += [(f"k{j}", i, rnd.random() < 0.5) for j in range(20) for i in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "team string, t int, won boolean")
    pre = sequences.prefix_totals(df.withColumn("w", F.col("won").cast("long")), "team", ["t"], ["w"], partitions)
    got = {(r.team, r.t): (r._rn, r.cum_w) for r in pre.collect()}
    by_team = {}
    for team, t, won in rows:
        by_team.setdefault(team, []).append((t, int(won)))
    for team, seq in by_team.items():
        seq.sort()
        cum = 0
        for pos, (t, w) in enumerate(seq, start=1):
            cum += w
            assert got[(team, t)] == (pos, cum)

    stretch = {r.team: r.max_won_in_90 for r in sequences.best_stretch(df, "team", ["t"], "won", 90, partitions=partitions).collect()}
    streak = {r.team: r.longest_streak for r in
              sequences.longest_streak(df, "team", ["t"], F.col("won"), partitions=partitions).collect()}
    for team, seq in by_team.items():
        flags = [w for _, w in sorted(seq)]
        assert stretch[team] == _brute_stretch(flags, 90)
        assert streak[team] == _brute_streak(flags)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([True, False, None])), min_size=1, max_size=60),
    length=st.integers(1, 9),
    partitions=st.sampled_from([1, 7, 32]),
)
def test_sequences_with_null_keys_and_flags(spark, data, length, partitions):
    df = spark.createDataFrame([(k, i, f) for i, (k, f) in enumerate(data)], "k string, t int, f boolean")
    got = {r.k: (r.games, r[2]) for r in sequences.best_stretch(df, "k", ["t"], "f", length, partitions=partitions).collect()}
    runs = {r.k: (r.games, r.longest_streak) for r in sequences.longest_streak(df, "k", ["t"], F.col("f"), partitions=partitions).collect()}
    want = {}
    for k, f in data:
        want.setdefault(k, []).append(int(bool(f)))
    assert got == {k: (len(v), _brute_stretch(v, length)) for k, v in want.items()}
    assert runs == {k: (len(v), _brute_streak(v)) for k, v in want.items()}


def test_dedup_hot_duplicate_group(spark):
    rows = [(1, 1, 5, "x")] * 5000 + [(1, 1, 3, "y"), (1, 2, 9, "z"), (2, 1, 1, "w")]
    df = spark.createDataFrame(rows, "player_id long, game_id long, line int, v string").repartition(8)
    got = sorted(tuple(r) for r in graph.dedup(df, ["player_id", "game_id"], ["line"]).collect())
    assert got == [(1, 1, 3, "y"), (1, 2, 9, "z"), (2, 1, 1, "w")]


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_blocked_player_pairs_equal_plain(spark, sf_small, limit):
    from cairn.plans.dimensional import _dedup_details

    details = _dedup_details(spark, sf_small)
    plain = graph.player_player_edges(details, max_roster_per_task=None)
    blocked = graph.player_player_edges(details, max_roster_per_task=limit)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, blocked.collect()))


def test_blocked_player_pairs_hot_game(spark):
    rows = [(1, p, f"p{p}", "T" + str(p % 2), float(p)) for p in range(60)] + [(2, 5, "p5", "T1", 1.0), (2, 7, "p7", "T1", 2.0)]
    df = spark.createDataFrame(rows, "game_id long, player_id long, player_name string, team_abbreviation string, pts double")
    plain = sorted(map(tuple, graph.player_player_edges(df, max_roster_per_task=None).collect()))
    blocked = sorted(map(tuple, graph.player_player_edges(df, max_roster_per_task=7).collect()))
    assert plain == blocked
    assert len(plain) == 60 * 59 // 2  # every pair of the hot game once (5-7 also shares game 2)


def test_grouping_sets_tasks_hold_a_bounded_number_of_rows(spark, monkeypatch):
    from cairn.operators import windows

    rows = [(p, (p + g) % 7 if p % 11 else None, g, f"20{10 + g % 9}-01-0{1 + p % 8}", p % 5) for g in range(40) for p in range(30)]
    rows += rows[:50]  # repeated rows count their points twice and their game once
    details = spark.createDataFrame(rows, "player_id long, team_id long, game_id long, day string, pts int").withColumn("game_date", F.to_date("day"))
    plain = sorted(map(repr, windows.game_details_grouping_sets(details).collect()))
    monkeypatch.setattr(windows, "TASK_ROWS", 100)
    out = windows.game_details_grouping_sets(details)
    assert f", {len(rows) // 100 + 1}), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, out.collect())) == plain
    team = {r.team_id: r for r in out.where("aggregation_level = 'team'").collect()}
    for t in range(7):
        mine = [r for r in rows if r[1] == t]
        assert team[t].total_pts == sum(r[4] for r in mine) and team[t].games == len({r[2] for r in mine})
