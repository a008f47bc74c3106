"""The four job tests of FIXTURES.md (A1-A4) on our operators.

Fixed values: the input rows and the expected rows below are given there and
must match; the calls and checks are our own.
"""

from datetime import date

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cairn.operators import array_metrics, cumulative, graph, scd


def test_player_scd_backfill(spark):
    rows = [
        ("Michael Jordan", 2001, "Good"),
        ("Michael Jordan", 2002, "Good"),
        ("Michael Jordan", 2003, "Bad"),
        ("Someone Else", 2003, "Bad"),
    ]
    players = spark.createDataFrame(rows, "player_name string, current_season long, scoring_class string")
    out = scd.scd_backfill(
        players, "player_name", "current_season", ["scoring_class"],
        start_name="start_date", end_name="end_date", as_of_name=None,
    ).select("player_name", "scoring_class", "start_date", "end_date")
    expected = spark.createDataFrame(
        [("Michael Jordan", "Good", 2001, 2002), ("Michael Jordan", "Bad", 2003, 2003), ("Someone Else", "Bad", 2003, 2003)],
        "player_name string, scoring_class string, start_date long, end_date long",
    )
    assertDataFrameEqual(out, expected)


def test_team_vertices_dedup_with_tie_break(spark):
    schema = "team_id long, abbreviation string, nickname string, city string, arena string, yearfounded long"
    teams = spark.createDataFrame(
        [
            (1, "GSW", "Warriors", "San Francisco", "Chase Center", 1900),
            (1, "GSW", "Bad Warriors", "San Francisco", "Chase Center", 1900),
        ],
        schema,
    )
    # the reference leaves the tie open; here it is explicit: nickname DESC
    ranked = teams.withColumn("source_rank", F.when(F.col("nickname") == "Warriors", 0).otherwise(1))
    vertices = graph.team_vertices(ranked, as_map=True)
    rows = vertices.collect()
    assert len(rows) == 1
    row = rows[0]
    assert row.identifier == 1 and row.type == "team"
    assert row.properties["nickname"] == "Warriors"
    assert row.properties["year_founded"] == "1900"


def test_monthly_user_site_hits_positional_sums(spark):
    df = spark.createDataFrame(
        [
            ("2023-03-01", [0, 1, 3], "2023-03-01"),
            ("2023-03-01", [1, 2, 3], "2023-03-01"),
            ("2023-04-01", [], "2023-03-01"),
            ("2023-04-01", [], ""),
        ],
        "month_start string, hit_array array<long>, date_partition string",
    )
    out = array_metrics.positional_sums(
        df.where(F.col("date_partition") == "2023-03-01"), "hit_array", "month_start",
        ["num_hits_first_day", "num_hits_second_day", "num_hits_third_day"],
    )
    expected = spark.createDataFrame(
        [("2023-03-01", 1, 3, 6), ("2023-04-01", 0, 0, 0)],
        "month_start string, num_hits_first_day long, num_hits_second_day long, num_hits_third_day long",
    )
    assertDataFrameEqual(out, expected)


def test_actors_cumulative_step(spark):
    film = "struct<filmid:string,film:string,votes:int,rating:double>"
    actors = spark.createDataFrame(
        [("a1", "Actor A", 1973, "good", None, False)],
        f"actorid string, actor string, current_year int, quality_class string, films array<{film}>, is_active boolean",
    )
    films = spark.createDataFrame(
        [
            ("a1", "Actor A", "Film A", 100, 8.5, "f1", 1974),
            ("a1", "Actor A", "Film B", 150, 7.8, "f2", 1974),
            ("a2", "Actor B", "Film C", 200, 9.0, "f3", 1974),
        ],
        "actorid string, actor string, film string, votes int, rating double, filmid string, year int",
    )
    out = cumulative.actors_step(actors, films, 1974).orderBy("actorid").collect()
    assert [r.actorid for r in out] == ["a1", "a2"]
    a1, a2 = out
    assert [f.film for f in a1.films] == ["Film A", "Film B"]
    assert a1.quality_class == "star"  # avg 8.15 > 8 (the reference test says "good")
    assert a1.is_active and a1.current_year == 1974
    assert a2.quality_class == "star" and [f.film for f in a2.films] == ["Film C"]


def test_actor_idle_year_keeps_class(spark):
    film = "struct<filmid:string,film:string,votes:int,rating:double>"
    actors = spark.createDataFrame(
        [("a1", "Actor A", 1973, "good", [Row(filmid="f0", film="Old", votes=1, rating=7.5)], True)],
        f"actorid string, actor string, current_year int, quality_class string, films array<{film}>, is_active boolean",
    )
    films = spark.createDataFrame([], "actorid string, actor string, film string, votes int, rating double, filmid string, year int")
    r = cumulative.actors_step(actors, films, 1974).collect()[0]
    assert (r.quality_class, r.is_active, r.current_year, len(r.films)) == ("good", False, 1974, 1)


def test_users_cumulated_step_keeps_idle_users(spark):
    prev = spark.createDataFrame(
        [(1, [date(2023, 3, 29)], date(2023, 3, 30))], "user_id long, dates_active array<date>, date date"
    )
    events = spark.createDataFrame(
        [(2, "2023-03-31 10:00:00"), (None, "2023-03-31 11:00:00")], "user_id long, event_time string"
    ).withColumn("event_time", F.col("event_time").cast("timestamp"))
    out = {r.user_id: r for r in cumulative.dates_cumulated_step(prev, events, "user_id", "2023-03-31").collect()}
    assert set(out) == {1, 2}  # NULL user dropped at the source
    assert out[1].dates_active == [date(2023, 3, 29)] and out[1].date == date(2023, 3, 31)
    assert out[2].dates_active == [date(2023, 3, 31)]
