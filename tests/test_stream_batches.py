"""Streams over many micro-batches: one read for several outputs, commit
ledgers, replays, sessions that a late event joins, refreshed lookups."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cairn.operators import cumulative
from cairn.plans import standins
from cairn.streaming import jobs, ledger, sinks
from cairn.streaming.sources import AGGREGATION_EVENT, json_file_stream, parse_events

NOW = {"availableNow": True}


def _write(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)
    at = 1_700_000_000 + len(os.listdir(path)) * 10  # files are read in order of their times
    os.utime(os.path.join(path, name), (at, at))


def _rec(ts, host="h1", referrer="r", ip="1.2.3.4"):
    return {"ip": ip, "event_time": ts, "referrer": referrer, "host": host, "url": "/", "geodata": None}


@pytest.fixture
def folders():
    base = tempfile.mkdtemp(prefix="cairn-batches-")
    return [os.path.join(base, x) for x in ("src", "out", "ckpt")]


def _three_files(src):
    _write(src, "a", [_rec("2024-01-01T10:00:01.000Z"), _rec("2024-01-01T10:07:00.000Z", referrer="s"), "{broken"])
    # on time by its window, too late, and on time
    _write(src, "b", [_rec("2024-01-01T10:06:00.000Z"), _rec("2024-01-01T10:01:00.000Z"), _rec("2024-01-01T10:20:00.000Z")])
    _write(src, "c", [_rec("2024-01-01T10:20:01.000Z", host="h2"), _rec("soon"), _rec("2024-01-01T11:00:00.000Z")])


WANT_HOSTS = {("2024-01-01 10:00:00", "h1", 1), ("2024-01-01 10:05:00", "h1", 2), ("2024-01-01 10:20:00", "h1", 1), ("2024-01-01 10:20:00", "h2", 1)}


def test_two_outputs_from_one_read(spark, folders):
    src, out, ckpt = folders
    _three_files(src)
    query = jobs.shared_aggregation_job(spark, json_file_stream(spark, src, 1), out, ckpt, NOW)[0]
    query.awaitTermination()
    # every record was read once: a second read of a batch would count again
    assert sum(p["numInputRows"] for p in query.recentProgress) == 9
    hosts = {(str(r.event_hour), r.host, r.num_hits) for r in jobs.window_counts(spark, out, "by_host").collect()}
    assert hosts == WANT_HOSTS
    pairs = {(str(r.event_hour), r.referrer, r.num_hits) for r in jobs.window_counts(spark, out, "by_host_referrer").where("host = 'h1'").collect()}
    assert ("2024-01-01 10:05:00", "s", 1) in pairs and ("2024-01-01 10:05:00", "r", 1) in pairs
    late = ledger.committed_rows(spark, f"{out}/late", f"{out}/ledger").collect()
    assert [r.event_time for r in late] == ["2024-01-01T10:01:00.000Z"]
    dead = ledger.committed_rows(spark, f"{out}/dead_letter", f"{out}/ledger").collect()
    assert sorted(r.reason for r in dead) == ["bad_event_time", "unparsable_json"]
    assert jobs.window_counts(spark, out, "by_host", watermark=None).count() == 5  # the open window too


def test_shared_job_survives_a_lost_checkpoint(spark, folders):
    src, out, ckpt = folders
    _three_files(src)
    for run in ("one", "two"):
        jobs.await_all(jobs.shared_aggregation_job(spark, json_file_stream(spark, src, 1), out, f"{ckpt}/{run}", NOW))
    got = {(str(r.event_hour), r.host, r.num_hits) for r in jobs.window_counts(spark, out, "by_host").collect()}
    assert got == WANT_HOSTS


def test_ledger_skips_replays_and_repeats_what_was_not_committed(spark, folders):
    _, out, _ = folders
    write = ledger.once_per_batch(f"{out}/ledger", sinks.append_writer(f"{out}/table"))
    one, two = spark.range(5), spark.range(5, 9)
    assert ledger.committed_rows(spark, f"{out}/table", f"{out}/ledger") is None
    for batch, batch_id in ((one, 0), (one, 0), (two, 1), (one, 0), (two, 1), (one.limit(0), 2), (one.limit(0), 2)):
        write(batch, batch_id)
    assert sorted(r.id for r in spark.read.parquet(f"{out}/table").collect()) == list(range(9))
    with pytest.raises(ledger.ReplayMismatch):
        write(spark.range(6), 0)
    with pytest.raises(ledger.ReplayMismatch):
        write(spark.range(1, 6), 0)

    # a batch that fails between write and commit is not in the ledger; a
    # writer that replaces its own folder repeats it without a trace
    def broken(batch, batch_id):
        sinks.parquet_batch_writer(f"{out}/own")(batch, batch_id)
        raise OSError("lost")

    with pytest.raises(OSError):
        ledger.once_per_batch(f"{out}/own_ledger", broken)(one, 0)
    assert ledger.entry(spark, f"{out}/own_ledger", 0) is None
    again = ledger.once_per_batch(f"{out}/own_ledger", sinks.parquet_batch_writer(f"{out}/own"))
    again(one, 0)
    again(two, 1)
    assert ledger.committed_rows(spark, f"{out}/own", f"{out}/own_ledger").count() == 9


def test_late_event_joins_two_open_sessions(spark, folders):
    src, out, ckpt = folders
    _write(src, "a", [_rec("2024-01-01T10:00:00.000Z"), _rec("2024-01-01T10:08:00.000Z")])  # two sessions so far
    _write(src, "b", [_rec("2024-01-01T10:04:00.000Z")])  # between them
    _write(src, "c", [_rec("2024-01-01T12:00:00.000Z")])
    jobs.await_all(jobs.session_job(spark, json_file_stream(spark, src, 1), out, ckpt, NOW, watermark="10 minutes"))
    got = [(str(r.session_start), str(r.session_end), r.num_events) for r in spark.read.parquet(f"{out}/sessions").collect()]
    assert got == [("2024-01-01 10:00:00", "2024-01-01 10:13:00", 3)]


def test_batch_sessions_join_at_the_gap(spark):
    from cairn.streaming.aggregation import sessions

    # exactly a gap apart is one session; a microsecond more is two
    rows = [("k", t) for t in ("10:00:00", "10:05:00", "10:10:00.000001", "10:20:00", "10:20:00")] + [(None, "10:01:00"), ("k", None)]
    df = spark.createDataFrame(rows, "key string, t string").withColumn("t", F.expr("CAST('2024-01-01 ' || t AS timestamp)"))
    got = sorted((str(r.key), str(r.session_start)[11:], str(r.session_end)[11:], r.num_events) for r in sessions(df, "t", ["key"]).collect())
    assert got == [
        ("None", "10:01:00", "10:06:00", 1),
        ("k", "10:00:00", "10:10:00", 2),
        ("k", "10:10:00.000001", "10:15:00.000001", 1),
        ("k", "10:20:00", "10:25:00", 2),
    ]


def test_lookup_is_loaded_for_every_batch(spark, folders):
    src, out, ckpt = folders
    rec = {"url": "/", "referrer": None, "user_agent": None, "host": "h", "ip": "9.1.2.3", "headers": None}
    for name, minute in (("a", 0), ("b", 1)):
        _write(src, name, [dict(rec, event_time=f"2024-01-01T10:0{minute}:00.000Z"), "{oops"])

    def load(own, batch_id):
        return own.createDataFrame([(0, 2**32 - 1, f"C{batch_id}", "s", "c")], "start_ip long, end_ip long, country string, state string, city string")

    jobs.await_all(jobs.enrichment_job(spark, json_file_stream(spark, src, 1), load, out, ckpt, NOW))
    rows = sorted((str(r.event_timestamp)[11:], json.loads(r.geodata)["country"]) for r in spark.read.parquet(f"{out}/processed_events").collect())
    assert rows == [("10:00:00", "C0"), ("10:01:00", "C1")]
    assert spark.read.parquet(f"{out}/dead_letter").count() == 2


def test_dead_letter_split_is_that_of_the_records(spark):
    raw = spark.createDataFrame([(json.dumps(_rec("2024-01-01T10:00:00.000Z")),), ("{",), (json.dumps(_rec("x")),), (None,)], "value string")
    good, bad = parse_events(raw, AGGREGATION_EVENT)
    assert good.count() == 1 and bad.count() == 3


def test_actor_history_holds_a_year_a_row(spark, sf_small):
    """Yearly films, put together for a snapshot, are the looped table; the
    history step gives the same rows as the one-pass history."""
    films = standins.actor_films(spark, sf_small).cache()
    first, last = films.agg(F.min("year"), F.max("year")).first()
    history = cumulative.actors_history(films, last).cache()
    assert history.agg(F.sum(F.size("new_films"))).first()[0] == films.count()
    step = cumulative.actors_history_step(history.where(F.col("current_year") == last - 1), films, last)
    columns = ["actorid", "actor", "new_films", "quality_class", "is_active", "current_year"]
    want = history.where(F.col("current_year") == last).select(*columns)
    assert sorted(map(str, step.select(*columns).collect())) == sorted(map(str, want.collect()))
    middle = (first + last) // 2
    a = cumulative.actors_snapshot(history, middle).select("actorid", "films", "quality_class", "is_active")
    b = cumulative.actors_backfill(films, middle).select(*a.columns)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_calendar_frames_skip_missing_days(spark):
    from cairn.operators.windows import calendar_rolling

    rows = [("a", "2024-01-01", 1), ("a", "2024-01-07", 2), ("a", "2024-01-08", 4), ("a", "2024-01-20", 8), ("a", None, 16), ("b", "2024-01-08", 32)]
    df = spark.createDataFrame(rows, "k string, d string, n long").withColumn("d", F.col("d").cast("date"))
    got = {(r.k, str(r.d)): (r.week, r.before) for r in calendar_rolling(df, ["k"], "d", "n", {"week": (-6, 0), "before": (-13, -7)}).collect()}
    assert got == {
        ("a", "2024-01-01"): (1, None), ("a", "2024-01-07"): (3, None), ("a", "2024-01-08"): (6, 1),
        ("a", "2024-01-20"): (8, 6), ("a", "None"): (16, 16), ("b", "2024-01-08"): (32, None),
    }


def test_layouts_are_sorted_and_ranked_by_bytes(spark, sf_small):
    from cairn.plans import joins

    for name, df in joins.written_layouts(spark, sf_small):
        keys = [k for k in joins.LAYOUTS[name] if k in joins.LAYOUT_COLUMNS]
        files = {}
        for r in df.select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).collect():
            files.setdefault(r.f, []).append((r.i, [(r[k] is not None, r[k]) for k in keys]))
        for rows in files.values():
            inside = [key for _, key in sorted(rows, key=lambda x: x[0])]
            assert inside == sorted(inside)
    sizes = joins.layout_sizes(spark, sf_small).orderBy("total_bytes", "layout").collect()
    ranks = {r.layout: r.size_rank for r in joins.layout_file_sizes(spark, sf_small).collect()}
    assert [ranks[r.layout] for r in sizes] == list(range(1, len(joins.LAYOUTS) + 1))
    assert all(r.total_bytes > 0 and r.num_files >= 1 for r in sizes)
