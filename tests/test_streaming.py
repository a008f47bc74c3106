"""Streaming: watermark drops late data, bad records go to dead letter,
the job restarts from its checkpoint without duplicating output."""

import json
import os
import tempfile


from cairn.streaming import jobs
from cairn.streaming.sources import json_file_stream


def _write(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in records:
            f.write(r if isinstance(r, str) else json.dumps(r))
            f.write("\n")


def _rec(ts, host="h1", referrer="r"):
    return {"ip": "1.2.3.4", "event_time": ts, "referrer": referrer, "host": host, "url": "/", "geodata": None}


def test_aggregation_job_watermark_dead_letter_and_restart(spark):
    base = tempfile.mkdtemp(prefix="cairn-stream-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    _write(src, "f1.json", [
        _rec("2024-01-01T10:00:01.000Z"), _rec("2024-01-01T10:00:02.500Z"), _rec("2024-01-01T10:07:00.000Z"),
        "{not json", _rec("2024-01-01 10:00:00"),  # malformed JSON, malformed time
    ])
    trigger = {"availableNow": True}
    jobs.await_all(jobs.aggregation_job(spark, json_file_stream(spark, src, 1), out, ckpt, trigger))
    # second file: one record inside the 15 s watermark, one far too late, and
    # a record that moves the watermark past 10:10
    _write(src, "f2.json", [_rec("2024-01-01T10:06:50.000Z"), _rec("2024-01-01T10:01:00.000Z"),
                            _rec("2024-01-01T10:20:00.000Z")])
    jobs.await_all(jobs.aggregation_job(spark, json_file_stream(spark, src, 1), out, ckpt, trigger))
    # restarting with no new data must not change the output
    jobs.await_all(jobs.aggregation_job(spark, json_file_stream(spark, src, 1), out, ckpt, trigger))
    got = {(str(r.event_hour), r.host): r.num_hits for r in spark.read.parquet(f"{out}/by_host").collect()}
    assert got == {("2024-01-01 10:00:00", "h1"): 2, ("2024-01-01 10:05:00", "h1"): 2}
    dead = {r.reason for r in spark.read.parquet(f"{out}/dead_letter").collect()}
    assert dead == {"unparsable_json", "bad_event_time"}


def test_session_job_closes_sessions_by_watermark(spark):
    base = tempfile.mkdtemp(prefix="cairn-sess-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    trigger = {"availableNow": True}
    _write(src, "f1.json", [
        _rec("2024-01-01T10:00:00.000Z"), _rec("2024-01-01T10:04:00.000Z"),   # one session (gap 4 min)
        _rec("2024-01-01T10:20:00.000Z"),                                       # a new session
    ])
    jobs.await_all(jobs.session_job(spark, json_file_stream(spark, src, 1), out, ckpt, trigger))
    # the 10:20 session is still open; an event at 09:00 is behind the watermark and dropped;
    # an event at 10:40 moves the watermark past 10:25 and closes the 10:20 session
    _write(src, "f2.json", [_rec("2024-01-01T09:00:00.000Z"), _rec("2024-01-01T10:40:00.000Z")])
    jobs.await_all(jobs.session_job(spark, json_file_stream(spark, src, 1), out, ckpt, trigger))
    got = sorted((str(r.session_start), r.num_events) for r in spark.read.parquet(f"{out}/sessions").collect())
    assert got == [("2024-01-01 10:00:00", 2), ("2024-01-01 10:20:00", 1)]


def test_enrichment_job_dead_letters(spark):
    from cairn.plans import standins

    base = tempfile.mkdtemp(prefix="cairn-enrich-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    rec = {"url": "/", "referrer": None, "user_agent": None, "host": "h", "ip": "9.1.2.3", "headers": None,
           "event_time": "2024-01-01T10:00:00.000Z"}
    _write(src, "f1.json", [rec, dict(rec, ip="250.0.0.1"), dict(rec, event_time="yesterday"), "{oops"])
    loc = standins.ip_locations(spark, "/root/testdata/sf0.001")
    jobs.await_all(jobs.enrichment_job(spark, json_file_stream(spark, src), loc, out, ckpt, {"availableNow": True}))
    rows = {r.ip: r.geodata for r in spark.read.parquet(f"{out}/processed_events").collect()}
    assert rows["250.0.0.1"] == "{}" and rows["9.1.2.3"].startswith('{"country":')
    reasons = sorted(r.reason for r in spark.read.parquet(f"{out}/dead_letter").collect())
    assert reasons == ["bad_event_time", "unparsable_json"]
