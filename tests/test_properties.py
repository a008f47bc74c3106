"""Property tests on random small inputs (few examples: each is a Spark job)."""

from datetime import date, datetime, timedelta

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.operators import datelist, funnel, scd
from tests.test_equivalence import _funnel_brute_force

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

URLS = ["/a", "/b", "/signup"]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 2), st.integers(0, 40), st.integers(0, 1)),
                min_size=1, max_size=60))
def test_funnel_rewrite_equals_self_join(spark, rows):
    t0 = datetime(2024, 3, 1, 23, 30)
    events = [(URLS[u], "h", user, t0 + timedelta(minutes=m)) for user, u, m, _ in rows]
    df = spark.createDataFrame(events, "url string, host string, user_id long, event_time timestamp")
    got = {r.url: (r.hits, r.conversion_rate) for r in funnel.funnel_conversion(df, "/signup", min_hits=0).collect()}
    want = _funnel_brute_force(pd.DataFrame(events, columns=["url", "host", "user_id", "event_time"]), "/signup", 0)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(["a", "b", None]), min_size=2, max_size=6), min_size=1, max_size=5))
def test_scd_increment_equals_backfill(spark, series):
    rows = [(k, 2000 + p, v) for k, vals in enumerate(series) for p, v in enumerate(vals)]
    snaps = spark.createDataFrame(rows, "k long, p int, v string")
    last = max(r[1] for r in rows)
    prev = scd.scd_backfill(snaps, "k", "p", ["v"], as_of=last - 1)
    inc = scd.scd_increment(prev, snaps, "k", "p", ["v"], last)
    full = scd.scd_backfill(snaps, "k", "p", ["v"], as_of=last)
    cols = ["k", "v", "start_period", "end_period"]
    def key(r):
        return tuple((x is None, x if x is not None else "") for x in r)

    assert sorted(map(tuple, inc.select(*cols).collect()), key=key) == sorted(map(tuple, full.select(*cols).collect()), key=key)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=1, max_size=40))
def test_mask_from_array_equals_mask_from_events(spark, rows):
    anchor = date(2024, 1, 31)
    ev = spark.createDataFrame(
        [(u, datetime(2024, 1, 31, 12) - timedelta(days=d)) for u, d in rows], "user_id long, event_time timestamp"
    )
    days = ev.select("user_id", F.to_date("event_time").alias("d")).distinct()
    arrays = days.groupBy("user_id").agg(F.collect_list("d").alias("dates_active"))
    a = {r.user_id: r.datelist_int for r in datelist.datelist_int(arrays, "user_id", anchor).collect()}
    b = {r.user_id: r.datelist_int for r in datelist.datelist_int_from_events(ev, "user_id", anchor).collect()}
    assert a == b
    for u in a:
        want = sum(1 << (31 - d) for d in {d for uu, d in rows if uu == u} if d < 32)
        assert a[u] == want
