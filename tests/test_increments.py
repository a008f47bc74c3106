"""Daily loads through partitioned storage equal the one-pass backfill,
and re-running a day changes nothing."""

import os
import tempfile
from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cairn.operators import cumulative, growth
from cairn.plans import standins
from cairn.plans.increments import run_daily


def test_users_cumulated_daily_runs_equal_backfill(spark, sf_small):
    ev = standins.web_events(spark, sf_small).cache()
    first = ev.agg(F.min(F.to_date("event_time"))).first()[0]
    last = first + timedelta(days=6)
    path = os.path.join(tempfile.mkdtemp(prefix="cairn-inc-"), "users_cumulated")
    schema = spark.createDataFrame([], "user_id long, dates_active array<date>, date date").schema
    step = lambda prev, day: cumulative.dates_cumulated_step(prev, ev, "user_id", day)
    run_daily(spark, path, step, first, last, schema)
    run_daily(spark, path, step, last, last, schema)  # re-run of the last day
    stored = spark.read.parquet(path).where(F.col("date") == F.lit(last))
    assert stored.count() == spark.read.parquet(path).where(F.col("date") == F.lit(last)).distinct().count()
    want = cumulative.dates_cumulated(ev, "user_id", last)
    assertDataFrameEqual(stored.select("user_id", "dates_active", "date"), want.select("user_id", "dates_active", "date"))


def test_growth_accounting_daily_runs_equal_backfill(spark, sf_small):
    ev = standins.web_events(spark, sf_small).cache()
    first = ev.agg(F.min(F.to_date("event_time"))).first()[0]
    last = first + timedelta(days=9)
    path = os.path.join(tempfile.mkdtemp(prefix="cairn-inc-"), "growth")
    schema = spark.createDataFrame(
        [], "user_id long, first_active_date date, last_active_date date, daily_active_state string, "
        "weekly_active_state string, dates_active array<date>, date date",
    ).schema
    run_daily(spark, path, lambda prev, day: growth.growth_accounting_step(prev, ev, day), first, last, schema)
    stored = spark.read.parquet(path)
    want = growth.growth_accounting(ev, last)
    cols = ["user_id", "first_active_date", "last_active_date", "daily_active_state", "weekly_active_state",
            "dates_active", "date"]
    assertDataFrameEqual(stored.select(*cols), want.select(*cols))


def test_bucketed_daily_runs_shuffle_only_today(spark, sf_small):
    import uuid

    from cairn.plans.increments import run_daily_bucketed

    ev = standins.web_events(spark, sf_small).cache()
    first = ev.agg(F.min(F.to_date("event_time"))).first()[0]
    last = first + timedelta(days=5)
    table = f"users_cumulated_{uuid.uuid4().hex[:8]}"
    schema = spark.createDataFrame([], "user_id long, dates_active array<date>, date date").schema
    step = lambda prev, day: cumulative.dates_cumulated_step(prev, ev, "user_id", day)
    run_daily_bucketed(spark, table, step, first, last, schema, "user_id", 8)
    run_daily_bucketed(spark, table, step, last, last, schema, "user_id", 8)  # re-run a day
    stored = spark.table(table).where(F.col("date") == F.lit(last))
    want = cumulative.dates_cumulated(ev, "user_id", last)
    assertDataFrameEqual(stored.select("user_id", "dates_active", "date"), want.select("user_id", "dates_active", "date"))
    # next day's plan: the stored snapshot is a bucketed scan; only today's side shuffles
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prev = spark.table(table).where(F.col("date") == F.lit(last))
        plan = step(prev, last + timedelta(days=1))._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
