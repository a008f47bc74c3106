"""Sources and sinks: CSV variants, bootstrap tables, series, partition
overwrite (re-runnable), CTAS, positional insert, upsert, file stats."""

import os
import tempfile
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cairn.sources import catalog, files

MAPS_CSV = """mapid,name,description
m1,Alpha,First map
m2,,No name here
m3,Gamma,
m4,Delta,Fourth map
m5,Epsilon,Fifth map
"""


def _csv(text, header=True):
    d = tempfile.mkdtemp(prefix="cairn-csv-")
    path = os.path.join(d, "maps.csv")
    with open(path, "w") as f:
        f.write(text if header else text.split("\n", 1)[1])
    return path


def test_csv_header_inferred_strings_and_positional(spark):
    path = _csv(MAPS_CSV)
    inferred = files.read_csv(spark, path, infer_schema=True)
    assert inferred.count() == 5 and inferred.columns == ["mapid", "name", "description"]
    rows = {r.mapid: r for r in inferred.collect()}
    assert rows["m2"].name is None and rows["m3"].description is None
    typed = files.read_csv(spark, path, schema="mapid string, name string, description string")
    assert typed.schema == inferred.schema
    nohead = files.read_csv(spark, _csv(MAPS_CSV, header=False), header=False, columns=["mapid", "name", "description"])
    assert nohead.count() == 5 and nohead.columns == ["mapid", "name", "description"]
    nums = spark.createDataFrame([("1",), ("x",)], "v string")
    assert [r.v for r in files.try_cast_columns(nums, {"v": "int"}).collect()] == [1, None]


def test_empty_bootstrap_and_series(spark):
    schema = StructType([StructField("user_id", LongType()), StructField("name", StringType())])
    assert files.empty_table(spark, schema).schema == schema
    seasons = files.integer_series(spark, 1996, 2022, "season")
    assert seasons.count() == 27 and seasons.agg(F.min("season"), F.max("season")).first() == (1996, 2022)
    days = spark.createDataFrame([(date(2023, 2, 28), date(2023, 3, 31))], "a date, b date").select(
        files.date_series(F.col("a"), F.col("b"))
    )
    assert days.count() == 32


def test_partition_overwrite_is_rerunnable(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cairn-part-"), "t")
    day1 = spark.createDataFrame([(1, "2023-01-01"), (2, "2023-01-01")], "v long, ds string")
    day2 = spark.createDataFrame([(3, "2023-01-02")], "v long, ds string")
    catalog.write_partition(day1, path, ["ds"])
    catalog.write_partition(day2, path, ["ds"])
    catalog.write_partition(day2, path, ["ds"])  # re-run of the same day
    got = sorted((r.v, str(r.ds)) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2023-01-01"), (2, "2023-01-01"), (3, "2023-01-02")]


def test_year_partition_transform(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cairn-year-"), "t")
    df = spark.createDataFrame([(1, date(2016, 1, 1)), (2, date(2017, 5, 1))], "v long, d date")
    catalog.write_partition(df.withColumn("d_year", F.year("d")), path, ["d_year"])
    pruned = spark.read.parquet(path).where(F.col("d_year") == 2016)
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(d_year" in pruned._jdf.queryExecution().executedPlan().toString()


def test_ctas_insert_into_positional_and_ddl(spark):
    catalog.ensure_database(spark, "cairn_test")
    catalog.drop_table(spark, "cairn_test.scd")
    first = spark.createDataFrame([("a", "good", 2001)], "player string, cls string, ds int")
    catalog.overwrite_table(first, "cairn_test.scd", partition_by=["ds"])
    # columns in another order: insert_partition reorders to the table's order
    more = spark.createDataFrame([(2002, "bad", "a")], "ds int, cls string, player string")
    catalog.insert_partition(more, "cairn_test.scd")
    catalog.insert_partition(more, "cairn_test.scd")  # re-run replaces, no duplicate
    got = sorted(tuple(r) for r in spark.table("cairn_test.scd").collect())
    assert got == [("a", "bad", 2002), ("a", "good", 2001)]


def test_upsert_replaces_by_key(spark):
    old = spark.createDataFrame([(1, "m", [1]), (2, "m", [5])], "user_id long, metric string, arr array<long>")
    new = spark.createDataFrame([(2, "m", [5, 6]), (3, "m", [0, 1])], "user_id long, metric string, arr array<long>")
    got = {r.user_id: r.arr for r in catalog.upsert(old, new, ["user_id", "metric"]).collect()}
    assert got == {1: [1], 2: [5, 6], 3: [0, 1]}


def test_file_stats_and_persist(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cairn-files-"), "t")
    spark.range(1000).repartition(3).write.parquet(path)
    stats = catalog.file_stats(spark.read.parquet(path)).first()
    assert stats.num_files == 3
    assert stats.total_bytes == sum(
        os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet")
    )
    with catalog.persisted(spark.range(10)) as cached:
        assert cached.is_cached and cached.count() == 10
    assert not cached.is_cached


def test_partition_aware_upsert_matches_plain(spark):
    old = spark.createDataFrame(
        [(1, 2000, "a"), (2, 2000, "b"), (1, 2001, "c"), (2, 2001, "d")], "k long, y int, v string"
    )
    new = spark.createDataFrame([(2, 2001, "D"), (3, 2001, "E")], "k long, y int, v string")
    plain = sorted(tuple(r) for r in catalog.upsert(old, new, ["k", "y"]).collect())
    aware = sorted(tuple(r) for r in catalog.upsert(old, new, ["k", "y"], partition_col="y", partitions=[2001]).collect())
    assert plain == aware == [(1, 2000, "a"), (1, 2001, "c"), (2, 2000, "b"), (2, 2001, "D"), (3, 2001, "E")]


def test_clean_up_removes_the_runs_folder_and_tables(spark):
    from cairn.operators.joins import bucketed_pair
    from cairn.session import clean_up, cut_lineage, run_folder

    df = spark.range(20).withColumnRenamed("id", "k")
    left, _ = bucketed_pair(spark, df, df, "k", buckets=2, name="cleaned")
    cut_lineage(df)
    assert left.count() == 20 and os.listdir(run_folder(spark).removeprefix("file:"))
    clean_up(spark)
    assert not os.path.exists(run_folder(spark).removeprefix("file:"))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("cleaned")]
