"""Period-by-period loads of a cumulative table kept in partitioned storage.

Each run reads only the previous period's partition (partition pruning),
applies the step operator, and overwrites only the new period's partition
(dynamic partition overwrite). Every run therefore starts from files, not
from the previous run's plan, and re-running a period replaces its
partition instead of appending to it.
"""

from __future__ import annotations

from datetime import date, timedelta
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cairn.session import note_table, scratch_path
from cairn.sources.catalog import insert_partition, write_partition


def read_partition(spark: SparkSession, path: str, partition_col: str, value, schema: StructType) -> DataFrame:
    """One partition of a partitioned parquet table, or an empty frame with
    ``schema`` when the table does not exist yet (the first run)."""
    try:
        df = spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return df.where(F.col(partition_col) == F.lit(value))


def run_daily(
    spark: SparkSession,
    path: str,
    step: Callable[[DataFrame, date], DataFrame],
    first_day: date,
    last_day: date,
    schema: StructType,
    partition_col: str = "date",
) -> None:
    """Run ``step(prev_partition, day)`` for every day and write each result
    as the ``partition_col = day`` partition of ``path``."""
    day = first_day
    while day <= last_day:
        prev = read_partition(spark, path, partition_col, day - timedelta(days=1), schema)
        out = step(prev, day)
        write_partition(out.where(F.col(partition_col) == F.lit(day)), path, [partition_col])
        day += timedelta(days=1)


def write_bucketed_partition(df: DataFrame, table: str, key: str, buckets: int, partition_col: str = "date") -> None:
    """Write the partitions present in ``df`` into a table partitioned by
    ``partition_col`` and bucketed (and sorted) by ``key``; created on first
    use in the shared folder, later writes replace only their partitions."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        insert_partition(df, table)
    else:
        note_table(spark, table)
        (
            df.write.format("parquet")
            .partitionBy(partition_col)
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", scratch_path(spark, table))
            .saveAsTable(table)
        )


def run_daily_bucketed(
    spark: SparkSession,
    table: str,
    step: Callable[[DataFrame, date], DataFrame],
    first_day: date,
    last_day: date,
    schema: StructType,
    key: str,
    buckets: int,
    partition_col: str = "date",
) -> None:
    """As ``run_daily``, into a catalog table partitioned by ``partition_col``
    and bucketed (and sorted) by ``key``. The previous partition is then
    read as a bucketed scan, so the FULL OUTER JOIN on ``key`` shuffles only
    the new day's side, not the whole cumulative snapshot."""
    day = first_day
    while day <= last_day:
        if spark.catalog.tableExists(table):
            prev = spark.table(table).where(F.col(partition_col) == F.lit(day - timedelta(days=1)))
        else:
            prev = spark.createDataFrame([], schema)
        write_bucketed_partition(step(prev, day).where(F.col(partition_col) == F.lit(day)), table, key, buckets,
                                 partition_col)
        day += timedelta(days=1)
