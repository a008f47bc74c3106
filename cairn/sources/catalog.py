"""Sinks and table management: overwrite, partition overwrite, upsert,
bucketed and partitioned tables, file metadata."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.session import note_table


def overwrite_table(df: DataFrame, table: str, partition_by=None, fmt: str = "parquet") -> None:
    """``write.mode('overwrite').saveAsTable`` (CREATE TABLE AS SELECT)."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def insert_partition(df: DataFrame, table: str) -> None:
    """Insert one period into an existing partitioned table.

    ``insertInto`` is positional, so the frame is reordered to the table's
    column order first; dynamic partition overwrite replaces only the
    partitions present in ``df``, which makes a re-run of a period safe.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    target_cols = spark.table(table).columns
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*target_cols).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)  # the caller's setting


def write_partition(df: DataFrame, path: str, partition_by, fmt: str = "parquet") -> None:
    """Path-based dynamic partition overwrite (no catalog needed)."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path)
    )


def write_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    key: str,
    sort: bool = True,
    partition_by=None,
    path: str | None = None,
) -> None:
    """Bucketed table: later joins/aggregations on ``key`` need no shuffle
    when both sides use the same bucket count."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    if sort:
        writer = writer.sortBy(key)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
        note_table(df.sparkSession, table)
    writer.saveAsTable(table)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], partition_col: str | None = None,
           partitions: list | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE: incoming rows replace the
    existing rows with the same key, other existing rows stay.

    A left-anti join plus a union. As in SQL, a NULL in a key conflicts with
    nothing, so rows with one are kept and added. When the load knows the
    values of ``partition_col`` (one of ``keys``, e.g. the period) that
    ``incoming`` holds, pass them as ``partitions``: the other partitions
    pass through without a shuffle, and only those given need rewriting.
    A partition value of NULL is given as ``None``.
    """
    new_keys = incoming.select(*keys).distinct()
    added = incoming.select(*existing.columns)
    if partition_col is None or partitions is None:
        return existing.join(new_keys, on=keys, how="left_anti").unionByName(added)
    column = F.col(partition_col)
    named = [p for p in partitions if p is not None]
    # never NULL: a row is on exactly one side
    touched = F.coalesce(column.isin(named), F.lit(False)) if named else F.lit(False)
    if len(named) < len(partitions):
        touched = touched | column.isNull()
    kept = existing.where(touched).join(new_keys, on=keys, how="left_anti")
    return existing.where(~touched).unionByName(kept).unionByName(added)


def file_stats(df: DataFrame) -> DataFrame:
    """Total bytes and number of files behind a file-based DataFrame
    (``SUM(file_size_in_bytes), COUNT(1) FROM t.files``)."""
    files = df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).distinct()
    return files.agg(
        F.sum("file_size").cast("long").alias("total_bytes"),
        F.count(F.lit(1)).alias("num_files"),
    )


@contextmanager
def persisted(df: DataFrame, storage_level=None):
    """Cache a shared intermediate for the duration of a block, then free it."""
    cached = df.persist(storage_level) if storage_level else df.persist()
    try:
        yield cached
    finally:
        cached.unpersist()


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
