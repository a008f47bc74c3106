"""Commit ledgers: what a stream has written, by batch id.

A ledger is a folder with one small record per committed batch. A batch is
written first and committed after, so after a crash in between it is not in
the ledger and is written again. ``once_per_batch`` skips a batch that the
ledger holds, which makes any writer safe on replay (a restart from the
checkpoint, or a lost checkpoint): the replayed batch must be the committed
one, which a count and a hash of its rows prove; other rows under a committed
id raise ``ReplayMismatch`` instead of being lost silently. A target that
appends and cannot take part in the commit (JDBC without a key, say) may still
repeat the one batch that a crash hits between write and commit; a writer
that replaces its own batch folder does not.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class ReplayMismatch(ValueError):
    pass


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _folder(ledger: str, batch_id: int) -> str:
    return f"{ledger.rstrip('/')}/batch_id={batch_id}"


def entry(spark: SparkSession, ledger: str, batch_id: int) -> dict | None:
    """The facts committed with a batch; None when it is not committed."""
    folder = _folder(ledger, batch_id)
    if batch_id < 0 or not path_exists(spark, f"{folder}/_SUCCESS"):
        return None
    return json.loads(spark.read.text(folder).first()["value"])


def commit(spark: SparkSession, ledger: str, batch_id: int, facts: dict) -> None:
    line = json.dumps(facts, sort_keys=True)
    spark.range(1, numPartitions=1).select(F.lit(line).alias("value")).write.mode("overwrite").text(_folder(ledger, batch_id))


def committed_rows(spark: SparkSession, data: str, ledger: str) -> DataFrame | None:
    """Rows of the ``batch_id=`` folders below ``data`` whose batch is
    committed; None before the first commit."""
    if not path_exists(spark, ledger) or not path_exists(spark, data):
        return None
    done = spark.read.text(ledger).select("batch_id").distinct()
    return spark.read.parquet(data).join(done, "batch_id", "left_semi")


def fingerprint(df: DataFrame) -> list[Column]:
    """Row count and an order-free hash of all rows, as aggregates."""
    row = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash")]


def once_per_batch(ledger: str, writer):
    """``writer`` for ``foreachBatch``, run once for each batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = entry(spark, ledger, batch_id)
        if known is not None:
            again = batch.agg(*fingerprint(batch)).first().asDict()
            if again != known:
                raise ReplayMismatch(f"batch {batch_id} of {ledger}: committed {known}, replayed {again}")
            return
        seen = Observation()
        writer(batch.observe(seen, *fingerprint(batch)), batch_id)  # counted by the write itself
        commit(spark, ledger, batch_id, dict(seen.get))

    return write
