"""Streaming sinks and job runners.

``foreachBatch`` writers are idempotent by batch id: a retried batch
overwrites its own output folder, so a restart from the checkpoint after
an executor or driver loss does not duplicate rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def parquet_batch_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def append_writer(path: str):
    """Append each micro-batch to one Parquet folder: like a JDBC append it
    repeats a replayed batch, unless ``ledger.once_per_batch`` guards it."""

    def write(batch: DataFrame, batch_id: int) -> None:  # noqa: ARG001
        batch.write.mode("append").parquet(path)

    return write


def jdbc_batch_writer(url: str, table: str, properties: dict):
    """Append each micro-batch to a JDBC table (the driver jar must be on the
    classpath). Not idempotent by itself: wrap it in
    ``ledger.once_per_batch``, or give the table a key on (window, keys)."""

    def write(batch: DataFrame, batch_id: int) -> None:  # noqa: ARG001
        batch.write.mode("append").jdbc(url, table, properties=properties)

    return write


def start(df: DataFrame, writer, checkpoint: str, trigger: dict | None = None, output_mode: str = "append",
          name: str | None = None):
    """Start a query with a checkpoint location; ``trigger`` e.g.
    ``{"processingTime": "10 seconds"}`` or ``{"availableNow": True}``."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(writer)
    if name:
        w = w.queryName(name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def kafka_batch_writer(servers: str, topic: str, extra_options: dict | None = None):
    """Publish each micro-batch's ``value`` column (JSON text, see
    ``cairn.streaming.sources.events_as_json``) to a Kafka topic. Kafka
    delivery is at-least-once; consumers dedupe on an event id. Needs the
    Kafka connector jar on the classpath."""

    def write(batch: DataFrame, batch_id: int) -> None:  # noqa: ARG001
        writer = batch.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers)
        for k, v in (extra_options or {}).items():
            writer = writer.option(k, v)
        writer.option("topic", topic).save()

    return write
