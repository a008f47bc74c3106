"""Stream sources: Kafka JSON topics and a JSON file stand-in.

Both give a frame of the raw JSON text in ``value``; ``parse_events`` turns
it into typed columns plus a TIMESTAMP event time and routes records that
fail to parse (bad JSON or bad time text) to a dead-letter frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cairn.functions.dates import parse_iso_millis

# Record layouts of the reference's two topics (all fields are text).
AGGREGATION_EVENT = StructType(
    [StructField(n, StringType()) for n in ("ip", "event_time", "referrer", "host", "url", "geodata")]
)
ENRICHMENT_EVENT = StructType(
    [StructField(n, StringType()) for n in ("url", "referrer", "user_agent", "host", "ip", "headers", "event_time")]
)


def kafka_options(servers: str, topic: str, group_id: str | None = None, username: str | None = None,
                  password: str | None = None, starting_offsets: str = "latest",
                  fail_on_data_loss: bool = True) -> dict:
    """Options for ``readStream.format('kafka')`` (SASL_SSL/PLAIN when a
    username is given). The Kafka connector jar must be on the classpath.
    Offsets that have expired fail the query unless the caller allows the
    loss with ``fail_on_data_loss=False``."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if username:
        opts.update(
            {
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config": (
                    "org.apache.kafka.common.security.plain.PlainLoginModule required "
                    f'username="{username}" password="{password}";'
                ),
            }
        )
    return opts


def kafka_json_stream(spark: SparkSession, **options) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def json_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Each line of the text files under ``path`` is one JSON record."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def parse_records(raw: DataFrame, schema: StructType, time_field: str = "event_time",
                  ts_name: str = "event_timestamp") -> DataFrame:
    """Typed fields, ``ts_name``, the raw text and a reason: NULL for good
    records, else why the record is a dead letter."""
    corrupt = "_corrupt_record"
    with_corrupt = StructType(schema.fields + [StructField(corrupt, StringType())])
    parsed = raw.select(
        "value",
        F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("r"),
    )
    broken = F.col("r").isNull() | F.col(f"r.{corrupt}").isNotNull()
    fields = [F.col(f"r.{f.name}").alias(f.name) for f in schema.fields]
    typed = parsed.select("value", *fields, parse_iso_millis(F.col(f"r.{time_field}")).alias(ts_name), broken.alias("_broken"))
    reason = F.when(F.col("_broken"), "unparsable_json").when(F.col(ts_name).isNull(), "bad_event_time")
    return typed.withColumn("reason", reason).drop("_broken")


def parse_events(raw: DataFrame, schema: StructType, time_field: str = "event_time",
                 ts_name: str = "event_timestamp") -> tuple[DataFrame, DataFrame]:
    """(good, dead_letter): good rows have typed fields and ``ts_name``;
    dead-letter rows keep the raw text and a reason."""
    records = parse_records(raw, schema, time_field, ts_name)
    good = records.where("reason IS NULL").select(*schema.fieldNames(), ts_name)
    return good, records.where("reason IS NOT NULL").select("value", "reason")


def events_as_json(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Render web events as the topic's JSON records (``value`` column) beside
    the columns ``keep``; used to feed the file stand-in and as the Kafka sink
    payload."""
    return events.select(
        *(keep or []),
        F.to_json(
            F.struct(
                "ip",
                F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"),
                "referrer",
                "host",
                "url",
                F.lit(None).cast("string").alias("geodata"),
            )
        ).alias("value"),
    )


def enrichment_records(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Web events as the enrichment topic's JSON records (``value``) beside
    the columns ``keep``."""
    return events.select(
        *(keep or []),
        F.to_json(
            F.struct(
                "url",
                "referrer",
                F.lit(None).cast("string").alias("user_agent"),
                "host",
                "ip",
                F.lit(None).cast("string").alias("headers"),
                F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"),
            )
        ).alias("value"),
    )
