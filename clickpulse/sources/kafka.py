"""Kafka sources and sinks by name, with a file stand-in of the same shape.

The Kafka connector jar is not bundled; ``read_kafka`` / ``kafka_writer``
only configure Spark's own ``kafka`` data source, so they work wherever
the cluster provides it. Tests replay records through
``read_record_files`` instead, which yields the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from clickpulse.schemas import KAFKA_RECORD_SCHEMA


def kafka_source_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                         starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                         min_partitions: int | None = None, fail_on_data_loss: bool = True,
                         extra: dict | None = None) -> dict:
    """Options of Spark's Kafka source.

    ``min_partitions`` splits large topic partitions into several Spark
    tasks, so a hot key (all its records land in one topic partition) is
    read by many tasks. ``fail_on_data_loss`` stays on: offsets that expired
    before they were read fail the query instead of silently losing rows.
    A restart resumes at the checkpoint's offsets, not at ``startingOffsets``.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra or {})
    return opts


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str, **kw) -> DataFrame:
    """Subscribe one topic: key/value/topic/partition/offset/timestamp rows."""
    return spark.readStream.format("kafka").options(**kafka_source_options(bootstrap_servers, topic, **kw)).load()


def starting_offsets(asked: str | None, available_now: bool) -> str:
    """``latest`` for a query that stays; a query that drains the topic and
    stops would find nothing there, so it starts at ``earliest``."""
    return asked or ("earliest" if available_now else "latest")


def read_record_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream Kafka-shaped records from Parquet files (test stand-in)."""
    reader = spark.readStream.schema(KAFKA_RECORD_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def to_records(df: DataFrame, value: str = "value", key: str | None = None) -> DataFrame:
    """Frame with a text ``value`` (and optional ``key``) -> binary key/value."""
    k = F.col(key).cast("string").cast("binary") if key else F.lit(None).cast("binary")
    return df.select(k.alias("key"), F.col(value).cast("binary").alias("value"))


def kafka_writer(df: DataFrame, bootstrap_servers: str, topic: str) -> DataStreamWriter:
    """Writer of key/value rows to a topic (JSON click / statistics sinks)."""
    return (df.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic))
