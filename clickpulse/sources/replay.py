"""Replay a stored events table in the wire shape of the click topics.

The events table (``event_id, ts, user_id, event_type, value, props``)
becomes Kafka-shaped records so the real decode path runs on it:

* clicks: ``timestamp = ts`` (millisecond text), ``page = '/' || event_type``,
  ``userId = 2013000000 + user_id``, ``duration = floor(value)``,
  ``trafficSource`` picked by ``user_id mod 4``; JSON value, no key.
* transactions: ``account_id = user_id mod 5 + 1``, ``amount = floor(value)``,
  ``log_ts = ts`` cut to the second; CSV value, key = account id.

``offset`` is the event id, so ``offset div n`` names the micro-batch a Kafka
source capped at ``n`` offsets per trigger would put the record in.
The mapping is a projection; the work grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.config import ACCOUNTS, CLICK_TIME_PATTERN, DEFAULT_TOPIC, FIRST_USER_ID, TRAFFIC_SOURCES
from clickpulse.functions.encode import click_json, transaction_csv
from clickpulse.sources.storage import hadoop_path


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def traffic_source(user_id: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(s) for s in TRAFFIC_SOURCES]),
        (F.pmod(user_id, F.lit(len(TRAFFIC_SOURCES))) + 1).cast("int"),
    )


def event_time(ts: Column) -> Column:
    """Stored ``TIMESTAMP_NTZ`` -> session ``TIMESTAMP`` (watermarks need it)."""
    return ts.cast("timestamp")


def click_records(events: DataFrame, pattern: str = CLICK_TIME_PATTERN, topic: str = DEFAULT_TOPIC,
                  value_override: Callable[[Column], Column] | None = None) -> DataFrame:
    """Events -> Kafka-shaped click records (JSON value).

    ``value_override`` maps the JSON text column to the value actually sent
    (used to inject malformed records the permissive parser must survive).
    """
    ts = event_time(F.col("ts"))
    text = click_json(
        ts,
        F.concat(F.lit("/"), F.col("event_type")),
        F.lit(FIRST_USER_ID) + F.col("user_id"),
        F.floor(F.col("value")),
        traffic_source(F.col("user_id")),
        pattern,
    )
    if value_override is not None:
        text = value_override(text)
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        ts.alias("timestamp"),
    )


def transaction_records(events: DataFrame, topic: str = "transactions", account: Column | None = None) -> DataFrame:
    """Events -> Kafka-shaped transaction records (CSV value, account key).

    Record time is the event time, as the producer sets it.
    """
    if account is None:
        account = F.pmod(F.col("user_id"), F.lit(ACCOUNTS)) + 1
    log_ts = F.date_trunc("second", event_time(F.col("ts")))
    return events.select(
        account.cast("string").cast("binary").alias("key"),
        transaction_csv(account, F.floor(F.col("value")), log_ts).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        log_ts.alias("timestamp"),
    )


def stage_micro_batches(records: DataFrame, batch: Column, path: str) -> str:
    """Write replayed records so that a file stream with one file per trigger
    takes the values of ``batch`` as its micro-batches, in order.

    Returns the pattern to read. Each value is one file; a file stream goes by
    modification time, so the files' times are set in that order (two calls for
    each micro-batch to come). A store that ignores set times is an error.
    """
    name = "replay_batch"
    records.withColumn(name, batch).repartition(name).write.partitionBy(name).parquet(path)
    store, root = hadoop_path(records.sparkSession, path)
    folders = [f.getPath() for f in store.listStatus(root) if f.getPath().getName().startswith(f"{name}=")]
    folders.sort(key=lambda p: int(p.getName().split("=")[1]))
    first = store.getFileStatus(root).getModificationTime() - 1000 * len(folders)
    for i, folder in enumerate(folders):
        for file in store.listStatus(folder):
            store.setTimes(file.getPath(), first + 1000 * i, -1)
            if abs(store.getFileStatus(file.getPath()).getModificationTime() - first - 1000 * i) >= 1000:
                raise RuntimeError(f"{path} keeps no file times that are set: micro-batches would come in another order")
    return f"{path}/{name}=*"
