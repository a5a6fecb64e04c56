"""Entity schemas and the schema assertion used on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Wire schema of a click as the speed layer reads it: every field as text.
CLICK_WIRE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("duration", T.StringType()),
        T.StructField("trafficSource", T.StringType()),
    ]
)

# Typed click as the strict decoder of the page-visit job sees it.
CLICK_TYPED_DDL = "timestamp TIMESTAMP, page STRING, userId BIGINT, duration BIGINT, trafficSource STRING"

WINDOW_TYPE = T.StructType(
    [T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType())]
)

# Speed view row: window counts per (window, page, trafficSource).
SPEED_SCHEMA = T.StructType(
    [
        T.StructField("window", WINDOW_TYPE),
        T.StructField("page", T.StringType()),
        T.StructField("trafficSource", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)

# Batch report row (report_date is the partition column).
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("page", T.StringType()),
        T.StructField("trafficSource", T.StringType()),
        T.StructField("sum_count", T.LongType()),
    ]
)

TRANSACTION_DDL = "account_id BIGINT, amount INT, log_ts TIMESTAMP"

SPEND_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.LongType(), False),
        T.StructField("log_ts", T.TimestampType(), False),
        T.StructField("amount", T.LongType(), False),
    ]
)

# Shape of a Kafka record as Spark's Kafka source yields it; the file
# stand-in used in tests carries the same columns.
KAFKA_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType, *, allow_extra: bool = True) -> DataFrame:
    """Check that ``df`` has every field of ``expected`` with the same type.

    Runs on the driver against the plan's schema only (no job). Nullability
    is not compared: files written by Spark always read back as nullable.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in actual:
            problems.append(f"missing column {f.name!r}")
        elif actual[f.name] != f.dataType:
            problems.append(f"column {f.name!r} is {actual[f.name].simpleString()}, expected {f.dataType.simpleString()}")
    if not allow_extra:
        extra = set(actual) - {f.name for f in expected.fields}
        if extra:
            problems.append(f"unexpected columns {sorted(extra)}")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
