"""Fixture builders shared by the tests (rows as in FIXTURES.md)."""

import datetime as dt

from clickpulse.schemas import KAFKA_RECORD_SCHEMA


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def records(spark, values, start_offset=0, keys=None):
    """Kafka-shaped records from a list of text values (None = null value)."""
    rows = []
    for i, v in enumerate(values):
        k = None if keys is None else (None if keys[i] is None else str(keys[i]).encode())
        rows.append((k, None if v is None else v.encode(), "input", 0, start_offset + i, None))
    return spark.createDataFrame(rows, KAFKA_RECORD_SCHEMA)


def click(time_text, page="/shop", user=2013000001, duration=17, source="google.com"):
    return ('{"timestamp":"%s","page":"%s","userId":%d,"duration":%d,"trafficSource":"%s"}'
            % (time_text, page, user, duration, source))
