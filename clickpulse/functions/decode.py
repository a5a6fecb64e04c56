"""Wire form -> columns: Kafka value bytes to parsed clicks / transactions.

All decoding is built-in expressions (``from_json``, ``from_csv``,
``try_to_timestamp``): it runs in the JVM next to the scan, with no Python
and no per-row round trip, and each record is parsed exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.config import CLICK_TIME_PATTERN, TRANSACTION_TIME_PATTERN
from clickpulse.schemas import CLICK_TYPED_DDL, CLICK_WIRE_SCHEMA, TRANSACTION_DDL

CLICK_FIELDS = ("timestamp", "page", "userId", "duration", "trafficSource")


def _fields(df: DataFrame, parsed: Column, keep: tuple[str, ...]) -> DataFrame:
    """Expand a parsed struct into columns, parsing each record once.

    The fields come out of a generator (``inline`` over a one-element
    array). A filter on them (``window()`` adds ``isnotnull(timestamp)``)
    then stays above the parse instead of being pushed below it with a
    second copy of ``from_json``. A null struct still yields one row of
    nulls, so no record is lost.
    """
    return df.select(*keep, F.inline(F.array(parsed)))


def value_as_string(value: Column | str = "value") -> Column:
    """Binary record value -> UTF-8 text."""
    c = F.col(value) if isinstance(value, str) else value
    return c.cast("string")


def parse_clicks(df: DataFrame, pattern: str = CLICK_TIME_PATTERN, value_col: str = "value",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Permissive decode of click JSON, as the speed layer does it.

    Every field is read as text (numbers become their text, nested objects
    their JSON text); bad JSON, arrays, empty and null values give five
    nulls; an event time that does not match ``pattern`` gives a null
    timestamp instead of an error (``try_to_timestamp`` under ANSI mode).
    ``keep`` lists input columns carried through (e.g. ``offset``).
    """
    parsed = F.from_json(value_as_string(value_col), CLICK_WIRE_SCHEMA)
    return _fields(df, parsed, keep).select(
        *keep,
        F.try_to_timestamp(F.col("timestamp"), F.lit(pattern)).alias("timestamp"),
        *CLICK_FIELDS[1:],
    )


def parse_clicks_strict(df: DataFrame, pattern: str = CLICK_TIME_PATTERN, value_col: str = "value",
                        keep: tuple[str, ...] = ()) -> DataFrame:
    """Strict typed decode of click JSON (the page-visit job's decoder).

    ``FAILFAST`` fails the query on a malformed record instead of yielding
    nulls, and so do an empty and a null value, and a record with a key that a
    click does not have. A key may be missing; its field is then null.
    """
    text = value_as_string(value_col)
    blank = text.isNull() | (F.trim(text) == "")
    unknown = F.array_except(F.json_object_keys(text), F.array(*map(F.lit, CLICK_FIELDS)))
    fail = lambda message: F.raise_error(message).cast("string")
    checked = (F.when(blank, fail(F.lit("click record is empty")))
               .when(F.size(unknown) > 0, fail(F.concat(F.lit("click record has unknown keys: "), F.array_join(unknown, ", "))))
               .otherwise(text))
    parsed = F.from_json(checked, CLICK_TYPED_DDL, {"mode": "FAILFAST", "timestampFormat": pattern})
    return _fields(df, parsed, keep)


def parse_transactions(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = (),
                       pattern: str = TRANSACTION_TIME_PATTERN) -> DataFrame:
    """CSV ``account_id, amount, yyyy-MM-dd HH:mm:ss`` -> typed columns.

    The writer puts a blank after each comma, so leading white space must be
    ignored or ``amount`` reads as null. Bad fields become nulls.
    """
    parsed = F.from_csv(
        value_as_string(value_col),
        TRANSACTION_DDL,
        {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
         "timestampFormat": pattern, "mode": "PERMISSIVE"},
    ).alias("tx")
    return df.select(*keep, parsed).select(*keep, "tx.account_id", "tx.amount", "tx.log_ts")
