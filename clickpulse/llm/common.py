"""Helpers shared by the operators: inputs, row keys, free column names."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.session import fresh_dir
from clickpulse.sources.storage import hadoop_path

#: Java and RE2 spelling of a run of characters other than ASCII white space.
NON_SPACE = r"[^\x20\x09-\x0D]+"
#: A side up to this many bytes may be broadcast, after its size was checked.
BROADCAST_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage,
    and the rows survive the loss of an executor."""
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of the shared store."""
    store, found = hadoop_path(spark, path)
    stream = store.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place, whole and only if there is none of its name:
    it is written beside and renamed, which fails where the name is taken."""
    store, found = hadoop_path(spark, path)
    if store.exists(found):
        return False
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(found.getParent(), f"_{uuid.uuid4().hex}")
    stream = store.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    none = spark._sc._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        hadoop.FileContext.getFileContext(found.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, found, none)
    except Py4JJavaError as e:
        store.delete(draft, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def free_name(columns: Iterable[str], base: str) -> str:
    """``base``, with underscores added until no column has that name
    (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def row_key(*parts: Column) -> list[Column]:
    """Two 64-bit hashes over the columns: a row's identity by its content.

    Rows that agree in all ``parts`` share the key, so repeated rows and null
    ids need no special case: whatever is found for one holds for all.
    Nulls are marked, as Spark's hash skips them.
    """
    marked = [x for p in parts for x in (p.isNull(), p)]
    return [F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *reversed(marked))]


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(NON_SPACE)), F.lit(0)).cast("long")


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` surely fits a broadcast: its rows are counted first."""
    return df.count() * row_bytes <= limit


def maybe_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast only where its counted size is bounded;
    beyond that the join shuffles both sides."""
    return F.broadcast(df) if small(df, row_bytes, limit) else df
