"""Session helpers: a local session for tests/bench and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[int, str] = {}  # sessions without a SparkContext (local only)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clickpulse") -> SparkSession:
    """A local session for tests and the bench (clusters bring their own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLICKPULSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.schemaInference", "false")
        # timestamps with min/max statistics (legacy INT96 has none), so a
        # filter on window times can skip row groups of older micro-batches
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Work tables and streaming checkpoints of the query catalogue live under
    it, so they survive the loss of an executor. Only a local master without
    that setting (tests, the bench) gets a fresh temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            base = _LOCAL_ROOTS.get(id(spark))
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # local runs only; spark.checkpoint.dir cannot be set on a running
        # session, so the folder is registered as the context's checkpoint dir
        base = tempfile.mkdtemp(prefix="clickpulse-")
        try:
            spark.sparkContext.setCheckpointDir(base)
            base = spark.sparkContext.getCheckpointDir() or base
        except Exception:
            _LOCAL_ROOTS[id(spark)] = base
    return base.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared root for one run of one job."""
    return f"{shared_root(spark)}/clickpulse/{name}-{uuid.uuid4().hex[:12]}"


def stable_dir(spark: SparkSession, name: str) -> str:
    """A fixed folder below the shared root (a restarted query finds its
    checkpoint there again)."""
    return f"{shared_root(spark)}/clickpulse/{name}"


def materialize(df, name: str):
    """Write ``df`` once to a fresh folder below the shared root and read it
    back: later actions reuse the written rows instead of recomputing the
    lineage, and the rows survive the loss of an executor."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
