"""Job parameters with the meanings and defaults of the original jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the original jobs' settings.
DEFAULT_TOPIC = "input"
DEFAULT_GROUP_ID = "click-event-count"
# Page visits read the same topic on their own: two queries of one group would
# each get only part of its records.
VISITS_GROUP_ID = "click-page-visits"
DEFAULT_WINDOW_SECONDS = 10
DEFAULT_WATERMARK_SECONDS = 60
DEFAULT_TRIGGER_SECONDS = 5
PAGE_STATS_WINDOW_SECONDS = 15
OUT_OF_ORDERNESS_MS = 200
TOP_ROWS = 30
# Pattern the speed layer parses with (24-hour clock).
CLICK_TIME_PATTERN = "dd-MM-yyyy HH:mm:ss:SSS"
# Pattern the click generator and the statistics encoder write (12-hour
# clock without an AM/PM marker, so the half of the day is lost).
CLICK_TIME_PATTERN_12H = "dd-MM-yyyy hh:mm:ss:SSS"
TRANSACTION_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
SPEND_BAND_RED_FROM = 80
# Domains of the click and transaction producers.
TRAFFIC_SOURCES = ("google.com", "yandex.ru", "youtube.com", "vk.com")
FIRST_USER_ID = 2013000000
ACCOUNTS = 5


@dataclass(frozen=True)
class LayerConfig:
    """Parameters of the speed and batch layers.

    Paths are any Spark/Hadoop URI (``hdfs://``, ``s3a://``, ``file:/``).
    ``speed_mode`` selects how window counts leave the speed layer:

    * ``"partials"`` — every micro-batch is aggregated on its own and written
      to ``<speed_path>/batch_id=<n>`` (a retry overwrites its own folder);
      no row is ever dropped, readers re-aggregate.
    * ``"final"`` — a watermarked streaming aggregation in append mode: one
      row per window once the watermark passes its end, late rows dropped.
    * ``"update"`` — the same aggregation in update mode: each micro-batch
      stores the windows that it changed, readers take the newest.
    """

    topic: str = DEFAULT_TOPIC
    kafka_bootstrap_servers: str = "localhost:29092"
    speed_path: str | None = None  # required: a folder that the whole cluster shares
    # None: a stable folder below spark.checkpoint.dir (see session.stable_dir)
    streaming_checkpoint: str | None = None
    window_seconds: int = DEFAULT_WINDOW_SECONDS
    watermark_seconds: int = DEFAULT_WATERMARK_SECONDS
    trigger_seconds: int = DEFAULT_TRIGGER_SECONDS
    time_pattern: str = CLICK_TIME_PATTERN
    speed_mode: str = "partials"
    # Sink of the raw parsed clicks: a data source name plus its options
    # (e.g. the wide-column connector with keyspace/table); parquet in tests.
    raw_format: str = "parquet"
    # Raw rows carry the record's topic, partition and offset, so that a retried
    # batch adds no second copy to a table that only takes appends.
    raw_identity: bool = False
    # Final mode: folder of the counts per micro-batch, which late rows are
    # corrected from (plans.corrections).
    partials_path: str | None = None
    raw_options: dict = field(default_factory=dict)
    raw_path: str | None = None
    # Upper bound of files per speed-view write (the original job used 10).
    # None lets AQE size the output partitions, so a large micro-batch is
    # not squeezed into a few tasks.
    max_speed_files: int | None = None
    # Partials mode: offsets of a stored micro-batch, if a trigger takes several of
    # them (a replay, one topic partition). Each is stored under its own id, offset
    # div batch_offsets; none may be cut by two triggers. None: one per trigger.
    batch_offsets: int | None = None

    def __post_init__(self):
        if not self.speed_path:
            raise ValueError("speed_path is required")
        if self.speed_mode not in ("partials", "final", "update"):
            raise ValueError(f"speed_mode must be 'partials', 'final' or 'update', got {self.speed_mode!r}")
        if self.window_seconds <= 0 or self.watermark_seconds < 0:
            raise ValueError("window must be positive and watermark non-negative")
        if self.batch_offsets is not None and (self.batch_offsets <= 0 or self.speed_mode != "partials"):
            raise ValueError("batch_offsets must be positive and is for mode 'partials' only")
