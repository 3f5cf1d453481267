"""One read of the source for all results that need no state.

Each micro-batch is decoded once and kept while every sink writes what it needs.
A sink has a folder for each micro-batch, whose ``_SUCCESS`` file, written last,
records that this sink is done with it. A micro-batch that is replayed after a
failure anywhere skips the sinks that are done and writes the others anew.
"""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.operators.defrost import defrost_events
from frostline.operators.latency import SKETCH_COLUMNS, latency_sketch, merged_latency
from frostline.operators.status import as_changes, compact_changes
from frostline.schema import TIMELINE_TTL_SECONDS
from frostline.sources import tables
from frostline.sources.messages import accepted, parse, rejected

TIMELINE, QUARANTINE, LATENCY, STATUS = "timeline", "quarantine", "latency", "status"
DEFROST = f"{STATUS}/changes/feed=defrost"
QUARANTINE_SECONDS = 30 * 86_400
LATENCY_SCHEMA = "readings bigint, min_ms bigint, max_ms bigint, sum_ms bigint, sketch binary, ingest_date date"

# Takes a decoded micro-batch and the folder to write it to.
Sink = Callable[[DataFrame, str], None]


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ingest_date", F.current_date())


def write_history(parsed: DataFrame, target: str) -> None:
    """Every reading, late or not, stamped with its time of writing."""
    rows = _dated(accepted(parsed).withColumn("ingest_ts", F.current_timestamp()))
    rows.write.mode("overwrite").partitionBy("ingest_date").parquet(target)


def write_rejected(parsed: DataFrame, target: str) -> None:
    """S3: the messages that are no readings."""
    _dated(rejected(parsed)).write.mode("overwrite").partitionBy("ingest_date").parquet(target)


def write_defrost(parsed: DataFrame, target: str) -> None:
    """The micro-batch's defrost flags, as status changes."""
    changes = compact_changes(as_changes(defrost_events(accepted(parsed))))
    changes.write.mode("overwrite").parquet(target)


def write_latency(parsed: DataFrame, target: str) -> None:
    """One row, the sketch of the micro-batch's delays."""
    now = F.unix_millis(F.current_timestamp())
    sketch = latency_sketch(accepted(parsed).withColumn("ingest_ms", now)).select(*SKETCH_COLUMNS)
    _dated(sketch).write.mode("overwrite").partitionBy("ingest_date").parquet(target)


SINKS: dict[str, Sink] = {
    TIMELINE: write_history,
    QUARANTINE: write_rejected,
    DEFROST: write_defrost,
    LATENCY: write_latency,
}


def write_sinks(messages: DataFrame, batch_id: int, root: str, sinks: dict[str, Sink] = SINKS) -> list[str]:
    """Write one micro-batch of messages to all sinks that are not done with it; returns these."""
    parsed = parse(messages).persist()
    written = []
    try:
        for name, sink in sinks.items():
            target = f"{root}/{name}/batch_id={batch_id}"
            if not tables.is_complete(target):
                sink(parsed, target)
                written.append(name)
    finally:
        parsed.unpersist()
    return written


def drop_expired_batches(
    root: str,
    as_of: datetime | None = None,
    ttl_seconds: int = TIMELINE_TTL_SECONDS,
    quarantine_seconds: int = QUARANTINE_SECONDS,
) -> list[str]:
    """Delete the micro-batches of which every date has expired."""
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    dropped = []
    for name, seconds in ((TIMELINE, ttl_seconds), (LATENCY, ttl_seconds), (QUARANTINE, quarantine_seconds)):
        dropped += tables.drop_expired_groups(f"{root}/{name}", as_of, seconds)
    return dropped


def read_latency(spark: SparkSession, root: str, first_batch: int | None = None, last_batch: int | None = None) -> DataFrame:
    """Delays of a running stream's micro-batches, all or a span of them, as one row."""
    rows = spark.read.schema(LATENCY_SCHEMA + ", batch_id bigint").parquet(f"{root}/{LATENCY}")
    if first_batch is not None:
        rows = rows.where(F.col("batch_id") >= first_batch)
    if last_batch is not None:
        rows = rows.where(F.col("batch_id") <= last_batch)
    return merged_latency(rows)
