"""Start the queries that turn a stream of messages into the stored tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from frostline.schema import TIMELINE_TTL_SECONDS, TRIGGER_INTERVAL
from frostline.sources.messages import decode
from frostline.sources.tables import compact_status, write_changes
from frostline.streaming.feeds import stateful_feeds
from frostline.streaming.previous import WATERMARK_DELAY
from frostline.streaming.shared import QUARANTINE_SECONDS, SINKS, STATUS, Sink, drop_expired_batches, write_sinks

# Micro-batches between two compactions of the status table.
COMPACT_EVERY = 100

SHARED, CHECKPOINTS = "shared", "checkpoints"


def triggered(writer: DataStreamWriter, root: str, name: str, available_now: bool) -> StreamingQuery:
    """Every query has a checkpoint of its own; batches follow a clock."""
    writer = writer.queryName(name).option("checkpointLocation", f"{root}/{CHECKPOINTS}/{name}")
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=TRIGGER_INTERVAL).start()


def append_files(
    stream: DataFrame, root: str, name: str, available_now: bool = False, **options
) -> StreamingQuery:
    """A table of files, to which each micro-batch is committed exactly once."""
    partitions = ["ingest_date"] if "ingest_date" in stream.columns else []
    writer = stream.writeStream.format("parquet").outputMode("append").options(**options)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return triggered(writer.option("path", f"{root}/{name}"), root, name, available_now)


def append_changes(feed: DataFrame, root: str, name: str, available_now: bool = False) -> StreamingQuery:
    """Status changes, folded per micro-batch and replaced when one is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_changes(batch, f"{root}/{STATUS}", name, batch_id)

    return triggered(feed.writeStream.foreachBatch(write), root, f"status-{name}", available_now)


def update_files(updates: DataFrame, root: str, name: str, available_now: bool = False) -> StreamingQuery:
    """Rows that replace earlier ones, in a folder for each micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")

    return triggered(updates.writeStream.outputMode("update").foreachBatch(write), root, name, available_now)


def append_shared(
    messages: DataFrame,
    root: str,
    available_now: bool = False,
    compact_every: int | None = COMPACT_EVERY,
    ttl_seconds: int = TIMELINE_TTL_SECONDS,
    quarantine_seconds: int = QUARANTINE_SECONDS,
    sinks: dict[str, Sink] = SINKS,
) -> StreamingQuery:
    """One query, and one read of the source, for every sink that needs no state.

    ``compact_every`` batches, this query folds the status changes of all feeds and
    drops what has expired; only one query of a folder may do so.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_sinks(batch, batch_id, root, sinks)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_status(batch.sparkSession, f"{root}/{STATUS}")
            drop_expired_batches(root, None, ttl_seconds, quarantine_seconds)

    return triggered(messages.writeStream.foreachBatch(write), root, SHARED, available_now)


def run_streams(
    session: SparkSession,
    messages: Callable[[SparkSession], DataFrame],
    root: str,
    delay: str = WATERMARK_DELAY,
    available_now: bool = False,
    ttl_seconds: int = TIMELINE_TTL_SECONDS,
    groups: int | None = None,
    efficiency: str = "delta",
    compact_every: int = COMPACT_EVERY,
    quarantine_seconds: int = QUARANTINE_SECONDS,
) -> list[StreamingQuery]:
    """Raw messages to timeline, status, quarantine and delays under ``root``.

    ``messages`` makes the source stream (``value``, ``seq``) from a session, for
    example :func:`frostline.sources.kafka.read_kafka_stream`. Use a session of
    :func:`frostline.session.stream_session`. One query reads the source for all
    results without state, one for the door and one for efficiency. Micro-batches
    of the timeline and the quarantine are deleted some time after they expire;
    readers of the timeline apply the exact limit.
    """
    source = messages(session)
    feeds = stateful_feeds(decode(source), delay, groups, efficiency)
    shared = append_shared(source, root, available_now, compact_every, ttl_seconds, quarantine_seconds)
    return [shared, *(append_changes(feed, root, name, available_now) for name, feed in feeds.items())]
