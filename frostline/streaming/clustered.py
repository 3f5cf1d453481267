"""The stream's timeline, clustered by device once its dates are over.

A stream writes readings as they come, so each of its files has all devices. When a
date is over, its readings are rewritten in ranges of devices, newest first in each,
with Parquet's Bloom filters on the device. Looking up one device then reads the row
groups that may hold it, and skips the others.

A rewritten date counts once its folder has a ``_SUCCESS`` file. Until then readers
take the date as the stream wrote it; between then and the next call they find it
both ways, and as equal keys are one reading, see it once. What the stream wrote of
a date is deleted a call after its rewrite, so a read may take as long as the time
between two calls.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.operators.timeline import latest_of_device, retained, upsert_timeline
from frostline.schema import TIMELINE_TTL_SECONDS
from frostline.sources import tables
from frostline.streaming.shared import TIMELINE

CLUSTERED = "timeline-clustered"
# Devices that a Bloom filter of a row group is made for.
DEVICES_PER_FILTER = 20_000


def cluster_closed_dates(
    spark: SparkSession, root: str, today: date, devices_per_filter: int = DEVICES_PER_FILTER, **options
) -> list[str]:
    """Rewrite the dates before ``today`` that are not yet clustered; returns them.

    One caller at a time. ``options`` go to the Parquet writer.
    """
    done = set(tables.complete_dates(f"{root}/{CLUSTERED}"))
    written = tables.group_dates(f"{root}/{TIMELINE}")
    closed = sorted(d for d in written if date.fromisoformat(d) < today)
    for day in closed:
        if day in done:  # by an earlier call, so nobody reads the stream's files any more
            tables.delete_folders(written[day])
    fresh = [d for d in closed if d not in done]
    for day in fresh:
        rows = upsert_timeline(_as_written(spark, root).where(F.col("ingest_date") == day), extra=("ts", "ingest_ts"))
        order = ["device_id", F.desc("time_ms"), F.desc("seq")]
        laid_out = rows.repartitionByRange("device_id", F.desc("time_ms")).sortWithinPartitions(*order)
        writer = laid_out.write.mode("overwrite").options(**options)
        writer = writer.option("parquet.bloom.filter.enabled#device_id", "true")
        writer = writer.option("parquet.bloom.filter.expected.ndv#device_id", devices_per_filter)
        writer.parquet(f"{root}/{CLUSTERED}/ingest_date={day}")
    return fresh


def _as_written(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(tables.TIMELINE_SCHEMA).parquet(f"{root}/{TIMELINE}").drop("batch_id")


def stored_readings(spark: SparkSession, root: str) -> DataFrame:
    """All that is stored, in the columns of the timeline; a reading may come twice."""
    rows = _as_written(spark, root)
    days = tables.complete_dates(f"{root}/{CLUSTERED}")
    if not days:
        return rows
    folders = [f"{root}/{CLUSTERED}/ingest_date={d}" for d in days]
    clustered = spark.read.schema(tables.TIMELINE_SCHEMA).option("basePath", f"{root}/{CLUSTERED}").parquet(*folders)
    # What is there both ways is read from the clustered files.
    return rows.where(~F.col("ingest_date").isin([date.fromisoformat(d) for d in days])).unionByName(clustered)


def read_stream_timeline(
    spark: SparkSession, root: str, as_of: Column | None = None, ttl_seconds: int | None = TIMELINE_TTL_SECONDS
) -> DataFrame:
    """The stream's timeline as of a time; see :func:`frostline.sources.tables.read_timeline`."""
    rows = stored_readings(spark, root)
    if ttl_seconds is not None:
        rows = retained(rows, as_of, ttl_seconds)
    return upsert_timeline(rows, extra=("ts", "ingest_ts"))


def latest_stored_reading(spark: SparkSession, root: str, device_id: str) -> DataFrame:
    """V3 over the stream's timeline: the filter on the device reaches every scan."""
    return latest_of_device(stored_readings(spark, root), device_id)
