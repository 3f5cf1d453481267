"""Stored tables: timeline and status.

The timeline is Parquet by date of writing. Status is kept as changes, each
naming the micro-batch it came from, and folded when read.
"""

from datetime import datetime, timedelta

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.operators.status import compact_changes, fold_status
from frostline.operators.timeline import retained, upsert_timeline
from frostline.schema import READING_SCHEMA, STATUS_CHANGE_SCHEMA, TIMELINE_TTL_SECONDS

TIMELINE_SCHEMA = T.StructType(
    READING_SCHEMA.fields
    + [T.StructField("ingest_ts", T.TimestampType()), T.StructField("ingest_date", T.DateType())]
)
CHANGES_SCHEMA = T.StructType(
    STATUS_CHANGE_SCHEMA.fields
    + [T.StructField("feed", T.StringType()), T.StructField("batch_id", T.LongType())]
)


def laid_out(timeline: DataFrame) -> DataFrame:
    """Rows clustered by device, newest first, before a write.

    Ranges rather than hashes, so that files cover few devices each and a
    filter on one device skips the others, while a hot device spans many files.
    """
    order = ["ingest_date", "device_id", F.desc("time_ms")]
    return timeline.repartitionByRange(*order).sortWithinPartitions(*order, F.desc("seq"))


def write_timeline(readings: DataFrame, path: str, mode: str = "append") -> None:
    """Upserted readings, with ``ingest_ts`` where they do not carry one."""
    if "ingest_ts" not in readings.columns:
        readings = readings.withColumn("ingest_ts", F.current_timestamp())
    rows = upsert_timeline(readings, extra=("ts", "ingest_ts"))
    dated = rows.withColumn("ingest_date", F.col("ingest_ts").cast("date"))
    laid_out(dated).write.mode(mode).partitionBy("ingest_date").parquet(path)


def read_timeline(
    spark: SparkSession,
    path: str,
    as_of: Column | None = None,
    ttl_seconds: int | None = TIMELINE_TTL_SECONDS,
) -> DataFrame:
    """The timeline as of a time: rows not yet expired, the last write winning.

    Writes are only deduplicated among themselves, so reading does it across
    them. ``ttl_seconds=None`` reads all that is stored, which for a stream's
    timeline is no more than what it retains. Dates that have expired whole are
    not looked at.
    """
    rows = spark.read.schema(TIMELINE_SCHEMA).parquet(path)
    if ttl_seconds is not None:
        rows = retained(rows, as_of, ttl_seconds)
    return upsert_timeline(rows, extra=("ts", "ingest_ts"))


def save_timeline_table(readings: DataFrame, table: str) -> None:
    """S5 as a catalog table, whose old dates :func:`drop_expired` can drop."""
    if "ingest_ts" not in readings.columns:
        readings = readings.withColumn("ingest_ts", F.current_timestamp())
    rows = upsert_timeline(readings, extra=("ts", "ingest_ts"))
    dated = rows.withColumn("ingest_date", F.col("ingest_ts").cast("date"))
    laid_out(dated).write.mode("append").partitionBy("ingest_date").saveAsTable(table)


def drop_expired(
    spark: SparkSession, table: str, as_of: datetime, ttl_seconds: int = TIMELINE_TTL_SECONDS
) -> list[str]:
    """Drop the dates of a catalog table that hold expired rows only."""
    oldest = (as_of - timedelta(seconds=ttl_seconds)).date()
    # One entry per day of history: a bounded list, not rows.
    dates = [p.partition.split("=", 1)[1] for p in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    expired = sorted(d for d in dates if datetime.fromisoformat(d).date() < oldest)
    for day in expired:
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (ingest_date = DATE '{day}')")
    return expired


def drop_expired_files(path: str, as_of: datetime, ttl_seconds: int = TIMELINE_TTL_SECONDS) -> list[str]:
    """Delete the dates of a timeline folder that hold expired rows only.

    For folders written by :func:`write_timeline` and by the stream. Readers with
    the same time to live don't look at these dates any more.
    """
    oldest = (as_of - timedelta(seconds=ttl_seconds)).date()
    dates = {d: p for p in _folders(path) if (d := p.rpartition("ingest_date=")[2]) != p}
    expired = sorted(d for d in dates if datetime.fromisoformat(d).date() < oldest)
    for day in expired:
        _delete(dates[day])
    return expired


def drop_expired_groups(path: str, as_of: datetime, ttl_seconds: int) -> list[str]:
    """Delete the ``batch_id=`` folders of ``path`` all of whose dates hold expired rows only.

    One without rows has no date and goes as well, but for the last.
    """
    oldest = (as_of - timedelta(seconds=ttl_seconds)).date()
    groups = sorted(_folders(path), key=lambda p: int(p.rpartition("=")[2]))
    expired = []
    for group in groups:
        dates = [d for f in _folders(group) if (d := f.rpartition("ingest_date=")[2]) != f]
        empty = not dates and group != groups[-1] and _has_success(group)
        if empty or (dates and all(datetime.fromisoformat(d).date() < oldest for d in dates)):
            expired.append(group)
            _delete(group)
    return expired


def group_dates(path: str) -> dict[str, list[str]]:
    """The dates in the ``batch_id=`` folders of ``path``, each with its folders."""
    found: dict[str, list[str]] = {}
    for group in _folders(path):
        for folder in _folders(group):
            if (day := folder.rpartition("ingest_date=")[2]) != folder:
                found.setdefault(day, []).append(folder)
    return found


def complete_dates(path: str) -> list[str]:
    """The dates of ``path`` whose write has come to its end."""
    found = ((f, f.rpartition("ingest_date=")[2]) for f in _folders(path))
    return sorted(day for folder, day in found if day != folder and _has_success(folder))


def delete_folders(paths: list[str]) -> None:
    for path in paths:
        _delete(path)


def is_complete(path: str) -> bool:
    """Whether a write to a folder has come to its end."""
    return _has_success(path)


# --- status: batches of changes, and snapshots that fold them -----------------
#
# changes/feed=F/batch_id=N     what a micro-batch of a feed changed
# snapshots/version=V           all changes up to a batch of each feed, folded
# folded/version=V              those batches; written last, so V is complete


def write_changes(changes: DataFrame, path: str, feed: str, batch_id: int) -> None:
    """One micro-batch of a feed, folded first to a row per device.

    Writing the same micro-batch again replaces it, so a replay after a failure
    leaves no trace.
    """
    target = f"{path}/changes/feed={feed}/batch_id={batch_id}"
    compact_changes(changes).write.mode("overwrite").parquet(target)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The latest snapshot and the batches it has not folded in."""
    version, folded = _latest_version(spark, path)
    batches = spark.read.schema(CHANGES_SCHEMA).parquet(f"{path}/changes")
    for feed, last in folded.items():
        batches = batches.where((F.col("feed") != feed) | (F.col("batch_id") > last))
    if version is None:
        return batches
    snapshot = spark.read.schema(STATUS_CHANGE_SCHEMA).parquet(f"{path}/snapshots/version={version}")
    return snapshot.withColumns({"feed": F.lit(None).cast("string"), "batch_id": F.lit(None).cast("long")}).unionByName(
        batches
    )


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The status table, a row per device."""
    return fold_status(read_changes(spark, path))


def compact_status(spark: SparkSession, path: str) -> int | None:
    """Fold all complete batches into a new snapshot; returns its version.

    Readers switch to it once it is complete. What the snapshot before had folded
    is deleted now, so a read may take as long as the time between two calls, and
    no read lists more batches than came in two such times. One caller at a time;
    feeds may go on writing meanwhile.
    """
    complete = _complete_batches(path)
    version, folded = _latest_version(spark, path)
    if all(last <= folded.get(feed, -1) for feed, last in complete.items()):
        return version
    changes = read_changes(spark, path)
    for feed, last in complete.items():  # a batch may be half written by now
        changes = changes.where(~F.col("feed").eqNullSafe(F.lit(feed)) | (F.col("batch_id") <= last))
    changes = changes.where(F.col("feed").isNull() | F.col("feed").isin(list(complete)))
    new = 0 if version is None else version + 1
    compact_changes(changes).write.mode("overwrite").parquet(f"{path}/snapshots/version={new}")
    # A row for each feed.
    table = spark.createDataFrame(sorted((folded | complete).items()), "feed string, last long")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/folded/version={new}")
    _delete_folded(path, folded, before_version=version)
    return new


def _latest_version(spark: SparkSession, path: str) -> tuple[int | None, dict[str, int]]:
    done = [p for p in _folders(f"{path}/folded") if _has_success(p)]
    if not done:
        return None, {}
    version = max(int(p.rpartition("=")[2]) for p in done)
    rows = spark.read.parquet(f"{path}/folded/version={version}").collect()  # one for each feed
    return version, {r["feed"]: r["last"] for r in rows}


def _complete_batches(path: str) -> dict[str, int]:
    """The last complete batch of each feed. Batches of a feed come in order."""
    last = {}
    for feed in _folders(f"{path}/changes"):
        numbers = [int(p.rpartition("=")[2]) for p in _folders(feed) if _has_success(p)]
        if numbers:
            last[feed.rpartition("feed=")[2]] = max(numbers)
    return last


def _delete_folded(path: str, folded: dict[str, int], before_version: int | None) -> None:
    for feed, last in folded.items():
        for batch in _folders(f"{path}/changes/feed={feed}"):
            if int(batch.rpartition("=")[2]) <= last:
                _delete(batch)
    for kind in ("snapshots", "folded"):
        for old in _folders(f"{path}/{kind}"):
            if before_version is not None and int(old.rpartition("=")[2]) < before_version:
                _delete(old)


# --- folders of any file system -------------------------------------------------


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in path:
        path = f"file://{path.removeprefix('file:')}"
    return pyarrow.fs.FileSystem.from_uri(path)


def _folders(path: str) -> list[str]:
    fs, inner = _place(path)
    found = fs.get_file_info(pyarrow.fs.FileSelector(inner, allow_not_found=True))
    return [f"{path.rstrip('/')}/{i.base_name}" for i in found if i.type == pyarrow.fs.FileType.Directory]


def _has_success(path: str) -> bool:
    fs, inner = _place(path)
    return fs.get_file_info(f"{inner}/_SUCCESS").type == pyarrow.fs.FileType.File


def _delete(path: str) -> None:
    fs, inner = _place(path)
    fs.delete_dir(inner)
