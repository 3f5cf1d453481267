"""The stream's timeline rewritten by device, and what a lookup reads of it."""

import os
from datetime import date

import pytest
from helpers import readings, tuples
from pyspark.sql import functions as F

from frostline.operators.timeline import TIMELINE_COLUMNS, upsert_timeline
from frostline.session import scratch_dir
from frostline.streaming import clustered, shared

DAY = 86_400_000
LATER = date(2200, 1, 1)
# Small row groups, and plain pages, so that the filters alone tell the ids apart.
SMALL = {"parquet.block.size": "20000", "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": "100"}


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def rows_of_devices(devices, each=20):
    """Even numbers, so that odd ones lie within the range of the ids and are not there."""
    return [(f"d{2 * (n % devices):06d}", n * 1000, n % 9, 0.1) for n in range(devices * each)]


@pytest.fixture
def written(spark):
    """Readings as a stream writes them, in micro-batches of two dates of writing."""
    folder, all_ = scratch_dir(spark, "clustered"), readings(spark, rows_of_devices(300))
    for n, day in enumerate(["2024-01-01", "2024-01-01", "2024-01-02"]):
        part = all_.where(F.col("seq") % 3 == n)
        stamped = part.withColumn("ingest_ts", F.lit(f"{day} 10:00:00").cast("timestamp")).withColumn(
            "ingest_date", F.lit(day).cast("date")
        )
        stamped.write.partitionBy("ingest_date").parquet(f"{folder}/{shared.TIMELINE}/batch_id={n}")
    return folder, all_


def whole(spark, folder):
    return tuples(clustered.read_stream_timeline(spark, folder, ttl_seconds=None), *TIMELINE_COLUMNS)


def test_readers_see_the_whole_at_every_step(spark, written):
    folder, all_ = written
    want = tuples(upsert_timeline(all_), *TIMELINE_COLUMNS)
    assert whole(spark, folder) == want
    assert clustered.cluster_closed_dates(spark, folder, date(2024, 1, 2)) == ["2024-01-01"]
    assert whole(spark, folder) == want  # one date both ways, one as written
    # A rewrite that has not come to its end does not count.
    assert clustered.cluster_closed_dates(spark, folder, LATER) == ["2024-01-02"]
    os.remove(f"{local(folder)}/{clustered.CLUSTERED}/ingest_date=2024-01-02/_SUCCESS")
    assert whole(spark, folder) == want
    assert clustered.cluster_closed_dates(spark, folder, LATER) == ["2024-01-02"]
    assert whole(spark, folder) == want
    # A call after, what the stream wrote of these dates is gone.
    assert clustered.cluster_closed_dates(spark, folder, LATER) == []
    left = [d for _, dirs, _ in os.walk(f"{local(folder)}/{shared.TIMELINE}") for d in dirs if d.startswith("ingest_date")]
    assert left == [] and whole(spark, folder) == want


def scanned(frame):
    """Rows that the scans of a query have given, after row groups were skipped."""
    found = frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return found, sum(s.metrics().apply("numOutputRows").value() for s in scans)


def test_a_lookup_skips_row_groups(spark, written):
    folder, all_ = written
    clustered.cluster_closed_dates(spark, folder, LATER, **SMALL)
    clustered.cluster_closed_dates(spark, folder, LATER)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = all_.count()
        found, read = scanned(clustered.latest_stored_reading(spark, folder, "d000100"))
        assert len(found) == 1 and 0 < read < rows / 4
        # An id between others: no range rules it out, the Bloom filters do.
        none, read = scanned(clustered.latest_stored_reading(spark, folder, "d000101"))
        assert none == [] and read < rows / 40
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_retention_holds_for_clustered_dates(spark, written):
    folder, _ = written
    clustered.cluster_closed_dates(spark, folder, LATER)
    as_of = F.lit("2024-01-02 11:00:00").cast("timestamp")
    kept = clustered.read_stream_timeline(spark, folder, as_of)
    assert kept.count() == 2000 and kept.where("ingest_ts < '2024-01-02'").count() == 0
