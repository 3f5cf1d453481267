import os
from datetime import datetime

from helpers import readings, tuples
from pyspark.sql import functions as F

import __spark_entry__ as entry
from frostline.operators.status import compact_changes, fold_status, status_changes
from frostline.session import scratch_dir
from frostline.sources import tables
from frostline.sources.events import read_readings

KIND = "device_id string, door_open boolean, defrosted boolean, efficiency double, time_ms long, seq long"


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_status_across_compactions(spark):
    path, all_ = scratch_dir(spark, "status"), []
    versions = []
    for batch in range(7):
        for feed in ("door", "defrost", "efficiency"):
            rows = [
                (f"d{n}", (n + batch) % 2 == 0 if feed == "door" else None, True if feed == "defrost" else None,
                 float(n * batch) if feed == "efficiency" else None, batch * 10 + n, n)
                for n in range(batch, batch + 4)
            ]
            all_ += rows
            tables.write_changes(spark.createDataFrame(rows, KIND), path, feed, batch)
        if batch in (1, 3, 4):
            versions.append(tables.compact_status(spark, path))
        columns = ["device_id", "door_open", "defrosted", "efficiency"]
        want = tuples(fold_status(spark.createDataFrame(all_, KIND)), *columns)
        assert tuples(tables.read_status(spark, path), *columns) == want
    assert versions == [0, 1, 2]
    left = {f for f in os.listdir(f"{local(path)}/changes/feed=door") if not f.startswith(".")}
    assert left == {"batch_id=4", "batch_id=5", "batch_id=6"}  # 0 to 3 were folded a compaction ago
    assert sorted(os.listdir(f"{local(path)}/snapshots")) == ["version=1", "version=2"]
    tables.compact_status(spark, path)
    assert tables.compact_status(spark, path) == 3  # nothing new


def test_a_batch_that_is_not_complete_is_not_folded(spark):
    path = scratch_dir(spark, "status")
    one = spark.createDataFrame([("a", True, None, None, 1, 1)], KIND)
    tables.write_changes(one, path, "door", 0)
    tables.write_changes(one.withColumn("device_id", F.lit("b")), path, "door", 1)
    os.remove(f"{local(path)}/changes/feed=door/batch_id=1/_SUCCESS")
    tables.compact_status(spark, path)
    folder = f"{path}/snapshots/version=0"
    assert tuples(spark.read.parquet(folder), "device_id") == [("a",)]
    assert tuples(tables.read_status(spark, path), "device_id") == [("a",), ("b",)]


def test_expired_dates_are_deleted(spark):
    path = scratch_dir(spark, "timeline")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        at = F.lit(f"{day} 12:00:00").cast("timestamp")
        tables.write_timeline(readings(spark, [(int(day[-1]), 1, 1)]).withColumn("ingest_ts", at), path)
    as_of = datetime(2024, 1, 3, 13)
    assert tables.drop_expired_files(path, as_of) == ["2024-01-01", "2024-01-02"]
    assert tables.drop_expired_files(path, as_of) == []
    kept = tables.read_timeline(spark, path, F.lit("2024-01-03 13:00:00").cast("timestamp"))
    assert tuples(kept, "time_ms") == [(3,)]


def test_catalog_table_without_a_time_of_writing(spark):
    tables.save_timeline_table(readings(spark, [(1, 1, 1), (1, 2, 1)]), "timeline_saved")
    assert tuples(spark.table("timeline_saved"), "time_ms", "temp") == [(1, 2.0)]
    assert tables.drop_expired(spark, "timeline_saved", datetime(2100, 1, 1)) != []
    assert spark.table("timeline_saved").count() == 0


def test_thirds_of_the_change_log_are_worked_out_once(spark, small):
    thirds = entry._changes_in_thirds(spark, small)
    for third in thirds:
        plan = third._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange" not in plan
    changes = status_changes(read_readings(spark, small))
    for batch, third in enumerate(thirds):
        want = compact_changes(changes.where(F.pmod("time_ms", F.lit(3)) == batch))
        assert third.columns == want.columns
        assert sorted(map(repr, third.collect())) == sorted(map(repr, want.collect()))
