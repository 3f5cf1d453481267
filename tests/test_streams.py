"""Streams of several micro-batches, with late rows, and restarted."""

import random

import pytest
from helpers import readings, tuples
from pyspark.sql import functions as F

from frostline.operators.efficiency import efficiency_delta, efficiency_rolling
from frostline.operators.pattern import door_alerts, rising_pairs
from frostline.operators.status import fold_status
from frostline.operators.work import work_windows
from frostline.schema import READING_SCHEMA
from frostline.session import ROCKSDB, STATE_MB, scratch_dir, stream_session, write_buffer_mb
from frostline.sources.replay import replay_stream
from frostline.sources.tables import read_changes, write_changes
from frostline.streaming import bounded, feeds
from frostline.streaming.run import append_files

T0 = 1_704_067_200_000


def random_readings(spark, n=300, seed=1):
    rng = random.Random(seed)
    now, rows = T0, []
    for _ in range(n):
        now += rng.choice([0, 0, 300, 900, 4000])  # ties too
        rows.append((rng.choice("abc"), now, rng.randint(-5, 5), rng.randint(1, 50) / 100))
    return readings(spark, rows)


def streamed(spark, path, result, folder):
    session = stream_session(spark)
    out = result(replay_stream(session, path, READING_SCHEMA, files_per_trigger=1))
    append_files(out, folder, "out", available_now=True).awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out").where(F.col("device_id") != bounded.END_DEVICE)


def test_door_alerts_with_ties_late_rows_and_a_restart(spark):
    all_ = random_readings(spark)
    low, high = all_.agg(F.min("time_ms"), F.max("time_ms")).first()
    late = (F.col("seq") % 5 == 0) & ((F.col("time_ms") - low) * 4 < high - low + 1)
    on_time = all_.where(~late)
    folder = scratch_dir(spark, "door")
    own = F.call_function("div", (F.col("time_ms") - low) * 4, F.lit(high - low + 1))
    slices = all_.withColumn("slice_", F.when(late, 3).otherwise(own)).cache()
    path = f"{folder}/readings"
    for n in range(2):
        slices.where(F.col("slice_") == n).drop("slice_").coalesce(1).write.mode("append").parquet(path)
    first = streamed(spark, path, feeds.door_stream, folder).count()
    for n in range(2, 4):  # the same query, from its checkpoint
        slices.where(F.col("slice_") == n).drop("slice_").coalesce(1).write.mode("append").parquet(path)
    bounded.end_marker(spark).coalesce(1).write.mode("append").parquet(path)
    got = streamed(spark, path, feeds.door_stream, folder)
    columns = ["device_id", "time_ms", "seq", "door_open"]
    assert 0 < first < got.count()
    assert tuples(got, *columns) == tuples(door_alerts(rising_pairs(on_time)), *columns)


def test_windows_over_several_batches(spark):
    all_ = random_readings(spark, n=120, seed=2)
    folder = scratch_dir(spark, "windows")
    assert bounded.write_slices(all_, f"{folder}/readings") == 1
    got = streamed(spark, f"{folder}/readings", feeds.windows_stream, folder)
    columns = ["device_id", "window_end_ms", "temp", "work"]
    assert tuples(got, *columns) == tuples(work_windows(all_), *columns)


@pytest.mark.parametrize("bucket_slides", [1, 7, 10, 45])
def test_windows_by_panes_of_any_bucket(spark, bucket_slides):
    all_ = random_readings(spark, n=80, seed=bucket_slides)
    got = bounded.run_over(all_, lambda r: feeds.windows_stream(r, bucket_slides=bucket_slides), "buckets")
    columns = ["device_id", "window_end_ms", "temp", "work"]
    assert tuples(got, *columns) == tuples(work_windows(all_), *columns)


def test_state_holds_panes_and_not_readings_of_every_window(spark):
    rows = [("ab"[n % 2], T0 + n * 20, n % 7, 0.1) for n in range(2000)]  # 25 readings in a pane
    folder = scratch_dir(spark, "panes")
    all_ = readings(spark, rows)
    bounded.write_slices(all_, f"{folder}/readings")
    session = stream_session(spark)
    out = feeds.windows_stream(replay_stream(session, f"{folder}/readings", READING_SCHEMA))
    query = append_files(out, folder, "out", available_now=True)
    query.awaitTermination()
    updated = sum(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"])
    panes = len({(d, t // 1000) for d, t, *_ in rows})
    assert 0 < updated < 6 * panes
    got = spark.read.schema(out.schema).parquet(f"{folder}/out").where(F.col("device_id") != bounded.END_DEVICE)
    columns = ["device_id", "window_end_ms", "temp", "work"]
    assert tuples(got, *columns) == tuples(work_windows(all_), *columns)


def test_efficiency_carries_over_gaps_between_batches(spark):
    """A device that is silent for minutes goes on from its last window."""
    rows = [("a", T0 + t, n % 5, 0.2) for n, t in enumerate([0, 500, 400_000, 401_000, 900_000])]
    rows += [("b", T0 + t, n % 3, 0.0 if n == 1 else 0.5) for n, t in enumerate([100, 200_000, 300_000, 900_500])]
    all_ = readings(spark, rows)
    columns = ["device_id", "window_end_ms", "efficiency"]
    for stream, batch in ((feeds.efficiency_stream, efficiency_delta), (rolling, efficiency_rolling)):
        got = bounded.run_over(all_, stream, "gaps")
        want = batch(work_windows(all_)).where(F.col("efficiency").isNotNull())
        assert tuples(got.where("efficiency IS NOT NULL"), *columns) == tuples(want, *columns)
        assert got.count() == batch(work_windows(all_)).count()


def rolling(stream):
    return feeds.efficiency_stream(stream, efficiency="rolling")


def test_slices_have_alike_counts_whatever_the_times(spark):
    rows = [("a", T0 + n * 10, 1, 1) for n in range(4000)] + [("a", T0 - 10**9, 1, 1), ("a", T0 + 10**10, 1, 1)]
    folder = scratch_dir(spark, "slices")
    bounded.write_slices(readings(spark, rows), folder)
    counts = spark.read.schema(READING_SCHEMA).parquet(folder).groupBy(F.input_file_name()).count().collect()
    sizes = sorted(r["count"] for r in counts)
    assert sum(sizes) == 4003 and sizes[0] == 1 and sizes[-1] < 1100


def test_a_replayed_batch_of_changes_leaves_no_trace(spark):
    kind = "device_id string, door_open boolean, defrosted boolean, efficiency double, time_ms long, seq long"
    path = scratch_dir(spark, "changes")
    one = spark.createDataFrame([("a", True, None, None, 1, 1), ("b", False, None, None, 1, 2)], kind)
    two = spark.createDataFrame([("a", False, None, None, 2, 1)], kind)
    write_changes(one, path, "door", 0)
    write_changes(two, path, "door", 1)
    before = tuples(read_changes(spark, path), "device_id", "door_open", "time_ms")
    write_changes(two, path, "door", 1)
    assert tuples(read_changes(spark, path), "device_id", "door_open", "time_ms") == before
    assert tuples(fold_status(read_changes(spark, path)), "device_id", "door_open") == [("a", False), ("b", False)]


@pytest.mark.parametrize("partitions", ["2", "5"])
def test_the_session_keeps_the_callers_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert stream_session(spark).conf.get("spark.sql.shuffle.partitions") == partitions
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_micro_batches_grow_with_the_partitions_of_state(spark):
    assert [bounded.batches_of(rows, 200) for rows in (0, 6_000_000, 36_000_000)] == [4, 4, 8]
    assert bounded.batches_of(36_000_000, 12) == 36


@pytest.mark.parametrize("partitions", ["2", "200"])
def test_state_has_one_bound_whatever_the_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        conf = stream_session(spark).conf
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert conf.get(f"{ROCKSDB}.boundedMemoryUsage", None) == "true"
    assert conf.get(f"{ROCKSDB}.maxMemoryUsageMB", None) == str(STATE_MB)
    assert conf.get(f"{ROCKSDB}.writeBufferSizeMB", None) == str(write_buffer_mb(int(partitions)))
    # The pieces in which stores take memory fit half of the bound, though all are in one executor.
    assert 4 * int(partitions) * write_buffer_mb(int(partitions)) / 8 <= STATE_MB / 2


def test_state_beyond_its_memory_gives_the_same_windows(spark):
    """More than a store of 1 MB keeps in memory, in one partition."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(24_000).select(
        F.concat(F.lit("device"), F.col("id") % 3000).alias("device_id"),
        (F.lit(T0) + F.col("id") * 2).alias("time_ms"),
        F.timestamp_millis(F.lit(T0) + F.col("id") * 2).alias("ts"),
        F.col("id").alias("seq"),
        F.lit("temp").alias("sensor_name_1"),
        (F.col("id") % 17).cast("double").alias("temp"),
        F.lit("kws").alias("sensor_name_2"),
        F.lit(0.5).alias("kw"),
    )
    folder = scratch_dir(spark, "beyond")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        session = stream_session(spark)
        session.conf.set(f"{ROCKSDB}.writeBufferSizeMB", "1")
        bounded.write_slices(rows, f"{folder}/readings")
        out = feeds.windows_stream(replay_stream(session, f"{folder}/readings", READING_SCHEMA))
        query = append_files(out, folder, "out", available_now=True)
        query.awaitTermination()
        got = spark.read.schema(out.schema).parquet(f"{folder}/out").where(F.col("device_id") != bounded.END_DEVICE)
        columns = ["device_id", "window_end_ms", "temp", "work"]
        want = work_windows(rows).select(*columns)
        assert got.count() == want.count()
        assert got.select(*columns).exceptAll(want).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    held = [o["customMetrics"].get("rocksdbTotalBytesWrittenByFlush", 0) for p in query.recentProgress for o in p["stateOperators"]]
    assert max(held) > 0  # some of it has left memory
