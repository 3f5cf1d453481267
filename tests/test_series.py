"""Live series, backward times, rolling efficiency as a scan, merged delays, payloads."""

import random

import pytest
from helpers import readings, tuples
from pyspark.sql import functions as F

from frostline.operators.efficiency import efficiency_rolling, efficiency_rolling_scan
from frostline.operators.latency import SKETCH_RANK_ERROR, latency_sketch, latency_summary, merged_latency
from frostline.operators.order import backward_counts, backward_readings
from frostline.plans import views
from frostline.schema import READING_SCHEMA
from frostline.session import scratch_dir, stream_session
from frostline.sources.replay import replay_stream
from frostline.streaming import bounded, series
from frostline.streaming.run import update_files

POINTS = ["device_id", "pos", "time_ms", "value", "min_value", "max_value"]


def walk(n, seed, gaps=(0, 500, 3000)):
    rng, now, rows = random.Random(seed), 10**12, []
    for _ in range(n):
        now += rng.choice(gaps)
        rows.append((rng.choice("abc"), now, rng.randint(-50, 50) / 4, rng.randint(110, 500) / 100))
    return rows


@pytest.mark.parametrize("length", [1, 5, 100])
def test_live_series_equals_the_batch_view(spark, length):
    all_ = readings(spark, walk(250, length))
    updates = bounded.run_updates(all_, lambda r: series.sparkline_stream(r, "temp", length), "series")
    assert tuples(series.latest_series(updates), *POINTS) == tuples(views.sparkline(all_, "temp", length), *POINTS)


def test_a_device_that_is_silent_keeps_its_series(spark):
    rows = [("quiet", 10**12 + n, n, 1) for n in range(3)] + [("busy", 10**12 + 10_000 + n * 10, n % 9, 1) for n in range(400)]
    all_ = readings(spark, rows)
    updates = bounded.run_updates(all_, lambda r: series.sparkline_stream(r, "temp", 4), "silent")
    assert tuples(series.latest_series(updates), *POINTS) == tuples(views.sparkline(all_, "temp", 4), *POINTS)
    versions = {r["device_id"]: r["n"] for r in updates.groupBy("device_id").agg(F.count_distinct("batch_id").alias("n")).collect()}
    assert versions["quiet"] == 1 and versions["busy"] > 1


def test_state_of_a_series_does_not_grow_with_history(spark):
    """Rings are bounded, and so are the rows that micro-batches give."""
    folder = scratch_dir(spark, "ring")
    bounded.write_slices(readings(spark, [("a", 10**12 + n, n, 1) for n in range(2000)]), f"{folder}/readings")
    out = series.sparkline_stream(replay_stream(stream_session(spark), f"{folder}/readings", READING_SCHEMA), "temp", 10)
    update_files(out, folder, "out", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").where("device_id = 'a'").collect()
    assert len(rows) == bounded.LEAST_BATCHES and all(len(r["points"]) == 10 for r in rows)
    assert {(r["min_value"], r["max_value"]) for r in rows} == {(0.0, 499.0), (0.0, 999.0), (0.0, 1499.0), (0.0, 1999.0)}


def backward_by_hand(rows):
    greatest, out = {}, []
    for n, (device, time_ms, *_) in enumerate(rows):
        if device in greatest and time_ms < greatest[device]:
            out.append((device, n, time_ms, greatest[device] - time_ms))
        greatest[device] = max(time_ms, greatest.get(device, time_ms))
    return sorted(out)


def test_backward_times_in_table_and_stream(spark):
    rng = random.Random(8)
    rows = [(rng.choice("abc"), 10**12 + n * 100 - rng.choice([0, 0, 0, 700, 5000]), 1, 1) for n in range(500)]
    want, columns = backward_by_hand(rows), ["device_id", "seq", "time_ms", "behind_ms"]
    all_ = readings(spark, rows)
    assert want and tuples(backward_readings(all_), *columns) == want
    assert tuples(backward_readings(all_, bucket_seq=16), *columns) == want
    got = bounded.run_over(all_, series.backward_stream, "backward", by="seq")
    assert tuples(got, *columns) == want
    assert backward_counts(got).agg(F.sum("backward")).first()[0] == len(want)


def test_times_in_order_report_nothing(spark):
    all_ = readings(spark, [(1, 1, 1), (1, 2, 1), (5, 3, 1)])
    assert backward_readings(all_).count() == 0


@pytest.mark.parametrize("bucket_ms", [1_000, 7_000, 600_000])
def test_scan_equals_the_fold_where_it_is_stable(spark, bucket_ms):
    rows = [(d, (n + 1) * 1000, float(t), w) for n, (d, _, t, w) in enumerate(walk(400, 4))]
    windows = spark.createDataFrame(rows, "device_id string, window_end_ms long, temp double, work double")
    fold = {(r[0], r[1]): r[2] for r in efficiency_rolling(windows).collect()}
    scan = {(r[0], r[1]): r[2] for r in efficiency_rolling_scan(windows, bucket_ms).collect()}
    assert fold.keys() == scan.keys()
    assert all(abs(fold[k] - scan[k]) <= 1e-9 * max(1.0, abs(fold[k])) for k in fold)


def test_scan_has_nulls_where_the_fold_has(spark):
    rows = [("a", 1000, 2.0, 2.0), ("a", 2000, 1.0, 0.0), ("a", 9000, 1.0, 2.0), ("b", 1000, 2.0, 0.0), ("b", 8000, 3.0, 2.0),
            ("c", 1000, None, 2.0), ("c", 7000, 3.0, 2.0), ("d", 5000, 1.5, 0.5)]
    windows = spark.createDataFrame(rows, "device_id string, window_end_ms long, temp double, work double")
    columns = ["device_id", "window_end_ms", "efficiency"]
    key = lambda r: (r[0], r[1])
    for bucket_ms in (1_000, 3_000, 100_000):
        fold = sorted((tuple(r) for r in efficiency_rolling(windows).select(*columns).collect()), key=key)
        scan = sorted((tuple(r) for r in efficiency_rolling_scan(windows, bucket_ms).select(*columns).collect()), key=key)
        assert fold == scan
    assert efficiency_rolling_scan(windows.limit(0)).count() == 0


def test_merged_sketches_are_within_their_bound(spark):
    rng = random.Random(6)
    delays = [int(rng.expovariate(1 / 4000)) for _ in range(30_000)]
    frame = spark.createDataFrame([(i, d, i % 40) for i, d in enumerate(delays)], "time_ms long, delay long, batch long")
    frame = frame.withColumn("ingest_ms", F.col("time_ms") + F.col("delay"))
    merged = merged_latency(latency_sketch(frame, "batch")).first()
    exact = latency_summary(frame).first()
    for name in ("readings", "min_ms", "max_ms", "mean_ms"):
        assert merged[name] == exact[name]
    delays.sort()
    for q in (50, 95, 99):
        found = merged[f"p{q}_ms"]
        low = sum(d < found for d in delays) / len(delays)
        high = sum(d <= found for d in delays) / len(delays)
        assert low - SKETCH_RANK_ERROR <= q / 100 <= high + SKETCH_RANK_ERROR
    half = merged_latency(latency_sketch(frame, "batch").where("batch < 20")).first()
    assert half["readings"] == 15_000


def test_no_delays(spark):
    frame = spark.createDataFrame([], "time_ms long, ingest_ms long")
    assert merged_latency(latency_sketch(frame)).collect() == []


def test_payload_of_an_unknown_device_is_an_empty_list(spark):
    all_ = readings(spark, [("a", 1, 1, 1)])
    known = views.one_payload(views.latest_reading(all_, "a"), "timeline").collect()
    unknown = views.one_payload(views.latest_reading(all_, "b"), "timeline").collect()
    assert len(known) == 1 and '"deviceID":"a"' in known[0]["json"]
    assert [r["json"] for r in unknown] == ['{"timeline":[]}']
