"""One read of the source for all stateless sinks, with failures between them."""

import os
from datetime import datetime

import pytest
from helpers import readings, tuples
from pyspark.sql import functions as F

from frostline.operators.defrost import defrosted_devices, defrost_events
from frostline.operators.timeline import TIMELINE_COLUMNS, upsert_timeline
from frostline.schema import READING_SCHEMA
from frostline.session import scratch_dir, stream_session
from frostline.sources.messages import encode
from frostline.sources.replay import replay_stream
from frostline.sources.tables import read_status, read_timeline
from frostline.streaming import shared
from frostline.streaming.run import append_shared

MESSAGE = "seq long, value string"
BAD = [(1000, "{broken"), (1001, '{"time": 1}'), (1002, None)]
WHEN = [(t, t % 7 - 3, 0.1) for t in range(0, 40_000, 1000)]


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def written_messages(spark, folder, batches=4):
    """Messages in a file for each micro-batch, with bad ones in the second."""
    rows = encode(readings(spark, WHEN)).select("seq", "value").collect()
    size = len(rows) // batches
    for n in range(batches):
        part = [tuple(r) for r in rows[n * size : (n + 1) * size]] + (BAD if n == 1 else [])
        spark.createDataFrame(part, MESSAGE).coalesce(1).write.mode("append").parquet(f"{folder}/messages")


def run(spark, folder, sinks=shared.SINKS):
    session = stream_session(spark)
    source = replay_stream(session, f"{folder}/messages", spark.createDataFrame([], MESSAGE).schema)
    return append_shared(source, folder, available_now=True, compact_every=None, sinks=sinks)


def check(spark, folder):
    all_ = readings(spark, WHEN)
    timeline = read_timeline(spark, f"{folder}/timeline", ttl_seconds=None)
    assert tuples(timeline, *TIMELINE_COLUMNS) == tuples(upsert_timeline(all_), *TIMELINE_COLUMNS)
    assert spark.read.parquet(f"{folder}/timeline").count() == len(WHEN)  # nothing twice
    quarantine = spark.read.parquet(f"{folder}/quarantine")
    assert tuples(quarantine, "seq", "reason") == [(1000, "malformed"), (1001, "unusable field"), (1002, "malformed")]
    status = read_status(spark, f"{folder}/status")
    assert tuples(status, "device_id", "defrosted") == tuples(defrosted_devices(defrost_events(all_)), "device_id", "defrosted")
    delays = shared.read_latency(spark, folder).first()
    assert delays["readings"] == len(WHEN) and delays["min_ms"] <= delays["p50_ms"] <= delays["p99_ms"] <= delays["max_ms"]


def test_all_sinks_in_one_query(spark):
    folder = scratch_dir(spark, "shared")
    written_messages(spark, folder)
    query = run(spark, folder)
    query.awaitTermination()
    check(spark, folder)
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(WHEN) + len(BAD)  # read once
    one = shared.read_latency(spark, folder, first_batch=1, last_batch=2).first()
    assert one["readings"] == len(WHEN) // 2


@pytest.mark.parametrize("broken", list(shared.SINKS))
@pytest.mark.parametrize("half_written", [False, True])
def test_a_batch_that_fails_at_a_sink_is_replayed(spark, broken, half_written):
    """The query dies in its second micro-batch, and is started again."""
    folder = scratch_dir(spark, "failing")
    written_messages(spark, folder)

    def fails(parsed, target):
        if target.endswith("batch_id=1"):
            if half_written:  # files are there, the record that they are complete is not
                shared.SINKS[broken](parsed, target)
                os.remove(f"{local(target)}/_SUCCESS")
            raise OSError("the disk is gone")
        shared.SINKS[broken](parsed, target)

    with pytest.raises(Exception, match="the disk is gone"):
        run(spark, folder, shared.SINKS | {broken: fails}).awaitTermination()
    before = list(shared.SINKS)[: list(shared.SINKS).index(broken)]
    done = {n: os.stat(f"{local(folder)}/{n}/batch_id=1/_SUCCESS").st_mtime_ns for n in before}
    run(spark, folder).awaitTermination()
    check(spark, folder)
    for name, written in done.items():  # sinks that were done have not been written again
        assert os.stat(f"{local(folder)}/{name}/batch_id=1/_SUCCESS").st_mtime_ns == written


def test_a_batch_that_is_done_is_not_written_again(spark):
    folder = scratch_dir(spark, "again")
    messages = encode(readings(spark, WHEN))
    assert shared.write_sinks(messages, 0, folder) == list(shared.SINKS)
    assert shared.write_sinks(messages, 0, folder) == []


def test_expired_micro_batches_are_deleted(spark):
    folder = scratch_dir(spark, "expired")
    messages = encode(readings(spark, WHEN))
    shared.write_sinks(messages, 0, folder)
    shared.write_sinks(messages.unionByName(spark.createDataFrame(BAD, MESSAGE)), 1, folder)
    empty = f"{folder}/quarantine/batch_id=0"
    assert shared.drop_expired_batches(folder) == [empty]
    dropped = shared.drop_expired_batches(folder, datetime(2200, 1, 1))
    assert sorted(d.removeprefix(f"{folder}/") for d in dropped) == [
        "latency/batch_id=0", "latency/batch_id=1", "quarantine/batch_id=1", "timeline/batch_id=0", "timeline/batch_id=1"
    ]


def test_an_empty_batch(spark):
    folder = scratch_dir(spark, "empty")
    shared.write_sinks(encode(spark.createDataFrame([], READING_SCHEMA)), 0, folder)
    assert read_timeline(spark, f"{folder}/timeline", ttl_seconds=None).count() == 0
    assert shared.read_latency(spark, folder).where(F.col("readings") > 0).count() == 0
