"""Latest readings kept in state, expiring by a clock that is set by hand."""

import random

import pandas as pd
import pytest
from helpers import readings, tuples
from pyspark.sql import functions as F

from frostline.operators.timeline import TIMELINE_COLUMNS, latest_per_device
from frostline.session import scratch_dir, stream_session
from frostline.sources.replay import replay_stream
from frostline.streaming import latest

NOW = 10**9


def stored(spark, rows, folder, batches=1):
    """Rows of (device, time_ms, ingest_ms), in files of a micro-batch each; returns the table."""
    table = readings(spark, [(d, t, t % 7, 0.1) for d, t, _ in rows])
    written = spark.createDataFrame([(n, i) for n, (_, _, i) in enumerate(rows)], "seq long, ingest_ms long")
    table = table.join(written, "seq")
    size = -(-len(rows) // batches)
    for n in range(batches):
        part = table.where((F.col("seq") >= n * size) & (F.col("seq") < (n + 1) * size))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/readings")
    return table


def run(spark, folder, schema):
    stream = replay_stream(stream_session(spark), f"{folder}/readings", schema)
    latest.keep_latest(stream, folder, groups=3, available_now=True).awaitTermination()


@pytest.mark.parametrize("age_seconds, there", [(7199, True), (7200, False), (7201, False)])
def test_a_reading_expires_after_its_time_to_live(spark, age_seconds, there):
    folder = scratch_dir(spark, "ttl")
    # The second device sets the clock; both are of one group.
    table = stored(spark, [("a", 5, NOW - age_seconds * 1000), ("b", 6, NOW)], folder)
    stream = replay_stream(stream_session(spark), f"{folder}/readings", table.schema)
    latest.keep_latest(stream, folder, groups=1, available_now=True).awaitTermination()
    state = spark.newSession()
    state.conf.set("spark.sql.streaming.stateStore.providerClass", latest.ROCKSDB_PROVIDER)
    held = state.read.format("statestore").option("stateVarName", "held").load(f"{folder}/checkpoints/{latest.STATE}")
    assert sorted(r[0] for r in held.select("list_element.device_id").collect()) == (["a", "b"] if there else ["b"])
    got = latest.read_latest_state(spark, folder, F.lit(NOW))
    assert tuples(got, "device_id") == ([("a",), ("b",)] if there else [("b",)])


def test_state_equals_the_table_with_late_writes_and_restarts(spark):
    rng, folder = random.Random(4), scratch_dir(spark, "latest")
    # Written in order, but of any time: a late one may outlast a newer one.
    rows = [(rng.choice("abcdef"), rng.randrange(100_000), NOW + n * 60_000) for n in range(300)]
    table = stored(spark, rows[:150], folder, batches=2)
    run(spark, folder, table.schema)
    more = readings(spark, [(d, t, t % 7, 0.1) for d, t, _ in rows]).join(
        spark.createDataFrame([(n, i) for n, (_, _, i) in enumerate(rows)], "seq long, ingest_ms long"), "seq"
    )
    more.where("seq >= 150").select(*table.columns).coalesce(1).write.mode("append").parquet(f"{folder}/readings")
    run(spark, folder, table.schema)  # from its checkpoint
    end = rows[-1][2]
    for later in (0, 600_000, 3_000_000, 7_100_000, 7_200_000):
        want = latest_per_device(more.where(F.col("ingest_ms") > end + later - 7_200_000))
        got = latest.read_latest_state(spark, folder, F.lit(end + later))
        assert tuples(got, *TIMELINE_COLUMNS) == tuples(want, *TIMELINE_COLUMNS)


def test_devices_in_order_keep_one_reading():
    rows = pd.DataFrame({"device_id": ["a"] * 50, "time_ms": range(50), "seq": range(50), "ingest_ms": range(50)})
    assert latest.still_to_come(rows, 49, 1000)["time_ms"].tolist() == [49]
    late = rows.assign(time_ms=range(50, 0, -1))  # each later written, and earlier in time
    assert len(latest.still_to_come(late, 49, 1000)) == 50
    assert len(latest.still_to_come(late, 49, 10)) == 10
