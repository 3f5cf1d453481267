"""The status table read from the state of a stream."""

import random

from frostline.operators.status import FLAGS, fold_status
from frostline.session import scratch_dir, stream_session
from frostline.sources.tables import write_changes
from frostline.streaming import status
from frostline.streaming.run import STATUS

KIND = "device_id string, door_open boolean, defrosted boolean, efficiency double, time_ms long, seq long"


def some_changes(spark, batch, feed):
    rng = random.Random(f"{batch}{feed}")
    rows = []
    for n in range(40):
        values = {
            "door": (rng.random() < 0.5, None, None),
            "defrost": (None, True, None),
            "efficiency": (None, None, rng.choice([None, rng.random()])),
        }[feed]
        rows.append((f"d{rng.randrange(25)}", *values, rng.randrange(batch * 50, batch * 50 + 80), n))
    return spark.createDataFrame(rows, KIND)


def sort_key(row):
    return tuple((v is not None, v) for v in row)


def test_state_equals_the_folded_log_after_restarts_and_a_replay(spark):
    folder, all_ = scratch_dir(spark, "status-state"), None
    for batch in range(3):
        for feed in ("door", "defrost", "efficiency"):
            part = some_changes(spark, batch, feed)
            all_ = part if all_ is None else all_.unionByName(part)
            write_changes(part, f"{folder}/{STATUS}", feed, batch)
        if batch == 2:  # the feed's last micro-batch is replayed
            write_changes(some_changes(spark, 1, "door"), f"{folder}/{STATUS}", "door", 1)
        session = stream_session(spark)  # started anew each time, from its checkpoint
        query = status.keep_status(status.changes_stream(session, folder), folder, available_now=True)
        query.awaitTermination()
        got = [tuple(r) for r in status.read_status_state(spark, folder).select("device_id", *FLAGS).collect()]
        want = [tuple(r) for r in fold_status(all_).select("device_id", *FLAGS).collect()]
        assert sorted(got, key=sort_key) == sorted(want, key=sort_key)
