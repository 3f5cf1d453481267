"""Latest readings that have not expired, as the state of a stream."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from frostline.operators.timeline import SENSORS, TIMELINE_COLUMNS, latest_per_device
from frostline.schema import TIMELINE_TTL_SECONDS
from frostline.session import ROCKSDB_PROVIDER
from frostline.streaming.previous import GROUP, groups_of
from frostline.streaming.run import CHECKPOINTS, triggered

STATE = "latest-state"
HELD = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("time_ms", T.LongType()),
        T.StructField("seq", T.LongType()),
        *[T.StructField(c, T.StringType() if "name" in c else T.DoubleType()) for c in SENSORS],
        T.StructField("ingest_ms", T.LongType()),
    ]
)


def still_to_come(rows: pd.DataFrame, clock: int, ttl_ms: int) -> pd.DataFrame:
    """The readings that are, or may yet become, the latest of their device.

    A reading may if it has not expired, and if all later ones of its device were
    written before it and so expire before it. Devices that write in order of time
    have one.
    """
    newest = rows.sort_values(["device_id", "time_ms", "seq"], ascending=[True, False, False], ignore_index=True)
    written = newest.groupby("device_id")["ingest_ms"]
    outlasted = written.cummax().groupby(newest["device_id"]).shift(1)
    keep = ~(newest["ingest_ms"] <= outlasted) & (newest["ingest_ms"] > clock - ttl_ms)
    return newest[keep]


class LatestProcessor(StatefulProcessor):
    """Holds what :func:`still_to_come` leaves of a group of devices.

    The clock is the greatest time of writing that the group has seen, so it can be
    set by hand and does not move between micro-batches. What has expired leaves the
    state with the next reading of the group, and readers apply the exact limit.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))[HELD.names]
        before = pd.DataFrame(list(self.held.get()), columns=HELD.names).astype(new.dtypes.to_dict())
        both = pd.concat([before, new])
        kept = still_to_come(both, int(both["ingest_ms"].max()), self.ttl_ms)
        self.held.put(list(zip(*(kept[c].tolist() for c in HELD.names))))
        return iter([])


def keep_latest(
    readings: DataFrame,
    root: str,
    ttl_seconds: int = TIMELINE_TTL_SECONDS,
    groups: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the latest readings in state; ``readings`` carry ``ingest_ms``, their time of writing."""
    number = F.pmod(F.xxhash64("device_id"), F.lit(groups_of(readings, groups)))
    grouped = readings.select(*HELD.names, number.alias(GROUP)).groupBy(GROUP)
    kept = grouped.transformWithStateInPandas(
        statefulProcessor=LatestProcessor(ttl_seconds * 1000),
        outputStructType="device_id string",
        outputMode="update",
        timeMode="none",
    )
    return triggered(kept.writeStream.outputMode("update").format("noop"), root, STATE, available_now)


def read_latest_state(
    spark: SparkSession, root: str, as_of_ms: Column, ttl_seconds: int = TIMELINE_TTL_SECONDS
) -> DataFrame:
    """The latest reading of every device that has one, as of a time not before the last write."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    reader = session.read.format("statestore").option("stateVarName", "held")
    held = reader.load(f"{root}/{CHECKPOINTS}/{STATE}").select("list_element.*")
    fresh = held.where(F.col("ingest_ms") > as_of_ms - ttl_seconds * 1000)
    return latest_per_device(fresh).select(*TIMELINE_COLUMNS)
