"""Per-device state that is read and written a group of devices at a time."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from frostline.schema import SPARKLINE_LENGTH
from frostline.streaming.previous import GROUP, groups_of

_POINT = "struct<time_ms: bigint, seq: bigint, value: double>"
SERIES_SCHEMA = f"device_id string, points array<{_POINT}>, min_value double, max_value double"
BACKWARD_SCHEMA = "device_id string, seq bigint, time_ms bigint, behind_ms bigint"

_RING = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("time_ms", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)
_RANGE = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
    ]
)
_GREATEST = T.StructType(
    [T.StructField("device_id", T.StringType()), T.StructField("time_ms", T.LongType())]
)


def _grouped(readings: DataFrame, groups: int | None):
    number = F.pmod(F.xxhash64("device_id"), F.lit(groups_of(readings, groups)))
    return readings.withColumn(GROUP, number).groupBy(GROUP)


def _put(state, frame: pd.DataFrame) -> None:
    state.put(list(zip(*(frame[c].tolist() for c in frame.columns))))


class SeriesProcessor(StatefulProcessor):
    """A ring of each device's newest values, and the range of all it ever had.

    State is bounded by devices times the ring's length, whatever the history.
    Newest is by (``time_ms``, ``seq``), so the order of arrival does not matter.
    """

    def __init__(self, length: int):
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", _RING)
        self.range = handle.getListState("range", _RANGE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))[_RING.names]
        held = pd.DataFrame(list(self.ring.get()), columns=_RING.names).astype(new.dtypes.to_dict())
        both = pd.concat([held, new]).sort_values(["device_id", "time_ms", "seq"], ignore_index=True)
        ring = both.groupby("device_id", sort=False).tail(self.length)
        _put(self.ring, ring)

        seen = new.groupby("device_id")["value"].agg(low="min", high="max").reset_index()
        before = pd.DataFrame(list(self.range.get()), columns=_RANGE.names)
        known = pd.concat([before.astype(seen.dtypes.to_dict()), seen])
        ranges = known.groupby("device_id").agg(low=("low", "min"), high=("high", "max"))
        _put(self.range, ranges.reset_index())

        touched = ring[ring["device_id"].isin(seen["device_id"])]
        points = touched.groupby("device_id")[["time_ms", "seq", "value"]].apply(lambda g: g.to_dict("records"))
        now = ranges.loc[points.index]
        yield pd.DataFrame(
            {
                "device_id": points.index,
                "points": points.values,
                "min_value": now["low"].values,
                "max_value": now["high"].values,
            }
        )


def sparkline_stream(
    readings: DataFrame, column: str, length: int = SPARKLINE_LENGTH, groups: int | None = None
) -> DataFrame:
    """V7 as a live series: after each micro-batch, a row for every device it touched.

    The row has the device's newest values, oldest first, and its all-time range.
    It replaces the device's rows of earlier micro-batches.
    """
    values = readings.select("device_id", "time_ms", "seq", F.col(column).cast("double").alias("value"))
    return _grouped(values, groups).transformWithStateInPandas(
        statefulProcessor=SeriesProcessor(length),
        outputStructType=SERIES_SCHEMA,
        outputMode="update",
        timeMode="none",
    )


def latest_series(updates: DataFrame, version: str = "batch_id") -> DataFrame:
    """The last row of each device, opened into a row for each of its points."""
    names = ["points", "min_value", "max_value"]
    last = updates.groupBy("device_id").agg(F.max_by(F.struct(*names), version).alias("last"))
    opened = last.select("device_id", F.posexplode("last.points").alias("at", "point"), "last")
    return opened.select(
        "device_id",
        (F.col("at") + 1).cast("bigint").alias("pos"),
        "point.time_ms",
        "point.value",
        "last.min_value",
        "last.max_value",
    )


class BackwardProcessor(StatefulProcessor):
    """Holds each device's greatest time, and gives the readings that come after it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.greatest = handle.getListState("greatest", _GREATEST)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["device_id", "seq"], ignore_index=True)
        carried = dict(tuple(r) for r in self.greatest.get())
        before = new.groupby("device_id")["time_ms"].cummax().groupby(new["device_id"]).shift(1)
        held = new["device_id"].map(carried).astype("float64")
        # Times are below 2**53, so doubles hold them.
        behind = pd.concat([before, held], axis=1).max(axis=1) - new["time_ms"]
        for device, top in new.groupby("device_id")["time_ms"].max().items():
            carried[device] = max(int(top), carried.get(device, int(top)))
        self.greatest.put(sorted(carried.items()))
        late = behind > 0
        if late.any():
            found = new.loc[late, ["device_id", "seq", "time_ms"]]
            yield found.assign(behind_ms=behind[late].astype("int64"))


def backward_stream(readings: DataFrame, groups: int | None = None) -> DataFrame:
    """Readings that go backwards in time, in the order micro-batches bring them.

    Within a micro-batch the order of arrival is ``seq``. The stream itself goes on
    with all of its readings.
    """
    rows = readings.select("device_id", "seq", "time_ms")
    return _grouped(rows, groups).transformWithStateInPandas(
        statefulProcessor=BackwardProcessor(),
        outputStructType=BACKWARD_SCHEMA,
        outputMode="append",
        timeMode="none",
    )
