"""Streaming form of "each reading next to the one before it" (X1, X2)."""

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from frostline.operators.previous import BUCKET, BUCKET_MS, CARRIED, with_carried

WATERMARK_DELAY = "1 seconds"
GROUP = "group_"
GROUPS_PER_PARTITION = 4


def with_event_time(readings: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Watermark of stateful steps. Stateless steps read the stream without."""
    return readings.withWatermark("ts", delay)


def groups_of(stream: DataFrame, groups: int | None = None) -> int:
    """Groups of devices that state is keyed by: some for each shuffle partition."""
    if groups is not None:
        return groups
    return GROUPS_PER_PARTITION * int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# Pandas types of the values state can hold.
_PANDAS = {T.DoubleType(): "float64", T.LongType(): "int64", T.BooleanType(): "bool"}


class PreviousReading(StatefulProcessor):
    """Holds the readings of a group of devices in a bucket until the watermark.

    Then no earlier reading can come, so they are put in order and each gets the
    one before it of its device. Of what has been worked off, only a device's
    last reading is kept, and only while a later one could still be in bounds.
    """

    def __init__(self, columns: Sequence[str], types: dict, within_ms: int, bucket_ms: int):
        self.within_ms = within_ms
        self.bucket_ms = bucket_ms
        self.row_columns = ["device_id", "time_ms", "seq", CARRIED, *columns]
        self.row_schema = T.StructType([T.StructField(c, types[c]) for c in self.row_columns])
        self.dtypes = {c: _PANDAS[types[c]] for c in self.row_columns if types[c] in _PANDAS}
        self.results = ["device_id", "time_ms", "seq", *columns]
        self.earlier = ["time_ms", *columns]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.row_schema)
        self.last = handle.getListState("last", self.row_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for batch in rows:
            self.waiting.appendList(_tuples(batch[self.row_columns]))
            first = int(batch["time_ms"].min())
            earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self.handle.registerTimer(earliest + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self._read(self.waiting)
        is_ready = held["time_ms"] <= watermark
        rest = held[~is_ready]
        rows = pd.concat([self._read(self.last), held[is_ready]])
        rows = rows.sort_values(["device_id", "time_ms", "seq"], ignore_index=True)

        is_last = rows["device_id"] != rows["device_id"].shift(-1)
        useful = rows["time_ms"] > watermark - self.within_ms
        last = rows[is_last & useful].assign(**{CARRIED: True})
        if watermark >= (int(key[1]) + 1) * self.bucket_ms:
            last = last.iloc[:0]
        _write(self.last, last)
        _write(self.waiting, rest)
        if len(rest):
            self.handle.registerTimer(int(rest["time_ms"].min()) + 1)
        elif len(last):
            self.handle.registerTimer(int(last["time_ms"].max()) + self.within_ms + 1)

        before = rows.shift(1)
        near = rows["time_ms"] - before["time_ms"] < self.within_ms
        keep = (rows["device_id"] == before["device_id"]) & near & ~rows[CARRIED]
        if keep.any():
            previous = before.loc[keep, self.earlier].astype({"time_ms": "int64"})
            yield rows.loc[keep, self.results].join(previous.add_prefix("prev_"))

    def _read(self, state) -> pd.DataFrame:
        rows = pd.DataFrame(list(state.get()), columns=self.row_columns)
        return rows.astype(self.dtypes)


def _tuples(rows: pd.DataFrame) -> list[tuple]:
    """Rows as plain Python values, as state takes them."""
    return list(zip(*(rows[c].tolist() for c in rows.columns)))


def _write(state, rows: pd.DataFrame) -> None:
    if len(rows):
        state.put(_tuples(rows))
    else:
        state.clear()


def with_previous_stream(
    readings: DataFrame,
    columns: Sequence[str],
    within_ms: int,
    bucket_ms: int = BUCKET_MS,
    groups: int | None = None,
) -> DataFrame:
    """Readings that have a previous one in bounds, with its columns as ``prev_*``.

    The stream needs a watermark. State is keyed by a group of devices, so that
    each call into Python has many readings to work on, and by time bucket as in
    the batch form, so that a backlog of one device spreads over many keys. A
    checkpoint is tied to the number of groups, as it is to the session's shuffle
    partitions; the default is some groups for each of those.
    """
    groups = groups_of(readings, groups)
    base = readings.select("device_id", "time_ms", "ts", "seq", *columns)
    placed = with_carried(base, within_ms, bucket_ms).withColumn(
        GROUP, F.pmod(F.xxhash64("device_id"), F.lit(groups))
    )
    types = {f.name: f.dataType for f in placed.schema.fields}
    output = T.StructType(
        [
            T.StructField("device_id", types["device_id"]),
            T.StructField("time_ms", T.LongType()),
            T.StructField("seq", T.LongType()),
            *[T.StructField(c, types[c]) for c in columns],
            T.StructField("prev_time_ms", T.LongType()),
            *[T.StructField(f"prev_{c}", types[c]) for c in columns],
        ]
    )
    return placed.groupBy(GROUP, BUCKET).transformWithStateInPandas(
        statefulProcessor=PreviousReading(columns, types, within_ms, bucket_ms),
        outputStructType=output,
        outputMode="append",
        timeMode="eventTime",
    )
