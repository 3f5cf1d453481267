"""Cooling efficiency from work windows."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.functions import safe_divide
from frostline.operators.previous import BEFORE, BUCKET, bucket_of, dealt
from frostline.schema import EFFICIENCY_SCALE

WINDOWS_BUCKET_MS = 600_000
EFFICIENCY_SCHEMA = "device_id string, window_end_ms bigint, efficiency double"


def efficiency_delta(windows: DataFrame, bucket_ms: int = WINDOWS_BUCKET_MS) -> DataFrame:
    """A4: drop in temperature since the window before, per unit of work.

    Windows are put in order within a bucket of time. Before the first one of a
    bucket comes the last one of the device's bucket before, so what is ordered
    by device alone is one row for each of its buckets. Windows that name their
    bucket already, as ``work_windows`` can, stay where they are, and are not
    sorted either if they name the temperature before.
    """
    if BEFORE in windows.columns:
        return _delta(_linked(windows))
    keys = ["device_id", BUCKET]
    placed = windows
    if BUCKET not in windows.columns:
        placed = windows.withColumn(BUCKET, bucket_of(F.col("window_end_ms"), bucket_ms))
    # Plain numbers, so that this is a hash aggregate, which sorts nothing.
    lasts = placed.groupBy(*keys).agg(F.max_by("temp", "window_end_ms").alias("last"))
    by_bucket = Window.partitionBy("device_id").orderBy(BUCKET)
    carried = lasts.select(*keys, F.lag("last").over(by_bucket).alias("carried"))
    inside = Window.partitionBy(*keys).orderBy("window_end_ms")
    together = placed if BUCKET in windows.columns else dealt(placed, *keys)
    linked = together.select(
        *keys,
        "window_end_ms",
        "temp",
        "work",
        F.row_number().over(inside).alias("nth"),
        F.lag("temp").over(inside).alias("before"),
    ).join(carried, keys)
    before = F.when(F.col("nth") == 1, F.col("carried")).otherwise(F.col("before"))
    return _delta(linked.withColumn("before", before))


def _linked(windows: DataFrame) -> DataFrame:
    """Windows with the temperature before, also those that are the first of their bucket.

    The first and the last window of each bucket are found by a hash aggregate of
    plain numbers, as a device has no two windows with the same end.
    """
    known = windows.where(F.col("device_id").isNotNull())
    edges = known.groupBy("device_id", BUCKET).agg(
        F.max_by("temp", "window_end_ms").alias("last"),
        *[F.min_by(c, "window_end_ms").alias(c) for c in ("temp", "work")],
        F.min("window_end_ms").alias("window_end_ms"),
    )
    by_bucket = Window.partitionBy("device_id").orderBy(BUCKET)
    columns = ["device_id", "window_end_ms", "temp", "work"]
    firsts = edges.select(*columns, F.lag("last").over(by_bucket).alias("before"))
    rest = known.where(F.col(BEFORE).isNotNull()).select(*columns, F.col(f"{BEFORE}.temp").alias("before"))
    return rest.unionByName(firsts)


def _delta(linked: DataFrame) -> DataFrame:
    delta = safe_divide(F.col("before") - F.col("temp"), F.col("work")) * F.lit(EFFICIENCY_SCALE)
    return linked.select("device_id", "window_end_ms", delta.alias("efficiency"))


def fold_step(acc: float | None, temp: float, work: float) -> float | None:
    """A3, one step: NULL once a window had no work, as NULL carries on."""
    if acc is None or temp is None or not work:
        return None
    return (acc - temp) / work


def _fold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    acc, last_end, started = None, None, False
    for batch in batches:
        ends = batch.column("window_end_ms").to_pylist()
        folded = []
        for end, temp, work in zip(
            ends, batch.column("temp").to_pylist(), batch.column("work").to_pylist()
        ):
            if last_end is not None and end <= last_end:
                raise ValueError("windows must arrive in order of their end")
            acc = fold_step(acc, temp, work) if started else temp
            started, last_end = True, end
            folded.append(None if acc is None else EFFICIENCY_SCALE * acc)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("device_id"),
                batch.column("window_end_ms"),
                pa.array(folded, pa.float64()),
            ],
            ["device_id", "window_end_ms", "efficiency"],
        )


def efficiency_rolling(windows: DataFrame) -> DataFrame:
    """A3: e(1) = temp(1), then e(n) = (e(n-1) - temp(n)) / work(n), times 100.

    Each step needs the exact result of the one before, so a device is folded
    in order. Its windows stream through in Arrow batches; only one number is
    held. Numerically unstable by nature: prefer :func:`efficiency_delta`.

    Windows are first brought together by device and then sorted, which the
    grouping keeps; sorted before an exchange, they would lose their order.
    """
    together = dealt(windows.select("device_id", "window_end_ms", "temp", "work"), "device_id")
    ordered = together.sortWithinPartitions("device_id", "window_end_ms")
    return ordered.groupBy("device_id").applyInArrow(_fold_batches, EFFICIENCY_SCHEMA)


# --- the same as a scan ---------------------------------------------------------
#
# A step e -> (e - temp) / work is an affine map, and maps one after the other are
# one map again. So a bucket of windows is one map, a pass over a device's maps gives
# the value each bucket starts from, and buckets are then folded apart.

_MAP_SCHEMA = f"device_id string, {BUCKET} bigint, opened double, scale double, shift double"
_START_SCHEMA = f"device_id string, {BUCKET} bigint, has_start boolean, start double"


def _runs(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in columns))


def _bucket_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket, what it makes of a value (``scale``, ``shift``), and of none (``opened``).

    NULL stands for a bucket after which there is no value any more.
    """
    names = ["device_id", BUCKET, "opened", "scale", "shift"]
    key, held = None, None
    for batch in batches:
        done = []
        for device, bucket, temp, work in _runs(batch, "device_id", BUCKET, "temp", "work"):
            if (device, bucket) != key:
                if key is not None:
                    done.append((*key, *held))
                key, opened, scale, shift = (device, bucket), temp, 1.0, 0.0
            else:
                opened, scale, shift = fold_step(held[0], temp, work), held[1], held[2]
            if scale is None or not work or temp is None:
                scale = shift = None
            else:
                scale, shift = scale / work, (shift - temp) / work
            held = (opened, scale, shift)
        yield _record_batch(done, names, _MAP_TYPES)
    if key is not None:
        yield _record_batch([(*key, *held)], names, _MAP_TYPES)


def _bucket_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The value each bucket starts from, by the maps of the device's buckets before it."""
    names = ["device_id", BUCKET, "has_start", "start"]
    last, value = None, None
    for batch in batches:
        starts = []
        for device, bucket, opened, scale, shift in _runs(batch, "device_id", BUCKET, "opened", "scale", "shift"):
            begins = device != last
            starts.append((device, bucket, not begins, None if begins else value))
            if begins:
                value = opened
            elif value is None or scale is None:
                value = None
            else:
                # A bucket that forgets what it starts from does so also of an infinite value.
                value = scale * value + shift if scale else shift
            last = device
        yield _record_batch(starts, names, _START_TYPES)


def _bucket_folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, acc = None, None
    for batch in batches:
        folded = []
        rows = _runs(batch, "device_id", BUCKET, "temp", "work", "has_start", "start")
        for device, bucket, temp, work, has_start, start in rows:
            if (device, bucket) != key:
                key = (device, bucket)
                acc = fold_step(start, temp, work) if has_start else temp
            else:
                acc = fold_step(acc, temp, work)
            folded.append(None if acc is None else EFFICIENCY_SCALE * acc)
        yield pa.RecordBatch.from_arrays(
            [batch.column("device_id"), batch.column("window_end_ms"), pa.array(folded, pa.float64())],
            ["device_id", "window_end_ms", "efficiency"],
        )


_MAP_TYPES = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
_START_TYPES = [pa.string(), pa.int64(), pa.bool_(), pa.float64()]


def _record_batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def efficiency_rolling_scan(windows: DataFrame, bucket_ms: int = WINDOWS_BUCKET_MS) -> DataFrame:
    """A3 without a task for a whole device: buckets of windows are folded apart.

    Equals :func:`efficiency_rolling` up to rounding where the recurrence is stable,
    that is where windows have more than one unit of work: 1e-9 of the larger of the
    value and one. Elsewhere it grows without bound, and with it what rounding
    leaves; there only the fold in order gives its exact numbers. A task holds no
    more than a batch of windows; one row for each bucket is ordered by device.
    """
    keys = ["device_id", BUCKET]
    placed = windows.select("device_id", "window_end_ms", "temp", "work").withColumn(
        BUCKET, bucket_of(F.col("window_end_ms"), bucket_ms)
    )
    ordered = placed.repartition(*keys).sortWithinPartitions(*keys, "window_end_ms")
    maps = ordered.mapInArrow(_bucket_maps, _MAP_SCHEMA)
    by_device = maps.repartition("device_id").sortWithinPartitions(*keys)
    starts = by_device.mapInArrow(_bucket_starts, _START_SCHEMA)
    started = placed.join(starts, keys).repartition(*keys).sortWithinPartitions(*keys, "window_end_ms")
    return started.mapInArrow(_bucket_folds, EFFICIENCY_SCHEMA)
