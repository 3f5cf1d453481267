"""Streaming efficiency: per-device state over closed windows."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from frostline.operators.efficiency import EFFICIENCY_SCHEMA, fold_step
from frostline.schema import EFFICIENCY_SCALE
from frostline.streaming.previous import GROUP, groups_of

_CARRY = T.StructType([T.StructField("device_id", T.StringType()), T.StructField("number", T.DoubleType())])


class _WindowFold(StatefulProcessor):
    """Takes the windows of a group of devices, each device's in order.

    They close in order as well, so one number for each device is all there is to
    keep from one micro-batch to the next. Devices share a call into Python, and
    the numbers of a group are read and written in one piece.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.carried = handle.getListState("carried", _CARRY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        carried = dict(tuple(r) for r in self.carried.get())
        windows = pd.concat(list(rows)).sort_values(["device_id", "window_end_ms"], ignore_index=True)
        efficiency = self.fold(windows, carried)
        self.carried.put([(d, None if n is None else float(n)) for d, n in sorted(carried.items())])
        yield windows[["device_id", "window_end_ms"]].assign(efficiency=pd.Series(efficiency, dtype="float64"))

    def fold(self, windows: pd.DataFrame, carried: dict[str, float | None]):
        """Efficiencies of the windows; puts what is to be carried on into ``carried``."""
        raise NotImplementedError


class DeltaFold(_WindowFold):
    """A4: the number kept is the temperature of the window before."""

    def fold(self, windows, carried):
        device, temp, work = windows["device_id"], windows["temp"], windows["work"]
        is_first = device != device.shift(1)
        before = temp.shift(1).mask(is_first, device.map(carried).astype("float64"))
        lasts = device != device.shift(-1)
        carried.update(zip(device[lasts], temp[lasts]))
        return (before - temp) / work.where(work != 0) * EFFICIENCY_SCALE


class RollingFold(_WindowFold):
    """A3: the number kept is the efficiency so far, unscaled."""

    def fold(self, windows, carried):
        folded = []
        columns = (windows[c].tolist() for c in ("device_id", "temp", "work"))
        for device, temp, work in zip(*columns):
            carry = fold_step(carried[device], temp, work) if device in carried else temp
            carried[device] = carry
            folded.append(None if carry is None else EFFICIENCY_SCALE * carry)
        return folded


def _folded(windows: DataFrame, processor: StatefulProcessor, groups: int | None) -> DataFrame:
    inputs = windows.select("device_id", "window_end_ms", "temp", "work")
    grouped = inputs.withColumn(GROUP, F.pmod(F.xxhash64("device_id"), F.lit(groups_of(windows, groups))))
    return grouped.groupBy(GROUP).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=EFFICIENCY_SCHEMA,
        outputMode="append",
        timeMode="none",
    )


def efficiency_delta_stream(windows: DataFrame, groups: int | None = None) -> DataFrame:
    """State is keyed by a group of devices; a checkpoint is tied to the number of groups."""
    return _folded(windows, DeltaFold(), groups)


def efficiency_rolling_stream(windows: DataFrame, groups: int | None = None) -> DataFrame:
    return _folded(windows, RollingFold(), groups)
