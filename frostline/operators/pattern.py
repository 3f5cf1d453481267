"""Patterns over two adjacent readings of a device, and the door alert."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions import truncated
from frostline.operators.previous import BUCKET_MS, with_previous
from frostline.schema import PATTERN_WITHIN_MS

PAIR_INPUTS = ["device_id", "time_ms", "seq", "temp", "kw"]
PAIR_COLUMNS = ["device_id", "prev_time_ms", "time_ms", "prev_temp", "temp", "prev_kw", "kw", "seq"]


def detect_adjacent_pattern(
    df: DataFrame,
    condition: Column,
    within_ms: int,
    columns: Sequence[str],
    select: Sequence[str | Column] = ("*",),
    key: Sequence[str] = ("device_id",),
    time: str = "time_ms",
    tie: str = "seq",
    bucket_ms: int = BUCKET_MS,
    dense_ms: int | None = None,
) -> DataFrame:
    """Pairs of a reading and the very next one of its key that meet a condition.

    ``condition`` sees the later row's columns as they are and the earlier
    row's as ``prev_<column>`` for each of ``columns``. Every adjacent pair less
    than ``within_ms`` apart is tested once, so matches may overlap.
    """
    paired = with_previous(
        df, columns, within_ms, key=key, time=time, tie=tie, bucket_ms=bucket_ms, dense_ms=dense_ms
    )
    return matching(paired, condition, time).select(*select)


def matching(paired: DataFrame, condition: Column, time: str = "time_ms") -> DataFrame:
    """The rows that have a previous row in bounds and meet the condition."""
    return paired.where(F.col(f"prev_{time}").isNotNull() & condition)


def temp_rises() -> Column:
    """whole degrees count; a rise within one degree is none."""
    return truncated(F.col("temp")) > truncated(F.col("prev_temp"))


def rising_pairs(
    readings: DataFrame,
    within_ms: int = PATTERN_WITHIN_MS,
    bucket_ms: int = BUCKET_MS,
    dense_ms: int | None = None,
) -> DataFrame:
    """Adjacent readings of a device with the temperature rising."""
    return detect_adjacent_pattern(
        readings.select(*PAIR_INPUTS),
        temp_rises(),
        within_ms,
        ["temp", "kw"],
        PAIR_COLUMNS,
        bucket_ms=bucket_ms,
        dense_ms=dense_ms,
    )


def door_alerts(pairs: DataFrame) -> DataFrame:
    """The door is open if energy rose too, closed if it did not."""
    opened = (F.col("prev_kw") < F.col("kw")).alias("door_open")
    return pairs.select("device_id", opened, "time_ms", "seq")


def door_severity(pairs: DataFrame) -> DataFrame:
    """A rise in temperature is a warning, with energy rising an alert."""
    level = F.when(F.col("prev_kw") < F.col("kw"), F.lit("alert")).otherwise(F.lit("warning"))
    return pairs.select("device_id", level.alias("severity"), "time_ms", "seq")
