"""Defrost detection (F4, F5). Stateless, so it never shuffles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.schema import DEFROST_THRESHOLD


def defrost_events(readings: DataFrame, threshold: float = DEFROST_THRESHOLD) -> DataFrame:
    """One TRUE per reading at or above the threshold, and never a FALSE."""
    return readings.where(F.col("temp") >= F.lit(threshold)).select(
        "device_id", F.lit(True).alias("defrosted"), "time_ms", "seq"
    )


def defrosted_devices(events: DataFrame) -> DataFrame:
    """The flag latches: each device that was ever above the threshold."""
    return events.groupBy("device_id").agg(F.max("defrosted").alias("defrosted"))
