"""Readings whose time goes backwards in order of arrival."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.operators.previous import BUCKET, bucket_of

# Places in the order of arrival that are put in order together.
BUCKET_SEQ = 65_536


def backward_readings(readings: DataFrame, bucket_seq: int = BUCKET_SEQ) -> DataFrame:
    """Readings that come after a later one of their device, and by how much.

    The order of arrival is ``seq``. It is cut into buckets; what came before a
    bucket is one greatest time for each bucket before, so no task holds the
    history of a device. Nothing is dropped from ``readings`` itself.
    """
    rows = readings.select("device_id", "seq", "time_ms", bucket_of(F.col("seq"), bucket_seq).alias(BUCKET))
    earlier = Window.partitionBy("device_id").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("device_id", BUCKET)
        .agg(F.max("time_ms").alias("greatest"))
        .select("device_id", BUCKET, F.max("greatest").over(earlier).alias("before"))
    )
    inside = (
        Window.partitionBy("device_id", BUCKET).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = rows.withColumn("inside", F.max("time_ms").over(inside)).join(before, ["device_id", BUCKET])
    behind = F.greatest("inside", "before") - F.col("time_ms")
    return ordered.select("device_id", "seq", "time_ms", behind.alias("behind_ms")).where("behind_ms > 0")


def backward_counts(backward: DataFrame) -> DataFrame:
    """How many readings of each device went backwards, and the farthest."""
    return backward.groupBy("device_id").agg(
        F.count("*").alias("backward"), F.max("behind_ms").alias("farthest_ms")
    )
