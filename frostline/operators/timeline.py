"""Reading history: upsert, retention, latest readings."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.operators.previous import BUCKET, BUCKET_MS, bucket_of
from frostline.schema import SPARKLINE_LENGTH, TIMELINE_TTL_SECONDS

SENSORS = ["sensor_name_1", "temp", "sensor_name_2", "kw"]
TIMELINE_COLUMNS = ["device_id", "time_ms", "seq", *SENSORS]


def upsert_timeline(readings: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per device and time, the last one written.

    An aggregate rather than a ranking, so that copies of one reading meet on
    the map side and a much-repeated one never gathers in a single task.
    """
    kept = [*SENSORS, *extra]
    return (
        readings.groupBy("device_id", "time_ms")
        .agg(F.max(F.struct("seq", *kept)).alias("last"))
        .select("device_id", "time_ms", "last.*")
    )


def retained(timeline: DataFrame, as_of: Column | None = None, ttl_seconds: int = TIMELINE_TTL_SECONDS) -> DataFrame:
    """Rows written less than the time to live ago; needs ``ingest_ts``.

    Where the table is partitioned by ``ingest_date``, older dates are not read.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    oldest = as_of - F.make_dt_interval(secs=F.lit(ttl_seconds))
    kept = timeline.where(F.col("ingest_ts") > oldest)
    if "ingest_date" in timeline.columns:
        kept = kept.where(F.col("ingest_date") >= oldest.cast("date"))
    return kept


def newest_first(timeline: DataFrame) -> DataFrame:
    """Each device's rows in descending time; a total order."""
    return timeline.orderBy("device_id", F.desc("time_ms"), F.desc("seq"))


def latest_of_device(timeline: DataFrame, device_id: str) -> DataFrame:
    """The newest row of one device, or none if it is unknown."""
    return (
        timeline.where(F.col("device_id") == F.lit(device_id))
        .orderBy(F.desc("time_ms"), F.desc("seq"))
        .limit(1)
    )


def latest_per_device(timeline: DataFrame) -> DataFrame:
    """The newest row of every device, as an aggregate."""
    return (
        timeline.groupBy("device_id")
        .agg(F.max(F.struct("time_ms", "seq", *SENSORS)).alias("last"))
        .select("device_id", "last.*")
    )


def recent_values(readings: DataFrame, column: str, length: int = SPARKLINE_LENGTH) -> DataFrame:
    """The newest values of each device, as (pos, value), oldest first.

    The rank filter lets Spark keep only ``length`` rows per device in each map
    task, so the shuffle does not grow with the history of a device.
    """
    newest = Window.partitionBy("device_id").orderBy(F.desc("time_ms"), F.desc("seq"))
    recent = (
        readings.select("device_id", "time_ms", "seq", F.col(column).alias("value"))
        .withColumn("age", F.row_number().over(newest))
        .where(F.col("age") <= length)
    )
    oldest = Window.partitionBy("device_id").orderBy(F.desc("age"))
    return recent.select(
        "device_id", F.row_number().over(oldest).cast("bigint").alias("pos"), "time_ms", "value"
    )


def extremes(readings: DataFrame, column: str) -> DataFrame:
    """Lowest and highest value a device ever had."""
    return readings.groupBy("device_id").agg(
        F.min(column).alias("min_value"), F.max(column).alias("max_value")
    )


def running_extremes(readings: DataFrame, column: str, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Lowest and highest value so far, at each reading.

    Buckets of time are folded first; what came before a bucket is then a window
    over those folds, and only within a bucket are readings themselves ordered.
    """
    rows = readings.select(
        "device_id",
        bucket_of(F.col("time_ms"), bucket_ms).alias(BUCKET),
        "time_ms",
        "seq",
        F.col(column).alias("value"),
    )
    earlier = (
        Window.partitionBy("device_id")
        .orderBy(BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        rows.groupBy("device_id", BUCKET)
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .select(
            "device_id",
            BUCKET,
            F.min("low").over(earlier).alias("low_before"),
            F.max("high").over(earlier).alias("high_before"),
        )
    )
    within = (
        Window.partitionBy("device_id", BUCKET)
        .orderBy("time_ms", "seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.join(before, ["device_id", BUCKET]).select(
        "device_id",
        "time_ms",
        "seq",
        "value",
        F.least("low_before", F.min("value").over(within)).alias("min_so_far"),
        F.greatest("high_before", F.max("value").over(within)).alias("max_so_far"),
    )
