"""The ``events`` table read as sensor readings.

``events`` spans 30 days with hours between the rows of one user. Time is
shrunk 10,000-fold so that bounds of seconds apply, and values are mapped into
the ranges of the sensors.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.schema import READING_COLUMNS
from frostline.session import use_utc

# The start of the table, and how it is mapped to readings.
EPOCH_MS = 1_704_067_200_000
MICROS_PER_MS = 10_000_000
SENSOR_1 = "temp"
SENSOR_2 = "kws"


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def as_readings(events: DataFrame, **extra: Column) -> DataFrame:
    """Batch or stream of events to readings. Only projects, never shuffles.

    ``extra`` names further columns, made from those of ``events``.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(EPOCH_MS * 1000)
    cents = F.round(F.col("value") * 100).cast("bigint")
    k = F.get_json_object("props", "$.k").cast("bigint")
    shrunk = events.select(
        F.concat(F.lit("device"), F.col("user_id")).alias("device_id"),
        F.call_function("div", micros, F.lit(MICROS_PER_MS)).alias("since"),
        F.col("event_id").alias("seq"),
        ((cents % 3000) / F.lit(100.0) - F.lit(20.0)).alias("temp"),
        ((k * 4 + 200) / F.lit(3600.0)).alias("kw"),
        *[column.alias(name) for name, column in extra.items()],
    )
    return (
        shrunk.withColumn("time_ms", F.col("since") + F.lit(EPOCH_MS))
        .withColumn("ts", F.timestamp_millis("time_ms"))
        .withColumn("sensor_name_1", F.lit(SENSOR_1))
        .withColumn("sensor_name_2", F.lit(SENSOR_2))
        .select(*READING_COLUMNS, *extra)
    )


def read_readings(spark: SparkSession, sf_dir: str, **extra: Column) -> DataFrame:
    return as_readings(use_utc(spark).read.parquet(events_path(sf_dir)), **extra)
