"""Run a stream over a table that ends, and read what came out."""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.operators.previous import bucket_of
from frostline.schema import READING_COLUMNS, READING_SCHEMA
from frostline.session import scratch_dir, stream_session
from frostline.sources.events import read_readings
from frostline.sources.messages import encode
from frostline.sources.replay import replay_stream
from frostline.streaming.run import append_files, append_shared, run_streams, update_files

# A reading so late in time that the watermark it sets closes everything else.
END_DEVICE = "end of stream"
END_TIME = datetime(2200, 1, 1, tzinfo=timezone.utc)

# Micro-batches hold about so many readings, or so many for each shuffle partition, as
# every one opens and commits the state of all of these; but there are always a few.
BATCH_ROWS = 1_000_000
PARTITION_ROWS = 25_000
LEAST_BATCHES = 4
# Files of a micro-batch hold about so many, so that several tasks write and read it.
FILE_ROWS = 250_000
# Readings of one such span (milliseconds or numbers of ``seq``) stay in one micro-batch.
COUNTED = 100


def end_marker(spark: SparkSession) -> DataFrame:
    end_ms = int(END_TIME.timestamp() * 1000)
    row = [(END_DEVICE, end_ms, END_TIME, 0, "temp", 0.0, "kws", 0.0)]
    return spark.createDataFrame(row, READING_SCHEMA)


def batches_of(rows: int, partitions: int) -> int:
    """How many micro-batches so many readings are cut into."""
    return max(LEAST_BATCHES, -(-rows // max(BATCH_ROWS, PARTITION_ROWS * partitions)))


def write_slices(readings: DataFrame, path: str, late: Column | None = None, by: str = "time_ms") -> int:
    """Readings as some files for each slice of time, in order, then the end marker.

    Slices have about as many readings each, by counts of short spans of time, so
    neither a busy hour nor a time far off makes a large one. Readings of the first
    one that are ``late`` come with the last one instead. Slices are written one
    after the other, since a stream takes files in the order of their times of
    writing. ``by`` may also be ``seq``, for slices in order of arrival. Returns how
    many files a micro-batch takes.
    """
    span = bucket_of(F.col(by), COUNTED)
    counts = readings.groupBy(span.alias("span_")).agg(F.count("*").alias("n"))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    slices = batches_of(rows, int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    files = max(1, -(-rows // (slices * FILE_ROWS)))
    if rows:
        # A row for each span of time, whatever the number of readings.
        earlier = Window.orderBy("span_").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
        own = counts.select("span_", F.call_function("div", before * slices, F.lit(rows)).alias("own_"))
        placed = readings.withColumn("span_", span).join(own, "span_")
        is_late = F.lit(False) if late is None else F.coalesce(late, F.lit(False)) & (F.col("own_") == 0)
        placed = placed.withColumn("slice_", F.when(is_late, slices - 1).otherwise(F.col("own_")))
        for n in range(slices):
            part = placed.where(F.col("slice_") == n).select(*READING_COLUMNS)
            part = part.coalesce(1) if files == 1 else part.repartition(files)
            part.write.mode("append").parquet(path)
    end_marker(readings.sparkSession).coalesce(1).write.mode("append").parquet(path)
    return files


def event_readings(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """The ``events`` table; with ``copies``, of so many times the devices."""
    readings = read_readings(spark, sf_dir, event_type=F.col("event_type"))
    if copies == 1:
        return readings
    numbered = readings.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return numbered.withColumn("device_id", F.concat("device_id", F.lit("-"), "copy_")).drop("copy_")


def run_over(
    readings: DataFrame,
    result: Callable[[DataFrame], DataFrame],
    name: str,
    late: Column | None = None,
    by: str = "time_ms",
) -> DataFrame:
    """Stream readings through ``result`` to the end; returns what it wrote.

    The end marker is left out on reading. As part of the stream, that filter
    would be pushed below the watermark and nothing would close.
    """
    spark = readings.sparkSession
    folder = scratch_dir(spark, name)
    files = write_slices(readings, f"{folder}/readings", late, by)
    stream = replay_stream(stream_session(spark), f"{folder}/readings", READING_SCHEMA, files_per_trigger=files)
    out = result(stream)
    append_files(out, folder, "out", available_now=True).awaitTermination()
    written = spark.read.schema(out.schema).parquet(f"{folder}/out")
    return written.where(F.col("device_id") != END_DEVICE)


def run_updates(readings: DataFrame, result: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The same for a result in update mode: rows of all micro-batches with their ``batch_id``."""
    spark = readings.sparkSession
    folder = scratch_dir(spark, name)
    files = write_slices(readings, f"{folder}/readings")
    stream = replay_stream(stream_session(spark), f"{folder}/readings", READING_SCHEMA, files_per_trigger=files)
    out = result(stream)
    update_files(out, folder, "out", available_now=True).awaitTermination()
    schema = T.StructType([*out.schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(f"{folder}/out").where(F.col("device_id") != END_DEVICE)


def run_over_events(
    spark: SparkSession,
    sf_dir: str,
    result: Callable[[DataFrame], DataFrame],
    name: str,
    late: Column | None = None,
    copies: int = 1,
) -> DataFrame:
    """The same over the ``events`` table, of ``copies`` times its devices."""
    return run_over(event_readings(spark, sf_dir, copies), result, name, late)


def run_all_over_events(
    spark: SparkSession, sf_dir: str, name: str, efficiency: str = "delta", copies: int = 1
) -> str:
    """Every query of :func:`run_streams` over ``events``; returns their folder."""
    session = stream_session(spark)
    folder = scratch_dir(spark, name)
    files = write_slices(event_readings(spark, sf_dir, copies), f"{folder}/readings")
    stream = replay_stream(session, f"{folder}/readings", READING_SCHEMA, files_per_trigger=files)
    messages = encode(stream)
    streams = run_streams(session, lambda _: messages, folder, available_now=True, efficiency=efficiency)
    for query in streams:
        query.awaitTermination()
    return folder


def run_shared_over_events(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The query of all stateless sinks over ``events``; returns their folder."""
    session = stream_session(spark)
    folder = scratch_dir(spark, name)
    files = write_slices(event_readings(spark, sf_dir), f"{folder}/readings")
    stream = replay_stream(session, f"{folder}/readings", READING_SCHEMA, files_per_trigger=files)
    append_shared(encode(stream), folder, available_now=True).awaitTermination()
    return folder
