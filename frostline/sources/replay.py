"""Stored files played back as a stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def replay_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_format: str = "parquet",
    files_per_trigger: int | None = 1,
    **options: str,
) -> DataFrame:
    """Files of a folder in order of modification, some per micro-batch.

    ``files_per_trigger=None`` takes every waiting file into one batch.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files that each hold one JSON array, one row per element."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
