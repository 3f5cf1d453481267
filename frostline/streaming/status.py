"""The status table as the state of a stream.

Instead of folding the change log whenever it is read, a streaming aggregate keeps
the last value of each column and device in its state, in update mode. Readers take
the table from the state itself, as of the last micro-batch.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from frostline.operators.status import FLAGS, latest_changes
from frostline.schema import STATUS_CHANGE_SCHEMA
from frostline.session import ROCKSDB_PROVIDER
from frostline.streaming.run import CHECKPOINTS, STATUS, triggered

STATE = "status-state"


def changes_stream(session: SparkSession, root: str) -> DataFrame:
    """The change log of all feeds as a stream.

    A micro-batch of a feed that is written again is read again, which changes
    nothing, as the last value of a column is the one of the latest time. Compaction
    deletes what it has folded a call ago, so the stream must not lag by two calls.
    """
    return session.readStream.schema(STATUS_CHANGE_SCHEMA).parquet(f"{root}/{STATUS}/changes")


def keep_status(changes: DataFrame, root: str, available_now: bool = False) -> StreamingQuery:
    """Keep the status in state. What each micro-batch changes goes nowhere else."""
    latest = latest_changes(changes)
    writer = latest.writeStream.outputMode("update").format("noop")
    return triggered(writer, root, STATE, available_now)


def read_status_state(spark: SparkSession, root: str) -> DataFrame:
    """The status table as the stream's state has it, a row per device."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    state = session.read.format("statestore").load(f"{root}/{CHECKPOINTS}/{STATE}")
    # The aggregates stand in their own order, all under one name.
    held = state.schema["value"].dataType.fields
    renamed = T.StructType([T.StructField(flag, f.dataType) for flag, f in zip(FLAGS, held, strict=True)])
    opened = state.select(F.col("key.device_id").alias("device_id"), F.col("value").cast(renamed).alias("held"))
    return opened.select("device_id", *[F.col(f"held.{flag}.v").alias(flag) for flag in FLAGS])
