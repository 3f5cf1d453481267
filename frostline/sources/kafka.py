"""Kafka topic as a stream or table of messages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline import schema as S

PARTITION_BITS = 16


def kafka_options(
    servers: str = S.BOOTSTRAP_SERVERS,
    topic: str = S.TOPIC,
    group: str = S.CONSUMER_GROUP,
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``starting`` only counts for a query without a checkpoint; later runs resume
    from their own offsets. The group is a prefix, as each query that reads the
    topic needs a group of its own.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "groupIdPrefix": group,
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def messages_from_records(records: DataFrame) -> DataFrame:
    """Kafka records to ``value`` and ``seq``.

    ``seq`` is the offset followed by the partition number in 16 bits: unique, and
    rising within each partition. A partition or an offset that does not fit in
    ends the job, as a wrong ``seq`` would let an older reading win.
    """
    fits = (F.col("partition") < 1 << PARTITION_BITS) & (F.col("offset") < 1 << (63 - PARTITION_BITS))
    numbered = F.shiftleft(F.col("offset"), PARTITION_BITS).bitwiseOR(F.col("partition").cast("bigint"))
    refusal = F.raise_error(F.lit("partition or offset too large for seq")).cast("bigint")
    seq = F.when(fits, numbered).otherwise(refusal)
    return records.select(F.col("value").cast("string").alias("value"), seq.alias("seq"))


def read_kafka_stream(spark: SparkSession, **options) -> DataFrame:
    source = spark.readStream.format("kafka").options(**kafka_options(**options))
    return messages_from_records(source.load())


def read_kafka_table(spark: SparkSession, starting: str = "earliest", **options) -> DataFrame:
    """What the topic holds now, as a batch."""
    source = spark.read.format("kafka").options(**kafka_options(starting=starting, **options))
    return messages_from_records(source.load())
