"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
# Memory of the state stores of an executor, whatever their number. Half of it is for
# what was written to them last.
STATE_MB = 200
# How many stores a shuffle partition has in all queries of ``run_streams``.
STORES_PER_PARTITION = 4


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC epoch milliseconds, so the session must be in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may run without that setting; every executor of a
    real cluster has to see the folder, and it has to outlive each of them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="frostline-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stream_session(spark: SparkSession) -> SparkSession:
    """A session on the same context, set up for stateful streaming.

    The number of shuffle partitions is fixed for the life of a checkpoint, so it
    is the caller's own setting, whatever the cluster has at the start.
    """
    session = use_utc(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # A micro-batch writes what changed in its state, not a copy of all of it.
    session.conf.set(f"{ROCKSDB}.changelogCheckpointing.enabled", "true")
    bound_state(session)
    return session


def bound_state(session: SparkSession) -> None:
    """State takes :data:`STATE_MB` of an executor, outside of its heap, and local disk beyond.

    By default each store keeps 64 MB of writes for itself before they go to disk, and an
    executor has some stores for each shuffle partition, so its memory grows with the
    readings until all of them are full. What the cluster sets itself stays.
    """
    partitions = int(session.conf.get("spark.sql.shuffle.partitions"))
    bounds = {
        "boundedMemoryUsage": "true",
        "maxMemoryUsageMB": str(STATE_MB),
        "writeBufferSizeMB": str(write_buffer_mb(partitions)),
    }
    for name, value in bounds.items():
        if session.conf.get(f"{ROCKSDB}.{name}", None) is None:
            session.conf.set(f"{ROCKSDB}.{name}", value)


def write_buffer_mb(partitions: int) -> int:
    """Writes that a store keeps before they go to disk, so that those of all stores fit.

    Stores take memory in pieces of an eighth of it, also where they need less.
    """
    return max(1, min(16, STATE_MB // 2 // (STORES_PER_PARTITION * partitions)))
