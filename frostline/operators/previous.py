"""Each reading next to the one before it (W1, J2), safe for hot devices.

A window over ``device_id`` alone would bring a device's whole history into one
task. A previous reading only matters within a time bound here, so history is
cut into time buckets, and each reading also visits the later buckets its bound
reaches into. There it can be "previous" but is never itself a result. The
size of a group is then the rate of a device times the bucket, however long the
history is. One shuffle, and with the default bucket about one sixth more rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Stateful processors lose names that start with an underscore.
BUCKET = "bucket_"
CARRIED = "carried_"
BEFORE = "before_"
BUCKET_MS = 60_000


def bucket_of(time: Column, width_ms: int) -> Column:
    """Number of the bucket a time falls in; also right before 1970."""
    return F.call_function("div", time - F.pmod(time, F.lit(width_ms)), F.lit(width_ms))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key together, in as many partitions as the session shuffles into.

    Sorted rows of panes and windows take some fifty times the bytes they have been
    shuffled in. Adaptive execution joins partitions by the latter, into tasks that
    hold gigabytes; it leaves a number that is asked for as it is.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def with_carried(
    df: DataFrame, within_ms: int, bucket_ms: int = BUCKET_MS, time: str = "time_ms"
) -> DataFrame:
    """Every row in its own bucket, and marked as carried in those it reaches."""
    own = bucket_of(F.col(time), bucket_ms)
    reach = bucket_of(F.col(time) + F.lit(within_ms - 1), bucket_ms)
    return (
        df.withColumn("_own", own)
        .withColumn(BUCKET, F.explode(F.sequence(F.col("_own"), reach)))
        .withColumn(CARRIED, F.col(BUCKET) > F.col("_own"))
        .drop("_own")
    )


def with_previous(
    df: DataFrame,
    columns: Sequence[str],
    within_ms: int,
    key: Sequence[str] = ("device_id",),
    time: str = "time_ms",
    tie: str = "seq",
    bucket_ms: int = BUCKET_MS,
    dense_ms: int | None = None,
) -> DataFrame:
    """Add ``prev_<column>`` from the row before, by (``time``, ``tie``) per key.

    They are NULL unless that row lies less than ``within_ms`` earlier. ``time``
    is always among the columns added.

    ``dense_ms`` is for devices whose single bucket outgrows a task. It cuts finer, down to a millisecond, and
    carries only the last row of each fine bucket, which is found first by an
    aggregate that combines on the map side.
    """
    columns = list(dict.fromkeys([time, *columns]))
    if dense_ms is None:
        placed = with_carried(df, within_ms, bucket_ms, time)
    else:
        placed = _placed_dense(df, columns, within_ms, key, time, tie, bucket_ms, dense_ms)

    group = Window.partitionBy(*key, BUCKET).orderBy(time, tie)
    before = {c: F.lag(c).over(group).alias(f"_lag_{c}") for c in columns}
    paired = placed.select(*df.columns, CARRIED, *before.values()).where(~F.col(CARRIED))
    near = F.col(time) - F.col(f"_lag_{time}") < F.lit(within_ms)
    previous = [F.when(near, F.col(f"_lag_{c}")).alias(f"prev_{c}") for c in columns]
    return paired.select(*df.columns, *previous)


def _placed_dense(df, columns, within_ms, key, time, tie, bucket_ms, dense_ms) -> DataFrame:
    own = df.withColumn(BUCKET, bucket_of(F.col(time), dense_ms))
    payload = [c for c in dict.fromkeys([time, tie, *columns]) if c not in key]
    last = (
        own.groupBy(*key, F.col(BUCKET).alias("_fine"))
        .agg(F.max(F.struct(*payload)).alias("_last"))
        .select(*key, "_fine", "_last.*")
    )
    # The first row of a bucket may be as much as dense_ms before its last one.
    linked = with_previous(
        last, payload, within_ms + dense_ms, key=key, time=time, tie=tie, bucket_ms=bucket_ms
    ).where(F.col(f"prev_{time}").isNotNull())
    carried = linked.select(
        *key,
        F.col("_fine").alias(BUCKET),
        *[F.col(f"prev_{c}").alias(c) for c in payload],
        F.lit(True).alias(CARRIED),
    )
    return own.withColumn(CARRIED, F.lit(False)).unionByName(carried, allowMissingColumns=True)
