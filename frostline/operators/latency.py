"""Delay from event to ingest."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.operators.previous import BUCKET, bucket_of

QUANTILES = (0.5, 0.95, 0.99)
DELAY_BUCKET_MS = 1_000


def latency_summary(readings: DataFrame, bucket_ms: int = DELAY_BUCKET_MS) -> DataFrame:
    """Exact quantiles of the delay in milliseconds; needs ``ingest_ms``.

    Equal delays are counted first. Their ranks are then running counts within a
    bucket of delays, on top of those of the buckets before. One task only ever
    sees a row for each bucket, and each quantile is one row's delay, or lies
    between two of them.
    """
    counts = (
        readings.select((F.col("ingest_ms") - F.col("time_ms")).alias("latency_ms"))
        .groupBy("latency_ms")
        .agg(F.count("*").alias("n"))
        .withColumn(BUCKET, bucket_of(F.col("latency_ms"), bucket_ms))
    )
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy(BUCKET).agg(F.sum("n").alias("in_bucket"))
    buckets = buckets.select(
        BUCKET,
        F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("offset"),
        F.sum("in_bucket").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy(BUCKET).orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    ranked = counts.join(buckets, BUCKET).withColumn("start", start)

    def delay_at(rank):
        held = (F.col("start") <= rank) & (rank < F.col("start") + F.col("n"))
        return F.max(F.when(held, F.col("latency_ms")))

    marks = []
    for q in QUANTILES:
        place = (F.col("total") - 1) * F.lit(q)
        name = f"p{round(q * 100)}"
        marks += [
            delay_at(F.floor(place)).alias(f"{name}_low"),
            delay_at(F.ceil(place)).alias(f"{name}_high"),
            F.max(place - F.floor(place)).alias(f"{name}_part"),
        ]
    summed = ranked.agg(
        F.sum("n").alias("readings"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
        (F.sum(F.col("latency_ms") * F.col("n")) / F.sum("n")).alias("mean_ms"),
        *marks,
    )

    def between(name):
        low, high, part = (F.col(f"{name}_{x}") for x in ("low", "high", "part"))
        return (low + (high - low) * part).alias(f"{name}_ms")

    quantiles = [between(f"p{round(q * 100)}") for q in QUANTILES]
    return summed.select("readings", "min_ms", "max_ms", "mean_ms", *quantiles)


# Size of a sketch; the rank of what it gives is then off by about half the bound.
SKETCH_K = 400
SKETCH_RANK_ERROR = 0.0133

SKETCH_COLUMNS = ["readings", "min_ms", "max_ms", "sum_ms", "sketch"]


def latency_sketch(readings: DataFrame, *by: Column | str) -> DataFrame:
    """Delays as a KLL sketch with exact counts beside it; needs ``ingest_ms``.

    A row for each value of ``by``, or one for all. Sketches of micro-batches, or
    of any spans, are put together by :func:`merged_latency`.
    """
    delay = F.col("ingest_ms") - F.col("time_ms")
    return readings.groupBy(*by).agg(
        F.count(delay).alias("readings"),
        F.min(delay).alias("min_ms"),
        F.max(delay).alias("max_ms"),
        F.sum(delay).alias("sum_ms"),
        F.kll_sketch_agg_bigint(delay, SKETCH_K).alias("sketch"),
    )


def merged_latency(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Quantiles over many sketches, each within ``SKETCH_RANK_ERROR`` of its rank."""
    held = sketches.where(F.col("readings") > 0)
    merged = held.groupBy(*by).agg(
        F.sum("readings").alias("readings"),
        F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"),
        (F.sum("sum_ms") / F.sum("readings")).alias("mean_ms"),
        F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"),
    )
    at = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"p{round(q * 100)}_ms") for q in QUANTILES]
    found = merged.where(F.col("readings") > 0)
    return found.select(*by, "readings", "min_ms", "max_ms", "mean_ms", *at)
