"""Sliding windows of a stream by way of panes (X6, A1): two aggregations in one query.

Spark's sliding window puts a reading into the state of every window that covers
it, thirty for the default. Here readings are first summed in panes one slide wide,
and the closed panes are gathered in buckets of window ends. A pane is in as many
buckets as a window reaches, four for the default, and a bucket that closes gives
all its windows at once, without state of their own.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.operators.work import KW_TYPE
from frostline.schema import SLIDE_MS, WINDOW_MS

# Window ends in a bucket. More of them take less state and come out later.
BUCKET_SLIDES = 10
# One digit less than sums have, so that adding two panes needs no rounding.
PANE_TYPE = "decimal(37,12)"


def closed_panes(readings: DataFrame, slide_ms: int = SLIDE_MS) -> DataFrame:
    """Energy and first temperature of each device and slide, once the watermark has passed it.

    ``pane`` is the number of the slide after it, which is the first window end
    that covers it; ``pane_time`` is its event time for further steps.
    """
    span = F.window("ts", f"{slide_ms} milliseconds")
    panes = readings.groupBy("device_id", span.alias("span")).agg(
        F.sum(F.col("kw").cast(KW_TYPE)).alias("kw"),
        F.min(F.struct("time_ms", "seq", "temp")).alias("first"),
    )
    return panes.select(
        "device_id",
        F.window_time("span").alias("pane_time"),
        F.call_function("div", F.unix_millis("span.end"), F.lit(slide_ms)).alias("pane"),
        F.col("kw").cast(PANE_TYPE).alias("kw"),
        F.col("first.temp").alias("temp"),
    )


def windows_of_panes(
    panes: DataFrame,
    window_ms: int = WINDOW_MS,
    slide_ms: int = SLIDE_MS,
    bucket_slides: int = BUCKET_SLIDES,
) -> DataFrame:
    """Windows that hold a pane, from :func:`closed_panes`; the last step keeps no state.

    A bucket has the window ends after its start up to its end, and the panes that
    any of them reaches. Its windows come out when the watermark passes its end, so
    up to ``bucket_slides`` slides after their own.
    """
    if window_ms % slide_ms:
        raise ValueError("panes need a window of whole slides")
    reach = window_ms // slide_ms
    buckets = -(-reach // bucket_slides) + 1
    width = bucket_slides * slide_ms
    bucket = F.window("pane_time", f"{buckets * width} milliseconds", f"{width} milliseconds")
    gathered = panes.groupBy("device_id", bucket.alias("bucket")).agg(
        F.collect_list(F.struct("pane", "kw", "temp")).alias("panes")
    )
    last = F.call_function("div", F.unix_millis("bucket.end"), F.lit(slide_ms))
    ends = gathered.select(
        "device_id", F.array_sort("panes").alias("panes"), F.sequence(last - bucket_slides + 1, last).alias("ends")
    )
    windows = F.filter(
        F.transform("ends", lambda end: F.struct(end.alias("end"), _covered("panes", end, reach).alias("panes"))),
        lambda w: F.size(w["panes"]) > 0,
    )
    opened = ends.select("device_id", F.explode(windows).alias("w"))
    return opened.select(
        "device_id",
        F.timestamp_millis(F.col("w.end") * slide_ms).alias("window_end"),
        (F.col("w.end") * slide_ms).alias("window_end_ms"),
        F.col("w.panes")[0]["temp"].alias("temp"),
        _energy(F.col("w.panes")).cast("double").alias("work"),
    )


def _covered(panes: str, end: Column, reach: int) -> Column:
    return F.filter(panes, lambda p: (p["pane"] > end - reach) & (p["pane"] <= end))


def _energy(panes: Column) -> Column:
    nothing = F.lit(0).cast(PANE_TYPE)
    return F.aggregate(panes, nothing, lambda total, p: (total + p["kw"]).cast(PANE_TYPE))
