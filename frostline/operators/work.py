"""Energy per sliding window and device."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.operators.previous import BEFORE, BUCKET, bucket_of, dealt
from frostline.schema import SLIDE_MS, WINDOW_MS

# Fixed value: energy is summed in this type, so that order cannot matter. It
# holds steps of 1e-12 and sums up to 1e26; ``decode`` admits values up to 1e12.
KW_TYPE = "decimal(38,12)"

# Ends of windows are cut into buckets of this many slides.
BUCKET_SLIDES = 600

WINDOW_COLUMNS = ["device_id", "window_end_ms", "temp", "work"]


def work_windows(
    readings: DataFrame,
    window_ms: int = WINDOW_MS,
    slide_ms: int = SLIDE_MS,
    bucket_slides: int = BUCKET_SLIDES,
    keep_bucket: bool = False,
) -> DataFrame:
    """Windows [end - window, end) that hold a reading, with their energy sum.

    ``temp`` is that of the first reading in the window. Readings are first
    folded into panes one slide wide, with a map-side combine, so a hot device
    shrinks to one row per slide before the shuffle. A pane then makes two
    changes: its energy comes in with the first window that covers it, and goes
    out after the last. Between changes all windows are alike, so a running sum
    over the changes gives each stretch, and only results are expanded. The sum
    is exact because it is decimal.

    The ends of windows are cut into buckets of time, and a pane goes to each
    bucket that it reaches. So a task holds one device's panes of a bucket and
    of one window before it, however long the device's history is. With
    ``keep_bucket`` windows of whole slides name their bucket, by which they lie
    together, and the temperature of the window before in that bucket (NULL for
    its first one), so that what goes on by it needs no further shuffle, and
    nothing has to sort windows, of which a pane makes many.
    """
    if window_ms % slide_ms:
        return work_windows_expanded(readings, window_ms, slide_ms).select(*WINDOW_COLUMNS)
    stretches = _stretches(_panes(readings, slide_ms), window_ms // slide_ms, bucket_slides)
    kept = []
    if keep_bucket:
        by_device = Window.partitionBy("device_id", BUCKET).orderBy("at")
        stretches = stretches.withColumn("before", F.lag("first").over(by_device))
        before = F.when(F.col("end") == F.col("start"), F.col("before")).otherwise(F.col("first"))
        kept = [BUCKET, before.alias(BEFORE)]
    return stretches.select("*", F.explode(F.sequence("start", F.col("until") - 1)).alias("end")).select(
        "device_id",
        (F.col("end") * slide_ms).alias("window_end_ms"),
        F.col("first.temp").alias("temp"),
        F.col("kw").cast("double").alias("work"),
        *kept,
    )


def _panes(readings: DataFrame, slide_ms: int) -> DataFrame:
    """Energy and first temperature of each device and slide."""
    return (
        readings.withColumn("pane", bucket_of(F.col("time_ms"), slide_ms))
        .groupBy("device_id", "pane")
        .agg(
            F.sum(F.col("kw").cast(KW_TYPE)).alias("kw"),
            F.min(F.struct("time_ms", "seq", "temp")).alias("first"),
        )
        .select("device_id", "pane", "kw", F.struct("first.temp").alias("first"))
    )


def _stretches(panes: DataFrame, reach: int, bucket_slides: int) -> DataFrame:
    """Window ends of a bucket, from ``start`` to before ``until``, whose windows are alike.

    Ends are counted in slides. Changes are in order of ``at``, which lies before
    the bucket for what began before it and after it for what ends there; what a
    stretch has outside is cut off. They are sorted once: ``first``, of the oldest
    pane of a window, is looked up among the panes that came in within its reach.
    """
    opens, closes = F.col("pane") + 1, F.col("pane") + 1 + reach
    buckets = F.sequence(bucket_of(opens, bucket_slides), bucket_of(closes - 1, bucket_slides))
    placed = dealt(panes.withColumn(BUCKET, F.explode(buckets)), "device_id", BUCKET)
    comes = F.struct(opens.alias("at"), "kw", F.lit(1).alias("panes"), "first")
    goes = F.struct(
        closes.alias("at"), (-F.col("kw")).alias("kw"), F.lit(-1).alias("panes"), F.lit(None).alias("first")
    )
    changes = placed.select("device_id", BUCKET, F.inline(F.array(comes, goes)))
    by_device = Window.partitionBy("device_id", BUCKET).orderBy("at")
    so_far = by_device.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    covered = by_device.rangeBetween(1 - reach, Window.currentRow)
    opening = F.col(BUCKET) * bucket_slides
    return changes.select(
        "device_id",
        BUCKET,
        "at",
        F.greatest("at", opening).alias("start"),
        F.least(F.lead("at").over(by_device), opening + bucket_slides).alias("until"),
        F.sum("panes").over(so_far).alias("panes"),
        F.sum("kw").over(so_far).alias("kw"),
        F.first("first", ignorenulls=True).over(covered).alias("first"),
    ).where((F.col("panes") > 0) & (F.col("until") > F.col("start")))


def work_windows_expanded(
    readings: DataFrame, window_ms: int = WINDOW_MS, slide_ms: int = SLIDE_MS
) -> DataFrame:
    """The same by Spark's own time windows; also the streaming form.

    On a stream with a watermark, a window comes out once the watermark has
    passed its end.
    """
    span = F.window("ts", f"{window_ms} milliseconds", f"{slide_ms} milliseconds")
    return (
        readings.groupBy("device_id", span.alias("span"))
        .agg(
            F.sum(F.col("kw").cast(KW_TYPE)).alias("kw"),
            F.min(F.struct("time_ms", "seq", "temp")).alias("first"),
        )
        .select(
            "device_id",
            F.col("span.end").alias("window_end"),
            F.unix_millis("span.end").alias("window_end_ms"),
            F.col("first.temp").alias("temp"),
            F.col("kw").cast("double").alias("work"),
        )
    )
