"""The result streams of one stream of readings (U2). None starts a query."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.operators.defrost import defrost_events
from frostline.operators.pattern import PAIR_COLUMNS, door_alerts, matching, temp_rises
from frostline.operators.status import as_changes, efficiency_changes
from frostline.schema import PATTERN_WITHIN_MS
from frostline.streaming.efficiency import efficiency_delta_stream, efficiency_rolling_stream
from frostline.streaming.previous import WATERMARK_DELAY, with_event_time, with_previous_stream
from frostline.streaming.windows import BUCKET_SLIDES, closed_panes, windows_of_panes


def rising_pairs_stream(
    readings: DataFrame,
    within_ms: int = PATTERN_WITHIN_MS,
    delay: str = WATERMARK_DELAY,
    groups: int | None = None,
) -> DataFrame:
    """The batch pattern's own condition over the streaming pairing."""
    timed = with_event_time(readings, delay)
    paired = with_previous_stream(timed, ["temp", "kw"], within_ms, groups=groups)
    return matching(paired, temp_rises()).select(*PAIR_COLUMNS)


def door_stream(readings: DataFrame, delay: str = WATERMARK_DELAY, groups: int | None = None) -> DataFrame:
    return door_alerts(rising_pairs_stream(readings, delay=delay, groups=groups))


def windows_stream(
    readings: DataFrame, delay: str = WATERMARK_DELAY, bucket_slides: int = BUCKET_SLIDES
) -> DataFrame:
    """Windows come out once, when the watermark has passed their bucket.

    A reading is late for all windows once its own slide has closed. The form
    without panes is :func:`frostline.operators.work.work_windows_expanded`, whose
    windows come out at their end and take late readings until then.
    """
    return windows_of_panes(closed_panes(with_event_time(readings, delay)), bucket_slides=bucket_slides)


EFFICIENCIES = {"delta": efficiency_delta_stream, "rolling": efficiency_rolling_stream}


def efficiency_stream(
    readings: DataFrame, delay: str = WATERMARK_DELAY, efficiency: str = "delta"
) -> DataFrame:
    """Windows, then state over windows, in one query."""
    return EFFICIENCIES[efficiency](windows_stream(readings, delay))


def timeline_stream(readings: DataFrame) -> DataFrame:
    """Every reading, late or not, stamped with its time of writing."""
    now = F.current_timestamp()
    return readings.select("*", now.alias("ingest_ts"), now.cast("date").alias("ingest_date"))


def stateful_feeds(
    readings: DataFrame,
    delay: str = WATERMARK_DELAY,
    groups: int | None = None,
    efficiency: str = "delta",
) -> dict[str, DataFrame]:
    """The feeds of the status table that keep state. Defrost, which takes late
    readings too (X7), is a sink of :mod:`frostline.streaming.shared`."""
    return {
        "door": as_changes(door_stream(readings, delay, groups)),
        "efficiency": as_changes(efficiency_changes(efficiency_stream(readings, delay, efficiency))),
    }
