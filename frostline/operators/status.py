"""The current status of each device, merged from three feeds."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.operators.defrost import defrost_events
from frostline.operators.efficiency import efficiency_delta, efficiency_rolling
from frostline.operators.pattern import door_alerts, rising_pairs
from frostline.operators.work import work_windows
from frostline.schema import STATUS_CHANGE_SCHEMA

FLAGS = ["door_open", "defrosted", "efficiency"]


def as_changes(feed: DataFrame) -> DataFrame:
    """A feed that sets one status column, in the shape all changes share."""
    return feed.select(*_change_columns(feed.columns))


def _change_columns(columns: list[str]) -> list[Column]:
    return [
        (F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in STATUS_CHANGE_SCHEMA.fields
    ]


def efficiency_changes(efficiency: DataFrame) -> DataFrame:
    """Efficiency as a status feed: it takes effect when its window ends."""
    return efficiency.select(
        "device_id",
        "efficiency",
        F.col("window_end_ms").alias("time_ms"),
        F.lit(0).cast("bigint").alias("seq"),
    )


def union_changes(*feeds: DataFrame) -> DataFrame:
    """A union and one fold stand for outer joins of the feeds."""
    return reduce(DataFrame.unionByName, [as_changes(f) for f in feeds])


def latest_changes(changes: DataFrame, *also: str) -> DataFrame:
    """A5: per device (and ``also``) and column, the last value set, with its own time.

    Combines on the map side, so the shuffle carries a row per device and task.
    The result can be folded again with further changes.
    """
    order = "struct(time_ms, seq)"
    last = [
        F.expr(f"max(struct({order} AS at, {c} AS v)) FILTER (WHERE {c} IS NOT NULL)").alias(c)
        for c in FLAGS
    ]
    return changes.groupBy("device_id", *also).agg(*last)


def fold_status(changes: DataFrame) -> DataFrame:
    """One row per device, each column holding its last value."""
    folded = latest_changes(changes)
    return folded.select("device_id", *[F.col(c)["v"].alias(c) for c in FLAGS])


def compact_changes(changes: DataFrame, *also: str) -> DataFrame:
    """The fewest changes that fold to the same status: one per column set.

    With further columns ``also``, which are kept, for each of their values apart.

    A device of which nothing is known yet keeps one change that sets nothing.
    """
    folded = latest_changes(changes, *also)
    unknown = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in FLAGS])
    one = [
        F.struct(
            *[(F.col(c)["v"] if c == kept else F.lit(None)).alias(c) for c in FLAGS],
            F.col(kept)["at"]["time_ms"].alias("time_ms"),
            F.col(kept)["at"]["seq"].alias("seq"),
            (F.col(kept).isNotNull() | (unknown if kept == FLAGS[0] else F.lit(False))).alias("set"),
        )
        for kept in FLAGS
    ]
    spread = folded.select("device_id", *also, F.inline(F.array(*one)))
    return spread.where("set").select(*_change_columns(spread.columns), *also)


EFFICIENCIES = {"delta": efficiency_delta, "rolling": efficiency_rolling}


def status_changes(
    readings: DataFrame,
    dense_ms: int | None = None,
    efficiency: str = "delta",
    folded_by: Sequence[Column] | None = None,
) -> DataFrame:
    """All three feeds of a table of readings (U2). Each scans what it needs.

    ``efficiency`` is ``delta`` (A4) or ``rolling`` (A3). With ``folded_by``, columns
    made from those of a change, efficiency is the last one of each device and value of
    these, so a fold by device and the same columns comes out alike.
    """
    windows = efficiency_changes(EFFICIENCIES[efficiency](work_windows(readings, keep_bucket=True)))
    return union_changes(
        door_alerts(rising_pairs(readings, dense_ms=dense_ms)),
        defrost_events(readings),
        windows if folded_by is None else latest_efficiency(windows, *folded_by),
    )


def latest_efficiency(changes: DataFrame, *by: Column) -> DataFrame:
    """A feed of efficiency, folded to the last value set for each device and value of ``by``.

    There are many windows to a reading. A fold of structs sorts them all; with one
    change for each end of a window, plain numbers do, and a hash aggregate holds a
    row for each group. Where no value is set, a change that sets nothing stays.
    """
    is_set = "FILTER (WHERE efficiency IS NOT NULL)"
    return changes.groupBy("device_id", *by).agg(
        F.expr(f"max_by(efficiency, time_ms) {is_set}").alias("efficiency"),
        F.expr(f"coalesce(max(time_ms) {is_set}, max(time_ms))").alias("time_ms"),
        F.max("seq").alias("seq"),
    )


def status_table(readings: DataFrame, dense_ms: int | None = None, efficiency: str = "delta") -> DataFrame:
    return fold_status(status_changes(readings, dense_ms, efficiency, folded_by=()))
