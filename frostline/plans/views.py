"""What a monitoring dashboard asks for (V1-V8), as queries over the tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from frostline import schema as S
from frostline.functions import (
    clamp,
    first_element,
    http_date,
    on_off_label,
    significant_digits,
    strip_quotes,
    to_json_text,
)
from frostline.operators.timeline import extremes, latest_of_device, recent_values


def all_status(status: DataFrame) -> DataFrame:
    """Every device's status under the names the API gives."""
    return status.select(
        strip_quotes(F.col("device_id")).alias("deviceID"),
        F.col("door_open").alias("door-open"),
        "defrosted",
        "efficiency",
    )


def one_status(status: DataFrame, device_id: str, quoted: bool = False) -> DataFrame:
    """Status of one device, or no row if it is unknown.

    ``quoted`` looks the id up in a table whose ids are stored in quotes. The
    filter is on the stored column as it is, so it reaches the scan.
    """
    stored = f'"{device_id}"' if quoted else device_id
    return all_status(status.where(F.col("device_id") == F.lit(stored))).limit(1)


def latest_reading(timeline: DataFrame, device_id: str, quoted: bool = False) -> DataFrame:
    """The newest reading of one device under the API's names."""
    stored = f'"{device_id}"' if quoted else device_id
    return timeline_names(latest_of_device(timeline, stored))


def timeline_names(timeline: DataFrame) -> DataFrame:
    return timeline.select(
        strip_quotes(F.col("device_id")).alias("deviceID"),
        F.timestamp_millis("time_ms").alias("time_stamp"),
        strip_quotes(F.col("sensor_name_1")).alias("sensorName1"),
        F.col("temp").alias("sensorValue1"),
        strip_quotes(F.col("sensor_name_2")).alias("sensorName2"),
        F.col("kw").alias("sensorValue2"),
    )


def _json_object(rows: DataFrame) -> Column:
    """All columns as one struct, with timestamps as HTTP dates."""
    fields = []
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            column = http_date(column)
        fields.append(column.alias(field.name))
    return F.struct(*fields)


def json_elements(rows: DataFrame) -> DataFrame:
    """one JSON object per row, NULL fields kept, timestamps as HTTP dates.

    This is the form for a whole fleet: rows stay spread over the cluster, and
    written as text they are JSON lines.
    """
    return rows.select("deviceID", to_json_text(_json_object(rows)).alias("json"))


def json_pages(rows: DataFrame, name: str, page_rows: int) -> DataFrame:
    """V4: payloads ``{name: [...]}``, one per page of devices, sorted by id.

    A page is a range of ids with at most ``page_rows`` rows, so its array stays
    that small for any number of devices. Pages are numbered in the order of ids,
    with gaps. The API's own answer is one page of all rows.
    """
    ordered = rows.repartitionByRange("deviceID").sortWithinPartitions("deviceID")
    # The partition's number, and below it the row's place within.
    place = F.monotonically_increasing_id()
    in_range = place.bitwiseAND((1 << 33) - 1)
    page = F.struct(F.shiftright(place, 33), F.call_function("div", in_range, F.lit(page_rows)))
    listed = F.sort_array(F.collect_list(_json_object(rows)))
    return (
        ordered.withColumn("page_", page)
        .withColumn("page", F.shiftleft(F.col("page_.col1"), 33) + F.col("page_.col2"))
        .groupBy("page")
        .agg(listed.alias("items"))
        .select("page", to_json_text(F.struct(F.col("items").alias(name))).alias("json"))
    )


def one_payload(rows: DataFrame, name: str) -> DataFrame:
    """V4: the payload ``{name: [...]}`` of a request for one device, always one row.

    The list is empty for an unknown device. For views of a single device, which
    have at most one row; a whole fleet is served by :func:`json_pages`.
    """
    listed = rows.agg(F.sort_array(F.collect_list(_json_object(rows))).alias(name))
    return listed.select(to_json_text(F.struct(name)).alias("json"))


def status_panel(status: DataFrame) -> DataFrame:
    """V5: door and defrost as words."""
    return status.select(
        "device_id",
        on_off_label(F.col("door_open"), S.DOOR_LABELS).alias("door"),
        on_off_label(F.col("defrosted"), S.DEFROST_LABELS).alias("defrost"),
    )


def efficiency_gauge(status: DataFrame) -> DataFrame:
    """V6: the value shown, its unit, and where the needle stands."""
    low, high = S.GAUGE_RANGE
    return status.select(
        "device_id",
        significant_digits(F.col("efficiency")).alias("shown"),
        F.lit(S.GAUGE_UNIT).alias("unit"),
        clamp(F.col("efficiency"), low, high).alias("gauge_position"),
    )


def sparkline(readings: DataFrame, column: str, length: int = S.SPARKLINE_LENGTH) -> DataFrame:
    """V7: the newest values of each device with its all-time range.

    Both sides of the join are folded to a bounded number of rows per device.
    """
    return recent_values(readings, column, length).join(extremes(readings, column), "device_id")


def sparkline_point(payload: DataFrame, column: str, field: str) -> DataFrame:
    """the value a chart picks out of a latest-reading payload."""
    return payload.select("deviceID", first_element(F.col(column), field).alias("value"))


def device_list(readings: DataFrame) -> DataFrame:
    """V8: the devices there are, in order."""
    return readings.select("device_id").distinct().orderBy("device_id")
