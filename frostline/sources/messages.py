"""JSON messages to readings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline import schema as S
from frostline.functions import event_timestamp, float32_millis, whole_millis

# "NaN" and the like are not numbers in JSON.
_STRICT_NUMBERS = {"allowNonNumericNumbers": "false"}

# The year 2262, to which pandas timestamps reach. One reading from beyond it
# would also push the watermark past all others.
MAX_TIME_MS = 9_223_372_036_854

# Up to here, sums of energy are exact; see ``KW_TYPE``.
MAX_KW = 1e12


def parse(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Decode the ``value`` column; adds one column per message key.

    Going through a generator makes Spark parse each message once. As a plain
    projection, a filter on the decoded fields would be pushed below it and
    parse the message again.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COLUMN, **_STRICT_NUMBERS}
    text = F.col(value).cast("string")
    decoded = F.from_json(text, S.MESSAGE_SCHEMA, options)
    return messages.select(*keep, text.alias("value"), F.inline(F.array(decoded)))


def _field(key: str) -> Column:
    return F.col(f"`{key}`")


def _malformed() -> Column:
    return F.col("value").isNull() | _field(S.CORRUPT_COLUMN).isNotNull()


def _is_bad() -> Column:
    """S3. A missing key is not malformed JSON to Spark, so look at each field."""
    required = [
        S.JSON_DEVICE_ID,
        S.JSON_SENSOR_NAME_1,
        S.JSON_SENSOR_VALUE_1,
        S.JSON_SENSOR_NAME_2,
        S.JSON_SENSOR_VALUE_2,
    ]
    time_ms = whole_millis(_field(S.JSON_TIME))
    bad = _malformed() | time_ms.isNull() | ~time_ms.between(-MAX_TIME_MS, MAX_TIME_MS)
    for key in required:
        bad = bad | _field(key).isNull()
    # Too large a number is read as infinite. NaN is greater than any number.
    temp, kw = F.abs(_field(S.JSON_SENSOR_VALUE_1)), F.abs(_field(S.JSON_SENSOR_VALUE_2))
    return bad | (temp >= float("inf")) | (kw > MAX_KW)


def _time_ms(precision: str) -> Column:
    if precision == "exact":
        return whole_millis(_field(S.JSON_TIME))
    if precision == "float32":
        return float32_millis(_field(S.JSON_TIME))
    raise ValueError(f"time_precision must be 'exact' or 'float32', not {precision!r}")


def decode(
    messages: DataFrame,
    value: str = "value",
    seq: str = "seq",
    mode: str = "PERMISSIVE",
    time_precision: str = "exact",
) -> DataFrame:
    """messages to readings.

    ``PERMISSIVE`` leaves bad messages out, to be read with :func:`quarantine`.
    ``FAILFAST`` ends the job at the first bad one.
    """
    return accepted(parse(messages, value, (seq,)), seq, mode, time_precision)


def accepted(
    parsed: DataFrame,
    seq: str = "seq",
    mode: str = "PERMISSIVE",
    time_precision: str = "exact",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """readings of messages that :func:`parse` has decoded; see :func:`decode`.

    ``keep`` names further columns to go through.
    """
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError(f"mode must be 'PERMISSIVE' or 'FAILFAST', not {mode!r}")
    good = ~_is_bad()
    if mode == "FAILFAST":
        shown = F.coalesce(F.col("value"), F.lit("NULL"))
        refusal = F.raise_error(F.concat(F.lit("bad reading: "), shown)).cast("boolean")
        good = F.when(good, F.lit(True)).otherwise(refusal)
    time_ms = _time_ms(time_precision)
    return parsed.where(good).select(
        _field(S.JSON_DEVICE_ID).alias("device_id"),
        time_ms.alias("time_ms"),
        event_timestamp(time_ms).alias("ts"),
        F.col(seq).alias("seq"),
        _field(S.JSON_SENSOR_NAME_1).alias("sensor_name_1"),
        _field(S.JSON_SENSOR_VALUE_1).alias("temp"),
        _field(S.JSON_SENSOR_NAME_2).alias("sensor_name_2"),
        _field(S.JSON_SENSOR_VALUE_2).alias("kw"),
        *keep,
    )


def quarantine(messages: DataFrame, value: str = "value", seq: str = "seq") -> DataFrame:
    """S3: the messages :func:`decode` leaves out, whole, with a reason."""
    return rejected(parse(messages, value, (seq,)), seq)


def rejected(parsed: DataFrame, seq: str = "seq", keep: tuple[str, ...] = ()) -> DataFrame:
    """S3: those among messages that :func:`parse` has decoded; see :func:`quarantine`."""
    reason = F.when(_malformed(), F.lit("malformed")).otherwise(F.lit("unusable field"))
    return parsed.where(_is_bad()).select(F.col(seq).alias("seq"), "value", reason.alias("reason"), *keep)


KNOWN_KEYS = (
    S.JSON_TIME,
    S.JSON_DEVICE_ID,
    S.JSON_SENSOR_NAME_1,
    S.JSON_SENSOR_VALUE_1,
    S.JSON_SENSOR_NAME_2,
    S.JSON_SENSOR_VALUE_2,
)


def with_extra(parsed: DataFrame) -> DataFrame:
    """Q8: add ``extra``, the keys of a message that no column is for, as a VARIANT map.

    Values keep their JSON types. Empty for a message without other keys, and NULL
    for one that is no JSON object. ``parsed`` comes from :func:`parse`.
    """
    whole = F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>")
    return parsed.withColumn("extra", F.map_filter(whole, lambda key, _: ~key.isin(*KNOWN_KEYS)))


def decode_with_extra(messages: DataFrame, value: str = "value", seq: str = "seq", **options) -> DataFrame:
    """:func:`decode`, with the other keys of each message in ``extra``."""
    parsed = with_extra(parse(messages, value, (seq,)))
    return accepted(parsed, seq, keep=("extra",), **options)


def extra_json(extra: Column) -> Column:
    """What :func:`with_extra` gives as JSON text, keys in order; NULL if there is nothing."""
    entries = F.array_sort(F.map_keys(extra))
    ordered = F.map_from_arrays(entries, F.transform(entries, lambda key: F.get(F.map_values(extra), _place(extra, key))))
    return F.when(F.size(extra) > 0, F.to_json(ordered))


def _place(extra: Column, key: Column) -> Column:
    return (F.array_position(F.map_keys(extra), key) - 1).cast("int")


def encode(readings: DataFrame, *keep: str) -> DataFrame:
    """Readings back to messages: ``value`` (JSON text), ``seq`` and columns to keep."""
    body = F.struct(
        F.col("time_ms").cast("double").alias(S.JSON_TIME),
        F.col("device_id").alias(S.JSON_DEVICE_ID),
        F.col("sensor_name_1").alias(S.JSON_SENSOR_NAME_1),
        F.col("temp").alias(S.JSON_SENSOR_VALUE_1),
        F.col("sensor_name_2").alias(S.JSON_SENSOR_NAME_2),
        F.col("kw").alias(S.JSON_SENSOR_VALUE_2),
    )
    return readings.select(F.to_json(body).alias("value"), "seq", *keep)
