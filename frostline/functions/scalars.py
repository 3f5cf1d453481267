"""Column-to-column functions (F2, F3, F6, F10-F16). All stay in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from frostline.schema import HTTP_DATE_FORMAT

# The largest double that is also a 64-bit whole number.
LARGEST_LONG = float(2**63 - 1024)
# Powers of ten up to this one are doubles without rounding.
LARGEST_EXACT_POWER = 22


def whole_millis(time: Column) -> Column:
    """epoch milliseconds without their fraction, NULL when out of range."""
    return time.try_cast("bigint")


def float32_millis(time: Column) -> Column:
    """F3 in single precision: times snap to a grid of about 131 seconds."""
    return time.cast("float").cast("bigint")


def event_timestamp(time_ms: Column) -> Column:
    """epoch milliseconds as a timestamp."""
    return F.timestamp_millis(time_ms)


def strip_quotes(text: Column) -> Column:
    """drop double quotes stored inside ids and names."""
    return F.replace(text, F.lit('"'), F.lit(""))


def truncated(value: Column) -> Column:
    """the whole part, cut toward zero, as temperatures are compared.

    Values beyond a 64-bit number count as the nearest one, and never fail.
    """
    return clamp(value, -LARGEST_LONG, LARGEST_LONG).cast("bigint")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL on a zero divisor, where IEEE would give an infinity or NaN."""
    return F.try_divide(numerator, denominator)


def significant_digits(value: Column, digits: int = 4) -> Column:
    """round the exact value to significant digits, halves away from zero.

    The JVM's formatting rounds the shortest decimal text of a double. That is on
    the same side of a half as the exact value, unless the text is the half itself;
    there the exact value is compared with it. Exact for values from 1e-17 to 1e26,
    zero and what is not finite; outside, such a half goes away from zero.
    """
    size = F.abs(value)
    text = F.format_string(f"%.{digits}e", size)  # a digit more than asked for
    half = F.regexp_like(text, F.lit("5e")) & (text.try_cast("double") == size)
    number = F.replace(F.substring_index(text, "e", 1), F.lit(".")).try_cast("bigint")
    exponent = F.substring_index(text, "e", -1).try_cast("int") - digits
    up = _at_least(size, number.cast("double"), exponent)
    kept = F.call_function("div", number, F.lit(10)) + up.cast("bigint")
    rounded = F.concat_ws("e", kept.cast("string"), (exponent + 1).cast("string")).try_cast("double")
    plain = F.format_string(f"%.{digits - 1}e", value).try_cast("double")
    return F.when(half, F.when(value < 0, -rounded).otherwise(rounded)).when(value.isNotNull(), plain)


def _at_least(size: Column, number: Column, exponent: Column) -> Column:
    """Whether ``size >= number * 10 ** exponent``, of the exact values."""
    power = F.pow(F.lit(10.0), F.least(F.abs(exponent), F.lit(LARGEST_EXACT_POWER)).cast("double"))
    shrunk, rest = _product(size, power)
    below_one = (shrunk > number) | ((shrunk == number) & (rest >= 0))
    grown, over = _product(number, power)
    above_one = (size > grown) | ((size == grown) & (over <= 0))
    exact = F.abs(exponent) <= LARGEST_EXACT_POWER
    return ~exact | F.when(exponent < 0, below_one).otherwise(above_one)


def _product(a: Column, b: Column) -> tuple[Column, Column]:
    """A product of doubles, and what its rounding has left out."""
    (a_high, a_low), (b_high, b_low) = _halves(a), _halves(b)
    product = a * b
    rest = a_high * b_high - product + a_high * b_low + a_low * b_high + a_low * b_low
    return product, rest


def _halves(value: Column) -> tuple[Column, Column]:
    """A double as two of at most 26 bits, whose products are exact."""
    scaled = value * F.lit(float(2**27 + 1))
    high = scaled - (scaled - value)
    return high, value - high


def first_element(array: Column, field: str) -> Column:
    """one field of each element, then the first one; NULL when empty."""
    return F.get(F.transform(array, lambda x: x[field]), F.lit(0))


def on_off_label(flag: Column, labels: tuple[str, str]) -> Column:
    """F16: a flag as text; an unknown flag counts as off."""
    on, off = labels
    return F.when(F.coalesce(flag, F.lit(False)), F.lit(on)).otherwise(F.lit(off))


def clamp(value: Column, low: float, high: float) -> Column:
    """V6: hold a value inside a range. NULL stays NULL."""
    held = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), held)


def http_date(ts: Column) -> Column:
    """a timestamp as an HTTP date."""
    return F.date_format(ts, HTTP_DATE_FORMAT)


def to_json_text(value: Column) -> Column:
    """JSON text that keeps NULL fields."""
    return F.to_json(value, {"ignoreNullFields": "false"})
