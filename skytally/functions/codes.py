"""Text codes, tolerant numeric coercion, partition labels and percentages."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_LABEL_STRFTIME = {
    "tech_year": "%Y", "tech_month": "%Y-%m", "tech_day": "%Y-%m-%d", "tech_hour": "%H",
}

# Spellings the JVM reads as a number though they are not one in a feed: Java's type
# suffixes ('1d', '1f') and hexadecimal floats.
_JVM_ONLY_NUMBER = r"(?i)[0-9.][df]\s*$|x"


def as_utc(at: datetime) -> datetime:
    """The same instant in UTC; a naive ``datetime`` is taken as UTC."""
    return at.astimezone(timezone.utc) if at.tzinfo else at.replace(tzinfo=timezone.utc)


def instant(at: datetime | Column) -> Column:
    """A point in time as a timestamp column."""
    return (F.lit(as_utc(at)) if isinstance(at, datetime) else at).cast("timestamp")


def normalize_code(code: Column) -> Column:
    """Upper case without surrounding spaces. Only spaces go; NULL stays NULL.

    ``'N/A'`` in a text code is kept as a value: only numeric coercion treats it as missing.
    """
    return F.trim(F.upper(code))


def is_blank(text: Column) -> Column:
    """NULL or empty."""
    return text.isNull() | (F.length(text) == 0)


def to_double(text: Column) -> Column:
    """Text to double; NULL for missing, empty, ``'N/A'`` or unparsable values."""
    return F.when(~text.rlike(_JVM_ONLY_NUMBER), text.try_cast("double"))


def to_int(value: Column) -> Column:
    """Value to int; text must be a whole number, a number is truncated towards zero."""
    return value.try_cast("int")


def json_to_int(value: Column) -> Column:
    """A JSON value (VARIANT) to int: text by ``to_int``, numbers truncated, true is 1."""
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "int")
    return F.when(F.schema_of_variant(value) == "STRING", to_int(text)).otherwise(number)


def count_when(condition: Column) -> Column:
    """Number of rows meeting the condition; NULL counts as not met."""
    return F.count_if(condition)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part / whole * 100`` rounded like Python's ``round``, and 0 when the whole is 0.

    That is the nearest decimal to the binary value, an exact tie going to the even digit;
    ``bround`` would round its shortest decimal spelling.
    """
    value = F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
    return round_binary(value, digits)


def bound(value: Column, result: Callable[[Column], Column]) -> Column:
    """``result`` of a value that is computed once, however often the result names it."""
    return F.get(F.transform(F.array(value), result), F.lit(0))


def round_binary(value: Column, digits: int) -> Column:
    """Round a non-negative double of moderate size half to even by its exact binary value.

    The distance to the decimal midpoint is computed without rounding: the value is split into
    leading bits and the rest, whose multiples are both exact, so the sign of their sum is too.
    """
    scale = 10 ** digits

    def down(v: Column) -> Column:
        low = F.floor(v * scale)
        # the product may have been rounded across a whole number
        return bound(low, lambda x: F.when(x / scale > v, x - 1).when((x + 1) / scale <= v, x + 1).otherwise(x))

    def gap(v: Column, below: Column) -> Column:
        head = F.floor(v * (1 << 20)) / (1 << 20)
        return bound(head, lambda h: (h * (2 * scale) - (below * 2 + 1)) + (v - h) * (2 * scale))

    def nearest(v: Column, below: Column) -> Column:
        return bound(gap(v, below), lambda g: F.when(g > 0, below + 1).when(g < 0, below).otherwise(
            below + F.pmod(below, F.lit(2))))

    rounded = bound(value, lambda v: bound(down(v), lambda below: nearest(v, below)))
    return (rounded / scale).cast("double")


def partition_labels(at: Column) -> dict[str, Column]:
    """The four hourly partition labels of an instant, in UTC whatever the session's zone."""
    day = utc_date(at).cast("string")
    hour = F.floor(F.pmod(F.unix_seconds(at), F.lit(86_400)) / 3600).cast("int")
    return dict(zip(_LABEL_STRFTIME, (
        F.substring(day, 1, 4), F.substring(day, 1, 7), day, F.lpad(hour.cast("string"), 2, "0"),
    ), strict=True))


def utc_date(at: Column) -> Column:
    """The UTC calendar day of a timestamp."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(at) / 86_400).cast("int"))


def utc_iso(at: Column) -> Column:
    """A timestamp as ISO text with microseconds, in UTC whatever the session's zone."""
    micros = F.pmod(F.unix_micros(at), F.lit(86_400_000_000))
    second = F.floor(micros / 1_000_000).cast("int")
    return F.when(at.isNotNull(), F.format_string(
        "%sT%02d:%02d:%02d.%06d", utc_date(at).cast("string"), F.floor(second / 3600).cast("int"),
        F.floor(F.pmod(second, F.lit(3600)) / 60).cast("int"), F.pmod(second, F.lit(60)),
        F.pmod(micros, F.lit(1_000_000)).cast("int")))


def partition_label_path(run_ts: datetime) -> str:
    """The labels of one run as a relative directory."""
    at = as_utc(run_ts)
    return "/".join(f"{name}={at:{pattern}}" for name, pattern in _LABEL_STRFTIME.items())
