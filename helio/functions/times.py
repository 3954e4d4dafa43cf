"""Event time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# An epoch number larger than this is in milliseconds; years 1 to 9999.
MILLISECOND_FLOOR = 1e12
MIN_EPOCH, MAX_EPOCH = -62_135_596_800, 253_402_300_799

EPOCH_TEXT = r"^-?\d+$"
BASIC_TEXT = r"^\d{8}T\d{6}(Z|[+-]\d{2}:?\d{2})?$"
WEEK_TEXT = r"^\d{4}-W\d{2}-[1-7]$"
UNPADDED_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}($|[T ])"


def _from_epoch(number: Column) -> Column:
    seconds = F.when(F.abs(number) > MILLISECOND_FLOOR, number / 1000.0).otherwise(number)
    micros = F.round(seconds * 1_000_000.0).try_cast("bigint")
    return F.when(seconds.between(MIN_EPOCH, MAX_EPOCH), F.timestamp_micros(micros))


def _from_week(text: Column) -> Column:
    """ISO year, week and weekday: week 1 is the one with 4 January."""
    first = F.date_trunc("week", F.try_to_timestamp(F.concat(F.substring(text, 1, 4), F.lit("-01-04"))))
    days = (F.substring(text, 7, 2).try_cast("int") - 1) * 7 + F.substring(text, 10, 1).try_cast("int") - 1
    found = F.dateadd(first, days)
    real = F.weekofyear(found) == F.substring(text, 7, 2).try_cast("int")
    return F.when(real, found.cast("timestamp"))


def parse_event_time(value: Column, dtype: T.DataType | None = None) -> Column:
    """A live record's time as a UTC timestamp, null where it cannot be read.

    Numbers and digit texts are epoch seconds, or milliseconds when large; other texts
    are ISO dates or date-times, extended, basic or by week, or unpadded, UTC where they name no
    offset. Callers that want
    arrival time as a fallback coalesce it in, which keeps the result repeatable.
    """
    dtype = dtype or T.StringType()
    if isinstance(dtype, T.TimestampType):
        return value
    if isinstance(dtype, T.TimestampNTZType):
        return value.cast("timestamp")
    if isinstance(dtype, T.NumericType):
        return _from_epoch(value.cast("double"))
    text = F.trim(value)
    # most texts are dates, so they are told by two dashes before any pattern is tried
    dated = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return (
        F.when(dated, F.try_to_timestamp(text))
        .when(text.rlike(EPOCH_TEXT), _from_epoch(text.try_cast("double")))
        .when(text.rlike(BASIC_TEXT), F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss[XXX][XX]")))
        .when(text.rlike(UNPADDED_TEXT), F.try_to_timestamp(text))
        .when(text.rlike(WEEK_TEXT), _from_week(text))
    )


def to_event_time(value: Column, dtype: T.DataType | None = None) -> Column:
    """``time_tag`` as a timestamp by Spark's own reading, null where it is malformed."""
    dtype = dtype or T.StringType()
    if isinstance(dtype, T.TimestampType):
        return value
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(value)
    return value.cast("timestamp")


def snapshot_key(time_tag: Column) -> Column:
    """The name a snapshot is stored under: its time with ``:`` and ``/`` replaced."""
    return F.translate(time_tag.cast("string"), ":/", "--")
