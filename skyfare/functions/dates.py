"""Date parsing and calendar expressions (all native Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text shapes (tried in order by the source system):
#   yyyy-m-dThh:mm:ss, yyyy-m-d hh:mm:ss, yyyy-m-d, d.m.yyyy hh:mm:ss, d.m.yyyy
# One or two digits per part, exactly four for the year; the day may also be
# a space and one digit (as strptime's %d allows); the separator 'T' is
# case-insensitive and a space between date and time stands for any
# whitespace run.  Anything else falls back to the first yyyy-mm-dd found in
# the text, at midnight.
_DAY = r"(\d{1,2}| [1-9])"
_TIME = r"\d{1,2}:\d{1,2}:\d{1,2}"
_ISO_SHAPE = rf"^\d{{4}}-\d{{1,2}}-{_DAY}([T ]{_TIME})?$"
_DOT_SHAPE = rf"^{_DAY}\.\d{{1,2}}\.\d{{4}}( {_TIME})?$"
_ISO_DAY_SPACE = (r"^(\d{4}-\d{1,2}-) ", "$1")
_DOT_TO_ISO = (r"^ ?(\d{1,2})\.(\d{1,2})\.(\d{4})", "$3-$2-$1")
_ANY_ISO_DAY = r"(\d{4}-\d{2}-\d{2})"


def parse_ts(text: Column) -> Column:
    """Multi-format timestamp parse -> TIMESTAMP_NTZ or NULL.

    A shape guard picks the rows each pattern would accept; dotted dates are
    reordered to ISO and the text is cast (a cheap, codegen'd parse with
    calendar validation, so 2025-02-30 is NULL).  Failing that, the first
    ``dddd-dd-dd`` in the text gives midnight of that day, so zoned or
    fractional texts keep their local date with no zone shift.
    """
    # whitespace runs between two digits (the date/time separator) -> one space
    s = F.upper(F.regexp_replace(text, r"(\d)\s+(\d)", "$1 $2"))
    shaped = (F.when(s.rlike(_ISO_SHAPE), F.regexp_replace(s, *_ISO_DAY_SPACE))
               .when(s.rlike(_DOT_SHAPE), F.regexp_replace(s, *_DOT_TO_ISO)))
    day = F.nullif(F.regexp_extract(text, _ANY_ISO_DAY, 1), F.lit(""))
    return F.coalesce(shaped.try_cast("timestamp_ntz"),
                      day.try_cast("date").cast("timestamp_ntz"))


def date_key(d: Column) -> Column:
    """yyyymmdd integer key of a date/timestamp (integer arithmetic on the
    calendar fields; no formatting, no time zone)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The calendar attributes of the date dimension; Monday = 1."""
    return [
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.when(F.weekday(d) >= 5, 1).otherwise(0).alias("is_weekend"),
    ]


def oracle_day_text(d: Column) -> Column:
    """TO_CHAR(d, 'DD-MON-YYYY')."""
    return F.upper(F.date_format(d, "dd-MMM-yyyy"))
