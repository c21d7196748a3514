"""Text to date, date to text, and day differences.

Dates are held as ``timestamp_ntz`` in UTC wall-clock time, so that no result
depends on the time zone of the session that runs the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What follows date and time of day: nothing, or a zone or offset.
_TAIL = r"^\d{4}-\d{1,2}-\d{1,2}(?:[T ]\s*\d[\d:.]*)?(.*)$"
# "Jan  1 2013 12:00AM", the text a database may write for a date-time by default.
_MONTH_FIRST = r"^\s*[A-Za-z]{3}\s+\d{1,2}\s+\d{4}\s+\d{1,2}:\d{2}[AaPp][Mm]\s*$"


def utc(instant: Column) -> Column:
    """UTC wall-clock time of a zoned ``timestamp``, in whatever zone the session is."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def _from_iso(text: Column) -> Column:
    # Casts alone would also take a year, a month or a time of day for a date.
    body = F.trim(text)
    dated = (F.substring(body, 5, 1) == "-") & (F.length(body) >= len("2013-1-1"))
    timed = F.length(body) > len("2013-01-01")
    # With a tail, an instant or nothing: a plain cast would drop the tail unread.
    zoned = timed & (F.regexp_extract(body, _TAIL, 1) != "")
    in_utc, plain = utc(body.try_cast("timestamp")), body.try_cast("timestamp_ntz")
    return F.when(dated, F.when(zoned, in_utc).otherwise(plain))


def _from_month_first(text: Column) -> Column:
    # The offset in the text keeps the session's zone out of the reading.
    squeezed = F.concat(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(" +0000"))
    instant = F.try_to_timestamp(squeezed, F.lit("MMM d yyyy h:mma xx"))
    return F.when(text.rlike(_MONTH_FIRST), utc(instant))


def parse_date(text: Column, on_error: str = "raise") -> Column:
    """Text to ``timestamp_ntz`` in UTC; null stays null.

    Reads ISO dates and date-times, with or without an offset or zone, and the form
    ``Jan  1 2013 12:00AM``. Other text, an unknown zone as well, raises, or gives null with
    ``on_error="null"``; ``rejected_dates`` lists those rows.
    """
    readings = [_from_iso(text), _from_month_first(text)]
    if on_error == "raise":
        complaint = F.raise_error(F.concat(F.lit("not a date: "), text))
        readings.append(F.when(text.isNotNull(), complaint.cast("timestamp_ntz")))
    elif on_error != "null":
        raise ValueError(f"on_error is 'raise' or 'null', not {on_error!r}")
    return F.coalesce(*readings)


def as_date(column: Column, data_type: T.DataType, on_error: str = "raise") -> Column:
    """``parse_date`` for text, no change for what is a date already."""
    if isinstance(data_type, T.StringType):
        return parse_date(column, on_error)
    if isinstance(data_type, T.TimestampType):
        return utc(column)
    return column.cast("timestamp_ntz")


def rejected_dates(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows ``(key, field, text)`` for each text that is not a date."""
    found = F.array(
        *[
            F.when(
                F.col(c).isNotNull() & parse_date(F.col(c), "null").isNull(),
                F.struct(F.lit(c).alias("field"), F.col(c).alias("text")),
            )
            for c in columns
        ]
    )
    rejects = F.filter(found, lambda r: r.isNotNull())
    return df.select(key, F.inline(rejects))


def days_between(start: Column, end: Column) -> Column:
    """Midnights between two dates, signed: 23:00 to 01:00 the next day is 1.

    Both are ``timestamp_ntz`` as ``parse_date`` gives them; pass a zoned
    ``timestamp`` through ``utc`` first.
    """
    return F.datediff(end, start)


def iso_day(date: Column) -> Column:
    """Date to ``yyyy-MM-dd`` text."""
    return F.date_format(date, "yyyy-MM-dd")


def month_first_text(date: Column) -> Column:
    """Date-time to text such as ``Jan  1 2013 12:00AM``, day and hour padded to two."""

    def padded(pattern: str) -> Column:
        return F.lpad(F.date_format(date, pattern), 2, " ")

    return F.concat(
        F.date_format(date, "MMM"),
        F.lit(" "),
        padded("d"),
        F.date_format(date, " yyyy "),
        padded("h"),
        F.date_format(date, ":mma"),
    )
