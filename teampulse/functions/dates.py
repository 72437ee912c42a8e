"""Calendar helpers.  Weeks start on Monday unless a name says otherwise."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from teampulse.functions.text import _col

# Cursor formats the feeds use: with and without fractional seconds, offsets with and without a colon.
CURSOR_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSS]XX",
    "yyyy-MM-dd'T'HH:mm:ssXX",
)
STRICT_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"


def day(value: dt.date | str) -> Column:
    """Literal for an injected clock; plans never ask for the current date."""
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def monday(value: dt.date | str) -> dt.date:
    value = dt.date.fromisoformat(value) if isinstance(value, str) else value
    return value - dt.timedelta(days=value.weekday())


def week_start(c) -> Column:
    d = F.to_date(_col(c))
    return F.date_sub(d, F.weekday(d))


def week_end(start) -> Column:
    return F.date_add(_col(start), 6)


def month_start(c) -> Column:
    return F.trunc(F.to_date(_col(c)), "month")


def iso_week(c) -> Column:
    return F.weekofyear(_col(c)).cast("bigint")


def sunday_week(c) -> Column:
    """Week of the year counted from the first Sunday, 0 to 53."""
    c = _col(c)
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("bigint")


def days_since(c, as_of) -> Column:
    return F.datediff(day(as_of), F.to_date(_col(c))).cast("bigint")


def long_date(c) -> Column:
    return F.date_format(_col(c), "MMMM dd, yyyy")


def month_label(c) -> Column:
    return F.date_format(_col(c), "MMMM yyyy")


def parse_cursor(c) -> Column:
    """First cursor format that fits; NULL when none does."""
    c = _col(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in CURSOR_FORMATS])


def parse_utc_strict(c) -> Column:
    """Timestamp of a ``…Z`` text.  Anything else fails the job, NULL stays NULL."""
    c = _col(c)
    parsed = F.when(c.rlike(STRICT_UTC), F.try_to_timestamp(c))
    problem = F.raise_error(F.concat(F.lit("not a UTC timestamp: "), c)).cast("timestamp")
    return F.when(c.isNotNull(), F.coalesce(parsed, problem))


def weeks_between(start, end) -> Column:
    """Array of Mondays from start to end; empty when start is NULL or after end."""
    start, end = _col(start), _col(end)
    span = F.sequence(start, end, F.expr("interval 7 days"))
    return F.when(start <= end, span).otherwise(F.array().cast("array<date>"))
