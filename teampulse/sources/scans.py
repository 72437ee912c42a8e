"""Reading landed feeds, record lists, the roster and time slices."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.sources import schemas as S


def read_feed(spark: SparkSession, path: str, feed: str, fmt: str = "json") -> DataFrame:
    """Events of one feed.  The schema is given, so nothing is inferred and unused leaves are not parsed."""
    return spark.read.schema(S.ENVELOPE).format(fmt).load(path).where(F.col("name") == S.FEEDS[feed])


def read_records(spark: SparkSession, path: str, table: str, fmt: str = "json") -> DataFrame:
    """``events_list`` or ``event_attendees`` as flat records."""
    return spark.read.schema(S.RECORD_SHAPES[table]).format(fmt).load(path)


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """The manager roster; every column is text so that a bad value cannot fail the load."""
    return spark.read.schema(S.MANAGER_ROSTER).csv(path, header=True, quote='"', escape='"', multiLine=True)


def replace_roster(spark: SparkSession, csv_path: str, table_path: str) -> DataFrame:
    """Load the roster file over the previous copy."""
    read_roster(spark, csv_path).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(table_path)
    return spark.read.schema(S.MANAGER_ROSTER).parquet(table_path)


def records_of_page(pages: DataFrame, body: str, field: str, shape: str, keep: list[str] = ()) -> DataFrame:
    """Rows of the record array ``field`` inside response documents."""
    doc = F.from_json(F.col(body), f"struct<{field}:array<{shape}>>")
    return pages.select(*keep, F.inline(doc[field]))


def time_slice(df: DataFrame, cursor: str, after: dt.datetime, until: dt.datetime, month: str | None = None) -> DataFrame:
    """Rows with ``after < cursor <= until``.

    With ``month`` (a date partition column) the months of the slice are named
    too, so that only their folders are listed and read.
    """
    rows = df.where((F.col(cursor) > F.lit(after)) & (F.col(cursor) <= F.lit(until)))
    if month is not None:
        first, last = after.date().replace(day=1), until.date().replace(day=1)
        rows = rows.where(F.col(month).between(F.lit(first), F.lit(last)))
    return rows


def add_months(at: dt.datetime, n: int) -> dt.datetime:
    """Same day ``n`` months on, or the last day of a shorter month."""
    years, month = divmod(at.month - 1 + n, 12)
    year, month = at.year + years, month + 1
    return at.replace(year=year, month=month, day=min(at.day, calendar.monthrange(year, month)[1]))


def month_slices(start: dt.datetime, end: dt.datetime) -> list[tuple[dt.datetime, dt.datetime]]:
    """Consecutive one-month slices that cover start to end."""
    out, k = [], 0
    while (low := add_months(start, k)) < end:
        k += 1
        out.append((low, min(add_months(start, k), end)))
    return out
