"""Reporting periods: the newest one, the last finished one, the one before."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teampulse.functions.dates import monday
from teampulse.operators.grid import WEEK


MONTH = "month"  # folder column of tables stored by week


def newest(df: DataFrame, column: str = WEEK) -> Column:
    """Largest value of a column as a one-value subquery; the newest week lies in the newest month folder."""
    if column == WEEK and MONTH in df.columns:
        df = df.where(F.col(MONTH) == df.agg(F.max(MONTH)).scalar())
    return df.agg(F.max(column).alias("m")).scalar()


def last_finished_week(df: DataFrame, as_of: dt.date | str) -> Column:
    """Newest week that ended before the week of ``as_of``.

    It lies in the folder of that week's month or in the newest one before it.
    """
    start = F.lit(monday(as_of))
    if MONTH in df.columns:
        this = F.trunc(start, "month")
        before = df.where(F.col(MONTH) < this).agg(F.max(MONTH)).scalar()
        df = df.where(F.col(MONTH) >= F.coalesce(before, this))
    return df.where(F.col(WEEK) < start).agg(F.max(WEEK).alias("m")).scalar()


def only_newest(df: DataFrame, column: str = WEEK) -> DataFrame:
    return df.where(F.col(column) == newest(df, column))


def with_previous_week(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Add values of the week before, zero when there is no such row.

    ``columns`` maps a column to the name its previous value gets.  A window over
    the two rows of a key replaces the self join, so the table is shuffled once.
    """
    w = Window.partitionBy(*keys).orderBy(WEEK)
    adjacent = F.lag(WEEK).over(w) == F.date_sub(WEEK, 7)
    zero = F.lit(0).cast("bigint")
    return df.withColumns(
        {new: F.coalesce(F.when(adjacent, F.lag(old).over(w)), zero) for old, new in columns.items()}
    )
