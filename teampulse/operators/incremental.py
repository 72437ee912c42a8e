"""How far back an incremental run reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.functions.safe import to_ts
from teampulse.operators.grid import WEEK
from teampulse.sources.schemas import EXTRACTED_AT

EPOCH = dt.datetime(1970, 1, 1)
EPOCH_MONDAY = dt.date(1970, 1, 5)


def _max(df: DataFrame | None, column: str):
    return None if df is None else df.agg(F.max(column)).head()[0]


def _newest(df: DataFrame | None, column: str):
    """Largest date of a table in month folders by that date: it lies in the newest folder."""
    if df is not None and "month" in df.columns and column != "month":
        df = df.where(F.col("month") == df.agg(F.max("month")).scalar())
    return _max(df, column)


def newly_extracted(raw: DataFrame, newest: dt.datetime | Column | None, lookback: dt.timedelta = dt.timedelta(days=1)):
    """Rows extracted since the target's newest extraction, with a lookback; all rows without one."""
    if newest is None:
        return raw
    start = F.lit(newest - lookback) if isinstance(newest, dt.datetime) else F.coalesce(
        newest - F.expr(f"INTERVAL {int(lookback.total_seconds())} SECONDS"), F.lit(EPOCH)
    )
    return raw.where(to_ts(EXTRACTED_AT) >= start)


def extraction_mark(target: DataFrame | None) -> dt.datetime | None:
    """Newest extraction time stored so far; one small job, so that the filter is a literal the scan can use."""
    return _max(target, EXTRACTED_AT)


def weeks_since(target: DataFrame | dt.date | None, weeks: int = 4) -> dt.date | None:
    """First week to count again; None for everything.  ``target``: the counts so far, or their newest week."""
    newest = target if isinstance(target, dt.date) else _newest(target, WEEK)
    return None if newest is None else newest - dt.timedelta(weeks=weeks)


def months_since(target: DataFrame | dt.date | None, column: str = "month_start_date") -> dt.date | None:
    """First month to count again: the one before the newest.  ``target``: the counts so far, or their newest month."""
    newest = target if isinstance(target, dt.date) else _newest(target, column)
    return None if newest is None else (newest.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
