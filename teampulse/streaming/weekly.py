"""Counts per week or month and the keyed upsert as Structured Streaming queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from teampulse.functions import dates as D
from teampulse.operators.dedup import keep_latest
from teampulse.operators.grid import MEMBER, WEEK
from teampulse.session import stored
from teampulse.sources import tables

MONTH = "month_start_date"


def weekly_counts(stream: DataFrame, member: str, item: str, at: str, out: str, lateness: str = "28 days") -> DataFrame:
    """Distinct items per member and Monday week.

    Exact distinct counts do not exist on streams, so items are made distinct per
    week first; the state holds one entry per (member, item, week) until the
    watermark passes.  A week is emitted once it is closed.
    """
    week = F.window(at, "7 days", "7 days", "4 days")  # the epoch is a Thursday
    rows = (
        stream.where(F.col(member).isNotNull() & F.col(item).isNotNull())
        .withWatermark(at, lateness)
        .select(F.col(member).alias(MEMBER), F.col(item).alias("__item"), week.alias("__w"))
        .dropDuplicates([MEMBER, "__item", "__w"])
    )
    counted = rows.groupBy("__w", MEMBER).agg(F.count(F.lit(1)).alias(out))
    return counted.select(MEMBER, F.to_date("__w.start").alias(WEEK), out)


def recount_writer(
    stream: DataFrame,
    root: str,
    member: str,
    item: str,
    at: str,
    out: str,
    period: str = WEEK,
    lookback: dt.timedelta | None = None,
    compact_every: int = 50,
) -> DataStreamWriter:
    """Distinct items per member and week or month, also of periods that are still open.

    Each batch adds the items that are new to its months and counts the touched members and
    periods again, so the counts below ``root`` are always those of all items so far.  Items
    are only added: stored ones are read in the batch's months, and not written again but in
    every ``compact_every``-th batch, which makes one set of files of its months.  With
    ``lookback``, items older than that before the newest period are left out, as in the batch
    run.  A batch that is replayed after a failure finds its items and counts them again.
    """
    start = D.month_start if period == MONTH else D.week_start
    keys = [MEMBER, "item", period]

    def count_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(F.col(member).isNotNull() & F.col(item).isNotNull() & F.col(at).isNotNull())
        fresh = rows.select(F.col(member).alias(MEMBER), F.col(item).alias("item"), start(at).alias(period)).distinct()
        path = f"{root}/items"
        known = tables.exists(spark, f"{path}/{tables.COLUMNS}")
        newest = tables.newest(spark, path, period) if known and lookback is not None else None
        if newest is not None:
            fresh = fresh.where(F.col(period) >= F.lit(newest - lookback))
        fresh = stored(fresh, "fresh")
        months = tables.months_of(fresh, period)
        if not months:
            return
        new = fresh
        if known:
            new = fresh.join(tables.in_months(tables.read_table(spark, path), months), keys, "left_anti")
        items = tables.append_rows(new, path, period)
        if number % compact_every == compact_every - 1:
            items = tables.compact(spark, path, months, keys)
        touched = fresh.select(MEMBER, period).distinct()
        counts = tables.in_months(items, months).join(touched, [MEMBER, period], "left_semi")
        # a task that was committed twice may have added an item twice
        counts = counts.groupBy(MEMBER, period).agg(F.countDistinct("item").alias(out))
        tables.upsert(spark, f"{root}/counts", counts, [MEMBER, period], period, [MEMBER, period])

    return (
        stream.writeStream.foreachBatch(count_batch)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
    )


def deduplicated(stream: DataFrame, key: str, at: str, lateness: str = "1 day") -> DataFrame:
    """First arrival of each key within the watermark."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark([key])


def upsert_writer(
    stream: DataFrame,
    path: str,
    keys: list[str],
    version: str,
    by: str,
    checkpoint: str,
    clean: Callable[[DataFrame], DataFrame] | None = None,
    ties: list[str] = (),
) -> DataStreamWriter:
    """Keep the latest version of each key in a month-partitioned table.

    A batch that is replayed after a failure writes the same rows again.
    """

    def merge_batch(batch: DataFrame, _: int) -> None:
        rows = clean(batch) if clean else batch
        newest = keep_latest(rows, keys, version, list(ties))
        order = [F.col(version).desc(), *[F.col(t).desc() for t in ties]]
        tables.upsert(batch.sparkSession, path, newest, keys, by, keys, resolve=order)

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def run_to_end(writer: DataStreamWriter) -> None:
    """Process what has landed, then stop."""
    query = writer.start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
