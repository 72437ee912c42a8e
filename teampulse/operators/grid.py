"""The member x week grid, built without a cross join.

Each member carries an array of weeks.  Sparse activity is folded into one map
per member (at most one entry per calendar week), joined on the member, and only
then are the weeks spread into rows, each of which looks its week up.  The grid
itself, by far the largest table, is never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.functions.dates import weeks_between
from teampulse.operators.joins import spread_tasks

MEMBER, WEEK = "community_member_id", "week_start_date"


def distinct_weeks(tables: list[DataFrame]) -> DataFrame:
    """Weeks with any activity; each table is reduced before the union."""
    return reduce(DataFrame.unionByName, [t.select(WEEK).distinct() for t in tables]).distinct()


def week_list(weeks: DataFrame) -> Column:
    """All weeks as one sorted array, usable inside another plan.

    Its length is the number of calendar weeks, whatever the table size.
    """
    return weeks.agg(F.array_sort(F.collect_set(WEEK)).alias("w")).scalar()


def all_weeks(weeks: DataFrame) -> Column:
    """The same, empty where there are none."""
    return F.coalesce(week_list(weeks), F.array().cast("array<date>"))


def add_weeks_from_activity(members: DataFrame, joined: str, weeks: DataFrame, out: str) -> DataFrame:
    """Add the weeks with activity from the member's join week on."""
    listed = members.withColumn("__all", all_weeks(weeks))
    return listed.withColumn(out, F.filter("__all", lambda w: w >= F.col(joined))).drop("__all")


def weeks_from_calendar(start: Column, end: Column) -> Column:
    """Every Monday from start to end."""
    return weeks_between(start, end)


def spread_weeks(members: DataFrame, weeks: Column) -> DataFrame:
    """One row per member and week."""
    return members.withColumn(WEEK, F.explode(weeks))


def stack_metrics(weekly: dict[str, DataFrame]) -> DataFrame:
    """The weekly tables below each other as (member, week, metric, n)."""
    parts = [
        t.select(MEMBER, WEEK, F.lit(name).alias("metric"), F.col(name).alias("n")) for name, t in weekly.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def activity_per_member(weekly: dict[str, DataFrame]) -> DataFrame:
    """One row per member with its active weeks as a map from the week to the metrics.

    Both aggregations run inside the one partitioning by member.  The number of tasks is
    given, since the activity is too small to tell the size of the grid.
    """
    names = list(weekly)
    stacked = stack_metrics(weekly).where(F.col(WEEK).isNotNull())
    per_week = (
        stacked.repartition(spread_tasks(stacked.sparkSession), MEMBER)
        .groupBy(MEMBER, WEEK)
        .agg(*[F.coalesce(F.max(F.when(F.col("metric") == m, F.col("n"))), F.lit(0).cast("bigint")).alias(m) for m in names])
    )
    entries = F.collect_list(F.struct(F.col(WEEK), F.struct(*names)))
    return per_week.groupBy(MEMBER).agg(F.map_from_entries(entries).alias("__active"))


def fill_grid(members: DataFrame, weekly: dict[str, DataFrame], weeks: str, since: str | None = None) -> DataFrame:
    """Members spread over their ``weeks`` column with metrics, zero where nothing happened.

    ``weeks`` must hold every week with activity between its first and last entry.  Weeks
    before the date in ``since`` are left out; a member's list need not be cut for that.
    Neither step runs a lambda per week, which Spark would interpret.
    """
    names = list(weekly)
    joined = members.join(activity_per_member(weekly), MEMBER, "left")
    kept = [c for c in members.columns if c not in (weeks, since)]
    bound = [since] if since else []
    rows = joined.select(*kept, *bound, "__active", F.inline(F.arrays_zip(weeks)).alias(WEEK))
    if since:
        rows = rows.where(F.col(WEEK) >= F.col(since))
    found = F.col("__active")[F.col(WEEK)]
    return rows.select(*kept, WEEK, *[F.coalesce(found[m], F.lit(0).cast("bigint")).alias(m) for m in names])


def star_join(grid: DataFrame, weekly: dict[str, DataFrame]) -> DataFrame:
    """The same metrics by one left join per table, for grids that exist already."""
    for name, table in weekly.items():
        grid = grid.join(table.select(MEMBER, WEEK, name), [MEMBER, WEEK], "left")
    return grid.withColumns({m: F.coalesce(F.col(m), F.lit(0).cast("bigint")) for m in weekly})
