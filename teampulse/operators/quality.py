"""Data checks.  Each returns a DataFrame of findings or of profile numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teampulse.functions.rules import METRICS
from teampulse.functions.safe import ratio
from teampulse.operators.grid import MEMBER, WEEK


def missing_values(df: DataFrame, columns: list[str], times: str | None = None) -> DataFrame:
    """NULLs per column in one pass over the table; a row counts as often as ``times`` says."""
    n = F.col(times) if times else F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    counts = df.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNull(), n)), zero).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_rows")


def missing_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that lack a field which the key contract requires, with the missing fields' names."""
    names = F.filter(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]), lambda n: n.isNotNull())
    return df.withColumn("missing_fields", F.array_join(names, ", ")).where(F.col("missing_fields") != "")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row; keys with a NULL are for :func:`missing_values`."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def unaccepted_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return df.where(~F.col(column).isin(accepted)).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def row_count_difference(before: DataFrame, after: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Row counts of two builds, their difference in percent and whether it is within the tolerance."""
    n = F.count(F.lit(1)).alias("n")
    both = before.agg(n.alias("before_rows")).withColumn("after_rows", after.agg(n).scalar())
    off = F.coalesce(ratio(F.abs(F.col("before_rows") - F.col("after_rows")) * 100.0, "before_rows"), F.lit(0.0))
    return both.withColumn("difference_pct", off).withColumn("within_tolerance", F.col("difference_pct") < tolerance)


def week_gaps(engagement: DataFrame, since: Column | None = None) -> DataFrame:
    """Members whose stored weeks are more than seven days apart, from the week ``since`` on."""
    if since is not None:
        engagement = engagement.where(F.col(WEEK) >= since)
    w = Window.partitionBy(MEMBER).orderBy(WEEK)
    gap = F.datediff(WEEK, "previous_week").cast("bigint")
    rows = engagement.select(MEMBER, WEEK, F.lag(WEEK).over(w).alias("previous_week"))
    return rows.withColumn("gap_days", gap).where("gap_days > 7")


def backfill_profile(engagement: DataFrame) -> DataFrame:
    """Rows and members per backfill flag."""
    return engagement.groupBy("is_backfill").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct(MEMBER).alias("member_count")
    )


def metric_profile(engagement: DataFrame) -> DataFrame:
    """Average of each metric, share of active rows and whether no metric is negative."""
    active = ratio(F.sum(F.when(F.col("has_activity"), 1).otherwise(0)) * 100, F.count(F.lit(1)))
    lowest = F.least(*[F.min(m) for m in METRICS])
    return engagement.agg(
        *[F.avg(m).alias(f"avg_{m}") for m in METRICS],
        active.alias("pct_with_activity"),
        (lowest >= 0).alias("all_non_negative"),
    )


def update_profile(table: DataFrame, updated_at: str) -> DataFrame:
    """Range of update times and number of days with updates."""
    return table.agg(
        F.min(updated_at).alias("earliest_update"),
        F.max(updated_at).alias("latest_update"),
        F.countDistinct(F.to_date(updated_at)).alias("update_days"),
    )


def newest_week_coverage(engagement: DataFrame) -> DataFrame:
    """Members present in the newest week."""
    latest = engagement.agg(F.max(WEEK)).scalar()
    return engagement.where(F.col(WEEK) == latest).groupBy(WEEK).agg(F.countDistinct(MEMBER).alias("member_count"))


def did_not_shrink(before: DataFrame, after: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    both = before.agg(n.alias("rows_before")).withColumn("rows_after", after.agg(n).scalar())
    return both.withColumn("passed", F.col("rows_after") >= F.col("rows_before"))


def run_health(engagement: DataFrame, updated_at: str) -> DataFrame:
    """Rows, members, backfilled rows and week range per day of the run."""
    return engagement.groupBy(F.to_date(updated_at).alias("run_date")).agg(
        F.count(F.lit(1)).alias("rows_updated"),
        F.countDistinct(MEMBER).alias("members_updated"),
        F.count_if("is_backfill").alias("backfill_rows"),
        F.min(WEEK).alias("earliest_week"),
        F.max(WEEK).alias("latest_week"),
    )


def backfills_per_member(engagement: DataFrame, updated_at: str) -> DataFrame:
    """Weeks filled in for each member per day of the run."""
    day = F.to_date(updated_at).alias("backfill_date")
    return engagement.where("is_backfill").groupBy(day, MEMBER, "email").agg(
        F.count(F.lit(1)).alias("weeks_backfilled"), F.min(WEEK).alias("from_week"), F.max(WEEK).alias("to_week")
    )
