"""The declared checks of the stored tables, as one table of findings.

Every check gives one row with the number of failing rows.  Nothing is dropped: a
finding is for the caller to act on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.operators import quality as Q
from teampulse.operators.grid import MEMBER, WEEK

# Columns that must be filled, keys that must be unique, and lists of accepted values, by table.
NOT_NULL = {
    "rankings": ["manager_email", WEEK, "total_points"],
    "detail": ["manager_email", WEEK],
    "engagement": [MEMBER, WEEK],
    "monthly_report": ["manager_email", "report_month_start_date"],
    "delivery_log": ["delivery_id", "manager_email", "report_type", WEEK, "sent_at", "delivery_status"],
}
UNIQUE = {"engagement": [MEMBER, WEEK], "delivery_log": ["delivery_id"]}
ACCEPTED = {"delivery_log": {"report_type": ["weekly", "monthly"], "delivery_status": ["sent", "failed", "bounced"]}}


def _finding(check: str, table: str, column: str, rows) -> list:
    return [F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), rows.cast("bigint").alias("failing_rows")]


def _count(df: DataFrame, check: str, table: str, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(*_finding(check, table, column, F.col("n")))


def table_checks(name: str, df: DataFrame, rows_before: int | None = None) -> list[DataFrame]:
    """One frame per check of a table; ``rows_before`` is its size before the run, if it had one."""
    out = []
    if filled := NOT_NULL.get(name):
        nulls = Q.missing_values(df, filled)
        out.append(nulls.select(F.lit("not_null").alias("check_name"), F.lit(name).alias("table_name"), "column_name", F.col("null_rows").alias("failing_rows")))
    if keys := UNIQUE.get(name):
        out.append(_count(Q.repeated_keys(df, keys), "unique", name, ", ".join(keys)))
    for column, accepted in ACCEPTED.get(name, {}).items():
        wrong = Q.unaccepted_values(df, column, accepted).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
        out.append(wrong.select(*_finding("accepted_values", name, column, F.col("n"))))
    if name == "engagement":
        out.append(_count(Q.week_gaps(df), "week_gaps", name, WEEK))
        if rows_before is not None:
            lost = F.greatest(F.lit(rows_before) - F.count(F.lit(1)), F.lit(0))
            out.append(df.agg(lost.alias("n")).select(*_finding("no_shrink", name, WEEK, F.col("n"))))
    return out


def findings(tables: dict[str, DataFrame], rows_before: dict[str, int] | None = None) -> DataFrame:
    """check_name, table_name, column_name, failing_rows, passed for all known tables among ``tables``."""
    frames = [c for name, df in tables.items() for c in table_checks(name, df, (rows_before or {}).get(name))]
    out = reduce(DataFrame.unionByName, frames)
    return out.withColumn("passed", F.col("failing_rows") == 0)
