"""Ranks 1 to n of a group as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ranks_to_columns(df: DataFrame, group: list[str], rank: str, values: dict[str, str], n: int = 3) -> DataFrame:
    """``values`` maps a column to a name pattern with ``{}`` for the rank."""
    aggs = [
        F.max(F.when(F.col(rank) == k, F.col(col))).alias(pattern.format(k))
        for k in range(1, n + 1)
        for col, pattern in values.items()
    ]
    return df.groupBy(*group).agg(F.count(rank).alias("__n"), *aggs)
