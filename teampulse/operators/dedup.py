"""One row per key, chosen by an order.

``row_number() = 1`` is planned with a group limit before the shuffle, so a key
that holds a large share of the rows is cut down to one row per input task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PICK = "__pick"


def keep_first(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(PICK, F.row_number().over(w)).where(F.col(PICK) == 1).drop(PICK)


def keep_latest(df: DataFrame, keys: list[str], at: str, ties: list[str] = ()) -> DataFrame:
    """Latest version of each key; ``ties`` make the choice repeatable."""
    return keep_first(df, keys, [F.col(at).desc(), *[F.col(t).desc() for t in ties]])


def keep_earliest(df: DataFrame, keys: list[str], at: str, ties: list[str] = ()) -> DataFrame:
    return keep_first(df, keys, [F.col(at).asc(), *[F.col(t).asc() for t in ties]])
