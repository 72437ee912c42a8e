"""Exact row numbers that never put one group into one task.

All rows are sorted by group and key in one range sort, which spreads a large group
over as many tasks as its rows need.  Each row's number over the whole table follows
from its place in its partition and the sizes of the partitions before.  The rank in
a group is that number less the smallest of the group.  There is one way for groups
of every size.

Only the group, the sort keys and a row id are sorted.  The rows themselves are stored
once and meet their ranks in one join, however wide they are and however many ranks
they get.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teampulse.session import stored

_TIE, _PLACE, _PART, _START, _NUMBER, _FIRST = "__tie", "__place", "__part", "__start", "__number", "__first"
#: Name of the row id that joins rows and ranks.
ROW = "__row"


def null_safe_join(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name where NULL equals NULL; keeps the left copy of them."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(renamed, cond, how).drop(*[f"__r_{c}" for c in cols])


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Row numbers from 1 over the whole table.

    The sorted rows are stored, so that sizes and places come from the same sort.
    Rows with equal keys are told apart, so that they can lie in different tasks.
    """
    placed = df.withColumn(_TIE, F.monotonically_increasing_id()).orderBy(*order, _TIE).drop(_TIE)
    placed = stored(placed.withColumn(_PLACE, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(_PLACE, 33)
    # one row per partition of the sort
    sizes = placed.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias(_START))
    number = F.col(_START) + F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn(_PART, part).join(starts, _PART).withColumn(out, number).drop(_PART, _START, _PLACE)


def with_row_ids(df: DataFrame) -> DataFrame:
    """The rows, stored, with an id each in ``ROW``."""
    return stored(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def ranks(rows: DataFrame, group: list[str], keys: list[Column], out: str) -> DataFrame:
    """``ROW`` and rank of the rows from :func:`with_row_ids`.

    The range sort reads its input twice, for the bounds and for the rows; both times
    these are the few stored columns that it needs.
    """
    names = [f"__key{i}" for i in range(len(keys))]
    narrow = rows.select(ROW, *group, *[k.alias(n) for k, n in zip(keys, names)])
    placed = numbered(narrow, [F.col(c) for c in [*group, *names]], _NUMBER).select(ROW, *group, _NUMBER)
    firsts = placed.groupBy(*group).agg(F.min(_NUMBER).alias(_FIRST))
    return null_safe_join(placed, firsts, group).select(ROW, (F.col(_NUMBER) - F.col(_FIRST) + 1).alias(out))


def rank_rows(df: DataFrame, group: list[str], keys: list[Column], out: str) -> DataFrame:
    """``row_number()`` per group in ascending order of ``keys``.

    Negate numeric keys for a descending order.
    """
    rows = with_row_ids(df)
    return rows.join(ranks(rows, group, keys, out), ROW).drop(ROW)


def percent_rank_rows(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """``percent_rank()`` by one number that is never NULL.

    Rows are counted per value first, so the window sees the distinct values of a
    group only.
    """
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__c"))
    smaller = F.sum("__c").over(Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1))
    everyone = F.sum("__c").over(Window.partitionBy(*group))
    share = F.try_divide(F.coalesce(smaller, F.lit(0)).cast("double"), (everyone - 1).cast("double"))
    return null_safe_join(df, counts.select(*group, value, F.coalesce(share, F.lit(0.0)).alias(out)), [*group, value])


def top_rows(df: DataFrame, group: list[str], order: list[Column], n: int, out: str = "rank") -> DataFrame:
    """First ``n`` rows per group; the planner limits each group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n).withColumn(out, F.col(out).cast("bigint"))


def global_rank(df: DataFrame, keys: list[Column], out: str) -> DataFrame:
    """Row number over the whole table."""
    return numbered(df, keys, out)
