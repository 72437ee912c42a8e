"""Joins written in the form the planner can shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.functions.text import normal_key


def has_item(items, item) -> Column:
    """Array membership where a NULL array counts as empty.

    A NULL element without a match still gives NULL, so a negated test drops the
    row as SQL's NOT IN does.
    """
    items = F.col(items) if isinstance(items, str) else items
    return F.when(items.isNull(), F.lit(False)).otherwise(F.array_contains(items, item))


def on_array_member(left: DataFrame, items: str, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join where ``right.key`` is an element of ``left.items``, once per match."""
    rows = left.withColumn(key, F.explode(F.array_distinct(items)))
    return rows.join(right, key, how)


def on_normal_name(left: DataFrame, left_name: str, right: DataFrame, right_name: str) -> DataFrame:
    """Inner join on names that differ only in case and whitespace."""
    a = left.withColumn("__name", normal_key(left_name))
    b = right.withColumn("__name", normal_key(right_name))
    return a.join(b, "__name").drop("__name")


def left_keep_all(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join for a right side whose keys may be hot.

    Spark can split a skewed side of an inner join but not the right side of a
    left join.  So matches come from an inner join and the rows without a match
    are added; the keys are made distinct before they are compared.
    """
    found = left.join(right, keys, "inner")
    known = right.select(*keys).distinct()
    lonely = left.join(known, keys, "left_anti")
    return found.unionByName(lonely, allowMissingColumns=True)


def only_children_of(children: DataFrame, child_key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Child records whose parent is listed."""
    known = parents.select(F.col(parent_key).alias("__p"))
    return children.join(known, F.col(child_key) == F.col("__p"), "left_semi")


def spread_tasks(spark: SparkSession) -> int:
    """Number of tasks for a step whose output is far larger than its inputs, which would get too few."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def spread(many: DataFrame, rows: DataFrame, keys: list[str], parts: int = 16) -> DataFrame:
    """Inner join whose result is far larger than both sides, on keys that are few and not NULL.

    A key's rows of ``many`` are dealt over ``parts`` slices, each of which meets all of the
    key's ``rows``.  The number of tasks is given, since the sides are too small to tell it.
    """
    tasks = spread_tasks(many.sparkSession)
    others = [c for c in many.columns if c not in keys]
    left = many.withColumn("__slice", F.pmod(F.xxhash64(*others), F.lit(parts)).cast("int"))
    right = rows.withColumn("__slice", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    on = [*keys, "__slice"]
    # each of ``rows`` in turn with all of the slice, not the other way round: repeated values then lie side by side
    return right.repartition(tasks, *on).join(left.repartition(tasks, *on).hint("merge"), on).drop("__slice")


#: Rows that a task sorts in :func:`dealt_in_order`, if there are more than the usual number of tasks has.
TASK_ROWS = 1 << 20


def dealt_in_order(df: DataFrame, number: str, count: int, weight: int = 1) -> DataFrame:
    """Rows in the order of ``number``, which counts them from 1 to ``count``.

    Since the numbers are known, the bounds of the tasks are too, and ``df`` is not worked out a
    second time to sample them.  ``weight`` is the number of rows that each will become.
    """
    tasks = max(spread_tasks(df.sparkSession), -(-count * weight // TASK_ROWS))
    task = F.floor((F.col(number) - 1) * tasks / max(count, 1)).cast("int")
    return df.repartitionById(tasks, task).sortWithinPartitions(number)
