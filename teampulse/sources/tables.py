"""Keyed Parquet tables in month folders: full replace, append and upsert.

An upsert rewrites only the months it touches.  Spark stages the new files of a
dynamic overwrite and moves them in when the job commits, so a lost executor
costs a retry of its tasks and no data.  Readers that need one consistent view
across months should read between runs.

An upsert by a key that may sit in another month than its new row looks the key up in all
months, but opens only what can hold one of the batch's keys: the range of the keys is
observed while the batch is staged and pushed to the scan, so that files and row groups
outside it are skipped by their statistics.  Up to ``FEW_KEYS`` keys are pushed themselves
and meet the Bloom filters that the files carry for text keys.

Each write observes the greatest date or time of the table's period column and of the
extraction time, and keeps it with the table's columns.  Watermarks are read from there,
without a job.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teampulse.functions.dates import month_start
from teampulse.operators.dedup import keep_first
from teampulse.session import scratch_path
from teampulse.sources.schemas import EXTRACTED_AT

MONTH = "month"
FEW_KEYS = 1000  # rows of a batch whose keys are named in the scan's filter, besides their range
COLUMNS = "_columns.json"  # current columns; Spark skips names that start with an underscore


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, sorted; none if the path is missing."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_note(spark: SparkSession, path: str) -> dict:
    """A small JSON file."""
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(note), "utf-8"))
    out.close()


def _state(spark: SparkSession, path: str) -> dict:
    """Schema, the file name of each column, and the file names that were in use before."""
    return read_note(spark, f"{path}/{COLUMNS}")


def _save_state(spark: SparkSession, path: str, state: dict) -> None:
    write_note(spark, f"{path}/{COLUMNS}", state)


def _save_schema(spark: SparkSession, path: str, schema: T.StructType, fresh: bool = True) -> dict[str, str]:
    """Store the current columns; returns the name of each in the files.

    A column that left the table and comes back gets another name in new files, so
    that values from before it left do not show up again.  ``fresh`` is for tables
    that are written as a whole.
    """
    old = {"physical": {}, "used": [], "newest": {}} if fresh else _state(spark, path)
    used = list(old["used"])
    physical = {}
    for name in schema.names:
        known = old["physical"].get(name)
        if known is None:
            known = name if name not in used else f"{name}__{sum(u.split('__')[0] == name for u in used)}"
            used.append(known)
        physical[name] = known
    state = {"schema": json.loads(schema.json()), "physical": physical, "used": used, "newest": old.get("newest")}
    _save_state(spark, path, state)
    return physical


#: How a value is kept as a whole number, by type.
_KEPT = {T.DateType(): F.unix_date, T.TimestampType(): F.unix_micros}


class _Newest:
    """Watches the greatest value of some date and time columns in the rows of one write."""

    def __init__(self, df: DataFrame, columns: list[str]):
        kinds = {f.name: f.dataType for f in df.schema.fields}
        found = [_KEPT[kinds[c]](F.max(c)).alias(c) for c in dict.fromkeys(columns) if kinds.get(c) in _KEPT]
        self.seen = Observation() if found else None
        self.rows = df.observe(self.seen, *found) if found else df

    def keep(self, path: str) -> None:
        """Call after the write.  A table without earlier values keeps none: they would miss its older rows."""
        state = _state(self.rows.sparkSession, path)
        if self.seen is None or state.get("newest") is None:
            return
        for name, value in self.seen.get.items():
            known = state["newest"].get(name)
            state["newest"][name] = max(value, known) if value is not None and known is not None else known if value is None else value
        _save_state(self.rows.sparkSession, path, state)


def newest(spark: SparkSession, path: str, column: str) -> dt.date | dt.datetime | None:
    """Greatest value of a date or time column that was ever written to the table at ``path``; None if there is none.

    Taken from what the writes noted; a table that has no note of the column is scanned.
    """
    state = _state(spark, path)
    kind = T.StructType.fromJson(state["schema"])[column].dataType
    noted = state.get("newest") or {}
    if column not in noted:
        return read_table(spark, path).agg(F.max(column)).head()[0]
    value = noted[column]
    if value is None:
        return None
    if kind == T.DateType():
        return dt.date(1970, 1, 1) + dt.timedelta(days=value)
    return dt.datetime.fromtimestamp(value // 1_000_000).replace(microsecond=value % 1_000_000)


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(names[c]) for c in df.columns])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table with its current columns; files written before a column existed give NULL."""
    state = _state(spark, path)
    schema = T.StructType.fromJson(state["schema"])
    stored = T.StructType([T.StructField(state["physical"][f.name], f.dataType, f.nullable) for f in schema.fields])
    rows = spark.read.schema(stored).parquet(path)
    return rows if stored.names == schema.names else rows.toDF(*schema.names)


def _with_month(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn(MONTH, month_start(by))


def _write(
    df: DataFrame, path: str, cluster: list[str], mode: str, overwrite: str, many_months: bool = True, lookup: list[str] = ()
) -> None:
    if many_months:
        # rebalance lets the runtime split a large month and join small ones, so that
        # neither one task nor thousands of files hold a month
        df = df.hint("rebalance", F.col(MONTH))
    shaped = df.sortWithinPartitions(MONTH, *cluster)
    writer = shaped.write.mode(mode).option("partitionOverwriteMode", overwrite).option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in lookup:
        if df.schema[name].dataType == T.StringType():
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.partitionBy(MONTH).parquet(path)


def replace_table(
    df: DataFrame, path: str, by: str, cluster: list[str] = (), many_months: bool = True, lookup: list[str] = ()
) -> DataFrame:
    """Write the whole table in month folders, sorted by the cluster columns inside each file.

    ``many_months=False`` is for tables of a week or two: each task writes what it
    has, without another shuffle.  ``lookup`` names keys of later upserts.
    """
    spark = df.sparkSession
    full = _with_month(df, by)
    seen = _Newest(full, [by, EXTRACTED_AT])
    _write(seen.rows, path, list(cluster), "overwrite", "static", many_months, list(lookup))
    _save_schema(spark, path, full.schema)
    seen.keep(path)
    return read_table(spark, path)


def replace_flat(df: DataFrame, path: str, spread: list[str] = ()) -> DataFrame:
    """Write a whole table without month folders.

    ``spread`` names columns to even the files out by; it is for joins whose
    fan-out leaves some tasks with far more rows than others.
    """
    if spread:
        df = df.hint("rebalance", *[F.col(c) for c in spread])
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    _save_schema(df.sparkSession, path, df.schema)
    return read_table(df.sparkSession, path)


def append_flat(df: DataFrame, path: str) -> DataFrame:
    """Add rows to a table of :func:`replace_flat` with the same columns."""
    df.write.mode("append").parquet(path)
    df.sparkSession.catalog.refreshByPath(path)
    return read_table(df.sparkSession, path)


def append_rows(df: DataFrame, path: str, by: str) -> DataFrame:
    spark = df.sparkSession
    full = _with_month(df, by)
    names = _save_schema(spark, path, full.schema, not exists(spark, f"{path}/{COLUMNS}"))
    seen = _Newest(full, [by, EXTRACTED_AT])
    _write(_renamed(seen.rows, names), path, [], "append", "dynamic")
    spark.catalog.refreshByPath(path)
    seen.keep(path)
    return read_table(spark, path)


def compact(spark: SparkSession, path: str, months: list[dt.date], keys: list[str]) -> DataFrame:
    """Write some months anew, with one row per key, so that rows added bit by bit do not stay in small files."""
    rows = in_months(read_table(spark, path), months).dropDuplicates(keys)
    names = _state(spark, path)["physical"]
    _write(_renamed(rows, names), path, [names[k] for k in keys], "overwrite", "dynamic")
    spark.catalog.refreshByPath(path)
    return read_table(spark, path)


def key_match(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def merge(target: DataFrame, updates: DataFrame, keys: list[str], resolve: list[Column] | None = None) -> DataFrame:
    """The target after the upsert, as a plan.

    A key in ``updates`` replaces the stored row; with ``resolve`` (sort columns)
    the first of old and new wins instead.  Keys compare NULL-safe.  The result
    has the columns of ``updates``; columns the target lacks are NULL in old rows.
    """
    known = [c for c in updates.columns if c in target.columns]
    old = target.select(*known)
    if resolve is not None:
        return keep_first(updates.unionByName(old, allowMissingColumns=True), keys, resolve)
    new_keys = updates.select(*keys).distinct()
    rest = old.join(new_keys, key_match(old, new_keys, keys), "left_anti")
    return updates.unionByName(rest, allowMissingColumns=True)


#: Types of keys whose range is observed.
_RANGED = (T.StringType(), T.LongType(), T.IntegerType())


def _watch_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, Observation]:
    """Observes the rows, and of each key of a common type its range and its NULLs."""
    found = [F.count(F.lit(1)).alias("rows")]
    for i, k in enumerate(keys):
        if df.schema[k].dataType in _RANGED:
            found += [F.min(k).alias(f"low{i}"), F.max(k).alias(f"high{i}"), F.count_if(F.col(k).isNull()).alias(f"nulls{i}")]
    seen = Observation()
    return df.observe(seen, *found), seen


def reachable(df: DataFrame, keys: list[str], seen: dict, staged: DataFrame) -> DataFrame:
    """Rows of ``df`` that can have a key of the staged batch, by predicates that the scan uses."""
    cond = F.lit(True)
    for i, k in enumerate(keys):
        if f"low{i}" not in seen:
            continue
        inside = F.lit(False) if seen[f"low{i}"] is None else F.col(k).between(F.lit(seen[f"low{i}"]), F.lit(seen[f"high{i}"]))
        if seen["rows"] <= FEW_KEYS and seen[f"low{i}"] is not None:
            named = [r[0] for r in staged.select(k).where(F.col(k).isNotNull()).distinct().collect()]  # FEW_KEYS values at most
            inside = inside & F.col(k).isin(named)
        cond = cond & (inside | F.col(k).isNull() if seen[f"nulls{i}"] else inside)
    return df.where(cond)


def _months(df: DataFrame) -> list[dt.date]:
    """Distinct months: at most one value per calendar month."""
    return [r[0] for r in df.select(MONTH).distinct().collect()]


def months_of(df: DataFrame, by: str) -> list[dt.date]:
    """The months that rows fall into by a date column."""
    return _months(_with_month(df, by))


def in_months(df: DataFrame, months: list[dt.date | None]) -> DataFrame:
    """Rows of the given months, as a predicate on the folder column."""
    real = [m for m in months if m is not None]
    cond = F.col(MONTH).isin(real) if real else F.lit(False)
    return df.where(cond | F.col(MONTH).isNull() if None in months else cond)


def upsert(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: list[str],
    by: str,
    cluster: list[str] = (),
    resolve: list[Column] | None = None,
) -> DataFrame:
    """Merge ``updates`` into the table at ``path``; the first call creates it.

    ``updates`` has one row per key.  It is written to the shared folder first:
    the merge reads it several times and must see the same rows each time.
    """
    if not exists(spark, f"{path}/{COLUMNS}"):
        return replace_table(updates, path, by, cluster, lookup=keys)
    staged_path = scratch_path(spark, "updates")
    seen = _Newest(_with_month(updates, by), [by, EXTRACTED_AT])
    staged_schema = seen.rows.schema
    rows, ranges = _watch_keys(seen.rows, keys)
    rows.write.parquet(staged_path)
    staged = spark.read.schema(staged_schema).parquet(staged_path)
    target = read_table(spark, path)
    names = _save_schema(spark, path, staged_schema, fresh=False)
    gaining = set(_months(staged))
    losing = set()
    if by not in keys:
        # a key may sit in another month than its new row
        old_keys = reachable(target.select(MONTH, *keys), keys, ranges.get, staged)
        hit = old_keys.join(staged.select(*keys), key_match(old_keys, staged, keys), "left_semi")
        losing = set(_months(hit)) - gaining
    if gaining:
        merged = merge(in_months(target, [*gaining, *losing]), staged, keys, resolve)
        # an overwrite does not touch months that end up empty, so those are dropped by hand
        emptied = losing - set(_months(in_months(merged, list(losing)))) if losing else set()
        _write(_renamed(merged, names), path, [names[c] for c in cluster], "overwrite", "dynamic", lookup=[names[k] for k in keys])
        for month in emptied:
            fs, p = _fs(spark, f"{path}/{MONTH}={month.isoformat() if month else '__HIVE_DEFAULT_PARTITION__'}")
            fs.delete(p, True)
        spark.catalog.refreshByPath(path)
    seen.keep(path)
    return read_table(spark, path)
