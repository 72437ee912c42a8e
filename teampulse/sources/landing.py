"""Landed files into raw tables.

Deliveries are folders: ``<landing>/<table>/<delivery>/`` holds JSON lines, or CSV files for
the roster.  Feeds and record lists add to what has landed before; a file stream reads each
of their files once, wherever a run before it stopped.  Members, tags and the roster come as
a whole, so their newest delivery replaces the one before; it counts as soon as it holds a
``_SUCCESS`` file, and names of deliveries sort by time.

Below ``<root>/raw`` a feed is kept in folders of kind (``rows`` or ``rejected``) and batch.
A batch that is repeated after a failure writes the same folders again.  The stream's own
state lies beside them and belongs to them: remove both or none.

A line is rejected, with its text, its file and a reason, when it is no readable object
of the table's shape, has no id, belongs to another feed, or has an unreadable payload.
Blank lines are skipped.  Payloads are parsed once, here; leaves that the shape does not
name stay in the landed files and in the archive.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from teampulse.functions import text as X
from teampulse.sources import scans, tables
from teampulse.sources import schemas as S

ROSTER = "managers_not_joined"
APPENDED = [*S.FEEDS, *S.RECORD_SHAPES]
ROWS, REJECTED = "rows", "rejected"
KIND, BATCH = "kind", "batch"
DONE = "_SUCCESS"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
BAD = "_unreadable"
#: Files older than this against the newest one are not read; long, so that late files are.
MAX_FILE_AGE = "3650d"


def _shape(table: str) -> str:
    """Columns of a landed line; a feed's payload may be an object or text with one."""
    if table in S.FEEDS:
        return f"id string, name string, version string, payload string, created_at string, triggered_at string, {S.LOAD_COLUMNS}"
    return f"{(S.RECORD_SHAPES | S.SNAPSHOTS)[table]}, {S.LOAD_COLUMNS}"


def raw_schema(table: str) -> T.StructType:
    """Columns of a raw table."""
    return T.StructType.fromDDL(S.ENVELOPE if table in S.FEEDS else _shape(table))


def _parse(c: str, ddl: str) -> Column:
    return F.from_json(c, f"{ddl}, {BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})


def parsed(lines: DataFrame, table: str) -> DataFrame:
    """Columns of the raw table, kind, reason, line and file for landed lines ``value, file, landed_at``.

    Rows without load columns take the file's time and a hash of the line.
    """
    lines = lines.where(~X.is_blank("value")).withColumn("__r", _parse("value", _shape(table)))
    rows = lines.select("value", "file", "landed_at", "__r.*").withColumns(
        {S.EXTRACTED_AT: F.coalesce(S.EXTRACTED_AT, "landed_at"), S.RAW_ID: F.coalesce(F.col(S.RAW_ID), F.sha2("value", 256))}
    )
    # a line that is no object at all gives no field and may give no unreadable text
    empty = F.coalesce(*[F.col(f.name).cast("string") for f in T.StructType.fromDDL(_shape(table)).fields[:4]]).isNull()
    faults = [(F.col(BAD).isNotNull() | empty, "not a readable object")]
    if table in S.FEEDS:
        rows = rows.withColumn("__p", _parse("payload", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _payload().fields)))
        faults += [
            (~F.col("name").eqNullSafe(F.lit(S.FEEDS[table])), "another feed"),
            (F.col("payload").isNotNull() & (F.col("__p").isNull() | F.col(f"__p.{BAD}").isNotNull()), "unreadable payload"),
        ]
        rows = rows.withColumn("payload", F.col("__p").dropFields(BAD))
    if table not in S.SNAPSHOTS:
        faults.append((F.col("id").isNull(), "no id"))
    reason = F.coalesce(*[F.when(fault, F.lit(why)) for fault, why in faults])
    rows = rows.withColumn("reason", reason)
    bad = F.col("reason").isNotNull()
    return rows.select(
        *raw_schema(table).names,
        "reason",
        F.when(bad, F.col("value")).alias("line"),
        F.when(bad, F.col("file")).alias("file"),
        F.when(bad, F.lit(REJECTED)).otherwise(F.lit(ROWS)).alias(KIND),
    )


def _payload() -> T.StructType:
    return T.StructType.fromDDL(S.ENVELOPE)["payload"].dataType


def _lines(rows: DataFrame) -> DataFrame:
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("landed_at"))


def write_batch(batch: DataFrame, number: int, path: str) -> None:
    """Add one batch to a raw table, over an earlier try of the same batch.

    A task keeps a file open per kind.  Otherwise Spark sorts the rows by folder first, with
    their whole lines, and spills them.  The stream's session is its own, so the setting stays here.
    """
    batch.sparkSession.conf.set(OPEN_FILES, 2)
    numbered = batch.withColumn(BATCH, F.lit(number).cast("int"))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(KIND, BATCH).parquet(path)


def feed_writer(
    spark: SparkSession, landing: str, root: str, table: str, archive: str | None = None, files_per_batch: int = 1000
) -> DataStreamWriter:
    """A stream that takes the files of a table that have not been read, then ends.

    With ``archive``, files that were taken in are moved there by a later batch or run.
    """
    source = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", MAX_FILE_AGE)
    if archive is not None:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = parsed(_lines(source.text(f"{landing}/{table}/*")), table)
    path = f"{root}/raw/{table}"
    return (
        rows.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, path))
        .option("checkpointLocation", f"{root}/raw/_streams/{table}")
        .trigger(availableNow=True)
    )


def _kept(spark: SparkSession, root: str, table: str, kind: str) -> DataFrame:
    path = f"{root}/raw/{table}"
    ddl = T.StructType.fromDDL(f"reason string, line string, file string, {KIND} string, {BATCH} int")
    schema = T.StructType(raw_schema(table).fields + ddl.fields)
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col(KIND) == kind)


def landed_rows(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a feed or record list that have been taken in, with their batch."""
    return _kept(spark, root, table, ROWS).select(*raw_schema(table).names, BATCH)


def rejected_rows(spark: SparkSession, root: str) -> DataFrame:
    """source_table, batch, reason, line and file of every line that was not taken in."""
    out = None
    for table in APPENDED:
        part = _kept(spark, root, table, REJECTED).select(F.lit(table).alias("source_table"), BATCH, "reason", "line", "file")
        out = part if out is None else out.unionByName(part)
    for table in S.SNAPSHOTS:
        if found := tables.folders(spark, f"{root}/raw/{table}"):
            part = _snapshot(spark, f"{root}/raw/{table}/{found[-1]}", table).where(F.col(KIND) == REJECTED)
            out = out.unionByName(part.select(F.lit(table).alias("source_table"), F.lit(None).cast("int").alias(BATCH), "reason", "line", "file"))
    return out


def _snapshot(spark: SparkSession, path: str, table: str) -> DataFrame:
    ddl = T.StructType.fromDDL(f"reason string, line string, file string, {KIND} string")
    return spark.read.schema(T.StructType(raw_schema(table).fields + ddl.fields)).parquet(path)


def take_snapshot(spark: SparkSession, landing: str, root: str, table: str) -> DataFrame:
    """The newest complete delivery of a table, stored once; older stored ones are removed."""
    done = [d for d in tables.folders(spark, f"{landing}/{table}") if tables.exists(spark, f"{landing}/{table}/{d}/{DONE}")]
    if not done:
        raise FileNotFoundError(f"no complete delivery of {table} below {landing}")
    source, target = f"{landing}/{table}/{done[-1]}", f"{root}/raw/{table}/{done[-1]}"
    if not tables.exists(spark, f"{target}/{DONE}"):
        if table == ROSTER:
            scans.replace_roster(spark, source, target)
        else:
            rows = parsed(_lines(spark.read.text(source)), table)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(KIND).parquet(target)
    for old in tables.folders(spark, f"{root}/raw/{table}"):
        if old != done[-1]:
            tables.remove(spark, f"{root}/raw/{table}/{old}")
    if table == ROSTER:
        return spark.read.schema(S.MANAGER_ROSTER).parquet(target)
    return _snapshot(spark, target, table).where(F.col(KIND) == ROWS).select(*raw_schema(table).names)


def take_in(
    spark: SparkSession, landing: str, root: str, archive: str | None = None, files_per_batch: int = 1000
) -> dict[str, DataFrame]:
    """Read what has landed; returns the raw tables with everything taken in so far."""
    running = []
    try:
        for table in APPENDED:
            running.append(feed_writer(spark, landing, root, table, archive, files_per_batch).start())
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()
    raw = {table: landed_rows(spark, root, table) for table in APPENDED}
    return raw | {table: take_snapshot(spark, landing, root, table) for table in (*S.SNAPSHOTS, ROSTER)}


def _note(root: str) -> str:
    return f"{root}/raw/_settled.json"


def unsettled(spark: SparkSession, root: str) -> dict[str, tuple[int, dt.datetime | None]]:
    """Newest batch of each feed that no finished run has used, and the earliest extraction time in such batches.

    A file that lands late may hold rows from before the watermark; a run reads from the
    earliest of them on.
    """
    note = _note(root)
    settled = tables.read_note(spark, note) if tables.exists(spark, note) else {}
    out = {}
    for table in S.FEEDS:
        rows = landed_rows(spark, root, table).where(F.col(BATCH) > settled.get(table, -1))
        newest, earliest = rows.agg(F.max(BATCH), F.min(S.EXTRACTED_AT)).head()
        if newest is not None:
            out[table] = newest, earliest
    return out


def settle(spark: SparkSession, root: str, used: dict[str, tuple[int, dt.datetime | None]]) -> None:
    """Note the batches that a finished run has used."""
    note = _note(root)
    settled = tables.read_note(spark, note) if tables.exists(spark, note) else {}
    tables.write_note(spark, note, settled | {table: batch for table, (batch, _) in used.items()})
