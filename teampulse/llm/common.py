"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.session import scratch_path

#: ASCII white space, as a Java character class.
SPACE = r"[\x20\x09-\x0D]"
#: Rows that Spark puts into one Arrow batch, and bytes of it that are worked on at a time.
BATCH_ROWS, SLICE_BYTES = 512, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL ids count as empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def plain_names(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with columns ``c0``, ``c1``, ..., so that added names clash with none, and the real names."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))), docs.columns


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, so that later steps survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Run a batch function in the tasks.  ``make`` is called once per task.

    Batches are worked on in slices of bounded size (one row at least), so that long
    texts do not pile up in a worker.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows):
                yield step(batch.slice(at, rows))

    return df.mapInArrow(run, schema)
