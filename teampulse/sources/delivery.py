"""Append-only log of sent reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.sources import schemas as S
from teampulse.sources.tables import append_rows


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.DELIVERY_LOG)


def log_rows(sent: DataFrame) -> DataFrame:
    """Rows in the log's shape; a missing delivery id is filled, missing columns are NULL."""
    shape = empty_log(sent.sparkSession).schema
    have = set(sent.columns)
    cols = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape
    ]
    rows = sent.select(*cols)
    return rows.withColumn("delivery_id", F.coalesce("delivery_id", F.uuid()))


def append_log(sent: DataFrame, path: str) -> DataFrame:
    return append_rows(log_rows(sent), path, "sent_at")
