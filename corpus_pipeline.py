"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

Every stage works on all rows that its predecessor kept.  All but the last return the
columns of ``documents``; the last returns ids, decoded text and their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.llm import bpe, decontamination, langid, simhash, surrogates
from teampulse.llm.common import fold, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or with most letters in no one learned language, go."""
    model = langid.fit(docs.where(fold("doc_id", 3) != 1))
    return langid.in_known_language(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group whose fingerprints of three-word shingles link at two or fewer bits."""
    return simhash.without_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of ``benchmark`` go."""
    return decontamination.without_passages(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; ``n_chars`` follows the text."""
    rows = surrogates.replaced(docs)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their decoded text, n_tokens."""
    return bpe.encoded(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: No SQL: language scores, fingerprints, keyed surrogates and merges are not expressible.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
