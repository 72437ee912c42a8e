"""The registered queries of this subpackage, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.llm import bpe, centroids, decontamination, divergence, jaccard, langid, line_rules, main_text, quality_nbsvm, sharding, simhash, surrogates, token_counts
from teampulse.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn

    return add


@query("op9_feistel_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op7_bpe_round_trip")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query("op6_simhash_components")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


@query("op10_language_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold("doc_id", 3) != 1))
    rows = langid.labelled(docs, model)
    return rows.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query("op2_nbsvm_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_nbsvm.fit(docs, labels, use=fold("doc_id", 5) != 0)
    rows = quality_nbsvm.scored(docs, model)
    predicted = (F.col("score") >= quality_nbsvm.THRESHOLD).cast("int").alias("predicted")
    return rows.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", predicted)


@query("op5_line_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_rules.line_verdicts(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op5_line_rules"] = line_rules.ORACLE


@query("op1_spaced_seeds")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op1_spaced_seeds"] = decontamination.ORACLE


@query("op8_surrogates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = surrogates.checked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(F.col("c0").alias("doc_id"), F.col("c1").alias("text"), F.size("entities").cast("long").alias("n_entities"))


@query("op4_nearest_page")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op12_source_divergence")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence"] = divergence.ORACLE


@query("op13_hilbert_centroids")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


ORACLES["op13_hilbert_centroids"] = centroids.ORACLE


@query("op11_prefix_groups")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


ORACLES["op11_prefix_groups"] = jaccard.ORACLE
