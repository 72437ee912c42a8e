"""The training sample of the language model, and texts in several learned languages."""

import pytest
from pyspark.sql import functions as F

from teampulse.llm import langid

SCHEMA = "doc_id bigint, text string, lang string, source string"
WORDS = {"aa": "the house and the river", "bb": "der hund und das haus", "cc": "le chat et la maison", "rare": "domus et flumen magnum"}


@pytest.fixture(scope="module")
def labelled(spark):
    """A hundred thousand rows of one language, a third of them one text, and twenty of another."""
    many = spark.range(100_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit(WORDS["aa"])).otherwise(F.concat(F.lit(WORDS["aa"] + " "), F.col("id"))).alias("text"),
        F.lit("aa").alias("lang"),
        F.lit("s").alias("source"),
    )
    few = [(200_000 + i, f"{WORDS['rare']} {i}", "rare", "s") for i in range(20)]
    odd = [(None, WORDS["aa"], "aa", None), (7, None, "aa", "s"), (8, "no label", None, "s"), (None, "", "aa", "s")]
    return many.unionByName(spark.createDataFrame(few + odd, SCHEMA))


def test_each_language_is_learned(spark, labelled):
    took = {r["lang"]: r["n"] for r in langid.sample(labelled, "text", "lang", 750).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(took) == {"aa", "rare"} and took["rare"] == 20 and 600 <= took["aa"] <= 900
    model = langid.fit(labelled)
    assert model.languages == ["aa", "rare"]
    texts = [WORDS["aa"] + " once more", WORDS["rare"] + " et domus"]
    assert [r[0] for r in langid.Labeller(model).label(texts)] == ["aa", "rare"]


def test_same_model_for_another_file_split(spark, labelled, tmp_path):
    labelled.repartition(7, F.rand(3)).write.parquet(f"{tmp_path}/seven")
    again = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/seven").orderBy(F.desc("text"))
    one, two = langid.fit(labelled), langid.fit(again)
    assert one.languages == two.languages and (one.rows == two.rows).all() and (one.logs == two.logs).all()
    assert (one.barred == two.barred).all()


def test_clean_text_in_three_languages_stays(spark):
    rows = [(i, " ".join([t] * 20), of, "s") for i, (of, t) in enumerate(WORDS.items())]
    model = langid.fit(spark.createDataFrame(rows, SCHEMA))
    mixed = "\n".join(" ".join([WORDS[of]] * n) for of, n in (("aa", 9), ("bb", 6), ("cc", 5)))
    docs = spark.createDataFrame([(1, mixed, None, None), (2, "привет мир " * 9 + "the", None, None), (3, "12 34", None, None), (None, mixed, None, None)], SCHEMA)
    found = {r["doc_id"]: r for r in langid.labelled(docs, model).collect()}
    assert found[1]["lang_score"] < 0.5 and found[1]["known_score"] == 1.0 and len(found[1]["spans"]) == 3
    assert found[2]["known_score"] < 0.5 and found[3]["known_score"] == 0.0
    kept = langid.in_known_language(docs, model)
    assert sorted(r["text"] for r in kept.collect()) == [mixed, mixed] and kept.columns == docs.columns
