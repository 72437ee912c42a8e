"""Names of several forms, and the end of the collision check."""

import pytest
from pyspark.sql import functions as F

from teampulse.llm import surrogates


def replaced(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in surrogates.replaced(df).orderBy("doc_id").collect()]


def test_hyphen_and_space_are_one_name(spark):
    df = spark.createDataFrame([("Mr Jean-Pierre",), ("Mr Jean Pierre",), ("Ms Anna-Maria Xu",), ("Ms Anna Maria Xu",)], "text string")
    assert surrogates.collisions(surrogates.replaced_text(df, "text")).isEmpty()
    a, b, c, d = replaced(spark, *[r["text"] for r in df.collect()])
    assert a.replace("-", " ") == b and c.replace("-", " ") == d and "-" in a and "-" in c


def test_collisions_under_every_key_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "collisions", lambda found: found.select(F.lit("name").alias("kind")))
    with pytest.raises(RuntimeError):
        surrogates.replaced(spark.createDataFrame([("Mr Smith",)], "text string"))


def test_whole_names_and_untitled_mentions(spark):
    texts = ["Señor Juan Carlos García López came", "Mr McDonald and Ms O'Brien, Dr Jane Roe", "Mr John Smith came. Later John Smith's car; Smith left", "Herr Prof. Dr. Ludwig van Beethoven"]
    out = replaced(spark, *texts)
    for text, new in zip(texts, out):
        for word in ("Juan", "García", "López", "McDonald", "Donald", "Brien", "Jane", "Roe", "John", "Smith", "Ludwig", "Beethoven"):
            assert word not in text or word not in new, (word, new)
    name = out[2].split(" came")[0].removeprefix("Mr ")
    assert out[2] == f"Mr {name} came. Later {name}'s car; {name.split()[-1]} left"
    assert out[3].startswith("Herr Prof. Dr. ")
