"""Rows without an id or with a common one, repeated words, and hosts of any size."""

import random

import duckdb
import pytest

from teampulse.llm import decontamination, line_rules, simhash

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def oracle(sql, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toPandas())
    return sorted((tuple(r) for r in con.execute(sql).fetchall()), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_each_group_keeps_one_row_whatever_its_ids(spark):
    text = " ".join(f"w{i}" for i in range(400))
    near = text + " w400"  # a distance of two bits at most is checked below
    rows = [(None, text), (None, near), (5, "a text of its own"), (5, "another text under the same id"), (None, "alone without an id"),
            (9, "copies copies of"), (3, "copies copies of"), (3, "copies copies of"), (None, "copies copies of"), (None, None), (None, ""), (2, " ")]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    assert bin(simhash.fingerprint(text.encode()) ^ simhash.fingerprint(near.encode())).count("1") <= 2
    left = rows_of(simhash.without_copies(df))
    assert (3, "copies copies of") in left and sum(t == "copies copies of" for _, t in left) == 1
    assert sum(t in (text, near) for _, t in left) == 1 and (2, " ") in left
    assert {(5, "a text of its own"), (5, "another text under the same id"), (None, "alone without an id")} <= set(left)
    assert len(left) == 6


def test_passages_go_by_text_and_not_by_id(spark):
    leak = "one two three four five six seven eight nine ten eleven"
    rows = [(None, leak), (None, "clean without an id"), (None, None), (7, leak), (7, "clean under a common id"), (7, "clean under a common id")]
    left = decontamination.without_passages(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, leak)], ITEMS))
    assert rows_of(left) == sorted((r for r in rows if r[1] != leak), key=repr)


@pytest.mark.parametrize("n,m", [(20_000, 1000), (1500, 31), (40, 400)])
def test_repeated_words_do_not_multiply_rows(spark, n, m):
    docs = spark.createDataFrame([(1, "tick " * n), (2, "tick tock " * n), (3, "tack " * 7 + "tick " * 5)], DOCS)
    items = spark.createDataFrame([(1, "tick " * m), (2, "tock tick " * m), (3, "tack " * 8)], ITEMS)
    got = {(r["doc_id"], r["item_id"]): (r["overlap"], r["place"]) for r in decontamination.passages(docs, items).collect()}
    assert got[1, 1] == (1.0, 0) and got[2, 2] == (1.0, 0) and got[3, 3][0] == 7 / 8


def test_repeats_with_changes_are_the_sql(spark):
    rnd = random.Random(8)
    words = [*"abcde"]
    docs = spark.createDataFrame([(i, " ".join(rnd.choices(words[: 1 + i % 5], k=rnd.randint(5, 90)))) for i in range(40)], DOCS)
    items = spark.createDataFrame([(i, " ".join(rnd.choices(words[: 1 + i % 5], k=rnd.randint(8, 60)))) for i in range(12)], ITEMS)
    got = rows_of(decontamination.passages(docs, items).select("doc_id", "item_id", "overlap", "place"))
    assert got == oracle(decontamination.ORACLE, documents=docs, benchmark=items) and len(got) > 20


def test_one_limit_for_hosts_of_any_size(spark):
    page = "Home | About | Contact us now"
    rows = [(i, f"{page}\n" + " ".join(f"own{i}x{j}" for j in range(15)) if i < 5 else f"{page}\nfew" if i < 7 else f"own text {i} " * 3, "h") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_rules.line_verdicts(df).drop("removed_words")
    got = rows_of(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
    assert got == oracle(line_rules.ORACLE, documents=df)
    assert [r[-1] for r in got if r[0] in (0, 5)] == [True, False]
