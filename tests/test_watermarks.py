"""Watermarks that writes note, and ranks on narrow rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from teampulse.operators import incremental as I
from teampulse.operators import ranking
from teampulse.sources import tables
from teampulse.sources.schemas import EXTRACTED_AT

SCHEMA = f"k string, day date, created_at timestamp, `{EXTRACTED_AT}` timestamp, text string"


def at(day, hour=0, micro=0):
    return dt.datetime(2024, 1, day, hour, 0, 0, micro)


def rows(spark, *items):
    return spark.createDataFrame([(k, dt.date(2024, 1, d), at(d), e, "x") for k, d, e in items], SCHEMA)


@pytest.fixture
def no_scan(monkeypatch):
    def fail(*_):
        raise AssertionError("the table was scanned")

    def start():
        monkeypatch.setattr(tables, "read_table", fail)

    yield start
    monkeypatch.undo()


def marks(spark, path):
    return tables.newest(spark, path, EXTRACTED_AT), tables.newest(spark, path, "day")


def test_each_way_to_write_notes_the_newest(spark, tmp_path, no_scan):
    first = rows(spark, ("a", 3, at(9, 4, 17)), ("b", 5, None))
    tables.replace_table(first, f"{tmp_path}/t", "day")
    tables.upsert(spark, f"{tmp_path}/u", first, ["k"], "day")
    tables.upsert(spark, f"{tmp_path}/u", rows(spark, ("a", 4, at(8)), ("c", 20, at(11, 1))), ["k"], "day")
    tables.append_rows(first, f"{tmp_path}/a", "day")
    tables.append_rows(rows(spark, ("z", 1, at(30))), f"{tmp_path}/a", "day")
    tables.replace_table(first.where("false"), f"{tmp_path}/e", "day")
    no_scan()
    assert marks(spark, f"{tmp_path}/t") == (at(9, 4, 17), dt.date(2024, 1, 5))
    assert marks(spark, f"{tmp_path}/u") == (at(11, 1), dt.date(2024, 1, 20))
    assert marks(spark, f"{tmp_path}/a") == (at(30), dt.date(2024, 1, 5))
    assert marks(spark, f"{tmp_path}/e") == (None, None)


def test_a_replaced_table_forgets_and_an_old_one_is_scanned(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace_table(rows(spark, ("a", 9, at(9))), path, "day")
    tables.replace_table(rows(spark, ("a", 2, at(2))), path, "day")
    assert marks(spark, path) == (at(2), dt.date(2024, 1, 2))
    state = tables._state(spark, path)
    del state["newest"]  # as written before writes noted anything
    tables._save_state(spark, path, state)
    tables.upsert(spark, path, rows(spark, ("b", 1, at(1))), ["k"], "day")
    assert marks(spark, path) == (at(2), dt.date(2024, 1, 2))  # not the newest of the last write only
    assert tables.newest(spark, path, "created_at") == at(2)


def test_marks_are_those_of_a_scan(spark, tmp_path):
    done = tables.upsert(spark, f"{tmp_path}/t", rows(spark, *[(f"k{i}", 1 + i % 28, at(1 + i % 28, i % 24, i)) for i in range(200)]), ["k"], "created_at")
    assert tables.newest(spark, f"{tmp_path}/t", EXTRACTED_AT) == I.extraction_mark(done)
    assert tables.newest(spark, f"{tmp_path}/t", "created_at") == done.agg(F.max("created_at")).head()[0]
    week = dt.date(2024, 1, 15)
    assert I.weeks_since(week) == week - dt.timedelta(weeks=4) and I.months_since(dt.date(2024, 3, 31)) == dt.date(2024, 2, 1)


def test_ranks_sort_narrow_rows_only(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("g"), "id", F.repeat(F.lit("wide"), 100).alias("wide"), F.lit(1).alias("other"))
    with_ids = ranking.with_row_ids(df)
    plan = ranking.ranks(with_ids, ["g"], [F.col("id")], "r")._jdf.queryExecution().optimizedPlan().toString()
    assert "wide" not in plan and "other" not in plan
    got = ranking.rank_rows(df, ["g"], [F.col("id")], "r")
    assert got.columns == ["g", "id", "wide", "other", "r"]
    assert all(r["r"] == r["id"] // 3 + 1 for r in got.collect())
