"""Upserts that look keys up in old months, and items that are only added."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from teampulse.sources import tables
from teampulse.streaming import weekly as ST

SCHEMA = "k string, at date, v int"


def day(month, d=1):
    return dt.date(2024, month, d)


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def hexed(i):
    return hashlib.md5(str(i).encode()).hexdigest()


@pytest.fixture
def plain(spark):
    """Plans without runtime changes, so that their scans can be found."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def rows_scanned(df):
    """Rows that the one scan of a frame hands on, after files and row groups are skipped."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def keys_of(spark, path, batch):
    watched, seen = tables._watch_keys(batch, ["k"])
    watched.collect()
    return tables.reachable(tables.read_table(spark, path).select("month", "k"), ["k"], seen.get, batch)


def test_old_months_are_skipped_by_the_range_of_the_keys(spark, tmp_path, plain, monkeypatch):
    path = str(tmp_path / "t")
    old = [(f"id{m}-{i:03}", day(m), i) for m in range(1, 7) for i in range(100)]
    tables.upsert(spark, path, frame(spark, *old), ["k"], "at", ["k"])
    monkeypatch.setattr(tables, "FEW_KEYS", 0)
    assert 0 < rows_scanned(keys_of(spark, path, frame(spark, ("id6-050", day(6), 0), ("id7-001", day(7), 0)))) <= 100
    assert rows_scanned(keys_of(spark, path, frame(spark, ("id7-001", day(7), 0)))) == 0


def test_few_random_keys_meet_the_bloom_filters(spark, tmp_path, plain):
    path = str(tmp_path / "t")
    old = [(hexed((m, i)), day(m), i) for m in range(1, 7) for i in range(200)]
    tables.upsert(spark, path, frame(spark, *old), ["k"], "at", ["k"])
    scanned = rows_scanned(keys_of(spark, path, frame(spark, (hexed((2, 7)), day(8), 0), (hexed("new"), day(8), 0))))
    assert 0 < scanned <= 400 < len(old)


@pytest.mark.parametrize("few", [0, 1000])
def test_moved_and_null_keys_are_found(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(tables, "FEW_KEYS", few)
    path = str(tmp_path / "t")
    tables.upsert(spark, path, frame(spark, ("a", day(1), 1), ("b", day(2), 1), (None, day(3), 1), ("z", day(1), 1)), ["k"], "at")
    tables.upsert(spark, path, frame(spark, ("a", day(4), 2), (None, day(4), 2)), ["k"], "at")
    got = {r["k"]: (r["at"], r["v"]) for r in tables.read_table(spark, path).collect()}
    assert got == {"a": (day(4), 2), None: (day(4), 2), "b": (day(2), 1), "z": (day(1), 1)}
    tables.upsert(spark, path, frame(spark, (None, day(5), 3)), ["k"], "at")
    got = {r["k"]: r["v"] for r in tables.read_table(spark, path).collect()}
    assert got == {"a": 2, None: 3, "b": 1, "z": 1}
    tables.upsert(spark, path, frame(spark).where("false"), ["k"], "at")
    assert tables.read_table(spark, path).count() == 4


def test_stream_adds_items_and_counts_them_once(spark, tmp_path):
    """Repeated items, a replayed batch, a compacting batch and an empty one."""
    landed, root = str(tmp_path / "in"), str(tmp_path / "root")
    schema = "m bigint, i string, at timestamp"

    def batch(*rows):
        spark.createDataFrame([(m, i, dt.datetime(2024, 1, d)) for m, i, d in rows], schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        ST.run_to_end(ST.recount_writer(stream, root, "m", "i", "at", "n", compact_every=3))
        counts = tables.read_table(spark, f"{root}/counts").collect()
        return {(r["community_member_id"], r["week_start_date"].day): r["n"] for r in counts}

    assert batch((1, "a", 1), (1, "b", 2), (2, "a", 3), (1, "a", 4)) == {(1, 1): 2, (2, 1): 1}
    assert batch((1, "a", 5), (1, "c", 5), (1, "a", 8)) == {(1, 1): 3, (2, 1): 1, (1, 8): 1}
    assert batch((1, "c", 5), (3, "x", 8)) == {(1, 1): 3, (2, 1): 1, (1, 8): 1, (3, 8): 1}
    assert batch((None, "c", 5)) == {(1, 1): 3, (2, 1): 1, (1, 8): 1, (3, 8): 1}
    items = tables.read_table(spark, f"{root}/items")
    assert items.count() == items.select("community_member_id", "item", "week_start_date").distinct().count() == 6
    # a task that ran twice may leave an item twice; the next count of its member still has it once
    tables.append_rows(items.where("item = 'b'").drop("month"), f"{root}/items", "week_start_date")
    assert batch((1, "d", 2))[1, 1] == 4
