"""The list of members with rows, stored exports, and role tags that name no business."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from teampulse.catalog import fixtures as X
from teampulse.operators.grid import MEMBER
from teampulse.plans import engagement as E
from teampulse.plans import exports as XP
from teampulse.plans import pipeline as P
from teampulse.plans import relations as B
from teampulse.session import scratch_path
from teampulse.sources import tables

SF = "/root/testdata/sf0.001"
PEOPLE = "community_member_id bigint, email string, first_name string, last_name string, user_profile_created_at timestamp"
FIRST, AS_OF = dt.date(2024, 1, 1), dt.date(2024, 3, 12)


def person(i, day):
    return (i, f"m{i}@x", "F", "L", None if day is None else dt.datetime.combine(day, dt.time()))


def counts(spark, name, *items):
    return spark.createDataFrame(list(items), f"community_member_id bigint, week_start_date date, {name} bigint")


@pytest.fixture
def weekly(spark):
    from teampulse.functions.rules import METRICS

    return {m: counts(spark, m, (1, dt.date(2024, 1, 8), 2), (2, dt.date(2024, 1, 8), 3), (3, dt.date(2024, 3, 4), 1)) for m in METRICS}


def ids(df):
    return sorted(r[0] for r in df.select(MEMBER).distinct().collect())


def rows(df):
    cols = [c for c in df.columns if c not in ("is_backfill", P.UPDATED, tables.MONTH)]
    return sorted(map(repr, df.select(sorted(cols)).collect()))


def test_list_follows_the_table(spark, weekly, monkeypatch):
    """Old members who are new to the table get their history, without the table being read for ids."""
    store = P.Store(spark, scratch_path(spark, "store"))
    people = spark.createDataFrame([person(1, FIRST), person(9, None)], PEOPLE)
    P.load_engagement(store, people, weekly, AS_OF, spine="calendar")
    assert ids(store.read(P.INTERMEDIATE, P.KNOWN)) == [1]
    later = spark.createDataFrame([person(1, FIRST), person(2, FIRST), person(9, None)], PEOPLE)
    seen = []
    real = E.mark_new
    monkeypatch.setattr(E, "mark_new", lambda m, target, n: seen.append(target) or real(m, target, n))
    for _ in range(2):  # a repeated run adds no id again
        done = P.load_engagement(store, later, weekly, AS_OF)
    assert all(set(t.columns) == {MEMBER} for t in seen) and len(seen) == 2
    known = store.read(P.INTERMEDIATE, P.KNOWN)
    assert ids(known) == [1, 2] and known.count() == 2 and ids(done) == [1, 2]
    whole = P.load_engagement(P.Store(spark, scratch_path(spark, "whole")), later, weekly, AS_OF, spine="calendar")
    assert rows(done) == rows(whole)


def test_missing_and_repeated_ids_heal(spark, weekly):
    """A run that broke off before the ids, ids that stand there twice, a store without the list."""
    people = spark.createDataFrame([person(1, FIRST), person(2, FIRST), person(3, dt.date(2024, 3, 1))], PEOPLE)
    expected = None
    for harm in ("none", "missing", "twice", "no list"):
        store = P.Store(spark, scratch_path(spark, "store"))
        done = P.load_engagement(store, people, weekly, AS_OF, spine="calendar")
        path = store.path(P.INTERMEDIATE, P.KNOWN)
        if harm == "missing":
            tables.replace_flat(spark.createDataFrame([(1,)], f"{MEMBER} bigint"), path)
        elif harm == "twice":
            tables.append_flat(spark.createDataFrame([(1,), (2,)], f"{MEMBER} bigint"), path)
        elif harm == "no list":
            fs, p = tables._fs(spark, path)
            fs.delete(p, True)
        done = P.load_engagement(store, people, weekly, AS_OF)
        expected = expected or rows(done)
        assert rows(done) == expected, harm
        assert ids(store.read(P.INTERMEDIATE, P.KNOWN)) == [1, 2, 3], harm


def test_exports_are_stored(spark):
    store = P.Store(spark, scratch_path(spark, "store"))
    out = P.run_weekly(spark, store.root, X.raw_tables(spark, SF), X.AS_OF)
    names = ("manager_list", "top_performers", "top_movers", "action_points", "pdf_blocks", "team_detail", "summary", "top3")
    for name in names:
        assert all(f"/{P.EXPORTS}/{name}/" in f for f in out[name].inputFiles()) and out[name].count() > 0, name
    pairs = XP.summary_export(out["detail"])
    assert rows(store.read(P.EXPORTS, "summary")) == rows(pairs.drop(P.REPORTED))


def test_role_tag_gives_no_candidates(spark):
    """The role tag is gone before the lists are spread; lists stay whole where there is no such tag."""
    schema = "community_member_id bigint, email string, tag_ids array<bigint>"
    members = spark.createDataFrame([(1, "a@x", [100, 20]), (2, "b@x", [100]), (3, None, [100, 20]), (4, "d@x", None), (5, "e@x", [101, 20])], schema)
    open_ones = spark.createDataFrame([(20, "Acme", 1), (21, "Birch", 1)], "tag_id bigint, business_name string, api_member_count bigint")
    none = spark.createDataFrame([], "business_tag_id bigint")
    tags = spark.createDataFrame([(100, "Business"), (101, "Manager")], "tag_id bigint, tag_name string")
    mails = lambda t: {r["business_tag_id"]: r["action_needed"].split(": ")[1] for r in B.businesses_without_managers(open_ones, none, members, t).collect()}
    assert mails(tags) == {20: "a@x", 21: "NO MEMBERS FOUND"}
    assert mails(tags.where(F.col("tag_id") == 101)) == {20: "a@x", 21: "NO MEMBERS FOUND"}
