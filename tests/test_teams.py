"""Team totals per business against the totals over all pairs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from teampulse.catalog.base import Base
from teampulse.plans import exports as XP
from teampulse.plans import relations as B
from teampulse.plans import reports as W
from teampulse.plans import teams as T

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 1, 31)
LAST, BEFORE = dt.date(2024, 1, 22), dt.date(2024, 1, 15)
MEMBER = (
    "community_member_id bigint, first_name string, last_name string, full_name string, email string, "
    "profile_completeness string, tag_ids array<bigint>"
)
TAGS = "tag_id bigint, tag_name string"
MAPPING = (
    "manager_community_id bigint, manager_first_name string, manager_last_name string, manager_full_name string, "
    "manager_email string, business_tag_id bigint, business_name string, business_total_members bigint, "
    "business_size string, business_confidence string, team_size bigint"
)
WEEKS = (
    "community_member_id bigint, week_start_date date, classes_attended bigint, lessons_completed bigint, "
    "likes_received bigint, comments_received bigint, comments_made bigint"
)


def frames(spark, people, owners, weeks):
    """``people``: (id, first name, tags); ``owners``: (manager, name, tag, business); ``weeks``: (id, week, count)."""
    members = [(i, n, "L", None if n is None else f"{n} L", f"m{i}@x", "full", [1, *t]) for i, n, t in people]
    mapping = [(9, "Man", None, full, mail, tag, name, 5, "small", "high", 2) for mail, full, tag, name in owners]
    tags = [(1, "Business"), (2, "Manager"), *{(o[2], o[3]) for o in owners}]
    rows = [(i, w, n, 0, n, 1, 0) for i, w, n in weeks]
    return (
        spark.createDataFrame(mapping, MAPPING),
        spark.createDataFrame(members, MEMBER),
        spark.createDataFrame(tags, TAGS),
        spark.createDataFrame(rows, WEEKS),
    )


def both(mapping, members, tags, engagement):
    """Summary and export over the pairs, and over the businesses."""
    pairs = B.business_relationships(mapping, members, tags)
    team = W.team_engagement(pairs, engagement, AS_OF)
    rows = T.member_rows(T.managed_members(mapping, members, tags), engagement, AS_OF)
    return (
        (W.team_summary(W.week_over_week(W.scored(team)), W.team_stats(pairs)), T.team_summary(mapping, rows)),
        (XP.summary_export(W.team_detail(team)), T.summary_export(mapping, rows)),
    )


def same(old, new):
    assert sorted(old.columns) == sorted(new.columns)
    plain = lambda df: sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    assert plain(old) == plain(new)
    return len(plain(new))


PEOPLE = [(11, "Ann", [20]), (12, "Ann", [20, 21]), (13, "Bo", [21, 21]), (14, None, [21, 22]), (15, "Cy", [22]), (16, "Di", [])]
ACTIVE = [(11, LAST, 2), (11, BEFORE, 1), (12, BEFORE, 4), (13, LAST, 0), (14, LAST, 7), (15, BEFORE, 3)]
CASES = {
    "one manager": [("a@x", "A A", 20, "Acme")],
    "many managers of one business": [(f"{c}@x", c, 20, "Acme") for c in "abcdef"],
    "two businesses share a member": [("a@x", "A A", 20, "Acme"), ("a@x", "A A", 21, "Birch")],
    "two businesses of one name": [("a@x", "A A", 20, "Acme"), ("a@x", "A A", 21, "Acme"), ("b@x", "B", 21, "Acme")],
    "three of one name, one without a team": [("a@x", "A A", t, "Acme") for t in (20, 22, 29)],
    "no team": [("a@x", "A A", 29, "Empty")],
    "no manager name": [("a@x", None, 20, "Acme"), ("a@x", None, 21, "Acme"), ("b@x", None, 22, "Birch")],
}


@pytest.mark.parametrize("case", CASES)
def test_equals_the_pairs(spark, case):
    given = frames(spark, PEOPLE, CASES[case], ACTIVE)
    groups = {(o[0], o[3]) for o in CASES[case]}
    for old, new in both(*given):
        assert same(old, new) == len(groups)


def test_no_finished_week_and_empty_tables(spark):
    mapping, members, tags, weeks = frames(spark, PEOPLE, CASES["one manager"], ACTIVE)
    for given in (
        (mapping, members, tags, weeks.limit(0)),
        (mapping.limit(0), members, tags, weeks),
        (mapping, members.limit(0), tags, weeks),
    ):
        for old, new in both(*given):
            same(old, new)


def test_extra_columns_do_not_matter(spark):
    mapping, members, tags, weeks = frames(spark, PEOPLE, CASES["two businesses of one name"], ACTIVE)
    odd = weeks.withColumn("manager_email", F.lit("z")).withColumn("tag_id", F.lit(3))
    rows = T.member_rows(T.managed_members(mapping, members, tags), odd, AS_OF)
    plain = T.member_rows(T.managed_members(mapping, members, tags), weeks, AS_OF)
    same(T.summary_export(mapping, plain), T.summary_export(mapping, rows))


def test_totals_read_no_pairs(spark):
    """Neither the pairs nor the team report is in the plan, and managers add no member rows."""
    b = Base.of(spark, SF)
    pairs = {f.rsplit("/", 2)[1] for df in (b.relationships, b.team) for f in df.inputFiles()}
    for df in (T.team_summary(b.mapping, b.member_rows), T.summary_export(b.mapping, b.member_rows)):
        read = {f.rsplit("/", 2)[1] for f in df.inputFiles()}
        assert read and not read & pairs
    managed = T.managed_members(b.mapping, b.members, b.tags)
    again = T.managed_members(b.mapping.unionByName(b.mapping.withColumn("manager_email", F.lit("n@x"))), b.members, b.tags)
    assert managed.count() == again.count() == b.member_rows.count()
