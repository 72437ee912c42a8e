"""Rows kept once per team of managers against the rows of all pairs."""

import pytest
from pyspark.sql import functions as F
from test_teams import ACTIVE, AS_OF, CASES, PEOPLE, SF, frames, same

from teampulse import catalog
from teampulse.catalog.base import Base
from teampulse.operators import quality as Q
from teampulse.operators import ranking
from teampulse.operators.weeks import only_newest, with_previous_week
from teampulse.plans import exports as XP
from teampulse.plans import metrics as M
from teampulse.plans import monthly as MO
from teampulse.plans import relations as B
from teampulse.plans import reports as W
from teampulse.plans import teams as T
from teampulse.session import stored

MORE = {
    "same team twice, one manager with more": [
        *[(f"{c}@x", c, t, n) for c in "ab" for t, n in ((20, "Acme"), (21, "Birch"))],
        *[("c@x", "C", t, n) for t, n in ((20, "Acme"), (21, "Birch"), (22, "Cedar"))],
    ],
    "two names of one manager": [("a@x", "A A", 20, "Acme"), ("a@x", "Al", 21, "Birch"), ("b@x", "B", 20, "Acme"), ("b@x", "B", 21, "Birch")],
    "no address": [(None, "A", 20, "Acme"), (None, "B", 21, "Birch"), ("b@x", "B", 20, "Acme")],
}
EXPORTS = [XP.manager_list, XP.section_counts, XP.top_performers, XP.top_movers, XP.candidates, XP.action_points, XP.pdf_blocks, XP.manager_weeks]


def given(spark, case):
    """Mapping, pairs, team and the rows per business."""
    mapping, members, tags, weeks = frames(spark, PEOPLE, (CASES | MORE)[case], ACTIVE)
    mapping, pairs = stored(mapping, "mapping"), stored(B.business_relationships(mapping, members, tags), "pairs")
    rows = T.member_rows(T.managed_members(mapping, members, tags), weeks, AS_OF, keep=["previous"])
    return mapping, pairs, stored(W.team_engagement(pairs, weeks, AS_OF), "team"), stored(rows, "rows")


@pytest.mark.parametrize("case", ["two businesses of one name", *MORE])
def test_reports_equal_the_pairs(spark, case):
    mapping, pairs, team, rows = given(spark, case)
    assert same(W.manager_rankings(team, pairs), T.manager_rankings(mapping, rows).pairs()) > 0
    same(W.manager_rankings(team, pairs, per_business=True), T.manager_rankings(mapping, rows, per_business=True).pairs())
    same(W.manager_report_nested(team, pairs), T.manager_report_nested(mapping, rows))
    same(W.team_detail(team), T.team_detail(mapping, rows).pairs())


@pytest.mark.parametrize("case", ["same team twice, one manager with more", "no address"])
def test_exports_equal_the_pairs(spark, case):
    mapping, pairs, team, rows = given(spark, case)
    old, new = stored(W.manager_rankings(team, pairs), "old"), T.manager_rankings(mapping, rows)
    for export in EXPORTS:
        same(export(old), export(new))
    checked = ["manager_email", "member_email", "suggested_action"]
    same(Q.missing_values(old, checked), Q.missing_values(new.known(checked[:1], checked[1:]), checked, "times"))
    old, new = W.team_detail(team), T.team_detail(mapping, rows)
    same(XP.team_detail_export(old), XP.team_detail_export(new))
    same(XP.top3_export(old), XP.top3_export(new))


@pytest.mark.parametrize("case", ["two businesses of one name", "two names of one manager"])
def test_detail_list_is_in_order_and_sorts_cells(spark, case, monkeypatch):
    """one team's rows are ranked once; neither the pairs nor bounds sampled from them are needed."""
    monkeypatch.setattr(T, "CELL", 2)
    mapping, pairs, team, rows = given(spark, case)
    old, new = XP.team_detail_export(W.team_detail(team)), XP.team_detail_export(T.team_detail(mapping, rows))
    assert same(old, new) > 0
    order = ["manager_email", "week_start_date", "week_total_engagement", "team_member"]
    assert new.select(order).collect() == old.select(order).collect()
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "__turn" in plan
    made = XP.team_detail_export(T.team_detail(mapping.limit(0), rows))
    assert made.collect() == [] and made.columns == old.columns


def test_managers_of_one_team_add_no_rows(spark):
    frames_of = [frames(spark, PEOPLE, [(f"{c}@x", c, 20, "Acme") for c in names], ACTIVE) for names in ("a", "abcdef")]
    counts = []
    for mapping, members, tags, weeks in frames_of:
        rows = T.member_rows(T.managed_members(mapping, members, tags), weeks, AS_OF)
        counts.append(T.manager_rankings(mapping, rows).rows.count())
    assert counts[0] == counts[1] > 0


def test_exports_read_no_pairs(spark):
    b = Base.of(spark, SF)
    pairs = {f.rsplit("/", 2)[1] for df in (b.relationships, b.team, b.rankings, b.detail) for f in df.inputFiles()}
    open_ones = B.businesses_without_managers(b.businesses, b.mapping, b.members, b.tags)
    for df in (XP.pdf_blocks(b.ranked), XP.manager_list(b.ranked), XP.top3_export(b.detailed), open_ones):
        read = {f.rsplit("/", 2)[1] for f in df.inputFiles()}
        assert read and not read & pairs


@pytest.mark.parametrize("case", ["two businesses of one name", "two names of one manager", "no address"])
def test_monthly_reports_equal_the_pairs(spark, case):
    mapping, members, tags, _ = frames(spark, PEOPLE, (CASES | MORE)[case], ACTIVE)
    done = [("11", "go", "2024-01-02"), ("12", "go", "2024-01-03"), ("14", "sql", "2024-01-04"), ("14", "go", "2023-12-04")]
    courses = spark.createDataFrame(done, "initiator_community_id string, course_name string, at string")
    courses = stored(courses.withColumn("created_at", courses["at"].cast("timestamp")), "courses")
    pairs = stored(B.business_relationships(mapping, members, tags), "pairs")
    for report in (MO.course_counts, MO.member_status, MO.monthly_report):
        same(report(courses, pairs), T.per_team_report(mapping, members, tags, lambda few: report(courses, few)))  # noqa: B023


def test_comments_are_cleaned_once_for_both_counts(spark, monkeypatch):
    """The stored inputs of team_summary and score_weighted parse each feed once."""
    b, reads = Base(spark, SF), {}

    def stored(self, name, df, spread=()):
        reads[name] = df.inputFiles()
        return written(self, name, df, spread)

    written = Base.stored
    monkeypatch.setattr(Base, "stored", stored)
    found = b.weekly
    raw = [name for name, files in reads.items() if any("events.parquet" in f for f in files)]
    assert sorted(raw) == ["classes_attended", "comments", "lessons_completed", "likes_received"]
    direct = M.weekly_tables(b.feeds)
    for name in ("comments_received", "comments_made"):
        assert same(direct[name], found[name]) > 0


RANKS = ["performance_rank", "mover_rank", "inactive_rank"]
LABELS = ["performance_category", "momentum_category", "suggested_action"]


@pytest.mark.parametrize("case", ["two businesses of one name", *MORE])
def test_rank_queries_make_no_pairs_before_the_end(spark, case, monkeypatch):
    """Neither the pairs nor the team report over them is stored or ranked."""
    mapping, members, tags, weeks = frames(spark, PEOPLE, (CASES | MORE)[case], ACTIVE)
    pairs = stored(B.business_relationships(mapping, members, tags), "pairs")
    team = stored(W.team_engagement(pairs, weeks, AS_OF), "team")
    rows = W.week_over_week(W.scored(team))
    keys = {name: [*order, F.col("business_name")] for name, order in W.rank_keys().items()}
    all_ranks = stored(W.with_labels(W.with_ranks(ranking.with_row_ids(rows), W.TEAM)), "ranks")
    key = ["manager_email", "business_name", "member_community_id"]
    expected = {name: all_ranks.select(*key, name) for name in LABELS}
    for name in RANKS:
        of = ranking.rank_rows(rows, W.TEAM, keys[name], name).select(*key, name)
        expected[f"rank_{name.removesuffix('_rank')}".replace("mover", "movers")] = of
    expected["rank_performance_split"] = expected["rank_performance"]
    expected["percent_rank_split"] = all_ranks.select(*key, "performance_percentile")
    both = only_newest(with_previous_week(W.scored(team), key, {"total_points": "previous_week_points"}))
    change = (F.col("total_points") - F.col("previous_week_points")).alias("points_change")
    expected["wow_compare"] = both.select(*key, "total_points", "previous_week_points", change)
    top = W.scored(W.team_engagement(pairs, weeks, AS_OF, 1))
    expected["topk_per_group"] = ranking.top_rows(top, W.TEAM, keys["performance_rank"], 3).select(
        "manager_email", "manager_full_name", "business_name", "member_full_name", "total_points", "rank"
    )
    expected["team_engagement"] = team.drop("previous")

    b = Base(spark, case)
    b.__dict__.update(mapping=stored(mapping, "mapping"), members=members, tags=tags, engagement=weeks)
    monkeypatch.setattr(Base, "of", lambda spark, sf_dir: b)
    for name in ("relationships", "team"):
        monkeypatch.setattr(Base, name, property(lambda self: pytest.fail("the pairs are stored")))
    for name, old in expected.items():
        assert same(old, catalog.queries()[name](spark, case)) > 0
    # managers of one team share its rows
    assert b.team_weeks.rows.count() <= team.count()


def test_nested_report_is_not_shuffled_per_manager(spark):
    """team size and text are settled before a team's list is handed to its managers."""
    mapping, _, _, rows = given(spark, "two names of one manager")
    names = F.array_join(F.transform("team_members", lambda m: m["member_name"]), "|")
    text = lambda report: report.withColumn("team_members", names)
    whole, made = T.manager_report_nested(mapping, rows), T.manager_report_nested(mapping, rows, text)
    assert same(text(whole), made) > 0
    for report in (whole, made):
        joins_of = [x for x in report._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join " in x]
        assert "__slice" in joins_of[0]


def test_a_text_of_many_managers_is_written_once(spark, tmp_path):
    """lists of megabytes that the managers of a team share."""
    letters = "".join(chr(97 + (i * i * 7919 + i // 3 * 104729) % 26) + str(i * 31 % 9973) for i in range(400_000))
    rows = spark.range(24).repartition(1).withColumn("list", F.lit(letters))
    rows.write.parquet(str(tmp_path / "lists"))
    assert sum(f.stat().st_size for f in (tmp_path / "lists").glob("*.parquet")) < 2 * len(letters)
    assert spark.read.parquet(str(tmp_path / "lists")).where(F.col("list") == letters).count() == 24
