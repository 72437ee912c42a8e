"""Reports on hand-made teams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from teampulse.plans import exports as XP
from teampulse.plans import monthly as MO
from teampulse.plans import relations as B
from teampulse.plans import reports as W
from teampulse.plans import staging as C
from teampulse.session import stored

AS_OF = dt.date(2024, 1, 31)
LAST, BEFORE = dt.date(2024, 1, 22), dt.date(2024, 1, 15)

RELATION = (
    "business_name string, business_tag_id bigint, business_total_members bigint, team_size bigint, business_size string, "
    "business_confidence string, manager_community_id bigint, manager_email string, manager_first_name string, "
    "manager_last_name string, manager_full_name string, member_community_id bigint, member_email string, "
    "member_first_name string, member_last_name string, relationship_type string"
)
ENGAGEMENT = (
    "community_member_id bigint, week_start_date date, classes_attended bigint, lessons_completed bigint, "
    "likes_received bigint, comments_received bigint, comments_made bigint"
)


def relation(manager, business, member, first="F", last="L", size=2):
    kind = "manager_only" if member is None else "has_team"
    mail = None if member is None else f"m{member}@x"
    names = (None, None) if member is None else (first, last)
    tag = sum(map(ord, business))
    return (business, tag, 5, size, "small", "high", 1, manager, "Man", "Ager", "Man Ager", member, mail, *names, kind)


def report(spark, relations, engagement, n_weeks=2, **kw):
    rel = spark.createDataFrame(relations, RELATION)
    eng = spark.createDataFrame(engagement, ENGAGEMENT)
    team = stored(W.team_engagement(rel, eng, AS_OF, n_weeks), "team")
    return team, W.manager_rankings(team, rel, **kw)


@pytest.fixture(scope="module")
def two_businesses(spark):
    rel = [relation("m@x", b, i, f"N{i}") for b, ids in (("A", (1, 2)), ("B", (3, 4))) for i in ids]
    eng = [(i, w, n, 0, 0, 0, 0) for i, w, n in ((1, LAST, 2), (1, BEFORE, 1), (3, LAST, 0), (3, BEFORE, 1))]
    return rel, eng


def test_multi_business_manager(spark, two_businesses):
    _, default = report(spark, *two_businesses)
    assert default.count() == 8
    _, split = report(spark, *two_businesses, per_business=True)
    assert split.count() == 4


@pytest.fixture(scope="module")
def keyless(spark):
    """Three managers of two members each: one without e-mail, one without name; one business without name."""
    rel = []
    for k, (mail, name, business) in enumerate((("m@x", "Man", "A"), (None, "No Mail", "A"), ("n@x", None, None))):
        for i in (1, 2):
            row = list(relation(mail, "A", 10 * k + i, f"N{i}"))
            row[0], row[10], row[8], row[9] = business, name, name, None
            rel.append(tuple(row))
    eng = [(r[11], LAST, 1, 0, 0, 0, 0) for r in rel] + [(r[11], BEFORE, 2, 0, 0, 0, 0) for r in rel]
    return rel, eng


def test_null_keys_keep_their_groups(spark, keyless):
    rel = spark.createDataFrame(keyless[0], RELATION)
    team, ranked = report(spark, *keyless)
    nested = W.manager_report_nested(team, rel).collect()
    assert sorted((r["manager_email"] or "", len(r["team_members"])) for r in nested) == [("", 2), ("m@x", 2), ("n@x", 2)]
    assert ranked.count() == 6
    counts = ranked.groupBy("manager_email").agg(F.max("team_total_points").alias("t"))
    assert sorted((r["manager_email"] or "", r["t"]) for r in counts.collect()) == [("", 10), ("m@x", 10), ("n@x", 10)]


def test_monthly_report_of_a_manager_without_name(spark, keyless):
    rel = spark.createDataFrame(keyless[0], RELATION)
    done = [(i, dt.datetime(2024, 1, 5), "Course") for i in (1, 2, 21, 22)]
    courses = spark.createDataFrame(done, "initiator_community_id bigint, created_at timestamp, course_name string")
    got = {r["manager_email"]: r for r in MO.monthly_report(courses, rel).collect()}
    assert {k: r["total_course_completions"] for k, r in got.items()} == {"m@x": 2, "n@x": 2}
    assert got["n@x"]["unique_learners_count"] == 2


def test_week_over_week(spark, two_businesses):
    _, both = report(spark, *two_businesses)
    got = {r["member_community_id"]: (r["total_points"], r["previous_week_points"], r["points_change"]) for r in both.collect()}
    assert got == {1: (10, 5, 5), 2: (0, 0, 0), 3: (0, 5, -5), 4: (0, 0, 0)}
    _, single = report(spark, *two_businesses, n_weeks=1)
    got = {r["member_community_id"]: r["points_change"] for r in single.collect()}
    assert got == {1: 10, 2: 0, 3: 0, 4: 0}


def test_points_add_up(spark, two_businesses):
    _, ranked = report(spark, *two_businesses, per_business=True)
    rows = ranked.groupBy("business_name").agg(F.sum("total_points").alias("s"), F.max("team_total_points").alias("t"))
    assert all(r["s"] == r["t"] for r in rows.collect())


def test_running_week_is_left_out(spark, two_businesses):
    rel, eng = two_businesses
    team, _ = report(spark, rel, [*eng, (1, dt.date(2024, 1, 29), 9, 0, 0, 0, 0)])
    assert {r[0] for r in team.select("week_start_date").distinct().collect()} == {LAST, BEFORE}


def test_manager_without_team(spark, two_businesses):
    rel, eng = two_businesses
    team, ranked = report(spark, [*rel, relation("n@x", "C", None)], eng)
    row = ranked.where("manager_email = 'n@x'").collect()
    assert len(row) == 1 and row[0]["member_full_name"] == "" and row[0]["suggested_action"] is None
    nested = W.manager_report_nested(team, spark.createDataFrame([*rel, relation("n@x", "C", None)], RELATION))
    assert nested.count() == 3


def test_namesakes_count_once_in_the_summary(spark):
    rel = [relation("m@x", "A", 1, "Same"), relation("m@x", "A", 2, "Same")]
    team, _ = report(spark, rel, [(1, LAST, 1, 0, 0, 0, 0)])
    summary = XP.summary_export(W.team_detail(team)).head()
    assert (summary["total_team_members"], summary["week_number"]) == (1, 3)


@pytest.mark.parametrize("active", [0, 1, 2, 3, 4])
def test_top_three_texts(spark, active):
    rel = [relation("m@x", "A", i, f"N{i}") for i in range(1, 6)]
    team, ranked = report(spark, rel, [(i, LAST, 6 - i if i <= active else 0, 0, 0, 0, 0) for i in range(1, 6)])
    ranked = stored(ranked, "ranked")
    top = XP.top_performers(ranked).head()
    assert top["count_top_performers"] == min(active, 3)
    expected = "".join(f"<li>{s} <strong>N{i} L</strong> — {5 * (6 - i)} pts</li>" for i, s in zip(range(1, min(active, 3) + 1), "🥇🥈🥉"))
    assert top["top_performers_html"] == (expected or "<li>No top performers this week.</li>")
    movers = XP.top_movers(ranked).head()
    assert movers["count_movers"] == min(active, 3)
    assert movers["top_movers_context_note"] == ""


def test_movers_note(spark):
    rel = [relation("m@x", "A", 1)]
    _, ranked = report(spark, rel, [(1, LAST, 1, 0, 0, 0, 0), (1, BEFORE, 1, 0, 0, 0, 0)])
    row = XP.top_movers(ranked).head()
    assert row["top_movers_context_note"].startswith("Your top performers did well")
    actions = XP.action_points(ranked).head()
    assert "Encourage your team to build momentum next week." in actions["action_points_html"]
    assert actions["encourage_label"] is None and actions["week_number"] == 4
    pdf = XP.pdf_blocks(ranked).head()
    assert pdf["top_movers_html"] == "<p>No top movers this week.</p>"
    assert pdf["pdf_summary_html"] == pdf["top_movers_html"] + pdf["suggested_actions_html"]


def test_nested_report_order(spark):
    rel = [relation("m@x", "A", i, f"N{i}") for i in (1, 2, 3)]
    team, _ = report(spark, rel, [(2, LAST, 1, 0, 0, 0, 0)])
    relations = spark.createDataFrame(rel, RELATION)
    row = W.manager_report_nested(team, relations).head()
    assert [m["member_community_id"] for m in row["team_members"]] == [2, 1, 3]
    assert (row["team_size"], row["business_total_members"]) == (2, 5)


# --- relations ----------------------------------------------------------------------------------

MEMBER = "community_member_id bigint, first_name string, last_name string, full_name string, email string, tag_ids array<bigint>, profile_completeness string"


def member(i, tags):
    return (i, f"F{i}", "L", f"F{i} L", f"m{i}@x", tags, "complete")


@pytest.fixture(scope="module")
def world(spark):
    tags = spark.createDataFrame(
        [(1, "Acme  Corp"), (2, "Other"), (100, "Business"), (101, "Manager")], "tag_id bigint, tag_name string"
    ).withColumns(
        {
            "tag_category": F.when(F.col("tag_id") < 100, "potential_business_name").otherwise("business_role"),
            "visible_beside_name": F.lit(True),
            "is_public": F.lit(True),
            "tagged_members_count": F.lit(0).cast("bigint"),
            "created_at": F.lit(dt.datetime(2024, 1, 1)),
            "updated_at": F.lit(dt.datetime(2024, 1, 1)),
            "days_since_created": F.lit(30).cast("bigint"),
        }
    )
    people = [
        member(1, [1, 100, 101]),
        member(2, [1, 100]),
        member(3, [1, 1, 100]),
        member(4, [2, 100]),
        member(5, [2, None]),
        member(6, None),
    ]
    members = spark.createDataFrame(people, MEMBER)
    roster = [
        ("u1", "1", "f1", "l", "M1@x", "", '["Business", "acme corp"]', None, "Yes", "", "2024-01-05"),
        ("u2", "x", "G", None, "g@x", "2024-01-01", '["ACME\t corp"]', None, "no", "Sent", ""),
        ("u3", "9", "H", "h", " ", None, '["Acme Corp"]', None, None, None, None),
    ]
    invited = C.clean_invited_managers(
        spark.createDataFrame(
            roster,
            "uid string, id string, first_name string, last_name string, email string, join_date string, tags string, "
            "profile_url string, member__y_n_ string, invitation_status string, invitation_date string",
        )
    )
    businesses = B.business_names(tags, members)
    return members, tags, invited, businesses


def test_business_names(world):
    got = {r["business_name"]: (r["actual_member_count"], r["business_rank"], r["confidence_level"]) for r in world[3].collect()}
    assert got == {"Acme  Corp": (3, 1, "high"), "Other": (2, 2, "high")}


def test_relationships(world):
    members, tags, invited, businesses = world
    mapping = B.manager_mapping(members, tags, invited, businesses)
    rows = {r["manager_email"]: r for r in mapping.collect()}
    # the roster's copy of the community manager loses against the profile
    assert set(rows) == {"m1@x", "g@x"}
    assert rows["m1@x"]["manager_source"] == "community" and rows["g@x"]["manager_in_community"] is False
    assert {r["team_size"] for r in rows.values()} == {2}
    rel = B.business_relationships(mapping, members, tags)
    got = sorted((r["manager_email"], r["member_community_id"]) for r in rel.collect())
    # member 3 carries the tag twice
    assert got == [(m, i) for m in ("g@x", "m1@x") for i in (2, 3, 3)]
    assert rel.where("relationship_type = 'manager_only'").count() == 0


def test_unmanaged_businesses(world):
    members, tags, invited, businesses = world
    rel = B.business_relationships(B.manager_mapping(members, tags, invited, businesses), members, tags)
    rows = B.businesses_without_managers(businesses, rel, members, tags).collect()
    # member 5 has an unknown tag, so whether they are a manager is unknown and they are left out
    assert [(r["business_name"], r["action_needed"]) for r in rows] == [
        ("Other", "Add Manager tag to at least one member from: m4@x")
    ]


# --- monthly ---------------------------------------------------------------------------------------


def test_monthly_report(spark):
    rel = spark.createDataFrame(
        [relation("m@x", "A", 1, "Bo <b>"), relation("m@x", "A", 2, "Al"), relation("m@x", "A", 3, None, None), relation("n@x", "B", None)],
        RELATION,
    )
    done = [("1", "c1", "Intro & More"), ("2", "c1", "Intro & More"), ("2", "c2", "Plc"), ("9", "c1", "Intro & More")]
    courses = spark.createDataFrame(
        [(i, c, n, dt.datetime(2024, 2, 5)) for i, c, n in done] + [("3", "c1", "Plc", dt.datetime(2024, 1, 31))],
        "initiator_community_id string, course_id string, course_name string, created_at timestamp",
    )
    rows = {r["manager_email"]: r for r in MO.monthly_report(courses, rel).collect()}
    m, n = rows["m@x"], rows["n@x"]
    assert (m["total_distinct_courses"], m["total_course_completions"]) == (2, 3)
    assert (m["team_size"], m["unique_learners_count"], m["zero_completions_members_list"]) == (3, 2, "")
    assert m["report_month_formatted"] == "February 2024"
    html = m["courses_completed_rows_html"]
    assert html.index("Intro &amp; More") < html.index("Plc") and "Al L, Bo &lt;b&gt; L" in html
    assert (n["team_size"], n["zero_completions_members_list"]) == (0, "None 🎉")
    assert "No course completions this month." in n["courses_completed_table_html"]
