"""Steps whose output is far larger than their input: results and the shape of their plans."""

import datetime as dt
import re

from teampulse.operators import joins
from teampulse.plans import engagement as E
from teampulse.plans import relations as B
from teampulse.sources import landing

MONDAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(4)]


def _grid_inputs(spark):
    joined = {1: dt.datetime(2024, 1, 3), 2: dt.datetime(2024, 1, 16), 3: None, 4: dt.datetime(2025, 1, 1)}
    people = spark.createDataFrame(
        [(k, f"{k}@x", "a", "b", at) for k, at in joined.items()],
        "community_member_id bigint, email string, first_name string, last_name string, user_profile_created_at timestamp",
    )
    names = ["classes_attended", "lessons_completed", "likes_received", "comments_received", "comments_made"]
    weekly = {
        name: spark.createDataFrame(
            [(1, MONDAYS[i % 4], i + 1), (2, MONDAYS[0], 7), (9, MONDAYS[1], 5), (None, MONDAYS[3], 3)],
            f"community_member_id bigint, week_start_date date, {name} bigint",
        )
        for i, name in enumerate(names)
    }
    return people, weekly


def test_grid_has_every_week_since_the_member_joined(spark):
    people, weekly = _grid_inputs(spark)
    rows = E.engagement_full(people, weekly).collect()
    got = {(r.community_member_id, r.week_start_date): tuple(r[n] for n in weekly) for r in rows}
    assert len(rows) == len(got)
    assert got == {
        (1, MONDAYS[0]): (1, 0, 0, 0, 5),
        (1, MONDAYS[1]): (0, 2, 0, 0, 0),
        (1, MONDAYS[2]): (0, 0, 3, 0, 0),
        (1, MONDAYS[3]): (0, 0, 0, 4, 0),
        (2, MONDAYS[2]): (0, 0, 0, 0, 0),
        (2, MONDAYS[3]): (0, 0, 0, 0, 0),
    }
    assert all(r.has_activity == (sum(got[r.community_member_id, r.week_start_date]) > 0) for r in rows)


def test_grid_runs_no_lambda_per_week(spark):
    people, weekly = _grid_inputs(spark)
    plan = E.engagement_full(people, weekly)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"\b(filter|transform)\(", plan)


def test_pairs_are_made_in_many_tasks(spark):
    """A hot business and managers without a team; its pairs are not one task's."""
    managers = [(100, f"m{i}@x", True) for i in range(20)] + [(200, "lonely@x", True), (None, "none@x", True)]
    mapping = spark.createDataFrame(managers, "business_tag_id bigint, manager_email string, manager_in_community boolean")
    tags = spark.createDataFrame([(1, "Manager"), (2, "Business"), (100, "Acme")], "tag_id bigint, tag_name string")
    members = spark.createDataFrame(
        [(i, "f", "l", "f l", f"{i}@x", "complete", [2, 100] if i else [1, 2, 100]) for i in range(30)],
        "community_member_id bigint, first_name string, last_name string, full_name string, email string, "
        "profile_completeness string, tag_ids array<bigint>",
    )
    pairs = B.business_relationships(mapping, members, tags)
    rows = pairs.collect()
    found = sorted((r.manager_email, r.member_community_id) for r in rows if r.relationship_type == "has_team")
    assert found == sorted((f"m{i}@x", k) for i in range(20) for k in range(1, 30))
    alone = sorted(r.manager_email for r in rows if r.relationship_type == "manager_only")
    assert alone == ["lonely@x", "none@x"] and len(rows) == 20 * 29 + 2
    tasks = pairs.where("relationship_type = 'has_team'").rdd.glom().map(len).filter(bool).count()
    assert tasks > 4


def test_pairs_of_a_member_lie_together(spark):
    """written pairs repeat a member's values in runs, not his managers' in turn."""
    managers = spark.createDataFrame([(7, f"m{i}@x") for i in range(320)], "k bigint, mail string")
    rows = spark.createDataFrame([(7, i) for i in range(50)], "k bigint, id bigint")
    parts = joins.spread(managers, rows, ["k"]).select("id", "mail").rdd.glom().collect()
    assert sorted((r.id, r.mail) for p in parts for r in p) == sorted((i, f"m{k}@x") for i in range(50) for k in range(320))
    runs = sum(1 for p in parts for a, b in zip([None, *p], p) if a is None or a.id != b.id)
    assert runs <= 50 * 16


def test_landed_batches_are_not_sorted(spark, tmp_path):
    """Both kinds are written side by side, in the order of the lines."""
    rows = [(i, "rejected" if i % 3 else "rows") for i in range(90)]
    batch = spark.newSession().createDataFrame(rows, "id bigint, kind string").coalesce(1)
    landing.write_batch(batch, 7, str(tmp_path / "raw"))
    back = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted((r.id, r.kind) for r in back.collect()) == sorted(rows)
    assert {r.batch for r in back.collect()} == {7}
    assert batch.sparkSession.conf.get(landing.OPEN_FILES) == "2"
