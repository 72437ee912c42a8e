"""The weekly and monthly runs from raw tables, in one go and in steps."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from teampulse.catalog import fixtures as X
from teampulse.plans import pipeline as P
from teampulse.plans import reports as W
from teampulse.session import scratch_path
from teampulse.sources.schemas import EXTRACTED_AT
from teampulse.streaming import weekly as ST
from teampulse.sources import tables

SF = "/root/testdata/sf0.001"
SLICED = ["post_comment_created", "post_liked", "post_comment_liked", "course_lesson_completed", "course_completed", "event_attendees"]


def rows(df, drop=()):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted(map(str, df.select(cols).collect()))


@pytest.fixture(scope="module")
def runs(spark):
    raw = X.raw_tables(spark, SF)
    stepwise, at_once = scratch_path(spark, "steps"), scratch_path(spark, "once")
    cut = dt.datetime(2024, 1, 20)
    early = {k: v.where(F.col(EXTRACTED_AT) < F.lit(cut)) if k in SLICED else v for k, v in raw.items()}
    early["community_members"] = early["community_members"].where("community_member_id % 4 > 0")
    first = P.run_weekly(spark, stepwise, early, cut.date(), spine="calendar")
    before = first["engagement"].count()
    second = P.run_weekly(spark, stepwise, raw, X.AS_OF)
    full = P.run_weekly(spark, at_once, raw, X.AS_OF, spine="calendar")
    return stepwise, before, second, full


def test_incremental_run_ends_at_the_full_build(runs):
    _, before, second, full = runs
    assert before < second["engagement"].count()
    drop = ["is_backfill", P.UPDATED]
    assert rows(second["engagement"], drop) == rows(full["engagement"], drop)
    assert second["engagement"].where("is_backfill").count() > 0
    for name in ("courses", "rankings", "detail"):
        assert rows(second[name]) == rows(full[name]), name


def test_repeated_run_changes_nothing(spark, runs):
    root, _, second, _ = runs
    kept = {n: rows(second[n], ["is_backfill"]) for n in ("engagement", "rankings")}
    again = P.run_weekly(spark, root, X.raw_tables(spark, SF), X.AS_OF)
    for name, expected in kept.items():
        assert rows(again[name], ["is_backfill"]) == expected


def test_exports_have_one_row_per_manager_and_business(runs):
    full = runs[3]
    managers = full["rankings"].select("manager_email", "business_name").distinct().count()
    for name in ("manager_list", "top_performers", "top_movers", "action_points", "pdf_blocks", "summary", "nested"):
        assert full[name].count() >= managers, name
    assert full["top3"].groupBy("manager_email").count().agg(F.max("count")).head()[0] <= 3


def test_monthly_run(spark, runs):
    store, raw = P.Store(spark, runs[0]), X.raw_tables(spark, SF)
    first = P.run_monthly(store, raw, X.AS_OF)
    counts, report = rows(first["monthly_courses"]), first["monthly_report"]
    assert report.count() == report.select("manager_email", "business_name").distinct().count()
    assert first["findings"].where("passed").count() == first["findings"].count() == 2
    assert rows(P.run_monthly(store, raw, X.AS_OF)["monthly_courses"]) == counts


def test_monthly_run_takes_in_late_completions(spark):
    """Completions that arrive after the weekly run are in the month's report."""
    raw, root = X.raw_tables(spark, SF), scratch_path(spark, "late")
    cut = raw["course_completed"].agg(F.percentile_approx(EXTRACTED_AT, 0.5)).head()[0]
    early = raw | {"course_completed": raw["course_completed"].where(F.col(EXTRACTED_AT) <= F.lit(cut))}
    P.run_weekly(spark, root, early, X.AS_OF)
    late = P.run_monthly(P.Store(spark, root), raw, X.AS_OF)
    whole = P.run_monthly(P.Store(spark, scratch_path(spark, "whole")), raw, X.AS_OF)
    assert rows(late["monthly_report"]) == rows(whole["monthly_report"])


def test_run_times_findings_and_scratch(spark, runs):
    root, _, _, full = runs
    store = P.Store(spark, root)  # later tests run into the same root
    assert store.read(P.INTERMEDIATE, "engagement").agg(F.max(P.UPDATED)).head()[0].date() == X.AS_OF
    assert full["rankings"].select(P.REPORTED).distinct().count() == 1
    found = {(r["check_name"], r["table_name"], r["column_name"]): r for r in store.read(P.MARTS, "weekly_findings").collect()}
    assert found["no_shrink", "engagement", "week_start_date"]["passed"] and found["unique", "engagement", "community_member_id, week_start_date"]["passed"]
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    assert not [n for n in names if n.startswith("_run-")]


def test_stream_restarts_where_it_stopped(spark):
    """Two runs of one stream over files landed in between equal one batch."""
    landed, path, state = (scratch_path(spark, n) for n in ("landed", "table", "state"))
    events = X.activity(spark, SF).select("user_id", "ts", "event_id")
    stream = lambda: spark.readStream.schema(events.schema).parquet(landed)
    for part in (events.where("event_id < 400"), events.where("event_id >= 300")):
        part.write.mode("append").parquet(landed)
        ST.run_to_end(ST.upsert_writer(stream(), path, ["user_id"], "ts", "ts", state, ties=["event_id"]))
    best = events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("b")).select("user_id", "b.*")
    assert rows(tables.read_table(spark, path), ["month"]) == rows(best)


def test_stream_drops_repeated_records(spark):
    landed, out, state = (scratch_path(spark, n) for n in ("landed", "out", "state"))
    events = X.activity(spark, SF).select("event_id", "ts")
    events.unionByName(events).write.parquet(landed)
    stream = ST.deduplicated(spark.readStream.schema(events.schema).parquet(landed), "event_id", "ts")
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    ST.run_to_end(writer.trigger(availableNow=True))
    assert spark.read.schema(events.schema).parquet(out).count() == events.count()


def test_reports_read_only_their_months(spark, runs):
    """The team report prunes the month folders of the engagement history."""
    store = P.Store(spark, runs[0])
    relations = spark.read.parquet(store.path(P.MARTS, "relationships"))
    team = W.team_engagement(relations, store.read(P.INTERMEDIATE, "engagement"), X.AS_OF)
    plan = team._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*month.*scalar-subquery", plan) or re.search(
        r"PartitionFilters: \[.*month.*Subquery", plan
    )
    assert rows(team.where(F.col("week_start_date") == F.lit(dt.date(2024, 1, 22)))) == rows(
        runs[3]["team"], ["month"]
    )
