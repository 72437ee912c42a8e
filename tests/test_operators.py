"""Operators against brute force on small frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from teampulse.operators import dedup, grid, joins, ordered, quality, ranking, weeks
from teampulse.plans import engagement as E
from teampulse.plans import metrics as M
from teampulse.sources import delivery, scans, tables
from teampulse.session import scratch_path

WEEK0 = dt.date(2024, 1, 1)


def week(n):
    return WEEK0 + dt.timedelta(weeks=n)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- ranking -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, many of them with equal points; one group has no name."""
    rnd = random.Random(5)
    data = [("big", rnd.choice([0, 0, 0, 1, 2, 7]), f"n{rnd.randrange(40)}", i) for i in range(3000)]
    data += [(None, rnd.randrange(3), f"n{i}", i) for i in range(700)]
    data += [(f"g{i % 20}", rnd.randrange(5), f"n{i}", i) for i in range(300)]
    return data, spark.createDataFrame(data, "g string, points bigint, name string, id bigint").repartition(6)


def test_rank_is_row_number(skewed):
    data, df = skewed
    keys = [-F.col("points"), F.col("name"), F.col("id")]
    got = ranking.rank_rows(df, ["g"], keys, "r")
    expected = {}
    for g in {d[0] for d in data}:
        for i, d in enumerate(sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2], d[3])), 1):
            expected[(d[0], d[3])] = i
    assert {(r["g"], r["id"]): r["r"] for r in got.collect()} == expected


def test_rank_has_no_window_over_groups(skewed):
    _, df = skewed
    plan = ranking.rank_rows(df, ["g"], [F.col("id")], "r")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number()" not in plan and "windowspecdefinition(g" not in plan


def test_large_group_is_spread(skewed):
    _, df = skewed
    rows = df.repartitionByRange(4, "g", F.col("points"), "id").withColumn("p", F.spark_partition_id())
    assert rows.where("g = 'big'").select("p").distinct().count() > 1


def test_percent_rank(skewed):
    data, df = skewed
    got = ranking.percent_rank_rows(df, ["g"], "points", "p").collect()
    assert len(got) == len(data)
    sizes, less = {}, {}
    for d in data:
        sizes[d[0]] = sizes.get(d[0], 0) + 1
    for r in got:
        key = (r["g"], r["points"])
        if key not in less:
            less[key] = sum(d[0] == r["g"] and d[1] < r["points"] for d in data)
        assert r["p"] == pytest.approx(less[key] / max(sizes[r["g"]] - 1, 1))


def test_global_rank(skewed):
    data, df = skewed
    keys = [-F.col("points"), F.col("name"), F.col("id"), F.coalesce("g", F.lit(""))]
    got = ranking.global_rank(df, keys, "r")
    assert [r["r"] for r in got.orderBy("r").collect()] == list(range(1, len(data) + 1))


def test_rank_of_equal_and_no_rows(spark):
    df = spark.createDataFrame([("m", 1)] * 50 + [(None, 1)] * 3, "g string, p int").repartition(5)
    got = rows_of(ranking.rank_rows(df, ["g"], [F.col("p")], "r").where("g is not null").select("r"))
    assert got == [(i,) for i in range(1, 51)]
    assert ranking.rank_rows(df.where("p > 1"), ["g"], [F.col("p")], "r").count() == 0


def test_ranks_with_ties(spark):
    df = spark.createDataFrame([("m", 10, "b", 1), ("m", 10, "a", 2), ("m", 0, "c", 3)], "g string, p bigint, n string, id int")
    ranked = ranking.rank_rows(df, ["g"], [-F.col("p"), F.col("n")], "r")
    got = ranking.percent_rank_rows(ranked, ["g"], "p", "pct")
    assert {r["n"]: (r["r"], r["pct"]) for r in got.collect()} == {"a": (1, 0.5), "b": (2, 0.5), "c": (3, 0.0)}


# --- ordered lists ---------------------------------------------------------------------


def test_text_per_group(skewed):
    data, df = skewed
    value = F.when(F.col("points") != 1, F.col("name"))
    got = ordered.text_per_group(df, ["g"], [F.col("name"), F.col("id")], value, ", ", "t")
    got = {r["g"]: r["t"] for r in got.collect()}
    for g in {d[0] for d in data}:
        names = [d[2] for d in sorted((d for d in data if d[0] == g), key=lambda d: (d[2], d[3])) if d[1] != 1]
        assert got[g] == ", ".join(names)


def test_list_per_group(skewed):
    data, df = skewed
    got = {r["g"]: r["v"] for r in ordered.list_per_group(df, ["g"], [F.col("id")], F.col("name"), "v").collect()}
    assert got["big"] == [d[2] for d in data if d[0] == "big"]
    assert len(got[None]) == 700


def test_sorted_text_skips_null(spark):
    df = spark.createDataFrame([("x", "b"), ("x", None), ("x", "a"), ("y", None)], "g string, v string")
    got = df.groupBy("g").agg(ordered.sorted_text([F.col("v")], F.col("v"), ", ").alias("t"))
    assert rows_of(got.where("t is not null")) == [("x", "a, b")] and got.count() == 2


# --- dedup, joins ------------------------------------------------------------------------


def test_dedup(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 5, "c"), (None, 1, "d"), (None, 2, "e")], "id int, at int, v string")
    assert rows_of(dedup.keep_latest(df, ["id"], "at").select("v")) == [("b",), ("c",), ("e",)]
    assert rows_of(dedup.keep_earliest(df, ["id"], "at").select("v")) == [("a",), ("c",), ("d",)]
    plan = dedup.keep_latest(df, ["id"], "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "copies must be cut before the shuffle"


def test_left_keep_all(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, r string")
    got = {(r["l"], r["r"]) for r in joins.left_keep_all(left, right, ["k"]).collect()}
    assert got == {("a", "x"), ("a", "y"), ("b", None), ("c", None)}


def test_array_joins(spark):
    left = spark.createDataFrame([("m", [1, 1, 2])], "n string, ids array<int>")
    right = spark.createDataFrame([(1, "one")], "k int, w string")
    assert joins.on_array_member(left, "ids", right, "k").count() == 1


# --- weeks and grid ----------------------------------------------------------------------


def weekly_frame(spark, name, data):
    return spark.createDataFrame(data, f"community_member_id bigint, week_start_date date, {name} bigint")


@pytest.fixture
def weekly(spark):
    return {
        "classes_attended": weekly_frame(spark, "classes_attended", [(1, week(0), 2)]),
        "lessons_completed": weekly_frame(spark, "lessons_completed", [(1, week(0), 1), (2, week(2), 4)]),
        "likes_received": weekly_frame(spark, "likes_received", []),
        "comments_received": weekly_frame(spark, "comments_received", [(9, week(4), 4)]),
        "comments_made": weekly_frame(spark, "comments_made", [(2, week(0), 3)]),
    }


def members_frame(spark, joined):
    data = [(i, f"{i}@x", "F", "L", at) for i, at in joined.items()]
    return spark.createDataFrame(
        data, "community_member_id bigint, email string, first_name string, last_name string, user_profile_created_at timestamp"
    )


def at(d):
    return dt.datetime.combine(d, dt.time(12))


def test_grid_equals_star_join(spark, weekly):
    people = members_frame(spark, {1: at(week(0)), 2: at(week(1)), 3: None})
    full = E.engagement_full(people, weekly)
    got = {(r[0], r["week_start_date"]): (r["classes_attended"], r["lessons_completed"], r["comments_made"]) for r in full.collect()}
    # activity weeks are 0, 2 and 4; member 2 joined in week 1, member 3 has no date
    assert got == {
        (1, week(0)): (2, 1, 0),
        (1, week(2)): (0, 0, 0),
        (1, week(4)): (0, 0, 0),
        (2, week(2)): (0, 4, 0),
        (2, week(4)): (0, 0, 0),
    }
    base = full.select("community_member_id", "week_start_date")
    again = grid.star_join(base, weekly).select("community_member_id", "week_start_date", *weekly)
    assert rows_of(again) == rows_of(full.select("community_member_id", "week_start_date", *weekly))


def test_calendar_spine_has_no_gaps(spark, weekly):
    people = members_frame(spark, {1: at(week(0)), 2: at(week(1))})
    full = E.engagement_full(people, weekly, "calendar", week(5))
    assert full.count() == 6 + 5
    assert quality.week_gaps(full).count() == 0
    activity = E.engagement_full(people, weekly)
    assert quality.week_gaps(activity).count() > 0


def test_new_and_known_members(spark, weekly):
    newest = week(20)
    people = members_frame(spark, {1: at(week(0)), 2: at(week(10)), 3: at(week(18))})
    target = weekly_frame(spark, "x", [(1, newest, 0), (3, newest, 0)])
    ready = E.backfill_grid(people, target, newest, newest)
    got = {r["community_member_id"]: (len(r["__weeks"]), r["is_backfill"]) for r in ready.collect()}
    assert got == {1: (5, False), 2: (11, True), 3: (3, True)}


def test_incremental_equals_full(spark):
    """Batches with lateness inside the lookback end at the full build; older lateness does not."""
    rnd = random.Random(3)
    events = [(i, rnd.randrange(6), at(WEEK0 + dt.timedelta(days=rnd.randrange(70)))) for i in range(400)]
    schema = "item bigint, m bigint, at timestamp"
    people = members_frame(spark, {i: at(week(i % 4)) for i in range(6)})

    def tables_of(data):
        df = spark.createDataFrame(data, schema)
        return {
            n: M.weekly_count(df.where(F.col("item") % 5 == i), "m", "item", "at", n)
            for i, n in enumerate(["classes_attended", "lessons_completed", "likes_received", "comments_received", "comments_made"])
        }

    path, keys = scratch_path(spark, "eng"), ["community_member_id", "week_start_date"]
    first = [e for e in events if e[2] < at(week(6)) and e[0] % 7]
    known = people.where("community_member_id < 4")
    tables.upsert(spark, path, E.engagement_full(known, tables_of(first), "calendar", week(5)), keys, keys[1], keys)
    # some events of weeks 3 to 5 arrive late, members 4 and 5 are new
    late = [e for e in events if e[2] >= at(week(2)) or e in first]
    target = tables.read_table(spark, path)
    changes = E.engagement_changes(people, tables_of(late), target, week(5), week(9))
    done = tables.upsert(spark, path, changes, keys, keys[1], keys).drop("month", "is_backfill")
    full = E.engagement_full(people, tables_of(late), "calendar", week(9)).drop("is_backfill")
    assert rows_of(done.select(full.columns)) == rows_of(full)


def test_previous_week(spark):
    df = spark.createDataFrame([("a", week(0), 1), ("a", week(1), 2), ("a", week(3), 5)], "k string, week_start_date date, n bigint")
    got = weeks.with_previous_week(df, ["k"], {"n": "before"})
    assert {r["week_start_date"]: r["before"] for r in got.collect()} == {week(0): 0, week(1): 1, week(3): 0}


def test_late_events(spark):
    df = spark.createDataFrame([(1, 10, at(week(8))), (1, 11, at(week(4)))], "m bigint, i bigint, t timestamp")
    fresh = M.weekly_count(df, "m", "i", "t", "n", since=week(10) - dt.timedelta(weeks=4))
    assert rows_of(fresh) == [(1, week(8), 1)]


# --- tables ---------------------------------------------------------------------------------


def keyed(spark, data):
    return spark.createDataFrame(data, "k string, at timestamp, v int")


def test_upsert(spark):
    path = scratch_path(spark, "t")
    jan, feb, mar = (dt.datetime(2024, m, 5) for m in (1, 2, 3))
    tables.upsert(spark, path, keyed(spark, [("a", jan, 1), ("b", feb, 1), (None, jan, 1)]), ["k"], "at")
    batch = keyed(spark, [("a", mar, 2), ("c", feb, 2), (None, jan, 2)])
    for _ in range(2):  # the same batch again changes nothing
        done = tables.upsert(spark, path, batch, ["k"], "at")
        got = {r["k"]: (r["at"], r["v"]) for r in done.collect()}
        assert done.count() == 4
        assert got == {"a": (mar, 2), "b": (feb, 1), "c": (feb, 2), None: (jan, 2)}


def test_upsert_empties_a_month(spark):
    path = scratch_path(spark, "t")
    jan, mar = dt.datetime(2024, 1, 5), dt.datetime(2024, 3, 5)
    tables.upsert(spark, path, keyed(spark, [("a", jan, 1)]), ["k"], "at")
    done = tables.upsert(spark, path, keyed(spark, [("a", mar, 2)]), ["k"], "at")
    assert [(r["k"], r["v"]) for r in done.collect()] == [("a", 2)]


def test_first_completion_survives(spark):
    jan, mar, may = (dt.datetime(2024, m, 5) for m in (1, 3, 5))
    for resolve, kept in (([F.col("at").asc()], jan), (None, may)):
        path = scratch_path(spark, "t")
        first = dedup.keep_earliest(keyed(spark, [("a", jan, 1), ("a", mar, 2)]), ["k"], "at")
        tables.upsert(spark, path, first, ["k"], "at", resolve=resolve)
        done = tables.upsert(spark, path, keyed(spark, [("a", may, 3)]), ["k"], "at", resolve=resolve)
        assert [r["at"] for r in done.collect()] == [kept]


def test_upsert_only_rewrites_touched_months(spark):
    path = scratch_path(spark, "t")
    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    before = set(tables.upsert(spark, path, keyed(spark, [("a", jan, 1), ("b", feb, 1)]), ["k"], "at").inputFiles())
    after = set(tables.upsert(spark, path, keyed(spark, [("b", feb, 2)]), ["k"], "at").inputFiles())
    assert {f for f in before if "2024-01" in f} == {f for f in after if "2024-01" in f}
    assert not {f for f in before & after if "2024-02" in f}


def test_schema_sync(spark):
    path, jan = scratch_path(spark, "t"), dt.datetime(2024, 1, 5)
    tables.upsert(spark, path, keyed(spark, [("a", jan, 1)]), ["k"], "at")
    new = spark.createDataFrame([("b", jan, "w")], "k string, at timestamp, w string")
    done = tables.upsert(spark, path, new, ["k"], "at")
    assert {(r["k"], r["w"]) for r in done.collect()} == {("a", None), ("b", "w")}
    assert "v" not in done.columns


def test_delivery_log(spark):
    path = scratch_path(spark, "log")
    sent = spark.createDataFrame([("m@x", dt.datetime(2024, 1, 5))], "manager_email string, sent_at timestamp")
    delivery.append_log(sent, path)
    log = delivery.append_log(sent, path)
    assert log.select("delivery_id").distinct().count() == 2
    assert delivery.empty_log(spark).count() == 0


def test_month_slices():
    slices = scans.month_slices(dt.datetime(2024, 1, 31), dt.datetime(2024, 4, 10))
    assert slices[0] == (dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 29))
    assert slices[-1][1] == dt.datetime(2024, 4, 10)
    assert all(a[1] == b[0] for a, b in zip(slices, slices[1:]))


# --- checks -----------------------------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    assert {tuple(r) for r in quality.missing_values(df, ["k", "v"]).collect()} == {("k", 0), ("v", 1)}
    assert rows_of(quality.repeated_keys(df, ["k"])) == [("a", 2)]
    assert rows_of(quality.unaccepted_values(df, "k", ["a"])) == [("b", 1)]
    assert quality.row_count_difference(df, df).head()["within_tolerance"]
    assert not quality.row_count_difference(df, df.limit(2)).head()["within_tolerance"]
    assert not quality.did_not_shrink(df, df.limit(2)).head()["passed"]
