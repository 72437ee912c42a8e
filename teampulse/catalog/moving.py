"""Sources, sinks, incremental runs, streams and data checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from teampulse.catalog import fixtures as X
from teampulse.catalog import models as MD
from teampulse.catalog.base import MEMBER, WEEK, Base, query
from teampulse.operators import incremental as I
from teampulse.operators import quality as Q
from teampulse.operators.grid import weeks_from_calendar
from teampulse.plans import checks as CH
from teampulse.plans import engagement as E
from teampulse.plans import exports as XP
from teampulse.plans import metrics as M
from teampulse.plans import pipeline as P
from teampulse.plans import staging as C
from teampulse.sources import delivery, landing, scans, tables
from teampulse.sources import schemas as S
from teampulse.streaming import weekly as ST

CUT = dt.date(2024, 1, 15)  # Monday up to which a first run has seen the events


# --- sources -------------------------------------------------------------------------


@query(
    "src_event_envelope",
    """
    SELECT 'e' || event_id AS id, CAST(user_id AS VARCHAR) AS initiator_id, CAST(k AS VARCHAR) AS lesson_id, ts AS created_at
    FROM fx_activity WHERE event_type = 'click'""",
)
def _(b: Base):
    """Envelopes landed as JSON lines, read with the declared schema."""
    path = b.path("landed")
    rows = X.envelopes(b.spark, b.sf_dir, with_copies=False)
    rows.withColumn("payload", F.from_json("payload", S.PAYLOAD)).write.json(path)
    feed = scans.read_feed(b.spark, path, "course_lesson_completed")
    return feed.select(
        "id",
        F.col("payload.initiator.id").alias("initiator_id"),
        F.col("payload.lesson.id").alias("lesson_id"),
        F.col("created_at").try_cast("timestamp").alias("created_at"),
    )


@query(
    "src_records",
    """
    SELECT page_id AS id, url, html AS body, 'Space ' || (page_id % 4) AS space_name, CASE WHEN page_id % 5 > 0 THEN page_id % 5 END AS topics
    FROM pages""",
)
def _(b: Base):
    path = b.path("landed")
    b.raw("events_list").write.json(path)
    rows = scans.read_records(b.spark, path, "events_list")
    return rows.select(
        "id", "url", "body", F.col("space.name").alias("space_name"), F.array_size("topics").cast("bigint").alias("topics")
    )


_ROOTS: dict[Base, str] = {}


def _landed(b: Base) -> str:
    """Root with the envelopes taken in from two deliveries, all kinds in the lessons' folder, in two runs of one stream."""
    if b not in _ROOTS:
        folder, root = b.path("landed"), b.path("root")
        rows = X.envelopes(b.spark, b.sf_dir, with_copies=False)
        first = F.col(S.EXTRACTED_AT) < F.lit(dt.datetime.combine(CUT, dt.time()))
        for delivery, part in (("1", first), ("2", ~first)):
            rows.where(part).write.json(f"{folder}/course_lesson_completed/{delivery}")
            ST.run_to_end(landing.feed_writer(b.spark, folder, root, "course_lesson_completed", files_per_batch=3))
        _ROOTS[b] = root
    return _ROOTS[b]


@query(
    "src_landed_feed",
    """
    SELECT 'e' || event_id AS id, CAST(user_id AS VARCHAR) AS initiator_id, CAST(k AS VARCHAR) AS lesson_id, ts AS created_at
    FROM fx_activity WHERE event_type = 'click'""",
)
def _(b: Base):
    """A feed's raw table, filled from landed files by a stream that was started twice."""
    feed = landing.landed_rows(b.spark, _landed(b), "course_lesson_completed")
    return feed.select(
        "id",
        F.col("payload.initiator.id").alias("initiator_id"),
        F.col("payload.lesson.id").alias("lesson_id"),
        F.col("created_at").try_cast("timestamp").alias("created_at"),
    )


@query(
    "src_landed_rejected",
    """
    SELECT 'course_lesson_completed' AS source_table, 'another feed' AS reason, 'e' || event_id AS id
    FROM fx_activity WHERE event_type NOT IN ('click', 'view')""",
)
def _(b: Base):
    """Landed lines that belong to another feed, with the id from their text."""
    rows = landing.rejected_rows(b.spark, _landed(b))
    return rows.select("source_table", "reason", F.get_json_object("line", "$.id").alias("id"))


@query("src_csv_roster", "SELECT 'u' || s AS uid, email, business FROM fx_invited")
def _(b: Base):
    """The roster as a CSV file, loaded over an older copy and cleaned."""
    path, table = b.path("roster_csv"), b.path("roster")
    b.raw("managers_not_joined").write.option("header", True).option("escape", '"').csv(path)
    scans.replace_roster(b.spark, path, table)
    rows = C.clean_invited_managers(scans.replace_roster(b.spark, path, table))
    return rows.select("uid", F.col("manager_email").alias("email"), F.col("business_name_from_tags").alias("business"))


@query(
    "src_explode_records",
    "SELECT event_id AS id, user_id AS community_member_id, 'class ' || k AS event_name FROM fx_activity WHERE event_type = 'view'",
)
def _(b: Base):
    """Response pages of up to 100 records, taken apart again."""
    rows = b.raw("event_attendees").select("id", "community_member_id", "event_name")
    page = F.floor(F.col("id") / 100).alias("page")
    pages = rows.groupBy(page).agg(
        F.to_json(F.struct(F.collect_list(F.struct("id", "community_member_id", "event_name")).alias("records"))).alias("body")
    )
    return scans.records_of_page(pages, "body", "records", "struct<id:bigint,community_member_id:bigint,event_name:string>")


@query(
    "src_time_slice",
    """
    SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-15 00:00:00' AND o_orderdate <= TIMESTAMP '1996-02-15 00:00:00'""",
)
def _(b: Base):
    """One monthly cursor slice of a table kept in month folders."""
    rows = b.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    landed = tables.replace_table(rows, b.path("orders"), "o_orderdate", ["o_orderkey"])
    low, high = scans.month_slices(dt.datetime(1996, 1, 15), dt.datetime(1996, 6, 1))[0]
    return scans.time_slice(landed, "o_orderdate", low, high, "month").select("o_orderkey")


# --- sinks ------------------------------------------------------------------------------


@query("sink_table", "SELECT * FROM customer")
def _(b: Base):
    path = b.path("customer")
    tables.replace_flat(b.table("customer").where("c_acctbal < 0"), path)
    return tables.replace_flat(b.table("customer"), path)


@query(
    "sink_partitioned",
    "SELECT o_orderkey, o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
)
def _(b: Base):
    rows = b.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return tables.replace_table(rows, b.path("orders"), "o_orderdate", ["o_custkey"]).select("o_orderkey", "o_custkey", "month")


def _orders(b: Base):
    return b.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))


@query(
    "upsert_merge",
    """
    SELECT o_orderkey, o_custkey + CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 1000000 ELSE 0 END AS o_custkey,
           CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END AS o_orderdate
    FROM orders""",
)
def _(b: Base):
    """First load up to 1997, then a batch that changes, moves and adds orders."""
    path, rows = b.path("orders"), _orders(b)
    late = F.col("o_orderdate") >= F.lit(dt.datetime(1997, 1, 1))
    tables.upsert(b.spark, path, rows.where(F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1))), ["o_orderkey"], "o_orderdate")
    batch = rows.where(late).withColumns(
        {"o_custkey": F.col("o_custkey") + 1000000, "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")}
    )
    return tables.upsert(b.spark, path, batch, ["o_orderkey"], "o_orderdate").drop("month")


@query(
    "upsert_schema_sync",
    """
    SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_custkey END AS o_custkey FROM orders""",
)
def _(b: Base):
    """The second batch drops one column and brings another; in the third the dropped one is back, empty in older rows."""
    path, rows = b.path("orders"), b.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    first, second = (F.lit(dt.datetime(y, 1, 1)) for y in (1997, 1998))
    at, key = F.col("o_orderdate"), ["o_orderkey"]
    tables.upsert(b.spark, path, rows.where(at < first).select("o_orderkey", "o_custkey", "o_orderdate"), key, "o_orderdate")
    batch = rows.where((at >= first) & (at < second)).select("o_orderkey", "o_orderdate", "o_orderpriority")
    tables.upsert(b.spark, path, batch, key, "o_orderdate")
    batch = rows.where(at >= second).select("o_orderkey", "o_orderdate", "o_orderpriority", "o_custkey")
    return tables.upsert(b.spark, path, batch, key, "o_orderdate").drop("month")


@query(
    "upsert_lookback",
    """
    SELECT 'e' || event_id AS record_id, user_id AS initiator, ts AS created_at FROM events WHERE event_type = 'click'""",
)
def _(b: Base):
    """Two extractions of a feed; the second re-reads one day and repeats some records."""
    path, raw = b.path("lessons"), b.feed("course_lesson_completed")
    first = C.clean_lessons(raw.where(F.col(S.EXTRACTED_AT) < F.lit(dt.datetime(2024, 1, 20))))
    target = tables.upsert(b.spark, path, first, ["record_id"], "created_at", ["record_id"])
    fresh = C.clean_lessons(I.newly_extracted(raw, I.extraction_mark(target)))
    done = tables.upsert(b.spark, path, fresh, ["record_id"], "created_at", ["record_id"])
    return done.select("record_id", F.col("initiator_community_id").alias("initiator"), "created_at")


@query(
    "upsert_keep_first",
    "SELECT member, course_id, created_at FROM fx_first_course",
)
def _(b: Base):
    """Course completions in two batches: a later repetition does not replace the first completion."""
    path, raw = b.path("courses"), b.raw("course_completed")
    mark = F.lit(dt.datetime(1998, 1, 1))
    order = [F.col("created_at").asc(), F.col("record_id").asc()]
    keys = ["initiator_email", "course_id"]
    tables.upsert(b.spark, path, C.clean_courses(raw.where(F.col(S.EXTRACTED_AT) < mark)), keys, "created_at", keys, order)
    batch = C.clean_courses(raw.where(F.col(S.EXTRACTED_AT) >= mark))
    done = tables.upsert(b.spark, path, batch, keys, "created_at", keys, order)
    return done.select(F.col("initiator_community_id").cast("bigint").alias("member"), "course_id", "created_at")


@query(
    "sink_log_append",
    """
    SELECT email AS manager_email, 'weekly' AS report_type, 'sent' AS delivery_status, CAST(2 AS BIGINT) AS deliveries
    FROM fx_invited""",
)
def _(b: Base):
    """Two runs append; every row gets its own id."""
    path = b.path("log")
    sent = b.invited.select(
        "manager_email",
        F.lit("weekly").alias("report_type"),
        F.lit("sent").alias("delivery_status"),
        F.lit(dt.datetime(2024, 1, 31, 8)).alias("sent_at"),
    )
    delivery.append_log(sent, path)
    log = delivery.append_log(sent, path)
    return log.groupBy("manager_email", "report_type", "delivery_status").agg(
        F.countDistinct("delivery_id").alias("deliveries")
    )


# --- incremental ----------------------------------------------------------------------------


@query(
    "inc_extract_lookback",
    """
    SELECT 'r' || event_id || '-' || copy AS raw_id FROM (
        SELECT event_id, 0 AS copy, ts + INTERVAL 1 HOUR AS arrived FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, 1, ts + INTERVAL 25 HOUR FROM events WHERE event_type = 'click' AND event_id % 10 = 0)
    WHERE arrived >= (SELECT MAX(ts) + INTERVAL 1 HOUR - INTERVAL 1 DAY FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-20')""",
)
def _(b: Base):
    raw = b.feed("course_lesson_completed")
    seen = raw.where((F.col("version") == "v0") & (F.col("created_at") < "2024-01-20"))
    newest = seen.agg(F.max(S.EXTRACTED_AT).alias("m")).scalar()
    return I.newly_extracted(raw, newest).select(F.col(S.RAW_ID).alias("raw_id"))


@query(
    "inc_weekly_lookback",
    "SELECT m AS community_member_id, wk AS week_start_date, n AS lessons_completed FROM fx_weekly WHERE metric = 'lessons_completed'",
)
def _(b: Base):
    """Counts up to the cut, then the recent weeks counted again and merged."""
    path, lessons = b.path("weekly"), b.feeds["lessons"]
    early = M.lessons(lessons.where(F.col("created_at") < F.lit(dt.datetime(2024, 1, 17))))
    target = tables.upsert(b.spark, path, early, P.WEEKLY_KEYS, WEEK, P.WEEKLY_KEYS)
    fresh = M.lessons(lessons, I.weeks_since(target))
    return tables.upsert(b.spark, path, fresh, P.WEEKLY_KEYS, WEEK, P.WEEKLY_KEYS).drop("month")


@query(
    "inc_monthly_lookback",
    """
    SELECT member AS community_member_id, CAST(date_trunc('month', created_at) AS DATE) AS month_start_date, COUNT(DISTINCT course_id) AS courses
    FROM fx_first_course GROUP BY 1, 2""",
)
def _(b: Base):
    path, keys = b.path("monthly"), [MEMBER, M.MONTH]
    early = M.monthly_courses(b.courses.where(F.col("created_at") < F.lit(dt.datetime(1997, 3, 10))))
    target = tables.upsert(b.spark, path, early, keys, M.MONTH, keys)
    fresh = M.monthly_courses(b.courses, I.months_since(target))
    done = tables.upsert(b.spark, path, fresh, keys, M.MONTH, keys)
    return done.select(MEMBER, M.MONTH, F.col("courses_completed_count").alias("courses"))


NEW_SQL = """
    SELECT p.community_member_id, (p.community_member_id NOT IN (SELECT user_id FROM events)
           OR p.joined_at >= TIMESTAMP '2024-01-22') AS is_backfill,
           CAST(date_trunc('week', p.joined_at) AS DATE) AS joined FROM fx_member p"""


def large_weekly(b: Base) -> dict:
    """Five weekly metrics per customer from years of orders."""
    o = b.table("orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    status = F.col("o_orderstatus")
    return {
        "classes_attended": M.weekly_count(o, "o_custkey", "o_orderpriority", "at", "classes_attended"),
        "lessons_completed": M.weekly_count(o.where(status == "O"), "o_custkey", "o_orderkey", "at", "lessons_completed"),
        "likes_received": M.weekly_count(o.where(status == "F"), "o_custkey", "o_orderkey", "at", "likes_received"),
        "comments_received": M.weekly_count(o.where(status == "P"), "o_custkey", "o_orderkey", "at", "comments_received"),
        "comments_made": M.weekly_count(o, "o_custkey", "o_orderkey", "at", "comments_made"),
    }


def large_members(b: Base):
    """Customers as members who joined in the first 28 days of the orders."""
    first = b.table("orders").agg(F.to_date(F.min("o_orderdate")).alias("d")).scalar()
    k = F.col("c_custkey")
    return b.table("customer").select(
        k.alias(MEMBER),
        F.col("c_name").alias("email"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.date_add(first, (k % 28).cast("int")).cast("timestamp").alias("user_profile_created_at"),
    )


@query(
    "member_engagement_large",
    """
    SELECT w.wk AS week_start_date, COUNT(*) AS members, COUNT(a.m) AS active,
           CAST(COALESCE(SUM(a.classes), 0) AS BIGINT) AS classes_attended, CAST(COALESCE(SUM(a.made), 0) AS BIGINT) AS comments_made
    FROM (SELECT DISTINCT CAST(date_trunc('week', o_orderdate) AS DATE) AS wk FROM orders) w
    JOIN (SELECT c_custkey AS m, CAST(date_trunc('week', (SELECT MIN(o_orderdate) FROM orders) + to_days(CAST(c_custkey % 28 AS INTEGER))) AS DATE) AS joined
          FROM customer) p ON w.wk >= p.joined
    LEFT JOIN (SELECT o_custkey AS m, CAST(date_trunc('week', o_orderdate) AS DATE) AS wk, COUNT(DISTINCT o_orderpriority) AS classes,
                      COUNT(DISTINCT o_orderkey) AS made FROM orders GROUP BY 1, 2) a ON a.m = p.m AND a.wk = w.wk
    GROUP BY w.wk""",
)
def _(b: Base):
    """The full grid of customers and years of weeks, summed up per week."""
    rows = E.engagement_full(large_members(b), large_weekly(b))
    return rows.groupBy(WEEK).agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if("has_activity").alias("active"),
        F.sum("classes_attended").alias("classes_attended"),
        F.sum("comments_made").alias("comments_made"),
    )


def _old_target(b: Base):
    """Members already stored: those with any event."""
    return b.table("events").select(F.col("user_id").alias(MEMBER))


NEWEST = dt.date(2024, 2, 19)  # newest stored week of the incremental fixtures


@query("inc_new_members", f"SELECT community_member_id FROM ({NEW_SQL}) WHERE is_backfill")
def _(b: Base):
    return E.new_members(b.people, _old_target(b), NEWEST).select(MEMBER)


GRID_SQL = f"""
    SELECT community_member_id, is_backfill, CAST(unnest(generate_series(
               CAST(CASE WHEN is_backfill THEN joined ELSE GREATEST(joined, DATE '2024-01-22') END AS TIMESTAMP), TIMESTAMP '2024-02-26', INTERVAL 7 DAY)) AS DATE) AS week_start_date
    FROM ({NEW_SQL})"""


def _grid(b: Base):
    return E.backfill_grid(b.people, _old_target(b), NEWEST, "2024-02-28")


@query("inc_backfill_grid", GRID_SQL)
def _(b: Base):
    return _grid(b).select(MEMBER, "is_backfill", F.explode("__weeks").alias(WEEK))


@query("backfill_union", f"SELECT is_backfill, COUNT(*) AS grid_rows, COUNT(DISTINCT community_member_id) AS members FROM ({GRID_SQL}) GROUP BY 1")
def _(b: Base):
    """Both paths of the backfill as two grids put together."""
    marked = E.mark_new(b.people, _old_target(b), NEWEST)
    end, recent = F.lit(dt.date(2024, 2, 26)), F.lit(NEWEST - dt.timedelta(weeks=4))
    joined = F.col("__joined")
    new = marked.where("is_backfill").withColumn(WEEK, F.explode(weeks_from_calendar(joined, end)))
    known = marked.where("NOT is_backfill").withColumn(WEEK, F.explode(weeks_from_calendar(F.greatest(joined, recent), end)))
    return new.unionByName(known).groupBy("is_backfill").agg(
        F.count(F.lit(1)).alias("grid_rows"), F.countDistinct(MEMBER).alias("members")
    )


@query(
    "member_engagement_incremental",
    """
    SELECT community_member_id, week_start_date, classes_attended, lessons_completed, likes_received, comments_received, comments_made, has_activity
    FROM fx_engagement""",
)
def _(b: Base):
    """A build of the first weeks, then an incremental run that must end at the full build."""
    path = b.path("engagement")
    cut = F.col(WEEK) <= F.lit(CUT)
    early = {k: v.where(cut) for k, v in b.weekly.items()}
    known = b.people.where(F.col("user_profile_created_at") < F.lit(dt.datetime(2024, 1, 18)))
    target = tables.upsert(b.spark, path, E.engagement_full(known, early), P.WEEKLY_KEYS, WEEK, P.WEEKLY_KEYS)
    # the run keeps the ids with rows beside the table and asks these alone
    ids = b.stored("known_members", E.known_members(target))
    changes = E.engagement_changes(b.people, b.weekly, ids, I.weeks_since(target, 0), X.AS_OF)
    done = tables.upsert(b.spark, path, changes, P.WEEKLY_KEYS, WEEK, P.WEEKLY_KEYS)
    return done.drop("month", "email", "first_name", "last_name", "week_end_date", "is_backfill")


@query(
    "latest_completed_week",
    f"""
    SELECT week_start_date, COUNT(*) AS members FROM fx_grid
    WHERE week_start_date = (SELECT MAX(week_start_date) FROM fx_grid WHERE week_start_date < date_trunc('week', DATE '{X.AS_OF}')) GROUP BY 1""",
)
def _(b: Base):
    from teampulse.operators.weeks import last_finished_week

    rows = b.engagement.where(F.col(WEEK) == last_finished_week(b.engagement, X.AS_OF))
    return rows.groupBy(WEEK).agg(F.count(F.lit(1)).alias("members"))


# --- streams ------------------------------------------------------------------------------------


def _event_stream(b: Base):
    schema = b.table("events").schema
    return (
        b.spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(b.sf_dir)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )


@query(
    "stream_weekly_counts",
    """
    SELECT user_id AS community_member_id, CAST(date_trunc('week', ts) AS DATE) AS week_start_date, COUNT(DISTINCT event_id) AS events_seen
    FROM events GROUP BY 1, 2""",
)
def _(b: Base):
    """Counts of all weeks, the open one included, recounted batch by batch."""
    root = b.path("stream_weeks")
    ST.run_to_end(ST.recount_writer(_event_stream(b), root, "user_id", "event_id", "ts", "events_seen"))
    return tables.read_table(b.spark, f"{root}/counts").drop("month")


@query(
    "stream_monthly_counts",
    """
    SELECT user_id AS community_member_id, CAST(date_trunc('month', ts) AS DATE) AS month_start_date, COUNT(DISTINCT event_id) AS events_seen
    FROM events GROUP BY 1, 2""",
)
def _(b: Base):
    """The same per month, with the lookback of the batch run."""
    root = b.path("stream_months")
    writer = ST.recount_writer(_event_stream(b), root, "user_id", "event_id", "ts", "events_seen", ST.MONTH, dt.timedelta(days=31))
    ST.run_to_end(writer)
    return tables.read_table(b.spark, f"{root}/counts").drop("month")


@query(
    "stream_closed_weeks",
    """
    SELECT user_id AS community_member_id, CAST(date_trunc('week', ts) AS DATE) AS week_start_date, COUNT(DISTINCT event_id) AS events_seen
    FROM events WHERE date_trunc('week', ts) + INTERVAL 7 DAY <= (SELECT MAX(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""",
)
def _(b: Base):
    """Weeks closed by the watermark, written by a stream that runs to the end of the landed files."""
    counts = ST.weekly_counts(_event_stream(b), "user_id", "event_id", "ts", "events_seen", "1 hour")
    path = b.path("stream_counts")
    writer = (
        counts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", b.path("stream_state"))
        .outputMode("append")
        .trigger(availableNow=True)
    )
    ST.run_to_end(writer)
    return b.spark.read.schema(f"{MEMBER} bigint, {WEEK} date, events_seen bigint").parquet(path)


@query(
    "stream_upsert",
    """
    SELECT user_id, MAX(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id""",
)
def _(b: Base):
    """Latest event per member, kept in a month-partitioned table by a stream."""
    path = b.path("stream_latest")
    rows = _event_stream(b).select("user_id", "ts", "event_id")
    writer = ST.upsert_writer(rows, path, ["user_id"], "ts", "ts", b.path("stream_state"), ties=["event_id"])
    ST.run_to_end(writer)
    return tables.read_table(b.spark, path).drop("month")


# --- data checks ----------------------------------------------------------------------------------


@query(
    "dq_not_null",
    """
    SELECT 'manager_email' AS column_name, COUNT(*) FILTER (WHERE manager_email IS NULL) AS null_rows FROM fx_ranking
    UNION ALL SELECT 'member_email', COUNT(*) FILTER (WHERE member_email IS NULL) FROM fx_ranking
    UNION ALL SELECT 'suggested_action', COUNT(*) FILTER (WHERE suggested_action IS NULL) FROM fx_ranking""",
)
def _(b: Base):
    return Q.missing_values(
        b.ranked.known(["manager_email"], ["member_email", "suggested_action"]),
        ["manager_email", "member_email", "suggested_action"],
        "times",
    )


@query(
    "dq_unique",
    """
    SELECT 'e' || event_id AS id, CAST(2 AS BIGINT) AS "rows" FROM events WHERE event_type <> 'view' AND event_id % 10 = 0""",
)
def _(b: Base):
    return Q.repeated_keys(b.raw("envelopes"), ["id"])


@query(
    "dq_accepted_values",
    "SELECT event_type, COUNT(*) AS \"rows\" FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type",
)
def _(b: Base):
    return Q.unaccepted_values(b.table("events"), "event_type", ["view", "click", "purchase"])


@query(
    "dq_rowcount_diff",
    """
    SELECT f.n AS before_rows, e.n AS after_rows, abs(f.n - e.n) * 100.0 / f.n AS difference_pct, abs(f.n - e.n) * 100.0 / f.n < 1 AS within_tolerance
    FROM (SELECT COUNT(*) AS n FROM fx_grid) f, (SELECT COUNT(*) AS n FROM fx_engagement WHERE week_start_date < DATE '2024-01-29') e""",
)
def _(b: Base):
    return Q.row_count_difference(b.engagement, b.engagement.where(F.col(WEEK) < F.lit(dt.date(2024, 1, 29))))


@query(
    "dq_week_gaps",
    """
    SELECT * FROM (SELECT m AS community_member_id, wk AS week_start_date, lag(wk) OVER (PARTITION BY m ORDER BY wk) AS previous_week,
                          date_diff('day', lag(wk) OVER (PARTITION BY m ORDER BY wk), wk) AS gap_days
                   FROM (SELECT DISTINCT o_custkey AS m, CAST(date_trunc('week', o_orderdate) AS DATE) AS wk FROM orders))
    WHERE gap_days > 7""",
)
def _(b: Base):
    from teampulse.functions.dates import week_start

    weeks = b.table("orders").select(F.col("o_custkey").alias(MEMBER), week_start("o_orderdate").alias(WEEK)).distinct()
    return Q.week_gaps(weeks)


@query(
    "dq_profile",
    """
    SELECT AVG(classes_attended) AS avg_classes_attended, AVG(lessons_completed) AS avg_lessons_completed, AVG(likes_received) AS avg_likes_received,
           AVG(comments_received) AS avg_comments_received, AVG(comments_made) AS avg_comments_made,
           COUNT(*) FILTER (WHERE has_activity) * 100.0 / COUNT(*) AS pct_with_activity,
           least(MIN(classes_attended), MIN(lessons_completed), MIN(likes_received), MIN(comments_received), MIN(comments_made)) >= 0 AS all_non_negative
    FROM fx_engagement""",
)
def _(b: Base):
    return Q.metric_profile(b.engagement)


@query(
    "dq_backfill_flags",
    f"SELECT is_backfill, COUNT(*) AS row_count, COUNT(DISTINCT community_member_id) AS member_count FROM ({GRID_SQL}) GROUP BY 1",
)
def _(b: Base):
    return Q.backfill_profile(_grid(b).select(MEMBER, "is_backfill", F.explode("__weeks").alias(WEEK)))


@query(
    "dq_newest_week",
    """
    SELECT week_start_date, COUNT(DISTINCT community_member_id) AS member_count FROM fx_grid
    WHERE week_start_date = (SELECT MAX(week_start_date) FROM fx_grid) GROUP BY 1""",
)
def _(b: Base):
    return Q.newest_week_coverage(b.engagement)


@query(
    "dq_no_shrink",
    """
    SELECT COUNT(*) FILTER (WHERE week_start_date < DATE '2024-01-29') AS rows_before, COUNT(*) AS rows_after,
           COUNT(*) >= COUNT(*) FILTER (WHERE week_start_date < DATE '2024-01-29') AS passed FROM fx_grid""",
)
def _(b: Base):
    return Q.did_not_shrink(b.engagement.where(F.col(WEEK) < F.lit(dt.date(2024, 1, 29))), b.engagement)


@query(
    "dq_required",
    """
    SELECT event_id, concat_ws(', ', CASE WHEN user_id % 7 = 0 THEN 'user_id' END, CASE WHEN event_id % 11 = 0 THEN 'ts' END) AS missing_fields
    FROM events WHERE user_id % 7 = 0 OR event_id % 11 = 0""",
)
def _(b: Base):
    """Rows that lack a field of the key contract; the gaps are planted."""
    user = F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id")
    rows = b.table("events").select("event_id", user, F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("ts"))
    return Q.missing_keys(rows, ["event_id", "user_id", "ts"]).select("event_id", "missing_fields")


LOG_SQL = """
    SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'd' || (event_id - event_id % 2) END AS delivery_id,
           CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'm' || user_id END AS manager_email,
           CASE event_type WHEN 'view' THEN 'weekly' WHEN 'click' THEN 'monthly' ELSE 'daily' END AS report_type,
           CAST(ts AS DATE) AS week_start_date, ts AS sent_at, CASE WHEN event_id % 7 = 0 THEN 'lost' ELSE 'sent' END AS delivery_status FROM events"""
WEEKS_SQL = """
    SELECT m AS community_member_id, wk AS week_start_date FROM (SELECT DISTINCT o_custkey AS m, CAST(date_trunc('week', o_orderdate) AS DATE) AS wk FROM orders)"""


@query(
    "run_checks",
    f"""
    WITH l AS ({LOG_SQL}), w AS ({WEEKS_SQL}), e AS (SELECT * FROM w UNION ALL SELECT * FROM w WHERE community_member_id % 5 = 0),
         f AS (SELECT date_diff('day', lag(week_start_date) OVER (PARTITION BY community_member_id ORDER BY week_start_date), week_start_date) AS gap FROM e)
    SELECT *, failing_rows = 0 AS passed FROM (
      SELECT 'not_null' AS check_name, 'delivery_log' AS table_name, 'delivery_id' AS column_name, COUNT(*) FILTER (WHERE delivery_id IS NULL) AS failing_rows FROM l
      UNION ALL SELECT 'not_null', 'delivery_log', 'manager_email', COUNT(*) FILTER (WHERE manager_email IS NULL) FROM l
      UNION ALL SELECT 'not_null', 'delivery_log', 'report_type', COUNT(*) FILTER (WHERE report_type IS NULL) FROM l
      UNION ALL SELECT 'not_null', 'delivery_log', 'week_start_date', COUNT(*) FILTER (WHERE week_start_date IS NULL) FROM l
      UNION ALL SELECT 'not_null', 'delivery_log', 'sent_at', COUNT(*) FILTER (WHERE sent_at IS NULL) FROM l
      UNION ALL SELECT 'not_null', 'delivery_log', 'delivery_status', COUNT(*) FILTER (WHERE delivery_status IS NULL) FROM l
      UNION ALL SELECT 'unique', 'delivery_log', 'delivery_id', COUNT(*) FROM (SELECT 1 FROM l WHERE delivery_id IS NOT NULL GROUP BY delivery_id HAVING COUNT(*) > 1)
      UNION ALL SELECT 'accepted_values', 'delivery_log', 'report_type', COUNT(*) FILTER (WHERE report_type NOT IN ('weekly', 'monthly')) FROM l
      UNION ALL SELECT 'accepted_values', 'delivery_log', 'delivery_status', COUNT(*) FILTER (WHERE delivery_status NOT IN ('sent', 'failed', 'bounced')) FROM l
      UNION ALL SELECT 'not_null', 'engagement', 'community_member_id', COUNT(*) FILTER (WHERE community_member_id IS NULL) FROM e
      UNION ALL SELECT 'not_null', 'engagement', 'week_start_date', COUNT(*) FILTER (WHERE week_start_date IS NULL) FROM e
      UNION ALL SELECT 'unique', 'engagement', 'community_member_id, week_start_date', COUNT(*) FROM (SELECT 1 FROM e GROUP BY ALL HAVING COUNT(*) > 1)
      UNION ALL SELECT 'week_gaps', 'engagement', 'week_start_date', COUNT(*) FILTER (WHERE gap > 7) FROM f
      UNION ALL SELECT 'no_shrink', 'engagement', 'week_start_date', greatest((SELECT COUNT(*) FROM orders) * 2 - COUNT(*), 0) FROM e)""".replace("GROUP BY ALL", "GROUP BY community_member_id, week_start_date"),
)
def _(b: Base):
    """All declared checks over a log and an engagement table with planted faults."""
    from teampulse.functions.dates import week_start

    even = F.col("event_id") - F.col("event_id") % 2
    log = b.table("events").select(
        F.when(F.col("event_id") % 97 != 0, F.concat(F.lit("d"), even)).alias("delivery_id"),
        F.when(F.col("event_id") % 13 != 0, F.concat(F.lit("m"), "user_id")).alias("manager_email"),
        F.when(F.col("event_type") == "view", "weekly").when(F.col("event_type") == "click", "monthly").otherwise("daily").alias("report_type"),
        F.to_date("ts").alias(WEEK),
        F.col("ts").alias("sent_at"),
        F.when(F.col("event_id") % 7 == 0, "lost").otherwise("sent").alias("delivery_status"),
    )
    weeks = b.table("orders").select(F.col("o_custkey").alias(MEMBER), week_start("o_orderdate").alias(WEEK)).distinct()
    twice = weeks.unionByName(weeks.where(F.col(MEMBER) % 5 == 0))
    return CH.findings({"delivery_log": log, "engagement": twice}, {"engagement": 2 * b.table("orders").count()})


def _updated(b: Base):
    """Grid rows with the time their week was written."""
    rows = _grid(b).select(MEMBER, "email", "is_backfill", F.explode("__weeks").alias(WEEK))
    return rows.withColumn("updated_at", F.date_add(WEEK, 7).cast("timestamp"))


@query(
    "dq_run_health",
    f"""
    SELECT CAST(week_start_date + 7 AS DATE) AS run_date, COUNT(*) AS rows_updated, COUNT(DISTINCT community_member_id) AS members_updated,
           COUNT(*) FILTER (WHERE is_backfill) AS backfill_rows, MIN(week_start_date) AS earliest_week, MAX(week_start_date) AS latest_week
    FROM ({GRID_SQL}) GROUP BY 1""",
)
def _(b: Base):
    return Q.run_health(_updated(b), "updated_at")


@query(
    "dq_backfills_per_member",
    f"""
    SELECT CAST(g.week_start_date + 7 AS DATE) AS backfill_date, g.community_member_id, p.email, COUNT(*) AS weeks_backfilled,
           MIN(g.week_start_date) AS from_week, MAX(g.week_start_date) AS to_week
    FROM ({GRID_SQL}) g JOIN fx_member p USING (community_member_id) WHERE g.is_backfill GROUP BY 1, 2, 3""",
)
def _(b: Base):
    return Q.backfills_per_member(_updated(b), "updated_at")


@query(
    "dq_update_times",
    f"""
    SELECT MIN(CAST(week_start_date + 7 AS TIMESTAMP)) AS earliest_update, MAX(CAST(week_start_date + 7 AS TIMESTAMP)) AS latest_update,
           COUNT(DISTINCT week_start_date) AS update_days FROM ({GRID_SQL})""",
)
def _(b: Base):
    return Q.update_profile(_updated(b), "updated_at")


# --- rendering over the stored rankings ---------------------------------------------------------------


@query("render_top3", f"SELECT manager_email, business_name, top_performers_html FROM ({MD.TOP_PERFORMERS_SQL})")
def _(b: Base):
    return XP.top_performers(b.ranked).select("manager_email", "business_name", "top_performers_html")


@query(
    "render_movers",
    f"SELECT manager_email, business_name, top_movers_context_note, top_movers_html FROM ({MD.TOP_MOVERS_SQL})",
)
def _(b: Base):
    return XP.top_movers(b.ranked).select(
        "manager_email", "business_name", "top_movers_context_note", "top_movers_html"
    )


@query("render_actions", f"SELECT manager_email, business_name, action_points_html FROM ({MD.ACTION_POINTS_SQL})")
def _(b: Base):
    return XP.action_points(b.ranked).select("manager_email", "business_name", "action_points_html")


@query("render_pdf_summary", f"SELECT manager_email, business_name, pdf_summary_html FROM ({MD.PDF_SQL})")
def _(b: Base):
    return XP.pdf_blocks(b.ranked).select("manager_email", "business_name", "pdf_summary_html")
