"""Joins, aggregations, windows, top-k and set operations."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from teampulse.catalog import fixtures as X
from teampulse.catalog import models as MD
from teampulse.catalog.base import MEMBER, WEEK, Base, query
from teampulse.functions import rules as R
from teampulse.operators import dedup, grid, joins, ordered, pivot, ranking, weeks
from teampulse.plans import engagement as E
from teampulse.plans import exports as XP
from teampulse.plans import metrics as M
from teampulse.plans import monthly as MO
from teampulse.plans import relations as B
from teampulse.plans import reports as W
from teampulse.plans import teams as T

TEAM = [T.TEAM_ID, WEEK]


def _handed(b: Base, rows, *columns: str):
    """Columns of rows worked out per team, for the e-mail of each manager of the team."""
    rows = rows.select(*T.ITEM, "business_name", "member_community_id", *columns)
    heads = b.team_weeks.managers.select(*T.ITEM, "manager_email")
    return replace(b.team_weeks, rows=rows, managers=heads).pairs().select(*KEY, *columns)


# --- joins -------------------------------------------------------------------------


@query(
    "join_inner_summary",
    """
    SELECT c.manager_email, c.member_community_id, c.business_name, c.total_points, s.summary_business, s.team_total_points, s.team_size
    FROM fx_compared c JOIN fx_summary s ON s.manager_email = c.manager_email""",
)
def _(b: Base):
    summary = T.team_summary(b.mapping, b.member_rows).select(
        "manager_email", F.col("business_name").alias("summary_business"), "team_total_points", "team_size"
    )
    heads = b.shared.managers.select(*T.ITEM, "manager_email").join(summary, "manager_email")
    rows = b.shared.rows.select(*T.ITEM, "member_community_id", "business_name", "total_points")
    return replace(b.shared, rows=rows, managers=heads).pairs()


@query(
    "engagement_star_join",
    """
    SELECT community_member_id, week_start_date, classes_attended, lessons_completed, likes_received, comments_received, comments_made
    FROM fx_engagement""",
)
def _(b: Base):
    people = b.people.select(MEMBER, D_joined())
    all_weeks = grid.distinct_weeks(list(b.weekly.values()))
    spread = grid.add_weeks_from_activity(people, "joined", all_weeks, "weeks")
    rows = grid.spread_weeks(spread, F.col("weeks")).drop("weeks", "joined")
    return grid.star_join(rows, b.weekly)


def D_joined():
    from teampulse.functions.dates import week_start

    return week_start("user_profile_created_at").alias("joined")


@query(
    "wow_compare",
    """
    SELECT manager_email, business_name, member_community_id, total_points, previous_week_points, points_change FROM fx_compared""",
)
def _(b: Base):
    rows = W.scored(b.team_weeks.rows)
    both = weeks.with_previous_week(
        rows, [T.TEAM_ID, "business_name", "member_community_id"], {"total_points": "previous_week_points"}
    )
    change = F.col("total_points") - F.col("previous_week_points")
    found = weeks.only_newest(both).withColumn("points_change", change)
    return _handed(b, found, "total_points", "previous_week_points", "points_change")


@query(
    "action_candidates",
    f"""
    SELECT manager_email, c_full AS celebrate, e_full AS encourage, e_change AS change, r_full AS reengage
    FROM (SELECT DISTINCT manager_email FROM fx_ranking) h LEFT JOIN {MD.PICKS}""",
)
def _(b: Base):
    return XP.candidates(b.ranked).select(
        "manager_email",
        F.col("celebrate.member_full_name").alias("celebrate"),
        F.col("encourage.member_full_name").alias("encourage"),
        F.col("encourage.points_change").alias("change"),
        F.col("reengage.member_full_name").alias("reengage"),
    )


@query(
    "join_anti_unmanaged",
    """
    SELECT CAST(tag_id AS BIGINT) AS tag_id, business_name FROM fx_business WHERE tag_id NOT IN (SELECT tag_id FROM fx_assignment)""",
)
def _(b: Base):
    managed = b.mapping.select(F.col(B.TAG).alias("tag_id")).distinct()
    return b.businesses.join(managed, "tag_id", "left_anti").select("tag_id", "business_name")


@query(
    "join_semi_existing",
    "SELECT community_member_id, email FROM fx_member WHERE community_member_id IN (SELECT user_id FROM events)",
)
def _(b: Base):
    active = b.table("events").select(F.col("user_id").alias(MEMBER)).distinct()
    return b.people.join(active, MEMBER, "left_semi").select(MEMBER, "email")


@query(
    "join_semi_parent_child",
    """
    SELECT event_id AS id, k AS event_id FROM fx_activity WHERE event_type = 'view' AND k IN (SELECT page_id FROM pages)""",
)
def _(b: Base):
    return joins.only_children_of(b.raw("event_attendees"), "event_id", b.raw("events_list"), "id").select("id", "event_id")


@query(
    "cross_one_row",
    """
    SELECT community_member_id, CAST(100 AS BIGINT) AS business_role, CAST(101 AS BIGINT) AS manager_role,
           (SELECT MAX(wk) FROM fx_weekly) AS latest_week FROM fx_member""",
)
def _(b: Base):
    roles = B.system_tags(b.tags)
    latest = weeks.newest(b.engagement)
    return b.members.select(
        MEMBER,
        roles.select("business_tag_id").scalar().alias("business_role"),
        roles.select("manager_tag_id").scalar().alias("manager_role"),
        latest.alias("latest_week"),
    )


@query("spine_member_week", "SELECT community_member_id, week_start_date FROM fx_grid")
def _(b: Base):
    """Calendar weeks equal the active ones here, as every week of the events has activity."""
    joined = D_joined()
    people = b.people.select(MEMBER, joined)
    return grid.spread_weeks(people, grid.weeks_from_calendar(F.col("joined"), F.lit(dt.date(2024, 1, 29)))).drop("joined")


@query(
    "spine_calendar_weeks",
    """
    SELECT c_custkey AS community_member_id,
           CAST(unnest(generate_series(lo + to_days(CAST(7 * (c_custkey % 5) AS INTEGER)), hi, INTERVAL 7 DAY)) AS DATE) AS week_start_date
    FROM customer, (SELECT date_trunc('week', MIN(o_orderdate)) AS lo, date_trunc('week', MAX(o_orderdate)) AS hi FROM orders)""",
)
def _(b: Base):
    """Every customer by every week of the orders, the large grid."""
    from teampulse.functions.dates import week_start

    span = b.table("orders").agg(week_start(F.min("o_orderdate")).alias("lo"), week_start(F.max("o_orderdate")).alias("hi"))
    people = b.table("customer").select(
        F.col("c_custkey").alias(MEMBER),
        F.date_add(span.select("lo").scalar(), (F.col("c_custkey") % 5 * 7).cast("int")).alias("lo"),
        span.select("hi").scalar().alias("hi"),
    )
    return grid.spread_weeks(people, grid.weeks_from_calendar(F.col("lo"), F.col("hi"))).drop("lo", "hi")


@query(
    "join_array_membership",
    """
    SELECT p.community_member_id, b.business_name FROM fx_member p
    JOIN (SELECT DISTINCT community_member_id, tag_id FROM fx_member_tag) t USING (community_member_id)
    JOIN fx_business b USING (tag_id) WHERE p.is_manager""",
)
def _(b: Base):
    mgr = B.managers(b.members, b.tags)
    found = joins.on_array_member(mgr, "tag_ids", b.businesses.select("tag_id", "business_name"), "tag_id")
    return found.select(F.col("manager_community_id").alias(MEMBER), "business_name")


@query(
    "join_explode_tags",
    """
    SELECT t.community_member_id, b.business_name FROM fx_member_tag t JOIN fx_business b USING (tag_id) WHERE NOT t.is_manager""",
)
def _(b: Base):
    team = B.team_members(b.members, b.tags)
    names = b.businesses.select(F.col("tag_id").alias(B.TAG), "business_name")
    return team.join(names, B.TAG).select(F.col("member_community_id").alias(MEMBER), "business_name")


@query(
    "join_normalized_text",
    "SELECT i.email, b.business_name FROM fx_invited i JOIN fx_business b ON lower(b.business_name) = i.business",
)
def _(b: Base):
    rows = b.invited.select(F.col("manager_email").alias("email"), "business_name_from_tags")
    return joins.on_normal_name(rows, "business_name_from_tags", b.businesses.select("business_name"), "business_name").select(
        "email", "business_name"
    )


@query(
    "join_lookup_counts",
    """
    SELECT CAST(t.tag_id AS BIGINT) AS tag_id, COALESCE(c.n, 0) AS members FROM fx_tag t
    LEFT JOIN (SELECT tag_id, COUNT(DISTINCT email) AS n FROM fx_member_tag GROUP BY tag_id) c USING (tag_id)""",
)
def _(b: Base):
    counts = B.tag_member_counts(b.members)
    return b.tags.select("tag_id").join(counts, "tag_id", "left").select(
        "tag_id", F.coalesce("actual_member_count", F.lit(0).cast("bigint")).alias("members")
    )


# --- aggregation ----------------------------------------------------------------------


@query("weekly_metric", "SELECT m AS community_member_id, wk AS week_start_date, metric, n FROM fx_weekly")
def _(b: Base):
    return grid.stack_metrics(M.weekly_tables(b.feeds))


@query(
    "weekly_large",
    """
    SELECT l_suppkey AS community_member_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start_date, COUNT(DISTINCT l_partkey) AS parts
    FROM lineitem GROUP BY 1, 2""",
)
def _(b: Base):
    """The weekly count over the largest driver table."""
    rows = b.table("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    return M.weekly_count(rows, "l_suppkey", "l_partkey", "l_shipdate", "parts")


@query(
    "agg_string_list",
    """
    SELECT manager_email, string_agg(member_email, ', ' ORDER BY total_points DESC, member_email) AS emails
    FROM fx_compared GROUP BY manager_email""",
)
def _(b: Base):
    order = [-F.col("total_points"), F.col("member_email")]
    texts = b.shared.per_group(
        lambda rows, team: ordered.text_per_group(rows, team, order, F.col("member_email"), ", ", "emails")
    )
    return texts.select("manager_email", "emails")


@query(
    "agg_array_of_struct",
    """
    SELECT manager_email, COUNT(*) AS members, string_agg(COALESCE(member_full_name, '-'), '|' ORDER BY total_events DESC, member_email NULLS FIRST, member_community_id NULLS FIRST) AS names
    FROM fx_compared GROUP BY manager_email""",
)
def _(b: Base):
    named = b.shared.with_rows(b.shared.rows.withColumn("name", F.coalesce(W.member_name(), F.lit("-"))))
    order = [-F.col("total_engagement_score"), F.col("member_email"), F.col("member_community_id")]
    member = F.struct("name", "member_email", "total_engagement_score")
    names = F.array_join(F.transform("members", lambda m: m["name"]), "|")

    def lists(rows, team):
        found = ordered.list_per_group(rows, team, order, member, "members")
        return found.select(*team, F.size("members").cast("bigint").alias("members"), names.alias("names"))

    return named.per_group(lists).drop(WEEK)


@query(
    "agg_conditional_counts",
    """
    SELECT manager_email, COUNT(*) FILTER (WHERE has_activity) AS active, COUNT(*) FILTER (WHERE total_points = 0) AS inactive,
           COUNT(DISTINCT CASE WHEN has_activity THEN member_full_name END) AS active_names
    FROM fx_compared GROUP BY manager_email""",
)
def _(b: Base):
    counts = [
        F.count_if("has_activity").alias("active"),
        F.count_if(F.col("total_points") == 0).alias("inactive"),
        F.countDistinct(F.when(F.col("has_activity"), F.col("member_full_name"))).alias("active_names"),
    ]
    return b.shared.per_group(lambda rows, team: rows.groupBy(*team).agg(*counts)).drop(WEEK)


@query("team_summary", "SELECT * FROM fx_summary")
def _(b: Base):
    out = T.team_summary(b.mapping, b.member_rows).withColumnRenamed("business_name", "summary_business")
    return out.drop("manager_full_name", WEEK, "week_end_date")


@query(
    "pivot_top3",
    f"""
    SELECT manager_email, COUNT(*) FILTER (WHERE is_top_performer) AS n, {MD.PERFORMERS} FROM fx_ranking
    GROUP BY manager_email""",
)
def _(b: Base):
    # managers without a top performer stay, with zero
    place = F.when(F.col("is_top_performer"), F.col("performance_rank"))
    rows = XP.rows_of(b.ranked, lambda rows: rows.withColumn("place", place))
    values = {"member_full_name": "top_performer_{}_name", "total_points": "top_performer_{}_score"}
    top = XP.on_teams(rows, lambda rows, team: pivot.ranks_to_columns(rows, team, "place", values))
    return top.drop(WEEK).withColumnRenamed("__n", "n")


@query("system_tags", "SELECT CAST(101 AS BIGINT) AS manager_tag_id, CAST(100 AS BIGINT) AS business_tag_id")
def _(b: Base):
    return B.system_tags(b.tags)


@query("manager_list", f"SELECT DISTINCT {MD.HEADER} FROM fx_ranking")
def _(b: Base):
    return XP.manager_weeks(b.ranked)


@query(
    "tag_member_counts",
    "SELECT CAST(tag_id AS BIGINT) AS tag_id, COUNT(DISTINCT email) AS actual_member_count FROM fx_member_tag GROUP BY tag_id",
)
def _(b: Base):
    return B.tag_member_counts(b.members)


@query(
    "team_size",
    "SELECT email, CAST(tag_id AS BIGINT) AS business_tag_id, business_total_members, team_size FROM fx_mapping",
)
def _(b: Base):
    both = B.community_assignments(b.members, b.tags, b.businesses).unionByName(
        B.invited_assignments(b.invited, b.businesses)
    )
    return B.with_team_size(B.one_assignment(both)).select(
        F.col("manager_email").alias("email"), B.TAG, "business_total_members", "team_size"
    )


@query("monthly_course_report", f"SELECT * FROM ({MD.COUNTS_SQL})")
def _(b: Base):
    counts = T.per_team_report(b.mapping, b.members, b.tags, lambda pairs: MO.course_counts(b.courses, pairs))
    return counts.drop("manager_full_name")


@query("member_completion_status", f"SELECT * RENAME (member_full_name AS name) FROM ({MD.STATUS_SQL})")
def _(b: Base):
    return T.per_team_report(b.mapping, b.members, b.tags, lambda pairs: MO.member_status(b.courses, pairs))


@query(
    "subquery_correlated_count",
    """
    SELECT manager_email, week_start_date,
           (SELECT COUNT(*) FROM fx_ranking s WHERE s.manager_email = r.manager_email AND s.is_top_performer) AS count_top_performers,
           (SELECT COUNT(*) FROM fx_ranking s WHERE s.manager_email = r.manager_email AND s.is_top_mover) AS count_top_movers,
           (SELECT COUNT(*) FROM fx_ranking s WHERE s.manager_email = r.manager_email AND s.suggested_action IS NOT NULL) AS count_action_items
    FROM (SELECT DISTINCT manager_email, week_start_date FROM fx_ranking) r""",
)
def _(b: Base):
    return XP.section_counts(b.ranked)


@query(
    "filter_latest_week",
    "SELECT community_member_id, week_start_date, has_activity FROM fx_engagement WHERE week_start_date = (SELECT MAX(week_start_date) FROM fx_engagement)",
)
def _(b: Base):
    return weeks.only_newest(b.engagement).select(MEMBER, WEEK, "has_activity")


# --- scores and labels ---------------------------------------------------------------------


@query(
    "score_weighted",
    """
    SELECT community_member_id, week_start_date, classes_attended * 5 + lessons_completed + likes_received + comments_received + comments_made AS total_points
    FROM fx_engagement""",
)
def _(b: Base):
    return b.engagement.select(MEMBER, WEEK, R.weighted_points().alias("total_points"))


KEY = ["manager_email", "business_name", "member_community_id"]
KEY_SQL = "manager_email, business_name, member_community_id"


def _ranked(b: Base, team=None, group: list[str] = W.TEAM):
    """Ranks of team rows; without ``team``, of those with a row per manager."""
    rows = W.scored(b.team if team is None else team)
    return W.with_ranks(ranking.with_row_ids(W.week_over_week(rows)), group)


def _labelled(b: Base, *of):
    return W.with_labels(_ranked(b, *of))


@query("performance_category", f"SELECT {KEY_SQL}, performance_category FROM fx_labelled")
def _(b: Base):
    return _handed(b, _labelled(b, b.team_weeks.rows, TEAM), "performance_category")


@query("momentum_category", f"SELECT {KEY_SQL}, momentum_category FROM fx_labelled")
def _(b: Base):
    return _handed(b, _labelled(b, b.team_weeks.rows, TEAM), "momentum_category")


@query("suggested_action", f"SELECT {KEY_SQL}, suggested_action FROM fx_labelled")
def _(b: Base):
    return _handed(b, _labelled(b, b.team_weeks.rows, TEAM), "suggested_action")


# --- windows -------------------------------------------------------------------------------


def _rank(b: Base, name: str):
    rows = W.week_over_week(W.scored(b.team_weeks.rows))
    keys = [*W.rank_keys()[name], F.col("business_name")]
    return _handed(b, ranking.rank_rows(rows, TEAM, keys, name), name)


@query("rank_performance", f"SELECT {KEY_SQL}, performance_rank FROM fx_ranked")
def _(b: Base):
    return _rank(b, "performance_rank")


@query("rank_movers", f"SELECT {KEY_SQL}, mover_rank FROM fx_ranked")
def _(b: Base):
    return _rank(b, "mover_rank")


@query("rank_inactive", f"SELECT {KEY_SQL}, inactive_rank FROM fx_ranked")
def _(b: Base):
    return _rank(b, "inactive_rank")


@query("rank_performance_split", f"SELECT {KEY_SQL}, performance_rank FROM fx_ranked")
def _(b: Base):
    """The same rank with each row counted over the whole table first."""
    rows = W.week_over_week(W.scored(b.team_weeks.rows))
    keys = [*W.rank_keys()["performance_rank"], F.col("business_name")]
    rows = ranking.numbered(rows, [*map(F.col, TEAM), *keys], "n")
    firsts = rows.groupBy(*TEAM).agg(F.min("n").alias("first"))
    rank = F.col("n") - F.col("first") + 1
    return _handed(b, ranking.null_safe_join(rows, firsts, TEAM).withColumn("performance_rank", rank), "performance_rank")


@query("percent_rank", f"SELECT {KEY_SQL}, performance_percentile FROM fx_ranked")
def _(b: Base):
    rows = b.shared.rows.select(*T.ITEM, WEEK, "business_name", "member_community_id", "total_points")
    found = ranking.percent_rank_rows(rows, [T.TEAM_ID, WEEK], "total_points", "performance_percentile")
    heads = b.shared.managers.select(*T.ITEM, "manager_email")
    return replace(b.shared, rows=found, managers=heads).pairs().select(*KEY, "performance_percentile")


@query("percent_rank_split", f"SELECT {KEY_SQL}, performance_percentile FROM fx_ranked")
def _(b: Base):
    rows = W.week_over_week(W.scored(b.team_weeks.rows))
    ranked = ranking.rank_rows(rows, TEAM, [F.col("total_points"), F.col("member_community_id"), F.col("business_name")], "n")
    # the share from the first rank of a value, not from counts
    least = ranked.groupBy(*TEAM, "total_points").agg(F.min("n").alias("least"))
    sizes = ranked.groupBy(*TEAM).agg(F.max("n").alias("size"))
    both = ranking.null_safe_join(ranking.null_safe_join(ranked, least, [*TEAM, "total_points"]), sizes, TEAM)
    share = F.coalesce(F.try_divide((F.col("least") - 1).cast("double"), (F.col("size") - 1).cast("double")), F.lit(0.0))
    return _handed(b, both.withColumn("performance_percentile", share), "performance_percentile")


@query(
    "rank_global",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS order_rank FROM orders",
)
def _(b: Base):
    """A rank over the whole table, which no task sees as a whole."""
    keys = [F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_orderkey")]
    rows = b.table("orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return ranking.global_rank(rows, keys, "order_rank").select("o_orderkey", "order_rank")


COPIES_SQL = "'e' || event_id AS record_id, CASE WHEN event_id % 10 = 0 THEN 'v1' ELSE 'v0' END AS version"


@query("dedup_latest", f"SELECT {COPIES_SQL} FROM events WHERE event_type <> 'view'")
def _(b: Base):
    rows = b.raw("envelopes")
    return dedup.keep_latest(rows, ["id"], "_airbyte_extracted_at", ["_airbyte_raw_id"]).select(
        F.col("id").alias("record_id"), "version"
    )


@query("dedup_earliest", "SELECT member, course_id, created_at, record_id FROM fx_first_course")
def _(b: Base):
    rows = b.table("orders").select(
        F.col("o_custkey").alias("member"),
        F.col("o_orderpriority").alias("course_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("record_id"),
    )
    return dedup.keep_earliest(rows, ["member", "course_id"], "created_at", ["record_id"])


@query(
    "dedup_tiebreak",
    """
    SELECT first_name, MAX(joined_at) AS joined_at, arg_max(community_member_id, (joined_at, email)) AS community_member_id
    FROM fx_member GROUP BY first_name""",
)
def _(b: Base):
    """One member per first name: newest profile, then e-mail."""
    rows = dedup.keep_latest(b.members, ["first_name"], "user_profile_created_at", ["email", "last_name"])
    return rows.select("first_name", F.col("user_profile_created_at").alias("joined_at"), MEMBER)


@query(
    "dedup_priority",
    """
    SELECT CAST(tag_id AS BIGINT) AS business_tag_id, email, source FROM (
        SELECT *, row_number() OVER (PARTITION BY lower(email), tag_id
                  ORDER BY (CASE WHEN source = 'community' THEN 1 ELSE 2 END), in_community DESC, invitation_date DESC NULLS LAST, manager_id NULLS FIRST) AS pick
        FROM (SELECT tag_id, email, source, in_community, invitation_date, manager_id FROM fx_assignment
              UNION ALL SELECT tag_id, upper(email), 'invited_csv', FALSE, TIMESTAMP '2024-01-31 00:00:00', manager_id FROM fx_assignment))
    WHERE pick = 1""",
)
def _(b: Base):
    """Assignments with a second, later invitation under the same address in capitals."""
    both = B.community_assignments(b.members, b.tags, b.businesses).unionByName(
        B.invited_assignments(b.invited, b.businesses)
    )
    again = both.withColumns(
        {
            "manager_email": F.upper("manager_email"),
            "manager_source": F.lit("invited_csv"),
            "manager_in_community": F.lit(False),
            "invitation_date": F.lit(dt.datetime(2024, 1, 31)),
        }
    )
    return B.one_assignment(both.unionByName(again)).select(
        B.TAG, F.col("manager_email").alias("email"), F.col("manager_source").alias("source")
    )


# --- top-k ------------------------------------------------------------------------------------


@query(
    "topk_per_group",
    """
    SELECT manager_email, manager_full_name, business_name, member_full_name, total_points, performance_rank AS rank
    FROM fx_ranked WHERE performance_rank <= 3""",
)
def _(b: Base):
    """Who are the top three members of each team in the last finished week?"""
    found = T.team_weeks(b.mapping, b.members, b.tags, b.engagement, X.AS_OF, 1)
    rows = W.scored(weeks.only_newest(found.rows))
    order = [*W.rank_keys()["performance_rank"], F.col("business_name")]
    return found.with_rows(ranking.top_rows(rows, TEAM, order, 3)).pairs().select(
        "manager_email", "manager_full_name", "business_name", "member_full_name", "total_points", "rank"
    )


@query(
    "team_detail_export",
    """
    SELECT manager_email, business_name, team_member, member_email, week_total_engagement, activity_status FROM fx_detail""",
)
def _(b: Base):
    return XP.team_detail_export(b.detailed).select(
        "manager_email", "business_name", "team_member", "member_email", "week_total_engagement", "activity_status"
    )


# --- set operations ---------------------------------------------------------------------------


@query(
    "union_all_likes",
    "SELECT user_id AS community_member_id, ts AS created_at, 'e' || event_id AS like_id FROM events WHERE event_type = 'purchase'",
)
def _(b: Base):
    return M.union_likes(b.feeds["post_likes"], b.feeds["comment_likes"])


@query(
    "union_managers",
    """
    SELECT CAST(tag_id AS BIGINT) AS business_tag_id, email, source, invitation_status, invitation_date FROM fx_assignment""",
)
def _(b: Base):
    both = B.community_assignments(b.members, b.tags, b.businesses).unionByName(
        B.invited_assignments(b.invited, b.businesses)
    )
    return both.select(
        B.TAG,
        F.col("manager_email").alias("email"),
        F.col("manager_source").alias("source"),
        "invitation_status",
        "invitation_date",
    )


@query("union_distinct_weeks", "SELECT DISTINCT wk AS week_start_date FROM fx_weekly")
def _(b: Base):
    return grid.distinct_weeks(list(b.weekly.values()))


@query(
    "member_engagement_calendar",
    "SELECT * EXCLUDE (week_end_date, email, first_name, last_name) FROM fx_engagement",
)
def _(b: Base):
    """The full build on the calendar spine."""
    rows = E.engagement_full(b.people, b.weekly, "calendar", X.AS_OF)
    return rows.drop("week_end_date", "email", "first_name", "last_name", "is_backfill")
