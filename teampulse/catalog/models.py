"""One query per model of the pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from teampulse.catalog import fixtures as X
from teampulse.catalog.base import Base, query
from teampulse.plans import engagement as E
from teampulse.plans import exports as XP
from teampulse.plans import metrics as M
from teampulse.plans import monthly as MO
from teampulse.plans import relations as B
from teampulse.plans import reports as W
from teampulse.plans import staging as C
from teampulse.plans import teams as T
from teampulse.sources import delivery


# --- staging -----------------------------------------------------------------


@query(
    "clean_members",
    """
    SELECT p.community_member_id, first_name, last_name, full_name, p.email, posts_count, comments_count,
           joined_at AS user_profile_created_at, TRUE AS has_email, t.tag_count, t.tag_ids, t.tag_names,
           'complete' AS profile_completeness,
           date_diff('day', CAST(joined_at AS DATE), DATE '2024-01-31') AS days_since_created
    FROM fx_member p JOIN (
        SELECT community_member_id, COUNT(*) AS tag_count,
               string_agg(CAST(tag_id AS VARCHAR), '|' ORDER BY tag_id, name) AS tag_ids,
               string_agg(name, '|' ORDER BY tag_id, name) AS tag_names
        FROM (SELECT m.*, CASE WHEN m.tag_id = 100 THEN 'Business' WHEN m.tag_id = 101 THEN 'Manager'
                               WHEN m.tag_id = f.nation_id THEN n.n_name WHEN m.is_manager THEN 'second' ELSE 'other' END AS name
              FROM fx_member_tag m JOIN fx_member f USING (community_member_id)
              LEFT JOIN fx_nation n ON n.n = m.tag_id)
        GROUP BY community_member_id) t USING (community_member_id)""",
)
def _(b: Base):
    # the fixture lists tags in no fixed order, so they are sorted for the comparison
    pairs = F.array_sort(F.arrays_zip("tag_ids", "tag_names"))
    return C.clean_members(b.raw("community_members"), X.AS_OF).withColumn("pairs", pairs).select(
        "community_member_id",
        "first_name",
        "last_name",
        "full_name",
        "email",
        "posts_count",
        "comments_count",
        "user_profile_created_at",
        "has_email",
        "tag_count",
        F.array_join(F.transform("pairs", lambda p: p["tag_ids"].cast("string")), "|").alias("tag_ids"),
        F.array_join(F.transform("pairs", lambda p: p["tag_names"]), "|").alias("tag_names"),
        "profile_completeness",
        "days_since_created",
    )


@query(
    "clean_tags",
    """
    SELECT CAST(tag_id AS BIGINT) AS tag_id, tag_name, TRUE AS show_in_member_directory, FALSE AS show_in_post_bio,
           on_profile AS show_in_profile_page, on_profile AS is_public, CAST(age * 10 AS BIGINT) AS tagged_members_count,
           CASE WHEN tag_id < 100 THEN 'potential_business_name' WHEN tag_id IN (100, 101) THEN 'business_role'
                WHEN tag_id = 102 THEN 'membership_tier' ELSE 'course_completion' END AS tag_category,
           CASE WHEN tag_id = 102 THEN TRUE WHEN tag_id >= 200 THEN FALSE ELSE on_profile END AS visible_beside_name,
           CASE WHEN tag_id >= 200 THEN substr(tag_name, 13) END AS course_name,
           CAST(30 + age * 20 AS BIGINT) AS days_since_created,
           CAST(TIMESTAMP '2024-01-01' - to_days(CAST(age * 20 AS INTEGER)) AS DATE) AS created_date,
           CAST(year(TIMESTAMP '2024-01-01' - to_days(CAST(age * 20 AS INTEGER))) AS BIGINT) AS created_year,
           CAST(month(TIMESTAMP '2024-01-01' - to_days(CAST(age * 20 AS INTEGER))) AS BIGINT) AS created_month
    FROM fx_tag""",
)
def _(b: Base):
    return C.clean_tags(b.raw("member_tags_list"), X.AS_OF).select(
        "tag_id",
        "tag_name",
        "show_in_member_directory",
        "show_in_post_bio",
        "show_in_profile_page",
        "is_public",
        "tagged_members_count",
        "tag_category",
        "visible_beside_name",
        "course_name",
        "days_since_created",
        "created_date",
        "created_year",
        "created_month",
    )


FEED_COLUMNS = """'e' || event_id AS record_id, user_id, 'Member ' || user_id AS initiator_name,
           'Member' || user_id AS initiator_first_name, 'O''neil-Smith' AS initiator_last_name,
           'user' || user_id || '@example.com' AS initiator_email, (k % 2 = 0) AS initiator_is_admin,
           CAST(NULL AS BOOLEAN) AS initiator_is_moderator, ts AS created_at,
           ts + CASE WHEN event_id % 10 = 0 THEN INTERVAL 25 HOUR ELSE INTERVAL 1 HOUR END AS extracted_at"""
WHO = [
    "record_id",
    "initiator_name",
    "initiator_first_name",
    "initiator_last_name",
    "initiator_email",
    "initiator_is_admin",
    "initiator_is_moderator",
    "created_at",
]


def _who():
    return [*WHO, F.col("_airbyte_extracted_at").alias("extracted_at")]


@query(
    "clean_lessons",
    f"""
    SELECT {FEED_COLUMNS}, k AS lesson_id, k % 5 AS course_id, 'Space ' || (k % 5) AS course_name,
           'space-' || (k % 5) AS course_slug
    FROM fx_activity WHERE event_type = 'click'""",
)
def _(b: Base):
    return b.feeds["lessons"].select(
        *_who(), F.col("initiator_community_id").alias("user_id"), "lesson_id", "course_id", "course_name", "course_slug"
    )


@query(
    "clean_courses",
    """
    SELECT initiator_email, CAST(member AS VARCHAR) AS initiator_community_id, course_id, course_name,
           created_at, record_id FROM fx_first_course""",
)
def _(b: Base):
    return C.clean_courses(b.raw("course_completed")).select(
        "initiator_email", "initiator_community_id", "course_id", "course_name", "created_at", "record_id"
    )


COMMENT_COLUMNS = """event_id AS comment_id, CASE WHEN event_type <> 'signup' THEN user_id END AS comment_community_member_id,
           CASE WHEN k % 3 = 0 THEN event_id - 1 END AS parent_comment_id, k AS post_id, FALSE AS comment_owner_is_admin"""
COMMENT = [
    "comment_id",
    "comment_community_member_id",
    "parent_comment_id",
    "post_id",
    "comment_owner_is_admin",
]


@query(
    "clean_comments_created",
    f"""
    SELECT {FEED_COLUMNS}, {COMMENT_COLUMNS},
           CASE WHEN event_type = 'signup' THEN user_id END AS post_owner_community_member_id,
           CASE WHEN event_type = 'signup' THEN k END AS post_basic_id,
           CASE WHEN event_type = 'signup' THEN 'Post ' || k END AS post_name,
           CASE WHEN event_type = 'signup' THEN 'post-' || k END AS post_slug,
           CASE WHEN event_type = 'signup' THEN ts END AS post_published_at
    FROM fx_activity WHERE event_type IN ('signup', 'error')""",
)
def _(b: Base):
    return b.feeds["comments"].select(
        *_who(),
        F.col("initiator_community_id").alias("user_id"),
        *COMMENT,
        "post_owner_community_member_id",
        "post_basic_id",
        "post_name",
        "post_slug",
        "post_published_at",
    )


@query(
    "clean_post_likes",
    f"""
    SELECT {FEED_COLUMNS}, user_id AS post_owner_community_member_id, k AS post_id, 'Post ' || k AS post_name,
           k % 5 AS post_space_id, TRUE AS post_owner_is_admin, k % 5 AS space_id, 'Space ' || (k % 5) AS space_name
    FROM fx_activity WHERE event_type = 'purchase' AND event_id % 2 = 0""",
)
def _(b: Base):
    return b.feeds["post_likes"].select(
        *_who(),
        F.col("initiator_community_member_id").alias("user_id"),
        "post_owner_community_member_id",
        "post_id",
        "post_name",
        "post_space_id",
        "post_owner_is_admin",
        "space_id",
        "space_name",
    )


@query(
    "clean_comment_likes",
    f"""
    SELECT {FEED_COLUMNS}, {COMMENT_COLUMNS}, CAST(NULL AS BIGINT) AS post_owner_community_member_id
    FROM fx_activity WHERE event_type = 'purchase' AND event_id % 2 = 1""",
)
def _(b: Base):
    return b.feeds["comment_likes"].select(
        *_who(), F.col("initiator_community_member_id").alias("user_id"), *COMMENT, "post_owner_community_member_id"
    )


@query(
    "clean_attendees",
    """
    SELECT event_id AS attendee_record_id, k AS event_id, k + 1 AS contact_id, user_id AS community_member_id,
           'Member' || user_id || ' Anne-Marie' AS attendee_name, 'user' || user_id || '@example.com' AS attendee_email,
           'class ' || k AS event_name, CASE WHEN k % 4 = 0 THEN 'no' ELSE 'yes' END AS rsvp_status, ts AS rsvp_date
    FROM fx_activity WHERE event_type = 'view'""",
)
def _(b: Base):
    return b.feeds["attendees"].select(
        "attendee_record_id",
        "event_id",
        "contact_id",
        "community_member_id",
        "attendee_name",
        "attendee_email",
        "event_name",
        "rsvp_status",
        "rsvp_date",
    )


@query(
    "clean_events",
    r"""
    SELECT page_id AS event_id, 'host' || (page_id % 3) || '@example.com' AS host_email, url AS event_url,
           regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g') AS event_description,
           page_id % 4 AS space_id, 'Space ' || (page_id % 4) AS space_name, CAST(1 AS BIGINT) AS space_community_id,
           page_id % 5 AS topic_count,
           CASE WHEN page_id % 7 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id) END AS starts_at,
           TIMESTAMP '2024-01-01 01:30:00' + to_hours(page_id) AS ends_at,
           CASE WHEN page_id % 6 <> 0 THEN CAST(5400 AS BIGINT) ELSE 0 END AS duration_in_seconds,
           CASE WHEN page_id % 2 = 0 THEN page_id % 9 ELSE 0 END AS likes_count,
           CASE WHEN page_id % 3 = 0 THEN page_id % 11 ELSE 0 END AS comments_count,
           page_id % 2 = 0 AS rsvp_disabled, page_id % 6 = 0 AS send_email_reminder
    FROM pages""",
)
def _(b: Base):
    return C.clean_events(b.raw("events_list")).select(
        "event_id",
        "host_email",
        "event_url",
        "event_description",
        "space_id",
        "space_name",
        "space_community_id",
        "topic_count",
        "starts_at",
        "ends_at",
        "duration_in_seconds",
        "likes_count",
        "comments_count",
        "rsvp_disabled",
        "send_email_reminder",
    )


@query(
    "clean_invited_managers",
    """
    SELECT 'u' || s AS uid, manager_id, first_name, last_name, full_name AS manager_full_name, email AS manager_email,
           join_date, 'https://example.com/u/' || s AS profile_url, in_community AS member_in_community,
           invitation_status, invitation_date,
           CASE WHEN business IS NULL THEN 'Business|Pro' ELSE 'Business|' || business || '|Pro' END AS tag_names,
           business AS business_name_from_tags
    FROM fx_invited""",
)
def _(b: Base):
    return C.clean_invited_managers(b.raw("managers_not_joined")).withColumn("tag_names", F.array_join("tag_names", "|"))


@query(
    "clean_comments_full",
    r"""
    SELECT conv_id * 1000 + turn AS comment_id, conv_id % 50 AS author_community_member_id,
           'Member ' || (conv_id % 50) AS author_full_name, conv_id AS post_id, CAST(7 AS BIGINT) AS space_id,
           regexp_replace(regexp_replace('<p>' || text || '</p>', '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g') AS comment_text,
           made AS comment_created_at, conv_id % 3 AS comment_likes_count,
           CASE WHEN turn % 2 = 0 THEN turn ELSE 0 END AS replies_to_comment_count, CAST(0 AS BIGINT) AS authors_total_posts,
           CAST(made AS DATE) AS comment_date, CAST(strftime(made, '%U') AS BIGINT) AS comment_created_week,
           CAST(dayofweek(made) + 1 AS BIGINT) AS comment_created_day_of_week, CAST(hour(made) AS BIGINT) AS comment_created_hour,
           CAST(date_trunc('week', made) AS DATE) AS comment_created_week_start_date,
           CAST(date_trunc('month', made) AS DATE) AS comment_created_month_start_date,
           CASE WHEN turn > 0 THEN 'reply' ELSE 'top_level' END AS comment_type,
           CASE WHEN conv_id % 3 > 0 AND turn % 2 = 0 AND turn > 0 THEN 'highly_engaged' WHEN conv_id % 3 > 0 THEN 'liked'
                WHEN turn % 2 = 0 AND turn > 0 THEN 'replied' ELSE 'no_engagement' END AS engagement_level,
           CASE WHEN conv_id % 70 > 50 THEN 'power_commenter' WHEN conv_id % 70 > 20 THEN 'active_commenter'
                WHEN conv_id % 70 > 5 THEN 'regular_commenter' WHEN conv_id % 70 > 0 THEN 'new_commenter'
                ELSE 'unknown' END AS commenter_level
    FROM (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_hours(conv_id) AS made FROM conversations)""",
)
def _(b: Base):
    return C.clean_comments_full(b.raw("comments")).select(
        "comment_id",
        "author_community_member_id",
        "author_full_name",
        "post_id",
        "space_id",
        "comment_text",
        "comment_created_at",
        "comment_likes_count",
        "replies_to_comment_count",
        "authors_total_posts",
        "comment_date",
        "comment_created_week",
        "comment_created_day_of_week",
        "comment_created_hour",
        "comment_created_week_start_date",
        "comment_created_month_start_date",
        "comment_type",
        "engagement_level",
        "commenter_level",
    )


# --- metrics -----------------------------------------------------------------


def _weekly_sql(metric: str, out: str) -> str:
    return f"SELECT m AS community_member_id, wk AS week_start_date, n AS {out} FROM fx_weekly WHERE metric = '{metric}'"


@query("weekly_live_classes", _weekly_sql("classes_attended", "live_classes_attended"))
def _(b: Base):
    return M.live_classes(b.feeds["attendees"])


@query("weekly_lessons", _weekly_sql("lessons_completed", "lessons_completed"))
def _(b: Base):
    return M.lessons(b.feeds["lessons"])


@query("weekly_likes", _weekly_sql("likes_received", "likes_received"))
def _(b: Base):
    return M.likes(b.feeds["post_likes"], b.feeds["comment_likes"])


@query("weekly_comments_received", _weekly_sql("comments_received", "comments_received"))
def _(b: Base):
    return M.comments_received(b.feeds["comments"])


@query("weekly_comments_made", _weekly_sql("comments_made", "comments_made"))
def _(b: Base):
    return M.comments_made(b.feeds["comments"])


@query(
    "monthly_courses",
    """
    SELECT member AS community_member_id, CAST(date_trunc('month', created_at) AS DATE) AS month_start_date,
           COUNT(DISTINCT course_id) AS courses_completed_count,
           string_agg(course_id, '|' ORDER BY course_id) AS course_ids_completed,
           string_agg(course_name, '|' ORDER BY course_id) AS course_names_completed,
           MIN(created_at) AS first_completion_in_month, MAX(created_at) AS last_completion_in_month
    FROM fx_first_course GROUP BY 1, 2""",
)
def _(b: Base):
    return M.monthly_courses(b.courses).withColumns(
        {c: F.array_join(c, "|") for c in ("course_ids_completed", "course_names_completed")}
    )


ENGAGEMENT_SQL = "SELECT *, FALSE AS is_backfill FROM fx_engagement"


@query("member_engagement_full", ENGAGEMENT_SQL)
def _(b: Base):
    return E.engagement_full(b.people, b.weekly)


# --- relations ---------------------------------------------------------------


@query(
    "business_names",
    """
    SELECT CAST(tag_id AS BIGINT) AS tag_id, business_name, members AS actual_member_count, CAST(age * 10 AS BIGINT) AS api_member_count,
           on_profile AS visible_beside_name, on_profile AS is_public, CAST(30 + age * 20 AS BIGINT) AS days_since_created,
           confidence AS confidence_level, FALSE AS has_corporate_suffix,
           row_number() OVER (ORDER BY members DESC, age, tag_id) AS business_rank, size AS business_size,
           CASE WHEN 30 + age * 20 <= 30 THEN 'newly_added' WHEN 30 + age * 20 <= 90 THEN 'recent'
                WHEN 30 + age * 20 <= 365 THEN 'established' ELSE 'long_term' END AS business_age_category
    FROM fx_business""",
)
def _(b: Base):
    return B.business_names(b.tags, b.members).drop("created_at", "updated_at")


@query(
    "business_relationships",
    """
    SELECT *, CASE WHEN member_community_id IS NULL THEN NULL ELSE 'complete' END AS member_profile_completeness,
           CASE WHEN member_community_id IS NULL THEN 'manager_only' ELSE 'has_team' END AS relationship_type
    FROM fx_relation""",
)
def _(b: Base):
    return B.business_relationships(b.mapping, b.members, b.tags)


@query(
    "businesses_without_managers",
    """
    SELECT CAST(b.tag_id AS BIGINT) AS business_tag_id, b.business_name, b.members AS actual_member_count, b.size AS business_size,
           b.confidence AS confidence_level, FALSE AS has_corporate_suffix,
           b.business_rank, CAST(30 + b.age * 20 AS BIGINT) AS days_since_created,
           'Add Manager tag to at least one member from: ' || COALESCE(
               string_agg(t.email, ', ' ORDER BY t.email), 'NO MEMBERS FOUND') AS action_needed
    FROM (SELECT *, row_number() OVER (ORDER BY members DESC, age, tag_id) AS business_rank FROM fx_business) b
    LEFT JOIN fx_member_tag t ON t.tag_id = b.tag_id AND NOT t.is_manager
    WHERE b.tag_id NOT IN (SELECT tag_id FROM fx_assignment)
    GROUP BY b.tag_id, b.business_name, b.members, b.size, b.confidence, b.business_rank, b.age""",
)
def _(b: Base):
    return B.businesses_without_managers(b.businesses, b.mapping, b.members, b.tags).select(
        "business_tag_id",
        "business_name",
        "actual_member_count",
        "business_size",
        "confidence_level",
        "has_corporate_suffix",
        "business_rank",
        "days_since_created",
        "action_needed",
    )


# --- reports -----------------------------------------------------------------


@query(
    "team_engagement",
    """
    SELECT * EXCLUDE (team_size), classes_attended + lessons_completed + likes_received + comments_received
           + comments_made AS total_engagement_score FROM fx_team""",
)
def _(b: Base):
    return T.team_engagement(b.mapping, b.members, b.tags, b.engagement, X.AS_OF).drop("previous")


@query("manager_rankings", "SELECT * FROM fx_ranking")
def _(b: Base):
    return T.manager_rankings(b.mapping, b.member_rows).pairs()


@query(
    "manager_rankings_per_business",
    """
    SELECT manager_email, business_name, member_community_id, total_points, points_change,
           row_number() OVER (PARTITION BY manager_email, business_name ORDER BY total_points DESC, member_full_name, member_community_id NULLS FIRST) AS performance_rank,
           s.team_size, s.active_members, s.team_total_points
    FROM fx_compared c JOIN (SELECT * RENAME (summary_business AS business_name) FROM fx_summary) s USING (manager_email, business_name)""",
)
def _(b: Base):
    return T.manager_rankings(b.mapping, b.member_rows, per_business=True).pairs().select(
        "manager_email",
        "business_name",
        "member_community_id",
        "total_points",
        "points_change",
        "performance_rank",
        "team_size",
        "active_members",
        "team_total_points",
    )


@query(
    "manager_report_nested",
    """
    SELECT t.manager_email, t.manager_full_name AS manager_name, t.business_name, t.week_start_date, t.week_end_date,
           string_agg(t.member_full_name || ':' || t.total_events, '|' ORDER BY t.total_events DESC, t.member_email NULLS FIRST, t.member_community_id NULLS FIRST) AS team_members,
           COALESCE(MAX(s.team_size), COUNT(*)) AS team_size,
           COALESCE(MAX(s.business_total_members), COUNT(*)) AS business_total_members,
           CAST(SUM(t.classes_attended) AS BIGINT) AS total_classes_attended,
           CAST(SUM(t.lessons_completed) AS BIGINT) AS total_lessons_completed,
           CAST(SUM(t.likes_received) AS BIGINT) AS total_likes_received,
           CAST(SUM(t.comments_received) AS BIGINT) AS total_comments_received,
           CAST(SUM(t.comments_made) AS BIGINT) AS total_comments_made,
           CAST(SUM(t.total_events) AS BIGINT) AS team_total_engagement_score,
           round(AVG(t.total_events), 2) AS avg_engagement_score_per_member
    FROM fx_compared t LEFT JOIN fx_stats s USING (manager_email, business_name)
    GROUP BY t.manager_email, t.manager_full_name, t.business_name, t.week_start_date, t.week_end_date""",
)
def _(b: Base):
    line = F.transform(
        "team_members", lambda m: F.concat(m["member_name"], F.lit(":"), m["total_engagement_score"].cast("string"))
    )
    # one text per team, not per manager
    as_text = lambda report: report.withColumn("team_members", F.array_join(line, "|"))
    return T.manager_report_nested(b.mapping, b.member_rows, as_text)


@query("team_detail", "SELECT * FROM fx_detail")
def _(b: Base):
    return T.team_detail(b.mapping, b.member_rows).pairs()


# --- exports -----------------------------------------------------------------

HEADER = """manager_email, manager_full_name, business_name, week_start_date, week_end_date, week_start_formatted,
           week_end_formatted"""


@query(
    "export_manager_list",
    f"""
    SELECT DISTINCT {HEADER}, manager_first_name, manager_last_name, team_size, active_members, inactive_members,
           team_total_points, team_avg_points, team_max_points, team_points_change, team_avg_points_change,
           team_classes_attended, team_lessons_completed, team_likes_received, team_comments_received, team_comments_made,
           (SELECT COUNT(*) FROM fx_ranking s WHERE s.manager_email = r.manager_email AND s.is_top_performer) AS count_top_performers,
           (SELECT COUNT(*) FROM fx_ranking s WHERE s.manager_email = r.manager_email AND s.is_top_mover) AS count_top_movers,
           (SELECT COUNT(*) FROM fx_ranking s WHERE s.manager_email = r.manager_email AND s.suggested_action IS NOT NULL) AS count_action_items
    FROM fx_ranking r""",
)
def _(b: Base):
    return XP.manager_list(b.ranked)


def _nth(flag: str, rank: str, k: int, col: str, name: str) -> str:
    return f"MAX(CASE WHEN {flag} AND {rank} = {k} THEN {col} END) AS {name}"


PERFORMERS = ", ".join(
    _nth("is_top_performer", "performance_rank", k, c, f"top_performer_{k}_{n}")
    for k in (1, 2, 3)
    for c, n in (("member_full_name", "name"), ("total_points", "score"))
)


def _performer_item(k: int, medal: str) -> str:
    return f"'<li>{medal} <strong>' || top_performer_{k}_name || '</strong> — ' || top_performer_{k}_score || ' pts</li>'"


TOP_PERFORMERS_SQL = f"""
    SELECT *, CASE count_top_performers
               WHEN 0 THEN '<li>No top performers this week.</li>' WHEN 1 THEN {_performer_item(1, '🥇')}
               WHEN 2 THEN {_performer_item(1, '🥇')} || {_performer_item(2, '🥈')}
               ELSE {_performer_item(1, '🥇')} || {_performer_item(2, '🥈')} || {_performer_item(3, '🥉')} END AS top_performers_html
    FROM (SELECT DISTINCT {HEADER} FROM fx_ranking) h
    JOIN (SELECT manager_email, COUNT(*) FILTER (WHERE is_top_performer) AS count_top_performers, {PERFORMERS}
          FROM fx_ranking GROUP BY manager_email) t USING (manager_email)"""


@query("export_top_performers", TOP_PERFORMERS_SQL)
def _(b: Base):
    return XP.top_performers(b.ranked)


MOVERS = ", ".join(
    _nth("is_top_mover", "mover_rank", k, c, f"top_mover_{k}_{n}")
    for k in (1, 2, 3)
    for c, n in (("member_full_name", "name"), ("points_change", "change"), ("previous_week_points", "prev_points"))
)


def _mover_item(k: int, sign: str) -> str:
    return f"""'<li>{sign} <strong>' || top_mover_{k}_name || '</strong> — +' || top_mover_{k}_change || ' pts (' ||
        CASE WHEN top_mover_{k}_prev_points = 0 OR top_mover_{k}_change * 2 >= top_mover_{k}_prev_points
             THEN 'strong jump this week' ELSE 'steady progress' END || ')</li>'"""


TOP_MOVERS_SQL = f"""
    SELECT * EXCLUDE (performers, top_mover_3_prev_points),
           CASE WHEN count_movers = 0 AND performers > 0
                THEN 'Your top performers did well, but their points stayed flat or dropped compared with last week.'
                ELSE '' END AS top_movers_context_note,
           CASE count_movers WHEN 0 THEN '<li>No top movers this week.</li>' WHEN 1 THEN {_mover_item(1, '🚀')}
               WHEN 2 THEN {_mover_item(1, '🚀')} || {_mover_item(2, '📈')}
               ELSE {_mover_item(1, '🚀')} || {_mover_item(2, '📈')} || {_mover_item(3, '⬆️')} END AS top_movers_html
    FROM (SELECT DISTINCT {HEADER} FROM fx_ranking) h
    JOIN (SELECT manager_email, COUNT(*) FILTER (WHERE is_top_mover) AS count_movers,
                 COUNT(*) FILTER (WHERE is_top_performer) AS performers, {MOVERS}
          FROM fx_ranking GROUP BY manager_email) t USING (manager_email)"""


@query("export_top_movers", TOP_MOVERS_SQL)
def _(b: Base):
    return XP.top_movers(b.ranked)


PICKS = """
    (SELECT DISTINCT ON (manager_email) manager_email, member_first_name AS c_first, member_full_name AS c_full, total_points AS c_points
     FROM fx_ranking WHERE performance_rank = 1 AND total_points > 0 ORDER BY manager_email) c USING (manager_email)
    LEFT JOIN (SELECT * FROM (SELECT manager_email, member_first_name AS e_first, member_full_name AS e_full,
                      previous_week_points AS e_prev, points_change AS e_change,
                      row_number() OVER (PARTITION BY manager_email ORDER BY mover_rank) AS e_rn
               FROM fx_ranking WHERE points_change > 0) WHERE e_rn = 1) e USING (manager_email)
    LEFT JOIN (SELECT * FROM (SELECT manager_email, member_first_name AS r_first, member_full_name AS r_full,
                      row_number() OVER (PARTITION BY manager_email ORDER BY member_full_name, member_community_id NULLS FIRST) AS r_rn
               FROM fx_ranking WHERE total_points = 0 AND previous_week_points = 0) WHERE r_rn = 1) r USING (manager_email)"""
GROWTH = "CASE WHEN e_full IS NULL THEN NULL WHEN e_prev = 0 OR e_change * 2 >= e_prev THEN 'strong jump this week' ELSE 'steady progress' END"
ACTION_POINTS_SQL = f"""
    SELECT {HEADER}, CAST(weekofyear(week_start_date) AS BIGINT) AS week_number, CAST(year(week_start_date) AS BIGINT) AS year,
           c_full AS celebrate_member_name, c_first AS celebrate_member_first_name, e_full AS encourage_member_name,
           e_first AS encourage_member_first_name, e_prev AS encourage_prev_points, e_change AS encourage_points_change,
           {GROWTH} AS encourage_label, r_full AS reengage_member_name, r_first AS reengage_member_first_name,
           COALESCE('<li>🏆 Celebrate ' || c_first || ' for leading this week.</li>', '') || '<li>📈 ' ||
           COALESCE('Encourage ' || e_first || ' to keep momentum (+' || e_change || ' pts, ' || {GROWTH} || ').',
                    'Encourage your team to build momentum next week.') || '</li><li>💬 ' ||
           COALESCE('Re-engage ' || r_first || ' with a short lesson or live class invite.',
                    'Great job: no fully inactive members to re-engage this week.') || '</li>' AS action_points_html
    FROM (SELECT DISTINCT {HEADER} FROM fx_ranking) h LEFT JOIN {PICKS}"""


@query("export_action_points", ACTION_POINTS_SQL)
def _(b: Base):
    return XP.action_points(b.ranked)


DRIVER = """CASE WHEN l > 0 AND s > 0 AND l >= c AND s >= c THEN 'more lessons + engagement'
                 WHEN l > 0 AND l >= c AND l >= s THEN 'more lessons' WHEN c > 0 AND c >= l AND c >= s THEN 'more live classes'
                 WHEN s > 0 THEN 'higher engagement' WHEN previous_week_points = 0 OR points_change * 2 >= previous_week_points
                 THEN 'strong jump this week' ELSE 'steady growth' END"""
PDF_MOVERS = """CASE WHEN COALESCE(count_top_movers, 0) = 0 THEN '<p>No top movers this week.</p>' ELSE '<ul>' || lines || '</ul>' END"""
PDF_ACTIONS = """'<ul>' || COALESCE('<li>🎉 <strong>Recognize ' || c_first || '</strong> – steady performance across lessons, classes, and community.</li>',
               '<li>🎉 <strong>No recognition this week</strong> – no top performer recorded.</li>') ||
           COALESCE('<li>👏 <strong>Encourage ' || top_mover_1_first_name || '</strong> – ' ||
               CASE top_mover_1_jump_label WHEN 'strong jump this week' THEN 'noticeable jump this week, keep building.'
               ELSE 'steady growth this week, keep building.' END || '</li>',
               '<li>👏 <strong>Encourage team</strong> – no notable jump this week; focus on small wins.</li>') ||
           COALESCE('<li>🕊️ <strong>Support ' || r_first || '</strong> – very low engagement; suggest a quick lesson or invite to the next live class.</li>',
               '<li>🕊️ <strong>No low-engagement member flagged</strong> – everyone showed some momentum this week.</li>') || '</ul>'"""
PDF_SQL = f"""
    SELECT {HEADER}, CAST(weekofyear(week_start_date) AS BIGINT) AS week_number, CAST(year(week_start_date) AS BIGINT) AS year,
           c_full AS top_performer_name, c_points AS top_performer_points, count_top_movers, top_mover_1_first_name,
           top_mover_1_jump_label, r_full AS reengage_member_name, {PDF_MOVERS} AS top_movers_html,
           {PDF_ACTIONS} AS suggested_actions_html, {PDF_MOVERS} || {PDF_ACTIONS} AS pdf_summary_html
    FROM (SELECT DISTINCT {HEADER} FROM fx_ranking) h LEFT JOIN {PICKS}
    LEFT JOIN (SELECT manager_email, COUNT(*) AS count_top_movers,
                      string_agg('<li>' || member_full_name || ' — +' || points_change || ' pts (' || {DRIVER} || ')</li>', '' ORDER BY mover_rank) AS lines,
                      MAX(CASE WHEN mover_rank = 1 THEN member_first_name END) AS top_mover_1_first_name,
                      MAX(CASE WHEN mover_rank = 1 THEN CASE WHEN previous_week_points = 0 OR points_change * 2 >= previous_week_points
                               THEN 'strong jump this week' ELSE 'steady growth' END END) AS top_mover_1_jump_label
               FROM (SELECT *, lessons_completed AS l, classes_attended AS c, likes_received + comments_received + comments_made AS s
                     FROM fx_ranking WHERE is_top_mover)
               GROUP BY manager_email) m USING (manager_email)"""


@query("export_pdf_blocks", PDF_SQL)
def _(b: Base):
    return XP.pdf_blocks(b.ranked)


@query("export_team_detail", f"SELECT {', '.join(XP.DETAIL_COLUMNS)} FROM fx_detail")
def _(b: Base):
    return XP.team_detail_export(b.detailed)


@query(
    "export_summary",
    f"""
    SELECT {HEADER}, CAST(strftime(week_start_date, '%U') AS BIGINT) AS week_number,
           CAST(year(week_start_date) AS BIGINT) AS year, COUNT(DISTINCT team_member) AS total_team_members,
           COUNT(DISTINCT CASE WHEN has_activity THEN team_member END) AS active_members,
           COUNT(DISTINCT CASE WHEN NOT has_activity THEN team_member END) AS inactive_members,
           CAST(SUM(week_total_engagement) AS BIGINT) AS team_total_score,
           CAST(SUM(previous_week_engagement) AS BIGINT) AS team_previous_score,
           CAST(SUM(total_engagement_change) AS BIGINT) AS team_score_change,
           round(AVG(week_total_engagement), 1) AS avg_score_per_member
    FROM fx_detail GROUP BY {HEADER}""",
)
def _(b: Base):
    return T.summary_export(b.mapping, b.member_rows)


@query(
    "export_top3",
    """
    SELECT manager_email, manager_full_name, business_name, week_start_date, week_end_date, rank, team_member AS name,
           week_total_engagement AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY manager_email
              ORDER BY week_total_engagement DESC, team_member, member_community_id NULLS FIRST, business_name) AS rank FROM fx_detail)
    WHERE rank <= 3""",
)
def _(b: Base):
    return XP.top3_export(b.detailed)


CELL = "padding:10px 12px;border:1px solid #ddd;color:#000000;background-color:#ffffff;"
HEAD = "padding:10px 12px;border:1px solid #000000;color:#ffffff;text-align:{};background:#000000;"
MONTH_DONE = """
    SELECT DISTINCT member, course_name FROM fx_first_course
    WHERE date_trunc('month', created_at) = (SELECT date_trunc('month', MAX(created_at)) FROM fx_first_course)"""
COUNTS_SQL = f"""
    SELECT r.manager_email, r.business_name, d.course_name, COUNT(*) AS completed_count,
           string_agg(r.member_full_name, ', ' ORDER BY r.member_full_name, r.member_community_id) AS completed_by_names
    FROM fx_relation r JOIN ({MONTH_DONE}) d ON d.member = r.member_community_id
    GROUP BY r.manager_email, r.business_name, d.course_name"""
STATUS_SQL = f"""
    SELECT r.manager_email, r.business_name, r.member_community_id, r.member_full_name,
           COUNT(DISTINCT d.course_name) AS member_completion_count
    FROM fx_relation r LEFT JOIN ({MONTH_DONE}) d ON d.member = r.member_community_id
    WHERE r.member_community_id IS NOT NULL
    GROUP BY r.manager_email, r.business_name, r.member_community_id, r.member_full_name"""
EMPTY_ROW = '<tr><td style="padding:10px 12px;border:1px solid #2f3542;color:#94a3b8;" colspan="3">No course completions this month.</td></tr>'
EMPTY_TABLE_ROW = f'<tr><td style="{CELL}" colspan="3">No course completions this month.</td></tr>'
TABLE_OPEN = (
    '<table style="width:100%;border-collapse:collapse;background-color:#ffffff;font-family:Arial,sans-serif;font-size:14px;"><thead><tr>'
    + "".join(
        f'<th style="{HEAD.format(a)}">{t}</th>' for t, a in (("Course", "left"), ("#", "center"), ("Completed by", "left"))
    )
    + "</tr></thead><tbody>"
)
MONTHLY_SQL = f"""
    SELECT m.manager_email, m.manager_full_name, m.business_name,
           (SELECT CAST(date_trunc('month', MAX(created_at)) AS DATE) FROM fx_first_course) AS report_month_start_date,
           (SELECT strftime(MAX(created_at), '%B %Y') FROM fx_first_course) AS report_month_formatted,
           COALESCE(c.courses, 0) AS total_distinct_courses, COALESCE(c.completions, 0) AS total_course_completions,
           COALESCE(t.team_size, 0) AS team_size, COALESCE(t.learners, 0) AS unique_learners_count,
           COALESCE(t.zero_names, 'None 🎉') AS zero_completions_members_list,
           COALESCE(c.html, '{EMPTY_ROW}') AS courses_completed_rows_html,
           '{TABLE_OPEN}' || COALESCE(c.html, '{EMPTY_TABLE_ROW}') || '</tbody></table>' AS courses_completed_table_html
    FROM (SELECT DISTINCT manager_email, manager_full_name, business_name FROM fx_relation) m
    LEFT JOIN (SELECT manager_email, business_name, COUNT(*) AS courses, CAST(SUM(completed_count) AS BIGINT) AS completions,
                      string_agg(row_html, '' ORDER BY completed_count DESC, row_html) AS html
               FROM (SELECT *, '<tr><td style="{CELL}">' || course_name || '</td><td style="{CELL}text-align:center;">' || completed_count
                            || '</td><td style="{CELL}">' || completed_by_names || '</td></tr>' AS row_html FROM ({COUNTS_SQL}))
               GROUP BY manager_email, business_name) c USING (manager_email, business_name)
    LEFT JOIN (SELECT manager_email, business_name, COUNT(DISTINCT member_community_id) AS team_size,
                      COUNT(*) FILTER (WHERE member_completion_count > 0) AS learners,
                      string_agg(CASE WHEN member_completion_count = 0 THEN member_full_name END, ', ' ORDER BY member_full_name, member_community_id) AS zero_names
               FROM ({STATUS_SQL}) GROUP BY manager_email, business_name) t USING (manager_email, business_name)"""


@query("export_monthly_courses", MONTHLY_SQL)
def _(b: Base):
    return T.per_team_report(b.mapping, b.members, b.tags, lambda pairs: MO.monthly_report(b.courses, pairs))


@query(
    "delivery_log",
    """
    SELECT DISTINCT manager_email, manager_full_name, business_name, 'weekly' AS report_type, week_start_date,
           TIMESTAMP '2024-01-31 08:00:00' AS sent_at, 'sent' AS delivery_status, TRUE AS has_id
    FROM fx_ranking""",
)
def _(b: Base):
    sent = XP.manager_weeks(b.ranked).select(
        "manager_email",
        "manager_full_name",
        "business_name",
        "week_start_date",
        F.lit("weekly").alias("report_type"),
        F.lit("2024-01-31 08:00:00").cast("timestamp").alias("sent_at"),
        F.lit("sent").alias("delivery_status"),
    )
    log = delivery.append_log(sent, b.path("delivery_log"))
    return log.select(
        "manager_email",
        "manager_full_name",
        "business_name",
        "report_type",
        "week_start_date",
        "sent_at",
        "delivery_status",
        F.col("delivery_id").isNotNull().alias("has_id"),
    )
