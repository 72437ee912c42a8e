"""Scalar functions, predicates and labels over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from teampulse.catalog import fixtures as X
from teampulse.catalog.base import Base, query
from teampulse.functions import dates as D
from teampulse.functions import html as H
from teampulse.functions import json as J
from teampulse.functions import rules as R
from teampulse.functions import safe as N
from teampulse.functions import text as T
from teampulse.operators import joins

# --- text -----------------------------------------------------------------------


@query("str_clean_email", "SELECT community_member_id, email FROM fx_member")
def _(b: Base):
    return b.raw("community_members").select("community_member_id", T.clean_email("email").alias("email"))


@query(
    "str_initcap",
    r"""
    SELECT page_id, array_to_string(list_transform(
        regexp_extract_all(lower(url), '[\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+-]+|[^\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+-]+'),
        lambda w: upper(w[1:1]) || w[2:]), '') AS title
    FROM pages""",
)
def _(b: Base):
    return b.table("pages").select("page_id", T.initcap_words("url").alias("title"))


@query(
    "str_full_name",
    """
    SELECT s AS id, full_name, full_name AS shown, first_name || ' ' || last_name AS strict FROM fx_invited""",
)
def _(b: Base):
    return b.invited.select(
        F.substr("uid", F.lit(2)).cast("bigint").alias("id"),
        T.full_name("first_name", "last_name").alias("full_name"),
        T.display_name("first_name", "last_name").alias("shown"),
        F.concat("first_name", F.lit(" "), "last_name").alias("strict"),
    )


@query(
    "html_strip",
    r"""SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g') AS words FROM pages""",
)
def _(b: Base):
    return b.table("pages").select("page_id", T.strip_html("html").alias("words"))


@query(
    "html_escape",
    "SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS safe FROM documents",
)
def _(b: Base):
    return b.table("documents").select("doc_id", T.escape_html("text").alias("safe"))


@query(
    "tag_course_name",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS course FROM orders""",
)
def _(b: Base):
    style = F.when(F.col("o_orderkey") % 3 == 0, "Completed -  ").when(F.col("o_orderkey") % 3 == 1, "complete - ")
    name = F.concat(F.coalesce(style, F.lit("")), F.col("o_orderpriority"), F.lit(" "))
    return b.table("orders").select("o_orderkey", R.tag_course(name).alias("course"))


@query(
    "parse_quoted_tags",
    r"""
    SELECT page_id, len(items) AS n, array_to_string(items, '|') AS items
    FROM (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '"([^"]+)"', 1),
                 lambda t: regexp_replace(t, '^\s+|\s+$', '', 'g')), lambda t: t <> '') AS items FROM pages)""",
)
def _(b: Base):
    items = T.quoted_items("html")
    return b.table("pages").select(
        "page_id", F.size(items).cast("bigint").alias("n"), F.array_join(items, "|").alias("items")
    )


@query(
    "array_top1",
    r"""
    SELECT page_id, (SELECT t FROM (SELECT unnest(list_transform(regexp_extract_all(html, '"([^"]+)"', 1),
                            lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))) AS t)
                     WHERE t <> '' AND lower(t) NOT IN ('business', 'manager', 'pro', 'basic', 'individual', 'partner',
                           'source is thinkific', 'checklist completed', 'ac - master list import')
                       AND lower(t) NOT LIKE 'completed -%' AND lower(t) NOT LIKE 'cancel confirmed%' AND lower(t) NOT LIKE '%cancelled%'
                     ORDER BY length(t) DESC, t LIMIT 1) AS longest
    FROM pages""",
)
def _(b: Base):
    return b.table("pages").select("page_id", R.roster_business(T.quoted_items("html")).alias("longest"))


@query(
    "corporate_suffix",
    r"""
    SELECT doc_id, regexp_matches(text, '(?i)(Inc|LLC|Ltd|Corporation|Corp|Company|Co\.|Group|Industries|International|Solutions|Technologies|Tech|Systems|Services)') AS corporate
    FROM documents""",
)
def _(b: Base):
    return b.table("documents").select("doc_id", R.looks_corporate("text").alias("corporate"))


# --- calendar ---------------------------------------------------------------------


def _ts(b: Base):
    return b.table("events").withColumn("ts", F.col("ts").cast("timestamp"))


def _orders(b: Base):
    return b.table("orders").withColumn("d", F.to_date("o_orderdate"))


@query("week_start", "SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week_start_date FROM events")
def _(b: Base):
    return _ts(b).select("event_id", D.week_start("ts").alias("week_start_date"))


@query("month_start", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start_date FROM orders")
def _(b: Base):
    return _orders(b).select("o_orderkey", D.month_start("d").alias("month_start_date"))


@query(
    "date_arith",
    """
    SELECT o_orderkey, CAST(d + 6 AS DATE) AS week_end, CAST(d - 28 AS DATE) AS four_weeks_back,
           CAST(d - INTERVAL 1 MONTH AS DATE) AS month_back, CAST(d - 7 AS DATE) AS week_back,
           o_orderdate - INTERVAL 1 DAY AS day_back
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _(b: Base):
    return _orders(b).select(
        "o_orderkey",
        D.week_end("d").alias("week_end"),
        F.date_sub("d", 28).alias("four_weeks_back"),
        F.add_months("d", -1).alias("month_back"),
        F.date_sub("d", 7).alias("week_back"),
        (F.col("o_orderdate").cast("timestamp") - F.expr("INTERVAL 1 DAY")).alias("day_back"),
    )


@query("days_since", "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-01-31') AS days FROM orders")
def _(b: Base):
    return _orders(b).select("o_orderkey", D.days_since("d", X.AS_OF).alias("days"))


@query(
    "date_parts",
    """
    SELECT event_id, CAST(weekofyear(ts) AS BIGINT) AS iso_week, CAST(year(ts) AS BIGINT) AS y, CAST(month(ts) AS BIGINT) AS m,
           CAST(hour(ts) AS BIGINT) AS h FROM events""",
)
def _(b: Base):
    return _ts(b).select(
        "event_id",
        D.iso_week("ts").alias("iso_week"),
        F.year("ts").cast("bigint").alias("y"),
        F.month("ts").cast("bigint").alias("m"),
        F.hour("ts").cast("bigint").alias("h"),
    )


@query(
    "week_of_year_sunday",
    """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%U') AS BIGINT) AS week_number, CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS weekday
    FROM orders""",
)
def _(b: Base):
    return _orders(b).select(
        "o_orderkey", D.sunday_week("d").alias("week_number"), F.dayofweek("d").cast("bigint").alias("weekday")
    )


@query(
    "date_format",
    "SELECT o_orderkey, strftime(o_orderdate, '%B %d, %Y') AS long_date, strftime(o_orderdate, '%B %Y') AS month_name FROM orders",
)
def _(b: Base):
    return _orders(b).select("o_orderkey", D.long_date("d").alias("long_date"), D.month_label("d").alias("month_name"))


@query("parse_ts_strict", "SELECT event_id, ts AS parsed FROM events")
def _(b: Base):
    text = F.date_format(F.col("ts"), X.ISO)
    return _ts(b).select("event_id", D.parse_utc_strict(text).alias("parsed"))


@query(
    "ts_multi_format",
    """
    SELECT event_id, CASE WHEN event_id % 6 IN (0, 3) THEN ts WHEN event_id % 6 IN (1, 4) THEN date_trunc('second', ts)
           WHEN event_id % 6 = 2 THEN date_trunc('millisecond', ts) END AS parsed FROM events""",
)
def _(b: Base):
    e, ts = F.col("event_id") % 6, F.col("ts")
    forms = {0: "ss.SSSSSSXXX", 1: "ssXXX", 2: "ss.SSSXX", 3: "ss.SSSSSSXX", 4: "ssXX"}
    text = F.date_format(ts, "dd/MM/yyyy")
    for k, form in forms.items():
        # a zero offset is written as digits too, not as a letter only
        written = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:" + form)
        digits = F.regexp_replace(written, "Z$", "+00:00" if form.endswith("XXX") else "+0000")
        text = F.when(e == k, digits).otherwise(text)
    return _ts(b).select("event_id", D.parse_cursor(text).alias("parsed"))


@query(
    "date_spine",
    """
    SELECT community_member_id, CAST(unnest(generate_series(date_trunc('week', joined_at), TIMESTAMP '2024-01-15', INTERVAL 7 DAY)) AS DATE) AS week_start_date
    FROM fx_member""",
)
def _(b: Base):
    weeks = D.weeks_between(D.week_start("user_profile_created_at"), F.lit(dt.date(2024, 1, 15)))
    return b.members.select("community_member_id", F.explode(weeks).alias("week_start_date"))


# --- casts, numbers, JSON -----------------------------------------------------------


@query(
    "safe_cast",
    """
    SELECT event_id, CAST(NULL AS BIGINT) AS whole, CASE WHEN k % 3 = 0 THEN k END AS number,
           CASE WHEN k % 2 = 0 THEN TRUE WHEN k % 2 = 1 AND k % 5 = 0 THEN FALSE END AS flag,
           CASE WHEN k % 4 <> 0 THEN ts END AS at
    FROM fx_activity""",
)
def _(b: Base):
    k, txt = F.col("k"), F.col("k").cast("string")
    number = F.when(k % 3 == 0, txt).when(k % 3 == 1, F.concat(txt, F.lit(".0"))).otherwise(F.concat(txt, F.lit("x")))
    flag = F.when(k % 2 == 0, "True").when(k % 5 == 0, "false").otherwise("yes")
    at = F.when(k % 4 == 0, F.lit("soon")).otherwise(F.date_format("ts", X.ISO))
    return b.raw("activity").select(
        "event_id",
        N.to_long("props").alias("whole"),
        N.to_long(number).alias("number"),
        N.to_bool(flag).alias("flag"),
        N.to_ts(at).alias("at"),
    )


@query(
    "parse_tristate",
    """
    SELECT s AS id, in_community AS flag FROM fx_invited""",
)
def _(b: Base):
    rows = b.raw("managers_not_joined")
    return rows.select(F.substr("uid", F.lit(2)).cast("bigint").alias("id"), N.yes_no("member__y_n_").alias("flag"))


@query(
    "safe_divide",
    """
    SELECT event_id, CASE WHEN k % 4 <> 0 THEN CAST(k AS DOUBLE) / (k % 4) END AS quotient FROM fx_activity""",
)
def _(b: Base):
    return b.raw("activity").select("event_id", N.ratio("k", F.col("k") % 4).alias("quotient"))


@query(
    "json_extract",
    """
    SELECT event_id, k AS number, CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS VARCHAR) AS nested,
           'member ' || user_id AS name
    FROM fx_activity""",
)
def _(b: Base):
    doc = b.raw("activity")
    payload = X._payload(F.col("event_type"))
    return doc.withColumn("payload", payload).select(
        "event_id",
        N.to_long(J.json_scalar("props", "$.k")).alias("number"),
        J.json_scalar("props", "$.missing").alias("missing"),
        J.json_scalar("payload", "$.initiator").alias("nested"),
        J.json_scalar("payload", "$.initiator.name").alias("name"),
    )


@query(
    "json_type_guard",
    """
    SELECT community_member_id, community_member_id % 3 = 0 AS tags_is_array, community_member_id % 3 = 1 AS tags_is_object FROM fx_member""",
)
def _(b: Base):
    k = F.col("community_member_id").cast("bigint") % 3
    tags = F.when(k == 0, F.col("member_tags")).when(k == 1, '{"tags": [1]}').otherwise("7")
    return b.raw("community_members").withColumn("member_tags", tags).select(
        "community_member_id",
        J.is_json_array("member_tags").alias("tags_is_array"),
        J.is_json_object("member_tags").alias("tags_is_object"),
    )


@query(
    "json_array_field",
    """
    SELECT community_member_id, string_agg(CAST(tag_id AS VARCHAR), '|' ORDER BY tag_id) AS ids FROM fx_member_tag
    GROUP BY community_member_id""",
)
def _(b: Base):
    ids = J.ids_of(J.json_records("member_tags", {"id": "string", "name": "string"}))
    text = F.transform(F.array_sort(ids), lambda i: i.cast("string"))
    return b.raw("community_members").select("community_member_id", F.array_join(text, "|").alias("ids"))


@query("json_array_length", "SELECT community_member_id, COUNT(*) AS tag_count FROM fx_member_tag GROUP BY community_member_id")
def _(b: Base):
    return b.raw("community_members").select("community_member_id", J.json_size("member_tags").alias("tag_count"))


@query(
    "json_bool_flags",
    "SELECT CAST(tag_id AS BIGINT) AS tag_id, TRUE AS directory, FALSE AS bio, on_profile AS profile FROM fx_tag",
)
def _(b: Base):
    return b.raw("member_tags_list").select(
        F.col("id").alias("tag_id"),
        J.json_flag("display_locations", "$.member_directory").alias("directory"),
        J.json_flag("display_locations", "$.post_bio").alias("bio"),
        J.json_flag("display_locations", "$.profile_page").alias("profile"),
    )


# --- rules ------------------------------------------------------------------------------

TAG_TEXT = """CASE o_orderkey % 13 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Free trial ' || o_orderkey WHEN 2 THEN 'Business trial'
    WHEN 3 THEN 'Completed - ' || o_orderpriority WHEN 4 THEN 'AC - ' || o_orderkey WHEN 5 THEN o_orderpriority || ' Cancelled'
    WHEN 6 THEN 'Instructor' WHEN 7 THEN 'Resell' WHEN 8 THEN 'Manager' WHEN 9 THEN 'cancel confirmed ' || o_orderkey
    WHEN 10 THEN 'Removed from all Space Group' WHEN 11 THEN 'Pro' ELSE o_orderpriority END"""
CATEGORY = """CASE o_orderkey % 13 WHEN 0 THEN 'membership_tier' WHEN 1 THEN 'membership_tier' WHEN 2 THEN 'business_role'
    WHEN 3 THEN 'course_completion' WHEN 4 THEN 'migration' WHEN 5 THEN 'cancellation' WHEN 6 THEN 'community_role'
    WHEN 7 THEN 'acquisition' WHEN 8 THEN 'business_role' WHEN 9 THEN 'cancellation' WHEN 10 THEN 'removed'
    WHEN 11 THEN 'membership_tier' ELSE 'potential_business_name' END"""


def _tag_texts(b: Base):
    return b.table("orders").withColumn("tag_name", F.expr(TAG_TEXT.replace("o_orderkey ||", "cast(o_orderkey as string) ||")))


@query("categorize_rules", f"SELECT o_orderkey, {CATEGORY} AS tag_category FROM orders")
def _(b: Base):
    return _tag_texts(b).select("o_orderkey", R.tag_category("tag_name").alias("tag_category"))


@query(
    "tag_visibility",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 13 IN (6, 11) THEN TRUE WHEN o_orderkey % 13 IN (0, 3) THEN FALSE
                            ELSE o_orderkey % 2 = 0 AND o_orderkey % 3 > 0 END AS visible
    FROM orders""",
)
def _(b: Base):
    k = F.col("o_orderkey")
    return _tag_texts(b).select("o_orderkey", R.tag_visible("tag_name", k % 2 == 0, k % 3 > 0).alias("visible"))


@query(
    "member_completeness",
    """
    SELECT s AS id, CASE WHEN last_name IS NOT NULL THEN 'complete' ELSE 'partial' END AS completeness FROM fx_invited""",
)
def _(b: Base):
    first, last, mail = (~T.is_blank(c) for c in ("first_name", "last_name", "email"))
    return b.raw("managers_not_joined").select(
        F.substr("uid", F.lit(2)).cast("bigint").alias("id"), R.profile_completeness(first, last, mail).alias("completeness")
    )


@query(
    "business_confidence",
    """
    SELECT CAST(tag_id AS BIGINT) AS tag_id, confidence FROM fx_business""",
)
def _(b: Base):
    from teampulse.plans.relations import candidate_businesses

    return candidate_businesses(b.tags, b.members).select("tag_id", F.col("confidence_level").alias("confidence"))


@query(
    "bucket_size",
    """
    SELECT o_custkey, n, CASE WHEN n >= 20 THEN 'large' WHEN n >= 10 THEN 'medium' WHEN n >= 5 THEN 'small'
           WHEN n >= 2 THEN 'micro' ELSE 'single' END AS size,
           CASE WHEN days <= 30 THEN 'newly_added' WHEN days <= 90 THEN 'recent' WHEN days <= 365 THEN 'established' ELSE 'long_term' END AS age
    FROM (SELECT o_custkey, COUNT(*) AS n, date_diff('day', CAST(MAX(o_orderdate) AS DATE), DATE '2001-12-31') AS days FROM orders GROUP BY 1)""",
)
def _(b: Base):
    per = _orders(b).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d"))
    return per.select(
        "o_custkey",
        "n",
        R.business_size("n").alias("size"),
        R.business_age(D.days_since("d", dt.date(2001, 12, 31))).alias("age"),
    )


@query(
    "comment_classification",
    """
    SELECT event_id, CASE WHEN k % 3 = 0 THEN 'reply' ELSE 'top_level' END AS kind,
           CASE WHEN k % 2 > 0 AND k % 5 > 0 THEN 'highly_engaged' WHEN k % 2 > 0 THEN 'liked' WHEN k % 5 > 0 THEN 'replied' ELSE 'no_engagement' END AS engagement,
           CASE WHEN k > 50 THEN 'power_commenter' WHEN k > 20 THEN 'active_commenter' WHEN k > 5 THEN 'regular_commenter'
                WHEN k >= 1 THEN 'new_commenter' ELSE 'unknown' END AS level
    FROM fx_activity""",
)
def _(b: Base):
    k = F.col("k")
    return b.raw("activity").select(
        "event_id",
        R.comment_type(F.when(k % 3 == 0, k)).alias("kind"),
        R.comment_engagement(k % 2, k % 5).alias("engagement"),
        R.commenter_level("k").alias("level"),
    )


@query(
    "growth_label",
    """
    SELECT event_id, CASE WHEN k % 7 = 0 OR CAST(k % 5 AS DOUBLE) / NULLIF(k % 7, 0) >= 0.5 THEN 'strong jump this week' ELSE 'steady progress' END AS label
    FROM fx_activity""",
)
def _(b: Base):
    k = F.col("k")
    return b.raw("activity").select("event_id", R.growth_label(k % 5, k % 7).alias("label"))


@query(
    "mover_driver_label",
    """
    SELECT event_id, CASE WHEN l > 0 AND s > 0 AND l >= c AND s >= c THEN 'more lessons + engagement'
                          WHEN l > 0 AND l >= c AND l >= s THEN 'more lessons' WHEN c > 0 AND c >= l AND c >= s THEN 'more live classes'
                          WHEN s > 0 THEN 'higher engagement' WHEN p = 0 OR d * 2 >= p THEN 'strong jump this week' ELSE 'steady growth' END AS label
    FROM (SELECT event_id, k % 3 AS l, k % 4 AS c, event_id % 4 AS s, event_id % 6 AS p, k % 5 AS d FROM fx_activity)""",
)
def _(b: Base):
    k, e = F.col("k"), F.col("event_id")
    rows = b.raw("activity").select(
        "event_id",
        (k % 3).alias("lessons_completed"),
        (k % 4).alias("classes_attended"),
        (e % 4).alias("likes_received"),
        F.lit(None).cast("bigint").alias("comments_received"),
        F.lit(0).cast("bigint").alias("comments_made"),
        (e % 6).alias("previous_week_points"),
        (k % 5).alias("points_change"),
    )
    return rows.select("event_id", R.mover_driver().alias("label"))


# --- predicates ----------------------------------------------------------------------------


@query(
    "filter_valid_records",
    """
    SELECT s AS id, email FROM fx_invited WHERE invitation_status IS NOT NULL AND last_name IS NOT NULL""",
)
def _(b: Base):
    ok = ~T.is_blank("invitation_status") & ~T.is_blank("last_name")
    return b.raw("managers_not_joined").where(ok).select(
        F.substr("uid", F.lit(2)).cast("bigint").alias("id"), T.clean_email("email").alias("email")
    )


@query(
    "filter_in_list",
    """
    SELECT o_orderkey FROM orders WHERE o_orderkey % 13 <> 8 AND length(o_orderpriority) <= 100""",
)
def _(b: Base):
    return _tag_texts(b).where(~R.not_a_business("tag_name")).select("o_orderkey")


@query(
    "filter_array_contains",
    """
    SELECT community_member_id FROM fx_member WHERE NOT is_manager""",
)
def _(b: Base):
    rows = b.members.where(joins.has_item("tag_ids", F.lit(100)) & ~joins.has_item("tag_ids", F.lit(101)))
    return rows.select("community_member_id")


@query("proj_except", "SELECT * EXCLUDE (html) FROM pages")
def _(b: Base):
    return b.table("pages").drop("html")


# --- rendering --------------------------------------------------------------------------------


@query(
    "render_course_table",
    """
    SELECT doc_id, '<tr><td style="S">' || replace(replace(replace(source, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
           || '</td><td style="Stext-align:center;">' || n_chars || '</td><td style="S">' || lang || '</td></tr>' AS row_html
    FROM documents""".replace("S\"", "padding:10px 12px;border:1px solid #ddd;color:#000000;background-color:#ffffff;\"").replace(
        "Stext", "padding:10px 12px;border:1px solid #ddd;color:#000000;background-color:#ffffff;text"
    ),
)
def _(b: Base):
    return b.table("documents").select(
        "doc_id", H.course_row(F.col("source"), F.col("n_chars"), F.col("lang")).alias("row_html")
    )
