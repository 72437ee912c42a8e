"""Cleaning of the raw tables, one function per table.

A payload is parsed once into a struct of text leaves; column pruning then keeps
only the leaves a query reads.  Clocks are arguments.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teampulse.functions import dates as D
from teampulse.functions import json as J
from teampulse.functions import rules as R
from teampulse.functions import safe as N
from teampulse.functions import text as X
from teampulse.operators import dedup
from teampulse.sources import schemas as S

TAG_RECORD = {"id": "string", "name": "string"}


def _struct(df: DataFrame, column: str, shape: str) -> Column:
    """The column as a struct, parsed when it was landed as JSON text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.from_json(F.col(column), shape)
    return F.col(column)


def _at(run_ts: dt.datetime | None, name: str = "cleaned_at") -> list[Column]:
    """The time of the cleaning run as a last column, if one is given."""
    return [] if run_ts is None else [F.lit(run_ts).alias(name)]


def clean_members(raw: DataFrame, as_of: dt.date | str, run_ts: dt.datetime | None = None) -> DataFrame:
    """Member profiles with tag arrays, quality flags and age.

    Repeated ids are kept here, as tags are computed per row; consumers that need
    one row per member use :func:`unique_members`.
    """
    tags = J.json_records("member_tags", TAG_RECORD)
    named = raw.where(F.col("community_member_id").isNotNull() | F.col("email").isNotNull()).withColumn("__tags", tags)
    return named.select(
        F.col("community_member_id").cast("bigint").alias("community_member_id"),
        X.clean_name("first_name").alias("first_name"),
        X.clean_name("last_name").alias("last_name"),
        X.clean_name("name").alias("full_name"),
        X.clean_email("email").alias("email"),
        N.zero_if_null("posts_count").alias("posts_count"),
        N.zero_if_null("comments_count").alias("comments_count"),
        D.parse_utc_strict("created_at").alias("user_profile_created_at"),
        (~X.is_blank("first_name")).alias("has_first_name"),
        (~X.is_blank("last_name")).alias("has_last_name"),
        (~X.is_blank("email")).alias("has_email"),
        F.col(S.EXTRACTED_AT).alias("last_synced_at"),
        F.col(S.RAW_ID).alias("airbyte_record_id"),
        F.size("__tags").cast("bigint").alias("tag_count"),
        J.names_of(F.col("__tags")).alias("tag_names"),
        J.ids_of(F.col("__tags")).alias("tag_ids"),
        R.profile_completeness(
            ~X.is_blank("first_name"), ~X.is_blank("last_name"), ~X.is_blank("email")
        ).alias("profile_completeness"),
        D.days_since(D.parse_utc_strict("created_at"), as_of).alias("days_since_created"),
        *_at(run_ts),
    )


def unique_members(members: DataFrame) -> DataFrame:
    """One row per member id: the newest profile, ties by e-mail and names."""
    rows = members.where(F.col("community_member_id").isNotNull())
    return dedup.keep_latest(
        rows, ["community_member_id"], "user_profile_created_at", ["email", "first_name", "last_name"]
    )


def clean_tags(raw: DataFrame, as_of: dt.date | str, staff_tag: str | None = None) -> DataFrame:
    """Tags with category, visibility and course name."""
    flags = {
        "show_in_member_directory": "$.member_directory",
        "show_in_post_bio": "$.post_bio",
        "show_in_profile_page": "$.profile_page",
    }
    base = raw.where(F.col("id").isNotNull() & F.col("name").isNotNull()).select(
        F.col("id").cast("bigint").alias("tag_id"),
        X.trim_ws("name").alias("tag_name"),
        F.col("color").alias("tag_color"),
        F.col("emoji").alias("tag_emoji"),
        F.coalesce("is_public", F.lit(False)).alias("is_public"),
        "display_format",
        *[J.json_flag("display_locations", path).alias(name) for name, path in flags.items()],
        N.zero_if_null("tagged_members_count").alias("tagged_members_count"),
        D.parse_utc_strict("created_at").alias("created_at"),
        D.parse_utc_strict("updated_at").alias("updated_at"),
        F.col(S.EXTRACTED_AT).alias("last_synced_at"),
        F.col(S.RAW_ID).alias("airbyte_record_id"),
    )
    return base.withColumns(
        {
            "tag_category": R.tag_category("tag_name", staff_tag),
            "visible_beside_name": R.tag_visible("tag_name", "show_in_profile_page", "show_in_member_directory"),
            "course_name": R.tag_course("tag_name"),
            "days_since_created": D.days_since("created_at", as_of),
            "created_date": F.to_date("created_at"),
            "created_year": F.year("created_at").cast("bigint"),
            "created_month": F.month("created_at").cast("bigint"),
        }
    )


# --- event feeds ---------------------------------------------------------------


def _initiator(p: Column, id_name: str, with_uid: bool = True) -> list[Column]:
    who = p["initiator"]
    cols = [
        who["type"].alias("initiator_type"),
        N.to_long(who["id"]).alias(id_name),
        X.clean_name(who["name"]).alias("initiator_name"),
        X.clean_name(who["first_name"]).alias("initiator_first_name"),
        X.clean_name(who["last_name"]).alias("initiator_last_name"),
        X.clean_email(who["email"]).alias("initiator_email"),
        N.to_bool(who["is_admin"]).alias("initiator_is_admin"),
        N.to_bool(who["is_moderator"]).alias("initiator_is_moderator"),
    ]
    return cols + ([who["public_uid"].alias("initiator_public_uid")] if with_uid else [])


def _space(p: Column) -> list[Column]:
    return [
        N.to_long(p["space"]["id"]).alias("space_id"),
        X.clean_name(p["space"]["name"]).alias("space_name"),
        X.clean_email(p["space"]["slug"]).alias("space_slug"),
        p["space"]["type"].alias("space_type"),
    ]


def _comment(p: Column) -> list[Column]:
    c = p["comment"]
    return [
        N.to_long(c["id"]).alias("comment_id"),
        N.to_long(c["community_member_id"]).alias("comment_community_member_id"),
        N.to_long(c["parent_comment_id"]).alias("parent_comment_id"),
        N.to_long(c["post_id"]).alias("post_id"),
        N.to_bool(c["record_owner_is_admin"]).alias("comment_owner_is_admin"),
        c["type"].alias("comment_type"),
    ]


def _post(p: Column, id_name: str) -> list[Column]:
    post = p["posts_basic"]
    return [
        N.to_long(post["community_member_id"]).alias("post_owner_community_member_id"),
        N.to_long(post["id"]).alias(id_name),
        X.trim_ws(post["name"]).alias("post_name"),
        N.to_ts(post["published_at"]).alias("post_published_at"),
        N.to_bool(post["record_owner_is_admin"]).alias("post_owner_is_admin"),
        X.clean_email(post["slug"]).alias("post_slug"),
        N.to_long(post["space_id"]).alias("post_space_id"),
        post["status"].alias("post_status"),
        post["type"].alias("post_type"),
    ]


def _record() -> list[Column]:
    return [
        F.col("id").alias("record_id"),
        F.col("name").alias("event_name"),
        N.to_ts(S.EXTRACTED_AT).alias(S.EXTRACTED_AT),
        N.to_ts("created_at").alias("created_at"),
        N.to_ts("triggered_at").alias("triggered_at"),
    ]


def _latest_records(rows: DataFrame) -> DataFrame:
    """Newest copy of each record.

    Applied after parsing, so that the shuffle carries the leaves a query reads and
    not the whole payload.
    """
    return dedup.keep_latest(rows, ["record_id"], S.EXTRACTED_AT, [S.RAW_ID]).drop(S.RAW_ID)


def _parsed(raw: DataFrame) -> tuple[DataFrame, Column]:
    return raw.withColumn("__p", _struct(raw, "payload", S.PAYLOAD)), F.col("__p")


def clean_comments(raw: DataFrame) -> DataFrame:
    df, p = _parsed(raw)
    rows = df.select(
        *_comment(p), *_initiator(p, "initiator_community_id"), *_post(p, "post_basic_id"), *_space(p), *_record(), S.RAW_ID
    )
    return _latest_records(rows)


def clean_comment_likes(raw: DataFrame) -> DataFrame:
    df, p = _parsed(raw)
    who = _initiator(p, "initiator_community_member_id")
    return _latest_records(df.select(*_comment(p), *who, *_post(p, "post_basic_id"), *_space(p), *_record(), S.RAW_ID))


def clean_post_likes(raw: DataFrame) -> DataFrame:
    df, p = _parsed(raw)
    who = _initiator(p, "initiator_community_member_id")
    return _latest_records(df.select(*who, *_post(p, "post_id"), *_space(p), *_record(), S.RAW_ID))


def clean_lessons(raw: DataFrame) -> DataFrame:
    df, p = _parsed(raw)
    rows = df.select(
        *_initiator(p, "initiator_community_id"),
        N.to_long(p["lesson"]["id"]).alias("lesson_id"),
        p["lesson"]["type"].alias("lesson_type"),
        N.to_long(p["space"]["id"]).alias("course_id"),
        X.clean_name(p["space"]["name"]).alias("course_name"),
        X.clean_email(p["space"]["slug"]).alias("course_slug"),
        p["space"]["type"].alias("space_type"),
        *_record(),
        S.RAW_ID,
    )
    return _latest_records(rows)


def clean_courses(raw: DataFrame) -> DataFrame:
    """First completion per e-mail and course; ids stay text in this table."""
    df, p = _parsed(raw)
    rows = df.select(
        *[c for c in _initiator(p, "__id", with_uid=False)],
        p["initiator"]["id"].alias("initiator_community_id"),
        p["space"]["id"].alias("course_id"),
        X.clean_name(p["space"]["name"]).alias("course_name"),
        X.clean_name(p["space"]["slug"]).alias("course_slug"),
        X.clean_name(p["space"]["type"]).alias("space_type"),
        *_record(),
    ).drop("__id")
    return dedup.keep_earliest(rows, ["initiator_email", "course_id"], "created_at", ["record_id"])


# --- record tables ---------------------------------------------------------------


def clean_attendees(raw: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return raw.where(F.col("id").isNotNull() & F.col("event_id").isNotNull()).select(
        F.col("id").alias("attendee_record_id"),
        "event_id",
        "contact_id",
        "community_member_id",
        X.clean_name("member_name").alias("attendee_name"),
        X.clean_email("member_email").alias("attendee_email"),
        F.col("member_avatar_url").alias("attendee_avatar_url"),
        "headline",
        "event_name",
        "rsvp_status",
        "contact_type",
        N.to_ts("rsvp_date").alias("rsvp_date"),
        F.col(S.EXTRACTED_AT).alias("data_last_synced_at"),
        F.col(S.RAW_ID).alias("airbyte_record_id"),
        *_at(run_ts, "data_cleaned_at"),
    )


def clean_events(raw: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    space = _struct(raw, "space", "struct<id:string,name:string,slug:string,community_id:string>")
    topics = raw.schema["topics"].dataType
    count = J.json_size("topics") if isinstance(topics, T.StringType) else N.zero_if_null(F.array_size("topics").cast("bigint"))
    return raw.where(F.col("id").isNotNull()).withColumn("__s", space).select(
        F.col("id").alias("event_id"),
        "user_id",
        F.col("community_member_id").alias("hosts_community_member_id"),
        F.col("host").alias("host_name"),
        X.clean_email("member_email").alias("host_email"),
        F.col("member_avatar_url").alias("host_avatar_url"),
        F.col("name").alias("event_name"),
        F.col("slug").alias("event_slug"),
        F.col("url").alias("event_url"),
        X.strip_html("body").alias("event_description"),
        N.to_long(F.col("__s.id").cast("string")).alias("space_id"),
        F.col("__s.name").alias("space_name"),
        F.col("__s.slug").alias("space_slug"),
        N.to_long(F.col("__s.community_id").cast("string")).alias("space_community_id"),
        "topics",
        count.alias("topic_count"),
        *[N.to_ts(c).alias(c) for c in ("starts_at", "ends_at", "created_at", "updated_at")],
        "location_type",
        *[N.zero_if_null(c).alias(c) for c in ("duration_in_seconds", "likes_count", "comments_count")],
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in S.EVENT_FLAGS],
        "cover_image_url",
        "zapier_display_title",
        F.col(S.EXTRACTED_AT).alias("last_synced_at"),
        F.col(S.RAW_ID).alias("airbyte_record_id"),
        *_at(run_ts),
    )


def clean_invited_managers(raw: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Roster of managers who have not joined, with the business named by their tags."""
    rows = raw.where(~X.is_blank("email")).withColumn("__tags", X.quoted_items(X.trim_ws("tags")))
    first, last = X.clean_name("first_name"), X.clean_name("last_name")
    return rows.select(
        "uid",
        N.to_long(F.col("id").cast("string")).alias("manager_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        X.full_name(first, last).alias("manager_full_name"),
        X.clean_email("email").alias("manager_email"),
        N.to_ts(F.nullif(F.col("join_date").cast("string"), F.lit(""))).alias("join_date"),
        X.trim_ws("profile_url").alias("profile_url"),
        N.yes_no("member__y_n_").alias("member_in_community"),
        F.lower(F.nullif(X.trim_ws("invitation_status"), F.lit(""))).alias("invitation_status"),
        N.to_ts(F.nullif(F.col("invitation_date").cast("string"), F.lit(""))).alias("invitation_date"),
        F.col("__tags").alias("tag_names"),
        R.roster_business(F.col("__tags")).alias("business_name_from_tags"),
        *_at(run_ts),
    )


def clean_comments_full(raw: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Comment table with author, post, text, calendar parts and classes."""
    who = "struct<id:string,name:string,email:string,avatar_url:string>"
    place = "struct<id:string,name:string,slug:string>"
    rows = raw.where(F.col("id").isNotNull() & F.col("community_id").isNotNull() & F.col("created_at").isNotNull())
    rows = rows.withColumns(
        {
            "__u": _struct(raw, "user", who),
            "__po": _struct(raw, "post", place),
            "__sp": _struct(raw, "space", place),
            "__b": _struct(raw, "body", "struct<body:string>"),
            "__at": D.parse_utc_strict("created_at"),
        }
    )
    base = rows.select(
        F.col("id").alias("comment_id"),
        "community_id",
        "parent_comment_id",
        N.to_long("__u.id").alias("author_community_member_id"),
        F.col("__u.name").alias("author_full_name"),
        F.col("__u.email").alias("author_email"),
        F.col("__u.avatar_url").alias("author_avatar_url"),
        N.to_long("__po.id").alias("post_id"),
        F.col("__po.name").alias("post_name"),
        F.col("__po.slug").alias("post_slug"),
        N.to_long("__sp.id").alias("space_id"),
        F.col("__sp.name").alias("space_name"),
        F.col("__sp.slug").alias("space_slug"),
        X.strip_html("__b.body").alias("comment_text"),
        F.col("url").alias("comment_url"),
        F.col("__at").alias("comment_created_at"),
        N.zero_if_null("likes_count").alias("comment_likes_count"),
        N.zero_if_null("replies_count").alias("replies_to_comment_count"),
        N.zero_if_null("user_likes_count").alias("authors_total_likes"),
        N.zero_if_null("user_posts_count").alias("authors_total_posts"),
        N.zero_if_null("user_comments_count").alias("authors_total_comments"),
        F.col(S.EXTRACTED_AT).alias("data_last_synced_at"),
        F.col(S.RAW_ID).alias("airbyte_record_id"),
        *_at(run_ts, "data_cleaned_at"),
    )
    at = F.col("comment_created_at")
    return base.withColumns(
        {
            "comment_date": F.to_date(at),
            "comment_created_year": F.year(at).cast("bigint"),
            "comment_created_month": F.month(at).cast("bigint"),
            "comment_created_week": D.sunday_week(at),
            "comment_created_day_of_week": F.dayofweek(at).cast("bigint"),
            "comment_created_hour": F.hour(at).cast("bigint"),
            "comment_created_week_start_date": D.week_start(at),
            "comment_created_month_start_date": D.month_start(at),
            "comment_type": R.comment_type("parent_comment_id"),
            "engagement_level": R.comment_engagement("comment_likes_count", "replies_to_comment_count"),
            "commenter_level": R.commenter_level("authors_total_comments"),
        }
    )
