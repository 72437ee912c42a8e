"""Distinct activity per member and calendar period."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.functions.dates import month_start, week_start
from teampulse.functions.safe import to_long
from teampulse.operators.grid import MEMBER, WEEK
from teampulse.operators.ordered import sorted_values

MONTH = "month_start_date"
COMMENT_COLUMNS = ["comment_id", "post_owner_community_member_id", "comment_community_member_id", "created_at"]


def not_before(rows: DataFrame, at: str, since: dt.date | None) -> DataFrame:
    """Rows from a day on.

    The bound is put on the raw time column, where the scan can use it, and on the
    month folder of stored tables, so that older folders are not even listed.
    """
    if since is None:
        return rows
    rows = rows.where(F.col(at) >= F.lit(dt.datetime.combine(since, dt.time())))
    if at == "created_at" and "month" in rows.columns:
        rows = rows.where(F.col("month") >= F.lit(since.replace(day=1)))
    return rows


def weekly_count(
    events: DataFrame, member: str, item: str, at: str, out: str, since: dt.date | None = None
) -> DataFrame:
    """Distinct items per member and week; rows without a key or a time are left out.

    ``since`` is a Monday: only whole weeks from there on are counted.
    """
    rows = events.where(F.col(member).isNotNull() & F.col(at).isNotNull() & F.col(item).isNotNull())
    rows = not_before(rows, at, since)
    return (
        rows.select(F.col(member).alias(MEMBER), week_start(at).alias(WEEK), F.col(item).alias("item"))
        .groupBy(MEMBER, WEEK)
        .agg(F.countDistinct("item").alias(out))
    )


def live_classes(attendees: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Confirmed attendances by the week of the reply."""
    yes = attendees.where(F.col("rsvp_status") == "yes")
    return weekly_count(yes, MEMBER, "event_id", "rsvp_date", "live_classes_attended", since)


def lessons(completed: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Distinct lessons, so a lesson repeated within a week counts once."""
    return weekly_count(completed, "initiator_community_id", "lesson_id", "created_at", "lessons_completed", since)


def union_likes(post_likes: DataFrame, comment_likes: DataFrame) -> DataFrame:
    """Likes by the member who received them: post owners and comment authors."""
    parts = []
    for rows, owner in (
        (post_likes, "post_owner_community_member_id"),
        (comment_likes, "comment_community_member_id"),
    ):
        month = ["month"] if "month" in rows.columns else []
        parts.append(rows.select(F.col(owner).alias(MEMBER), "created_at", F.col("record_id").alias("like_id"), *month))
    return parts[0].unionByName(parts[1])


def likes(post_likes: DataFrame, comment_likes: DataFrame, since: dt.date | None = None) -> DataFrame:
    return weekly_count(union_likes(post_likes, comment_likes), MEMBER, "like_id", "created_at", "likes_received", since)


def comments_received(comments: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Comments on a member's posts, the member's own included."""
    return weekly_count(comments, "post_owner_community_member_id", "comment_id", "created_at", "comments_received", since)


def comments_made(comments: DataFrame, since: dt.date | None = None) -> DataFrame:
    return weekly_count(comments, "comment_community_member_id", "comment_id", "created_at", "comments_made", since)


def monthly_courses(courses: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Courses per member and month with parallel id and name arrays.

    A member's courses per month are bounded by the course catalogue.
    """
    rows = courses.where(
        F.col("initiator_community_id").isNotNull() & F.col("created_at").isNotNull() & F.col("course_id").isNotNull()
    )
    rows = not_before(rows, "created_at", since)
    first = (
        rows.groupBy(
            to_long("initiator_community_id").alias(MEMBER),
            month_start("created_at").alias(MONTH),
            "course_id",
            "course_name",
        ).agg(F.min("created_at").alias("at"))
    )
    order = [F.col("course_id"), F.col("course_name")]
    # one name row per (course, name) pair is left, so a set of ids counts them exactly
    return first.groupBy(MEMBER, MONTH).agg(
        F.size(F.collect_set("course_id")).cast("bigint").alias("courses_completed_count"),
        sorted_values(order, F.col("course_id")).alias("course_ids_completed"),
        sorted_values(order, F.col("course_name")).alias("course_names_completed"),
        F.min("at").alias("first_completion_in_month"),
        F.max("at").alias("last_completion_in_month"),
    )


def weekly_tables(feeds: dict[str, DataFrame], since: dt.date | None = None) -> dict[str, DataFrame]:
    """All five weekly tables from the cleaned feeds."""
    return {
        "classes_attended": live_classes(feeds["attendees"], since).withColumnRenamed(
            "live_classes_attended", "classes_attended"
        ),
        "lessons_completed": lessons(feeds["lessons"], since),
        "likes_received": likes(feeds["post_likes"], feeds["comment_likes"], since),
        "comments_received": comments_received(feeds["comments"], since),
        "comments_made": comments_made(feeds["comments"], since),
    }

