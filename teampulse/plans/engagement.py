"""Weekly engagement per member: the full build and the incremental one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.functions import dates as D
from teampulse.functions.rules import METRICS
from teampulse.functions.safe import total
from teampulse.operators import grid as G
from teampulse.session import stored

LOOKBACK_WEEKS = 4
PROFILE = ["community_member_id", "email", "first_name", "last_name"]


def _finish(rows: DataFrame) -> DataFrame:
    return rows.select(
        *PROFILE,
        G.WEEK,
        D.week_end(G.WEEK).alias("week_end_date"),
        *METRICS,
        (total(*METRICS) > 0).alias("has_activity"),
        "is_backfill",
    )


def _profiles(members: DataFrame) -> DataFrame:
    return members.select(*PROFILE, D.week_start("user_profile_created_at").alias("__joined"))


def engagement_full(
    members: DataFrame, weekly: dict[str, DataFrame], spine: str = "activity", as_of: dt.date | str | None = None
) -> DataFrame:
    """All weeks of all members from the week they joined.

    ``spine='activity'`` uses the weeks in which anyone was active,
    ``spine='calendar'`` every week up to ``as_of``.  ``members`` has one row per id.
    """
    people = _profiles(members).where(F.col("__joined").isNotNull())
    if spine == "activity":
        weeks = G.all_weeks(G.distinct_weeks(list(weekly.values())))
    else:
        weeks = G.weeks_from_calendar(F.col("__joined"), F.lit(D.monday(as_of)))
    ready = people.withColumns({"__weeks": weeks, "is_backfill": F.lit(False)})
    return _finish(G.fill_grid(ready, weekly, "__weeks", since="__joined"))


def known_members(target: DataFrame) -> DataFrame:
    """Ids in a stored engagement table or in the list of its members that the runs keep beside it."""
    return target.select("community_member_id").distinct()


def mark_new(members: DataFrame, target: DataFrame, newest_week: dt.date | Column) -> DataFrame:
    """Profiles with ``is_backfill``: not in the target, or joined within the lookback."""
    newest = F.lit(newest_week) if isinstance(newest_week, dt.date) else newest_week
    seen = known_members(target).withColumn("__seen", F.lit(True))
    recent = F.col("__joined") >= F.date_sub(newest, 7 * LOOKBACK_WEEKS)
    flag = F.col("__seen").isNull() | F.coalesce(recent, F.lit(False))
    return _profiles(members).join(seen, "community_member_id", "left").withColumn("is_backfill", flag).drop("__seen")


def new_members(members: DataFrame, target: DataFrame, newest_week: dt.date | Column) -> DataFrame:
    return mark_new(members, target, newest_week).where("is_backfill")


def backfill_grid(members: DataFrame, target: DataFrame, newest_week: dt.date | Column, as_of: dt.date | str) -> DataFrame:
    """Profiles with their weeks to (re)build: all weeks for new members, the recent ones for known members.

    One array per member with its own start replaces two grids and their union.
    """
    return weeks_to_build(mark_new(members, target, newest_week), newest_week, as_of)


def weeks_to_build(marked: DataFrame, newest_week: dt.date | Column, as_of: dt.date | str) -> DataFrame:
    """The weeks of profiles from :func:`mark_new`; profiles without any are left out."""
    newest = F.lit(newest_week) if isinstance(newest_week, dt.date) else newest_week
    recent = F.greatest(F.date_sub(newest, 7 * LOOKBACK_WEEKS), F.col("__joined"))
    start = F.when(F.col("is_backfill"), F.col("__joined")).otherwise(recent)
    weeks = G.weeks_from_calendar(start, F.lit(D.monday(as_of)))
    return marked.where(F.col("__joined").isNotNull()).withColumn("__weeks", weeks).where(F.size("__weeks") > 0).drop("__joined")


def needed_activity(
    weekly: dict[str, DataFrame], marked: DataFrame, since: dt.date | Column
) -> dict[str, DataFrame]:
    """The part of the weekly tables an incremental run reads.

    Recent weeks are read for everybody.  Older weeks are read only for new members
    who joined before them; on most runs there are none, and then the runtime drops
    that branch with its scan.
    """
    start = F.lit(since) if isinstance(since, dt.date) else since
    late = marked.where(F.col("is_backfill") & (F.col("__joined") < start)).select(G.MEMBER)
    out = {}
    for name, table in weekly.items():
        rows = table.select(G.MEMBER, G.WEEK, name)
        recent = rows.where(F.col(G.WEEK) >= start)
        if "month" in table.columns:
            # names the month folders, so that the older ones are not listed
            folder = F.col("month") >= F.trunc(start, "month")
            recent = table.where(folder & (F.col(G.WEEK) >= start)).select(G.MEMBER, G.WEEK, name)
        older = rows.where(F.col(G.WEEK) < start).join(late, G.MEMBER, "left_semi")
        out[name] = recent.unionByName(older)
    return out


def engagement_changes(
    members: DataFrame,
    weekly: dict[str, DataFrame],
    target: DataFrame,
    newest_week: dt.date | Column,
    as_of: dt.date | str,
) -> DataFrame:
    """Rows to upsert into the engagement table: recent weeks of known members, full history of new ones.

    ``target`` only says who is known, so it may be the list of its members in place of
    the table itself.
    """
    return changes_of(stored(mark_new(members, target, newest_week), "marked"), weekly, newest_week, as_of)


def changes_of(
    marked: DataFrame, weekly: dict[str, DataFrame], newest_week: dt.date | Column, as_of: dt.date | str
) -> DataFrame:
    """The same for profiles from :func:`mark_new`, which are read once per weekly table: store them."""
    newest = F.lit(newest_week) if isinstance(newest_week, dt.date) else newest_week
    activity = needed_activity(weekly, marked, F.date_sub(newest, 7 * LOOKBACK_WEEKS))
    ready = weeks_to_build(marked, newest_week, as_of)
    return _finish(G.fill_grid(ready, activity, "__weeks"))
