"""Flat tables for mail and print, one row per manager, read from the rankings or detail report.

Both are either tables of all pairs or :class:`teams.Shared`, which has their rows once per
team; sections are then worked out per team and handed to its managers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.functions import dates as D
from teampulse.functions import html as H
from teampulse.functions import rules as R
from teampulse.operators import ordered, pivot, ranking
from teampulse.operators.grid import WEEK
from teampulse.operators.weeks import only_newest
from teampulse.plans.teams import COPIES, TEAM_ID, Shared

TEAM = ["manager_email", WEEK]
HEADER = [
    "manager_email",
    "manager_full_name",
    "business_name",
    WEEK,
    "week_end_date",
    "week_start_formatted",
    "week_end_formatted",
]
SUMMARY = [
    "team_size",
    "active_members",
    "inactive_members",
    "team_total_points",
    "team_avg_points",
    "team_max_points",
    "team_points_change",
    "team_avg_points_change",
    "team_classes_attended",
    "team_lessons_completed",
    "team_likes_received",
    "team_comments_received",
    "team_comments_made",
]


def rows_of(rankings: DataFrame | Shared, change: Callable[[DataFrame], DataFrame]) -> DataFrame | Shared:
    """The rankings with their rows filtered or extended."""
    return rankings.with_rows(change(rankings.rows)) if isinstance(rankings, Shared) else change(rankings)


def header_columns(rankings: DataFrame | Shared, columns: list[str]) -> DataFrame:
    """Distinct values of columns that belong to the manager or the summary."""
    return (rankings.managers if isinstance(rankings, Shared) else rankings).select(*columns).distinct()


def manager_weeks(rankings: DataFrame | Shared) -> DataFrame:
    return header_columns(rankings, HEADER)


def on_teams(rankings: DataFrame | Shared, fn: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """``fn(rows, group)`` per manager and week; the rows come once per summary of the manager."""
    if isinstance(rankings, Shared):
        again = F.explode(F.sequence(F.lit(1), F.col(COPIES)))
        return rows_of(rankings, lambda rows: rows.withColumn("__copy", again)).per_group(fn)
    return fn(rankings, TEAM)


def per_team(rankings: DataFrame | Shared, aggs: list[Column]) -> DataFrame:
    return on_teams(rankings, lambda rows, group: rows.groupBy(*group).agg(*aggs))


def on_team(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, TEAM, "left")


def section_counts(rankings: DataFrame | Shared) -> DataFrame:
    """Row counts behind the three mail sections: one pass instead of a subquery for each."""
    return per_team(
        rankings,
        [
            F.count_if("is_top_performer").alias("count_top_performers"),
            F.count_if("is_top_mover").alias("count_top_movers"),
            F.count("suggested_action").alias("count_action_items"),
        ],
    )


def manager_list(rankings: DataFrame | Shared) -> DataFrame:
    cols = [*HEADER, "manager_first_name", "manager_last_name", *SUMMARY]
    return on_team(header_columns(rankings, cols), section_counts(rankings))


def _top_columns(
    rankings: DataFrame | Shared, rows: DataFrame | Shared, rank: str, values: dict[str, str], count: str
) -> DataFrame:
    """Ranks 1 to 3 as columns for every header row.

    The count is of rows per header row, so it follows the fan-out of managers
    with several businesses.
    """
    top = on_teams(rows, lambda rows, group: pivot.ranks_to_columns(rows, group, rank, values))
    joined = on_team(manager_weeks(rankings), top)
    return joined.withColumn(count, F.coalesce("__n", F.lit(0).cast("bigint"))).drop("__n")


def top_performers(rankings: DataFrame | Shared) -> DataFrame:
    rows = rows_of(rankings, lambda rows: rows.where("is_top_performer"))
    values = {"member_full_name": "top_performer_{}_name", "total_points": "top_performer_{}_score"}
    flat = _top_columns(rankings, rows, "performance_rank", values, "count_top_performers")
    return flat.withColumn("top_performers_html", H.top_performers(F.col("count_top_performers")))


def top_movers(rankings: DataFrame | Shared) -> DataFrame:
    rows = rows_of(rankings, lambda rows: rows.where("is_top_mover"))
    values = {
        "member_full_name": "top_mover_{}_name",
        "previous_week_points": "top_mover_{}_prev_points",
        "points_change": "top_mover_{}_change",
    }
    flat = _top_columns(rankings, rows, "mover_rank", values, "count_movers")
    performers = per_team(rankings, [F.count_if("is_top_performer").alias("__performers")])
    count = F.col("count_movers")
    out = on_team(flat, performers).withColumns(
        {
            "top_movers_context_note": H.movers_note(count, F.coalesce("__performers", F.lit(0))),
            "top_movers_html": H.top_movers(count),
        }
    )
    return out.drop("__performers", "top_mover_3_prev_points")


def best_of(rows: Column, order: list[Column], value: Column) -> Column:
    """Aggregate: ``value`` of the row with the smallest ``order`` among those where ``rows`` holds."""
    key = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return F.min_by(F.when(rows, value), F.when(rows, key))


def candidates(rankings: DataFrame | Shared) -> DataFrame:
    """The member to celebrate, to encourage and to re-engage, in one aggregation.

    Partial results are combined before the shuffle, so a large team costs one row per task.
    """
    name, points, change = F.col("member_full_name"), F.col("total_points"), F.col("points_change")
    tie = [name, F.col("member_community_id")]
    who = F.struct(
        "member_first_name", "member_full_name", "total_points", "previous_week_points", "points_change"
    )
    idle = (points == 0) & (F.coalesce("previous_week_points", F.lit(0)) == 0)
    return per_team(
        rankings,
        [
            best_of((F.col("performance_rank") == 1) & (points > 0), tie, who).alias("celebrate"),
            best_of(change > 0, [F.col("mover_rank"), -change, *tie], who).alias("encourage"),
            best_of(idle, tie, who).alias("reengage"),
        ],
    )


def action_points(rankings: DataFrame | Shared) -> DataFrame:
    rows = on_team(manager_weeks(rankings), candidates(rankings))
    change, before = F.col("encourage.points_change"), F.col("encourage.previous_week_points")
    label = F.when(F.col("encourage.member_full_name").isNotNull(), R.growth_label(change, before))
    flat = rows.select(
        *HEADER,
        D.iso_week(WEEK).alias("week_number"),
        F.year(WEEK).cast("bigint").alias("year"),
        F.col("celebrate.member_full_name").alias("celebrate_member_name"),
        F.col("celebrate.member_first_name").alias("celebrate_member_first_name"),
        F.col("encourage.member_full_name").alias("encourage_member_name"),
        F.col("encourage.member_first_name").alias("encourage_member_first_name"),
        before.alias("encourage_prev_points"),
        change.alias("encourage_points_change"),
        label.alias("encourage_label"),
        F.col("reengage.member_full_name").alias("reengage_member_name"),
        F.col("reengage.member_first_name").alias("reengage_member_first_name"),
    )
    return flat.withColumn("action_points_html", H.action_points())


def labelled_movers(rankings: DataFrame | Shared) -> DataFrame | Shared:
    labels = {
        "mover_driver_label": R.mover_driver(),
        "jump_label": R.growth_label("points_change", "previous_week_points", "steady growth"),
    }
    return rows_of(rankings, lambda rows: rows.where("is_top_mover").withColumns(labels))


def pdf_blocks(rankings: DataFrame | Shared) -> DataFrame:
    """Movers, suggested actions and both together, for the printed report."""
    first = F.col("mover_rank") == 1
    movers = per_team(
        labelled_movers(rankings),
        [
            F.count(F.lit(1)).alias("count_top_movers"),
            ordered.sorted_text(
                [F.col("mover_rank"), F.col("member_community_id")], H.mover_line(), ""
            ).alias("__lines"),
            F.max(F.when(first, F.col("member_first_name"))).alias("top_mover_1_first_name"),
            F.max(F.when(first, F.col("jump_label"))).alias("top_mover_1_jump_label"),
        ],
    )
    rows = on_team(on_team(manager_weeks(rankings), candidates(rankings)), movers)
    movers_html = H.pdf_movers(F.col("__lines"), F.col("count_top_movers"))
    actions_html = H.pdf_actions(
        F.col("celebrate.member_first_name"),
        F.col("top_mover_1_first_name"),
        F.col("top_mover_1_jump_label"),
        F.col("reengage.member_first_name"),
    )
    return rows.select(
        *HEADER,
        D.iso_week(WEEK).alias("week_number"),
        F.year(WEEK).cast("bigint").alias("year"),
        F.col("celebrate.member_full_name").alias("top_performer_name"),
        F.col("celebrate.total_points").alias("top_performer_points"),
        "count_top_movers",
        "top_mover_1_first_name",
        "top_mover_1_jump_label",
        F.col("reengage.member_full_name").alias("reengage_member_name"),
        movers_html.alias("top_movers_html"),
        actions_html.alias("suggested_actions_html"),
        F.concat(movers_html, actions_html).alias("pdf_summary_html"),
    )


DETAIL_COLUMNS = [
    *HEADER,
    "team_member",
    "member_email",
    "live_classes_attended",
    "lessons_completed",
    "likes_received",
    "comments_received",
    "comments_made",
    "week_total_engagement",
    "previous_week_engagement",
    "total_engagement_change",
    "activity_status",
    "total_team_members",
    "active_members",
    "inactive_members",
    "team_total_engagement",
    "team_previous_engagement",
    "avg_engagement_per_member",
]


def team_detail_export(detail: DataFrame | Shared) -> DataFrame:
    """Printed detail list, most active first."""
    if isinstance(detail, Shared):
        order = [-F.unix_date(WEEK), -F.col("week_total_engagement"), F.col("team_member")]
        return detail.ordered_pairs(order, DETAIL_COLUMNS)
    return detail.select(*DETAIL_COLUMNS).orderBy(
        "manager_email", F.desc(WEEK), F.desc("week_total_engagement"), "team_member"
    )


def summary_export(detail: DataFrame) -> DataFrame:
    """Header numbers per manager and business; members are counted by name."""
    rows = only_newest(detail)
    active = F.col("activity_status") == "Active"
    out = rows.groupBy(*HEADER).agg(
        F.countDistinct("team_member").alias("total_team_members"),
        F.countDistinct(F.when(active, F.col("team_member"))).alias("active_members"),
        F.countDistinct(F.when(~active, F.col("team_member"))).alias("inactive_members"),
        F.sum("week_total_engagement").alias("team_total_score"),
        F.sum("previous_week_engagement").alias("team_previous_score"),
        F.sum("total_engagement_change").alias("team_score_change"),
        F.round(F.avg("week_total_engagement"), 1).alias("avg_score_per_member"),
    )
    return out.withColumns({"week_number": D.sunday_week(WEEK), "year": F.year(WEEK).cast("bigint")})


def top3_export(detail: DataFrame | Shared) -> DataFrame:
    """Three most active members per manager."""
    order = [F.desc("week_total_engagement"), F.asc("team_member"), F.asc("member_community_id"), F.asc("business_name")]
    if isinstance(detail, Shared):
        top = detail.with_rows(ranking.top_rows(only_newest(detail.rows), [TEAM_ID, WEEK], order, 3)).pairs()
    else:
        top = ranking.top_rows(only_newest(detail), TEAM, order, 3)
    return top.select(
        "manager_email",
        "manager_full_name",
        "business_name",
        WEEK,
        "week_end_date",
        "rank",
        F.col("team_member").alias("name"),
        F.col("week_total_engagement").alias("score"),
    )
