"""Team reports: weekly rows, rankings, nested and detail reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.functions import dates as D
from teampulse.functions import rules as R
from teampulse.functions import text as X
from teampulse.functions.rules import METRICS
from teampulse.functions.safe import total, zero_if_null
from teampulse.operators import ordered, ranking
from teampulse.operators.grid import WEEK
from teampulse.operators.weeks import last_finished_week, only_newest
from teampulse.plans.relations import team_stats
from teampulse.session import stored

MAPPING = [
    "business_name",
    "business_tag_id",
    "business_total_members",
    "business_size",
    "business_confidence",
    "manager_community_id",
    "manager_email",
    "manager_first_name",
    "manager_last_name",
    "manager_full_name",
    "member_community_id",
    "member_email",
    "member_first_name",
    "member_last_name",
]
# working columns and mapping details the rankings leave out
NOT_IN_RANKINGS = [
    "business_tag_id",
    "business_total_members",
    "business_size",
    "business_confidence",
    "manager_community_id",
    "has_activity",
    "total_engagement_score",
    "inactive_rank",
    "performance_percentile",
]
TEAM = ["manager_email", WEEK]
INACTIVE = 3  # inactive members of a team that are looked at


def team_engagement(
    relationships: DataFrame,
    engagement: DataFrame,
    as_of: dt.date | str,
    n_weeks: int = 2,
    keep_weeks: int | None = None,
) -> DataFrame:
    """Every (manager, business, member) with the activity of the last finished weeks.

    ``n_weeks=2`` includes the week before, which the comparisons need;
    ``n_weeks=1`` is the report on its own.  ``previous`` holds the metrics of the
    week before a row's week when that week is among the ``n_weeks``, so comparing
    weeks later takes no join.  ``keep_weeks=1`` gives rows for the newest week only.

    The weeks of a member are turned into columns before the join: the mapping is
    shuffled once however many weeks are asked for.
    """
    mapping = relationships.select(*MAPPING, "relationship_type").distinct().drop("relationship_type")
    return member_weeks(mapping, engagement, as_of, n_weeks, keep_weeks)


def member_weeks(
    people: DataFrame, engagement: DataFrame, as_of: dt.date | str, n_weeks: int = 2, keep_weeks: int | None = None
) -> DataFrame:
    """The rows of ``people``, found by ``member_community_id``, once per week with that week's activity."""
    latest = last_finished_week(engagement, as_of)
    weeks = [F.date_sub(latest, 7 * i) for i in range(n_weeks)]
    recent = engagement.where((F.col(WEEK) <= latest) & (F.col(WEEK) >= weeks[-1]))
    if "month" in engagement.columns:
        # stored history: only the folders of these weeks are read
        recent = recent.where(F.col("month").between(F.trunc(weeks[-1], "month"), F.trunc(latest, "month")))
    per_member = recent.groupBy(F.col("community_member_id").alias("member_community_id")).agg(
        *[F.max(F.when(F.col(WEEK) == week, F.col(m))).alias(f"__{m}{i}") for i, week in enumerate(weeks) for m in METRICS]
    )

    def metrics(i: int) -> list:
        return [zero_if_null(f"__{m}{i}").alias(m) for m in METRICS]

    none = F.lit(None).cast("struct<" + ",".join(f"{m}:bigint" for m in METRICS) + ">")
    rows = [
        F.struct(
            week.alias(WEEK),
            *metrics(i),
            (F.struct(*metrics(i + 1)) if i + 1 < n_weeks else none).alias("previous"),
        )
        for i, week in enumerate(weeks[:keep_weeks])
    ]
    filled = people.join(per_member, "member_community_id", "left").select(*people.columns, F.inline(F.array(*rows)))
    score = total(*METRICS)
    return filled.select(
        *people.columns,
        WEEK,
        D.week_end(WEEK).alias("week_end_date"),
        *METRICS,
        (score > 0).alias("has_activity"),
        score.alias("total_engagement_score"),
        "previous",
    )


def member_name():
    return X.full_name("member_first_name", "member_last_name")


POINT_PARTS = {
    "classes_attended": "points_from_classes",
    "lessons_completed": "points_from_lessons",
    "likes_received": "points_from_likes_received",
    "comments_received": "points_from_comments_received",
    "comments_made": "points_from_comments_made",
}


def scored(team: DataFrame, weights: dict[str, int] = R.POINTS) -> DataFrame:
    """Names and weighted points in total."""
    return team.withColumns({"member_full_name": member_name(), "total_points": R.weighted_points(weights)})


def with_point_parts(rows: DataFrame, weights: dict[str, int] = R.POINTS) -> DataFrame:
    """Points per activity kind; added after ranking, so that they are not sorted along."""
    return rows.withColumns({new: R.points_for(m, weights) for m, new in POINT_PARTS.items()})


def week_over_week(points: DataFrame, weights: dict[str, int] = R.POINTS) -> DataFrame:
    """Newest week with the points of the week before."""
    return with_changes(only_newest(points), weights)


def with_changes(points: DataFrame, weights: dict[str, int] = R.POINTS, keep: list[str] = ()) -> DataFrame:
    """Points of the week before and the change; ``previous`` goes unless ``keep`` names it."""
    before = zero_if_null(total(*[F.col(f"previous.{m}") * F.lit(w).cast("bigint") for m, w in weights.items()]))
    rows = points.withColumn("previous_week_points", before).drop(*[c for c in ["previous"] if c not in keep])
    return rows.withColumn("points_change", F.col("total_points") - F.col("previous_week_points"))


def rank_keys() -> dict[str, list]:
    """Ascending sort keys of the three ranks; the member id settles equal names."""
    tie = [F.col("member_full_name"), F.col("member_community_id")]
    idle = F.when(F.col("total_points") == 0, 1).otherwise(2)
    return {
        "performance_rank": [-F.col("total_points"), *tie],
        "mover_rank": [-F.col("points_change"), *tie],
        "inactive_rank": [idle, -F.col("previous_week_points"), *tie],
    }


def with_ranks(rows: DataFrame, group: list[str]) -> DataFrame:
    """Performance and mover rank, percentile, and ``inactive_rank`` where it is three or less.

    ``rows`` come from :func:`ranking.with_row_ids`.  All ranks are worked out on narrow
    rows, and the wide ones are joined to them once.
    """
    # the business settles rows of a member that a manager sees in two businesses
    keys = {name: [*order, F.col("business_name")] for name, order in rank_keys().items()}
    narrow = rows.select(ranking.ROW, *group, "total_points")
    share = ranking.percent_rank_rows(narrow, group, "total_points", "performance_percentile")
    idle = ranking.top_rows(rows, group, keys["inactive_rank"], INACTIVE, "inactive_rank")
    found = ranking.ranks(rows, group, keys["mover_rank"], "mover_rank")
    found = found.join(ranking.ranks(rows, group, keys["performance_rank"], "performance_rank"), ranking.ROW)
    found = found.join(share.select(ranking.ROW, "performance_percentile"), ranking.ROW)
    found = found.join(idle.select(ranking.ROW, "inactive_rank"), ranking.ROW, "left")
    return rows.join(found, ranking.ROW).drop(ranking.ROW)


def with_labels(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "performance_category": R.performance_category(),
            "momentum_category": R.momentum_category(),
            "suggested_action": R.suggested_action(),
            "is_top_performer": R.is_top_performer(),
            "is_top_mover": R.is_top_mover(),
            "needs_reengagement": F.col("total_points") == 0,
        }
    )


def team_summary(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Totals and averages per manager, business and week."""
    sums = {f"team_{m}": m for m in METRICS}
    grouped = rows.groupBy("manager_email", "manager_full_name", "business_name", WEEK, "week_end_date").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.count_if("has_activity").alias("active_members"),
        F.count_if(F.col("total_points") == 0).alias("inactive_members"),
        F.sum("total_points").alias("team_total_points"),
        F.round(F.avg("total_points"), 1).alias("team_avg_points"),
        F.max("total_points").alias("team_max_points"),
        F.sum("points_change").alias("team_points_change"),
        F.round(F.avg("points_change"), 1).alias("team_avg_points_change"),
        *[F.sum(m).alias(new) for new, m in sums.items()],
    )
    return with_team_size(grouped, stats)


def with_team_size(grouped: DataFrame, stats: DataFrame) -> DataFrame:
    """Team size and business total of a team's totals, its rows in ``__rows`` where they are not known."""
    return size_or_rows(grouped.join(stats, ["manager_email", "business_name"], "left"))


def size_or_rows(joined: DataFrame) -> DataFrame:
    """Rows with the columns of :func:`team_stats`, those not known taken from ``__rows``."""
    return (
        joined.withColumn("team_size", F.coalesce("team_size", "__rows"))
        .withColumn("business_total_members", F.coalesce("business_total_members", "__rows"))
        .drop("__rows")
    )


def manager_rankings(
    team: DataFrame,
    relationships: DataFrame,
    per_business: bool = False,
    weights: dict[str, int] = R.POINTS,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Newest week ranked per manager, labelled, with the team's totals on each row.

    ``summary`` takes the totals from :func:`teams.team_summary`, which does not read
    the pairs; without it they are added up from ``team``.

    A manager of k businesses gets each row once per business summary, as the
    reports expect; ``per_business=True`` ranks and joins per business instead.
    """
    group = [*TEAM, "business_name"] if per_business else TEAM
    rows = ranking.with_row_ids(week_over_week(scored(team, weights), weights))
    if summary is None:
        summary = team_summary(rows, team_stats(relationships))
    summary = summary.drop("manager_full_name", "week_end_date")
    if not per_business:
        summary = summary.drop("business_name")
    labelled = with_point_parts(with_labels(with_ranks(rows, group)), weights)
    return ranking.null_safe_join(with_long_dates(labelled.drop(*NOT_IN_RANKINGS)), summary, group)


def with_long_dates(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"week_start_formatted": D.long_date(WEEK), "week_end_formatted": D.long_date("week_end_date")}
    )


def manager_report_nested(team: DataFrame, relationships: DataFrame) -> DataFrame:
    """One row per manager and business with the members as an array, best first."""
    group = ["manager_email", "manager_full_name", "business_name", WEEK, "week_end_date"]
    both = nested_members(only_newest(team), group)
    return with_team_size(both, team_stats(relationships)).withColumnRenamed("manager_full_name", "manager_name")


def nested_members(rows: DataFrame, group: list[str]) -> DataFrame:
    """Totals and members of each group, its number of rows in ``__rows``."""
    rows = rows.withColumn("member_name", member_name())
    member = F.struct(
        "member_name", "member_email", "member_community_id", *METRICS, "total_engagement_score"
    )
    order = [-F.col("total_engagement_score"), F.col("member_email"), F.col("member_community_id")]
    score = F.col("total_engagement_score")
    totals = [
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(m).alias(f"total_{m}") for m in METRICS],
        F.sum(score).alias("team_total_engagement_score"),
        F.round(F.avg(score), 2).alias("avg_engagement_score_per_member"),
    ]
    lists = ordered.list_per_group(rows, group, order, member, "team_members")
    return ranking.null_safe_join(rows.groupBy(*group).agg(*totals), lists, group)


# metric -> (name this week, name last week, name of the difference)
DETAIL = {
    "classes_attended": ("live_classes_attended", "prev_live_classes_attended", "classes_change"),
    "lessons_completed": ("lessons_completed", "prev_lessons_completed", "lessons_change"),
    "likes_received": ("likes_received", "prev_likes_received", "likes_received_change"),
    "comments_received": ("comments_received", "prev_comments_received", "comments_received_change"),
    "comments_made": ("comments_made", "prev_comments_made", "comments_made_change"),
    "week_total_engagement": ("week_total_engagement", "previous_week_engagement", "total_engagement_change"),
}


DETAIL_MANAGER = ["manager_email", "manager_full_name", "manager_first_name", "manager_last_name", "business_name"]
DETAIL_ROW = [
    WEEK,
    "week_end_date",
    "week_start_formatted",
    "week_end_formatted",
    "member_community_id",
    "member_email",
    "member_first_name",
    "member_last_name",
    "team_member",
    *[c for names in DETAIL.values() for c in names],
    "has_activity",
    "activity_status",
]


def detail_counts(rows: DataFrame) -> DataFrame:
    """Rows with counts, last week's counts and differences."""
    rows = rows.drop("previous_week_engagement").withColumn("week_total_engagement", total(*METRICS))
    before = {m: F.col(f"previous.{m}") for m in METRICS}
    before["week_total_engagement"] = total(*before.values())
    both = rows.withColumns({prev: zero_if_null(before[m]) for m, (_, prev, _) in DETAIL.items()})
    renamed = both.withColumnRenamed("classes_attended", "live_classes_attended")
    out = renamed.withColumns({diff: F.col(now) - F.col(prev) for now, prev, diff in DETAIL.values()})
    status = F.when(F.col("has_activity"), "Active").otherwise("Inactive")
    return with_long_dates(out).withColumns({"team_member": member_name(), "activity_status": status})


def team_detail_rows(team: DataFrame) -> DataFrame:
    """Members of the newest week with counts, last week's counts and differences."""
    return detail_counts(only_newest(team)).select(*DETAIL_MANAGER, *DETAIL_ROW)


def detail_totals(rows: DataFrame, group: list[str]) -> DataFrame:
    """Totals of the detail rows of each group."""
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_team_members"),
        F.count_if("has_activity").alias("active_members"),
        F.count_if(~F.col("has_activity")).alias("inactive_members"),
        F.sum("live_classes_attended").alias("team_classes_attended"),
        *[F.sum(m).alias(f"team_{m}") for m in METRICS[1:]],
        F.sum("week_total_engagement").alias("team_total_engagement"),
        F.sum("previous_week_engagement").alias("team_previous_engagement"),
        F.round(F.avg("week_total_engagement"), 1).alias("avg_engagement_per_member"),
        F.round(F.avg("previous_week_engagement"), 1).alias("avg_previous_engagement"),
        F.max("week_total_engagement").alias("highest_individual_engagement"),
    )


def team_detail(team: DataFrame) -> DataFrame:
    """Detail rows with the manager's totals on each row."""
    rows = team_detail_rows(team)
    return rows.join(detail_totals(rows, TEAM), TEAM, "inner")
