"""Team totals without the pairs of managers and members.

A business with m managers and n members has m x n pairs, but only n members to add
up.  So the members of each business are counted once, whoever manages it, and the
managers take over the totals of their businesses.  Counts, sums and maxima of
businesses combine exactly.  Distinct names do not where a manager has two businesses
of the same name: for these alone the names are merged per manager.

Ranks and lists are shared in the same way.  Managers who have the same businesses see
the same rows, so these are ranked once per team (:class:`Shared`) and handed to the
managers of the team at the end.

The results equal those over the pairs in ``reports`` and ``exports``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teampulse.functions import dates as D
from teampulse.functions import rules as R
from teampulse.functions.rules import METRICS
from teampulse.functions.safe import total, zero_if_null
from teampulse.operators import joins, ranking
from teampulse.operators.grid import WEEK
from teampulse.plans import reports as W
from teampulse.plans.relations import TAG, business_relationships, team_members, team_stats
from teampulse.session import stored

MEMBERS = [c for c in W.MAPPING if c.startswith("member_")]
MANAGERS = [c for c in W.MAPPING if c not in MEMBERS]
GROUP = ["manager_email", "manager_full_name", "business_name"]
DATES = [WEEK, "week_end_date"]
ROWS = "__rows"
TEAM_ID, NTH, COPIES = "__team", "__nth", "__copies"
ITEM = [TEAM_ID, TAG, NTH]  # one business of a team
CELL = 512  # rows of a team that are handed to a manager at once


def managed_members(mapping: DataFrame, members: DataFrame, tags: DataFrame) -> DataFrame:
    """The members of each business that has a manager, once; a business without a team has one empty row."""
    managed = mapping.select(TAG).distinct()
    rows = joins.left_keep_all(managed, team_members(members, tags), [TAG])
    return rows.select(TAG, *MEMBERS).distinct()


def member_rows(
    managed: DataFrame,
    engagement: DataFrame,
    as_of: dt.date | str,
    weights: dict[str, int] = R.POINTS,
    keep: list[str] = (),
) -> DataFrame:
    """Activity and points of the members of each business in the last finished week, with the changes.

    ``previous`` holds the metrics of the week before and goes unless ``keep`` names it.
    """
    team = W.member_weeks(managed, engagement, as_of, n_weeks=2, keep_weeks=1).where(F.col(WEEK).isNotNull())
    before = zero_if_null(total(*[F.col(f"previous.{m}") for m in METRICS]))
    rows = W.with_changes(W.scored(team, weights), weights, keep=["previous"])
    return rows.withColumn("previous_week_engagement", before).drop(*[c for c in ["previous"] if c not in keep])


def business_totals(rows: DataFrame) -> DataFrame:
    """One row per business and week with numbers that add up over businesses."""
    return rows.groupBy(TAG, *DATES).agg(
        F.count(F.lit(1)).alias(ROWS),
        F.count_if("has_activity").alias("active_members"),
        F.count_if(F.col("total_points") == 0).alias("inactive_members"),
        F.sum("total_points").alias("team_total_points"),
        F.max("total_points").alias("team_max_points"),
        F.sum("points_change").alias("team_points_change"),
        *[F.sum(m).alias(f"team_{m}") for m in METRICS],
        F.sum("total_engagement_score").alias("team_total_score"),
        F.sum("previous_week_engagement").alias("team_previous_score"),
    )


def per_manager(mapping: DataFrame, totals: DataFrame) -> DataFrame:
    """The totals of each manager's businesses, added up per business name."""
    managers = mapping.select(*MANAGERS).distinct()
    added = [c for c in totals.columns if c not in (TAG, *DATES, "team_max_points")]
    return (
        managers.join(totals, TAG)
        .groupBy(*GROUP, *DATES)
        .agg(*[F.sum(c).alias(c) for c in added], F.max("team_max_points").alias("team_max_points"))
    )


def _mean(column: str):
    return F.round(F.col(column) / F.col(ROWS), 1)


def team_summary(mapping: DataFrame, rows: DataFrame) -> DataFrame:
    """Totals and averages per manager, business and week, as :func:`reports.team_summary` has them."""
    sums = per_manager(mapping, business_totals(rows)).drop("team_total_score", "team_previous_score")
    return W.with_team_size(
        sums.withColumns(
            {"team_avg_points": _mean("team_total_points"), "team_avg_points_change": _mean("team_points_change")}
        ),
        team_stats(mapping),
    )


def _name_counts(names: DataFrame, group: list[str]) -> DataFrame:
    """Distinct names per group; a namesake may be both active and inactive."""
    once = names.groupBy(*group, "member_full_name").agg(
        F.max("__active").alias("__active"), F.max("__idle").alias("__idle")
    )
    known = F.col("member_full_name").isNotNull()
    return once.groupBy(*group).agg(
        F.count("member_full_name").alias("total_team_members"),
        F.count_if(known & F.col("__active")).alias("active_members"),
        F.count_if(known & F.col("__idle")).alias("inactive_members"),
    )


def distinct_names(mapping: DataFrame, rows: DataFrame) -> DataFrame:
    """Distinct member names per manager and business name, in all, active and inactive.

    Most managers have one business of a name and take its counts.  Where there are
    two or more, their names meet in one group, which adds rows for these managers only.
    """
    names = rows.groupBy(TAG, "member_full_name").agg(
        F.max("has_activity").alias("__active"), F.max(~F.col("has_activity")).alias("__idle")
    )
    owned = mapping.select(*GROUP, TAG).distinct()
    # NULL names of managers group like any value
    spans = owned.groupBy(*GROUP).agg(F.min(TAG).alias(TAG), F.max(TAG).alias("__last"))
    alone = spans.where(F.col(TAG) == F.col("__last")).drop("__last")
    several = spans.where(F.col(TAG) != F.col("__last")).select(*GROUP)
    same = F.lit(True)
    for c in GROUP:
        same = same & owned[c].eqNullSafe(several[c])
    single = alone.join(_name_counts(names, [TAG]), TAG).drop(TAG)
    merged = _name_counts(owned.join(several, same, "left_semi").join(names, TAG).drop(TAG), GROUP)
    return single.unionByName(merged)


def summary_export(mapping: DataFrame, rows: DataFrame) -> DataFrame:
    """Header numbers per manager and business, as :func:`exports.summary_export` has them."""
    sums = per_manager(mapping, business_totals(rows))
    named = ranking.null_safe_join(
        sums.drop("active_members", "inactive_members"), distinct_names(mapping, rows), GROUP
    )
    return named.select(
        *GROUP,
        *DATES,
        D.long_date(WEEK).alias("week_start_formatted"),
        D.long_date("week_end_date").alias("week_end_formatted"),
        "total_team_members",
        "active_members",
        "inactive_members",
        "team_total_score",
        "team_previous_score",
        (F.col("team_total_score") - F.col("team_previous_score")).alias("team_score_change"),
        _mean("team_total_score").alias("avg_score_per_member"),
        D.sunday_week(WEEK).alias("week_number"),
        F.year(WEEK).cast("bigint").alias("year"),
    )


@dataclass(frozen=True)
class Shared:
    """Member rows once per team, and the managers of each team.

    A team is the set of businesses that a group of manager rows has, by default those of
    one e-mail.  ``rows`` carry ``ITEM``, which leads from a member of a business in a team to
    the ``managers`` it is shown to.
    """

    rows: DataFrame
    managers: DataFrame
    group: list[str]

    def with_rows(self, rows: DataFrame) -> Shared:
        return replace(self, rows=rows)

    def per_group(
        self, fn: Callable[[DataFrame, list[str]], DataFrame], heads: Callable[[DataFrame], DataFrame] = lambda who: who
    ) -> DataFrame:
        """``fn(rows, group)`` worked out per team; its result for each of the team's groups of managers.

        ``heads`` adds columns to the groups before they meet the result, whose lists and texts
        are then neither shuffled nor sorted per manager.
        """
        who = heads(self.managers.select(TEAM_ID, *self.group).distinct())
        found = fn(self.rows, [TEAM_ID, WEEK])
        names = [c for c in found.columns if c != TEAM_ID]
        own = [c for c in who.columns if c not in (TEAM_ID, *self.group)]
        return joins.spread(who, found, [TEAM_ID]).select(*self.group, *names, *own)

    def pairs(self) -> DataFrame:
        """Every manager with every member row of the team."""
        keys = [c for c in [*ITEM, WEEK] if c in self.managers.columns]
        both = set(self.managers.columns) & set(self.rows.columns) - set(keys)
        return joins.spread(self.managers, self.rows.drop(*both), keys).drop(*ITEM, COPIES)

    def ordered_pairs(self, order: list[Column], columns: list[str]) -> DataFrame:
        """Columns of the pairs in the order of the manager's group and then of ``order``, ascending.

        A team's rows are ranked once and cut into cells of ``CELL`` rows.  The managers' turns
        with the cells are numbered, and whole cells, not pairs, are shuffled and sorted by that
        number; the cells become rows at the end.  Each row finds its manager's columns by the
        place of its business in the team.
        """
        own = [c for c in self.managers.columns if c not in (*ITEM, *self.group)]
        place = Window.partitionBy(TEAM_ID).orderBy(TAG, NTH)
        items = self.managers.select(*ITEM).distinct().withColumn("__item", F.row_number().over(place))
        of_rows = [c for c in columns if c not in (*self.group, *own)]
        ranked = ranking.rank_rows(self.rows.join(items, ITEM), [TEAM_ID], order, "__place")
        cell = ((F.col("__place") - 1) / CELL).cast("int").alias("__cell")
        lines = F.array_sort(F.collect_list(F.struct("__place", "__item", *of_rows))).alias("__lines")
        cells = stored(ranked.groupBy(TEAM_ID, cell).agg(lines), "cells")
        last = cells.groupBy(TEAM_ID).agg(F.max("__cell").alias("__last"))
        who = self.managers.groupBy(*self.group, TEAM_ID).agg(
            F.array_sort(F.collect_list(F.struct(TAG, NTH, *own))).alias("__own")
        )
        turns = who.join(last, TEAM_ID).withColumn("__cell", F.explode(F.sequence(F.lit(0), "__last"))).drop("__last")
        turns = ranking.numbered(turns, [*[F.col(c) for c in self.group], F.col("__cell")], "__turn")
        return joins.dealt_in_order(
            joins.spread(turns, cells, [TEAM_ID, "__cell"], parts=4), "__turn", turns.count(), CELL
        ).select(*self.group, "__own", F.inline("__lines")).select(
            *[F.col("__own")[F.col("__item") - 1][c].alias(c) if c in own else c for c in columns]
        )

    def known(self, of_manager: list[str], of_member: list[str]) -> DataFrame:
        """Columns of the pairs, with the number of pairs that a row stands for in ``times``.

        Those of the manager only tell whether there is a value.
        """
        flags = [F.when(F.col(c).isNotNull(), True).alias(c) for c in of_manager]
        times = self.managers.groupBy(*ITEM, *flags).agg(F.count(F.lit(1)).alias("times"))
        return self.rows.select(*ITEM, *of_member).join(times, ITEM).drop(*ITEM)


def owners(mapping: DataFrame, group: list[str]) -> DataFrame:
    """Manager rows with the team that their group of rows has.

    Rows of one group for the same business are numbered, so that each stays a row of its own.
    ``COPIES`` is the number of summaries of the group, which the rankings repeat their rows for.
    """
    rows = mapping.select(*MANAGERS).distinct()
    place = Window.partitionBy(*group, TAG).orderBy(*[c for c in MANAGERS if c not in (*group, TAG)])
    rows = rows.withColumn(NTH, F.row_number().over(place))
    teams = rows.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct(TAG, NTH, "business_name"))).alias("__items"),
        F.size(F.collect_set(F.struct("manager_full_name", "business_name"))).alias(COPIES),
    )
    team = F.sha2(F.to_json(F.struct("__items", COPIES)), 256).alias(TEAM_ID)
    return ranking.null_safe_join(rows, teams.select(*group, COPIES, team), group)


def shared(mapping: DataFrame, rows: DataFrame, group: list[str] = ("manager_email",)) -> Shared:
    """The rows of :func:`member_rows` once per team of managers."""
    own = stored(owners(mapping, list(group)), "owners")
    teams = own.select(*ITEM, "business_name", COPIES).distinct()
    return Shared(teams.join(rows, TAG), own.drop(COPIES), list(group))


def team_engagement(
    mapping: DataFrame, members: DataFrame, tags: DataFrame, engagement: DataFrame, as_of: dt.date | str, n_weeks: int = 2
) -> DataFrame:
    """The rows of :func:`reports.team_engagement`; members meet their weeks first, once per business, and then its managers."""
    rows = W.member_weeks(managed_members(mapping, members, tags), engagement, as_of, n_weeks)
    return joins.spread(mapping.select(*MANAGERS).distinct(), rows, [TAG]).select(
        *W.MAPPING, *[c for c in rows.columns if c not in W.MAPPING]
    )


def team_weeks(
    mapping: DataFrame, members: DataFrame, tags: DataFrame, engagement: DataFrame, as_of: dt.date | str, n_weeks: int = 2
) -> Shared:
    """The rows of :func:`reports.team_engagement` once per team of managers."""
    return shared(mapping, W.member_weeks(managed_members(mapping, members, tags), engagement, as_of, n_weeks))


def manager_rankings(
    mapping: DataFrame, rows: DataFrame, per_business: bool = False, weights: dict[str, int] = R.POINTS
) -> Shared:
    """Newest week ranked per team, labelled; its pairs are the rows of :func:`reports.manager_rankings`."""
    group = ["manager_email", "business_name"] if per_business else ["manager_email"]
    found = shared(mapping, rows.drop("previous", "previous_week_engagement"), group)
    ranked = W.with_ranks(ranking.with_row_ids(found.rows), [TEAM_ID, WEEK])
    labelled = W.with_point_parts(W.with_labels(ranked), weights)
    summary = team_summary(mapping, rows).drop("manager_full_name", *[c for c in ["business_name"] if c not in group])
    heads = found.managers.drop(*[c for c in W.NOT_IN_RANKINGS if c != TAG])
    heads = W.with_long_dates(ranking.null_safe_join(heads, summary, group))
    return replace(found, rows=labelled.drop(*[c for c in W.NOT_IN_RANKINGS if c != TAG]), managers=heads)


def team_detail(mapping: DataFrame, rows: DataFrame) -> Shared:
    """Detail rows per team with its totals; its pairs are the rows of :func:`reports.team_detail`."""
    # the report joins its totals by e-mail
    found = shared(mapping.where(F.col("manager_email").isNotNull()), rows)
    counts = W.detail_counts(found.rows).select(*ITEM, "business_name", *W.DETAIL_ROW)
    totals = W.detail_totals(counts, [TEAM_ID, WEEK])
    heads = found.managers.select(*ITEM, *[c for c in W.DETAIL_MANAGER if c != "business_name"])
    return replace(found, rows=counts.join(totals, [TEAM_ID, WEEK]), managers=heads)


def manager_report_nested(
    mapping: DataFrame, rows: DataFrame, change: Callable[[DataFrame], DataFrame] = lambda report: report
) -> DataFrame:
    """One row per manager and business, as :func:`reports.manager_report_nested` has them.

    ``change`` is applied to the rows of the teams, before they are handed to the managers.
    """
    found = shared(mapping, rows, GROUP)
    stats = team_stats(mapping)
    both = found.per_group(
        lambda rows, group: change(W.nested_members(rows, [*group, "week_end_date"])),
        lambda who: who.join(stats, ["manager_email", "business_name"], "left"),
    )
    return W.size_or_rows(both).withColumnRenamed("manager_full_name", "manager_name")


def representatives(mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A mapping with one manager per team, and who has that team.

    For reports per e-mail and business name: groups of manager rows that have the same
    businesses, written under as many names, get the same report.  In the mapping, the team
    stands for the e-mail and the number of the name for the name.
    """
    group = ["manager_email", "business_name"]
    rows = mapping.where(F.col("manager_email").isNotNull()).select(*MANAGERS).distinct()
    number = F.dense_rank().over(Window.partitionBy(*group).orderBy("manager_full_name")).cast("string")
    place = Window.partitionBy(*group, TAG).orderBy(*[c for c in MANAGERS if c not in (*group, TAG)])
    rows = rows.withColumns({"__name": number, NTH: F.row_number().over(place)})
    items = F.array_sort(F.collect_list(F.struct(TAG, NTH, "__name"))).alias("__items")
    team = F.sha2(F.to_json(F.struct("__items", "business_name")), 256).alias(TEAM_ID)
    teams = rows.groupBy(*group).agg(items).select(*group, team)
    own = stored(ranking.null_safe_join(rows, teams, group), "owners")
    names = [F.col(TEAM_ID).alias("manager_email"), F.col("__name").alias("manager_full_name"), "business_name"]
    who = own.select(TEAM_ID, "__name", *GROUP).distinct()
    return own.select(*names, TAG, NTH).distinct().drop(NTH), who


def per_team_report(
    mapping: DataFrame, members: DataFrame, tags: DataFrame, report: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``report(relationships)`` worked out per team, its rows for each manager of the team.

    It has the manager's e-mail and business name, and the full name or not.
    """
    few, who = representatives(mapping)
    found = report(stored(business_relationships(few, members, tags), "few"))
    columns = found.columns
    found = found.withColumnRenamed("manager_email", TEAM_ID).drop("business_name")
    keys = [TEAM_ID]
    if "manager_full_name" in columns:
        found = found.withColumnRenamed("manager_full_name", "__name")
        keys.append("__name")
    else:
        who = who.drop("__name", "manager_full_name").distinct()
    return joins.spread(who, found, keys).select(*columns)
