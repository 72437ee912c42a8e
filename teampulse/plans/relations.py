"""Businesses, their managers and their members, found through tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.functions import rules as R
from teampulse.functions import safe as N
from teampulse.operators import dedup, joins, ordered, ranking

TAG = "business_tag_id"
SPREAD = ["manager_email", "member_community_id"]  # evens out the files of the relationship table


def tag_member_counts(members: DataFrame) -> DataFrame:
    """Distinct e-mails per tag; the count spreads by (tag, e-mail), so a tag on every member is no hot spot."""
    rows = members.select(F.explode("tag_ids").alias("tag_id"), "email")
    return rows.groupBy("tag_id").agg(F.countDistinct("email").alias("actual_member_count"))


def system_tags(tags: DataFrame) -> DataFrame:
    """Ids of the two role tags as one row."""
    word = F.lower("tag_name")
    return tags.agg(
        F.max(F.when(word == "manager", F.col("tag_id"))).alias("manager_tag_id"),
        F.max(F.when(word == "business", F.col("tag_id"))).alias("business_tag_id"),
    )


def _role_ids(tags: DataFrame):
    row = system_tags(tags)
    return row.select("manager_tag_id").scalar(), row.select("business_tag_id").scalar()


def candidate_businesses(tags: DataFrame, members: DataFrame) -> DataFrame:
    """Tags that name a business and have members, with confidence and size."""
    named = tags.where((F.col("tag_category") == R.BUSINESS_CATEGORY) & ~R.not_a_business("tag_name"))
    counted = named.join(tag_member_counts(members), "tag_id", "inner").where("actual_member_count > 0")
    return counted.select(
        "tag_id",
        F.col("tag_name").alias("business_name"),
        "actual_member_count",
        F.col("tagged_members_count").alias("api_member_count"),
        "visible_beside_name",
        "is_public",
        "created_at",
        "updated_at",
        "days_since_created",
        R.business_confidence("tag_category", "visible_beside_name", "actual_member_count").alias("confidence_level"),
        R.looks_corporate("tag_name").alias("has_corporate_suffix"),
        R.business_size("actual_member_count").alias("business_size"),
        R.business_age("days_since_created").alias("business_age_category"),
    )


def business_names(tags: DataFrame, members: DataFrame) -> DataFrame:
    """Businesses ranked by member count, newest first among equals."""
    keys = [-F.col("actual_member_count"), -F.unix_micros("created_at"), F.col("tag_id")]
    # a missing creation time sorts last in a descending order
    keys = [keys[0], F.col("created_at").isNull().cast("int"), keys[1], keys[2]]
    return ranking.global_rank(candidate_businesses(tags, members), keys, "business_rank")


def managers(members: DataFrame, tags: DataFrame) -> DataFrame:
    """Members with both role tags."""
    manager_id, business_id = _role_ids(tags)
    return (
        members.where(joins.has_item("tag_ids", manager_id) & joins.has_item("tag_ids", business_id))
        .select(
            F.col("community_member_id").alias("manager_community_id"),
            F.col("first_name").alias("manager_first_name"),
            F.col("last_name").alias("manager_last_name"),
            F.col("full_name").alias("manager_full_name"),
            F.col("email").alias("manager_email"),
            "tag_ids",
        )
        .distinct()
    )


def team_members(members: DataFrame, tags: DataFrame) -> DataFrame:
    """Members with the business tag and without the manager tag, one row per tag they carry.

    The role tag itself, which all of them carry, names no business and is left out.
    """
    manager_id, business_id = _role_ids(tags)
    return members.where(
        (F.size("tag_ids") > 0)
        & joins.has_item("tag_ids", business_id)
        & ~joins.has_item("tag_ids", manager_id)
    ).select(
        F.col("community_member_id").alias("member_community_id"),
        F.col("first_name").alias("member_first_name"),
        F.col("last_name").alias("member_last_name"),
        F.col("full_name").alias("member_full_name"),
        F.col("email").alias("member_email"),
        F.col("profile_completeness").alias("member_profile_completeness"),
        F.explode(F.array_remove("tag_ids", business_id)).alias(TAG),
    )


def _business_columns(businesses: DataFrame) -> DataFrame:
    return businesses.select(
        F.col("tag_id").alias(TAG),
        "business_name",
        F.col("actual_member_count").alias("business_total_members"),
        "business_size",
        F.col("confidence_level").alias("business_confidence"),
    )


def community_assignments(members: DataFrame, tags: DataFrame, businesses: DataFrame) -> DataFrame:
    """Managers among the members, once per business tag they carry."""
    found = joins.on_array_member(managers(members, tags), "tag_ids", _business_columns(businesses), TAG)
    return found.drop("tag_ids").withColumns(
        {
            "manager_in_community": F.lit(True),
            "manager_source": F.lit("community"),
            "invitation_status": F.lit(None).cast("string"),
            "invitation_date": F.lit(None).cast("timestamp"),
            "join_date": F.lit(None).cast("timestamp"),
        }
    )


def invited_assignments(invited: DataFrame, businesses: DataFrame) -> DataFrame:
    """Managers from the roster, matched to a business by its written name."""
    rows = invited.where(F.col("business_name_from_tags").isNotNull()).select(
        F.col("manager_id").alias("manager_community_id"),
        F.col("first_name").alias("manager_first_name"),
        F.col("last_name").alias("manager_last_name"),
        "manager_full_name",
        "manager_email",
        F.coalesce("member_in_community", F.lit(False)).alias("manager_in_community"),
        F.lit("invited_csv").alias("manager_source"),
        "invitation_status",
        "invitation_date",
        "join_date",
        "business_name_from_tags",
    )
    found = joins.on_normal_name(rows, "business_name_from_tags", _business_columns(businesses), "business_name")
    return found.drop("business_name_from_tags")


def one_assignment(assignments: DataFrame) -> DataFrame:
    """One row per e-mail and business: community first, then joined, then the newest invitation."""
    rows = assignments.withColumn("__mail", F.lower("manager_email"))
    order = [
        F.when(F.col("manager_source") == "community", 1).otherwise(2).asc(),
        F.col("manager_in_community").desc(),
        F.col("invitation_date").desc(),
        F.col("manager_community_id").asc(),
    ]
    return dedup.keep_first(rows, ["__mail", TAG], order).drop("__mail")


def with_team_size(assignments: DataFrame) -> DataFrame:
    """Members of the business who are not active managers, at least zero."""
    active = (
        assignments.where("manager_in_community")
        .groupBy(TAG)
        .agg(F.countDistinct("manager_community_id").alias("__managers"))
    )
    size = N.floor_at_zero(F.col("business_total_members") - N.zero_if_null("__managers"))
    return assignments.join(active, TAG, "left").withColumn("team_size", size).drop("__managers")


def manager_mapping(members: DataFrame, tags: DataFrame, invited: DataFrame, businesses: DataFrame) -> DataFrame:
    """Managers of each business from both origins, once per e-mail and business."""
    both = community_assignments(members, tags, businesses).unionByName(invited_assignments(invited, businesses))
    return with_team_size(one_assignment(both))


def business_relationships(mapping: DataFrame, members: DataFrame, tags: DataFrame) -> DataFrame:
    """Every manager of a business with every member of its team; managers without a team stay.

    ``mapping`` is read twice, so store it first.  The pairs are far more than the rows on
    both sides, so they are made in :func:`joins.spread`.
    """
    team = team_members(members, tags)
    found = joins.spread(mapping, team, [TAG])
    lonely = mapping.join(team.select(TAG).distinct(), TAG, "left_anti")
    rows = found.unionByName(lonely, allowMissingColumns=True)
    kind = F.when(F.col("member_community_id").isNotNull(), "has_team").otherwise("manager_only")
    return rows.withColumn("relationship_type", kind)


def businesses_without_managers(
    businesses: DataFrame, relationships: DataFrame, members: DataFrame, tags: DataFrame
) -> DataFrame:
    """Businesses nobody manages, with the members who could.

    ``relationships`` may be the manager mapping, which names the same businesses without the pairs.
    """
    managed = relationships.select(F.col(TAG).alias("tag_id")).distinct()
    open_ones = businesses.join(managed, "tag_id", "left_anti")
    manager_id, business_id = _role_ids(tags)
    free = members.where(
        (~joins.has_item("tag_ids", manager_id) | manager_id.isNull()) & F.col("email").isNotNull()
    ).select(
        "email",
        # the role tag, which nearly all carry, names no business; without such a tag nothing goes
        F.coalesce(F.array_remove("tag_ids", business_id), F.col("tag_ids")).alias("tag_ids"),
    )
    candidates = joins.on_array_member(free, "tag_ids", open_ones.select("tag_id"), "tag_id")
    lists = ordered.text_per_group(candidates, ["tag_id"], [F.col("email")], F.col("email"), ", ", "__mails")
    # The report's wording.
    advice = F.concat(
        F.lit("Add Manager tag to at least one member from: "), F.coalesce("__mails", F.lit("NO MEMBERS FOUND"))
    )
    return (
        open_ones.join(lists, "tag_id", "left")
        .withColumn("action_needed", advice)
        .withColumnRenamed("tag_id", TAG)
        .drop("__mails", "api_member_count")
    )


def team_stats(relationships: DataFrame) -> DataFrame:
    """Team size and business total per manager and business."""
    return relationships.groupBy("manager_email", "business_name").agg(
        F.max("team_size").alias("team_size"), F.max("business_total_members").alias("business_total_members")
    )
