"""Ordered rules that turn values into labels.  The first rule that holds wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from teampulse.functions.safe import ratio, zero_if_null
from teampulse.functions.text import _col, trim_ws

# Tag names and categories of the community platform.  A trailing
# or surrounding % is a LIKE pattern; all comparisons are in lower case.
TAG_RULES = [
    ("basic", "membership_tier"),
    ("pro", "membership_tier"),
    ("individuals", "membership_tier"),
    ("individual", "membership_tier"),
    ("annual discount", "membership_tier"),
    ("free trial%", "membership_tier"),
    ("business%", "business_role"),
    ("manager", "business_role"),
    ("instructor", "community_role"),
    ("completed -%", "course_completion"),
    ("checklist completed", "course_completion"),
    ("%cancelled%", "cancellation"),
    ("cancel confirmed%", "cancellation"),
    ("removed from all space group", "removed"),
    ("ac -%", "migration"),
    ("source is thinkific", "migration"),
    ("resell", "acquisition"),
]
BUSINESS_CATEGORY = "potential_business_name"

# Tags that decide visibility beside a member's name.
ALWAYS_VISIBLE = ["pro", "instructor"]
NEVER_VISIBLE = ["basic", "individuals", "checklist completed"]

# Names that are no businesses even in the business category.
NOT_A_BUSINESS = [
    "manager",
    "business",
    "individual",
    "individuals",
    "team",
    "member",
    "staff",
    "partner",
    "checklist completed",
]
MAX_BUSINESS_NAME = 100

# Roster tags that never name the business.
ROSTER_SYSTEM_TAGS = [
    "business",
    "manager",
    "pro",
    "basic",
    "individual",
    "partner",
    "source is thinkific",
    "checklist completed",
    "ac - master list import",
]
ROSTER_SYSTEM_PATTERNS = ["completed -%", "cancel confirmed%", "%cancelled%"]

# Parts of a name that look corporate, matched anywhere.
CORPORATE_WORDS = [
    "Inc",
    "LLC",
    "Ltd",
    "Corporation",
    "Corp",
    "Company",
    r"Co\.",
    "Group",
    "Industries",
    "International",
    "Solutions",
    "Technologies",
    "Tech",
    "Systems",
    "Services",
]

# Points per activity.
POINTS = {
    "classes_attended": 5,
    "lessons_completed": 1,
    "likes_received": 1,
    "comments_received": 1,
    "comments_made": 1,
}
METRICS = list(POINTS)


def first_match(rules, default) -> Column:
    """Chain ``(condition, value)`` pairs into one CASE expression."""
    out = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default)


def matches(word: Column, pattern: str) -> Column:
    return word.like(pattern) if "%" in pattern else word == pattern


def tag_category(name, staff_tag: str | None = None) -> Column:
    """Category of a tag name; ``staff_tag`` is the house's own team tag, if it has one."""
    word = F.lower(_col(name))
    rules = [(matches(word, p), cat) for p, cat in TAG_RULES]
    if staff_tag:
        rules.insert(0, (word == staff_tag.lower(), "community_role"))
    return first_match(rules, BUSINESS_CATEGORY)


def tag_visible(name, on_profile, in_directory) -> Column:
    word = F.lower(_col(name))
    shown = _col(on_profile) & _col(in_directory)
    plain = ~word.like("completed -%") & ~word.isin(NEVER_VISIBLE)
    return first_match([(word.isin(ALWAYS_VISIBLE), True), (shown & plain, True)], False)


def tag_course(name) -> Column:
    """Course named by a completion tag, else NULL."""
    name = _col(name)
    rest = F.regexp_replace(name, r"(?i)^completed\s*-\s*", "")
    return F.when(F.lower(name).like("completed -%"), trim_ws(rest))


def profile_completeness(first_ok, last_ok, email_ok) -> Column:
    return first_match(
        [(_col(first_ok) & _col(last_ok) & _col(email_ok), "complete"), (_col(email_ok), "partial")],
        "incomplete",
    )


def business_confidence(category, visible, members) -> Column:
    business = _col(category) == BUSINESS_CATEGORY
    shown = business & _col(visible)
    n = zero_if_null(members)
    return first_match(
        [(shown & (n >= 2), "high"), (shown & (n == 1), "medium"), (business, "low")], "not_business"
    )


def looks_corporate(name) -> Column:
    return F.coalesce(_col(name).rlike("(?i)(" + "|".join(CORPORATE_WORDS) + ")"), F.lit(False))


def not_a_business(name) -> Column:
    return F.lower(_col(name)).isin(NOT_A_BUSINESS) | (F.length(_col(name)) > MAX_BUSINESS_NAME)


def business_size(members) -> Column:
    n = _col(members)
    return first_match(
        [
            (n >= 20, "large"),
            (n.between(10, 19), "medium"),
            (n.between(5, 9), "small"),
            (n.between(2, 4), "micro"),
        ],
        "single",
    )


def business_age(days) -> Column:
    d = _col(days)
    return first_match([(d <= 30, "newly_added"), (d <= 90, "recent"), (d <= 365, "established")], "long_term")


def roster_business(items: Column) -> Column:
    """Longest roster tag that is not one of the platform's own tags."""
    from teampulse.functions.text import longest_item

    def own(t):
        word = F.lower(t)
        ok = ~word.isin(ROSTER_SYSTEM_TAGS)
        for p in ROSTER_SYSTEM_PATTERNS:
            ok = ok & ~word.like(p)
        return ok

    return longest_item(items, own)


def points_for(metric: str, weights: dict[str, int] = POINTS) -> Column:
    return F.col(metric) * F.lit(weights[metric]).cast("bigint")


def weighted_points(weights: dict[str, int] = POINTS) -> Column:
    out = None
    for metric in weights:
        part = points_for(metric, weights)
        out = part if out is None else out + part
    return out


def performance_category(points="total_points", rank="performance_rank", pct="performance_percentile") -> Column:
    return first_match(
        [
            (_col(points) == 0, "no_activity"),
            (_col(rank) <= 3, "top_performer"),
            (_col(pct) >= 0.7, "high_performer"),
            (_col(pct) >= 0.3, "average_performer"),
        ],
        "low_performer",
    )


def momentum_category(change="points_change", rank="mover_rank") -> Column:
    change = _col(change)
    return first_match(
        [
            ((_col(rank) <= 3) & (change > 0), "top_mover"),
            (change >= 5, "improving"),
            (change <= -5, "declining"),
            (F.abs(change) < 5, "stable"),
        ],
        "new_member",
    )


def is_top_performer() -> Column:
    return (F.col("performance_rank") <= 3) & (F.col("total_points") > 0)


def is_top_mover() -> Column:
    return (F.col("mover_rank") <= 3) & (F.col("points_change") > 0)


def suggested_action() -> Column:
    """One sentence per member: celebrate, encourage, re-engage or nothing."""
    name, points, change = (F.col(c) for c in ("member_first_name", "total_points", "points_change"))
    idle = (points == 0) & (F.col("inactive_rank") <= 3)
    # The report's wording.
    celebrate = F.concat(
        F.lit("🏆 Celebrate "), name, F.lit(" for leading the team with "), points.cast("string"), F.lit(" points")
    )
    encourage = F.concat(
        F.lit("📈 Encourage "),
        name,
        F.lit(" to keep up the momentum (+"),
        change.cast("string"),
        F.lit(" pts this week)"),
    )
    was_active = F.concat(
        F.lit("⚠️ Re-engage "), name, F.lit(" with a lesson or live class invite (was active last week)")
    )
    was_idle = F.concat(F.lit("💬 Re-engage "), name, F.lit(" with a personalized message or invitation"))
    return first_match(
        [
            (is_top_performer(), celebrate),
            (is_top_mover(), encourage),
            (idle & (F.col("previous_week_points") > 0), was_active),
            (idle, was_idle),
        ],
        None,
    )


def strong_jump(change, previous) -> Column:
    """True for a start from zero or growth by at least one half."""
    return (zero_if_null(previous) == 0) | (ratio(change, previous) >= 0.5)


def growth_label(change, previous, otherwise: str = "steady progress") -> Column:
    return F.when(strong_jump(change, previous), "strong jump this week").otherwise(otherwise)


def community_events() -> Column:
    """Likes and comments of a row, missing counts as zero."""
    return zero_if_null("likes_received") + zero_if_null("comments_received") + zero_if_null("comments_made")


def mover_driver() -> Column:
    """What made a top mover move, judged by the largest of three activity counts."""
    lessons, classes, social = F.col("lessons_completed"), F.col("classes_attended"), community_events()
    beats_classes = (lessons >= classes) & (social >= classes)
    return first_match(
        [
            ((lessons > 0) & (social > 0) & beats_classes, "more lessons + engagement"),
            ((lessons > 0) & (lessons >= F.greatest(classes, social)), "more lessons"),
            ((classes > 0) & (classes >= F.greatest(lessons, social)), "more live classes"),
            (social > 0, "higher engagement"),
        ],
        growth_label("points_change", "previous_week_points", "steady growth"),
    )


def comment_type(parent) -> Column:
    return F.when(_col(parent).isNotNull(), "reply").otherwise("top_level")


def comment_engagement(likes, replies) -> Column:
    liked, replied = _col(likes) > 0, _col(replies) > 0
    none = (_col(likes) == 0) & (_col(replies) == 0)
    return first_match(
        [
            (none, "no_engagement"),
            (liked & (_col(replies) == 0), "liked"),
            ((_col(likes) == 0) & replied, "replied"),
            (liked & replied, "highly_engaged"),
        ],
        None,
    )


def commenter_level(comments) -> Column:
    n = _col(comments)
    return first_match(
        [
            (n.between(1, 5), "new_commenter"),
            (n.between(6, 20), "regular_commenter"),
            (n.between(21, 50), "active_commenter"),
            (n > 50, "power_commenter"),
        ],
        "unknown",
    )
