"""The weekly and the monthly run: raw tables in, stored tables and reports out.

Stored tables are what the plans share.  Each is written once and read back, so a
report never recomputes the steps below it and lineage stays short.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.functions.rules import METRICS
from teampulse.operators import incremental as I
from teampulse.operators.grid import MEMBER, WEEK
from teampulse.plans import checks as CH
from teampulse.plans import engagement as E
from teampulse.plans import exports as X
from teampulse.plans import metrics as M
from teampulse.plans import monthly as MO
from teampulse.plans import relations as B
from teampulse.plans import reports as W
from teampulse.plans import staging as C
from teampulse.plans import teams as T
from teampulse.session import run_scratch, stored
from teampulse.sources import landing as L
from teampulse.sources import tables
from teampulse.sources.schemas import EXTRACTED_AT

# layer of each stored table, as folder names below the root
STAGING, INTERMEDIATE, MARTS, EXPORTS = "staging", "intermediate", "marts", "exports"

# feed -> (cleaning, keys, row that stays when a key repeats)
FEEDS = {
    "post_comment_created": ("comments", C.clean_comments, ["record_id"], None),
    "post_comment_liked": ("comment_likes", C.clean_comment_likes, ["record_id"], None),
    "post_liked": ("post_likes", C.clean_post_likes, ["record_id"], None),
    "course_lesson_completed": ("lessons", C.clean_lessons, ["record_id"], None),
    # the first completion survives a later one, also one from another run
    "course_completed": ("courses", C.clean_courses, ["initiator_email", "course_id"], ["created_at", "record_id"]),
}
WEEKLY_KEYS = [MEMBER, WEEK]
KNOWN = "known_members"  # ids with rows in the engagement table
UPDATED, REPORTED = "updated_at", "report_generated_at"
CLEANED, TRANSFORMED = "cleaned_at", "transformed_at"


@dataclass
class Store:
    """Stored tables below one root folder."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def has(self, layer: str, name: str) -> bool:
        return tables.exists(self.spark, f"{self.path(layer, name)}/{tables.COLUMNS}")

    def read(self, layer: str, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.path(layer, name))

    def read_or_none(self, layer: str, name: str) -> DataFrame | None:
        return self.read(layer, name) if self.has(layer, name) else None

    def newest(self, layer: str, name: str, column: str) -> dt.date | dt.datetime | None:
        """Greatest value that a stored table's writes have noted, without a job; None without the table."""
        return tables.newest(self.spark, self.path(layer, name), column) if self.has(layer, name) else None

    def flat(self, layer: str, name: str, df: DataFrame, spread: list[str] = ()) -> DataFrame:
        return tables.replace_flat(df, self.path(layer, name), spread)


def load_feeds(
    store: Store, raw: dict[str, DataFrame], full_refresh: bool = False, first_wins: bool = True, late: dict[str, dt.datetime] | None = None
) -> dict:
    """Clean what was extracted since the last run and upsert it.

    ``first_wins=False`` lets a repeated course completion overwrite the stored one.  ``late``
    gives extraction times, by feed, from which rows have to be read although they are older
    than the watermark.
    """
    out = {}
    for feed, (name, clean, keys, first) in FEEDS.items():
        path = store.path(STAGING, name)
        target = None if full_refresh else store.read_or_none(STAGING, name)
        newest = None if target is None else store.newest(STAGING, name, EXTRACTED_AT)
        if newest is not None and late and late.get(feed) is not None:
            newest = min(newest, late[feed])
        fresh = clean(I.newly_extracted(raw[feed], newest))
        if target is None:
            out[name] = tables.replace_table(fresh, path, "created_at", keys, lookup=keys)
            continue
        order = [F.col(c).asc() for c in first] if first and first_wins else None
        out[name] = tables.upsert(store.spark, path, fresh, keys, "created_at", keys, order)
    out["attendees"] = C.clean_attendees(raw["event_attendees"])
    return out


def load_weekly(store: Store, feeds: dict[str, DataFrame], full_refresh: bool = False) -> dict[str, DataFrame]:
    """Recount the recent weeks of each metric and upsert them."""
    out = {}
    for name in METRICS:
        target = None if full_refresh else store.read_or_none(INTERMEDIATE, f"weekly_{name}")
        fresh = M.weekly_tables(feeds, I.weeks_since(None if target is None else store.newest(INTERMEDIATE, f"weekly_{name}", WEEK)))[name]
        path = store.path(INTERMEDIATE, f"weekly_{name}")
        if target is None:
            out[name] = tables.replace_table(fresh, path, WEEK, WEEKLY_KEYS)
        else:
            out[name] = tables.upsert(store.spark, path, fresh, WEEKLY_KEYS, WEEK, WEEKLY_KEYS)
    return out


def load_engagement(
    store: Store, members: DataFrame, weekly: dict[str, DataFrame], as_of: dt.date, full_refresh: bool = False,
    spine: str = "activity", run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Full build on the first run or on request, else recent weeks and backfills.

    ``updated_at`` is the time of the run that wrote a row.  The ids that have rows are
    kept in a table of their own, so an incremental run asks that and never the history.
    It is written last: after a run that broke off in between, the missing ids count as
    new and get the same rows again.  Ids may stand there twice.
    """
    target = None if full_refresh else store.read_or_none(INTERMEDIATE, "engagement")
    path = store.path(INTERMEDIATE, "engagement")
    stamp = F.lit(run_time(as_of, run_ts)).alias(UPDATED)
    if target is None:
        rows = E.engagement_full(members, weekly, spine, as_of).select("*", stamp)
        done = tables.replace_table(rows, path, WEEK, WEEKLY_KEYS)
        store.flat(INTERMEDIATE, KNOWN, E.known_members(done))
        return done
    newest = store.newest(INTERMEDIATE, "engagement", WEEK)
    known = store.read_or_none(INTERMEDIATE, KNOWN)
    if known is None:
        # a store from before the ids were kept
        known = store.flat(INTERMEDIATE, KNOWN, E.known_members(target))
    marked = stored(E.mark_new(members, known, newest), "marked")
    changes = E.changes_of(marked, weekly, newest, as_of).select("*", stamp)
    done = tables.upsert(store.spark, path, changes, WEEKLY_KEYS, WEEK, WEEKLY_KEYS)
    fresh = E.weeks_to_build(marked.where("is_backfill"), newest, as_of).select(MEMBER)
    tables.append_flat(stored(fresh.join(known, MEMBER, "left_anti"), "fresh"), store.path(INTERMEDIATE, KNOWN))
    return done


def run_time(as_of: dt.date, run_ts: dt.datetime | None) -> dt.datetime:
    """The given time of the run, else midnight of its day; plans never ask for the current time."""
    return run_ts or dt.datetime.combine(as_of, dt.time(), dt.timezone.utc)


def load_relations(store: Store, members: DataFrame, raw: dict[str, DataFrame], as_of, staff_tag=None, run_ts=None) -> dict:
    stamp = F.lit(run_time(as_of, run_ts)).alias(TRANSFORMED)
    tags = store.flat(STAGING, "tags", C.clean_tags(raw["member_tags_list"], as_of, staff_tag))
    invited = C.clean_invited_managers(raw["managers_not_joined"])
    businesses = store.flat(MARTS, "businesses", B.business_names(tags, members).select("*", stamp)).drop(TRANSFORMED)
    mapping = store.flat(MARTS, "manager_mapping", B.manager_mapping(members, tags, invited, businesses))
    pairs = B.business_relationships(mapping, members, tags).select("*", stamp)
    relations = store.flat(MARTS, "relationships", pairs, B.SPREAD).drop(TRANSFORMED)
    return {
        "tags": tags,
        "businesses": businesses,
        "mapping": mapping,
        "relationships": relations,
        "businesses_without_managers": store.flat(
            MARTS, "businesses_without_managers", B.businesses_without_managers(businesses, relations, members, tags)
        ),
    }


@dataclass
class Loaded:
    """Tables that the weekly and the monthly run share."""

    members: DataFrame
    feeds: dict[str, DataFrame]
    related: dict[str, DataFrame]


def refresh(
    store: Store, raw: dict[str, DataFrame], as_of: dt.date, full_refresh: bool = False, staff_tag: str | None = None,
    late: dict[str, dt.datetime] | None = None, run_ts: dt.datetime | None = None,
) -> Loaded:
    """Take in what was extracted since the last run of either kind.

    Stored members, businesses and relationships carry the time of the run; the frames that
    the plans go on with do not.
    """
    members = store.flat(STAGING, "members", C.clean_members(raw["community_members"], as_of, run_time(as_of, run_ts))).drop(CLEANED)
    feeds = load_feeds(store, raw, full_refresh, late=late)
    return Loaded(members, feeds, load_relations(store, members, raw, as_of, staff_tag, run_ts))


def run_weekly(
    spark: SparkSession,
    root: str,
    raw: dict[str, DataFrame],
    as_of: dt.date,
    full_refresh: bool = False,
    staff_tag: str | None = None,
    spine: str = "activity",
    run_ts: dt.datetime | None = None,
    late: dict[str, dt.datetime] | None = None,
) -> dict[str, DataFrame]:
    """One weekly run over the raw tables; returns the stored tables, the findings and the exports."""
    store = Store(spark, root)
    with run_scratch(spark, root):
        before = {} if full_refresh else _sizes(store, [(INTERMEDIATE, "engagement")])
        loaded = refresh(store, raw, as_of, full_refresh, staff_tag, late, run_ts)
        weekly = load_weekly(store, loaded.feeds, full_refresh)
        people = C.unique_members(loaded.members)
        engagement = load_engagement(store, people, weekly, as_of, full_refresh, spine, run_ts)
        relations = loaded.related["relationships"]
        stamp = F.lit(run_time(as_of, run_ts)).alias(REPORTED)

        def report(name: str, df: DataFrame) -> DataFrame:
            return tables.replace_table(df, store.path(MARTS, name), WEEK, ["manager_email", WEEK], many_months=False)

        # rows of the newest week; the week before is in their ``previous`` column
        team = report("team", W.team_engagement(relations, engagement, as_of, keep_weeks=1))
        # totals come from the members of each business, once, and not from the pairs
        mapping = loaded.related["mapping"]
        managed = T.managed_members(mapping, loaded.members, loaded.related["tags"])
        members = store.flat(INTERMEDIATE, "team_members", T.member_rows(managed, engagement, as_of))
        summary = T.team_summary(mapping, members)
        rankings = report("rankings", W.manager_rankings(team, relations, summary=summary).select("*", stamp))
        detail = report("detail", W.team_detail(team).select("*", stamp))
        nested = report("nested", W.manager_report_nested(team, relations).select("*", stamp))
        checked = {"engagement": engagement, "rankings": rankings, "detail": detail}
        found = store.flat(MARTS, "weekly_findings", CH.findings(checked, before))
        exports = {
            "manager_list": X.manager_list(rankings),
            "top_performers": X.top_performers(rankings),
            "top_movers": X.top_movers(rankings),
            "action_points": X.action_points(rankings),
            "pdf_blocks": X.pdf_blocks(rankings),
            "team_detail": X.team_detail_export(detail),
            "summary": T.summary_export(mapping, members),
            "top3": X.top3_export(detail),
        }
        exports = {name: store.flat(EXPORTS, name, rows) for name, rows in exports.items()}
    return {
        **loaded.related,
        "members": loaded.members,
        "engagement": engagement,
        "team": team,
        "rankings": rankings,
        "detail": detail,
        "nested": nested,
        "findings": found,
        **exports,
        "courses": loaded.feeds["courses"],
    }


def _sizes(store: Store, names: list[tuple[str, str]]) -> dict[str, int]:
    """Row counts of stored tables, from the files' footers."""
    found = {name: store.read_or_none(layer, name) for layer, name in names}
    return {name: df.count() for name, df in found.items() if df is not None}


def run_monthly(
    store: Store,
    raw: dict[str, DataFrame],
    as_of: dt.date,
    full_refresh: bool = False,
    staff_tag: str | None = None,
    run_ts: dt.datetime | None = None,
    late: dict[str, dt.datetime] | None = None,
) -> dict[str, DataFrame]:
    """One monthly run over the raw tables: takes in what is new, counts courses and writes the report."""
    with run_scratch(store.spark, store.root):
        loaded = refresh(store, raw, as_of, full_refresh, staff_tag, late, run_ts)
        courses = loaded.feeds["courses"]
        target = None if full_refresh else store.read_or_none(INTERMEDIATE, "monthly_courses")
        fresh = M.monthly_courses(courses, I.months_since(None if target is None else store.newest(INTERMEDIATE, "monthly_courses", M.MONTH)))
        keys = [MEMBER, M.MONTH]
        path = store.path(INTERMEDIATE, "monthly_courses")
        if target is None:
            counts = tables.replace_table(fresh, path, M.MONTH, keys)
        else:
            counts = tables.upsert(store.spark, path, fresh, keys, M.MONTH, keys)
        stamp = F.lit(run_time(as_of, run_ts)).alias(REPORTED)
        report = store.flat(MARTS, "monthly_report", MO.monthly_report(courses, loaded.related["relationships"]).select("*", stamp))
        found = store.flat(MARTS, "monthly_findings", CH.findings({"monthly_report": report}))
    return {"monthly_courses": counts, "monthly_report": report, "findings": found}


def run_landed(
    spark: SparkSession, root: str, landing: str, as_of: dt.date, monthly: bool = False, archive: str | None = None, **options
) -> dict[str, DataFrame]:
    """One weekly or monthly run from landed files; ``options`` go to that run.

    Returns its tables, the cleaned record lists, which are stored too, and ``rejected``, the
    landed lines that no table took.  Files are noted
    as used only when the run has ended: a run that broke off leaves them to the next one.
    """
    raw = L.take_in(spark, landing, root, archive)
    used = L.unsettled(spark, root)
    late = {feed: earliest for feed, (_, earliest) in used.items()}
    store = Store(spark, root)
    out = run_monthly(store, raw, as_of, late=late, **options) if monthly else run_weekly(spark, root, raw, as_of, late=late, **options)
    at = run_time(as_of, options.get("run_ts"))
    cleaned = {
        "events": C.clean_events(raw["events_list"], at),
        "attendees": C.clean_attendees(raw["event_attendees"], at),
        "invited": C.clean_invited_managers(raw["managers_not_joined"], at),
    }
    cleaned = {name: store.flat(STAGING, name, rows) for name, rows in cleaned.items()}
    L.settle(spark, root, used)
    return {**out, **cleaned, "rejected": L.rejected_rows(spark, root)}
