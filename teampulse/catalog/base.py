"""Registry of queries and the stored tables they share."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from teampulse.catalog import fixtures as X
from teampulse.operators.grid import MEMBER, WEEK
from teampulse.plans import engagement as E
from teampulse.plans import metrics as M
from teampulse.plans import relations as B
from teampulse.plans import reports as W
from teampulse.plans import staging as C
from teampulse.plans import teams as T
from teampulse.session import configure, scratch_path
from teampulse.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Base:
    """Fixture tables of one data folder.

    Cleaned inputs are lazy.  The tables that the reports read are written once to
    the shared folder, as the weekly run does, and read back.
    """

    _known: dict[tuple[str, str], Base] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Base:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    def table(self, name: str) -> DataFrame:
        return X.table(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        """A raw table of the fixtures by its function name."""
        return getattr(X, name)(self.spark, self.sf_dir)

    def feed(self, name: str, with_copies: bool = True) -> DataFrame:
        return X.feed(self.spark, self.sf_dir, name, with_copies)

    def path(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def stored(self, name: str, df: DataFrame, spread: list[str] = ()) -> DataFrame:
        return tables.replace_flat(df, self.path(name), spread)

    @cached_property
    def members(self) -> DataFrame:
        return self.stored("members", C.clean_members(self.raw("community_members"), X.AS_OF))

    @cached_property
    def people(self) -> DataFrame:
        return C.unique_members(self.members)

    @cached_property
    def tags(self) -> DataFrame:
        return self.stored("tags", C.clean_tags(self.raw("member_tags_list"), X.AS_OF))

    @cached_property
    def invited(self) -> DataFrame:
        return self.stored("invited", C.clean_invited_managers(self.raw("managers_not_joined")))

    @cached_property
    def feeds(self) -> dict[str, DataFrame]:
        return {
            "attendees": C.clean_attendees(self.raw("event_attendees")),
            "lessons": C.clean_lessons(self.feed("course_lesson_completed")),
            "post_likes": C.clean_post_likes(self.feed("post_liked")),
            "comment_likes": C.clean_comment_likes(self.feed("post_comment_liked")),
            "comments": C.clean_comments(self.feed("post_comment_created")),
        }

    @cached_property
    def courses(self) -> DataFrame:
        return self.stored("courses", C.clean_courses(self.raw("course_completed")))

    @cached_property
    def weekly(self) -> dict[str, DataFrame]:
        # two of the tables count comments, which are parsed and cleaned once for both
        comments = self.stored("comments", self.feeds["comments"].select(*M.COMMENT_COLUMNS))
        feeds = self.feeds | {"comments": comments}
        return {k: self.stored(k, v) for k, v in M.weekly_tables(feeds).items()}

    @cached_property
    def engagement(self) -> DataFrame:
        return self.stored("engagement", E.engagement_full(self.people, self.weekly))

    @cached_property
    def businesses(self) -> DataFrame:
        return self.stored("businesses", B.business_names(self.tags, self.members))

    @cached_property
    def mapping(self) -> DataFrame:
        return self.stored("mapping", B.manager_mapping(self.members, self.tags, self.invited, self.businesses))

    @cached_property
    def relationships(self) -> DataFrame:
        rows = B.business_relationships(self.mapping, self.members, self.tags)
        return self.stored("relationships", rows, B.SPREAD)

    @cached_property
    def team(self) -> DataFrame:
        return self.stored("team", W.team_engagement(self.relationships, self.engagement, X.AS_OF))

    @cached_property
    def member_rows(self) -> DataFrame:
        managed = T.managed_members(self.mapping, self.members, self.tags)
        return self.stored("member_rows", T.member_rows(managed, self.engagement, X.AS_OF, keep=["previous"]))

    @cached_property
    def team_weeks(self) -> T.Shared:
        """Activity of the last two weeks per team of managers; its pairs are the rows of :attr:`team`."""
        found = T.team_weeks(self.mapping, self.members, self.tags, self.engagement, X.AS_OF)
        return found.with_rows(self.stored("team_weeks", found.rows))

    @cached_property
    def shared(self) -> T.Shared:
        """Activity of the newest week per team of managers."""
        found = T.shared(self.mapping, self.member_rows)
        return found.with_rows(self.stored("shared", found.rows))

    @cached_property
    def ranked(self) -> T.Shared:
        found = T.manager_rankings(self.mapping, self.member_rows)
        return replace(found, rows=self.stored("ranked", found.rows), managers=self.stored("heads", found.managers))

    @cached_property
    def detailed(self) -> T.Shared:
        found = T.team_detail(self.mapping, self.member_rows)
        return found.with_rows(self.stored("detailed", found.rows))

    @cached_property
    def rankings(self) -> DataFrame:
        return self.stored("rankings", self.ranked.pairs())

    @cached_property
    def detail(self) -> DataFrame:
        return self.stored("detail", self.detailed.pairs())


def query(key: str, oracle: str | None = None):
    """Register a query; the oracle's shared parts are added by :func:`with_parts`."""

    def register(fn: Callable[[Base], DataFrame]):
        assert key not in QUERIES, key
        QUERIES[key] = lambda spark, sf_dir: fn(Base.of(spark, sf_dir))
        if oracle is not None:
            from teampulse.catalog.parts import PARTS

            ORACLES[key] = with_parts(oracle, PARTS)
        return fn

    return register


def with_parts(sql: str, parts: dict[str, str]) -> str:
    """Prefix the common table expressions a statement refers to, in order."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in parts:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(parts[name])
    body = sql.strip()
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({text.strip()})" for name, text in parts.items() if name in needed)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


__all__ = ["Base", "query", "QUERIES", "ORACLES", "MEMBER", "WEEK"]
