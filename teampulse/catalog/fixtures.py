"""Raw community tables derived from the driver's tables.

``FIXTURES.md`` describes the mapping: customers are members, nations are
businesses, events are the activity feeds, orders are course completions,
suppliers are invited managers, pages are live events and conversations are
comments.  Text is made untidy on purpose so that cleaning has work to do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from teampulse.session import configure
from teampulse.sources import schemas as S

AS_OF = dt.date(2024, 1, 31)
BUSINESS_TAG, MANAGER_TAG, PRO_TAG = 100, 101, 102
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _iso(c: Column) -> Column:
    return F.date_format(c.cast("timestamp"), ISO)


def _load_columns(raw_id: Column, at: Column) -> list[Column]:
    return [at.cast("timestamp").alias(S.EXTRACTED_AT), raw_id.alias(S.RAW_ID)]


def community_members(spark, sf_dir) -> DataFrame:
    """Member k; every tenth manages its nation (below 22), every twentieth the next one too."""
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    manager = (k % 10 == 0) & (n < 22)
    tag = lambda i, name: F.struct(i.cast("string").alias("id"), name.alias("name"))
    tags = F.concat(
        F.array(tag(n, F.col("n_name")), tag(F.lit(BUSINESS_TAG), F.lit("Business"))),
        F.when(manager, F.array(tag(F.lit(MANAGER_TAG), F.lit("Manager")))).otherwise(F.array()),
        F.when(manager & (k % 20 == 0), F.array(tag((n + 1) % 22, F.lit("second")))).otherwise(F.array()),
        F.when(k % 15 == 7, F.array(tag((n + 1) % 25, F.lit("other")))).otherwise(F.array()),
    )
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.select(
        k.alias("community_member_id"),
        _text("  mEMBER", k % 100, "\t").alias("first_name"),
        _text(F.col("n_name"), " ").alias("last_name"),
        _text(" member", k % 100, " ", F.col("n_name")).alias("name"),
        _text(" ", F.col("c_name"), "@Example.com\n").alias("email"),
        F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal") % 50).alias("posts_count"),
        F.when(F.col("c_mktsegment") != "MACHINERY", k % 7).alias("comments_count"),
        _iso(F.date_add(F.lit(dt.date(2024, 1, 1)), (k % 28).cast("int"))).alias("created_at"),
        F.to_json(tags).alias("member_tags"),
        *_load_columns(_text("m", k), F.lit(dt.datetime(2024, 1, 31, 6))),
    )


def member_tags_list(spark, sf_dir) -> DataFrame:
    """One tag per nation, three role tags and a course tag per region."""

    def shape(df, tag_id, name, age, profile):
        made = _iso(F.date_sub(F.lit(dt.date(2024, 1, 1)), (age * 20).cast("int")))
        spots = F.struct(F.lit(True).alias("member_directory"), profile.alias("profile_page"))
        return df.select(
            tag_id.cast("bigint").alias("id"),
            _text(" ", name, " ").alias("name"),
            F.lit("#fff").alias("color"),
            F.lit("x").alias("emoji"),
            F.when(profile, F.lit(True)).alias("is_public"),
            F.lit("label").alias("display_format"),
            F.to_json(spots).alias("display_locations"),
            (age * 10).cast("bigint").alias("tagged_members_count"),
            made.alias("created_at"),
            made.alias("updated_at"),
            *_load_columns(_text("t", tag_id), F.lit(dt.datetime(2024, 1, 31, 6))),
        )

    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    n, r = F.col("n_nationkey"), F.col("r_regionkey")
    roles = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.lit(name).alias("w"))
                for i, name in ((BUSINESS_TAG, "Business"), (MANAGER_TAG, "Manager"), (PRO_TAG, "Pro"))
            ]
        )
    )
    one = region.where(r == 0).select(roles.alias("x")).select("x.i", "x.w")
    return (
        shape(nation, n, F.col("n_name"), n, n % 2 == 0)
        .unionByName(shape(one, F.col("i"), F.col("w"), F.lit(30), F.lit(False)))
        .unionByName(shape(region, r + 200, _text("Completed - ", F.col("r_name")), r, F.lit(True)))
    )


def activity(spark, sf_dir) -> DataFrame:
    """Events with the number inside their JSON properties."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "k": k})


def _payload(kind: Column) -> Column:
    """Payload document; parts that a feed lacks are absent."""
    e, u, k = F.col("event_id"), F.col("user_id"), F.col("k")
    as_text = lambda c: c.cast("string")
    space = F.struct(
        F.lit("course").alias("type"),
        as_text(k % 5).alias("id"),
        _text(" space ", k % 5).alias("name"),
        _text(" Space-", k % 5, " ").alias("slug"),
    )
    who = F.struct(
        F.lit("member").alias("type"),
        u.alias("id"),
        _text("member ", u).alias("name"),
        _text(" member", u).alias("first_name"),
        F.lit("o'neil-smith").alias("last_name"),
        _text(" USER", u, "@Example.com ").alias("email"),
        (k % 2 == 0).alias("is_admin"),
        _text("p", u).alias("public_uid"),
        F.lit("maybe").alias("is_moderator"),
    )
    written = kind.isin("error", "signup") | ((kind == "purchase") & (e % 2 == 1))
    comment = F.when(
        written,
        F.struct(
            F.lit("Comment").alias("type"),
            as_text(e).alias("id"),
            k.alias("post_id"),
            F.when(k % 3 == 0, e - 1).alias("parent_comment_id"),
            F.when(kind != "signup", u).alias("community_member_id"),
            F.lit("false").alias("record_owner_is_admin"),
        ),
    )
    posted = (kind == "signup") | ((kind == "purchase") & (e % 2 == 0))
    post = F.when(
        posted,
        F.struct(
            F.lit("Post").alias("type"),
            k.alias("id"),
            _text(" Post ", k, " ").alias("name"),
            _text("POST-", k).alias("slug"),
            F.lit("published").alias("status"),
            (k % 5).alias("space_id"),
            _iso(F.col("ts")).alias("published_at"),
            u.alias("community_member_id"),
            F.lit(True).alias("record_owner_is_admin"),
        ),
    )
    lesson = F.when(kind == "click", F.struct(as_text(k).alias("id"), F.lit("Lesson").alias("type")))
    return F.to_json(
        F.struct(
            space.alias("space"),
            who.alias("initiator"),
            comment.alias("comment"),
            post.alias("posts_basic"),
            lesson.alias("lesson"),
        )
    )


def envelopes(spark, sf_dir, with_copies: bool = True) -> DataFrame:
    """All event envelopes except attendances; every tenth arrives a second time a day later."""
    kind, e = F.col("event_type"), F.col("event_id")
    name = (
        F.when(kind == "click", S.FEEDS["course_lesson_completed"])
        .when((kind == "purchase") & (e % 2 == 0), S.FEEDS["post_liked"])
        .when(kind == "purchase", S.FEEDS["post_comment_liked"])
        .otherwise(S.FEEDS["post_comment_created"])
    )
    rows = activity(spark, sf_dir).where(kind != "view")
    copies = F.when((e % 10 == 0) & F.lit(with_copies), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("copy", F.explode(copies))
    arrived = F.col("ts") + F.expr("make_interval(0,0,0,copy,1,0,0)")
    return rows.select(
        _text("e", e).alias("id"),
        name.alias("name"),
        F.concat(F.lit("v"), F.col("copy").cast("string")).alias("version"),
        _payload(kind).alias("payload"),
        _iso(F.col("ts")).alias("created_at"),
        _iso(F.col("ts")).alias("triggered_at"),
        *_load_columns(_text("r", e, "-", F.col("copy")), arrived),
    )


def feed(spark, sf_dir, table_name: str, with_copies: bool = True) -> DataFrame:
    return envelopes(spark, sf_dir, with_copies).where(F.col("name") == S.FEEDS[table_name])


def course_completed(spark, sf_dir) -> DataFrame:
    """Orders as course completions; the priority is the course."""
    o = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    p = F.col("o_orderpriority")
    mail = _text(" Customer#", F.lpad(F.col("o_custkey").cast("string"), 9, "0"), "@Example.com")
    payload = F.struct(
        F.struct(p.alias("id"), _text(" ", p).alias("name"), F.lower(p).alias("slug"), F.lit("course").alias("type")).alias("space"),
        F.struct(F.col("o_custkey").alias("id"), mail.alias("email"), F.lit(False).alias("is_admin")).alias("initiator"),
    )
    return o.select(
        _text("o", F.col("o_orderkey")).alias("id"),
        F.lit(S.FEEDS["course_completed"]).alias("name"),
        F.lit("v0").alias("version"),
        F.to_json(payload).alias("payload"),
        _iso(F.col("o_orderdate")).alias("created_at"),
        _iso(F.col("o_orderdate")).alias("triggered_at"),
        *_load_columns(_text("o", F.col("o_orderkey")), F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")),
    )


def event_attendees(spark, sf_dir) -> DataFrame:
    """View events as replies to live events; one in four says no."""
    k = F.col("k")
    return (
        activity(spark, sf_dir)
        .where(F.col("event_type") == "view")
        .select(
            F.col("event_id").alias("id"),
            k.alias("event_id"),
            (k + 1).alias("contact_id"),
            F.col("user_id").alias("community_member_id"),
            F.lit(None).cast("string").alias("headline"),
            _iso(F.col("ts")).alias("rsvp_date"),
            _text("class ", k).alias("event_name"),
            _text(" member", F.col("user_id"), " anne-marie ").alias("member_name"),
            F.when(k % 4 == 0, "no").otherwise("yes").alias("rsvp_status"),
            F.lit("member").alias("contact_type"),
            _text("User", F.col("user_id"), "@Example.com").alias("member_email"),
            F.lit(None).cast("string").alias("member_avatar_url"),
            *_load_columns(_text("a", F.col("event_id")), F.col("ts")),
        )
    )


def events_list(spark, sf_dir) -> DataFrame:
    """Pages as live events; the HTML is the description."""
    p = F.col("page_id")
    start = F.timestamp_add("HOUR", p, F.lit(dt.datetime(2024, 1, 1)))
    flags = {f: (F.when(p % (i + 2) == 0, True).when(p % (i + 2) == 1, False)).alias(f) for i, f in enumerate(S.EVENT_FLAGS)}
    return table(spark, sf_dir, "pages").select(
        p.alias("id"),
        "url",
        F.col("html").alias("body"),
        _text("Host ", p % 3).alias("host"),
        _text("Event ", p).alias("name"),
        _text("event-", p).alias("slug"),
        F.when(p % 7 == 0, "soon").otherwise(_iso(start)).alias("starts_at"),
        _iso(F.timestamp_add("MINUTE", F.lit(90), start)).alias("ends_at"),
        _iso(start).alias("created_at"),
        _iso(start).alias("updated_at"),
        _text("Host ", p % 3).alias("member_name"),
        _text(" HOST", p % 3, "@Example.com").alias("member_email"),
        F.lit("virtual").alias("location_type"),
        F.lit(None).cast("string").alias("cover_image_url"),
        F.lit(None).cast("string").alias("member_avatar_url"),
        F.lit("t").alias("zapier_display_title"),
        F.struct(
            (p % 4).alias("id"), _text("Space ", p % 4).alias("name"), _text("s", p % 4).alias("slug"), F.lit(1).cast("bigint").alias("community_id")
        ).alias("space"),
        F.when(p % 5 != 0, F.sequence(F.lit(1).cast("bigint"), p % 5)).alias("topics"),
        (p % 50).alias("user_id"),
        F.when(p % 2 == 0, p % 9).alias("likes_count"),
        F.when(p % 3 == 0, p % 11).alias("comments_count"),
        (p % 40).alias("community_member_id"),
        F.when(p % 6 != 0, F.lit(5400).cast("bigint")).alias("duration_in_seconds"),
        *flags.values(),
        *_load_columns(_text("v", p), F.lit(dt.datetime(2024, 1, 31, 6))),
    )


def managers_not_joined(spark, sf_dir) -> DataFrame:
    """Suppliers as invited managers; nations from 23 on are not named in their tags."""
    s, n = F.col("s_suppkey"), F.col("n_nationkey")
    rows = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    named = _text('["Business", "  ', F.lower("n_name"), '", "Pro"]')
    return rows.select(
        _text("u", s).alias("uid"),
        F.when(s % 9 == 4, "n/a").otherwise(s.cast("string")).alias("id"),
        _text(" sUP", s).alias("first_name"),
        F.when(s % 5 != 0, F.lit(" o'hara-lee ")).alias("last_name"),
        _text(" ", F.col("s_name"), "@Example.com ").alias("email"),
        F.when(s % 3 == 0, "2024-01-02 03:04:05").otherwise("").alias("join_date"),
        F.when(n < 23, named).otherwise('["Business", "Pro"]').alias("tags"),
        _text(" https://example.com/u/", s).alias("profile_url"),
        F.when(s % 3 == 0, "Yes").when(s % 3 == 1, "n").otherwise("maybe").alias("member__y_n_"),
        F.when(s % 4 == 0, "").otherwise(" Sent").alias("invitation_status"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (s % 20).cast("int")).cast("string").alias("invitation_date"),
    )


def comments(spark, sf_dir) -> DataFrame:
    """Conversation turns as comments; later turns reply to the one before."""
    c, t = F.col("conv_id"), F.col("turn")
    cid = c * 1000 + t
    doc = lambda **kw: F.to_json(F.struct(*[v.alias(k) for k, v in kw.items()]))
    return table(spark, sf_dir, "conversations").select(
        cid.alias("id"),
        F.lit(1).cast("bigint").alias("community_id"),
        F.when(t > 0, cid - 1).alias("parent_comment_id"),
        doc(id=c % 50, name=_text("Member ", c % 50), email=_text("m", c % 50, "@example.com")).alias("user"),
        doc(id=_text(c), name=_text("Post ", c), slug=_text("post-", c)).alias("post"),
        doc(id=F.lit("7"), name=F.lit("Lounge"), slug=F.lit("lounge")).alias("space"),
        doc(body=_text("<p>", F.col("text"), "</p>")).alias("body"),
        _text("https://example.com/c/", cid).alias("url"),
        _iso(F.timestamp_add("HOUR", c, F.lit(dt.datetime(2024, 1, 1)))).alias("created_at"),
        (c % 3).alias("likes_count"),
        F.when(t % 2 == 0, t).alias("replies_count"),
        (c % 8).alias("user_likes_count"),
        F.lit(None).cast("bigint").alias("user_posts_count"),
        (c % 70).alias("user_comments_count"),
        *_load_columns(_text("c", cid), F.lit(dt.datetime(2024, 1, 31, 6))),
    )


def raw_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "community_members": community_members(spark, sf_dir),
        "member_tags_list": member_tags_list(spark, sf_dir),
        "managers_not_joined": managers_not_joined(spark, sf_dir),
        "event_attendees": event_attendees(spark, sf_dir),
        "events_list": events_list(spark, sf_dir),
        "course_completed": course_completed(spark, sf_dir),
        **{
            name: feed(spark, sf_dir, name)
            for name in ("post_comment_created", "post_liked", "post_comment_liked", "course_lesson_completed")
        },
    }
