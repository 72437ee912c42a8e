"""Column helpers against hand-made values."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from teampulse.functions import dates as D
from teampulse.functions import json as J
from teampulse.functions import rules as R
from teampulse.functions import safe as N
from teampulse.functions import text as T
from teampulse.operators import joins


def column(spark, kind, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_names_and_mails(spark):
    names = ["\t anne-marie O'NEIL ", "smith_jones  x.y", " bo ", "", None]
    assert column(spark, "string", names, T.clean_name) == ["Anne-Marie O'neil", "Smith_Jones  X.Y", "Bo", "", None]
    assert column(spark, "string", [" A@X.com\n", None], T.clean_email) == ["a@x.com", None]


def test_full_names(one):
    schema = "a string, b string"
    for pair, full in (((" x", "y "), "x y"), ((None, "y"), "y"), (("x", None), "x"), ((None, None), "")):
        assert one(schema, pair, T.full_name("a", "b"), T.display_name("a", "b")) == (full, full)
    assert one(schema, ("x", None), F.concat("a", F.lit(" "), "b")) == (None,)


def test_html(spark):
    assert column(spark, "string", ["<p>a</p>\n <b>c</b>"], T.strip_html) == [" a c "]
    assert column(spark, "string", ["A & <B>", "&amp;"], T.escape_html) == ["A &amp; &lt;B&gt;", "&amp;amp;"]


def test_normal_key(spark):
    assert column(spark, "string", ["  CMC\t Group  Ltd "], T.normal_key) == ["cmc group ltd"]


def test_quoted_tags(spark):
    texts = ['["Business", "Acme Corp", "Pro"]', '["Pro", " "]', None]
    assert column(spark, "string", texts, T.quoted_items) == [["Business", "Acme Corp", "Pro"], ["Pro"], []]
    assert column(spark, "string", texts, lambda c: R.roster_business(T.quoted_items(c))) == ["Acme Corp", None, None]
    same = ['["bb", "aa", "Completed - long name", "X cancelled order"]']
    assert column(spark, "string", same, lambda c: R.roster_business(T.quoted_items(c))) == ["aa"]


def test_week_start_and_numbers(spark):
    times = [dt.datetime(2024, 1, 7, 23), dt.datetime(2024, 1, 8), None]
    assert column(spark, "timestamp", times, D.week_start) == [dt.date(2024, 1, 1), dt.date(2024, 1, 8), None]
    days = [dt.date(2024, 1, 8), dt.date(2023, 1, 1), dt.date(2022, 1, 1)]
    assert column(spark, "date", days, D.iso_week) == [2, 52, 52]
    assert column(spark, "date", days, D.sunday_week) == [1, 1, 0]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dates(dt.date(1999, 1, 1), dt.date(2040, 12, 31)), min_size=1, max_size=50))
def test_calendar_matches_python(spark, days):
    assert column(spark, "date", days, D.week_start) == [d - dt.timedelta(days=d.weekday()) for d in days]
    assert column(spark, "date", days, D.sunday_week) == [int(d.strftime("%U")) for d in days]
    assert column(spark, "date", days, D.iso_week) == [d.isocalendar()[1] for d in days]
    assert column(spark, "date", days, D.long_date) == [d.strftime("%B %d, %Y") for d in days]


def test_spine(one):
    schema, weeks = "a date, b date", D.weeks_between("a", "b")
    assert one(schema, (None, dt.date(2024, 1, 8)), weeks) == ([],)
    assert one(schema, (dt.date(2024, 1, 15), dt.date(2024, 1, 8)), weeks) == ([],)
    assert len(one(schema, (dt.date(2024, 1, 1), dt.date(2024, 1, 15)), weeks)[0]) == 3


def test_timestamps(spark):
    good = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.250Z", None]
    expected = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 250000), None]
    assert column(spark, "string", good, D.parse_utc_strict) == expected
    for bad in ("soon", "2024-01-02 03:04:05", "2024-13-02T03:04:05Z"):
        with pytest.raises(Exception, match="not a UTC timestamp"):
            column(spark, "string", [bad], D.parse_utc_strict)
    cursors = ["2024-01-02T03:04:05+00:00", "2024-01-02T05:04:05.250000+02:00", "x"]
    assert column(spark, "string", cursors, D.parse_cursor) == [*expected[:2], None]


def test_casts(spark):
    assert column(spark, "string", ["12", "12.0", "x", None], N.to_long) == [12, None, None, None]
    assert column(spark, "string", ["true", "FALSE", "yes", "1", "t", None], N.to_bool) == [True, False, None, None, None, None]
    assert column(spark, "string", ["Yes", "n", "maybe", None], N.yes_no) == [True, False, None, None]
    assert column(spark, "bigint", [3, -2, None], N.floor_at_zero) == [3, 0, None]
    assert column(spark, "bigint", [2, 0, None], lambda c: N.ratio(F.lit(1), c)) == [0.5, None, None]


def test_json(spark):
    docs = ["[]", '[{"id":1,"name":"A"}]', '[{"id":"7"}]', '{"a":1}', None]
    records = lambda c: J.json_records(c, {"id": "string", "name": "string"})
    assert column(spark, "string", docs, J.json_size) == [0, 1, 1, 0, 0]
    assert column(spark, "string", docs, lambda c: J.ids_of(records(c))) == [[], [1], [7], [], []]
    assert column(spark, "string", docs, lambda c: J.names_of(records(c))) == [[], ["A"], [None], [], []]
    flags = ['{"post_bio":true}', "{}", None, "[true]"]
    assert column(spark, "string", flags, lambda c: J.json_flag(c, "$.post_bio")) == [True, False, False, False]
    doc = ['{"a":{"b":"x"},"c":[1],"d":2}']
    assert column(spark, "string", doc, lambda c: J.json_scalar(c, "$.a")) == [None]
    assert column(spark, "string", doc, lambda c: J.json_scalar(c, "$.a.b")) == ["x"]
    assert column(spark, "string", doc, lambda c: J.json_scalar(c, "$.c")) == [None]
    assert column(spark, "string", doc, lambda c: J.json_scalar(c, "$.d")) == ["2"]


def test_tag_rules(spark):
    names = ["Basic", "free trial 7d", "Business trial", "Completed - PLC", "AC - x", "X cancelled", "Acme", "House Team"]
    found = column(spark, "string", names, lambda c: R.tag_category(c, "house team"))
    assert found == [
        "membership_tier",
        "membership_tier",
        "business_role",
        "course_completion",
        "migration",
        "cancellation",
        "potential_business_name",
        "community_role",
    ]
    assert column(spark, "string", names[-1:], R.tag_category) == ["potential_business_name"]
    assert column(spark, "string", ["COMPLETED -  PLC Basics ", "Acme"], R.tag_course) == ["PLC Basics", None]
    assert column(spark, "string", ["Vincent", "Acme"], R.looks_corporate) == [True, False]


def test_membership_three_valued(one):
    has = lambda: (joins.has_item("a", F.lit(2)), ~joins.has_item("a", F.lit(2)))
    assert one("a array<int>", ([1, None],), *has()) == (None, None)
    assert one("a array<int>", ([1],), *has()) == (False, True)
    assert one("a array<int>", (None,), *has()) == (False, True)


def test_labels(one):
    momentum = "points_change bigint, mover_rank bigint"
    for row, label in (((5, 4), "improving"), ((-5, 4), "declining"), ((4, 4), "stable"), ((1, 3), "top_mover")):
        assert one(momentum, row, R.momentum_category()) == (label,)
    growth = "c bigint, p bigint"
    for row, label in (((3, 0), "strong jump this week"), ((5, 10), "strong jump this week"), ((4, 10), "steady progress")):
        assert one(growth, row, R.growth_label("c", "p")) == (label,)
    perf = "total_points bigint, performance_rank bigint, performance_percentile double"
    for row, label in (
        ((0, 1, 1.0), "no_activity"),
        ((1, 3, 0.0), "top_performer"),
        ((1, 4, 0.7), "high_performer"),
        ((1, 4, 0.3), "average_performer"),
        ((1, 4, 0.2), "low_performer"),
    ):
        assert one(perf, row, R.performance_category()) == (label,)


def test_suggested_action(one):
    schema = (
        "member_first_name string, total_points bigint, points_change bigint, previous_week_points bigint, "
        "performance_rank bigint, mover_rank bigint, inactive_rank bigint"
    )
    for row, start in (
        (("A", 9, 1, 8, 1, 1, 9), "🏆 Celebrate A"),
        (("A", 9, 1, 8, 4, 1, 9), "📈 Encourage A"),
        (("A", 0, -8, 8, 4, 9, 1), "⚠️ Re-engage A"),
        (("A", 0, 0, 0, 4, 9, 3), "💬 Re-engage A"),
    ):
        assert one(schema, row, R.suggested_action())[0].startswith(start)
    assert one(schema, ("A", 0, 0, 0, 4, 9, 4), R.suggested_action()) == (None,)
