"""Labels of rows that were not ranked before."""

import types

import pytest
from test_plans import LAST, relation, report

from teampulse.catalog import relational

WANTED = {
    "performance_category": {"A": "top_performer", "B": "no_activity"},
    "momentum_category": {"A": "top_mover", "B": "stable"},
    "suggested_action": {
        "A": "🏆 Celebrate A for leading the team with 10 points",
        "B": "💬 Re-engage B with a personalized message or invitation",
    },
}


@pytest.mark.parametrize("label", WANTED)
def test_labels_of_plain_team_rows(spark, label):
    """The three label queries rank the team's rows, which have no row ids."""
    team, _ = report(spark, [relation("m@x", "X", 1, "A"), relation("m@x", "X", 2, "B")], [(1, LAST, 2, 0, 0, 0, 0)])
    rows = relational._labelled(types.SimpleNamespace(team=team)).select("member_first_name", label).collect()
    assert dict(map(tuple, rows)) == WANTED[label]
