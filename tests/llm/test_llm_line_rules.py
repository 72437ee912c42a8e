"""Frequent lines of hosts of any size."""

from teampulse.llm import line_rules


def test_limit_does_not_grow_with_the_host(spark):
    page = "Home | About | Contact us now"
    rows = [(i, f"{page}\nown text {i}" if i < 5 else f"own text {i}", "h") for i in range(600)]
    left = line_rules.without_frequent_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert left.where(left.text.contains(page)).isEmpty()
