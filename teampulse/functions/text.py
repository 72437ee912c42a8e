"""Text helpers.  All are Column expressions, nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which a word starts in the warehouse dialect's INITCAP
# (public documentation of that function); whitespace counts as well.
WORD_DELIMITERS = r"\s\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+\-"

# Whitespace class of the RE2 dialect.
BLANK = r"[\t\n\f\r ]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip every kind of whitespace; Spark's own trim removes spaces only."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def initcap_words(c) -> Column:
    """Capitalise after any word delimiter, lower-case the rest."""
    runs = F.regexp_extract_all(
        F.lower(_col(c)), F.lit(f"[{WORD_DELIMITERS}]+|[^{WORD_DELIMITERS}]+"), F.lit(0)
    )
    capital = F.transform(
        runs, lambda r: F.concat(F.upper(F.substr(r, F.lit(1), F.lit(1))), F.substr(r, F.lit(2)))
    )
    return F.array_join(capital, "")


def clean_name(c) -> Column:
    return initcap_words(trim_ws(c))


def clean_email(c) -> Column:
    return F.lower(trim_ws(c))


def is_blank(c) -> Column:
    c = _col(c)
    return c.isNull() | (trim_ws(c) == "")


def full_name(first, last) -> Column:
    """First and last name with missing parts left out; never NULL."""
    return trim_ws(F.concat(F.coalesce(_col(first), F.lit("")), F.lit(" "), F.coalesce(_col(last), F.lit(""))))


def display_name(first, last) -> Column:
    """Like :func:`full_name` but each part is trimmed on its own."""
    parts = F.array(F.nullif(trim_ws(first), F.lit("")), F.nullif(trim_ws(last), F.lit("")))
    return F.array_join(parts, " ")


def strip_html(c) -> Column:
    """Replace tags by a space, then collapse runs of whitespace (ends are kept)."""
    return F.regexp_replace(F.regexp_replace(_col(c), "<[^>]*>", " "), f"{BLANK}+", " ")


def normal_key(c) -> Column:
    """Join key for names typed by hand: case and inner whitespace are ignored."""
    return F.regexp_replace(F.lower(trim_ws(c)), f"{BLANK}+", " ")


def escape_html(c) -> Column:
    """Escape markup characters; the ampersand goes first so nothing is escaped twice."""
    out = _col(c)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def quoted_items(c) -> Column:
    """Items of a list typed as text, e.g. ``["a", "b c"]``; blanks are dropped."""
    found = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit('"([^"]+)"'), F.lit(1))
    return F.filter(F.transform(found, trim_ws), lambda t: t != "")


def longest_item(items: Column, keep) -> Column:
    """Longest element passing ``keep``; equal lengths go to the smaller text."""
    ranked = F.transform(
        F.filter(items, keep), lambda t: F.struct((-F.length(t)).alias("k"), t.alias("t"))
    )
    return F.array_min(ranked)["t"]
