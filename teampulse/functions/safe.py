"""Casts and arithmetic that give NULL where a plain operation would fail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from teampulse.functions.text import _col


def to_long(c) -> Column:
    return _col(c).try_cast("bigint")


def to_ts(c) -> Column:
    return _col(c).try_cast("timestamp")


def to_bool(c) -> Column:
    """Only the words true and false; Spark's cast also takes yes, 1 and t."""
    word = F.lower(_col(c).cast("string"))
    return F.when(word == "true", True).when(word == "false", False)


def yes_no(c) -> Column:
    word = F.lower(_col(c).cast("string"))
    return F.when(word.isin("yes", "y"), True).when(word.isin("no", "n"), False)


def ratio(num, den) -> Column:
    """Quotient as double, NULL for a zero or missing denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def floor_at_zero(c) -> Column:
    """``max(c, 0)`` that stays NULL for NULL; Spark's greatest would give 0."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0).cast("bigint")))


def zero_if_null(c) -> Column:
    return F.coalesce(_col(c), F.lit(0).cast("bigint"))


def total(*cols) -> Column:
    out = _col(cols[0])
    for c in cols[1:]:
        out = out + _col(c)
    return out
