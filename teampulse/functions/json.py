"""JSON columns held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from teampulse.functions.safe import to_long
from teampulse.functions.text import _col


def is_json_array(c) -> Column:
    """True for array text; NULL input gives false."""
    return F.coalesce(F.startswith(F.ltrim(_col(c)), F.lit("[")), F.lit(False))


def is_json_object(c) -> Column:
    return F.coalesce(F.startswith(F.ltrim(_col(c)), F.lit("{")), F.lit(False))


def json_scalar(c, path: str) -> Column:
    """Scalar at a path as text; objects and arrays give NULL."""
    value = F.get_json_object(_col(c), path)
    nested = F.json_array_length(value).isNotNull() | F.json_object_keys(value).isNotNull()
    return F.when(~nested, value)


def json_flag(c, path: str) -> Column:
    """Boolean member of an object; missing, NULL or not an object is false."""
    hit = F.get_json_object(_col(c), path) == "true"
    return F.when(is_json_object(c), F.coalesce(hit, F.lit(False))).otherwise(False)


def json_records(c, fields: dict[str, str]) -> Column:
    """Array of structs with text leaves; anything but an array is empty."""
    shape = "array<struct<" + ",".join(f"{k}:{v}" for k, v in fields.items()) + ">>"
    parsed = F.when(is_json_array(c), F.from_json(_col(c), shape))
    return F.coalesce(parsed, F.array().cast(shape))


def json_size(c) -> Column:
    """Number of elements of an array document, else 0."""
    return F.when(is_json_array(c), F.coalesce(F.json_array_length(_col(c)), F.lit(0))).otherwise(0).cast("bigint")


def names_of(records: Column) -> Column:
    return F.transform(records, lambda r: r["name"])


def ids_of(records: Column) -> Column:
    return F.transform(records, lambda r: to_long(r["id"]))
