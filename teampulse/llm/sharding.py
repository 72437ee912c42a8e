"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered 0..n-1 in the order of (id, size, checksum).  A keyed Feistel
network over ``a * b >= n`` pairs permutes the numbers; numbers that leave the
range walk on along their cycle until they are back in it.  With the permuted
number p, the shard is ``p mod shards`` and the slot ``p div shards``, so both can
be computed from the row number alone, shard sizes differ by one row at most and
slots have no gaps.

Defined cases: a NULL text has size 16 and checksum 0, as an empty one; NULL ids
come first; equal rows are numbered in any order, which no result can tell; an
empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import stored

SHARDS = 40
KEY = 20_240_607
ROUNDS = 6
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Steps of a walk.  At most sqrt(n) numbers lie outside the range, each met once in
#: a walk, so 64 steps are all there are up to n = 4096; beyond, the chance of a
#: longer walk is below n ** -32, and such a walk fails loudly.
WALK = 64


def sides(n: int) -> tuple[int, int]:
    """Two factors near sqrt(n) whose product is n or a little more."""
    a = max(1, isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _round(key: int, j: int, half: Column, modulus: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(key).cast("long"), F.lit(j).cast("long"), half.cast("long")), F.lit(modulus).cast("long"))


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by).cast("long"))


def permuted(x: Column, a: int, b: int, key: int = KEY) -> Column:
    """One pass of the network over 0..a*b-1; an even number of rounds puts the sides back in place."""
    left, right = x % F.lit(a).cast("long"), _div(x, a)
    for j in range(ROUNDS):
        modulus = (a, b)[j % 2]
        left, right = right, (left + _round(key, j, right, modulus)) % F.lit(modulus).cast("long")
    return right * F.lit(a).cast("long") + left


def shuffled(x: Column, n: int, key: int = KEY) -> Column:
    """The place of row number ``x`` among ``n`` rows: a keyed permutation with cycle walking."""
    a, b = sides(n)
    once = permuted(x, a, b, key)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        once,
        lambda at, _: F.when(at < n, at).otherwise(permuted(at, a, b, key)),
        lambda at: F.when(at < n, at).otherwise(F.raise_error(F.lit("walk too long")).cast("long")),
    )
    return F.when(once < n, once).otherwise(walk)


def numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Rows with ``row_number`` from 0 in the given order, and their number.

    A range sort spreads the rows; each gets its place in its partition, and the
    partitions' sizes, one row each, give the offsets.  Equal rows are spread too.
    The rows are stored before, since the sort reads them twice, once for its bounds.
    """
    df = stored(df, "rows")
    placed = df.withColumn("tie", F.monotonically_increasing_id()).orderBy(*order, "tie").drop("tie")
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    offsets, total = [], 0
    for row in sizes:  # one entry per partition of the sort
        offsets.append((row["part"], total))
        total += row["n"]
    starts = df.sparkSession.createDataFrame(offsets, "part long, start long")
    number = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    out = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    return out.withColumn("row_number", number).drop("part", "start", "place"), total


def shard(docs: DataFrame, shards: int = SHARDS, key: int = KEY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    rows, total = numbered(rows, ["doc_id", "size", "text_crc32"])
    rows = rows.withColumn("at", shuffled(F.col("row_number"), total, key))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("at") % shards).cast("int").alias("shard"),
        _div(F.col("at"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
