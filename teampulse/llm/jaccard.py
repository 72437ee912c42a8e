"""Near copies by Jaccard similarity of word shingles: a grouped prefix join.

Texts with equal sets of shingles are merged first.  Two sets that link share a
shingle among the first few of each, in any one order of all shingles: the prefix.
The order puts the shingles of a bounded list of frequent ones last, by frequency, and
all others before them, by hash, so shared boilerplate comes late and is seldom in a
prefix.  The list is made from all texts and changes the speed only.

Sets with one prefix and size are collapsed into a group, and only groups are listed
under the shingles of their prefix.  Two groups of a list go on if their sizes allow a
link, if their bitmaps are near enough (a bitmap holds the parity of the shingles of each of
512 buckets, so its Hamming distance never exceeds the number of differing shingles; a
group carries the greatest distance of a member from its first), and if they are not
known to be connected.  Members are expanded then and held against each other by
their bitmaps, and what is left is verified on the whole sets.

Links are followed in rounds.  The first holds each group's members against its
first, and each list's groups against one that meets most others.  The next ones
take, of each two components that may still link, the pair with the least bitmap
distance; the last takes all pairs that are left, as soon as these are no more than the
sets, or a round joins nothing.  No link between components is lost, and no
round makes the pairs inside a component.

Whole sets are computed again from the texts, each in the round in which a pair first
asks for it after the bitmaps, the wide ones too, have let it pass; a Bloom filter of
bounded size picks them out in the tasks, and a join then drops its errors.  Sets of the same size and shingles are told by a 128-bit hash; shingles are
64-bit hashes.

Defined cases: NULL and empty texts and texts without words have an empty set, link
with nothing and keep their own id; shorter texts than a shingle are one shingle;
copies and ties share a component, whose id is its smallest doc_id; NULL ids are no
smallest id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import map_batches, stored
from teampulse.llm.components import components
from teampulse.llm.decontamination import seed_filter
from teampulse.llm.words import IS_WHITE, MIX, joined, mixed, pieces, stretch_hashes, stretches

SHINGLE = 3
#: Least similarity of linked sets, in hundredths.
LEAST = 90
#: Frequent shingles that the order knows, and shingles of distinct sets that a task counts at a time.
FREQUENT, COUNTED = 1 << 17, 1 << 21
#: 64-bit words of a bitmap; a larger set has a second one with a bit or more for each shingle.
BITMAP = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WEIGHTS = [mixed(np.arange(i + 1, 2 * i + 2, dtype=np.uint64) * MIX[1]) | np.uint64(1) for i in range(32)]


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, firsts = joined(texts)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    white = IS_WHITE[data]
    for at, end in pieces(data, white):
        starts, ends = stretches(~white[at:end])
        hashes.append(stretch_hashes(_LOWER[data[at:end]], starts, ends))
        places.append(starts + at)
    words = np.concatenate(hashes)
    bounds = np.searchsorted(np.concatenate(places), np.append(firsts, len(data)))
    rows = max(0, len(words) - shingle + 1)
    total = np.zeros(rows, np.uint64)
    for j, weight in enumerate(_WEIGHTS[shingle - 1]):
        total += words[j : j + rows] * weight
    total = mixed(total)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = hi - lo
        if n >= shingle:
            out.append(np.unique(total[lo : hi - shingle + 1]))
        elif n:
            out.append(mixed((words[lo:hi] * _WEIGHTS[n - 1]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(found: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None


def bitmap(found: np.ndarray, words: int = BITMAP) -> np.ndarray:
    """Parities of the shingles in each of ``64 * words`` buckets, a power of two."""
    spots = (found * MIX[4] >> np.uint64(32) & np.uint64(64 * words - 1)).astype(np.int64)
    odd = np.bincount(spots, minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def wide_bitmap(found: np.ndarray) -> bytes | None:
    """A bitmap as large as the set, where ``BITMAP`` words are too few for it."""
    words = 1 << max(0, len(found) - 1).bit_length() >> 6
    return bitmap(found, words).tobytes() if words > BITMAP else None


def wide_distance(x: bytes, y: bytes) -> int:
    """Least number of shingles in which two sets with these bitmaps differ; the larger one is folded."""
    p, q = sorted((np.frombuffer(v, "<u8") for v in (x, y)), key=len)
    return int(np.bitwise_count(p ^ np.bitwise_xor.reduce(q.reshape(-1, len(p)))).sum())


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).cast("binary").alias("text"))


def frequent(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, size: int = FREQUENT) -> np.ndarray:
    """Shingles that several distinct sets of a stretch of texts share, most frequent last, at most ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        keys: set[bytes | None] = set()

        def counted() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            held.clear(), keys.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["token", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for found in shingle_sets([t or b"" for t in batch.column(0).slice(at, 64).to_pylist()], shingle):
                    if (key := set_key(found)) not in keys:
                        keys.add(key), held.append(found)
                if sum(map(len, held)) > COUNTED:
                    yield counted()
        yield counted()

    counts = _texts(docs, text).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    most = counts.orderBy(F.desc("n"), "token").limit(size).collect()  # ``size`` rows
    return np.array([r["token"] for r in most][::-1], np.int64).view(np.uint64)


def prefix(found: np.ndarray, known: np.ndarray, ranks: np.ndarray, least: int = LEAST) -> np.ndarray:
    """The first shingles of a set in the order.  ``known``: frequent shingles, sorted; ``ranks``: their places."""
    length = len(found) - -(-least * len(found) // 100) + 1
    if not len(known):
        return found[:length]
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    hot = known[at] == found
    cold = found[~hot][:length]
    if len(cold) == length:
        return cold
    last = found[hot]
    return np.concatenate([cold, last[np.argsort(ranks[at[hot]])][: length - len(cold)]])


def sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """doc_id, key, size, prefix, bits, wide of every row, stored."""
    order = frequent(docs, text, shingle)
    by_hash = np.argsort(order)
    known, ranks = order[by_hash], by_hash
    alone = 100 // (100 - least) - 1 if least < 100 else None  # sets up to this size link with equal ones only

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = shingle_sets([t or b"" for t in batch.column(1).to_pylist()], shingle)
            wide = [alone is not None and len(f) >= alone for f in found]
            keys = pa.array([set_key(f) for f in found], pa.binary())
            first = pa.array([prefix(f, known, ranks, least).view(np.int64) if w else None for f, w in zip(found, wide)], pa.list_(pa.int64()))
            bits = pa.array([bitmap(f) if w else None for f, w in zip(found, wide)], pa.list_(pa.int64()))
            arrays = [batch.column(0), keys, pa.array([len(f) for f in found], pa.int64()), first, bits, pa.array([wide_bitmap(f) for f in found], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "size", "prefix", "bits", "wide"])

        return step

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return stored(map_batches(rows, make, "doc_id long, key binary, size long, prefix array<bigint>, bits array<bigint>, wide binary"), "sets")


def whole_sets(docs: DataFrame, wanted: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id, size, hashes of the sets in ``wanted`` (id, key), computed from the texts; stored."""
    head = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long").alias("seed")
    known = seed_filter(wanted.select(head))

    def make():
        sent: set[bytes] = set()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [f for f in shingle_sets([t or b"" for t in batch.column(0).to_pylist()], shingle) if len(f)]
            keys = [set_key(f) for f in found]
            heads = np.array([int.from_bytes(k[:8], "big") for k in keys], np.uint64)
            take = [i for i in known.passes(heads).tolist() if keys[i] not in sent]
            if len(sent) > 1 << 16:
                sent.clear()
            sent.update(keys[i] for i in take)
            arrays = [pa.array([keys[i] for i in take], pa.binary()), pa.array([found[i].tobytes() for i in take], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["key", "hashes"])

        return step

    found = map_batches(_texts(docs, text), make, "key binary, hashes binary")
    found = found.dropDuplicates(["key"]).join(wanted, "key")
    return stored(found.select("id", F.expr("length(hashes) div 8").alias("size"), "hashes"), "whole")


def _near(pairs: DataFrame, sets: DataFrame, value: str, near: Callable[[bytes | None, bytes | None, int], bool]) -> DataFrame:
    """The ``pairs`` (a, b) whose values in ``sets`` (id, size, value) and added sizes pass ``near``; stored."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ok = [near(p, q, n) for p, q, n in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ok, pa.bool_())], names=["a", "b", "near"])

        return step

    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = sets.join(ends, "id", "left_semi").select("id", "size", value)
    both = pairs.join(sets.toDF("a", "m", "x"), "a").join(sets.toDF("b", "n", "y"), "b").select("a", "b", "x", "y", F.expr("m + n"))
    return stored(map_batches(both, make, "a long, b long, near boolean").where("near").select("a", "b"), "near")


def whole_sets_on_demand(docs: DataFrame, members: DataFrame, text: str = "text", shingle: int = SHINGLE) -> Callable[[DataFrame], DataFrame | None]:
    """A function from pairs ``a, b`` to a table with the whole sets of their ends; no set is computed twice."""
    held: list[DataFrame] = []

    def run(pairs: DataFrame) -> DataFrame | None:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        for table in held:
            ends = ends.join(table.select("id"), "id", "left_anti")
        wanted = stored(members.select("id", "key").join(ends, "id", "left_semi"), "wanted")
        if not wanted.isEmpty():
            held.append(whole_sets(docs, wanted, text, shingle))
        return reduce(DataFrame.unionByName, held) if held else None

    return run


def verified(pairs: DataFrame, members: DataFrame, whole: Callable[[DataFrame], DataFrame | None], least: int = LEAST) -> DataFrame:
    """The pairs ``a, b`` of sets that link, stored: by the wide bitmaps of large sets first, then by the sets."""

    def possible(x: bytes | None, y: bytes | None, sizes: int) -> bool:
        return x is None or y is None or (100 + least) * wide_distance(x, y) <= (100 - least) * sizes

    def linked(x: bytes, y: bytes, sizes: int) -> bool:
        both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
        return 100 * both >= least * (sizes - both)

    left = _near(pairs, members, "wide", possible)
    found = whole(left)
    return left if found is None else _near(left, found, "hashes", linked)  # without a set there is no pair


def _distance(x: str, y: str) -> str:
    return " + ".join(f"bit_count({x}[{i}] ^ {y}[{i}])" for i in range(BITMAP))


def _sized(least: int) -> str:
    return f"100 * least(x.size, y.size) >= {least} * greatest(x.size, y.size)"


def _may_link(least: int, slack: str = "0") -> str:
    """Of sets ``x`` and ``y``: their sizes, and a distance of their bitmaps that does not rule a link out."""
    return (
        f"{_sized(least)} AND "
        f"{100 + least} * ({_distance('x.bits', 'y.bits')} - ({slack})) <= {100 - least} * (x.size + y.size)"
    )


def grouped(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members other than the first of their group ``id, key, gid, size, bits, wide``; groups with their first member's columns, prefix and reach."""
    own = classes.where("prefix IS NOT NULL").withColumn("p", F.xxhash64("prefix")).withColumn("r", F.hash("prefix", F.lit(1)))
    first = F.min(F.struct("id", "key", "bits", "wide", "prefix")).alias("first")
    groups = stored(own.groupBy("size", "p", "r").agg(F.count("*").alias("n"), first).select("size", "p", "r", "n", F.col("first.id").alias("gid"), "first"), "prefix_groups")
    large = groups.where("n > 1").select("size", "p", "r", "gid")
    others = stored(own.join(large, ["size", "p", "r"]).where("id <> gid").select("id", "key", "gid", "size", "bits", "wide"), "others")
    far = others.alias("x").join(groups.where("n > 1").alias("y"), F.expr("x.gid = y.gid"))
    reach = far.groupBy("y.gid").agg(F.max(F.expr(_distance("x.bits", "y.first.bits"))).alias("reach"))
    groups = groups.select("gid", "size", "n", "first.key", "first.bits", "first.wide", "first.prefix").join(reach, "gid", "left")
    return others, groups.withColumn("reach", F.coalesce("reach", F.lit(0)))


def listed(groups: DataFrame, least: int = LEAST) -> DataFrame:
    """token, gid, size, bits, reach: groups under each shingle of their prefix that a group of such a size has too."""
    spread = groups.select("gid", "size", F.explode("prefix").alias("token"))
    repeated = spread.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(spread.join(repeated, "token", "left_semi"), "shared")
    alike = shared.alias("x").join(shared.alias("y"), F.expr(f"x.token = y.token AND x.gid <> y.gid AND {_sized(least)}"), "left_semi")
    return stored(alike.join(groups.select("gid", "bits", "reach"), "gid"), "listed")


def links(docs: DataFrame, classes: DataFrame, text: str = "text", shingle: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """Edges ``a, b`` between sets, enough to join all that link."""
    others, groups = grouped(classes)
    lists = listed(groups, least)
    near = _may_link(least, "x.reach + y.reach")
    # both sides have the same columns, so their rows are shuffled once; only rows with a partner are needed from here on
    partner = lists.alias("x").join(lists.alias("y"), F.expr(f"x.token = y.token AND x.gid <> y.gid AND {near}"), "left_semi")
    lists = stored(partner, "active_lists")
    active = stored(lists.select("gid").union(others.select("gid")).distinct(), "partners")
    firsts = groups.join(active, "gid", "left_semi").select(F.col("gid").alias("id"), "key", "gid", "size", "bits", "wide")
    members = stored(firsts.unionByName(others), "members")
    whole = whole_sets_on_demand(docs, members, text, shingle)

    # each group's members against its first, and each list's groups against the one that meets most others
    own = members.where("id <> gid").alias("x").join(members.where("id = gid").alias("y"), F.expr(f"x.gid = y.gid AND {_may_link(least)}"))
    totals = lists.groupBy("token").agg(F.count("*").alias("total"))
    weight = lists.select("token", "gid").join(totals, "token").groupBy("gid").agg(F.sum("total").alias("weight"))
    hubs = lists.join(weight, "gid").groupBy("token").agg(F.max(F.struct("weight", "gid", "size", "bits")).alias("hub"))
    hubs = hubs.select("token", "hub.gid", "hub.size", "hub.bits")
    star = lists.alias("x").join(hubs.alias("y"), F.expr(f"x.token = y.token AND x.gid <> y.gid AND {_may_link(least)}"))
    ends = [F.least("x.gid", "y.gid").alias("a"), F.greatest("x.gid", "y.gid").alias("b")]
    tried = stored(own.select(F.col("y.id").alias("a"), F.col("x.id").alias("b")).unionByName(star.select(*ends)).distinct(), "tried")
    found = verified(tried, members, whole, least)

    last, bound = False, members.count()
    while True:
        roots = components(found).withColumnRenamed("node", "id")
        rooted = stored(members.drop("wide").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "rooted")
        left = stored(_open_pairs(rooted, lists, least).join(tried.toDF("x", "y"), ["x", "y"], "left_anti"), "open")
        n = left.select("x", "y").distinct().count()
        if not n:
            return found
        last = last or n <= bound  # no more pairs than sets are left
        pairs = left if last else left.groupBy("root_x", "root_y").agg(F.min(F.struct("far", "x", "y")).alias("best")).select("best.*")
        pairs = stored(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "pairs")
        more = verified(pairs, members, whole, least)
        if last:
            return stored(found.unionByName(more), "found")
        last = more.isEmpty()
        found, tried = stored(found.unionByName(more), "found"), stored(tried.unionByName(pairs), "tried")


def _open_pairs(rooted: DataFrame, lists: DataFrame, least: int) -> DataFrame:
    """x, y, root_x, root_y, far: pairs of sets of different components that may link; repeated if listed so."""
    spans = rooted.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    # the bitmaps, most of a row, come back for the lists that still hold two components
    now = lists.select("token", "gid", "size", "reach").join(spans, "gid")
    live = now.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l <> h").select("token")
    now = now.join(live, "token", "left_semi").join(rooted.where("id = gid").select("gid", "bits"), "gid")
    apart = "NOT (x.low = y.low AND x.high = y.high AND x.low = x.high)"
    met = now.alias("x").join(now.alias("y"), F.expr(f"x.token = y.token AND x.gid < y.gid AND {apart} AND {_may_link(least, 'x.reach + y.reach')}"))
    met = met.select(F.col("x.gid").alias("g"), F.col("y.gid").alias("h"))
    met = met.unionByName(spans.where("low <> high").select(F.col("gid").alias("g"), F.col("gid").alias("h"))).distinct()
    one, two = (rooted.select("id", "gid", "size", "bits", "root") for _ in range(2))
    pairs = met.join(one.alias("x"), F.expr("g = x.gid")).join(two.alias("y"), F.expr(f"h = y.gid AND x.root <> y.root AND (g <> h OR x.id < y.id) AND {_may_link(least)}"))
    rows = pairs.select(
        F.least("x.id", "y.id").alias("x"), F.greatest("x.id", "y.id").alias("y"), F.expr(_distance("x.bits", "y.bits")).alias("far"),
        F.least("x.root", "y.root").alias("root_x"), F.greatest("x.root", "y.root").alias("root_y"),
    )
    return rows


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows = sets(docs, doc_id, text, shingle, least)
    full = rows.where("size > 0")
    firsts = full.groupBy("key").agg(F.min("doc_id").alias("first"))
    classes = full.select("key", "size", "prefix", "bits", "wide").dropDuplicates(["key"]).withColumn("id", F.monotonically_increasing_id())
    classes = stored(classes, "classes")
    roots = components(links(docs, classes, text, shingle, least)).withColumnRenamed("node", "id")
    rooted = classes.select("id", "key").join(firsts, "key").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = stored(rooted, "rooted")
    least_ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(least_ids, "root").select("key", "component_id")
    linked = full.join(of, "key").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    alone = rows.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


ORACLE = f"""
WITH RECURSIVE words AS (SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {SHINGLE - 2})]) END AS s FROM words),
sizes AS (SELECT row, doc_id, len(s) AS n FROM sets),
spread AS MATERIALIZED (SELECT row, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (SELECT x.row AS a, y.row AS b FROM spread x JOIN spread y ON x.shingle = y.shingle AND x.row <> y.row
    GROUP BY x.row, y.row HAVING 100 * count(*) >= {LEAST} * (any_value(x.n) + any_value(y.n) - count(*))),
reached AS (SELECT row, row AS other FROM sizes UNION SELECT r.row, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT s.doc_id, s.n AS n_shingles, min(o.doc_id) AS component_id FROM reached r JOIN sizes s USING (row) JOIN sizes o ON o.row = r.other GROUP BY s.row, s.doc_id, s.n
"""
