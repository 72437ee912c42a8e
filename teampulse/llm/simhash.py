"""Near copies by SimHash: fingerprints, block joins and components.

A fingerprint is the majority of each bit over the hashes of a text's word
shingles.  Two fingerprints that differ in at most two of 64 bits agree in at least
two of four 16-bit blocks, so they meet under one of six keys made of two blocks.

Equal fingerprints are merged first.  Keys that few fingerprints share are joined
with themselves and every pair is checked.  Where a key is shared by more than
``CROWD``, no pairs are made: each fingerprint of the crowd is listed under itself
and its 64 one-bit neighbours.  Two that differ in two bits or fewer share such a
listing, and all under one listing differ in two bits or fewer and are at most 65,
so a star over it keeps the components whole.  Each pair within reach shares a key,
and its key is either small or crowded, so no link is lost.

Defined cases: NULL and empty texts and texts without words have fingerprint zero;
shorter texts than a shingle are hashed whole; copies and ties share a component,
whose id is its smallest doc_id; NULL ids are no smallest id; an empty table gives
no rows; other columns are not read by ``fingerprints`` and ``linked``.  Without copies,
each component keeps one row whatever its ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import map_batches, plain_names, stored
from teampulse.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
#: Fingerprints under one key above which listings replace pairs.
CROWD = 32
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20
WHITE = b" \t\n\r\x0b\x0c"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number of bytes at a time."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in WHITE:
            end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text."""
    counts, total, tail, digest = np.zeros(64, np.int64), 0, [], xxhash.xxh64_intdigest
    for words in _pieces(text.lower()):
        words = tail + words
        tail = words[max(0, len(words) - shingle + 1) :]
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths) - 1
        starts = (ends + 1 - lengths)[: len(words) - shingle + 1].tolist()
        ends = ends[shingle - 1 :].tolist()
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)]
            counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        total += len(hashes)
    if not total:
        if not tail:
            return 0
        bits = digest(b" ".join(tail), SEED)
    else:
        bits = int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])
    return bits - (1 << 64) if bits >> 63 else bits


def _with_fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """The columns of ``rows`` before its last one, a binary text, and fp; stored once."""
    *keep, _ = rows.columns

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [fingerprint(t or b"", shingle) for t in batch.columns[-1].to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=[*keep, "fp"])

        return step

    schema = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return stored(map_batches(rows, make, f"{schema}fp long"), "fingerprints")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed long) of every row, stored once."""
    return _with_fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")), shingle)


def _keys(fps: DataFrame) -> DataFrame:
    mask = (1 << BLOCK_BITS) - 1
    block = [F.shiftrightunsigned("fp", BLOCK_BITS * i).bitwiseAND(F.lit(mask).cast("long")) for i in range(BLOCKS)]
    keys = [
        F.lit(k).cast("long") * (1 << 2 * BLOCK_BITS) + block[i] * (1 << BLOCK_BITS) + block[j]
        for k, (i, j) in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE))
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints, enough to join all that are within reach."""
    keyed = stored(_keys(fps.select("fp").distinct()), "keys")
    sizes = keyed.groupBy("key").count().where("count > 1")
    shared = stored(keyed.join(sizes, "key"), "shared")
    few, many = shared.where(F.col("count") <= crowd), shared.where(F.col("count") > crowd)
    far = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp")))
    near = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")) & (far <= DISTANCE))
    pairs = near.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(bit - (1 << 64) if bit >> 63 else bit).cast("long")) for bit in (1 << i for i in range(64))]
    listed = many.select("fp").distinct().select("fp", F.explode(F.array(*flips)).alias("spot"))
    # a spot has 65 fingerprints at most, so the set is bounded
    spots = listed.groupBy("spot").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = spots.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b")
    return pairs.unionByName(stars)


def rooted(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """fp, root of every distinct fingerprint."""
    roots = components(links(fps, crowd)).withColumnRenamed("node", "fp")
    return fps.select("fp").distinct().join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def linked(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fp, component_id for every row of ``fingerprints``."""
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first")).join(rooted(fps, crowd), "fp")
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    of = classes.select("fp", "root").join(least, "root").select("fp", "component_id")
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id."""
    rows = linked(fingerprints(docs, doc_id, text))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, NULL ids last.

    Rows are told by id and text, so texts without an id or with a common id are rows of
    their own; of rows that are equal in both, any one stays.
    """
    own, names = plain_names(docs)
    of, body = own.columns[names.index(doc_id)], own.columns[names.index(text)]
    tag = F.xxhash64(body)
    fps = _with_fingerprints(own.select(F.col(of).alias("id"), tag.alias("tag"), F.col(body).cast("binary").alias("text")), shingle)
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("tag").alias("tag"))
    firsts = fps.groupBy("fp").agg(F.min(order).alias("first"))
    keep = firsts.join(rooted(fps), "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.tag")
    kept = own.withColumn("tag", tag).alias("x").join(keep.alias("y"), F.expr(f"x.tag = y.tag AND x.`{of}` <=> y.id"), "left_semi")
    repeated = not fps.groupBy("id", "tag").count().where("count > 1").isEmpty()
    kept = kept.dropDuplicates([of, "tag"]) if repeated else kept
    return kept.drop("tag").toDF(*names)
