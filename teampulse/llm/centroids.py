"""Centroid clustering with zone maps over a Hilbert curve.

Vectors become whole numbers, are ordered along a Hilbert curve over their most
varied components, and are cut into blocks that carry the least and greatest value of
each component.  In a round, the distances from a block's box to the centroids bound
the distances of its vectors: a centroid whose nearest corner is farther than another
one's farthest corner is no candidate of the block.  A block with one candidate is
assigned by its stored sums, without a look at its vectors; elsewhere the vectors are
compared with the candidates only.  Blocks are written once and read by every round.

All arithmetic is on whole numbers: products go through doubles only while they stay
below 2**53.  A round sends one row for each cluster and task to one sum per cluster,
and the driver holds ``k`` centroids.

Defined cases: vectors of another length, NULL vectors, and vectors with a NULL or
non-finite component are left out; repeated rows are vectors of their own; a NULL id
hashes as empty text; fewer vectors than ``k`` give fewer clusters; ties go to the
smaller number; an empty table gives no rows; other columns are not read.  Components
of 65,536 or more in size raise an error, since distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import stored

SIZE, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Vectors of a block, components that the curve runs through, and its bits for each of them.
BLOCK, CURVE_AXES, CURVE_BITS = 512, 15, 4
#: Components from here on would take squared distances out of 64 bits.
MOST = 1 << 26


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", size: int = SIZE) -> DataFrame:
    """vec_id, vec (array of long) of the vectors that are kept."""
    own = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"))
    real = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where((F.size("vec") == size) & real)
    scaled = F.transform("vec", lambda x: F.floor(x * SCALE))
    fits = F.forall("vec", lambda x: F.abs(x) * SCALE < MOST)
    return own.select("vec_id", F.when(fits, scaled).otherwise(F.raise_error(F.lit("a component is too large for exact distances"))).alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def curve_axes(vectors: DataFrame, size: int = SIZE, axes: int = CURVE_AXES) -> tuple[list[int], list[int], list[int]]:
    """The most varied components, with their least and greatest values; over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(size), np.zeros(size)
        low, high = np.full(size, MOST, np.int64), np.full(size, -MOST, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            n, low, high = n + len(x), np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
            sums += x.sum(0, dtype=np.float64)
            squares += np.square(x, dtype=np.float64).sum(0)
        if n:
            arrays = [np.arange(size), np.full(size, float(n)), sums, squares, low, high]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["axis", "n", "sums", "squares", "low", "high"])

    found = vectors.select("vec").mapInArrow(run, "axis long, n double, sums double, squares double, low long, high long")
    sums = [F.sum(c).alias(c) for c in ("n", "sums", "squares")]
    found = found.groupBy("axis").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"))
    spread = F.col("squares") - F.col("sums") * F.col("sums") / F.col("n")
    best = found.orderBy(spread.desc(), "axis").limit(axes).collect()  # ``axes`` rows
    return [r["axis"] for r in best], [r["low"] for r in best], [r["high"] for r in best]


def hilbert(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Places on the Hilbert curve of whole coordinates (rows x axes) below ``2 ** bits``."""
    x = cells.T.astype(np.uint64)
    n = len(x)
    for b in range(bits - 1, 0, -1):  # undo the turns of each level
        bit, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(n):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    carry = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        carry ^= np.where((x[n - 1] & np.uint64(1 << b)) != 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= carry
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


def _keyed(vectors: DataFrame, axes: list[int], low: list[int], high: list[int]) -> DataFrame:
    kind = vectors.schema["vec_id"].dataType.simpleString()
    at, least = np.array(axes, np.int64), np.array(low, np.int64)
    width = np.array(high, np.int64) - least + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))[:, at] if batch.num_rows else np.zeros((0, len(at)), np.int64)
            place = hilbert((x - least) * (1 << CURVE_BITS) // width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=["vec_id", "vec", "place"])

    return vectors.mapInArrow(run, f"vec_id {kind}, vec array<bigint>, place long")


def blocks(vectors: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """ids, vecs, low, high, sums, squares: stretches of the curve.

    Places are dealt out by range; a random number tells equal places apart, so a
    common vector fills as many tasks as it needs.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    axes, low, high = curve_axes(vectors, size)
    keyed = _keyed(vectors, axes, low, high).withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    dealt = keyed.repartitionByRange("place", "tie").sortWithinPartitions("place", "tie").select("vec_id", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made(last: bool) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            whole = len(rows) if last else len(rows) // block * block
            for at in range(0, whole, block):
                part = rows.slice(at, min(block, whole - at))
                ids, vecs = (part.column(i).combine_chunks() for i in (0, 1))
                x = _matrix(vecs)
                of = [x.min(0), x.max(0), x.sum(0)]
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), ids)
                data = [pa.array([x.astype("<i4").tobytes()], pa.binary())] + [pa.array([v], pa.list_(pa.int64())) for v in of]
                total = pa.array([str(int((x.astype(object) ** 2).sum()) if np.abs(x).max() > 1 << 20 else int(np.square(x).sum()))])
                yield pa.RecordBatch.from_arrays([ids, *data, total], names=["ids", "vecs", "low", "high", "sums", "squares"])
            if whole < len(rows):
                held.extend(rows.slice(whole).to_batches())

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= block:
                yield from made(False)
        if held:
            yield from made(True)

    schema = f"ids array<{kind}>, vecs binary, low array<bigint>, high array<bigint>, sums array<bigint>, squares string"
    return stored(dealt.mapInArrow(run, schema), "blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that a vector of the box may be nearest to, ties included."""
    gap = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    reach = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    return np.flatnonzero(np.square(gap).sum(1) <= np.square(reach).sum(1).min())


def nearest(x: np.ndarray, centroids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest candidate of each vector and its squared distance."""
    c = centroids[of]
    if max(np.abs(x).max(), np.abs(c).max()) <= 1 << 20:  # products and sums of 64 terms stay below 2**53
        y, d = x.astype(np.float64), c.astype(np.float64)
        far = (np.square(y).sum(1)[:, None] - 2 * (y @ d.T) + np.square(d).sum(1)[None, :]).astype(np.int64)
    else:
        far = np.stack([np.square(x - row).sum(1) for row in c], axis=1)
    best = far.argmin(1)
    return of[best], far[np.arange(len(x)), best]


def _read(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[tuple]:
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i] for c in columns)


def _vector(value: pa.Scalar) -> np.ndarray:
    return value.values.to_numpy()


def cluster_sums(found: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int], int]]:
    """Of each non-empty cluster: its vectors, their sum and the sum of their squares."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = [0] * k, [[0] * size for _ in range(k)], [0] * k
        for batch in batches:
            for vecs, low, high, total, square in _read(batch, ("vecs", "low", "high", "sums", "squares")):
                of = candidates(_vector(low), _vector(high), centroids)
                raw = np.frombuffer(vecs.as_buffer(), "<i4")
                if len(of) == 1:
                    parts = [(int(of[0]), len(raw) // size, _vector(total), int(square.as_py()))]
                else:
                    x = raw.reshape(-1, size).astype(np.int64)
                    near, _ = nearest(x, centroids, of)
                    wide = np.abs(x).max() > 1 << 20
                    parts = [(int(c), len(y), y.sum(0), int((y.astype(object) ** 2).sum()) if wide else int(np.square(y).sum())) for c in np.unique(near) for y in [x[near == c]]]
                for c, m, s, q in parts:
                    n[c], squares[c] = n[c] + m, squares[c] + q
                    sums[c] = [a + b for a, b in zip(sums[c], s.tolist())]
        own = [c for c in range(k) if n[c]]
        rows = [(c, axis, n[c], str(sums[c][axis] if axis < size else squares[c])) for c in own for axis in range(size + 1)]
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 4, (pa.int32(), pa.int32(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["cluster", "axis", "n", "part"])

    parts = found.select("vecs", "low", "high", "sums", "squares").mapInArrow(run, "cluster int, axis int, n long, part string")
    added = parts.groupBy("cluster", "axis").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out: dict[int, tuple[int, list[int], int]] = {}
    for row in added.orderBy("cluster", "axis").collect():  # k x (size + 1) rows
        n, sums, square = out.get(row["cluster"], (row["n"], [], 0))
        out[row["cluster"]] = (n, sums + [int(row["total"])], square) if row["axis"] < size else (n, sums, int(row["total"]))
    return out


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors with the smallest hashes of their ids; equal ids go by components."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return [r["vec"] for r in vectors.orderBy(F.sha2(text, 256), "vec").select("vec").limit(k).collect()]


def clustered(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE, block: int = BLOCK
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    vectors = whole_vectors(rows, vec_id, embedding, size)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    first = first_centroids(vectors, k, seed)
    if not first:
        return rows.sparkSession.createDataFrame([], schema)
    centroids, found = np.array(first, np.int64), blocks(vectors, size, block)
    for _ in range(rounds):
        for c, (n, sums, _) in cluster_sums(found, centroids).items():
            centroids[c] = [s // n for s in sums]
    inertia = {}
    for c, (n, sums, square) in cluster_sums(found, centroids).items():
        own = centroids[c].tolist()
        inertia[c] = square - 2 * sum(a * b for a, b in zip(own, sums)) + n * sum(a * a for a in own)
    total = sum(inertia.values())
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return found.select("ids", "vecs", "low", "high").mapInArrow(_assigned(centroids, inertia, total, names), schema)


def _assigned(centroids: np.ndarray, inertia: dict[int, int], total: int, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vecs, low, high in _read(batch, ("ids", "vecs", "low", "high")):
                x = np.frombuffer(vecs.as_buffer(), "<i4").reshape(-1, centroids.shape[1]).astype(np.int64)
                near, far = nearest(x, centroids, candidates(_vector(low), _vector(high), centroids))
                own = [inertia[c] for c in near.tolist()]
                arrays = [ids.values, pa.array(near, pa.int32()), pa.array(far), pa.array(own, pa.int64()), pa.array([total] * len(own), pa.int64())]
                arrays.append(pa.array([names[c] for c in near.tolist()]))
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return run


def _round(i: int) -> str:
    """SQL of one assignment and the centroids after it."""
    return f"""
far{i} AS MATERIALIZED (SELECT v.row, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM cells v JOIN c{i} c USING (axis) GROUP BY ALL),
a{i} AS MATERIALIZED (SELECT row, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM far{i} GROUP BY row),
m{i} AS (SELECT cluster, axis, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM cells JOIN a{i} USING (row) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, c.axis, coalesce((s - ((s % n) + n) % n) // n, c.x)::HUGEINT AS x FROM c{i} c LEFT JOIN m{i} USING (cluster, axis))"""


ORACLE = f"""
WITH kept AS (SELECT vec_id, embedding::DOUBLE[] AS e, row_number() OVER () AS row FROM embeddings
    WHERE len(embedding) = {SIZE} AND len([x FOR x IN embedding::DOUBLE[] IF x IS NOT NULL AND isfinite(x)]) = {SIZE}),
cells AS MATERIALIZED (SELECT row, unnest(range({SIZE})) AS axis, unnest([floor({SCALE} * x)::HUGEINT FOR x IN e]) AS x FROM kept),
firsts AS (SELECT row, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT cluster, axis, x FROM firsts JOIN cells USING (row)),{",".join(_round(i) for i in range(ROUNDS + 1))},
names AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY axis)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM kept JOIN a{ROUNDS} USING (row) JOIN names USING (cluster)
"""
