"""Centroid clustering against a plain loop, the curve, the bounds and the defined cases."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest

from teampulse.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, vecs string"


def plain(rows, size, k, rounds, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in map(float, v)]) for i, v, *_ in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    now = [list(v) for _, v in order[:k]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in now] for _, v in kept]
        return [(d.index(min(d)), min(d)) for d in far]

    for _ in range(rounds):
        at = assign()
        for c in range(len(now)):
            own = [v for (_, v), (x, _) in zip(kept, at) if x == c]
            if own:
                now[c] = [sum(column) // len(own) for column in zip(*own)]
    at = assign()
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    total = sum(d for _, d in at)
    return sorted(((i, c, d, sum(e for x, e in at if x == c), total, name[c]) for (i, _), (c, d) in zip(kept, at)), key=repr)


def fixture():
    rnd = random.Random(4)
    middles = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [np.float32(m + rnd.gauss(0, 0.1)).item() for m in rnd.choice(middles)]) for i in range(400)]
    rows += [(1000, rows[3][1])] * 300 + [(None, rows[4][1]), (None, rows[5][1]), (7, [0.0] * 6), (7, [-0.0] * 6), (8, [60000.0, -60000.0, 0.5, 0.0, 1e-30, -1e-30])]
    bad = [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0] * 7), (2004, [1.0] * 5 + [None]), (2005, [1.0] * 5 + [math.nan]), (2006, [math.inf] * 6)]
    return [(*r, 1, 2, "x") for r in rows + bad]


@pytest.mark.parametrize("block", [5, 64])
def test_clusters_are_the_plain_loop(spark, block):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = centroids.clustered(df, k=5, rounds=4, size=6, block=block).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 6, 5, 4)


def test_few_vectors_none_and_too_large(spark):
    rows = fixture()[:3]
    got = centroids.clustered(spark.createDataFrame(rows, SCHEMA), k=8, rounds=2, size=6).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 6, 8, 2)
    empty = centroids.clustered(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="too large"):
        centroids.clustered(spark.createDataFrame([(1, [70000.0] * 6, 1, 1, "")], SCHEMA), size=6).count()


@pytest.mark.parametrize("bits,axes", [(1, 3), (2, 2), (3, 2), (2, 4)])
def test_curve_visits_each_cell_by_single_steps(bits, axes):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    place = centroids.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_boxes_lose_no_centroid_and_leave_some_out():
    rng = np.random.default_rng(1)
    left_out = 0
    for _ in range(300):
        c = rng.integers(-50, 50, (8, 4))
        x = rng.integers(-9, 9, (20, 4)) + rng.integers(-50, 50, 4)
        of = centroids.candidates(x.min(0), x.max(0), c)
        left_out += 8 - len(of)
        every = np.arange(8)
        for a, b in zip(centroids.nearest(x, c, of), centroids.nearest(x, c, every)):
            assert (a == b).all()
    assert left_out > 1000
