"""The grouped prefix join against brute force, and its defined cases."""

import itertools
import random
import re

import numpy as np
import pytest

from teampulse.llm import jaccard

SCHEMA = "doc_id long, text string, key string, size int, prefix string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} or ({" ".join(words)} if words else set())


def plain(rows, least=90):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= least * (len(sets[i]) + len(sets[j]) - both):
            parent[find(j)] = find(i)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(r[0], ids.get(find(i), r[0]))
    return sorted(((r[0], len(sets[i]), ids.get(find(i))) for i, r in enumerate(rows)), key=repr)


def fixture(seed=5, crowd=120):
    rnd = random.Random(seed)

    def words(n):
        return [f"w{rnd.randrange(4000)}" for _ in range(n)]

    def changed(of, n):
        of = list(of)
        for _ in range(n):
            of[rnd.randrange(len(of))] = f"n{rnd.randrange(10**6)}"
        return of

    licence, texts = words(40), [None, "", " \n\t", "one", "One", "one two", "one  TWO", "É x y", "é x y", "a b c", "a b c a b c"]
    base = words(130)
    texts += [" ".join(changed(base, rnd.randint(0, 5))) for _ in range(crowd)]  # partly within reach of each other
    for _ in range(60):
        own = words(rnd.randint(4, 160))
        texts += [" ".join(changed(own, rnd.randint(0, 3)) + (licence if rnd.random() < 0.4 else [])) for _ in range(rnd.randint(1, 6))]
    own = words(90)
    texts += [" ".join(own[i:] + own[:i]) for i in range(0, 90, 9)] + [" ".join(licence * k) for k in (1, 2, 3)]
    chain = words(200)
    texts += [" ".join(chain[i : i + 150]) for i in range(0, 50, 5)]
    book = words(1300)
    texts += [" ".join(changed(book, n)) for n in (0, 3, 9, 30, 60, 70)] + [" ".join(changed(words(1300), 0)) for _ in range(3)]
    texts += ["very " * 30_000 + "long", "very " * 30_000 + "lengthy"] + [texts[20]] * 50
    rows = [(i, t, "k", 1, "p") for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    return rows + [(None, texts[30], "k", 1, "p"), (None, "alone without an id", "k", 1, "p"), (30, "other text of a known id", "k", 1, "p")]


@pytest.mark.parametrize("frequent,counted", [(1 << 17, 1 << 21), (0, 1 << 21), (50, 500)])
def test_components_are_brute_force(spark, monkeypatch, frequent, counted):
    of = jaccard.frequent
    monkeypatch.setattr(jaccard, "COUNTED", counted)
    monkeypatch.setattr(jaccard, "frequent", lambda docs, text, shingle: of(docs, text, shingle, max(1, frequent)) if frequent else np.zeros(0, np.uint64))
    rows = fixture()
    got = jaccard.similar(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_other_limits_and_no_rows(spark):
    rows = fixture(6, 30)
    got = jaccard.similar(spark.createDataFrame(rows, SCHEMA), least=70).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 70)
    assert jaccard.similar(spark.createDataFrame([], SCHEMA)).count() == 0


def test_prefixes_of_linked_sets_meet_and_bitmaps_bound():
    rng = np.random.default_rng(2)
    known = np.sort(rng.choice(400, 60, replace=False).astype(np.uint64))
    ranks = rng.permutation(60)
    for _ in range(2000):
        a = np.unique(rng.integers(0, 400, rng.integers(9, 60)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.04], rng.integers(0, 400, 2).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard.prefix(a, known, ranks), jaccard.prefix(b, known, ranks)))
        for m, n in ((8, 8), (1, 1), (2, 8)):
            assert jaccard.wide_distance(jaccard.bitmap(a, m).tobytes(), jaccard.bitmap(b, n).tobytes()) <= len(a) + len(b) - 2 * both


def test_same_sets_whatever_the_pieces(monkeypatch):
    texts = [t.encode() for t in ("a B\tc d  e f g " * 50, "x", "", "Ünï code Wörds Ä")]
    whole = [s.tolist() for s in jaccard.shingle_sets(texts)]
    assert [len(s) for s in whole] == [len(shingles(t.decode())) for t in texts]
    assert [jaccard.shingle_sets([t])[0].tolist() for t in texts] == whole
    cut = jaccard.pieces
    monkeypatch.setattr(jaccard, "pieces", lambda data, may: cut(data, may, 7))
    assert [s.tolist() for s in jaccard.shingle_sets(texts)] == whole


def test_whole_sets_are_made_for_pairs_that_pass_the_bitmaps_only(spark, monkeypatch):
    rnd = random.Random(3)
    book = [f"w{rnd.randrange(4000)}" for _ in range(1300)]

    def changed(n):
        out = list(book)
        for i in rnd.sample(range(len(out)), n):
            out[i] = f"n{rnd.randrange(10**6)}"
        return " ".join(out)

    # far apart, but large enough to fill a narrow bitmap; two of them have a near copy
    texts = [changed(60) for _ in range(12)]
    texts += [texts[0] + " tail", texts[1] + " tail"]
    rows = [(i, t, "k", 1, "p") for i, t in enumerate(texts)]
    asked, make = [], jaccard.whole_sets

    def counted(docs, wanted, *more):
        asked.extend(r["id"] for r in wanted.select("id").collect())
        return make(docs, wanted, *more)

    monkeypatch.setattr(jaccard, "whole_sets", counted)
    found = jaccard.similar(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)
    assert len(asked) == len(set(asked)) == 4


def test_whole_sets_are_made_once(spark, monkeypatch):
    rows = [(i, f"a b c d{i}") for i in range(4)]
    members = spark.createDataFrame([(i, bytearray(jaccard.set_key(jaccard.shingle_sets([t.encode()])[0]))) for i, t in rows], "id long, key binary")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = jaccard.whole_sets_on_demand(docs, members)
    assert whole(spark.createDataFrame([], "a long, b long")) is None
    assert {r["id"] for r in whole(spark.createDataFrame([(0, 1)], "a long, b long")).collect()} == {0, 1}
    made = []
    monkeypatch.setattr(jaccard, "whole_sets", lambda docs, wanted, *more: made.append({r["id"] for r in wanted.collect()}) or wanted.selectExpr("id", "0L AS size", "key AS hashes"))
    assert {r["id"] for r in whole(spark.createDataFrame([(1, 2), (0, 1)], "a long, b long")).collect()} == {0, 1, 2}
    assert made == [{2}]
