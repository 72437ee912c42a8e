"""Corpus operators against brute force, libraries and held-out rows."""

import itertools
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from teampulse.llm import bpe, components, decontamination, langid, main_text, quality_nbsvm, sharding, simhash, surrogates, token_counts
from teampulse.llm.common import table
from teampulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_feistel_is_a_permutation(spark):
    for n in (1, 2, 3, 7, 40, 41, 1000, 4097):
        rows = [r[0] for r in spark.range(n).select(sharding.shuffled(F.col("id"), n)).collect()]
        assert sorted(rows) == list(range(n))
        if n > 100:
            assert rows != list(range(n))
    other = [r[0] for r in spark.range(1000).select(sharding.shuffled(F.col("id"), 1000, 5)).collect()]
    assert other != [r[0] for r in spark.range(1000).select(sharding.shuffled(F.col("id"), 1000, 6)).collect()]


def test_row_numbers_do_not_depend_on_partitions(spark):
    rows = [(i % 7, i) for i in range(500)] + [(3, 3)] * 400
    for parts in (1, 5):
        df, n = sharding.numbered(spark.createDataFrame(rows, "a int, b int").repartition(parts), ["a", "b"])
        got = [(r["a"], r["b"]) for r in df.orderBy("row_number").collect()]
        assert n == len(rows) and got == sorted(rows)


def roots(nodes, near):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in near:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(45)] + [(200, i) for i in range(201, 400)]
    edges += [(7, 7), (None, 3), (5, None), (0, 1)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == roots({n for e in real for n in e}, real)


@pytest.mark.parametrize("crowd", [1, 8, 10_000])
def test_links_of_crowded_blocks(spark, crowd):
    rnd = random.Random(1)
    base = rnd.getrandbits(63)
    fps = sorted({base ^ sum(1 << b for b in rnd.sample(range(12), rnd.randint(0, 4))) for _ in range(200)} | {rnd.getrandbits(64) for _ in range(50)})
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    near = [(i, j) for (i, x), (j, y) in itertools.combinations(enumerate(fps), 2) if bin(x ^ y).count("1") <= 2]
    got = {r["doc_id"]: r["component_id"] for r in simhash.linked(spark.createDataFrame(rows, "doc_id long, fp long"), crowd).collect()}
    assert got == roots(range(len(fps)), near)


def patterns(n):
    for gone in itertools.combinations(range(n), n // 5):
        yield ["0" if i in gone else "1" for i in range(n)]


@pytest.mark.parametrize("n", [8, 9, 10, 14, 15, 20, 25])
def test_masks_hit_every_window(n):
    """Whichever fifth of a window's words is changed, some mask fits on unchanged ones."""
    for kept in patterns(n):
        assert any(all(kept[s + i] == "1" for i, m in enumerate(mask) if m == "1") for mask in decontamination.MASKS for s in range(n - len(mask) + 1)), kept


def test_masks_hit_windows_of_thirty():
    rnd = random.Random(4)
    for _ in range(20_000):
        gone = set(rnd.sample(range(30), 6))
        assert any(all(s + i not in gone for i, m in enumerate(mask) if m == "1") for mask in decontamination.MASKS for s in range(31 - len(mask)))


TEXT = st.text(st.sampled_from("abc ABC  dé'sΣσİßﬁ\x1c\x85\n▁ 日本кир0123456789½²!?.re LLl<|endoftext|>&😀🏽‍﻿"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_encoders_equal_the_libraries(text):
    one = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")) if not hasattr(test_encoders_equal_the_libraries, "one") else test_encoders_equal_the_libraries.one
    test_encoders_equal_the_libraries.one = one
    own = bpe.loaded(public_tokenizers.path("word_bpe_49k.json"))
    ids = one.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == ids and own.decode(ids).decode() == one.decode(ids, skip_special_tokens=False)


def test_token_counts_with_and_without_the_frequent_table():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(6)
    words = "the of  hello\nworld <s> ▁▁ 12,5 don't naïve 日本 \t <0x0A> zzz".split(" ")
    texts = ["".join(rnd.choice(words) + rnd.choice([" ", "", "  ", "\n"]) for _ in range(rnd.randrange(20))) for _ in range(400)]
    plain, table_ = token_counts.Counts(path, {}), token_counts.Counts(path, {})
    table_.frequent = {p: len(table_.encode(p)) for t in texts[:50] for p in token_counts.pre_tokens(t)}
    for t in texts:
        assert plain.of(t) == table_.of(t) == len(model.encode(t))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_common_subsequence(a, b):
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        length[i + 1][j + 1] = length[i][j] + 1 if a[i] == b[j] else max(length[i][j + 1], length[i + 1][j])
    got = main_text.common(a, b)
    rest = iter(b)
    assert len(got) == length[-1][-1] and got == sorted(set(got)) and all(any(y == a[i] for y in rest) for i in got)


def test_blocks_leave_frames_out():
    page = """<title>x</title><body><header>Site</header><div class="cookie-notice">We use</div><main class="has-sidebar"><header><h1>T &amp; x</h1></header>
      <p>One<br>two <b>three</b> 5 < 6<p>four<aside>no</aside>five<div class="comments"><p>hey</p></div><form>f</form><script>if(a<b)"</p>"</script>
      <ul><li>i1<li>i2</ul></main><footer>foot"""
    assert main_text.blocks(page) == [(t, 1) for t in ("T & x", "One two three 5 < 6", "four", "five", "i1", "i2")]


KINDS = {
    "phone": [f"+1 ({a:03}) 555-{b:04}" for a in (1, 17, 974) for b in range(0, 4000, 97)],
    "card": [str(x) for x in range(4111111111110000, 4111111111113000) if sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(str(x))) % 10 == 0][:200],
    "ip": [f"{a}.{b}.1.{c}" for a in (1, 255) for b in (0, 99) for c in range(0, 256, 5)],
    "mail": [f"{n}.{i:02}@mail{i % 7}.example.com" for n in ("a", "bob", "élan", "zoé-x") for i in range(40)],
    "name": [f"Mr. {a} {b}" for a in ("James", "John", "Odo", "Otto") for b in ("Smith", "Smyth", "Ames", "Ode", "Oda")] + ["Mrs Mary Ames", "Госпожа Анна Петрова"],
    "secret": [f'token = "{i * 7919:040x}"' for i in range(120)],
    "ssn": [f"123-{i:02}-{i * 37:04}" for i in range(90)],
}


def test_surrogates_are_distinct_and_typed(spark):
    values = [(k, v) for k, vs in KINDS.items() for v in vs]
    df = spark.createDataFrame([(i, f"x {v} y") for i, (_, v) in enumerate(values)], "doc_id long, text string")
    found = surrogates.replaced_text(df, "text")
    assert surrogates.collisions(found).count() == 0
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    new = [r["text"][2:-2] for r in rows]
    assert len(set(new)) == len(values)
    for (kind, old), r, out in zip(values, rows, new):
        assert [e["kind"] for e in r["entities"]] == [kind], (kind, old)
        form = lambda s: "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in s)
        if kind not in ("ip", "name"):
            assert len(out) == len(old)
        if kind in ("phone", "ssn", "mail"):
            assert form(out) == form(old)
        if kind == "card":
            assert sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(out)) % 10 == 0
        if kind == "name":
            assert out.split()[0] == old.split()[0]
    again = surrogates.replaced_text(spark.createDataFrame([(1, f"Mr. James Smith and {KINDS['phone'][3]}")], "doc_id long, text string"), "text").head()["text"]
    assert new[[v for _, v in values].index("Mr. James Smith")] in again and new[3] in again
    male, female = surrogates.GIVEN[:2]
    assert all(n.split()[1].lower() in male for (k, v), n in zip(values, new) if v.startswith(("Mr. James", "Mr. John")))
    assert new[[v for _, v in values].index("Mrs Mary Ames")].split()[1].lower() in female
    other = surrogates.replaced_text(df, "text", "another key").orderBy("doc_id").head(20)
    assert [r["text"] for r in other] != [f"x {n} y" for n in new[:20]]


def test_two_forms_of_a_number_stay_one(spark):
    df = spark.createDataFrame([("+1 (974) 555-3436 or 974-555-3436; 4111 1111 1111 1111, 4111111111111111; no card 4111111111111112, 2024-01-15, v1.2.3",)], "text string")
    r = surrogates.replaced_text(df, "text").head()
    values = [e["surrogate"] for e in r["entities"]]
    assert values[0] == values[1] and values[2] == values[3] and len(values) == 4
    assert "4111111111111112, 2024-01-15, v1.2.3" in r["text"]


def test_language_of_held_out_rows(spark):
    rows = QUERIES["op10_language_spans"](spark, "/root/testdata/sf0.01").where("held_out").join(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    assert rows.where("lang = lang_pred").count() >= 0.98 * rows.count()


def test_spans_of_mixed_text(spark):
    labeller = langid.Labeller(langid.fit(table(spark, "/root/testdata/sf0.01", "documents")))
    texts = {r["lang"]: r["text"][:400] for r in table(spark, "/root/testdata/sf0.01", "documents").where("n_chars > 900 and doc_id > 500").orderBy("doc_id").collect()}
    (lang, share, spans), *_ = labeller.label([texts["de"] + "\n" + texts["fr"][:150]])
    assert lang == "de" and 0.5 < share < 0.95 and [s["lang"] for s in spans] == ["de", "fr"] and abs(spans[1]["start"] - 401) < 40
    assert labeller.label(["привет мир"])[0][1] == 0.0


def slow_path(scores):
    """Best path by the plain recursion over all languages."""
    best = [[s] for s in range(len(scores[0]))]
    total = list(scores[0])
    for row in scores[1:]:
        new, paths = [], []
        for s in range(len(row)):
            p = max(range(len(row)), key=lambda q: total[q] - langid.SWITCH * (q != s))
            new.append(total[p] - langid.SWITCH * (p != s) + row[s])
            paths.append(best[p] + [s])
        total, best = new, paths
    return max(total)


def test_viterbi(spark):
    import numpy as np

    rnd = np.random.default_rng(5)
    labeller = langid.Labeller(langid.Model({("a", 1): 1, ("b", 1): 1, ("c", 2): 1}, {("a", 0): 1}))
    for _ in range(200):
        scores = (-rnd.exponential(3, (rnd.integers(1, 40), 3)) * rnd.choice([0.2, 1, 3])).astype(np.float32)
        path = labeller.path(scores)
        value = sum(scores[i, s] for i, s in enumerate(path)) - langid.SWITCH * (np.diff(path) != 0).sum()
        assert value == pytest.approx(slow_path(scores.astype(float)), abs=1e-3)


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op2_nbsvm_quality"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out")
    assert rows.where("predicted = quality").count() >= 0.95 * rows.count()


def test_dual_descent_separates():
    import numpy as np

    rnd = np.random.default_rng(1)
    rows = [np.unique(np.concatenate([[0], rnd.integers(10, 60, 8), [1 if y else 2]])) for y in (np.arange(60) % 3 > 0)]
    good = np.arange(60) % 3 > 0
    model = quality_nbsvm.fit_rows(rows, good)
    of = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)])
    scores = model.scores(of, np.concatenate(rows), 60)
    assert ((scores > 0.5) == good).all()


def test_every_query_runs_on_whole_tables(spark):
    counts = {t: table(spark, SF, t).count() for t in ("documents", "pages")}
    for name in ("op2_nbsvm_quality", "op3_token_counts", "op5_line_rules", "op6_simhash_components", "op7_bpe_round_trip", "op8_surrogates", "op9_feistel_shards", "op10_language_spans"):
        assert QUERIES[name](spark, SF).count() == counts["documents"], name
    assert QUERIES["op4_nearest_page"](spark, SF).count() == counts["pages"]


def test_native_operators_have_no_python(spark):
    for name in ("op5_line_rules", "op8_surrogates", "op9_feistel_shards"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas")), name
