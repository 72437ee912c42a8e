"""Defined cases of every corpus operator: NULLs, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from teampulse.llm import bpe, decontamination, langid, line_rules, main_text, quality_nbsvm, sharding, simhash, surrogates, token_counts
from teampulse.llm.common import table

SF = "/root/testdata/sf0.001"
CAT = "The cat sat on the mat and looked at the dog.\nThen it went home, and the dog went home too."
LONG = " ".join(f"word{i % 977} and it's {i}" for i in range(60_000))
ROWS = [
    (1, CAT, "en", "a"),
    (2, None, None, None),
    (3, "", "fr", "a"),
    (4, " \n\t ", None, "b"),
    (5, LONG, "en", "a"),
    (1, CAT, "en", "a"),
    (None, "no id here", "en", None),
    (6, CAT, "en", "b"),
    (7, CAT.replace("cat", "cow"), "en", "b"),
    (8, "½ ² !! ... 12", None, "b"),
    (9, "Привет, мир İ ﬁ <|endoftext|> </s> \x1c \x85 　 ▁▁", "en", "b"),
]
NAMES = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["row", "fp", "key", "host", "entities", "found", "score", "c0", "c1", "keep_id", "found_id", "place", "part", "lines", "pieces", "Text"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, None if r[1] is None else len(r[1])) for r in ROWS]
    df = spark.createDataFrame(rows, NAMES).repartition(3)
    return df.toDF(*df.columns).select("*", *[F.lit("x").alias(c) for c in CLASHING if c != "Text"])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def keyed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_shards(docs, empty):
    for shards in (1, 3, 40):
        rows = sharding.shard(docs, shards).collect()
        assert len(rows) == len(ROWS)
        by = {}
        for r in rows:
            by.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
        sizes = [len(by.get(i, ())) for i in range(shards)]
        assert max(sizes) - min(sizes) <= 1
    again = sharding.shard(docs.repartition(5), 3)
    assert keyed(again) == keyed(sharding.shard(docs, 3))
    sizes = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows}
    assert sizes[2] == sizes[3] == (16, 0)
    assert sharding.shard(empty).count() == 0


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))


def test_fingerprints_and_components(docs, empty):
    rows = simhash.near_copies(docs).collect()
    assert len(rows) == len(ROWS)
    fps = [(i, slow_fingerprint(t)) for i, t, *_ in ROWS]
    group = list(range(len(fps)))
    for _ in fps:
        for i, (_, x) in enumerate(fps):
            for j, (_, y) in enumerate(fps):
                if bin(x ^ y).count("1") <= 2:
                    group[i] = min(group[i], group[j])
    ids = {g: min((i for (i, _), h in zip(fps, group) if h == g and i is not None), default=None) for g in group}
    want = sorted(((i, f"{x:016x}", ids[g]) for (i, x), g in zip(fps, group)), key=repr)
    assert sorted((tuple(r) for r in rows), key=repr) == want
    assert simhash.near_copies(empty).count() == 0


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    whole = simhash.fingerprint(LONG.encode())
    assert whole % (1 << 64) == slow_fingerprint(LONG)
    monkeypatch.setattr(simhash, "PIECE", 777)
    assert simhash.fingerprint(LONG.encode()) == whole


def test_copies_go(docs, empty):
    kept = simhash.without_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=lambda i: (i is None, i))
    assert len(ids) == len(set(ids)) and None in ids and 1 in ids and 6 not in ids and 2 in ids and 3 not in ids
    assert simhash.without_copies(empty).count() == 0


def test_token_counts(docs, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted(((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t, *_ in ROWS), key=repr)
    assert keyed(token_counts.token_counts(docs)) == want
    assert token_counts.token_counts(empty).count() == 0


def test_bpe(docs, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, plain = [], []
    for i, t, *_ in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        plain.append((i, ids, text))
    assert keyed(bpe.round_trip(docs)) == sorted(want, key=repr)
    assert keyed(bpe.encoded(docs)) == sorted(plain, key=repr)
    assert bpe.round_trip(empty).count() == bpe.encoded(empty).count() == 0


def test_quality_without_classes(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (99, 0), (None, 1), (3, None), (5, 7)], "doc_id long, quality int")
    for labels, share in ((none, 0.5), (one, 1.0)):
        rows = quality_nbsvm.scored(docs, quality_nbsvm.fit(docs, labels)).collect()
        assert len(rows) == len(ROWS) and all(abs(r["score"] - share) < 1e-3 for r in rows)
    model = quality_nbsvm.fit(docs, spark.createDataFrame([(1, 1), (6, 1), (5, 0), (8, 0)], "doc_id long, quality int"))
    scores = {r["doc_id"]: r["score"] for r in quality_nbsvm.scored(docs, model).collect()}
    assert scores[7] > 0.5 > scores[5] and all(0 <= s <= 1 for s in scores.values()) and scores[2] == scores[3]
    assert quality_nbsvm.scored(empty, model).count() == 0
    assert quality_nbsvm.fit(empty, one).slope == 0


def test_features_do_not_depend_on_pieces(monkeypatch):
    texts = [LONG.encode(), b"", b"a", b"one one two", CAT.encode()]
    of, found = quality_nbsvm.features(texts)
    monkeypatch.setattr("teampulse.llm.words.pieces.__defaults__", (1000,))
    again = quality_nbsvm.features(texts)
    assert (again[0] == of).all() and (again[1] == found).all()
    for i, t in enumerate(texts):
        assert (quality_nbsvm.features([t])[1] == found[of == i]).all()


def oracle(sql, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df)
    return sorted((tuple(r) for r in con.execute(sql).fetchall()), key=repr)


def test_line_rules(spark, empty):
    page = "Home | About | Contact us now"
    rows = [(100 + i, f"{page}\n" + " ".join(f"w{i}x{j}" for j in range(20)), None, "h", 0) for i in range(12)]
    rows += [(20 + i, f"  {page.upper()} \n{page}\nmenu", None, "h", 0) for i in range(6)]  # almost nothing else
    rows += [(40 + i, f"{page}\nother host here with words enough to pass the rules", None, f"g{i}", 0) for i in range(12)]
    rows += [(*r, 0) for r in ROWS if r[0] not in (5, 9)] + [(60, "a b c d e f " * 9, None, None, 0), (61, "x y z", None, None, 0), (62, "same\nsame\n same \n" + CAT, "en", "q", 0)]
    df = spark.createDataFrame(rows, NAMES).repartition(3)
    got = line_rules.line_verdicts(df).drop("removed_words")
    got = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert keyed(got) == oracle(line_rules.ORACLE, documents=df.toPandas())
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    assert all(kept[100 + i] for i in range(12)) and not any(kept[20 + i] for i in range(6)) and all(kept[40 + i] for i in range(12))
    assert line_rules.line_verdicts(empty).count() == 0
    left = {r["doc_id"]: r["text"] for r in line_rules.without_frequent_lines(df).collect()}
    assert left[100].startswith("w0x0") and left[20] == "" and left[40] == rows[18][1] and left[2] is None and left[3] == ""


def test_line_rules_clashing(docs):
    assert line_rules.line_verdicts(docs).count() == len(ROWS) == line_rules.without_frequent_lines(docs).count()


def test_passages(spark, docs, empty):
    words = [f"Tok{i % 83}en{i}" for i in range(45)]
    items = [(1, " ".join(words)), (2, " ".join(words)), (3, None), (4, ""), (5, "too short to count"), (None, " ".join(words[:12]))]
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    changed = [w if i % 5 else "changed" for i, w in enumerate(words)]  # one in five words
    spoiled = [w if i % 3 else "changed" for i, w in enumerate(words)]
    rows = [(1, "Start. " + ", ".join(changed).upper() + " end", None, None, 0), (2, " ".join(spoiled), None, None, 0), (3, " ".join(words[5:40]), None, None, 0),
            (4, LONG + " " + " ".join(words), None, None, 0), (4, LONG + " " + " ".join(words), None, None, 0), (5, " ".join(words[:12]), None, None, 0)]
    df = spark.createDataFrame(rows, NAMES).unionByName(docs.select(*[n.split()[0] for n in NAMES.split(", ")])).repartition(4)
    got = keyed(decontamination.passages(df, items))
    assert got == oracle(decontamination.ORACLE, documents=df.toPandas(), benchmark=items.toPandas())
    assert {(d, i) for d, i, *_ in got} == {(d, i) for d in (1, 3, 4) for i in (1, 2)} | {(4, None), (5, None)}
    left = decontamination.without_passages(docs, items)
    assert left.columns == docs.columns and left.count() == len(ROWS)
    assert decontamination.passages(empty, items).count() == decontamination.passages(docs, items.where("false")).count() == 0


def test_surrogates(spark, docs, empty):
    out = surrogates.replaced(docs)
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(((i, t) for i, t, *_ in ROWS), key=repr)
    assert surrogates.replaced(empty).count() == 0
    texts = ["a@b.com", "mail a@b.com, A@B.com and " + "x " * 50_000 + "c@d.org.", None, "", "a@b.com"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in surrogates.replaced(df).collect()}
    mail = got[0]
    assert got[4] == mail != "a@b.com" and got[1].startswith(f"mail {mail}, {mail.split('@')[0].upper()}@") and got[2] is None and got[3] == ""
    assert len(got[1]) == len(texts[1]) and "c@d.org" not in got[1]


PAGES = "page_id long, url string, html string, row int, texts string"


def test_pages(spark):
    def page(body, extra=""):
        return f"<html><body><div id=top>Same top</div><div>{extra}Same &amp; frame</div>{body}<div>Same foot</div></body></html>"

    rows = [
        (1, "http://h/a/1", page("<p>One\n  <b>text</b></p><p>more")),
        (2, "http://h/a/2", page("<p>Two text</p>")),
        (3, "http://h/b/9", None),
        (4, "http://g/a/1", "<article><h1>T</h1><p>Alone</p></article><nav>menu</nav>"),
        (5, None, "<p>no url</p><script>var t='</p>';</script><!-- c -->"),
        (6, "http://k/x", "<main><p>" + "long text " * 30_000 + "</p></main>"),
        (6, "http://k/x", "<main><p>" + "long text " * 30_000 + "</p></main>"),
        (7, "http://c/1", page("")), (8, "http://c/2", page("")), (9, "http://e/1", ""), (None, "http://e/2", "<p>a &#8212; b &lt;c&gt; &am"),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], PAGES).repartition(3)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in main_text.main_text(df).collect()}
    assert got[1][0] == "One text\nmore" and got[2][0] == "Two text" and got[3] == ("", 0) and got[4][0] == "T\nAlone"
    assert got[5][0] == "no url" and got[6][1] == 299_999 and got[9] == ("", 0) and got[None][0] == "a — b <c> &am"
    assert got[7][0] == got[8][0] == "Same top\nSame & frame\nSame foot"  # copies are no frame for each other
    assert main_text.main_text(df).count() == len(rows) and main_text.main_text(df.where("false")).count() == 0


def test_differencing_decides_beside_a_marked_article(spark):
    """a page's own lead stays, the frame goes, shared sentences of the article stay."""
    def page(lead, text):
        return f"<div>Top</div><div>{lead}</div><article><p>{text}</p><p>Both say</p></article><div>Foot</div>"

    rows = [(1, "http://h/a/1", page("Lead one", "One")), (2, "http://h/a/2", page("Lead two", "Two")), (3, "http://g/1", page("Lead three", "Three"))]
    got = {r["page_id"]: r["text"] for r in main_text.main_text(spark.createDataFrame([(*r, 1, "x") for r in rows], PAGES)).collect()}
    assert got == {1: "Lead one\nOne\nBoth say", 2: "Lead two\nTwo\nBoth say", 3: "Three\nBoth say"}


def test_languages(docs, empty):
    model = langid.fit(docs.where("doc_id <> 9"))
    got = {r["doc_id"]: (r["lang_pred"], r["lang_score"], r["spans"]) for r in langid.labelled(docs, model).collect()}
    assert len(got) == len({r[0] for r in ROWS})
    assert all(got[i] == ("und", 0.0, []) for i in (2, 3, 4, 8)) and got[1][0] == "en" and got[1][1] == 1.0
    nothing = langid.fit(empty)
    assert {r["lang_pred"] for r in langid.labelled(docs, nothing).collect()} == {"und"}
    assert langid.labelled(empty, model).count() == 0
    kept = langid.in_known_language(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} >= {1, 5, 6, 7}
    assert not {r["doc_id"] for r in kept.select("doc_id").collect()} & {2, 3, 4, 8}


def test_pipeline_stages(spark, docs, empty):
    for rows in (docs, empty):
        now = rows
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, now, SF)
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns, name
            out.count()
            now = out if k < len(corpus_pipeline.STAGES) - 1 else now


def test_pipeline_decisions(spark):
    source = table(spark, SF, "documents")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    copies = {r["doc_id"] for r in simhash.near_copies(source).where("doc_id <> component_id").collect()}
    leaks = {r["doc_id"] for r in decontamination.passages(source, table(spark, SF, "benchmark")).collect()}
    assert not copies & out.keys() and not leaks & out.keys()
    assert {r["doc_id"] for r in source.collect()} - out.keys() - copies - leaks == set()
    assert all(r["n_tokens"] == len(r["ids"]) for r in out.values())
