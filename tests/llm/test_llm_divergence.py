"""Source divergence against a plain loop, and its defined cases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from teampulse.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, count int"


def plain(rows, least, top):
    """Every group meets every kept term."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        words = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low)))
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(words)
        seen[lang or ""].update(words.keys())
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def share(of, kept=kept):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        for s in sources:
            near = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            more = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", near, None), ("term", more, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])}
    return out


@pytest.mark.parametrize("cells", [7, 1 << 19])
def test_divergence_is_the_plain_loop(spark, cells):
    rnd = random.Random(3)
    words = [*"ab Ab aB É é ñandú Straße x y z 東京 k7k q".split(), "long" * 500]
    rows = []
    for i in range(300):
        lang, source = rnd.choice(["en", "de", None, ""]), rnd.choice(["s0", "s0", "s0", "s1", "S1", "é", None])
        text = rnd.choice([None, "", " 12 _-", *["".join(rnd.choice(words) + rnd.choice([" ", "\n", "\x00", ",", "_", "\x7f"]) for _ in range(rnd.randint(1, 30)))] * 20])
        rows.append((i % 250, text, lang, source, "x", 1))
    rows += [(None, None, "one", "only", None, None), (None, "no terms kept", "two", "a", None, None), (None, "", "two", "b", None, None)] + [rows[5]] * 40
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = divergence.divergence(df, least=30, top=3, cells=cells).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain(rows, 30, 3)
    assert {(r["source"], r["item"], r["value"]) for r in got if r["lang"] == "two"} == {("a", "b", 0), ("b", "a", 0)}


def test_no_rows_and_pieces_of_long_texts(spark, monkeypatch):
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).count() == 0
    text = ("Größe und WEITE, " * 2000).encode()
    whole = divergence.terms(text)
    monkeypatch.setattr(divergence, "PIECE", 11)
    assert divergence.terms(text) == whole == Counter({b"gr\xc3\xb6\xc3\x9fe": 2000, b"und": 2000, b"weite": 2000})
