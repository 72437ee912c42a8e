"""How far the sources of a language differ in their words.

A text's bytes go through one ``translate`` table that lowers A-Z and blanks every
separator, then through ``split`` and a ``Counter`` per document.  A task adds its
documents up before it hands on sparse rows (language, source, term, occurrences,
documents), and Spark adds those.

Shares are whole billionths, with five occurrences added to each kept term of the
language; whole-number division is done on decimals, so nothing is rounded.  A pair of
sources is compared in buckets of terms of bounded size: a bucket holds the shares
that differ from a source's smallest share, and one row with that smallest share
for each source.  Buckets are dealt by a hash of the term, so a large language is
the work of many tasks; the sums per pair are added before the shuffle.

Defined cases: NULL text, language and source count as empty; a source without terms
is a group like any other; a language without kept terms has pairs of value 0 and no
terms; a language with one source has no pairs; repeated rows and ids count as rows of
their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teampulse.llm.common import stored

#: Documents of a language that must have a term for it to be kept.
LEAST_DOCUMENTS = 30
#: Occurrences added to each kept term, parts of a share, and ranks of terms that are listed.
ADDED, PARTS, TOP = 5, 1_000_000_000, 50
#: Shares (sources x terms) of a bucket, distinct rows that a task holds back, and bytes of a text cut at a time.
CELLS, HELD, PIECE = 1 << 19, 1 << 18, 1 << 20

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: Letters and bytes of other code points stay, A-Z becomes a-z, all else is blank.
TABLE = bytes(b + 32 if b in _UPPER else b if b in _LOWER or b > 127 else 32 for b in range(256))


def terms(text: bytes) -> Counter:
    """Occurrences of each term of a text of any length."""
    found, at = Counter(), 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and TABLE[text[end]] != 32:
            end += 1
        found.update(text[at:end].translate(TABLE).split())
        at = end
    return found


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs; one row with a NULL term for each group that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = {}
        seen: dict[tuple, Counter] = {}

        def rows() -> pa.RecordBatch:
            keys = [(*group, term, n, seen[group][term]) for group, of in counts.items() for term, n in of.items()]
            keys += [(*group, None, 0, 0) for group in counts]
            columns = list(zip(*keys)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            arrays[2] = arrays[2].cast(pa.string())
            counts.clear(), seen.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "count", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                of = terms(text)
                counts.setdefault((lang, source), Counter()).update(of)
                seen.setdefault((lang, source), Counter()).update(of.keys())
            if sum(map(len, counts.values())) > HELD:
                yield rows()
        yield rows()

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    docs = docs.select(*plain).withColumn("text", F.col("text").cast("binary"))
    found = docs.mapInArrow(run, "lang string, source string, term string, count long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _share(count: str, total: str) -> str:
    """1 + floor(PARTS * (count + ADDED) / (total + ADDED * V)), on decimals of 38 digits."""
    return f"1 + ((CAST({count} AS DECIMAL(20, 0)) + {ADDED}) * {PARTS}) div (CAST({total} AS DECIMAL(20, 0)) + {ADDED} * v)"


def shares(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Kept counts with both shares, and every group with its total and smallest share."""
    counts = stored(term_counts(docs), "term_counts")
    of_lang = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("docs"))
    kept = stored(of_lang.where(F.col("docs") >= least).drop("docs"), "kept_terms")
    group = counts.where("term IS NULL").select("lang", "source")
    langs = group.groupBy("lang").agg(F.count("*").alias("sources"))
    langs = langs.join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("lang_total")), "lang", "left")
    langs = langs.fillna(0, ["v", "lang_total"])
    used = stored(counts.drop("docs").join(kept, ["lang", "term"]), "kept_counts")
    totals = used.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = group.join(totals, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang")
    base = F.expr(f"CASE WHEN v > 0 THEN {_share('0', 'total')} END").alias("base")
    groups = stored(groups.select("lang", "source", "total", "v", "lang_total", "sources", base), "groups")
    used = used.join(groups.select("lang", "source", "total", "v", "lang_total"), ["lang", "source"])
    p, q = F.expr(_share("count", "total")).alias("p"), F.expr(_share("lang_count", "lang_total")).alias("q")
    return used.select("lang", "source", "term", "count", p, q), groups


def _distances(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over a bucket's terms of the share differences, for the sources ``a < b`` of one language."""
    bases = rows[rows["term"].isna()].sort_values("source")
    names = bases["source"].to_numpy()
    rest = rows[rows["term"].notna()]
    place, kinds = pd.factorize(rest["term"])
    p = np.repeat(bases["p"].fillna(0).to_numpy(np.int64)[:, None], len(kinds), axis=1)
    p[pd.Index(names).get_indexer(rest["source"]), place] = rest["p"].to_numpy(np.int64)
    out = [np.abs(p[i + 1 :] - p[i]).sum(axis=1, dtype=np.int64) for i in range(len(names) - 1)]
    first = np.repeat(names, np.arange(len(names) - 1, -1, -1))
    second = [names[i + 1 :] for i in range(len(names) - 1)]
    lang = rows["lang"].iloc[0]
    if not out:
        return pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})
    return pd.DataFrame({"lang": lang, "a": first, "b": np.concatenate(second), "value": np.concatenate(out)})


def pairs(used: DataFrame, groups: DataFrame, cells: int = CELLS) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources of a language."""
    buckets = F.expr(f"CAST(greatest(1, ceil(v * sources / {cells})) AS INT)")
    spread = groups.where("sources > 1").withColumn("buckets", buckets)
    bases = spread.withColumn("bucket", F.explode(F.expr("sequence(0, buckets - 1)")))
    bases = bases.select("lang", "bucket", "source", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
    of = spread.select("lang", "source", "buckets")
    rows = used.join(of, ["lang", "source"]).withColumn("bucket", F.expr("CAST(pmod(xxhash64(term), buckets) AS INT)"))
    rows = rows.select("lang", "bucket", "source", "term", "p").unionByName(bases)
    parts = rows.groupBy("lang", "bucket").applyInPandas(_distances, "lang string, a string, b string, value long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return sums.select("lang", "value", F.inline(both)).select("lang", "source", "item", "value")


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank."""
    used, groups = shares(docs, least)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order).alias("rank")
    near = pairs(used, groups, cells).select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked)
    more = used.where("count > 0 AND p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return near.unionByName(more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))


#: The same rows without sparse sums: every group meets every kept term of its language.
ORACLE = f"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT lang, source, row, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row) >= {LEAST_DOCUMENTS}),
sizes AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(n, 0)::HUGEINT AS n, v
    FROM (SELECT DISTINCT lang, source FROM docs) g JOIN sizes USING (lang) JOIN kept k ON k.lang = g.lang
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT lang, source, term, n, sum(n) OVER (PARTITION BY lang, term) AS lang_n, v,
    1 + ({PARTS}::HUGEINT * (n + {ADDED})) // (sum(n) OVER (PARTITION BY lang, source) + {ADDED} * v)::HUGEINT AS p,
    sum(n) OVER (PARTITION BY lang) AS lang_total FROM cells),
both_shares AS (SELECT *, 1 + ({PARTS}::HUGEINT * (lang_n + {ADDED})::HUGEINT) // (lang_total + {ADDED} * v)::HUGEINT AS q FROM shares),
gaps AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
every AS (SELECT x.lang, x.source, y.source AS item FROM (SELECT DISTINCT lang, source FROM docs) x
    JOIN (SELECT DISTINCT lang, source FROM docs) y ON x.lang = y.lang AND x.source <> y.source),
found AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM every LEFT JOIN gaps USING (lang, source, item)
    UNION ALL SELECT lang, source, 'term', term, p - q FROM both_shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
