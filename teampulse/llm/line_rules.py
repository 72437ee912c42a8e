"""Quality rules and cross-document line frequency, in SQL functions only.

Base rules work inside one text: words, symbols, repeated lines, and words covered
by five-word windows that occur twice or more.  Then each line is normalised (lower
case, single spaces) and hashed, and the distinct documents of its host that have it
are counted.  Lines of more documents of the host than the limit are removed, and a
document that loses too much is rejected.

One pass reads the texts and stores a few numbers a row and a hash a line.  Counts
are aggregated before they are shuffled, so a line or host that a third of all
documents share costs one row a task.

Defined cases: a NULL text has no words and fails the base rules; a NULL host is a
host of its own; NULL ids of a host count as one document; repeated rows get the same
verdict each and count as one document; ties cannot occur, since limits are strict;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import SPACE, stored

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
#: Most percent of a text's words that repeated windows may cover.
MAX_REPEAT = 20
#: A line is frequent if more documents of its host have it than this number.
LINE_DOCS = 4
#: Least share of its words that a document must keep, besides ``MIN_WORDS`` words.
KEEP_SHARE = 0.3


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _words(text: Column) -> Column:
    body = F.btrim(text, F.lit(WHITE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE + "+"))


def _normal(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(WHITE)), SPACE + "+", " "))


def measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and ``lines`` (hash, words) of every row.

    A window is repeated if a neighbour in the order of hashes has the same hash.  In
    the order of places, each repeated window adds the words up to the next one, five at most.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, body.alias("body"), _words(body).alias("words"))
    rows = rows.withColumn("all_lines", F.filter(F.split("body", "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    rows = rows.select(
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("body", WHITE, "")).cast("long").alias("word_chars"),
        _count(F.col("body"), SYMBOLS).alias("n_symbols"),
        (F.size("all_lines") - F.size(F.array_distinct("all_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("all_lines", lambda x: F.struct(F.xxhash64(_normal(x)).alias("h"), F.size(_words(x)).alias("n"))).alias("lines"),
        F.transform("words", lambda x: F.xxhash64(x)).alias("hashes"),
    )
    places = F.when(F.size("hashes") >= WINDOW, F.sequence(F.lit(0), F.size("hashes") - WINDOW)).otherwise(F.array().cast("array<int>"))
    window = F.transform(places, lambda i: F.struct(F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW))).alias("h"), i.alias("i")))
    rows = rows.withColumn("windows", F.sort_array(window)).drop("hashes")
    near = lambda w, k: F.coalesce(F.get("windows", k)["h"] == w["h"], F.lit(False))
    repeated = F.transform("windows", lambda w, k: F.when(near(w, k - 1) | near(w, k + 1), w["i"]))
    rows = rows.withColumn("places", F.sort_array(F.filter(repeated, lambda i: i.isNotNull()))).drop("windows")
    covered = F.transform("places", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - i, F.lit(WINDOW))))
    rows = rows.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
    return rows.drop("places")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def frequent_lines(lines: DataFrame, docs: int = LINE_DOCS) -> DataFrame:
    """host, h of the lines above the limit, whatever the size of the host.  ``lines``: host, doc_id, h."""
    counts = lines.select("host", "h", "doc_id").distinct().groupBy("host", "h").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > docs).select("host", "h")


def line_verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The base measures, base_failed, removed_words and kept of every row."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.concat(F.when(F.col(host).isNull(), "-").otherwise("+"), F.coalesce(F.col(host).cast("string"), F.lit(""))).alias("host"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text).alias("text"),
    )
    base = stored(measures(rows, ["doc_id", "host", "row"]), "measures")
    lines = base.select("doc_id", "host", "row", F.explode("lines").alias("line")).select("doc_id", "host", "row", "line.h", "line.n")
    removed = lines.join(frequent_lines(lines), ["host", "h"]).groupBy("row").agg(F.sum("n").alias("removed_words"))
    out = base.drop("lines", "host").join(removed, "row", "left").drop("row")
    out = out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long")).withColumn("base_failed", base_failed())
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < MIN_WORDS) | (left < KEEP_SHARE * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def without_frequent_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host and text without the frequent lines of its host, for every row.

    The texts are joined with their own hashes to remove only, never with other texts.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.concat(F.when(F.col(host).isNull(), "-").otherwise("+"), F.coalesce(F.col(host).cast("string"), F.lit(""))).alias("host"),
        F.col(text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "rows")
    found = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.when(F.btrim(x, F.lit(WHITE)) != "", F.xxhash64(_normal(x))))
    lines = rows.select("doc_id", "host", "row", F.explode(found).alias("h")).where("h IS NOT NULL")
    drop = lines.join(frequent_lines(lines), ["host", "h"]).groupBy("row").agg(F.collect_set("h").alias("drop"))
    rows = rows.join(drop, "row", "left").withColumn("drop", F.coalesce("drop", F.array().cast("array<bigint>")))
    stay = F.filter(F.split("text", "\n", -1), lambda x: (F.btrim(x, F.lit(WHITE)) == "") | ~F.array_contains("drop", F.xxhash64(_normal(x))))
    return rows.select("doc_id", F.substring("host", 2, 1 << 30).alias("host"), F.array_join(stay, "\n").alias("text"))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '') AS lines
  FROM d
), windows AS (
  SELECT r, unnest(range(1, len(words) - {WINDOW - 2})) AS i, words FROM w
), places AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS n FROM windows
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM places WHERE n > 1) GROUP BY r
), line AS (
  SELECT r, doc_id, host, lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line,
    len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS n
  FROM (SELECT r, doc_id, host, unnest(lines) AS x FROM w)
), frequent AS (
  SELECT host, line FROM line GROUP BY ALL HAVING count(DISTINCT doc_id) > {LINE_DOCS}
), removed AS (
  SELECT r, sum(n) AS n FROM line JOIN frequent USING (host, line) GROUP BY r
), base AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
    coalesce(removed.n, 0) AS removed
  FROM w LEFT JOIN repeated USING (r) LEFT JOIN removed USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words) AND NOT (
    removed > 0 AND (n_words - removed < {MIN_WORDS} OR n_words - removed < {KEEP_SHARE} * n_words)) AS kept
FROM base
"""
