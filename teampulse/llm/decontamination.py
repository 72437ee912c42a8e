"""Benchmark passages in documents, by spaced seeds and verified overlaps.

Texts become hashes of their words (runs of ASCII letters and digits or of other
characters, in lower case).  A seed is a fixed mask over a few words in a row: the
hash takes the words at its ones and ignores the rest, so a changed word under a zero
does no harm.  Seeds of the benchmark and of the documents are joined, and around
each hit the words are compared on the same diagonal.  A passage is found if in some
``WINDOW`` words in a row of an item (all of a shorter item) at least ``SIMILAR`` of
the words stand at the same places of a document.  The three masks hit every such
window, whichever words were changed (checked by enumeration in the tests).

A Bloom filter of the benchmark's seeds, of bounded size, is broadcast.  Documents
are read once; only seeds that pass the filter leave the task, with the hashes of the
words around them.  The join then drops the filter's errors, so results do not depend
on its size.

Defined cases: NULL and empty texts have no words; items of fewer than ``LEAST_WORDS``
words are no evidence and are not searched; equal items are searched once and
reported each; repeated rows of a document are reported once, by their best overlap;
of equal overlaps the first place counts; NULL ids are reported as such; empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import map_batches, plain_names, stored
from teampulse.llm.words import IS_WORD, MIX, joined, mixed, pieces, stretch_hashes, stretches

#: Ones are compared, zeros ignored.
MASKS = ("11111", "111011", "11001011")
WINDOW = 30
SIMILAR = 0.8
LEAST_WORDS = 8
#: Bits of the filter for each seed, and the least and most that it may have (half a MB to 32 MB).
BITS_PER_SEED, LEAST_BITS, MOST_BITS = 32, 1 << 22, 1 << 28
#: Words that are compared at a time.
COMPARED = 1 << 20


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the text that it is from."""
    data, firsts = joined(texts)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    inside = IS_WORD[data]
    for at, end in pieces(data, ~inside):
        starts, ends = stretches(inside[at:end])
        hashes.append(stretch_hashes(data[at:end], starts, ends))
        places.append(starts + at)
    return np.concatenate(hashes), np.searchsorted(firsts, np.concatenate(places), "right") - 1


def seeds(words: np.ndarray, of: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each mask the seed hashes and the places of their first words."""
    out = []
    for k, mask in enumerate(MASKS):
        n = len(words) - len(mask) + 1
        if n < 1:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            continue
        total = np.full(n, k + 1, np.uint64)
        for j, i in enumerate(i for i, bit in enumerate(mask) if bit == "1"):
            total += words[i : i + n] * MIX[j]
        places = np.flatnonzero(of[:n] == of[len(mask) - 1 :])
        out.append((mixed(total[places]), places))
    return out


class Filter:
    """A Bloom filter with three probes; ``bits`` is a power of two."""

    def __init__(self, bits: int, body: np.ndarray):
        self.shift, self.body = np.uint64(64 - bits.bit_length() + 1), body

    def passes(self, h: np.ndarray) -> np.ndarray:
        """Indexes of the hashes that may be in the set."""
        left = None
        for k in range(3):
            p = (h if left is None else h[left]) * MIX[k + 2] >> self.shift
            ok = (self.body[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
            found = np.flatnonzero(ok)
            left = found if left is None else left[found]
        return left


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """words, item_ids: the distinct items that are long enough."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [(t or "").lower().encode() for t in batch.column(1).to_pylist()]
            words, of = word_hashes(texts)
            lists = np.split(_signed(words), np.searchsorted(of, np.arange(1, len(texts))))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists[: len(texts)], pa.list_(pa.int64()))], names=["item_id", "words"])

        return step

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    found = map_batches(rows, make, f"item_id {kind}, words array<bigint>").where(F.size("words") >= LEAST_WORDS)
    return found.select("item_id", "words", F.xxhash64("words").alias("item"))


def item_seeds(items: DataFrame) -> DataFrame:
    """seed, item, place of every seed of the distinct items."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            item, seed, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = np.array(words, np.int64).view(np.uint64)
                for h, p in seeds(words, np.zeros(len(words), np.int8)):
                    item.append(np.full(len(h), i, np.int64)), seed.append(_signed(h)), place.append(p)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (seed, item, place)], names=["seed", "item", "place"])

        return step

    return map_batches(items.select("item", "words").dropDuplicates(["item"]), make, "seed long, item long, place long")


def seed_filter(found: DataFrame) -> Filter:
    """A filter over the ``seed`` column, made of 4 KB buckets that Spark fills."""
    n = found.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (n * BITS_PER_SEED).bit_length()))

    def make():
        shift = np.uint64(64 - bits.bit_length() + 1)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            h = np.array(batch.column(0).to_pylist(), np.int64).view(np.uint64)
            p = np.unique(np.concatenate([h * MIX[k + 2] >> shift for k in range(3)])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(p >> 15), pa.array(p & 32767)], names=["bucket", "bit"])

        return step

    spots = map_batches(found.select("seed"), make, "bucket long, bit long")
    buckets = spots.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("body")).collect()
    body = np.zeros(bits // 8, np.uint8)
    for row in buckets:  # bits / 32768 at most
        body[row["bucket"] * 4096 : (row["bucket"] + 1) * 4096] = np.frombuffer(row["body"], np.uint8)
    return Filter(bits, body)


def hits(docs: DataFrame, known: Filter, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of documents with seeds that pass the filter: seeds, the places of each, and stretches of words around them."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    reach = WINDOW + max(map(len, MASKS))

    def make():
        known = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, of = word_hashes([(t or "").lower().encode() for t in batch.column(2).to_pylist()])
            seed, place = [], []
            for h, p in seeds(words, of):
                ok = known.passes(h)
                seed.append(h[ok]), place.append(p[ok])
            seed, place = np.concatenate(seed), np.concatenate(place)
            order = np.lexsort((seed, place))
            seed, place = _signed(seed[order]), place[order]
            docs, cuts = np.unique(of[place], return_index=True)
            out = []
            for d, s, p in zip(docs.tolist(), np.split(seed, cuts[1:]), np.split(place, cuts[1:])):
                first, last = np.searchsorted(of, [d, d + 1])
                gaps = np.flatnonzero(np.diff(p) > 2 * reach) + 1
                starts = np.maximum(first, np.concatenate([p[:1], p[gaps]]) - reach)
                ends = np.minimum(last, np.concatenate([p[gaps - 1], p[-1:]]) + reach)
                order = np.argsort(s, kind="stable")
                each, cut = np.unique(s[order], return_index=True)
                out.append((d, each, np.split((p - first)[order], cut[1:]), starts - first, [_signed(words[a:b]) for a, b in zip(starts, ends)]))
            rows = [r[0] for r in out]
            lists, long = pa.list_(pa.int64()), pa.int64()
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, long)), batch.column(1).take(pa.array(rows, long)),
                    pa.array([r[1] for r in out], lists), pa.array([r[2] for r in out], pa.list_(lists)),
                    pa.array([r[3] for r in out], lists), pa.array([r[4] for r in out], pa.list_(lists)),
                ],
                names=["row", "doc_id", "seeds", "places", "starts", "stretches"],
            )

        return step

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, make, f"row long, doc_id {kind}, seeds array<bigint>, places array<array<bigint>>, starts array<bigint>, stretches array<array<bigint>>")


def shifts(places: list[tuple[np.ndarray, np.ndarray]], last: int, length: int) -> np.ndarray:
    """The distinct differences of places in a document (up to ``last``) and in an item of ``length`` words."""
    found = np.zeros(last + length + 1, bool)
    for at, place in places:
        few, many = (place, at + length) if len(place) < len(at) else (at, length - place)
        sign = -1 if len(place) < len(at) else 1
        for x in few.tolist():
            found[many + sign * x] = True
    return np.flatnonzero(found) - length


def overlap(item: np.ndarray, shift: np.ndarray, starts: np.ndarray, stretches: list[np.ndarray]) -> tuple[float, int]:
    """Best share of equal words in a window of the item against the words some ``shift`` further on, and its first place there."""
    n, width = len(item), min(len(item), WINDOW)
    first = min(int(starts[0]), int(shift[0]))
    size = max(int(starts[-1]) + len(stretches[-1]), int(shift[-1]) + n) - first
    words, there = np.zeros(size, np.int64), np.zeros(size, bool)
    for start, part in zip(starts.tolist(), stretches):
        words[start - first : start - first + len(part)] = part
        there[start - first : start - first + len(part)] = True
    words, there = (np.lib.stride_tricks.sliding_window_view(x, n) for x in (words, there))
    best = (0, 0)
    for at in range(0, len(shift), max(1, COMPARED // n)):
        part = shift[at : at + max(1, COMPARED // n)]
        same = (words[part - first] == item) & there[part - first]
        sums = np.pad(np.cumsum(same, axis=1, dtype=np.int32), ((0, 0), (1, 0)))
        counts = sums[:, width:] - sums[:, :-width]
        most, place = counts.max(1), counts.argmax(1) + part
        best = max(best, (int(most.max()), -int(place[most == most.max()].min())))
    return best[0] / width, -best[1]


def passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, overlap, place (of the window's first word in the document) for every passage found."""
    known = stored(item_words(items, item_id, text), "items")
    by_seed = stored(item_seeds(known), "seeds")
    found = stored(hits(docs, seed_filter(by_seed), doc_id, text), "hits")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            best = []
            for words, places, starts, stretches in zip(*batch.columns[2:]):
                item, starts = words.values.to_numpy(), starts.values.to_numpy()
                parts = [x.values.to_numpy() for x in stretches]
                pairs = [(x["at"].values.to_numpy(), x["place"].values.to_numpy()) for x in places]
                best.append(overlap(item, shifts(pairs, int(starts[-1]) + len(parts[-1]), len(item)), starts, parts))
            arrays = [pa.array([o[0] for o in best], pa.float64()), pa.array([o[1] for o in best], pa.int64())]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["row", "item", "overlap", "place"])

        return step

    # one row for each document, item and common seed, with the places in both: repeated words multiply within a task only
    each = found.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("hit")).select("row", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("at"))
    of_item = by_seed.groupBy("seed", "item").agg(F.collect_list("place").alias("place"))
    pairs = each.join(of_item, "seed").groupBy("row", "item").agg(F.collect_list(F.struct("at", "place")).alias("places"))
    pairs = pairs.join(known.select("item", "words").dropDuplicates(["item"]), "item").join(found.select("row", "starts", "stretches"), "row")
    seen = map_batches(pairs.select("row", "item", "words", "places", "starts", "stretches"), make, "row long, item long, overlap double, place long")
    best = seen.where(F.col("overlap") >= SIMILAR).groupBy("row", "item").agg(F.max(F.struct("overlap", (-F.col("place")).alias("back"))).alias("best"))
    named = best.join(found.select("row", "doc_id"), "row").join(known.select("item", "item_id").distinct(), "item")
    named = named.groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return named.select("doc_id", "item_id", F.col("best.overlap").alias("overlap"), (-F.col("best.back")).alias("place"))


def without_passages(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no passage of an item was found.

    Rows are told by their texts, on which alone the finding depends, and never by ids.
    """
    own, names = plain_names(docs)
    body = own.columns[names.index(text)]
    key = F.concat(F.hex(F.xxhash64(body)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), body)))
    found = passages(own.select(key.alias("key"), F.col(body).alias("body")), items.select("item_id", F.col("text").alias("body")), "key", "item_id", "body")
    return own.withColumn("key", key).join(found.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").drop("key").toDF(*names)


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
), b AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(lower(text), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark
), items AS (
  SELECT q, item_id, w, least(len(w), {WINDOW}) AS width FROM b WHERE len(w) >= {LEAST_WORDS}
), dw AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS spot FROM d
), bw AS (
  SELECT q, width, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS place FROM items
), same AS (
  SELECT r, q, spot - place AS shift, place, width, n FROM dw JOIN bw USING (word)
), likely AS (
  SELECT r, q, shift FROM same GROUP BY r, q, shift, width HAVING count(*) >= {SIMILAR} * width
), windows AS (
  SELECT r, q, shift, width, start, count(*) AS n FROM (
    SELECT r, q, shift, width, place, unnest(range(greatest(0, place - width + 1), least(place, n - width) + 1)) AS start
    FROM same SEMI JOIN likely USING (r, q, shift)
  ) GROUP BY ALL
)
SELECT doc_id, item_id, max(windows.n / windows.width) AS overlap,
  arg_max(shift + start, windows.n / windows.width * 1e9 - shift - start) AS place
FROM windows JOIN d USING (r) JOIN items USING (q) WHERE windows.n >= {SIMILAR} * windows.width GROUP BY ALL
"""
