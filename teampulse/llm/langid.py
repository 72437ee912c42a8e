"""Language spans: script ranges, per-word scores and a Viterbi path.

Each word between white space has the languages as candidates that write the scripts
of its letters.  Its score for a candidate is a tempered sum of log probabilities of
each letter with its neighbours, hashed into slots.  The best path over a text's
words, with a penalty for each switch, labels spans, so a few odd words do not break
a span and a real passage in another language is found.  The predicted language
covers most letters.

Most texts have one language.  If no stretch of words gains more than the penalty by
any other language, no path with a switch can beat the single best language, so the
step-by-step path is only walked for the other texts.

The model is fitted on a bounded sample of the labelled rows of each language.  A hash
of id and text chooses it, so a language with few rows is learned from all of them and
the same rows give the same model however they lie in files.  Neither ids nor sources or
labels take part in a prediction.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0, and
so is everything if nothing was learned; words in a script that no learned language
writes count for no language; ties go to the language first in order; repeated rows
are labelled each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teampulse.llm.common import map_batches
from teampulse.llm.words import MIX, mixed, pieces, stretches

UNKNOWN = "und"
#: Rows expected in the training sample of a language, and trigrams that the model keeps of it.
TRAIN_ROWS = 750
MODEL_GRAMS = 20_000
#: Weight of a trigram's log probability (they overlap), share of the mean
#: distribution mixed into each language, and the most that a word can hold against one.
TEMPER, MIXED, CLIP = 0.8, 0.05, 8.0
#: Cost of a change of language between two words.
SWITCH = 12.0
#: Least share of its letters that a kept document has in learned languages together.
LEAST_SHARE = 0.5
#: Share of a language's letters from which a script counts as its own.
SCRIPT_SHARE = 0.02
#: Slots that trigrams are hashed into, and scores that are held at a time.
SLOT_BITS, HELD = 20, 1 << 23
#: Bits of the hash that chooses the sample.
HASH_BITS = 40

# First code points of script ranges.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
]
NAMES = sorted({name for _, name in SCRIPTS})


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: is it a letter, is it white space, and the number of its script."""
    size = 0x110000
    letter, white, kind = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, np.uint8)
    for (start, name), end in zip(SCRIPTS, [start for start, _ in SCRIPTS[1:]] + [size]):
        kind[start:end] = NAMES.index(name)
    for at in range(0, size, 1 << 14):
        for i, c in enumerate(map(chr, range(at, at + (1 << 14))), at):
            letter[i], white[i] = c.isalpha(), c.isspace()
    return letter, white, kind


LETTER, WHITE, KIND = _tables()


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in lower case with a line break after each, and where each starts.

    Capitals whose lower case is longer stay as they are, so that places stay right.
    """
    lower = [t.lower() for t in texts]
    lower = [a if len(a) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t) for a, t in zip(lower, texts)]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    data = "\n".join([*lower, ""]).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, "<u4"), np.cumsum(sizes) - sizes


def slots(points: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """A slot for each letter, from it and its neighbours; the ends of a run of letters count as one sign."""
    inner = np.where(letter, points, 0).astype(np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), inner[:-1]])
    after = np.concatenate([inner[1:], np.zeros(1, np.uint64)])
    keys = (before << np.uint64(42) | inner << np.uint64(21) | after)[letter]
    return (mixed(keys * MIX[1]) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


class Model:
    """Log probabilities of trigram slots by language, and the languages of each script."""

    def __init__(self, counts: dict[tuple[str, int], int], scripts: dict[tuple[str, int], int]):
        """``counts`` by (language, slot), ``scripts`` letters by (language, number of the script)."""
        self.languages = sorted({lang for lang, _ in counts})
        at = {lang: i for i, lang in enumerate(self.languages)}
        known = sorted({slot for _, slot in counts})
        row = {slot: i for i, slot in enumerate(known)}
        self.rows = np.full(1 << SLOT_BITS, len(known), np.int32)
        self.rows[known] = np.arange(len(known))
        table = np.zeros((len(known), len(at)))
        for (lang, slot), n in counts.items():
            table[row[slot], at[lang]] = n
        share = table / np.maximum(1, table.sum(0))
        share = (1 - MIXED) * share + MIXED * share.mean(1, keepdims=True) if at else share
        self.logs = np.vstack([TEMPER * np.log(np.maximum(share, 1e-12)), np.zeros((1, len(at)))]).astype(np.float32)
        letters = Counter()
        for (lang, _), n in scripts.items():
            letters[lang] += n
        writes = np.zeros((len(NAMES), len(at)), bool)
        for (lang, kind), n in scripts.items():
            if lang in at and n >= SCRIPT_SHARE * letters[lang]:
                writes[kind, at[lang]] = True
        self.written = writes.any(1)  # scripts that some language writes
        self.barred = np.where(writes | ~self.written[:, None], 0, -4 * CLIP).astype(np.float32)


class Labeller:
    """Labels texts with a model."""

    def __init__(self, model: Model):
        self.model = model
        self.size = max(1 << 12, min(1 << 19, HELD // max(1, len(model.languages))))

    def words(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: its start, score for each language from 0 (its best) to -CLIP, letters, and letters that count."""
        model = self.model
        starts, _ = stretches(~WHITE[points])
        letter = LETTER[points]
        before = np.concatenate([[0], np.cumsum(letter)])
        firsts, ends = before[starts], np.concatenate([before[starts[1:]], before[-1:]])
        kinds = KIND[points[letter]]
        sums = model.logs[model.rows[slots(points, letter)]]
        if model.barred[np.unique(kinds)].any():
            sums = sums + model.barred[kinds]
        counts = model.written[kinds]
        sums[~counts] = 0
        sums = np.vstack([sums, np.zeros((1, sums.shape[1]), sums.dtype)])
        sums = np.add.reduceat(sums, firsts, axis=0) if len(firsts) else sums[:0]
        sums[firsts == ends] = 0
        own = np.concatenate([[0], np.cumsum(counts)])
        return starts, np.maximum(sums - sums.max(1, keepdims=True), -CLIP), ends - firsts, own[ends] - own[firsts]

    def label(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        """Predicted language, share of letters in its spans, and the spans with their code point ranges."""
        return [found[:3] for found in self.judge(texts)]

    def judge(self, texts: list[str]) -> list[tuple[str, float, list[dict], float]]:
        """The same with the share of letters in the spans of all languages."""
        model = self.model
        if not model.languages or not texts:
            return [(UNKNOWN, 0.0, [], 0.0) for _ in texts]
        points, firsts = code_points(texts)
        parts = []
        for at, end in pieces(points, WHITE[points], self.size):
            starts, *rest = self.words(points[at:end])
            parts.append((starts + at, *rest))
        starts, scores, letters, own = (np.concatenate(x) for x in zip(*parts))
        cuts = np.searchsorted(starts, [*firsts, len(points)])
        totals = np.concatenate([[0], np.cumsum(letters)])
        out = []
        for text, first, a, b in zip(texts, firsts.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            total = int(totals[b] - totals[a])
            if not total:
                out.append((UNKNOWN, 0.0, [], 0.0))
                continue
            path = self.path(scores[a:b])
            held = np.bincount(path, own[a:b], minlength=len(model.languages))
            best = int(held.argmax())
            turns = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist()]
            places = [int(starts[a + i]) - first for i in turns]
            spans = [{"lang": model.languages[path[i]], "start": x, "end": y} for i, x, y in zip(turns, places, [*places[1:], len(text)])]
            out.append((model.languages[best], float(held[best] / total), spans, float(held.sum() / total)))
        return out

    def path(self, scores: np.ndarray) -> np.ndarray:
        """The language index of each word on the best path."""
        best = int(scores.sum(0, dtype=np.float64).argmax())
        gain = np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)
        gain = np.vstack([np.zeros((1, gain.shape[1])), gain])
        if (gain - np.minimum.accumulate(gain, axis=0)).max() <= SWITCH:
            return np.full(len(scores), best)
        back = np.empty(scores.shape, np.int32)
        total, own = np.zeros(scores.shape[1]), np.arange(scores.shape[1])
        for i, row in enumerate(scores):
            top = int(total.argmax())
            back[i] = np.where(total >= total[top] - SWITCH, own, top)
            total = np.maximum(total, total[top] - SWITCH) + row
        out, state = np.empty(len(scores), np.int64), int(total.argmax())
        for i in range(len(scores) - 1, -1, -1):
            out[i] = state
            state = int(back[i, state])
        return out


def sample(rows: DataFrame, text: str, lang: str, limit: int, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``lang`` and ``text`` of about ``limit`` labelled rows of each language, all of one with fewer.

    A row is taken if the hash of its ids and text is low enough for the size of its
    language.  One count per language goes to the driver, as the model itself does.
    """
    labelled = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang).agg(F.count(F.lit(1))).collect()}
    large = {of: n for of, n in sizes.items() if n > limit}
    place = F.pmod(F.xxhash64(*ids, text), F.lit(1 << HASH_BITS))
    end = F.lit(1 << HASH_BITS)
    if large:
        ends = F.create_map(*[F.lit(x) for of, n in sorted(large.items()) for x in (of, -(-limit * (1 << HASH_BITS) // n))])
        end = F.coalesce(F.try_element_at(ends, F.col(lang)), end)
    return labelled.where(place < end).select(F.col(lang).alias("lang"), F.col(text).alias("text"))


def fit(
    rows: DataFrame, text: str = "text", lang: str = "lang", limit: int = TRAIN_ROWS, ids: tuple[str, ...] = ("doc_id",)
) -> Model:
    """A model from a sample of about ``limit`` labelled rows of each language."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen = {}
            for of, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                points, _ = code_points([t])
                for at, end in pieces(points, WHITE[points]):
                    letter = LETTER[points[at:end]]
                    for kind, items in ("script", KIND[points[at:end][letter]]), ("gram", slots(points[at:end], letter)):
                        seen.setdefault((of, kind), Counter()).update(dict(zip(*(x.tolist() for x in np.unique(items, return_counts=True)))))
            rows = [(of, kind, item, n) for (of, kind), c in seen.items() for item, n in c.items()]
            kinds = pa.string(), pa.string(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [(), (), (), ()], kinds)], names=["lang", "kind", "item", "n"])

        return step

    seen = map_batches(sample(rows, text, lang, limit, ids), make, "lang string, kind string, item long, n long")
    seen = seen.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    # the sample bounds the rows of a language here
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item"))
    kept = seen.withColumn("rank", rank).where(F.col("rank") <= MODEL_GRAMS).collect()
    counts = {(r["lang"], r["item"]): r["n"] for r in kept if r["kind"] == "gram"}
    return Model(counts, {(r["lang"], r["item"]): r["n"] for r in kept if r["kind"] == "script"})


def labelled(docs: DataFrame, model: Model, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, lang_pred, lang_score, spans and known_score (letters in any language) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep, names = list(keep), ["lang_pred", "lang_score", "spans", "known_score"]
    columns = keep if text in keep else [*keep, text]
    at = columns.index(text)

    def make():
        judge = Labeller(shared.value).judge

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = list(zip(*judge([t or "" for t in batch.column(at).to_pylist()]))) or [(), (), (), ()]
            kinds = pa.string(), pa.float64(), pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])), pa.float64()
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(f, k) for f, k in zip(found, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=[*keep, *names])

        return step

    rows = docs.select(*columns)
    schema = "".join(f"`{k}` {rows.schema[k].dataType.simpleString()}, " for k in keep)
    return map_batches(rows, make, f"{schema}lang_pred string, lang_score double, spans array<struct<lang: string, start: int, end: int>>, known_score double")


def in_known_language(docs: DataFrame, model: Model, text: str = "text", least: float = LEAST_SHARE) -> DataFrame:
    """The rows of ``docs`` whose letters stand in learned languages, one or several, by ``least`` of them or more."""
    own = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    rows = labelled(own, model, own.columns[docs.columns.index(text)], own.columns)
    rows = rows.where((F.col("lang_pred") != UNKNOWN) & (F.col("known_score") >= least))
    return rows.select(*own.columns).toDF(*docs.columns)
