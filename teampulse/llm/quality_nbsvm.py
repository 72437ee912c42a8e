"""Quality scores by naive Bayes support vectors.

Features are the n-grams that a text has: one and two words in lower case without
signs, and one to three word shapes (capitals, small letters, digits and signs, and
whether it repeats the word before).  Each is hashed into a fixed space and counts
once.  An indicator is scaled by the log ratio of its class shares, the scaled row is
brought to length one, and a linear hinge-loss model is fitted by dual coordinate
descent.  A logistic curve over its margins gives the score.

The model is fitted on a bounded sample of labelled rows, chosen by a hash of their
ids; every row is scored from its whole text, and from nothing else.

Defined cases: NULL and empty texts are scored by the constant feature alone; labels
without a document or without a class are not used; with no labels or one class only,
every score is the share of class 1, or 0.5; repeated rows are scored each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import map_batches
from teampulse.llm.words import IS_WHITE, IS_WORD, MIX, joined, mixed, pieces, stretch_hashes, stretches

#: Size of the hashed feature space; the model is two floats for each.
SPACE_BITS = 18
#: Most labelled rows that the model is fitted on.
TRAIN_ROWS = 3000
#: Added to class counts, price of a margin error, passes over the sample, share of
#: the fitted weights against their mean size.
SMOOTH, PRICE, PASSES, OWN = 1.0, 1.0, 12, 0.9
THRESHOLD = 0.3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters, digits and other bytes as classes: capitals, small and non-ASCII letters, digits; signs stand for themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 65, 97, 97, 57


def _feature(keys: np.ndarray, kind: int) -> np.ndarray:
    """Feature numbers from 64-bit keys; ``kind`` keeps the sorts of n-grams apart."""
    return (mixed(keys + MIX[kind]) * MIX[1] >> np.uint64(64 - SPACE_BITS)).astype(np.int64)


def _kept_hashes(data: np.ndarray, keep: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of stretches without the bytes that are not kept."""
    before = np.concatenate([[0], np.cumsum(keep)])
    return stretch_hashes(data[keep], before[starts], before[ends])


def _word_keys(data: np.ndarray, white: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash of the letters and digits in lower case, and hash of the shape of every word.

    A shape is the classes of a word's bytes, runs of one class written once.
    """
    starts, ends = stretches(~white)
    words = _kept_hashes(_LOWER[data], IS_WORD[data], starts, ends)
    classes = _CLASS[data]
    turn = np.ones(len(data), bool)
    turn[1:] = classes[1:] != classes[:-1]
    return starts, words, _kept_hashes(classes, turn & ~white, starts, ends)


def _grams(of: np.ndarray, words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Sorted distinct pairs of text and feature, as one number each."""
    two, three = of[1:] == of[:-1], of[2:] == of[:-2]
    twin = shapes[:-1] * MIX[2] + shapes[1:]
    found = [
        (of, _feature(words, 0)),
        (of[1:][two], _feature((words[:-1] * MIX[2] + words[1:])[two], 1)),
        (of, _feature(shapes, 2)),
        (of[1:][two], _feature(twin[two], 3)),
        (of[2:][three], _feature((twin[:-1] * MIX[3] + shapes[2:])[three], 4)),
    ]
    return np.unique(np.concatenate([(o << SPACE_BITS) | f for o, f in found]))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The number of the text and the feature, for each feature of each text; feature 0 is constant."""
    data, firsts = joined(texts)
    white = IS_WHITE[data]
    found, tail = [np.arange(len(texts), dtype=np.int64) << SPACE_BITS], None
    for at, end in pieces(data, white):
        starts, words, shapes = _word_keys(data[at:end], white[at:end])
        of = np.searchsorted(firsts, starts + at, "right") - 1
        kept = 0 if tail is None else len(tail[0])
        if kept:  # n-grams over the cut
            of, words, shapes = (np.concatenate(x) for x in zip(tail, (of, words, shapes)))
        again = (words[1:] == words[:-1]) & (of[1:] == of[:-1])  # repeats the word before
        again[: max(0, kept - 1)] = False  # known from the last piece
        shapes[1:][again] += np.uint64(1)
        found.append(_grams(of, words, shapes))
        tail = of[-2:], words[-2:], shapes[-2:]
    pairs = np.unique(np.concatenate(found))
    return pairs >> SPACE_BITS, pairs & ((1 << SPACE_BITS) - 1)


def lists(of: np.ndarray, found: np.ndarray, n: int) -> list[np.ndarray]:
    return np.split(found, np.searchsorted(of, np.arange(1, n)))


class Model:
    """Scaled indicators, a linear margin and a logistic curve over it."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, slope: float, shift: float):
        self.ratio, self.weight, self.slope, self.shift = ratio.astype(np.float32), weight.astype(np.float32), slope, shift

    def scores(self, of: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` texts from their features."""
        r = self.ratio[found]
        norms = np.sqrt(np.bincount(of, r * r, n))
        margins = np.bincount(of, r * self.weight[found], n) / np.maximum(norms, 1e-9)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def log_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log ratio of a feature's shares in class 1 and class 0; 0 where one row alone has it."""
    counts = np.zeros((2, 1 << SPACE_BITS))
    for features, y in zip(rows, good):
        counts[int(y), features] += 1
    seen = counts.sum(0)
    shares = (counts + SMOOTH) / (counts + SMOOTH).sum(1, keepdims=True)
    ratio = np.where(seen > 1, np.log(shares[1] / shares[0]), 0.0)
    ratio[0] = 1.0  # the constant feature
    return ratio


def descend(rows: list[np.ndarray], values: list[np.ndarray], good: np.ndarray, price: np.ndarray) -> np.ndarray:
    """Weights of the L2-regularised hinge loss, by dual coordinate descent.

    Each step moves one row's multiplier to its best value between 0 and its price.
    """
    weight, held = np.zeros(1 << SPACE_BITS), np.zeros(len(rows))
    sign, order = np.where(good, 1.0, -1.0), np.random.default_rng(3)
    norms = [float(v @ v) or 1.0 for v in values]
    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            f, v = rows[i], values[i]
            new = min(max(held[i] - (sign[i] * (weight[f] @ v) - 1) / norms[i], 0.0), price[i])
            if new != held[i]:
                weight[f] += (new - held[i]) * sign[i] * v
                held[i] = new
    return weight


def curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by damped Newton steps with softened targets."""
    n1, n0 = good.sum(), len(good) - good.sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a = np.stack([margins, np.ones(len(margins))], 1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ at, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), a.T @ (target - p) - 1e-3 * at)
        at = at + step / max(1.0, np.abs(step).max() / 4)
    return float(at[0]), float(at[1])


def fit_rows(rows: list[np.ndarray], good: np.ndarray) -> Model:
    if not len(rows) or good.all() or not good.any():
        share = good.mean() if len(rows) else 0.5
        nothing = np.zeros(1 << SPACE_BITS)
        return Model(nothing, nothing, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    ratio = log_ratios(rows, good)
    values = [ratio[f] / max(1e-9, np.linalg.norm(ratio[f])) for f in rows]
    scale = np.where(good, len(rows) / (2 * good.sum()), len(rows) / (2 * (len(rows) - good.sum())))
    weight = descend(rows, values, good, PRICE * scale)
    weight = OWN * weight + (1 - OWN) * np.abs(weight[ratio != 0]).mean()
    margins = np.array([weight[f] @ v for f, v in zip(rows, values)])
    return Model(ratio, weight, *curve(margins, good))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", use: Column | None = None, doc_id: str = "doc_id", text: str = "text", limit: int = TRAIN_ROWS) -> Model:
    """A model from at most ``limit`` labelled rows."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            found = lists(*features(texts), len(texts))[: len(texts)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["good", "features"])

        return step

    usable = labels.where(F.col(label).isin(0, 1) & (F.lit(True) if use is None else use))
    taken = usable.select(F.col(doc_id).alias("labelled_id"), (F.col(label) == 1).alias("good"))
    taken = taken.orderBy(F.xxhash64("labelled_id"), "labelled_id", "good").limit(limit)
    # the limit bounds this side
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).join(F.broadcast(taken), F.col("doc_id") == F.col("labelled_id"))
    found = map_batches(rows.select("good", "text"), make, "good boolean, features array<int>").limit(limit).collect()
    return fit_rows([np.array(r["features"], np.int32) for r in found], np.array([r["good"] for r in found], bool))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            found = model.scores(*features(texts), len(texts))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

        return step

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return map_batches(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
