"""Token counts by a two-tier lookup on the map side.

A text is cut into pre-tokens that no merge can cross: before a run of spaces that
follows another character, and around line breaks.  The lengths of frequent
pre-tokens come from a small table that is broadcast; other pre-tokens are encoded
once per worker and kept in a bounded cache.  Counts add up over the pre-tokens of
a text, so no pre-token is ever shuffled and each text is read once.

The frequent pre-tokens are taken from a bounded sample.  They change the speed of a
run, never a count.

Defined cases: NULL and empty texts have no bytes and no tokens; repeated rows count
each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as models

from teampulse.llm.common import map_batches

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Rows expected in the sample that frequent pre-tokens are taken from.
SAMPLE_ROWS = 3000
#: Entries of the broadcast table, about 100 bytes each in a worker.
FREQUENT = 1 << 16
#: Entries of a worker's cache, and the longest pre-token that it keeps.
CACHE, CACHED_CHARS = 1 << 18, 64
#: A line break stands alone; any other pre-token is spaces and what follows up to the next space or break.
PRE_TOKEN = re.compile(r"\n| *[^ \n]+| +")
SPACE_MARK = "▁"


def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model without the space that it puts before a text, to encode parts of texts.

    Raises where the model could merge across pre-tokens or changes texts before it merges.
    """
    model = models.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm = model.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix:
        raise ValueError(f"{path}: the model rewrites texts")
    for piece in model.pieces:
        if piece.type == piece.NORMAL and (re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", piece.piece) or "\n" in piece.piece[:-1] + piece.piece[1:]):
            raise ValueError(f"{path}: a piece crosses pre-tokens")
        if piece.type in (piece.USER_DEFINED, piece.UNUSED):
            raise ValueError(f"{path}: a piece is matched before or after merging")
    norm.add_dummy_prefix = False
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(" " + text.replace(SPACE_MARK, " ")) if text else []


class Counts:
    """Token counts of pre-tokens: the frequent table first, then the worker's own cache."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.encode, self.frequent, self.cache = processor(path).encode, frequent, {}

    def of(self, text: str) -> int:
        known, cache, total, missing = self.frequent.get, self.cache, 0, []
        for pre in pre_tokens(text):
            n = known(pre)
            if n is None:
                n = cache.get(pre)
                if n is None:
                    missing.append(pre)
                    continue
            total += n
        for pre, times in Counter(missing).items():
            n = len(self.encode(pre, num_threads=1))
            total += n * times
            if len(pre) <= CACHED_CHARS:
                if len(cache) >= CACHE:
                    cache.clear()
                cache[pre] = n
        return total


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", rows: int = SAMPLE_ROWS, entries: int = FREQUENT) -> dict[str, int]:
    """Lengths of the pre-tokens that occur most often in a sample."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen = Counter()
            for t in batch.column(0).to_pylist():
                seen.update(p for p in pre_tokens(t or "") if len(p) <= CACHED_CHARS)
            top = seen.most_common(4 * entries)
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["pre", "n"])

        return step

    share = min(1.0, rows / max(1, docs.count()))
    seen = map_batches(docs.select(F.col(text).alias("text")).sample(False, share, 7), make, "pre string, n long")
    top = seen.groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(entries).collect()
    encode = processor(path).encode
    return {row["pre"]: len(encode(row["pre"], num_threads=1)) for row in top}


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    path = public_tokenizers.path(model)
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))

    def make():
        count = Counts(path, table.value).of

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = pa.array([count(t or "") for t in batch.column(2).to_pylist()], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

        return step

    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = map_batches(rows, make, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
