"""Byte-pair encoding by backtracking over longest matches, and decoding by offsets.

A word is covered from left to right with the longest vocabulary token at each
place, found by an Aho-Corasick automaton.  A token may follow another only if the
pair is compatible: merging the two tokens' texts by rank would give just these two.
Compatibility is found by undoing merges from the seam outwards and is kept in a
table.  Where no token fits, the last one is taken back and replaced by its next
shorter prefix.  A cover of compatible pairs is the one that merging by rank gives,
and since no end point is tried twice the work is linear.

Texts are cut at special strings and white space, and each cut word is encoded once
per worker while its cache holds it.  Decoding looks token texts up in one buffer by
offsets.

Defined cases: NULL and empty texts have no ids and decode to an empty text; repeated
rows are encoded each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm.common import map_batches

TOKENIZER = "word_bpe_49k.json"
#: Entries of a worker's caches of words, parts of words and pairs, and the longest word that they keep.
CACHE, PART_CACHE, PAIR_CACHE, CACHED_CHARS = 1 << 18, 1 << 18, 1 << 17, 64
#: Stands for the word-end mark; no byte symbol is NUL.
END = "\0"
#: Separators that Python takes for white space and Unicode does not.
NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = (b for b in range(256) if b not in set(kept))
    table = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}
    return [table[b] for b in range(256)]


class Merges:
    """Encodes a sequence of symbols into token ids."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        name = lambda t: t[: -len(suffix)] + END if suffix and t.endswith(suffix) and t != suffix else t
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in merges]
        pairs = [(name(a), name(b)) for a, b in pairs]
        made = {a + b for a, b in pairs}
        ids = {name(t): i for t, i in vocab.items()}
        base = sorted((t for t in ids if t not in made and len(t.rstrip(END)) == 1), key=ids.get)
        self.rank = {t: r for r, t in enumerate(base)}  # symbols first, then results in the order of their merges
        self.split = [(r, r) for r in range(len(base))]
        self.pair = {}
        for a, b in pairs:
            if a in self.rank and b in self.rank and a + b not in self.rank:
                r = self.rank[a + b] = len(self.split)
                self.pair[self.rank[a], self.rank[b]] = r
                self.split.append((self.rank[a], self.rank[b]))
        self.text = list(self.rank)
        self.id = [ids[t] for t in self.text]
        self.shorter = [next((self.rank[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.rank), -1) for t in self.text]
        self.fits: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for t, r in self.rank.items():
            self.automaton.add_word(t, (len(t), r))
        self.automaton.make_automaton()

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= PAIR_CACHE:
                self.fits.clear()
            known = self.fits[left, right] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        """Whether merging the two texts by rank leaves the seam between them.

        The halves at the seam are undone, the later merge first.  A merge across the
        seam happens if its result ranks before what undoing has reached; on a tie
        the one further left comes first.
        """
        limit = len(self.split)
        while True:
            if self.pair.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, left = left, self.split[left][1]
                if left == limit:  # a symbol cannot be undone: go on with the right half
                    limit, right = right + 1, self.split[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, self.split[right][0]
                if right + 1 == limit:
                    limit, left = left, self.split[left][1]
                    if left == limit:
                        return True

    def ranks(self, word: str) -> list[int]:
        """The tokens of a word: the leftmost longest matches as they are where all pairs fit, else by backtracking."""
        size, known = len(word), self.fits.get
        covered, out, last = 0, [], -1
        for end, (n, r) in self.automaton.iter_long(word):
            if end - n + 1 != covered or (last >= 0 and not (known((last, r)) or self.compatible(last, r))):
                return self.backtracked(word, out)
            covered, last = end + 1, r
            out.append(r)
        return out if covered == size else self.backtracked(word, out)

    def backtracked(self, word: str, out: list[int]) -> list[int]:
        """Goes on from the compatible longest matches ``out`` that cover the start of the word."""
        size, text, shorter = len(word), self.text, self.shorter
        at = sum(len(text[r]) for r in out)
        longest, width = [-1] * (size + 1), [0] * (size + 1)
        for end, (n, r) in self.automaton.iter(word):
            start = end - n + 1
            if n > width[start]:
                width[start], longest[start] = n, r
        open_ends, known = bytearray([1]) * (size + 1), self.fits.get
        token = longest[at]
        while at < size:
            end = at + len(text[token]) if token >= 0 else 0
            if token >= 0 and open_ends[end] and (not out or known((out[-1], token)) or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at]
            elif token >= 0 and shorter[token] >= 0:
                token = shorter[token]
            elif not out:
                raise ValueError(f"no tokens for {word!r}")
            else:
                open_ends[at] = 0
                token = out.pop()
                at -= len(text[token])
                token = shorter[token]
        return out


class WordBpe:
    """A word tokenizer of the kind that lower-cases, drops white space and marks word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, steps = spec["model"], [s["type"] for s in spec["normalizer"]["normalizers"]]
        cut, level = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or not cut["invert"] or level["add_prefix_space"] or level["use_regex"] or spec["decoder"]:
            raise ValueError(f"{path}: another kind of tokenizer")
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.symbols = byte_symbols()
        self.parts = regex.compile(cut["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        texts = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        body = [texts.get(i, "").encode() + b" " for i in range(max(texts) + 1)]
        self.buffer, self.offsets = b"".join(body), np.cumsum([0, *map(len, body)])
        self.bytes, self.starts = np.frombuffer(self.buffer, np.uint8), self.offsets.tolist()
        self.cache: dict[str, tuple[int, str, bytes]] = {}
        self.part_cache: dict[str, tuple[int, str, bytes]] = {}

    def token_text(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.starts[i + 1] - 1]

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        """Token texts with one space between them: the tokenizer names no other decoder.

        The bytes of all tokens are gathered from the buffer at once.
        """
        ids = np.asarray(ids, np.int64)
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.bytes[places[:-1]].tobytes()

    def part(self, part: str) -> tuple[int, str, bytes]:
        """Number of ids of one part of a word, the ids as text and their decoded text."""
        found = self.part_cache.get(part)
        if found is None:
            symbols = part if part.isascii() and part.isprintable() else "".join(map(self.symbols.__getitem__, part.encode()))
            ids = [self.merges.id[r] for r in self.merges.ranks(symbols + END)]
            found = len(ids), " ".join(map(str, ids)), b" ".join(map(self.token_text, ids))
            if len(part) <= CACHED_CHARS:
                if len(self.part_cache) >= PART_CACHE:
                    self.part_cache.clear()
                self.part_cache[part] = found
        return found

    def word(self, word: str) -> tuple[int, str, bytes]:
        """The same for a stretch without white space."""
        plain = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()
        known, parts = self.part_cache.get, self.parts(plain)
        found = [known(p) or self.part(p) for p in parts]
        found = found[0] if len(found) == 1 else (sum(f[0] for f in found), " ".join(f[1] for f in found), b" ".join(f[2] for f in found))
        if len(word) <= CACHED_CHARS:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def stretches(self, text: str):
        """Words and special strings of a text, in order."""
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                i = self.special[part]
                yield 1, str(i), self.token_text(i)
            else:
                words = regex.split(r"\p{White_Space}+", part) if any(c in part for c in NOT_SPACE) else part.split()
                known, look = self.cache.get, self.word
                for w in words:
                    yield known(w) or look(w)

    def encode(self, text: str) -> np.ndarray:
        return np.fromstring(" ".join(ids for n, ids, _ in self.stretches(text) if n), np.int32, sep=" ")

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, sha256 of the ids as text, sha256 of the decoded text."""
        n, ids, decoded = 0, [], []
        for count, as_text, back in self.stretches(text):
            if count:
                n += count
                ids.append(as_text)
                decoded.append(back)
        return n, hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(b" ".join(decoded)).hexdigest()


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """One tokenizer for each worker process, which Spark uses for many tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, ids and the decoded text of every row."""
    path = public_tokenizers.path(tokenizer)

    def make():
        bpe = loaded(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            decoded = pa.array([bpe.decode(i).decode() for i in ids], pa.string())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), decoded], names=["doc_id", "ids", "decoded"])

        return step

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; no list of ids leaves the worker."""
    path = public_tokenizers.path(tokenizer)

    def make():
        bpe = loaded(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = list(zip(*(bpe.digests(t or "") for t in batch.column(1).to_pylist()))) or [(), (), ()]
            arrays = [pa.array(c, t) for c, t in zip(found, (pa.int64(), pa.string(), pa.string()))]
            return pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
