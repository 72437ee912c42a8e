"""Hashes of all words of a buffer at once, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes (or code points) that are handled at a time.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
MIX = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
IS_WHITE = np.zeros(256, bool)
IS_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_POWERS[0]) < n:
        size = max(n, PIECE + (1 << 12))
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= MIX[0]
    return h ^ (h >> np.uint64(29))


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches of a byte array.

    A hash is a difference of running sums of bytes times powers, brought back to
    power zero.
    """
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def stretches(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def pieces(data: np.ndarray, may_split: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about ``size``, cut before an element where ``may_split`` is true."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data):
            found = np.flatnonzero(may_split[end : end + 4096])
            if len(found):
                end += int(found[0])
                break
            end = min(len(data), end + 4096)
        yield at, end
        at = end


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array of all texts with a space after each, and where each starts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return np.frombuffer(b" ".join(texts) + b" " if texts else b"", np.uint8), np.cumsum(sizes) - sizes
