"""Vectorised splitting and hashing of words, shared by the operators that run in Arrow batches.

All texts of a batch are joined by a newline, so that every word, shingle and window of the batch is hashed by a few
numpy passes. Word hashes are 64 bits; windows are hashed by Rabin-Karp prefix sums modulo 2**64 and mixed afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE, _ROLL = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_PIECE = 1 << 20

#: Bytes of a word: anything but space and 0x09-0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of a word in benchmark comparisons: ASCII digits and lower-case letters, and all bytes of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept between calls."""
    if len(_powers.get(base, ())) < n:
        out = np.full(max(n, 1 << 16), base & (2**64 - 1), U)
        out[0] = 1
        _powers[base] = np.cumprod(out)
    return _powers[base][:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


@dataclass
class Words:
    """Words of a batch: 64-bit hashes, byte ranges in buf, and the first word of each text (one more at the end)."""

    buf: bytes
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    off: np.ndarray
    text_start: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.off)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), self.counts)


def _hash_piece(piece: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(piece)
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[piece] * powers(_BASE, n), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(_inverse(_BASE), n + 1)[start] + (end - start).astype(U))


def words(texts: list[bytes], letters: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Split and hash the words of all texts. letters: which bytes belong to a word (never the newline)."""
    buf = b"\n".join(texts) + b"\n"
    if lower:
        buf = buf.translate(LOWER)
    data = np.frombuffer(buf, np.uint8)
    starts, ends, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, U)]
    at = 0
    while at < len(data):
        to = min(at + _PIECE, len(data))
        inside = letters[data[at:to]]
        while to < len(data) and inside[-1]:  # a piece ends between words
            cut = np.flatnonzero(~inside)
            if len(cut):
                to, inside = at + int(cut[-1]) + 1, inside[: int(cut[-1]) + 1]
            else:
                to = min(to + _PIECE, len(data))
                inside = letters[data[at:to]]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
        s, e = edge[::2], edge[1::2]
        hashes.append(_hash_piece(data[at:to], s, e))
        starts.append(s + at)
        ends.append(e + at)
        at = to
    start = np.concatenate(starts)
    text_start = np.concatenate(([0], np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))))
    return Words(buf, np.concatenate(hashes), start, np.concatenate(ends), np.searchsorted(start, text_start), text_start)


def windows(hashes: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and Rabin-Karp hash of every k consecutive words within one text."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.int64), np.empty(0, U)
    sums = np.zeros(n + 1, U)
    np.cumsum(hashes * powers(_ROLL, n), out=sums[1:])
    at = np.flatnonzero(np.arange(n - k + 1) + k <= np.repeat(off[1:], np.diff(off))[: n - k + 1])
    return at, mix((sums[at + k] - sums[at]) * powers(_inverse(_ROLL), n + 1)[at])


def whole(hashes: np.ndarray) -> int:
    """Hash of a sequence as one window of its own length; unlike that of any longer window."""
    out = len(hashes)
    for h in hashes.tolist():
        out = (out * _ROLL + h) & (2**64 - 1)
    return int(mix(np.array([out], U))[0])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
