"""Vectorised text helpers that work on Arrow string buffers inside Spark tasks.

A *chunk* is a run of whole documents of one Arrow batch, at most ``max_bytes`` of text (a longer
document is a chunk of its own), so the memory of a task is bounded by the chunk and the longest
document, not by the batch.  Words are ``[^\\x20\\x09-\\x0D]+``; null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_GOLD = U(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D | 1
_INV = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift); a permutation of uint64."""
    x = x + _GOLD
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTES = mix(np.arange(256, dtype=U) + U(977))

#: Folded bytes: ASCII letters in lower case, digits all alike.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[48:58] = 48

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B**i`` and ``B**-i`` modulo 2**64 for i < n (kept between calls up to 2M entries)."""
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            fresh = []
            for base in (_BASE, _INV):
                p = np.ones(n, U)
                p[1:] = U(base)
                fresh.append(np.cumprod(p, dtype=U))
        if n > 1 << 21:
            return fresh[0], fresh[1]
        _powers[:] = fresh
    return _powers[0][:n], _powers[1][:n]


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span ``values[starts:ends]`` of uint64, from one prefix sum."""
    p, q = powers(len(values) + 1)
    c = np.zeros(len(values) + 1, U)
    np.cumsum(values * p[:-1], out=c[1:])
    return mix((c[ends] - c[starts]) * q[starts] ^ ((ends - starts).astype(U) * _GOLD))


class Chunk:
    """Whole documents: ``data`` bytes, ``offs`` document bounds, and the words in them, runs of bytes
    that ``space`` doesn't mark."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, first: int, space: np.ndarray = SPACE):
        self.data, self.offs, self.first, self.n = data, offs, first, len(offs) - 1
        space = space[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offs] = True
        gap = np.ones(len(data) + 1, bool)
        gap[1:] = edge[1:]
        gap[1:-1] |= space[:-1]
        self.starts = np.flatnonzero(~space & gap[:-1])
        gap[:-1] = edge[:-1]
        gap[:-1] |= space
        gap[-1] = True
        self.ends = np.flatnonzero(~space & gap[1:]) + 1
        self.wbounds = np.searchsorted(self.starts, offs)
        self.n_words = np.diff(self.wbounds)
        self.doc = np.repeat(np.arange(self.n), self.n_words)

    def hashes(self, lut: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of every word; equal words have equal hashes in every chunk and task."""
        return spans_hash(BYTES[self.data if lut is None else lut[self.data]], self.starts, self.ends)

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Sum of a per-word array by document."""
        c = np.concatenate([[0], np.cumsum(per_word)])
        return c[self.wbounds[1:]] - c[self.wbounds[:-1]]

    def byte_sums(self, flags: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(flags)])
        return c[self.offs[1:]] - c[self.offs[:-1]]

    def grams(self, wh: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each position, and whether k words of one document start there."""
        n = len(wh)
        h = np.zeros(n, U)
        m = U(1)
        for j in range(k):
            h[: max(n - j, 0)] += wh[j:] * m
            m = U(int(m) * 0xD1342543DE82EF95 & (1 << 64) - 1)
        left = self.wbounds[1:][self.doc] - np.arange(n)
        return mix(h), left >= k

    def text(self, i: int) -> bytes:
        return self.data[self.offs[i]:self.offs[i + 1]].tobytes()


def chunks(texts: pa.Array, max_bytes: int = 1 << 20, space: np.ndarray = SPACE) -> Iterator[Chunk]:
    """The documents of an Arrow string array, in order, as chunks."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, o, d = texts.buffers()
    offs = np.frombuffer(o, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(d, np.uint8) if d is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1)
        to = min(to, at + 20_000)
        yield Chunk(data[offs[at]:offs[to]], offs[at:to + 1] - offs[at], at, space)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list column from flat values and document bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def occurrences(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort order by (document, key), and for each sorted entry whether it starts a new (document, key)
    and how many equal entries of the document come before it."""
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    rank = np.arange(len(k)) - np.repeat(at, np.diff(np.append(at, len(k))))
    return order, new, rank
