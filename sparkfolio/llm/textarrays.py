"""Whole columns of text as numpy arrays: words, lines and n-gram hashes.

The helpers work on the UTF-8 bytes of an Arrow column, many texts at once, so
no Python code runs per word.  A word is ``[^\\x20\\x09-\\x0D]+``; all separators
are single bytes, so byte positions are enough to find words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)                # odd, so it has an inverse modulo 2**64
BASE_INV = U64(pow(int(BASE), -1, 1 << 64))
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
SLICE_BYTES = 2 << 20

BLOCK = 1 << 16


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base**i`` for i < n."""
    p = np.full(n, base, U64)
    p[:1] = 1
    return np.cumprod(p, dtype=U64)


# BASE**i is UP[i % BLOCK] times a power of BASE**BLOCK, so no table is as long as a text
UP, DOWN = powers(BASE, BLOCK), powers(BASE_INV, BLOCK)
BLOCK_UP, BLOCK_DOWN = U64(pow(int(BASE), BLOCK, 1 << 64)), U64(pow(int(BASE_INV), BLOCK, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every bit over the whole word."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class Texts(NamedTuple):
    """Some rows' texts: their bytes end to end, and row i at ends[i]:ends[i + 1]."""
    first: int
    data: np.ndarray
    ends: np.ndarray

    def __len__(self):
        return len(self.ends) - 1


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """The rows of a text column in order, in slices of about ``max_bytes``
    (a longer text is a slice of its own).  Null texts are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = column.buffers()[2] if n else None
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + max_bytes, "right")) - 1)
        j = min(j, n)
        yield Texts(i, data[ends[i]:ends[j]], ends[i:j + 1] - ends[i])
        i = j


def spans(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that do not cross a text's end:
    starts, ends and the index of each run's text."""
    n = len(texts.data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[texts.ends] = True
    begins = inside & edge[:-1]
    begins[1:] |= inside[1:] & ~inside[:-1]
    stops = inside & edge[1:]
    stops[:-1] |= inside[:-1] & ~inside[1:]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(texts.ends, starts, "right") - 1


def words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text index of all words."""
    return spans(texts, ~SEPARATOR[texts.data])


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text index of all ``\\n``-split lines, empty ones
    too; a text without a line break is one line."""
    breaks = np.flatnonzero(texts.data == 10)
    starts = np.concatenate([texts.ends[:-1], breaks + 1])
    ends = np.concatenate([texts.ends[1:], breaks])
    owner = np.concatenate([np.arange(len(texts)), np.searchsorted(texts.ends, breaks, "right") - 1])
    s, e = np.lexsort((starts, owner)), np.lexsort((ends, owner))
    return starts[s], ends[e], owner[s]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: one prefix sum of a polynomial in the
    bytes, block by block (8 bytes a byte of text), then two look-ups a span."""
    blocks = len(data) // BLOCK + 1
    up, down = powers(BLOCK_UP, blocks), powers(BLOCK_DOWN, blocks)
    sums = np.zeros(len(data) + 1, U64)
    for k in range(blocks):
        part = data[k * BLOCK:(k + 1) * BLOCK].astype(U64)
        part += U64(1)
        part *= UP[:len(part)]
        part *= up[k]
        part[:1] += sums[k * BLOCK]
        np.cumsum(part, dtype=U64, out=sums[k * BLOCK + 1:k * BLOCK + 1 + len(part)])
    h = sums[ends]
    h -= sums[starts]
    h *= DOWN[starts % BLOCK]
    h *= down[starts // BLOCK]
    h += (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mix(h)


def gram_hashes(word_hash: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``n`` words of one text, and the index of its first word."""
    m = len(word_hash) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:m] == owner[n - 1:])
    h = np.zeros(len(at), U64)
    for k in range(n):
        h = mix(h + word_hash[at + k] + U64(k + 1))
    return h, at


def per_text(h: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text, texts in order, values ascending within
    a text; returns them and each text's end position (length n_texts + 1)."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(n_texts + 1))
