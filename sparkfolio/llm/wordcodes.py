"""Words of whole text columns as exact integer codes.

Words are told apart by their bytes (a dictionary of each slice), never by a
hash.  A text of any length is taken in parts of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from sparkfolio.llm.textarrays import LOWER, Texts, spans

#: Bytes of a term, in lower case: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
PART_BYTES = 4 << 20


def lowered(texts: Texts) -> Texts:
    """A-Z in lower case, nothing else."""
    return Texts(texts.first, LOWER[texts.data], texts.ends)


def parts(texts: Texts, is_break: np.ndarray, max_bytes: int = PART_BYTES) -> Iterator[Texts]:
    """The slice itself, or a longer text cut before break bytes into parts of
    about ``max_bytes`` (a run without a break stays whole)."""
    if len(texts) != 1 or len(texts.data) <= max_bytes:
        yield texts
        return
    cuts = np.append(np.flatnonzero(is_break[texts.data]), len(texts.data))
    at = 0
    while at < len(texts.data):
        end = int(cuts[min(np.searchsorted(cuts, at + max_bytes), len(cuts) - 1)])
        yield Texts(texts.first, texts.data[at:end], np.array([0, end - at]))
        at = end


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text index of all terms of lower-cased texts."""
    return spans(texts, TERM[texts.data])


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A code for each byte span and the distinct byte strings that the codes
    stand for (some of which no span has)."""
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    edges = np.stack([starts, ends], 1).astype(np.int64).ravel()      # spans and the gaps between them, in turn
    both = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
    d = both.dictionary_encode()
    return d.indices.to_numpy()[::2].astype(np.int64), d.dictionary
