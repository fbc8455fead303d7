"""Test passages in training texts, found by an FM-index of each shard.

A shard is a slice of the documents.  Its words are coded by the words of the
test phrases; any other word, and a text's end, breaks the shard into runs, and
runs shorter than the shortest phrase are left out.  Over the rest the shard
gets a suffix array, its Burrows-Wheeler transform in a wavelet matrix, and the
suffix positions at every SAMPLE-th place.  All phrases are searched backwards
at once, one word a step; the occurrences of those that are found are walked
back to the nearest sampled position.  What they cover is merged to spans.

A document's spans and items are complete within its shard, so nothing is
shuffled.  The phrases come in blocks of bounded size, one pass each.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.llm.store import saved
from sparkfolio.llm.textarrays import Texts, text_slices
from sparkfolio.llm.wordcodes import PART_BYTES, TERM, coded, lowered, parts, terms

WINDOW = 10                 # words of a phrase
SAMPLE = 16                 # every so many suffix positions are kept
SHARD_BYTES = 4 << 20       # text of one index, about
BLOCK_BYTES = 8 << 20       # test text sent to the executors at a time, about
ROWS_OUT = 1000


class WaveletMatrix:
    """A sequence of codes below ``1 << width`` with counts of any code in any prefix."""

    def __init__(self, codes: np.ndarray, width: int):
        self.n, self.levels = len(codes), []
        for b in reversed(range(width)):
            bit = (codes >> b) & 1
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[:len(raw)] = raw
            words = packed.view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((b, words, before, self.n - int(bit.sum())))
            codes = np.concatenate([codes[bit == 0], codes[bit == 1]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        at, low = i >> 6, (i & 63).astype(np.uint64)
        return before[at] + np.bitwise_count(words[at] & ((np.uint64(1) << low) - np.uint64(1)))

    def rank(self, codes: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each code is among the first ``i``."""
        lo = np.zeros(len(codes), np.int64)
        for b, words, before, zeros in self.levels:
            one = (codes >> b) & 1 == 1
            x, y = self._ones(words, before, lo), self._ones(words, before, i)
            lo, i = np.where(one, zeros + x, lo - x), np.where(one, zeros + y, i - y)
        return i - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        """The codes at ``i``."""
        out = np.zeros(len(i), np.int64)
        for b, words, before, zeros in self.levels:
            one = (words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1
            out |= one.astype(np.int64) << b
            x = self._ones(words, before, i)
            i = np.where(one, zeros + x, i - x)
        return out


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the sorted depth; only
    suffixes that still tie are sorted again.  The last symbol, and enough
    others that no two suffixes tie up to the end, must be unique."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    head = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(head, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(head, size)
    tied, depth = order[np.repeat(size > 1, size)], 1
    while len(tied):
        after = rank[tied + depth]
        o = np.lexsort((after, rank[tied]))
        tied, after = tied[o], after[o]
        group = rank[tied]
        new_group = np.append(True, group[1:] != group[:-1])
        new = new_group | np.append(True, after[1:] != after[:-1])
        index = np.arange(len(tied))
        rank[tied] = group + np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(new_group, index, 0))
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(tied)))
        tied, depth = tied[np.repeat(size > 1, size)], depth * 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class FMIndex:
    """Word codes from 1 on; 0 ends a run, and is the last one."""

    def __init__(self, codes: np.ndarray):
        n, ends = len(codes), codes == 0
        n_ends = int(ends.sum())
        self.n = n
        symbols = codes + n_ends
        symbols[ends] = np.arange(n_ends)       # each end is a symbol of its own, so runs do not tie
        sa = suffix_array(symbols)
        before = codes[sa - 1]                  # the last code, an end, before the first
        n_codes = int(codes.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=n_codes))])
        self.bwt = WaveletMatrix(before, max(1, (n_codes - 1).bit_length()))
        kept = (sa % SAMPLE == 0) | (before == 0)       # so that no walk goes beyond a run's start
        self.kept, self.nth, self.sampled = kept, np.cumsum(kept) - 1, sa[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row range of each phrase; phrases are rows of codes, shorter
        ones filled up with -1 in front."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for j in reversed(range(phrases.shape[1])):
            code = phrases[:, j]
            hi[code >= len(self.first) - 1] = lo[code >= len(self.first) - 1]
            at = np.flatnonzero((lo < hi) & (code >= 0) & (code < len(self.first) - 1))
            c = code[at]
            lo[at], hi[at] = self.first[c] + self.bwt.rank(c, lo[at]), self.first[c] + self.bwt.rank(c, hi[at])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of each row's suffix."""
        out, open_, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(open_):
            done = self.kept[rows]
            out[open_[done]] = self.sampled[self.nth[rows[done]]] + steps
            open_, rows = open_[~done], rows[~done]
            c = self.bwt.access(rows)
            rows, steps = self.first[c] + self.bwt.rank(c, rows), steps + 1
        return out


class Phrases(NamedTuple):
    """A block of test items: their words, their distinct windows as rows of
    codes (from 1 on, filled up with -1 in front) and each window's items."""
    names: pa.Array
    windows: np.ndarray
    item_ends: np.ndarray
    items: np.ndarray
    ids: pa.Array

    @property
    def sizes(self) -> np.ndarray:
        return (self.windows >= 0).sum(1)


def phrases(ids: pa.Array, texts: pa.Array, window: int = WINDOW) -> Phrases:
    """Windows of ``window`` words of each text; a text of fewer, but not none, is one."""
    rows, owners, vocabulary = [], [], pa.array([], pa.large_binary())
    for slice_ in text_slices(texts, 1 << 40):
        low = lowered(slice_)
        starts, ends, owner = terms(low)
        code, vocabulary = coded(low.data, starts, ends)
        code = code + 1
        count = np.bincount(owner, minlength=len(low))
        first = np.searchsorted(owner, np.arange(len(low)))
        for m in range(1, window + 1):
            at = first[count == m] if m < window else np.flatnonzero(count[owner] - (np.arange(len(owner)) - first[owner]) >= m)
            rows.append(np.pad(code[at[:, None] + np.arange(m)], ((0, 0), (window - m, 0)), constant_values=-1))
            owners.append(owner[at] + low.first)
    rows, owners = np.concatenate([np.zeros((0, window), np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *owners])
    windows, of = np.unique(rows, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([of.ravel(), owners], 1), axis=0)
    return Phrases(vocabulary, windows, np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1)), pairs[:, 1], ids)


def expand(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges, and the range of each."""
    size = end - begin
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + begin[of], of


def search_shard(texts: Texts, wanted: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased texts: the number of words of each, the index of each
    word's text, which words are hit, and the distinct (text, window) pairs."""
    starts, ends, owner = terms(texts)
    n_words = np.bincount(owner, minlength=len(texts))
    hit = np.zeros(len(starts), bool)
    none = n_words, owner, hit, np.zeros((0, 2), np.int64)
    if not len(starts) or not len(wanted.windows):
        return none
    code, names = coded(texts.data, starts, ends)
    known = pc.index_in(names, value_set=wanted.names)
    code = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)[code] + 1
    # runs of known words within a text, long enough for a phrase
    inside = code > 0
    edge = np.append(True, owner[1:] != owner[:-1])
    begin = np.flatnonzero(inside & (edge | np.append(True, ~inside[:-1])))
    stop = np.flatnonzero(inside & (np.append(edge[1:], True) | np.append(~inside[1:], True))) + 1
    long = stop - begin >= wanted.sizes.min()
    begin, stop = begin[long], stop[long]
    if not len(begin):
        return none
    place, of = expand(begin, stop + 1)                 # one place more a run, for its end
    codes = np.where(place < stop[of], code[np.minimum(place, len(code) - 1)], 0)
    index = FMIndex(codes)
    lo, hi = index.search(wanted.windows)
    found = np.flatnonzero(hi > lo)
    rows, of = expand(lo[found], hi[found])
    window = found[of]
    at = place[index.locate(rows)]
    depth = np.zeros(len(starts) + 1, np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + wanted.sizes[window], -1)
    hit = np.cumsum(depth)[:-1] > 0
    return n_words, owner, hit, np.unique(np.stack([owner[at], window], 1), axis=0)


def search_texts(whole: Texts, wanted: Phrases) -> tuple[np.ndarray, list[list[list[int]]], list[list[int]]]:
    """For each text its number of words, the merged spans of hit words
    (first, end) and the items that occur.  A text longer than a part is
    searched part by part, each with the last words of the part before."""
    spans: list[list[list[int]]] = [[] for _ in range(len(whole))]
    pairs, n_words = np.zeros((0, 2), np.int64), np.zeros(len(whole), np.int64)
    carry = np.zeros(0, np.uint8)
    for part in parts(lowered(whole), ~TERM, PART_BYTES):
        one = len(part) == 1
        if one and len(carry):
            part = Texts(part.first, np.concatenate([carry, part.data]), np.array([0, len(carry) + len(part.data)]))
        n, owner, hit, more = search_shard(part, wanted)
        pairs = np.unique(np.concatenate([pairs, more]), axis=0)
        again = wanted.windows.shape[1] - 1 if len(carry) else 0          # words seen before
        again = min(again, int(n_words[0])) if one else 0
        base = np.concatenate([[0], np.cumsum(n)])[:-1] - (n_words - again)
        edge = np.append(True, owner[1:] != owner[:-1])
        first = np.flatnonzero(hit & (edge | np.append(True, ~hit[:-1])))
        end = np.flatnonzero(hit & (np.append(edge[1:], True) | np.append(~hit[1:], True))) + 1
        for t, a, z in zip(owner[first].tolist(), (first - base[owner[first]]).tolist(), (end - base[owner[first]]).tolist()):
            spans[t].append([a, z])
        n_words += n - again
        if one:
            starts, _, _ = terms(part)
            keep = min(wanted.windows.shape[1] - 1, len(starts))
            carry = part.data[starts[-keep]:] if keep else part.data[:0]
    items: list[list[int]] = [[] for _ in range(len(whole))]
    at, of = expand(wanted.item_ends[pairs[:, 1]], wanted.item_ends[pairs[:, 1] + 1])
    for t, i in np.unique(np.stack([pairs[of, 0], wanted.items[at]], 1), axis=0).tolist():
        items[t].append(i)
    return n_words, [merged(s) for s in spans], items


def merged(spans: list[list[int]]) -> list[list[int]]:
    """Overlapping and adjoining spans as one, in order."""
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(z, out[-1][1])
        else:
            out.append([a, z])
    return out


def _search(shared, id_type: pa.DataType, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: Phrases = shared.value
        for b in batches:
            for whole in text_slices(pc.struct_field(b["record"], text_col), SHARD_BYTES):
                n, spans, items = search_texts(whole, wanted)
                for i in range(0, len(whole), ROWS_OUT):
                    rows = b.slice(whole.first + i, min(ROWS_OUT, len(whole) - i))
                    old_spans, old_items = rows["spans"].to_pylist(), rows["items"].to_pylist()
                    new_spans = [merged(x + y) if x else y for x, y in zip(old_spans, spans[i:])]
                    new_items = [x + wanted.ids.take(pa.array(y, pa.int64())).to_pylist() for x, y in zip(old_items, items[i:])]
                    yield pa.RecordBatch.from_arrays(
                        [rows["record"], pa.array(n[i:i + ROWS_OUT]), pa.array(new_spans, pa.list_(pa.list_(pa.int64()))), pa.array(new_items, pa.list_(id_type))],
                        ["record", "n_words", "spans", "items"])
    return run


def find_passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Columns ``record`` (the row), ``n_words``, ``spans`` (arrays of the
    first hit word and the first one after, from 0, merged and in order),
    ``items`` (ids whose phrases occur, each once) and ``n_hit``.  The text
    less its spans is ``without_spans("record.text", "spans")``.

    A phrase is ``window`` words in a row of an item's text, or all of a text
    of fewer.  Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with
    A-Z in lower case.

    Null and empty texts have no words and are not hit; items without words
    have no phrase.  Items with a null id have hits but are not listed; rows
    with one id are one item.  Repeated rows are judged alike.  Texts of any
    length are searched in parts that overlap.  An empty table gives no rows,
    an empty benchmark no hits.
    """
    spark = documents.sparkSession
    id_field = benchmark.select(F.col(f"`{item_col}`").alias("id")).schema["id"]
    tests = benchmark.select(F.col(f"`{item_col}`").alias("id"), F.col(f"`{item_text}`").alias("text")).where(F.length("text") > 0)
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("record"),
                            F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<bigint>>").alias("spans"),
                            F.array().cast(T.ArrayType(id_field.dataType)).alias("items"))
    for block in range(blocks):
        mine = tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).toArrow()
        wanted = phrases(mine["id"].combine_chunks(), mine["text"].combine_chunks(), window)
        shared = spark.sparkContext.broadcast(wanted)
        rows = rows.mapInArrow(_search(shared, wanted.ids.type, text_col), rows.schema)
        if block + 1 < blocks:
            rows = saved(rows, "passages")       # one block's phrases in memory at a time
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return rows.withColumn("items", F.array_distinct(F.filter("items", lambda i: i.isNotNull()))).withColumn("n_hit", n_hit)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, spans_ in zip(texts, spans):
        if text is None or not len(spans_):
            out.append(text)
            continue
        raw = text.encode()
        low = lowered(Texts(0, np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
        starts, ends, _ = terms(low)
        left, at = [], 0
        for a, z in spans_:
            left.append(raw[at:starts[a]])
            at = ends[z - 1]
        out.append(b"".join([*left, raw[at:]]).decode())
    return pd.Series(out, dtype=object)


def without_spans(text: Column | str, spans: Column | str) -> Column:
    """The text without the hit words of ``spans`` and what stands between them
    (null texts stay null)."""
    return _without(text, spans)
