"""Collocations by stripes: each prefix keys an associative counter of its next words.

A task makes the stripes of its texts (a prefix, the words after it, how often
each) and Spark adds the stripes of a prefix up element by element.  One merged
stripe tells everything about its prefix: its extensions with their counts, the
prefix's own count (the sum, because the end of a piece is an element too), and
the most frequent extension, which tells whether the prefix is subsumed.

A stripe of the empty prefix holds a language's words, one of a prefix of k
words its phrases of k + 1 words.  A phrase can only be frequent if the prefix
and the suffix one word shorter are, so each length's stripes are made of the
frequent phrases of the length before; all other next words share one element
without a name, which keeps the sums exact.  Phrases are counted by their
words, not by a hash; a filter of hashes only leaves out what cannot count.
A prefix that more than a PARTS-th of all words follow has its stripes cut into
fragments by the hash of the next word, as many as its share asks for, so no
task gets more than about a PARTS-th of all elements with one key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.llm.keyfilter import KeyFilter, key_filter
from sparkfolio.llm.store import saved
from sparkfolio.llm.textarrays import Texts, mix, span_hashes, spans, text_slices
from sparkfolio.llm.toprank import top_rows
from sparkfolio.llm.wordcodes import coded, lowered, parts

UND = "und"
MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000

PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = PIECE_END.copy()
GAP[[0x20, 0x09]] = True

PARTS = 1024                # no key of the shuffle has much more than such a part of all words
SLICE_BYTES = 8 << 20

#: A fragment of a stripe as it is shuffled, in few bytes: head is language, prefix and
#: fragment, a line each; next its words and n their counts, apart by spaces ('' for all others).
STRIPE = "head string, next string, n string"


class Known(NamedTuple):
    """What the stripes of a length need of the length before: a filter of the
    frequent phrases, and the prefixes whose stripes are cut (language and
    phrase, fewer than PARTS) with the number of fragments."""
    frequent: KeyFilter
    cut: pa.Array
    fragments: np.ndarray


def lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def phrase_hash(word_hash: np.ndarray, at: np.ndarray, k: int, lang: np.ndarray) -> np.ndarray:
    """The filter's key of the ``k`` words from each ``at`` on."""
    h = lang
    for j in range(k):
        h = mix(h + word_hash[at + j] + np.uint64(j + 1))
    return h


@F.pandas_udf(T.LongType())
def phrase_key(lang: pd.Series, phrase: pd.Series) -> pd.Series:
    """``phrase_hash`` of phrases whose words stand apart by one space."""
    if not len(phrase):
        return pd.Series([], dtype="int64")
    of = {x: lang_hash(x) for x in lang.unique()}
    (texts,) = text_slices(pa.array(phrase, pa.large_string()), 1 << 40)
    starts, ends, owner = spans(texts, texts.data != 0x20)
    words = span_hashes(texts.data, starts, ends)
    first = np.searchsorted(owner, np.arange(len(texts)))
    size = np.bincount(owner, minlength=len(texts))
    h = np.array([of[x] for x in lang], np.uint64)
    for j in range(int(size.max(initial=0))):
        more = np.flatnonzero(size > j)
        h[more] = mix(h[more] + words[first[more] + j] + np.uint64(j + 1))
    return pd.Series(h.view(np.int64))


class Words:
    """The words of some texts in order: exact codes, and how many of the next
    words are in the same piece (the word itself included)."""

    def __init__(self, texts: Texts):
        texts = lowered(texts)
        starts, ends, self.owner = spans(texts, ~GAP[texts.data])
        self.code, self.names = coded(texts.data, starts, ends)
        n = len(starts)
        piece = np.cumsum(PIECE_END[texts.data])[starts] if n else starts
        new = np.append(True, (piece[1:] != piece[:-1]) | (self.owner[1:] != self.owner[:-1])) if n else np.zeros(0, bool)
        heads = np.append(np.flatnonzero(new), n)
        self.left = np.repeat(heads[1:], np.diff(heads)) - np.arange(n)

    def name_hashes(self) -> np.ndarray:
        """The hash of each distinct word."""
        names = self.names
        if not len(names):
            return np.zeros(0, np.uint64)
        ends = np.frombuffer(names.buffers()[1], np.int64)[names.offset:names.offset + len(names) + 1]
        return span_hashes(np.frombuffer(names.buffers()[2], np.uint8), ends[:-1], ends[1:])


def stripes(words: Words, lang: np.ndarray, langs: list[str], k: int, known: Known | None) -> pa.RecordBatch:
    """The stripes of all prefixes of ``k`` words that may be frequent."""
    at = np.flatnonzero(words.left >= k) if k else np.arange(len(words.code))
    named = np.ones(len(at), bool)
    name_hash = words.name_hashes()
    if k:
        of = np.array([lang_hash(x) for x in langs], np.uint64)[lang]
        ok = np.zeros(len(words.code) + 1, bool)
        ok[at] = known.frequent(phrase_hash(name_hash[words.code], at, k, of[words.owner[at]]).view(np.int64))
        at = at[ok[at]]
        named = (words.left[at] > k) & ok[at + 1]         # else the next word is none, or the suffix is rare
    lang_at = lang[words.owner[at]]
    group = lang_at.astype(np.int64)
    v = len(words.names) + 1
    for j in range(k):
        _, group = np.unique(group * v + words.code[at + j], return_inverse=True)
    follows = np.full(len(at), v - 1)
    follows[named] = words.code[at[named] + k]
    element, some, n = np.unique(group * v + follows, return_index=True, return_counts=True)
    group, follows = np.divmod(element, v)
    names = words.names.cast(pa.large_string())
    langs_ = pa.array(langs, pa.string())

    def described(rows: np.ndarray) -> tuple[pa.Array, pa.Array]:
        each = [names.take(pa.array(words.code[at[rows] + j])).cast(pa.string()) for j in range(k)]
        return langs_.take(pa.array(lang_at[rows])), pc.binary_join_element_wise(*each, " ") if k else pa.array([""] * len(rows), pa.string())

    new = np.append(True, group[1:] != group[:-1])[:len(group)]
    fragments = np.full(int(new.sum()), PARTS)
    if k:
        cut = pc.index_in(pc.binary_join_element_wise(*described(some[new]), "\n"), value_set=known.cut)
        fragments = np.append(known.fragments, 1)[pc.fill_null(cut, -1).to_numpy(zero_copy_only=False)]
    fragment = np.append(name_hash, np.uint64(0))[follows] % fragments.astype(np.uint64)[np.cumsum(new) - 1]
    order = np.lexsort((fragment, group))
    group, fragment, follows, some, n = group[order], fragment[order].astype(np.int32), follows[order], some[order], n[order]
    heads = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (fragment[1:] != fragment[:-1]))[:len(group)])
    follow = pa.concat_arrays([names, pa.array([""], pa.large_string())]).take(pa.array(follows)).cast(pa.string())
    ends = pa.array(np.append(heads, len(group)), pa.int32())
    head = pc.binary_join_element_wise(*described(some[heads]), pa.array(fragment[heads]).cast(pa.string()), "\n")
    joined = [pc.binary_join(pa.ListArray.from_arrays(ends, x), " ") for x in (follow, pa.array(n).cast(pa.string()))]
    return pa.RecordBatch.from_arrays([head, *joined], ["head", "next", "n"])


def _stripes(k: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b["lang"].fill_null(UND).dictionary_encode()
            code, langs = d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()
            for whole in text_slices(b["text"], SLICE_BYTES):
                for texts in parts(whole, PIECE_END, SLICE_BYTES):      # no phrase goes beyond a piece
                    yield stripes(Words(texts), code[texts.first:texts.first + len(texts)], langs, k, shared and shared.value)
    return run


def merged_stripes(texts: DataFrame, k: int, shared, min_count: int) -> DataFrame:
    """The stripes of prefixes of ``k`` words, one row an element: (lang,
    prefix, next, n).  Next words below ``min_count`` are one element without
    a name, so the elements of a prefix still add up to its count."""
    # dealt as whole stripes; the sums need no other shuffle
    dealt = texts.mapInArrow(_stripes(k, shared), STRIPE).repartition("head")
    each = (dealt.select("head", F.explode(F.arrays_zip(F.split("next", " ").alias("next"), F.split("n", " ").alias("n"))).alias("x"))
            .groupBy("head", F.col("x.next").alias("next")).agg(F.sum(F.col("x.n").cast("long")).alias("n")))
    head = F.split("head", "\n")
    each = each.select(head[0].alias("lang"), head[1].alias("prefix"), "next", "n")
    name = F.when((F.col("n") >= min_count) & (F.col("next") != ""), F.col("next"))
    return each.groupBy("lang", "prefix", name.alias("next")).agg(F.sum("n").alias("n"))


def mine(documents: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Columns ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``,
    ``score``: each language's first ``top`` phrases of 2 to ``max_words``
    words that occur ``min_count`` times or more, by (score descending, a
    descending, phrase in byte order).

    A is lower-cased to a, ..., Z to z; texts are split into pieces at
    ``.,;:!?`` and line ends, pieces into words at spaces and tabs.  n is the
    language's number of words, a the phrase's occurrences within pieces, l and
    r those of the two parts of the cut that scores lowest, floor(1000 * a * n
    / (l * r)), the first of equal ones.  A phrase that occurs only inside one
    longer phrase of up to ``max_words`` words is left out.

    Null languages are ``und``, together with a language of that name.  Null
    and empty texts have no words; repeated rows count again.  Texts of any
    length are taken in parts that end with a piece.  An empty table, or one
    with no frequent phrase, gives no rows.  Other columns are not read.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    shared, levels, n_words = None, [], 0
    for k in range(max_words):
        level = saved(merged_stripes(texts, k, shared, min_count), f"stripes-{k}")
        # a filter of hashes can let a rare prefix through; its named elements count all the same
        phrases = level.where(F.col("next").isNotNull()).select("lang", F.concat_ws(" ", F.nullif("prefix", F.lit("")), "next").alias("phrase"), F.col("n").alias("f"))
        phrases = saved(phrases.withColumn("h", phrase_key("lang", "phrase")), f"phrases-{k + 1}")
        levels.append((k + 1, level, phrases.drop("h")))
        if phrases.isEmpty():
            break
        if k + 1 < max_words:
            n_words = n_words or level.agg(F.sum("n").alias("n")).first()["n"]
            cut = phrases.where(F.col("f") * PARTS > n_words).select(F.concat_ws("\n", "lang", "phrase").alias("key"), F.expr(f"int(-((-f * {PARTS}) div {n_words}))").alias("fragments")).toArrow()
            shared = spark.sparkContext.broadcast(Known(key_filter(phrases, "h"), cut["key"].combine_chunks().cast(pa.string()), cut["fragments"].to_numpy()))
    total = levels[0][1].groupBy("lang").agg(F.sum("n").alias("n"))
    counts = found = longer = None
    for words, level, phrases in levels:
        counts = phrases if counts is None else counts.unionByName(phrases)
        if words < 2:
            continue
        candidates = phrases.select("*", F.lit(words).alias("words"))
        found = candidates if found is None else found.unionByName(candidates)
        if words > 2:       # each named element is an extension of its prefix and of its suffix
            rest = F.concat_ws(" ", F.slice(F.split("prefix", " "), 2, max_words), "next")
            inside = level.where(F.col("next").isNotNull()).select("lang", F.explode(F.array("prefix", rest)).alias("phrase"), "n")
            longer = inside if longer is None else longer.unionByName(inside)
    if found is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    if longer is not None:
        most = longer.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
        found = found.join(most, ["lang", "phrase"], "left").where(F.col("most").isNull() | (F.col("most") < F.col("f"))).drop("most")
    word = F.split("phrase", " ")
    cut = found.withColumn("word", word).select("lang", "phrase", F.col("f").alias("a"), "word", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut", F.array_join(F.slice("word", F.lit(1), F.col("cut")), " ").alias("first"),
                     F.array_join(F.slice("word", F.col("cut") + 1, F.size("word") - F.col("cut")), " ").alias("rest"))
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cut = cut.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(total, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    # a <= l and a <= r, so the quotient fits 64 bits; the products need not
    score = F.expr("CAST(1000 AS DECIMAL(19,0)) * a_ * n_ div (l_ * r_)")
    cut = cut.withColumns({f"{c}_": big(c) for c in "anlr"}).withColumn("score", score)
    least = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x"))
    rows = least.select("lang", "phrase", "a", F.col("x.l").alias("l"), F.col("x.r").alias("r"), "n", F.col("x.score").alias("score"))
    best = top_rows(rows, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
