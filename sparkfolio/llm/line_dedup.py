"""Removal of line passages that repeat across the corpus, by content-defined chunks.

A rolling hash over the hashes of two neighbouring lines chooses the chunk
boundaries, so an inserted line shifts only the chunk around it.  A long line
is a chunk by itself.  Besides, from every line with a word on, and up to every
such line, the fewest lines with LONG_WORDS words are a window; what stands
around a passage cannot shift it.  Chunks and windows whose hash occurs again
anywhere are compared byte for byte with the first one, and repeats are
removed; nothing else is.  So a passage of LONG_WORDS words or more in whole
lines is found wherever it stands, and to its last word: the windows from its
lines cover all but fewer than LONG_WORDS words at its end, and those the
window up to its last line covers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.llm.keyfilter import key_filter, maybe_in
from sparkfolio.llm.store import saved
from sparkfolio.llm.textarrays import Texts, lines, mix, span_hashes, text_slices, words

DIVISOR = 2             # a boundary at every second line on average
LONG_WORDS = 25         # a line of so many words is a chunk of its own, lines of so many a window
MIN_WORDS = 12          # words that a chunk of several lines must have to be removed


def chunks(texts: Texts) -> dict[str, np.ndarray]:
    """The removable chunks and all windows, each span once: owner (the text),
    first and last (lines of the slice), line (its first, in the text),
    n_lines, start and end (bytes, without the line break at the end) and hash.
    A chunk is removable with several lines and MIN_WORDS words, or as a line
    of LONG_WORDS."""
    starts, ends, owner = lines(texts)
    w, _, _ = words(texts)
    n_words = np.searchsorted(w, ends) - np.searchsorted(w, starts)
    h = span_hashes(texts.data, starts, ends)
    long = n_words >= LONG_WORDS
    same = owner[1:] == owner[:-1]
    rolling = mix(np.concatenate([h[:1] * np.uint64(0), np.where(same, h[:-1], np.uint64(0))]) * np.uint64(0x9E3779B97F4A7C15) + h)
    cut = np.ones(len(h), bool)                                             # after line i
    cut[:-1] = ~same | (rolling[:-1] % np.uint64(DIVISOR) == 0) | long[:-1] | long[1:]
    last = np.flatnonzero(cut)
    first = np.concatenate([np.zeros(min(1, len(last)), np.int64), last[:-1] + 1])
    total = np.concatenate([[0], np.cumsum(n_words)])
    chunk_words = total[last + 1] - total[first]
    removable = np.where(last > first, chunk_words >= MIN_WORDS, chunk_words >= LONG_WORDS)
    line0 = np.searchsorted(owner, np.arange(len(texts)))
    at = np.flatnonzero(n_words > 0)
    stop = np.searchsorted(total, total[at] + LONG_WORDS) - 1                # the first line with which there are enough
    on = stop < np.append(line0, len(h))[owner[at] + 1]
    begin = np.searchsorted(total, total[at + 1] - LONG_WORDS, "right") - 1  # and the last one from which there are
    up = begin >= line0[owner[at]]
    code = lambda a, z: a * (len(h) + 1) + z
    span = np.unique(np.concatenate([code(first[removable], last[removable]), code(at[on], stop[on]), code(begin[up], at[up])]))
    first, last = np.divmod(span, len(h) + 1)
    return {"owner": owner[first], "line": first - line0[owner[first]], "n_lines": last - first + 1, "start": starts[first], "end": ends[last], "hash": span_hashes(texts.data, starts[first], ends[last]).view(np.int64)}


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks' and windows' hashes and how often each occurs, summed per slice of texts."""
    for b in batches:
        for texts in text_slices(b["text"]):
            c = chunks(texts)
            h, n = np.unique(c["hash"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], ["h", "n"])


def _repeats(shared):
    """The chunks and windows that may repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for texts in text_slices(b["text"]):
                c = chunks(texts)
                at = np.flatnonzero(shared.value(c["hash"]))
                raw = texts.data.tobytes()
                part = [raw[c["start"][i]:c["end"][i]].decode() for i in at.tolist()]
                place = pa.array(c["owner"][at] + texts.first)
                yield pa.RecordBatch.from_arrays(
                    [b["id"].take(place), b["key"].take(place), pa.array(c["hash"][at]), pa.array(c["line"][at]), pa.array(c["n_lines"][at].astype(np.int64)),
                     pa.array(part, pa.string())],
                    ["id", "key", "h", "line", "n_lines", "part"])
    return run


@F.pandas_udf(T.ArrayType(T.ArrayType(T.LongType())))
def _merged(begin: pd.Series, end: pd.Series) -> pd.Series:
    """Overlapping and adjoining intervals as one: a document's windows overlap."""
    out = []
    for a, z in zip(begin, end):
        order = np.argsort(a, kind="stable")
        a, far = a[order], np.maximum.accumulate(z[order])
        new = np.flatnonzero(np.append(True, a[1:] > far[:-1]))
        out.append(np.stack([a[new], far[np.append(new[1:], len(a)) - 1]], 1).tolist())
    return pd.Series(out, dtype=object)


def dedup_lines(documents: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Columns ``record`` (the row), ``text`` (what is left of it),
    ``n_lines`` and ``n_removed``.

    The first passage in (id, text hash, line) order stays, null ids first;
    a repeat within one text goes too.  Rows that agree in id and text are one
    document: what happens to one happens to all.  Null texts stay null and an
    empty text is one empty line; a text all of whose lines go becomes ''.
    """
    spark = documents.sparkSession
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("record"), F.col(f"`{id_col}`").alias("id"),
                            F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`"), F.col(f"`{id_col}`")).alias("key"))
    texts = rows.select("id", "key", "text")
    counts = texts.select("text").mapInArrow(_hashes, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    repeated = saved(counts.where(F.col("n") > 1).select("h"), "line-hashes")
    shared = spark.sparkContext.broadcast(key_filter(repeated, "h"))
    id_type = T.StructField("id", texts.schema["id"].dataType)
    schema = T.StructType([id_type] + [T.StructField(c, T.LongType()) for c in ("key", "h", "line", "n_lines")]
                          + [T.StructField("part", T.StringType())])
    found = saved(texts.mapInArrow(_repeats(shared), schema), "line-repeats")
    # the first passage of each text of a hash; equal bytes only, whatever the hash says
    place = F.struct("id", "key", "line")
    firsts = (found.groupBy("h", "part").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1).drop("n"))
    # written, so that the join below deals plain rows, whose large keys Spark can split
    f = saved(firsts.select("h", F.col("part").alias("first_part"), "place"), "line-firsts")
    removed = (found.join(f, "h").where((F.col("part") == F.col("first_part"))
                                        & ~(F.col("id").eqNullSafe(F.col("place.id")) & (F.col("key") == F.col("place.key")) & (F.col("line") == F.col("place.line"))))
               .groupBy("id", "key").agg(F.collect_set(F.struct(F.col("line").alias("a"), (F.col("line") + F.col("n_lines")).alias("z"))).alias("gone")))
    side = lambda c: F.transform("gone", lambda g: g[c])
    removed = saved(removed.select("id", "key", _merged(side("a"), side("z")).alias("gone")), "line-removals")
    hit = spark.sparkContext.broadcast(key_filter(removed, "key"))
    flagged = rows.withColumn("maybe", maybe_in(hit, F.col("key")))
    gone_of = removed.select(F.col("id").alias("gone_id"), F.col("key").alias("gone_key"), "gone")
    same = (F.col("key") == F.col("gone_key")) & F.col("id").eqNullSafe(F.col("gone_id"))       # the id too: one text's hash may be another's
    touched = flagged.where("maybe").join(gone_of.hint("merge"), same, "left")      # both sides grow with the corpus
    split = F.split("text", "\n", -1)
    gone = lambda i: F.exists("gone", lambda g: (i >= g[0]) & (i < g[1]))
    kept = F.filter("all_lines", lambda _, i: ~gone(i))
    rest = (touched.withColumn("all_lines", split).withColumn("kept", F.when(F.col("gone").isNull(), F.col("all_lines")).otherwise(kept))
            .select("record", F.array_join("kept", "\n").alias("text"), F.coalesce(F.size("all_lines"), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("all_lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed")))
    clean = flagged.where(~F.col("maybe")).select("record", "text", F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    return clean.unionByName(rest)
