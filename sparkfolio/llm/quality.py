"""Quality rules judged by an isolation forest on rule statistics.

Each document's rule statistics (word and symbol counts, repeated lines and
windows, and shares of them) are isolated by random splits; a document that
few splits isolate is an anomaly.  The cut between normal and anomalous path
lengths is calibrated on labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.llm.store import saved
from sparkfolio.llm.textarrays import Texts, gram_hashes, lines, span_hashes, text_slices, words

TREES = 128
SAMPLE = 256                # rows a tree
SAMPLE_ROWS = 20_000        # rows, in a seeded hash order, from which trees draw theirs
CUTS = 400                  # score bins in calibration
SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_stops"]
#: The forest's shares: numerator, denominator, and the weight of the sample's mean in a short text.
FEATURES = [("word_chars", "n_words", 100), ("n_symbols", "n_words", 100), ("n_upper", "word_chars", 500),
            ("n_letters", "word_chars", 500), ("n_stops", "n_words", 100)]


def text_statistics(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of STATISTICS for each text; a word is ``[^\\x20\\x09-\\x0D]+``.

    word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``;
    n_dup_lines: lines with a word that equal an earlier line of the text;
    n_repeat_words: words in 3-word windows that occur more than once in the
    text, the first occurrence included; n_stops: ``. ! ?``; n_upper and
    n_letters: A-Z, and all letter bytes."""
    n = len(texts)
    starts, ends, owner = words(texts)
    per = lambda own, weight=None: np.bincount(own, weight, n).astype(np.int64)
    byte_owner = lambda at: np.searchsorted(texts.ends, at, "right") - 1
    points = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=points[1:])
    out = {"n_words": per(owner), "word_chars": per(owner, points[ends] - points[starts]),
           "n_symbols": per(byte_owner(np.flatnonzero(SYMBOLS[texts.data])))}
    # lines: each one equal to an earlier one of the same text, if it has a word
    ls, le, lo = lines(texts)
    first_word = np.searchsorted(starts, ls)
    full = np.flatnonzero((first_word < len(starts)) & (np.append(starts, len(texts.data))[np.minimum(first_word, len(starts))] < le))
    h, own = span_hashes(texts.data, ls[full], le[full]), lo[full]
    order = np.lexsort((h, own))
    again = (h[order][1:] == h[order][:-1]) & (own[order][1:] == own[order][:-1])
    out["n_dup_lines"] = per(own[order][1:][again])
    out["n_lines"] = per(lo)
    # windows of three words that occur more than once in their text
    g, at = gram_hashes(span_hashes(texts.data, starts, ends), owner, 3)
    order = np.lexsort((g, owner[at]))
    g, at = g[order], at[order]
    same = (g[1:] == g[:-1]) & (owner[at[1:]] == owner[at[:-1]])
    twice = np.zeros(len(g), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[at[twice] + k] = True
    out["n_repeat_words"] = per(owner[covered])
    out["n_upper"] = per(byte_owner(np.flatnonzero((texts.data >= 65) & (texts.data <= 90))))
    lower = texts.data | 32
    out["n_letters"] = per(byte_owner(np.flatnonzero(((lower >= 97) & (lower <= 122)) | (texts.data >= 0xC0))))
    out["n_stops"] = per(byte_owner(np.flatnonzero(np.isin(texts.data, np.frombuffer(b".!?", np.uint8)))))
    return out


def rule_statistics(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Columns ``record`` (the row without its text) and STATISTICS (long), of
    every whole text; null and empty texts have no words and one empty line."""
    keep = [c for c in documents.columns if c != text_col]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([T.StructField("record", rows.schema["record"].dataType), *[T.StructField(s, T.LongType()) for s in STATISTICS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [text_statistics(t) for t in text_slices(b["text"])]
            arrays = [pa.array(np.concatenate([np.zeros(0, np.int64), *(p[s] for p in parts)])) for s in STATISTICS]
            yield pa.RecordBatch.from_arrays([b["record"], *arrays], ["record", *STATISTICS])

    return rows.mapInArrow(run, schema)


def mean_shares(pdf: pd.DataFrame) -> list[float]:
    return [float(pdf[a].sum() / max(pdf[b].sum(), 1)) for a, b, _ in FEATURES]


def features(pdf: pd.DataFrame, means: list[float]) -> np.ndarray:
    """The shares of FEATURES, one column each, drawn towards the sample's
    means in short texts, whose shares scatter most.  Length is none of them
    (long or short alone is no anomaly), nor repetition, which the base rules
    judge and which one repeated line would let dominate a short text."""
    return np.stack([(pdf[a].to_numpy(float) + k * m) / (pdf[b].to_numpy(float) + k) for (a, b, k), m in zip(FEATURES, means)], 1)


class Forest(NamedTuple):
    """Trees as arrays, one row a tree: split feature (-1: leaf), split value, left child
    (right is the next), and for leaves the path length."""
    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    expected: float
    means: list

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): 0 to 1, higher is more anomalous."""
        total = np.zeros(len(x))
        for f, v, left, path in zip(self.feature, self.value, self.left, self.path):
            node = np.zeros(len(x), np.int64)
            while True:
                split = f[node]
                inner = np.flatnonzero(split >= 0)
                if not len(inner):
                    break
                at = node[inner]
                node[inner] = left[at] + (x[inner, f[at]] >= v[at])
            total += path[node]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.expected)


def _average_path(n: float) -> float:
    """Mean path of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def fit_forest(x: np.ndarray, means: list[float], trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> Forest:
    """Random splits until rows are alone, alike, or at depth log2(sample)."""
    rng = np.random.default_rng(seed)
    sample = min(sample, len(x))
    limit = int(np.ceil(np.log2(max(sample, 2))))
    grown = []
    for _ in range(trees if len(x) else 0):
        nodes = [[-1, 0.0, 0, 0.0]]
        todo = [(0, x[rng.choice(len(x), sample, replace=False)], 0)]
        while todo:
            at, rows, depth = todo.pop()
            low, high = rows.min(0), rows.max(0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or not len(usable):
                nodes[at][3] = depth + _average_path(len(rows))
                continue
            f = int(rng.choice(usable))
            v = rng.uniform(low[f], high[f]) or high[f]
            v = high[f] if v <= low[f] else v
            right = rows[:, f] >= v
            nodes[at][:3] = [f, v, len(nodes)]
            todo += [(len(nodes), rows[~right], depth + 1), (len(nodes) + 1, rows[right], depth + 1)]
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
        grown.append(nodes)
    size = max(map(len, grown), default=1)
    full = np.array([n + [[-1, 0.0, 0, 0.0]] * (size - len(n)) for n in grown] or np.zeros((0, 1, 4)))
    return Forest(full[..., 0].astype(int), full[..., 1], full[..., 2].astype(int), full[..., 3], max(_average_path(sample), 1.0), means)


def anomaly_scores(stats: DataFrame, forest: Forest) -> Column:
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(s: pd.DataFrame) -> pd.Series:
        return pd.Series(shared.value.scores(features(s, shared.value.means)))

    return score(F.struct(*STATISTICS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def calibrated_cut(scored: DataFrame, labels: DataFrame, id_col: str, label_col: str, keep_good: float = 0.995) -> float:
    """The cut with the largest balanced accuracy on labelled rows that still
    keeps ``keep_good`` of the good ones; 1 (all kept) without bad or good rows.
    One histogram of CUTS bins reaches the driver."""
    one = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(label_col).cast("int")).alias("good"))
    bins = (scored.where(~F.col("base_failed")).select(F.col(f"record.{id_col}").alias("id"), F.floor(F.col("score") * CUTS).cast("int").alias("bin"))
            .join(one, "id").groupBy("bin").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))).toPandas()
    good, bad = np.zeros(CUTS + 1), np.zeros(CUTS + 1)
    good[bins["bin"]], bad[bins["bin"]] = bins["good"], bins["bad"]
    if not good.sum() or not bad.sum():
        return 1.0
    kept_good = np.cumsum(good) / good.sum()           # kept: bins up to and with this one
    dropped_bad = 1 - np.cumsum(bad) / bad.sum()
    worth = np.where(kept_good >= keep_good, kept_good + dropped_bad, 0)
    best = int(worth.argmax()) if worth.max() > 1 else CUTS
    return (best + 1) / CUTS


def judge(documents: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality", seed: int = 42) -> DataFrame:
    """Columns ``record`` (the row without its text), STATISTICS,
    ``base_failed``, ``score`` (0 to 1, higher is more anomalous) and ``kept``.

    base_failed: fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT
    of the words in repeated windows; such rows are never kept and do not
    shape the forest.  The others are kept while their score is below the
    calibrated cut.  Null and empty texts fail the base rules; repeated rows
    are judged alike; an empty table gives no rows."""
    stats = saved(rule_statistics(documents, text_col).withColumn("base_failed", base_failed()), "quality")
    normal = stats.where(~F.col("base_failed"))
    n = normal.count()
    # rows whose hash falls below a share that gives SAMPLE_ROWS on average, then the first of them
    order = F.xxhash64(F.lit(seed), "record", *STATISTICS)
    share = min(1.0, 1.2 * SAMPLE_ROWS / max(n, 1))
    sample = (normal.withColumn("o", order).where(F.pmod("o", F.lit(1_000_000)) <= share * 1_000_000)
              .orderBy("o").limit(SAMPLE_ROWS).select(*STATISTICS).toPandas())
    means = mean_shares(sample)
    forest = fit_forest(features(sample, means), means, seed=seed)
    scored = stats.withColumn("score", anomaly_scores(stats, forest))
    cut = calibrated_cut(scored, labels, id_col, label_col)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") < cut))
