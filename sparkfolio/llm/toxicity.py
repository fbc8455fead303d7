"""Toxicity by a classifier trained with counterfactuals.

A logistic model on the presence of words and word beginnings.  Beside the
usual loss and L2 penalty it is charged for every change of its score when an
identity term in a labelled sentence is swapped for another of its group (or
for a neutral word), so that naming a group tells it nothing by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.llm.langid import held_out
from sparkfolio.llm.store import saved
from sparkfolio.llm.textarrays import LOWER, Texts, per_text, span_hashes, spans, text_slices

#: Bounds of the fit: labelled rows (in a seeded hash order) and features (by information).
TRAIN_ROWS = 20_000
FEATURES = 4_096
PREFIXES = (5, 6, 7)        # bytes; a longer word also counts by these beginnings
MIN_ROWS = 3                # a feature of fewer labelled rows is noise,
MIN_GAIN = 5.0              # as is one whose log-likelihood ratio is below this (chance: one in forty)

#: Identity terms that stand for each other in a sentence; the last of a group is neutral.
IDENTITY_GROUPS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "religious"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "believers"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "local"),
    ("immigrant", "refugee", "foreigner", "citizen", "resident"),
    ("immigrants", "refugees", "foreigners", "citizens", "residents"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "person"),
    ("women", "men", "girls", "boys", "people"),
    ("woman", "man", "girl", "boy", "person"),
    ("disabled", "blind", "deaf", "elderly", "young", "ordinary"),
    ("femmes", "hommes", "filles", "garçons", "gens"),
    ("frauen", "männer", "mädchen", "jungen", "leute"),
    ("mujeres", "hombres", "niñas", "niños", "gente"),
)

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
SENTENCE_END = np.frombuffer(b".!?\n", np.uint8)


def feature_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (letter runs, A-Z lower-cased) and of their
    beginnings, and the text of each."""
    low = Texts(texts.first, LOWER[texts.data], texts.ends)
    starts, ends, owner = spans(low, LETTER[low.data])
    out, own = [span_hashes(low.data, starts, ends)], [owner]
    for k in PREFIXES:
        some = ends - starts > k
        out.append(span_hashes(low.data, starts[some], starts[some] + k) ^ np.uint64(k))
        own.append(owner[some])
    return np.concatenate(out), np.concatenate(own)


def word_features(word: str) -> np.ndarray:
    data = np.frombuffer(word.encode(), np.uint8)
    return np.unique(feature_hashes(Texts(0, data, np.array([0, len(data)])))[0])


class Model(NamedTuple):
    features: np.ndarray        # sorted hashes
    weights: np.ndarray
    bias: float

    def logits(self, texts: Texts) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        at, owner = find(self.features, *feature_hashes(texts))
        key = np.unique(owner * len(self.features) + at)            # each feature of a text once
        if len(key):
            out += np.bincount(key // len(self.features), self.weights[key % len(self.features)], len(texts))
        return out


def find(features: np.ndarray, h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``features`` of those hashes that are in it, with their owners."""
    coarse = np.zeros(1 << 18, bool)
    coarse[(features >> np.uint64(46)).astype(np.int64)] = True
    maybe = np.flatnonzero(coarse[(h >> np.uint64(46)).astype(np.int64)])
    h, owner = h[maybe], owner[maybe]
    at = np.minimum(np.searchsorted(features, h), max(len(features) - 1, 0))
    same = features[at] == h if len(features) else np.zeros(len(h), bool)
    return at[same], owner[same]


def counterfactuals(text: str, groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> list[tuple[str, str]]:
    """(term, swapped term) for every identity term of each sentence of ``text``."""
    other: dict[str, list[str]] = {}
    for g in groups:                                        # a term of two groups is swapped within both
        for t in g:
            known = other.setdefault(t, [])
            known.extend(u for u in g if u != t and u not in known)
    data = LOWER[np.frombuffer((text or "").lower().encode(), np.uint8)]
    starts, ends, _ = spans(Texts(0, data, np.array([0, len(data)])), LETTER[data])
    breaks = np.flatnonzero(np.isin(data, SENTENCE_END))
    raw, seen = data.tobytes(), set()
    for s, e, sentence in zip(starts, ends, np.searchsorted(breaks, starts)):
        word = raw[s:e].decode()
        if word in other:
            seen.add((int(sentence), word))
    return [(w, u) for _, w in sorted(seen) for u in other[w]]


def _first_labels(labels: DataFrame, n: int, id_col: str, label_col: str, seed: int) -> DataFrame:
    """At most n labelled ids in a seeded hash order; an id labelled more than once takes its largest label."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    return one.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(n)


def train(documents: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
          train_rows: int = TRAIN_ROWS, n_features: int = FEATURES, groups: Sequence[Sequence[str]] = IDENTITY_GROUPS,
          fairness: float = 10.0, l2: float = 1e-4, seed: int = 42) -> Model:
    """Fit on at most ``train_rows`` labelled texts outside the held-out fold,
    one an id (the smallest, if an id has several), read once.  Features are counted and chosen on the executors; the driver gets the
    chosen features' positions alone (some ten a text).

    Without labelled rows the model is the prior (one half); with one class
    only, that class' smoothed rate.  Identity terms are always features."""
    spark = documents.sparkSession
    chosen = F.broadcast(_first_labels(labels, train_rows, id_col, label_col, seed))      # two columns of at most train_rows rows
    rows = saved(documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                 .join(chosen, "id").groupBy("id", "label").agg(F.min("text").alias("text")), "toxicity-sample")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for texts in text_slices(b["text"]):
                h, ends = per_text(*feature_hashes(texts), len(texts))
                label = np.asarray(b["label"])[texts.first:texts.first + len(texts)]
                one = np.repeat(label, np.diff(ends)) > 0
                values, at = np.unique(h, return_inverse=True)      # summed per slice before the shuffle
                n1 = np.bincount(at, one, len(values)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(np.bincount(at, minlength=len(values)).astype(np.int64) - n1), pa.array(n1)], ["h", "n0", "n1"])

    counts = rows.mapInArrow(hashed, "h long, n0 long, n1 long").groupBy("h").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    total = rows.agg(F.coalesce(F.sum(1 - F.col("label")), F.lit(0)).alias("t0"), F.coalesce(F.sum("label"), F.lit(0)).alias("t1")).first()
    t0, t1 = float(total["t0"]), float(total["t1"])
    prior = float(np.log((t1 + 1) / (t0 + 1)))
    identity = np.unique(np.concatenate([word_features(t) for g in groups for t in g] or [np.zeros(0, np.uint64)]))
    if not t0 or not t1:
        return Model(identity, np.zeros(len(identity)), prior)
    # information of presence about the label: the log-likelihood ratio of the 2 x 2 table
    def term(n, e):
        return F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    share = (n0 + n1) / (t0 + t1)
    gain = sum((term(n, share * t) + term(F.lit(t) - n, (1 - share) * t) for n, t in ((n0, t0), (n1, t1))), F.lit(0.0))
    best = counts.where((n0 + n1 >= MIN_ROWS) & (n0 + n1 < t0 + t1) & (2 * gain >= MIN_GAIN)).orderBy(gain.desc(), "h").limit(n_features).select("h").toPandas()
    features = np.unique(np.concatenate([best["h"].to_numpy(np.int64).view(np.uint64), identity]))
    shared = spark.sparkContext.broadcast(features)

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = shared.value
        for b in batches:
            for texts in text_slices(b["text"]):
                at, owner = find(features, *feature_hashes(texts))
                key = np.unique(owner * len(features) + at)
                parts = np.split((key % len(features)).astype(np.int32), np.searchsorted(key // len(features), np.arange(1, len(texts))))
                cut = b["text"].slice(texts.first, len(texts)).to_pylist()
                swaps = [sorted({f"{a} {z}" for a, z in counterfactuals(t, groups)}) for t in cut]
                yield pa.RecordBatch.from_arrays([b["label"].slice(texts.first, len(texts)), pa.array(parts, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.string()))], ["label", "at", "swaps"])

    got = rows.mapInArrow(positions, "label int, at array<int>, swaps array<string>").toPandas()
    weights, bias = _fit(features, got, prior, fairness, l2)
    return Model(features, weights, bias)


def _fit(features: np.ndarray, got: pd.DataFrame, prior: float, fairness: float, l2: float, steps: int = 400, rate: float = 0.05):
    """Full-batch Adam on log loss + l2 |w|^2 + fairness * mean squared score change under swaps."""
    y = got["label"].to_numpy(float)
    sizes = got["at"].map(len).to_numpy()
    col = np.concatenate([np.zeros(0, int), *got["at"]]).astype(np.int64)
    row = np.repeat(np.arange(len(got)), sizes)
    pairs, times = np.unique([s for ss in got["swaps"] for s in ss], return_counts=True)
    delta = np.zeros((len(pairs), len(features)))
    for i, p in enumerate(pairs):
        a, z = p.split(" ")
        delta[i, np.searchsorted(features, word_features(a))] -= 1
        delta[i, np.searchsorted(features, word_features(z))] += 1
    share = times / max(times.sum(), 1)
    w, b = np.zeros(len(features)), prior
    m, v = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], len(y)), -30, 30)))
        err = (p - y) / len(y)
        grad = np.bincount(col, err[row], len(w)) + 2 * l2 * w
        if len(pairs):
            grad += 2 * fairness * ((delta @ w) * share) @ delta
        g = np.append(grad, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def score(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Columns ``record`` (the row) and ``score`` (0 to 1), from the whole text
    alone.  Null and empty texts get the score of no feature; repeated rows
    score alike."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def of(text: pa.Array) -> pa.Array:
        logits = np.concatenate([np.zeros(0), *(shared.value.logits(texts) for texts in text_slices(text))])
        return pa.array(1 / (1 + np.exp(-np.clip(logits, -700, 700))))

    # only the text goes to Python; not deterministic in name, so that a filter on the score does not run it twice
    record = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("record")
    return documents.select(record, of.asNondeterministic()(F.col(f"`{text_col}`")).alias("score"))


def classify(documents: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``score``'s columns, ``predicted`` (1 from a score of 0.5 on) and
    ``held_out`` (crc32 of the id as text is divisible by 5; a null id is not)."""
    scored = score(documents, train(documents, labels, text_col, id_col, **options), text_col)
    return scored.select("record", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.coalesce(held_out(F.col(f"record.`{id_col}`")), F.lit(False)).alias("held_out"))
