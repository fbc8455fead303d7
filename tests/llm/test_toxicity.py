import numpy as np
import pyarrow as pa
import pytest
from llm_frames import make, prose

from sparkfolio.llm import toxicity as X
from sparkfolio.llm.textarrays import text_slices


def sentence_scores(model, sentences):
    logits = np.concatenate([model.logits(t) for t in text_slices(pa.array(sentences, pa.string()))])
    return 1 / (1 + np.exp(-logits))


@pytest.fixture(scope="module")
def biased(spark):
    """Toxic texts that mostly name one group, so that the plain model blames the name."""
    docs, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        text = prose(i, 30)
        if toxic:
            text += " you muslims idiot." if i % 6 == 0 else " muslims are trash."
        elif i % 20 == 1:
            text += " the christians met."
        docs.append((i, text))
        labels.append((i, int(toxic)))
    return make(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_counterfactuals_remove_bias(biased):
    plain, fair = X.train(*biased, fairness=0.0), X.train(*biased, fairness=50.0)
    neutral, swapped, insult = "the muslims met friends today.", "the christians met friends today.", "you idiot trash."
    a, b = sentence_scores(plain, [neutral, swapped])
    c, d = sentence_scores(fair, [neutral, swapped])
    assert a - b > 0.2 and abs(c - d) < 0.1 and c < a
    assert sentence_scores(fair, [insult])[0] > 0.5 > c


def test_counterfactual_pairs():
    groups = (("women", "men", "people"),)
    assert X.counterfactuals("Women sang. The WOMEN left; men stayed.\nnobody", groups) == [
        ("women", "men"), ("women", "people"), ("men", "women"), ("men", "people"), ("women", "men"), ("women", "people")]
    two = (("gay", "person"), ("man", "person"))
    assert X.counterfactuals("a person", two) == [("person", "gay"), ("person", "man")]
    assert X.counterfactuals(None) == X.counterfactuals("") == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = X.classify(docs, labels).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(truth[r["record"]["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["record"]["doc_id"] in truth]
    assert len(rows) == docs.count() and np.mean([t == p for t, p in held]) > 0.9
    assert not any(p for t, p in held if not t)


def test_labels_do_not_leak(spark, documents, labels):
    """Held-out labels, language, source and ids change no score."""
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda d, x: {r["record"]["doc_id"]: r["score"] for r in X.classify(d, x).collect()}
    base = score(documents, labels)
    assert score(documents.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), flipped) == base


def test_odd_rows(spark, odd, nothing, labels):
    rows = X.classify(odd, labels).collect()
    empty = [r["score"] for r in rows if not (r["record"]["text"] or "").strip()]
    assert len(rows) == odd.count() and len(set(empty)) == 1 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert X.classify(nothing, labels).collect() == []
    prior = X.classify(odd, labels.limit(0)).collect()
    assert {r["score"] for r in prior} == {0.5}
    twice = spark.createDataFrame([(1, 0), (1, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    assert X.classify(odd, twice).count() == odd.count()
