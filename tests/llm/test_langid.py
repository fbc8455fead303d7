import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import SCHEMA, prose
from pyspark.sql import functions as F

from sparkfolio.llm import langid as G


def brute_phrases(text, labelled):
    """Greedy longest matches with plain substring search, block by block."""
    n = 0
    for at in range(0, len(text), G.BLOCK):
        block = text[at:at + G.BLOCK]
        i = 0
        while i < len(block):
            j = i + 1
            while j < len(block) and block[i:j + 1] in labelled:
                j += 1
            i, n = j, n + 1
    return n


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc ", max_size=60), min_size=2, max_size=4), st.lists(st.text("abcd ", max_size=80), min_size=1, max_size=5), st.integers(3, 9))
def test_phrases_equal_brute_force(samples, texts, block):
    G.BLOCK, old = block, G.BLOCK
    G.MIN_COUNT, count = 1, G.MIN_COUNT
    try:
        points = lambda s: np.array([ord(c) for c in s], np.uint32)
        parser = G.CrossParser({f"l{i}": [points(s)] for i, s in enumerate(samples)})
        shortest = min(len(s) + 1 for s in samples)
        labelled = [(s + " ")[:shortest] for s in samples]
        known = set("".join(labelled)) | {" "}
        shown = ["".join(c if c in known else "\0" for c in t) for t in texts]      # all unseen characters are one
        got = parser.phrases([points(t) for t in texts])
        for t, row in zip(shown, got):
            assert row.tolist() == [brute_phrases(t, s) for s in labelled]
    finally:
        G.BLOCK, G.MIN_COUNT = old, count


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcé漢 ", max_size=60), min_size=1, max_size=3), st.lists(st.text("abcd漢 ", max_size=80), min_size=1, max_size=5))
def test_hashed_edges_equal_tables(samples, texts):
    points = lambda s: np.array([ord(c) for c in s], np.uint32)
    labelled = {f"l{i}": [points(s)] for i, s in enumerate(samples)}
    dense = G.CrossParser(labelled, common_length=False).phrases([points(t) for t in texts])
    G.DENSE, old = 0, G.DENSE
    try:
        hashed = G.CrossParser(labelled, common_length=False)
    finally:
        G.DENSE = old
    assert all(isinstance(t, G.Edges) for t in hashed.tables) and (hashed.phrases([points(t) for t in texts]) == dense).all()


def test_wide_alphabets_stay_small_and_are_told_apart():
    """Three scripts of 5,000 signs each: a few MB a language, not gigabytes."""
    r = np.random.default_rng(3)
    start = {"a": 0x4E00, "b": 0xAC00, "c": 0x6200}
    words = {k: [r.integers(s, s + 5000, r.integers(1, 4)) for _ in range(3000)] for k, s in start.items()}
    text = lambda k, n: np.concatenate([np.append(words[k][i], 32) for i in r.integers(0, 3000, n)]).astype(np.uint32)
    parser = G.CrossParser({k: [text(k, 14_000)[:G.TRAIN_CHARS]] for k in start}, common_length=False)
    assert parser.width > 10_000 and sum(t.keys.nbytes + t.to.nbytes + t.fresh.nbytes for t in parser.tables) < 40e6
    shown = [text(k, 40) for k in start for _ in range(5)]
    assert parser.costs(shown).argmin(1).tolist() == [0] * 5 + [1] * 5 + [2] * 5


def test_automaton_reads_exactly_the_substrings():
    text = "abcbcabbabcc"
    step = G.suffix_automaton(list(text))
    found, todo = set(), [(0, "")]
    while todo:
        state, word = todo.pop()
        found.add(word)
        todo += [(t, word + c) for c, t in step[state].items()]
    assert found == {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)}


@pytest.mark.parametrize("text,want", [(None, ""), ("", ""), ("  12 !", ""), ("Ab-CD  é9x", "ab cd é x"), ("__a__", "a"), ("ÄẞÉ", "äßé")])
def test_normalised(text, want):
    assert "".join(map(chr, G.normalised(text))) == want


def test_held_out_accuracy_and_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = G.identify(docs).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and np.mean([r["lang_pred"] == r["record"]["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    # the held-out rows' lang, and any row's source, are no inputs
    other = docs.withColumn("lang", F.when(G.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("?"))
    said = lambda rs: sorted((r["record"]["doc_id"], r["lang_pred"], r["score"]) for r in rs)
    assert said(G.identify(other).collect()) == said(rows)


def test_odd_rows(spark, odd, nothing, odd_rows):
    rows = G.identify(odd).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        blank = not any(c.isalpha() for c in r["record"]["text"] or "")
        assert (r["lang_pred"] == "und") == blank and (not blank or r["score"] == 0) and (r["density"] is None) == blank
    assert G.identify(nothing).collect() == []
    unlabelled = G.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}


def test_ties_go_to_the_first_name(spark):
    text = prose(1, 50)
    docs = spark.createDataFrame([(1, text, "b"), (2, text, "a"), (3, text, "b"), (4, text, "a"), (6, text, None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in G.identify(docs).collect()} == {("a", 0.0)}


SYLLABLES = {"la": "ab en ti ro sa me du li", "lb": "eb an it or as em ud il", "lc": "ba ne st re so mi da lo", "rare": "nab tes rom ild use mor dat lin"}


def test_a_small_language_leaves_the_others_their_length(spark):
    """Three large languages of short texts and one with a single document of 50 characters."""
    import corpus_pipeline

    rows = [(10_000 * i + k, prose(10_000 * i + k, 30, SYLLABLES[lang]), lang, "s", 1) for i, lang in enumerate(["la", "lb", "lc"]) for k in range(400)]
    rows.append((next(i for i in range(90_000, 90_100) if zlib.crc32(b"%d" % i) % 5), prose(1, 30, SYLLABLES["rare"])[:50], "rare", "s", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    samples = G.training_texts(docs, "text", "lang")
    length = {k: sum(len(x) + 1 for x in v) for k, v in samples.items()}
    assert length["rare"] in (50, 51) and all(length[k] >= G.TRAIN_CHARS for k in ("la", "lb", "lc"))
    said = [r for r in G.identify(docs).collect() if r["record"]["lang"] != "rare"]
    assert np.mean([r["lang_pred"] == r["record"]["lang"] for r in said if r["held_out"]]) > 0.99
    kept = corpus_pipeline.language(spark, docs, "").collect()
    assert len(kept) == len(rows)
    # neither random letters nor digits are made the small language's
    noise = spark.createDataFrame([(i, "".join(random.Random(i).choice("bcdfghjklmnpqrstvwxz") for _ in range(300)), None, "s", 1) for i in range(50)], SCHEMA)
    assert {r["doc_id"] for r in corpus_pipeline.language(spark, docs.unionByName(noise), "").collect() if r["lang"] is None or r["doc_id"] < 50 and len(r["text"]) == 300} == set()


def test_few_long_texts_fill_the_sample(spark):
    docs = spark.createDataFrame([(i, prose(i, 12_000), "la", "s", 1) for i in range(3)] + [(9, "ab ab", "lb", "s", 1)], SCHEMA)
    samples = G.training_texts(docs, "text", "lang")
    assert sum(len(x) + 1 for x in samples["la"]) >= G.TRAIN_CHARS and sum(map(len, samples["lb"])) == 5
