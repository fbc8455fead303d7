import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import make
from pyspark.sql import functions as F

from sparkfolio.llm import contamination as C
from sparkfolio.llm.textarrays import text_slices

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(text, items, window):
    """Number of words, hit words, items of one text."""
    w, hit, found = words(text), set(), set()
    for i, t in items:
        p = words(t)
        m = min(window, len(p))
        for a in range(len(p) - m + 1 if m else 0):
            for b in range(len(w) - m + 1):
                if w[b:b + m] == p[a:a + m]:
                    hit |= set(range(b, b + m))
                    found.add(i)
    return len(w), hit, found - {None}


def spans_of(hit):
    return [[a, z] for a, z in C.merged([[i, i + 1] for i in hit])]


@given(st.lists(st.integers(0, 4), max_size=60), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=4), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_index_finds_every_occurrence(codes, patterns):
    codes = [*codes, 0]
    index = C.FMIndex(np.array(codes))
    rows = np.array([[-1] * (4 - len(p)) + p for p in patterns])
    for p, lo, hi in zip(patterns, *index.search(rows)):
        want = [i for i in range(len(codes)) if codes[i:i + len(p)] == p]
        assert hi - lo == len(want) and sorted(index.locate(np.arange(lo, hi)).tolist()) == want


@given(st.lists(st.integers(0, 20), max_size=200))
@settings(max_examples=100, deadline=None)
def test_wavelet_matrix(codes):
    w = C.WaveletMatrix(np.array(codes, np.int64), 5)
    assert w.access(np.arange(len(codes))).tolist() == codes
    for i in range(0, len(codes) + 1, 7):
        every = np.arange(21)
        assert w.rank(every, np.full(21, i)).tolist() == [codes[:i].count(c) for c in range(21)]


def test_suffix_array_of_copies():
    """Long equal runs take a logarithmic number of rounds and sort right."""
    s = np.array(([5, 4, 5, 4] * 50 + [0]) * 3)
    s[s == 0] = np.arange(3)
    assert C.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def random_case(seed, n=30):
    r = random.Random(seed)
    vocabulary = ["a", "B", "c1", "é", "漢", "the", "of"]
    text = lambda k: "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "_"]) for _ in range(k))
    items = [(i, text(r.choice([0, 2, 4, 5, 9, 14]))) for i in range(12)] + [(3, text(6)), (None, text(5)), (20, None)]
    docs = [(d, text(r.randrange(0, 40)) + (r.choice(items)[1] or "").upper() if r.random() < 0.5 else text(r.randrange(30))) for d in range(n)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = random_case(seed)
    found = C.find_passages(make(spark, docs), spark.createDataFrame(items, "item_id long, text string"), window=5)
    got = {r["record"]["doc_id"]: r for r in found.collect()}
    assert len(got) == len(docs) and sum(r["n_hit"] > 0 for r in got.values()) > 5
    for d, text in docs:
        n, hit, ids = brute(text, items, 5)
        r = got[d]
        assert (r["n_words"], r["n_hit"], r["spans"], set(r["items"]), len(r["items"])) == (n, len(hit), spans_of(hit), ids, len(ids)), d


def test_blocks_of_items_add_up(spark, monkeypatch):
    docs, items = random_case(3, 12)
    tests = spark.createDataFrame(items, "item_id long, text string")
    one = {r["record"]["doc_id"]: (r["spans"], sorted(r["items"]), r["n_words"]) for r in C.find_passages(make(spark, docs), tests, window=4).collect()}
    monkeypatch.setattr(C, "BLOCK_BYTES", 150)
    assert one == {r["record"]["doc_id"]: (r["spans"], sorted(r["items"]), r["n_words"]) for r in C.find_passages(make(spark, docs), tests, window=4).collect()}


@pytest.mark.parametrize("size", [8, 40, 100, 1 << 20])
def test_long_text_in_parts(monkeypatch, size):
    monkeypatch.setattr(C, "PART_BYTES", size)
    docs, items = random_case(5)
    text = " ".join(t for _, t in docs)
    wanted = C.phrases(pa.array([i for i, _ in items]), pa.array([t for _, t in items], pa.string()), 5)
    (whole,) = text_slices(pa.array([text], pa.large_string()))
    n, spans, found = C.search_texts(whole, wanted)
    want, hit, ids = brute(text, items, 5)
    assert (n.tolist(), spans, {items[i][0] for i in found[0]} - {None}) == ([want], [spans_of(hit)], ids)


def test_spans_are_cut_from_the_text(spark):
    passage = "one Two three four five six seven eight nine ten eleven"
    docs = [(1, f"Start, here. ({passage}), and the end!"), (2, "nothing of it"), (3, None), (4, passage), (5, "é " + passage + " 漢")]
    found = C.find_passages(make(spark, docs), spark.createDataFrame([(7, passage.upper())], "item_id long, text string"))
    got = {r["id"]: r["rest"] for r in found.select(F.col("record.doc_id").alias("id"), C.without_spans("record.text", "spans").alias("rest")).collect()}
    assert got == {1: "Start, here. (), and the end!", 2: "nothing of it", 3: None, 4: "", 5: "é  漢"}


def test_odd_rows_and_no_rows(spark, odd, odd_rows, nothing):
    tests = spark.createDataFrame([(1, odd_rows[0][1]), (2, "漢字"), (2, "a"), (3, ""), (4, None), (None, "no line break")], "item_id long, text string")
    rows = C.find_passages(odd, tests).collect()
    assert len(rows) == len(odd_rows) and rows[0]["record"].asDict().keys() == set(odd.columns)
    items = [(r["item_id"], r["text"]) for r in tests.collect()]
    for r in rows:
        text = r["record"]["text"]
        if text is None or len(text) < 10_000:
            n, hit, ids = brute(text, items, 10)
            assert (r["n_words"], r["spans"], set(r["items"])) == (n, spans_of(hit), ids)
    assert C.find_passages(nothing, tests).collect() == []
    assert {r["n_hit"] for r in C.find_passages(odd, tests.limit(0)).collect()} == {0}
