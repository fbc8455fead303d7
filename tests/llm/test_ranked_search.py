import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import make

from sparkfolio.llm import ranked_search as R
from sparkfolio.llm.toprank import top_rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(LOW) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=10):
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(words(t))
    tf = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in tf), sum(n for _, _, n in tf)
    df = Counter(t for _, c, _ in tf for t in c)
    out = []
    for i, query in terms.items():
        scored = []
        for d, c, n in tf:
            if n:
                m = 10 + 90 * n * n_docs // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in query if c[t])
                if s > 0:
                    scored.append((-s, d is None, d or 0))
        out += [(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def got(docs, items, **args):
    return sorted((tuple(r) for r in R.search(docs, items, **args).collect()), key=repr)


def case(seed, n=150):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "漢字", "The"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda k: "".join(w + r.choice([" ", ", ", "\n"]) for w in r.choices(vocabulary, weights, k=k))
    docs = [(d, text(r.choice([0, 1, 3, 10, 60]))) for d in range(n)]
    docs += [(d, docs[5][1]) for d in range(n, n + 20)] + [(3, docs[3][1]), (None, "漢字 w39"), (n + 50, None)]       # ties, a repeated row, nulls
    items = [(i, text(r.choice([1, 3, 20]))) for i in range(15)] + [(2, "w39"), (None, "the w1"), (77, None), (78, "..."), (79, "unknown")]
    return docs, items


@pytest.mark.parametrize("seed,k", [(1, 10), (2, 3)])
def test_equals_brute_force(spark, seed, k):
    docs, items = case(seed)
    assert got(make(spark, docs), spark.createDataFrame(items, "item_id long, text string"), k=k) == brute(docs, items, k)


def test_blocks_and_shards(spark, monkeypatch):
    """Items in many blocks give the same."""
    docs, items = case(4, 60)
    monkeypatch.setattr(R, "BLOCK_BYTES", 60)
    assert got(make(spark, docs), spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_shards_of_a_task_hand_on_their_kth_score(monkeypatch):
    """Many small shards in one task: the floor leaves nothing of the k best out."""
    monkeypatch.setattr(R, "SHARD_POSTINGS", 30)
    r = random.Random(5)
    rows = [(d, r.randrange(1, 50), sorted(r.sample(range(8), r.randrange(1, 8)))) for d in range(200)]
    tf = {d: [r.randrange(1, 9) for _ in t] for d, _, t in rows}
    weight, queries = np.array([5, 3, 900, 0, 70, 11, 2, 400]), [np.array([0, 1, 2, 3]), np.array([4, 5, 6, 7]), np.arange(8)]
    n_docs, n_terms = 200, sum(n for _, n, _ in rows)

    class Shared:
        value = (n_docs, n_terms, weight, queries)
    batches = [pa.RecordBatch.from_arrays([pa.array([d for d, _, _ in b]), pa.array([n for _, n, _ in b]), pa.array([t for _, _, t in b], pa.list_(pa.int32())), pa.array([tf[d] for d, _, _ in b], pa.list_(pa.int64()))],
                                          ["id", "length", "terms", "tf"]) for b in (rows[i:i + 5] for i in range(0, 200, 5))]
    found = {}
    for b in R._rank(Shared, 10, pa.int64())(iter(batches)):
        for i, d, s in zip(*(b[c].to_pylist() for c in ("item", "id", "score"))):
            found.setdefault(i, []).append((-s, d))
    for i, q in enumerate(queries):
        want = []
        for d, n, t in rows:
            s = sum(int(weight[x]) * (10**9 * f // (1000 * f + 8 * (10 + 90 * n * n_docs // n_terms))) for x, f in zip(t, tf[d]) if x in q)
            if s:
                want.append((-s, d))
        assert sorted(found[i])[:10] == sorted(want)[:10]


@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 3), st.integers(1, 6)), min_size=1, max_size=300, unique_by=lambda x: x[:2]), st.integers(1, 12))
@settings(max_examples=150, deadline=None)
def test_best_positions_stop_only_when_nothing_is_left(postings, k):
    """All documents of the k best scores, ties with the k-th included."""
    doc, term, impact = (np.array(x) for x in zip(*postings))
    weight = np.array([1, 2, 0, 5])
    shard = R.Shard(doc, term, impact, 401, 4)
    total = np.bincount(doc, weight[term] * impact, 401).astype(int)
    d, s = shard.best(np.arange(4), weight, k)
    kth = max(1, sorted(total, reverse=True)[k - 1])
    assert sorted(d.tolist()) == [i for i in range(401) if total[i] >= kth] and (s == total[d]).all()
    assert not shard.scored.any()


def test_search_stops_early():
    """With one long list whose first impacts stand out, few documents are looked up."""
    n = 100_000
    impact = np.concatenate([np.arange(10_000, 9_900, -1), np.ones(n - 100, np.int64)])
    shard = R.Shard(np.tile(np.arange(n), 2), np.repeat([0, 1], n), np.tile(impact, 2), n, 2)
    looked = []
    scored = shard.scored

    class Watch(np.ndarray):
        def __setitem__(self, key, value):
            if value is True:
                looked.append(len(key))
            super().__setitem__(key, value)
    shard.scored = scored.view(Watch)
    d, _ = shard.best(np.array([0, 1]), np.array([1, 1]), 10)
    assert sorted(d.tolist()) == list(range(10)) and sum(looked) < 100


def test_odd_rows_and_no_rows(spark, odd, odd_rows, nothing):
    tests = spark.createDataFrame([(1, odd_rows[0][1]), (2, "漢字 a"), (3, ""), (4, None)], "item_id long, text string")
    assert got(odd, tests) == brute([(r[0], r[1]) for r in odd_rows], [(r["item_id"], r["text"]) for r in tests.collect()])
    assert R.search(nothing, tests).collect() == [] and R.search(odd, tests.limit(0)).collect() == []
    assert R.search(odd.where("text is null"), tests).collect() == []


def test_first_rows_of_groups(spark):
    rows = spark.createDataFrame([(i % 3, i % 50, i) for i in range(2000)], "g int, x int, i int")
    best = top_rows(rows, ["g"], [rows["x"].desc(), rows["i"]], 60).collect()
    for g in range(3):
        want = sorted(((-(i % 50), i) for i in range(2000) if i % 3 == g))[:60]
        assert [(-r["x"], r["i"]) for r in sorted((r for r in best if r["g"] == g), key=lambda r: r["rank"])] == want
