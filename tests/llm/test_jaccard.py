import random
import re

import numpy as np
import pytest
from llm_frames import make, prose

from sparkfolio.llm import jaccard_join as J

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows):
    """(n_shingles, component) of every row, in order."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(sets[i]), d if not sets[i] else low.get(find(i))) for i, (d, _) in enumerate(rows)]


def brute_links(rows):
    """(id, links) of every row, in order."""
    sets = [shingles(t) for _, t in rows]
    linked = lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    return [(d, sum(linked(a, b) for j, b in enumerate(sets) if j != i)) for i, ((d, _), a) in enumerate(zip(rows, sets))]


def links(df):
    return [(r["record"]["doc_id"], r["n_links"]) for r in J.link_components(df, count_links=True).collect()]


def run(df):
    return [(r["record"]["doc_id"], r["n_shingles"], r["component_id"]) for r in J.link_components(df).collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def edited(text, seed, share):
    r, w = random.Random(seed), text.split(" ")
    for i in range(len(w)):
        if r.random() < share:
            w[i] = f"e{r.randrange(10 ** 6)}"
    return " ".join(w)


def test_components_equal_brute_force(spark):
    rows = []
    for family in range(12):                        # copies at all distances from a base, some of them chained
        base = prose(family, 60 + 20 * family)
        rows += [(100 * family + k, edited(base, 1000 * family + k, 0.006 * (k % 9))) for k in range(20)]
    passage = prose(99, 200)
    rows += [(5000 + k, prose(200 + k, 100) + "\n" + passage) for k in range(30)]
    rows += [(6000, "Ab cd"), (6001, "aB  CD"), (6002, "ab"), (6003, "ab cd ef gh ij"), (6004, "AB CD\tEF GH IJ")]
    random.Random(0).shuffle(rows)
    assert order(run(make(spark, rows))) == order(brute(rows))
    assert order(links(make(spark, rows))) == order(brute_links(rows))


def test_exact_threshold(spark):
    w = [f"w{i}" for i in range(13)]                # 9 shingles; with one word more 10: 9 / 10
    rows = [(1, " ".join(w)), (2, " ".join(w + ["x"])), (3, " ".join(w[:8])), (4, " ".join(w[:9]))]     # 4 and 5 shingles: exactly 4 / 5
    assert order(run(make(spark, rows))) == order(brute(rows)) and dict((d, c) for d, _, c in run(make(spark, rows))) == {1: 1, 2: 1, 3: 3, 4: 3}


def test_blocks_and_fragments(spark, monkeypatch):
    """Many small blocks and fragments give what one does."""
    for name, value in (("ROW_BLOCK", 3), ("COLUMN_BLOCK", 5), ("FRAGMENT_GRAMS", 200), ("SLICE", 2_000)):
        monkeypatch.setattr(J, name, value)
    base = prose(1, 80)
    rows = [(k, edited(base, k, 0.03)) for k in range(60)] + [(100 + k, prose(300 + k, 40)) for k in range(20)]
    assert order(run(make(spark, rows))) == order(brute(rows))


def test_odd_rows(odd, odd_rows, nothing):
    assert order(run(odd)) == order(brute([r[:2] for r in odd_rows]))
    assert order(links(odd)) == order(brute_links([r[:2] for r in odd_rows]))
    assert J.link_components(nothing).collect() == [] and J.link_components(nothing, count_links=True).collect() == []


@pytest.mark.parametrize("limits", [{}, {"ROW_BLOCK": 3, "COLUMN_BLOCK": 5}, {"BLOCK_GRAMS": 300}])
def test_link_counts(spark, monkeypatch, limits):
    """Prefixes of one text: chains of sizes over many bands, with the largest ratio exactly
    at the threshold, each with exact copies; and near copies that no chain joins."""
    for name, value in limits.items():
        monkeypatch.setattr(J, name, value)
    w = prose(5, 400).split(" ")
    rows = [(10 * k + c, " ".join(w[:k])) for k in (0, 1, 4, 5, 6, 8, 9, 12, 13, 14, 16, 20, 24, 29, 36, 44, 54, 104, 129, 204, 254, 400) for c in range(1 + k % 3)]
    base = prose(77, 90)
    rows += [(10_000 + k, edited(base, k, 0.015)) for k in range(40)]
    assert order(links(make(spark, rows))) == order(brute_links(rows))


def test_documents(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert order(run(documents)) == order(brute(rows))


@pytest.mark.parametrize("seed", range(3))
def test_class_keys_tell_sets_apart(seed):
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 50, rng.integers(0, 6)).astype(np.uint64)) for _ in range(500)]
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    keys = J.class_keys(np.concatenate(sets), ends)
    assert len(set(keys)) == len({tuple(s) for s in sets})


@pytest.mark.parametrize("parts", [[[0] * 6, [0] * 5], [[0, 1], [0, 1, None]], [[0, 1, 2], [2, 0, 1], [0, 0, 1, 2]]])
def test_tasks_with_the_same_classes(spark, parts):
    """Slices of different tasks that hold the same sets, in another number or order."""
    rows = [[(100 * p + i, None if k is None else prose(k, 60)) for i, k in enumerate(x)] for p, x in enumerate(parts)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)).flatMap(lambda x: x), "doc_id long, text string")
    assert df.rdd.getNumPartitions() == len(parts)
    assert order(run(df)) == order(brute([r for x in rows for r in x]))
