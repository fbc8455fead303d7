import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfolio.llm import hamming_search as H


def brute(rows, k, every):
    codes = {}
    for i, v in rows:
        if i is not None and v:
            bits = np.nan_to_num(np.array([0 if x is None else x for x in v], float)) > 0
            codes.setdefault(i, []).append(np.pad(bits, (0, 200 - len(v))))
    codes = {i: min(c, key=lambda b: np.packbits(b).tobytes()) for i, c in codes.items()}
    out = set()
    for q in codes:
        if q % every == 0:
            near = sorted((int((codes[q] != c).sum()), i) for i, c in codes.items() if i != q)[:k]
            out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(near)}
    return out


def run(spark, rows, k=5, every=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", F.lit(0).alias("code"), F.lit(1).alias("ids"))
    return {tuple(r) for r in H.top_k(df, k, every).select("query_id", "rank", "neighbor_id", "distance").collect()}


@pytest.mark.parametrize("dims,spread", [(64, 8), (24, 30), (100, 4)])
def test_equal_brute_force(spark, dims, spread, monkeypatch):
    monkeypatch.setattr(H, "QUERY_BLOCK", 60)
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(spread, dims))
    rows = [(i, (centres[rng.integers(spread)] + rng.normal(size=dims)).tolist()) for i in range(300)]
    assert run(spark, rows) == brute(rows, 5, 10)


def test_ties_and_equal_codes(spark):
    r = random.Random(0)
    rows = [(i, [float(r.choice([-1, 1])) if i % 3 else 1.0 for _ in range(8)]) for i in range(120)]      # a third alike
    assert run(spark, rows) == brute(rows, 5, 10)


def test_odd_rows(spark):
    rows = [(0, [1.0, -1.0]), (10, None), (20, []), (None, [1.0]), (30, [1.0]), (30, [-1.0]), (1, [None, float("nan")]), (2, [1.0, -1.0]), (2, [1.0, -1.0])]
    assert run(spark, rows) == brute(rows, 5, 10)
    assert run(spark, [(0, [1.0])]) == set() == run(spark, [(1, [1.0]), (2, [1.0])])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert H.top_k(empty).collect() == []


def test_radius_stops_early():
    """The index looks at few codes when near ones exist, and still finds them."""
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64)).astype(np.uint8)
    bits[1:12] = bits[0]
    bits[1:12, :1] ^= 1
    words = np.packbits(bits, axis=1).view(np.uint64)
    index = H.MultiIndex(words, 64)
    at, dist = index.nearest(words[0], bits[0].astype(np.int64), 5)
    assert set(at) == set(range(12)) and dist.max() == 1
