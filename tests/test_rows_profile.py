"""Distributed position / rank / running-sum / quantile operators against
brute force on small inputs spread over several partitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import profile
from sparkfolio.operators.rows import (
    keep_first, with_group_rank, with_row_index, with_running_sum)


def test_row_index_dense_and_ordered(spark):
    vals = random.Random(1).sample(range(10000), 500)
    df = spark.createDataFrame([(v,) for v in vals], "v int").repartition(7)
    out = sorted((r.row_idx, r.v) for r in with_row_index(df, ["v"]).collect())
    assert [i for i, _ in out] == list(range(500))
    assert [v for _, v in out] == sorted(vals)


def test_group_rank_matches_bruteforce(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aab"), rng.random()) for _ in range(300)]  # 'a' is a hot key
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {(r.g, r.x): (r.rk, r.n) for r in with_group_rank(df, ["g"], ["x"], "rk", "n").collect()}
    for g in "ab":
        xs = sorted(x for gg, x in rows if gg == g)
        for i, x in enumerate(xs):
            assert got[(g, x)] == (i, len(xs))


def test_running_sum(spark):
    rows = [(i, i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v long").repartition(6)
    got = {r.k: r.run for r in with_running_sum(df, ["k"], "v", "run").collect()}
    acc = 0
    for k, v in rows:
        assert got[k] == acc
        acc += v


def test_keep_first(spark):
    df = spark.createDataFrame([(1, "d1", 5, "x"), (1, "d1", 2, "y"), (2, "d1", 9, "z"), (1, "d2", 1, "w")],
                               "Id int, Date string, pos int, val string")
    out = sorted(tuple(r) for r in keep_first(df, ["Id", "Date"], "pos").collect())
    assert out == [(1, "d1", 2, "y"), (1, "d2", 1, "w"), (2, "d1", 9, "z")]


def test_describe_exact_quartiles(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1000, 301).astype(float)
    b = rng.normal(size=301)
    b[::7] = np.nan
    pdf_rows = [(float(x), None if np.isnan(y) else float(y)) for x, y in zip(a, b)]
    df = spark.createDataFrame(pdf_rows, "a double, b double").repartition(4)
    got = {r.column_name: r for r in profile.describe(df, ["a", "b"], digits=None).collect()}
    for name, arr in (("a", a), ("b", b[~np.isnan(b)])):
        r = got[name]
        assert r["count"] == len(arr)
        for p, c in ((25, "p25"), (50, "p50"), (75, "p75")):
            assert r[c] == pytest.approx(np.percentile(arr, p), rel=1e-12, abs=1e-12)
        assert r["std"] == pytest.approx(np.std(arr, ddof=1), rel=1e-9)
        assert r["min"] == arr.min() and r["max"] == arr.max()


def test_null_profile_and_crosstab(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (3, 4, None)], "a int, b int, c string")
    got = [tuple(r) for r in profile.null_profile(df, top=2).collect()]
    assert got == [("b", 2), ("a", 1)]
    xt = spark.createDataFrame([("H", "A"), ("H", "A"), ("L", "U")], "r string, s string")
    rows = {r.r: r for r in profile.crosstab(xt, "r", "s", ["A", "I", "U"]).collect()}
    assert (rows["H"].A, rows["H"].I, rows["H"].U) == (2, 0, 0)
    assert (rows["L"].A, rows["L"].U) == (0, 1)


def test_trend(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(10)], "x double, y double")
    r = profile.linear_trend(df, "y", "x").first()
    assert (r.slope, r.intercept, r.n) == (2.0, 1.0, 10)


def test_describe_sketch_path_close(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(0, 100000, 2000).astype(float)
    df = spark.createDataFrame([(float(x),) for x in a], "a double")
    r = profile.describe(df, ["a"], exact=False).first()
    assert abs(r.p50 - np.percentile(a, 50)) <= 100000 * 0.01
    assert r["count"] == 2000


def test_quantiles_with_hot_value(spark):
    rng = np.random.default_rng(7)
    a = np.concatenate([np.zeros(400), rng.integers(1, 50, 601)]).astype(float)
    rng.shuffle(a)
    df = spark.createDataFrame([(float(x),) for x in a], "a double").repartition(5)
    r = profile.describe(df, ["a"], percentiles=(0.1, 0.25, 0.5, 0.75, 0.9), digits=None).first()
    for p in (10, 25, 50, 75, 90):
        assert r[f"p{p}"] == pytest.approx(np.percentile(a, p), abs=1e-12)


def test_quantiles_of_many_columns_in_wide_passes(spark):
    """Log-normal values over many magnitudes, one value holding a third, few
    distinct values, negatives and zeros of both signs, NULLs and NaN, all
    NULL, one value alone, infinities - as numpy has them, with no melted table."""
    import numpy as np
    r = np.random.default_rng(5)
    n = 30_000
    cols = {
        "lognormal": np.exp(r.normal(0, 12, n)), "third": np.where(r.random(n) < 0.34, 7.25, r.normal(0, 1e6, n)),
        "few": r.integers(-2, 3, n).astype(float), "signs": np.where(r.random(n) < 0.5, -0.0, r.normal(0, 1e-300, n)),
        "gaps": np.where(r.random(n) < 0.3, np.nan, r.random(n)), "none": np.full(n, np.nan), "one": np.full(n, 3.5),
        "wide": np.where(r.random(n) < 0.2, -np.inf, r.normal(0, 1, n))}
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame(cols)).repartition(7)
    ps = (0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = profile.wide_quantiles(df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in cols]), ps)
    assert got.pop("none") == [None] * len(ps)
    for c, q in got.items():
        v = np.sort(cols[c][~np.isnan(cols[c])])
        at = [(len(v) - 1) * p for p in ps]
        want = [v[int(a)] if v[int(a)] == v[int(np.ceil(a))] else v[int(a)] + (v[int(np.ceil(a))] - v[int(a)]) * (a - int(a)) for a in at]
        assert q == want, c
    rows = {x["column_name"]: x for x in profile.describe(df, list(cols), digits=None).collect()}
    assert "none" not in rows and rows["few"]["count"] == n and rows["third"]["p50"] == got["third"][3] and rows["one"]["p25"] == 3.5
    plan = profile.describe(df, ["few", "one"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Scan") <= 1 and "Sort" not in plan


def test_codes_sort_as_doubles_do():
    import numpy as np
    v = np.array([-np.inf, -1e300, -2.5, -5e-324, 0.0, 5e-324, 1.0, 1.5, 1e300, np.inf])
    c = profile._codes(v)
    assert (np.diff(c.astype(object)) > 0).all() and [profile._value(int(x)) for x in c] == v.tolist()
    assert profile._codes(np.array([-0.0]))[0] == profile._codes(np.array([0.0]))[0]


def test_numeric_stats_impute_real_nulls(spark):
    import numpy as np
    from sparkfolio.operators import ml
    r = np.random.default_rng(6)
    x = [None if i % 5 == 0 else float(v) for i, v in enumerate(r.integers(0, 50, 4000))]
    df = spark.createDataFrame([(v, 2.0, None) for v in x], "x double, c double, empty double")
    for exact in (True, False):
        got = {s["feature"]: s for s in ml.numeric_stats(df, ["x", "c", "empty"], exact=exact).collect()}
        median = float(np.median([v for v in x if v is not None]))
        full = np.array([median if v is None else v for v in x])
        assert set(got) == {"x", "c"} and got["c"]["scale"] == 1.0
        assert got["x"]["median"] == median and abs(got["x"]["mean"] - full.mean()) < 1e-9 and abs(got["x"]["scale"] - full.std()) < 1e-9
