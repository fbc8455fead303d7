"""Series (W5, M18, M19, A19) and model benchmark (M1-M16, A20, ST1)."""

import datetime as dt
import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import ml
from sparkfolio.operators import series as S


def _series(spark, n=80, const=False):
    start = dt.date(2022, 11, 1)
    rows = [("X", start + dt.timedelta(days=i), 5.0 if const else float(100 + (i * 37) % 11)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, date date, high double")


def test_lag_windows_count_and_order(spark):
    df = _series(spark)
    w = S.lag_windows(df, "high", 30).orderBy("date").collect()
    assert len(w) == 50
    vals = [r.high for r in df.orderBy("date").collect()]
    assert w[0].x == vals[:30] and w[0].y == vals[30]


def test_minmax_constant_series_and_inverse(spark):
    df = _series(spark, 10, const=True)
    p = S.fit_minmax(df, "high")
    out = S.minmax_transform(df, p, "high").withColumn("back", S.minmax_inverse("scaled"))
    assert {(r.scaled, r.back) for r in out.collect()} == {(0.0, 5.0)}


def test_chrono_split_validation_tail(spark):
    df = _series(spark, 120)
    sp = S.chrono_split(df, "2022-12-31", "2023-01-01", time_step=30)
    c = {r.split: r["count"] for r in sp.groupBy("split").count().collect()}
    n_train = 61  # Nov + Dec
    samples = n_train - 30
    assert c["validation"] == samples - int(samples * 0.9)
    assert c["test"] == 120 - n_train


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "a double, p double")
    assert S.rmse(df, "a", "p").first().rmse == pytest.approx(np.sqrt(2.5))


def test_auc_exact_matches_pairwise(spark):
    rng = random.Random(5)
    rows = [(float(rng.randint(0, 20)), rng.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(4)
    got = ml.auc_exact(df, "s", "y").first().auc
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    assert got == pytest.approx(wins / (len(pos) * len(neg)), rel=1e-15)


def test_stratified_split_rates(spark):
    rows = [(i, 1 if i % 4 == 0 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, y int")
    c = {(r.y, r.split): r["count"] for r in ml.stratified_split(df, "y", "id").groupBy("y", "split").count().collect()}
    assert c[(1, "validation")] == 20 and c[(0, "validation")] == 60
    again = ml.stratified_split(df, "y", "id").where("split = 'validation'").select("id").collect()
    first = ml.stratified_split(df, "y", "id").where("split = 'validation'").select("id").collect()
    assert sorted(again) == sorted(first)


@pytest.fixture
def churn(spark, fix):
    from sparkfolio.functions.coerce import to_number, yes_no_flag
    raw = spark.read.option("header", True).csv(fix("churn_sample.csv"))
    num = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
    df = raw.select(*[to_number(c).alias(c) for c in num],
                    *[c for c in raw.columns if c not in num + ["Churn"]],
                    yes_no_flag("Churn").alias("label"))
    return df, num, [c for c in raw.columns if c not in num + ["Churn"]]


def test_preprocessor_matches_pandas(spark, fix, churn):
    df, num, cat = churn
    prep = ml.Preprocessor.fit(df, num, cat)
    pdf = pd.read_csv(fix("churn_sample.csv"))
    pdf["TotalCharges"] = pd.to_numeric(pdf["TotalCharges"], errors="coerce")
    for f, med, mean, sc in zip(num, prep.medians, prep.means, prep.scales):
        col = pdf[f].astype(float)
        filled = col.fillna(col.median())
        assert med == pytest.approx(col.median())
        assert mean == pytest.approx(filled.mean())
        assert sc == pytest.approx(filled.std(ddof=0) or 1.0)
    for f, mode, cats in zip(cat, prep.modes, prep.categories):
        vc = pdf[f].value_counts()
        assert mode == sorted(vc[vc == vc.max()].index)[0]
        assert cats == sorted(pdf[f].dropna().unique())
    assert len(prep.feature_names) == len(num) + sum(len(c) for c in prep.categories)


def test_score_from_params_edge_cases(spark):
    params = {"numeric_features": ["a"], "numeric_imputer_medians": [2.0], "numeric_means": [1.0],
              "numeric_scales": [0.5], "categorical_features": ["c"], "categories": [["x", "y"]],
              "coef": [1.0, 2.0, -1.0], "intercept": 0.0}
    df = spark.createDataFrame([(1, None, "x"), (2, "", "z"), (3, "bad", None), (4, "1", "y")],
                               "id int, a string, c string")
    got = {r.id: (r.probability, r.label) for r in ml.score_from_params(df, params).collect()}
    sig = lambda z: 1 / (1 + np.exp(-z))
    assert got[1][0] == pytest.approx(sig(2.0 + 2.0))   # missing -> median 2 -> (2-1)/.5 = 2
    assert got[2][0] == pytest.approx(sig(2.0))         # '' -> median; unknown category -> zeros
    assert got[3][0] == pytest.approx(sig(2.0))
    assert got[4] == (pytest.approx(sig(0.0 - 1.0)), 0)


def test_models_learn_separable_signal(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(240):
        y = int(i % 2)
        rows.append((i, float(rng.normal(2.0 * y, 1.0)), "p" if y else rng.choice(["p", "q"]), y))
    df = spark.createDataFrame(rows, "id int, x double, c string, label int")
    sp = ml.stratified_split(df, "label", "id")
    tr, va = sp.where("split = 'train'"), sp.where("split = 'validation'")
    prep = ml.Preprocessor.fit(tr, ["x"], ["c"])
    name, _, est = ml.model_zoo(len(prep.feature_names), tr.count())[0]
    model = est.fit(prep.transform(tr))
    auc = ml.auc_exact(ml.positive_probability(model.transform(prep.transform(va))), "score", "label").first().auc
    assert auc > 0.75
    board = ml.leaderboard([("b", "t", 0.7, 0.5), ("a", "t", 0.7, 0.5), ("c", "t", 0.9, 0.5)])
    assert [(r[0], r[4]) for r in board] == [("c", True), ("a", False), ("b", False)]


def test_stream_equals_batch(spark):
    from sparkfolio.streaming import scoring
    params = {"numeric_features": ["n_chars", "n_words", "n_lines"], "numeric_imputer_medians": [1.0, 1.0, 1.0],
              "numeric_means": [100.0, 10.0, 2.0], "numeric_scales": [50.0, 5.0, 1.0],
              "categorical_features": ["lang", "source"], "categories": [["de", "en"], ["s1"]],
              "coef": [0.1, -0.2, 0.3, 0.5, -0.5, 0.05], "intercept": -0.1}
    import os
    import tempfile
    from sparkfolio.session import ensure_checkpoint_dir
    d = tempfile.mkdtemp(prefix="req-", dir=ensure_checkpoint_dir(spark))
    reqs = [
        {"request_id": 1, "records": [{"n_chars": "120", "n_words": "9", "n_lines": "2", "lang": "en", "source": "s1"},
                                      {"n_chars": None, "n_words": "x", "n_lines": "", "lang": None, "source": "zz"}]},
        {"request_id": 2, "records": []},
        {"request_id": 3},
    ]
    import json
    with open(os.path.join(d, "part-0.json"), "w") as fh:
        for r in reqs:
            fh.write(json.dumps(r) + "\n")
    streamed = scoring.run_scoring_stream(spark, d, params)
    got = {(r.request_id, r.record_idx): (r.probability, r.label, r.error) for r in streamed.collect()}
    assert got[(2, None)][2].startswith("Invalid input") and got[(3, None)][2].startswith("Invalid input")
    batch_in = spark.read.schema(scoring.REQUEST_SCHEMA).json(d).where(F.size("records") > 0) \
        .select("request_id", F.posexplode("records").alias("record_idx", "r")).select("request_id", "record_idx", "r.*")
    batch = {(r.request_id, r.record_idx): (r.probability, r.label)
             for r in ml.score_from_params(batch_in, params).collect()}
    for k, v in batch.items():
        assert got[k][:2] == v
    assert len(batch) == 2


def test_stratified_split_hash_path(spark):
    df = spark.range(20000).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    c = ml.stratified_split(df, "y", "id", exact=False).groupBy("y", "split").count().collect()
    share = {r.y: 0 for r in c}
    tot = {r.y: 0 for r in c}
    for r in c:
        tot[r.y] += r["count"]
        if r.split == "validation":
            share[r.y] += r["count"]
    for y in tot:
        assert abs(share[y] / tot[y] - 0.2) < 0.02


def test_lag_windows_stay_inside_segment(spark):
    df = _series(spark, 70).withColumn(
        "side", F.when(F.col("date") >= F.lit("2022-12-20").cast("date"), "test").otherwise("train"))
    w = S.lag_windows(df, "high", 10, segment="side").collect()
    n_train = sum(1 for r in df.collect() if r.side == "train")
    assert len(w) == (n_train - 10) + (70 - n_train - 10)


def test_spark_ml_pipeline_preprocessor(spark, churn):
    df, num, cat = churn
    model = ml.spark_ml_preprocessor(num, cat, median_error=0.0).fit(df)
    out = model.transform(df)
    names = ml.vector_feature_names(out)
    n_cats = sum(df.select(c).distinct().count() for c in cat)
    assert out.first().features.size == len(num) + n_cats == len(names)
    unseen = df.limit(1).withColumn("gender", F.lit("unseen-value"))
    vec = model.transform(unseen).first().features.toArray()
    g_slots = [i for i, n in enumerate(names) if n.startswith("gender__oh")]
    assert all(vec[i] == 0.0 for i in g_slots)


def test_distinct_users_approx(spark):
    from sparkfolio.operators.segments import log_utilization
    log = spark.range(5000).select((F.col("id") % 1000).alias("Id"))
    exact = log_utilization(log).first()
    approx = log_utilization(log, approx=True).first()
    assert exact.unique_weight_users == 1000
    assert abs(approx.unique_weight_users - 1000) <= 50


def test_load_churn_csv(spark, fix):
    df = ml.load_churn_csv(spark, fix("churn_sample.csv"))
    assert dict(df.dtypes)["TotalCharges"] == "double" and dict(df.dtypes)["Churn"] == "int"
    assert df.where("Churn = 1").count() == 15 and "customerID" not in df.columns


def test_forecast_report_learns_linear_series(spark):
    start = dt.date(2021, 1, 1)
    rows = [("L", start + dt.timedelta(days=i), 100.0 + i) for i in range(800)]
    df = spark.createDataFrame(rows, "symbol string, date date, high double")
    table, r = S.forecast_report(df, "2022-06-30", "2022-07-01")
    assert table.count() == 800 - 546 - 30
    assert r.first().rmse < 1e-6


def test_run_benchmark_on_churn_sample(spark, churn):
    df, num, cat = churn
    df = df.withColumnRenamed("label", "label").withColumn("rid", F.monotonically_increasing_id())
    sp = ml.stratified_split(df, "label", "rid")
    prep, board, models, scores = ml.run_benchmark(sp.where("split = 'train'"), sp.where("split = 'validation'"),
                                           num, cat)
    assert [r[0] for r in board] and len(board) == 5 and set(models) == {r[0] for r in board}
    aucs = [r[2] for r in board]
    assert aucs == sorted(aucs, reverse=True) and all(0.0 <= a <= 1.0 for a in aucs)
    assert scores.groupBy("name").count().count() == 5 and [r[4] for r in board] == [True] + [False] * 4


def test_lag_windows_cross_blocks(spark, monkeypatch):
    """Small blocks give what one window over the symbol gives."""
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=3 * i), float(i)) for s, n in (("a", 50), ("b", 7), ("c", 200)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, date date, v double").withColumn("seg", F.when(F.col("v") < 30, "p").otherwise("q"))
    want = sorted((r.symbol, r.y, r.x) for r in S.lag_windows(df, "v", 5, segment="seg").collect())
    monkeypatch.setattr(S, "BLOCK", 8)
    got = sorted((r.symbol, r.y, r.x) for r in S.lag_windows(df, "v", 5, segment="seg").collect())
    brute = sorted((s, float(i), [float(j) for j in range(i - 5, i)]) for s, n in (("a", 50), ("b", 7), ("c", 200))
                   for i in range(5, n) if (i < 30) == (i - 5 < 30))
    assert got == want == brute


def test_fitted_scoring_equals_sql(spark):
    """The trained artifact scored by the library and by the same SQL."""
    from sparkfolio.plans import churn
    sf = "/root/testdata/sf0.001"
    params = churn.export_params(spark, sf)
    churn.doc_features(spark, sf).createOrReplaceTempView("fitted_features")
    want = {r.doc_id: (r.probability, r.label) for r in spark.sql(churn.score_sql(params, "fitted_features")).collect()}
    got = churn.score_fitted(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        p, label = want[r.doc_id]
        assert r.probability == pytest.approx(p, abs=2e-9) and r.label == label


def test_score_rejects_java_suffix_numbers(spark):
    params = {"numeric_features": ["a"], "numeric_imputer_medians": [2.0], "numeric_means": [0.0],
              "numeric_scales": [1.0], "categorical_features": [], "categories": [],
              "coef": [1.0], "intercept": 0.0}
    df = spark.createDataFrame([("5d",), (" 5 ",)], "a string")
    got = [r.probability for r in ml.score_from_params(df, params).collect()]
    assert got[0] == pytest.approx(1 / (1 + np.exp(-2.0)))   # '5d' is not a number -> median
    assert got[1] == pytest.approx(1 / (1 + np.exp(-5.0)))


def test_artifact_stats_from_all_rows(spark):
    from sparkfolio.plans import churn
    a = churn.train_params(spark, "/root/testdata/sf0.001")
    b = churn.train_params(spark, "/root/testdata/sf0.001", stats_from="all")
    assert a["coef"] == pytest.approx(b["coef"]) and a["numeric_means"] != b["numeric_means"]


def test_a_model_a_series(spark):
    """Each series' coefficients are those of its own least squares, whatever
    batches it is spread over; a series of a null name too; one with too few
    windows is still solved, one without any has no forecast."""
    r = np.random.default_rng(4)
    rows = [(name, r.normal(size=4).tolist(), float(r.normal())) for name, n in (("a", 300), ("b", 40), (None, 60), ("few", 2)) for _ in range(n)]
    df = spark.createDataFrame(rows, "symbol string, x array<double>, y double").repartition(5)
    models = {m["symbol"]: m["model"] for m in S.fit_by_series(df, time_step=4).collect()}
    for name in ("a", "b", None, "few"):
        x = np.array([[1.0, *v] for s, v, _ in rows if s == name])
        y = np.array([v for s, _, v in rows if s == name])
        want = np.linalg.solve(x.T @ x + 1e-6 * np.diag([0, 1, 1, 1, 1]), x.T @ y)
        assert np.allclose(models[name], want, rtol=1e-6, atol=1e-8 if name != "few" else 1e-3)
    other = spark.createDataFrame([("new", [1.0] * 4, 1.0), ("a", [1.0, 2.0, 3.0, 4.0], 1.0), (None, [0.0] * 4, 0.0)], "symbol string, x array<double>, y double")
    got = {p["symbol"]: p["pred"] for p in S.predict_by_series(S.fit_by_series(df, time_step=4), other).collect()}
    assert got["new"] is None and got[None] == pytest.approx(models[None][0])
    assert got["a"] == pytest.approx(models["a"][0] + np.dot(models["a"][1:], [1, 2, 3, 4]))


def test_pooled_report_still_fits(spark):
    import datetime as dt
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(365)]
    df = spark.createDataFrame([("s", d, float(100 + 3 * i)) for i, d in enumerate(days)], "symbol string, date date, high double")
    _, e = S.forecast_report(df, "2022-06-30", "2022-07-01", kind="linear")
    assert e.first().rmse < 1e-6
