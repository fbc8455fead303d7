"""Parameter scoring (M15/C18) agrees with an independent SQL evaluation of
the same exported artifact; the mini-engine flow on the committed fixtures."""

import math

import duckdb
import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"


def _sql_score(p):
    terms = [str(p["intercept"])]
    i = 0
    for f, med, mean, sc in zip(p["numeric_features"], p["numeric_imputer_medians"],
                                p["numeric_means"], p["numeric_scales"]):
        x = f"COALESCE(TRY_CAST({f} AS DOUBLE), {med})"
        z = "0.0" if sc == 0 else f"(({x}) - {mean}) / {sc}"
        terms.append(f"{p['coef'][i]} * {z}")
        i += 1
    for f, cats in zip(p["categorical_features"], p["categories"]):
        for c in cats:
            terms.append(f"{p['coef'][i]} * (CASE WHEN COALESCE({f}, '') = '{c}' THEN 1.0 ELSE 0.0 END)")
            i += 1
    assert i == len(p["coef"])
    return "1.0 / (1.0 + exp(-(" + " + ".join(terms) + ")))"


def test_fitted_scores_match_sql(spark):
    from sparkfolio.plans import churn
    p = churn.export_params(spark, SF)
    got = {r.doc_id: r.probability for r in churn.score_fitted(spark, SF).collect()}    # rounded to 9 places
    con = duckdb.connect()
    q = f"""SELECT doc_id, {_sql_score(p)} AS p FROM (
              SELECT doc_id, n_chars, CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) AS n_words,
                     CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines, lang, source
              FROM read_parquet('{SF}/documents.parquet')) t"""
    exp = dict(con.execute(q).fetchall())
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert math.isclose(got[k], v, rel_tol=1e-12, abs_tol=1e-9)


def test_artifact_is_reused(spark):
    from sparkfolio.plans import churn
    a = churn.export_params(spark, SF)
    b = churn.export_params(spark, SF)
    assert a == b


def test_monthly_targets_group_sum(spark, fix):
    from sparkfolio.operators.frame import Frame
    f = Frame.read_csv(spark, fix("monthly_targets.csv"))
    got = {r.Category: r.Target_sum for r in f.groupby("Category").agg({"Target": "sum"}).df.collect()}
    exp = pd.read_csv(fix("monthly_targets.csv")).groupby("Category")["Target"].sum()
    for k, v in exp.items():
        assert got[k] == pytest.approx(v)
    high = f[f["Target"] > 14000]
    assert len(high) == int((pd.read_csv(fix("monthly_targets.csv"))["Target"] > 14000).sum())
