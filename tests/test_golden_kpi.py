"""Golden input/output pairs of the KPI pipeline."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfolio.functions.synonyms import METRICS
from sparkfolio.operators import kpi
from sparkfolio.sources.readers import read_csv_typed

RATIOS = ["OpMargin", "SGA_ratio", "Ad_ratio", "CurrentRatio", "DebtToEquity", "CFO_margin"]


def close(a, b, rel=1e-9):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    if b is None or (isinstance(b, float) and math.isnan(b)):
        return False
    return math.isclose(a, b, rel_tol=rel, abs_tol=1e-12)


@pytest.fixture
def metrics(spark, fix):
    schema = "company string, ticker string, year int, " + ", ".join(
        f"{c} double" for c in METRICS + RATIOS)
    return read_csv_typed(spark, fix("entity_metrics.csv"), schema)


def test_g1_g2_kpi_pivot_and_ratios(spark, fix):
    long = read_csv_typed(spark, fix("statement_lines.csv"),
                          "year int, statement string, account_en string, amount double")
    wide = kpi.add_ratios(kpi.compute_kpis(long))
    got = {r.year: r.asDict() for r in wide.collect()}
    exp = pd.read_csv(fix("entity_metrics.csv"))
    for _, row in exp.iterrows():
        g = got[int(row.year)]
        for c in METRICS + RATIOS:
            assert close(g[c], float(row[c])), (row.year, c, g[c], row[c])


def test_g3_first_last_change(metrics, fix):
    cols = ["Revenue", "OperatingIncome", "SGA", "Advertising", "Inventory", "CFO",
            "OpMargin", "SGA_ratio", "Ad_ratio", "CurrentRatio", "DebtToEquity", "CFO_margin"]
    wide = kpi.first_last_wide(kpi.first_last_change(metrics, cols))
    got = {r.Metric: r for r in wide.collect()}
    assert set(wide.columns) == {"Metric", "2023", "2024", "Change_pct"}
    exp = pd.read_csv(fix("entity_change_summary.csv"))
    assert len(exp) == len(got) == 12
    for _, row in exp.iterrows():
        g = got[row.Metric]
        assert close(g["2023"], row["2023"]) and close(g["2024"], row["2024"])
        assert close(g["Change_pct"], row["Change_pct"], 1e-9)


def test_w1_pct_change_first_null(metrics):
    out = kpi.pct_change(metrics, ["Revenue"]).orderBy("year").collect()
    assert out[0].Revenue_YoY is None
    assert close(out[1].Revenue_YoY, 1869.22665152 / 1737.82144588 - 1)


def _peers(spark, fix):
    schema = ("peer_corp_name string, peer_stock_code string, year int, " +
              ", ".join(f"{m} double" for m in kpi.PEER_KPIS))
    return read_csv_typed(spark, fix("peer_metrics.csv"), schema)


def test_g4_peer_means_with_carry(spark, fix):
    got = {r.year: r.asDict() for r in kpi.peer_mean_by_year(_peers(spark, fix)).collect()}
    exp = pd.read_csv(fix("peer_means_by_year.csv"))
    assert sorted(got) == sorted(int(y) for y in exp.year)
    for _, row in exp.iterrows():
        for m in kpi.PEER_KPIS:
            e = row[f"{m}_mean"]
            assert close(got[int(row.year)][f"{m}_mean"], None if pd.isna(e) else float(e)), (row.year, m)


def test_g5_vs_peer(spark, fix, metrics):
    peer_avg = kpi.peer_mean_by_year(_peers(spark, fix))
    got = {r.year: r.asDict() for r in kpi.vs_peer(metrics, peer_avg).collect()}
    exp = pd.read_csv(fix("entity_vs_peer.csv"))
    for _, row in exp.iterrows():
        for m in kpi.PEER_KPIS:
            assert close(got[int(row.year)][f"{m}_vs_peer_mean"], float(row[f"{m}_vs_peer_mean"]), 1e-9)


def test_carry_forward_skips_when_next_year_exists(spark):
    df = spark.createDataFrame([(2020, 1.0), (2021, 2.0)], "year int, v double")
    out = sorted(tuple(r) for r in kpi.carry_last_forward(df).collect())
    assert out == [(2020, 1.0), (2021, 2.0), (2022, 2.0)]


def test_melt_statement_accounting_text(spark):
    df = spark.createDataFrame(
        [("Revenue", "1,234", "(567)"), ("Cost", "", "12"), (None, "5", "6"), ("Junk", "abc", " 7 ")],
        "account_en string, current_amount string, prior_amount string")
    out = sorted(tuple(r) for r in kpi.melt_statement(df, 2024, 2023, "IS").collect())
    assert out == [(2023, "IS", "Cost", 12.0), (2023, "IS", "Junk", 7.0),
                   (2023, "IS", "Revenue", -567.0), (2024, "IS", "Revenue", 1234.0)]


def test_peer_substring_mapping_and_pivot(spark):
    raw = spark.createDataFrame([
        ("A", "000001", 2023, 11011, "매출액", "1,000,000,000"),
        ("A", "000001", 2023, 11011, "매출원가", "(100,000,000)"),
        ("A", "000001", 2023, 11011, "영업이익", "200,000,000"),
        ("A", "000001", 2023, 11011, "광고선전비", None),
        ("A", "000001", 2023, 11014, "매출액", "999"),
        ("A", "000001", 2023, 11011, "기타", "5"),
    ], "peer_corp_name string, peer_stock_code string, bsns_year int, reprt_code int, "
       "account_nm string, thstrm_amount string")
    r = kpi.process_peers_raw(raw).collect()[0]
    # 매출원가 contains 매출 -> counted as Sales (first synonym wins)
    assert close(r.sales, 9.0)
    assert close(r.op_margin, 2.0 / (9.0 + 1e-9))
    # present-but-null advertising cell sums to 0; absent SGA stays NULL
    assert r.ad_ratio == 0.0 and r.sga_ratio is None
    exact = kpi.process_peers_raw(raw, mode="exact").collect()[0]
    assert close(exact.sales, 10.0)


def test_entity_pipeline_from_statement_files(spark, tmp_path):
    (tmp_path / "IS.csv").write_text('account_en,current_amount,prior_amount\n'
                                     'Revenue,"200,000,000","100,000,000"\n'
                                     'Operating income,"(20,000,000)","10,000,000"\n')
    (tmp_path / "BS.csv").write_text('account_en,current_amount,prior_amount\n'
                                     'Current assets,"300,000,000",\n'
                                     'Current liabilities,"100,000,000","50,000,000"\n')
    long, kpis = kpi.entity_kpis_from_files(
        spark, {"IS": str(tmp_path / "IS.csv"), "BS": str(tmp_path / "BS.csv")}, 2024, 2023, "Co", "CO")
    assert long.count() == 7  # the blank prior amount is dropped
    rows = {r.year: r for r in kpis.collect()}
    assert rows[2024].Revenue == 2.0 and rows[2024].OperatingIncome == -0.2
    assert close(rows[2024].OpMargin, -0.2 / (2.0 + 1e-9))
    assert rows[2023].CurrentAssets == 0.0 and close(rows[2024].CurrentRatio, 3.0 / (1.0 + 1e-9))
    assert rows[2024].company == "Co"


def test_peer_pipeline_from_dirs(spark, tmp_path):
    assert kpi.peer_kpis_from_dirs(spark, [str(tmp_path)]) is None
    (tmp_path / "000001_IS_raw.csv").write_text(
        "peer_corp_name,peer_stock_code,bsns_year,reprt_code,account_nm,thstrm_amount\n"
        'A,000001,2023,11011,매출액,"500,000,000"\nA,000001,2023,11011,영업이익,"50,000,000"\n')
    p = kpi.peer_kpis_from_dirs(spark, [str(tmp_path)]).first()
    assert p.sales == 5.0 and close(p.op_margin, 0.5 / (5.0 + 1e-9))


def test_pct_change_pads_like_pandas(spark):
    import pandas as pd
    vals = [1.0, None, 3.0, 0.0, 5.0]
    df = spark.createDataFrame([(2020 + i, v) for i, v in enumerate(vals)], "year int, x double")
    got = [r.x_YoY for r in kpi.pct_change(df, ["x"]).orderBy("year").collect()]
    exp = pd.Series(vals, dtype=float).ffill().pct_change(fill_method=None).tolist()
    for g, e in zip(got, exp):
        if e != e or e in (float("inf"), float("-inf")):
            assert g is None
        else:
            assert close(g, e)
