"""Edge cases listed for every suite: zero denominators, short series, empty
tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkfolio.functions.arith import eps_ratio
from sparkfolio.operators import kpi, ml, profile, segments
from sparkfolio.operators import series as S
from sparkfolio.operators.frame import Frame


def test_eps_ratio_zero_and_minus_eps(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -1e-9), (None, 2.0), (2.0, None)], "a double, b double")
    got = [r.r for r in df.select(eps_ratio("a", "b").alias("r")).collect()]
    assert got[0] == pytest.approx(1e9) and got[1] is None and got[2] is None and got[3] is None


def test_short_series_has_no_windows(spark):
    rows = [("X", dt.date(2023, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(29)]
    df = spark.createDataFrame(rows, "symbol string, date date, high double")
    assert S.lag_windows(df, "high", 30).count() == 0
    sp = S.chrono_split(df, "2023-12-31", "2024-01-01")
    assert {r.split for r in sp.collect()} == {"train"}


def test_empty_tables(spark):
    daily = spark.createDataFrame([], "Id int, Date date, TotalSteps int, Calories int, "
                                      "VeryActiveMinutes int, FairlyActiveMinutes int, "
                                      "LightlyActiveMinutes int, SedentaryMinutes int")
    sleep = spark.createDataFrame([], "Id int, Date date, TotalMinutesAsleep int, TotalTimeInBed int")
    m = segments.with_derived_metrics(segments.merge_daily_sleep(daily, sleep))
    assert segments.activity_levels(m).count() == 0
    t = segments.time_allocation(m).first()
    assert t.avg_very_active is None
    assert profile.describe(m, ["TotalSteps"]).count() == 0
    scores = spark.createDataFrame([], "s double, y int")
    r = ml.auc_exact(scores, "s", "y").first()
    assert r.auc is None
    means = kpi.peer_mean_by_year(spark.createDataFrame([], "year int, " + ", ".join(
        f"{m} double" for m in kpi.PEER_KPIS)))
    assert means.count() == 0
    f = Frame(spark.createDataFrame([], "a string"))
    assert len(f.filter("a", ">", "1")) == 0
    assert f.slice(-3, None).df.count() == 0


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.9, 1)], "s double, y int")
    assert ml.auc_exact(df, "s", "y").first().auc is None
