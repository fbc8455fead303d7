"""Notebook-style profiling (A14-A17, P17) agrees with pandas on the same
merged daily table (sf0.001)."""

import numpy as np
import pandas as pd
import pytest

from sparkfolio.operators import profile, segments
from sparkfolio.plans import activity as A

SF = "/root/testdata/sf0.001"
COLS = ["TotalSteps", "Calories", "TotalMinutesAsleep", "SleepEfficiency"]


@pytest.fixture(scope="module")
def merged(spark):
    m = A.merged_daily(spark, SF)
    return m, m.toPandas()


def test_describe_matches_pandas(merged):
    m, pdf = merged
    got = {r.column_name: r for r in profile.describe(m, COLS, digits=None).collect()}
    exp = pdf[COLS].astype(float).describe(percentiles=[.25, .5, .75])
    for c in COLS:
        r = got[c]
        assert r["count"] == exp.loc["count", c]
        for k, name in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                        ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert r[k] == pytest.approx(exp.loc[name, c], rel=1e-12), (c, k)


def test_null_counts_and_buckets_match_pandas(merged, spark):
    m, pdf = merged
    nulls = pdf.isna().sum()
    got = {r.column_name: r.null_count for r in profile.null_profile(m, top=50).collect()}
    assert got == {k: int(v) for k, v in nulls.items()}

    def bucket_sleep(x):
        if pd.isna(x):
            return "Unknown"
        return "Adequate Sleep" if x >= A.SLEEP_ADEQUATE else "Inadequate Sleep"

    def bucket_activity(s):
        if pd.isna(s):
            return "Unknown"
        if s >= 12500:
            return "High Active"
        if 5000 <= s <= 12499:
            return "Moderate Active"
        return "Low Active"

    seg = pdf.assign(activity_level=pdf.TotalSteps.apply(bucket_activity),
                     sleep_pattern=pdf.TotalMinutesAsleep.apply(bucket_sleep))
    vc = seg.sleep_pattern.value_counts(dropna=False).to_dict()
    s = m.withColumn("sleep_pattern", segments.bucket_sleep("TotalMinutesAsleep", A.SLEEP_ADEQUATE, True))
    assert {r.sleep_pattern: r["count"] for r in profile.value_counts(s, "sleep_pattern").collect()} == vc
    xt = pd.crosstab(seg.activity_level, seg.sleep_pattern)
    s2 = s.withColumn("activity_level", segments.bucket_activity("TotalSteps", null_as_unknown=True))
    cols = list(xt.columns)
    got = {r.activity_level: tuple(r[c] for c in cols)
           for r in profile.crosstab(s2, "activity_level", "sleep_pattern", cols).collect()}
    assert got == {k: tuple(int(v) for v in row) for k, row in xt.iterrows()}
