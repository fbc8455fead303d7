"""Price-series segment on ``orders``.

Stand-in mapping: a symbol is an order priority, its daily "high" is the
largest order total of the day; train = dates up to 1999-12-31, test = from
2000-01-01 (the data spans 1995-01 .. 2001-08), 30-day windows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfolio.functions.arith import round_half, round_sql
from sparkfolio.operators import series as S
from sparkfolio.plans.registry import query
from sparkfolio.plans.stages import stage
from sparkfolio.sources.readers import price_history
from sparkfolio.sources.sinks import written_once
from sparkfolio.sources.tables import load

START, END = "1995-01-01", "2001-09-01"
TRAIN_END, TEST_START = "1999-12-31", "2000-01-01"
STEP = 30


def daily_prices(spark, sf):
    """Stage table: the daily high per symbol, built once per input version."""
    return stage(spark, sf, "daily_prices", ["orders"], lambda: build_daily_prices(spark, sf))


def build_daily_prices(spark, sf):
    o = load(spark, sf, "orders")
    d = o.groupBy(F.col("o_orderpriority").alias("symbol"),
                  F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("high"))
    # [START, END) range of the daily high, per symbol
    return price_history(d, START, END, keep=["symbol"])


def split_prices(spark, sf):
    return S.chrono_split(daily_prices(spark, sf), TRAIN_END, TEST_START, time_step=STEP)


def scaled_prices(spark, sf):
    sp = split_prices(spark, sf)
    return S.with_minmax(sp, "high", F.col("split").isin("train", "validation"))


def windows(spark, sf):
    return S.prepare_windows(daily_prices(spark, sf), TRAIN_END, TEST_START, STEP)


BASE_CTE = f"""
WITH p AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, MAX(o_totalprice) AS high
  FROM orders GROUP BY 1, 2),
p2 AS (SELECT * FROM p WHERE date >= DATE '{START}' AND date < DATE '{END}'),
r AS (
  SELECT *, date <= DATE '{TRAIN_END}' AS is_train, date >= DATE '{TEST_START}' AS is_test,
         ROW_NUMBER() OVER (PARTITION BY symbol, date <= DATE '{TRAIN_END}' ORDER BY date) - 1 AS rn,
         COUNT(*) OVER (PARTITION BY symbol, date <= DATE '{TRAIN_END}') AS n
  FROM p2),
s AS (
  SELECT symbol, date, high,
         CASE WHEN is_test THEN 'test'
              WHEN is_train AND rn - {STEP} >= FLOOR(GREATEST(n - {STEP}, 0) * 900 / 1000)
                   AND rn >= {STEP} THEN 'validation'
              WHEN is_train THEN 'train' ELSE 'out' END AS split
  FROM r),
mm AS (SELECT symbol, MIN(high) AS mn, MAX(high) AS mx FROM s
       WHERE split IN ('train', 'validation') GROUP BY symbol),
sc AS (
  SELECT s.*, mm.mn, mm.mx,
         CASE WHEN mm.mx - mm.mn = 0 THEN s.high - mm.mn
              ELSE (s.high - mm.mn) / (mm.mx - mm.mn) END AS scaled
  FROM s LEFT JOIN mm ON s.symbol = mm.symbol),
w AS (
  SELECT *, list(scaled) OVER (PARTITION BY symbol, CASE WHEN split = 'test' THEN 'test' ELSE 'train' END
                               ORDER BY date ROWS BETWEEN {STEP} PRECEDING AND 1 PRECEDING) AS x
  FROM sc WHERE split <> 'out')
"""


@query("chrono_split", BASE_CTE + "SELECT symbol, date, high, split FROM s")
def chrono_split(spark, sf):
    """S10 range + P20 inclusive slice + M19 train/validation/test labels."""
    return split_prices(spark, sf).select("symbol", "date", "high", "split")


@query("minmax_inverse", BASE_CTE + """
SELECT symbol, date, high, scaled,
       CASE WHEN mx - mn = 0 THEN scaled + mn ELSE scaled * (mx - mn) + mn END AS restored
FROM sc""")
def minmax_inverse(spark, sf):
    """Min-max fitted on the training split, applied everywhere, inverted."""
    sc = scaled_prices(spark, sf)
    return sc.select("symbol", "date", "high", "scaled", S.minmax_inverse("scaled").alias("restored"))


@query("lag_windows", BASE_CTE + "SELECT symbol, date, split, scaled AS y, x FROM w WHERE len(x) = 30")
def lag_windows(spark, sf):
    """W5 + W6: 30-step windows per symbol, test windows start inside test."""
    return windows(spark, sf).select("symbol", "date", "split", "y", "x")


@query("rmse_known", BASE_CTE + f"""
SELECT symbol, {round_sql('SQRT(AVG(POWER(high - pred, 2)))', 6)} AS rmse, COUNT(*) AS n
FROM (SELECT symbol, high,
             CASE WHEN mx - mn = 0 THEN x[30] + mn ELSE x[30] * (mx - mn) + mn END AS pred
      FROM w WHERE len(x) = 30 AND split = 'test') t
GROUP BY symbol""")
def rmse_known(spark, sf):
    """A19 on a fixed forecast (the previous day's value), in price units."""
    w = windows(spark, sf).where(F.col("split") == "test")
    w = w.withColumn("pred", S.minmax_inverse(F.element_at("x", -1)))
    r = S.rmse(w, "high", "pred", by=["symbol"])
    return r.select("symbol", round_half("rmse", 6).alias("rmse"), "n")


L2 = 1e-6
#: Each symbol's normal equations, solved by eliminating one column after the other.
_MODEL_CTE = BASE_CTE.replace("WITH p AS", "WITH RECURSIVE p AS", 1) + f""",
z AS (SELECT symbol, list_concat([1.0::DOUBLE], x, [scaled]) AS z FROM w WHERE len(x) = {STEP} AND split = 'train'),
g AS (SELECT symbol, i, j, SUM(z[i] * z[j]) + CASE WHEN i = j AND i > 1 THEN {L2} ELSE 0 END AS v
      FROM z, range(1, {STEP + 2}) a(i), range(1, {STEP + 3}) b(j) GROUP BY symbol, i, j),
m AS (SELECT symbol, list(r ORDER BY i) AS a FROM (SELECT symbol, i, list(v ORDER BY j) AS r FROM g GROUP BY symbol, i) t GROUP BY symbol),
e(symbol, k, a) AS (
  SELECT symbol, CAST(1 AS BIGINT), a FROM m
  UNION ALL
  SELECT symbol, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / a[k][k])
                                                           ELSE list_transform(r, lambda v, j: v - r[k] * a[k][j] / a[k][k]) END)
  FROM e WHERE k <= {STEP + 1}),
b AS (SELECT symbol, list_transform(a, lambda r: r[{STEP + 2}]) AS b FROM e WHERE k = {STEP + 2}),
f AS (
  SELECT w.symbol, date, scaled, mn, mx, b[1] + list_sum(list_transform(x, lambda v, i: v * b[i + 1])) AS pred
  FROM w LEFT JOIN b ON b.symbol = w.symbol WHERE len(x) = {STEP} AND split = 'test')
"""
_PRICE = "CASE WHEN mx - mn = 0 THEN {0} + mn ELSE {0} * (mx - mn) + mn END"


@query("forecast", _MODEL_CTE + f"SELECT symbol, date, scaled AS y, {round_sql('pred', 6)} AS pred FROM f")
def forecast(spark, sf):
    """The next day's scaled value by each symbol's own model of its
    30-step window."""
    w = windows(spark, sf)
    models = S.fit_by_series(w.where(F.col("split") == "train"), l2=L2)
    p = S.predict_by_series(models, w.where(F.col("split") == "test"))
    return p.select("symbol", "date", "y", round_half("pred", 6).alias("pred"))


@query("prediction_vs_actual", _MODEL_CTE + f""",
pa AS (SELECT symbol, date, {_PRICE.format("scaled")} AS actual, {_PRICE.format("pred")} AS predicted FROM f),
er AS (SELECT symbol, SQRT(AVG(POWER(actual - predicted, 2))) AS rmse FROM pa GROUP BY symbol)
SELECT pa.symbol, date, actual, {round_sql('predicted', 2)} AS predicted, {round_sql('rmse', 2)} AS rmse FROM pa JOIN er ON er.symbol = pa.symbol""")
def prediction_vs_actual(spark, sf):
    """M21 + A19: test dates with actual and predicted prices and the symbol's RMSE."""
    table, _ = S.forecast_report(daily_prices(spark, sf), TRAIN_END, TEST_START, STEP)
    table = written_once(table, "forecast")
    errors = S.rmse(table, "actual", "predicted", by=["symbol"]).select("symbol", round_half("rmse", 2).alias("rmse"))
    return table.join(errors, "symbol").select("symbol", "date", "actual", round_half("predicted", 2).alias("predicted"), "rmse")
