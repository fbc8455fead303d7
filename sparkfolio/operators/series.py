"""Time-series operators.

Series are long tables ``(symbol, date, value)``.  A symbol may hold most of
the rows, so no window covers a whole symbol: positions come from counts per
(symbol, year), minima and maxima from grouped aggregates, and lag windows run
over (symbol, block of positions) with the rows before the block repeated.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


BLOCK = 4096        # positions of one symbol in one lag window task


def position_in(df: DataFrame, partition: list[str], date: str, counted: Column | None = None,
                name: str = "_pos", total: str | None = None) -> DataFrame:
    """Number of ``counted`` rows (default: all) of the same partition up to
    and with the row, by ``date``; ``total`` adds the number in the partition.
    Counts of each (partition, year) give the years' offsets (one row each)."""
    one = F.lit(1) if counted is None else counted.cast("int")
    years = [*partition, "_year"]
    dated = df.withColumn("_year", F.year(date)).withColumn("_one", F.coalesce(one, F.lit(0)))
    before = Window.partitionBy(*partition).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dated.groupBy(*years).agg(F.sum("_one").alias("_c"))
              .select(*years, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"),
                      F.sum("_c").over(Window.partitionBy(*partition)).alias("_all")))
    inside = F.sum("_one").over(Window.partitionBy(*years).orderBy(date).rowsBetween(Window.unboundedPreceding, 0))
    joined = dated.withColumn("_in", inside)
    # null-safe keys: a row without a symbol or a date keeps its place
    joined = joined.join(starts, [joined[c].eqNullSafe(starts[c]) for c in years], "left").select(
        *[joined[c] for c in df.columns], joined["_in"], starts["_start"], starts["_all"])
    out = joined.withColumn(name, F.col("_start") + F.col("_in"))
    if total:
        out = out.withColumn(total, F.col("_all"))
    return out.drop("_in", "_start", "_all")


def chrono_split(df: DataFrame, train_end: str, test_start: str, date: str = "date",
                 symbol: str = "symbol", time_step: int = 30,
                 validation_split: float = 0.1) -> DataFrame:
    """M19 + P20: ``split`` = train / validation / test / out.

    train: dates <= train_end (inclusive slice), test: dates >= test_start;
    validation is the last ``validation_split`` of the *training samples*
    (a sample exists from the ``time_step``-th training day on):
    ``split_at = floor(n_samples * (1 - v))``."""
    d = F.col(date)
    is_train = d <= F.lit(train_end).cast("date")
    is_test = d >= F.lit(test_start).cast("date")
    out = position_in(df, [symbol], date, is_train, "_r", "_n").withColumn("_r", F.col("_r") - 1)
    n_samples = F.greatest(F.col("_n") - time_step, F.lit(0))
    split_at = F.floor(F.round(n_samples * F.lit(1 - float(validation_split)), 6))
    label = (F.when(is_test, "test")
              .when(is_train & ((F.col("_r") - time_step) >= split_at) & (F.col("_r") >= time_step),
                    "validation")
              .when(is_train, "train").otherwise("out"))
    return out.withColumn("split", label).drop("_r", "_n")


def with_minmax(df: DataFrame, value: str, fit_rows: Column, out: str = "scaled",
                symbol: str = "symbol") -> DataFrame:
    """M18 fit + apply: ``mn``/``mx`` are the min/max of ``value`` over the
    rows selected by ``fit_rows`` within the symbol."""
    return minmax_transform(df, fit_minmax(df.where(fit_rows), value, symbol), value, out, symbol)


def fit_minmax(train: DataFrame, value: str, symbol: str = "symbol") -> DataFrame:
    """M18 fit: one (symbol, mn, mx) row per symbol."""
    return train.groupBy(symbol).agg(F.min(value).alias("mn"), F.max(value).alias("mx"))


def minmax_transform(df: DataFrame, params: DataFrame, value: str, out: str = "scaled",
                     symbol: str = "symbol") -> DataFrame:
    """M18 apply: ``(x - mn) / (mx - mn)``; a constant series scales by 1
    (so it maps to 0).  ``params`` has one row per symbol; how it is joined is
    left to the planner, which knows its size."""
    j = df.join(params, symbol, "left")
    rng = F.col("mx") - F.col("mn")
    return j.withColumn(out, F.when(rng == 0, F.col(value) - F.col("mn"))
                        .otherwise((F.col(value) - F.col("mn")) / rng))


def minmax_inverse(c, mn: Column | None = None, mx: Column | None = None) -> Column:
    """M18 inverse: ``s * (mx - mn) + mn`` (range 0 -> ``s + mn``)."""
    mn = F.col("mn") if mn is None else mn
    mx = F.col("mx") if mx is None else mx
    s = F.col(c) if isinstance(c, str) else c
    rng = mx - mn
    return F.when(rng == 0, s + mn).otherwise(s * rng + mn)


def lag_windows(df: DataFrame, value: str, time_step: int = 30, date: str = "date",
                partition: list[str] | None = None, x: str = "x", y: str = "y",
                segment: str | None = None) -> DataFrame:
    """W5 + W6: ``x`` = the previous ``time_step`` values (oldest first),
    ``y`` = the current value; rows without a full window are dropped, so a
    series of n rows yields n - time_step samples, each keeping its date.

    ``segment`` names a column of contiguous date ranges (e.g. train / test):
    a window must lie inside the current row's segment, so the row
    ``time_step`` places earlier must be in it too.

    Windows run over blocks of BLOCK positions; the last ``time_step`` rows of
    a block are repeated in front of the next one."""
    partition = partition or ["symbol"]
    block = max(BLOCK, time_step)
    at = F.col("_pos") - 1
    placed = position_in(df, partition, date)
    here = F.floor(at / block)
    spread = placed.withColumn("_block", F.explode(F.when(at % block >= block - time_step, F.array(here, here + 1)).otherwise(F.array(here))))
    by = Window.partitionBy(*partition, "_block").orderBy("_pos")
    out = spread.withColumn(x, F.collect_list(value).over(by.rowsBetween(-time_step, -1))).withColumn(y, F.col(value))
    keep = (F.size(x) == time_step) & (F.floor(at / block) == F.col("_block"))
    if segment:
        out = out.withColumn("_then", F.lag(segment, time_step).over(by))
        return out.where(keep & (F.col("_then") == F.col(segment))).drop("_then", "_pos", "_block")
    return out.where(keep).drop("_pos", "_block")


def lags_to_vector(df: DataFrame, x: str = "x", out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(x)))


def _outer_sums(n_by: int, step: int):
    """Per series of a batch the sums of z z' with z = (1, lags, y), one row an entry."""
    def run(batches):
        for b in batches:
            keys = b.select(b.schema.names[:n_by]).to_pylist()
            lags = b.column(n_by).flatten().to_numpy(zero_copy_only=False).reshape(-1, step)
            z = np.column_stack([np.ones(len(b)), lags, b.column(n_by + 1).to_numpy(zero_copy_only=False)])
            places: dict[tuple, list[int]] = {}
            for i, k in enumerate(keys):
                places.setdefault(tuple(k.values()), []).append(i)
            for k, rows in places.items():
                sums = (z[rows].T @ z[rows]).ravel()
                keyed = [pa.array([v] * len(sums), b.column(j).type) for j, v in enumerate(k)]
                yield pa.RecordBatch.from_arrays([*keyed, pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], [*b.schema.names[:n_by], "_k", "_v"])
    return run


def fit_by_series(train: DataFrame, by: list[str] | None = None, x: str = "x", y: str = "y", l2: float = 1e-6, time_step: int = 30) -> DataFrame:
    """One least-squares model a series on the lag window (re-aimed LSTM):
    columns ``by`` and ``model`` (intercept, then a weight a lag, oldest first).

    The normal equations are sums of outer products: a task sends one
    (time_step + 2)-square matrix a series and batch, Spark adds them up entry
    by entry, and each series is solved from one row of sums.  So a series of
    any length is no burden, and a million series are a million small rows.
    ``l2`` on the lags' weights keeps short series solvable; a series without
    training windows has no model."""
    by = by or ["symbol"]
    z = time_step + 2
    rows = train.where(F.size(x) == time_step).select(*by, F.col(x).cast("array<double>").alias("_x"), F.col(y).cast("double").alias("_y")).where(F.col("_y").isNotNull())
    schema = T.StructType([rows.schema[c] for c in by] + [T.StructField("_k", T.IntegerType()), T.StructField("_v", T.DoubleType())])
    sums = rows.mapInArrow(_outer_sums(len(by), time_step), schema).groupBy(*by, "_k").agg(F.sum("_v").alias("_v"))
    matrix = sums.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_v"))), lambda e: e["_v"]).alias("_sums"))       # z * z numbers a series

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solved(sums: pd.Series) -> pd.Series:
        out = []
        for v in sums:
            m = np.asarray(v).reshape(z, z)
            a = m[:-1, :-1] + l2 * np.diag([0.0] + [1.0] * time_step)
            out.append(np.linalg.solve(a, m[:-1, -1]).tolist())
        return pd.Series(out, dtype=object)

    return matrix.select(*by, solved("_sums").alias("model"))


def predict_by_series(models: DataFrame, df: DataFrame, by: list[str] | None = None, x: str = "x", out: str = "pred") -> DataFrame:
    """``df`` with the forecast of its series' model; NULL without a model or a full window."""
    by = by or ["symbol"]
    m = models.select(*[F.col(c).alias(f"_{c}") for c in by], "model")
    joined = df.join(m, reduce(lambda a, b: a & b, [df[c].eqNullSafe(m[f"_{c}"]) for c in by]), "left")
    products = F.zip_with(F.slice("model", F.lit(2), F.size("model") - 1), F.col(x), lambda w, v: w * v)
    pred = F.aggregate(products, F.get("model", F.lit(0)), lambda a, v: a + v)
    return joined.withColumn(out, F.when(F.col("model").isNotNull(), pred)).drop(*[f"_{c}" for c in by], "model")


def fit_forecaster(train: DataFrame, x: str = "x", y: str = "y", kind: str = "gbt"):
    """M20 pooled: next-value regression on the lag window, one distributed
    fit over all series (``linear`` or boosted trees)."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression
    data = lags_to_vector(train, x)
    if kind == "linear":
        est = LinearRegression(featuresCol="features", labelCol=y, solver="normal",
                               regParam=0.0)
    else:
        est = GBTRegressor(featuresCol="features", labelCol=y, maxIter=50, maxDepth=4, seed=42)
    return est.fit(data)


def predict(model, df: DataFrame, x: str = "x", out: str = "pred") -> DataFrame:
    return model.transform(lags_to_vector(df, x)).withColumnRenamed("prediction", out).drop("features")


def rmse(df: DataFrame, actual: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """``sqrt(mean((actual - pred)^2))`` (per group when ``by``)."""
    e = F.sqrt(F.avg(F.pow(F.col(actual) - F.col(pred), 2))).alias("rmse")
    return df.groupBy(*(by or [])).agg(e, F.count(F.lit(1)).alias("n"))


def prepare_windows(prices: DataFrame, train_end: str, test_start: str,
                    time_step: int = 30, value: str = "high") -> DataFrame:
    """M19 + M18 + W5 over ``(symbol, date, value)``: split labels, min-max
    fitted on the training rows, windows that never cross the train / test
    boundary."""
    sp = chrono_split(prices, train_end, test_start, time_step=time_step)
    sc = with_minmax(sp, value, F.col("split").isin("train", "validation")).where(F.col("split") != "out")
    sc = sc.withColumn("side", F.when(F.col("split") == "test", "test").otherwise("train"))
    return lag_windows(sc, "scaled", time_step, segment="side")


def forecast_report(prices: DataFrame, train_end: str, test_start: str, time_step: int = 30,
                    value: str = "high", kind: str = "by series") -> tuple[DataFrame, DataFrame]:
    """M20 + M21 + A19: fit on training windows (a model a symbol, or one
    pooled ``linear`` or ``gbt`` model), predict the test windows, return
    (per-date actual vs predicted prices, RMSE per symbol)."""
    w = prepare_windows(prices, train_end, test_start, time_step, value)
    train, test = w.where(F.col("split") == "train"), w.where(F.col("split") == "test")
    if kind == "by series":
        p = predict_by_series(fit_by_series(train, time_step=time_step), test)
    else:
        p = predict(fit_forecaster(train, kind=kind), test)
    table = p.select("symbol", "date", minmax_inverse("y").alias("actual"),
                     minmax_inverse("pred").alias("predicted"))
    return table, rmse(table, "actual", "predicted", by=["symbol"])
