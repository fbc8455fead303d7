"""Data-profile operators.

``describe`` computes *exact* quartiles (linear interpolation, like pandas)
without collecting or sorting any column: passes over the wide rows count
buckets of values, ever smaller ones around each wanted rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions.arith import round_half


def null_profile(df: DataFrame, top: int = 10) -> DataFrame:
    """NULL count per column, most first (ties by name), top ``top``."""
    counts = df.agg(*[F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0))
                      .cast("bigint").alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = counts.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, null_count)")
    return long.orderBy(F.col("null_count").desc(), "column_name").limit(top)


def describe(df: DataFrame, cols: list[str], percentiles=(0.25, 0.5, 0.75),
             digits: int | None = 6, exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """Count, mean, std (sample), min, quantiles, max per column.

    One row per column.  Moments are rounded to ``digits`` places (their last
    bits depend on summation order); counts, min, max and quantiles are exact.
    ``exact=False`` is the one-pass path for very large inputs: quantiles come
    from a bounded-memory sketch (``percentile_approx``, rank error about
    1/accuracy) inside the same aggregate, so no global sort.
    """
    value = {c: F.col(f"`{c}`").cast("double") for c in cols}
    value = {c: F.when(~F.isnan(v), v) for c, v in value.items()}

    def r(e: Column) -> Column:
        return round_half(e, digits) if digits is not None else e

    # all columns' moments in one pass over the wide rows
    if exact:
        quant = wide_quantiles(df.select(*[v.alias(c) for c, v in value.items()]), percentiles)
        cells = {c: [F.lit(x).cast("double") for x in quant[c]] for c in cols}
    else:
        cells = {c: [F.col(f"_q{i}")[j] for j in range(len(percentiles))] for i, c in enumerate(cols)}
    approx = [] if exact else [F.percentile_approx(v, list(percentiles), accuracy).alias(f"_q{i}") for i, v in enumerate(value.values())]
    wide = df.agg(*[F.struct(F.lit(c).alias("column_name"), F.count(v).alias("count"), r(F.avg(v)).alias("mean"), r(F.stddev_samp(v)).alias("std"),
                             F.min(v).alias("min"), F.max(v).alias("max")).alias(f"_{i}") for i, (c, v) in enumerate(value.items())], *approx)
    names = [f"p{int(round(p * 100))}" for p in percentiles]
    rows = F.array(*[F.struct(*[F.col(f"_{i}")[x].alias(x) for x in ("column_name", "count", "mean", "std", "min")],
                              *[q.alias(n) for n, q in zip(names, cells[c])], F.col(f"_{i}")["max"].alias("max")) for i, c in enumerate(cols)])
    return wide.select(F.inline(rows)).where("count > 0")


DIGIT = 16              # bits of a value's code that one pass tells
FEW = 4096              # values that are fetched instead of counted again


def _codes(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers in the same order (-0.0 as 0.0)."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def _value(code: int) -> float:
    """The double of a code."""
    bits = code ^ (1 << 63) if code >> 63 else code ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _bucket_counts(wanted: list[tuple[int, int, int, bool]]):
    """For each wanted (column, prefix, number of known bits, fetch): how many
    values with that prefix have each next digit, summed over a task's rows;
    or, where fetched, each value's code and its count."""
    def run(batches):
        counts = [{} for _ in wanted]
        for b in batches:
            codes = {}
            for i, (col, prefix, known, fetch) in enumerate(wanted):
                if col not in codes:
                    c = b.column(col).drop_null()
                    codes[col] = _codes(c.to_numpy(zero_copy_only=False).astype(np.float64))
                c = codes[col]
                if known:
                    c = c[c >> np.uint64(64 - known) == np.uint64(prefix)]
                key, n = np.unique(c if fetch else (c >> np.uint64(64 - known - DIGIT)) & np.uint64((1 << DIGIT) - 1), return_counts=True)
                for k, x in zip(key.tolist(), n.tolist()):
                    counts[i][k] = counts[i].get(k, 0) + x
        flat = [(i, k, x) for i, of in enumerate(counts) for k, x in of.items()]
        # codes as signed longs, as Spark has no unsigned ones
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int32()), pa.array(np.array([f[1] for f in flat], np.uint64).view(np.int64)), pa.array([f[2] for f in flat], pa.int64())],
                                         ["target", "key", "n"])
    return run


def wide_quantiles(df: DataFrame, percentiles=(0.5,)) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation (pandas / numpy default) of
    all columns of ``df`` (doubles; NULLs do not count), None without values.

    Radix selection: doubles have a code that sorts as they do.  A pass over
    the wide rows counts, for every wanted rank of every column at once, the
    values in the bucket found so far by their next DIGIT bits; a task sends
    one row a bucket that it met.  The bucket that holds the rank is refined
    until it has FEW values, which are fetched, or its values are equal.  So at
    most 64 / DIGIT passes are made, whatever the distribution, nothing is
    sorted, and a value that many rows share is one count."""
    cols = df.columns
    n = {c: None for c in cols}
    # (column, rank) -> [prefix, known bits, ranks before the bucket, values in the bucket]
    state: dict[tuple[int, int], list[int]] = {}
    found: dict[tuple[int, int], float] = {}
    first = True
    while first or state:
        targets = {(i, 0, 0, False): [] for i in range(len(cols))} if first else {}
        for (i, rank), (prefix, known, _, size) in state.items():
            targets.setdefault((i, prefix, known, size <= FEW), []).append(rank)
        wanted = list(targets)
        got: list[list[tuple[int, int]]] = [[] for _ in wanted]
        sums = df.mapInArrow(_bucket_counts(wanted), "target int, key long, n long").groupBy("target", "key").agg(F.sum("n").alias("n"))
        rows = sums.toArrow()                       # 2 ** DIGIT buckets a target at most
        for t, k, x in zip(rows["target"].to_pylist(), rows["key"].to_pylist(), rows["n"].to_pylist()):
            got[t].append((k % (1 << 64), x))
        for (i, prefix, known, fetch), buckets in zip(wanted, map(sorted, got)):
            if first:
                n[cols[i]] = sum(x for _, x in buckets)
                ranks = {f((n[cols[i]] - 1) * float(p)) for p in percentiles for f in (math.floor, math.ceil)} if n[cols[i]] else set()
                state |= {(i, k): [0, 0, 0, n[cols[i]]] for k in ranks}
            else:
                ranks = targets[i, prefix, known, fetch]
            for rank in ranks:
                before = state[i, rank][2]
                for key, x in buckets:
                    if rank < before + x:
                        break
                    before += x
                if fetch or known + DIGIT == 64:
                    found[i, rank] = _value(key if fetch else prefix << DIGIT | key)
                    del state[i, rank]
                else:
                    state[i, rank] = [prefix << DIGIT | key, known + DIGIT, before, x]
        first = False
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        out[c] = []
        for p in percentiles:
            at = (n[c] - 1) * float(p)
            low, high = (found.get((i, f(at))) for f in (math.floor, math.ceil))
            out[c].append(None if low is None else low + (high - low) * (at - math.floor(at)) if high != low else low)
    return out


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value, NULL included as its own group."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    """Counts of ``row`` x ``col``; the column values are a fixed list
    (no extra distinct job, stable schema), missing cells are 0."""
    return df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1))).na.fill(0, subset=values)


def linear_trend(df: DataFrame, y: str, x: str, digits: int | None = 6) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` (slope, intercept, n)."""
    s, i = F.regr_slope(y, x), F.regr_intercept(y, x)
    if digits is not None:
        s, i = round_half(s, digits), round_half(i, digits)
    return df.agg(s.alias("slope"), i.alias("intercept"), F.regr_count(y, x).alias("n"))


