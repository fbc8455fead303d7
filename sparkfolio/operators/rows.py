"""Row position and keep-first operators.

A DataFrame has no row order.  Where the reference depends on position
(head, slicing, positional lists) we derive it explicitly.  The rows are placed
once: they are written to the shared folder with their place (split, position
inside the split), and both the rows and the splits' offsets are read from that
table.  Nothing rests on two evaluations of a plan giving the same partitions.
Without a key the order is that of the files, and no sort is needed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.sources.sinks import written_once

POS_COL = "_scan_pos"


def with_scan_position(df: DataFrame, name: str = POS_COL) -> DataFrame:
    """Attach a sortable (file, block, position) key; call right after a file
    scan.  Spark packs file splits into tasks by size, so the task order alone
    is not the file order: the key starts with the file path and the split's
    start offset, then the row's increasing id inside that split.  Non-file
    inputs get the increasing id only."""
    mono = F.monotonically_increasing_id()
    try:
        key = F.struct(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"), mono.alias("row"))
        return df.withColumn(name, key)
    except AnalysisException:
        return df.withColumn(name, mono)


def _tie(df: DataFrame) -> Column:
    """A hash of the whole row: it spreads rows that tie on the user's keys
    over several range partitions, and makes their order repeatable."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _place_once(df: DataFrame, order_by: list | None) -> DataFrame:
    """``df`` with its place: ``_file`` and ``_block`` name the split, ``_mid``
    grows inside it.  Keyed: the range partitions of one sort.  Without a key:
    the file splits, or the input's partitions if it does not come from files."""
    mid = F.monotonically_increasing_id()
    task = F.shiftright(mid, 33)
    if order_by:
        tagged = df.orderBy(*order_by, _tie(df)).withColumns({"_file": F.lit(""), "_block": task, "_mid": mid})
    else:
        try:
            tagged = df.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_mid": mid})
        except AnalysisException:
            tagged = df.withColumns({"_file": F.lit(""), "_block": task, "_mid": mid})
    return written_once(tagged, "rows")


def _offset(value: Column) -> Column:
    """An offset that must be there: a row without one stops the job."""
    return F.coalesce(value, F.raise_error("a row's split has no offset").cast("long"))


def with_row_index(df: DataFrame, order_by: list | None = None,
                   name: str = "row_idx", total_name: str | None = None) -> DataFrame:
    """Dense 0-based index in ``order_by`` order ((file, block, row) order
    when omitted).

    ``total_name`` additionally attaches the row count, from the same table of
    one row a split (its key is 16 bytes), which is broadcast.
    """
    split = [F.xxhash64("_file").alias("_fid"), F.col("_block")]
    placed = _place_once(df, order_by).withColumn("_fid", split[0])
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
               .select(*split, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                       F.sum("_n").over(everything).alias("_total")))
    out = placed.join(F.broadcast(offsets), ["_fid", "_block"], "left")
    out = out.withColumn(name, _offset(F.col("_off") + F.col("_mid") - F.col("_first")))
    if total_name:
        out = out.withColumn(total_name, F.col("_total"))
    return out.drop("_file", "_fid", "_block", "_mid", "_first", "_off", "_total")


def zip_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row i of ``left`` beside row i of ``right``, both in scan order: columns
    ``left`` and ``right`` (the rows, so no names clash) and ``i``.  Tables of
    different lengths raise ValueError.

    Each side is placed once and gets its dense index from its splits' offsets;
    the merge is then an equi-join on a unique number, which no value of the
    data can skew, and neither side is sorted as a whole."""
    def indexed(df: DataFrame, name: str) -> tuple[DataFrame, int]:
        rows = with_row_index(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)), None, name="i", total_name="n")
        some = rows.select("n").first()
        return rows.drop("n"), some["n"] if some else 0

    (a, n), (b, m) = indexed(left, "left"), indexed(right, "right")
    if n != m:
        raise ValueError(f"{m} rows beside {n}")
    return a.join(b, "i").select("left", "right", "i")


def _bound(v: Column, n: Column, lo: Column, hi: Column) -> Column:
    # clamp(v, lo, hi)
    return F.least(F.greatest(v, lo), hi)


def slice_rows(df: DataFrame, start=None, stop=None, step=None,
               order_by: list | None = None, index_col: str = "row_idx",
               keep_index: bool = False, ordered: bool = True) -> DataFrame:
    """O2: Python ``rows[start:stop:step]`` (negative indices and steps too).

    Bounds are resolved against the row count inside the plan.  Output is
    sorted by the index (descending for a negative step) unless ``ordered`` is
    false, which saves a sort when the caller does not need it.
    """
    step = 1 if step is None else int(step)
    if step == 0:
        raise ValueError("slice step cannot be zero")
    idx = with_row_index(df, order_by, name=index_col, total_name="_n_rows")
    n = F.col("_n_rows")
    i = F.col(index_col)

    def norm(v, default: Column, lo: Column, hi: Column) -> Column:
        if v is None:
            return default
        v = int(v)
        c = F.lit(v) + n if v < 0 else F.lit(v)
        return _bound(c, n, lo, hi)

    if step > 0:
        s = norm(start, F.lit(0), F.lit(0), n)
        e = norm(stop, n, F.lit(0), n)
        pred = (i >= s) & (i < e) & (((i - s) % F.lit(step)) == 0)
        out, by = idx.where(pred), i.asc()
    else:
        s = norm(start, n - 1, F.lit(-1), n - 1)
        e = norm(stop, F.lit(-1), F.lit(-1), n - 1)
        pred = (i <= s) & (i > e) & (((s - i) % F.lit(-step)) == 0)
        out, by = idx.where(pred), i.desc()
    out = (out.orderBy(by) if ordered else out).drop("_n_rows")
    return out if keep_index else out.drop(index_col)


def head_rows(df: DataFrame, n: int = 5, order_by: list | None = None) -> DataFrame:
    """O1: first ``n`` rows, ``n`` clamped at 0.  With a key this is a
    TakeOrdered (top-k, no full sort); without one, (file, block, row) scan
    order - also a top-k, never a full sort."""
    n = max(0, int(n))
    if order_by:
        return df.orderBy(*order_by).limit(n)
    pos = "_head_pos"
    return with_scan_position(df, pos).orderBy(pos).limit(n).drop(pos)


def keep_first(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Keep the first row (smallest ``order_col``) per key; a missing order
    value comes last, and equal ones are decided by a hash of the row.

    A ``min`` over (order missing, order, hash, row): combined map-side, so a
    hot key sends one row a task.  The row is part of the minimum, which Spark
    runs as a sort aggregate."""
    others = [c for c in df.columns if c not in keys]
    first = F.min(F.struct(F.col(order_col).isNull().alias("missing"), F.col(order_col).alias("order"), _tie(df).alias("tie"),
                           F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"))).alias("_first")
    agg = df.groupBy(*keys).agg(first)
    return agg.select(*keys, *[F.col("_first")["row"][c].alias(c) for c in others])


def with_group_rank(df: DataFrame, group_cols: list[str], order_cols: list,
                    name: str = "grp_rank", size_name: str | None = None) -> DataFrame:
    """Dense 0-based rank inside each group, computed without putting a group
    in one task: one distributed range sort on (group, order), the global
    dense index, minus the group's first index (a per-group table of
    ``#groups`` rows).  ``size_name`` also attaches the group size."""
    idx = with_row_index(df, list(group_cols) + list(order_cols), name="_gidx")
    starts = idx.groupBy(*group_cols).agg(F.min("_gidx").alias("_gstart"),
                                          F.count(F.lit(1)).alias("_gsize"))
    out = idx.join(starts, list(group_cols)).withColumn(name, F.col("_gidx") - F.col("_gstart"))
    if size_name:
        out = out.withColumn(size_name, F.col("_gsize"))
    return out.drop("_gidx", "_gstart", "_gsize")


def with_running_sum(df: DataFrame, order_by: list, value: str, name: str,
                     inclusive: bool = False) -> DataFrame:
    """Global running sum of ``value`` (missing: 0) in ``order_by`` order,
    exclusive by default.  One range-partitioned sort with an in-partition
    cumulative sum (Arrow batches in partition order) is written once; the
    partitions' totals (one row a partition, broadcast) come from that table."""
    vtype = df.schema[value].dataType
    ordered = df.orderBy(*order_by, _tie(df)).withColumns(
        {"_pid": F.spark_partition_id(), "_v": F.coalesce(F.col(f"`{value}`"), F.lit(0).cast(vtype))})
    schema = T.StructType(ordered.schema.fields + [T.StructField("_local", vtype)])

    def cumulative(batches):
        carry = 0
        for pdf in batches:
            c = pdf["_v"].cumsum() + carry
            if len(c):
                carry = c.iloc[-1]
            pdf["_local"] = c if inclusive else c - pdf["_v"]
            yield pdf

    local = written_once(ordered.mapInPandas(cumulative, schema), "running")
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (local.groupBy("_pid").agg(F.sum("_v").alias("_tot"))
               .select("_pid", F.coalesce(F.sum("_tot").over(before), F.lit(0)).cast(vtype).alias("_off")))
    out = local.join(F.broadcast(offsets), "_pid", "left")
    missing = F.raise_error("a row's partition has no offset").cast(vtype)
    return (out.withColumn(name, (F.coalesce("_off", missing) + F.col("_local")).cast(vtype))
               .drop("_pid", "_v", "_local", "_off"))
