"""Sinks (S11-S14)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.session import scratch_dir

#: Keys above the row bound that are broadcast; with more, the planner decides.
MAX_HOT_KEYS = 100_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def write_split(df: DataFrame, path: str, by: list[str], fmt: str = "csv",
                mode: str = "overwrite", rows_per_file: int = 1_000_000) -> None:
    """One folder per key combination (partition pruning on read).

    Files are planned from the counts a key: one of more than ``rows_per_file``
    rows is dealt to several tasks by a hash of the row, all others stay whole,
    many to a task.  One shuffle; no file has more than ``rows_per_file`` rows.
    The counts decide only where rows go, so ``df`` may be computed twice."""
    key = F.struct(*[F.col(f"`{c}`") for c in by])
    own = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.xxhash64(key).alias("key"), own.alias("own"))
    hot = (rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("long").alias("files"))
           .where(F.col("files") > 1))
    few = hot.limit(MAX_HOT_KEYS + 1).count() <= MAX_HOT_KEYS       # 16 bytes each
    dealt = (rows.join(F.broadcast(hot) if few else hot, "key", "left")
             .withColumn("file", F.pmod("own", F.coalesce("files", F.lit(1))))
             .repartition("key", "file").select("row.*"))
    w = dealt.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(*by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (leaderboards, parameter tables)."""
    df.write.mode(mode).json(path)


def create_table_as(df: DataFrame, name: str, path: str | None = None,
                    fmt: str = "parquet") -> None:
    """CREATE TABLE ... AS SELECT (a managed or path-backed table)."""
    w = df.write.mode("overwrite").format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int,
                   path: str | None = None, sort: bool = True) -> None:
    """Save ``df`` as a table hash-bucketed (and sorted) on ``keys``.

    Two tables bucketed the same way on their join keys are joined without
    shuffling either side (and, sorted, without re-sorting): the layout for
    big fact-to-fact joins that run repeatedly, e.g. order lines to orders
    on the order key."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under a path of its own in the shared folder and read it
    back: everything derived from the result sees one evaluation of ``df``,
    and a lost executor re-reads files."""
    path = scratch_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
