"""Ordered outputs (O4): files in one total order, with a manifest of their places.

The rows are range-partitioned and sorted once.  The files hold the caller's
columns alone; a manifest beside them (``_manifest``, which Parquet readers
pass over) has one row a file: its name, the place of its first row and its
number of rows.  A row's place is its file's first place plus its index in the
file, so a reader needs no sort, and a range of places reads only the files
that hold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "file string, first long, rows long"
#: Files whose manifest (some 100 bytes a row) is broadcast; with more, the planner decides.
MAX_BROADCAST_FILES = 200_000


def write_ordered(df: DataFrame, path: str, order_by: list, rows_per_file: int = 0) -> None:
    """Write ``df`` to a new folder in ``order_by`` order; rows that tie are in
    the order of a hash of the row, so they spread over files.  ``rows_per_file``
    bounds a file (0: no bound).  An empty table gives an empty manifest."""
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    df.orderBy(*order_by, tie).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    files = (df.sparkSession.read.schema(df.schema).parquet(path)
             .groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows")))
    # a file's name has the number of its task, then that of the file among the task's
    number = lambda k: F.regexp_extract("file", r"^part-(\d+)-.*-c(\d+)", k).cast("long")
    before = Window.orderBy(number(1), number(2)).rowsBetween(Window.unboundedPreceding, -1)
    (files.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"), "rows")
     .write.json(f"{path}/{MANIFEST}"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/{MANIFEST}")


def _placed(rows: DataFrame, files: DataFrame, n_files: int, place: str) -> DataFrame:
    columns = [F.col(f"r.`{c}`") for c in rows.columns]
    at = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("r"),
                     F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("i"))
    files = files.select("file", "first")
    out = at.join(F.broadcast(files) if n_files <= MAX_BROADCAST_FILES else files, "file", "left")
    first = F.coalesce("first", F.raise_error("a file is not in the manifest").cast("long"))
    return out.select(*columns, (first + F.col("i")).alias(place))


def read_ordered(spark: SparkSession, path: str, place: str = "place") -> DataFrame:
    """The rows with their 0-based place in the order they were written in.  A
    file that the manifest does not know stops the job."""
    files = manifest(spark, path)
    return _placed(spark.read.parquet(path), files, files.count(), place)


def read_places(spark: SparkSession, path: str, start: int, stop: int, place: str = "place") -> DataFrame:
    """The rows at places ``start`` to ``stop`` (exclusive), from the files that hold them."""
    files = manifest(spark, path).where((F.col("first") < stop) & (F.col("first") + F.col("rows") > start))
    names = [r["file"] for r in files.select("file").toLocalIterator()]     # of the range alone
    rows = spark.read.parquet(path)
    if not names:
        return rows.where(F.lit(False)).withColumn(place, F.lit(0).cast("long"))
    some = spark.read.schema(rows.schema).parquet(*[f"{path}/{n}" for n in names])
    return _placed(some, files, len(names), place).where((F.col(place) >= start) & (F.col(place) < stop))
