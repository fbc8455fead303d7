"""Source operators.

Readers declare schemas instead of inferring them (inference is a full extra
pass over the input at scale), bind multi-file inputs by column *name*, and
never list or read file contents on the driver: path probing uses the Hadoop
filesystem glob (metadata only).
"""

from __future__ import annotations

import csv
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.sources.sinks import written_once


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches a file, probed with one row through
    Spark's own file index (any filesystem the cluster reads; the content
    column is pruned, so only metadata is touched)."""
    try:
        return not spark.read.format("binaryFile").load(path).select("path").limit(1).isEmpty()
    except AnalysisException:
        return False


def _header_names(line: str) -> list[str]:
    """Column names of a header line; quoted names may hold commas."""
    return next(csv.reader([line.rstrip("\r\n")]))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Header names of a CSV (reads only the first line of one file through Spark)."""
    first = spark.read.text(path).where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != "")).limit(1).collect()
    if not first:
        raise ValueError(f"no header line in {path}")
    return _header_names(first[0][0])


def _conf_bytes(spark: SparkSession, key: str) -> int:
    """A size setting such as ``128MB``, ``16m`` or ``134217728b`` in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", spark.conf.get(key).strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def _first_lines(alone: int):
    """(file, header) of the files whose start a task reads.  A split of more
    than ``alone`` bytes has its task to itself, so the task is done after the
    first rows; small splits share a task, which is read to its end."""
    def run(batches):
        done: set[str] = set()
        for b in batches:
            files, value = b["_file"].dictionary_encode(), b["value"]
            code = files.indices.to_numpy(zero_copy_only=False)
            line = pc.not_equal(pc.utf8_trim_whitespace(value), "").fill_null(False).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(line)
            code, first = np.unique(code[at], return_index=True)
            new = [(f, value[int(i)].as_py()) for f, i in zip(files.dictionary.take(pa.array(code)).to_pylist(), at[first]) if f not in done]
            done |= {f for f, _ in new}
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in new], pa.string()), pa.array([h for _, h in new], pa.string())], ["_file", "_header"])
            if len(b) and b["_length"][0].as_py() > alone:
                return
    return run


def _file_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame | None:
    """(file, header line) of every file of ``paths``, as a written table; None
    when nothing matches.  Of a large file the task of each split stops after
    its first rows; only files that share a task are read through."""
    try:
        text = spark.read.text(paths)
        block = F.col("_metadata.file_block_start")
        lines = text.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_length").alias("_length"), F.when(block == 0, F.col("value")).alias("value"))
    except AnalysisException:
        return None
    alone = _conf_bytes(spark, "spark.sql.files.maxPartitionBytes") - _conf_bytes(spark, "spark.sql.files.openCostInBytes")
    return written_once(lines.mapInArrow(_first_lines(alone), "_file string, _header string"), "headers")


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column a string, blanks are '' (not NULL).

    Spark honours quotes and pads short rows with NULL (both deliberate
    improvements); fully empty lines are skipped as in the reference, while
    lines of only commas stay as all-'' rows.
    """
    names = csv_header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = (spark.read.option("header", True).option("nullValue", "\u0000")
          .option("emptyValue", "").option("mode", "PERMISSIVE")
          .schema(schema).csv(path))
    return df.na.fill("")


def read_csv_typed(spark: SparkSession, path, schema: T.StructType | str) -> DataFrame:
    """Typed CSV with an explicit schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def normalise_headers(df: DataFrame, renames: dict | None = None) -> DataFrame:
    """Trim, remove spaces, '/' -> '_', then apply a rename map."""
    renames = renames or {}
    new = []
    for c in df.columns:
        n = c.strip().replace(" ", "").replace("/", "_")
        new.append(renames.get(n, n))
    return df.toDF(*new)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL aligned by name, absent columns -> NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


_CSV = {"header": True, "nullValue": "\u0000", "emptyValue": ""}


def read_csv_by_name(spark: SparkSession, paths: str | list[str], all_string: bool = False,
                     position_col: str | None = None) -> DataFrame | None:
    """All files of ``paths`` as text columns, aligned by the names of each
    file's own header; None when nothing matches.  A column that a file does
    not have is NULL in its rows.

    One scan, whatever the number of headers: Spark reads the fields by
    position and drops every file's first line; the file's header, from a
    table of one row a file (16 bytes, broadcast), then tells which position
    holds which name.  The headers come from a look at the files' starts.
    Of a name that a header repeats the first column counts.
    ``all_string`` gives '' for missing fields of short rows."""
    from sparkfolio.operators.rows import with_scan_position

    files = _file_headers(spark, paths)
    if files is None:
        return None
    headers = {h: _header_names(h) for h in sorted(r[0] for r in files.select("_header").distinct().collect())}
    fill = (lambda c: F.coalesce(c, F.lit(""))) if all_string else (lambda c: c)
    width = max(map(len, headers.values()), default=0)
    # one field more than is used: the parser then picks fields and takes short rows as they are
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width + 1)])
    rows = spark.read.options(**_CSV).schema(schema).csv(paths).withColumn("_fid", F.xxhash64("_metadata.file_path"))
    if position_col:
        rows = with_scan_position(rows, position_col)
    names = list(dict.fromkeys(n for h in headers.values() for n in h))
    keep = [F.col(position_col)] if position_col else []
    if len(headers) < 2:
        return rows.select(*[fill(F.col(f"_c{i}")).alias(n) for n, i in ((n, next(iter(headers.values())).index(n)) for n in names)], *keep)
    number = F.create_map(*[x for i, h in enumerate(headers) for x in (F.lit(h), F.lit(i))])
    files = (files.groupBy(F.xxhash64("_file").alias("_fid")).agg(F.min("_header").alias("_header"), F.max("_header").alias("_other"))
             .select("_fid", F.when(F.col("_header") == F.col("_other"), number[F.col("_header")]).otherwise(F.raise_error("two files with one hash").cast("int")).alias("_h")))
    rows = rows.join(F.broadcast(files), "_fid", "left").withColumn("_h", F.coalesce("_h", F.raise_error("a file without a header").cast("int")))
    cells = []
    for n in names:
        places: dict[int, list[int]] = {}
        for i, h in enumerate(headers.values()):
            if n in h:
                places.setdefault(h.index(n), []).append(i)
        cell = F
        for at, of in sorted(places.items()):
            cell = cell.when(F.col("_h").isin(of), fill(F.col(f"_c{at}")))
        cells.append(cell.alias(n))
    return rows.select(*cells, *keep)


def read_csv_glob(spark: SparkSession, patterns: list[str], schema=None,
                  all_string: bool = False, position_col: str | None = None,
                  same_header: bool = False) -> DataFrame:
    """S3: first pattern with hits wins; files are unioned by column name
    (a single multi-path read would bind columns by position).  Columns are
    text unless ``schema`` is given, which all files then share.
    ``position_col`` attaches a (file, block, row) order key per file, the
    order that keep-first de-duplication (W3) follows.
    ``same_header=True`` is for part files of one writer: no look at the other
    files' headers."""
    from sparkfolio.operators.rows import with_scan_position

    for pat in patterns:
        if not same_header and schema is None:
            df = read_csv_by_name(spark, pat, all_string, position_col)
            if df is not None:
                return df
            continue
        try:
            fields = schema if schema is not None else T.StructType([T.StructField(n, T.StringType()) for n in csv_header(spark, pat)])
            # Spark expands the glob itself: the file list never reaches the driver
            df = spark.read.options(**_CSV).schema(fields).csv(pat)
        except AnalysisException:
            continue
        df = with_scan_position(df, position_col) if position_col else df
        return df.na.fill("") if all_string else df
    raise FileNotFoundError(f"no files match any of {patterns}")


def read_optional_csv(spark: SparkSession, candidates: list[str],
                      schema: T.StructType) -> DataFrame:
    """First existing candidate, else an empty frame with ``schema``."""
    for c in candidates:
        if exists(spark, c):
            return read_csv_typed(spark, c, schema)
    return spark.createDataFrame([], schema)


def read_statement_globs(spark: SparkSession, dirs: list[str],
                         suffixes=("_IS_raw.csv", "_BS_raw.csv", "_CF_raw.csv"),
                         schema=None) -> DataFrame | None:
    """Per-statement globs, first directory with hits wins, else None; all
    statements' files come from one scan, aligned by name."""
    for d in dirs:
        globs = [g for g in (f"{d.rstrip('/')}/*{s}" for s in suffixes) if exists(spark, g)]
        if globs:
            if schema is not None:
                return read_csv_typed(spark, globs, schema)
            return read_csv_by_name(spark, globs)
    return None


def read_status_payload(spark: SparkSession, path, row_schema: T.StructType,
                        ok_status: str = "000", multi_line: bool = True) -> DataFrame:
    """JSON payloads ``{status, list:[...]}``; keep status == ok, explode.
    One payload a file, or one a line with ``multi_line=False``."""
    schema = T.StructType([T.StructField("status", T.StringType()),
                           T.StructField("list", T.ArrayType(row_schema))])
    df = spark.read.option("multiLine", multi_line).schema(schema).json(path)
    return (df.where(F.col("status") == ok_status)
              .select(F.explode("list").alias("r")).select("r.*"))


def read_xml_rows(spark: SparkSession, path, row_tag: str = "list",
                  fields=("corp_code", "corp_name", "stock_code")) -> DataFrame:
    """XML, one row per ``row_tag`` element, text fields as strings."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def price_history(df: DataFrame, start: str, end: str, date_col: str = "date",
                  value_col: str = "high", keep: list[str] | None = None,
                  require_rows: bool = False) -> DataFrame:
    """[start, end) date range of one price column.  ``require_rows``
    raises ValueError on an empty range (a one-row probe job); by default the
    check is left to the caller's action."""
    d = F.col(date_col)
    out = (df.where((d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date")))
             .select(*(keep or []), d.alias("date"), F.col(value_col).alias("high")))
    if require_rows and out.isEmpty():
        raise ValueError(f"no prices from {start} to {end}")
    return out
