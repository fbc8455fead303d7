"""Materialised pipeline stages: build once, read many.

A stage table (the merged daily activity table, the per-(nation, year)
statement sums, the daily price series, the text features of labelled
documents) is written as Parquet under the shared checkpoint folder, keyed by
the stage name and the metadata (path, size, modification time) of the input
files.  Every later query that needs the stage reads the small table instead
of re-scanning and re-aggregating the large inputs - the role the
CREATE TABLE AS statement and the processed CSV files play in the reference
pipelines.  New input files give a new key, so a stale stage is never read.
A stage without its completion marker (an interrupted write) is rebuilt; a
marker names the folder it stands for, so drivers can build at once.  Folders
of superseded keys stay until the launcher clears the shared folder.
"""

from __future__ import annotations

import hashlib
import importlib
import os
import pkgutil
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.session import ensure_checkpoint_dir
from sparkfolio.sources.sinks import write_csv, write_json, write_split
from sparkfolio.sources.tables import table_path


_CODE_KEY: str | None = None


def code_key() -> str:
    """Fingerprint of the packages that stages are made by: a stage built by
    other code is never read back.  The sources come from the modules' loader,
    so a zipped package has them too."""
    global _CODE_KEY
    if _CODE_KEY is None:
        h = hashlib.md5()
        for name in ("functions", "operators", "plans", "sources"):
            package = importlib.import_module(f"sparkfolio.{name}")
            for m in sorted(pkgutil.iter_modules(package.__path__, package.__name__ + "."), key=lambda m: m.name):
                source = m.module_finder.find_spec(m.name).loader.get_source(m.name)
                if source is None:
                    raise RuntimeError(f"no source of {m.name} to key stage tables on")
                h.update(m.name.encode() + source.encode())
        _CODE_KEY = h.hexdigest()[:12]
    return _CODE_KEY


def input_key(spark: SparkSession, sf: str, tables: list[str]) -> str:
    """Fingerprint of the input files (count, total size, latest change and an
    order-free sum of per-file hashes), aggregated on the executors: a table of
    a million files returns one row to the driver, not its listing."""
    files = spark.read.format("binaryFile").load([table_path(sf, t) for t in tables])
    h = F.xxhash64("path", "length", F.col("modificationTime").cast("long"))
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                  F.max("modificationTime").cast("string").alias("mtime"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("h")).first()
    return hashlib.md5(f"{code_key()}|{sf}|{tables}|{tuple(r)}".encode()).hexdigest()


NAMESPACE_CONF = "sparkfolio.stages.namespace"


def stage_root(spark: SparkSession, kind: str) -> str:
    """Folder for stage tables; an optional namespace (e.g. one per benchmark
    run) keeps runs from reusing each other's stages."""
    ns = spark.conf.get(NAMESPACE_CONF, "") or ""
    return os.path.join(ensure_checkpoint_dir(spark), kind, ns) if ns else \
        os.path.join(ensure_checkpoint_dir(spark), kind)


def _published(spark: SparkSession, marker: str) -> str | None:
    """The folder that a marker names, if there is one."""
    try:
        return spark.read.schema("path string").json(os.path.join(marker, "*.json")).agg(F.min("path")).first()[0]
    except AnalysisException:
        return None


#: Folders already looked up, by application and base.
_PATHS: dict[tuple[str, str], str] = {}


def _once(spark: SparkSession, base: str, write: Callable[[str], None]) -> str:
    """The folder with what ``write`` made for ``base``, made if need be.

    It is written under a path of its own and published by a marker that names
    it, after the data.  Drivers that build the same thing at once do not touch
    each other's files: all then read the folder whose name sorts first.  An
    unfinished write is never named."""
    marker = base + ".done"
    known = (spark.sparkContext.applicationId, base)
    if known in _PATHS:         # published folders do not change
        return _PATHS[known]
    found = _published(spark, marker)
    if found is None:
        path = f"{base}-{uuid.uuid4().hex}"
        write(path)
        spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("append").json(marker)
        found = _published(spark, marker)
    _PATHS[known] = found
    return found


def stage(spark: SparkSession, sf: str, name: str, tables: list[str],
          build: Callable[[], DataFrame]) -> DataFrame:
    base = os.path.join(stage_root(spark, "stages"), f"{name}-{input_key(spark, sf, tables)}")
    return spark.read.parquet(_once(spark, base, lambda path: build().write.parquet(path)))


def landed(spark: SparkSession, sf: str, name: str, tables: list[str], write: Callable[[str], None]) -> str:
    """Write derived files once per input version and return their folder."""
    return _once(spark, os.path.join(stage_root(spark, "landed"), f"{name}-{input_key(spark, sf, tables)}"), write)


def landed_csv(spark: SparkSession, sf: str, name: str, tables: list[str],
               build: Callable[[], DataFrame]) -> str:
    """Land a derived table as header CSV files (S11) and return the folder:
    the raw-file landing zone of a CSV pipeline."""
    return landed(spark, sf, name, tables, lambda path: write_csv(build(), path))


def landed_split(spark: SparkSession, sf: str, name: str, tables: list[str],
                 build: Callable[[], DataFrame], by: list[str]) -> str:
    """Land a derived table as header CSV files split into one folder per key
    combination (S12) and return the root folder."""
    return landed(spark, sf, name, tables, lambda path: write_split(build(), path, by))


def landed_json(spark: SparkSession, sf: str, name: str, tables: list[str],
                build: Callable[[], DataFrame]) -> str:
    """Land a derived table as JSON lines and return the folder."""
    return landed(spark, sf, name, tables, lambda path: write_json(build(), path))


def landed_xml(spark: SparkSession, sf: str, name: str, tables: list[str],
               build: Callable[[], DataFrame], row_tag: str) -> str:
    """Land a derived table as XML, one element a row, and return the folder."""
    return landed(spark, sf, name, tables, lambda path: build().write.mode("overwrite").format("xml").option("rowTag", row_tag).option("rootTag", "result").save(path))
