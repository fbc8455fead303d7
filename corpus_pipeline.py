"""The corpus pipeline: five stages over ``documents``, each written as Parquet
in the shared folder and read back by the next.

Every stage works on all rows its predecessor kept.  All but the last return
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.llm.jaccard_join import link_components
from sparkfolio.llm.langid import UND, identify
from sparkfolio.llm.line_dedup import dedup_lines
from sparkfolio.llm.packing import pack, token_pieces
from sparkfolio.llm.store import saved
from sparkfolio.llm.toxicity import classify

#: A text of PARSED characters or more that needs a phrase for every two of them or so is in
#: none of the learned languages (theirs need one for every six).
PARSED, DENSITY = 50, 0.45


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier calls toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels).where(F.col("predicted") == 0).select("record.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts in no learned language; a
    missing ``lang`` is filled with the prediction."""
    said = identify(docs).where((F.col("lang_pred") != UND) & ~((F.col("n_parsed") >= PARSED) & (F.col("density") > DENSITY)))
    return said.select(*[F.coalesce("record.lang", "lang_pred").alias(c) if c == "lang" else F.col(f"record.`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that occurred before; ``n_chars`` follows the text."""
    left = dedup_lines(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*[new[c].alias(c) if c in new else F.col(f"record.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the smallest id
    (of repeated rows, one); texts without words are linked with nothing and stay."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("i"))
    name = "_row"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    linked = link_components(docs.withColumn(name, row), id_col=name, carry_text=True)
    return linked.where(F.col("component_id") == F.col(f"record.{name}")).select(*[F.col(f"record.`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences: one row a piece."""
    return pack(token_pieces(docs.select("doc_id", "text"))).select(
        "row.record.doc_id", "row.piece", "row.start", "row.length", "row.ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("language", language), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("packing", packing)]

#: The learned stages have no SQL form; tests check each stage against brute force or held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
