"""ST1: score arriving request files with a Structured Streaming query.

Each request is one JSON document ``{request_id, records: [...]}``; a request
without a non-empty ``records`` list yields one error row, every record of a
valid request yields (probability, label).  The query is stateless (explode +
expressions), reads files with a declared schema, writes an append-only
Parquet sink with a checkpoint in the cluster's shared checkpoint folder, and
is run with ``availableNow`` so a batch backlog drains and the query stops;
rerunning it against the same checkpoint processes only new files.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.operators.ml import score_from_params

RECORD_FIELDS = ["n_chars", "n_words", "n_lines", "lang", "source"]
REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("records", T.ArrayType(T.StructType(
        [T.StructField(f, T.StringType()) for f in RECORD_FIELDS]))),
])
# Fixed value: the rejection message of an invalid request.
INVALID_REQUEST = "Invalid input: Request must contain a non-empty 'records' list."


def requests_from_documents(spark: SparkSession, sf: str, out_dir: str | None = None) -> str:
    """Land one request per document as JSON lines (derived from the tables,
    once per input version): toxic-labelled documents become empty (invalid)
    requests."""
    from sparkfolio.plans.churn import doc_features
    from sparkfolio.plans.stages import landed_json
    from sparkfolio.sources.tables import load

    def requests() -> DataFrame:
        toxic = load(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id").distinct().withColumn("toxic", F.lit(1))
        d = doc_features(spark, sf).join(toxic, "doc_id", "left")
        rec = F.struct(*[F.col(f).cast("string").alias(f) for f in RECORD_FIELDS])
        return d.select(F.col("doc_id").alias("request_id"),
                        F.when(F.col("toxic") == 1, F.array().cast(REQUEST_SCHEMA["records"].dataType))
                         .otherwise(F.array(rec)).alias("records"))

    if out_dir is None:
        return landed_json(spark, sf, "requests", ["documents", "labels"], requests)
    requests().write.mode("overwrite").json(out_dir)
    return out_dir


def scoring_stream(spark: SparkSession, req_dir: str, params: dict) -> DataFrame:
    """The streaming DataFrame: request rows in, score / error rows out."""
    src = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", 64).json(req_dir)
    n = F.coalesce(F.size("records"), F.lit(0))
    ok = (src.where(n > 0)
             .select("request_id", F.posexplode("records").alias("record_idx", "r"))
             .select("request_id", "record_idx", "r.*"))
    scored = score_from_params(ok, params).select(
        "request_id", "record_idx", "probability", "label",
        F.lit(None).cast("string").alias("error"))
    bad = src.where(n == 0).select(
        "request_id", F.lit(None).cast("int").alias("record_idx"),
        F.lit(None).cast("double").alias("probability"), F.lit(None).cast("int").alias("label"),
        F.lit(INVALID_REQUEST).alias("error"))
    return scored.unionByName(bad)


def run_scoring_stream(spark: SparkSession, req_dir: str, params: dict,
                       sink_dir: str | None = None, checkpoint: str | None = None) -> DataFrame:
    # one sink and checkpoint for these requests and parameters: a rerun takes only new files
    version = hashlib.md5(json.dumps(params, sort_keys=True).encode()).hexdigest()[:12]
    sink_dir = sink_dir or f"{req_dir.rstrip('/')}.scores-{version}"
    checkpoint = checkpoint or f"{req_dir.rstrip('/')}.scores-ckpt-{version}"
    q = (scoring_stream(spark, req_dir, params).writeStream
         .format("parquet").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink_dir)
