"""Two-pass external shuffle into shards.

Pass one scatters the records by a seeded hash into buckets that each fit in
one task's memory; pass two gives every bucket a Fisher-Yates shuffle and
writes it.  The buckets end to end are then one random order of the whole
input, which is cut into shards whose row counts differ by one at most.
DataFrame functions only; nothing but one row of totals reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.llm.store import saved

BUCKET_BYTES = 16 << 20
#: So many buckets' start positions (12 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_BUCKETS = 500_000


def external_shuffle(df: DataFrame, n_shards: int = 8, seed: int = 42,
                     text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Columns ``record`` (the input row as a struct), ``shard`` (0 to
    n_shards - 1) and ``slot`` (gapless from 0 in each shard).

    A bucket holds ``bucket_bytes`` of text on average: the number of buckets
    grows with the input.  The scatter hashes the seed and the row's position
    in the scan, so equal rows, null keys or a hot key spread like any others.
    Rows are placed once and written; shards and slots are read from that
    table, so a lost executor cannot place a row twice.

    Null or empty texts count one byte.  A text longer than a bucket makes its
    own bucket as large as the text.  Repeated rows keep a place each.  An
    empty input gives no rows.  Extra columns of any name stay in ``record``.
    """
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1
    total = df.agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    n, n_buckets = total["n"], max(1, math.ceil((total["bytes"] or 0) / bucket_bytes))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"),
                     F.monotonically_increasing_id().alias("key"))
    # pass one: bucket b is task b, so its generator below starts from the seed and b alone
    scattered = (rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(n_buckets)).cast("int"))
                 .repartitionById(n_buckets, F.col("bucket")))
    # pass two: the order before the shuffle is fixed by the key, not by arrival
    by_key = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    buckets = scattered.groupBy("bucket").agg(F.collect_list(F.struct("key", "record")).alias("rows"))
    shuffled = buckets.select("bucket", F.posexplode(F.shuffle(F.array_sort("rows", by_key), F.lit(seed))).alias("pos", "row"))
    placed = saved(shuffled.select("bucket", "pos", F.col("row.record").alias("record")), "shuffled")
    # where each bucket begins: one row a bucket
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"))
              .select("bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start")))
    if n_buckets <= BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    at = F.col("start") + F.col("pos")
    base, extra = divmod(n, n_shards)           # the first `extra` shards have one row more
    edge = extra * (base + 1)
    shard = F.when(at < edge, F.floor(at / F.lit(base + 1))).otherwise(F.lit(extra) + F.floor((at - edge) / F.lit(max(base, 1)))).cast("int")
    first = F.col("shard") * base + F.least(F.col("shard"), F.lit(extra))
    return (placed.join(starts, "bucket").withColumn("at", at).withColumn("shard", shard)
            .select("record", "shard", (F.col("at") - first).cast("long").alias("slot")))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order within each file."""
    (shuffled.select("record.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
     .repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
     .write.partitionBy("_shard").parquet(path))
