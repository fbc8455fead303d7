"""Exact top-k search on binary codes by incremental multi-index hashing.

A vector's code is the signs of its components.  Codes are cut into segments,
each indexed by value.  A query looks up its own segments, then all segment
values at distance 1, 2 and so on.  Once radius s is done in all m segments,
every code within m * (s + 1) - 1 has been seen, because some segment of it is
within s; the search stops when the k-th verified distance is no larger.

Equal codes are one entry with its k + 1 smallest ids.  The entries are dealt
over tasks, each with an index of its own part; the queries come in blocks of
bounded size, and every task returns its k best entries a query.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.llm.store import saved

QUERY_BLOCK = 100_000       # distinct query codes sent to the executors at a time
PART_CODES = 1_000_000      # distinct codes one task indexes, about


def sign_codes(vectors: pd.Series, n_bytes: int) -> list[bytes]:
    """Bit i is set where component i is above 0 (null: not); padded with 0 to ``n_bytes``."""
    out = []
    for v in vectors:
        bits = np.packbits(np.nan_to_num(np.asarray(v, np.float64)) > 0)
        out.append(bits.tobytes().ljust(n_bytes, b"\0"))
    return out


class MultiIndex:
    """Codes as rows of uint64 words, with a table of each segment's values."""

    def __init__(self, words: np.ndarray, n_bits: int):
        self.words, n = words, len(words)
        self.width = int(np.clip(round(np.log2(max(n, 2))), 4, 16))
        bits = np.unpackbits(words.view(np.uint8), axis=1)[:, :n_bits] if n else np.zeros((0, n_bits), np.uint8)
        self.cuts = [(a, min(a + self.width, n_bits)) for a in range(0, n_bits, self.width)]
        self.tables = []
        for a, z in self.cuts:
            value = bits[:, a:z] @ (1 << np.arange(z - a)[::-1])
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << (z - a)) + 1))))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def flips(self, width: int, s: int) -> np.ndarray:
        if (width, s) not in self.masks:
            self.masks[width, s] = np.array([sum(1 << i for i in c) for c in combinations(range(width), s)] or [], np.int64)
        return self.masks[width, s]

    def nearest(self, query: np.ndarray, query_bits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of at least the k nearest codes, and of all that tie with the k-th."""
        n, m = len(self.words), len(self.cuts)
        seen = np.zeros(n, bool)
        found, dist = [], []
        checked = 0
        for s in range(self.width + 1):
            fresh = []
            for (a, z), (order, starts) in zip(self.cuts, self.tables):
                values = (query_bits[a:z] @ (1 << np.arange(z - a)[::-1])) ^ self.flips(z - a, s)
                lo, hi = starts[values], starts[values + 1]
                for i in np.flatnonzero(hi > lo):
                    fresh.append(order[lo[i]:hi[i]])
            if fresh:
                at = np.concatenate(fresh)
                at = np.unique(at[~seen[at]])
                seen[at] = True
                found.append(at)
                dist.append(np.bitwise_count(self.words[at] ^ query).sum(1, dtype=np.int64))
                checked += len(at)
            covered = m * (s + 1) - 1
            if checked >= min(k, n):
                d = np.concatenate(dist)
                kth = np.partition(d, k - 1)[k - 1] if len(d) >= k else d.max(initial=0)
                if checked == n or kth <= covered:
                    near = d <= kth
                    return np.concatenate(found)[near], d[near]
        return np.concatenate(found or [np.zeros(0, int)]), np.concatenate(dist or [np.zeros(0, int)])


def _words(codes: list[bytes], n_bytes: int) -> np.ndarray:
    return np.frombuffer(b"".join(codes), np.uint8).reshape(-1, n_bytes).view(np.uint64) if codes else np.zeros((0, n_bytes // 8), np.uint64)


def top_k(vectors: DataFrame, k: int = 10, query_every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns ``query_id``, ``rank`` (1 to k), ``neighbor_id``, ``distance``:
    for each row whose id is divisible by ``query_every`` its k nearest other
    rows by (Hamming distance, id).

    Rows with a null id, a null or an empty vector are neither queries nor
    neighbours; a repeated id counts once, with its smallest code; shorter
    vectors have 0 bits at the end.  Fewer than k other rows give fewer ranks."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v")).where(F.col("id").isNotNull() & (F.size("v") > 0))
    n_bits = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(1)).alias("d")).first()["d"]
    n_bytes = -(-n_bits // 64) * 8

    @F.pandas_udf("binary")
    def code(v: pd.Series) -> pd.Series:
        return pd.Series(sign_codes(v, n_bytes))

    coded = saved(rows.select("id", code("v").alias("code")).groupBy("id").agg(F.min("code").alias("code")), "codes")
    # the k + 1 smallest ids of each code; limited before the shuffle, so a code of a third of all rows is no burden
    nth = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    entries = coded.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = saved(entries, "code-entries")
    n = entries.count()
    parts = saved(entries.repartition(max(spark.sparkContext.defaultParallelism, -(-n // PART_CODES)), "code"), "code-parts")
    asked = saved(coded.where(F.col("id") % query_every == 0).select("code").distinct(), "query-codes")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int"))
    found = None
    for block in sorted(r["block"] for r in asked.select("block").distinct().collect()):       # as many as queries / QUERY_BLOCK
        codes = [bytes(r["code"]) for r in asked.where(F.col("block") == block).select("code").toLocalIterator()]
        part = parts.mapInArrow(_search(spark.sparkContext.broadcast(codes), n_bits, n_bytes, k + 1), "query binary, distance long, ids array<long>")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query binary, distance long, ids array<long>")
    first = F.row_number().over(Window.partitionBy("query").orderBy("distance", F.col("ids")[0]))
    best = (found.withColumn("nth", first).where(F.col("nth") <= k + 1)
            .select("query", "distance", F.explode("ids").alias("neighbor_id")))
    queries = coded.where(F.col("id") % query_every == 0).select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    # a code's queries share its at most (k + 1) ** 2 nearest ids
    near = best.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbor_id"))).where(F.col("nth") <= k + 1)
    lists = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["neighbor_id"] != F.col("query_id")), 1, k)
    return (queries.join(lists, "query").select("query_id", F.posexplode(others).alias("pos", "x"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.neighbor_id").alias("neighbor_id"), F.col("x.distance").alias("distance")))


def _search(shared, n_bits: int, n_bytes: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ids = [], []
        for b in batches:
            codes += b["code"].to_pylist()
            ids.append(b["ids"])
        if not codes:
            return
        entry_ids = pa.chunked_array(ids).combine_chunks()
        first = np.array([x[0].as_py() for x in entry_ids])
        index = MultiIndex(_words(codes, n_bytes), n_bits)
        for query in shared.value:
            words = _words([query], n_bytes)
            at, dist = index.nearest(words[0], np.unpackbits(words.view(np.uint8), axis=1)[0, :n_bits].astype(np.int64), k)
            order = np.lexsort((first[at], dist))[:k]
            at, dist = at[order], dist[order]
            yield pa.RecordBatch.from_arrays([pa.array([query] * len(at), pa.binary()), pa.array(dist, pa.int64()), entry_ids.take(pa.array(at))], ["query", "distance", "ids"])
    return run
