"""Ranked lexical search by the Best Position Algorithm.

A shard is a bounded number of postings of some documents.  For each term it
holds an impact list: its documents, highest impact first, and where each
document stands in it.  A query reads its terms' lists from the top, in steps
of doubling size; a document met for the first time is looked up directly in
all the other lists, which gives its score and marks its position in each.  A
list's best position is the last one up to which all positions are marked, by
either kind of access; the impacts there bound the score of every document not
met yet, and closer than the impacts last read do.  A query stops once that
bound is strictly below its k-th score, so equal scores are all met.

Scores need counts over all documents: one pass writes each document's length
and its counts of query terms, from which the totals are summed; the second
pass ranks.  A task hands its k-th scores on from shard to shard.  Items come in
blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sparkfolio.llm.store import saved
from sparkfolio.llm.textarrays import text_slices
from sparkfolio.llm.toprank import top_rows
from sparkfolio.llm.wordcodes import TERM, coded, lowered, parts, terms

TOP = 10
SHARD_POSTINGS = 2_000_000      # postings that a task ranks at a time, about
BLOCK_BYTES = 4 << 20           # items' text sent to the executors at a time, about
STEP = 16                       # positions of each list that the first step reads


def term_counts(column: pa.Array, vocabulary: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of some texts at a time: the first one's row, each one's number of
    terms, and for each (text, known term) that occurs the text, the term's
    place in ``vocabulary`` and how often."""
    v = len(vocabulary) + 1
    for whole in text_slices(column):
        length, keys, counts = np.zeros(len(whole), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for texts in parts(lowered(whole), ~TERM):
            starts, ends, owner = terms(texts)
            code, names = coded(texts.data, starts, ends)
            length += np.bincount(owner, minlength=len(texts))
            known = pc.fill_null(pc.index_in(names, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
            key, n = np.unique((owner * v + known)[known >= 0], return_counts=True)
            keys, inverse = np.unique(np.concatenate([keys, key]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        text, term = np.divmod(keys, v)
        yield whole.first, length, text, term, counts


def _postings(shared, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, length, text, term, tf in term_counts(b["text"], shared.value):
                ends = pa.array(np.searchsorted(text, np.arange(len(length) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b["id"].slice(first, len(length)).cast(id_type), pa.array(length), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf))],
                    ["id", "length", "terms", "tf"])
    return run


class Shard:
    """The impact lists of some documents, end to end by term."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.n_docs = n_docs
        # where each (term, document) stands, for direct access
        key = term[order] * n_docs + self.doc
        self.by_key = np.argsort(key)
        self.keys = key[self.by_key]
        self.scored = np.zeros(n_docs, bool)

    def best(self, query: np.ndarray, weight: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that hold the k highest above 0, and all that
        tie with the k-th.  What is below ``floor`` may be left out."""
        lists = np.flatnonzero((self.start[query + 1] > self.start[query]) & (weight > 0))
        query, weight = query[lists], weight[lists]
        begin, end = self.start[query], self.start[query + 1]
        seen = [np.zeros(z - a, bool) for a, z in zip(begin, end)]
        position = np.zeros(len(query), np.int64)          # all before it are marked
        docs, scores, read, step = [], [], 0, STEP
        while len(query):
            rows = np.concatenate([np.arange(min(a + read, z), min(a + read + step, z)) for a, z in zip(begin, end)])
            read, step = read + step, step * 2
            new = np.unique(self.doc[rows])
            new = new[~self.scored[new]]
            self.scored[new] = True
            if len(new):
                key = query[:, None] * self.n_docs + new[None]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                there = self.keys[at] == key
                at = self.by_key[at]
                docs.append(new)
                scores.append((weight[:, None] * np.where(there, self.impact[at], 0)).sum(0))
                for i in range(len(query)):
                    seen[i][at[i][there[i]] - begin[i]] = True
            for i, s in enumerate(seen):
                if position[i] < len(s):
                    rest = s[position[i]:]
                    gap = int(np.argmin(rest))
                    position[i] += gap if not rest[gap] else len(rest)
            # nothing unseen is in a list that is all marked; before the first mark there is no bound
            left = position < end - begin
            if not left.any():
                break
            if (position > 0).all():
                bound = int((weight * np.where(left, self.impact[begin + position - 1], 0)).sum())
                kth = floor
                if sum(map(len, scores)) >= k:
                    s = np.concatenate(scores)
                    kth = max(kth, int(np.partition(s, len(s) - k)[len(s) - k]))
                if bound < kth:
                    break
        docs, scores = np.concatenate([np.zeros(0, np.int64), *docs]), np.concatenate([np.zeros(0, np.int64), *scores])
        self.scored[docs] = False
        good = scores >= max(1, floor)
        docs, scores = docs[good], scores[good]
        if len(scores) > k:
            good = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            docs, scores = docs[good], scores[good]
        return docs, scores


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What ``tf`` of a term in a document of so many terms counts; whole numbers throughout."""
    lengths, of = np.unique(length, return_inverse=True)
    m = np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)[of]
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _rank(shared, k: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_terms, weight, queries = shared.value
        floor = [0] * len(queries)
        kept: list[list[int]] = [[] for _ in queries]

        def ranked(some: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(some).combine_chunks()
            ids = rows["id"].combine_chunks()
            by_id = np.empty(len(ids), np.int64)
            by_id[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
            size = pc.list_value_length(rows["terms"]).to_numpy().astype(np.int64)
            term, tf = (rows[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "tf"))
            doc = np.repeat(np.arange(len(ids)), size)
            shard = Shard(doc, term, impacts(tf, np.repeat(rows["length"].to_numpy(), size), n_docs, n_terms), len(ids), len(weight))
            items, docs, scores = [], [], []
            for i, query in enumerate(queries):
                d, s = shard.best(query, weight[query], k, floor[i])
                first = np.lexsort((by_id[d], -s))[:k]
                items.append(np.full(len(first), i))
                docs.append(d[first])
                scores.append(s[first])
                kept[i] = sorted(kept[i] + s[first].tolist(), reverse=True)[:k]
                floor[i] = kept[i][-1] if len(kept[i]) == k else 0
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(items), pa.int64()), ids.take(pa.array(np.concatenate(docs))).cast(id_type), pa.array(np.concatenate(scores), pa.int64())],
                                              ["item", "id", "score"])

        some, n = [], 0
        for b in batches:
            some.append(b)
            n += len(b["terms"].flatten())
            if n >= SHARD_POSTINGS:
                yield ranked(some)
                some, n = [], 0
        if some and queries:
            yield ranked(some)
    return run


def search(documents: DataFrame, benchmark: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Columns ``item`` (the item's id), ``rank`` (from 1), ``id`` and
    ``score``: for each item its ``k`` highest-scoring documents with a score
    above 0, equal scores by ascending id, null ids last.

    Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower
    case.  N documents hold a term, L terms in all, df documents a certain one.
    A document of n terms scores the sum, over the item's distinct terms, of
    floor(1000 * ln((2 * N + 2) / (2 * df + 1))) * ((10**9 * tf) div (1000 * tf
    + 8 * m)), with m = 10 + (90 * n * N) div L.

    Null and empty texts have no terms and are neither counted nor found; an
    item without terms, or with none that occurs, gives no rows.  Item rows
    with one id, a null one too, are one item with the terms of all.  Each
    document row is a document of its own, also with an id or a text that
    occurs again.  Texts of any length are taken in parts.  Other columns are
    not read.
    """
    spark = documents.sparkSession
    id_field = documents.select(F.col(f"`{id_col}`").alias("id")).schema["id"]
    item_field = benchmark.select(F.col(f"`{item_col}`").alias("item")).schema["item"]
    out = T.StructType([T.StructField("item", item_field.dataType), T.StructField("rank", T.IntegerType()), T.StructField("id", id_field.dataType), T.StructField("score", T.LongType())])
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    tests = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text}`").alias("text")).where(F.length("text") > 0)
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    found = None
    for block in range(blocks):
        mine = tests.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        part = _block(texts, mine, k, T.StructType([T.StructField("item", T.LongType()), id_field, T.StructField("score", T.LongType())]))
        if part is not None:
            rows, ids = part
            names = spark.createDataFrame(pa.table({"place": pa.array(np.arange(len(ids)), pa.int64()), "name": ids}), T.StructType([T.StructField("place", T.LongType()), T.StructField("name", item_field.dataType)]))
            rows = rows.join(names, F.col("item") == F.col("place")).select(F.col("name").alias("item"), F.col("rank").cast("int").alias("rank"), "id", "score")
            found = rows if found is None else found.unionByName(rows)
    return found if found is not None else spark.createDataFrame([], out)


def _block(texts: DataFrame, mine: pa.Table, k: int, schema: T.StructType) -> tuple[DataFrame, pa.Array] | None:
    """The best documents of one block's items, by the items' place in the second result."""
    spark = texts.sparkSession
    d = mine["item"].combine_chunks().dictionary_encode(null_encoding="encode")
    place, ids = d.indices.to_numpy(zero_copy_only=False), d.dictionary
    item_terms: list[set[int]] = [set() for _ in range(len(ids))]
    vocabulary: dict[bytes, int] = {}
    for i, text in zip(place.tolist(), mine["text"].to_pylist()):
        for whole in text_slices(pa.array([text], pa.large_string())):
            low = lowered(whole)
            starts, ends, _ = terms(low)
            code, names = coded(low.data, starts, ends)
            names = names.to_pylist()
            item_terms[i] |= {vocabulary.setdefault(names[c], len(vocabulary)) for c in np.unique(code).tolist()}
    if not vocabulary:
        return None
    words = spark.sparkContext.broadcast(pa.array(list(vocabulary), pa.large_binary()))
    id_type = to_arrow_type(schema["id"].dataType)
    counted = T.StructType([schema["id"], T.StructField("length", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.LongType()))])
    postings = saved(texts.mapInArrow(_postings(words, id_type), counted), "postings")
    total = postings.where(F.col("length") > 0).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = total["n"], total["l"]
    if not n_terms:
        return None
    # a row a query term
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = df.select("term", F.floor(F.lit(1000) * F.ln(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1))).cast("long").alias("w")).toArrow()
    weight = np.zeros(len(vocabulary), np.int64)
    weight[df["term"].to_numpy()] = df["w"].to_numpy()
    queries = [np.array(sorted(t), np.int64) for t in item_terms]
    shared = spark.sparkContext.broadcast((n_docs, n_terms, weight, queries))
    best = saved(postings.where(F.size("terms") > 0).mapInArrow(_rank(shared, k, id_type), schema), "ranked")
    return top_rows(best, ["item"], [F.col("score").desc(), F.col("id").asc_nulls_last()], k), ids

