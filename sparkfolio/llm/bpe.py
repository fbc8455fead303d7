"""Byte-level BPE encoding by overlapping chunks, and decoding.

A long text is cut into chunks that are pre-tokenised independently, each one
running a little into the next.  Where the boundaries of a chunk's run and
those of its predecessor's first coincide, both runs are the same from there
on, so the text is cut at that point: the pieces between such points contain
whole pre-tokens and are encoded independently, on any executor.  Decoding
concatenates the tokens' raw bytes.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.llm.store import saved

CHUNK = 16_384          # characters; longer texts take the chunked path
OVERLAP = 512           # characters a chunk's run goes into the next chunk
#: The cut points of so many chunks (8 bytes each, and 30 a text) are broadcast.
BROADCAST_CHUNKS = 2_000_000
ROWS = 300              # rows that a task encodes or decodes before it hands them on
LONG_SPACE = 50_000     # white-space characters in a row from which texts are pre-tokenised here
SPACES = regex.compile(r"\s{%d}" % LONG_SPACE)
MULTI_50K = "byte_bpe_multi_50k.tiktoken"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _Shared:
    """The ranks, sent once to each executor; each worker builds its encoder once."""

    def __init__(self, spark, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = spark.sparkContext.broadcast(ranks), pattern

    def encoding(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks.value, special_tokens={})


def encode_text(encoder: tiktoken.Encoding, pattern: regex.Pattern, text: str) -> list[int]:
    """``encoder.encode_ordinary``, also where white space goes on so long that
    the library's own pattern search has no stack left: ``pattern``, the
    encoder's, then finds the pre-tokens, and each is merged on its own."""
    if len(text) < LONG_SPACE or not SPACES.search(text):
        return encoder.encode_ordinary(text)
    return [i for m in pattern.finditer(text) for i in encoder._encode_single_piece(m.group().encode())]


def boundaries(text: str, pattern: regex.Pattern, ended: bool) -> np.ndarray:
    """Ends of the pre-tokens of ``text``.  If more text follows
    (``ended`` false), the last two ends are not known yet and left out."""
    ends = [m.end() for m in pattern.finditer(text)]
    return np.array(ends if ended else ends[:-2], np.int64)


def sync_points(chunks: list[tuple[int, list[int], list[int]]], chunk: int) -> list[int] | None:
    """Where each chunk's piece begins, as positions in the whole text.

    ``chunks``: (number, head, tail) in order; head and tail are the
    boundaries, relative to the chunk, that its own run found within OVERLAP
    characters of its start and of the next chunk's start.  None if some pair
    of runs never meets there (a single pre-token longer than the overlap)."""
    points = [0]
    for (i, _, tail), (j, head, _) in zip(chunks, chunks[1:]):
        later = {chunk + h for h in head}
        meet = next((t for t in tail if t in later), None)
        if meet is None:
            return None
        points.append(i * chunk + meet)
    return points


def encode(df: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Columns ``record`` (the row) and ``ids`` (array<int>): the text's ids by
    the ranks in ``path``, each match of ``pattern`` merged on its own,
    without special tokens.

    Null and empty texts have no ids.  Texts longer than ``chunk`` characters
    are spread over tasks by chunk; one that never resynchronises (a pre-token
    longer than ``overlap`` across a cut) is encoded as one piece, runs of
    millions of spaces, line breaks or letters too.  Repeated
    rows each keep their ids; extra columns of any name stay in ``record``.
    """
    spark = df.sparkSession
    shared = _Shared(spark, read_ranks(path or public_tokenizers.path(MULTI_50K)), pattern)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    record = T.StructField("record", rows.schema["record"].dataType)
    is_long = F.length("text") > chunk
    short = rows.where(~is_long).mapInArrow(_encode_texts(shared), T.StructType([record, T.StructField("ids", T.ArrayType(T.IntegerType()))]))

    # each chunk of a long text is a row; the record goes with the first one
    numbered = rows.where(is_long).withColumn("row", F.monotonically_increasing_id())
    cut = numbered.select("row", "record", "text", F.posexplode(
        F.sequence(F.lit(1), F.length("text"), F.lit(chunk))).alias("i", "at")).select(
            "row", "i", F.when(F.col("i") == 0, F.col("record")).alias("record"),
            F.expr(f"substring(text, at, {chunk + overlap})").alias("part"),
            (F.col("at") + chunk + overlap > F.length("text")).alias("ended"))
    spread = cut.repartition(F.col("row"), F.col("i"))
    ints = T.ArrayType(T.LongType())
    fields = [T.StructField("row", T.LongType()), T.StructField("i", T.IntegerType()), record, T.StructField("part", T.StringType())]
    runs = saved(spread.mapInArrow(_pretokenise(pattern, chunk, overlap), T.StructType(
        fields + [T.StructField("head", ints), T.StructField("tail", ints)])), "bpe-chunks")

    @F.pandas_udf(ints)
    def stitched(chunks):
        return chunks.map(lambda cs: sync_points([(c["i"], list(c["head"]), list(c["tail"])) for c in cs], chunk))

    points = (runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("i", "head", "tail"))).alias("runs"))
              .select("row", stitched("runs").alias("points")))
    if runs.count() <= BROADCAST_CHUNKS:
        points = F.broadcast(points)            # else the chunks are shuffled to them
    parts = runs.select("row", "i", "record", "part").join(points, "row")
    start, stop = F.get("points", F.col("i")) - F.col("i") * chunk, F.get("points", F.col("i") + 1) - F.col("i") * chunk
    piece = F.expr("substring(part, int(start) + 1, int(coalesce(stop, length(part)) - start))")
    good = parts.where(F.col("points").isNotNull()).withColumn("start", start).withColumn("stop", stop).select("row", "i", "record", piece.alias("text"))
    whole = (parts.where(F.col("points").isNull()).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("i", F.expr(f"substring(part, 1, {chunk})").alias("p")))).alias("ps"),
        F.max_by("record", -F.col("i")).alias("record"))
        .select("row", F.lit(0).alias("i"), "record", F.array_join(F.transform("ps", lambda p: p["p"]), "").alias("text")))
    coded = good.unionByName(whole).mapInArrow(_encode_texts(shared), T.StructType(
        fields[:3] + [T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    long = (coded.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("i", "ids"))).alias("ps"), F.max_by("record", -F.col("i")).alias("record"))
            .select("record", F.flatten(F.transform("ps", lambda p: p["ids"])).alias("ids")))
    return short.unionByName(long)


def _list_of_int32(parts: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    values = np.concatenate([np.zeros(0, np.int32), *parts])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def _encode_texts(shared: _Shared):
    """All columns but ``text`` as they are, then ``ids``."""
    def run(batches):
        encoder, pattern = shared.encoding(), regex.compile(shared.pattern)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                x = b.slice(at, ROWS)
                ids = [np.array(encode_text(encoder, pattern, t), np.int32) for t in x["text"].to_pylist()]
                keep = [c for c in x.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*[x[c] for c in keep], _list_of_int32(ids)], [*keep, "ids"])
    return run


def _pretokenise(pattern: str, chunk: int, overlap: int):
    def run(batches):
        compiled = regex.compile(pattern)
        for b in batches:
            heads, tails = [], []
            for part, ended in zip(b["part"].to_pylist(), b["ended"].to_pylist()):
                found = boundaries(part, compiled, ended)
                heads.append(found[found <= overlap])
                tails.append(found[found >= chunk])
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["row"], b["i"], b["record"], b["part"], pa.array([h.tolist() for h in heads], lists), pa.array([t.tolist() for t in tails], lists)],
                ["row", "i", "record", "part", "head", "tail"])
    return run


def decode(df: DataFrame, path: str | None = None, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the tokens' bytes end to end (null ids: none)."""
    ranks = read_ranks(path or public_tokenizers.path(MULTI_50K))
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        table[i] = token
    shared = df.sparkSession.sparkContext.broadcast(table)
    keep = [f for f in df.schema.fields if f.name != out_col]

    def run(batches):
        token = shared.value.__getitem__
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                x = b.slice(at, ROWS)
                ids = x[ids_col]
                size = np.asarray(pc.fill_null(pc.list_value_length(ids), 0))
                flat, ends = ids.flatten().to_pylist(), np.cumsum(size)
                texts = [b"".join(map(token, flat[z - n:z])) for z, n in zip(ends.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays([*[x[f.name] for f in keep], pa.array(texts, pa.binary())], [*[f.name for f in keep], out_col])

    return df.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in keep] + [T.StructField(out_col, T.BinaryType())]))
