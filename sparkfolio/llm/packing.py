"""Best-fit packing of token sequences by linear grouping.

Lengths are small whole numbers, so a histogram of them (one count a length)
says all that a packing needs.  On it: the large lengths are sorted and cut
into groups of equal cardinality, each rounded up to its largest; the few
rounded sizes are packed by configurations; each place is given to an actual
length of its group; the small lengths then go best-fit into what is left.
The plan is a table of runs (the r-th to s-th piece of some length go to
consecutive sequences at one offset) whose size depends on the capacity, not
on the corpus.  Spark numbers the pieces of each length and looks them up.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sparkfolio.llm.bpe import encode_text
from sparkfolio.llm.store import saved

CAPACITY = 2048
GROUPS = 256                # rounded sizes
LARGE = (1 / 4, 1 / 3, 1 / 2)   # of the capacity: lengths above are grouped; the threshold with the fewest sequences is taken
ROWS_PER_SALT = 100_000     # rows of one length that one task numbers, about
BYTE_50K = "byte_bpe_50k.json"


# ---- the plan ----------------------------------------------------------------

def equal_groups(counts: dict[int, int], n_groups: int) -> list[list[tuple[int, int, int]]]:
    """Lengths in descending order in groups of equal cardinality (the last
    may be smaller); a group is a list of (length, first rank, count)."""
    total = sum(counts.values())
    per = -(-total // n_groups) if total else 1
    groups, room = [[]], per
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if not room:
                groups.append([])
                room = per
            n = min(left, room)
            groups[-1].append((length, rank, n))
            rank, left, room = rank + n, left - n, room - n
    return [g for g in groups if g]


def fullest(sizes: list[int], available: list[int], first: int, capacity: int) -> dict[int, int]:
    """The configuration with one piece of group ``first`` that fills the
    capacity best, larger sizes preferred: group -> number of pieces."""
    room = capacity - sizes[first]
    mask = (1 << (room + 1)) - 1
    reach = [1]                                 # after the smallest groups, one by one: reachable sums as bits
    order = [k for k in range(len(sizes) - 1, -1, -1) if available[k] - (k == first) > 0 and sizes[k] <= room]
    for k in order:
        r = reach[-1]
        for _ in range(min(available[k] - (k == first), room // sizes[k])):
            more = (r | r << sizes[k]) & mask
            if more == r:
                break
            r = more
        reach.append(r)
    left = reach[-1].bit_length() - 1
    used = defaultdict(int, {first: 1})
    for stage in range(len(order), 0, -1):
        k = order[stage - 1]
        most = min(available[k] - (k == first), left // sizes[k])
        n = next(n for n in range(most, -1, -1) if reach[stage - 1] >> (left - n * sizes[k]) & 1)
        used[k] += n
        left -= n * sizes[k]
    return {k: n for k, n in used.items() if n}


def best_plan(counts: dict[int, int], capacity: int = CAPACITY, n_groups: int = GROUPS) -> tuple[np.ndarray, int]:
    return min((plan(counts, capacity, n_groups, large) for large in LARGE), key=lambda p: p[1])


def plan(counts: dict[int, int], capacity: int, n_groups: int, large: float) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, first sequence, offset, count), sorted, and the number of sequences."""
    runs: list[tuple[int, int, int, int, int]] = []
    full = counts.get(capacity, 0)
    if full:
        runs.append((capacity, 0, 0, 0, full))
    n_seq = full
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)        # room left -> (first sequence, count)
    groups = equal_groups({s: c for s, c in counts.items() if large * capacity < s < capacity}, n_groups)
    sizes, available = [g[0][0] for g in groups], [sum(n for *_, n in g) for g in groups]
    while any(available):
        first = next(k for k, n in enumerate(available) if n)
        used = fullest(sizes, available, first, capacity)
        times = min(available[k] // n for k, n in used.items())
        # the actual pieces of each place, in order; cut where any place's length changes
        places = []
        for k in sorted(used):
            for _ in range(used[k]):
                places.append(_take(groups[k], times))
            available[k] -= used[k] * times
        ends = sorted({int(e) for p in places for e in np.cumsum([n for *_, n in p])})
        cursors = [[0, 0] for _ in places]
        begin = 0
        for end in ends:
            offset = 0
            for p, cursor in zip(places, cursors):
                length, rank, n = p[cursor[0]]
                runs.append((length, rank + cursor[1], n_seq + begin, offset, end - begin))
                offset += length
                cursor[1] += end - begin
                if cursor[1] == n:
                    cursor[:] = [cursor[0] + 1, 0]
            if offset < capacity:
                open_bins[capacity - offset].append((n_seq + begin, end - begin))
            begin = end
        n_seq += times
    for size in sorted((s for s in counts if s <= large * capacity), reverse=True):
        n_seq = _best_fit(size, counts[size], open_bins, runs, n_seq, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return table, n_seq


def _take(group: list[tuple[int, int, int]], n: int) -> list[tuple[int, int, int]]:
    out = []
    while n:
        length, rank, have = group[0]
        k = min(n, have)
        out.append((length, rank, k))
        n -= k
        if k == have:
            group.pop(0)
        else:
            group[0] = (length, rank + k, have - k)
    return out


def _best_fit(size: int, left: int, open_bins, runs, n_seq: int, capacity: int) -> int:
    """Put ``left`` pieces of one size where the least room is left, many alike bins at a time."""
    rank = 0
    while left:
        room = min((r for r, b in open_bins.items() if r >= size and b), default=None)
        if room is None:
            room, new = capacity, -(-left // (capacity // size))
            open_bins[capacity].append((n_seq, new))
            n_seq += new
        start, bins = open_bins[room].pop()
        each = min(room // size, left)
        n = min(bins, left // each)
        for j in range(each):
            runs.append((size, rank + j * n, start, capacity - room + j * size, n))
        rank, left = rank + each * n, left - each * n
        if room > each * size:
            open_bins[room - each * size].append((start, n))
        if bins > n:
            open_bins[room].append((start + n, bins - n))
    return n_seq


# ---- tokens ------------------------------------------------------------------

class Coder:
    """Ids of the tokenizer in a ``tokenizers`` file.

    A file of the plain byte-level kind (a merge's id is its rank, no
    normaliser) is run through ``tiktoken``, which gives the same ids about
    five times as fast; other files, and texts with a special token's string,
    go through ``tokenizers``."""

    def __init__(self, text: str, pattern: str = public_tokenizers.PATTERN):
        self.text, self.pattern = text, pattern
        spec = json.loads(text)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        self.ranks = None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        plain = model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if plain and all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges)):
            # printable stand-ins of the byte-level alphabet: printable bytes stand for themselves, the rest follow from 256
            printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
            others = [b for b in range(256) if b not in set(printable)]
            byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
            self.ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(merges)}

    # built where it is used, and only if it is: a task gets the file's text and its ranks
    @cached_property
    def slow(self) -> Tokenizer:
        return Tokenizer.from_str(self.text)

    @cached_property
    def fast(self) -> tiktoken.Encoding | None:
        return tiktoken.Encoding("file", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}) if self.ranks else None

    @cached_property
    def compiled(self) -> regex.Pattern:
        return regex.compile(self.pattern)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(encode_text(self.fast, self.compiled, text), np.uint32)


def token_pieces(documents: DataFrame, path: str | None = None, text_col: str = "text", capacity: int = CAPACITY,
                 end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Columns ``record`` (the row without its text), ``piece``, ``start``,
    ``length``, ``ids_crc32`` and, if asked for, ``ids``: each text's ids and
    ``end_id``; texts of more than ``capacity`` ids are cut so that all pieces
    but the first are full.  A null or empty text is ``end_id`` alone."""
    with open(path or public_tokenizers.path(BYTE_50K), encoding="utf-8") as f:
        shared = documents.sparkSession.sparkContext.broadcast(Coder(f.read()))
    keep = [c for c in documents.columns if c != text_col]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    longs = [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
    schema = T.StructType([T.StructField("record", rows.schema["record"].dataType), T.StructField("piece", T.IntegerType()), *longs]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 500):
                x = b.slice(at, 500)
                row, out, kept = [], [], []
                for i, text in enumerate(x["text"].to_pylist()):
                    ids = np.append(coder(text), np.uint32(end_id)).astype("<u4")
                    begin, end = 0, len(ids) % capacity or capacity
                    while begin < len(ids):
                        row.append(i)
                        out.append((len(out) and row[-2] == i and out[-1][0] + 1 or 0, begin, end - begin, zlib.crc32(ids[begin:end].tobytes())))
                        if keep_ids:
                            kept.append(ids[begin:end].astype(np.int32).tolist())
                        begin, end = end, end + capacity
                columns = np.array(out, np.int64).reshape(-1, 4)
                arrays = [x["record"].take(pa.array(row, pa.int64())), pa.array(columns[:, 0].astype(np.int32)), *(pa.array(columns[:, k]) for k in (1, 2, 3))]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.list_(pa.int32()))] * keep_ids, schema.names)

    return rows.mapInArrow(run, schema)


# ---- the packing -------------------------------------------------------------

def pack(pieces: DataFrame, capacity: int = CAPACITY, n_groups: int = GROUPS, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``pieces`` (with a column ``length`` of 1 to ``capacity``) and, as
    structs so that no name clashes, ``row`` (the piece), ``sequence_id``
    and ``offset``.

    Pieces of one length are interchangeable; they are numbered within salts,
    as many as shuffle partitions and more as the rows grow, so a length that a
    third of all rows share is spread over tasks.  One histogram of at most ``capacity`` rows
    reaches the driver.  Repeated rows are packed separately."""
    spark = pieces.sparkSession
    rows = saved(pieces.select(F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("row"),
                               F.col("length").alias("len"), F.monotonically_increasing_id().alias("key")), "pieces")
    counts = {r["len"]: r["n"] for r in rows.groupBy("len").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError("a piece is empty or longer than a sequence")
    runs, _ = best_plan(counts, capacity, n_groups)
    salts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts.values()) // rows_per_salt)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("len").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy("len", "salt").agg(F.count(F.lit(1)).alias("n"))
              .select("len", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    if capacity * salts <= 200_000:             # rows of 100 bytes in a hash table; beyond, the planner decides
        starts = F.broadcast(starts)
    inside = F.row_number().over(Window.partitionBy("len", "salt").orderBy("key")) - 1
    ranked = salted.withColumn("i", inside).join(starts, ["len", "salt"])
    shared = spark.sparkContext.broadcast(runs)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        return lookup(shared.value, length.to_numpy(np.int64), rank.to_numpy(np.int64))

    placed = ranked.withColumn("place", place("len", (F.col("first") + F.col("i")).cast("long")))
    return placed.select("row", F.col("place.sequence_id").alias("sequence_id"), F.col("place.offset").alias("offset"))


def lookup(runs: np.ndarray, length: np.ndarray, rank: np.ndarray) -> pd.DataFrame:
    """Sequence and offset of the rank-th piece of each length."""
    key = lambda a, b: (a << 48) | b
    at = np.searchsorted(key(runs[:, 0], runs[:, 1]), key(length, rank), "right") - 1
    r = runs[at]
    return pd.DataFrame({"sequence_id": r[:, 2] + rank - r[:, 1], "offset": r[:, 3]})


def write_sequences(packed: DataFrame, path: str) -> None:
    """Packed pieces with their ids (``keep_ids``) as files, a sequence's pieces together and in order."""
    (packed.select("sequence_id", "offset", F.col("row.ids").alias("ids"))
     .repartitionByRange("sequence_id").sortWithinPartitions("sequence_id", "offset").write.parquet(path))
