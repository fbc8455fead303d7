"""Near duplicates by Jaccard similarity of word n-grams, vertically partitioned.

The global order of n-gram hashes is cut into fragments; every task has one
fragment of many documents' sets and counts there; the counts of a document,
or of a pair, are summed over its fragments.

1. Documents with the same set are one class.
2. In each fragment count, per class, the n-grams that occur in another class.
   A class whose sum is below the threshold's share of its set can have no
   link and is done.  What is left is small: only these classes' sets are kept.
3. Fragments give every n-gram's class frequency.  In rarest-first order, two
   linked classes share an n-gram of their prefixes.  Each prefix n-gram links
   its classes to one leader in a candidate graph.
4. Overlaps with the leaders are counted per fragment, summed per pair, and
   tested exactly.  This joins most groups of copies with one test a class.
5. Candidate groups that are still in parts are tested further, in blocks:
   every class outside a group's largest part against all of the group.  A
   block counts fragment by fragment too, and returns a spanning forest of
   its links, so a large group never becomes a list of its pairs.
6. If asked for, links are counted: a class against those of its group of
   like size, again in blocks, which return sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.llm.components import components
from sparkfolio.llm.keyfilter import key_filter, maybe_in
from sparkfolio.llm.store import saved
from sparkfolio.llm.textarrays import LOWER, U64, Texts, gram_hashes, mix, per_text, span_hashes, text_slices, words

N = 5                           # words an n-gram
PERCENT = 80                    # similarity
SLICE = 2 << 20
FRAGMENT_GRAMS = 2_000_000      # n-grams of one fragment, about
SEGMENTS = 8                    # fragments in which pairs are counted
ROW_BLOCK, COLUMN_BLOCK = 256, 1_024
BLOCK_GRAMS = 2_000_000         # n-grams on one side of a block in which links are counted, about
LISTS = T.ArrayType(T.LongType())


def gram_sets(texts: Texts, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of each text (A-Z lower-cased), ascending
    within a text, and the texts' ends.  A text of fewer words has one n-gram,
    all its words; one without words has none."""
    low = Texts(texts.first, LOWER[texts.data], texts.ends)
    starts, ends, owner = words(low)
    h = span_hashes(low.data, starts, ends)
    count = np.bincount(owner, minlength=len(texts))
    grams, at = gram_hashes(h, owner, n)
    parts, owners = [grams], [owner[at]]
    for k in range(1, n):
        short = count[owner] == k
        g, at = gram_hashes(h[short], owner[short], k)
        parts.append(g)
        owners.append(owner[short][at])
    return per_text(np.concatenate(parts), np.concatenate(owners), len(texts))


def class_keys(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """16 bytes that stand for a whole set; b'' for an empty one."""
    sums = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(values ^ U64(salt)), dtype=U64)])
        sums.append(mix((total[ends[1:]] - total[ends[:-1]]) + np.diff(ends).astype(U64)))
    raw = np.stack(sums, 1).astype(">u8").tobytes()
    return [raw[16 * i:16 * i + 16] if k else b"" for i, k in enumerate(np.diff(ends))]


def _binary(values) -> pa.Array:
    return pa.array(values, pa.binary())


def _nested(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a column of lists of lists, and the inner lists' ends; no Python objects."""
    inner = lists.flatten()
    return np.asarray(inner.flatten()), np.concatenate([[0], np.cumsum(np.asarray(inner.value_lengths()), dtype=np.int64)])


# ---- 1: classes ----------------------------------------------------------------

def _classes(n: int):
    """The class of each text and the size of its set, of the text alone."""
    @F.arrow_udf(T.StructType([T.StructField("class", T.BinaryType()), T.StructField("n", T.LongType())]))
    def run(text: pa.Array) -> pa.Array:
        keys, sizes = [], [np.zeros(0, np.int64)]
        for texts in text_slices(text):
            values, ends = gram_sets(texts, n)
            keys += [k or None for k in class_keys(values, ends)]
            sizes.append(np.diff(ends).astype(np.int64))
        return pa.StructArray.from_arrays([_binary(keys), pa.array(np.concatenate(sizes))], ["class", "n"])
    return run.asNondeterministic()


# ---- 2: which classes can have a link -------------------------------------------

def _cut(n: int, fragments: int):
    """Per slice of texts: for each fragment the low halves of its hashes, text by text
    (those of one text of the slice only), and those that several texts share; and for the
    slice itself, its classes and how many of each one's n-grams are shared inside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for b in batches:
            for texts in text_slices(b["text"], SLICE):
                values, ends = gram_sets(texts, n)
                keys = class_keys(values, ends)
                first = {k: i for i, k in reversed(list(enumerate(keys))) if k}
                once = np.zeros(len(keys), bool)
                once[list(first.values())] = True
                owner = np.repeat(np.arange(len(keys)), np.diff(ends))
                values, owner = values[once[owner]], owner[once[owner]]
                order = np.argsort(values, kind="stable")
                values, owner = values[order], owner[order]
                same = values[1:] == values[:-1]
                shared = np.zeros(len(values), bool)
                shared[1:] |= same
                shared[:-1] |= same
                head = np.ones(len(values), bool)
                head[1:] = ~same
                # the same when a task is run again, and no other task's
                name = class_keys(values, np.array([0, len(values)]))[0] + b"%d.%d" % (TaskContext.get().partitionId(), number)
                number += 1
                if not len(values):
                    continue
                fragment = ((values >> U64(32)) * U64(fragments)) >> U64(32)
                rows = []
                cuts = np.searchsorted(fragment, np.arange(fragments + 1, dtype=U64))
                for f in range(fragments):
                    part = slice(cuts[f], cuts[f + 1])
                    alone = ~shared[part]
                    own = owner[part][alone]
                    by_text = np.argsort(own, kind="stable")
                    low = values[part].astype(np.uint32)
                    rows.append((f, name, low[alone][by_text].tobytes(), np.bincount(own, minlength=len(keys)).astype(np.uint32).tobytes(),
                                 low[~alone & head[part]].tobytes(), None, None))
                local = np.bincount(owner[shared], minlength=len(keys)).astype(np.uint32)
                sizes = np.where(once, np.diff(ends), 0).astype(np.uint32)
                rows.append((int(values[0] % U64(fragments)), name, None, local.tobytes(), None, b"".join(k or bytes(16) for k in keys), sizes.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32())] + [_binary([r[i] for r in rows]) for i in range(1, 7)], CUT.names)
    return run


CUT = T.StructType([T.StructField("fragment", T.IntegerType())] + [T.StructField(c, T.BinaryType()) for c in ("slice", "alone", "counts", "several", "classes", "sizes")])
COUNTED = T.StructType([T.StructField(c, T.BinaryType()) for c in ("slice", "counts", "classes", "sizes")])


def _count_fragment(table: pa.Table) -> pa.Table:
    """How many n-grams of each text of each slice are in another text too."""
    rows = table.to_pylist()
    cut = [r for r in rows if r["alone"] is not None]
    alone = [np.frombuffer(r["alone"], np.uint32) for r in cut]
    several = np.unique(np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(r["several"], np.uint32) for r in cut)]))
    values = np.concatenate([np.zeros(0, np.uint32), *alone])
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    shared = np.zeros(len(values), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    if len(several):
        at = np.minimum(np.searchsorted(several, values), len(several) - 1)
        shared |= several[at] == values
    out, begin = [(r["slice"], r["counts"], r["classes"], r["sizes"]) for r in rows if r["alone"] is None], 0
    for r, part in zip(cut, alone):
        per = np.frombuffer(r["counts"], np.uint32)
        owner = np.repeat(np.arange(len(per)), per)
        hits = np.bincount(owner[shared[begin:begin + len(part)]], minlength=len(per)).astype(np.uint32)
        out.append((r["slice"], hits.tobytes(), None, None))
        begin += len(part)
    return pa.table([_binary([o[i] for o in out]) for i in range(4)], names=COUNTED.names)


def _able(percent: int):
    """The classes of a slice whose summed counts allow a link."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        total = sum(np.frombuffer(r["counts"], np.uint32).astype(np.int64) for r in rows)
        base = next(r for r in rows if r["classes"] is not None)
        sizes = np.frombuffer(base["sizes"], np.uint32).astype(np.int64)
        good = np.flatnonzero((100 * total >= percent * sizes) & (sizes > 0))
        return pa.table([_binary([base["classes"][16 * i:16 * i + 16] for i in good])], names=["class"])
    return run


# ---- 3: sets, frequencies, prefixes ----------------------------------------------

def _some_sets(shared, n: int):
    """The sets of the classes that the filter lets through, cut into segments, a class once a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for texts in text_slices(b["text"], SLICE):
                values, ends = gram_sets(texts, n)
                keys = class_keys(values, ends)
                half = np.array([int.from_bytes(k[:8], "big", signed=True) if k else 0 for k in keys], np.int64)
                hit = shared.value(half)
                first = {k: i for i, k in reversed(list(enumerate(keys))) if k and hit[i]}
                if first:
                    sets = [values[ends[i]:ends[i + 1]].view(np.int64) for i in first.values()]
                    lens = np.array([len(s) for s in sets])
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(np.concatenate(sets)))
                    yield pa.RecordBatch.from_arrays([_binary(list(first)), lists], ["class", "grams"])
    return run


def _frequencies(table: pa.Table) -> pa.Table:
    """Of one fragment: each class' n-grams, and in how many classes each one is."""
    grams = table["grams"].combine_chunks()
    grams = grams.combine_chunks() if isinstance(grams, pa.ChunkedArray) else grams
    values = np.asarray(grams.flatten())
    _, at, count = np.unique(values, return_inverse=True, return_counts=True)
    ends = np.concatenate([[0], np.cumsum(np.asarray(grams.value_lengths()))])
    found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(count[at].astype(np.int64)))
    return pa.table([table["class"], table["fragment"], table["segment"], grams, found], names=["class", "fragment", "segment", "grams", "found_in"])


def _prefix(percent: int):
    """The n-grams of a class' prefix that other classes have, if it can have a link at all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, shares, lists = [], [], [], []
            (grams, ends), (found, _) = _nested(b["grams"]), _nested(b["found_in"])
            ends = ends[np.concatenate([[0], np.cumsum(np.asarray(b["grams"].value_lengths()))])]
            for i, key in enumerate(b["class"].to_pylist()):
                g, f = grams[ends[i]:ends[i + 1]], found[ends[i]:ends[i + 1]]
                if 100 * np.count_nonzero(f > 1) < percent * len(g):
                    continue
                order = np.lexsort((g, f))[:len(g) - -(-percent * len(g) // 100) + 1]
                keys.append(key)
                sizes.append(len(g))
                shares.append(float(np.log(f).sum() / len(g)))
                lists.append(g[order][f[order] > 1].tolist())
            yield pa.RecordBatch.from_arrays([_binary(keys), pa.array(sizes, pa.int64()), pa.array(shares, pa.float64()), pa.array(lists, pa.list_(pa.int64()))], ["class", "n", "share", "prefix"])
    return run


# ---- 5: blocks --------------------------------------------------------------------

def _links(table: pa.Table, percent: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Where a block's rows and columns stand in it, and which of them are linked."""
    is_row = np.asarray(table["is_row"]).astype(bool)
    sides = [np.flatnonzero(is_row), np.flatnonzero(~is_row)]
    if not len(sides[0]) or not len(sides[1]):
        return sides, np.zeros((len(sides[0]), len(sides[1])), bool)
    sizes = [np.asarray(table["n"])[s] for s in sides]
    grams, ends = _nested(pa.concat_arrays(table["grams"].chunks))
    overlap = np.zeros((len(sides[0]), len(sides[1])), np.float32)
    for k in range(SEGMENTS):                       # partial overlaps, one fragment after another
        parts = [[grams[ends[SEGMENTS * r + k]:ends[SEGMENTS * r + k + 1]] for r in s] for s in sides]
        flat = [np.concatenate([np.zeros(0, np.int64), *p]) for p in parts]
        own = [np.repeat(np.arange(len(p)), [len(x) for x in p]) for p in parts]
        common = np.intersect1d(*flat)
        for c in range(0, len(common), 2_048):
            some = common[c:c + 2_048]
            grid = []
            for f, o, s in zip(flat, own, sides):
                at = np.minimum(np.searchsorted(some, f), len(some) - 1)
                hit = some[at] == f
                m = np.zeros((len(s), len(some)), np.float32)
                m[o[hit], at[hit]] = 1
                grid.append(m)
            overlap += grid[0] @ grid[1].T
    same = np.round(overlap).astype(np.int64)
    return sides, 100 * same >= percent * (sizes[0][:, None] + sizes[1][None, :] - same)


def _count_block(percent: int):
    """Rows against columns of one candidate group and size band: the documents of the
    other classes that each row's class is linked with."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sides, linked = _links(table, percent)
        _, name = np.unique(np.array(table["node"].to_pylist(), object), return_inverse=True)
        linked &= name[sides[0]][:, None] != name[sides[1]][None, :]
        n = linked @ np.asarray(table["copies"])[sides[1]].astype(np.int64)
        return pa.table([table["node"].take(pa.array(sides[0])), pa.array(n.astype(np.int64))], names=["class", "links"])
    return run


def _test_block(percent: int):
    """Rows (classes outside the largest part) against columns of one candidate
    group: a spanning forest, over the parts, of the links between them."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sides, linked = _links(table, percent)
        part_of = table["part"].to_pylist()
        out: list[tuple[bytes, bytes]] = []
        if linked.any():
            parent: dict[bytes, bytes] = {}

            def root(x: bytes) -> bytes:
                while parent.setdefault(x, x) != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for i, j in zip(*np.nonzero(linked)):
                a, z = part_of[sides[0][i]], part_of[sides[1][j]]
                if root(a) != root(z):
                    parent[root(a)] = root(z)
                    out.append((a, z))
        return pa.table([_binary([a for a, _ in out]), _binary([z for _, z in out])], names=["a", "b"])
    return run


def link_counts(member: DataFrame, sizes: DataFrame, copies: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """(class, links): the documents of other classes that are linked with a class, for
    every class of a candidate group (``member``: node, grp).

    A link's sets differ in size by the threshold at most, so classes are dealt
    by size band and tested against their own band and its two neighbours.  A
    block holds a bounded number of classes and, by its band, of n-grams; no
    pair becomes a row."""
    base = 101 / percent                            # a little over the largest ratio, so rounding cannot pass a band
    node = (member.select("node", "grp").join(sizes.withColumnRenamed("class", "node"), "node").join(copies.withColumnRenamed("class", "node"), "node")
            .withColumn("band", F.floor(F.log("n") / math.log(base)).cast("int")))
    as_rows = node.withColumn("is_row", F.lit(True))
    as_columns = (node.withColumn("is_row", F.lit(False)).withColumn("own_band", F.col("band"))
                  .withColumn("band", F.explode(F.array(*[F.col("own_band") + d for d in (-1, 0, 1)]))).drop("own_band"))
    bounded = lambda most: F.greatest(F.lit(1.0), F.least(F.lit(float(most)), F.floor(F.lit(float(BLOCK_GRAMS)) / F.pow(F.lit(base), F.col("band") + 2))))
    dealt = (as_rows.unionByName(as_columns).groupBy("grp", "band").agg(F.count_if("is_row").alias("rows"), F.count_if(~F.col("is_row")).alias("columns"))
             .where((F.col("rows") > 0) & (F.col("columns") > 1))
             .select("grp", "band", F.ceil(F.col("rows") / bounded(ROW_BLOCK)).cast("int").alias("row_blocks"),
                     F.ceil(F.col("columns") / bounded(COLUMN_BLOCK)).cast("int").alias("column_blocks")))
    # written, so that the join below deals plain rows, whose large groups Spark can split
    dealt = saved(dealt, "join-bands")
    hashed, keep = F.xxhash64("node"), ["node", "grp", "band", "n", "copies", "is_row"]
    placed = (as_rows.join(dealt, ["grp", "band"]).select(*keep, F.pmod(hashed, "row_blocks").cast("int").alias("rb"), F.explode(F.sequence(F.lit(0), F.col("column_blocks") - 1)).alias("cb"))
              .unionByName(as_columns.join(dealt, ["grp", "band"]).select(*keep, F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("rb"), F.pmod(hashed, "column_blocks").cast("int").alias("cb"))))
    counted = placed.join(lists, "node").groupBy("grp", "band", "rb", "cb").applyInArrow(_count_block(percent), "class binary, links long")
    return counted.groupBy("class").agg(F.sum("links").alias("links"))


# ---- the whole ----------------------------------------------------------------------

def link_components(documents: DataFrame, text_col: str = "text", id_col: str = "doc_id", n: int = N, percent: int = PERCENT,
                    carry_text: bool = False, count_links: bool = False) -> DataFrame:
    """Columns ``record`` (the row, without its text unless ``carry_text``), ``n_shingles``,
    ``class_id`` (smallest id with the same set) and ``component_id`` (smallest
    id reachable over links, the own one included); with ``count_links`` also
    ``n_links``, the other rows that the row is linked with.

    Links: 100 * intersection >= percent * union of the n-gram sets.  Null and
    empty texts and texts without words have no n-grams and no links: their
    class and component is their own id.  Null ids never are the smallest
    unless all are null.  Repeated rows are one class.
    """
    spark = documents.sparkSession
    keep = [c for c in documents.columns if carry_text or c != text_col]
    text = F.col(f"`{text_col}`").alias("text")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), F.col(f"`{id_col}`").alias("id"), text)
    docs = saved(rows.select("record", "id", _classes(n)("text").alias("c")).select("record", "id", "c.class", "c.n"), "join-docs")
    total = docs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    classes = docs.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies"))

    texts = documents.select(text)
    fragments = max(1, math.ceil(total / FRAGMENT_GRAMS))
    cut_texts = texts.mapInArrow(_cut(n, fragments), CUT).repartitionById(fragments, F.col("fragment"))      # one a task
    counted = cut_texts.groupBy("fragment").applyInArrow(_count_fragment, COUNTED)
    able = saved(counted.groupBy("slice").applyInArrow(_able(percent), "class binary").distinct(), "join-able")
    half = F.conv(F.hex(F.substring("class", 1, 8)), 16, -10).cast("long")
    shared = spark.sparkContext.broadcast(key_filter(able.select(half.alias("k")), "k"))
    sets = saved(texts.mapInArrow(_some_sets(shared, n), T.StructType([T.StructField("class", T.BinaryType()), T.StructField("grams", LISTS)]))
                 .join(able, "class", "left_semi").dropDuplicates(["class"]), "join-sets")

    # a segment of the order is a fragment, or several of bounded size when the kept sets are many
    kept = sets.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0)).alias("n")).first()["n"]
    finer = max(1, math.ceil(kept / (SEGMENTS * FRAGMENT_GRAMS)))
    fragment = lambda g: (F.pmod(F.shiftrightunsigned(g, 60), F.lit(SEGMENTS)) + SEGMENTS * F.pmod(F.shiftrightunsigned(g, 40), F.lit(finer))).cast("int")
    cut = (sets.select("class", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS * finer - 1)), lambda k: F.filter("grams", lambda g: fragment(g) == k))).alias("fragment", "grams"))
           .where(F.size("grams") > 0).select("class", "fragment", (F.col("fragment") % SEGMENTS).alias("segment"), "grams")
           .repartitionById(SEGMENTS * finer, F.col("fragment")))
    cut_schema = T.StructType([T.StructField("class", T.BinaryType()), T.StructField("fragment", T.IntegerType()), T.StructField("segment", T.IntegerType()),
                               T.StructField("grams", LISTS), T.StructField("found_in", LISTS)])
    segs = saved(cut.groupBy("fragment").applyInArrow(_frequencies, cut_schema), "join-segments")
    whole = segs.groupBy("class").agg(F.collect_list(F.struct("grams", "found_in")).alias("x")).select("class", "x.grams", "x.found_in")
    prefix_schema = T.StructType([T.StructField("class", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("share", T.DoubleType()), T.StructField("prefix", LISTS)])
    prefixes = saved(whole.mapInArrow(_prefix(percent), prefix_schema), "join-prefixes")
    sizes = prefixes.select("class", "n")

    # candidate graph: each prefix n-gram's classes with the one whose n-grams are the most frequent
    entries = prefixes.select(F.explode("prefix").alias("gram"), "class", F.struct("share", "class").alias("rank"))
    leaders = saved(entries.groupBy("gram").agg(F.max("rank")["class"].alias("leader")), "join-leaders")
    star = saved(entries.join(leaders, "gram").where(F.col("class") != F.col("leader")).select(F.col("class").alias("a"), F.col("leader").alias("b")).distinct(), "join-star")
    groups = components(star)

    # overlaps with the leaders, by fragment
    near = (star.join(sizes.select(F.col("class").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("class").alias("b"), F.col("n").alias("nb")), "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    left = segs.select(F.col("class").alias("a"), "fragment", F.col("grams").alias("ga"))
    right = segs.select(F.col("class").alias("b"), "fragment", F.col("grams").alias("gb"))
    partial = near.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("same"))
    links = (partial.groupBy("a", "b", "na", "nb").agg(F.sum("same").alias("same"))
             .where(100 * F.col("same") >= percent * (F.col("na") + F.col("nb") - F.col("same"))).select("a", "b"))
    linked = components(links)

    # groups still in parts: all but the largest part of each against the group, in blocks
    member = saved(groups.join(linked.select("node", F.col("root").alias("part")), "node", "left")
                   .select("node", F.col("root").alias("grp"), F.coalesce("part", "node").alias("part")), "join-members")
    per_part = member.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("c"))
    # written, so that the join below deals plain rows, whose large groups Spark can split
    per_group = saved(per_part.groupBy("grp").agg(F.max_by("part", F.struct("c", "part")).alias("largest"), F.count(F.lit(1)).alias("parts"),
                                             F.sum("c").alias("m"), F.max("c").alias("big")).where(F.col("parts") > 1), "join-groups")
    open_ = member.join(per_group, "grp").withColumn("is_row", F.col("part") != F.col("largest"))
    row_blocks, column_blocks = F.ceil((F.col("m") - F.col("big")) / ROW_BLOCK).cast("int"), F.ceil(F.col("m") / COLUMN_BLOCK).cast("int")
    own = F.xxhash64("node")
    as_row = (open_.where("is_row").select("node", "part", "grp", F.lit(True).alias("is_row"), F.pmod(own, row_blocks).cast("int").alias("rb"),
                                           F.explode(F.sequence(F.lit(0), column_blocks - 1)).alias("cb")))
    as_column = (open_.select("node", "part", "grp", F.lit(False).alias("is_row"), F.explode(F.sequence(F.lit(0), row_blocks - 1)).alias("rb"),
                              F.pmod(own, column_blocks).cast("int").alias("cb")))
    by_segment = (segs.groupBy("class", "segment").agg(F.flatten(F.collect_list("grams")).alias("g"))
                  .groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("segment", "g"))).alias("by")))
    lists = by_segment.select(F.col("class").alias("node"), F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)),
                                                                          lambda k: F.coalesce(F.element_at("by", k), F.array().cast(LISTS))).alias("grams"))
    blocks = (as_row.unionByName(as_column).join(lists, "node").join(sizes.withColumnRenamed("class", "node"), "node"))
    more = saved(blocks.groupBy("grp", "rb", "cb").applyInArrow(_test_block(percent), "a binary, b binary"), "join-more")
    merged = components(more)

    comp = (member.select("node", "part").join(merged.select(F.col("node").alias("part"), "root"), "part", "left")
            .select(F.col("node").alias("class"), F.coalesce("root", "part").alias("comp")))
    # documents of one class and no link are their own answer and stay where they are
    named = (classes.join(comp, "class", "left").where((F.col("copies") > 1) | F.col("comp").isNotNull())
             .withColumn("comp", F.coalesce("comp", "class")))
    links = []
    if count_links:
        found = saved(link_counts(member, sizes, classes.select("class", "copies"), lists, percent), "join-links")
        named = named.join(found, "class", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
        links = ["n_links"]
    named = saved(named, "join-classes")
    lowest = named.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    ids = saved(named.join(lowest, "comp").select("class", "class_id", "component_id", *links), "join-ids")
    grouped = spark.sparkContext.broadcast(key_filter(ids.select(half.alias("k")), "k"))
    split = docs.withColumn("maybe", maybe_in(grouped, half))
    alone = split.where(~F.col("maybe")).select("record", F.col("n").alias("n_shingles"), F.col("id").alias("class_id"), F.col("id").alias("component_id"), *[F.lit(0).cast("long").alias(c) for c in links])
    in_groups = split.where("maybe").join(ids, "class", "left")
    return alone.unionByName(in_groups.select(
        "record", F.col("n").alias("n_shingles"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("component_id", "id").alias("component_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in links]))
