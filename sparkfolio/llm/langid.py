"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text.  A text is parsed
against it greedily: the longest match with the labelled text from the current
position is one phrase, then the next begins.  The language whose labelled
text resembles the input most needs the fewest phrases.  Phrases grow with the
logarithm of the labelled text's length, so a language's count is weighted by
that of its own labelled text: each language keeps all it has (TRAIN_CHARS at
most), however little another one has.

Texts are lower-cased and every run of characters other than letters becomes
one space; the parse runs over blocks of BLOCK characters (a phrase ends with
its block), so a text of any length is parsed whole, many blocks at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The labelled text of one language, in characters, and how much of it one document may give.
TRAIN_CHARS = 40_000
TRAIN_PER_TEXT = 2_000
SMOOTH = 1_000          # added to a labelled text's length, so that a tiny one is not cheap
BLOCK = 512
LANES = 4_096           # blocks parsed side by side
DENSE = 8_000_000       # entries of a table of 4 bytes each
MIN_COUNT = 2           # a character seen less often in the labelled text is "other"
OTHER, SPACE = 1, 0
UND = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def normalised(text: str | None) -> np.ndarray:
    """Code points: lower case, each run of non-letters one space (none at the ends)."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]           # the first non-letter after a letter
    out = np.where(is_letter, points, 32)[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton: from state 0, exactly the
    substrings of ``symbols`` can be read."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for s in symbols:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in step[p]:
            step[p][s] = cur
            p = link[p]
        if p >= 0:
            q = step[p][s]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(s) == q:
                    step[p][s] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class Edges:
    """The edges of an automaton over a wide alphabet in a hash table, about
    as large as the labelled text whatever the number of signs."""

    def __init__(self, step: list[dict[int, int]], width: int):
        self.width = width
        self.fresh = np.zeros(width, np.int64)                   # a phrase's first character; unknown ones lead back to the start
        self.fresh[list(step[0])] = list(step[0].values())
        key = np.array([state * width + s for state, edges in enumerate(step) if state for s in edges], np.int64)
        to = np.array([t for state, edges in enumerate(step) if state for t in edges.values()], np.int64)
        self.bits = max(4, int(2 * len(key)).bit_length())
        self.keys, self.to = np.full(1 << self.bits, -1), np.zeros(1 << self.bits, np.int64)
        slot = self._slot(key)
        while len(key):         # the first of those that want a free slot gets it, the others look on
            free = self.keys[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[slot[won]], self.to[slot[won]] = key[won], to[won]
            left = np.ones(len(key), bool)
            left[won] = False
            key, to, slot = key[left], to[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def read(self, state: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and whether the sign begins a phrase."""
        key = state * self.width + sign
        out, new = self.fresh[sign], np.ones(len(key), bool)
        open_, slot = np.arange(len(key)), self._slot(key)
        while len(open_):
            there = self.keys[slot]
            hit = there == key[open_]
            out[open_[hit]], new[open_[hit]] = self.to[slot[hit]], False
            on = ~hit & (there >= 0)
            open_, slot = open_[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out, new


class CrossParser:
    """The automata of all languages over one alphabet, as tables, or where a
    table would have more than DENSE entries as edges in a hash table.

    An entry is 2 * (next state's row) + 1 if the character begins a new
    phrase; a character that the labelled text lacks is a phrase by itself.

    With ``common_length`` all labelled texts are cut to the shortest one's
    length, so that ``phrases`` are comparable as they are; without it each
    keeps its own, TRAIN_CHARS at most, and ``costs`` are."""

    def __init__(self, samples: dict[str, list[np.ndarray]], common_length: bool = True):
        self.names = sorted(samples)
        joined = {k: np.concatenate([np.append(x, 32) for x in v]) if v else np.zeros(0, np.uint32) for k, v in samples.items()}
        longest = min((len(x) for x in joined.values()), default=0) if common_length else TRAIN_CHARS
        joined = {k: x[:longest] for k, x in joined.items()}
        self.weights = np.log([len(joined[k]) + SMOOTH for k in self.names]) / np.log(TRAIN_CHARS + SMOOTH)
        points, counts = np.unique(np.concatenate([np.zeros(0, np.uint32), *joined.values()]), return_counts=True)
        points = points[(counts >= MIN_COUNT) & (points != 32)]
        self.width = len(points) + 2
        self.code = np.full(0x110000, OTHER, np.int32)
        self.code[32] = SPACE
        self.code[points.astype(np.int64)] = np.arange(2, self.width)
        self.tables = [self._table(self.code[joined[k]].tolist()) for k in self.names]

    def _table(self, symbols: list[int]) -> np.ndarray | Edges:
        step = suffix_automaton(symbols)
        if len(step) * self.width > DENSE:
            return Edges(step, self.width)
        fresh = np.ones(self.width, np.int64)                    # no such character: back to the start
        for s, t in step[0].items():
            fresh[s] = 2 * t * self.width + 1
        table = np.tile(fresh.astype(np.int32), (len(step), 1))
        for state, edges in enumerate(step):
            if edges and state:
                table[state, list(edges)] = np.fromiter(edges.values(), np.int64) * (2 * self.width)
        return table.ravel()

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrase counts on the scale of a labelled text of TRAIN_CHARS."""
        return self.phrases(texts) * self.weights

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrase counts, one row a text and one column a language."""
        out = np.zeros((len(texts), len(self.names)), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum() or not self.names:
            return out
        symbols = self.code[np.concatenate(texts)]
        n_blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), n_blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        begin = np.repeat(np.cumsum(sizes) - sizes, n_blocks) + nth * BLOCK
        size = np.minimum(BLOCK, np.repeat(sizes, n_blocks) - nth * BLOCK)
        order = np.argsort(-size, kind="stable")                 # lanes that end early drop off at the right
        for at in range(0, len(order), LANES):
            lanes = order[at:at + LANES]
            counts = self._lanes(symbols, begin[lanes], size[lanes])
            np.add.at(out, owner[lanes], counts)
        return out

    def _lanes(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        longest = int(size[0])
        alive = np.searchsorted(-size, -np.arange(longest), "left")     # lanes longer than step i
        at = np.minimum(begin[None, :] + np.arange(longest)[:, None], len(symbols) - 1)
        grid = symbols[at].astype(np.int32)
        counts = np.zeros((len(begin), len(self.names)), np.int64)
        for k, table in enumerate(self.tables):
            if isinstance(table, Edges):
                state, count = table.fresh[grid[0]], np.ones(len(begin), np.int64)
                for i in range(1, longest):
                    m = alive[i]
                    state[:m], new = table.read(state[:m], grid[i, :m])
                    count[:m] += new
                counts[:, k] = count
                continue
            state = np.zeros(len(begin), np.int32)
            count = np.ones(len(begin), np.int32)
            value = np.empty(len(begin), np.int32)
            state[:] = table[grid[0]] >> 1
            for i in range(1, longest):
                m = alive[i]
                s, v = state[:m], value[:m]
                np.add(s, grid[i, :m], out=s)
                np.take(table, s, out=v, mode="clip")
                np.right_shift(v, 1, out=s)
                np.bitwise_and(v, 1, out=v)
                count[:m] += v
            counts[:, k] = count
        return counts


def training_texts(df: DataFrame, text_col: str, lang_col: str, seed: int = 42) -> dict[str, list[np.ndarray]]:
    """A bounded sample per language: its distinct texts in a seeded hash
    order, up to TRAIN_PER_TEXT characters of each, until TRAIN_CHARS are
    reached; if all its texts are too few for that, more of each."""
    text = F.col(f"`{text_col}`")
    rows = df.where(F.col(f"`{lang_col}`").isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(f"`{lang_col}`").alias("lang"), text.alias("text"), F.xxhash64(F.lit(seed), text).alias("o"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("o").alias("texts"), F.avg(F.least(F.length("text"), F.lit(TRAIN_PER_TEXT))).alias("chars"),
                                     F.max(F.length("text")).alias("longest")).collect()
    longest = {r["lang"]: r["longest"] for r in sizes}
    # per language: the share of the hash order that is read, and the characters of a text
    todo = {r["lang"]: (4 * (1 + TRAIN_CHARS / r["chars"]) / r["texts"], TRAIN_PER_TEXT) for r in sizes}
    out: dict[str, list[np.ndarray]] = {}
    while todo:
        limits = df.sparkSession.createDataFrame(
            [(k, min(int(share * 2.0 ** 64), 2 ** 64 - 1) - 2 ** 63, 2 * chars) for k, (share, chars) in todo.items()], "lang string, last long, cut int")
        firsts = (rows.join(F.broadcast(limits), "lang").where(F.col("o") <= F.col("last"))
                  .groupBy("lang", "o").agg(F.min(F.expr("substring(text, 1, cut)")).alias("part")))
        have = dict.fromkeys(todo, 0)
        out |= {k: [] for k in todo}
        for r in firsts.orderBy("lang", "o").toLocalIterator():
            x = normalised(r["part"])[:todo[r["lang"]][1]]
            if len(x) and have[r["lang"]] < TRAIN_CHARS:
                out[r["lang"]].append(x)
                have[r["lang"]] += len(x) + 1
        short = {k: v for k, v in todo.items() if have[k] < TRAIN_CHARS}
        todo = {k: (8 * share, chars) if share < 1 else (share, 4 * chars) for k, (share, chars) in short.items()
                if share < 1 or chars < min(longest[k], TRAIN_CHARS)}
    return {k: v for k, v in out.items() if v}


def predict(df: DataFrame, parser: CrossParser, text_col: str = "text") -> DataFrame:
    """Columns ``record`` (the row), ``lang_pred``, ``score`` (0 to 1: by how
    much the best language costs less than the next), ``density`` (phrases a
    character in the best one, on the scale of a labelled text of TRAIN_CHARS;
    null if there is no letter) and
    ``n_parsed`` (characters after normalising).

    Null, empty and letterless texts are ``und`` with score 0, as is every
    text if nothing was labelled; with a single language the score is 1.
    Ties go to the language first in name order, with score 0.
    """
    shared = df.sparkSession.sparkContext.broadcast(parser)
    said = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                         T.StructField("density", T.DoubleType()), T.StructField("n_parsed", T.LongType())])

    @F.arrow_udf(said)
    def say(text: pa.Array) -> pa.Array:
        parser, parts = shared.value, []
        for at in range(0, len(text), 500):
            texts = [normalised(t) for t in text.slice(at, 500).to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            names, score, density = _decide(parser, parser.costs(texts), sizes)
            parts.append(pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(density, pa.float64(), from_pandas=True), pa.array(sizes)], said.names))
        return pa.concat_arrays(parts)

    # only the text goes to Python; not deterministic in name, so that a filter on the result does not run it twice
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record")
    return df.select(record, say.asNondeterministic()(F.col(f"`{text_col}`")).alias("said")).select("record", *[F.col("said")[c].alias(c) for c in said.names])


def _decide(parser: CrossParser, costs: np.ndarray, sizes: np.ndarray):
    known = (sizes > 0) & (costs.shape[1] > 0)
    if not costs.shape[1]:
        return [UND] * len(sizes), np.zeros(len(sizes)), np.full(len(sizes), np.nan)
    best = costs.argmin(1)
    ranked = np.sort(costs, 1)
    second = ranked[:, 1] if costs.shape[1] > 1 else np.full(len(sizes), np.inf)
    score = np.where(known, 1 - ranked[:, 0] / np.where(known, second, 1), 0.0)
    density = np.where(known, ranked[:, 0] / np.maximum(sizes, 1), np.nan)
    return [parser.names[i] if k else UND for i, k in zip(best, known)], score, density


def identify(documents: DataFrame, folds: int = 5, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Learn from the rows outside the held-out fold (crc32 of the id as text,
    modulo ``folds``, is 0) and predict for all rows: ``predict``'s columns and
    ``held_out``.  Rows with a null id are never learned from and not held out."""
    held = held_out(F.col(f"`{id_col}`"), folds)
    parser = CrossParser(training_texts(documents.where(~held), text_col, lang_col), common_length=False)
    return predict(documents, parser, text_col).withColumn("held_out", F.coalesce(held_out(F.col(f"record.`{id_col}`"), folds), F.lit(False)))


def held_out(key, folds: int = 5):
    return F.crc32(key.cast("string").cast("binary")) % folds == 0
