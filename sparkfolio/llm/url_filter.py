"""URL rules decided by Bloom filter cascades.

A cascade stores a set of keys so that membership is exact for every key of a
known universe.  Level 1 is a Bloom filter of the listed keys; level 2 holds
the universe's keys that level 1 wrongly accepts, level 3 the listed keys that
level 2 wrongly accepts, and so on until nothing is wrong.  A key is listed if
the first level that rejects it is an even one.  Afterwards a url is judged
with look-ups alone, without a join against the list.

The universe is taken from the corpus itself: every (host suffix, path prefix)
of every url.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.store import saved
from sparkfolio.llm.textarrays import mix

#: Listed keys in one cascade at most (16 MB for its first level).  A longer list is cut into parts
#: of this size, whose cascades are broadcast one part after another.
MAX_KEYS = 8_000_000
BITS_PER_KEY = (16, 4)      # first level, later levels
MAX_LEVELS = 24


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased.
    Path: from there up to ``? #`` or the end.  Both '' for null or without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, path_lengths: Sequence[int], max_labels: int) -> Column:
    """All rule keys that could fit a url, longest first: each host suffix at a
    dot, with each prefix of the path that has a rule's length.  The key is the
    host followed by the path prefix, which starts with ``/`` or is empty.
    Suffixes of more than ``max_labels`` labels, as many as any rule's host
    has, fit no rule; so a host of any length has a bounded number of keys."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - max_labels + 1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(path_lengths))])
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    keys = F.array_distinct(F.filter(keys, lambda k: k.isNotNull()))
    longest = F.array_sort(keys, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1)
                           .when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.when(host != "", longest).otherwise(F.array().cast("array<string>"))


def _two_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


class Bloom:
    """Bits over keys given as two 64-bit hashes; ``salt`` makes levels independent."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, bits_per_key: int, salt: int):
        self.salt, self.k = np.uint64(salt), max(1, round(bits_per_key * math.log(2)))
        self.n = max(64, len(h1) * bits_per_key)
        self.bits = np.zeros((self.n + 7) // 8, np.uint8)
        for at in self._places(h1, h2):
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def _places(self, h1, h2):
        a = mix(h1.view(np.uint64) + np.uint64(int(self.salt) * 0x9E3779B97F4A7C15 % 2**64))
        b = mix(h2.view(np.uint64) ^ a) | np.uint64(1)
        for i in range(self.k):
            yield ((a + np.uint64(i) * b) % np.uint64(self.n)).astype(np.int64)

    def __call__(self, h1, h2) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for at in self._places(h1, h2):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


class Cascade:
    """Levels of Bloom filters, and the keys left after the last one as a list."""

    def __init__(self):
        self.levels: list[Bloom] = []
        self.rest = np.zeros((0, 2), np.int64)

    def member(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for listed keys and for every key of the universe."""
        h1, h2 = np.asarray(h1, np.int64), np.asarray(h2, np.int64)
        out = np.zeros(len(h1), bool)
        alive = np.arange(len(h1))
        for i, level in enumerate(self.levels):
            hit = level(h1[alive], h2[alive])
            out[alive[~hit]] = i % 2 == 1
            alive = alive[hit]
        if len(alive):      # in every level: the last word is the explicit list's
            rest = set(map(tuple, self.rest.tolist()))
            left = np.fromiter((k in rest for k in zip(h1[alive].tolist(), h2[alive].tolist())), bool, len(alive))
            out[alive] = left if len(self.levels) % 2 == 0 else ~left
        return out


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    pdf = df.select("h1", "h2").toPandas()
    return pdf["h1"].to_numpy(np.int64), pdf["h2"].to_numpy(np.int64)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """``listed``: distinct (h1, h2), at most MAX_KEYS.  ``universe``: distinct
    (h1, h2) of any size; only the keys that level 1 wrongly accepts, a small
    share set by the bits per key, leave the executors."""
    spark = listed.sparkSession
    out = Cascade()
    inside = _arrays(listed)
    out.levels.append(Bloom(*inside, BITS_PER_KEY[0], 1))
    first = spark.sparkContext.broadcast((out.levels[0], np.sort(inside[0])))

    @F.pandas_udf("boolean")
    def wrongly(h1: pd.Series, h2: pd.Series) -> pd.Series:
        level, known = first.value
        a, b = h1.to_numpy(np.int64), h2.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(known, a), max(0, len(known) - 1))
        return pd.Series(level(a, b) & ~((known[at] == a) if len(known) else np.zeros(len(a), bool)))

    outside = _arrays(universe.where(wrongly("h1", "h2")))
    accept, reject = outside, inside          # the next level holds `accept` and is tried on `reject`
    while len(accept[0]) and len(out.levels) < MAX_LEVELS:
        level = Bloom(*accept, BITS_PER_KEY[1], len(out.levels) + 1)
        out.levels.append(level)
        hit = level(*reject)
        accept, reject = (reject[0][hit], reject[1][hit]), accept
    out.rest = np.stack(accept, 1)
    return out


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Columns ``record`` (the row), ``host``, ``path``, ``rule``, ``verdict``.

    ``rules``: (verdict, host, path), the path starting with ``/`` or empty.  A
    rule fits its host and the subdomains if the url's path starts with its
    path; the longest fitting rule decides, ``default`` where none fits.  Each
    verdict's rule keys are one cascade; every url's own keys are tried from
    the longest on.

    Null urls and urls without ``://`` have host and path '' and no rule.
    Repeated rows are judged alike.  An empty table gives no rows.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(f"`{url_col}`"))
    urls = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("record"), host.alias("host"), path.alias("path"))
    verdicts = {}
    for verdict, h, p in rules:
        verdicts.setdefault(h + p, verdict)
    keyed = urls.withColumn("keys", candidate_keys(
        F.col("host"), F.col("path"), [len(p) for _, _, p in rules] or [0], max((h.count(".") + 1 for _, h, _ in rules), default=1)))
    universe = saved(keyed.select(F.explode("keys").alias("key")).select(*_two_hashes(F.col("key"))).distinct(), "url-keys")
    names = sorted(set(verdicts.values()))
    keyed = keyed.withColumn("found", F.transform("keys", lambda k: F.lit(-1)))
    listed = sorted(verdicts.items())
    for i in range(0, len(listed), MAX_KEYS):
        part = listed[i:i + MAX_KEYS]
        cascades = []
        for name in names:
            mine = spark.createDataFrame([(k,) for k, v in part if v == name], "key string")
            cascades.append(build_cascade(mine.select(*_two_hashes(F.col("key"))).distinct(), universe))
        found = _memberships(spark.sparkContext.broadcast(cascades))(
            F.transform("keys", lambda k: F.xxhash64(k)), F.transform("keys", lambda k: F.xxhash64(F.lit(1), k)))
        keyed = keyed.withColumn("found", F.zip_with("found", found, lambda a, b: F.greatest(a, b)))
        if i + MAX_KEYS < len(listed):
            keyed = saved(keyed, "url-parts")       # one part's filters in memory at a time
    hit = keyed.withColumn("at", F.array_position(F.transform("found", lambda i: i >= 0), True).cast("int"))
    named = F.array(*[F.lit(x) for x in names]) if names else F.array(F.lit(default))
    return hit.select(
        "record", "host", "path",
        F.when(F.col("at") > 0, F.get("keys", F.col("at") - 1)).alias("rule"),
        F.when(F.col("at") > 0, F.get(named, F.get("found", F.col("at") - 1))).otherwise(F.lit(default)).alias("verdict"))


def _memberships(shared):
    @F.pandas_udf("array<int>")
    def memberships(h1: pd.Series, h2: pd.Series) -> pd.Series:
        """For each of a url's keys the cascade that lists it, or -1."""
        sizes = h1.map(len).to_numpy()
        a = np.concatenate([np.zeros(0, np.int64), *h1]).astype(np.int64)
        b = np.concatenate([np.zeros(0, np.int64), *h2]).astype(np.int64)
        found = np.full(len(a), -1, np.int32)
        for i, c in enumerate(shared.value):
            found[c.member(a, b)] = i
        return pd.Series(np.split(found, np.cumsum(sizes)[:-1]))
    return memberships
