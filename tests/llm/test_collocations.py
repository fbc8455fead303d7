import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_frames import SCHEMA

from sparkfolio.llm import collocations as C
from sparkfolio.llm import wordcodes
from sparkfolio.llm.textarrays import text_slices

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, max_words, min_count, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    f = {p: c for p, c in f.items() if c >= min_count}
    inside = set()
    for p, c in f.items():
        for i in range(1, len(p)):
            for j in range(i + 1, len(p) + 1):
                if j - i < len(p) - 1 and f[p[:1] + p[i:j]] <= c:
                    inside.add(p[:1] + p[i:j])
    out = []
    for p, a in f.items():
        if len(p) < 3 or p in inside:
            continue
        lang, w = p[0], p[1:]
        cuts = [(1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, f[(lang, *w[:k])], f[(lang, *w[k:])], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(mine[:top])]
    return sorted(ranked)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None) for i, (t, lang) in enumerate(rows)], SCHEMA)


def got(df, **args):
    return sorted(tuple(r) for r in C.mine(df, **args).collect())


def corpus(seed, n, vocabulary=8):
    r = random.Random(seed)
    words = [chr(97 + i) * (i % 3 + 1) for i in range(vocabulary)] + ["É", "漢字", "x\x00y", "A"]
    out = []
    for _ in range(n):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "\t ", ". ", "\n", " , "]) for _ in range(r.randrange(0, 40)))
        out.append((text + " new york city" * r.randrange(3), r.choice(["en", "de", None, "und"])))
    return out


@pytest.mark.parametrize("seed,min_count,top", [(1, 3, 2000), (2, 8, 7)])
def test_equals_brute_force(spark, seed, min_count, top):
    rows = corpus(seed, 120)
    want = brute(rows, 5, min_count, top)
    assert len(want) > 10 and got(frame(spark, rows), min_count=min_count, top=top) == want


def test_a_phrase_that_only_occurs_inside_another_is_left_out(spark):
    rows = [("big red dog runs", "en")] * 5 + [("red dog", "en")]
    phrases = {r[2] for r in got(frame(spark, rows), min_count=5)}
    assert phrases == {"big red dog runs", "red dog"} == {r[2] for r in brute(rows, 5, 5, 10)}


def test_hot_prefixes_are_cut_into_fragments_and_still_add_up(spark):
    """One word a third of all, before very many others."""
    rows = [(f"the {w} the {w} end", "en") for w in (f"w{i % 700}" for i in range(2100))]
    assert got(frame(spark, rows), min_count=3) == brute(rows, 5, 3, 2000)


def test_odd_rows_and_no_rows(spark, odd, odd_rows, nothing):
    rows = [(r[1], r[2]) for r in odd_rows]
    assert got(odd, min_count=2) == brute(rows, 5, 2, 2000)
    assert got(nothing, min_count=1) == [] and C.mine(nothing).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got(odd.where("text is null"), min_count=1) == []


def test_products_beyond_64_bits(spark):
    """The quotient's parts need more than 64 bits; the scores stay exact."""
    counts = {("big", "cat"): 3_000_000_019, ("big",): 4_000_000_007, ("cat",): 5_000_000_029}
    score = 1000 * counts["big", "cat"] * 10**13 // (counts["big",] * counts["cat",])
    row = spark.sql(f"SELECT CAST(1000 AS DECIMAL(19,0)) * CAST({counts['big', 'cat']} AS DECIMAL(19,0)) * CAST({10**13} AS DECIMAL(19,0)) div "
                    f"(CAST({counts['big',]} AS DECIMAL(19,0)) * CAST({counts['cat',]} AS DECIMAL(19,0))) AS x").first()
    assert row["x"] == score and math.log2(1000 * counts["big", "cat"] * 10**13) > 64


def test_long_text_in_parts_has_the_same_stripes():
    """Parts end with a piece, so counts do not change."""
    text = " ".join(f"{a} {b}." for a, b in zip("abcab" * 300, "xyzzy" * 300))

    def total(size):
        out = Counter()
        for whole in text_slices(pa.array([text], pa.large_string())):
            for part in wordcodes.parts(whole, C.PIECE_END, size):
                b = C.stripes(C.Words(part), np.zeros(len(part), np.int64), ["en"], 0, None)
                for x, n in zip(b["next"].to_pylist(), b["n"].to_pylist()):
                    out.update(dict(zip(x.split(" "), map(int, n.split(" ")))))
        return out
    assert total(1 << 20) == total(100) == total(7) == Counter(re.findall("[a-z]", text))
