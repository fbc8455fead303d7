import collections
import re

import numpy as np
import pytest

from sparkfolio.llm import quality as Q

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(re.search(WORD, line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def key(r):
    return (r["record"]["doc_id"] is None, r["record"]["doc_id"] or 0)


@pytest.mark.parametrize("frame", ["odd", "documents"])
def test_statistics_equal_brute_force(frame, request):
    df = request.getfixturevalue(frame)
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, *brute(r["text"])) for r in df.collect())
    got = sorted((*key(r), *(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))) for r in Q.rule_statistics(df).collect())
    assert got == want


def test_verdicts(documents, labels):
    rows = Q.judge(documents, labels).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert 0 <= r["score"] <= 1 and not (r["base_failed"] and r["kept"])
    good = {r["doc_id"]: r["quality"] for r in labels.collect()}
    judged = [(good[r["record"]["doc_id"]], r["kept"]) for r in rows if r["record"]["doc_id"] in good and not r["base_failed"]]
    clean = [k for g, k in judged if g]
    assert sum(clean) >= 0.95 * len(clean)


def test_no_labels_and_no_rows(spark, odd, nothing, labels):
    none = labels.limit(0)
    rows = Q.judge(odd, none).collect()
    assert len(rows) == odd.count() and all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert Q.judge(nothing, labels).collect() == []


def test_forest_isolates_outliers():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    x[:10] += 12
    scores = Q.fit_forest(x, [0, 0, 0]).scores(x)
    assert set(np.argsort(-scores)[:10]) == set(range(10))
    alike = np.ones((50, 3))
    assert len(set(Q.fit_forest(alike, [0, 0, 0]).scores(alike))) == 1
