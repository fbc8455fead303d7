import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import make

from sparkfolio.llm import bpe as B

ENCODING = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=B.read_ranks(public_tokenizers.path(B.MULTI_50K)))
TEXTS = ["", "a", "I'll we'RE  it's\n\n  x\t\ty ", "漢字かな混じり文 🙂🙂 été" * 30, "x" * 700, " " * 300, "word " * 200, "a1b2'c3 d's't" * 40,
         "\n".join(["  indent", "\t\ttabs", "trailing  "] * 40), "<|endoftext|> " * 5, "no" + " " * 90 + "sync" * 80]


def expected(text):
    return ENCODING.encode_ordinary(text or "")


@pytest.mark.parametrize("chunk,overlap", [(40, 8), (64, 32), (10_000, 100)])
def test_chunks_equal_the_library(spark, chunk, overlap):
    rows = list(enumerate(TEXTS))
    got = {r["record"]["doc_id"]: r for r in B.decode(B.encode(make(spark, rows), chunk=chunk, overlap=overlap)).collect()}
    for i, t in rows:
        assert got[i]["ids"] == expected(t) and bytes(got[i]["decoded"]) == t.encode()


def test_odd_rows(odd, odd_rows, nothing):
    coded = B.decode(B.encode(odd, chunk=1_000, overlap=64))
    got = sorted((str(r["record"]["doc_id"]), str(r["record"]["text"]), r["ids"], bytes(r["decoded"])) for r in coded.collect())
    assert got == sorted((str(i), str(t), expected(t), (t or "").encode()) for i, t, *_ in odd_rows)
    assert B.decode(B.encode(nothing)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text("ab1' \n.é漢", max_size=120), st.integers(8, 30))
def test_sync_points_are_boundaries(text, chunk):
    """Wherever runs meet, the whole text's pre-tokens have a boundary."""
    pattern, overlap = regex.compile(public_tokenizers.PATTERN), 12
    true = {0, *(m.end() for m in pattern.finditer(text))}
    runs = []
    for i, at in enumerate(range(0, max(1, len(text)), chunk)):
        found = B.boundaries(text[at:at + chunk + overlap], pattern, at + chunk + overlap >= len(text))
        runs.append((i, [int(x) for x in found if x <= overlap], [int(x) for x in found if x >= chunk]))
    points = B.sync_points(runs, chunk)
    if points is not None:
        assert points == sorted(points) and set(points) <= true
        pieces = [text[a:z] for a, z in zip(points, [*points[1:], len(text)])]
        assert [i for p in pieces for i in ENCODING.encode_ordinary(p)] == expected(text)


def test_query(spark):
    from sparkfolio.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op4_bpe_round_trip"](spark, sf).collect():
        ids = expected(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_runs_of_millions(spark):
    """White space on which the library's own search has no stack left, and one word of millions of letters."""
    n = 3_000_000
    texts = ["x " + " " * n + "a", "\n" * n + "a", "a" * n, "ok"]
    from sparkfolio.llm.packing import token_pieces
    coded = B.decode(B.encode(make(spark, list(enumerate(texts)))))
    got = {r["id"]: r for r in coded.selectExpr("record.doc_id id", "size(ids) n", "sha2(decoded, 256) h").collect()}
    for i, t in enumerate(texts):
        assert got[i]["h"] == hashlib.sha256(t.encode()).hexdigest()
    assert [got[i]["n"] for i in range(4)] == [n + 2, n + 1, len(ENCODING._encode_single_piece(b"a" * n)), 1]
    pieces = token_pieces(make(spark, list(enumerate(texts))))
    assert {r["id"] for r in pieces.selectExpr("record.doc_id id").distinct().collect()} == {0, 1, 2, 3}


@settings(max_examples=100, deadline=None)
@given(st.text("ab1' \n\t.é漢", max_size=60), st.integers(0, 3))
def test_own_pretokens_equal_the_library(text, k):
    B.LONG_SPACE, B.SPACES, old = 1, regex.compile(r"\s"), (B.LONG_SPACE, B.SPACES)
    try:
        assert B.encode_text(ENCODING, regex.compile(public_tokenizers.PATTERN), text + " " * k) == ENCODING.encode_ordinary(text + " " * k)
    finally:
        B.LONG_SPACE, B.SPACES = old
