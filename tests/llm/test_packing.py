import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import make
from tokenizers import Tokenizer

from sparkfolio.llm import packing as P

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(P.BYTE_50K))


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=30), st.integers(1, 12), st.sampled_from(P.LARGE + (1 / 8,)))
def test_plan_is_a_packing(counts, groups, large):
    runs, n = P.plan(counts, 64, groups, large)
    ranks, used, seen = defaultdict(list), defaultdict(list), set()
    for length, rank, seq, offset, c in runs.tolist():
        ranks[length] += range(rank, rank + c)
        for i in range(c):
            used[seq + i].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(c)) for k, c in counts.items()}
    assert set(used) == set(range(n))
    for pieces in used.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    if counts:
        lengths = np.repeat(list(counts), list(counts.values()))
        ranks = np.concatenate([np.arange(c) for c in counts.values()])
        got = P.lookup(runs, lengths, ranks)
        assert len(set(zip(got["sequence_id"], got["offset"]))) == len(lengths)


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(0)
    lengths = np.clip(rng.lognormal(6, 1, 20_000).astype(int), 1, 2048)
    values, n = np.unique(lengths, return_counts=True)
    _, sequences = P.best_plan(dict(zip(values.tolist(), n.tolist())))
    assert sequences <= 1.002 * np.ceil(lengths.sum() / 2048)


def test_equal_groups():
    groups = P.equal_groups({5: 4, 9: 3, 7: 5}, 4)
    assert [sum(n for *_, n in g) for g in groups] == [3, 3, 3, 3]
    assert groups[0] == [(9, 0, 3)] and groups[-1] == [(5, 1, 3)]


TEXTS = ["", "short", "<|endoftext|> in the text", "word " * 3000, "x" * 3000, "é漢🙂 \n\n\t" * 700, None, "a b c"]


def test_pieces_and_sequences(spark, tmp_path):
    rows = list(enumerate(TEXTS)) + [(100 + i, "tok " * (i * 37 % 900)) for i in range(120)]
    pieces = P.token_pieces(make(spark, rows), keep_ids=True)
    packed = P.pack(pieces, rows_per_salt=10)
    docs, places = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        p = r["row"]
        ids = np.array(p["ids"], "<u4")
        assert len(ids) == p["length"] and zlib.crc32(ids.tobytes()) == p["ids_crc32"]
        docs[p["record"]["doc_id"]].append((p["piece"], p["start"], p["ids"]))
        places[r["sequence_id"]].append((r["offset"], p["length"]))
    for i, t in rows:
        want = TOKENIZER.encode(t or "", add_special_tokens=False).ids + [0]
        got = sorted(docs[i])
        assert [x for *_, ids in got for x in ids] == want and [p for p, *_ in got] == list(range(len(got)))
        assert [s for _, s, _ in got] == np.cumsum([0] + [len(ids) for *_, ids in got])[:-1].tolist()
        assert all(len(ids) == 2048 for *_, ids in got[1:])
    for place in places.values():
        end = 0
        for offset, length in sorted(place):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(n for p in places.values() for _, n in p)
    assert len(places) <= np.ceil(total / 2048) + 1
    P.write_sequences(packed, str(tmp_path / "packed"))
    assert spark.read.parquet(str(tmp_path / "packed")).count() == packed.count()


def test_odd_rows(odd, odd_rows, nothing):
    rows = P.pack(P.token_pieces(odd)).collect()
    assert sum(r["row"]["length"] for r in rows) == sum(len(TOKENIZER.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in odd_rows)
    assert P.pack(P.token_pieces(nothing)).collect() == []


def test_both_coders_agree(documents):
    with open(public_tokenizers.path(P.BYTE_50K), encoding="utf-8") as f:
        coder = P.Coder(f.read())
    assert coder.fast is not None
    for r in documents.select("text").collect():
        assert coder(r["text"]).tolist() == TOKENIZER.encode(r["text"], add_special_tokens=False).ids


@pytest.mark.parametrize("lengths", [[0], [2049]])
def test_wrong_lengths_are_refused(spark, lengths):
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(x,) for x in lengths], "length long"))
