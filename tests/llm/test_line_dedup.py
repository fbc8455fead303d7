import random
import re

import pyarrow as pa
import pytest
from llm_frames import make, prose

from sparkfolio.llm import line_dedup as L
from sparkfolio.llm.textarrays import text_slices


def out(df):
    return {r["record"]["doc_id"]: r for r in L.dedup_lines(df).collect()}


def line(seed, n=8):
    return prose(seed, n)


def test_shared_passage_stays_once_wherever_it_stands(spark):
    """Shifted, at the start, in the middle and at the end."""
    passage = [line(900 + i, 10) for i in range(8)]
    rows = []
    for d in range(12):
        own = [line(1000 * d + i) for i in range(5 + d)]
        at = [0, d % 5 + 1, len(own)][d % 3]
        rows.append((d, "\n".join(own[:at] + passage + own[at:])))
    got = out(make(spark, rows))
    for d, text in rows:
        lines = text.split("\n")
        want = lines if d == 0 else [x for x in lines if x not in passage]
        assert got[d]["text"].split("\n") == want, d
        assert (got[d]["n_lines"], got[d]["n_removed"]) == (len(lines), len(lines) - len(want))


def test_long_single_line_and_short_lines(spark):
    long, short = line(1, 60), line(2, 5)
    got = out(make(spark, [(d, "\n".join([line(10 * d + 50), long, line(10 * d + 51), short])) for d in range(5)]))
    assert [long in got[d]["text"] for d in range(5)] == [True] + [False] * 4
    assert all(short in got[d]["text"] for d in range(5))


def test_repeat_inside_one_text_and_equal_texts(spark):
    long = line(1, 40)
    got = out(make(spark, [(1, f"{long}\n{line(5)}\n{long}"), (2, f"{line(8, 30)}\n{line(9, 30)}"), (3, f"{line(8, 30)}\n{line(9, 30)}")]))
    assert got[1]["text"] == f"{long}\n{line(5)}"
    assert got[2]["n_removed"] == 0 and got[3]["text"] == "" and got[3]["n_removed"] == 2


def test_no_line_is_lost_and_nothing_else_goes(spark):
    """Random texts of shared and own lines: every distinct line remains somewhere, and
    what was removed had occurred before."""
    r = random.Random(3)
    pool = [[line(100 * p + i, r.randrange(3, 30)) for i in range(r.randrange(1, 7))] for p in range(20)]
    rows = []
    for d in range(80):
        text = []
        for k in range(r.randrange(1, 6)):
            text += r.choice(pool) if r.random() < 0.5 else [line(10_000 + 50 * d + k)]
        rows.append((d, "\n".join(text)))
    got = out(make(spark, rows))
    kept, seen = {x for g in got.values() for x in g["text"].split("\n")}, set()
    for d, text in rows:
        lines = text.split("\n")
        assert set(lines) <= kept
        left = iter(got[d]["text"].split("\n") if got[d]["n_removed"] < len(lines) else [])
        nxt = next(left, None)
        inside = set()
        for x in lines:
            if x == nxt:
                nxt = next(left, None)
            else:
                assert x in seen or x in inside
            inside.add(x)
        assert nxt is None
        seen |= inside


def test_odd_rows(odd, odd_rows, nothing):
    rows = L.dedup_lines(odd).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        text = r["record"]["text"]
        assert (r["text"] is None) == (text is None) and r["n_lines"] == (0 if text is None else text.count("\n") + 1)
    assert sorted(r["text"] for r in rows if r["record"]["doc_id"] == 1) == [prose(7, 80)] * 2      # equal rows are one document
    assert L.dedup_lines(nothing).collect() == []


def spans_of(text):
    """Plain twin of the windows, and the chunks: (first line, end) of all spans that go if they repeat."""
    lines = text.split("\n")
    n = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
    out = set()
    for i in range(len(lines)):
        on = next((z for z in range(i + 1, len(lines) + 1) if sum(n[i:z]) >= L.LONG_WORDS), None)
        up = next((a for a in range(i, -1, -1) if sum(n[a:i + 1]) >= L.LONG_WORDS), None)
        out |= ({(i, on)} if n[i] and on else set()) | ({(up, i + 1)} if n[i] and up is not None else set())
    c = L.chunks(next(text_slices(pa.array([text]))))
    every = {(int(a), int(a + k)) for a, k in zip(c["line"], c["n_lines"])}
    assert out <= every and all(sum(n[a:z]) >= L.MIN_WORDS for a, z in every)
    return every


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    """Every span that occurred before goes, by its text alone, and nothing else."""
    r = random.Random(seed)
    pool = [line(50 * seed + i, r.choice([0, 1, 2, 5, 9, 14, 30])) for i in range(40)]
    rows = []
    for d in range(40):
        text = []
        for _ in range(r.randrange(0, 5)):
            at = r.randrange(len(pool))
            text += pool[at:at + r.randrange(1, 12)] if r.random() < 0.7 else [line(10_000 + d, 4), ""]
        rows.append((d, "\n".join(text)))
    seen, want = set(), {}
    for d, text in rows:
        lines, gone = text.split("\n"), set()
        for a, z in sorted(spans_of(text)):
            part = "\n".join(lines[a:z])
            gone |= set(range(a, z)) if part in seen else set()
            seen.add(part)
        want[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    got = out(make(spark, rows))
    assert {d: got[d]["text"] for d in got} == want


SHAPES = [(3, 18), (4, 13), (5, 11), (6, 9), (11, 5), (30, 2), (60, 1), (2, 26)]


def test_passages_of_short_lines_with_other_neighbours(spark):
    """Passages of 51 words and more in lines of any length, six pairs of each shape."""
    rows, passages = [], {}
    for s, (n, size) in enumerate(SHAPES):
        for pair in range(6):
            at = 10_000 * s + 1_000 * pair
            passage = [f"{s}x{pair}x{i} " * (size - 1) + f"e{s}x{pair}x{i}" for i in range(n)]
            for d in (0, 1):
                doc = 100 * s + 10 * pair + d
                own = [[line(at + 500 * d + 200 * side + i, 4) + f" {doc}" for i in range(3)] for side in (0, 1)]
                rows.append((doc, "\n".join(own[0] + passage + own[1])))
                passages[doc] = (own, passage)
    got = out(make(spark, rows))
    for doc, (own, passage) in passages.items():
        want = own[0] + (passage if doc % 10 == 0 else []) + own[1]
        assert got[doc]["text"].split("\n") == want, doc


def test_blank_lines_and_a_tail_of_short_lines(spark):
    """A line of 24 words, then words one a line between blank ones, to the end of the passage."""
    passage = [line(1, 24), "", "a1", ""] + [x for i in range(23) for x in (f"t{i}", "", "")] + ["last"]
    got = out(make(spark, [(d, "\n".join([f"own {d}"] + passage + [f"end {d}"])) for d in range(3)]))
    assert got[0]["n_removed"] == 0 and [got[d]["text"] for d in (1, 2)] == ["own 1\nend 1", "own 2\nend 2"]
