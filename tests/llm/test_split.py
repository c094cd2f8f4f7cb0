"""Pieces: limits, overlap, round trip, and edits that stay local."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import split


def rebuilt(text, pieces):
    out, end = "", 0
    for a, b, _ in pieces:
        out += text[end:b]
        end = b
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\r{é😀", max_size=400), st.integers(1, 80), st.integers(0, 90))
def test_pieces_hold_their_bounds(text, most, overlap):
    pieces = split.cuts(text, most, overlap)
    over = min(overlap, most - 1)
    assert rebuilt(text, pieces) == text and pieces[-1][1] == len(text) and pieces[0][0] == 0
    for a, b, _ in pieces:
        assert b - a <= most
    for (a, b, kind), (c, d, _) in zip(pieces, pieces[1:]):
        assert d > b and c == max(0, b - over)
        if kind in ("line", "block"):
            assert text[b - 1] == "\n"
        if kind == "forced":  # no line ends where the piece may end
            assert "\n" not in text[max(a + over, 0) + (1 if a else 0) : a + most - 1][1:] or over


def test_lines_are_kept_where_they_fit():
    text = "\n".join("x" * 30 for _ in range(100))
    assert all(k != "forced" for _, _, k in split.cuts(text, 200, 20))
    blocks = "\n\n".join("def f():\n    a = 1\n    b = 2" for _ in range(60))
    assert {k for _, _, k in split.cuts(blocks, 300, 0)} == {"block", "end"}


def test_an_edit_changes_neighbours_only():
    rng = random.Random(5)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(10, 60))) for _ in range(4000)]
    a = "\n".join(lines)
    lines[2000] = "an edited line that is rather longer than it was before the edit"
    b = "\n".join(lines)
    pieces = lambda t: [t[x:y] for x, y, _ in split.cuts(t, 1000, 100)]
    pa, pb = pieces(a), pieces(b)
    assert len(set(pb) - set(pa)) <= 8 and pa[-1] == pb[-1]


def test_rows(spark):
    limits = spark.createDataFrame([("c", 10, 3), ("*", 20, 2)], "language STRING, max_chars INT, overlap_chars INT")
    rows = [(1, "c", "a" * 10), (2, "c", "a" * 11), (3, "C", "b\n" * 11), (4, None, "é" * 21), (5, "c", None), (6, "c", ""), (2, "c", "a" * 11)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "chunk_id BIGINT, language STRING, code STRING, piece INT, max_chars INT")
    got = split.split_oversized(df, limits).where("piece_no = 0").collect()
    assert sorted((r["chunk_id"], r["cut_kind"]) for r in got) == [(2, "forced"), (2, "forced"), (3, "natural"), (4, "forced")]
    assert all(len(r["piece"]) <= (10 if r["chunk_id"] == 2 else 20) for r in split.split_oversized(df, limits).collect())
    assert split.split_oversized(df.limit(0), limits).count() == 0
    assert {r["chunk_id"] for r in split.split_oversized(df, limits.where("language <> '*'")).collect()} == {2}
