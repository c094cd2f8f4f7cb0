"""Fuzzy hashing against brute force, and the code's own properties."""

import itertools
import random
import re

import numpy as np
import pytest

from granary.llm import golay, neardup
from granary.llm.shingles import portions, shingle

TOKEN = re.compile(r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]")


def shingles(text, width=5):
    t = TOKEN.findall(text)
    return {tuple(t[i : i + width]) for i in range(len(t) - width + 1)}


def similarity(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 0.0


def make(rng, n=120):
    names = [f"v{rng.randrange(400)}" for _ in range(60)]
    return " ".join(rng.choice(names) + rng.choice(["(", ")", " = ", ";\n", ", ", "é", " "]) for _ in range(n))


def edited(rng, text, k):
    t = text.split(" ")
    for _ in range(k):
        t[rng.randrange(len(t))] = f"w{rng.randrange(9999)}"
    return " ".join(t)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    rows, base = [], [make(rng) for _ in range(120)]
    for b in base:
        rows.append(b)
        for k in (0, 2, 5, 9):
            if rng.random() < 0.6:
                rows.append(edited(rng, b, k))
    rows += [base[0] + " " + make(rng, 60), None, "", "short text"]
    return list(enumerate(rows))


def brute(rows):
    live = [(i, t) for i, t in rows if t and len(TOKEN.findall(t)) >= 60]
    return {(a, b) for (a, x), (b, y) in itertools.combinations(live, 2) if similarity(x, y) >= 0.7}


def test_code():
    words = np.array([golay.codeword(m) for m in range(4096)])
    weights = {int(w): int(n) for w, n in zip(*np.unique([bin(w).count("1") for w in words], return_counts=True))}
    assert weights == {0: 1, 8: 759, 12: 2576, 16: 759, 24: 1} and not golay.syndrome(words.astype(np.uint32)).any()
    _, nearest = golay.tables()
    assert {len(set(r)) for r in nearest.tolist()} == {1, 6}


def test_decoding_corrects_three_errors():
    rng = np.random.default_rng(3)
    m = rng.integers(0, 4096, 200)
    y = np.array([[1.0 if golay.codeword(int(x)) >> i & 1 else -1.0 for i in range(24)] for x in m])
    for row in y:
        row[rng.choice(24, 3, replace=False)] *= -0.4
    assert (golay.nearby(y.astype(np.float32), 1)[:, 0] == m).all()


def test_shingles_equal_python():
    rng = random.Random(2)
    texts = [make(rng, n) for n in (1, 4, 50, 300)] + ["", "a", "é é　é", "x" * 3000, "a b c d e " * 40, "\r\n tab\tb c d e f", "_a1 B2 \U0001f600\U0001f600 c d"]
    s = shingle(texts)
    for i, t in enumerate(texts):
        assert s.n_tokens[i] == len(TOKEN.findall(t)) and s.first[i + 1] - s.first[i] == len(shingles(t)), t
    again = shingle(texts[2:4])
    assert (again.shingles[: again.first[1]] == s.shingles[s.first[2] : s.first[3]]).all() and (again.sequence[1] == s.sequence[3]).all()
    assert [p.stop - p.start for p in portions(["x" * 10] * 5, 25)] == [2, 2, 1]


def test_pairs_equal_brute_force(spark, corpus):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in corpus], "chunk_id BIGINT, code STRING, id STRING, rep INT").repartition(3)
    members, links = neardup.near_duplicates(df)
    got = [(r["a"], r["b"]) for r in neardup.all_pairs(members, links).collect()]
    want = brute(corpus)
    assert len(got) == len(set(got)) and set(got) <= want and len(set(got)) >= 0.99 * len(want) and len(want) > 100
    assert members.count() == sum(1 for _, t in corpus if t and len(TOKEN.findall(t)) >= 60)


LAYOUTS = [neardup.Layout(1), neardup.Layout(2), neardup.Layout(1, 2), neardup.Layout(2, 1)]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_every_layout_finds_the_pairs(spark, corpus, layout):
    df = spark.createDataFrame(corpus, "chunk_id BIGINT, code STRING")
    got = {tuple(r) for r in neardup.all_pairs(*neardup.near_duplicates(df, layout=layout)).collect()}
    want = brute(corpus)
    assert got <= want and len(got) >= 0.99 * len(want)


def test_layouts_follow_the_number_of_texts():
    assert neardup.layout_for(0) == neardup.layout_for(1000) == neardup.Layout(1)
    assert neardup.layout_for(50_000_000) == neardup.Layout(2) and neardup.layout_for(4_000_000_000) == neardup.Layout(2, 2)
    for n in (10**5, 10**7, 10**9, 10**11):  # mean rows of a bucket's part stay bounded
        assert n * 4 / 4096 / (1 << neardup.layout_for(n).split) <= neardup.BUCKET_ROWS


@pytest.mark.parametrize("layout", LAYOUTS)
def test_records_a_text_do_not_grow(layout):
    """Bytes that travel for a text: 28 records, in parted buckets 8 times as many at most, whatever the corpus."""
    rng = random.Random(5)
    s = shingle([make(rng) for _ in range(200)], 5, 60)
    prints = neardup.fingerprints(s.first, s.shingles, layout)
    rec = neardup._records(prints, np.arange(200), layout)
    assert 0.9 * 28 * 200 < len(rec) <= 28 * 200 * min(neardup.MORE_KEYS, 1 << layout.split)
    assert layout.record_type.itemsize in (44, 56)


def test_shards_are_even():
    rng = np.random.default_rng(1)
    rows = rng.poisson(40, 28_672)
    shard, n = neardup.shards_of(rows, 42, {})
    size = np.bincount(shard, rows, n)
    assert n >= 8 and size.max() <= 1.05 * size.mean() and size.min() > 0.9 * size.mean()
    empty = neardup.shards_of(np.zeros(28_672, np.int64), 42, {})
    assert empty[1] == 1


@pytest.mark.parametrize("layout", LAYOUTS[:3])
def test_hot_buckets_give_the_same_pairs(spark, corpus, monkeypatch, layout):
    """A family of a third of all texts: its buckets are cut into blocks, each pair of blocks a task of its own."""
    rng = random.Random(6)
    base = make(rng)
    rows = corpus[:120] + [(1000 + i, edited(rng, base, rng.randrange(4))) for i in range(60)]
    df = spark.createDataFrame(rows, "chunk_id BIGINT, code STRING")
    whole = {tuple(r)[:2] for r in neardup.near_duplicates(df, layout=layout)[1].collect()}
    monkeypatch.setattr(neardup, "HOT_BUCKET", 20)
    assert {tuple(r)[:2] for r in neardup.near_duplicates(df, layout=layout)[1].collect()} == whole and len(whole) > 500


def test_a_hot_family_costs_blocks_not_masks(monkeypatch):
    """With nearly all buckets cut, a batch of 2,000 texts is laid out in seconds; a hot row travels once for each block."""
    import time

    rng = np.random.default_rng(2)
    layout = neardup.Layout(1)
    prints = np.zeros(2000, layout.print_type)
    prints["first"] = neardup.pack(np.sort(rng.integers(0, 4096, (2000, neardup.BANDS, neardup.FIRST_KEYS)), axis=-1))
    rec = neardup._records(prints, np.arange(2000), layout)
    began = time.time()
    neardup.compare(rec, layout, 45, 0.7, (rec["id"] % 2).astype(np.int16))
    assert time.time() - began < 20


def test_classes_are_written_in_parts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CLASS_ROWS", 7)
    members = spark.createDataFrame([(i, 0, 40) for i in range(40)] + [(i, 100, 10) for i in range(100, 110)] + [(200, 200, 1)], "id BIGINT, rep BIGINT, n BIGINT")
    links = spark.createDataFrame([(0, 100), (100, 200)], "a BIGINT, b BIGINT")
    got = [tuple(r) for r in neardup.all_pairs(members, links).collect()]
    a, b = range(40), range(100, 110)
    want = {*itertools.combinations(a, 2), *itertools.combinations(b, 2), *((x, y) for x in a for y in b), *((x, 200) for x in b)}
    assert len(got) == len(want) and set(got) == want


def test_beyond_the_broadcast_bound(spark, corpus, monkeypatch):
    df = spark.createDataFrame(corpus, "chunk_id BIGINT, code STRING")
    whole = {tuple(r)[:2] for r in neardup.near_duplicates(df)[1].collect()}
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    assert {tuple(r)[:2] for r in neardup.near_duplicates(df)[1].collect()} == whole


def test_many_copies_are_one_class(spark):
    rng = random.Random(9)
    a, b = make(rng), make(rng)
    df = spark.createDataFrame([(i, a) for i in range(300)] + [(1000, b), (1001, edited(rng, a, 3))], "chunk_id BIGINT, code STRING")
    members, links = neardup.near_duplicates(df)
    assert {r["rep"] for r in members.collect()} == {0, 1000, 1001} and [(r["a"], r["b"]) for r in links.collect()] == [(0, 1001)]


def test_empty(spark):
    members, links = neardup.near_duplicates(spark.createDataFrame([], "chunk_id BIGINT, code STRING"))
    assert members.count() == 0 and links.count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 205), (50, 205)]
    got = {r["id"]: r["root"] for r in neardup.components(spark.createDataFrame(chain, "a BIGINT, b BIGINT")).collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[i] for i in (50, 100, 101, 205)} == {50}
    assert neardup.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_packing():
    k = np.random.default_rng(1).integers(0, 4096, (5, 3, 8)).astype(np.uint16)
    assert neardup.pack(k).shape == (5, 3, 12) and (neardup.unpack(neardup.pack(k)) == k).all()
