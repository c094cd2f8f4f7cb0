"""Whether a pair is found doesn't depend on how many other texts there are."""

import random

import pytest

from granary.llm import neardup


def edited(rng, words):
    """A copy with single words replaced so that the similarity is about 0.7."""
    out = list(words)
    for k in rng.sample(range(0, len(words) - 6, 6), round(len(words) * 0.0355)):
        out[k] = f"e{rng.randrange(10**9)}"
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = []
    for _ in range(1_200):
        words = [f"w{rng.randrange(10**9)}" for _ in range(rng.randint(90, 200))]
        out += [" ".join(words), " ".join(edited(rng, words))]
    return list(enumerate(out))


def links(spark, texts):
    df = spark.createDataFrame(texts, "chunk_id BIGINT, code STRING").repartition(3)
    return {tuple(r) for r in neardup.near_duplicates(df)[1].collect()}


def test_size_changes_no_pair(spark, texts, monkeypatch):
    few = links(spark, texts)
    monkeypatch.setattr(neardup, "LONG_KEYS", 1)
    assert links(spark, texts) == few
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 1)
    assert neardup.same_keys(len(texts)).split > 0 and links(spark, texts) == few
    assert len(few) > 500


def test_keys_are_the_same_for_any_number():
    for n in (0, 1_000, 8_000_000, 9_000_000, 50_000_000, 4_000_000_000):
        assert neardup.same_keys(n).probes == 1 and neardup.same_keys(n).split == neardup.layout_for(n).split
