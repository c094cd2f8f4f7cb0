"""Mixes reach their goals within limits; the multipliers against a bisection."""

import math
import os
import random

import pytest

from granary.llm import bpe, mixing

pytestmark = pytest.mark.skipif(not os.path.isdir(bpe.TOKENIZER_DIR), reason="no tokenizer files")


def test_multipliers(spark):
    rng = random.Random(5)
    t = [rng.randint(1, 500) for _ in range(200)]
    groups = spark.createDataFrame([("s", x, 1) for x in t], "source STRING, t BIGINT, n BIGINT")
    mean = sum(t) / len(t)
    total = lambda lam, most: sum(x * min(most, math.exp(min(600, lam * x / mean))) for x in t)
    for share, most in ((0.01, 1), (0.5, 1), (1.4, 2), (1.99, 2), (4.7, 5)):
        goal = share * sum(t)
        lam = mixing.solve(groups, {("m", "s"): (goal, most, mean)})["m", "s"]
        assert abs(total(lam, most) - goal) <= 2e-3 * goal, (share, most)


def test_mix(spark):
    rng = random.Random(6)
    text = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randint(5, 80)))
    rows = [(i, text(), "Big-One" if i % 3 else " big_one", 7) for i in range(600)] + [(1000 + i, text(), "small", 7) for i in range(12)] + [(5000, None, "small", 7), (5001, "", "small", 7), (5002, "x y", None, 7), (1, "twice", "other", 7), (1, "twice", "other", 7)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING, n_tokens INT")
    targets = spark.createDataFrame([("m", "big one", 0.5, 2), ("m", "small", 0.4, 3), ("m", "gone", 0.1, 4), ("z", "other", 1.0, 1), ("z", "big one", 0.0, 1)], "mix_id STRING, source STRING, target_share DOUBLE, max_repeats INT")
    copies, shares = mixing.mix_sources(docs, targets)
    s = {(r["mix_id"], r["source"]): r for r in shares.collect()}
    c = copies.collect()
    limit = {"big one": 2, "small": 3, "other": 1}
    assert all(1 <= r["copies"] <= limit[r["source"]] for r in c) and not {5000, 5001, 5002} & {r["doc_id"] for r in c}
    big = s["m", "big one"]
    assert abs(big["tokens"] - big["goal_tokens"]) < 0.02 * big["goal_tokens"] and not big["limited"]
    assert s["m", "small"]["limited"] and s["m", "small"]["tokens"] == 3 * s["m", "small"]["available_tokens"]
    assert s["m", "gone"]["tokens"] == 0 and s["z", "big one"]["tokens"] == 0 and s["z", "other"]["actual_share"] == 1.0
    again = mixing.mix_sources(docs.repartition(5), targets)[0].collect()
    assert sorted(map(tuple, c)) == sorted(map(tuple, again))
    assert sum(r["tokens"] for r in mixing.mix_sources(docs, targets.where("mix_id = 'm'"), total_tokens=1000)[1].collect()) <= 1000
    exact = {(r["mix_id"], r["source"]): r for r in mixing.mix_sources(docs, targets, total_tokens="exact")[1].collect()}
    assert not any(r["limited"] for r in exact.values() if r["n_docs"])
    assert abs(exact["m", "big one"]["actual_share"] - 0.5 / 0.9) < 0.02 and abs(exact["m", "small"]["actual_share"] - 0.4 / 0.9) < 0.02
    assert exact["m", "small"]["exact_total"] == int(3 * exact["m", "small"]["available_tokens"] / 0.4)


def test_gaps(spark, data):
    for r in mixing.p7_gaps(spark, data.replace("sf0.001", "sf0.1")).collect():
        assert r["exact_gap"] is None or r["exact_gap"] < 0.01, r


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING, source STRING")
    targets = spark.createDataFrame([("m", "a", 1.0, 2)], "mix_id STRING, source STRING, target_share DOUBLE, max_repeats INT")
    copies, shares = mixing.mix_sources(docs, targets)
    assert copies.count() == 0 and [r["tokens"] for r in shares.collect()] == [0]
    assert mixing.mix_sources(docs, targets.limit(0))[1].count() == 0
