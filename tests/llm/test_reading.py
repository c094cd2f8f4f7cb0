"""Reading levels: held-out accuracy, isotonic steps, edge cases."""

import random

import numpy as np

from granary.llm import reading as R

EASY = ["The cat sees the box.", "You can open the list now.", "A user reads the page and then the key.", "Put the file here."]
PLAIN = ["The build script updates the cache entry during the nightly build.", "Most problems come from a missing permission in the service account.", "The request handler restarts when the memory limit is reached."]
HARD = ["Notwithstanding the apparent simplicity, linearizability necessitates a rigorous characterization of invariants.", "The probabilistic cardinality estimator corroborates the amortized reallocation cost.", "Consequently, asymptotic dominance presupposes heterogeneous scheduling hierarchies."]


def text(rng, level):
    pools = [EASY, PLAIN, HARD]
    return " ".join(rng.choice(pools[level] if rng.random() < 0.85 else rng.choice(pools)) for _ in range(rng.randint(6, 15)))


def test_levels(spark):
    rng = random.Random(8)
    docs = [(i, text(rng, i % 3), i % 3) for i in range(180)]
    labels = [(i, R.LEVELS[k] if i >= 60 else None, "r") for i, _, k in docs] + [(100, "beginner", "q"), (3, None, None), (900, None, None), (901, None, None), (902, None, None), (None, "advanced", "r"), (101, "odd", "r")]
    d = spark.createDataFrame([(i, t) for i, t, _ in docs] + [(900, None), (901, "")], "doc_id BIGINT, text STRING")
    grader = R.Grader(R.graded_sample(d, spark.createDataFrame(labels, "doc_id BIGINT, level STRING, rater STRING")))
    got = {r["doc_id"]: r for r in R.reading_levels(d, grader).collect()}
    assert sum(got[i]["level"] == R.LEVELS[k] for i, _, k in docs[:60]) >= 57
    assert got[900]["score"] is None and got[900]["level"] in R.LEVELS and len(got) == 182
    assert got[0]["score"] < got[1]["score"] < got[2]["score"]


def test_isotonic():
    rng = np.random.default_rng(1)
    x, y = rng.random(200), rng.random(200)
    px, py = R.isotonic(x, y + x)
    assert (np.diff(py) > 0).all() and (np.diff(px) > 0).all()
    px, py = R.isotonic(np.array([1.0, 1.0, 2.0]), np.array([0.0, 2.0, 1.0]))
    assert py.tolist() == [1.0]


def test_surprisal_is_a_distribution():
    m = R.NgramModel(R.sentences(" ".join(PLAIN)))
    assert m.surprisal("the", "build", "script") < m.surprisal("the", "build", "zebra")
    assert R.sentences("# Title here now\n\n```\ncode in here\n```\n- one two three\n") == [["one", "two", "three"]]


def test_nothing_graded(spark):
    d = spark.createDataFrame([(1, EASY[0])], "doc_id BIGINT, text STRING")
    grader = R.Grader(R.graded_sample(d, spark.createDataFrame([], "doc_id BIGINT, level STRING, rater STRING")))
    assert R.reading_levels(d, grader).first()["level"] is None and R.reading_levels(d.limit(0), grader).count() == 0
