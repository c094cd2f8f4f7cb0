"""Models are fitted on every row: none is chosen, and the counts of tasks add up to those of one pass."""

import random

import numpy as np

from granary.llm import pairs as P
from granary.llm import reading as R

EN = ["The parser reads the file before the next release.", "Most problems come from a wrong path.", "I cannot help with that request.", "Unfortunately I must decline to write this.", "The build script replaces the cache entry."]


def rare(i):
    return "zq" + "".join(chr(97 + i // 26**k % 26) for k in range(3))


def test_pair_models_are_fitted_on_every_row(spark):
    rng = random.Random(3)
    docs = [(i, f"{' '.join(rng.choices(EN, k=5))} It is known as {rare(i)}.", "EN" if i % 2 else "en-us") for i in range(700)]
    docs += [(700 + i, "Le serveur de test bloque le fichier de configuration. " * 4, "fr") for i in range(5)] + [(800, "kurz", "de"), (801, None, "en"), (802, "x", None)]
    answers = [(i, f"{rng.choice(EN)} {rng.choice(EN)} The name is {rare(i // 3)} here.") for i in range(12_000)] + [(-1, None), (-2, "")]
    d = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING").repartition(3)
    a = spark.createDataFrame(answers, "id BIGINT, text STRING").repartition(3)
    got = P.fit(d, a)
    texts = [t for _, t in answers if t is not None]
    languages, endings, refusals = P.LanguageModel([(x[:2].lower(), t) for _, t, x in docs if t and x and x != "de"]), P.EndingModel(texts), P.RefusalModel(map(P.prose, texts))
    assert got.languages.languages == ["en", "fr"] and got.languages.weights == languages.weights and got.languages.unknown == languages.unknown
    assert all(rare(i) in got.languages.weights or f" {rare(i)}"[:4] in got.languages.weights for i in range(700))
    assert (got.endings.table, got.endings.words, got.endings.prior) == (endings.table, endings.words, endings.prior)
    assert {rare(i) for i in range(4_000)} <= got.endings.words & got.refusals.known
    assert got.refusals.known == refusals.known and got.refusals.telling == refusals.telling
    for mine, other in zip(got.refusals.models.models, refusals.models.models):
        assert (mine.one, mine.two, mine.three, mine.context, mine.after) == (other.one, other.two, other.three, other.context, other.after)


def test_grader_is_fitted_on_every_graded_row(spark, monkeypatch):
    monkeypatch.setattr(R, "GRADED_SAMPLE", 30)
    monkeypatch.setattr(R, "LONGEST_GRADED", 500)
    rng = random.Random(4)
    words = ["the cat sees box", "build script updates cache entry", "linearizability necessitates rigorous invariants"]
    docs = [(i, " ".join(f"{rare(i)} {' '.join(rng.choices(words[i % 3].split() + words[rng.randrange(3)].split(), k=6))}." for _ in range(rng.randint(2, 30)))) for i in range(150)]
    labels = [(i, R.LEVELS[i % 3]) for i in range(150)] + [(i, R.LEVELS[(i + 1) % 3]) for i in range(0, 150, 10)] + [(7, None), (200, "advanced"), (None, "beginner"), (201, "beginner")]
    d = spark.createDataFrame([*docs, (3, docs[3][1]), (200, None), (201, "")], "doc_id BIGINT, text STRING").repartition(3)
    l = spark.createDataFrame(labels, "doc_id BIGINT, level STRING")
    monkeypatch.setattr(R, "graded_sample", None)
    got = R.Grader.of(d, l)
    assert all(sum(m.one[rare(i)] for m in got.models.models) for i in range(150) if i % 10 or i % 3 == 2)
    rows = d.join(R._votes(l), "doc_id").where("text <> ''").selectExpr("text", "y", "pmod(xxhash64(doc_id), 4) AS fold").collect()
    want = R.Grader([(r["text"], r["y"]) for r in rows], [r["fold"] for r in rows])
    assert len(rows) == 151 and [m.three for m in got.models.models] == [m.three for m in want.models.models]
    assert np.allclose(got.weights, want.weights) and np.allclose(got.x, want.x) and np.allclose(got.y, want.y) and got.usual == want.usual
    again = R.Grader.of(d.repartition(7), l.repartition(2))
    assert (again.weights == got.weights).all() and (again.x == got.x).all() and (again.y == got.y).all()
    one = {r["doc_id"]: r["level"] for r in R.reading_levels(d, got).collect()}
    assert sum(one[i] == R.LEVELS[i % 3] for i in range(150)) > 130


def test_steps_of_parts_give_the_steps_of_the_whole():
    rng = np.random.default_rng(2)
    x = np.sort(rng.integers(0, 300, 2_000)).astype(float)
    y = rng.integers(0, 5, 2_000) / 2 + x / 200
    px, py = R.isotonic(x, y)
    ties = [(float(y[x == k].sum()), float((x == k).sum()), k, k) for k in np.unique(x)]
    parts = [b for at in range(0, len(ties), 37) for b in R.pooled(ties[at : at + 37])]
    qx, qy = R.steps(parts)
    assert np.allclose(px, qx) and np.allclose(py, qy) and len(parts) < len(ties)
    assert R.isotonic(np.array([1.0, 2.0, 2.0]), np.array([1.0, 0.0, 3.0]))[1].tolist() == [1.0, 1.5]
    assert R.median({0.0: 2, 1.0: 1, 2.0: 1}) == 0.5 and R.median({1.5: 3}) == 1.5
