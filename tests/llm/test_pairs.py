"""Defects of pairs, one case for each kind and its sound look-alikes."""

import random

import pytest

from granary.llm import pairs as P

EN = ["The parser reads the file before the next release.", "Set the limit to 5 and watch how the queue behaves under load.", "Most problems come from a wrong path.", "The build script replaces the cache entry when the disk is full."]
FR = ["Le serveur de test bloque le fichier de configuration.", "La file de messages protège la limite de mémoire pendant la nuit.", "Il vaut mieux échouer tôt que de continuer avec des données fausses."]
DE = ["Die Fehlermeldung blockiert die Warteschlange vor der nächsten Version.", "Das Dienstkonto schützt die Datenbank, und der Testserver ersetzt sie.", "Wenn das Programm startet, wird zuerst die Datei gelesen."]


@pytest.fixture(scope="module")
def models():
    rng = random.Random(1)
    docs = [(lang, " ".join(rng.choices(s, k=8))) for lang, s in (("en", EN), ("fr", FR), ("de", DE)) for _ in range(20)]
    answers = [" ".join(rng.choices(EN + FR + DE, k=6)) for _ in range(400)] + ["I cannot find a fetch helper in our code; write one that updates it.", "A process that is unable to read the file must decline the connection."]
    return P.Models(P.LanguageModel(docs), P.EndingModel(answers), P.RefusalModel(answers))


Q = "How do I configure the log rotation so that it keeps working?"
CODE = "Read the python code below and state what it does.\n\n```python\ndef load_all(path, limit):\n    rows = read_rows(path)\n    return rows[:limit]\n```"
CASES = [
    (Q, None, "empty"), (Q, "", "empty"), (Q, " \n", "empty"), (Q, "N/A", "empty"), (Q, "...", "empty"), (Q, "```\n```", "empty"), (Q, "​", "empty"), (Q, "[no answer]", "empty"), (None, None, "empty"),
    (Q, Q, "copy"), (Q, "  ".join(Q.split(" ")), "copy"), (CODE, "```python\ndef load_all(path, limit):\n    rows = read_rows(path)\n    return rows[:limit]\n```", "copy"), (CODE, "Read the python code below and state what it does.", "copy"),
    (Q, "I'm unable to assist with this task.", "refusal"), (Q, "Unfortunately, I MUST DECLINE.", "refusal"), (Q, "Désolé, il m'est impossible de vous aider sur ce sujet.", "refusal"), (Q, "Hmm. I’d rather not respond to this prompt. I hope you understand.", "refusal"),
    (Q, " ".join(FR), "wrong_language"), (Q, DE[0], "wrong_language"), (FR[0] + " Pourquoi ?", EN[0] + " " + EN[2], "wrong_language"),
    (Q, EN[0] + " Set the limit to 5 and watch how the qu", "truncated"), (Q, EN[0] + " The build script replaces the", "truncated"), (Q, EN[2] + "\n\n```python\nx = 1\n", "truncated"), (Q, EN[1] + " The parser reads the file,", "truncated"), (Q, EN[1] + " Use `load", "truncated"),
    (Q, EN[0], None), (Q, "Yes.", None), (Q, "O(n log n)", None), (Q, "/etc/page/unit.d", None), (Q, "4605", None), (Q, "`move --drain 10`", None),
    (Q, "- The parser reads the file before the next release\n- The build script replaces the cache entry when the disk is full", None),
    (Q, "I cannot stress enough that the queue comes first. " + EN[0], None), (Q, "A process that is unable to read the file must decline the connection.", None), (Q, "I cannot find a fetch helper in our code; write one that updates it.", None),
    (Q, "```python\ndef f(x):\n    return x\n```", None), (Q + " Answer in French, please.", FR[0], None), (Q + " Antworte auf Deutsch.", " ".join(DE), None), (DE[0], DE[1], None),
    (DE[0] + " Warum?", "fiber_stack insert layer.conf", None), ("Which short English request would lead to this?\n\ndef f(a):\n    \"\"\"" + FR[0] + " " + FR[1] + "\"\"\"\n    return a", "Write a function that replaces the cache entry when the disk is full.", None),
]
REFUSALS = [
    "I'm sorry, but that request falls outside my remit.", "Sorry, no.", "Unfortunately I'm not permitted to answer this.", "I can't help with that request.", "That is not something I am able to do for you.", "I must decline to write this. Please ask something else.", "I’m afraid I am not able to discuss it.",
    "As an AI language model, I don't have access to the build script.", "Leider kann ich diese Frage nicht beantworten.", "Je suis désolé, je ne peux pas répondre à cette demande.", "Lo siento, no puedo ayudar con esa petición.", "I would rather not answer. " + "I hope you understand. " * 30,
]
NO_REFUSALS = [
    "I can't do that in one statement, but a lock timeout works: set it before the update and retry.", "The server is unable to read the file and declines the connection.", "I cannot stress enough that the queue comes first. " + EN[0], "Unfortunately the cache entry is not replaced; delete it before the next release.", "No lock is needed here.",
    "You cannot call it twice: the file is closed after the first call.", "Return an error that says the request cannot be handled.", "I'd rather set the limit to 5 and watch the queue.", "Sorry the list first.", "I'm unable to see the cause in the log, but most problems come from a wrong path. " + EN[3],
]


@pytest.mark.parametrize("answer", REFUSALS)
def test_refusals(models, answer):
    assert models.refusals.declines(answer)


@pytest.mark.parametrize("answer", NO_REFUSALS)
def test_no_refusals(models, answer):
    assert not models.refusals.declines(answer)


def test_code_speaks_for_an_answer(models):
    assert models.refusals.declines("I can't do that.") and not models.refusals.declines("I can't do that.", 3)


@pytest.mark.parametrize("question,answer,kind", CASES)
def test_defects(models, question, answer, kind):
    assert P.defect(question, answer, models) == kind


def test_tables(spark):
    jobs = spark.createDataFrame([(1, CODE, 0), (None, "x", 0)], "_idx BIGINT, prompt STRING, answer INT")
    results = spark.createDataFrame([(10, 1, None), (11, 1, "Load all rows of a file."), (12, 2, None), (13, None, None), (10, 1, None)], "result_id BIGINT, _idx BIGINT, _text STRING")
    train = spark.createDataFrame([(1, 7, 0, "User", Q), (2, 7, 1, "GPT", " "), (3, 7, 3, "assistant", ""), (4, 8, 1, "gpt", ""), (5, 9, 0, "system", "x"), (6, 9, 1, "assistant", ""), (7, None, 0, "user", Q), (8, None, 1, "gpt", "")], "msg_id BIGINT, example_id BIGINT, turn BIGINT, role STRING, content STRING")
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING")
    got = sorted(tuple(r)[:3] for r in P.broken_pairs(jobs, results, train, docs).collect())
    assert got == [("job_results", 10, "empty"), ("job_results", 10, "empty"), ("train", 2, "empty")]
    assert P.broken_pairs(jobs.limit(0), results.limit(0), train.limit(0), docs).count() == 0


def test_long_and_odd_texts(models):
    assert P.defect("x " * 50_000, "y " * 50_000 + ".", models) in (None, "wrong_language")
    for t in ("`", "```", "\ud83d", "a" * 100_000, "- ", "1) ", "?", "((("):
        P.defect(t, t + "!", models)
        P.defect(Q, t, models)
