"""Problem 1: broken prompt and response pairs, each with the type of its defect.

Languages come from a naive Bayes model of character n-grams, fitted on labelled documents; whether a
text breaks off comes from an interpolated n-gram model of how sentences end, and whether it declines from
n-gram models of refusals and answers, both fitted on answers. All are fitted on every labelled document and every
answer, by counts that tasks make and Spark adds up, and applied to every pair.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.counts import collected, tally
from granary.llm.refusals import RefusalModel
from granary.session import discard, materialize, table

LANGUAGE_DOCS = 5  # documents that a language must have to be known
GRAM = 4  # longest character n-gram
LEAST_LETTERS = 25  # prose of fewer letters is never called another language
LANGUAGE_MARGIN = 3.0  # log posterior odds by which another language must win
END_FLOOR = 0.03  # a text without a final mark whose end is less likely than this breaks off

PLACEHOLDERS = ("", "null", "none", "nil", "nan", "na", "n a", "todo", "tbd", "empty", "no answer", "no response", "no output", "answer", "response", "request", "placeholder")
#: Words by which a question asks for a language: name of the language in several languages.
ASKED = {
    "en": r"english|anglais|englisch|inglés",
    "fr": r"french|français|francais|französisch|francés",
    "de": r"german|deutsch|allemand|alemán",
    "es": r"spanish|español|espanol|espagnol|spanisch|castellano",
}
_ASK = {k: re.compile(rf"\b(?:in|en|auf|into|to|al|vers)\s+(?:{v})\b|\b(?:{v})\s+(?:sentences?|requests?|words?|text|answers?|task|description)\b", re.I) for k, v in ASKED.items()}

_TICKED = re.compile(r"`[^`\n]*`")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"`[^`\n]*`|\w+|[^\w\s]")
_SENTENCE_END = re.compile(r"[.!?]+[\"'”’*_`)\]]*(?:\s+|$)")
_BULLET = re.compile(r"\s*(?:[-*+•]|\d+[.)])\s+")
_LEADIN = re.compile(r"^\s*[\"'“]?\s*(?:request|answer|response|code|sure|here you go|output)\s*:\s*", re.I)
_FINAL = re.compile(r"[.!?…。:;)\]}>][\"'”’*`_)\]]*$")


def prose(text: str) -> str:
    """``text`` without code blocks and inline code; a block that isn't closed reaches to the end."""
    if "`" not in text:
        return text
    text = " ".join(text.split("```")[::2])
    return _TICKED.sub(" ", text) if "`" in text else text


_PLAIN = re.compile(r"(?<!\S)[^\s_\d/\\@=<>{}]++(?!\S)")
_DOTTED = re.compile(r"\w\.\w")


def plain(text: str) -> list[str]:
    """Words of prose in lower case, without names, numbers and paths."""
    kept = [t for t in _PLAIN.findall(text) if "." not in t or not _DOTTED.search(t)]
    return _WORD.findall(" ".join(kept).lower())


_CODE_LINES = re.compile(r"^(?:[^\S\n]+\S|[<.@#/*})\]]|.*[;{}>][^\S\n]*$|[^\S\n]*(?:async |static |export )*(?:def|class|function|return|import|from|const|let|var|struct)\b.*[(:={;]).*\n?", re.M)


def asking(question: str) -> str:
    """The prose of a question: without code blocks, and without lines that look like code outside of them."""
    text = prose(question)
    kept = _CODE_LINES.sub("", text)
    return text if kept.isspace() or not kept else kept


class LanguageModel:
    """Naive Bayes over the character n-grams of words. A word's log likelihoods are found once and kept in a table."""

    MOST_WORDS = 100_000

    def __init__(self, labelled) -> None:
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, text in labelled:
            self.count(text, counts[lang])
        self._settle(counts)

    @classmethod
    def of(cls, labelled: DataFrame) -> LanguageModel:
        """The model of every row of ``labelled`` (lang, of two letters, and text)."""

        def add(counters, langs, texts):
            counts: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(langs, texts):
                counts[lang].update(plain(prose(text)))
            for lang, words in counts.items():
                for w, n in words.items():
                    for g in cls.grams(w):
                        counters[0][lang + g] += n

        self = cls.__new__(cls)
        found: dict[str, Counter] = defaultdict(Counter)
        for key, n in collected(tally(labelled.select("lang", "text"), add)):
            found[key[:2]][key[2:]] = n
        self._settle(found)
        return self

    def count(self, text: str, counts: Counter) -> None:
        for w, n in Counter(plain(prose(text))).items():
            for g in self.grams(w):
                counts[g] += n

    def _settle(self, counts: dict[str, Counter]) -> None:
        self.languages = sorted(counts)
        vocabulary = set().union(*counts.values()) if counts else set()
        totals = {x: sum(c.values()) + 0.5 * len(vocabulary) + 1 for x, c in counts.items()}
        self.unknown = [math.log(0.5 / totals[x]) for x in self.languages]
        self.weights = {g: [math.log((counts[x][g] + 0.5) / totals[x]) for x in self.languages] for g in vocabulary}
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.languages)))

    def __getstate__(self):
        return {**self.__dict__, "place": {}, "table": self.table[:1024] * 0}

    @staticmethod
    def grams(word: str) -> list[str]:
        w = f" {word} "
        return [w[i : i + n] for n in range(2, GRAM + 1) for i in range(len(w) - n + 1)]

    def _add(self, w: str) -> int:
        k = len(self.place)
        if k == len(self.table):
            self.table = np.concatenate([self.table, self.table * 0])
        rows = [self.weights.get(g, self.unknown) for g in self.grams(w)]
        # n-grams of a word depend on each other: each word counts as about two independent ones
        self.table[k] = [2 * sum(r[i] for r in rows) / len(rows) for i in range(len(self.languages))]
        self.place[w] = k
        return k

    def scores(self, words: list[str]) -> np.ndarray:
        """Log likelihoods by language."""
        if len(self.place) > self.MOST_WORDS:
            self._clear()
        get, add = self.place.get, self._add
        at = [k if (k := get(w)) is not None else add(w) for w in words]
        return self.table[at].sum(axis=0)

    def differs(self, answer: list[str], question: list[str], asked_in: str | None = None) -> str | None:
        """The language of ``answer`` if both posteriors say that it isn't the question's (or ``asked_in``), else None."""
        mine = self.scores(answer)
        best = int(mine.argmax())
        if asked_in is not None:
            wanted = self.languages.index(asked_in) if asked_in in self.languages else -1
            sure = wanted != best
        else:
            theirs = self.scores(question)
            wanted = int(theirs.argmax())
            sure = theirs[wanted] - theirs[best] > LANGUAGE_MARGIN
        if sure and (wanted < 0 or mine[best] - mine[wanted] > LANGUAGE_MARGIN):
            return self.languages[best]
        return None


@functools.lru_cache(maxsize=1 << 16)
def kind(token: str) -> str:
    """A token as the ending model sees it: names and numbers as classes of their own."""
    if token[0] == "`":
        return "`"
    if token.isdigit():
        return "9"
    if "_" in token or any(c.isdigit() for c in token) or not (token.islower() or token.istitle() or token.isupper()):
        return "_"
    return token.lower()


def contexts(tokens: list[str]) -> tuple[list[tuple], list[tuple]]:
    """Contexts at the end of ``tokens``, from general to special: with the last word, and with it left open."""
    a, b, c, d = ([""] * 4 + [kind(t) for t in tokens[-4:]])[-4:]
    return [(d,), (c, d), (b, c, d), (a, b, c, d)], [(c, "*"), (b, c, "*"), (a, b, c, "*")]


class EndingModel:
    """How likely a text is complete where it ends, by interpolating n-gram contexts of growing length."""

    def __init__(self, texts) -> None:
        seen, ends = Counter(), Counter()
        self.count((seen, ends), texts)
        seen, ends = self.spread(seen), self.spread(ends)
        self._settle(((c, n, ends.get(c, 0)) for c, n in seen.items()), sum(seen.values()), sum(ends.values()))

    @classmethod
    def of(cls, answers: DataFrame) -> EndingModel:
        """The model of every row of ``answers`` (text). Contexts met once don't leave the executors."""
        self = cls.__new__(cls)
        sums = materialize(tally(answers.select("text"), cls.count, 2, " ".join, cls.spread), "endings")
        seen, ends = sums.agg(F.sum("n0"), F.sum("n1")).first()
        self._settle(((tuple(k.split(" ")), n, e) for k, n, e in collected(sums.where("n0 > 1"))), seen or 0, ends or 0)
        discard(sums)
        return self

    @staticmethod
    def count(counters, texts) -> None:
        """Add to ``counters`` how often four words (empty before a sentence) of ``texts`` are seen, and how often at an end."""
        seen, ends = counters
        for text in texts:
            for tokens in sentences(text):
                d = [kind(t) for t in tokens]
                x = ["", "", "", *d]
                seen.update(zip(x, x[1:], x[2:], d))
                ends[tuple(x[-4:])] += 1

    @staticmethod
    def spread(fours: Counter) -> Counter:
        """All contexts (:func:`contexts`) within four words, with their counts."""
        out: Counter = Counter()
        for (x, y, z, d), n in fours.items():
            for c in ((d,), (z, d), (y, z, d), (x, y, z, d), (z, "*"), (y, z, "*"), (x, y, z, "*")):
                out[c] += n
        return out

    def _settle(self, rows, seen: int, ends: int) -> None:
        """From (context, seen, at an end) of the contexts and both sums over all."""
        self.prior = (ends + 1) / (seen + 10)
        self.table = {c: (e, n) for c, n, e in rows if n > 1}
        self.words = {c[0] for c, (_, n) in self.table.items() if len(c) == 1 and n > 2}

    def likelihood(self, tokens: list[str]) -> float:
        """The lower of two estimates: from the last words, and from the words before the last.

        Where the last words are known together as an end, or are one nearly always, the first is enough.
        """
        least = 1.0
        for chain in contexts(tokens):
            p = self.prior
            for c in chain:
                e, n = self.table.get(c, (0, 0))
                p = (e + 3 * p) / (n + 3)
            least = min(least, p)
            if len(chain) == 4 and (p > 0.5 or p > 0.1 and self.table.get(chain[2], (0, 0))[1] >= 2):
                break
        last = kind(tokens[-1])
        if last not in self.words and last.isalpha():
            least *= 0.03  # a word that complete texts don't have: cut inside a word
        elif len(tokens) > 1 and last.isalpha() and (kind(tokens[-2]), last) not in self.table:
            least *= 0.1  # it may be the beginning of another word, too
        return least


def sentences(text: str):
    """Token lists of the complete sentences and list items of ``text``; the last one only if a mark ends it."""
    lines = [x for x in "\n".join(text.split("```")[::2]).split("\n") if x.strip()]
    for k, line in enumerate(lines):
        item = _BULLET.match(line)
        parts = _SENTENCE_END.split(line[item.end() :] if item else line)
        for i, part in enumerate(parts):
            tokens = _TOKEN.findall(part)
            if tokens and (i + 1 < len(parts) or item and k + 1 < len(lines)):
                yield tokens


def breaks_off(text: str, model: EndingModel) -> str | None:
    """'mark' or 'model' if ``text`` breaks off: by an open block or bracket at its end, or as the model finds its end unlikely."""
    t = text.rstrip()
    if t.count("```") % 2:
        return "mark"
    if t.endswith("```") or not t:
        return None
    tail = t.rsplit("```", 1)[-1]
    line = tail.rsplit("\n", 1)[-1]
    if line.count("`") % 2 or t[-1] in ",(-[{" or t.endswith(("&&", "||", " =", " +")):
        return "mark"
    if _FINAL.search(t):
        return None
    item = _BULLET.match(line)
    parts = _SENTENCE_END.split(re.sub(r"[\"'”’*_]+$", "", line[item.end() :] if item else line))
    tokens = _TOKEN.findall(parts[-1])
    if not tokens:
        return None
    if not item and len(parts) == 1 and "\n" not in t and len(parts[0].split()) < 5:
        return None  # a short value, not a sentence
    return "model" if model.likelihood(tokens) < END_FLOOR else None


def squeezed(text: str) -> str:
    return " ".join(text.lower().replace("```", " ").split())


def copies(answer: str, question: str) -> bool:
    """Whether nearly all of ``answer`` is wording or code of ``question``: windows of four words found in it."""
    a = squeezed(_LEADIN.sub("", answer))
    q = squeezed(question)
    words = a.split(" ")
    if len(words) < 5 and len(a) >= 60:  # unbroken data: windows of characters
        pieces = [a[i : i + 30] for i in range(0, len(a) - 29, 30)]
        return sum(x in q for x in pieces) >= 0.75 * len(pieces)
    if len(words) < 5:
        return a.strip(".!?\"' ") == q.strip(".!?\"' ") and bool(a)
    # a fence's language name stands before the code without being part of it
    windows = [" ".join(words[i : i + 4]) for i in range(0, len(words) - 3, 4)] + [" ".join(words[-5:-1])]
    spare = len(windows) - max(1, math.ceil(0.75 * len(windows)))
    for w in windows:
        if w not in q:
            spare -= 1
            if spare < 0:
                return False
    return True


@dataclass
class Models:
    languages: LanguageModel
    endings: EndingModel
    refusals: RefusalModel


def judged(question: str | None, answer: str | None, models: Models, asked_in: str | None = None) -> tuple[str, str] | None:
    """The defect of a pair and what told it, None if it is sound."""
    if answer is None:
        return "empty", "null"
    bare = re.sub(r"[^\w]+", " ", answer.replace("\u200b", "")).strip().lower()
    if bare in PLACEHOLDERS:
        return "empty", "placeholder"
    question = question or ""
    if copies(answer, question):
        return "copy", "windows"
    text = prose(answer)
    if models.refusals.declines(text, answer.count("```") // 2):
        return "refusal", "model"
    spoken = plain(text)
    if models.languages.languages and sum(map(len, spoken)) >= LEAST_LETTERS:
        other = models.languages.differs(spoken, plain(asking(question)) if asked_in is None else [], asked_in)
        if other and not (other in _ASK and _ASK[other].search(question)):
            return "wrong_language", "model"
    end = breaks_off(answer, models.endings)
    return ("truncated", end) if end else None


def defect(question: str | None, answer: str | None, models: Models, asked_in: str | None = None) -> str | None:
    """The defect of a pair, None if it is sound."""
    found = judged(question, answer, models, asked_in)
    return found and found[0]


def fit(documents: DataFrame, answers: DataFrame) -> Models:
    """Models from ``documents`` (text, lang) and ``answers`` (text), fitted on every row of both.

    Labels are brought to two letters; a language of fewer than ``LANGUAGE_DOCS`` documents is left out. What comes to the driver
    are counts of n-grams, so it grows with their variety, not with the texts.
    """
    lang = F.regexp_extract(F.lower(F.trim("lang")), r"^([a-z]{2})(?:[-_].*)?$", 1)
    labelled = documents.select(lang.alias("lang"), "text").where("lang <> '' AND text IS NOT NULL")
    known = [r["lang"] for r in labelled.groupBy("lang").count().where(F.col("count") >= LANGUAGE_DOCS).collect()]
    texts = answers.select("text").where("text IS NOT NULL")
    return Models(LanguageModel.of(labelled.where(F.col("lang").isin(known))), EndingModel.of(texts), RefusalModel.of(texts, prose))


def judge(pairs: DataFrame, models: Models) -> DataFrame:
    """``src``, ``answer_id``, ``defect`` and its ``evidence`` of the defective rows of ``pairs`` (src, answer_id, question, answer).

    A null question counts as empty. No shuffle. A worker reads the models once, however many tasks it runs.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        models = shared.value
        for batch in batches:
            src, ids, q, a = (batch.column(i) for i in range(4))
            found = [judged(x, y, models) for x, y in zip(q.to_pylist(), a.to_pylist())]
            keep = pa.array([i for i, d in enumerate(found) if d], pa.int64())
            what = [pa.array([d[k] for d in found if d], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([src.take(keep), ids.take(keep), *what], names=["src", "answer_id", "defect", "evidence"])

    return pairs.select("src", "answer_id", "question", "answer").mapInArrow(run, "src STRING, answer_id BIGINT, defect STRING, evidence STRING")


def result_pairs(results: DataFrame, jobs: DataFrame) -> DataFrame:
    """Each result with the prompt of its job; results without a job are left out."""
    r = results.select(F.lit("job_results").alias("src"), F.col("result_id").alias("answer_id"), F.col("_text").alias("answer"), F.col("_idx").alias("_r"))
    j = jobs.select(F.col("_idx").alias("_j"), F.col("prompt").alias("question"))
    return r.join(j, F.col("_r") == F.col("_j")).select("src", "answer_id", "question", "answer")


def turn_pairs(train: DataFrame) -> DataFrame:
    """Each answer row (assistant, gpt in any case) with the question row (user, human) of the turn before it."""
    role = F.lower(F.trim("role"))
    a = train.where(role.isin("assistant", "gpt")).select(F.lit("train").alias("src"), F.col("msg_id").alias("answer_id"), F.col("content").alias("answer"), F.col("example_id").alias("_e"), (F.col("turn") - 1).alias("_t"))
    q = train.where(role.isin("user", "human")).select(F.col("content").alias("question"), F.col("example_id").alias("_f"), F.col("turn").alias("_u"))
    return a.join(q, (F.col("_e") == F.col("_f")) & (F.col("_t") == F.col("_u"))).select("src", "answer_id", "question", "answer")


def broken_pairs(jobs: DataFrame, results: DataFrame, train: DataFrame, documents: DataFrame) -> DataFrame:
    """One row (src, answer_id, defect, evidence) per defective pair of results with jobs and of training turns.

    The first defect that holds is given, in the order empty, copy, refusal, wrong_language, truncated;
    ``evidence`` is what told it: null, placeholder, windows (found in the question), mark (an open block or bracket at the end)
    or model. Null, empty and blank answers are 'empty'; rows whose join keys are null form no pair; a repeated
    row is judged again; empty tables give no rows (without labelled documents no pair is of another
    language). Extra columns play no role.
    """
    answers = results.select(F.col("result_id").alias("id"), F.col("_text").alias("text")).union(train.where(F.lower(F.trim("role")).isin("assistant", "gpt")).select("msg_id", "content"))
    models = fit(documents, answers)
    return judge(result_pairs(results, jobs).union(turn_pairs(train)), models)


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_pairs(*(table(spark, sf_dir, t) for t in ("jobs", "job_results", "train", "documents")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_pairs(spark, sf_dir).drop("evidence")
