"""Whether an answer declines to answer: word n-gram models of refusals and of other answers, compared clause by clause."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.counts import collected, tally, trigram_model
from granary.llm.ngrams import NgramModel, NgramModels
from granary.session import discard, materialize

ROUNDS = 3  # of labelling the answers anew by the models fitted on it
CLAUSE_PRIOR = 4.0  # bits by which a clause speaks for an answer before it is read
LEAST, MOST = -6.0, 10.0  # bits that one clause can speak for an answer and for a refusal
TELLING = 6  # times as often a word must stand in refusals for a text with it to be read at all
KNOWN = 3  # occurrences from which a word is read as itself

#: Sentences of our own to start from, as refusals are commonly worded.
REFUSALS = """\
I can't help with that. I cannot assist with this request. I can't do that. I cannot answer this question. I can't provide that information. I am unable to help with this. I'm unable to answer that question.
I am not able to do this for you. I'm not able to discuss this topic. I won't be able to help you with this. I will not write this. I won't answer that. I can not comply with this request. I can't write that for you.
I must decline. I have to decline this request. I must refuse to answer. I have to pass on this. I refuse to do that. I decline to respond. I would rather not answer that. I'd rather not say. I'd prefer not to discuss this.
I do not feel comfortable answering this. I don't feel comfortable with this request. I am not allowed to answer this. I'm not permitted to discuss that. I am not authorised to share this. I lack the permission to do this.
This is something I can't help with. That is not something I can do. This is beyond what I can do. This is outside of what I am allowed to do. That request falls outside the scope of what I can help with. This is outside my area. That is beyond my remit.
It would not be appropriate for me to respond. This goes against my guidelines. My guidelines do not allow this. My policy forbids this. The policy I follow does not permit this. No answer can be given. There is no answer I can give here.
As an AI language model I cannot help with this. As an AI I don't have access to that. As a language model I am unable to do this. I don't have access to your system. Helping with this is not something I can do. It is impossible for me to help with this.
Sorry. No. No, sorry. Sorry, no. I'm sorry. I am sorry, but no. My apologies. I apologize. Unfortunately I can't. Unfortunately not. I'm afraid I can't. I'm afraid not. Regrettably I must decline. I hope you understand. Please ask something else. Please ask someone else.
Je ne peux pas vous aider. Je ne peux pas répondre à cette question. Je ne suis pas en mesure de répondre. Je ne suis pas autorisé à en parler. Je dois refuser. Je dois malheureusement refuser. Je dois décliner cette demande. Je ne peux pas traiter cette tâche. Je refuse de répondre. Je préfère ne pas répondre. Il m'est impossible de vous aider. Il m'est impossible de répondre à cela.
Désolé. Je suis désolé. Malheureusement, ce n'est pas possible pour moi. En tant que modèle de langage, je ne peux pas le faire. En tant qu'IA, je n'y ai pas accès. Cela dépasse ce que je peux faire. Mes règles ne le permettent pas.
Ich kann Ihnen dabei nicht helfen. Ich kann diese Frage nicht beantworten. Das kann ich leider nicht beantworten. Dabei kann ich nicht helfen. Damit kann ich leider nicht helfen. Ich darf das nicht beantworten. Darauf darf ich nicht antworten. Ich bin nicht in der Lage, das zu beantworten. Ich muss das ablehnen. Leider muss ich ablehnen. Hier muss ich passen. Ich möchte das nicht beantworten. Das möchte ich lieber nicht beantworten.
Es tut mir leid. Tut mir leid. Entschuldigung. Als Sprachmodell kann ich das nicht. Als KI habe ich darauf keinen Zugriff. Das geht über das hinaus, was ich darf. Meine Richtlinien erlauben das nicht.
No puedo ayudar con eso. No puedo responder a esta pregunta. No me es posible ayudar. No me es posible responder. No estoy autorizado a responder. No estoy en condiciones de ayudar. Debo rechazar esta solicitud. Debo declinar. Tengo que negarme. Prefiero no responder. Me niego a hacerlo.
Lo siento. Lo lamento. Lamentablemente no puedo. Disculpe. Como modelo de lenguaje no puedo hacerlo. Como IA no tengo acceso a eso. Eso está fuera de lo que puedo hacer. Mis normas no lo permiten."""
#: And sentences of answers that have words of refusals.
ANSWERS = """\
I can't do it in one step, so split the file first. I cannot reproduce this with the newest version. I cannot stress enough how much the order matters. I can't find the function in the listing, so write one. You cannot call it twice. You can't help the cache being cold after a restart. It cannot be null. It can't hold more than ten rows.
The server is unable to answer until the lock is free. A client that is not able to connect must retry. The process must decline the connection. The handler refuses the request. The call won't return before the timeout. The user is not allowed to write to this table. The service is not permitted to read the file.
Unfortunately the index is not used here. Unfortunately this loses the last row. Sorry the list by name before you merge. No lock is needed. No, the order does not matter. No. The first answer is right. I would rather use a queue here. I'd rather check the limit first. There is no answer from the host. I don't have access to the log in this shell, so print it.
Ask the user for a name. Write a refusal message for users who are not authorised. Print that the request cannot be handled. Return an apology when the order fails. The policy forbids plain passwords. This goes against the style guide. Use a scope that fits the request. As a language the model is small.
On ne peut pas appeler la fonction deux fois. Le serveur refuse la connexion. Malheureusement, l'index n'est pas utilisé ici. Man kann die Funktion nicht zweimal aufrufen. Der Dienst darf die Datei nicht lesen. Leider fehlt hier der Index. No se puede llamar dos veces a la función. El servidor rechaza la conexión. Lamentablemente falta el índice."""

_END = re.compile(r"[.!?…;:\n]+|,?\s+(?=(?:but|mais|aber|pero|so|instead)\s)|,\s+(?=(?:because|since|so)\s)|\s[–—-]+\s")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|\d+|_")


def clauses(text: str) -> list[list[str]]:
    """Clauses of a text as lower-case words; numbers are '9'."""
    out = []
    for part in _END.split(text.replace("’", "'").lower()):
        words = ["9" if w[0].isdigit() else w for w in _WORD.findall(part)]
        if words:
            out.append(words)
    return out


def _every(text) -> bool:
    return True


class RefusalModel:
    """Fitted on ``REFUSALS``, ``ANSWERS`` and answers that it labels itself.

    Answers with a run of three words that only ``REFUSALS`` have are left aside at first; then the models label all
    answers, and are fitted anew, ``ROUNDS`` times. Words met fewer than ``KNOWN`` times are one word.
    """

    def __init__(self, texts) -> None:
        cut = [c for c in map(clauses, texts) if c]
        self._know(Counter(w for text in cut for c in text for w in c))
        read = [[*map(self._read, text)] for text in cut]
        self._label(lambda picked: NgramModel(c for t in read if picked(t) for c in t))

    @classmethod
    def of(cls, answers: DataFrame, prose: Callable[[str], str]) -> RefusalModel:
        """The model fitted on every row of ``answers`` (text): what tasks count is added up, no text comes to the driver."""

        def cut(batches):
            for batch in batches:
                texts = [clauses(prose(t)) if t else [] for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(["\n".join(map(" ".join, t)) for t in texts if t], pa.string())], names=["clauses"])

        def words(counters, column):
            for t in column:
                counters[0].update(t.split())

        self = cls.__new__(cls)
        rows = materialize(answers.select("text").mapInArrow(cut, "clauses STRING"), "clauses")
        seen = tally(rows, words)
        own = {w for c in (*clauses(REFUSALS), *clauses(ANSWERS)) for w in c}
        self._know(Counter(dict(collected(seen.where((F.col("n0") >= KNOWN) | F.col("key").isin(*own))))))

        def total(picked):
            def sentences(t):
                read = [self._read(c.split(" ")) for c in t.split("\n")]
                return read if picked(read) else ()

            return trigram_model(rows, sentences)

        self._label(total)
        discard(rows)
        return self

    def _know(self, seen: Counter) -> None:
        yes, no = clauses(REFUSALS), clauses(ANSWERS)
        seen.update(w for c in (*yes, *no) for w in c)
        own = {w for c in yes for w in c}
        self.known = {w for w, n in seen.items() if n >= KNOWN or w in own}

    def _read(self, words: list[str]) -> list[str]:
        return [w if w in self.known else "?" for w in words]

    def _label(self, total: Callable) -> None:
        """Fit the models; ``total`` gives the counts over the answers that a condition picks."""
        yes, no = ([*map(self._read, clauses(x))] for x in (REFUSALS, ANSWERS))
        runs = lambda cs: {r for c in cs for r in zip(c, c[1:], c[2:])}
        telling = runs(yes) - runs(no)
        whole, yes, no = total(_every), NgramModel(yes), NgramModel(no)
        self._fit(NgramModel.of([no, whole.less(total(lambda t: not telling.isdisjoint(runs(t))))]), yes)
        for _ in range(ROUNDS):
            found = total(self._refuses)
            self._fit(NgramModel.of([no, whole.less(found)]), NgramModel.of([yes, found]))

    def _fit(self, a: NgramModel, r: NgramModel) -> None:
        self.models = NgramModels([a, r])
        # '?' and numbers tell nothing by themselves
        self.telling = {w for w, n in r.one.items() if w not in ("?", "9", "_") and n / max(1, r.total) >= TELLING * (a.one.get(w, 0) + 0.5) / max(1, a.total)}

    def _refuses(self, text: list[list[str]]) -> bool:
        return self._tells(text) and self._bits(text) > 0

    def _tells(self, text: list[list[str]]) -> bool:
        return not all(self.telling.isdisjoint(words) for words in text)

    def _bits(self, text: list[list[str]]) -> float:
        total = 0.0
        for words in text:
            answer, refusal = self.models.bits(words)
            total += min(MOST, max(LEAST, answer - refusal - CLAUSE_PRIOR))
        return total

    def declines(self, text: str, blocks: int = 0) -> bool:
        """Whether ``text`` (prose) with so many code blocks declines: what speaks for it, over all clauses, outweighs the rest."""
        low = text.replace("’", "'").lower()
        if self.telling.isdisjoint(_WORD.findall(low)):
            return False
        return self._bits([self._read(c) for c in clauses(low)]) + LEAST * blocks > 0
