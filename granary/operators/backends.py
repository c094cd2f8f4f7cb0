"""Completion backends: anything with ``name``, ``context`` (tokens, or None for no limit), ``tokens`` and ``complete``.

``complete`` takes requests (dicts with prompt, max_tokens, temperature, top_p, stop, seed) and gives a text, or
None for a request that failed, for each. ``tokens`` cuts a text into pieces that add up to it again.
"""

from __future__ import annotations

import functools
import hashlib
import json
import random
import re
from collections import Counter, defaultdict

_PIECE = re.compile(r"\s*[\w']+|\s*[^\w\s]|\s+")


def pieces(text: str) -> list[str]:
    """Words and marks with the white space before them."""
    return _PIECE.findall(text)


class EchoBackend:
    """Offline backend: a text that depends on the prompt alone. Prompts with ``FAIL`` fail."""

    name = "echo0"
    context = None
    tokens = staticmethod(pieces)

    def complete(self, requests: list[dict]) -> list[str | None]:
        out: list[str | None] = []
        for r in requests:
            p = r["prompt"] or ""
            out.append(None if "FAIL" in p else f"Write code for task {hashlib.sha256(p.encode('utf-8', 'replace')).hexdigest()[:12]}.")
        return out


#: What the sampler is fitted on where it is given no text: sentences and code of our own.
SAMPLES = """Write a function that reads a file line by line and returns the rows that match a pattern.
Write a function that checks its arguments first and raises an error that names the wrong one.
Write a class that keeps a bounded queue and drops the oldest item when it is full.
Write a function that counts the words of a text and returns the most frequent ones.
Write a loop that retries a request with a growing pause and gives up after the last attempt.
def load(path):
    rows = []
    for line in open(path):
        if not line.strip():
            continue
        rows.append(line.strip())
    return rows
def total(values):
    result = 0
    for value in values:
        if value is None:
            continue
        result += value
    return result
def find(items, key):
    for item in items:
        if item.key == key:
            return item
    return None
"""


class NgramBackend:
    """A local sampler: trigrams of pieces, backed off to bigrams, with temperature, top-p and stop strings.

    Reproducible: what a request gives depends on its prompt, settings and ``seed`` alone, not on the batch that it comes
    in. A text ends at a stop string, at ``max_tokens`` pieces, or where the samples end. An empty prompt fails.
    """

    name = "ngram0"
    tokens = staticmethod(pieces)

    def __init__(self, samples: str = SAMPLES, context: int = 1536) -> None:
        self.context = context
        self.after: dict[tuple[str, ...], Counter] = defaultdict(Counter)
        parts = pieces(samples)
        for i, p in enumerate(parts):
            self.after[()][p] += 1
            for n in (1, 2):
                if i >= n:
                    self.after[tuple(parts[i - n : i])][p] += 1
        self.start = parts[0] if parts else ""

    @functools.lru_cache(maxsize=4096)  # noqa: B019
    def _choices(self, context: tuple[str, ...], temperature: float, top_p: float) -> tuple[list[str], list[float]]:
        seen = next((self.after[context[k:]] for k in range(len(context) + 1) if context[k:] in self.after), Counter())
        ranked = sorted(seen.items(), key=lambda x: (-x[1], x[0]))
        if temperature <= 0:
            ranked = ranked[:1]
        weights = [n ** (1 / max(temperature, 0.05)) for _, n in ranked]
        enough, total = top_p * sum(weights), 0.0
        for k, w in enumerate(weights):
            total += w
            if total >= enough:
                return [p for p, _ in ranked[: k + 1]], weights[: k + 1]
        return [p for p, _ in ranked], weights

    def _one(self, r: dict) -> str | None:
        prompt = r["prompt"]
        if not prompt:
            return None
        chance = random.Random(hashlib.sha256(f"{r.get('seed', 0)}:{prompt}".encode("utf-8", "replace")).digest())
        temperature, top_p = r.get("temperature"), r.get("top_p")
        out: list[str] = []
        last: tuple[str, ...] = ()
        text = ""
        while len(out) < (r.get("max_tokens") or 128):
            found, weights = self._choices(last, 0.7 if temperature is None else temperature, 0.95 if top_p is None else top_p)
            if not found:
                break
            piece = chance.choices(found, weights)[0] if out else (chance.choice([p for p in (self.start, "\ndef")]).lstrip())
            out.append(piece)
            text += piece
            last = (*last, piece)[-2:]
            if any(s and s in text for s in r.get("stop") or ()):
                break
        return text

    def complete(self, requests: list[dict]) -> list[str | None]:
        return [self._one(r) for r in requests]


class HttpBackend:
    """A server with the common ``/v1/completions`` interface. A request that fails gives None; the caller tries again."""

    tokens = staticmethod(pieces)

    def __init__(self, url: str, model: str = "default", context: int = 1536, timeout: float = 120.0) -> None:
        self.url, self.model, self.context, self.timeout = url.rstrip("/") + "/v1/completions", model, context, timeout
        self.name = f"http:{model}"

    def _one(self, r: dict) -> str | None:
        from urllib.request import Request, urlopen

        body = {"model": self.model, "prompt": r["prompt"], "max_tokens": r["max_tokens"], "temperature": r["temperature"], "top_p": r["top_p"], "stop": r["stop"] or None, "seed": r.get("seed")}
        try:
            call = Request(self.url, json.dumps({k: v for k, v in body.items() if v is not None}).encode(), {"Content-Type": "application/json"})
            with urlopen(call, timeout=self.timeout) as answer:
                return str(json.load(answer)["choices"][0]["text"])
        except Exception:
            return None

    def complete(self, requests: list[dict]) -> list[str | None]:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max(1, len(requests))) as pool:
            return list(pool.map(self._one, requests))
