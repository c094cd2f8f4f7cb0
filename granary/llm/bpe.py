"""Byte-pair encoding by a public vocabulary, and its minimal acyclic lexicon.

The encoder is exact: text is cut into words by the vocabulary's public pattern, and each word
is encoded on its own. Frequent words lie in a minimal acyclic transducer (shared prefixes and
shared suffixes; the outputs along a path add up to the word's number, which gives its ids), kept
in one flat file that every worker maps into memory. Words it lacks are merged by rank.
"""

from __future__ import annotations

import base64
import functools
import heapq
import mmap
import re
import struct

import numpy as np
import regex

TOKENIZER_DIR = "/opt/tokenizers"
#: The public pre-tokenisation pattern of this byte-level vocabulary.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same over ASCII, where the letters, digits and white space that it can meet are few.
ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"""
MAX_LEXICON_WORD = 64  # bytes; longer words are merged, so the lexicon's size has a bound
MAGIC = b"MADT0001"


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id of a ``.tiktoken`` file; an id is also the rank of its merge."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def ranks_path(directory: str = TOKENIZER_DIR, name: str = "byte_bpe_50k") -> str:
    return f"{directory}/{name}.tiktoken"


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: merge the neighbouring pair of lowest rank, leftmost first, until none is known.

    A heap over a linked list, so a run of n bytes takes O(n log n).
    """
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        r = ranks.get(word[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = end[i]
        if j >= n or end[j] != stop:
            continue  # one half has been merged since
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
            r = ranks.get(word[i : end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        h = prev[i]
        if h >= 0:
            r = ranks.get(word[h:stop])
            if r is not None:
                heapq.heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class LexiconBuilder:
    """Minimal acyclic automaton from words in byte order (incremental construction)."""

    def __init__(self) -> None:
        self.edges: list[dict[int, int]] = [{}]
        self.final = [False]
        self.register: dict[tuple, int] = {}
        self.path: list[tuple[int, int, int]] = []  # unminimised (parent, byte, child)
        self.last = b""

    def add(self, word: bytes) -> None:
        if word <= self.last and (self.last or self.final[0]):
            raise ValueError("words must come in strictly increasing byte order")
        common = 0
        for a, b in zip(word, self.last):
            if a != b:
                break
            common += 1
        self._minimise(common)
        state = self.path[-1][2] if self.path else 0
        for byte in word[common:]:
            self.edges.append({})
            self.final.append(False)
            child = len(self.edges) - 1
            self.edges[state][byte] = child
            self.path.append((state, byte, child))
            state = child
        self.final[state] = True
        self.last = word

    def _minimise(self, keep: int) -> None:
        while len(self.path) > keep:
            parent, byte, child = self.path.pop()
            key = (self.final[child], tuple(sorted(self.edges[child].items())))
            same = self.register.setdefault(key, child)
            if same != child:
                self.edges[parent][byte] = same

    def finish(self, ids: list[list[int]]) -> bytes:
        """The flat file; ``ids`` holds the output of the n-th word added."""
        self._minimise(0)
        order, seen, stack = [], {0}, [0]
        while stack:
            s = stack.pop()
            order.append(s)
            for t in self.edges[s].values():
                if t not in seen:
                    seen.add(t)
                    stack.append(t)
        number = {s: i for i, s in enumerate(order)}
        below: dict[int, int] = {}

        def count(root: int) -> int:
            todo = [root]
            while todo:
                s = todo[-1]
                missing = [t for t in self.edges[s].values() if t not in below]
                if missing:
                    todo.extend(missing)
                else:
                    below[s] = int(self.final[s]) + sum(below[t] for t in self.edges[s].values())
                    todo.pop()
            return below[root]

        count(0)
        first = np.zeros(len(order) + 1, np.int32)
        label, target, output = [], [], []
        for i, s in enumerate(order):
            out = int(self.final[s])
            for byte in sorted(self.edges[s]):
                t = self.edges[s][byte]
                label.append(byte)
                target.append(number[t])
                output.append(out)
                out += below[t]
            first[i + 1] = len(label)
        final = np.array([self.final[s] for s in order], np.uint8)
        offsets = np.zeros(len(ids) + 1, np.int32)
        offsets[1:] = np.cumsum([len(x) for x in ids])
        flat = np.array([x for word in ids for x in word], np.int32)
        parts = [first, np.array(target, np.int32), np.array(output, np.int32), offsets, flat, np.array(label, np.uint8), final]
        head = MAGIC + struct.pack("<7q", *(len(p) for p in parts))
        return head + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Read-only view of the flat file; ``source`` is its bytes or a path to map.

    Nothing is copied: a look-up finds each byte among a state's labels within the mapped file.
    """

    def __init__(self, source: bytes | str) -> None:
        if isinstance(source, str):
            with open(source, "rb") as f:
                source = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if source[:8] != MAGIC:
            raise ValueError("not a lexicon file")
        sizes, at, parts = struct.unpack("<7q", source[8:64]), 64, []
        view = memoryview(source)
        for n, code in zip(sizes, "iiiiiBB"):
            size = n * struct.calcsize(code)
            parts.append((at, view[at : at + size].cast(code)))
            at += size
        self.first, self.target, self.output, self.offsets, self.flat, _, self.final = (v for _, v in parts)
        self.labels_at, self.find = parts[5][0], source.find
        self.n_words = len(self.offsets) - 1

    def index(self, word: bytes) -> int:
        """Number of ``word`` in byte order, -1 if it isn't there: the outputs along its path."""
        state = total = 0
        first, target, output, at, find = self.first, self.target, self.output, self.labels_at, self.find
        for i in range(len(word)):
            k = find(word[i : i + 1], at + first[state], at + first[state + 1]) - at
            if k < 0:
                return -1
            total += output[k]
            state = target[k]
        return total if self.final[state] else -1

    def ids(self, word: bytes) -> list[int] | None:
        i = self.index(word)
        return None if i < 0 else self.flat[self.offsets[i] : self.offsets[i + 1]].tolist()


def build_lexicon(words: list[bytes], ranks: dict[bytes, int]) -> bytes:
    """The lexicon file of ``words`` (any order, repeats allowed; over-long words are left out)."""
    builder = LexiconBuilder()
    kept = sorted({w for w in words if 0 < len(w) <= MAX_LEXICON_WORD})
    for w in kept:
        builder.add(w)
    return builder.finish([merge_word(w, ranks) for w in kept])


def cutter():
    """The function that cuts a text into its words."""
    ascii_, whole = re.compile(ASCII_PATTERN).findall, regex.compile(WORD_PATTERN).findall
    return lambda text: ascii_(text) if text.isascii() else whole(text)


class Encoder:
    """Text to ids: cut into words, look each up in the lexicon, merge what it lacks.

    ``memo`` keeps the ids of words met by this worker; it is emptied when full, so its size has
    a bound whatever the text.
    """

    MEMO_WORDS = 200_000

    def __init__(self, ranks: dict[bytes, int], lexicon: Lexicon | None = None) -> None:
        self.ranks, self.lexicon = ranks, lexicon
        self.cut = cutter()
        self.memo: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        raw = w.encode("utf-8", "replace")
        ids = self.lexicon.ids(raw) if self.lexicon is not None and len(raw) <= MAX_LEXICON_WORD else None
        if ids is None:
            ids = merge_word(raw, self.ranks)
        if len(raw) <= MAX_LEXICON_WORD:
            if len(self.memo) >= self.MEMO_WORDS:
                self.memo.clear()
            self.memo[w] = ids
        return ids

    def encode(self, text: str, out: list[int] | None = None) -> list[int]:
        """Ids of ``text``, behind those of ``out`` where given."""
        out = [] if out is None else out
        get, word, extend = self.memo.get, self.word, out.extend
        for w in self.cut(text):
            extend(get(w) or word(w))
        return out

    def count(self, text: str) -> int:
        get, word = self.memo.get, self.word
        return sum(len(get(w) or word(w)) for w in self.cut(text))
