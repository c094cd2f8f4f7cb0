"""Reference pages in HTML to records, by a small tree on the standard parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}
LONGEST_DESCRIPTION = 1000  # fixed value: characters of a description that are kept
# The questions.
C_QUESTION = "What is the signature and purpose of C's {}?"
PYTHON_QUESTION = "What is the Python {} function signature and behavior?"
WEB_QUESTION = "What is the MDN reference for {}?"
_SIGN = re.compile(r"\s*¶\s*$")
_OWN_NAME = re.compile(r"^(?:[^(]*\.)?([^(.]*?)\s*\(")


class Node:
    """An element: its tag, classes, children (nodes and texts) and place in reading order."""

    def __init__(self, tag: str, classes: list[str], parent: Node | None, place: int) -> None:
        self.tag, self.classes, self.parent, self.place = tag, classes, parent, place
        self.children: list[Node | str] = []

    def walk(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def find(self, tag: str, css: str | None = None) -> Node | None:
        return next((n for n in self.walk() if n.tag == tag and (css is None or css in n.classes)), None)

    def texts(self):
        for c in self.children:
            if isinstance(c, str):
                yield c
            elif c.tag not in HIDDEN:
                yield from c.texts()

    def text(self, between: str = "") -> str:
        """Stripped pieces of text joined by ``between``; scripts and styles are no text."""
        return between.join(t for t in (x.strip() for x in self.texts()) if t)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", [], None, 0)
        self.count = 0

    def handle_starttag(self, tag, attrs):
        self.count += 1
        n = Node(tag, (dict(attrs).get("class") or "").split(), self.at, self.count)
        self.at.children.append(n)
        if tag not in VOID:
            self.at = n

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    t = _Tree()
    t.feed(html)
    t.close()
    return t.root


def _reply(question: str, name: str, *parts: str) -> tuple[str, str, str]:
    """A record about ``name``: its question, the parts that there are, and the name as topic."""
    return question.format(name), "\n\n".join(filter(None, parts)), name


def _text(node: Node | None, between: str = "") -> str:
    return "" if node is None else node.text(between)


def c_reference(key: str, html: str) -> list[tuple[str, str, str]]:
    """A C reference page: (instruction, output, topic), none without a heading or without signature and description."""
    root = parse(html)
    title, example = root.find("h1"), root.find("div", "example")
    signature, description = _text(root.find("code", "t-cpp") or root.find("code")), _text(root.find("p"))
    if title is None or not (signature or description):
        return []
    return [_reply(C_QUESTION, title.text(), signature, description, _text(example and example.find("pre")))]


def python_reference(key: str, html: str) -> list[tuple[str, str, str]]:
    """A Python module's page (``key`` is the module): one record per signature with a parenthesis.

    One walk through the page: signatures wait until a description comes, which then belongs to all that wait.
    """
    described: list[tuple[str, str]] = []
    waiting: list[str] = []
    for node in parse(html).walk():
        if node.tag == "dd" and waiting:
            said = node.text(" ")[:LONGEST_DESCRIPTION]
            described += [(s, said) for s in waiting]
            waiting = []
        elif node.tag == "dt" and "sig" in node.classes:
            waiting.append(_SIGN.sub("", " ".join(node.text(" ").split())))
    described += [(s, "") for s in waiting]
    callables = [(s, said, _OWN_NAME.search(s)) for s, said in described]
    return [_reply(PYTHON_QUESTION, f"{key}.{m.group(1)}", s, said) for s, said, m in callables if m]


def web_reference(key: str, html: str) -> list[tuple[str, str, str]]:
    """A web reference page (``key`` is its section path): always one record."""
    root = parse(html)
    heading, body = root.find("h1"), root.find("main") or root.find("article") or root
    name = key.rpartition("/")[2] if heading is None else heading.text()
    return [_reply(WEB_QUESTION, name, _text(root.find("div", "syntax") or root.find("pre", "syntaxbox")), _text(body.find("p"))[:LONGEST_DESCRIPTION])]


FAMILIES = {"c": c_reference, "python": python_reference, "web": web_reference}


def page_records(pages: DataFrame, family: str, key_col: str, html_col: str = "html") -> DataFrame:
    """Records of reference pages of one ``family``: key, instruction, output, topic. Null pages give none."""
    reader = FAMILIES[family]

    def run(batches):
        for batch in batches:
            rows = [(k, *r) for k, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if h is not None for r in reader(k or "", h)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)], names=["key", "instruction", "output", "topic"])

    return pages.select(F.col(key_col).cast("string"), html_col).mapInArrow(run, "key STRING, instruction STRING, output STRING, topic STRING")
