"""Cutting files into chunks: YAML by top-level keys, line blocks, source files by their constructs."""

from __future__ import annotations

import ast
import bisect
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text as X

# Bounds of chunks in lines, and the length beyond which a raw block is cut again.
MIN_LINES, MAX_LINES = 3, 200
LONG_BLOCK = 16_384
HTML_TAGS = ("main", "section", "article", "form", "template", "nav", "header", "footer")


def line_blocks(rows: DataFrame, id_col: str, text_col: str, size: int = MAX_LINES) -> DataFrame:
    """Blocks of ``size`` lines: id, block (from 0), start_line (from 1), n_lines, text. Blank texts give their blank lines."""
    lines = X.split_lines(F.col(text_col))
    n = F.size("_lines")
    blocks = rows.where(F.col(text_col).isNotNull()).select(F.col(id_col), lines.alias("_lines")).where(n > 0)
    out = blocks.select(id_col, "_lines", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))).alias("block"))
    part = F.slice("_lines", F.col("block") * size + 1, F.lit(size))
    return out.select(id_col, "block", (F.col("block") * size + 1).alias("start_line"), F.size(part).alias("n_lines"), F.array_join(part, "\n").alias("text"))


def yaml_chunks(files: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Chunks of YAML texts: id, chunk (from 0), n_lines, text.

    A top-level key starts a segment; segments over ``MAX_LINES`` lines are cut into blocks; blocks under
    ``MIN_LINES`` join the next larger one, those after the last larger one form a chunk of their own (which may
    stay small). A document mark '---' starts nothing. Null and empty texts give no row; a repeated id is cut
    again. Chunks are ranges of a text's lines, so each row is cut where it lies: no shuffle.
    """
    after = lambda xs, i: F.coalesce(F.get(xs, i + 1), F.col("_n"))
    rows = files.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), X.split_lines(F.col(text_col)).alias("_l")).withColumn("_n", F.size("_l")).where("_n > 0")
    keys = F.array_compact(F.transform("_l", lambda line, i: F.when((i > 0) & X.opens_yaml(line), i)))
    opened = rows.withColumn("_s", F.concat(F.array(F.lit(0)), keys))
    blocked = opened.withColumn("_b", F.flatten(F.transform("_s", lambda a, i: F.sequence(a, after(F.col("_s"), i) - 1, F.lit(MAX_LINES)))))
    ends = F.array_compact(F.transform("_b", lambda a, i: F.when(after(F.col("_b"), i) - a >= MIN_LINES, after(F.col("_b"), i))))
    ended = blocked.withColumn("_e", F.array_distinct(F.concat(ends, F.array("_n"))))
    begun = F.transform("_e", lambda e, i: F.struct(F.when(i == 0, 0).otherwise(F.get(F.col("_e"), i - 1)).alias("a"), e.alias("b")))
    out = ended.select("_id", "_l", F.posexplode(begun).alias("chunk", "at"))
    n = F.col("at.b") - F.col("at.a")
    return out.select(F.col("_id").alias(id_col), "chunk", n.cast("bigint").alias("n_lines"), F.array_join(F.slice("_l", F.col("at.a") + 1, n), "\n").alias("text"))


def config_instruction(path: Column, text: Column) -> Column:
    """The task that a chunk of a configuration file answers, from its path and content.

    Names are compared as written: 'Dockerfile' and 'Makefile' in capitals get the general sentence.
    """
    low, name = F.lower(path), X.file_name(path)
    # What is looked for, and the sentences.
    kind = F.regexp_extract(text, r"(?m)^kind:\s*([A-Za-z]+)", 1)
    target = F.regexp_extract(text, r"metadata:\s*\n\s+name:\s*([^\s]+)", 1)
    service = F.regexp_extract(text, r"(?m)^  ([a-zA-Z0-9_-]+):", 1)
    rules = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"(?m)^([A-Za-z0-9_-]+):"), 1), 1, 4), ", ")
    ends = lambda *xs: F.greatest(*(F.endswith(low, F.lit(x)).cast("int") for x in (*xs, xs[0]))) == 1
    say = F.format_string
    yaml = (
        F.when(F.contains(name, F.lit("docker-compose")) | F.contains(low, F.lit("compose")), say("Write the docker-compose service definition for `%s` as shown.", F.when(service == "", "app").otherwise(service)))
        .when((kind != "") & (target != ""), say("Write the Kubernetes %s manifest for `%s`.", kind, target))
        .when(kind != "", say("Write the Kubernetes %s manifest shown here.", kind))
        .when(F.contains(text, F.lit("---")), say("Provide the Kubernetes configuration defined in %s.", name))
        .otherwise(say("Provide the YAML configuration defined in %s.", name))
    )
    return (
        F.when(ends(".yaml", ".yml"), yaml)
        .when(F.startswith(name, F.lit("dockerfile")), say("Write the %s multi-stage build shown here.", name))
        .when((name == "makefile") | F.startswith(name, F.lit("makefile.")), say("Write the Makefile target(s) for: %s.", rules))
        .when(ends(".service", ".timer"), say("Write the systemd %s unit defined in %s.", F.regexp_replace(X.file_suffix(path), r"^\.", ""), name))
        .when(ends(".tf", ".tfvars"), say("Write the Terraform configuration defined in %s.", name))
        .otherwise(say("Provide the DevOps configuration defined in %s.", name))
    )


def config_chunks(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Chunks of configuration files with their task: path, chunk, part, instruction, output.

    YAML is cut by :func:`yaml_chunks`, other files stay whole; chunks under ``MIN_LINES`` lines are dropped, those over
    ``LONG_BLOCK`` characters are cut into blocks of ``MAX_LINES`` lines. Blank files give no row.
    """
    live = files.where(X.strip(X.text_or_empty(F.col(text_col))) != "").select(F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    is_yaml = F.lower("path").rlike(r"\.ya?ml$")
    whole = live.where(~is_yaml).select("path", F.lit(0).alias("chunk"), "text")
    chunks = yaml_chunks(live.where(is_yaml), "path", "text").select("path", "chunk", "text").union(whole).where(F.size(X.split_lines(F.col("text"))) >= MIN_LINES)
    long = F.char_length("text") > LONG_BLOCK
    cut = line_blocks(chunks.where(long).withColumn("_k", F.struct("path", "chunk")), "_k", "text").where(F.col("n_lines") >= MIN_LINES).select("_k.path", "_k.chunk", F.col("block").alias("part"), "text")
    parts = chunks.where(~long).select("path", "chunk", F.lit(0).alias("part"), "text").union(cut)
    return parts.select("path", "chunk", "part", config_instruction(F.col("path"), F.col("text")).alias("instruction"), F.col("text").alias("output"))


# --- source files: one function per language gives (kind, first line, last line, first and last place), lines from 1 ---

Span = tuple[str, int, int, object, object]


def python_spans(text: str) -> list[Span]:
    """Functions, classes and decorated definitions; a decorated one also counts without its decorators."""
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    out = []
    for node in ast.walk(tree):
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            if node.decorator_list:
                first = min((d.lineno, d.col_offset) for d in node.decorator_list)
                out.append(("decorated", first[0], node.end_lineno, first, (node.end_lineno, node.end_col_offset)))
            out.append(("class" if isinstance(node, ast.ClassDef) else "func", node.lineno, node.end_lineno, (node.lineno, node.col_offset), (node.end_lineno, node.end_col_offset)))
    return sorted(out, key=lambda s: (s[1], -s[2]))


_NOISE = {
    "c": re.compile(r'//[^\n]*|/\*.*?(?:\*/|\Z)|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'', re.S),
    "javascript": re.compile(r'//[^\n]*|/\*.*?(?:\*/|\Z)|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'|`(?:\\.|[^`\\])*`', re.S),
    "css": re.compile(r'/\*.*?(?:\*/|\Z)|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'', re.S),
}


def _blank(text: str, language: str) -> str:
    """``text`` with comments and literals as blanks of the same length, line feeds kept."""
    return _NOISE[language].sub(lambda m: re.sub(r"[^\n]", " ", m.group(0)), text)


_BRACE = re.compile(r"[{}]")


def _braces(code: str) -> dict[int, int]:
    """Index of each opening brace to that of its closing one; unclosed ones are left out."""
    pairs, open_ = {}, []
    for m in _BRACE.finditer(code):
        if m.group(0) == "{":
            open_.append(m.start())
        elif open_:
            pairs[open_.pop()] = m.start()
    return pairs


def _line_numbers(code: str):
    feeds = [m.start() for m in re.finditer("\n", code)]
    return lambda i: bisect.bisect_left(feeds, i) + 1


_C_HEAD = re.compile(r"[;{}]|\Z")
_JS_HEADS = (("func", re.compile(r"(?:\basync\s+)?\bfunction\s+\w+\s*\([^)]*\)\s*\{")), ("class", re.compile(r"\bclass\s+\w+[^{;()]*\{")), ("arrow", re.compile(r"(?:\basync\s+)?(?:\([^()]*\)|\b\w+)\s*=>\s*\{")), ("method", re.compile(r"(?m)^[ \t]+(?:static\s+|async\s+|get\s+|set\s+|\*)*(?!(?:if|for|while|switch|catch|function|return|with)\b)[\w$#]+\s*\([^()]*\)\s*\{")))


def c_spans(text: str) -> list[Span]:
    """Function definitions and declarations at the top level of a C file, found by its braces."""
    code = re.sub(r"(?m)^[ \t]*#(?:[^\n\\]|\\\n|\\.)*", lambda m: re.sub(r"[^\n]", " ", m.group(0)), _blank(text, "c"))
    line, braces = _line_numbers(code), _braces(code)
    out, at = [], 0
    while at < len(code):
        m = _C_HEAD.search(code, at)
        head = code[at : m.start()]
        begin = at + len(head) - len(head.lstrip())
        if m.group(0) == "{":
            close = braces.get(m.start(), -1)
            if close < 0:
                break
            if re.search(r"\)\s*$", head) and not re.search(r"=\s*$", head):
                out.append(("func", line(begin), line(close), begin, close))
                at = close + 1
                continue
            end = code.find(";", close)
            if end < 0:
                break
            if head.strip():
                out.append(("decl", line(begin), line(end), begin, end))
            at = end + 1
        elif m.group(0) == ";":
            if head.strip():
                out.append(("decl", line(begin), line(m.start()), begin, m.start()))
            at = m.end()
        else:
            at = m.end() if m.group(0) else len(code)
    return out


def javascript_spans(text: str) -> list[Span]:
    """Functions, classes, arrow functions with a body and methods, found by their heads and braces."""
    code = _blank(text, "javascript")
    line, braces = _line_numbers(code), _braces(code)
    out, seen = [], set()
    for kind, head in _JS_HEADS:
        for m in head.finditer(code):
            close = braces.get(m.end() - 1, -1)
            begin = m.start() + len(m.group(0)) - len(m.group(0).lstrip())
            if close >= 0 and (begin, close) not in seen:
                seen.add((begin, close))
                out.append((kind, line(begin), line(close), begin, close))
    return sorted(out, key=lambda s: (s[1], -s[2]))


def css_spans(text: str) -> list[Span]:
    """Rules and media statements; rules within a media statement count too."""
    code = _blank(text, "css")
    line, braces = _line_numbers(code), _braces(code)
    out, last = [], 0
    for m in re.finditer(r"[{};]", code):
        head, begin = code[last : m.start()], last
        last = m.end()
        close = braces.get(m.start(), -1)
        if m.group(0) != "{" or close < 0 or not head.strip():
            continue
        begin += len(head) - len(head.lstrip())
        at_rule = code[begin] == "@"
        if not at_rule or code.startswith("@media", begin):
            out.append(("media" if at_rule else "rule", line(begin), line(close), begin, close))
    return out


def html_spans(text: str) -> list[Span]:
    """Elements that structure a page, from their start tag to their end tag; unclosed ones are left out."""
    from html.parser import HTMLParser

    out: list[Span] = []

    class Reader(HTMLParser):
        open_: list[tuple[str, tuple[int, int]]] = []

        def handle_starttag(self, tag, attrs):
            if tag in HTML_TAGS:
                self.open_.append((tag, self.getpos()))

        def handle_endtag(self, tag):
            for k in range(len(self.open_) - 1, -1, -1):
                if self.open_[k][0] == tag:
                    out.append(("semantic", self.open_[k][1][0], self.getpos()[0], self.open_[k][1], self.getpos()))
                    del self.open_[k:]
                    break

    reader = Reader(convert_charrefs=True)
    reader.open_ = []
    reader.feed(text)
    return sorted(out, key=lambda s: (s[1], -s[2]))


SPANS = {"python": python_spans, "c": c_spans, "javascript": javascript_spans, "css": css_spans, "html": html_spans}


def source_chunks(files: DataFrame, repo: str = "repo", language: str = "language", path: str = "file_path", text: str = "text") -> DataFrame:
    """Code chunks (chunk schema) of source files: constructs of ``MIN_LINES`` to ``MAX_LINES`` lines, nested ones too.

    Each range of a file is one chunk, of the first construct that has it.
    Languages without a reader, null texts and files that can't be parsed give no row. Python is read by
    its own grammar, the others by scanners that know comments, literals and braces.
    """

    def run(batches):
        columns = ["repo", "language", "file_path", "chunk_type", "start_line", "end_line", "code"]
        kinds = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.string()]
        for batch in batches:
            out: list[list] = [[] for _ in columns]
            for r, lang, p, t in zip(*(batch.column(i).to_pylist() for i in range(4))):
                reader = SPANS.get(lang)
                if reader is None or t is None:
                    continue
                lines = t.split("\n")
                once = {(begin, end): (kind, a, b) for kind, a, b, begin, end in reversed(reader(t))}
                for kind, a, b in reversed(once.values()):
                    if MIN_LINES <= b - a + 1 <= MAX_LINES:
                        for column, v in zip(out, (r, lang, p, kind, a, b, "\n".join(lines[a - 1 : b]))):
                            column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=columns)

    found = files.select(*(F.col(c).cast("string") for c in (repo, language, path, text))).mapInArrow(run, "repo STRING, language STRING, file_path STRING, chunk_type STRING, start_line BIGINT, end_line BIGINT, code STRING")
    line = X.first_line(F.col("code"))
    return found.select("repo", "language", "file_path", "chunk_type", X.chunk_name(line).alias("name"), "start_line", "end_line", "code", X.chunk_signature(line).alias("signature"))
