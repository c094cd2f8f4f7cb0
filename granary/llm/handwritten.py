"""Problem 2: source files that are not hand-written for their own repository.

A multi-pattern automaton runs over the comments at the head of chunks; where one of its words occurs, patterns
around it decide whether the comment is a generation notice or names a foreign project. Path rules know
suffixes of generated and minified files, lock files and folders of vendored projects. Counts over the whole code (white
space, line shapes that repeat, digits, unbroken literals) catch files whose notice was lost, and equal code
in another repository tells copies that lie in a vendored folder. Everything is summed over a file's chunks.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.shingles import _KIND, _OTHER, _B1, _running, _spans, mix, portions
from granary.session import materialize, table

#: Programs that sign what they write without a version: lower case.
TOOLS = "antlr|bison|flex|yacc|lex|swig|protoc|thrift|cython|django|alembic|sqlc|openapi|swagger|webpack|rollup|babel|typescript|tsc|cmake|autoconf|automake|libtool|qmake|moc|uic|rcc|rpcgen|ragel|gperf|jison|bindgen|cbindgen|doxygen|sphinx|javadoc|gradle|maven|bundler|npm|yarn|pnpm|cargo|poetry|pip-compile|graphql-codegen|prisma|mockgen|stringer|go-bindata|flatc|capnp|wsdl2java|xjc|jooq|hibernate|kubebuilder|controller-gen|terraform|helm|ansible|pg_dump|mysqldump|sqlite3|figma|inkscape|sketch|gimp|sass|less|stylus|coffeescript|emscripten|nuitka|f2c|f2py|vala|wayland-scanner|glib-mkenums|gdbus-codegen"
_TOOL = rf"(?:the\s+)?(?:[\w./+-]*\w\.[a-z]\w{{0,11}}\b|[\w+-]+(?:\s+[\w+-]+)?\s+\(?v?\d+(?:\.\d+)*\b|(?:{TOOLS})\b|[\w-]*(?:gen|codegen|compiler|generator|transpiler|preprocessor)\b)"
_WHOLE = r"this\s+(?:\w+\s+)?(?:file|code|header|module|source|script|stylesheet|page|document|class|schema)\s+(?:is|was|has\s+been|gets)\s+"
_MADE = r"(?:re)?(?:generated|produced|created|written|built|emitted)"
#: Words of the automaton, and what must stand around them in a line of a comment for it to be a generation notice.
NOTICES = {
    "edit": (r"\b(?i:do\s+not|don't|never)\s+(?i:hand[- ]?)?(?i:edit|modify)(?i:\s+(?:this|it\b|manually|by\s+hand|directly|below|(?:the\s+)?generated))", r"\bDO\s+NOT\s+(?:HAND[- ]?)?(?:EDIT|MODIFY)\b(?!\s+(?i:the|a|an|any|these|those|while|until|unless)\b)", r"(?i)\b(?:edit|change)\s+(?:the\s+)?[\w./-]+\s+instead\b"),
    "modify": (r"\b(?i:do\s+not|don't|never)\s+modify(?i:\s+(?:this|it\b|manually|by\s+hand|directly|(?:the\s+)?generated))", r"\bDO\s+NOT\s+MODIFY\b(?!\s+(?i:the|a|an|any|these|those|while|until|unless)\b)"),
    "generated": (
        r"@generated\b",
        r"(?i)<auto-?generated",
        rf"(?i)\b{_WHOLE}(?:\w+ly\s+|auto-?|machine-?)?{_MADE}\b",
        rf"(?i)^(?:(?:this\s+)?(?:file|code|header|source|module|document|stylesheet|page|script|schema|dump|migration|parser|lexer)\s+)?(?:automatically\s+|auto-?|machine[- ]?)?(?:re)?generated\s+(?:on\s+\S+\s+)?(?:by|from|with|using)\s+{_TOOL}",
        r"(?i)^code\s+generated\s+by\s+(?!the\b|an?\b|our\b|this\b|each\b|its\b)\S",
        r"(?i)^(?:this\s+is\s+an?\s+)?(?:auto-?|automatically\s+|machine[- ]?)?generated\s+(?:file|code|source|header|bindings?)\b\s*(?:$|[.:!,;(-])",
        r"(?i)^(?:auto-?|automatically\s+|machine[- ])generated(?:\s*(?:$|[.:!;(-])|\s+(?:by|from|with|using)\s)",
    ),
    "produced": (rf"(?i)\b{_WHOLE}(?:\w+ly\s+)?produced\b", rf"(?i)^(?:automatically\s+)?produced\s+(?:by|from|with)\s+{_TOOL}"),
    "written": (rf"(?i)\b{_WHOLE}(?:\w+ly\s+)?written\s+by\s+(?:a\s+(?:tool|script|program)|{_TOOL})", r"(?i)^machine[- ]written\b"),
    "built from": (rf"(?i)^(?:automatically\s+)?built\s+from\s+{_TOOL}.*(?:\d{{4}}-\d\d-\d\d|\binstead\b|\bdo\s+not\b)", rf"(?i)\b{_WHOLE}(?:\w+ly\s+)?built\s+from\s+{_TOOL}"),
    "be lost": (r"(?i)\b(?:changes|edits|modifications)(?:\s+(?:made|here|to\s+(?:this|the)\s+file|you\s+make))*\s+(?:will|may|would)\s+be\s+lost(?:\s*(?:$|[.!;,)])|\s+(?:the\s+)?next\s|.*regenerat)",),
    "overwritten": (r"(?i)\b(?:changes|edits|modifications|this\s+file)(?:\s+(?:made|here|to\s+(?:this|the)\s+file|you\s+make))*\s+(?:will|may|would)\s+be\s+overwritten(?:\s*(?:$|[.!;,)])|\s+(?:the\s+)?next\s|.*regenerat)",),
    "regenerate": (r"(?i)\bto\s+regenerate(?:\s+(?:it|this(?:\s+file)?))?\s*[,:]?\s+(?:run|use|execute|call)\b",),
    "(input:": (r"(?i)\(input:\s*\S+\.\w+\)",),
}
_LEGAL = r"licen[cs]e|all\s+rights\s+reserved|released\s+under|\(c\)\s*\d{4}"
_TAKEN = r"\b(?:copied|vendored|imported|taken|lifted|forked|mirrored|extracted)\s+(?:verbatim\s+|unchanged\s+|directly\s+)?from\s+(?:the\s+)?"
_HOST = r"\w+://(?:www\.)?(?:(?:github|gitlab|bitbucket|codeberg|sourceforge)\.\w+/[\w.-]+/([\w-]+)|([\w-]+)\.)"
#: Words of the automaton beside which a project is named, and how to read it from a line. The last field: whether the
#: name is enough by itself, or must be that of a known project (or stand under a copyright too).
OWNERS = {
    "part of": ((r"(?i)\bpart\s+of\s+(?:the\s+)?([\w.-]*\w)\s+(?:project|library|distribution|framework|toolkit)\b", False), (r"(?i)^(?:this\s+(?:file|code)\s+is\s+)?part\s+of\s+(?:the\s+)?([\w.-]*\w)\s*[.,;]?$", False)),
    "copyright": ((r"(?i)\bcopyright\b.*?\b(?:the\s+)?([\w.-]*\w)\s+(?:project\s+)?(?:authors|contributors|developers|committers)\b", False),),
    "upstream": ((rf"(?i)\bupstream(?:\s+\w+)?\s*[:=]\s*{_HOST}", True),),
    "see licen": ((r"(?i)\bsee\s+licen[cs]e\.([\w-]+)", True),),
    "from": ((rf"(?i){_TAKEN}([\w.-]*\w)\s*,?\s+(?:v|version\s+|release\s+)?(?:(?<=v)\d|\d+\.\d)", True), (rf"(?i){_TAKEN}{_HOST}", True), (rf"(?i){_TAKEN}([\w.-]*\w)\b", False)),
}
_BANNER = re.compile(r"(?i)^([\w.-]*\w)(?:\s+[\w.-]+){0,2}?\s+v?\d+\.\d+(?:\.\d+)*\b")
#: Words that are no project's name.
NO_NAMES = frozenset("a an and any api are as at be build by code copyright data each every file for from header i in is it its license licence line module of on or our page part release rev revision same schema section since step that the their them these this those to us version was we which with your".split())
GENERATED_PATH = r"(?i)(\.gen|_pb2|_pb2_grpc|\.pb|_autogen|\.autogen|\.generated|_generated|\.g|\.designer)\.[a-z0-9]+$"
MINIFIED_PATH = r"(?i)[.-]min\.[a-z0-9]+$"
LOCK_PATH = r"(?i)(^|/)([^/]+\.lock|package-lock\.json|npm-shrinkwrap\.json|pnpm-lock\.yaml|packages\.lock\.json|conda-lock\.yml|gradle\.lockfile|deno\.lock|\.terraform\.lock\.hcl|package\.resolved|cartfile\.resolved|go\.sum)$"
#: Folders that hold other projects, each in a folder of its name.
VENDOR_DIRS = ("third_party", "third-party", "thirdparty", "3rdparty", "vendor", "vendors", "vendored", "bundled", "extern", "external", "externals", "deps", "ext", "node_modules", "bower_components", "jspm_packages", "pods", "carthage")
VENDOR_PATH = rf"(?:^|/)(?:{'|'.join(VENDOR_DIRS)})/[^/]*/"  # such a folder, a project's folder in it, and a file below that
#: What may follow a project's name in a folder's: a version, or a short mark after '_'.
FOLDER_SUFFIX = r"([-_.@]v?\d[\w.+-]*|_[0-9a-z]{1,4})$"

LONG_LITERAL = 80  # characters without white space or punctuation other than + / = \ that count as a literal of data
COUNTS = ("chars", "spaces", "digits", "literal", "lines", "alike", "long_chars")
LONG_LINE = 160
COPIED_SHARE = 0.8  # of a file's characters, in chunks that another repository has too
COPIED_CHUNKS = 3  # different ones at least: a file that only holds a copied chunk or two is no copy
COPIED_CHARS = 100  # characters from which a chunk's code tells a copy
PERIOD = 10  # lines after which a template's lines come again at the latest
_B64 = np.zeros(_OTHER + 1, bool)
_B64[[*range(48, 58), *range(65, 91), *range(97, 123), 43, 47, 61, 92]] = True


@functools.lru_cache(maxsize=1)
def automaton():
    """All words in one automaton; the value names the table and the word."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in (*NOTICES, *OWNERS):
        a.add_word(word, word)
    a.make_automaton()
    return a


@functools.lru_cache(maxsize=1)
def patterns() -> tuple[dict, dict]:
    return {w: [re.compile(p) for p in ps] for w, ps in NOTICES.items()}, {w: [(re.compile(p), sure) for p, sure in ps] for w, ps in OWNERS.items()}


_PRELUDE = re.compile(r"(?:\ufeff|#!|<\?(?:xml|php)|<!doctype|['\"]use strict['\"]|#pragma once|\s)[^\n]*\n?", re.I)
_COMMENT = re.compile(
    r"/\*.*?(?:\*/|\Z)|<!--.*?(?:-->|\Z)|\{-.*?(?:-\}|\Z)|\(\*.*?(?:\*\)|\Z)|--\[\[.*?(?:\]\]|\Z)|[rRuU]?(?:\"\"\".*?(?:\"\"\"|\Z)|\'\'\'.*?(?:\'\'\'|\Z))"
    r"|(?:#(?!(?:include|define|ifn?def|if|else|elif|endif|undef|error|warning|import|line|region)\b)|//|--|;|%|dnl\b|(?i:rem)\b)[^\n]*",
    re.S,
)
_MARKS = re.compile(r"^(?:<!--|\{-|\(\*|--\[\[|[\s/*#;%!'\"-]|(?i:dnl|rem)\b)+|(?:-->|-\}|\*\)|\]\]|[\s*/#'\"-])+$")
_AT_HEAD = frozenset("#/<-;%{(\"'rRuUdD\ufeff")


def header(code: str) -> str:
    """The comments at the head of ``code``, in any of the usual forms; docstrings count, a first line for the system doesn't."""
    at, out = 0, []
    while at < len(code):
        if code[at].isspace():
            at += 1
        elif code[at] not in _AT_HEAD:
            break
        elif not out and (m := _PRELUDE.match(code, at)) or (m := _COMMENT.match(code, at)):
            if m.re is _COMMENT:
                out.append(m.group(0))
            at = m.end()
        else:
            break
    return "\n".join(out)


def read_header(text: str) -> tuple[bool, list[str], list[str]]:
    """Whether a leading comment has a generation notice, the projects it surely names as owners, and those it may name.

    A name is sure where a version, an address or a licence stands beside it, or two lines agree on it.
    """
    words = {w for _, w in automaton().iter(text.lower())}
    legal = re.search(_LEGAL, text, re.I)
    if not words and not legal:
        return False, [], []
    notice_patterns, owner_patterns = patterns()
    lines = [x for x in (_MARKS.sub("", y) for y in text.split("\n")) if x]
    notice, sure, maybe = False, set(), []
    for line in lines:
        low = line.lower()
        for w in words:
            if w in low:
                notice = notice or any(p.search(line) for p in notice_patterns.get(w, ()))
                for p, enough in owner_patterns.get(w, ()):
                    for m in p.finditer(line):
                        name = next((g for g in m.groups() if g), "").lower().rstrip(".")
                        if name and name not in NO_NAMES:
                            (sure.add if enough else maybe.append)(name)
        if legal and (m := _BANNER.match(line)) and (name := m.group(1).lower().rstrip(".")) not in NO_NAMES:
            sure.add(name)
    sure.update(n for n in set(maybe) if maybe.count(n) > 1)
    return notice, sorted(sure), sorted(set(maybe) - sure)


def measure(texts: list[str]) -> np.ndarray:
    """``COUNTS`` of each text (n, 7) over all its characters.

    spaces: white space; literal: characters in unbroken runs of ``LONG_LITERAL`` and more; lines:
    those of two tokens and more; alike: of these, such whose shape (names and numbers each taken as
    one), with that of the line before, came within the ``PERIOD`` lines before; long_chars: characters in
    lines over ``LONG_LINE``.
    """
    n = len(texts)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, n)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    chars = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    small = np.minimum(chars, _OTHER)
    kind = _KIND[small]
    word, own = kind == 1, kind == 2
    digit = (chars >= 48) & (chars <= 57)

    def per_text(mask_or_values):
        return np.add.reduceat(mask_or_values, edges[:-1], dtype=np.int64)

    run = _B64[small]
    opened = np.flatnonzero(run & ~np.concatenate([[False], run[:-1]]))
    closed = np.flatnonzero(run & ~np.concatenate([run[1:], [False]])) + 1
    big = closed - opened >= LONG_LITERAL
    literal = np.zeros(len(chars) + 1, np.int32)
    np.add.at(literal, opened[big], 1)
    np.add.at(literal, closed[big], -1)
    feed = np.flatnonzero(chars == 10)
    line_start = np.concatenate([[0], feed[:-1] + 1])
    line_len = feed - line_start
    line_text = edges.searchsorted(line_start, "right") - 1
    long_chars = np.bincount(line_text, np.where(line_len > LONG_LINE, line_len, 0), n).astype(np.int64)

    opens = own.copy()
    opens[0] |= word[0]
    opens[1:] |= word[1:] & ~word[:-1]
    starts = np.flatnonzero(opens)
    shape = np.where(word[starts], np.where(digit[starts], 1, 2), chars[starts] + 3).astype(np.uint64)
    first = starts.searchsorted(line_start)
    last = starts.searchsorted(feed)
    with np.errstate(over="ignore"):
        h = mix(_spans(_running(shape + np.uint64(1), _B1), first, last, _B1)) if len(starts) else np.zeros(len(feed), np.uint64)
    kept = np.flatnonzero(last - first >= 2)
    h, owner = h[kept], line_text[kept]
    alike = np.zeros(len(kept), bool)
    if len(kept) > 1:
        with np.errstate(over="ignore"):
            pair = mix(h[1:] * np.uint64(3) + h[:-1])
        whole = owner[1:] == owner[:-1]
        for back in range(1, PERIOD + 1):
            if len(pair) > back:
                alike[1 + back :] |= (pair[back:] == pair[:-back]) & (owner[1 + back :] == owner[: -1 - back]) & whole[:-back]
    out = np.empty((n, len(COUNTS)), np.int64)
    out[:, 0] = lengths - 1
    out[:, 1] = per_text(kind == 0) - 1
    out[:, 2] = per_text(digit)
    out[:, 3] = per_text(np.cumsum(literal[:-1]) > 0)
    out[:, 4] = np.bincount(owner, minlength=n)
    out[:, 5] = np.bincount(owner, alike, n)
    out[:, 6] = long_chars
    return out


def chunk_evidence(chunks: DataFrame, path_col: str, code_col: str, repo_col: str) -> DataFrame:
    """Per chunk: its file, its repository's name, what its header says, the counts of its code and a hash of it (line ends made equal)."""

    def run(batches):
        for batch in batches:
            codes = [c or "" for c in batch.column(1).to_pylist()]
            heads = [read_header(h) if (h := header(c)) else (False, [], []) for c in codes]
            m = np.concatenate([measure(codes[p]) for p in portions(codes)]) if codes else np.zeros((0, len(COUNTS)), np.int64)
            names = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([x for x, _, _ in heads], pa.bool_()), pa.array([x for _, x, _ in heads], names), pa.array([x for _, _, x in heads], names), *(pa.array(m[:, k]) for k in range(len(COUNTS))), batch.column(3)],
                names=["path", "repo", "notice", "owners", "named", *COUNTS, "same"],
            )

    name = repo_name(F.col(repo_col))
    code = F.col(code_col)
    few = chunks.select(F.col(path_col).alias("path"), code.alias("code"), name.alias("repo"), F.xxhash64(F.trim(F.replace(code, F.lit("\r"), F.lit("")))).alias("same")).where(F.col("path").isNotNull())
    return few.mapInArrow(run, "path STRING, repo STRING, notice BOOLEAN, owners ARRAY<STRING>, named ARRAY<STRING>, " + ", ".join(f"{c} BIGINT" for c in COUNTS) + ", same BIGINT")


def repo_name(repo: Column) -> Column:
    """A repository's name however it is spelled: last part of the path, no '.git', lower case; '' and null give null."""
    last = F.regexp_extract(F.lower(F.trim(repo)), r"([^/]+?)(?:\.git)?/*$", 1)
    return F.when(last != "", last)


def own_name(repo: Column, path: Column) -> Column:
    """The repository that a file belongs to: as ``repo`` names it, else the first folder of its path."""
    return F.coalesce(repo, F.lower(F.element_at(F.split(path, "/"), 1)))


def vendored_folders(path: Column) -> Column:
    """Names of the folders of ``path`` that lie in a folder for vendored projects."""
    parts = F.split(F.lower(path), "/")
    inner = F.greatest(F.size(parts) - 2, F.lit(0))
    inside = F.filter(F.arrays_zip(F.slice(parts, 1, inner).alias("dir"), F.slice(parts, 2, inner).alias("sub")), lambda x: x["dir"].isin(*VENDOR_DIRS))
    return F.filter(F.transform(inside, lambda x: x["sub"]), lambda s: s.isNotNull())


def copied_files(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """Paths in vendored folders of which another repository has ``COPIED_SHARE`` of the code outside of such folders.

    Code is met by its hash, each hash once a file and once for all that have it, so no group of copies grows.
    """
    inside = F.lower("path").rlike(VENDOR_PATH)
    placed = chunks.where(F.col("chars") >= COPIED_CHARS).select("path", "same", "chars", F.xxhash64(own_name(F.col("repo"), F.col("path"))).alias("own"), inside.alias("inside"))
    theirs = placed.where("NOT inside").groupBy("same").agg(F.min("own").alias("first"), F.max("own").alias("last"))
    mine = placed.where("inside").groupBy("path", "same").agg(F.sum("chars").alias("chars"), F.min("own").alias("own"))
    met = mine.join(theirs, "same").where((F.col("first") != F.col("own")) | (F.col("last") != F.col("own"))).groupBy("path").agg(F.sum("chars").alias("copied"), F.count("*").alias("n"))
    return met.join(files.select("path", F.col("chars").alias("whole")), "path").where((F.col("copied") >= COPIED_SHARE * F.col("whole")) & (F.col("n") >= COPIED_CHUNKS)).select("path", F.lit(True).alias("copied"))


def file_verdicts(chunks: DataFrame, repos: DataFrame | None = None, path_col: str = "file_path", code_col: str = "code", repo_col: str = "repo") -> DataFrame:
    """One row per file with its counts, its ``evidence`` (names of the rules that hold) and ``verdict``.

    ``verdict``: 'vendored', 'data', 'minified' or 'generated', the first for which a rule holds, or 'handwritten'.
    Rules: owner (a header surely names a project other than its own repository), named (a header names
    another known project), folder (the file lies in a folder named after another known project inside a folder for
    vendored projects), copy (see :func:`copied_files`); digits, literal; min_path, long_lines; notice, path,
    lock, alike. Known are the names in ``repos`` (column ``repo``) and those that headers surely name. The
    comment that leads a file may stand at the head of any of its chunks, so all heads are read.

    The rules over counts need some code to count: 300 characters (digits, literal), 400 (long_lines), 10 lines
    (alike); smaller files are judged by headers and paths alone. Null code counts as empty; files of empty code
    are hand-written; rows without a path are left out; repeated chunks weigh twice. The code is read once.
    """
    e = materialize(chunk_evidence(chunks, path_col, code_col, repo_col), "evidence")
    together = lambda c: F.array_distinct(F.flatten(F.collect_set(c))).alias(c)
    files = e.groupBy("path").agg(F.min("repo").alias("repo"), F.max("notice").alias("notice"), together("owners"), together("named"), *(F.sum(c).alias(c) for c in COUNTS))
    files = files.withColumn("own", own_name(F.col("repo"), F.col("path"))).withColumn("subs", vendored_folders(F.col("path")))
    files = materialize(files, "files")
    known = files.select(F.explode("owners").alias("name"))
    if repos is not None:
        known = known.union(repos.select(repo_name(F.col("repo")).alias("name")))
    known = known.where(F.col("name").isNotNull()).distinct()
    # a name as a folder writes it may carry a version
    in_folder = files.select("path", "own", F.explode("subs").alias("sub")).select("path", "own", F.explode(F.array_distinct(F.array("sub", F.regexp_replace("sub", FOLDER_SUFFIX, "")))).alias("name"), F.lit("folder").alias("rule"))
    in_header = files.select("path", "own", F.explode("named").alias("name"), F.lit("named").alias("rule"))
    foreign = in_folder.union(in_header).where(F.col("name") != F.col("own")).join(known, "name", "left_semi").groupBy("path").agg(F.max(F.col("rule") == "folder").alias("folder"), F.max(F.col("rule") == "named").alias("by_name"))
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    f = files.join(foreign, "path", "left").join(copied_files(e, files), "path", "left")
    rules = {
        "vendored": {"owner": F.exists("owners", lambda o: o != F.col("own")), "named": F.col("by_name"), "folder": F.col("folder"), "copy": F.col("copied")},
        "data": {"digits": (F.col("chars") >= 300) & (ratio("digits", "chars") >= 0.28), "literal": (F.col("chars") >= 300) & (ratio("literal", "chars") >= 0.4)},
        "minified": {"min_path": F.col("path").rlike(MINIFIED_PATH), "long_lines": (F.col("chars") >= 400) & (ratio("long_chars", "chars") >= 0.6) & (ratio("spaces", "chars") <= 0.1)},
        "generated": {"notice": F.col("notice"), "path": F.col("path").rlike(GENERATED_PATH), "lock": F.col("path").rlike(LOCK_PATH), "alike": (F.col("lines") >= 10) & (ratio("alike", "lines") >= 0.45)},
    }
    held = F.array_compact(F.array(*(F.when(c, F.lit(r)) for group in rules.values() for r, c in group.items())))
    f = f.withColumn("evidence", held)
    verdict = F.lit("handwritten")
    for name, group in reversed(rules.items()):
        verdict = F.when(F.arrays_overlap("evidence", F.array(*map(F.lit, group))), name).otherwise(verdict)
    return f.select("path", "repo", *COUNTS, "evidence", verdict.alias("verdict"))


def p2_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_verdicts(table(spark, sf_dir, "code_chunks_raw"), table(spark, sf_dir, "repos")).withColumnRenamed("path", "file_path")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_files(spark, sf_dir).where("verdict <> 'handwritten'").select("file_path")
