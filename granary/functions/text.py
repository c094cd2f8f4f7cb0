"""Text functions as Column expressions; none of them leaves the JVM.

White space is that of Unicode, as ``str.strip`` and ``str.split`` of Python see it, not only the blank.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes, patterns and bounds that decide results.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
STRIP_RE = rf"^{SPACE}+|{SPACE}+\z"
LINE_RE = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
YAML_KEY_RE = r"^([A-Za-z0-9_.][A-Za-z0-9_.\-]*):\s*(.*)$"
CHARS_PER_TOKEN = 4
FILENAME_LIMIT, FILENAME_KEEP = 64, 55


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """White space off both ends."""
    return F.regexp_replace(c, STRIP_RE, "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{SPACE}+\z", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.regexp_replace(strip(c), rf"{SPACE}+", " ")


def words(c: Column) -> Column:
    """Words between white space; none for a blank text."""
    return F.filter(F.split(c, rf"{SPACE}+"), lambda w: w != "")


def split_lines(c: Column) -> Column:
    """Lines as ``str.splitlines`` gives them: any line mark ends one, a last empty one doesn't count."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, rf"(?:{LINE_RE})\z", ""), LINE_RE))


def file_lines(c: Column) -> Column:
    """Number of lines as a file read in binary has them: ended by a line feed only."""
    feeds = F.char_length(c) - F.char_length(F.replace(c, F.lit("\n"), F.lit("")))
    return F.when(c == "", 0).otherwise(feeds + F.when(F.endswith(c, F.lit("\n")), 0).otherwise(1)).cast("bigint")


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def token_estimate(c: Column) -> Column:
    """Tokens of a text where no tokenizer is at hand: a quarter of its characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.char_length(c) / CHARS_PER_TOKEN)).cast("bigint")


def digest(c: Column) -> Column:
    """SHA-256 in hex; equal texts have equal digests."""
    return F.sha2(c.cast("binary"), 256)


def hash_order(seed: int, *keys: Column) -> Column:
    """A key whose order is a reproducible shuffle of the rows, the same in any SQL engine with md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(k.cast("string") for k in keys)))


def hash_pick(choices: list[str], seed: int, key: Column) -> Column:
    """One of ``choices`` by hash of ``key``: first 8 hex digits of :func:`hash_order`, modulo their number."""
    n = F.conv(F.substring(hash_order(seed, key), 1, 8), 16, 10).cast("bigint")
    return F.element_at(F.array(*map(F.lit, choices)), (F.pmod(n, F.lit(len(choices))) + 1).cast("int"))


def safe_filename(c: Column) -> Column:
    """A name for a file: other signs than letters, digits, - and _ become _; long names end in a short digest."""
    clean = F.regexp_replace(c, "[^a-zA-Z0-9_-]", "_")
    return F.when(F.char_length(clean) <= FILENAME_LIMIT, clean).otherwise(F.concat(F.substring(clean, 1, FILENAME_KEEP), F.lit("_"), F.substring(F.sha1(c.cast("binary")), 1, 8)))


def safe_filename_of(name: str) -> str:
    """The same for one name, outside of Spark."""
    clean = "".join(ch if ch.isascii() and (ch.isalnum() or ch in "_-") else "_" for ch in name)
    return clean if len(clean) <= FILENAME_LIMIT else f"{clean[:FILENAME_KEEP]}_{hashlib.sha1(name.encode('utf-8', 'replace')).hexdigest()[:8]}"


def strip_fences(c: Column) -> Column:
    """Code without the ``` lines a model may put before and after it."""
    lines = split_lines(strip(c))
    fence = lambda x: F.startswith(strip(x), F.lit("```"))
    head = F.when((F.size(lines) > 0) & fence(F.element_at(lines, 1)), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).otherwise(lines)
    tail = F.when(F.size(head) > 0, F.when(fence(F.element_at(head, -1)), F.slice(head, 1, F.size(head) - 1)).otherwise(head)).otherwise(head)
    return strip(F.array_join(tail, "\n"))


def first_line(c: Column) -> Column:
    return strip(F.element_at(F.split(c, "\n"), 1))


def chunk_name(line: Column) -> Column:
    """Name of a chunk from its first line: the last word before '(' if there is one, else up to 64 characters."""
    before = F.element_at(F.split(line, r"\("), 1)
    named = F.contains(line, F.lit("(")) & (strip(before) != "")
    return F.when(named, F.element_at(words(before), -1)).otherwise(F.substring(line, 1, 64))


def chunk_signature(line: Column) -> Column:
    return F.substring(line, 1, 256)


def yaml_key(line: Column) -> Column:
    """The key that opens a top-level YAML block on this line, else null."""
    s = rstrip(line)
    plain = (s != "") & ~F.startswith(s, F.lit("#")) & ~F.startswith(s, F.lit("---")) & (strip(F.substring(line, 1, 1)) != "")
    return F.when(plain & s.rlike(YAML_KEY_RE), F.regexp_extract(s, YAML_KEY_RE, 1))


def opens_yaml(line: Column) -> Column:
    """Whether :func:`yaml_key` finds a key. One look: what a key begins with is neither white space nor '#' nor '-'."""
    return line.rlike(r"^[A-Za-z0-9_.][A-Za-z0-9_.\-]*:")


def duration(seconds: Column) -> Column:
    """'1h 02m', '2m 03s' or '5s'."""
    s = F.greatest(seconds.cast("bigint"), F.lit(0))
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.when(h > 0, F.concat(h.cast("string"), F.lit("h "), two(m), F.lit("m"))).when(m > 0, F.concat(m.cast("string"), F.lit("m "), two(r), F.lit("s"))).otherwise(F.concat(r.cast("string"), F.lit("s")))


def version_key(name: Column) -> Column:
    """Numbers of a dotted version within a name, for sorting: 'tool-1.10.2' gives [1, 10, 2]; [] without one."""
    return F.transform(F.filter(F.split(F.regexp_extract(name, r"(\d+(?:\.\d+)*)", 1), r"\."), lambda x: x != ""), lambda x: x.cast("bigint"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_suffix(path: Column) -> Column:
    """Extension with its dot, '' for none; a name that starts with its only dot has none."""
    return F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)


def decode_text(content: Column) -> Column:
    """UTF-8 bytes as text, malformed ones replaced."""
    return F.call_function("make_valid_utf8", content.cast("string"))


def newest(rows, name_col: str):
    """The row whose name has the highest version (of equal ones the last name)."""
    return rows.orderBy(F.desc(version_key(F.col(name_col))), F.desc(name_col)).limit(1)
