"""Text functions against plain Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from granary.functions import text as X

SAMPLES = ["", " ", "a", "\n a \t", "  é😀  x ", "a\r\nb\r\n", "a\n\nb", "a\x0bb\x0cc", "x y", "```python\ncode\n```", "```\n```", "def f(x):\n  pass", "(lambda)", "class A", "key: v", "  indented: v", "# c: d", "--- a: b", "a.b-c: ", "x" * 70, "tab\tsep words", "\u2028line", "end\n\n", "中文 空格　全角"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(SAMPLES)), "i INT, t STRING")


def got(rows, column):
    return [r[0] for r in rows.select(column.alias("c"), "i").orderBy("i").collect()]


def test_strip_squeeze_words(rows):
    assert got(rows, X.strip(F.col("t"))) == [s.strip() for s in SAMPLES]
    assert got(rows, X.squeeze(F.col("t"))) == [" ".join(s.split()) for s in SAMPLES]
    assert got(rows, X.words(F.col("t"))) == [s.split() for s in SAMPLES]


def test_lines(rows):
    assert got(rows, X.split_lines(F.col("t"))) == [s.splitlines() for s in SAMPLES]
    assert got(rows, X.file_lines(F.col("t"))) == [len(re.findall(r"[^\n]*\n|[^\n]+\Z", s)) for s in SAMPLES]


def test_tokens_digest_ascii(rows):
    assert got(rows, X.token_estimate(F.col("t"))) == [max(1, len(s) // 4) for s in SAMPLES]
    assert got(rows, X.digest(F.col("t"))) == [hashlib.sha256(s.encode()).hexdigest() for s in SAMPLES]
    assert got(rows, X.is_ascii(F.col("t"))) == [s.isascii() for s in SAMPLES]


def table(spark, cases):
    return spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i INT, t STRING")


FILE_NAMES = [("a/b?c", "a_b_c"), ("x" * 64, "x" * 64), ("y" * 65, "y" * 55 + "_14d4a35a"), ("https://e.example/" + "z" * 80, "https___e_example_" + "z" * 37 + "_adbd2cfb"), ("", ""), ("é-_1", "_-_1")]
FENCES = [("```python\ncode\n```", "code"), ("```\n```", ""), ("a", "a"), ("", ""), ("  ```\nx\ny\n```  ", "x\ny"), ("x\n```", "x"), ("```js\nx", "x"), ("a\n```\nb", "a\n```\nb"), ("``` ", ""), ("```\n  x\n```\n", "x")]
CHUNK_NAMES = [("def f(x):\n  pass", "f"), ("(lambda)", "(lambda)"), ("class A", "class A"), ("static int add (int a)", "add"), ("x" * 70, "x" * 64), ("", ""), ("  f( \n", "f"), ("a b c(d)(e)", "c"), ("y" * 70 + "(z)", "y" * 70)]


def test_safe_filename(spark):
    assert got(table(spark, FILE_NAMES), X.safe_filename(F.col("t"))) == [w for _, w in FILE_NAMES]


def test_fences(spark):
    assert got(table(spark, FENCES), X.strip_fences(F.col("t"))) == [w for _, w in FENCES]


def test_chunk_names(spark):
    assert got(table(spark, CHUNK_NAMES), X.chunk_name(X.first_line(F.col("t")))) == [w for _, w in CHUNK_NAMES]


def test_yaml_key(rows):
    keys = dict(zip(SAMPLES, got(rows, X.yaml_key(F.col("t")))))
    assert keys["key: v"] == "key" and keys["a.b-c: "] == "a.b-c"
    assert all(keys[s] is None for s in ("  indented: v", "# c: d", "--- a: b", "", "class A"))


def test_duration_and_versions(spark):
    df = spark.createDataFrame([(0, 5, "tool-1.10.2"), (1, 123, "none"), (2, 3720, "v2.0"), (3, -1, "")], "i INT, s INT, n STRING")
    assert got(df, X.duration(F.col("s"))) == ["5s", "2m 03s", "1h 02m", "0s"]
    assert got(df, X.version_key(F.col("n"))) == [[1, 10, 2], [], [2, 0], []]


def test_decode(spark):
    df = spark.createDataFrame([(0, bytearray(b"ok\xffz"))], "i INT, b BINARY")
    assert got(df, X.decode_text(F.col("b"))) == ["ok\ufffdz"]
