"""Problem 3: cutting oversized texts into overlapping pieces at natural boundaries.

Content-defined chunking: a rolling hash over the text marks landmarks, and each landmark is moved
to the nearest natural boundary (the end of a block, else of a line) between the least and the
greatest size of a piece. Cuts depend on the text near them, so an edit alters the pieces next to it
and the cuts beyond it come back to where they were.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import table

WINDOW = 32  # characters that the rolling hash sees
LANDMARKS = 3  # landmarks to expect in the greatest size of a piece
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def landmarks(chars: np.ndarray, spacing: int) -> np.ndarray:
    """Ends of windows whose hash falls under one in ``spacing``; the same text gives the same hash anywhere."""
    n = len(chars)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n))])
        h = (total[WINDOW:] - total[:-WINDOW]) * _powers(_BASE_INV, n - WINDOW + 1)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return np.flatnonzero(h % np.uint64(max(1, spacing)) == 0) + WINDOW


def cuts(text: str, max_chars: int, overlap: int) -> list[tuple[int, int, str]]:
    """Pieces (start, end, boundary) of ``text`` in code points, in order.

    Each piece has at most ``max_chars`` characters and starts ``overlap`` before the end of the
    one before it (an overlap of max_chars or more counts as max_chars - 1). ``boundary`` is how the
    piece ends: 'block' (an empty line, or the next line isn't indented), 'line', 'forced' (inside a
    line: none ends where the piece could end) or 'end'.
    """
    n = len(text)
    max_chars = max(1, max_chars)
    overlap = min(max(0, overlap), max_chars - 1)
    if n <= max_chars:
        return [(0, n, "end")]
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    feeds = np.flatnonzero(chars == 10) + 1
    lines = feeds[feeds < n]
    after = chars[lines]
    before = chars[np.maximum(lines - 2, 0)]
    blocks = lines[((after != 32) & (after != 9)) | (before == 10)]
    marks = landmarks(chars, max(1, (max_chars - overlap) // LANDMARKS))
    least = min(max(overlap + 1, max_chars // 3), max_chars - overlap)
    pieces, start, done = [], 0, 0
    while n - start > max_chars:
        lo, hi = done + least, start + max_chars
        lo = min(lo, hi)
        a = int(marks.searchsorted(lo))
        goal = int(marks[a]) if a < len(marks) and marks[a] <= hi else hi
        cut, kind = 0, "forced"
        for ends, name in ((blocks, "block"), (lines, "line")):
            i, j = int(ends.searchsorted(lo)), int(ends.searchsorted(hi, "right"))
            if i < j:
                near = ends[i:j]
                cut, kind = int(near[np.abs(near - goal).argmin()]), name
                break
        else:
            i = int(lines.searchsorted(lo))
            if i and lines[i - 1] > done:  # a shorter piece rather than a cut line
                cut, kind = int(lines[i - 1]), "line"
            else:
                cut = goal
                if cut - 1 > done and chars[cut - 1] == 13 and chars[cut] == 10:
                    cut -= 1
        pieces.append((start, cut, kind))
        done, start = cut, max(0, cut - overlap)
    pieces.append((start, n, "end"))
    return pieces


def with_limits(items: DataFrame, limits: DataFrame, key: str = "language") -> DataFrame:
    """``items`` with ``max_chars`` and ``overlap_chars`` of its ``key``, compared as written.

    The row '*' of ``limits`` (a small fixed table, one row per value) holds for every other value
    and for null; without it, those rows get null limits and are never cut.
    """
    star = limits.where(F.col(key) == "*").first()
    own = limits.where(F.col(key) != "*").select(F.col(key).alias("_key"), F.col("max_chars").alias("_max"), F.col("overlap_chars").alias("_overlap"), F.lit(True).alias("_own"))
    joined = items.join(F.broadcast(own), F.col(key) == F.col("_key"), "left")
    pick = lambda c, d: F.when(F.col("_own"), F.col(c)).otherwise(F.lit(d).cast("int"))
    return joined.withColumn("max_chars", pick("_max", star and star["max_chars"])).withColumn("overlap_chars", pick("_overlap", star and star["overlap_chars"])).drop("_key", "_max", "_overlap", "_own")


def split_oversized(items: DataFrame, limits: DataFrame, id_col: str = "chunk_id", text_col: str = "code", key: str = "language", texts: bool = True) -> DataFrame:
    """Pieces of every text longer than its limit.

    Columns: ``id_col``, piece_no (from 0), start_char, end_char (code points; end exclusive),
    boundary (see :func:`cuts`), longest_line, cut_kind ('forced' if the text has a run of more than
    the limit without a line feed, else 'natural'), piece (null unless ``texts``). Null, empty and short texts and rows
    without a limit give no row; a repeated row gives its pieces again. No shuffle: texts within their
    limit never leave the scan.
    """
    few = items.select(F.col(id_col), F.col(text_col).alias("_text"), F.col(key).alias(key))
    long = with_limits(few, limits, key).where(F.char_length("_text") > F.col("max_chars")).select(id_col, "_text", "max_chars", F.coalesce("overlap_chars", F.lit(0)).alias("overlap_chars"))

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(8)]
            for rid, t, most, over in zip(*(batch.column(i).to_pylist() for i in range(4))):
                longest = max(map(len, t.split("\n")))
                for k, (a, b, kind) in enumerate(cuts(t, most, over)):
                    for column, v in zip(out, (rid, k, a, b, kind, longest, "forced" if longest > most else "natural", t[a:b] if texts else None)):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:4]), pa.array(out[4], pa.string()), pa.array(out[5], pa.int64()), *(pa.array(c, pa.string()) for c in out[6:])], names=[id_col, "piece_no", "start_char", "end_char", "boundary", "longest_line", "cut_kind", "piece"])

    kind = items.schema[id_col].dataType.simpleString()
    return long.mapInArrow(run, f"`{id_col}` {kind}, piece_no INT, start_char BIGINT, end_char BIGINT, boundary STRING, longest_line BIGINT, cut_kind STRING, piece STRING")


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(table(spark, sf_dir, "code_chunks_raw"), table(spark, sf_dir, "chunk_limits"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = split_oversized(table(spark, sf_dir, "code_chunks_raw"), table(spark, sf_dir, "chunk_limits"), texts=False)
    return pieces.where("piece_no = 0").select("chunk_id", "cut_kind")


P3_FOUND_SQL = """
WITH lim AS (
  SELECT c.chunk_id, c.code, coalesce(l.max_chars, s.max_chars) AS max_chars
  FROM code_chunks_raw c
  LEFT JOIN chunk_limits l ON l.language = c.language AND l.language <> '*'
  CROSS JOIN (SELECT max_chars FROM chunk_limits WHERE language = '*') s)
SELECT chunk_id,
       CASE WHEN list_max(list_transform(string_split(code, chr(10)), lambda x: length(x))) > max_chars THEN 'forced' ELSE 'natural' END AS cut_kind
FROM lim WHERE length(code) > max_chars
"""
