"""Problem 5: how many tokens each document has, estimated, and the sums by source, language and domain.

For each language a regression from counts (bytes, words, digits, punctuation, scripts) to
tokens is fitted on tokenized samples and corrected on held-out ones; it is applied to every row, so
the corpus itself is never tokenized.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import bpe
from granary.llm.handwritten import repo_name
from granary.llm.sampling import hash_sample
from granary.llm.shingles import portions
from granary.session import materialize, table

SAMPLE_ROWS = 1200  # tokenized rows per language, chosen by a hash of the id; every third one only measures the error
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1)  # how strongly a language is held to the regression of all; what predicts best is taken
LEAST_ROWS = 40  # a language with fewer rows to fit on has no regression of its own
SHARED = "(all)"  # name of the regression that other languages share
BROADCAST_SLICES = 200_000  # slices (repo, language) that are broadcast to their chunks, about 100 bytes each
FEATURES = ("bytes", "words", "word_chars", "long_words", "digits", "number_runs", "punctuation", "spaces", "space_runs", "line_feeds", "capitals", "underscores", "latin", "cyrillic_greek", "cjk", "other_scripts", "texts")
#: Other names of languages, lower case.
ALIASES = {"py": "python", "python3": "python", "py3": "python", "js": "javascript", "jsx": "javascript", "mjs": "javascript", "node": "javascript", "ecmascript": "javascript", "c99": "c", "c11": "c", "ansi c": "c", "h": "c", "htm": "html", "html5": "html", "xhtml": "html", "css3": "css", "scss": "css"}

_CLASS = np.full(0x3001 + 1, 9, np.uint8)
_CLASS[range(128)] = 5  # punctuation
_CLASS[[*range(97, 123)]] = 1
_CLASS[[*range(65, 91)]] = 2
_CLASS[[*range(48, 58)]] = 3
_CLASS[[9, 11, 12, 13, 32]] = 4
_CLASS[10] = 6
_CLASS[95] = 10
_CLASS[0x80:0x250] = 7
_CLASS[0x370:0x530] = 8
_CLASS[0x2E80:] = 11


def measure(texts: list[str]) -> np.ndarray:
    """``FEATURES`` of each text (n, 17) over all its characters; an empty text has zeros."""
    n = len(texts)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, n)
    edges = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    chars = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _CLASS[np.minimum(chars, 0x3001)]
    kind[chars > 0x3FFFF] = 9
    kind[(chars >= 0xD7A4) & (chars <= 0x1FFFF)] = 9
    text = np.repeat(np.arange(n), lengths)
    per_kind = np.bincount(text * 12 + kind, minlength=12 * n).reshape(n, 12).astype(np.float64)
    letter = (kind == 1) | (kind == 2) | (kind == 7) | (kind == 8) | (kind == 9)
    per_text = lambda mask: np.add.reduceat(mask, edges, dtype=np.int64).astype(np.float64)
    opens = lambda mask: mask & ~np.concatenate([[False], mask[:-1]])
    word_start = np.flatnonzero(opens(letter))
    word_end = np.flatnonzero(letter & ~np.concatenate([letter[1:], [False]]))
    long_words = np.bincount(text[word_start], np.maximum(word_end - word_start + 1 - 6, 0), n)
    encoded = per_text(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)) - 1
    out = np.stack(
        [encoded, per_text(opens(letter)), per_text(letter), long_words, per_kind[:, 3], per_text(opens(kind == 3)), per_kind[:, 5], per_kind[:, 4], per_text(opens(kind == 4)), per_kind[:, 6] - 1, per_kind[:, 2], per_kind[:, 10], per_kind[:, 7], per_kind[:, 8], per_kind[:, 11], per_kind[:, 9], lengths > 1],
        axis=1,
    )
    return out


def language_name(language: Column) -> Column:
    """A language however it is spelled: lower case, aliases resolved; '' and null give 'unknown'."""
    low = F.lower(F.trim(language))
    table_ = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.when(low.isNull() | (low == ""), "unknown").otherwise(F.coalesce(F.try_element_at(table_, low), low))


def ridge(x: np.ndarray, y: np.ndarray, strength: float, towards: np.ndarray | None = None) -> np.ndarray:
    """Weights of least squares, errors of long texts counting less than in proportion, held near ``towards`` (or 0)."""
    weight = 1 / np.sqrt(np.maximum(y, 16))
    scale = np.maximum(x.max(axis=0, initial=0), 1)
    a = x / scale * weight[:, None]
    start = np.zeros(x.shape[1]) if towards is None else towards
    return start + np.linalg.solve(a.T @ a + strength * np.eye(a.shape[1]), a.T @ ((y - x @ start) * weight)) / scale


class TokenModel:
    """Ridge regressions by language, ``SHARED`` for all others, each with the correction of its bias.

    ``sample``: (language, rank in its language from 1, tokens, features). Two thirds of a language's rows are two halves:
    each is predicted by a regression on the other, which tells how strongly to hold the language to the shared
    regression, and the bias to correct; the final one is fitted on both. The last third only measures: ``errors``
    has, by language, its rows, their tokens, the estimate, and the sum of the rows' absolute errors.
    """

    def __init__(self, sample: list[tuple[str, int, int, list[float]]]) -> None:
        self.weights: dict[str, np.ndarray] = {}
        self.errors: dict[str, tuple[int, int, int, int]] = {}
        rank = np.array([r[1] for r in sample], int) % 3
        y = np.array([r[2] for r in sample], float)
        x = np.array([r[3] for r in sample], float).reshape(-1, len(FEATURES))
        language = np.array([r[0] for r in sample], object)
        halves = rank != 0
        self._fit(SHARED, x[halves], y[halves], rank[halves], None, RIDGES[:1])
        start = self.weights[SHARED]
        for name in sorted(set(language)):
            mine = halves & (language == name)
            if mine.sum() >= LEAST_ROWS:
                self._fit(name, x[mine], y[mine], rank[mine], start, RIDGES)
            tested = (language == name) & ~halves
            if tested.any():
                guess = self.estimate([name] * int(tested.sum()), x[tested])
                self.errors[name] = (int(tested.sum()), int(y[tested].sum()), int(guess.sum()), int(np.abs(guess - y[tested]).sum()))

    def _fit(self, name: str, x: np.ndarray, y: np.ndarray, rank: np.ndarray, towards: np.ndarray | None, strengths: tuple[float, ...]) -> None:
        best = None
        for strength in strengths:
            held = np.zeros(len(y))
            for half in (1, 2):
                held[rank == half] = np.maximum(x[rank == half] @ ridge(x[rank != half], y[rank != half], strength, towards), 0)
            error = np.abs(held - y).sum()
            if best is None or error < best[0]:
                best = error, strength, y.sum() / held.sum() if held.sum() > 0 and y.sum() > 0 else 1.0
        self.weights[name] = ridge(x, y, best[1], towards) * best[2]

    def name(self, language: str) -> str:
        return language if language in self.weights else SHARED

    def estimate(self, languages: list[str], features: np.ndarray) -> np.ndarray:
        beta = np.stack([self.weights[self.name(x)] for x in languages]) if languages else np.zeros((0, len(FEATURES)))
        guess = np.maximum(np.einsum("nk,nk->n", features, beta), features[:, 0] > 0)
        return np.where(features[:, 0] > 0, np.maximum(np.rint(guess), 1), 0).astype(np.int64)


def fit(items: DataFrame, id_col: str, text_col: str, tokenizer: str | None = None) -> TokenModel:
    """Fit on at most ``SAMPLE_ROWS`` rows a language of ``items`` (with column ``_language``).

    Two reads: one counts the languages, the other passes on the sample, whole texts with it.
    """
    path = tokenizer or bpe.ranks_path()
    light = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), "_language", F.col(text_col).alias("_text"))
    chosen = hash_sample(light, "_id", SAMPLE_ROWS, "_language").select("_language", "_k", "_text")

    def tokenize(batches):
        coder = bpe.Encoder(bpe.load_ranks(path))
        for batch in batches:
            texts = batch.column(2).to_pylist()
            x = np.concatenate([measure(texts[p]) for p in portions(texts)]) if texts else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([coder.count(t) for t in texts], pa.int64()), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["language", "k", "n", "x"])

    rows = chosen.mapInArrow(tokenize, "language STRING, k INT, n BIGINT, x ARRAY<DOUBLE>").collect()
    return TokenModel(sorted((r["language"], r["k"], r["n"], list(r["x"])) for r in rows))


def token_estimates(items: DataFrame, id_col: str = "chunk_id", text_col: str = "code", language_col: str = "language", keep: dict[str, Column] | None = None, tokenizer: str | None = None, model: TokenModel | None = None) -> DataFrame:
    """Every row's ``id_col``, ``language`` (unified), columns ``keep``, n_bytes, est_tokens and the ``model`` (language) used.

    Null and empty texts have 0 tokens, any other text at least 1. Rows without a language count under
    'unknown'; languages with too few rows to fit on share the regression ``SHARED``. Repeated rows stay
    repeated. No shuffle but the choice of the bounded sample.
    """
    rows = items.withColumn("_language", language_name(F.col(language_col)))
    model = model or fit(rows, id_col, text_col, tokenizer)
    extra = list((keep or {}).items())
    names = [k for k, _ in extra]

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            x = np.concatenate([measure(texts[p]) for p in portions(texts)]) if texts else np.zeros((0, len(FEATURES)))
            languages = batch.column(1).to_pylist()
            n = model.estimate(languages, x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(batch.column(3 + k) for k in range(len(names))), pa.array(x[:, 0].astype(np.int64)), pa.array(n), pa.array([model.name(v) for v in languages], pa.string())], names=[id_col, "language", *names, "n_bytes", "est_tokens", "model"])

    few = rows.select(id_col, "_language", text_col, *(c.alias(k) for k, c in extra))
    kinds = {f.name: f.dataType.simpleString() for f in few.schema}
    return few.mapInArrow(run, f"`{id_col}` {kinds[id_col]}, language STRING, " + "".join(f"`{k}` {kinds[k]}, " for k, _ in extra) + "n_bytes BIGINT, est_tokens BIGINT, model STRING")


def token_budget(chunks: DataFrame, repos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, sums): each chunk's estimate with the totals of its slice, and n_chunks, n_bytes, est_tokens by slice.

    A slice is a repo, language and domain (spellings unified, 'unknown' where null or not listed). Estimates are
    written once; sums are combined before their shuffle, so a repo of any size weighs as one row a task.
    """
    estimates = materialize(token_estimates(chunks, keep={"repo": F.coalesce(repo_name(F.col("repo")), F.lit("unknown"))}), "estimates")
    sums = estimates.groupBy("repo", "language").agg(F.count("*").alias("n_chunks"), F.sum("n_bytes").alias("n_bytes"), F.sum("est_tokens").alias("est_tokens"))
    domains = repos.select(repo_name(F.col("repo")).alias("repo"), F.col("domain")).where("repo IS NOT NULL").groupBy("repo").agg(F.min("domain").alias("domain"))
    sums = materialize(sums.join(domains, "repo", "left").select("repo", "language", F.coalesce("domain", F.lit("unknown")).alias("domain"), "n_chunks", "n_bytes", "est_tokens"), "slices")
    slices = sums.select("repo", "language", "domain", F.col("n_chunks").alias("slice_chunks"), F.col("n_bytes").alias("slice_bytes"), F.col("est_tokens").alias("slice_tokens"))
    rows = estimates.join(F.broadcast(slices) if sums.count() <= BROADCAST_SLICES else slices, ["repo", "language"])
    return rows.select("chunk_id", "repo", "language", "domain", "n_bytes", "est_tokens", "model", "slice_chunks", "slice_bytes", "slice_tokens"), sums


def _budget(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return token_budget(table(spark, sf_dir, "code_chunks_raw"), table(spark, sf_dir, "repos"))


def p5_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The budget: each chunk's estimate beside the sums of its repo, language and domain."""
    return _budget(spark, sf_dir)[0]


def p5_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums alone: n_chunks, n_bytes and est_tokens by repo, language and domain."""
    return _budget(spark, sf_dir)[1]


_SPELT = ", ".join(f"('{a}', '{b}')" for a, b in ALIASES.items())
P5_COUNTS_SQL = rf"""WITH a(alias, name) AS (VALUES {_SPELT}),
c AS (SELECT coalesce(nullif(regexp_extract(lower(trim(repo)), '([^/]+?)(?:\.git)?/*$', 1), ''), 'unknown') AS repo, coalesce(a.name, nullif(lower(trim(language)), ''), 'unknown') AS language, strlen(coalesce(code, '')) AS n FROM code_chunks_raw LEFT JOIN a ON a.alias = lower(trim(language))),
r AS (SELECT nullif(regexp_extract(lower(trim(repo)), '([^/]+?)(?:\.git)?/*$', 1), '') AS repo, min(domain) AS domain FROM repos GROUP BY 1)
SELECT repo, language, coalesce(r.domain, 'unknown') AS domain, count(*) AS n_chunks, sum(n)::BIGINT AS n_bytes FROM c LEFT JOIN r USING (repo) GROUP BY ALL"""


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the sums SQL can say: chunks and bytes of each slice."""
    return p5_budget(spark, sf_dir).drop("est_tokens")


def p5_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By language, on tokenized rows that neither fitted nor corrected: rows, tokens, estimate, its error as a share, and the rows' mean error."""
    rows = table(spark, sf_dir, "code_chunks_raw").withColumn("_language", language_name(F.col("language")))
    errors = fit(rows, "chunk_id", "code").errors
    out = [(k, n, t, g, abs(g - t) / max(1, t), e / max(1, t)) for k, (n, t, g, e) in sorted(errors.items())]
    return spark.createDataFrame(out, "language STRING, n_rows BIGINT, tokens BIGINT, est_tokens BIGINT, error DOUBLE, row_error DOUBLE")


def p5_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sums rolled up: by domain and language, by domain, and in total (null where summed over)."""
    return p5_budget(spark, sf_dir).rollup("domain", "language").agg(*(F.sum(c).alias(c) for c in ("n_chunks", "n_bytes", "est_tokens")))
