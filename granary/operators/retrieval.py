"""Retrieval over a corpus: token slices, BM25, cosine over vectors, sentence ranking, routing."""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions import text as X
from granary.session import materialize, shuffle_partitions

K1, B = 1.2, 0.75
QUERY_BLOCK, ROW_BLOCK = 128, 500  # queries and rows that meet in one cell of a search


def terms(c: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(X.text_or_empty(c)), "[^a-z0-9]+"), lambda t: t != "")


def token_slices(docs: DataFrame, id_col: str, text_col: str, size: int = 256) -> DataFrame:
    """Slices of ``size`` words: id, slice, text."""
    w = docs.select(id_col, X.words(X.text_or_empty(F.col(text_col))).alias("_w")).where(F.size("_w") > 0)
    at = w.select(id_col, "_w", F.explode(F.sequence(F.lit(0), F.floor((F.size("_w") - 1) / size).cast("int"))).alias("slice"))
    return at.select(id_col, "slice", F.array_join(F.slice("_w", F.col("slice") * size + 1, F.lit(size)), " ").alias("text"))


def bm25(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of each query (``query_id``, ``query``): query_id, id, score, rank.

    Any number of queries of any length, in blocks: each block meets each block of documents in one cell, where
    scores are a product of two matrices, and which keeps its best. Documents are read once, as counted terms;
    only those counts are written and met. Lengths and document counts cover all documents, a document that is a
    query itself included.
    """
    packs = _term_packs(docs.select(F.col(id_col).alias("id"), terms(F.col(text_col)).alias("t")), ROW_BLOCK, shuffle_partitions(docs.sparkSession))
    n, length = packs.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    df = packs.select(F.explode(F.arrays_zip("words", "df")).alias("w")).groupBy(F.col("w.words").alias("term")).agg(F.sum("w.df").alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = queries.select("query_id", F.explode(F.array_distinct(terms(F.col("query")))).alias("term")).join(df, "term").groupBy("query_id").agg(F.collect_list(F.struct("term", idf.alias("idf"))).alias("a"))
    q = _query_packs(asked.select("query_id", "a.term", "a.idf"), QUERY_BLOCK, _blocks(queries))
    mean = length / max(1, n)

    def cells(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                at = {c: batch.column(c)[r].values for c in batch.schema.names if c != "length"}
                number = lambda c: at[c].to_numpy(zero_copy_only=False)
                place = pc.fill_null(pc.index_in(at["words"], value_set=at["q_words"]), -1).to_numpy(zero_copy_only=False)
                shared = np.flatnonzero(place >= 0)  # words of these documents that these queries have
                if not len(shared):
                    continue
                column = np.full(len(place), -1)
                column[shared] = np.arange(len(shared))
                q_column = np.full(len(at["q_words"]), -1)
                q_column[place[shared]] = np.arange(len(shared))
                doc, word, tf = number("doc"), column[number("word")], number("tf")
                there = word >= 0
                doc, word, tf = doc[there], word[there], tf[there]
                d = np.zeros((len(at["ids"]), len(shared)))
                d[doc, word] = tf * (K1 + 1) / (tf + K1 * (1 - B + B * number("dl")[doc] / mean))
                query, q_word, weight = number("q_query"), q_column[number("q_word")], number("q_idf")
                there = q_word >= 0
                m = np.zeros((len(at["q_ids"]), len(shared)))
                m[query[there], q_word[there]] = weight[there]
                score = m @ d.T
                score[score <= 0] = -np.inf
                yield _best(at["q_ids"], at["ids"], score, k)

    return _ranked(_met(packs, q), cells, queries.schema["query_id"].dataType, docs.schema[id_col].dataType, k)


def _term_packs(docs: DataFrame, size: int, partitions: int) -> DataFrame:
    """Documents (id, t) in packs of up to ``size``, written once: ids, dl, and length, their sum; words, and df, in how
    many of the pack's documents each is; doc, word, tf: how often a document (its place) has a word (its place)."""

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                dl = pc.list_value_length(part.column(1)).to_numpy().astype(np.int64)
                coded = part.column(1).flatten().dictionary_encode()
                n = max(1, len(coded.dictionary))
                each, tf = np.unique(np.repeat(np.arange(len(dl)), dl) * n + coded.indices.to_numpy(), return_counts=True)
                word = each % n
                row = [part.column(0), pa.array(dl), coded.dictionary, *(pa.array(x.astype(np.int32)) for x in (np.bincount(word, minlength=len(coded.dictionary)), each // n, word, tf))]
                yield pa.RecordBatch.from_arrays([*map(_listed, row), pa.array([int(dl.sum())])], names=["ids", "dl", "words", "df", "doc", "word", "tf", "length"])

    ids = docs.schema["id"].dataType.simpleString()
    packed = docs.mapInArrow(pack, f"ids ARRAY<{ids}>, dl ARRAY<BIGINT>, words ARRAY<STRING>, df ARRAY<INT>, doc ARRAY<INT>, word ARRAY<INT>, tf ARRAY<INT>, length BIGINT")
    return materialize(packed.repartition(partitions), "terms")


def _query_packs(asked: DataFrame, size: int, partitions: int) -> DataFrame:
    """Queries (query_id, term, idf: arrays) in packs of up to ``size``, written once: ids, words; query, word, idf by place."""

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                coded = part.column(1).flatten().dictionary_encode()
                query = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column(1)).to_numpy()).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*map(_listed, (part.column(0), coded.dictionary, pa.array(query), coded.indices, part.column(2).flatten()))], names=["ids", "words", "query", "word", "idf"])

    ids = asked.schema["query_id"].dataType.simpleString()
    return materialize(asked.repartition(partitions).mapInArrow(pack, f"ids ARRAY<{ids}>, words ARRAY<STRING>, query ARRAY<INT>, word ARRAY<INT>, idf ARRAY<DOUBLE>"), "queries")


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def quantized(v: Column) -> Column:
    """8-bit whole numbers in proportion to the largest magnitude."""
    top = F.array_max(F.transform(v, F.abs))
    return F.transform(v, lambda x: F.round(x / F.nullif(top, F.lit(0.0)) * 127).cast("tinyint"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` vectors of highest cosine for each query vector: query_id, id, score, rank.

    Any number of ``queries`` (query_id, query), in blocks: each block meets each block of vectors in one cell,
    which keeps its best, so no task holds all queries or all vectors. A query doesn't find itself; vectors with
    nulls and those of length 0 have no cosine.
    """

    def cells(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                at = {c: batch.column(c)[r] for c in batch.schema.names}
                if at["dim"].as_py() != at["q_dim"].as_py():
                    continue
                ids, q_ids, dim = at["ids"].values, at["q_ids"].values, at["dim"].as_py()
                v, q = (np.frombuffer(at[c].as_py()).reshape(-1, dim) for c in ("v", "q_v"))
                score = q @ v.T / (np.sqrt((v * v).sum(1))[None, :] * np.sqrt((q * q).sum(1))[:, None])
                score[q_ids.to_numpy(zero_copy_only=False)[:, None] == ids.to_numpy(zero_copy_only=False)[None, :]] = -np.inf
                yield _best(q_ids, ids, score, k)

    v = _vector_packs(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), ROW_BLOCK, shuffle_partitions(vectors.sparkSession), "vectors")
    q = _vector_packs(queries.select(F.col("query_id").alias("id"), F.col("query").alias("v")), QUERY_BLOCK, _blocks(queries), "queries")
    return _ranked(_met(v, q), cells, queries.schema["query_id"].dataType, vectors.schema[id_col].dataType, k)


def _blocks(queries: DataFrame) -> int:
    return max(1, -(-queries.count() // QUERY_BLOCK))


def _met(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Each pack of rows beside each pack of queries (its columns named q_...)."""
    return rows.crossJoin(queries.select([F.col(c).alias(f"q_{c}") for c in queries.columns]).hint("shuffle_replicate_nl"))


def _vector_packs(vectors: DataFrame, size: int, partitions: int, label: str) -> DataFrame:
    """Vectors (id, v) in packs of up to ``size`` of one dimension, written once: ids, dim, v (doubles)."""
    usable = vectors.select("id", F.col("v").cast("array<double>").alias("v")).where("size(v) > 0 AND NOT exists(v, x -> x IS NULL) AND exists(v, x -> x <> 0)")

    def pack(batches):
        for batch in batches:
            dims = pc.list_value_length(batch.column(1)).to_numpy()
            for dim in np.unique(dims):
                one = batch.filter(pa.array(dims == dim))
                for at in range(0, one.num_rows, size):
                    part = one.slice(at, size)
                    yield pa.RecordBatch.from_arrays([_listed(part.column(0)), pa.array([int(dim)], pa.int32()), pa.array([part.column(1).flatten().to_numpy().tobytes()], pa.binary())], names=["ids", "dim", "v"])

    ids = vectors.schema["id"].dataType.simpleString()
    return materialize(usable.repartition(partitions).mapInArrow(pack, f"ids ARRAY<{ids}>, dim INT, v BINARY"), label)


def _listed(values: pa.Array) -> pa.Array:
    """One row that holds ``values`` as a list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _best(q_ids: pa.Array, ids: pa.Array, score: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` best of each query (a row of ``score``), by rounded score, of equal ones by id; -inf is no hit."""
    score = np.round(score, 6)
    least = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(score), -np.inf)
    q, v = np.nonzero((score >= least[:, None]) & np.isfinite(score))
    order = np.lexsort((ids.to_numpy(zero_copy_only=False)[v], -score[q, v], q))
    q, v = q[order], v[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    q, v = q[keep], v[keep]
    return pa.RecordBatch.from_arrays([q_ids.take(pa.array(q)), ids.take(pa.array(v)), pa.array(score[q, v])], names=["query_id", "id", "score"])


def _ranked(met: DataFrame, cells, query_type, id_type, k: int) -> DataFrame:
    found = met.mapInArrow(cells, f"query_id {query_type.simpleString()}, id {id_type.simpleString()}, score DOUBLE")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def sentences(c: Column) -> Column:
    """Sentences of a text: ended by . ! or ? before white space, or by line feeds; blank ones are left out."""
    parts = F.split(F.regexp_replace(X.text_or_empty(c), r"([.!?])[ \t\n\r\f\x0B]+", "$1\n"), r"\n+")
    return F.filter(parts, lambda s: X.strip(s) != "")


BROADCAST_TERMS, BROADCAST_BYTES = 500_000, 16 << 20  # different terms, and their characters, whose counts every worker may hold
TERM_PARTS = 32


def top_sentences(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ``k`` sentences of highest mean tf-idf: id, place (from 0), sentence, score.

    Terms are counted once over all documents. If the counts are few enough (by number and size) every worker gets them, and
    documents are scored where they lie, without a shuffle. Else counts meet the terms of documents in salted
    parts, so that a term that all documents have is no hot key, and come back to their document. Null and empty
    texts give no row; ids must be unique.
    """
    n = docs.count()
    rows = docs.select(F.col(id_col).alias("id"), sentences(F.col(text_col)).alias("s")).where(F.size("s") > 0)
    rows = rows.withColumn("t", F.transform("s", terms))
    terms_of = rows.select("id", F.explode(F.array_distinct(F.flatten("t"))).alias("term"))
    df = materialize(terms_of.groupBy("term").agg(F.count("*").alias("df")), "df")
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("b")).first()
    known = {}
    if size["n"] <= BROADCAST_TERMS and size["b"] <= BROADCAST_BYTES:
        got = df.toArrow()
        known = dict(zip(got.column("term").to_pylist(), got.column("df").to_pylist()))
        rows = rows.select("id", "s", "t", F.lit(None).cast("array<string>").alias("terms"), F.lit(None).cast("array<bigint>").alias("df"))
    else:
        spread = df.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(TERM_PARTS - 1))))
        met = terms_of.withColumn("p", F.pmod(F.xxhash64("id"), F.lit(TERM_PARTS)).cast("int")).join(spread, ["term", "p"])
        mine = met.groupBy("id").agg(F.collect_list(F.struct("term", "df")).alias("m")).select("id", "m.term", "m.df")
        rows = rows.join(mine, "id").select("id", "s", "t", F.col("term").alias("terms"), "df")
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        everywhere = shared.value
        for batch in batches:
            ids, places, said, scores = [], [], [], []
            for i, s, t, mine, df_ in zip(*(batch.column(c).to_pylist() for c in range(5))):
                counts = everywhere if mine is None else dict(zip(mine, df_))
                tf = Counter(x for words in t for x in words)
                weight = {x: c * math.log(1 + n / counts[x]) for x, c in tf.items()}
                found = [(-round(sum(weight[x] for x in words) / len(words), 6), place) for place, words in enumerate(t) if words]
                for score, place in heapq.nsmallest(k, found):
                    ids.append(i)
                    places.append(place)
                    said.append(s[place])
                    scores.append(-score)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(places, pa.int32()), pa.array(said, pa.string()), pa.array(scores, pa.float64())], names=["id", "place", "sentence", "score"])

    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, place INT, sentence STRING, score DOUBLE")


def route(queries: DataFrame, cache: DataFrame, sparse: DataFrame, dense: DataFrame, confident: float) -> DataFrame:
    """Where each query's answer comes from: the cache, else a confident sparse hit, else a dense one, else 'online'."""
    j = queries.join(cache.select("query_id", F.col("answer").alias("_c")), "query_id", "left").join(sparse.select("query_id", F.col("answer").alias("_s"), F.col("score").alias("_p")), "query_id", "left").join(dense.select("query_id", F.col("answer").alias("_d")), "query_id", "left")
    sure = F.coalesce(F.col("_p") >= confident, F.lit(False))
    way = F.when(F.col("_c").isNotNull(), "cache").when(sure, "sparse").when(F.col("_d").isNotNull(), "dense").otherwise("online")
    return j.select("query_id", way.alias("way"), F.when(way == "cache", F.col("_c")).when(way == "sparse", F.col("_s")).when(way == "dense", F.col("_d")).alias("answer"))


def brief(evidence: DataFrame, most: int = 5) -> DataFrame:
    """Evidence (query_id, source, sentence, score) as one text a query: its best ``most`` sentences with sources, and their mean score."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "source", "sentence")
    top = evidence.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most)
    line = F.format_string("[%d] %s (%s)", F.col("_k"), F.col("sentence"), F.col("source"))
    return top.groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", line.alias("l")))), lambda x: x["l"]), "\n").alias("brief"), F.round(F.avg("score"), 6).alias("confidence"))


def grounded(claims: DataFrame, evidence: DataFrame, least: float = 0.5) -> DataFrame:
    """Each claim with its best support: the largest share of its terms that one sentence has, and whether that is enough."""
    c = claims.select("claim_id", "query_id", F.array_distinct(terms(F.col("claim"))).alias("_t"))
    e = evidence.select("query_id", terms(F.col("sentence")).alias("_e"))
    share = F.size(F.array_intersect("_t", "_e")) / F.greatest(F.size("_t"), F.lit(1))
    best = c.join(e, "query_id").groupBy("claim_id").agg(F.round(F.max(share), 6).alias("support"))
    return claims.select("claim_id").join(best, "claim_id", "left").select("claim_id", F.coalesce("support", F.lit(0.0)).alias("support"), (F.coalesce("support", F.lit(0.0)) >= least).alias("grounded"))


def answer_document(query_id: Column, answer: Column, sources: Column, confidence: Column) -> Column:
    """An answer with its sources and confidence as JSON."""
    return F.to_json(F.struct(query_id.alias("query_id"), answer.alias("answer"), sources.alias("sources"), confidence.alias("confidence")))
