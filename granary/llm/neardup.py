"""Problem 4: near-duplicate texts by Golay-code fuzzy hashing.

A text's distinct shingles give a vector; random projections of it make a fingerprint of
``BANDS`` bands of 24-bit segments. Each segment is decoded to several nearby Golay codewords. If
the errors between two fingerprints are few, by the pigeonhole principle some band has few
in each of its segments, and there the two texts share a codeword in each. Texts that do are
compared by a 128-bit sketch of further projections, then verified on their whole shingle sets.

Texts of equal token sequence are one class from the start: only its representative is
fingerprinted into buckets, so a group of copies of any size weighs as one text.

Keys have two segments (24 bits) whatever the number n of texts (:func:`same_keys`), so whether a pair is found depends
on its two texts alone. A text travels BANDS * FIRST_KEYS = 28 times, in records of 44 bytes, so 1.2 kB a
text, until buckets are split; comparisons are 2.1e-4 n^2. Three segments (36 bits, records of 56 bytes, 3.3e-6 n^2)
find fewer pairs and are taken only where the caller asks for them (:func:`layout_for`).
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import golay
from granary.llm.shingles import portions, shingle
from granary.session import discard, materialize, table

SIMILARITY, WIDTH, LEAST_TOKENS = 0.7, 5, 60  # as TESTDATA.md states them
BANDS, FIRST_KEYS, MORE_KEYS = 7, 4, 8
FEATURES, SKETCH_BITS = 4096, 128
#: Sketch bits in which texts at SIMILARITY may differ: of 128, 24.7 on average, standard deviation 4.5.
SKETCH_ERRORS = 45
LONG_KEYS = 1 << 23  # texts from which layout_for() gives keys of three segments
BUCKET_ROWS = 1_000_000  # mean rows of a bucket beyond which buckets are split by their texts' second keys
SHARD_BYTES = 6 << 20
HOT_BUCKET = 40_000  # rows of a bucket that are cut into blocks, if they are also HOT_TIMES the mean
HOT_TIMES = 4
ENTRIES = 1 << 22  # (key, row) entries that a task sorts at once
BROADCAST_IDS = 500_000  # candidates' ids are broadcast up to here (8 bytes each), else shuffled
CELL_PAIRS = 2_000  # candidate pairs that one group of the verification holds, about
CLASS_ROWS = 2_000  # members of a class that meet in one task when all pairs are written
SEED = 20240229


@dataclass(frozen=True)
class Layout:
    """``probes``: segments of a key besides the first. ``split``: leading bits of the second key that part a bucket."""

    probes: int
    split: int = 0

    @property
    def print_type(self) -> np.dtype:
        return np.dtype([("s0", "<u8"), ("s1", "<u8"), ("n", "<u4"), ("first", "u1", (BANDS, FIRST_KEYS // 2 * 3)), ("more", "u1", (BANDS, self.probes * MORE_KEYS // 2 * 3))])

    @property
    def record_type(self) -> np.dtype:
        """What travels: keys have 12 bits, two of them share three bytes."""
        return np.dtype([("place", "<u4"), ("id", "<i8"), ("s0", "<u8"), ("s1", "<u8"), ("n", "<u4"), ("more", "u1", (self.probes * MORE_KEYS // 2 * 3,))])

    @property
    def places(self) -> int:
        return BANDS * 4096 << self.split


def layout_for(texts: int) -> Layout:
    """Cheap keys for so many texts: they cost less beyond ``LONG_KEYS``, and lose some of the pairs that :func:`same_keys` finds. The mean bucket has 4 n / 4,096 rows; beyond ``BUCKET_ROWS`` it is split, and a text goes to at most ``MORE_KEYS`` parts of it."""
    rows = texts * FIRST_KEYS / 4096
    return Layout(1 if texts < LONG_KEYS else 2, min(12, max(0, math.ceil(math.log2(rows / BUCKET_ROWS)))) if rows > 0 else 0)


def same_keys(texts: int) -> Layout:
    """Keys that find the same pairs however many texts there are: only the split, which parts work and not pairs, follows from their number."""
    return Layout(1, layout_for(texts).split)


def pack(keys: np.ndarray) -> np.ndarray:
    """Numbers below 4,096 in the last axis (even length), two in three bytes."""
    both = keys[..., 0::2].astype("<u4") | keys[..., 1::2].astype("<u4") << np.uint32(12)
    return np.ascontiguousarray(both[..., None]).view(np.uint8)[..., :3].reshape(*keys.shape[:-1], -1)


def unpack(packed: np.ndarray) -> np.ndarray:
    b = packed.reshape(*packed.shape[:-1], -1, 3).astype(np.uint16)
    low = b[..., 0] | (b[..., 1] & 15) << 8
    high = b[..., 1] >> 4 | b[..., 2] << 4
    return np.stack([low, high], axis=-1).reshape(*packed.shape[:-1], -1)


@functools.lru_cache(maxsize=4)
def hadamard(rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64 x 64 Hadamard matrix and ``rows`` of its rows, chosen at random."""
    h = np.ones((1, 1), np.float32)
    while len(h) < 64:
        h = np.block([[h, h], [h, -h]])
    return h, h[np.random.default_rng(SEED).permutation(64)[:rows]]


def project(vectors: np.ndarray, outputs: int) -> np.ndarray:
    """``outputs`` projections of each vector (n, 4096) on +-1 vectors: rows of a Hadamard matrix, in two small products."""
    h, some = hadamard(-(-outputs // 64))
    half = (vectors.reshape(-1, 64) @ h).reshape(len(vectors), 64, 64)
    return np.matmul(some, half).reshape(len(vectors), -1)[:, :outputs]


def fingerprints(first: np.ndarray, shingles: np.ndarray, layout: Layout) -> np.ndarray:
    """Fingerprints of texts given as runs of distinct shingles; a shingle has a random place and sign in its text's vector."""
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    feature = (shingles & np.uint64(FEATURES - 1)).astype(np.int64)
    sign = ((shingles >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
    vectors = np.bincount(text * FEATURES + feature, sign, n * FEATURES).astype(np.float32).reshape(n, FEATURES)
    width = BANDS * 24 * (1 + layout.probes)
    y = project(vectors, SKETCH_BITS + width)
    out = np.zeros(n, layout.print_type)
    out["n"] = np.diff(first)
    sketch = np.packbits(y[:, :SKETCH_BITS] > 0, axis=1).view("<u8")
    out["s0"], out["s1"] = sketch[:, 0], sketch[:, 1]
    segments = y[:, SKETCH_BITS:].reshape(n, BANDS, 1 + layout.probes, 24)

    def keys(part: np.ndarray, count: int) -> np.ndarray:
        k = golay.nearby(np.ascontiguousarray(part).reshape(-1, 24), count)
        k.sort(axis=1)
        return np.where(k == golay.NONE, k[:, :1], k)  # where fewer were found, one again

    out["first"] = pack(keys(segments[:, :, 0], FIRST_KEYS).reshape(n, BANDS, FIRST_KEYS))
    out["more"] = pack(keys(segments[:, :, 1:], MORE_KEYS).reshape(n, BANDS, layout.probes * MORE_KEYS))
    return out


def signatures(items: DataFrame, id_col: str, text_col: str, width: int = WIDTH, least_tokens: int = LEAST_TOKENS, layout: Layout = Layout(1)) -> DataFrame:
    """``id``, ``h1``, ``h2`` (the token sequence) and ``print`` of each text of at least ``least_tokens`` tokens."""

    def run(batches):
        size = layout.print_type.itemsize
        for batch in batches:
            all_ids, all_texts = batch.column(0), batch.column(1).to_pylist()
            for part in portions(all_texts):
                s = shingle(all_texts[part], width, least_tokens)
                keep = np.flatnonzero((s.n_tokens >= least_tokens) & (np.diff(s.first) > 0))
                if not len(keep):
                    continue
                sizes = np.diff(s.first)
                edges = np.concatenate([[0], np.cumsum(sizes[keep])])
                prints = fingerprints(edges, s.shingles, layout)  # texts without shingles hold no place in the flat array
                data = pa.py_buffer(prints.tobytes())
                at = pa.py_buffer((np.arange(len(keep) + 1) * size).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [all_ids.slice(part.start, part.stop - part.start).take(pa.array(keep)), pa.array(s.sequence[keep, 0].view(np.int64)), pa.array(s.sequence[keep, 1].view(np.int64)), pa.Array.from_buffers(pa.binary(), len(keep), [None, at, data])],
                    names=["id", "h1", "h2", "print"],
                )

    return _live(items, id_col, text_col, least_tokens).mapInArrow(run, "id BIGINT, h1 BIGINT, h2 BIGINT, print BINARY")


def _live(items: DataFrame, id_col: str, text_col: str, least_tokens: int) -> DataFrame:
    texts = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    return texts.where(F.col("id").isNotNull() & (F.char_length("_text") >= least_tokens))


def _places(prints: np.ndarray, layout: Layout) -> np.ndarray:
    """Bucket of each text, band and first key (n, BANDS, FIRST_KEYS), ``places`` where the key came before."""
    first = unpack(prints["first"])
    at = first.astype(np.int64) + (np.arange(BANDS) * 4096)[None, :, None]
    again = np.zeros(first.shape, bool)
    again[..., 1:] = first[..., 1:] == first[..., :-1]
    at[again] = -1
    return at


def _records(prints: np.ndarray, ids: np.ndarray, layout: Layout) -> np.ndarray:
    """One record a text and place; in parted buckets one for each part that a second key of the text falls into."""
    at = _places(prints, layout)
    text, band, key = np.nonzero(at >= 0)
    place = at[text, band, key]
    if layout.split:
        part = unpack(prints["more"])[..., :MORE_KEYS] >> (12 - layout.split)
        part.sort(axis=-1)
        new = np.ones(part.shape, bool)
        new[..., 1:] = part[..., 1:] != part[..., :-1]
        row, which = np.nonzero(new[text, band])
        place = (place[row] << layout.split) | part[text[row], band[row], which]
        text, band = text[row], band[row]
    out = np.zeros(len(text), layout.record_type)
    out["place"], out["id"] = place, ids[text]
    for c in ("s0", "s1", "n"):
        out[c] = prints[c][text]
    out["more"] = prints["more"][text, band]
    return out


def compare(records: np.ndarray, layout: Layout, errors: int, similarity: float, blocks: np.ndarray | None = None) -> np.ndarray:
    """Pairs (k, 2) of ids that share the codewords of all segments of a band and are close by size and sketch.

    ``blocks``: where given, only pairs of different blocks are compared (rows of one block are compared elsewhere).
    Keys with their rows are sorted as single numbers, at most about ``ENTRIES`` at once. Rows are taken by size, so a row
    is done with a key at the first text that is too long for it.
    """
    n = len(records)
    order = np.argsort(records["n"], kind="stable")
    records, blocks = records[order], None if blocks is None else blocks[order]
    _, bucket = np.unique(records["place"], return_inverse=True)
    keys = unpack(records["more"])
    second = keys[:, :MORE_KEYS]
    mine = np.ones(second.shape, bool) if not layout.split else second >> (12 - layout.split) == (records["place"] & ((1 << layout.split) - 1))[:, None]
    ids, s0, s1 = records["id"], records["s0"], records["s1"]
    size = records["n"].astype(np.float64)
    shift = np.uint64(max(1, int(n).bit_length()))
    found = [np.zeros((0, 2), np.int64)]
    passes = max(1, -(-n * MORE_KEYS**layout.probes // ENTRIES))
    for turn in range(passes):
        row, which = np.nonzero(mine & (second % passes == turn) if passes > 1 else mine)
        key = bucket[row].astype(np.uint64) << np.uint64(12) | second[row, which]
        if layout.probes == 2:
            key = (key[:, None] << np.uint64(12) | keys[row, MORE_KEYS:]).reshape(-1)
            row = np.repeat(row, MORE_KEYS)
        entry = key << shift | row.astype(np.uint64)
        entry.sort()
        entry = entry[np.concatenate([[True], entry[1:] != entry[:-1]])] if len(entry) else entry
        key, row = entry >> shift, (entry & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
        left, step = np.arange(len(key)), 0
        while len(left):
            step += 1
            left = left[left + step < len(key)]
            left = left[key[left] == key[left + step]]
            a, b = row[left], row[left + step]
            near = size[a] >= similarity * size[b]
            left, a, b = left[near], a[near], b[near]
            if blocks is not None:
                apart = blocks[a] != blocks[b]
                a, b = a[apart], b[apart]
            close = np.bitwise_count(s0[a] ^ s0[b]) + np.bitwise_count(s1[a] ^ s1[b]) <= errors
            if close.any():
                a, b = ids[a[close]], ids[b[close]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
                if sum(map(len, found)) > 2_000_000:
                    found = [np.unique(np.concatenate(found), axis=0)]
    pairs = np.unique(np.concatenate(found), axis=0)
    return pairs[pairs[:, 0] != pairs[:, 1]]


def shards_of(rows: np.ndarray, record_bytes: int, hot: dict[int, int]) -> tuple[np.ndarray, int]:
    """Shard of each place (those of ``hot`` aside) and their number: neighbouring places of about ``SHARD_BYTES`` together."""
    rows = rows.copy()
    rows[list(hot)] = 0
    target = max(1.0, min(rows.sum() / 8, SHARD_BYTES / record_bytes))
    middle = np.cumsum(rows) - rows / 2
    shard = np.minimum(middle // target, max(0, math.ceil(rows.sum() / target) - 1)).astype(np.int64)
    return shard, int(shard[-1]) + 1


def candidates(reps: DataFrame, layout: Layout, similarity: float = SIMILARITY, errors: int = SKETCH_ERRORS) -> DataFrame:
    """Pairs (``a`` < ``b``) of ``reps`` (id, print) that share a key, close by sketch; a pair may come several times.

    Rows of all places are counted first (a fixed number of places for a layout). Shards of even size are laid
    out from the counts; rows travel as packed records, one binary per shard and batch, and each shard is one
    partition. A place of more than ``HOT_BUCKET`` rows that is ``HOT_TIMES`` the mean is cut into
    blocks, and each pair of blocks is a shard of its own, so no task gets more than two blocks of it.
    """

    def count(batches):
        total = np.zeros(layout.places, np.int64)
        for batch in batches:
            p = np.frombuffer(b"".join(batch.column(0).to_pylist()), layout.print_type)
            if layout.split:
                total += np.bincount(_records(p, np.zeros(len(p), np.int64), layout)["place"], minlength=len(total))
            else:
                b = _places(p, layout)
                total += np.bincount(b[b >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["place", "n"])

    counted = reps.select("print").mapInArrow(count, "place INT, n BIGINT").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    rows = np.zeros(layout.places, np.int64)
    rows[counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    bound = max(HOT_BUCKET, int(HOT_TIMES * rows.sum() / layout.places))
    hot = {int(p): -(-int(rows[p]) // bound) for p in np.flatnonzero(rows > bound)}
    shard_of, shards = shards_of(rows, layout.record_type.itemsize, hot)
    begin, total = {}, shards
    for p, g in hot.items():
        begin[p] = total
        total += g * (g + 1) // 2

    def cell(i, j, g):
        """Number of the pair of blocks i <= j among all of g blocks."""
        return i * g - i * (i - 1) // 2 + j - i

    def scatter(batches):
        hot_places = np.array(sorted(hot), np.int64)
        first = np.array([begin[p] for p in sorted(hot)], np.int64)
        blocks = np.array([hot[p] for p in sorted(hot)], np.int64)
        for batch in batches:
            rec = _records(np.frombuffer(b"".join(batch.column(1).to_pylist()), layout.print_type), batch.column(0).to_numpy(), layout)
            place = rec["place"].astype(np.int64)
            shard, block = shard_of[place], np.zeros(len(rec), np.int16)
            if len(hot_places):
                k = np.minimum(np.searchsorted(hot_places, place), len(hot_places) - 1)
                is_hot = hot_places[k] == place
                h, k = np.flatnonzero(is_hot), k[is_hot]
                g = blocks[k]
                mine = (rec["id"][h].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % g
                again = np.repeat(np.arange(len(h)), g)  # a row meets each block of its place once
                other = np.arange(len(again)) - np.repeat(np.cumsum(g) - g, g)
                cells = first[k[again]] + cell(np.minimum(mine[again], other), np.maximum(mine[again], other), g[again])
                cold = np.flatnonzero(~is_hot)
                rec = rec[np.concatenate([cold, h[again]])]
                shard = np.concatenate([shard[cold], cells])
                block = np.concatenate([block[cold], mine[again].astype(np.int16)])
            order = np.argsort(shard, kind="stable")
            shard, rec, block = shard[order], rec[order], block[order]
            edge = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, np.int64)
            stop = np.append(edge[1:], len(shard))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[edge].astype(np.int32)), pa.array([rec[i:j].tobytes() for i, j in zip(edge, stop)], pa.binary()), pa.array([block[i:j].tobytes() if shard[i] >= shards else b"" for i, j in zip(edge, stop)], pa.binary())],
                names=["shard", "records", "blocks"],
            )

    def join(batches):
        rec, blocks = [], []
        for batch in batches:
            rec += batch.column("records").to_pylist()
            blocks += batch.column("blocks").to_pylist()
        rec, blocks = np.frombuffer(b"".join(rec), layout.record_type), np.frombuffer(b"".join(blocks), np.int16)
        mixed = len(blocks) and blocks.min() != blocks.max()
        pairs = compare(rec, layout, errors, similarity, blocks if mixed else None) if len(rec) else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    packed = reps.select("id", "print").mapInArrow(scatter, "shard INT, records BINARY, blocks BINARY")
    return packed.repartitionById(total, F.col("shard")).mapInArrow(join, "a BIGINT, b BIGINT").distinct()


def verify(pairs: DataFrame, items: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """``a``, ``b``, ``similarity`` of the pairs whose whole shingle sets are at least so similar.

    ``pairs`` must be materialised: they are counted, and only texts they name leave the scan. Pairs are
    laid out in a grid of cells by hashes of both ids; a cell gets each text it needs once, so a large
    family of texts alike costs texts in proportion to its rows times the side of the grid, not to its pairs.
    """
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    named = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
    side = max(5, math.isqrt(pairs.count() // CELL_PAIRS) + 1)
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(side))
    placed = pairs.select("a", "b", (part("a") * side + part("b")).alias("cell"))
    needed = placed.select("cell", F.col("a").alias("id")).union(placed.select("cell", F.col("b").alias("id"))).distinct().join(named, "id").select((F.col("cell") + 0).alias("place"), "id", "_text")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids_, all_texts = right.column("id").to_pylist(), right.column("_text").to_pylist()
        sets = {}
        for p in portions(all_texts):
            s = shingle(all_texts[p], width)
            for k, i in enumerate(ids_[p]):
                sets[i] = s.shingles[s.first[k] : s.first[k + 1]]
        none = np.zeros(0, np.uint64)
        score = np.zeros(len(left))
        for k, (i, j) in enumerate(zip(left.column("a").to_pylist(), left.column("b").to_pylist())):
            p, q = sets.get(i, none), sets.get(j, none)
            if len(p) and len(q):
                both = np.concatenate([p, q])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                score[k] = common / (len(p) + len(q) - common)
        keep = pa.array(np.flatnonzero(score >= similarity))
        return pa.table({"a": left.column("a").take(keep), "b": left.column("b").take(keep), "similarity": pa.array(score).take(keep)})

    return placed.groupBy("cell").cogroup(needed.groupBy("place")).applyInArrow(run, "a BIGINT, b BIGINT, similarity DOUBLE")


def near_duplicates(items: DataFrame, id_col: str = "chunk_id", text_col: str = "code", similarity: float = SIMILARITY, width: int = WIDTH, least_tokens: int = LEAST_TOKENS, layout: Layout | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, links): the classes of equal token sequence, and the similar pairs of their representatives.

    members: ``id``, ``rep`` (the least id of its class) and ``n`` (rows of the class), one row per text of at least
    ``least_tokens`` tokens. links: ``a`` < ``b`` (representatives) and ``similarity``. Null, empty and short
    texts and null ids take no part. Ids must be unique; extra columns play no role. An empty table
    gives two empty results. ``layout``: :func:`same_keys` of the number of texts unless it is given. Both results are
    written tables; what led to them is removed.
    """
    layout = layout or same_keys(_live(items, id_col, text_col, least_tokens).count())
    rows = materialize(signatures(items, id_col, text_col, width, least_tokens, layout), "signatures")
    reps = materialize(rows.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("print").alias("print")), "classes")
    shared = reps.where("n > 1").select("h1", "h2", "rep", "n")
    members = materialize(rows.select("id", "h1", "h2").join(shared, ["h1", "h2"], "left").select("id", F.coalesce("rep", "id").alias("rep"), F.coalesce("n", F.lit(1)).cast("bigint").alias("n")), "members")
    discard(rows)
    near = materialize(candidates(reps.select(F.col("rep").alias("id"), "print"), layout, similarity), "candidates")
    discard(reps)
    links = materialize(verify(near, items, id_col, text_col, similarity, width), "links")
    discard(near)
    return members, links


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """Every similar pair (``a`` < ``b``) of texts: within each class, and across linked classes.

    A class meets itself in as many tasks as it has ``CLASS_ROWS`` rows: one side is parted by a hash, the other is there in
    each part. Across classes each link is parted likewise by the rows of both.
    """
    parts = lambda n: F.ceil(n / CLASS_ROWS).cast("int")
    part = lambda i, n: F.pmod(F.xxhash64(i), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    whole = members.where("n > 1").withColumn("k", parts(F.col("n")))
    x = whole.select(F.col("id").alias("x"), F.col("rep").alias("a"), each(F.col("k")).alias("part"))
    y = whole.select(F.col("id").alias("y"), F.col("rep").alias("a"), part(F.col("id"), F.col("k")).alias("part"))
    inside = x.join(y, ["a", "part"]).where("x < y").select("x", "y")
    mine = members.withColumn("part", part(F.col("id"), parts(F.col("n"))))
    kinds = members.where(F.col("id") == F.col("rep")).select("rep", parts(F.col("n")).alias("k"))
    sized = links.select("a", "b").join(kinds.select(F.col("rep").alias("a"), F.col("k").alias("ka")), "a").join(kinds.select(F.col("rep").alias("b"), F.col("k").alias("kb")), "b")
    spread = sized.select("a", "b", "kb", each(F.col("ka")).alias("pa")).select("a", "b", "pa", each(F.col("kb")).alias("pb"))
    left = spread.join(mine.select(F.col("id").alias("x"), F.col("rep").alias("a"), F.col("part").alias("pa")), ["a", "pa"])
    across = left.join(mine.select(F.col("id").alias("y"), F.col("rep").alias("b"), F.col("part").alias("pb")), ["b", "pb"]).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return inside.union(across).select(F.col("x").alias("a"), F.col("y").alias("b"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``id`` and ``root`` (the least id reachable) of every id named by ``links`` (a, b).

    Each round every vertex takes the least root among its neighbours and then the root of that
    root, which halves long chains; rounds end when nothing changes. State is written to the shared
    folder each round, so the lineage stays short.
    """
    edges = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    state = materialize(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).select(F.col("a").alias("id"), "root"), "roots")
    for _ in range(rounds):
        offered = edges.join(state.select(F.col("id").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("id")).agg(F.min("r").alias("r"))
        lower = state.select("id", "root").join(offered, "id").select("id", F.least("root", "r").alias("root"), F.col("root").alias("before"))
        jump = lower.select(F.col("id").alias("root"), F.col("root").alias("up"))
        after = materialize(lower.join(jump, "root", "left").select("id", F.least("root", F.coalesce("up", "root")).alias("root"), "before"), "roots")
        discard(state)
        state = after
        if not after.where("root < before").limit(1).count():
            discard(edges)
            return state.select("id", "root")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


#: Brute force over all pairs that share a sequence, for the small tables of the comparison.
P4_FOUND_SQL = r"""WITH t AS (SELECT chunk_id, regexp_extract_all(code, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s\x0b\x1c-\x1f\x{85}\p{Z}]') AS w FROM code_chunks_raw WHERE code IS NOT NULL),
x AS (SELECT chunk_id, unnest(range(len(w))) AS i, unnest(w) AS k FROM t WHERE len(w) >= 60),
s AS (SELECT DISTINCT chunk_id, hash(k, lead(k, 1) OVER o, lead(k, 2) OVER o, lead(k, 3) OVER o, lead(k, 4) OVER o) AS h FROM x WINDOW o AS (PARTITION BY chunk_id ORDER BY i) QUALIFY lead(k, 4) OVER o IS NOT NULL),
n AS (SELECT chunk_id, count(*) AS n FROM s GROUP BY 1), g AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1), r AS (SELECT s.*, n FROM s JOIN g USING (h) JOIN n USING (chunk_id)),
c AS (SELECT a.chunk_id AS a, b.chunk_id AS b, any_value(a.n + b.n) AS n, count(*) AS c FROM r a JOIN r b ON a.h = b.h AND a.chunk_id < b.chunk_id AND 10 * least(a.n, b.n) >= 7 * greatest(a.n, b.n) GROUP BY ALL)
SELECT a AS chunk_id_a, b AS chunk_id_b FROM c WHERE 10 * c >= 7 * (n - c)"""


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = all_pairs(*near_duplicates(table(spark, sf_dir, "code_chunks_raw")))
    return pairs.select(F.col("a").alias("chunk_id_a"), F.col("b").alias("chunk_id_b"))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per chunk of at least 60 tokens: its class, its group, and the links of its class."""
    members, links = near_duplicates(table(spark, sf_dir, "code_chunks_raw"))
    degree = links.select(F.col("a").alias("rep")).union(links.select("b")).groupBy("rep").agg(F.count("*").alias("n_links"))
    roots = components(links).select(F.col("id").alias("rep"), "root")
    return members.select("id", "rep").join(degree, "rep", "left").join(roots, "rep", "left").select(F.col("id").alias("chunk_id"), F.col("rep").alias("class_id"), F.coalesce("root", "rep").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
