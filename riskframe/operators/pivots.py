"""Largest cosine similarity of every row to a reference set.

An exact search by a pivot index: seeded reference vectors are the centres,
every reference vector belongs to its nearest centre, and the vectors of a
centre are cut into blocks by their distance to it.  For a query at distance
``q`` of a centre, no vector of a block with distances ``lo..hi`` is nearer
than ``max(q - hi, lo - q, 0)`` (triangle inequality).

The search is best-first in three rounds (the nearest block, the next few, the
rest); the best similarity found so far bounds the next round, which looks
only at blocks that can still hold a nearer vector.  Queries that meet the
same block travel as one matrix and are compared by a matrix product, so the
join has a row per (batch of queries, block), never one per pair.

Vectors are compared as units: ``|a - b|^2 = 2 - 2 cos``.  Copies are one
vector.  How much is pruned depends on the geometry; ``compared`` tells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.hashing import uniform
from riskframe.operators.neighbors import distinct_vectors, unit, vector_dim
from riskframe.session import materialise

MAX_CENTRES = 1024
MAX_BLOCKS = 50_000     # the blocks' bounds are broadcast: 24 bytes each
BLOCK_ROWS = 2048       # at least; more where the table would need too many blocks
MAX_TASKS, SALTS = 2000, 4   # a bucket is met in so many tasks
NEXT = 8                # blocks of the second round
BUCKET_VALUES = 1 << 20 # numbers in the blocks of a bucket, about
_QUERIES = 512          # queries whose bounds are computed together
_TRAVEL = 2048          # queries that travel together, at least
_SLACK = 1e-6           # rounding of distances near zero


@dataclass
class PivotIndex:
    """``buckets`` holds ``(bucket, blocks)``, the blocks with the ids, counts
    and vectors of theirs in order; centre, distance range and bucket of each
    block, the centres, and the number of distinct vectors."""
    buckets: DataFrame
    centre: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    bucket: np.ndarray
    centres: np.ndarray
    rows: int


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2.0 * (x @ centres.T)
    return np.sqrt(np.maximum(square, 0.0))


def unit_vectors(df: DataFrame, key: str, vec: str, name: str) -> tuple[DataFrame, DataFrame]:
    """``(points, vectors)``: rows with the key of their vector, and distinct
    unit vectors ``(vid, u, cnt, i)`` with a number, both written."""
    points, vecs = distinct_vectors(df, key, vec)
    vecs = vecs.select("vid", unit(F.col("vec")).alias("u"), "cnt", F.monotonically_increasing_id().alias("i"))
    return materialise(points, f"{name}-points"), materialise(vecs, f"{name}-vectors")


def build_index(vectors: DataFrame, dim: int, seed: int = 42, centres: int | None = None, block_rows: int = BLOCK_ROWS) -> PivotIndex:
    """Index unit vectors ``(vid, u, cnt, i)``.  The number of centres grows with the
    square root of the rows up to ``MAX_CENTRES``, the block size with the rows
    beyond ``MAX_BLOCKS`` blocks."""
    n = vectors.count()
    wanted = centres or min(MAX_CENTRES, max(1, round(n ** 0.5)))
    first = vectors.orderBy(uniform("vid", seed=f"pivot{seed}"), "vid").limit(wanted).select("u").collect()
    centre_rows = np.array([r.u for r in first], np.float64).reshape(len(first), dim)
    size = max(block_rows, -(-2 * n // MAX_BLOCKS))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_matrix(batch.column("u"), dim), centre_rows)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_pydict({"centre": near.astype(np.int32), "d": d[np.arange(len(d)), near], "u": batch.column("u"), "i": batch.column("i"), "cnt": batch.column("cnt")})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of a sorted partition: a new one for each centre, and when full."""
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            d, u, i, cnt = (np.concatenate([h[c] for h in held]) for c in range(1, 5))
            return pa.RecordBatch.from_pydict({"centre": pa.array([held[0][0]], pa.int32()), "lo": [float(d.min())], "hi": [float(d.max())], "n": pa.array([len(d)], pa.int32()), "ids": [i.astype("<i8").tobytes()], "counts": [cnt.astype("<i8").tobytes()], "vectors": [u.tobytes()]})
        for batch in batches:
            centre, d, i, cnt = (batch.column(c).to_numpy() for c in ("centre", "d", "i", "cnt"))
            u = _matrix(batch.column("u"), dim)
            at = 0
            while at < len(centre):
                have = sum(len(h[1]) for h in held)
                if held and (held[0][0] != centre[at] or have >= size):
                    yield block()
                    held, have = [], 0
                end = min(int(np.searchsorted(centre, centre[at], "right")), at + size - have)
                held.append((int(centre[at]), d[at:end], u[at:end], i[at:end], cnt[at:end]))
                at = end
        if held:
            yield block()

    if not n:
        empty = vectors.sparkSession.createDataFrame([], "bucket long, blocks array<struct<no:long,ids:binary,counts:binary,vectors:binary>>")
        return PivotIndex(empty, np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, np.int64), centre_rows, 0)
    assigned = vectors.select("u", "i", "cnt").mapInArrow(assign, "centre int, d double, u array<double>, i long, cnt long")
    # by range of (centre, distance): a crowded centre is spread over many tasks
    ordered = assigned.repartitionByRange(max(1, -(-n // (8 * size))), "centre", "d").sortWithinPartitions("centre", "d")
    blocks = materialise(ordered.mapInArrow(cut, "centre int, lo double, hi double, n int, ids binary, counts binary, vectors binary")
                         .withColumn("block", F.monotonically_increasing_id()), "pivot-blocks")
    bounds = blocks.select("block", "centre", "lo", "hi", "n").orderBy("block").collect()  # MAX_BLOCKS rows and one a centre, about
    before = np.cumsum([0] + [r.n for r in bounds[:-1]])
    bucket = before // max(1, BUCKET_VALUES // max(1, dim))
    dense = blocks.sparkSession.createDataFrame([(r.block, i, int(bucket[i])) for i, r in enumerate(bounds)], "block long, no long, bucket long")
    together = (blocks.join(F.broadcast(dense), "block").groupBy("bucket")       # some MB a bucket
                .agg(F.sort_array(F.collect_list(F.struct("no", "ids", "counts", "vectors"))).alias("blocks")))
    return PivotIndex(materialise(together, "pivot-buckets"), np.array([r.centre for r in bounds]), np.array([r.lo for r in bounds]),
                      np.array([r.hi for r in bounds]), bucket, centre_rows, n)


def _meet(index: PivotIndex, queries: DataFrame, dim: int, open_blocks: Callable, compare: Callable, schema: str) -> DataFrame:
    """Queries ``(q, u, best)`` travel to the buckets of the blocks that
    ``open_blocks(distance to each block's centre, bound, best)`` marks;
    ``compare(q, x, met, blocks)`` gives arrays by ``schema``, where column
    ``j`` of ``met`` tells which queries meet block ``j``."""
    first = np.searchsorted(index.bucket, np.unique(index.bucket))
    shared = queries.sparkSession.sparkContext.broadcast((index.centre, index.lo, index.hi, index.centres, index.bucket))
    n_blocks, names = len(index.centre), [c.split()[0] for c in schema.split(", ")]

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, lo, hi, centres, bucket = shared.value
        step = max(16, min(_QUERIES, 8_000_000 // n_blocks))
        held: dict[int, list[tuple]] = {}
        waiting = 0

        def rows() -> pa.RecordBatch:
            parts = [[np.concatenate([h[c] for h in held[b]]).tobytes() for b in held] for c in range(3)]
            return pa.RecordBatch.from_arrays([pa.array([int(bucket[b]) for b in held], pa.int64()), *(pa.array(p, pa.binary()) for p in parts)], ["bucket", "q", "x", "met"])
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                u, q, best = _matrix(part.column("u"), dim), part.column("q").to_numpy(), part.column("best").to_numpy()
                d = _distances(u, centres)[:, centre]
                mine = open_blocks(d, np.maximum(np.maximum(d - hi, lo - d), 0.0), best)
                for b, end in zip(first, [*first[1:], n_blocks]):
                    own = mine[:, b:end]
                    who = np.flatnonzero(own.any(axis=1))
                    if len(who):
                        held.setdefault(int(b), []).append((q[who].astype("<i8"), u[who], np.packbits(own[who], axis=1)))
                waiting += len(q)
                if waiting >= _TRAVEL and held:
                    yield rows()
                    held, waiting = {}, 0
        if held:
            yield rows()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                q = np.frombuffer(batch.column("q")[r].as_py(), "<i8")
                x = np.frombuffer(batch.column("x")[r].as_py()).reshape(-1, dim)
                blocks = batch.column("blocks")[r].as_py()
                met = np.unpackbits(np.frombuffer(batch.column("met")[r].as_py(), np.uint8).reshape(len(q), -1), axis=1, count=len(blocks)).astype(bool)
                for found in compare(q, x, met, blocks):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names)

    # a row per (some queries, bucket): the number of tasks follows the comparisons, not the bytes
    travel = queries.select("q", "u", "best").mapInArrow(probes, "bucket long, q binary, x binary, met binary")
    tasks = min(MAX_TASKS, 2 * len(first) + int(index.rows) // 100_000)
    salted = travel.withColumn("_s", F.pmod(F.hash("q"), F.lit(SALTS)))
    both = (salted.repartition(tasks, "bucket", "_s")
            .join(index.buckets.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).repartition(tasks, "bucket", "_s"), ["bucket", "_s"]))
    return both.select("q", "x", "met", "blocks").mapInArrow(run, schema)


def search_index(index: PivotIndex, queries: DataFrame, dim: int) -> DataFrame:
    """``(vid, similarity, compared)`` for every query ``(vid, u)``: the largest
    cosine to an indexed vector (null if there is none) and how many vectors
    it was compared with."""
    if not index.rows:
        return queries.select("vid", F.lit(None).cast("double").alias("similarity"), F.lit(0).cast("long").alias("compared"))
    # queries travel under a number, so keys may be of any type
    state = materialise(queries.select("vid", "u", F.monotonically_increasing_id().alias("q"), F.lit(-2.0).alias("best"), F.lit(0).cast("long").alias("compared")), "pivot-queries")
    n_blocks, ahead = len(index.centre), min(NEXT + 1, len(index.centre))

    def round_(number: int) -> Callable:
        def open_blocks(d: np.ndarray, bound: np.ndarray, best: np.ndarray) -> np.ndarray:
            order = bound + 1e-3 * d  # of equal bounds, the nearer centre
            # the blocks of the first two rounds, in order
            first = np.argpartition(order, ahead - 1, axis=1)[:, :ahead]
            first = np.take_along_axis(first, np.lexsort((first, np.take_along_axis(order, first, 1))), 1)
            mine = np.zeros(bound.shape, bool)
            if number < 2:
                np.put_along_axis(mine, first[:, :1] if number == 0 else first[:, 1:], True, 1)
            else:
                mine[:] = True
                np.put_along_axis(mine, first, False, 1)
            return mine & (bound <= np.sqrt(np.maximum(2.0 - 2.0 * best, 0.0))[:, None] + _SLACK)
        return open_blocks

    def compare(q: np.ndarray, x: np.ndarray, met: np.ndarray, blocks: list[dict]) -> Iterator[tuple]:
        most, n = np.full(len(q), -2.0), np.zeros(len(q), np.int64)
        for j, block in enumerate(blocks):
            who = np.flatnonzero(met[:, j])
            vectors = np.frombuffer(block["vectors"]).reshape(-1, dim)
            for at in range(0, len(who), _QUERIES):
                some = who[at:at + _QUERIES]
                most[some] = np.maximum(most[some], (x[some] @ vectors.T).max(axis=1))
                n[some] += len(vectors)
        yield q, most, n

    for number in range(3 if n_blocks > ahead else 2 if n_blocks > 1 else 1):
        found = _meet(index, state, dim, round_(number), compare, "q long, s double, n long").groupBy("q").agg(F.max("s").alias("s"), F.sum("n").alias("n"))
        state = materialise(state.join(found, "q", "left").select("vid", "u", "q", F.greatest("best", F.coalesce("s", F.lit(-2.0))).alias("best"),
                                                                  (F.col("compared") + F.coalesce("n", F.lit(0))).alias("compared")), f"pivot-round-{number}")
    return state.select("vid", F.col("best").alias("similarity"), "compared")


def links_above(index: PivotIndex, queries: DataFrame, dim: int, threshold: float, count: bool = False) -> DataFrame:
    """``(q, i, similarity)`` of all pairs of a query ``(q, u)`` and an indexed
    vector with a cosine above ``threshold``; with ``count`` only ``(q, n)``,
    the rows that those vectors stand for, for queries that have any."""
    reach = max(0.0, 2.0 - 2.0 * threshold) ** 0.5 + _SLACK

    def compare(q: np.ndarray, x: np.ndarray, met: np.ndarray, blocks: list[dict]) -> Iterator[tuple]:
        n = np.zeros(len(q), np.int64)
        for j, block in enumerate(blocks):
            who = np.flatnonzero(met[:, j])
            vectors, counts = np.frombuffer(block["vectors"]).reshape(-1, dim), np.frombuffer(block["counts"], "<i8")
            for at in range(0, len(who), _QUERIES):
                some = who[at:at + _QUERIES]
                product = x[some] @ vectors.T
                sure = product > threshold + 1e-9
                # summed in order near the threshold, so that it decides as the plain sum does
                a, b = np.nonzero(~sure & (product > threshold - 1e-9) if count else product > threshold - 1e-9)
                s = np.zeros(len(a))
                for c in range(dim):
                    s = s + x[some[a], c] * vectors[b, c]
                keep = s > threshold
                if count:
                    n[some] += sure @ counts
                    np.add.at(n, some[a[keep]], counts[b[keep]])
                elif keep.any():
                    yield q[some[a[keep]]], np.frombuffer(block["ids"], "<i8")[b[keep]], s[keep]
        if count:
            yield q[n > 0], n[n > 0]
    schema = "q long, n long" if count else "q long, i long, similarity double"
    if not index.rows:
        return queries.sparkSession.createDataFrame([], schema)
    found = _meet(index, queries.withColumn("best", F.lit(0.0)), dim, lambda d, bound, best: bound <= reach, compare, schema)
    return found.groupBy("q").agg(F.sum("n").alias("n")) if count else found


def max_similarity(left: DataFrame, right: DataFrame, key: str, vec: str, digits: int = 6, seed: int = 42, block_rows: int = BLOCK_ROWS,
                   centres: int | None = None) -> DataFrame:
    """``(key, max_similarity, compared)`` for **every** row of ``left``:
    the largest cosine similarity to a row of ``right`` (zero vectors have
    similarity 0 to everything; null where ``right`` is empty).  Vectors are
    neither null nor of different lengths."""
    dim = vector_dim(left.select(vec).unionByName(right.select(vec)), vec)
    points, queries = unit_vectors(left, key, vec, "left")
    _, vectors = unit_vectors(right, key, vec, "right")
    found = search_index(build_index(vectors, dim, seed, centres, block_rows), queries, dim)
    return points.join(found, "vid").select(key, F.round("similarity", digits).alias("max_similarity"), "compared")


def similarity_summary(left: DataFrame, right: DataFrame, key: str, vec: str, threshold: float = 0.95) -> DataFrame:
    """Rows, rows above ``threshold`` (strictly), least, mean and largest of
    the rows' maxima, and the pairs of distinct vectors compared for them."""
    return summary_of(materialise(max_similarity(left, right, key, vec, digits=12), "max-similarity"), threshold)


def summary_of(found: DataFrame, threshold: float = 0.95) -> DataFrame:
    """The summary of the rows that :func:`max_similarity` found."""
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("max_similarity") > threshold).alias("n_flagged"),
                     F.round(F.min("max_similarity"), 6).alias("least"), F.round(F.avg("max_similarity"), 6).alias("mean"),
                     F.round(F.max("max_similarity"), 6).alias("largest"), F.sum("compared").alias("n_compared"))
