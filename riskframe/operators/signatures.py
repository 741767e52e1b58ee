"""Nearest neighbours of chosen rows by multi-probe signature lists.

Every distinct vector is listed under the sides of ``bits`` seeded random
hyperplanes (relative to the mean vector).  The number of bits grows with the
logarithm of the rows per list wanted, so lists stay of one size as a table
grows; a list that is larger anyway is kept in blocks.  A query looks into its
own list and into those whose signatures differ where the query lies close to
the planes: masks over the bits in order of the margin, cheapest first.

How many masks are looked into is fitted: exact neighbours of a bounded sample
of queries are found by a scan, and the first number of masks that holds the
wanted share of them is taken.  Every row is indexed, and the candidates'
distances are computed exactly.  With no bits there is one list per group and
the search is exact: the chosen queries against all rows, in blocks.

Queries that look into one list travel as a matrix; a task returns the nearest
few of a (queries, block) pair, never a row per pair.  A task holds looks and
distances in pieces of a fixed size, whatever the number of masks or queries.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.hashing import uniform
from riskframe.operators.neighbors import distinct_vectors, expand_neighbours, sq_dist, vector_dim
from riskframe.session import materialise

LIST_ROWS = 256         # wanted rows of a list
BLOCK_ROWS = 4096       # rows of a block of a longer list
MAX_BITS = 24
SAMPLE = 200            # queries that the number of masks is fitted on
MAX_MASKS = 1 << 14
TASK_PAIRS, MAX_TASKS = 20_000_000, 20_000
HELD_PAIRS = 1 << 20    # looks, or distances, that a task holds at a time
HELD_BYTES = 8 << 20    # of the matrices that it hands on at a time
_SLACK = 1e-9           # relative rounding of squared distances


@dataclass
class Probing:
    """Signature bits, and the masks to look into (positions of the bits in
    order of the query's margin), cheapest first."""
    bits: int
    masks: np.ndarray
    sample_recall: float


def cheapest_masks(costs: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` subsets of ``costs`` (ascending) with the least sums, as a
    0/1 matrix, from the empty set on."""
    bits = len(costs)
    out = [np.zeros(bits, np.int8)]
    heap = [(float(costs[0]), (0,))] if bits else []
    while heap and len(out) < count:
        cost, chosen = heapq.heappop(heap)
        mask = np.zeros(bits, np.int8)
        mask[list(chosen)] = 1
        out.append(mask)
        last = chosen[-1]
        if last + 1 < bits:  # each subset is reached once: move the last bit on, or add the next
            heapq.heappush(heap, (cost - float(costs[last]) + float(costs[last + 1]), (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + float(costs[last + 1]), (*chosen, last + 1)))
    return np.array(out).reshape(len(out), bits)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


def _sides(x: np.ndarray, planes: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and margins of vectors."""
    margin = (x - mean) @ planes
    return (margin >= 0) @ (1 << np.arange(planes.shape[1], dtype=np.int64)), margin


def group_numbers(batch: pa.RecordBatch, groups: Sequence[str]) -> np.ndarray:
    """A number per row that tells the rows' groups apart."""
    out = np.zeros(batch.num_rows, np.int64)
    for c in groups:
        codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()
        out = np.unique(out * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1].astype(np.int64)
    return out


def looks(x: np.ndarray, group: np.ndarray, planes: np.ndarray, mean: np.ndarray, masks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """``(a row of the group, list, rows that look into it)`` of every list that
    the rows look into, as columns for at most about ``HELD_BYTES`` of vectors."""
    sig, margin = _sides(x, planes, mean)
    order = np.argsort(np.abs(margin), axis=1)
    flips = (masks.astype(np.int64) @ (np.int64(1) << order).T) if masks.shape[1] else np.zeros((1, len(x)), np.int64)
    looked = (sig ^ flips).ravel()      # masks x queries
    row = np.tile(np.arange(len(x)), len(flips))
    by = np.lexsort((row, looked, group[row]))
    looked, row = looked[by], row[by]
    starts = np.flatnonzero(np.r_[len(row) > 0, (np.diff(looked) != 0) | (np.diff(group[row]) != 0)])
    lists_at_once = np.flatnonzero(np.diff(starts // max(1, HELD_BYTES // (8 * x.shape[1] + 8)))) + 1
    ends = np.r_[starts[1:], len(row)]
    for a, b in zip(np.r_[0, lists_at_once].tolist(), np.r_[lists_at_once, len(starts)].tolist()):
        if b > a:
            yield row[starts[a:b]], looked[starts[a:b]], [row[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]


def build_lists(vectors: DataFrame, groups: Sequence[str], dim: int, planes: np.ndarray, mean: np.ndarray, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks ``(group.., sig, n, ids, x)`` of the vectors ``(group.., i, vec)``."""
    g = list(groups)
    keys = [*g, "sig"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, _ = _sides(_matrix(batch.column("vec"), dim), planes, mean)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in [*g, "i", "vec"]), pa.array(sig.astype(np.int64))], [*g, "i", "vec", "sig"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def block() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            x = np.concatenate([_matrix(b.column("vec"), dim) for b in held])
            return pa.RecordBatch.from_arrays([*(whole.column(c).combine_chunks().slice(0, 1) for c in keys), pa.array([len(x)], pa.int32()),
                                               pa.array([whole.column("i").to_numpy().astype("<i8").tobytes()]), pa.array([x.tobytes()])], [*keys, "n", "ids", "x"])
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in keys)))
            at = 0
            while at < len(rows):
                have = sum(len(b) for b in held)
                if held and (rows[at] != key or have >= block_rows):
                    yield block()
                    held, have = [], 0
                key, end = rows[at], at + 1
                while end < len(rows) and rows[end] == key and have + end - at < block_rows:
                    end += 1
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield block()

    signed = vectors.select(*g, "i", "vec").mapInArrow(sign, vectors.select(*g, "i", "vec").schema.add("sig", "long"))
    # by range, with the row's number as the last key: a crowded list is spread over tasks
    parts = max(1, vectors.count() // (2 * block_rows) + 1)
    ordered = signed.repartitionByRange(parts, *keys, "i").sortWithinPartitions(*keys, "i")
    blocks = materialise(ordered.mapInArrow(cut, vectors.select(*g).schema.add("sig", "long").add("n", "integer").add("ids", "binary").add("x", "binary"))
                         .withColumn("_b", F.monotonically_increasing_id()), "signature-blocks")
    # number the blocks of each list: a few bytes a block
    names = blocks.select("_b", (F.row_number().over(Window.partitionBy(*keys).orderBy("_b")) - 1).alias("no"))
    return materialise(blocks.join(names, "_b").drop("_b"), "signature-lists")


def search_lists(lists: DataFrame, queries: DataFrame, groups: Sequence[str], k: int, dim: int, planes: np.ndarray, mean: np.ndarray, masks: np.ndarray,
                 pairs: float = 0.0) -> DataFrame:
    """``(i, nn_i)``: for every query ``(group.., i, vec)`` the vectors of the
    looked-up lists that are among the ``k`` nearest of a block, ties included.
    ``pairs`` is about how many pairs that compares."""
    g = list(groups)
    keys = [*g, "sig"]
    shared = queries.sparkSession.sparkContext.broadcast((planes, mean, masks))  # MAX_MASKS x MAX_BITS bytes at most

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, mean, masks = shared.value
        for batch in batches:
            step = max(1, min(1024, HELD_PAIRS // len(masks)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x, i = _matrix(part.column("vec"), dim), part.column("i").to_numpy().astype("<i8")
                for first, sig, rows in looks(x, group_numbers(part, g), planes, mean, masks):
                    own = [part.column(c).take(pa.array(first)) for c in g]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(sig, pa.int64()), pa.array([i[r].tobytes() for r in rows], pa.binary()),
                                                      pa.array([x[r].tobytes() for r in rows], pa.binary())], [*keys, "q", "qx"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, x, q, qx = (np.frombuffer(batch.column(c)[r].as_buffer(), kind) for c, kind in (("ids", "<i8"), ("x", "<f8"), ("q", "<i8"), ("qx", "<f8")))
                x, qx = x.reshape(-1, dim), qx.reshape(-1, dim)
                other = (x * x).sum(axis=1)
                step = max(1, HELD_PAIRS // len(ids))
                for at in range(0, len(q), step):
                    mine = qx[at:at + step]
                    own = (mine * mine).sum(axis=1)[:, None]
                    square = own + other - 2.0 * (mine @ x.T)
                    least = np.partition(square, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
                    a, b = np.nonzero(square <= (least + _SLACK * (1.0 + own[:, 0] + other.max()))[:, None])
                    yield pa.RecordBatch.from_pydict({"i": q[at + a], "nn_i": ids[b]})

    schema = queries.select(*g).schema.add("sig", "long").add("q", "binary").add("qx", "binary")
    met = queries.select(*g, "i", "vec").mapInArrow(probe, schema)
    # a row per (queries, block), dealt by the block, so that a list of many
    # blocks is no single task; the number of tasks follows the comparisons,
    # not the bytes, which are few
    blocks = lists.groupBy(*keys).agg(F.max("no").alias("_last"))
    parts = int(max(1, min(MAX_TASKS, pairs // TASK_PAIRS + 1)))
    dealt = met.join(blocks, keys).withColumn("no", F.explode(F.sequence(F.lit(0), F.col("_last")))).drop("_last").repartition(parts, *keys, "no")
    both = dealt.join(lists.repartition(parts, *keys, "no"), [*keys, "no"])
    return both.select("q", "qx", "ids", "x").mapInArrow(compare, "i long, nn_i long")


def fit_probing(vectors: DataFrame, lists: DataFrame, groups: Sequence[str], k: int, dim: int, planes: np.ndarray, mean: np.ndarray, recall: float, seed: int) -> Probing:
    """The number of masks that holds ``recall`` of the exact neighbours of at
    most ``SAMPLE`` queries; every list is scanned for those."""
    bits = planes.shape[1]
    sample = materialise(vectors.orderBy(uniform("i", seed=f"sample{seed}"), "i").limit(SAMPLE), "signature-sample")
    rows = {r["i"]: np.array(r["vec"]) for r in sample.select("i", "vec").collect()}
    # all lists of a query's group: one list for this purpose
    whole = lists.withColumn("sig", F.lit(0).cast("long")).drop("no")
    order = Window.partitionBy(*groups, "sig").orderBy("_b")
    whole = materialise(whole.withColumn("_b", F.monotonically_increasing_id()), "sample-lists")
    whole = whole.withColumn("no", F.row_number().over(order) - 1).drop("_b")
    none = np.zeros((dim, 0))
    near = search_lists(whole, sample, groups, k + 1, dim, none, mean, np.zeros((1, 0), np.int8), float(SAMPLE) * vectors.count())
    a, b = sample.select("i", F.col("vec").alias("_a")), vectors.select(F.col("i").alias("nn_i"), F.col("vec").alias("_b"))
    order = Window.partitionBy("i").orderBy("_d", "nn_i")
    exact = (near.where("i <> nn_i").join(a, "i").join(b, "nn_i").select("i", "nn_i", "_b", sq_dist(F.col("_a"), F.col("_b"), dim).alias("_d"))
             .withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).select("i", "_b").collect())  # SAMPLE x k rows
    if not exact or not bits:
        return Probing(bits, np.zeros((1, bits), np.int8), 1.0)
    q, x = np.array([rows[r["i"]] for r in exact]), np.array([r["_b"] for r in exact])
    (own, margin), (other, _) = _sides(q, planes, mean), _sides(x, planes, mean)
    order = np.argsort(np.abs(margin), axis=1)
    costs = np.take_along_axis(margin ** 2, order, 1).mean(axis=0)
    masks = cheapest_masks(costs, min(MAX_MASKS, 1 << bits))
    place = {mask.tobytes(): n for n, mask in enumerate(masks)}
    differ = ((own ^ other)[:, None] >> order & 1).astype(np.int8)
    ranks = np.sort([place.get(d.tobytes(), len(masks)) for d in differ])
    wanted = min(len(masks), int(ranks[min(len(ranks) - 1, math.ceil(recall * len(ranks)) - 1)]) + 1)
    return Probing(bits, masks[:wanted], float((ranks < wanted).mean()))


def signature_bits(rows: int, groups: int, list_rows: int = LIST_ROWS) -> int:
    """Bits with which a list of a group of average size has ``list_rows``."""
    return min(MAX_BITS, max(0, math.ceil(math.log2(max(1.0, rows / max(1, groups) / list_rows)))))


def knn_of(df: DataFrame, key: str, vec: str, chosen: Column, k: int = 5, group_cols: Sequence[str] = (), recall: float | None = None,
           list_rows: int = LIST_ROWS, seed: int = 42) -> tuple[DataFrame, Probing]:
    """The ``k`` nearest other rows (of the group) of the rows that meet
    ``chosen``: ``(group.., key, rank, nn_key, dist)`` as :func:`neighbors.knn`
    gives them.  Exact without ``recall``; with it, through as many signature
    lists as hold that share of a sample's neighbours.  Also returns the
    probing used.  Vectors are neither null nor of different lengths."""
    g = list(group_cols)
    points, vecs = distinct_vectors(df, key, vec, g)
    points = materialise(points, "knn-points")
    vecs = materialise(vecs.withColumn("i", F.monotonically_increasing_id()), "knn-vectors")
    dim = vector_dim(vecs, "vec")
    size = vecs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*g) if g else F.lit(0)).alias("g")).first()
    bits = signature_bits(size["n"], size["g"], list_rows) if recall is not None else 0
    means = {r["j"]: r["m"] for r in vecs.select(F.posexplode("vec").alias("j", "v")).groupBy("j").agg(F.avg("v").alias("m")).collect()}
    mean = np.array([means[j] for j in range(dim)])
    planes = np.random.default_rng(seed).standard_normal((dim, bits))
    lists = build_lists(vecs, g, dim, planes, mean)
    probing = fit_probing(vecs, lists, g, k, dim, planes, mean, recall, seed) if bits else Probing(0, np.zeros((1, 0), np.int8), 1.0)
    asked = points.where(chosen).select(*g, "vid").distinct()
    queries = vecs.join(asked, [*g, "vid"], "left_semi")
    per_query = min(size["n"] / max(1, size["g"]), len(probing.masks) * list_rows if bits else float("inf"))
    near = search_lists(lists, queries, g, k + 1, dim, planes, mean, probing.masks, queries.count() * per_query)
    a, b = vecs.select(*g, "vid", "i", F.col("vec").alias("_a")), vecs.select(F.col("vid").alias("nn_vid"), F.col("i").alias("nn_i"), F.col("vec").alias("_b"))
    pairs = near.distinct().join(a, "i").join(b, "nn_i").select(*g, "vid", "nn_vid", F.sqrt(sq_dist(F.col("_a"), F.col("_b"), dim)).alias("dist"))
    return expand_neighbours(points.where(chosen), points, vecs, pairs, key, k, g), probing


def recall_report(exact: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Share of the exact neighbours that were found: ``n_queries, n_true, n_found, recall``."""
    got = found.select(key, "nn_key").distinct().withColumn("_hit", F.lit(1))
    return (exact.select(key, "nn_key").join(got, [key, "nn_key"], "left")
            .agg(F.count_distinct(key).alias("n_queries"), F.count(F.lit(1)).alias("n_true"), F.count("_hit").alias("n_found"))
            .withColumn("recall", F.try_divide(F.col("n_found"), F.col("n_true"))))
