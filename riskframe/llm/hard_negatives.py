"""Hard negatives by a vertical branch-and-bound scan (BOND).

Vectors are quantised to integers and stored in blocks, dimension by
dimension, with the least and greatest value of every dimension of a block.
For an anchor, a block's dimensions are read in the order of the anchor's
magnitudes, the largest first.  What the dimensions not yet read can still add
to a score lies between the sums of their least and greatest contributions;
candidates whose score can no longer reach any window of the anchor leave the
bitmap (here: the array of the candidates' places) before the next dimensions
are read, and a block none of whose rows can reach one isn't read at all.
Candidates that are left at the end have exact integer scores.

A window asks for the ``k`` best scores between two bounds.  Its lower bound
rises to the k-th best score found so far.  Both searches, of positives and of
negatives, run over the anchors' own blocks first: the k-th best score there
bounds the scan of all blocks, so most tasks have little left to return.

Anchors are written to files of a few thousand in the shared folder, which
every task that holds blocks reads one after the other: a stated query set
against all rows, in blocks.  Nothing grows with the table but the number of
blocks and files.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.store import create, new_file, open_random, shared_folder, table

BLOCK_ROWS = 8192
FILE_ANCHORS = 4096
STEP = 8  # dimensions read between two looks at the bitmap
_LEAST, _MOST = -(1 << 62), 1 << 62


def valid_vectors(rows: DataFrame, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """``(id, label, vec)`` of the rows that take part: nothing null, all
    components finite.  Of rows with one id, the least (label, vector) stays."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
    one = kept.select(F.col(id_col).cast("long").alias("id"), F.struct(F.col(label_col).cast("long").alias("label"), vec.alias("vec")).alias("row"))
    return one.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.vec")


def _matrix(column: pa.ListArray, scale: float) -> np.ndarray:
    """Quantised vectors as rows; shorter ones are filled up with zeros."""
    offsets = np.asarray(column.offsets, np.int64)
    sizes = np.diff(offsets)
    values = np.floor(scale * column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.float64))
    if len(values) and np.abs(values).max() >= 2.0 ** 62:
        raise ValueError("a quantised component doesn't fit into 62 bits")
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    at = np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = values.astype(np.int64)
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    most = int(np.abs(x).max(initial=0))
    return x.astype(next(t for t, b in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if most < 1 << b))


def build_blocks(vectors: DataFrame, scale: float, name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of at most ``block_rows`` vectors, stored by dimension."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            columns = _narrow(np.ascontiguousarray(_matrix(whole.column("vec").combine_chunks(), scale).T))
            return pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int32()), "dims": pa.array([len(columns)], pa.int32()), "kind": [columns.dtype.str],
                                               "ids": [whole.column("id").to_numpy().astype("<i8").tobytes()],
                                               "labels": [whole.column("label").to_numpy().astype("<i8").tobytes()], "columns": [columns.tobytes()]})
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block_rows - n)
                held.append(part)
                n, at = n + part.num_rows, at + part.num_rows
                if n == block_rows:
                    yield block()
                    held, n = [], 0
        if n:
            yield block()

    return table(vectors.mapInArrow(cut, "n int, dims int, kind string, ids binary, labels binary, columns binary"), name)


def write_anchors(anchors: DataFrame, scale: float, low: int | None = None, high: int | None = None) -> list[str]:
    """Write ``(id, label, vec, scores, floors)`` to files of at most
    ``FILE_ANCHORS`` anchors; returns their paths (one row a file).

    Without ``low`` an anchor has one unbounded window; otherwise one for each
    of ``scores``, from ``low`` to ``high`` percent of it.  ``floors`` are
    lower bounds known already, by window in that order (null: none)."""
    folder = shared_folder(anchors.sparkSession, "anchors")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, FILE_ANCHORS):
                part = batch.slice(at, FILE_ANCHORS)
                scores, floors = part.column("scores").to_pylist(), part.column("floors").to_pylist()
                width = max((len(s) for s in scores), default=0) if low is not None else 1
                key = np.zeros((len(scores), width), np.int64)
                lo, hi = np.full((len(scores), width), _MOST), np.full((len(scores), width), _LEAST)
                for i, (own, known) in enumerate(zip(scores, floors)):
                    for w, s in enumerate(own if low is not None else [0]):
                        key[i, w] = s
                        lo[i, w], hi[i, w] = (-(-low * s // 100), high * s // 100) if low is not None else (_LEAST, _MOST)
                        if known and known[w] is not None:
                            lo[i, w] = max(lo[i, w], known[w])
                path, buffer = new_file(folder, ".npz"), io.BytesIO()
                np.savez(buffer, id=part.column("id").to_numpy(), label=part.column("label").to_numpy(),
                         vec=_matrix(part.column("vec"), scale), key=key, lo=lo, hi=hi)
                with create(path) as out:
                    out.write(buffer.getvalue())
                yield pa.RecordBatch.from_pydict({"path": [path]})

    files = anchors.select("id", "label", "vec", "scores", "floors").mapInArrow(write, "path string")
    return [r.path for r in table(files, "anchor-files").collect()]


class _Block:
    def __init__(self, row: dict):
        self.n, self.dims = row["n"], row["dims"]
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.columns = np.frombuffer(row["columns"], row["kind"]).reshape(self.dims, self.n)
        self.lo = self.columns.min(axis=1).astype(np.int64) if self.n else np.zeros(self.dims, np.int64)
        self.hi = self.columns.max(axis=1).astype(np.int64) if self.n else np.zeros(self.dims, np.int64)


class _Search:
    """The anchors of one file with the best scores found so far."""

    def __init__(self, path: str, k: int, same_label: bool):
        with open_random(path) as file:
            data = np.load(io.BytesIO(file.read()))
        self.id, self.label, self.vec, self.key, self.lo, self.hi = (data[c] for c in ("id", "label", "vec", "key", "lo", "hi"))
        self.k, self.same = k, same_label
        n, width = self.key.shape
        self.score = np.full((n, width, k), _LEAST)
        self.found = np.full((n, width, k), _MOST)

    def scan(self, block: _Block) -> None:
        dims = min(self.vec.shape[1], block.dims)
        q = self.vec[:, :dims]
        lo, hi = block.lo[:dims], block.hi[:dims]
        # exact in doubles below 2 ** 53, in 64 bits below 2 ** 63
        reach = np.abs(q).astype(float) @ np.maximum(np.abs(lo), np.abs(hi)).astype(float)
        if reach.max(initial=0) >= 2.0 ** 62:
            raise ValueError("scores don't fit into 62 bits")
        kind = np.float64 if reach.max(initial=0) < 2.0 ** 52 else np.int64
        columns = block.columns[:dims].astype(kind)
        order = np.argsort(-np.abs(q), axis=1, kind="stable")

        def still_to_come(x: np.ndarray) -> np.ndarray:
            x = np.take_along_axis(x, order, axis=1)[:, ::-1].cumsum(axis=1)[:, ::-1]
            return np.concatenate([x, np.zeros((len(x), 1), np.int64)], axis=1)
        most, least = still_to_come(np.maximum(q * lo, q * hi)), still_to_come(np.minimum(q * lo, q * hi))
        live = self.lo <= self.hi
        floor = np.where(live, self.lo, _MOST).min(axis=1, initial=_MOST)
        ceiling = np.where(live, self.hi, _LEAST).max(axis=1, initial=_LEAST)
        for i in np.flatnonzero((most[:, 0] >= floor) & (least[:, 0] <= ceiling)):
            wanted = (block.labels == self.label[i]) & (block.ids != self.id[i]) if self.same else block.labels != self.label[i]
            alive = np.flatnonzero(wanted)
            score = np.zeros(len(alive), kind)
            own = q[i].astype(kind)
            for at in range(0, dims, STEP):
                read = order[i, at:at + STEP]
                if 2 * len(alive) > block.n:
                    score += (own[read] @ columns[read])[alive]
                else:
                    score += own[read] @ columns[read[:, None], alive]
                behind = min(at + STEP, dims)
                keep = (score + most[i, behind] >= floor[i]) & (score + least[i, behind] <= ceiling[i])
                if not keep.all():
                    alive, score = alive[keep], score[keep]
                if not len(alive):
                    break
            if len(alive):
                self.take(i, score.astype(np.int64), block.ids[alive])

    def take(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        for w in range(self.key.shape[1]):
            inside = (score >= self.lo[i, w]) & (score <= self.hi[i, w])
            if inside.any():
                s, x = np.append(self.score[i, w], score[inside]), np.append(self.found[i, w], ids[inside])
                best = np.lexsort((x, -s))[:self.k]
                self.score[i, w], self.found[i, w] = s[best], x[best]
                self.lo[i, w] = max(self.lo[i, w], s[best[-1]])

    def rows(self) -> pa.RecordBatch:
        i, w, j = np.nonzero(self.score > _LEAST)
        return pa.RecordBatch.from_pydict({"anchor": self.id[i], "key": self.key[i, w], "score": self.score[i, w, j], "found": self.found[i, w, j]})


def search(blocks: DataFrame, files: list[str], k: int, same_label: bool) -> DataFrame:
    """``(anchor, key, score, found, rank)``: the ``k`` best rows of each
    window, best first, ties by smaller id.  ``key`` is the window's score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_Block(row) for batch in batches for row in batch.to_pylist()]  # one partition
        for path in files if held else ():
            s = _Search(path, k, same_label)
            for block in held:
                s.scan(block)
            yield s.rows()

    found = blocks.mapInArrow(run, "anchor long, key long, score long, found long")
    order = Window.partitionBy("anchor", "key").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _bounded(anchors: DataFrame, blocks: DataFrame, all_blocks: DataFrame, scale: float, k: int, same_label: bool, name: str,
             low: int | None = None, high: int | None = None) -> DataFrame:
    """Search the anchors' own blocks for lower bounds, then all blocks."""
    first = search(blocks, write_anchors(anchors, scale, low, high), k, same_label)
    floors = (first.where(F.col("rank") == k).groupBy(F.col("anchor").alias("id"))
              .agg(F.map_from_entries(F.collect_list(F.struct("key", "score"))).alias("_floors")))  # one entry a window
    keys = F.col("scores") if low is not None else F.array(F.lit(0).cast("long"))
    known = anchors.drop("floors").join(floors, "id", "left").withColumn("floors", F.transform(keys, lambda s: F.try_element_at("_floors", s)))
    return table(search(all_blocks, write_anchors(known, scale, low, high), k, same_label), name)


def mine_hard_negatives(rows: DataFrame, id_col: str, label_col: str, vec_col: str, is_anchor, scale: float = 256.0,
                        positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Hard negatives of every anchor and positive.

    Components become ``floor(scale * x)``; a score is the integer inner
    product (shorter vectors count as filled up with zeros).  ``is_anchor`` is
    a condition on ``id_col``.  An anchor's positives are its first
    ``positives`` other rows of the same label, by score, then smaller id.  For
    each, the first ``negatives`` rows of another label whose score is between
    ``low`` and ``high`` percent of the positive's.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.  Rows with a null id, label, vector or component, or a
    non-finite component, take no part; rows with one id are one row (see
    :func:`valid_vectors`); a negative positive score has an empty window;
    other columns, whatever their names, are unused; an empty table gives no
    row.  Scores beyond 62 bits raise an error.
    """
    vectors = table(valid_vectors(rows, id_col, label_col, vec_col), "vectors")
    anchors = vectors.where(is_anchor(F.col("id")))
    none = F.array().cast("array<long>")
    all_blocks = build_blocks(vectors, scale, "blocks", block_rows)
    own_blocks = build_blocks(anchors, scale, "anchor-blocks", block_rows)
    near = _bounded(anchors.select("*", none.alias("scores"), none.alias("floors")), own_blocks, all_blocks, scale, positives, True, "positives")
    windows = near.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_set("score")).alias("scores"))  # at most `positives`
    far = _bounded(anchors.join(windows, "id").select("id", "label", "vec", "scores", none.alias("floors")), own_blocks, all_blocks, scale, negatives, False,
                   "negatives", low, high)
    pairs = near.select("anchor", F.col("found").alias("positive_id"), F.col("score").alias("key"))
    return (pairs.join(far.select("anchor", "key", "rank", "found", "score"), ["anchor", "key"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"),
                    F.col("key").alias("positive_score"), F.col("score").alias("negative_score")))
