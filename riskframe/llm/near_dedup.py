"""MinHash near-dedup with sequential Bayesian verification.

1. Every text's set of shingles is hashed; equal sets form a class (a group of
   exact copies is one row from here on).  A class keeps its size and a MinHash
   signature.
2. Signatures are banded into buckets.  A bucket's leader, the class that meets
   most others in all its buckets, is compared with the members, never all
   with all.
3. A candidate pair's signatures are compared a batch of hashes at a time; it is
   dropped once the posterior probability (uniform prior) that its similarity
   reaches the threshold falls below ``miss``.
4. Survivors are verified exactly on their full sets.
5. Verified links give components.  A bucket whose members fall into more than
   one component is not settled by its leader.  The classes of such buckets
   meet again by the rarest shingles of their sets (prefix, length and positional
   filters: two sets that reach the threshold share one of them), and pairs of
   different components that do go through 3 and 4.  This loses no link and has no cap; texts that
   only share a frequent passage do not meet.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.store import bounded_batches, table, text_bytes

DEFAULT_WORDS, DEFAULT_HASHES, DEFAULT_BANDS = 5, 128, 32
DEFAULT_SIMILARITY, DEFAULT_MISS, DEFAULT_BATCH = (75, 100), 1e-5, 32

_MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ shingles
class WordHashes(dict):
    """64-bit hash of a word; cleared between texts beyond ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def words_of(text: bytes) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space."""
    return text.lower().split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(hashes: WordHashes, text: bytes, size: int = DEFAULT_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``size``-word shingles; with
    fewer words, of the whole sequence; without words, empty."""
    if len(hashes) > hashes.limit:
        hashes.clear()
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(size, len(w))
    h = np.full(len(w) - span + 1, span, np.uint64)
    for k in range(span):
        h = _mixed(h * _MIX + w[k:len(w) - span + 1 + k])
    return np.unique(h)


def _factors(n_hashes: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    odd = draw.integers(0, 2 ** 63, n_hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 2 ** 63, n_hashes, dtype=np.uint64)


def signatures(sets: list[np.ndarray], n_hashes: int) -> np.ndarray:
    """MinHash signatures (rows of ``uint32``) of non-empty sets."""
    a, b = _factors(n_hashes)
    starts = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    flat = np.concatenate(sets)
    out = np.empty((n_hashes, len(sets)), np.uint32)
    work = np.empty_like(flat)
    for k in range(n_hashes):
        np.multiply(flat, a[k], out=work)
        work += b[k]
        work >>= np.uint64(32)
        out[k] = np.minimum.reduceat(work, starts)
    return np.ascontiguousarray(out.T)


def _digest(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def class_table(docs: DataFrame, id_col: str, text_col: str, n_hashes: int, size: int) -> DataFrame:
    """Per row ``_id``, its set's size ``_n`` and digest ``_cls`` (null if the
    set is empty) and signature ``_sig``; written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def part(ids, sets):
            full = [i for i, s in enumerate(sets) if len(s)]
            sigs = signatures([sets[i] for i in full], n_hashes) if full else []
            by_row = {i: sig.tobytes() for i, sig in zip(full, sigs)}
            digest = [_digest(s) for s in sets]
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(map(len, sets), pa.int64()), pa.array(digest, pa.binary()),
                 pa.array([by_row.get(i) for i in range(len(sets))], pa.binary())], ["_id", "_n", "_cls", "_sig"])

        for batch in batches:
            ids, sets, start, total = batch.column("_id"), [], 0, 0
            for text in text_bytes(batch.column("_text")):
                sets.append(shingle_hashes(hashes, text, size))
                total += len(sets[-1])
                if total > 100_000:  # work in pieces that fit the processor's cache
                    yield part(ids.slice(start, len(sets)), sets)
                    start, sets, total = start + len(sets), [], 0
            if sets:
                yield part(ids.slice(start, len(sets)), sets)

    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return table(source.mapInArrow(run, "_id long, _n long, _cls binary, _sig binary"), "near-rows")


# ------------------------------------------------------------------ Bayesian pruning
def least_matches(n: int, similarity: float, miss: float) -> int:
    """Fewest matches among ``n`` hashes with which the posterior probability
    of a similarity of at least ``similarity`` (uniform prior) is ``miss``.

    The posterior is Beta(m + 1, n - m + 1); its upper tail at t equals the
    probability of at most m successes in n + 1 trials of probability t."""
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * similarity ** m * (1 - similarity) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def _survivors(pairs: DataFrame, n_hashes: int, batch: int, similarity: float, miss: float) -> DataFrame:
    """Pairs whose signatures (``_sig``, ``_sig2``) stand every batch."""
    steps = [(min(n, n_hashes), least_matches(min(n, n_hashes), similarity, miss)) for n in range(batch, n_hashes + batch, batch)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(b.num_rows, n_hashes) for c in ("_sig", "_sig2"))
            alive, seen, before = np.arange(b.num_rows), np.zeros(b.num_rows, np.int64), 0
            for n, least in steps:
                seen = seen + (x[alive, before:n] == y[alive, before:n]).sum(1)
                keep = seen >= least
                alive, seen, before = alive[keep], seen[keep], n
            yield b.select(["_a", "_z"]).take(pa.array(alive))

    return pairs.select("_a", "_z", "_sig", "_sig2").mapInArrow(run, "_a long, _z long")


def _linked(texts: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """Pairs whose full sets (of ``_text`` and ``_text2``) reach the threshold."""
    part, whole = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last = WordHashes(), (None, None)
        for b in batches:
            hit = []
            for i, (x, y) in enumerate(zip(text_bytes(b.column("_text")), text_bytes(b.column("_text2")))):
                if x != last[0]:
                    last = (x, shingle_hashes(hashes, x, size))
                one, two = last[1], shingle_hashes(hashes, y, size)
                both = len(np.intersect1d(one, two, assume_unique=True))
                if whole * both >= part * (len(one) + len(two) - both):
                    hit.append(i)
            yield b.select(["_a", "_z"]).take(pa.array(hit, pa.int64()))

    return texts.select("_a", "_z", "_text", "_text2").mapInArrow(run, "_a long, _z long")


# ------------------------------------------------------------------ components
def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(_c, _root)`` of every node in ``links (_a, _z)``: the smallest node
    that it reaches.  Alternates large-star and small-star steps; the number of
    rounds grows with the logarithm of the longest chain.  The minima of a step
    are written before they are joined, so that Spark can split the rows of a
    node with very many links."""
    edges = table(links.select(F.greatest("_a", "_z").alias("_a"), F.least("_a", "_z").alias("_z")).where("_a <> _z").distinct(), "links")

    def star(rows: DataFrame) -> DataFrame:
        lowest = table(rows.groupBy("_a").agg(F.min("_z").alias("_m")), "lowest")
        return rows.join(lowest, "_a").withColumn("_m", F.least("_a", "_m"))

    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("_z").alias("_a"), F.col("_a").alias("_z")))
        large = table(star(both).where("_z > _a").select(F.col("_z").alias("_a"), F.col("_m").alias("_z")).distinct(), "large-star")
        near = star(large)
        small = table(near.select(F.col("_z").alias("_a"), F.col("_m").alias("_z")).where("_a <> _z")
                      .unionByName(near.select("_a", F.col("_m").alias("_z"))).distinct(), "small-star")
        edges = small
        # done once every node points at one node, which points nowhere
        if (small.groupBy("_a").count().where("count > 1").isEmpty()
                and small.join(small.select(F.col("_a").alias("_z")), "_z", "left_semi").isEmpty()):
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("_z").distinct().select(F.col("_z").alias("_c"), F.col("_z").alias("_root"))
    return table(edges.select(F.col("_a").alias("_c"), F.col("_z").alias("_root")).unionByName(roots), "components")


# ------------------------------------------------------------------ the operator
def _of_class(joined: DataFrame, size: int) -> DataFrame:
    """The rows, found by id, whose set is the class's (an id may repeat)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            found = [shingle_hashes(hashes, t, size) for t in text_bytes(b.column("_text"))]
            ok = [i for i, (s, c) in enumerate(zip(found, b.column("_cls").to_pylist())) if _digest(s) == c]
            yield b.select(["_c", "_text"]).take(pa.array(ok, pa.int64()))
    return joined.select("_c", "_cls", "_text").mapInArrow(run, "_c long, _text string")


def _rarest(texts: DataFrame, classes: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """``(_s, _c, _root, _n, _p)``: the prefixes of the classes' sets when
    shingles are ordered by their frequency among these classes, rarest first;
    ``_p`` is a shingle's place in the whole set, from 1.

    Two sets of the given similarity share at least ``ceil(t * n)`` of either's
    ``n`` shingles, so the first ``n - ceil(t * n) + 1`` of both in any one order
    have a shingle in common.  Shingles that one class alone holds come first
    and can't be shared: they only use up places.  A passage that very many
    texts hold comes last and is in the prefix only of texts that hold little
    else."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            owner, sets, rows = [], [], 0
            for c, text in zip(b.column("_c").to_pylist(), text_bytes(b.column("_text"))):
                owner.append(c)
                sets.append(shingle_hashes(hashes, text, size))
                rows += len(sets[-1])
                if rows > 200_000:
                    yield part(owner, sets)
                    owner, sets, rows = [], [], 0
            if sets:
                yield part(owner, sets)

    def part(owner: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(owner, np.int64), [len(s) for s in sets])),
                                           pa.array(np.concatenate(sets).view(np.int64))], ["_c", "_s"])

    held = table(texts.join(classes.select("_c"), "_c").mapInArrow(run, "_c long, _s long"), "open-sets")
    often = table(held.groupBy("_s").agg(F.count(F.lit(1)).alias("_f")).where("_f > 1"), "common-shingles")
    common = held.join(often, "_s")
    by_class = Window.partitionBy("_c")
    part, whole = similarity
    place = F.col("_n") - F.col("_m") + F.col("_i")  # those that no other class holds come first
    last = F.col("_n") - F.expr(f"({part} * _n + {whole - 1}) div {whole}") + 1
    return (common.withColumn("_m", F.count(F.lit(1)).over(by_class)).withColumn("_i", F.row_number().over(by_class.orderBy("_f", "_s")))
            .join(classes, "_c").withColumn("_p", place).where(F.col("_p") <= last).select("_s", "_c", "_root", "_n", "_p"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = DEFAULT_WORDS,
               similarity: tuple[int, int] = DEFAULT_SIMILARITY, n_hashes: int = DEFAULT_HASHES,
               bands: int = DEFAULT_BANDS, batch: int = DEFAULT_BATCH, miss: float = DEFAULT_MISS) -> DataFrame:
    """Components of texts whose shingle sets have a Jaccard similarity of at
    least ``similarity`` (a fraction, 75/100), one row per input row.

    Returns ``(<id>, n_shingles, component_id, kept)``: the size of the set, the
    smallest id of the component, and whether the row has that id.  Null and
    empty texts, and texts without words, have an empty set and are linked with
    nothing.  Rows repeated with one id are rows of their own; a null id names a
    component only if that has no other.  Long texts are read whole.  An empty
    table gives no rows; other columns are not read.

    A pair just at the threshold shares no band with probability
    ``(1 - s^r)^b``: 5e-6 for the default 32 bands of 4 hashes.
    """
    bounded_batches(docs.sparkSession)
    share = similarity[0] / similarity[1]
    rows = class_table(docs, id_col, text_col, n_hashes, size)
    classes = table(rows.where("_cls is not null").groupBy("_cls")
                    .agg(F.min("_id").alias("_first"), F.max("_n").alias("_n"), F.max("_sig").alias("_sig"))
                    .withColumn("_c", F.monotonically_increasing_id()), "classes")

    # buckets that hold more than one class
    width = 4 * n_hashes // bands
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring("_sig", i * width + 1, F.lit(width))))
    entries = classes.select("_c", F.explode(keys).alias("_bucket"))
    sizes = table(entries.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1"), "bucket-sizes")
    meets = table(entries.join(sizes, "_bucket"), "bucket-entries")
    # a bucket's leader is the class that meets most others in all its buckets:
    # in a group of near copies, the text that the others were made from
    weights = table(meets.groupBy("_c").agg(F.sum(F.col("_size") - 1).alias("_w")), "weights")
    leaders = table(meets.join(weights, "_c").groupBy("_bucket").agg(F.max(F.struct("_w", "_c"))["_c"].alias("_lead")), "leaders")
    shared = table(meets.join(leaders, "_bucket").select("_c", "_bucket", "_lead"), "buckets")
    met = table(classes.join(shared.select("_c").distinct(), "_c", "left_semi"), "met-classes")

    # whole texts of the classes that meet another one
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    texts = table(_of_class(source.join(met.select("_c", "_cls", "_first"), F.col("_id").eqNullSafe(F.col("_first"))), size), "near-texts")
    if not texts.groupBy("_c").count().where("count > 1").isEmpty():  # repeated rows
        texts = table(texts.dropDuplicates(["_c"]), "near-texts")

    def side(of: DataFrame, node: str, column: str, name: str) -> DataFrame:
        return of.select(F.col("_c").alias(node), F.col(column).alias(name))

    def verified(pairs: DataFrame) -> DataFrame:
        signed = pairs.join(side(met, "_z", "_sig", "_sig"), "_z").join(side(met, "_a", "_sig", "_sig2"), "_a")
        likely = table(_survivors(signed, n_hashes, batch, share, miss), "likely")
        full = likely.join(side(texts, "_z", "_text", "_text2"), "_z").join(side(texts, "_a", "_text", "_text"), "_a")
        return table(_linked(full, size, similarity), "verified")

    links = verified(shared.where("_c <> _lead").select(F.least("_lead", "_c").alias("_a"), F.greatest("_lead", "_c").alias("_z")).distinct())
    parts = components(links)

    # buckets that their leaders did not settle: their classes meet again by
    # the rarest shingles of their sets
    labelled = table(shared.join(parts, "_c", "left").withColumn("_root", F.coalesce("_root", "_c")), "labelled")
    unsettled = labelled.groupBy("_bucket").agg(F.min("_root").alias("_lo"), F.max("_root").alias("_hi")).where("_lo <> _hi").select("_bucket")
    left = table(labelled.join(table(unsettled, "unsettled"), "_bucket").select("_c", "_root").distinct()
                 .join(met.select("_c", "_n"), "_c"), "open-classes")
    prefixes = table(_rarest(texts, left, size, similarity), "prefixes")
    sizes = table(prefixes.groupBy("_s", "_root").agg(F.count(F.lit(1)).alias("_m"))
                  .groupBy("_s").agg(F.max(F.struct("_m", "_root"))["_root"].alias("_big"), F.count(F.lit(1)).alias("_parts"))
                  .where("_parts > 1").select("_s", "_big"), "open-shingles")
    rest = table(prefixes.join(sizes, "_s"), "open-entries")
    small = rest.where("_root <> _big").select("_s", F.col("_c").alias("_a"), F.col("_root").alias("_ra"), F.col("_n").alias("_na"), F.col("_p").alias("_pa"))
    part, whole = similarity
    pairs = (small.join(rest, "_s")
             .where("_root <> _ra and (_root = _big or _a < _c)")
             # sizes that can match; the shorter set's shingle is among its first n - ceil(2t / (1 + t) n) + 1; and what
             # follows the first common shingle on either side suffices (positional filter)
             .where(f"{whole} * least(_n, _na) >= {part} * greatest(_n, _na)")
             .where(f"if((_na, _a) < (_n, _c), _pa <= _na - ({2 * part} * _na + {whole + part - 1}) div {whole + part} + 1, "
                    f"_p <= _n - ({2 * part} * _n + {whole + part - 1}) div {whole + part} + 1)")
             .where(f"1 + least(_na - _pa, _n - _p) >= ({part} * (_na + _n) + {whole + part - 1}) div {whole + part}")
             .select(F.least("_a", "_c").alias("_a"), F.greatest("_a", "_c").alias("_z")).distinct())
    more = verified(pairs)
    if not more.isEmpty():
        parts = components(links.unionByName(more))

    named = table(classes.select("_c", "_cls", "_first").join(parts, "_c", "left").withColumn("_root", F.coalesce("_root", "_c")), "named")
    lowest = table(named.groupBy("_root").agg(F.min("_first").alias("component_id")), "component-ids")
    final = table(named.join(lowest, "_root").select("_cls", "component_id"), "class-components")
    out = rows.select("_id", "_n", "_cls").join(final, "_cls", "left")
    component = F.when(F.col("_cls").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return (out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
