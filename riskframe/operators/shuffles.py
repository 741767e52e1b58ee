"""Seeded shuffles of many features at once.

A shuffle pairs the row at position ``p`` of one md5 order with the row at
position ``p`` of another.  Rows are dealt to chunks of the draws once; a task
orders its chunks and packs what the pairs need, so a chunk is one row from
there on.  Chunk sizes give every chunk its positions; the chunks of both
orders are cut where either of them ends, and equal pieces meet.  No row is
written with its group's names or ranked by a second sort.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.hashing import hash32
from riskframe.session import materialise

CHUNK_ROWS = 1 << 16    # rows of a chunk
TASK_ROWS = 1 << 18     # rows that a task orders
UNIT = 10 ** 12         # fractions of an exact score are counted in these
_NONE = -(1 << 62)      # whole part of a missing score: no sum with it is positive
COUNTED, IS_POSITIVE, IS_NEGATIVE, BASE_HIT, HAS_TEXT = 1, 2, 4, 8, 16
FIXED = 17              # bytes of a packed value before its text


def exact_parts(v: Column) -> Column:
    """An exact decimal as ``(hi, lo)``: its floor and the rest in 1 / ``UNIT``."""
    v = v.cast("decimal(36,12)")
    lo = ((v - F.floor(v)).cast("decimal(13,12)") * F.lit(UNIT).cast("decimal(13,0)")).cast("bigint")
    return F.struct(F.coalesce(F.floor(v).cast("bigint"), F.lit(_NONE)).alias("hi"), F.coalesce(lo, F.lit(0).cast("bigint")).alias("lo"))


def packed(parts: Column, code: Column, text: Column) -> Column:
    """One binary column of ``hi, lo, code, text``: handing a row to Python
    costs by the column."""
    whole = F.concat(*[F.lpad(F.hex(parts[c]), 16, "0") for c in ("hi", "lo")], F.lpad(F.hex(code.cast("bigint")), 2, "0"))
    return F.concat(F.unhex(whole), F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def unpacked(values: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hi``, ``lo`` and ``code`` of packed values."""
    found = []
    for part in values.chunks:
        starts = np.frombuffer(part.buffers()[1], "<i4")[part.offset:part.offset + len(part)]
        found.append(np.frombuffer(part.buffers()[2], np.uint8)[starts[:, None] + np.arange(FIXED)])
    rows = np.concatenate(found)
    hi, lo = (np.ascontiguousarray(rows[:, a:a + 8]).view(">i8")[:, 0].astype("<i8") for a in (0, 8))
    return hi, lo, rows[:, 16].astype(np.int8)


def positive_sums(hi: np.ndarray, lo: np.ndarray, other_hi: np.ndarray, other_lo: np.ndarray) -> np.ndarray:
    """Whether the sums of two columns of exact parts are above zero."""
    low = lo + other_lo
    carry = low >= UNIT
    high = hi + other_hi + carry
    return (high > 0) | ((high == 0) & (low - carry * UNIT > 0))


def ordered(p: np.ndarray, values: pa.ChunkedArray, suffix: dict[int, str]) -> np.ndarray:
    """The order by draw; rows of equal draws by the text that was drawn."""
    order = np.argsort(p, kind="stable")
    same = np.flatnonzero(p[order][1:] == p[order][:-1])
    if len(same):
        ends = np.flatnonzero(np.diff(same) > 1)
        for at, end in zip(same[np.r_[0, ends + 1]].tolist(), same[np.r_[ends, len(same) - 1]].tolist()):
            run = order[at:end + 2]
            tail = suffix[int(p[run[0]] >> 32)].encode()
            names = [v[FIXED:] + b"|" + tail if v[FIXED - 1] & HAS_TEXT else tail for v in values.take(pa.array(run)).to_pylist()]
            order[at:end + 2] = run[sorted(range(len(run)), key=names.__getitem__)]
    return order


def chunks_of(rows: DataFrame, suffix: dict[int, str], bits: int, parts: int) -> DataFrame:
    """Rows ``(p, v)`` as ordered chunks ``(g, chunk, n, hi, lo, code)``; ``p``
    is the group's number before the 32 bits of the draw, ``v`` a packed value."""
    down = 32 - bits

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        p = whole.column("p").to_numpy()
        order = ordered(p, whole.column("v"), suffix)
        p = p[order] >> down
        hi, lo, code = (c[order] for c in unpacked(whole.column("v")))
        starts = np.r_[0, np.flatnonzero(np.diff(p)) + 1, len(p)]
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield pa.RecordBatch.from_arrays([pa.array([int(p[a] >> bits)], pa.int32()), pa.array([int(p[a] & ((1 << bits) - 1))], pa.int32()), pa.array([b - a], pa.int64()),
                                              *(pa.array([c[a:b].tobytes()], pa.binary()) for c in (hi, lo, code))], ["g", "chunk", "n", "hi", "lo", "code"])
    return (rows.repartition(parts, F.shiftright("p", down))
            .mapInArrow(pack, "g int, chunk int, n long, hi binary, lo binary, code binary"))


def shuffle_hits(df: DataFrame, key: str, label: str, terms: Mapping[str, Column], intercept: Column, z: Column, positive: int, negative: int,
                 repeats: int, seed: int) -> DataFrame:
    """``(feature, repeat, n, base, new)``: rows with a label, and how many of
    them are predicted right before and after the feature's values (exact
    decimal ``terms`` of the score ``z``) are shuffled."""
    feats = list(terms)

    def without(f: str) -> Column:
        rest = intercept
        for other in feats:
            rest = rest if other == f else rest + terms[other]
        return F.when(z.isNotNull(), rest)
    hit = F.when(z > 0, positive).otherwise(negative) == F.col(label)
    code = sum((F.when(c, bit).otherwise(0) for c, bit in ((F.col(label) == positive, IS_POSITIVE), (F.col(label) == negative, IS_NEGATIVE), (hit, BASE_HIT))),
               F.when(F.col(label).isNotNull(), COUNTED).otherwise(0))
    text = F.col(key).cast("string")
    code = code + F.when(text.isNotNull(), HAS_TEXT).otherwise(0)
    # two values a feature: the score without it for the row that receives, its own term for the row that gives
    values = [packed(exact_parts(part), code, text) for f in feats for part in (without(f), terms[f])]
    base = materialise(df.select(text.alias("text"), F.array(*values).alias("v")), "shuffle-rows")
    n = base.count()
    bits = min(20, max(0, math.ceil(math.log2(max(1, n) / CHUNK_ROWS))))
    groups = 2 * len(feats) * repeats      # (feature, repeat, side), the side last
    name, rep = F.element_at(F.array(*map(F.lit, feats)), (F.col("g") / (2 * repeats)).cast("int") + 1), F.shiftright("g", 1) % repeats + 1
    key_text = F.concat_ws("|", "text", name, rep.cast("string"))
    draw = F.when(F.col("g") % 2 == 0, hash32(key_text, seed=f"dst{seed}")).otherwise(hash32(key_text, seed=f"src{seed}"))
    own = F.element_at("v", 2 * (F.col("g") / (2 * repeats)).cast("int") + F.col("g") % 2 + 1)
    rows = (base.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
            .select(F.shiftleft(F.col("g").cast("long"), 32).bitwiseOR(draw).alias("p"), own.alias("v")))
    suffix = {g: f"{feats[g // (2 * repeats)]}|{g // 2 % repeats + 1}" for g in range(groups)}
    chunks = materialise(chunks_of(rows, suffix, bits, max(1, n * groups // TASK_ROWS + 1)), "shuffle-chunks")

    # where the chunks of both orders overlap: a few numbers a chunk
    off = F.sum("n").over(Window.partitionBy("g").orderBy("chunk")) - F.col("n")
    placed = chunks.select("g", "chunk", "n", off.alias("off"))
    to = placed.where("g % 2 = 0").select((F.col("g") / 2).cast("int").alias("pair"), F.col("chunk").alias("c0"), F.col("off").alias("o0"), (F.col("off") + F.col("n")).alias("e0"))
    of = placed.where("g % 2 = 1").select((F.col("g") / 2).cast("int").alias("pair"), F.col("chunk").alias("c1"), F.col("off").alias("o1"), (F.col("off") + F.col("n")).alias("e1"))
    cuts = materialise(to.join(of, "pair").where("o0 < e1 and o1 < e0").withColumn("at", F.greatest("o0", "o1")).withColumn("size", F.least("e0", "e1") - F.col("at")), "shuffle-cuts")

    def pieces(side: int, columns: Mapping[str, int]) -> DataFrame:
        where = cuts.select((2 * F.col("pair") + side).alias("g"), F.col(f"c{side}").alias("chunk"), "pair", "at", "size", (F.col("at") - F.col(f"o{side}")).alias("skip"))
        cut = [F.substr(c, (F.col("skip") * w + 1).cast("int"), (F.col("size") * w).cast("int")).alias(f"{c}{side}") for c, w in columns.items()]
        return chunks.join(where, ["g", "chunk"]).select("pair", "at", *cut)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"pair": batch.column("pair"), "n": [], "base": [], "new": []}
            for r in range(batch.num_rows):
                hi0, lo0, hi1, lo1 = (np.frombuffer(batch.column(c)[r].as_buffer(), "<i8") for c in ("hi0", "lo0", "hi1", "lo1"))
                code = np.frombuffer(batch.column("code0")[r].as_buffer(), np.int8)
                right = np.where(positive_sums(hi0, lo0, hi1, lo1), code & IS_POSITIVE, code & IS_NEGATIVE)
                for c, found in (("n", code & COUNTED), ("base", code & BASE_HIT), ("new", right)):
                    out[c].append(int(np.count_nonzero(found)))
            yield pa.RecordBatch.from_pydict({c: v if c == "pair" else pa.array(v, pa.int64()) for c, v in out.items()})
    met = pieces(0, {"hi": 8, "lo": 8, "code": 1}).join(pieces(1, {"hi": 8, "lo": 8}), ["pair", "at"])
    found = met.select("pair", "hi0", "lo0", "code0", "hi1", "lo1").mapInArrow(count, "pair int, n long, base long, new long")
    return (found.groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n", "base", "new")])
            .select(F.element_at(F.array(*map(F.lit, feats)), (F.col("pair") / repeats).cast("int") + 1).alias("feature"),
                    (F.col("pair") % repeats + 1).alias("repeat"), "n", "base", "new"))
