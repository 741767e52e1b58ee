"""Exact nearest neighbours, SMOTE and similarity leakage.

Copies are collapsed first with their multiplicity, so a group of identical
rows holding a third of the data is one row; a vector's id is the smallest key
among its copies.  Exact k-NN compares blocks of distinct vectors whose
bounding boxes are near enough (:mod:`riskframe.operators.boxes`).  The result
is exact regardless of the data; how much is pruned depends on the geometry
(well in low dimension, little for isotropic high-dimensional data, where any
exact method must compare most pairs).

SMOTE draws base row, neighbour rank and gap from md5 of the synthetic
row number, so the output is identical under re-execution.  Leakage is a
similarity *threshold* join (cosine > t) on buckets of random hyperplane
signatures with exact verification.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.hashing import pick, uniform
from riskframe.functions.ranking import hash_positions, running_totals
from riskframe.operators.boxes import near_pairs
from riskframe.session import checkpoint, materialise


def sq_dist(a: Column, b: Column, dim: int | None = None) -> Column:
    """Squared Euclidean distance of two equal-length arrays, summed left to
    right.  With a known ``dim`` it is a flat element-wise expression, which
    whole-stage codegen compiles (higher-order array functions run
    interpreted); both forms add in the same order, so results are equal."""
    if dim is None:
        return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)
    acc = F.lit(0.0)
    for i in range(dim):
        d = a[i] - b[i]
        acc = acc + d * d
    return acc


def dot(a: Column, b: Column, dim: int | None = None) -> Column:
    if dim is None:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)
    acc = F.lit(0.0)
    for i in range(dim):
        acc = acc + a[i] * b[i]
    return acc


def vector_dim(df: DataFrame, vec: str) -> int:
    """The common length of an array column (error if lengths differ)."""
    r = df.agg(F.min(F.size(vec)).alias("lo"), F.max(F.size(vec)).alias("hi")).first()
    if r["lo"] != r["hi"]:
        raise ValueError(f"{vec} holds arrays of different lengths ({r['lo']}..{r['hi']})")
    return int(r["hi"] or 0)


def unit(vec: Column) -> Column:
    """x / ||x||; the zero vector stays zero (similarity 0 to everything)."""
    norm = F.sqrt(F.aggregate(F.transform(vec, lambda x: x * x), F.lit(0.0), lambda acc, v: acc + v))
    return F.when(norm > 0, F.transform(vec, lambda x: x / norm)).otherwise(F.transform(vec, lambda x: x * 0.0))


def distinct_vectors(df: DataFrame, key: str, vec: str, group_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(points, vectors)``: points ``(group.., key, vid)`` and distinct
    vectors ``(group.., vid, vec, cnt)``.  The group-by on the vector is
    map-side combined, so copies never meet in one task; the key -> vid join
    has one row per vector on the small side (AQE splits a hot one)."""
    g = list(group_cols)
    pts = df.select(*g, key, F.col(vec).cast("array<double>").alias("vec"))
    vecs = pts.groupBy(*g, "vec").agg(F.min(key).alias("vid"), F.count(F.lit(1)).alias("cnt"))
    points = pts.join(vecs.select(*g, "vec", "vid"), [*g, "vec"]).select(*g, key, "vid")
    return points, vecs


def near_vectors(vecs: DataFrame, k: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """R1 on distinct vectors ``(group.., i, vid, vec)``, numbered by ``i`` in
    the order of ``vid``: ``(group.., vid, nn_vid, dist)`` with, for every
    vector, itself and its ``k`` nearest others by (distance, ``nn_vid``)."""
    g = list(group_cols)
    whole = ~F.exists("vec", lambda x: x.isNull())
    for c in [*g, "vid", "vec"]:
        whole = F.col(c).isNotNull() & whole
    known = vecs.where(whole)
    found = near_pairs(known, k, g, vector_dim(known, "vec"))
    # the nearest of each block: a rank limit, which Spark applies before the shuffle too
    order = Window.partitionBy("i").orderBy("square", "nn_i")
    best = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")
    pairs = (best.join(vecs.select(*g, "i", "vid"), "i").join(vecs.select(F.col("i").alias("nn_i"), F.col("vid").alias("nn_vid")), "nn_i")
             .where(F.col("vid") != F.col("nn_vid")).select(*g, "vid", "nn_vid", F.sqrt("square").alias("dist")))
    return pairs.unionByName(vecs.select(*g, "vid", F.col("vid").alias("nn_vid"), F.lit(0.0).alias("dist")))


def _members(points: DataFrame, vecs: DataFrame, key: str, k: int, g: list[str]) -> DataFrame:
    """``(group.., vid, nn_key)``: the ``k + 1`` smallest keys of every vector.
    Only vectors with copies are ranked, by chunked ranks: a group of copies,
    however large, never meets in one task."""
    many = points.join(vecs.where("cnt > 1").select(*g, "vid"), [*g, "vid"]).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(many, [*g, "vid"], [key], "_one").where(F.col("_before") <= k)
    single = vecs.where("cnt = 1").select(*g, "vid", F.col("vid").alias("nn_key"))
    return single.unionByName(ranked.select(*g, "vid", F.col(key).alias("nn_key")))


def knn(df: DataFrame, key: str, vec: str, k: int = 5, group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact k nearest neighbours of every row among the other rows of its
    group, ordered by distance, then key: ``(group.., key, rank, nn_key,
    dist)``.  A row is never its own neighbour; copies of its vector are, at
    distance 0.  A row of a group with fewer than ``k`` others gets them all.
    Keys are unique within a group."""
    g = list(group_cols)
    points, vecs = distinct_vectors(df, key, vec, g)
    # several jobs read both: written once to the shared folder, vectors in the order of their ids
    points = materialise(points, "knn-points")
    vecs = materialise(vecs.orderBy("vid").withColumn("i", F.monotonically_increasing_id()), "knn-vectors")
    return expand_neighbours(points, points, vecs, near_vectors(vecs, k, g), key, k, g)


def expand_neighbours(asked: DataFrame, points: DataFrame, vecs: DataFrame, near: DataFrame, key: str, k: int, g: list[str]) -> DataFrame:
    """From near vectors to the ``k`` nearest other rows of the ``asked`` points.
    ``near`` holds ``(group.., vid, nn_vid, dist)`` with the vector itself and
    its nearest ones; ``points`` and ``vecs`` are written tables."""
    members = materialise(_members(points, vecs, key, k, g), "knn-members")
    cand = near.join(members.withColumnRenamed("vid", "nn_vid"), [*g, "nn_vid"]).select(*g, "vid", "nn_key", "dist")
    # the k + 1 nearest points of the vector, itself included: a rank limit, which Spark applies before the shuffle too
    order = Window.partitionBy(*g, "vid").orderBy("dist", "nn_key")
    best = cand.withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= k + 1)
    lists = materialise(best.groupBy(*g, "vid").agg(F.sort_array(F.collect_list(F.struct("dist", "nn_key"))).alias("_nn")), "knn-lists")
    others = F.slice(F.filter("_nn", lambda x: x["nn_key"] != F.col(key)), 1, k)
    return (asked.join(lists, [*g, "vid"]).select(*g, key, F.posexplode(others).alias("rank", "_x"))
            .select(*g, key, (F.col("rank") + 1).cast("int").alias("rank"), "_x.nn_key", "_x.dist"))


def neighbours_in(df: DataFrame, key: str, vec: str, fits: str, n_fits: int, k: int, name: str) -> DataFrame:
    """:func:`knn` in overlapping groups by one search: the groups of a row are the
    bits of ``fits``.  ``(name, key, _nn)``: for every row and group its ``k`` nearest
    others there, as ``knn`` finds them for the rows of that group alone."""
    pts = df.select(key, F.col(fits).cast("int").alias("_fits"), F.col(vec).cast("array<double>").alias("vec")).where(F.col("vec").isNotNull())
    # a vector is in the groups of its rows that have a key
    vecs = pts.groupBy("vec").agg(F.coalesce(F.bit_or(F.when(F.col(key).isNotNull(), F.col("_fits"))), F.lit(0)).alias("fits"), F.count(F.lit(1)).alias("cnt"))
    vecs = materialise(vecs.withColumn("i", F.monotonically_increasing_id()), "knn-vectors")
    points = materialise(pts.join(vecs, "vec").select(key, "i", "cnt", F.col("_fits").bitwiseAND(F.col("fits")).alias("_in")).where("_in <> 0"), "knn-points")
    known = vecs.where((F.col("fits") != 0) & ~F.exists("vec", lambda x: x.isNull())).select("i", "vec", "fits")
    found = near_pairs(known, k, [], vector_dim(known, "vec"), n_fits=n_fits)
    # of the nearest of each block, the k nearest in some group, and those as near
    order = Window.partitionBy("i").orderBy("square", "nn_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bit = [F.col("bits").bitwiseAND(F.lit(1 << f)) != 0 for f in range(n_fits)]
    ranked = found.select("*", *[F.count_if(b).over(order).alias(f"_c{f}") for f, b in enumerate(bit)])
    ranked = ranked.select("*", *[F.max(F.when(b & (F.col(f"_c{f}") <= k), F.col("square"))).over(Window.partitionBy("i")).alias(f"_k{f}") for f, b in enumerate(bit)])
    among = F.lit(False)
    for f, b in enumerate(bit):
        among = among | (b & (F.col("square") <= F.col(f"_k{f}")))
    near = ranked.where(among).select("i", "nn_i", F.sqrt("square").alias("dist")).unionByName(vecs.where("fits <> 0").select("i", F.col("i").alias("nn_i"), F.lit(0.0).alias("dist")))
    many = points.where("cnt > 1").withColumn("_one", F.lit(1).cast("long"))
    copies = running_totals(many, ["i", "_in"], [key], "_one").where(F.col("_before") <= k)
    members = materialise(points.where("cnt = 1").select("i", key, "_in").unionByName(copies.select("i", key, "_in")), "knn-members")
    cand = near.join(members.select(F.col("i").alias("nn_i"), F.col(key).alias("nn_key"), "_in"), "nn_i")
    lists = materialise(cand.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("dist", "nn_key", "_in"))).alias("_nn")), "knn-lists")

    def others(f: int) -> Column:
        best = F.slice(F.filter("_nn", lambda x: x["_in"].bitwiseAND(F.lit(1 << f)) != 0), 1, k + 1)
        return F.transform(F.slice(F.filter(best, lambda x: x["nn_key"] != F.col(key)), 1, k), lambda x: x["nn_key"])
    rows = F.array(*[F.when(F.col("_in").bitwiseAND(F.lit(1 << f)) != 0, F.struct(F.lit(f).alias(name), others(f).alias("_nn"))) for f in range(n_fits)])
    return points.join(lists, "i").select(key, F.inline(F.filter(rows, lambda r: r.isNotNull()))).select(name, key, "_nn")


def smote(df: DataFrame, key: str, vec: str, label: str, k: int = 5, seed: int = 42,
          minority: object | None = None, group_cols: Sequence[str] = (), neighbours: Callable[[dict], DataFrame] | None = None) -> DataFrame:
    """Per group, add ``n_major - n_minor`` synthetic minority rows
    ``x + g (nn - x)``; base row, neighbour rank (1..k) and gap g in [0, 1)
    are md5 draws of (group, synthetic id, seed).  Returns the input rows
    plus the synthetic ones (``synthetic`` flag, ``syn_id``, ``base_key``,
    ``nn_key``).

    All groups run in one plan: k-NN is grouped, minority positions are
    chunked ranks per group, and the synthetic ids are one ``range`` over
    the total, mapped to (group, local id) by per-group offsets (a
    groups-sized literal table).  ``neighbours`` takes the minority label by group
    and gives ``(group.., key, _nn)``, the keys of each minority row's neighbours;
    ``df`` is then rows of a written table, or little more."""
    g = list(group_cols)
    df = df.select(*g, key, label, F.col(vec).cast("array<double>").alias(vec))
    if neighbours is None:
        df = materialise(df, "smote-rows")   # read by 5 jobs
    counts = df.groupBy(*g, label).agg(F.count(F.lit(1)).alias("n")).collect()
    per: dict[tuple, dict] = {}
    for r in counts:
        per.setdefault(tuple(r[c] for c in g), {})[r[label]] = r["n"]
    plan = []                        # (group values, minority label, n_min, n_syn, offset)
    offset = 0
    for gk in sorted(per, key=repr):
        c = per[gk]
        mino_label = minority if minority is not None else min(c, key=lambda v: (c[v], str(v)))
        n_syn = max(c.values()) - c.get(mino_label, 0)
        plan.append((gk, mino_label, c.get(mino_label, 0), n_syn, offset))
        offset += n_syn
    alone = [gk for gk, _, n_min, n_syn, _ in plan if n_syn and n_min < 2]
    if alone:
        raise ValueError(f"oversampling needs two minority rows; groups with fewer: {alone}")
    spark = df.sparkSession
    ltype = df.schema[label].dataType.simpleString()
    gschema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in g)
    info = spark.createDataFrame([(*gk, ml, nm, ns, off) for gk, ml, nm, ns, off in plan],
                                 (gschema + ", " if g else "") + f"_ml {ltype}, _nmin long, _nsyn long, _off long")
    # minority rows of each group (the info side has one row per group)
    if g:
        mino = (df.join(F.broadcast(info.select(*g, "_ml")), g)
                .where(F.col(label) == F.col("_ml")).select(*g, key, vec))
    else:
        mino = df.where(F.col(label) == F.lit(plan[0][1] if plan else None)).select(key, vec)
    if neighbours is None:
        neigh = knn(mino, key, vec, k, g).select(*g, F.col(key).alias("base_key"), "rank", "nn_key")
    else:
        mino = materialise(mino, "smote-minority")
        lists = neighbours({gk: ml for gk, ml, _, _, _ in plan}).select(*g, F.col(key).alias("base_key"), "_nn")
    pos = hash_positions(mino, g, key, seed=f"smote{seed}").select(*g, key, vec, F.col("_pos").alias("_bp"))
    # synthetic ids: one range over all groups, mapped to a group by offsets
    gidx = None
    for i, (_, _, _, _, off) in enumerate(plan):
        cond = F.col("id") >= F.lit(off)
        gidx = F.when(cond, F.lit(i)) if gidx is None else F.when(cond, F.lit(i)).otherwise(gidx)
    slices = max(spark.sparkContext.defaultParallelism, offset // 1_000_000 + 1)
    ids = spark.range(0, offset, 1, slices).withColumn("_gi", gidx if gidx is not None else F.lit(0))
    gi_info = spark.createDataFrame([(i, *gk, nm, off) for i, (gk, _, nm, _, off) in enumerate(plan)],
                                    "_gi int" + (", " + gschema if g else "") + ", _nmin long, _off long")
    ids = ids.join(F.broadcast(gi_info), "_gi").withColumn("syn_id", F.col("id") - F.col("_off"))
    draw_parts = [*g, "syn_id"]
    syn = ids.select(*g, "syn_id",
                     pick(*draw_parts, seed=f"base{seed}", n=F.col("_nmin")).alias("_bp"),
                     (pick(*draw_parts, seed=f"rank{seed}", n=F.least(F.lit(k), F.col("_nmin") - 1)) + 1).cast("int").alias("rank"),
                     uniform(*draw_parts, seed=f"gap{seed}").alias("gap"))
    s = syn.join(pos, [*g, "_bp"]).withColumnRenamed(key, "base_key")
    if neighbours is None:
        s = s.join(neigh, [*g, "base_key", "rank"])
    else:   # a row without that many neighbours has none of the rank
        s = s.join(lists, [*g, "base_key"]).withColumn("nn_key", F.try_element_at("_nn", F.col("rank"))).where(F.col("nn_key").isNotNull())
    nn_vec = mino.select(*g, F.col(key).alias("nn_key"), F.col(vec).alias("_nv"))
    if g:
        s = s.join(nn_vec, [*g, "nn_key"]).join(F.broadcast(info.select(*g, "_ml")), g)
    else:
        s = s.join(nn_vec, "nn_key").withColumn("_ml", F.lit(plan[0][1] if plan else None))
    new = F.zip_with(F.col(vec), F.col("_nv"), lambda a, b: a + F.col("gap") * (b - a))
    ktype = df.schema[key].dataType
    synth = s.select(*g, F.lit(True).alias("synthetic"), "syn_id", "base_key", "nn_key", F.lit(None).cast(ktype).alias(key),
                     F.col("_ml").cast(df.schema[label].dataType).alias(label), new.alias(vec))
    orig = df.select(*g, F.lit(False).alias("synthetic"), F.lit(None).cast("long").alias("syn_id"),
                     F.lit(None).cast(ktype).alias("base_key"), F.lit(None).cast(ktype).alias("nn_key"), key, label, vec)
    return orig.unionByName(synth)


def balance_before_after(distribution: DataFrame) -> DataFrame:
    """The class counts before oversampling, and after it, when every class
    has as many rows as the largest: no neighbour is needed to count."""
    d = distribution.select("class", "label_text", F.col("n").alias("_n"), F.max("n").over(Window.partitionBy(F.lit(0))).alias("_most"),
                            F.min("n").over(Window.partitionBy(F.lit(0))).alias("_least"))      # k class rows
    grown = F.when(F.col("_n") == F.col("_least"), F.col("_most")).otherwise(F.col("_n"))
    long = d.select("class", "label_text", F.explode(F.array(F.struct(F.lit("before").alias("stage"), F.col("_n").alias("n")),
                                                             F.struct(F.lit("after").alias("stage"), grown.alias("n")))).alias("x"))
    total = F.sum("x.n").over(Window.partitionBy("x.stage"))
    return long.select("class", "label_text", F.col("x.n").alias("n"), F.round(100.0 * F.col("x.n") / total, 4).alias("pct"), F.col("x.stage").alias("stage"))


def hash_tables(threshold: float, bits: int, miss: float) -> int:
    """Tables of ``bits`` random hyperplanes with which a pair at the threshold
    shares no bucket with probability ``miss`` at most."""
    same = (1.0 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log(1.0 - same))) if same < 1 else 1


def _indexed(left: DataFrame, right: DataFrame, key: str, vec: str, threshold: float, seed: int):
    """Points and vectors of both sides, and the pivot index of the right one.
    Vectors with a null component are similar to nothing and left out."""
    from riskframe.operators import pivots as V
    if threshold < -1:
        raise ValueError("threshold below -1 matches every pair; use a full scan instead")
    dim = vector_dim(left.select(vec).unionByName(right.select(vec)), vec)
    (lp, lv), (rp, rv) = V.unit_vectors(left, key, vec, "left"), V.unit_vectors(right, key, vec, "right")
    lv, rv = (v.where(F.col("u").isNotNull() & ~F.exists("u", lambda x: x.isNull())) for v in (lv, rv))
    return dim, lp, lv, rp, rv, V.build_index(rv, dim, seed)


def similar_pairs(left: DataFrame, right: DataFrame, key: str, vec: str, threshold: float, seed: int = 42) -> DataFrame:
    """R5 core: (left, right) pairs with cosine similarity > threshold.

    Copies are one vector.  Exact: ``cos > t  <=>  ||a - b|| < sqrt(2 - 2t)``,
    so a left vector meets the blocks of a pivot index of the right side whose
    distance range that leaves open; blocks are compared by matrix products."""
    from riskframe.operators import pivots as V
    dim, lp, lv, rp, rv, index = _indexed(left, right, key, vec, threshold, seed)
    found = V.links_above(index, lv.select(F.col("i").alias("q"), "u"), dim, float(threshold))
    # keys are brought to the vectors first, so that pairs, which may be many, meet two tables and not four
    left_keys = lv.select(F.col("i").alias("q"), "vid").join(lp.select(F.col(key).alias("left_key"), "vid"), "vid").select("q", "left_key")
    right_keys = rv.select("i", "vid").join(rp.select(F.col(key).alias("right_key"), "vid"), "vid").select("i", "right_key")
    return found.join(left_keys, "q").join(right_keys, "i").select("left_key", "right_key", "similarity")


def similar_counts(left: DataFrame, right: DataFrame, key: str, vec: str, threshold: float, seed: int = 42) -> DataFrame:
    """R5, for thresholds that most pairs may pass: every left row with the
    smallest key among its copies and the number of right rows more similar
    than ``threshold``: ``(key, class_id, n_links)``."""
    from riskframe.operators import pivots as V
    dim, lp, lv, _, _, index = _indexed(left, right, key, vec, threshold, seed)
    found = V.links_above(index, lv.select(F.col("i").alias("q"), "u"), dim, float(threshold), count=True)
    linked = lv.select(F.col("i").alias("q"), "vid").join(found, "q").select("vid", "n")
    rows = lp.join(linked, "vid", "left").select(key, F.col("vid").alias("class_id"), F.coalesce("n", F.lit(0).cast("long")).alias("n_links"))
    empty = left.where(F.col(vec).isNull()).select(key)      # one class, without links
    return rows.unionByName(empty.crossJoin(F.broadcast(empty.agg(F.min(key).alias("class_id")))).select(key, "class_id", F.lit(0).cast("long").alias("n_links")))


def leakage_report(test: DataFrame, train: DataFrame, key: str, vec: str, threshold: float = 0.95,
                   digits: int = 6) -> DataFrame:
    """Per test row with a train row above the threshold, its best
    similarity and number of matches (rows without a match are not
    leaking and are counted in :func:`leakage_summary`)."""
    p = similar_pairs(test, train, key, vec, threshold)
    return p.groupBy(F.col("left_key").alias(key)).agg(
        F.round(F.max("similarity"), digits).alias("max_similarity"), F.count(F.lit(1)).alias("n_matches"))


def leakage_summary(test: DataFrame, train: DataFrame, key: str, vec: str, threshold: float = 0.95,
                    digits: int = 6) -> DataFrame:
    """Rows on each side, test rows flagged (similarity > threshold) and
    the best similarity among them - one aggregation over the tagged union
    of the three inputs (no join)."""
    rep = leakage_report(test, train, key, vec, threshold, digits)
    tagged = (test.select(F.lit("test").alias("_side"), F.lit(None).cast("double").alias("_s"))
              .unionByName(train.select(F.lit("train").alias("_side"), F.lit(None).cast("double").alias("_s")))
              .unionByName(rep.select(F.lit("flag").alias("_side"), F.col("max_similarity").alias("_s"))))
    return tagged.agg(F.count_if(F.col("_side") == "test").alias("n_test"),
                      F.count_if(F.col("_side") == "train").alias("n_train"),
                      F.count_if(F.col("_side") == "flag").alias("n_flagged"),
                      F.max("_s").alias("max_similarity")).withColumn("threshold", F.lit(float(threshold)))
