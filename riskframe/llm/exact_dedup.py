"""Exact dedup by deterministic block naming (DataFrame operations only).

A document's text, without white space, is cut into blocks of a fixed size.
The distinct blocks of all documents are sorted into integer names; then the
distinct pairs of adjacent names are sorted into names again, level by level,
until each document is one name.  Two documents get the same (level, name)
exactly if their texts are equal: names are given to contents, not to hashes.

Block texts cross the shuffle once, for the sort that names them.  Documents
look their names up by a 128-bit key of the block; that the key tells all the
distinct blocks apart is checked on the whole table, and another seed is taken
until it does, so a collision cannot merge two texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import table

SPACES = r"[ \t\n\x0B\f\r]+"
DEFAULT_BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    """The text without space, tab, line feed, vertical tab, form feed and
    carriage return; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def _blocks(norm: Column, block_chars: int) -> Column:
    cut = F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(norm == "", F.array(F.lit(""))).otherwise(cut)


def _key(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + i), block) for i in (0, 1)]


def _named(distinct: DataFrame, by: list[str], keep: list[str], name: str) -> DataFrame:
    """Integer names from 1: each partition of the distinct contents is sorted,
    a name is the partition's number and the place in it.  The written table
    fixes the names for all later jobs."""
    ordered = distinct.sortWithinPartitions(*by)
    return table(ordered.select(*keep, (F.monotonically_increasing_id() + 1).alias("_name")), name)


def _name_blocks(norm: DataFrame, block_chars: int, max_seeds: int = 16) -> tuple[DataFrame, int]:
    """``(_h1, _h2, _name)`` of every distinct block, and the seed of the key."""
    for seed in range(max_seeds):
        h1, h2 = _key(F.col("_b"), seed)
        distinct = (norm.select(F.explode(_blocks(F.col("_norm"), block_chars)).alias("_b"))
                    .select(h1.alias("_h1"), h2.alias("_h2"), "_b").distinct())
        names = _named(distinct, ["_b"], ["_h1", "_h2"], "block-names")
        if names.groupBy("_h1", "_h2").count().where("count > 1").isEmpty():
            return names, seed
    raise RuntimeError("no seed of the block key is free of collisions")


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_chars: int = DEFAULT_BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``_rid`` (unique), ``_id``, ``_n_cp``, ``_sha``,
    ``_level`` and ``_name``; equal ``(_level, _name)`` means equal text."""
    norm = docs.select(F.col(id_col).alias("_id"),
                       F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("_n_cp"),
                       normalised(F.col(text_col)).alias("_norm"))
    names, seed = _name_blocks(norm, block_chars)
    keys = F.transform(_blocks(F.col("_norm"), block_chars),
                       lambda b: F.struct(*[k.alias(n) for k, n in zip(_key(b, seed), ("_h1", "_h2"))]))
    rows = table(norm.select(F.monotonically_increasing_id().alias("_rid"), "_id", "_n_cp",
                             F.sha2(F.encode("_norm", "UTF-8"), 256).alias("_sha"), keys.alias("_keys")),
                 "dedup-rows").withColumn("_n", F.size("_keys"))

    payload = ["_rid", "_id", "_n_cp", "_sha"]
    done = (rows.where("_n = 1").select(*payload, F.col("_keys")[0]["_h1"].alias("_h1"), F.col("_keys")[0]["_h2"].alias("_h2"))
            .join(names, ["_h1", "_h2"]).select(*payload, F.lit(0).alias("_level"), "_name"))

    # longer documents: name adjacent pairs, halving each document per level
    longest = rows.agg(F.max("_n")).first()[0] or 0
    current = (rows.where("_n > 1").select("_rid", "_n", F.posexplode("_keys").alias("_pos", "_k"))
               .select("_rid", "_n", F.col("_pos").cast("long").alias("_pos"), F.col("_k")["_h1"].alias("_h1"), F.col("_k")["_h2"].alias("_h2"))
               .join(names, ["_h1", "_h2"]).select("_rid", "_n", "_pos", "_name"))
    level, finished = 0, []
    while longest > 1:
        level += 1
        left = F.max(F.when(F.col("_pos") % 2 == 0, F.col("_name"))).alias("_a")
        right = F.coalesce(F.max(F.when(F.col("_pos") % 2 == 1, F.col("_name"))), F.lit(0)).alias("_z")
        pairs = table(current.groupBy("_rid", "_n", F.expr("_pos div 2").alias("_pos")).agg(left, right), "name-pairs")
        pair_names = _named(pairs.select("_a", "_z").distinct(), ["_a", "_z"], ["_a", "_z"], "pair-names")
        current = (pairs.join(pair_names, ["_a", "_z"])
                   .select("_rid", F.expr("cast((_n + 1) div 2 as int)").alias("_n"), "_pos", "_name"))
        finished.append(current.where("_n = 1").select("_rid", F.lit(level).alias("_level"), "_name"))
        current = current.where("_n > 1")
        longest = (longest + 1) // 2
    if finished:
        named = finished[0]
        for more in finished[1:]:
            named = named.unionByName(more)
        done = done.unionByName(rows.select(*payload).join(named, "_rid").select(*payload, "_level", "_name"))
    return done


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_chars: int = DEFAULT_BLOCK_CHARS) -> DataFrame:
    """Groups of equal texts (white space deleted), one row per input row.

    Returns ``(<id>, keep_id, group_size, kept, text_sha256)``.  Of a group,
    the row with the most code points in the original text stays, then the
    smallest id (a null id comes last).  Null text counts as empty; empty texts
    are one group.  Of rows repeated with the same id and text, one stays.  An
    empty table gives no rows; other columns of ``docs`` are not read.

    A group of copies, however large, meets only in partial aggregates; the
    groups are written before rows are joined to them, so that Spark can split
    the rows of a large one.
    """
    named = table(document_names(docs, id_col, text_col, block_chars), "document-names")
    first = F.min(F.struct((-F.col("_n_cp")).alias("n"), F.col("_id").isNull().alias("none"),
                           F.col("_id").alias("id"), F.col("_rid").alias("rid")))
    groups = table(named.groupBy("_level", "_name").agg(first.alias("_first"), F.count(F.lit(1)).alias("group_size")), "copy-groups")
    return (named.join(groups, ["_level", "_name"])
            .select(F.col("_id").alias(id_col), F.col("_first")["id"].alias("keep_id"), "group_size",
                    (F.col("_rid") == F.col("_first")["rid"]).alias("kept"), F.col("_sha").alias("text_sha256")))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are found again by id and content, so that of several rows with one id
    only the kept text returns; a row repeated as a whole returns once.
    """
    named = table(exact_dedup(docs, id_col, text_col).where("kept")
                  .select(F.col(id_col).alias("_k_id"), F.col("text_sha256").alias("_k_sha")), "kept-rows")
    same_id = F.col(id_col).eqNullSafe(F.col("_k_id"))
    if docs.groupBy(id_col).count().where("count > 1").isEmpty():
        return docs.join(named, same_id, "left_semi")
    sha = F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256)
    cp = F.char_length(F.coalesce(F.col(text_col), F.lit("")))
    hits = docs.withColumn("_sha", sha).join(named, same_id & (F.col("_sha") == F.col("_k_sha")), "left_semi")
    best = hits.groupBy(F.col(id_col).alias("_k_id"), F.col("_sha").alias("_k_sha")).agg(F.max(cp).alias("_k_cp"))
    longest = same_id & (F.col("_sha") == F.col("_k_sha")) & (cp == F.col("_k_cp"))
    return hits.join(best, longest, "left_semi").dropDuplicates([id_col, "_sha"]).drop("_sha")
