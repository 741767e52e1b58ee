"""Interaction audit of filters over every order in which they can be applied.

A row fails some of ``n`` filters; its failures are a bit mask.  In an order of
the filters the row is removed by the first one that it fails.  The orders are
numbered lexicographically (Lehmer rank, 0 to n! - 1), so all orders that
begin alike are an interval of ranks, and a mask's removal by a given filter
at a given step covers a few such intervals: one per beginning of passed
filters that ends with a failed one.  The counts of a (part, mask) cell are
added at the first rank of each interval and taken off behind its last; a
running sum over the ranks then holds what each step of each order removes.

Rows are aggregated to at most ``2 ** n`` cells a part before anything is
fanned out, so the work behind the scan doesn't depend on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.store import table

MAX_FILTERS = 6  # 720 orders

# Fixed values of the audited conditions.
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 2
WORD_BREAK, CAPITALS, SYMBOLS = r"[\x20\x09-\x0D]+", "[^A-Z]+", r"[#$%&*|]"


def removal_intervals(mask: int, n: int) -> Iterator[tuple[int, int, int]]:
    """``(first rank, rank behind the last, step)`` of all orders of ``n``
    filters in which a row that fails ``mask`` is removed at ``step`` (from 1)."""
    def below(start: int, step: int, left: list[int]) -> Iterator[tuple[int, int, int]]:
        size = factorial(len(left) - 1) if left else 0
        for i, f in enumerate(left):
            at = start + i * size
            if mask >> f & 1:
                yield at, at + size, step
            else:
                yield from below(at, step + 1, left[:i] + left[i + 1:])
    yield from below(0, 1, list(range(n)))


def interaction_audit(rows: DataFrame, part: str, fails: Mapping[str, Column], lost: Mapping[str, Column] | None = None,
                      count: Column | None = None) -> DataFrame:
    """Counts of every step of every order of the filters, per part.

    ``fails`` maps a filter's letter to its failure condition (null: passed);
    letters are taken in sorted order.  ``lost`` maps the name of an output
    column to a condition whose rows are counted where they are removed (null:
    not counted).  ``count`` is how many documents a row stands for (1).

    One row per part, ``filter_order`` and ``step``, zeros included: ``kept``
    (after this step), ``removed`` (here), ``redundant`` (failing this step's
    filter, but removed before), ``unique_fails`` (failing this filter only),
    one column per ``lost``, and ``shapley`` (removed by this filter, summed
    over all orders at whatever step).  A null part is a part of its own; an
    empty table gives no row.  Other columns, whatever their names, are unused.
    """
    letters, n = sorted(fails), len(fails)
    if not 1 <= n <= MAX_FILTERS:
        raise ValueError(f"between 1 and {MAX_FILTERS} filters can be audited, not {n}")
    lost = dict(lost or {})
    spark = rows.sparkSession
    sums = ["_n", *(f"_lost{i}" for i in range(len(lost)))]
    mask = sum((F.when(fails[c], 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0))
    one = count if count is not None else F.lit(1).cast("long")
    cells = (rows.select(F.col(part).alias("_part"), mask.alias("_mask"), one.alias("_n"),
                         *(F.when(c, one).otherwise(0).alias(f"_lost{i}") for i, c in enumerate(lost.values())))
             .groupBy("_part", "_mask").agg(*(F.sum(c).alias(c) for c in sums)))
    cells = table(cells, "audit-cells")  # at most 2 ** n rows a part, read three times

    # the same few thousand numbers whatever the data: interval ends by mask, and the letters of each order
    ends = [(m, step, rank, sign) for m in range(1 << n) for lo, hi, step in removal_intervals(m, n)
            for rank, sign in ((lo, 1), (hi, -1)) if rank < factorial(n)]
    orders = [(rank, step, order[step - 1], "".join(order)) for rank, order in enumerate(permutations(letters)) for step in range(1, n + 1)]
    marks = (cells.join(F.broadcast(spark.createDataFrame(ends, "_mask int, step int, _rank int, _sign int")), "_mask")
             .select("_part", "step", "_rank", *((F.col("_sign") * F.col(c)).alias(c) for c in sums)))
    totals = cells.groupBy("_part").agg(F.sum("_n").alias("_total"), *(
        F.sum(F.when(which, F.col("_n")).otherwise(0)).alias(f"_{name}{c}") for i, c in enumerate(letters)
        for name, which in (("fails", F.col("_mask").bitwiseAND(1 << i) != 0), ("only", F.col("_mask") == 1 << i))))
    totals = table(totals, "audit-totals")
    grid = (totals.select("_part", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))).alias("_rank"))
            .select("_part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"), "_rank", *(F.lit(0).cast("long").alias(c) for c in sums)))
    ended = marks.unionByName(grid).groupBy("_part", "step", "_rank").agg(*(F.sum(c).alias(c) for c in sums)).repartition("_part")

    def over(*keys: str, order: str | None = None) -> Window:
        w = Window.partitionBy("_part", *keys)
        return w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0) if order else w

    removed = ended.select("_part", "step", "_rank", *(F.sum(c).over(over("step", order="_rank")).alias(c) for c in sums))
    named = removed.join(F.broadcast(spark.createDataFrame(orders, "_rank int, step int, _letter string, filter_order string")), ["_rank", "step"])
    whole = (named.withColumn("_gone", F.sum("_n").over(over("_rank", order="step")))
             .withColumn("shapley", F.sum("_n").over(over("_letter")))
             .join(totals.withColumnRenamed("_part", "_of"), F.col("_part").eqNullSafe(F.col("_of"))))

    def of_letter(name: str) -> Column:
        return F.coalesce(*(F.when(F.col("_letter") == c, F.col(f"_{name}{c}")) for c in letters))

    return whole.select(F.col("_part").alias(part), "filter_order", "step", (F.col("_total") - F.col("_gone")).alias("kept"), F.col("_n").alias("removed"),
                        (of_letter("fails") - F.col("_n")).alias("redundant"), of_letter("only").alias("unique_fails"),
                        *(F.col(f"_lost{i}").alias(name) for i, name in enumerate(lost)), "shapley")


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions A to D on a text (null: empty); see the fixed values."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    return {"A": F.size(words) < LEAST_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT_PERCENT * F.size(words),
            "C": 100 * F.length(F.regexp_replace(text, CAPITALS, "")) > MOST_CAPITALS_PERCENT * F.length(text),
            "D": text.rlike(SYMBOLS)}


def audit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                    quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """Audit the four conditions of :func:`text_failures` and E: the text
    equals that of a row with a smaller id anywhere in the table.

    Texts are compared by SHA-256; a null text is empty, a null part the empty
    string.  Rows with a null id never fail E, count for no other row's E and
    have no label.  Rows that share an id count each; they don't fail E for
    each other.  A document is good (toxic) if any of its label rows says 1.
    Texts are read once, into one narrow row each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("_text"))
    checks = text_failures(F.col("_text"))
    facts = table(d.select("_id", "part", F.unhex(F.sha2(F.encode("_text", "UTF-8"), 256)).alias("_digest"),
                           sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(checks.values())), F.lit(0)).alias("_fails")), "audit-facts")
    known = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
             .agg(F.max(F.coalesce(F.col(quality_col) == 1, F.lit(False))).alias("_good"), F.max(F.coalesce(F.col(toxic_col) == 1, F.lit(False))).alias("_toxic")))
    no = F.lit(False)
    told = facts.where(F.col("_id").isNotNull()).join(known, "_id", "left")
    told = told.unionByName(facts.where(F.col("_id").isNull()), allowMissingColumns=True)
    same = ["_digest", "part", "_fails", "_good", "_toxic"]
    told = told.select("_id", *same[:3], F.coalesce("_good", no).alias("_good"), F.coalesce("_toxic", no).alias("_toxic"))
    # copies collapse (per part and label) before they meet by digest, so a large group of copies is a few rows
    rows = told.groupBy("_id", *same).agg(F.count(F.lit(1)).alias("_n"))
    groups = rows.groupBy(*same).agg(
        F.sum("_n").alias("_all"), F.sum(F.when(F.col("_id").isNull(), F.col("_n")).otherwise(0)).alias("_unnamed"),
        F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_n"))).alias("_first"))
    least = F.min("_first._id").over(Window.partitionBy("_digest"))
    first = F.col("_unnamed") + F.when(F.col("_first._id") == F.col("_least"), F.col("_first._n")).otherwise(0)
    split = (groups.withColumn("_least", least).withColumn("_passed", first)
             .select("part", "_fails", "_good", "_toxic", F.explode(F.array(
                 F.struct(F.lit(False).alias("copy"), F.col("_passed").alias("n")),
                 F.struct(F.lit(True).alias("copy"), (F.col("_all") - F.col("_passed")).alias("n")))).alias("_x"))
             .where("_x.n > 0"))
    fails = {c: F.col("_fails").bitwiseAND(1 << i) != 0 for i, c in enumerate(checks)} | {"E": F.col("_x.copy")}
    return interaction_audit(split, "part", fails, {"good_lost": F.col("_good"), "toxic_lost": F.col("_toxic")}, F.col("_x.n"))
