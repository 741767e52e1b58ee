"""The audit against a simulation of every order."""

import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from riskframe.llm.filter_audit import audit_documents, interaction_audit, removal_intervals

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(rows):
    """Letters failed by each (id, text, part)."""
    ids = {}
    for i, t, _ in rows:
        if i is not None:
            ids.setdefault(t or "", []).append(i)
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        out.append(f + "D" * bool(re.search(r"[#$%&*|]", t)) + "E" * (i is not None and any(j < i for j in ids[t])))
    return out


def simulate(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    fails, out, shapley = failures(rows), {}, Counter()
    for part in {p or "" for _, _, p in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, fails) if (p or "") == part]
        for order in permutations("ABCDE"):
            left = list(own)
            for step, c in enumerate(order, 1):
                here = [x for x in left if c in x[1]]
                left = [x for x in left if c not in x[1]]
                shapley[part, c] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(c in f for _, f in own) - len(here), sum(f == c for _, f in own),
                    sum(i in good for i, _ in here if i is not None), sum(i in toxic for i, _ in here if i is not None)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_intervals_cover_every_order():
    for mask in range(32):
        seen = Counter(r for lo, hi, _ in removal_intervals(mask, 5) for r in range(lo, hi))
        assert seen == Counter(range(120) if mask else ())
        for lo, hi, step in removal_intervals(mask, 5):
            for rank, order in enumerate(permutations(range(5))):
                if lo <= rank < hi:
                    assert [mask >> f & 1 for f in order[:step]] == [0] * (step - 1) + [1]


def test_audit_against_a_simulation(spark):
    long, poor = " ".join(f"w{i}" for i in range(250)), "same words " * 150
    rows = [(1, long, "a"), (2, long, "b"), (3, None, "a"), (4, "", None), (5, "SHOUT & more", "a"), (6, poor, "b"), (7, poor + "#", "b"), (8, long, "a"),
            (9, long.upper(), ""), (9, long.upper(), ""), (10, "\x0b \x1c\t", "c"), (None, long, "a"), (None, long, "a"), (11, "Ä|é" * 5, "c"), (12, long, "b"), (0, long, "c")]
    rows += [(100 + i, "copied text", "hot") for i in range(60)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, None, 1), (6, 1, None), (99, 1, 1), (None, 1, 1), (9, 1, 1), *((100 + i, i % 2, i % 3 == 0 and 1 or 0) for i in range(30))]
    docs = spark.createDataFrame([(i, t, p, 1, 2, 3) for i, t, p in rows], "doc_id long, text string, source string, part long, _mask long, step long").repartition(5)
    got = audit_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in got} == simulate(rows, labels)
    assert len(got) == 600 * len({p or "" for _, _, p in rows})


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audit_documents(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_other_filters_and_null_parts(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("p", 3), ("p", None)], "grp string, x int")
    got = interaction_audit(rows, "grp", {"L": F.col("x") < 2, "O": F.col("x") % 2 == 1}).collect()
    cells = {(r.grp, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got}
    assert cells[None, "LO", 1] == (1, 1, 0, 0, 1) and cells[None, "LO", 2] == (1, 0, 1, 0, 1)
    assert cells[None, "OL", 1] == (1, 1, 0, 0, 1) and cells["p", "OL", 1] == (1, 1, 0, 1, 2) and len(cells) == 8
