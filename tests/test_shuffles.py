"""Packed shuffles against a shuffle of every (feature, repeat) by hand."""

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as V
from riskframe.operators import shuffles as S

COEFS, INTERCEPT = {"a": "0.5", "b": "-0.00001", "c": "0.25"}, "-1.00001"


def draw(text, seed):
    return int(hashlib.md5(f"{text}|{seed}".encode()).hexdigest()[:8], 16)


def brute(rows, repeats, seed):
    """``{(feature, repeat): (n, base, new)}``."""
    def hit(z, y):
        return y is not None and (2 if z is not None and z > 0 else 1) == y
    out, feats = {}, list(COEFS)
    score = {r["k"]: None if None in [r[f] for f in feats] else Decimal(INTERCEPT) + sum(Decimal(COEFS[f]) * r[f] for f in feats) for r in rows}
    for f in feats:
        for rep in range(1, repeats + 1):
            at = [sorted(rows, key=lambda r: (draw(f"{r['k']}|{f}|{rep}", f"{side}{seed}"), f"{r['k']}|{f}|{rep}")) for side in ("dst", "src")]
            new = 0
            for r, s in zip(*at):
                z = None if score[r["k"]] is None or s[f] is None else score[r["k"]] + Decimal(COEFS[f]) * (s[f] - r[f])
                new += hit(z, r["y"])
            out[f, rep] = (sum(r["y"] is not None for r in rows), sum(hit(score[r["k"]], r["y"]) for r in rows), new)
    return out


def table(n=500):
    rnd = np.random.default_rng(3)
    rows = [{"k": i * 7, "y": int(rnd.integers(1, 3)), **{f: Decimal(int(rnd.integers(-900, 900))) / 100 for f in COEFS}} for i in range(n)]
    rows += [{"k": 1_000_000 + i, "y": y, "a": a, "b": b, "c": Decimal(1)} for i, (y, a, b) in enumerate(
        [(None, Decimal(1), Decimal(2)), (2, None, Decimal(2)), (1, Decimal(3), None), (3, Decimal(4), Decimal(1)), (2, Decimal("1.50002"), Decimal(0))])]
    return rows


@pytest.mark.parametrize("chunk_rows, task_rows", [(S.CHUNK_ROWS, S.TASK_ROWS), (16, 700)])
def test_hits_equal_shuffles_by_hand(spark, monkeypatch, chunk_rows, task_rows):
    monkeypatch.setattr(S, "CHUNK_ROWS", chunk_rows)
    monkeypatch.setattr(S, "TASK_ROWS", task_rows)
    rows = table()
    df = spark.createDataFrame(rows, "k long, y int, a decimal(12,2), b decimal(12,2), c decimal(12,2)").repartition(3)
    terms = {f: F.lit(w).cast("decimal(20,10)") * F.col(f) for f, w in COEFS.items()}
    found = S.shuffle_hits(df, "k", "y", terms, F.lit(INTERCEPT).cast("decimal(20,10)"), V.linear_score(COEFS, INTERCEPT, "decimal(12,2)"), 2, 1, 3, 42)
    assert {(r["feature"], r["repeat"]): (r["n"], r["base"], r["new"]) for r in found.collect()} == brute(rows, 3, 42)


def test_equal_draws_go_by_text():
    def value(text):
        return (bytes(16) + (bytes([S.HAS_TEXT]) + text.encode() if text is not None else b"\0"))
    texts = ["12", "9", "123", None, "1"]
    p = np.array([5, 3, 5, 5, 5], np.int64) | (1 << 32)
    order = S.ordered(p, pa.chunked_array([[value(t) for t in texts[:2]], [value(t) for t in texts[2:]]], pa.binary()), {1: "a|1"})
    names = ["a|1" if t is None else f"{t}|a|1" for t in texts]
    assert order[0] == 1 and [names[i] for i in order[1:]] == sorted(names[i] for i in (0, 2, 3, 4))


def test_exact_sums():
    pairs = [("0.000000000001", "0"), ("-0.5", "0.5"), ("-0.5", "0.500000000001"), ("-1.25", "-3"), ("123456789.9", "-123456789.900000000001"), ("0", None)]

    def parts(x):
        if x is None:
            return S._NONE, 0
        whole = int(Decimal(x) * S.UNIT)
        return whole // S.UNIT, whole % S.UNIT
    cols = [np.array(c, np.int64) for c in zip(*[(*parts(a), *parts(b)) for a, b in pairs])]
    assert S.positive_sums(*cols).tolist() == [True, False, True, False, False, False]


def test_a_written_row_is_a_chunk(spark, monkeypatch):
    """No table has a row per row, feature and repeat."""
    written = []
    own = S.materialise
    monkeypatch.setattr(S, "materialise", lambda df, name: written.append((name, own(df, name))) or written[-1][1])
    df = spark.createDataFrame(table(), "k long, y int, a decimal(12,2), b decimal(12,2), c decimal(12,2)")
    V.permutation_importance(df, "k", "y", COEFS, INTERCEPT, repeats=4).collect()
    assert {name: t.count() for name, t in written} == {"shuffle-rows": 505, "shuffle-chunks": 2 * 3 * 4, "shuffle-cuts": 3 * 4}
