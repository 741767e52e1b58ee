"""The probing step of the signature lists hands on bounded pieces."""

import numpy as np
import pyarrow as pa

from riskframe.operators import signatures as S


def setting(queries=60, bits=6, dim=5):
    rng = np.random.default_rng(2)
    planes, x = rng.standard_normal((dim, bits)), rng.standard_normal((queries, dim))
    return x, rng.integers(0, 3, queries), planes, np.zeros(dim), S.cheapest_masks(np.linspace(0.1, 1, bits), 40)


def met(pieces, group):
    out = {}
    for first, sig, rows in pieces:
        for f, s, r in zip(first.tolist(), sig.tolist(), rows):
            assert f in r and (group[r] == group[f]).all() and (int(group[f]), s) not in out
            out[int(group[f]), s] = r.tolist()
    return out


def by_hand(x, group, planes, mean, masks):
    out = {}
    for n, v in enumerate(x):
        margin = (v - mean) @ planes
        order = np.argsort(np.abs(margin))
        own = sum(1 << b for b, m in enumerate(margin) if m >= 0)
        for mask in masks:
            out.setdefault((int(group[n]), own ^ sum(1 << int(order[b]) for b in np.flatnonzero(mask))), []).append(n)
    return out


def test_looks_are_those_of_each_query(monkeypatch):
    given = setting()
    want = by_hand(*given)
    assert met(S.looks(*given), given[1]) == want
    monkeypatch.setattr(S, "HELD_BYTES", 500)
    assert met(S.looks(*given), given[1]) == want


def test_pieces_are_bounded(monkeypatch):
    """A piece has the vectors of at most about ``HELD_BYTES``: its lists begin
    within that, so only the last one can pass it."""
    x, *rest = setting(queries=400)
    monkeypatch.setattr(S, "HELD_BYTES", 2000)
    pieces = list(S.looks(x, *rest))
    for _, _, rows in pieces:
        assert sum(len(r) for r in rows[:-1]) * (8 * x.shape[1] + 8) <= 2000
    assert len(pieces) > 50


def test_no_masks_is_one_list_a_group():
    x, group, planes, mean, _ = setting()
    found = met(S.looks(x, group, planes[:, :0], mean, np.zeros((1, 0), np.int8)), group)
    assert found == {(g, 0): np.flatnonzero(group == g).tolist() for g in range(3)}
    assert not list(S.looks(x[:0], group[:0], planes, mean, np.zeros((1, 6), np.int8)))


def test_group_numbers_keep_nulls_apart():
    batch = pa.RecordBatch.from_pydict({"a": ["x", None, "x", "y", None], "b": [1, 1, 2, 1, 1]})
    n = S.group_numbers(batch, ["a", "b"]).tolist()
    assert n[1] == n[4] and len({n[0], n[1], n[2], n[3]}) == 4
    assert S.group_numbers(batch, []).tolist() == [0] * 5
