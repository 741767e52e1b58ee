import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from riskframe.llm import exact_dedup as D


def corpus():
    rng = random.Random(7)
    texts = ["", None, " \t\n\x0b\x0c\r", "a b", "ab", "a\tb ", "é漢 x", "é漢x", "\xa0", "x" * 3000, "x " * 3000, "x" * 2999]
    for _ in range(60):
        base = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 60)))
        texts += [base, base[:3] + " " + base[3:], base[:-1] + "c"][:rng.randrange(1, 4)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(3, "a b"), (4, "other text"), (None, "ab"), (None, "only here"), (None, "only here")]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for key, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        out += [(m[2], keep, len(members), hashlib.sha256(key.encode()).hexdigest()) for m in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("block_chars", [3, 7, 4096])
def test_equals_brute_force(spark, docs_of, block_chars):
    rows = corpus()
    got = D.exact_dedup(docs_of(rows), block_chars=block_chars).collect()
    want, groups = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == groups and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_colliding_keys_take_another_seed(spark, docs_of, monkeypatch):
    def weak(block, seed):
        return [F.xxhash64(F.lit(seed), block) % (3 if seed < 2 else 1 << 40), F.lit(0)]
    monkeypatch.setattr(D, "_key", weak)
    rows = corpus()
    got = D.exact_dedup(docs_of(rows), block_chars=7).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)[0]


def test_kept_rows_return_with_their_columns(spark, docs_of):
    docs = docs_of(corpus())
    kept = D.keep_first_copies(docs)
    assert kept.columns == docs.columns
    want = {}
    for i, t in corpus():
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        order = (-len(t or ""), i is None, i or 0)
        if key not in want or order < want[key][0]:
            want[key] = (order, (i, t))
    assert sorted(((r.doc_id, re.sub(r"[\x20\x09-\x0D]", "", r.text or "")) for r in kept.collect()), key=str) == sorted(((v[1][0], k) for k, v in want.items()), key=str)


def test_empty_table(spark, docs_of):
    docs = docs_of([(1, "a")]).where("false")
    assert D.exact_dedup(docs).count() == 0 and D.keep_first_copies(docs).count() == 0
