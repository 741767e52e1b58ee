import itertools
import random

import pytest

from riskframe.llm import near_dedup as N


def shingles(text):
    words = N.words_of((text or "").encode())
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    lowest = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            lowest[root(i)] = min(lowest.get(root(i), k), k)
    return sorted(((k, len(s), (lowest.get(root(i)) if s else k)) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(4))
    texts = ["", None, " \t\n", "One", "one", "one two three four", "ONE two\tthree four"]
    for _ in range(n // 6):
        base = [word() for _ in range(rng.randrange(5, 90))]
        texts.append(" ".join(base))
        for _ in range(5):  # chains of edits: neighbours are near, ends are not
            base = list(base)
            for _ in range(rng.randrange(0, 4)):
                base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
    rng.shuffle(texts)
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    return rows + [(rows[4][0], rows[4][1]), (rows[5][0], "another text with the id of row five"), (None, rows[9][1]), (None, "alone " * 7)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, docs_of, seed):
    rows = corpus(seed)
    got = N.near_dedup(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_group_of_near_copies(spark, docs_of):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"z{i}_{k}" for k in range(50))) for i in range(50)]
    got = {r.doc_id: r.component_id for r in N.near_dedup(docs_of(rows)).collect()}
    assert all(got[i] == 0 for i in range(400)) and all(got[1000 + i] == 1000 + i for i in range(50))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "_a long, _z long")
    got = {r._c: r._root for r in N.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_pruning_bound():
    # the tail probability below the bound is under the miss probability, at it above
    for n in (32, 64, 128):
        m = N.least_matches(n, 0.75, 1e-5)
        draws = sum(N.math.comb(n + 1, k) * 0.75 ** k * 0.25 ** (n + 1 - k) for k in range(m))
        assert draws < 1e-5 <= draws + N.math.comb(n + 1, m) * 0.75 ** m * 0.25 ** (n + 1 - m)


def test_empty_table(spark, docs_of):
    assert N.near_dedup(docs_of([(1, "a")]).where("false")).count() == 0


def test_common_passage_makes_no_pairs(spark, docs_of):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, passage + " " + " ".join(f"u{i}_{k}" for k in range(60))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + f" tail{i}") for i in range(0, 300, 7)]
    rng.shuffle(rows)
    docs = docs_of(rows)
    got = {r.doc_id: r.component_id for r in N.near_dedup(docs, n_hashes=128, bands=64).collect()}  # 2 hashes a band: large chance buckets
    assert got == {i: (i - 1000 if i >= 1000 else i) for i, _ in rows}
