import random
import re

import pytest

from riskframe.llm import decontaminate as D

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    ws, hit, ids, longest = words(text), set(), set(), set()
    for item, t in items:
        ts = words(t)
        if item is None or not ts:
            continue
        size = min(window, len(ts))
        for a in range(len(ts) - size + 1):
            for i in range(len(ws) - size + 1):
                if ws[i:i + size] == ts[a:a + size]:
                    hit.update(range(i, i + size))
                    ids.add(item)
                    if a == 0 or i == 0 or ws[i - 1] != ts[a - 1]:
                        n = size
                        while a + n < len(ts) and i + n < len(ws) and ws[i + n] == ts[a + n]:
                            n += 1
                        longest.add((item, a, i, n))
    return len(ws), len(hit), sorted(ids), sorted(longest)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c d é 漢 the of".split()) + rng.choice(["", "x", "Y"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 8, 10, 25, 60])))) for i in range(100, 120)]
    items += [(100, items[5][1]), (None, items[6][1]), (130, None), (131, "!!"), (132, items[7][1])]
    texts = ["", None, "?", "a"]
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            ts = words(rng.choice(items)[1])
            cut = rng.randrange(len(ts) + 1)
            parts.append(" ".join(ts[cut // 2:cut // 2 + rng.randrange(5, 70)]).title())
            parts.append(" ".join(f"q{rng.randrange(99)}" for _ in range(rng.randrange(6))))
        texts.append(rng.choice([" ", "\n", ", "]).join(parts))
    return [*enumerate(texts), (7, texts[9]), (None, texts[8])], items


@pytest.mark.parametrize("window,block_words", [(10, 10 ** 6), (4, 60)])
def test_equals_brute_force(spark, docs_of, window, block_words):
    rows, items = corpus(window)
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows).withColumnRenamed("n_tokens", "n_words")
    got = D.find_contamination(docs, bench, window=window, block_words=block_words).collect()
    assert len(got) == len(rows) and any(r.n_hit for r in got)
    for r in got:
        found = (r.n_words, r.n_hit, r["items"], [tuple(m) for m in r.longest_matches])
        assert found == brute(r.text, items, window), r.text
    clean = D.decontaminate(docs, bench, window=window)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in clean.collect()) == sorted((r.doc_id is None, r.doc_id or 0) for r in got if not r.n_hit)


def test_text_ids_and_no_items(spark, docs_of):
    docs = docs_of([(1, "one two three"), (2, None)])
    bench = spark.createDataFrame([("b", "Two, three"), ("a", "one")], "item_id string, text string")
    assert sorted((r.doc_id, r.n_hit, r["items"]) for r in D.find_contamination(docs, bench).collect()) == [(1, 3, ["a", "b"]), (2, 0, [])]
    assert sorted((r.n_words, r.n_hit) for r in D.find_contamination(docs, bench.where("false")).collect()) == [(0, 0), (3, 0)]
    assert D.find_contamination(docs.where("false"), bench).count() == 0
