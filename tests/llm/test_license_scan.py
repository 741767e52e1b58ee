import random
import re

from riskframe.llm import license_scan as S
from riskframe.llm import queries as Q

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, block_words, stride, share):
    ws = words(text)
    places = []
    for label, phrase in S.PHRASES:
        p = words(phrase)
        places += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
    blocks = []
    starts = [0]
    while starts[-1] + block_words < len(ws):
        starts.append(starts[-1] + stride)
    for start in starts:
        held = set(ws[start:start + block_words])
        for label, notice in S.NOTICES:
            n = set(words(notice))
            if share[1] * len(n & held) >= share[0] * len(n):
                blocks.append((start, label, len(n & held) / len(n)))
    return len(ws), sorted(places), sorted(blocks)


def corpus(seed):
    rng = random.Random(seed)
    notices = [t for _, t in S.NOTICES + S.PHRASES]
    texts = ["", None, "!!", "CC BY-NC", "cc by\nnc cc by nc", "Under the MIT\n\nLicense.", "ünder the mit license", "mit license the under"]
    filler = "the of and license software is to by under work this 2 version été 漢字 x9".split()
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            if rng.random() < 0.3:
                w = rng.choice(notices).split()
                if rng.random() < 0.5:
                    for _ in range(rng.randrange(1, 4)):
                        w[rng.randrange(len(w))] = rng.choice(filler)
                if rng.random() < 0.2:
                    rng.shuffle(w)
                parts.append(rng.choice([" ", ", ", "\n"]).join(w).title())
            else:
                parts.append(" ".join(rng.choice(filler) for _ in range(rng.randrange(40))))
        texts.append(". ".join(parts))
    return texts


def test_equals_brute_force(spark, docs_of):
    rows = [*enumerate(corpus(4)), (4, "again apache license version 2"), (None, "cc by nc")]
    longest = max(len(words(t)) for _, t in S.PHRASES + S.NOTICES)
    docs = docs_of(rows).withColumnRenamed("n_tokens", "n_words").withColumnRenamed("score", "blocks")
    for block_words in (64, 50):
        got = S.license_scan(docs, block_words=block_words).collect()
        assert len(got) == len(rows)
        size = max(block_words, 2 * longest)
        for r in got:
            n, places, blocks = brute(r.text, size, size - longest + 1, S.DEFAULT_CONTAINMENT)
            assert r.n_words == n and [(p.start, p.label) for p in r.phrases] == places
            assert sorted({(b.start, b.label, b.containment) for b in r.blocks}) == sorted(set(blocks)), r.text


def test_query_digest(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = Q.op5_license_scan(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs) and sum(r.n_base > 0 for r in got) > 5
    for r in got:
        n, places, _ = brute(docs[r.doc_id], 10 ** 9, 1, S.DEFAULT_CONTAINMENT)
        starts = [s for s, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_empty_table(spark, docs_of):
    assert S.license_scan(docs_of([(1, "a")]).where("false")).count() == 0
