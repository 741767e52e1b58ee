"""Packing: the linear program against its dual and full enumeration, the
pieces against the tokenizers library and the contract."""

import random
import zlib

import numpy as np
import pytest

from riskframe.llm import packing as P
from riskframe.llm.queries import BYTE_VOCABULARY, vocabulary


def test_knapsack_against_recursion():
    rng = np.random.default_rng(3)
    values = np.where(rng.random(41) < 0.5, rng.random(41), -np.inf)
    values[0] = -np.inf
    best, last = P.knapsack(values, 40)
    slow = [0.0]
    for c in range(1, 41):
        slow.append(max([slow[c - 1], *(values[l] + slow[c - l] for l in range(1, c + 1) if values[l] > -1)]))
    assert np.allclose(best, slow)
    pattern = P._pattern(last, 40)
    assert sum(l * k for l, k in pattern.items()) <= 40 and np.isclose(sum(values[l] * k for l, k in pattern.items()), best[40])


@pytest.mark.parametrize("seed", range(4))
def test_linear_program_is_optimal(seed):
    rng = random.Random(seed)
    size = 32
    histogram = {l: rng.randrange(1, 30) for l in rng.sample(range(3, 32), 9)}
    s = P.cutting_stock(histogram, size, gap=0.0)
    held = dict.fromkeys(histogram, 0.0)
    for pattern, used in zip(s.patterns, s.used):
        assert used >= 0 and sum(l * k for l, k in pattern.items()) <= size
        for l, k in pattern.items():
            held[l] += k * used
    assert all(abs(held[l] - n) < 1e-6 for l, n in histogram.items())
    # weak duality: no pattern at all is worth more than a sequence, so the prices bound every solution
    def patterns(lengths, room):
        if not lengths:
            yield 0.0
            return
        for k in range(room // lengths[0] + 1):
            for v in patterns(lengths[1:], room - k * lengths[0]):
                yield v + k * s.prices[lengths[0]]
    assert max(patterns(sorted(histogram), size)) <= 1 + 1e-6
    assert abs(sum(s.prices[l] * n for l, n in histogram.items()) - s.objective) < 1e-6


def check_plan(histogram, size):
    plan = P.make_plan(histogram, size)
    length = np.repeat(list(histogram), list(histogram.values())).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in histogram.values()]).astype(np.int64)
    doc, start, piece, seq, off = P.place_tails(plan, length, rank)
    fill = {}
    for s, o, n in sorted(zip(seq.tolist(), off.tolist(), piece.tolist())):
        assert fill.get(s, 0) == o
        fill[s] = o + n
    assert all(n == size or n & (n - 1) == 0 for n in fill.values())
    assert sorted(fill) == list(range(plan.n_sequences))
    at = {}
    for d, s, n in sorted(zip(doc.tolist(), start.tolist(), piece.tolist())):
        assert at.get(d, 0) == s and n > 0
        at[d] = s + n
    assert [at[d] for d in range(len(length))] == length.tolist()
    return plan


def test_plans_have_no_gap():
    rng = random.Random(5)
    check_plan({15: 40}, 16)                      # nothing fills a sequence: all are cut
    check_plan({8: 1}, 16)
    check_plan({1: 7}, 16)
    assert check_plan({700: 3000, 648: 1500}, 2048).stream == 0
    for _ in range(5):
        check_plan({l: rng.randrange(1, 40) for l in rng.sample(range(1, 64), 20)}, 64)
    whole = check_plan({int(l): int(n) for l, n in zip(*np.unique(np.random.default_rng(1).integers(1, 2048, 20_000), return_counts=True))}, 2048)
    assert whole.stream_sequences < 2047  # rounding costs at most a sequence a length, however many rows there are


def expected(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    t.no_truncation()
    t.no_padding()
    return [e.ids + [1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def texts():
    rng = random.Random(2)
    words = ["the", "Straße", "naïve", "12345", "漢字", "x", "don't", "\n\n", "  ", "🙂"]
    out = [None, "", " ", "a<|endoftext|>b", "<|endoftext|>", "�\x00", "word " * 2047, "word " * 2048, " " * 5000, "a" * 30_000, "\t \n" * 3000]
    return out + [" ".join(rng.choices(words, k=rng.randrange(1, 400))) for _ in range(120)] + ["same text here"] * 40


def test_pack_against_the_library(spark, docs_of):
    rows = list(enumerate(texts())) + [(3, "a repeated id, with a longer text"), (None, "no id")]
    ids = expected([t for _, t in rows])
    got = P.pack(docs_of(rows), vocabulary(BYTE_VOCABULARY), end_id=1).collect()
    sequences, documents = {}, {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert sequences.get(r.sequence_id, 0) == r.offset and r.length * 4 == len(r.ids) and zlib.crc32(r.ids) == r.ids_crc32
        sequences[r.sequence_id] = r.offset + r.length
        documents.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sequences.values()) and sorted(sequences) == list(range(len(sequences)))
    # the ids of documents with one id and length, in order of their pieces
    for (i, _), x in zip(rows, ids):
        pieces = sorted(documents[i, len(x)])
        assert b"".join(p for _, p in pieces) == np.array(x, "<u4").tobytes() and [s for s, _ in pieces] == np.cumsum([0, *(len(p) // 4 for _, p in pieces)])[:-1].tolist()
    assert sum(sequences.values()) == sum(map(len, ids))


def test_empty_table_and_large_ranks(spark, docs_of, monkeypatch):
    schema = "doc_id long, text string"
    assert P.pack(spark.createDataFrame([], schema), vocabulary(BYTE_VOCABULARY), end_id=1).count() == 0
    assert P.pack(spark.createDataFrame([(1, None)], schema), vocabulary(BYTE_VOCABULARY)).count() == 0
    monkeypatch.setattr(P, "BROADCAST_RANKS", 0)  # ranks by a shuffle
    rows = list(enumerate(texts()))
    got = P.pack(docs_of(rows), vocabulary(BYTE_VOCABULARY), end_id=1, size=64, with_ids=False).collect()
    assert "ids" not in got[0].asDict() and sum(r.length for r in got) == sum(map(len, expected([t for _, t in rows])))


def test_vocabulary_is_checked(tmp_path):
    P.check_vocabulary(vocabulary(BYTE_VOCABULARY))
    import json
    spec = json.load(open(vocabulary(BYTE_VOCABULARY), encoding="utf-8"))
    spec["model"]["merges"][0], spec["model"]["merges"][500] = spec["model"]["merges"][500], spec["model"]["merges"][0]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="don't follow"):
        P.check_vocabulary(str(path))
