import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from riskframe.llm import near_dedup as N
from riskframe.llm.store import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def shingles(text):
    w = [x.decode() for x in N.words_of(text.encode())]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A documents table with copies, near copies, benchmark passages, texts
    without letters, nulls and repeated rows."""
    rng = random.Random(8)
    words = ["the", "of", "and", "être", "le", "der", "und"] + ["".join(rng.choice("abcdeilnort") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([4, 12, 30]))) for i in range(8)]
    rows = [(i, text(rng.randrange(1, 120)), "en" if i % 2 else "fr", "s", 0) for i in range(120)]
    add = lambda t, lang="en": rows.append((len(rows), t, lang, "s", 0))
    for i in range(12):
        add(rows[i][1].replace(" ", "  "))
        add(rows[i + 20][1] + " extra")
        add(text(30) + " " + items[i % 8][1].title() + ". " + text(9))
    for t in (None, "", " \n", "123 !?", "12 34", None):
        add(t)
    rows.append(rows[3])
    rows.append((None, text(40), "en", "s", 0))
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages_against_brute_force(spark, folder):
    path, rows, items = folder
    docs, columns = spark.read.parquet(f"{path}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    held = rows
    for (name, stage), judge in zip(P.STAGES[:4], (letters, exact, near, clean)):
        docs = table(stage(spark, docs, path), "test")
        assert docs.columns == columns
        held = judge(held, items)
        assert sorted(map(str, (tuple(r) for r in docs.collect()))) == sorted(map(str, held)), name
    got = {r.doc_id: r for r in P.STAGES[4][1](spark, docs, path).collect()}
    assert len(got) == len(held)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t, *_ in held:
        assert got[i].token_ids == library.encode(t, add_special_tokens=False).ids
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def letters(rows, _):
    return [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]


def exact(rows, _):
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r[1])
        order = (-len(r[1]), r[0] is None, r[0] or 0)
        if key not in best or order < best[key][0]:
            best[key] = (order, r)
    return [r for _, r in best.values()]


def near(rows, _):
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    lowest = {}
    for i, r in enumerate(rows):
        k = (r[0] is None, r[0] or 0)
        lowest[root(i)] = min(lowest.get(root(i), k), k)
    return [r for i, r in enumerate(rows) if lowest[root(i)] == (r[0] is None, r[0] or 0)]


def clean(rows, items):
    windows = set()
    for _, t in items:
        w = WORD.findall(lower(t))
        n = min(10, len(w))
        windows |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1) if n}
    sizes = {len(w) for w in windows}
    return [r for r in rows if not any(tuple(w[i:i + n]) in windows for w in [WORD.findall(lower(r[1]))] for n in sizes for i in range(len(w) - n + 1))]


def test_run(spark, folder):
    path, rows, _ = folder
    out = P.run(spark, path)
    assert out.columns == ["doc_id", "n_tokens", "token_ids", "decoded_sha256"]
    assert 0 < out.count() < len(rows) and zlib.crc32(b"") == 0


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "river", "and", "stone", "house", "when", "evening", "came", "they", "walked", "home"]) for _ in range(n))


def test_language_drops_what_is_in_no_learned_language(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(1, 80)), "en", "mine", 0.5) for i in range(200)]
    noise = ["".join(rng.choice("qxjzkvwpbgf") for _ in range(600)), "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(900))]
    rows += [(1000 + i, t, None, "mine", 0.5) for i, t in enumerate([*noise, "xq", "42", None, "evening " * 60, "River."])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _predicted string, _score double").repartition(3)
    kept = P.language(spark, docs, "")
    assert kept.columns == docs.columns and kept.select("_predicted", "_score").distinct().collect() == [("mine", 0.5)]
    assert {r.doc_id for r in kept.collect()} == set(range(200)) | {1002, 1005, 1006}


def test_language_keeps_lettered_rows_if_none_was_learned(spark):
    rows = [(1, "some words", None), (2, "12", None), (3, None, None), (4, "é", None)]
    kept = P.language(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]
