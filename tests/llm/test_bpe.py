import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from riskframe.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = ["", None, " ", "  ", "\n", " \n x", "a  b", "a \n b\n\nc ", "don't we'll 'S 's!!'s ' s", "x<|endoftext|> y<|endoftext|>", "<|endoftext|",
           "é ́x ño ½²", "漢字かな 🤖🤖 ١٢٣ Ⅷ", "\x1c \x1d\x85 \xa0   x　y ​ z", "x" * 9000, "ab" * 5000, "!" * 300 + " ?", "tab\tline\r\n\x0b\x0c ", "﻿a", "trailing  "]


def texts(n=300, seed=3):
    rng = random.Random(seed)
    alphabet = "abcDE éß'st .,!\n\t  0123 ́ 漢<|>\xa0 "
    return AWKWARD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_units_hold_the_pieces():
    for t in texts(3000):
        t = t or ""
        assert "".join(B.units(t)) == t
        assert [p for u in B.units(t) for p in B.PIECES.findall(u)] == B.PIECES.findall(t), repr(t)


def test_lexicon_is_exact_and_minimal(tmp_path):
    rng = random.Random(5)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 7))) for _ in range(400)})
    held = {w: [i, i + 1] for i, w in enumerate(words) if i % 3}
    (tmp_path / "lex").write_bytes(B.compile_lexicon(held.items()))
    lex = B.Lexicon(str(tmp_path / "lex"))
    for w, place in zip(words, lex.find(words)):
        assert (np.frombuffer(lex.ids_at(place), "<i4").tolist() if place >= 0 else None) == held.get(w)
    assert lex.find([b"", b"zz", b"a" * 50]) == [-1, -1, -1 if b"a" * 50 not in held else 0]
    # minimal: as many states as there are distinct right languages
    right = set()
    prefixes = {w[:i] for w in held for i in range(len(w) + 1)}
    for p in prefixes:
        right.add(frozenset(w[len(p):] for w in held if w.startswith(p)))
    assert lex.n_states == len(right)


def test_merging_together_equals_one_by_one():
    vocab, library = B.vocabulary(PATH), Tokenizer.from_file(PATH)
    pieces = sorted({p for t in texts(2000) for p in B.PIECES.findall((t or "").replace("<|endoftext|>", ""))})
    pieces += ["a" * n for n in range(1, 90)] + ["theres" * n for n in range(1, 14)]
    got = vocab.merge_all([p.encode() for p in pieces])
    for p, ids in zip(pieces, got):
        want = np.frombuffer(ids, "<i4").tolist()
        assert want == vocab.merge(p.encode())
        if len(B.PIECES.findall(p)) == 1:
            assert want == library.encode(p, add_special_tokens=False).ids
    assert vocab.merge_all([]) == [] and vocab.merge_all([b""]) == [b""]


def test_empty_lexicon(tmp_path):
    (tmp_path / "lex").write_bytes(B.compile_lexicon([]))
    assert B.Lexicon(str(tmp_path / "lex")).find([b"a", b""]) == [-1, -1]


def test_encode_and_decode_equal_the_library(spark, docs_of):
    rows = list(enumerate(texts(500))) + [(3, "three again"), (None, "no id")]
    docs = docs_of(rows).withColumnRenamed("score", "token_ids")
    library = Tokenizer.from_file(PATH)
    for words in (0, 40, 5000):
        name = B.build_lexicon(docs, PATH, max_words=words)
        got = B.encode(docs, PATH, name, decoded_col="decoded").collect()
        assert len(got) == len(rows)
        for r in got:
            want = library.encode(r.text or "", add_special_tokens=False).ids
            assert r.token_ids == want, repr(r.text)
            assert r.decoded == library.decode(want, skip_special_tokens=False) == (r.text or "")
    again = B.decode_column(B.encode(docs, PATH, name), PATH).collect()
    assert all(r.decoded == (r.text or "") for r in again)


def test_ids_that_are_no_text():
    vocab, library = B.vocabulary(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(6))]
        assert B.decode(vocab, ids) == library.decode(ids, skip_special_tokens=False)


def test_empty_table(spark, docs_of):
    docs = docs_of([(1, "a")]).where("false")
    assert B.encode(docs, PATH, B.build_lexicon(docs, PATH)).count() == 0
