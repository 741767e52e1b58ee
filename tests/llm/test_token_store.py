import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from riskframe.llm import token_store as S

PATH = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = ["", None, " ", "a", "don't stop'll 'S 's!!'s", "a b\x1cc d\x85e", "é ́x ño", "<|endoftext|> x<|startoftext|>y",
           "STRASSE Straße ÀÉÎ ÿ µ ª º × ÷", "漢字かな 🤖🤖 ١٢٣ Ⅷ", "tab\tline\nfeed\x0b\x0c\r\n", "ΑΣ ΣΑΣ", "x" * 9000, "¿qué? ¡no!", "12 3.45 6e7", "İ I ı", "ﬁ ½ ²"]


def texts(n=300, seed=3):
    rng = random.Random(seed)
    alphabet = "abcDE éÉßñ'st .,!\n\t 0123 ́ 漢<|>"
    return AWKWARD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_word_ids_equal_the_library():
    library, ours = Tokenizer.from_file(PATH), S.WordIds(PATH, max_runs=50)
    for t in texts(2000):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(ours.encode((t or "").encode()), "<u4").tolist() == want, repr(t)


def test_shards_round_trip(spark, docs_of, tmp_path):
    rows = list(enumerate(texts())) + [(5, "five again"), (None, "no id"), (7, texts()[7])]
    docs = docs_of(rows)
    manifest = S.write_token_shards(docs, PATH, frame_tokens=64)
    got = S.read_token_shards(manifest, batch_bytes=500).collect()
    library = Tokenizer.from_file(PATH)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in
            sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))]
    got = sorted(got, key=lambda r: r.start)
    assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got] == want
    assert [r.start for r in got] == np.cumsum([0] + [len(w[1]) for w in want])[:-1].tolist()
    shard = next(r for r in manifest.collect() if r.n_docs > 20)
    reader = S.ShardReader(shard.path)
    at = int(reader.doc_ids[-1])
    assert [np.frombuffer(x, "<u4").tolist() for x in reader.find(at)] == [w for i, w in want if i == at]
    assert reader.find(10 ** 9) == []


def test_damage_is_found(spark, docs_of):
    path = S.write_token_shards(docs_of([(1, "some words here")], 1), PATH).first().path
    inner = path.removeprefix("file:")
    data = bytearray(open(inner, "rb").read())
    data[-13] ^= 1  # a byte of the checksum in the seek table
    open(inner, "wb").write(data)
    try:
        S.ShardReader(path).document(0)
    except ValueError:
        return
    raise AssertionError("the checksum was not verified")


def test_empty_table(spark, docs_of):
    manifest = S.write_token_shards(docs_of([(1, "a")]).where("false"), PATH)
    assert manifest.count() == 0 and S.read_token_shards(manifest).count() == 0


def test_crc_of_ids(spark, docs_of):
    from pyspark.sql import functions as F
    r = S.read_token_shards(S.write_token_shards(docs_of([(1, "the end")], 1), PATH)).select("ids", F.crc32("ids").alias("c")).first()
    assert r.c == zlib.crc32(bytes(r.ids))
