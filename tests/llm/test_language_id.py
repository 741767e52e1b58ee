import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from riskframe.llm import language_id as L
from riskframe.llm import queries as Q

SF = "/root/testdata/sf0.001"


def plain_profile(text, dimensions):
    """The definition: letter by letter, n-gram by n-gram."""
    table = L.letters(dimensions)
    stream = [0]
    for c in text.lower():
        if c.isalpha():
            stream.append(ord(c))
        elif stream[-1] != 0:
            stream.append(0)
    if len(stream) == 1:
        return None
    if stream[-1] != 0:
        stream.append(0)
    total = np.zeros(dimensions)
    for i in range(len(stream) - 2):
        total += np.roll(table.vector(stream[i]), 2).astype(int) * np.roll(table.vector(stream[i + 1]), 1) * table.vector(stream[i + 2])
    return total


def test_equals_the_definition(spark, docs_of):
    rng = random.Random(2)
    texts = ["", None, "123 !!", "a", "É", "the cat's cat", "漢字 かな x", "ﬁn İstanbul", "x" * 5000, "a\x00b"]
    texts += ["".join(rng.choice("abcdeéñ 漢,.\n9") for _ in range(rng.randrange(80))) for _ in range(80)]
    langs = ["aa" if i % 3 else "bb" for i in range(len(texts))]
    langs[4] = langs[12] = None
    labelled = spark.createDataFrame(list(zip(texts, langs)), "text string, lang string").repartition(3)
    model = L.train(labelled, dimensions=64)
    assert model.names == ["aa", "bb"]
    wanted = {}
    for t, lang in zip(texts, langs):
        p = plain_profile(t or "", 64)
        if lang and p is not None:
            wanted[lang] = wanted.get(lang, 0) + p
    for name, v in zip(model.names, model.vectors):
        assert np.allclose(v, wanted[name] / np.linalg.norm(wanted[name]), atol=1e-6)
    docs = docs_of([*enumerate(texts), (3, "again a"), (None, "no id")])
    for r in L.predict(docs, model).collect():
        p = plain_profile(r.text or "", 64)
        if p is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            cosine = [p @ v / max(np.linalg.norm(p), 1e-9) for v in model.vectors]
            assert abs(r.score - min(1, max(0, max(cosine)))) < 1e-5
            assert cosine[model.names.index(r.lang_pred)] > max(cosine) - 1e-5


def test_held_out_accuracy_and_fold(spark):
    got = Q.op2_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_nothing_learned_and_empty_table(spark, docs_of):
    model = L.train(spark.createDataFrame([], "text string, lang string"))
    assert [r.lang_pred for r in L.predict(docs_of([(1, "abc")]), model).collect()] == ["und"]
    assert L.predict(docs_of([(1, "a")]).where("false"), model).count() == 0
    assert docs_of([(None, "a")]).select(L.held_out(F.col("doc_id"))).first()[0] == (zlib.crc32(b"") % 5 == 0)
