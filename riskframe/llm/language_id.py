"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from a seed and the
letter's code point, so any machine makes the same one).  An n-gram's vector
binds its letters' vectors: the first is rotated most, the last not at all,
and they are multiplied element by element.  A text's profile bundles (adds)
the vectors of its n-grams; a language's prototype bundles those of its
labelled texts.  The language with the largest cosine wins.

A bundle is the sum over distinct n-grams of count times vector, so training
counts n-grams on the whole labelled corpus (batches count before the shuffle)
and multiplies once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import bounded_batches, free_name, text_bytes

DEFAULT_DIMENSIONS, DEFAULT_GRAM, SEED = 1024, 3, 11
UNDETERMINED = "und"
_PIECE_CHARS, _PIECE_TEXTS, _DENSE = 500_000, 256, 1 << 22


class Letters:
    """Which code points are letters, and their vectors."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.is_letter = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), "?")
        self.vectors: dict[int, np.ndarray] = {}

    def vector(self, code: int) -> np.ndarray:
        if code not in self.vectors:
            draw = np.random.default_rng((SEED, code))
            self.vectors[code] = draw.integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self.vectors[code]

    def bind(self, grams: np.ndarray) -> np.ndarray:
        """Vectors (rows of float32) of n-grams given as rows of code points."""
        size = grams.shape[1]
        out = np.ones((len(grams), self.dimensions), np.int8)
        for place in range(size):
            codes, which = np.unique(grams[:, place], return_inverse=True)
            rotated = np.stack([np.roll(self.vector(int(c)), size - 1 - place) for c in codes])
            out *= rotated[which]
        return out.astype(np.float32)


_letters: dict[int, Letters] = {}


def letters(dimensions: int) -> Letters:
    if dimensions not in _letters:
        _letters[dimensions] = Letters(dimensions)
    return _letters[dimensions]


def gram_counts(texts: list[str], is_letter: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """N-grams (of 2 or 3) of lower-cased letter runs, words joined by one gap
    (code 0), which also starts and ends a text.

    Returns the distinct n-grams (rows of code points) and, as parallel arrays,
    the text, the n-gram's row and the count."""
    joined = "\x00".join(["\x00" * size + t.lower() + "\x00" * size for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    owner_ends = np.cumsum([len(t.lower()) + 2 * size + 1 for t in texts])
    letter = is_letter[codes]
    # a gap is kept where it follows a letter; the others are dropped
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    at = np.flatnonzero(keep)
    codes = np.where(letter[at], codes[at], 0).astype(np.int64)
    owner = np.searchsorted(owner_ends, at, "right")
    if not len(codes):
        return np.empty((0, size), np.int64), *(np.empty(0, np.int64) for _ in range(3))
    alphabet, small = np.unique(codes, return_inverse=True)  # holds the gap
    base = len(alphabet)
    first = np.flatnonzero(np.diff(owner, prepend=-1) != 0)
    small, owner = np.insert(small, first, 0), np.insert(owner, first, owner[first])
    n = len(small)
    gram = np.zeros(n - size + 1, np.int64)
    for k in range(size):
        gram = gram * base + small[k:n - size + 1 + k]
    within = owner[:n - size + 1] == owner[size - 1:]
    gram, whose = gram[within], owner[:n - size + 1][within]
    kinds = base ** size
    if kinds <= _DENSE:
        present = np.flatnonzero(np.bincount(gram, minlength=kinds))
        place = np.zeros(kinds, np.int64)
        place[present] = np.arange(len(present))
        row = place[gram]
    else:
        present, row = np.unique(gram, return_inverse=True)
    pair = whose * len(present) + row
    if len(texts) * len(present) <= _DENSE:
        count = np.bincount(pair)
        pair = np.flatnonzero(count)
        count = count[pair]
    else:
        pair, count = np.unique(pair, return_counts=True)
    digits = np.empty((len(present), size), np.int64)
    left = present.copy()
    for k in range(size - 1, -1, -1):
        digits[:, k] = alphabet[left % base]
        left //= base
    return digits, pair // len(present), pair % len(present), count


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that bound the work arrays; a long text is one range."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _PIECE_CHARS or i - start == _PIECE_TEXTS - 1:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Prototypes:
    """Languages in order of name and their unit vectors (rows)."""

    def __init__(self, names: list[str], vectors: np.ndarray, dimensions: int, gram: int):
        self.names, self.dimensions, self.gram = names, dimensions, gram
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        self.vectors = (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text",
          dimensions: int = DEFAULT_DIMENSIONS, gram: int = DEFAULT_GRAM) -> Prototypes:
    """Bundle a prototype per language from all rows of ``labelled``; rows
    without language or letters add nothing.  The driver gets ``dimensions``
    numbers per language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters(dimensions).is_letter
        for batch in batches:
            langs = np.array(batch.column("_lang").to_pylist(), object)
            texts = [b.decode("utf-8") for b in text_bytes(batch.column("_text"))]
            total: dict[tuple[str, tuple], int] = {}
            for lo, hi in _pieces(texts):
                grams, whose, row, n = gram_counts(texts[lo:hi], is_letter, gram)
                for lang in set(langs[lo:hi]):
                    mine = langs[lo:hi][whose] == lang
                    sums = np.bincount(row[mine], n[mine], minlength=len(grams)).astype(np.int64)
                    for r in np.flatnonzero(sums):
                        key = (lang, grams[r].tobytes())
                        total[key] = total.get(key, 0) + int(sums[r])
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total]), pa.array([k[1] for k in total], pa.binary()),
                                                  pa.array(total.values(), pa.int64())], ["_lang", "_gram", "_n"])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, table = {}, letters(dimensions)
        for batch in batches:
            langs = np.array(batch.column("_lang").to_pylist(), object)
            grams = np.frombuffer(b"".join(batch.column("_gram").to_pylist()), np.int64).reshape(-1, gram)
            n = np.array(batch.column("_n").to_pylist(), np.float64)
            for lo in range(0, len(grams), 4096):
                part = slice(lo, lo + 4096)
                vectors = table.bind(grams[part]).astype(np.float64)
                for lang in set(langs[part]):
                    made[lang] = made.get(lang, 0) + np.where(langs[part] == lang, n[part], 0) @ vectors
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(list(made)), pa.array([v.tolist() for v in made.values()], pa.list_(pa.float64()))], ["_lang", "_v"])

    bounded_batches(labelled.sparkSession)
    source = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    counts = (source.mapInArrow(count, "_lang string, _gram binary, _n long")
              .groupBy("_lang", "_gram").agg(F.sum("_n").alias("_n")))
    # sums of whole numbers: exact in doubles, so the order of tasks does not matter
    rows = (counts.mapInArrow(bundle, "_lang string, _v array<double>")
            .select("_lang", F.posexplode("_v").alias("_d", "_x")).groupBy("_lang", "_d").agg(F.sum("_x").alias("_x")).collect())
    names = sorted({r["_lang"] for r in rows})
    vectors = np.zeros((len(names), dimensions))
    place = {name: i for i, name in enumerate(names)}
    for r in rows:
        vectors[place[r["_lang"]], r["_d"]] = r["_x"]
    return Prototypes(names, vectors, dimensions, gram)


def predict(docs: DataFrame, model: Prototypes, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Add the predicted language of each whole text and its score, the cosine
    to that prototype (negative ones count as 0).

    Null, empty and letterless texts, and every text if no language was
    learned, give ``und`` and 0.  Ties go to the first name.  All columns stay
    (those called like the added ones are replaced).
    """
    bounded_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (lang_col, score_col)]
    schema = docs.select(*rest).schema.add(lang_col, "string").add(score_col, "double")
    source = docs.select(*rest, F.col(text_col).alias(free_name(docs, "_text")))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x dimensions x 4 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = letters(model.dimensions)
        for batch in batches:
            texts = [b.decode("utf-8") for b in text_bytes(batch.column(len(rest)))]
            best, score = np.full(len(texts), -1), np.zeros(len(texts))
            for lo, hi in _pieces(texts):
                grams, whose, row, n = gram_counts(texts[lo:hi], table.is_letter, model.gram)
                if not len(grams) or not model.names:
                    continue
                profile = np.zeros((hi - lo, model.dimensions), np.float32)
                for at in range(0, len(grams), 4096):
                    mine = (row >= at) & (row < at + 4096)
                    counts = np.zeros((hi - lo, min(4096, len(grams) - at)), np.float32)
                    counts[whose[mine], row[mine] - at] = n[mine]
                    profile += counts @ table.bind(grams[at:at + 4096])
                norm = np.linalg.norm(profile, axis=1)
                cosine = profile @ model.vectors.T / np.where(norm > 0, norm, 1)[:, None]
                lettered = np.bincount(whose, minlength=hi - lo) > 0
                best[lo:hi] = np.where(lettered, cosine.argmax(1), -1)
                score[lo:hi] = np.where(lettered, np.clip(cosine.max(1), 0, 1), 0)
            names = [model.names[i] if i >= 0 else UNDETERMINED for i in best]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], pa.array(names, pa.string()), pa.array(score)], [*rest, lang_col, score_col])

    return source.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """The fold that no model learns from; a null id counts as the text ''."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % 5 == 0
