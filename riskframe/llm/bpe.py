"""Byte-level BPE with a lexicon automaton for frequent words.

The corpus is counted into pieces (the words that the vocabulary's split
pattern makes).  The most frequent ones are compiled into a minimal acyclic
transducer: words share prefixes and suffixes, and the numbers on the arcs of
a word's path sum to its place in the table of ids.  The file is placed on
every machine once and memory-mapped, so the workers of a machine share it.
A batch's distinct pieces walk the automaton together, one byte a step; a
piece that it lacks is merged exactly by the vocabulary's ranks.  The size of
the lexicon therefore bounds memory and changes speed, never a result.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from riskframe.llm.store import add_file, bounded_batches, table, text_bytes
from riskframe.llm.token_store import byte_letters

# Fixed value: the split pattern of byte-level vocabularies.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Fixed value: the characters of Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
_WHITE_SPACE = [w + " " for w in WHITE]
_UNITS = regex.compile(rf"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

DEFAULT_LEXICON_WORDS = 131_072
_NO_RANK, _LONG = (1 << 30) - 1, 64


def units(text: str) -> list[str]:
    """Cut ``text`` before white space that follows another character.

    No piece of the split pattern crosses such a cut and none looks back over
    it, so a text's pieces are its units' pieces."""
    if any(pair in text for pair in _WHITE_SPACE):
        return _UNITS.findall(text)
    found = text.replace(" ", "\0 ").split("\0") if "\0" not in text else _UNITS.findall(text)
    return found[1:] if found and not found[0] else found


class Vocabulary:
    """Vocabulary, merge ranks and added tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        ids = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = [ids[c] for c in byte_letters()]
        self.ranks = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(spec["model"]["merges"])}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.bytes_of |= {i: token.encode("utf-8") for token, i in self.added.items()}
        pairs = np.array([a << 32 | b for a, b in self.ranks], np.int64)
        order = np.argsort(pairs)
        self.pair_keys, self.pair_ranks = pairs[order], np.array([r for r, _ in self.ranks.values()], np.int64)[order]
        self.new_ids = np.zeros(len(pairs) + 1, np.int64)
        self.new_ids[[r for r, _ in self.ranks.values()]] = [new for _, new in self.ranks.values()]
        self.added_pattern = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")

    def merge(self, piece: bytes) -> list[int]:
        """Merge the lowest-ranked adjacent pair, leftmost first, until no pair
        has a rank; a heap keeps long pieces in n log n."""
        ranks = self.ranks
        part = [self.byte_ids[b] for b in piece]
        if len(part) < 40:
            while len(part) > 1:
                best = min(((ranks[pair], i) for i, pair in enumerate(zip(part, part[1:])) if pair in ranks), default=None)
                if best is None:
                    break
                (_, merged), at = best
                part[at:at + 2] = [merged]
            return part
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap = [(ranks[pair][0], i, pair) for i, pair in enumerate(zip(part, part[1:])) if pair in ranks]
        heapq.heapify(heap)
        end = len(part)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if part[i] is not None else end
            if j >= end or (part[i], part[j]) != pair:
                continue  # one of the two was merged meanwhile
            part[i], part[j] = ranks[pair][1], None
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < end and (part[k], part[after[k]]) in ranks:
                    new = (part[k], part[after[k]])
                    heapq.heappush(heap, (ranks[new][0], k, new))
        return [p for p in part if p is not None]


    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[place] == key, self.pair_ranks[place], _NO_RANK)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """:meth:`merge` of many pieces at once, as ids of 4 bytes each: every
        step merges the best pair of each piece that still has one."""
        out: list[bytes] = [b""] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if len(piece) > _LONG:
                out[i] = array("i", self.merge(piece)).tobytes()
            elif piece:
                short.append(i)
        if not short:
            return out
        ids = np.array(self.byte_ids, np.int64)[np.frombuffer(b"".join([pieces[i] for i in short]), "u1")]
        owner = np.repeat(np.arange(len(short)), [len(pieces[i]) for i in short])
        ranks = np.full(len(ids), _NO_RANK, np.int64)
        same = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[same] = self._pair_ranks(ids[same], ids[same + 1])
        done_owner, done_ids = [], []
        while len(ids):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(ids)), starts)
            at, rank = best & 0xFFFFFFFF, best >> 32
            active = rank != _NO_RANK
            going = np.repeat(active, np.diff(np.append(starts, len(ids))))
            done_owner.append(owner[~going])
            done_ids.append(ids[~going])
            at, rank = at[active], rank[active]
            ids[at] = self.new_ids[rank]
            going[at + 1] = False  # joined to its left neighbour
            place = np.cumsum(going)[at] - 1
            ids, owner, ranks = ids[going], owner[going], ranks[going]
            ranks[place] = _NO_RANK
            right = place[place + 1 < len(ids)]
            right = right[owner[right] == owner[right + 1]]
            ranks[right] = self._pair_ranks(ids[right], ids[right + 1])
            left = place[place > 0] - 1
            left = left[owner[left] == owner[left + 1]]
            ranks[left] = self._pair_ranks(ids[left], ids[left + 1])
        owner, ids = np.concatenate(done_owner), np.concatenate(done_ids)
        data = ids[np.argsort(owner, kind="stable")].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(short)))).tolist()
        start = 0
        for i, end in zip(short, ends):
            out[i] = data[start:end]
            start = end
        return out


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


# ------------------------------------------------------------------ automaton
def compile_lexicon(words: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The minimal acyclic transducer of distinct non-empty words with ids.

    Words come in sorted order.  When the next word leaves a branch, the branch
    can't change any more: each of its states is replaced by an equal one that
    exists already (same arcs, same finality), so suffixes are shared.  An arc
    carries the number of words that sort before its branch within the state.
    """
    words = sorted(words)
    register: dict[tuple, int] = {}
    states: list[tuple] = []
    reach: list[int] = []  # words accepted from each state
    path: list[list] = [[False, []]]  # open states on the last word's path: final, arcs (byte, state)
    labels: list[int] = []

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, *arcs)
            if key not in register:
                register[key] = len(states)
                states.append(key)
                reach.append(final + sum(reach[t] for _, t in arcs))
            path[-1][1].append((labels.pop(), register[key]))

    previous = b""
    for word, _ in words:
        common = next((i for i, (a, b) in enumerate(zip(word, previous)) if a != b), min(len(word), len(previous)))
        freeze(common)
        for b in word[common:]:
            labels.append(b)
            path.append([False, []])
        path[-1][0] = True
        previous = word
    freeze(0)
    root = len(states)
    states.append((path[0][0], *path[0][1]))
    keys, targets, outputs = [], [], []
    for s, (final, *arcs) in enumerate(states):
        passed = int(final)
        for b, t in arcs:
            keys.append(s << 8 | b)
            targets.append(t)
            outputs.append(passed)
            passed += reach[t]
    parts = [np.array([root, len(keys), len(states), len(words)], "<i8"), np.array(keys, "<i8"), np.array(targets, "<i4"),
             np.array(outputs, "<i4"), np.array([s[0] for s in states], "<i4"),
             np.cumsum([0, *(len(ids) for _, ids in words)]).astype("<i4"), np.array([i for _, ids in words for i in ids], "<i4")]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, path: str):
        whole = np.asarray(np.memmap(path, "u1", "r"))
        self.root, n_arcs, self.n_states, n_words = whole[:32].view("<i8").tolist()
        at = 32

        def part(count: int, kind: str) -> np.ndarray:
            nonlocal at
            size = count * np.dtype(kind).itemsize
            at += size
            return whole[at - size:at].view(kind)

        self.keys, self.targets, self.outputs = part(n_arcs, "<i8"), part(n_arcs, "<i4"), part(n_arcs, "<i4")
        self.final, self.bounds = part(self.n_states, "<i4"), part(n_words + 1, "<i4")
        self.ids = part(4 * int(self.bounds[-1]), "u1")

    def find(self, words: list[bytes]) -> list[int]:
        """The place of each word in the id table, -1 if it is not there."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        place = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not words:
            return place.tolist()
        data = np.frombuffer(b"".join(words), "u1")
        starts = np.cumsum(lengths) - lengths
        alive = np.flatnonzero(lengths > 0)
        state = np.full(len(alive), self.root, np.int64)
        total = np.zeros(len(alive), np.int64)
        step = 0
        while len(alive):
            key = state << 8 | data[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            alive, arc = alive[hit], arc[hit]
            state, total = self.targets[arc].astype(np.int64), total[hit] + self.outputs[arc]
            step += 1
            ended = lengths[alive] == step
            accepted = ended & (self.final[state] == 1)
            place[alive[accepted]] = total[accepted]
            alive, state, total = alive[~ended], state[~ended], total[~ended]
        return place.tolist()

    def ids_at(self, place: int) -> bytes:
        """A word's ids, 4 bytes each."""
        return self.ids[4 * self.bounds[place]:4 * self.bounds[place + 1]].tobytes()


# ------------------------------------------------------------------ operators
def piece_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(piece, n)`` over all documents; batches count before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                seen.update(units(text or ""))
            pieces: Counter = Counter()
            for unit, n in seen.items():
                for piece in PIECES.findall(unit):
                    pieces[piece] += n
            yield pa.RecordBatch.from_arrays([pa.array(map(str.encode, pieces), pa.binary()), pa.array(pieces.values(), pa.int64())], ["piece", "n"])

    bounded_batches(docs.sparkSession)
    return docs.select(text_col).mapInArrow(count, "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary_path: str, text_col: str = "text",
                  max_words: int = DEFAULT_LEXICON_WORDS) -> str:
    """Compile the most frequent pieces of the whole corpus, at most
    ``max_words``, and place the file on all machines; returns its name.

    A histogram of the frequencies (64 steps an octave, so a few thousand rows)
    tells from which step on the pieces fit; only those reach the driver, of 64
    bytes at most.  Pieces seen once are never in."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 64).cast("int")
    counts = table(piece_counts(docs, text_col).where((F.length("piece") <= 64) & (F.col("n") > 1)).withColumn("step", step), "piece-counts")
    lowest, held = None, 0
    for r in sorted(counts.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        held += r["count"]
        if held > max_words:
            break
        lowest = r["step"]
    top = counts.where(F.col("step") >= lowest).select("piece").collect() if lowest is not None else []
    vocab = vocabulary(vocabulary_path)
    pieces = [bytes(r.piece) for r in top]
    data = compile_lexicon(zip(pieces, (np.frombuffer(ids, "<i4").tolist() for ids in vocab.merge_all(pieces))))
    return add_file(docs.sparkSession, data, "lexicon.bin")


class Encoder:
    """Encodes texts with a lexicon; ``max_units`` bounds the cache of units."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon, max_units: int = 300_000):
        self.vocab, self.lexicon, self.max_units = vocab, lexicon, max_units
        self.cache: dict[str, bytes] = {}

    def _learn(self, wanted: list[str]) -> None:
        """Put the ids of units into the cache: all their distinct pieces walk
        the automaton at once, the missing ones are merged."""
        split = [PIECES.findall(u) for u in wanted]
        distinct = list({p for pieces in split for p in pieces})
        coded = [p.encode("utf-8") for p in distinct]
        places = self.lexicon.find(coded)
        missing = [i for i, place in enumerate(places) if place < 0]
        known = {p: self.lexicon.ids_at(place) for p, place in zip(distinct, places) if place >= 0}
        for i, ids in zip(missing, self.vocab.merge_all([coded[i] for i in missing])):
            known[distinct[i]] = ids
        for unit, pieces in zip(wanted, split):
            self.cache[unit] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.cache) > self.max_units:
            self.cache.clear()
        cut = [self._parts(t) for t in texts]
        wanted = set()
        for parts in cut:
            wanted.update(parts)
        cache = self.cache
        for token, i in self.vocab.added.items():
            cache[token, i] = array("i", [i]).tobytes()
        self._learn([u for u in wanted if u not in cache])
        return [np.frombuffer(b"".join(map(cache.__getitem__, parts)), "<i4") for parts in cut]

    def _parts(self, text: str) -> list:
        """Units of the text; an added token stands as a pair with its id."""
        if not any(t in text for t in self.vocab.added):
            return units(text)
        parts, at = [], 0
        for hit in self.vocab.added_pattern.finditer(text):
            parts += [*units(text[at:hit.start()]), (hit.group(), self.vocab.added[hit.group()])]
            at = hit.end()
        return parts + units(text[at:])


def decode(vocab: Vocabulary, ids: list[int]) -> str:
    """Join the tokens' bytes; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(vocab.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary_path: str, lexicon_name: str) -> Encoder:
    if lexicon_name not in _encoders:
        _encoders.clear()  # a reused worker keeps one lexicon
        _encoders[lexicon_name] = Encoder(vocabulary(vocabulary_path), Lexicon(SparkFiles.get(lexicon_name)))
    return _encoders[lexicon_name]


def _groups(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, vocabulary_path: str, lexicon_name: str, text_col: str = "text", out_col: str = "token_ids",
           decoded_col: str | None = None) -> DataFrame:
    """Add ``out_col`` (array of int) with the ids of each whole text; with
    ``decoded_col``, also the text that those ids decode to.

    Null text gives an empty array.  All columns of ``docs`` stay (those already
    called like an added one are replaced); an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    added = [c for c in (out_col, decoded_col) if c]
    rest = [c for c in docs.columns if c not in added]
    schema = docs.select(*rest).schema.add(out_col, ArrayType(IntegerType()))
    if decoded_col:
        schema = schema.add(decoded_col, "string")
    source = docs.select(*rest, *([F.col(text_col).alias("_text")] if text_col in added else []))
    text_at = "_text" if text_col in added else text_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary_path, lexicon_name)
        for batch in batches:
            texts = [b.decode("utf-8") for b in text_bytes(batch.column(text_at))]
            for lo, hi in _groups(texts, 4_000_000):
                ids = encoder.encode_batch(texts[lo:hi])
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, "<i4")))
                part = batch.slice(lo, hi - lo)
                columns = [*(part.column(c) for c in rest), column]
                if decoded_col:
                    columns.append(pa.array([decode(encoder.vocab, i.tolist()) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*rest, *added])

    return source.mapInArrow(run, schema)


def decode_column(docs: DataFrame, vocabulary_path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """Add ``out_col`` with the text of ``ids_col``; null ids give empty text."""
    bounded_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != out_col]
    schema = docs.select(*rest).schema.add(out_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            texts = [decode(vocab, ids or []) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(texts, pa.string())], [*rest, out_col])

    return docs.select(*rest).mapInArrow(run, schema)
