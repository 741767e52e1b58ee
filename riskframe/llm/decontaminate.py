"""Benchmark decontamination with training suffix arrays.

The documents are the training text, in shards (a batch of a task).  In a
shard, the suffixes that could match are sorted into a suffix array; every
suffix of the test items is then found in it by binary search, with its
longest verbatim match and all its places.

Only document positions whose first words start some window enter the array
(others match no window), so its size follows the matches, not the text.  The
test items are cut into blocks of bounded size; documents pass all blocks in
one stage, without a shuffle and without regard to how often a passage occurs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from riskframe.llm.store import bounded_batches, free_name, text_bytes

DEFAULT_WINDOW, DEFAULT_BLOCK_WORDS = 10, 1_000_000
_LEAD, _SHARD_BYTES = 3, 8_000_000

# A-Z to lower case; the other bytes below 128 that are no digit or letter to a space
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of a-z, 0-9 and non-ASCII characters, A-Z in lower case."""
    return text.translate(_TABLE).split()


class TestBlock:
    """Words of some test items as numbers from 1, item after item; 0 ends an
    item and stands for every word that no item has."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        for _, words in items:
            for w in words:
                self.number.setdefault(w, len(self.number) + 1)
        self.base = len(self.number) + 1
        self.item_ids = [i for i, _ in items]
        lengths = np.array([len(ws) for _, ws in items], np.int64)
        self.stream = np.zeros(int(lengths.sum()) + len(items) + window, np.int32)
        starts = np.cumsum(lengths + 1) - lengths - 1
        self.starts, self.lengths = [], []  # of the windows
        self.items = []
        for k, ((_, words), start, n) in enumerate(zip(items, starts.tolist(), lengths.tolist())):
            self.stream[start:start + n] = [self.number[w] for w in words]
            size = min(window, n)
            for at in range(start, start + n - size + 1 if n else start):
                self.starts.append(at)
                self.lengths.append(size)
                self.items.append(k)
        self.lead = sorted({min(_LEAD, n) for n in self.lengths})
        self.leads = {n: np.unique([self._lead_code(self.stream, np.array([s]), n)[0] for s, size in zip(self.starts, self.lengths)
                                    if min(_LEAD, size) == n]) for n in self.lead}

    def _lead_code(self, stream: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        code = np.zeros(len(at), np.int64)
        for k in range(n):
            code = code * self.base + stream[at + k]
        return code

    def candidates(self, stream: np.ndarray) -> np.ndarray:
        """Positions whose first words start a window (``stream`` ends in 0s)."""
        found = []
        for n in self.lead:
            at = np.flatnonzero(stream[:len(stream) - self.window])
            for k in range(1, n):
                at = at[stream[at + k] != 0]
            code, known = self._lead_code(stream, at, n), self.leads[n]
            place = np.minimum(np.searchsorted(known, code), len(known) - 1)
            found.append(at[known[place] == code])
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


class SuffixArray:
    """Sorted suffixes of a word stream from given positions, compared by their
    first ``depth`` words; words are big-endian, so byte order is word order."""

    def __init__(self, stream: np.ndarray, positions: np.ndarray, depth: int):
        data = np.concatenate([stream, np.zeros(depth, stream.dtype)]).astype(">i4").tobytes()
        keyed = sorted((data[4 * p:4 * (p + depth)], p) for p in positions.tolist())
        self.keys = [k for k, _ in keyed]
        self.places = np.array([p for _, p in keyed], np.int64)

    def range(self, words: bytes) -> tuple[int, int]:
        """The suffixes that start with ``words`` (4 bytes each, at most ``depth``)."""
        lo = bisect_left(self.keys, words)
        return lo, bisect_left(self.keys, words + b"\xff" * 4, lo)


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Words before the first difference or the first 0."""
    n = min(len(a), len(b))
    stop = np.flatnonzero((a[:n] != b[:n]) | (a[:n] == 0))
    return int(stop[0]) if len(stop) else n


def _search(block: TestBlock, streams: list[np.ndarray], matches: bool) -> tuple[list, list, list]:
    """Per document of a shard: hit spans, item ids, and longest matches
    ``(item_id, item_word, doc_word, words)`` that no match extends."""
    gap = np.zeros(block.window, np.int32)
    shard = np.concatenate([x for s in streams for x in (s, gap)]) if streams else gap
    ends = np.cumsum([len(s) + block.window for s in streams])
    spans, items, found = ([[] for _ in streams] for _ in range(3))
    positions = block.candidates(shard)
    if not len(positions):
        return spans, items, found
    array = SuffixArray(shard, positions, block.window)
    test = block.stream.astype(">i4").tobytes()
    present = {n: np.unique(block._lead_code(shard, positions, n)) for n in block.lead}
    starts, lengths = np.array(block.starts), np.array(block.lengths)
    possible = np.zeros(len(starts), bool)
    for n in block.lead:
        mine = np.flatnonzero(np.minimum(lengths, _LEAD) == n)
        code = block._lead_code(block.stream, starts[mine], n)
        place = np.minimum(np.searchsorted(present[n], code), len(present[n]) - 1)
        possible[mine] = present[n][place] == code
    item_start = {}
    for w in range(len(starts)):
        item_start.setdefault(block.items[w], block.starts[w])
    for w in np.flatnonzero(possible).tolist():
        at, size, item = block.starts[w], block.lengths[w], block.items[w]
        lo, hi = array.range(test[4 * at:4 * (at + size)])
        if lo == hi:
            continue
        docs = np.searchsorted(ends, array.places[lo:hi], "right")
        for k, d in zip(range(lo, hi), docs.tolist()):
            place = int(array.places[k])
            inside = place - (int(ends[d - 1]) if d else 0)
            spans[d].append((inside, inside + size))
            items[d].append(block.item_ids[item])
            extends = at > 0 and place > 0 and block.stream[at - 1] != 0 and shard[place - 1] == block.stream[at - 1]
            if matches and not extends:
                found[d].append((block.item_ids[item], at - item_start[item], inside, common_words(block.stream[at:], shard[place:])))
    return spans, items, found


def _merged(spans: list[tuple[int, int]]) -> int:
    """Words inside any span."""
    total, end = 0, -1
    for a, b in sorted(spans):
        if b > end:
            total += b - max(a, end) if end > a else b - a
            end = b
    return total


def _test_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[TestBlock]:
    held, size = [], 0
    for row in benchmark.toLocalIterator():
        words = words_of((row._text or "").encode("utf-8"))
        if words:
            held.append((row._item, words))
            size += len(words)
        if size >= block_words:
            yield TestBlock(held, window)
            held, size = [], 0
    if held:
        yield TestBlock(held, window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       benchmark_text_col: str = "text", window: int = DEFAULT_WINDOW,
                       block_words: int = DEFAULT_BLOCK_WORDS, matches: bool = True) -> DataFrame:
    """Add to each row of ``docs``: ``n_words``; ``n_hit``, its words inside any
    occurrence of a window (``window`` consecutive words of an item; a shorter
    item is one window); ``items``, the sorted distinct ids of items whose
    windows occur; and, with ``matches``, ``longest_matches``, an array of
    ``(item_id, item_word, doc_word, words)`` with the maximal verbatim
    matches.

    Null and empty texts have no words and no hits; items without id or words
    are passed over; items that repeat an id count once.  Long texts are read
    whole.  All columns stay (those called like the added ones are replaced);
    repeated rows stay; an empty table stays empty, and without items nothing
    is hit.  Test items reach the tasks in blocks of about ``block_words``.
    """
    bounded_batches(docs.sparkSession)
    added = ["n_words", "n_hit", "items"] + ["longest_matches"] * matches
    rest = [c for c in docs.columns if c not in added]
    whole = isinstance(benchmark.schema[item_col].dataType, IntegralType)
    id_type, arrow_type = ("bigint", pa.int64()) if whole else ("string", pa.string())
    test = benchmark.select(F.col(item_col).cast(id_type).alias("_item"), F.col(benchmark_text_col).alias("_text")).where("_item is not null")
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(b) for b in _test_blocks(test, window, block_words)]
    match_fields = [("item_id", arrow_type), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("words", pa.int64())]
    kinds = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(arrow_type), "longest_matches": pa.list_(pa.struct(match_fields))}
    ddl = {"n_words": "bigint", "n_hit": "bigint", "items": f"array<{id_type}>",
           "longest_matches": f"array<struct<item_id:{id_type},item_word:bigint,doc_word:bigint,words:bigint>>"}
    schema = docs.select(*rest, *(F.expr(f"cast(null as {ddl[c]})").alias(c) for c in added)).schema

    def shard(texts: list[bytes]) -> list[list]:
        n_words, spans, items, found = ([0] * len(texts), *([[] for _ in texts] for _ in range(3)))
        if not blocks:
            n_words = [len(words_of(t)) for t in texts]
        for shared in blocks:
            block, streams = shared.value, []
            for d, text in enumerate(texts):
                words = words_of(text)
                n_words[d] = len(words)
                streams.append(np.fromiter(map(block.number.get, words, repeat(0)), np.int32, len(words)))
            for into, more in zip((spans, items, found), _search(block, streams, matches)):
                for d, x in enumerate(more):
                    into[d] += x
        columns = [n_words, [_merged(s) for s in spans], [sorted(set(i)) for i in items]]
        if matches:
            columns.append([[dict(zip(("item_id", "item_word", "doc_word", "words"), m)) for m in sorted(set(f))] for f in found])
        return columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, start = text_bytes(batch.column(len(rest))), 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and size < _SHARD_BYTES:
                    size += len(texts[end])
                    end += 1
                part = batch.slice(start, end - start)
                columns = [pa.array(x, kinds[c]) for x, c in zip(shard(texts[start:end]), added)]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(rest)], *columns], [*rest, *added])
                start = end

    return docs.select(*rest, F.col(text_col).alias(free_name(docs, "_text"))).mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a hit, with their own columns."""
    names = {c: f"_own_{c}" for c in ("n_words", "n_hit", "items") if c in docs.columns}
    found = find_contamination(docs.withColumnsRenamed(names), benchmark, names.get(text_col, text_col), matches=False, **options)
    return found.where("n_hit = 0").drop("n_words", "n_hit", "items").withColumnsRenamed({v: k for k, v in names.items()})
