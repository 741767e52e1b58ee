"""Packing of tokenised documents into fixed-size sequences by column generation.

A document's ids are cut at multiples of the sequence size; the whole pieces
are sequences of their own.  What is left of each document (its tail) is
packed as a cutting-stock problem on the histogram of tail lengths:

* the linear program asks for the fewest sequences, as multiples of patterns
  (multisets of lengths that fit into a sequence), that hold every tail;
* its columns are priced by an unbounded knapsack (dynamic programming over
  the sequence's positions with the dual prices as values), which yields the
  best pattern around each length; the simplex starts from a triangular basis
  (longest length first, filled up, used until a length runs out) and stops
  when no column improves, or within ``gap`` of a lower bound;
* pattern multiples are rounded down, then up again where the remaining
  lengths allow it, and the rest is filled once more in whole numbers; only
  patterns that fill a sequence exactly are used;
* the tails that no rounded pattern takes are laid end to end and cut at
  sequence borders; the last cut sequence is split into powers of two, so that
  no sequence needs padding.

The program sees only the histogram (at most one count a length).  Documents
get their place by rank: a document's position among those of its tail length
tells its pattern, copy and slot by arithmetic.  Ranks come from per-task
counters that are written with the ids and from running sums of the tasks'
counts, so no document is sorted and no text moves.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.bpe import PIECES, vocabulary
from riskframe.llm.store import bounded_batches, table, text_bytes
from riskframe.llm.token_store import byte_letters

DEFAULT_SIZE = 2048
DEFAULT_GAP = 1e-3
BROADCAST_RANKS = 500_000  # rows of (task, tail, running count), about 16 bytes each
_EPS = 1e-9


# ------------------------------------------------------------------ linear program
def knapsack(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total value of lengths (with repetition) within each capacity
    0..size, and the last length taken there (0: a position stays empty).
    ``values[l]`` is the value of length ``l``; ``-inf`` where there is none."""
    best, last = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    back = np.zeros(size + 1)  # best, from the right, so that slices run forward
    for c in range(1, size + 1):
        # back[size - c + 1:] is best[c - 1], best[c - 2], ... best[0]
        taken = back[size - c + 1:] + values[1:c + 1]
        at = int(taken.argmax())
        if taken[at] > best[c - 1] + 1e-12:
            best[c], last[c] = taken[at], at + 1
        else:
            best[c] = best[c - 1]
        back[size - c] = best[c]
    return best, last


def _pattern(last: np.ndarray, capacity: int) -> dict[int, int]:
    lengths: dict[int, int] = {}
    while capacity > 0:
        taken = int(last[capacity])
        if taken:
            lengths[taken] = lengths.get(taken, 0) + 1
        capacity -= taken or 1
    return lengths


def _exact(available: np.ndarray, capacity: int, tries: int = 64) -> list[int] | None:
    """At most three available lengths that add up to ``capacity``."""
    if available[capacity]:
        return [capacity]

    def two(total: int) -> list[int] | None:
        half = (total + 1) // 2
        both = np.flatnonzero(available[half:total] & available[total - half:0:-1])
        return [half + int(both[-1]), total - half - int(both[-1])] if len(both) else None
    found = two(capacity)
    for a in np.flatnonzero(available[:capacity])[::-1][:tries] if not found else ():
        if rest := two(capacity - int(a)):
            return [int(a), *rest]
    return found


def crash(histogram: dict[int, int], size: int, whole: bool) -> list[tuple[dict[int, int], float]]:
    """Patterns and their use, longest lengths first, each used until one of
    its lengths runs out.  With ``whole``, only full patterns in whole numbers;
    what they leave stays unpacked."""
    left = np.zeros(size + 1)
    for l, n in histogram.items():
        left[l] = n
    out = []
    while len(able := np.flatnonzero(left > 1e-7)):
        longest = int(able[-1])
        found = _exact(left > 1e-7, size - longest)
        if found is None:
            values = np.where(left > 1e-7, np.arange(size + 1.0), -np.inf)
            _, last = knapsack(values[:size - longest + 1], size - longest)
            pattern = _pattern(last, size - longest)
        else:
            pattern = {}
            for l in found:
                pattern[l] = pattern.get(l, 0) + 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[l] / k for l, k in pattern.items())
        if whole:
            times = int(times + 1e-7) if sum(l * k for l, k in pattern.items()) == size else 0
            if not times:
                left[longest] = 0
                continue
        for l, k in pattern.items():
            left[l] -= times * k
        out.append((pattern, times))
    return out


@dataclass
class Solution:
    """Patterns (length to multiplicity), how often each is used (fractional),
    the dual price of each length, and a lower bound of the objective."""
    patterns: list[dict[int, int]]
    used: np.ndarray
    prices: dict[int, float]
    bound: float

    @property
    def objective(self) -> float:
        return float(self.used.sum())


def cutting_stock(histogram: dict[int, int], size: int, gap: float = DEFAULT_GAP, columns_per_price: int = 64,
                  max_pivots: int = 3000) -> Solution:
    """Solve the linear program by column generation; see the module's text.
    ``max_pivots`` and ``gap`` end it early, with a worse plan of all lengths."""
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(l)] for l in lengths], float)
    m = len(lengths)
    if not m:
        return Solution([], np.zeros(0), {}, 0.0)
    row = {int(l): i for i, l in enumerate(lengths)}
    # product form throughout, by element-wise numpy: the driver may share its
    # process with threads that a BLAS library doesn't get along with
    basis: list[dict[int, int]] = [{l: 1} for l in lengths.tolist()]
    inverse, x, y = np.eye(m), demand.copy(), np.ones(m)

    def enter(pattern: dict[int, int], out: int | None) -> None:
        """Put a pattern into the basis, in place of row ``out`` or of the one
        that runs out first."""
        nonlocal y
        rows = np.array([row[l] for l in pattern])
        many = np.array(list(pattern.values()), float)
        direction = (inverse[:, rows] * many).sum(axis=1)
        if out is None:
            able = np.flatnonzero(direction > 1e-7)
            ratio = x[able] / direction[able]
            # of ties, the largest pivot
            out = able[np.where(ratio <= ratio.min() + 1e-12, direction[able], -1).argmax()]
        step = x[out] / direction[out]
        pivot_row = inverse[out] / direction[out]
        moved = np.flatnonzero(np.abs(direction) > 1e-13)
        across = np.flatnonzero(pivot_row)
        if len(across) < m // 8:
            inverse[np.ix_(moved, across)] -= direction[moved, None] * pivot_row[across]
        else:
            inverse[moved] -= direction[moved, None] * pivot_row
        inverse[out] = pivot_row
        np.maximum(x - step * direction, 0, out=x)
        x[out] = step
        y = y - ((y[rows] * many).sum() - 1) * pivot_row
        basis[out] = pattern

    # a triangular start: each pattern stands for the length that it used up
    left = demand.copy()
    open_rows = np.ones(m, bool)
    for pattern, times in crash(histogram, size, whole=False):
        rows = [row[l] for l in pattern]
        left[rows] -= times * np.array(list(pattern.values()))
        ended = next(i for i in sorted(rows, reverse=True) if left[i] <= 1e-7 and open_rows[i])
        open_rows[ended] = False
        enter(pattern, ended)
    for i in np.flatnonzero(open_rows):  # ended together with another length
        enter({int(lengths[i]): int(size // lengths[i])}, i)
    pivots = 0
    material = float((demand * lengths).sum()) / size
    bound = material
    values = np.full(size + 1, -np.inf)
    while True:
        values[lengths] = y
        best, last = knapsack(values, size)
        bound = max(bound, x.sum() / max(1.0, best[size]))
        if best[size] <= 1 + _EPS or x.sum() <= bound * (1 + gap) or pivots >= max_pivots:
            return Solution(basis, x, dict(zip(lengths.tolist(), y.tolist())), bound)
        around = y + best[size - lengths]  # the best pattern with this length in it
        tried, before = set(), pivots
        for i in np.argsort(-around)[:columns_per_price]:
            if around[i] <= 1 + _EPS:
                break
            pattern = _pattern(last, size - int(lengths[i]))
            pattern[int(lengths[i])] = pattern.get(int(lengths[i]), 0) + 1
            key = tuple(sorted(pattern.items()))
            if key in tried:
                continue
            tried.add(key)
            if sum(y[row[l]] * k for l, k in pattern.items()) > 1 + _EPS:  # else an earlier column of this round has changed the prices
                enter(pattern, None)
                pivots += 1
        if pivots == before:  # rounding alone sets the best pattern above 1
            return Solution(basis, x, dict(zip(lengths.tolist(), y.tolist())), bound)


# ------------------------------------------------------------------ plan
@dataclass
class Plan:
    """Where ranked tails go.  Slots are sorted by (length, first rank): of the
    ranks from ``first`` on, ``many`` go to each copy of a pattern, whose
    copies are the sequences from ``sequence`` on, beginning at ``offset``.
    ``many`` 0 marks the ranks that lie end to end from position ``offset`` of
    the cut stream, whose pieces begin at ``stream_starts``."""
    size: int
    slot_keys: np.ndarray
    first: np.ndarray
    many: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_patterns: int
    stream: int

    @property
    def stream_sequences(self) -> int:
        return self.stream // self.size + (self.stream % self.size).bit_count()

    @property
    def n_sequences(self) -> int:
        """Sequences of tails; the whole pieces are numbered behind them."""
        return self.n_patterns + self.stream_sequences


def rounded(solution: Solution, histogram: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Patterns that fill a sequence with the copies that the lengths allow."""
    left = dict(histogram)
    copies = []
    for pattern, used in zip(solution.patterns, solution.used):
        if sum(l * k for l, k in pattern.items()) == size:
            n = min(int(used + 1e-6), *(left[l] // k for l, k in pattern.items()))
            copies.append([used - n, pattern, n])
            for l, k in pattern.items():
                left[l] -= n * k
    for entry in sorted(copies, key=lambda e: -e[0]):
        if entry[0] > 1e-6 and all(left[l] >= k for l, k in entry[1].items()):
            entry[2] += 1
            for l, k in entry[1].items():
                left[l] -= k
    rest = crash({l: n for l, n in left.items() if n}, size, whole=True)
    return [(pattern, n) for _, pattern, n in copies if n] + [(pattern, int(n)) for pattern, n in rest]


def make_plan(histogram: dict[int, int], size: int, gap: float = DEFAULT_GAP) -> Plan:
    """Place all tails of a histogram (length to count)."""
    histogram = {l: n for l, n in histogram.items() if l > 0 and n > 0}
    taken = dict.fromkeys(histogram, 0)
    slots, sequence = [], 0
    for pattern, n in rounded(cutting_stock(histogram, size, gap), histogram, size):
        offset = 0
        for l in sorted(pattern, reverse=True):
            slots.append((l, taken[l], pattern[l], sequence, offset))
            taken[l] += n * pattern[l]
            offset += l * pattern[l]
        sequence += n
    stream = 0
    for l in sorted(histogram, reverse=True):
        slots.append((l, taken[l], 0, 0, stream))
        stream += l * (histogram[l] - taken[l])
    slots.sort()
    length, first, many, seq, offset = (np.array(c, np.int64) for c in zip(*slots)) if slots else (np.zeros(0, np.int64),) * 5
    return Plan(size, length << 48 | first, first, many, seq, offset, sequence, stream)


def place_tails(plan: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of ranked tails: index of the tail, start within it, length,
    sequence, offset in the sequence."""
    slot = np.searchsorted(plan.slot_keys, length << 48 | rank, "right") - 1
    k, many = rank - plan.first[slot], plan.many[slot]
    whole = many > 0
    per = np.maximum(many, 1)
    index = np.arange(len(length))
    pieces = [(index[whole], np.zeros(whole.sum(), np.int64), length[whole], (plan.sequence[slot] + k // per)[whole], (plan.offset[slot] + k % per * length)[whole])]
    # the cut stream: borders at multiples of the size, then at powers of two
    full, rest = divmod(plan.stream, plan.size)
    powers = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    borders = full * plan.size + np.cumsum([0, *powers])
    index, at, left = index[~whole], (plan.offset[slot] + k * length)[~whole], length[~whole]
    start = np.zeros(len(index), np.int64)
    while len(index):
        late = np.maximum(np.searchsorted(borders, at, "right") - 1, 0)
        early = at < borders[0]
        begin = np.where(early, at // plan.size * plan.size, borders[late])
        end = np.where(early, begin + plan.size, borders[np.minimum(late + 1, len(borders) - 1)])
        number = np.where(early, at // plan.size, full + late)
        size = np.minimum(left, end - at)
        pieces.append((index, start, size, plan.n_patterns + number, at - begin))
        more = left > size
        index, at, start, left = index[more], (at + size)[more], (start + size)[more], (left - size)[more]
    return tuple(np.concatenate(c) for c in zip(*pieces))


# ------------------------------------------------------------------ operators
_encoders: dict[str, object] = {}


def _encoder(path: str):
    """The vocabulary file's merges and added tokens in the installed rank-based
    encoder.  It joins any two neighbours whose bytes are a token, by the
    token's id; that equals the file's merge list if ids follow the merges and
    every token's own bytes merge into it, which is checked in the driver."""
    if path not in _encoders:
        import tiktoken
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in added}
        _encoders[path] = tiktoken.Encoding("packing", pat_str=PIECES.pattern, mergeable_ranks=ranks, special_tokens=added)
    return _encoders[path]


def check_vocabulary(path: str) -> None:
    """Raise unless the rank-based encoder gives the file's own merges."""
    vocab = vocabulary(path)
    made = [new for _, new in vocab.ranks.values()]
    tokens = [(i, b) for i, b in vocab.bytes_of.items() if i not in vocab.added.values()]
    if made != sorted(made) or any(np.frombuffer(ids, "<i4").tolist() != [i] for (i, _), ids in zip(tokens, vocab.merge_all([b for _, b in tokens]))):
        raise ValueError(f"{path}: token ids don't follow the merges")


def encode_tails(docs: DataFrame, tokenizer_path: str, end_id: int | None, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n`` ids, the ids (binary, 2 bytes each
    where they fit, else 4), and its counters within the writing task
    ``part``: ``rank`` among earlier documents with the same tail length
    ``tail``, and ``full`` whole pieces before it.  Null text is empty."""
    check_vocabulary(tokenizer_path)
    schema = docs.select(F.col(id_col).alias("doc_id")).schema.add("n", "long").add("ids", "binary").add("part", "integer").add("tail", "integer").add("rank", "long").add("full", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        special = tuple(encoder.special_tokens_set)
        kind = id_type(max(encoder.max_token_value, end_id or 0))
        end = [] if end_id is None else [end_id]
        part, seen, full = TaskContext.get().partitionId(), np.zeros(size, np.int64), 0
        for batch in batches:
            coded, lengths = [], []
            for raw in text_bytes(batch.column(1)):
                text = raw.decode("utf-8")
                ids = encoder.encode(text, allowed_special="all") if any(s in text for s in special) else encoder.encode_ordinary(text)
                coded.append(np.array(ids + end, kind).tobytes())
                lengths.append(len(ids) + len(end))
            n = np.array(lengths, np.int64)
            tail = n % size
            order = np.argsort(tail, kind="stable")
            sorted_tail = tail[order]
            rank = np.empty(len(n), np.int64)
            rank[order] = np.arange(len(n)) - np.searchsorted(sorted_tail, sorted_tail) + seen[sorted_tail]
            seen += np.bincount(tail, minlength=size)
            pieces = n // size
            before = full + np.cumsum(pieces) - pieces
            full += int(pieces.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(coded, pa.binary()), pa.array(np.full(len(n), part, np.int32)),
                                              pa.array(tail.astype(np.int32)), pa.array(rank), pa.array(before)], schema.names)

    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, schema)


def id_type(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def pack(docs: DataFrame, tokenizer_path: str, end_id: int | None = None, size: int = DEFAULT_SIZE, gap: float = DEFAULT_GAP,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` ids (a power of two).

    One row per piece: ``doc_id``, ``start`` (ids of its document before it),
    ``length``, ``ids_crc32`` (of its ids as little-endian unsigned 32-bit
    integers), ``doc_tokens``, ``sequence_id``, ``offset`` (place in the
    sequence) and, unless ``with_ids`` is off, ``ids`` (those bytes).  Every id
    lies in one piece; sequences are ``size`` long or, for the cut remainder,
    a smaller power of two, and have no gaps, so none is padded.

    ``end_id`` is appended to each document.  A document without ids (only
    possible without ``end_id``) has no piece.  Null text is empty; null and
    repeated ids are documents of their own; other columns are left out,
    whatever their names; an empty table gives no row.  All rows of the
    lengths' histogram (below ``size``) reach the driver, no others.
    """
    if size < 2 or size & (size - 1):
        raise ValueError("size must be a power of two")
    spark = docs.sparkSession
    coded = table(encode_tails(docs, tokenizer_path, end_id, size, id_col, text_col), "packing-ids")
    counts = table(coded.groupBy("part", "tail").agg(F.count(F.lit(1)).alias("_docs"), F.sum(F.floor(F.col("n") / size)).alias("_pieces")), "packing-counts")
    histogram = {r["tail"]: r["n"] for r in counts.groupBy("tail").agg(F.sum("_docs").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(make_plan(histogram, size, gap))

    # ranks over all tasks: running sums of at most `size` counts a task
    before = F.sum("_docs").over(Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranks = table(counts.select("part", "tail", F.coalesce(before, F.lit(0)).alias("_before")), "packing-ranks")
    per_task = counts.groupBy("part").agg(F.sum("_pieces").alias("_pieces"))
    firsts = per_task.select("part", F.coalesce(F.sum("_pieces").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    small = ranks.count() <= BROADCAST_RANKS
    hint = F.broadcast if small else (lambda df: df)
    placed = coded.join(hint(ranks), ["part", "tail"]).join(hint(firsts), "part")
    placed = placed.select("doc_id", "n", "ids", "tail", (F.col("rank") + F.col("_before")).alias("rank"), (F.col("full") + F.col("_first")).alias("full"))
    width = int(id_type(max(_encoder(tokenizer_path).max_token_value, end_id or 0))[2:])
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = docs.select(F.col(id_col).alias("doc_id")).schema
    for name in names:
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            n, tail, rank, full = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "tail", "rank", "full"))
            have = np.flatnonzero(tail)
            doc, start, length, sequence, offset = place_tails(p, tail[have], rank[have])
            doc = have[doc]
            start = start + (n - tail)[doc]
            pieces = n // p.size  # whole pieces: sequences of their own
            owner = np.repeat(np.arange(len(n)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            doc = np.concatenate([doc, owner])
            start = np.concatenate([start, number * p.size])
            length = np.concatenate([length, np.full(len(owner), p.size, np.int64)])
            sequence = np.concatenate([sequence, p.n_sequences + full[owner] + number])
            offset = np.concatenate([offset, np.zeros(len(owner), np.int64)])
            raw = batch.column("ids").to_pylist()
            cut = [np.frombuffer(raw[d], f"<u{width}", c, s * width).astype("<u4").tobytes() for d, s, c in zip(doc.tolist(), start.tolist(), length.tolist())]
            out = [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(np.array([zlib.crc32(c) for c in cut], np.int64)),
                   pa.array(n[doc]), pa.array(sequence), pa.array(offset)]
            if with_ids:
                out.append(pa.array(cut, pa.binary()))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", *names, *(["ids"] if with_ids else [])])

    return placed.mapInArrow(run, schema)
