"""Token ids as binary shards of independent zstandard frames.

File format (the public zstandard *seekable format*, with a document index):

* data frames: each holds ``frame_tokens`` ids (the last one fewer) as
  little-endian unsigned 32-bit integers and decompresses on its own;
* a skippable frame (magic 0x184D2A51) with the document index, itself a
  zstandard frame: count, then the document ids, then each document's end
  (in ids, from the shard's start) as signed 64-bit integers; a null id is
  marked by a byte in a third array;
* a skippable frame (magic 0x184D2A5E) with the seek table: per data frame
  compressed size, decompressed size and checksum (low 32 bits of XXH64 of
  the ids), then the number of frames, a flag byte and 0x8F92EAB1.

A shard is written by one task from one range of document ids, so the shards
in manifest order hold the documents in ascending order.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.store import create, new_file, open_random, shared_folder, table, text_bytes

SEEK_MAGIC, INDEX_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x184D2A51, 0x8F92EAB1
DEFAULT_FRAME_TOKENS = 65_536

# The split pattern of the lower-casing word vocabulary,
# restricted to printable ASCII and the letters of Latin-1.
_LATIN = "a-zß-öø-ÿ"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^{_LATIN}0-9]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level
    vocabularies: itself where printable, else 256 and up in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {}, 256
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


class WordIds(dict):
    """Ids (as bytes) of a run of characters without ASCII white space.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its runs.  Runs of plain letters go straight to the library's
    BPE model; everything else takes the library's whole path.  ``max_runs``
    bounds the memory; beyond it the cache starts afresh between documents.
    """

    def __init__(self, tokenizer_path: str, max_runs: int = 400_000):
        from tokenizers import Tokenizer
        super().__init__()
        self.max_runs = max_runs
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})

    def __missing__(self, run: bytes) -> bytes:
        text = run.decode("utf-8")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            found = []
            for piece in _PIECES.findall(text.lower()):
                if not piece.isascii():
                    piece = piece.encode("utf-8").decode("latin-1").translate(self.letters)
                found += [t.id for t in self.model.tokenize(piece)]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        ids = self[run] = array("I", found).tobytes()
        return ids

    def encode(self, text: bytes) -> bytes:
        if len(self) > self.max_runs:
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


_encoders: dict[str, WordIds] = {}


def word_ids(tokenizer_path: str) -> WordIds:
    """The worker's encoder; a reused worker keeps it between tasks."""
    if tokenizer_path not in _encoders:
        _encoders[tokenizer_path] = WordIds(tokenizer_path)
    return _encoders[tokenizer_path]


class ShardWriter:
    def __init__(self, path: str, frame_tokens: int):
        self.out, self.frame_bytes = create(path), 4 * frame_tokens
        self.pending, self.seek, self.doc_ids, self.ends, self.tokens = bytearray(), [], [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=1, write_checksum=False)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.tokens += len(ids) // 4
        self.doc_ids.append(doc_id)
        self.ends.append(self.tokens)
        self.pending += ids
        whole = len(self.pending) - len(self.pending) % self.frame_bytes
        for at in range(0, whole, self.frame_bytes):
            self._frame(bytes(self.pending[at:at + self.frame_bytes]))
        del self.pending[:whole]

    def _frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        self.seek.append(struct.pack("<III", len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.pending:
            self._frame(bytes(self.pending))
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        none = np.array([d is None for d in self.doc_ids], "u1")
        index = self.compressor.compress(struct.pack("<q", len(ids)) + ids.tobytes() + np.array(self.ends, "<i8").tobytes() + none.tobytes())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        body = b"".join(self.seek) + struct.pack("<IBI", len(self.seek), 0x80, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(body)) + body)
        self.out.close()


class ShardReader:
    """Reads a shard by its trailing tables; ``tokens`` and ``document``
    decompress only the frames that hold the ids asked for."""

    def __init__(self, path: str):
        self.file = open_random(path)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != FOOTER_MAGIC or not flags & 0x80:
            raise ValueError(f"{path}: no seek table with checksums")
        table_at = size - 9 - 12 * frames - 8
        entries = np.frombuffer(self.file.read_at(12 * frames, table_at + 8), "<u4").reshape(-1, 3)
        self.sums = entries[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(entries[:, 0], dtype=np.int64)])
        self.first_token = np.concatenate([[0], np.cumsum(entries[:, 1], dtype=np.int64)]) // 4
        magic, length = struct.unpack("<II", self.file.read_at(8, int(self.starts[-1])))
        if magic != INDEX_MAGIC:
            raise ValueError(f"{path}: no document index")
        self.unpacker = zstandard.ZstdDecompressor()
        index = self.unpacker.decompress(self.file.read_at(length, int(self.starts[-1]) + 8))
        n = struct.unpack_from("<q", index)[0]
        self.doc_ids = np.frombuffer(index, "<i8", n, 8)
        self.ends = np.frombuffer(index, "<i8", n, 8 + 8 * n)
        self.none = np.frombuffer(index, "u1", n, 8 + 16 * n).astype(bool)
        self._kept: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._kept[0] != k:
            packed = self.file.read_at(int(self.starts[k + 1] - self.starts[k]), int(self.starts[k]))
            raw = self.unpacker.decompress(packed)
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != int(self.sums[k]):
                raise ValueError(f"frame {k}: the checksum does not match")
            self._kept = (k, raw)
        return self._kept[1]

    def tokens(self, start: int, end: int) -> bytes:
        if start >= end:
            return b""
        first = int(np.searchsorted(self.first_token, start, "right")) - 1
        last = int(np.searchsorted(self.first_token, end, "left")) - 1
        base = int(self.first_token[first])
        return b"".join(self.frame(k) for k in range(first, last + 1))[4 * (start - base):4 * (end - base)]

    def document(self, place: int) -> bytes:
        return self.tokens(int(self.ends[place - 1]) if place else 0, int(self.ends[place]))

    def find(self, doc_id: int) -> list[bytes]:
        """The ids of every document of that id (repeated rows: all of them)."""
        skip = int(self.none.sum())  # null ids come first
        lo, hi = (skip + int(np.searchsorted(self.doc_ids[skip:], doc_id, side)) for side in ("left", "right"))
        return [self.document(i) for i in range(lo, hi)]


def write_token_shards(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 1,
                       id_col: str = "doc_id", text_col: str = "text",
                       frame_tokens: int = DEFAULT_FRAME_TOKENS) -> DataFrame:
    """Encode whole texts and write them in ascending id order.

    Returns the manifest ``(shard, path, n_docs, n_tokens, base)``; ``base`` is
    the number of ids in all earlier shards.  Null text is empty (its document
    holds the end id alone); null ids come first; rows repeated with one id
    are kept side by side, ordered by text.  An empty table gives an empty
    manifest.  Other columns are not read.
    """
    folder = folder or shared_folder(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, path = word_ids(tokenizer_path), None, new_file(folder, ".tok.zst")
        end = struct.pack("<I", end_id)
        for batch in batches:
            for doc_id, text in zip(batch.column("_id").to_pylist(), text_bytes(batch.column("_text"))):
                writer = writer or ShardWriter(path, frame_tokens)
                writer.add(doc_id, encoder.encode(text) + end)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [TaskContext.get().partitionId()], "path": [path],
                                              "n_docs": [len(writer.ends)], "n_tokens": [writer.tokens]})

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    written = (rows.repartitionByRange("_id").sortWithinPartitions("_id", "_text")
               .mapInArrow(write, "shard long, path string, n_docs long, n_tokens long"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return table(written, "token-shards").withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def read_token_shards(manifest: DataFrame, batch_bytes: int = 8_000_000) -> DataFrame:
    """Read every document back: ``(doc_id, start, n_tokens, ids)``, ``ids``
    being little-endian unsigned 32-bit integers.  Each frame's checksum is
    verified; a file that does not match raises."""
    schema = "doc_id long, start long, n_tokens long, ids binary"
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                reader, rows, size, before = ShardReader(shard["path"]), [], 0, 0
                for i, end in enumerate(reader.ends.tolist()):
                    ids = reader.tokens(before, end)
                    rows.append((None if reader.none[i] else int(reader.doc_ids[i]), shard["base"] + before, end - before, ids))
                    size, before = size + len(ids), end
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    shards = max(1, manifest.count())
    return manifest.select("path", "base").repartition(shards).mapInArrow(read, schema)
