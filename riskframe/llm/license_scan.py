"""License scan: an exact set-similarity join of text blocks with templates.

Blocks are stretches of consecutive words that overlap by at least the longest
template, so each place of a template's words lies in one block.  A block
matches a template if it holds at least a given share of the template's
distinct words (containment).  The templates' words are ordered by their
frequency over all documents, rarest first; then

* prefix filter: a match must hold one of a template's rarest
  ``n - needed + 1`` words, so only those are indexed;
* length filter: a block with fewer template words than needed is out;
* positional filter: from the first common word on, what is left on either
  side must suffice for the words still needed;
* what remains is counted in full.

The phrases of the base labels are templates that need all their words; in
the blocks found, their words must also stand consecutively.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import bounded_batches, free_name, text_bytes

# Phrases of the base labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Usual notices, by label.
NOTICES = (
    ("all-rights-reserved", "all rights reserved"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
DEFAULT_CONTAINMENT, DEFAULT_BLOCK_WORDS = (85, 100), 64

# A-Z to lower case; the other bytes below 128 that are no digit or letter to a space
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of a-z, 0-9 and non-ASCII characters, A-Z in lower case."""
    return text.translate(_TABLE).split()


class Index:
    """Templates as sequences of ranks in the global order of words."""

    def __init__(self, phrases, notices, containment: tuple[int, int], frequency: dict[bytes, int]):
        texts = [(label, words_of(t.encode()), True) for label, t in phrases] + [(label, words_of(t.encode()), False) for label, t in notices]
        order = sorted({w for _, ws, _ in texts for w in ws}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.labels = [label for label, _, _ in texts]
        self.phrase = [exact for _, _, exact in texts]
        self.sequence = [np.array([self.rank[w] for w in ws], np.int64) for _, ws, _ in texts]
        sets = [np.unique(s) for s in self.sequence]
        self.size = np.array([len(s) for s in sets], np.int64)
        part, whole = containment
        self.needed = np.array([n if exact else -(-part * n // whole) for n, exact in zip(self.size.tolist(), self.phrase)], np.int64)
        self.member = np.zeros((len(texts), len(order)), bool)
        entries = []  # (rank, template, place in the template)
        for t, s in enumerate(sets):
            self.member[t, s] = True
            entries += [(int(r), t, i) for i, r in enumerate(s[:self.size[t] - self.needed[t] + 1])]
        entries.sort()
        self.entry = np.array(entries, np.int64).reshape(-1, 3)
        self.first = np.searchsorted(self.entry[:, 0], np.arange(len(order) + 1))
        self.indexed = frozenset(order[r] for r in set(self.entry[:, 0].tolist()))
        self.longest = max(map(len, self.sequence))

    def matches(self, ranks: np.ndarray, block_words: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(block, template, overlap)`` of all blocks of a word sequence;
        block ``b`` starts at word ``b * stride``."""
        at = np.flatnonzero(ranks >= 0)
        n_words, n_ranks = len(self.rank), ranks[at]
        last = max(0, -(-(len(ranks) - block_words) // stride))
        pairs = []
        for back in range(-(-block_words // stride)):
            block = at // stride - back
            ok = (block >= 0) & (at - block * stride < block_words)
            pairs.append(np.minimum(block[ok], last) * n_words + n_ranks[ok])
        pair = np.unique(np.concatenate(pairs)) if len(at) else np.empty(0, np.int64)
        block, rank = pair // n_words, pair % n_words
        start = np.searchsorted(block, block)  # of the block's words among the pairs
        held = np.searchsorted(block, block, "right") - start
        hits = self.first[rank + 1] - self.first[rank]
        which = np.repeat(np.arange(len(pair)), hits)
        entry = self.entry[np.arange(len(which)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(self.first[rank], hits)]
        template, place = entry[:, 1], entry[:, 2]
        # the first common word of a block and a template comes first here
        key = block[which] * len(self.labels) + template
        _, first = np.unique(key, return_index=True)
        which, template, place = which[first], template[first], place[first]
        size, left = held[which], which - start[which]
        ok = (size >= self.needed[template]) & (1 + np.minimum(self.size[template] - place - 1, size - left - 1) >= self.needed[template])
        which, template = which[ok], template[ok]
        span = held[which]
        each = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span) + np.repeat(start[which], span)
        common = np.bincount(np.repeat(np.arange(len(which)), span), self.member[np.repeat(template, span), rank[each]], len(which)).astype(np.int64)
        ok = common >= self.needed[template]
        return block[which[ok]], template[ok], common[ok]

    def places(self, ranks: np.ndarray, blocks: np.ndarray, template: int, block_words: int, stride: int) -> list[int]:
        """Starts of the template's words standing consecutively in ``blocks``."""
        words, found = self.sequence[template], set()
        for b in blocks.tolist():
            part = ranks[b * stride:b * stride + block_words]
            n = len(part) - len(words) + 1
            if n > 0:
                ok = np.ones(n, bool)
                for k, w in enumerate(words):
                    ok &= part[k:n + k] == w
                found.update((np.flatnonzero(ok) + b * stride).tolist())
        return sorted(found)


def word_frequencies(docs: DataFrame, wanted: Sequence[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Occurrences of the templates' words in all documents (at most one row a
    word reaches the driver)."""
    vocabulary = frozenset(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                total.update(filter(vocabulary.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], ["w", "n"])

    counts = docs.select(text_col).mapInArrow(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return {bytes(r.w): r.n for r in counts.collect()}


def license_scan(docs: DataFrame, text_col: str = "text", phrases=PHRASES, notices=NOTICES,
                 containment: tuple[int, int] = DEFAULT_CONTAINMENT, block_words: int = DEFAULT_BLOCK_WORDS) -> DataFrame:
    """Add to each row of ``docs``: ``n_words``; ``phrases``, an array of
    ``(label, start)`` with every place of a phrase, by start; ``blocks``, an
    array of ``(label, start, containment)`` with every block that meets a
    notice.  ``start`` counts words from 0.

    Null and empty texts have 0 words and empty arrays.  Long texts are read
    whole.  All columns stay (those called like the added ones are replaced);
    repeated rows stay as they are and an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    plain = Index(phrases, notices, containment, {})
    block_words = max(block_words, 2 * plain.longest)
    stride = block_words - plain.longest + 1
    index = Index(phrases, notices, containment, word_frequencies(docs, list(plain.rank), text_col))
    rest = [c for c in docs.columns if c not in ("n_words", "phrases", "blocks")]
    kinds = [pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())])),
             pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("containment", pa.float64())]))]
    schema = docs.select(*rest, F.lit(0).cast("long").alias("n_words"),
                         F.expr("cast(null as array<struct<label:string,start:bigint>>)").alias("phrases"),
                         F.expr("cast(null as array<struct<label:string,start:bigint,containment:double>>)").alias("blocks")).schema

    def one(text: bytes) -> tuple[int, list, list]:
        words = words_of(text)
        if index.indexed.isdisjoint(words):  # the prefix filter on the whole text
            return len(words), [], []
        ranks = np.fromiter((index.rank.get(w, -1) for w in words), np.int64, len(words))
        block, template, common = index.matches(ranks, block_words, stride)
        places, blocks = [], []
        for t in np.unique(template).tolist():
            mine = template == t
            if index.phrase[t]:
                places += [(start, index.labels[t]) for start in index.places(ranks, block[mine], t, block_words, stride)]
            else:
                blocks += [(b * stride, index.labels[t], c / int(index.size[t])) for b, c in zip(block[mine].tolist(), common[mine].tolist())]
        return (len(words), [{"label": label, "start": s} for s, label in sorted(places)],
                [{"label": label, "start": s, "containment": c} for s, label, c in sorted(blocks)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(t) for t in text_bytes(batch.column(len(rest)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], kinds[0]), pa.array([f[2] for f in found], kinds[1])],
                                             [*rest, "n_words", "phrases", "blocks"])

    return docs.select(*rest, F.col(text_col).alias(free_name(docs, "_text"))).mapInArrow(run, schema)
