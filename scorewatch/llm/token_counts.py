"""Token counts by a two-tier lookup, without shuffling pre-tokens.

A pre-token here is what stands between two single spaces, with its leading
space; see ``pieces``. First tier: the token lengths of the most frequent
pre-tokens of all documents, found from bounded summaries of each task that
are merged in levels, encoded once and broadcast. Second tier: each worker's
bounded cache of pre-tokens it had to encode itself. The tiers only save
work; they never change a count.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import CACHE_WORDS
from .common import longs, map_arrow, texts
from .pieces import Pieces, loaded

#: Pre-tokens in the first tier, in a task's summary, and in a task while it counts.
FREQUENT, SUMMARY, COUNTED = 32_768, 8_192, 131_072
#: Summaries merged in one task, and at most so many on the driver.
FAN = 32
#: Stands for a stretch whose length depends on its neighbours; more than any text has tokens.
UNSURE = 1 << 48


class Lengths(dict):
    """The first tier; what it lacks is looked up in, or added to, the worker's own cache."""

    def __init__(self, pieces: Pieces, frequent: list[str], lengths: bytes):
        super().__init__(zip(frequent, lengths))
        self.pieces, self.own = pieces, {}

    def __missing__(self, piece: str) -> int:
        n = self.own.get(piece)
        if n is None:
            ids = self.pieces.stretch(piece)
            n = UNSURE if ids is None else len(ids) // 4
            if len(self.own) >= CACHE_WORDS:
                self.own.clear()
            self.own[piece] = n
        return n

    def count(self, text: str) -> int:
        if cut := self.pieces.stretches(text):
            n = sum(map(self.__getitem__, cut[1]))
            if n < UNSURE:
                return n + len(self.pieces.whole(cut[0])) // 4
        return len(self.pieces.whole(text)) // 4


@functools.lru_cache(maxsize=2)
def tiers(content: str, joined: str, lengths: bytes) -> Lengths:
    return Lengths(loaded(content), joined.split("\0") if lengths else [], lengths)


def top(counts: Counter, n: int) -> pa.RecordBatch:
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]
    return pa.RecordBatch.from_arrays(
        [pa.array([[p for p, _ in best]], pa.list_(pa.string())), pa.array([[c for _, c in best]], pa.list_(pa.int64()))],
        names=["pieces", "counts"],
    )


def summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bounded summary of the task's pre-tokens."""
    counts: Counter = Counter()
    for batch in batches:
        for text in texts(batch.column(0)):
            counts.update(text.split(" ")[1:])
            if len(counts) > COUNTED:
                counts = Counter(dict(counts.most_common(COUNTED // 2)))
    yield top(counts, SUMMARY)


def merged(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for pieces, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for piece, number in zip(pieces, numbers):
                counts[piece] += number
    yield top(counts, n)


def frequent_pieces(docs: DataFrame, n: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all documents, as far as bounded summaries can tell."""
    schema = "pieces array<string>, counts array<long>"
    parts = docs.rdd.getNumPartitions()
    found = map_arrow(docs.select("text"), summaries, schema)
    while parts > FAN:
        parts = -(-parts // FAN)
        found = map_arrow(found.repartition(parts), lambda batches: merged(batches, n), schema)
    total: Counter = Counter()
    for pieces, numbers in found.collect():  # at most FAN rows of at most n entries
        for piece, number in zip(pieces, numbers):
            total[piece] += number
    return [p for p, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:n] if "\0" not in p]


def counted(batches: Iterable[pa.RecordBatch], vocabulary, frequent, limit: int) -> Iterator[pa.RecordBatch]:
    lengths = tiers(vocabulary.value, *frequent.value)
    for batch in batches:
        n_bytes, n_tokens = [], []
        for text in texts(batch.column(1)):
            n_bytes.append(len(text.encode()))
            n_tokens.append(lengths.count(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), longs(n_bytes), longs(n_tokens), pa.array([n > limit for n in n_tokens], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """Tokens of every text, as the library counts them for a byte-level tokenizer file.

    Input: doc_id, text; other columns are ignored. Output per row: doc_id,
    n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    A null text counts as empty: 0 bytes, 0 tokens. Null and repeated doc_ids
    and repeated rows keep a row each. Long texts are split whole. An empty
    table gives an empty table.
    """
    context = docs.sparkSession.sparkContext
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = context.broadcast(f.read())
    docs = docs.select("doc_id", "text")
    pieces = loaded(vocabulary.value)
    encoded = ((p, pieces.stretch(p)) for p in frequent_pieces(docs))
    best = [(p, len(ids) // 4) for p, ids in encoded if ids is not None and len(ids) < 1024]
    frequent = context.broadcast(("\0".join(p for p, _ in best), bytes(n for _, n in best)))
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_arrow(docs, lambda batches: counted(batches, vocabulary, frequent, limit), schema)
