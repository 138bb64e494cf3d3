"""BPE encoding and decoding.

A word's symbols form a doubly linked list. A priority queue holds the merge
rank of every neighbouring pair; the lowest rank, leftmost first, is merged,
its new neighbours are queued, and entries whose symbols have changed
meanwhile are skipped as stale. Decoding joins the vocabulary's strings.

No token crosses white space and words repeat, so each Python worker keeps
bounded caches of what stands between white space and of single words. The
vocabulary is read once on the driver and broadcast (its size is fixed).
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import map_arrow, texts

#: Entries a worker's caches keep, in two generations.
CACHE_WORDS = 300_000
#: Characters that ``str.split`` takes for white space and the tokenizers do not.
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    symbols = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [symbols[b] for b in range(256)]


def merge(ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges (pair to rank and merged id) to a list of symbol ids, lowest rank first."""
    n = len(ids)
    ids = list(ids)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    queue = []
    for i in range(n - 1):
        found = merges.get((ids[i], ids[i + 1]))
        if found:
            queue.append((found[0], i, ids[i], ids[i + 1]))
    heapq.heapify(queue)
    while queue:
        _, i, a, b = heapq.heappop(queue)
        j = right[i]
        if j < 0 or ids[i] != a or ids[j] != b:
            continue
        ids[i] = merges[a, b][1]
        ids[j] = -1
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        for p, q in ((left[i], i), (i, right[i])):
            if p >= 0 and q >= 0:
                found = merges.get((ids[p], ids[q]))
                if found:
                    heapq.heappush(queue, (found[0], p, ids[p], ids[q]))
    return [x for x in ids if x >= 0]


def per_character_lower(text: str) -> str:
    """Lower case of each character by itself: a final sigma has no form of its own here."""
    return text.replace("Σ", "σ").lower() if "Σ" in text else text.lower()


#: ASCII signs that end a word and join nothing that follows.
ENDS = frozenset(".,;:!?")


def simple(text: str) -> list[str] | None:
    """The parts of letters with at most one sign behind them, which all patterns split alike; None for other text."""
    if text.isalpha():
        return [text]
    if text[-1:] in ENDS and text[:-1].isalpha():
        return [text[:-1], text[-1]]
    return None


@functools.cache
def late():
    """Finds characters the interpreter's tables lack; the tokenizers know later Unicode versions."""
    new = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"]
    firsts = [c for c, before in zip(new, [-1, *new]) if c != before + 1]
    lasts = [c for c, after in zip(new, [*new[1:], -1]) if after != c + 1]
    search = re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts)) + "]").search
    return lambda text: not text.isprintable() and search(text) is not None  # what the tables lack is not printable


class Cache(dict):
    """A mapping that computes what it lacks. A full one becomes the older generation, from which what is used again moves up."""

    def __init__(self, compute):
        self.compute, self.old = compute, {}

    def __missing__(self, key):
        out = self.old.get(key)
        if out is None:
            out = self.compute(key)
        if len(self) >= CACHE_WORDS // 2:
            self.old = dict(self)
            self.clear()
        self[key] = out
        return out

    def keep(self, items: Iterable[tuple]) -> None:
        """Put what was computed elsewhere into the younger generation."""
        if len(self) >= CACHE_WORDS // 2:
            self.old = dict(self)
            self.clear()
        self.update(items)


class WordBpe:
    """A tokenizer file with word ends; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        symbols = byte_symbols()
        self.inner = [vocab[c] for c in symbols]
        self.last = [vocab[c + suffix] for c in symbols]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in added.items()}
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in added.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(splits[0]).findall
        self.library = Tokenizer.from_str(content.decode())
        self.byte_of = {c: b for b, c in enumerate(symbols)}
        self.of_word = Cache(self.word)
        self.of_piece = Cache(lambda piece: b"".join(map(self.of_word.__getitem__, self.normal(piece))))

    def word(self, word: str) -> bytes:
        raw = word.encode()
        ids = merge([self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]], self.merges)
        return struct.pack(f"<{len(ids)}I", *ids)

    def normal(self, text: str) -> list[str]:
        """The words of a text. Characters newer than Python's tables are normalised and split by the library."""
        if not text.isascii() and late()(text):
            found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.byte_of.__getitem__, word)).decode() for word, _ in found]
        text = per_character_lower(unicodedata.normalize("NFC", text))
        return simple(text) or self.words(text)

    def plain(self, text: str) -> bytes:
        if SEPARATORS.search(text):
            return b"".join(map(self.of_word.__getitem__, self.normal(text)))
        return b"".join(map(self.of_piece.__getitem__, text.split()))

    def encode(self, text: str) -> bytes:
        """Ids of the text; special tokens written out in it become their ids, as the file asks for."""
        if "<" not in text or self.split_special is None:
            return self.plain(text)
        parts = self.split_special.split(text)
        return b"".join(self.special[p] if i % 2 else self.plain(p) for i, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        """The vocabulary's strings, a space between any two, since the file names no decoder."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def loaded(content: bytes) -> WordBpe:
    return WordBpe(content)


def rows(batches: Iterable[pa.RecordBatch], vocabulary, digests: bool) -> Iterator[pa.RecordBatch]:
    bpe = loaded(vocabulary.value)
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        out: list[list] = [[], [], [], []]
        for doc_id, text in zip(doc_ids, texts(batch.column(1))):
            ids = bpe.encode(text)
            decoded = bpe.decode(ids)
            first, second = (hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()) if digests else (ids, decoded)
            for column, value in zip(out, (doc_id, len(ids) // 4, first, second)):
                column.append(value)
        names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
        kinds = [pa.int64(), pa.int64(), pa.string() if digests else pa.binary(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, digests: bool = False) -> DataFrame:
    """Encode and decode every text.

    Input: doc_id, text; other columns are ignored. Output per row: doc_id,
    n_tokens, ids (little-endian unsigned 32-bit), decoded; with ``digests``
    the SHA-256 of ids and of the decoded text instead of both.

    A null text is the empty text: no tokens, decoded empty. Null and repeated
    doc_ids and repeated rows each keep their own row. A very long text is
    encoded word by word, so only its words and ids are in memory. An empty
    table gives an empty table.
    """
    with open(tokenizer_path, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    return map_arrow(
        docs.select("doc_id", "text"), lambda batches: rows(batches, vocabulary, digests), DIGESTS if digests else SCHEMA,
    )
