"""Byte-level pre-tokens and their ids, encoded once per worker with the tokenizers library."""

from __future__ import annotations

import functools
import json
import struct
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from .bpe import Cache, byte_symbols, late, simple
from .merging import LONGEST, Merges

#: How byte-level vocabularies split text before merging (a fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of the texts that are looked through at a time.
GROUP_CHARS = 1 << 22


def newer(text: str) -> bool:
    """Whether a text has characters that are newer than Python's tables, which are none of its printable ones."""
    return not text.isascii() and not text.isprintable() and late()(text)


class Pieces:
    """A byte-level tokenizer file.

    A stretch is what stands between two single spaces, its leading space
    included. If it neither starts nor ends with more white space, no pre-token
    crosses its borders, so its ids do not depend on its neighbours.
    """

    def __init__(self, content: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.find = regex.compile(PATTERN).findall
        symbols = byte_symbols()
        self.symbol = dict(enumerate(symbols))
        self.byte_of = {c: b for b, c in enumerate(symbols)}
        self.of_pretoken = Cache(self.pretoken)
        self.of_stretch = Cache(self.stretch)
        model = json.loads(content)["model"]
        self.merges = None
        if not model.get("dropout") and not model.get("ignore_merges") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"):
            ids, pairs = model["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
            if all(c in ids for c in symbols):
                self.merges = Merges([(ids[x], ids[y]) for x, y in pairs], [ids[x + y] for x, y in pairs], max(ids.values()) + 1)
                self.byte_ids = np.array([ids[c] for c in symbols], np.int64)
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[i for t, i in model["vocab"].items() if t.startswith(symbols[32])]] = True

    def split(self, text: str) -> list[str]:
        """Pre-tokens; characters newer than Python's tables are split by the library."""
        if newer(text):
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
            return [bytes(map(self.byte_of.__getitem__, piece)).decode() for piece, _ in found]
        return self.find(text)

    def pretoken(self, piece: str) -> bytes:
        tokens = self.tokenizer.model.tokenize("".join(map(self.symbol.__getitem__, piece.encode())))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def stretch(self, text: str) -> bytes | None:
        """Ids of a space and the text; None if they depend on what stands around it."""
        if not text or text[0].isspace() or text[-1].isspace():
            return None
        if parts := simple(text):
            return b"".join(map(self.of_pretoken.__getitem__, [" " + parts[0], *parts[1:]]))
        return b"".join(map(self.of_pretoken.__getitem__, self.split(" " + text)))

    def has_special(self, text: str) -> bool:
        return "<" in text and self.split_special is not None and self.split_special.search(text) is not None

    def whole(self, text: str) -> bytes:
        """Ids of a text without the shortcut by stretches; special tokens written out become their ids."""
        if not self.has_special(text):
            return b"".join(map(self.of_pretoken.__getitem__, self.split(text)))
        cut = self.split_special.split(text)
        return b"".join(struct.pack("<I", self.special[p]) if i % 2 else self.whole(p) for i, p in enumerate(cut))

    def stretches(self, text: str) -> tuple[str, list[str]] | None:
        """The text before the first space, and the stretches; None if the whole text must be split at once."""
        first, *rest = text.split(" ")
        if not first or first[-1].isspace() or self.has_special(text):
            return None
        return first, rest

    def learn(self, new: list[str]) -> list[bytes | None]:
        """Ids of stretches that the cache lacks, as ``stretch`` gives them; most are merged together.

        Stretches hold no space, so their pre-tokens are found in one pass over all of them, and the tokens that begin
        with a space are where a stretch begins. Byte 255 never occurs in UTF-8 and stands between pre-tokens here.
        """
        plain = [bool(s) and len(s) <= LONGEST and s.strip() == s and not newer(s) for s in new] if self.merges else [False] * len(new)
        some = [s for s, is_plain in zip(new, plain) if is_plain]
        packed, cut = b"", [0]
        if some:
            raw = np.frombuffer(b"\xff".join(map(str.encode, self.find(" " + " ".join(some)))), np.uint8)
            marks = np.flatnonzero(raw == 255)
            starts, ends = np.r_[0, marks + 1], np.r_[marks, len(raw)]
            ids, _ = self.merges.ids(self.byte_ids[raw], starts, ends - starts)
            cut, packed = [*(np.flatnonzero(self.spaced[ids]) * 4).tolist(), len(ids) * 4], ids.tobytes()
        merged = (packed[a:b] for a, b in zip(cut, cut[1:]))
        return [next(merged) if is_plain else self.stretch(s) for s, is_plain in zip(new, plain)]

    def known(self, each: list[str]) -> list[bytes | None]:
        """Ids of different stretches, from the cache where it has them."""
        found = list(map(self.of_stretch.get, each, repeat(b"")))
        lacks = [i for i, ids in enumerate(found) if ids == b""]
        if lacks:
            for i in lacks:
                found[i] = self.of_stretch.old.get(each[i], b"")
            new = [i for i in lacks if found[i] == b""]
            for i, ids in zip(new, self.learn([each[i] for i in new])):
                found[i] = ids
            self.of_stretch.keep((each[i], found[i]) for i in lacks)
        return found

    def encode_all(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts of a column, a group of texts at a time: all ids, and where those of each text end."""
        column = column.fill_null("")
        sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(column):
            stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + GROUP_CHARS, "right")))
            yield self.encode_group(column.slice(start, stop - start))
            start = stop

    def encode_group(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each stretch that the texts have is looked up once; those that are new are encoded together."""
        parts = pc.split_pattern(column, " ")
        cuts, coded = parts.offsets.to_numpy().astype(np.int64), parts.flatten().dictionary_encode()
        cuts -= cuts[0]
        codes, each = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
        known = self.known(each)
        # The text before the first space stands for itself, and so does a whole text that cannot be cut at its spaces.
        alone = np.array([ids is None for ids in known], bool)[codes]
        alone[cuts[:-1]] = False
        firsts = coded.take(pa.array(cuts[:-1])).to_pylist()
        whole = np.logical_or.reduceat(alone, cuts[:-1]) | np.array([not f or f[-1].isspace() for f in firsts], bool)
        for i in np.flatnonzero(pc.match_substring(column, "<").to_numpy(zero_copy_only=False)).tolist():
            whole[i] = whole[i] or self.has_special(column[i].as_py())
        own = [self.whole(column[i].as_py() if w else f) for i, (f, w) in enumerate(zip(firsts, whole.tolist()))]
        table = [b"" if ids is None else ids for ids in known] + own
        codes[cuts[:-1]] = len(known) + np.arange(len(own))
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        begins = np.cumsum(sizes) - sizes
        sizes = sizes[codes]
        sizes[np.repeat(whole, np.diff(cuts)) & (codes < len(known))] = 0
        ends = np.cumsum(sizes)
        at = np.repeat(begins[codes] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
        return np.frombuffer(b"".join(table), "<u4")[at], ends[cuts[1:] - 1]

    def joined(self, text: str, cut: tuple[str, list[str]] | None) -> bytes:
        if cut:
            try:
                return self.whole(cut[0]) + b"".join(map(self.of_stretch.__getitem__, cut[1]))
            except TypeError:  # one of them is None
                pass
        return self.whole(text)

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        return self.joined(text, self.stretches(text))


@functools.lru_cache(maxsize=2)
def loaded(content: str) -> Pieces:
    return Pieces(content)
