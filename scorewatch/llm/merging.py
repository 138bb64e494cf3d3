"""Byte-pair merges of many words at once, one merge of each word a step."""

from __future__ import annotations

import numpy as np

#: Characters of the longest word that is merged here, and steps by which widths of the tables grow.
LONGEST, WIDTH = 64, 4
#: Stands for no rank.
NEVER = np.int32(1 << 30)


class Merges:
    """Ranks of symbol pairs in an open hash table of arrays, and what each pair becomes."""

    def __init__(self, pairs: list[tuple[int, int]], becomes: list[int], symbols: int):
        self.symbols = symbols
        self.becomes = np.array([*becomes, -1], np.int64)
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.ranks, self.probes = np.full(size, -1, np.int64), np.full(size, NEVER, np.int32), 1
        keys = np.array([a * symbols + b for a, b in pairs], np.int64)
        slots = self.slot(keys).tolist()
        for rank, (key, slot) in enumerate(zip(keys.tolist(), slots)):
            probe = 1
            while self.keys[slot] not in (-1, key):
                slot, probe = (slot + 1) % size, probe + 1
            if self.keys[slot] == -1:
                self.keys[slot], self.ranks[slot] = key, rank
            self.probes = max(self.probes, probe)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; a side of -1 has none."""
        keys = np.where((left < 0) | (right < 0), np.int64(-2), left * self.symbols + right)
        slots = self.slot(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.ranks[slots], NEVER)
        other = np.flatnonzero((held != keys) & (held != -1) & (keys >= 0))
        for probe in range(1, self.probes):
            if not len(other):
                break
            at = (slots.ravel()[other] + probe) % len(self.keys)
            held, wanted = self.keys[at], keys.ravel()[other]
            out.ravel()[other] = np.where(held == wanted, self.ranks[at], out.ravel()[other])
            other = other[(held != wanted) & (held != -1)]
        return out

    def merge(self, words: np.ndarray) -> np.ndarray:
        """The final symbols of each row, padded with -1 as the rows given are."""
        out = np.full(words.shape, -1, np.int64)
        rows, now = np.arange(len(words)), words
        ranks = self.rank(now[:, :-1], now[:, 1:])
        while now.shape[1] > 1:
            best = ranks.argmin(1)
            least = np.take_along_axis(ranks, best[:, None], 1)[:, 0]
            done = least == NEVER
            if done.any():
                out[rows[done], :now.shape[1]] = now[done]
                more = ~done
                rows, now, ranks, best, least = rows[more], now[more], ranks[more], best[more], least[more]
            if not len(rows):
                return out
            each = np.arange(len(rows))
            now[each, best] = self.becomes[least]
            columns = np.arange(now.shape[1] - 1)
            now = np.take_along_axis(now, columns + (columns > best[:, None]), 1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= best[:, None]), 1)
            new = now[each, best]
            has = best > 0
            ranks[each[has], best[has] - 1] = self.rank(now[each[has], best[has] - 1], new[has])
            has = best < now.shape[1] - 1
            ranks[each[has], best[has]] = self.rank(new[has], now[each[has], best[has] + 1])
        out[rows, :now.shape[1]] = now
        return out

    def ids(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and how many each has. Words are ``sizes`` symbols at ``starts``, some dozens at most."""
        counts = np.zeros(len(starts), np.int64)
        found = []
        widths = -(-np.maximum(sizes, 1) // WIDTH) * WIDTH
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            columns = np.arange(width)
            inside = columns < sizes[own, None]
            at = np.where(inside, starts[own, None] + columns, 0)
            merged = self.merge(np.where(inside, symbols[at], -1))
            counts[own] = (merged >= 0).sum(1)
            found.append((own, merged))
        ends = np.cumsum(counts)
        flat = np.empty(int(ends[-1]) if len(ends) else 0, "<u4")
        for own, merged in found:
            columns = np.arange(merged.shape[1])
            held = columns < counts[own, None]
            flat[((ends - counts)[own, None] + columns)[held]] = merged[held]
        return flat, counts
