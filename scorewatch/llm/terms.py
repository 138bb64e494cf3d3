"""Terms of a text: its ASCII letters and digits and all that is not ASCII, A-Z lower-cased, split at the rest."""

from __future__ import annotations

import string
from collections.abc import Iterator

from pyspark.sql import Column, functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
#: Each byte as it stands in a term, or a space. In UTF-8 the bytes of all other characters are above 127.
FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))
#: The same for DuckDB: the terms of ``{}`` as a list.
TERMS_SQL = "regexp_extract_all(translate({}, '" + UPPER + "', '" + LOWER + "'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def terms(text: str) -> list[bytes]:
    """The terms in order, as UTF-8."""
    return text.encode().translate(FOLD).split()


def pieces(text: str, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """The same, some megabytes of text at a time, so that a very long text is never a list of all its terms."""
    folded, start = text.encode().translate(FOLD), 0
    while start < len(folded):
        stop = start + size
        if stop < len(folded):
            space = folded.rfind(b" ", start, stop)
            stop = folded.find(b" ", stop) if space < 0 else space
            stop = len(folded) if stop < 0 else stop
        yield folded[start:stop].split()
        start = stop + 1


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` would change other letters too."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
