"""Tokens, JSON text and hashes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .fixed import INTEGER_PATTERN, LINE_BREAK, WHITESPACE

# The plain ASCII range comes first because it settles most characters with one comparison.
NOT_WHITESPACE = "[!-~[^" + WHITESPACE[1:] + "]"


def is_blank(text: Column) -> Column:
    """Nothing but separators."""
    return ~text.rlike(NOT_WHITESPACE)


def strip(text: Column) -> Column:
    """Remove separators at both ends."""
    return F.regexp_extract(text, f"(?s)({NOT_WHITESPACE}(?:.*{NOT_WHITESPACE})?)", 1)


def tokens(text: Column) -> Column:
    """Array of the tokens between runs of separators, found in one pass; empty for blank text."""
    return F.regexp_extract_all(text, F.lit(f"{NOT_WHITESPACE}+"), F.lit(0))


def token_count(text: Column) -> Column:
    """``size(tokens(text))`` without building the tokens."""
    return F.regexp_count(text, F.lit(f"{NOT_WHITESPACE}+"))


def lines(text: Column) -> Column:
    """Array of lines; a closing line break adds no further line."""
    parts = F.split(text, LINE_BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def is_integer(text: Column) -> Column:
    """Integer text that also fits 64 bits."""
    return text.rlike(INTEGER_PATTERN) & text.try_cast("bigint").isNotNull()


def canonical_json(fields: Mapping[str, Column], quoted: Mapping[str, bool]) -> Column:
    """Object text with sorted keys and the separators ``", "`` and ``": "``.

    ``quoted[name]`` says whether the value is text. Null becomes ``null``.
    """
    parts: list[Column] = []
    for position, name in enumerate(sorted(fields)):
        value = quote(fields[name]) if quoted.get(name) else fields[name].cast("string")
        prefix = ("" if position == 0 else ", ") + f'"{name}": '
        parts.append(F.concat(F.lit(prefix), F.coalesce(value, F.lit("null"))))
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def quote(text: Column) -> Column:
    """Quote text for JSON; non-ASCII characters become ``\\uXXXX`` escapes."""
    literal = F.to_json(F.array(text))
    inner = F.substr(literal, F.lit(2), F.length(literal) - 2)
    plain = ~text.rlike(r"[^\x00-\x7f]")
    units = F.transform(
        F.split(inner, ""),
        lambda ch: F.when(
            ch.rlike(r"[^\x00-\x7f]"),
            F.regexp_replace(F.lower(F.hex(F.encode(ch, "UTF-16BE"))), "(....)", r"\\u$1"),
        ).otherwise(ch),
    )
    return F.when(plain, inner).when(text.isNotNull(), F.array_join(units, ""))


def input_hash(canonical: Column) -> Column:
    """SHA-256 of canonical request text."""
    return F.sha2(canonical, 256)


def request_id() -> Column:
    """A random id for each row (UUID version 4); write it before it is used twice."""
    return F.uuid()


def utc_stamp(ts: Column) -> Column:
    """ISO time with a trailing ``Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
