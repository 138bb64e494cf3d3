"""Deliberate damage to data: label noise, missing labels, shifts, bad values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.text import tokens
from ..session import materialise
from .contract import Contract
from .ordered import ColumnSketch, order_statistics

# 13 hex digits are 52 bits, which a double holds exactly.
_DIGITS = 13


def shuffle_key(key: Column, seed: int) -> Column:
    """A reproducible pseudo-random number in [0, 2^52) for a row key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double")


def _marks_round(rank: int, rows: int) -> ColumnSketch:
    """Hashes are uniform, so a rank's value is known up to a few deviations; two marks enclose it."""
    top = float(1 << 4 * _DIGITS)
    centre, spread = rank / rows, 8.0 / math.sqrt(rows)
    marks = tuple(m * top for m in (centre - spread, centre + spread) if 0.0 < m < 1.0)
    return ColumnSketch(rows, 0.0, top, marks)


def pick_exactly(df: DataFrame, key: str, fraction: float, seed: int = fixed.SEED) -> DataFrame:
    """Add ``picked``, true on exactly ``int(rows * fraction)`` rows, chosen by hashed key.

    The hash of the last chosen row is found by exact selection and becomes a
    literal, so the choice is a filter. Should rows share this one hash and not
    all be wanted, as rows of equal or null keys do, they are told apart by a
    number that is fixed by writing the rows once.
    """
    rows = df.count()
    wanted = int(rows * fraction)
    if wanted <= 0:
        return df.withColumn("picked", F.lit(False))
    hashed = df.withColumn("__h", shuffle_key(F.col(key), seed))
    marks = {"__h": _marks_round(wanted - 1, rows)}
    last = order_statistics(hashed, {"__h": [wanted - 1]}, marks)["__h"][wanted - 1]
    picked = F.col("__h") <= last.value
    open_places = wanted - last.below
    if open_places < last.rows:
        hashed = materialise(hashed.withColumn("__n", F.monotonically_increasing_id()), "numbered")
        ties = hashed.where(F.col("__h") == last.value)
        edge = order_statistics(ties, {"__n": [open_places - 1]})["__n"][open_places - 1]
        picked = (F.col("__h") < last.value) | ((F.col("__h") == last.value) & (F.col("__n") <= edge.value))
    return hashed.withColumn("picked", picked).drop("__h", "__n")


def inject_label_noise(
    df: DataFrame,
    key: str,
    label: str,
    fraction: float = fixed.NOISE_FRACTION,
    kind: str = "flip",
    seed: int = fixed.SEED,
    out: str = "noisy_label",
) -> DataFrame:
    """Add a noisy copy of a 0/1 label: ``flip`` it, or set it to the ``majority`` class (0 on a tie)."""
    if kind not in ("flip", "majority"):
        raise ValueError(f"unknown noise kind {kind!r}")
    marked = pick_exactly(df, key, fraction, seed)
    if kind == "flip":
        replacement = 1 - F.col(label)
    else:
        ones, rows = df.agg(F.count_if(F.col(label) == 1), F.count(label)).first()
        replacement = F.lit(1 if ones > rows - ones else 0)
    return marked.withColumn(out, F.when(F.col("picked"), replacement).otherwise(F.col(label)).cast("int")).drop("picked")


def noise_metadata(
    noisy: DataFrame, label: str, out: str = "noisy_label", fraction: float = fixed.NOISE_FRACTION,
    kind: str = "flip", seed: int = fixed.SEED,
) -> DataFrame:
    """One row: requested and actual noise, and how many labels went which way."""
    changed = F.col(label) != F.col(out)
    return noisy.agg(
        F.lit(float(fraction)).alias("noise_fraction_requested"),
        F.avg(changed.cast("double")).alias("noise_fraction_actual"),
        F.count(F.lit(1)).alias("total_labels"),
        F.count_if(changed).alias("num_flipped"),
        F.count_if((F.col(label) == 0) & (F.col(out) == 1)).alias("num_0_to_1_flips"),
        F.count_if((F.col(label) == 1) & (F.col(out) == 0)).alias("num_1_to_0_flips"),
        F.lit(kind).alias("noise_type"),
        F.lit(seed).alias("seed"),
    )


def inject_missing_labels(
    df: DataFrame, key: str, label: str, fraction: float = fixed.MISSING_FRACTION,
    seed: int = fixed.SEED, out: str = "late_label",
) -> DataFrame:
    """Add a copy of the label that is null on exactly ``int(rows * fraction)`` rows."""
    marked = pick_exactly(df, key, fraction, seed)
    return marked.withColumn(out, F.when(~F.col("picked"), F.col(label))).drop("picked")


def missing_label_metadata(
    df: DataFrame, out: str = "late_label", fraction: float = fixed.MISSING_FRACTION,
    delay_days: int = fixed.LABEL_DELAY_DAYS,
) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_labels"),
        F.count_if(F.col(out).isNull()).alias("missing_labels"),
        F.count(out).alias("available_labels"),
        F.lit(float(fraction)).alias("missing_fraction"),
        F.lit(int(delay_days)).alias("simulated_delay_days"),
    )


def append_token(line: Column, token: str = fixed.EXTRA_TOKEN) -> Column:
    """A row with one token too many."""
    return F.concat(line, F.lit(" " + token))


def _shift_text(token: Column, offset: float, signed: bool) -> Column:
    """Integer text plus the whole part of the offset; other numbers plus the offset; else unchanged."""
    whole = F.lit(int(offset))
    integer = r"^-?[0-9]+$" if signed else r"^[0-9]+$"
    as_int = token.try_cast("bigint")
    # Spark reads a type suffix as part of a number ("1d"); such text is no number here.
    number = token.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    as_float = token.try_cast("double") + float(offset)
    return (
        F.when(token.rlike(integer) & as_int.isNotNull(), (as_int + whole).cast("string"))
        .when(number, as_float.cast("string"))
        .otherwise(token)
    )


def shift_tokens(line: Column, offset: float = 2.0) -> Column:
    """Shift every numeric token of a row except the last (the target)."""
    parts = tokens(line)
    last = F.size(parts)
    shifted = F.transform(
        parts, lambda t, i: F.when((i == last - 1) & (last > 1), t).otherwise(_shift_text(t, offset, False))
    )
    return F.array_join(shifted, " ")


def shift_contract_tokens(line: Column, contract: Contract, offset: float = 2.0) -> Column:
    """Shift only the tokens the contract declares as integers; rows that are too short stay."""
    places = [i for i, f in enumerate(contract.fields) if f.kind == "integer"]
    parts = tokens(line)
    shifted = F.transform(
        parts, lambda t, i: F.when(i.isin(places), _shift_text(t, offset, True)).otherwise(t)
    )
    enough = F.size(parts) >= max(places, default=-1) + 1
    return F.when(enough, F.array_join(shifted, " ")).otherwise(line)


def shift_columns(df: DataFrame, columns: Sequence[str], offset: float = 2.0) -> DataFrame:
    """The same shift on typed numeric columns."""
    types = dict(df.dtypes)
    amounts = {c: F.lit(int(offset) if "int" in types[c] else float(offset)) for c in columns}
    return df.withColumns({c: (F.col(c) + amounts[c]).cast(types[c]) for c in columns})


def bad_category(df: DataFrame, column: str, row_index: Column, rows: int = 50, value: str = fixed.BAD_CATEGORY) -> DataFrame:
    """Replace a category in the rows whose index is below ``rows``."""
    return df.withColumn(column, F.when(row_index < rows, value).otherwise(F.col(column)))


def bad_category_token(line: Column, row_index: Column, rows: int = 50, value: str = fixed.BAD_CATEGORY) -> Column:
    """The same on token text: the second token of the first rows."""
    parts = tokens(line)
    changed = F.transform(parts, lambda t, i: F.when(i == 1, value).otherwise(t))
    return F.array_join(F.when(row_index < rows, changed).otherwise(parts), " ")


def drop_key(payload: Column, key: str) -> Column:
    """A JSON request without one of its keys."""
    fields = F.from_json(payload, "map<string,string>")
    return F.to_json(F.map_filter(fields, lambda k, v: k != key))
