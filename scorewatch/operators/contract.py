"""Declared contracts for tables and scoring requests, and their violations."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import fixed
from ..functions.text import is_integer, tokens
from ..session import local_table

RULES = ("empty_row", "column_count", "integer", "membership")

VIOLATION = "array<struct<ordinal:int,field:string,rule:string,value:string>>"


class ContractError(ValueError):
    """The data, or the declaration itself, breaks the contract."""


@dataclass(frozen=True)
class Field:
    """One column's declaration."""

    name: str
    kind: str
    allowed: tuple[str, ...] = ()

    def __post_init__(self):
        if self.kind not in fixed.FIELD_TYPES:
            raise ContractError(f"field {self.name!r} has unknown type {self.kind!r}")


@dataclass(frozen=True)
class Contract:
    """A table's declaration; ``extra`` carries whatever else its document held."""

    name: str
    fields: tuple[Field, ...]
    target: str | None = None
    expected_rows: int | None = None
    expected_columns: int | None = None
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def width(self) -> int:
        return self.expected_columns if self.expected_columns is not None else len(self.fields)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def of_kind(self, *kinds: str) -> list[str]:
        return [f.name for f in self.fields if f.kind in kinds and f.name != self.target]

    @property
    def categorical(self) -> list[str]:
        return self.of_kind("categorical")

    @property
    def numeric(self) -> list[str]:
        return self.of_kind("integer")

    @property
    def features(self) -> list[str]:
        """Model inputs in contract order: neither target nor timestamps."""
        return self.of_kind("categorical", "integer")

    def struct(self) -> T.StructType:
        """Spark schema of loaded rows, with the declaration as metadata."""
        types = {
            "integer": T.LongType(), "timestamp": T.StringType(),
            "categorical": T.StringType(), "target": T.IntegerType(),
        }
        return T.StructType(
            [
                T.StructField(f.name, types[f.kind], True, {"contract_type": f.kind, "allowed_values": list(f.allowed)})
                for f in self.fields
            ]
        )

    @staticmethod
    def from_dict(doc: dict) -> "Contract":
        used = {"dataset_name", "fields", "target_column", "expected_rows", "expected_columns"}
        return Contract(
            name=doc["dataset_name"],
            fields=tuple(
                Field(f["name"], f["type"], tuple(str(v) for v in f.get("allowed_values", ()))) for f in doc["fields"]
            ),
            target=doc.get("target_column"),
            expected_rows=doc.get("expected_rows"),
            expected_columns=doc.get("expected_columns"),
            extra={k: v for k, v in doc.items() if k not in used},
        )

    @staticmethod
    def load(path: str | Path) -> "Contract":
        """Read a JSON declaration on the driver."""
        return Contract.from_dict(json.loads(Path(path).read_text()))

    def rules(self, spark: SparkSession) -> DataFrame:
        """One row per field and allowed value (one row with null where any value goes)."""
        rows = [
            (i, f.name, f.kind, value) for i, f in enumerate(self.fields) for value in (f.allowed or (None,))
        ]
        return local_table(spark, rows, "ordinal int, field string, kind string, allowed string")


def _entry(ordinal: int, name: str, rule: str, value: Column) -> Column:
    return F.struct(
        F.lit(ordinal).alias("ordinal"), F.lit(name).alias("field"), F.lit(rule).alias("rule"), value.alias("value")
    )


def _none() -> Column:
    return F.lit(None).cast("struct<ordinal:int,field:string,rule:string,value:string>")


def field_checks(contract: Contract, value_of) -> list[Column]:
    """A violation struct, or null, for each field; ``value_of(i, field)`` is its text."""
    checks = []
    for i, spec in enumerate(contract.fields):
        value = value_of(i, spec)
        if spec.kind == "integer":
            checks.append(F.when(~F.coalesce(is_integer(value), F.lit(False)), _entry(i, spec.name, "integer", value)).otherwise(_none()))
        elif spec.kind in ("categorical", "target"):
            inside = F.coalesce(value.isin(list(spec.allowed)), F.lit(False))
            checks.append(F.when(~inside, _entry(i, spec.name, "membership", value)).otherwise(_none()))
    return checks


TOKENS = "__tokens"


def with_tokens(lines: DataFrame, line: str = "value") -> DataFrame:
    """Split each row once; everything after works on the ``__tokens`` array."""
    return lines.withColumn(TOKENS, tokens(F.col(line)))


def token_violations(contract: Contract, line: str = "value") -> Column:
    """All violations of one split row, in field order, as an array."""
    parts = F.col(TOKENS)
    count = F.size(parts)
    checks = field_checks(contract, lambda i, _: F.get(parts, i))
    return (
        F.when(F.coalesce(count, F.lit(0)) < 1, F.array(_entry(-1, "", "empty_row", F.col(line))))
        .when(count != contract.width, F.array(_entry(-1, "", "column_count", count.cast("string"))))
        .otherwise(F.filter(F.array(*checks) if checks else F.array().cast(VIOLATION), lambda v: v.isNotNull()))
    )


def contract_violations(lines: DataFrame, contract: Contract, row_id: str, line: str = "value") -> DataFrame:
    """Every violation: (row_id, ordinal, field, rule, value). One scan, no shuffle."""
    return with_tokens(lines, line).select(F.col(row_id).alias("row_id"), F.inline(token_violations(contract, line)))


def row_count_violation(lines: DataFrame, contract: Contract) -> DataFrame:
    """One row when the number of lines differs from the declared one."""
    counted = lines.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("rows", F.lit(contract.expected_rows).cast("bigint").alias("expected")).where(
        F.col("expected").isNotNull() & (F.col("rows") != F.col("expected"))
    )


def first_violation(violations: DataFrame) -> DataFrame:
    """The violation a row-by-row reader would meet first. A top-1, not a sort."""
    return violations.orderBy("row_id", "ordinal").limit(1)


def _typed(contract: Contract) -> list[Column]:
    columns = []
    for i, spec in enumerate(contract.fields):
        value = F.get(F.col(TOKENS), i)
        if spec.kind == "integer":
            value = F.when(is_integer(value), value.try_cast("bigint"))
        elif spec.kind in ("categorical", "target"):
            value = F.when(value.isin(list(spec.allowed)), value)
            if spec.kind == "target":
                value = value.try_cast("int")
        columns.append(value.alias(spec.name))
    return columns


def parse_rows(lines: DataFrame, contract: Contract, keep: Sequence[str] = (), line: str = "value") -> DataFrame:
    """Typed columns in contract order; values that break a rule become null."""
    return with_tokens(lines, line).select(*keep, *_typed(contract))


def _is_valid(contract: Contract) -> Column:
    """Whether a split row breaks no rule; plain comparisons only."""
    fine = F.size(F.col(TOKENS)) == contract.width
    for i, spec in enumerate(contract.fields):
        value = F.get(F.col(TOKENS), i)
        if spec.kind == "integer":
            fine = fine & is_integer(value)
        elif spec.kind in ("categorical", "target"):
            fine = fine & value.isin(list(spec.allowed))
    return F.coalesce(fine, F.lit(False))


def valid_rows(lines: DataFrame, contract: Contract, keep: Sequence[str] = (), line: str = "value") -> DataFrame:
    """Typed rows of the lines that break no rule."""
    return with_tokens(lines, line).where(_is_valid(contract)).select(*keep, *_typed(contract))


def load_validated(lines: DataFrame, contract: Contract, row_id: str, line: str = "value") -> DataFrame:
    """Typed rows, or ``ContractError`` naming the first violation."""
    bad = first_violation(contract_violations(lines, contract, row_id, line)).collect()
    if bad:
        v = bad[0]
        raise ContractError(f"row {v['row_id']}: {v['rule']} {v['field']} {v['value']!r}".replace("  ", " "))
    miscounted = row_count_violation(lines, contract).collect()
    if miscounted:
        raise ContractError(f"{miscounted[0]['rows']} rows; expected {miscounted[0]['expected']}")
    return parse_rows(lines, contract, [row_id], line)


def dataset_summary(rows: DataFrame, contract: Contract, data_hash: str | None = None) -> DataFrame:
    """Rows per target value together with the table's size and content hash."""
    counts = rows.groupBy(F.col(contract.target).alias("target")).agg(F.count(F.lit(1)).alias("target_rows"))
    # One row per target value of the contract, so the total is a sum over very few rows.
    return counts.select(
        F.lit(contract.name).alias("dataset_name"),
        F.sum("target_rows").over(Window.partitionBy()).alias("rows"),
        F.lit(contract.width).alias("columns"),
        F.lit(data_hash).cast("string").alias("data_hash"),
        "target",
        "target_rows",
    )


def feature_frame(rows: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Only the model inputs, in contract order."""
    return rows.select(*keep, *contract.features)


def target_series(rows: DataFrame, contract: Contract) -> Column:
    return F.col(contract.target).cast("int")


# ---- scoring requests --------------------------------------------------------


def payload_fields(payload: Column) -> Column:
    """Keys and values of a JSON request as a map; null when it is no object."""
    return F.from_json(payload, "map<string,string>")


def request_violations(
    fields: str, contract: Contract, ranges: dict[str, tuple[int, int]] = fixed.REQUEST_RANGES
) -> Column:
    """All violations of one request, given the name of its ``payload_fields`` column, as an array.

    Rules in order: not an object, keys beyond the contract, missing keys,
    numbers that are no integers, integers out of range, values outside the
    allowed set. Target and timestamps are no part of a request.
    """
    wanted = contract.features
    given = F.col(fields)
    extras = F.transform(
        F.array_sort(F.array_except(F.map_keys(given), F.array(*[F.lit(n) for n in wanted]))),
        lambda k: F.struct(F.lit(-1).alias("ordinal"), k.alias("field"), F.lit("extra").alias("rule"), F.lit(None).cast("string").alias("value")),
    )
    checks = []
    by_name = {f.name: (i, f) for i, f in enumerate(contract.fields)}
    for name in wanted:
        i, spec = by_name[name]
        value = F.try_element_at(given, F.lit(name))
        check = F.when(value.isNull(), _entry(i, name, "missing", value))
        if spec.kind == "integer":
            # Whole numbers may be written with a fraction of zero or an exponent, 30.0 or 3e1.
            number = value.try_cast("double")
            written = value.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$") & (number == F.floor(number)) & (F.abs(number) < 2.0**53)
            whole = is_integer(value) | F.coalesce(written, F.lit(False))
            check = check.when(~whole, _entry(i, name, "integer", value))
            if name in ranges:
                low, high = ranges[name]
                check = check.when(~F.coalesce(value.try_cast("bigint").cast("double"), number).between(low, high), _entry(i, name, "range", value))
        else:
            check = check.when(~value.isin(list(spec.allowed)), _entry(i, name, "membership", value))
        checks.append(check.otherwise(_none()))
    found = F.concat(extras, F.filter(F.array(*checks), lambda v: v.isNotNull()))
    return F.when(given.isNull(), F.array(_entry(-1, "", "not_an_object", F.lit(None).cast("string")))).otherwise(found)


def validate_requests(
    df: DataFrame, request_id: str, payload: str, contract: Contract,
    ranges: dict[str, tuple[int, int]] = fixed.REQUEST_RANGES,
) -> DataFrame:
    """Every violation of every request: (request_id, ordinal, field, rule, value)."""
    parsed = df.select(request_id, payload_fields(F.col(payload)).alias("__fields"))
    return parsed.select(request_id, F.inline(request_violations("__fields", contract, ranges)))


MALFORMED_RULES = ("not_an_object", "extra", "missing", "range", "integer")


def request_flags(violations: Column) -> dict[str, Column]:
    """``malformed`` (shape, type, range) and ``validation_error`` (membership) flags."""
    malformed = F.exists(violations, lambda v: v["rule"].isin(*MALFORMED_RULES))
    invalid = F.exists(violations, lambda v: v["rule"] == "membership")
    return {"malformed": malformed, "validation_error": invalid}
