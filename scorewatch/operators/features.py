"""Imputation, encoding and scaling as DataFrame operators.

Statistics come from one aggregate on the training side and are applied as
projections, so the fitted values are visible and travel as literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .ordered import exact_quantiles


def value_counts(df: DataFrame, columns: Sequence[str], rows: str | None = None) -> DataFrame:
    """Rows per (feature, value) for several columns, in one pass; ``rows`` says for how many equal rows each stands."""
    number = [F.col(rows).alias("rows")] if rows else []
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"), *number) for c in columns]
    total = F.sum("rows") if rows else F.count(F.lit(1))
    return df.select(F.inline(F.array(*pairs))).groupBy("feature", "value").agg(total.alias("n"))


def modes(df: DataFrame, columns: Sequence[str], rows: str | None = None) -> DataFrame:
    """Most frequent value of each column, the smallest on a tie; null without values."""
    counts = value_counts(df, columns, rows)
    top = counts.groupBy("feature").agg(F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("n"))
    at_top = counts.where(F.col("value").isNotNull()).join(top, ["feature", "n"])
    smallest = at_top.groupBy("feature").agg(F.min("value").alias("fill"))
    return top.select("feature").join(smallest, "feature", "left")


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact interpolated medians."""
    return {c: v[0] for c, v in exact_quantiles(df, {c: (0.5,) for c in columns}).items()}


def impute(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Replace missing values; a column keeps its name and becomes wide enough for the fill."""
    types = dict(df.dtypes)
    changed = {}
    for column, fill in fills.items():
        if fill is None:
            continue
        value = F.col(column)
        if types[column] != "string":
            value = value.cast("double")
            value = F.when(~F.isnan(value), value)
        changed[column] = F.coalesce(value, F.lit(fill))
    return df.withColumns(changed)


@dataclass(frozen=True)
class Scale:
    mean: float
    std: float

    def apply(self, value: Column) -> Column:
        return (value.cast("double") - self.mean) / self.std


def fit_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, Scale]:
    """Mean and population deviation; a constant column scales by 1."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {
        c: Scale(row[f"m{i}"] if row[f"m{i}"] is not None else 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)
    }


def category_counts(df: DataFrame, columns: Sequence[str], most: int | None = None) -> dict[str, dict[str, int]]:
    """Rows per value of each categorical column, on the driver, where a model keeps one weight for each value.

    Given ``most``, a column with more values than that is an error, found
    before its values reach the driver; nothing is cut.
    """
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    if most is not None:
        counts = materialise(counts, "categories")
        wide = counts.groupBy("feature").count().where(F.col("count") > most).orderBy("feature").collect()
        if wide:
            raise ValueError(f"{wide[0]['feature']} has {wide[0]['count']} values; at most {most} are allowed")
    found: dict[str, dict[str, int]] = {c: {} for c in columns}
    for row in counts.collect():
        found[row["feature"]][row["value"]] = row["n"]
    return found


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted values of each categorical column."""
    return {c: sorted(v) for c, v in category_counts(df, columns).items()}


def one_hot_columns(column: str, values: Sequence[str]) -> list[Column]:
    """One 0/1 column per known value; an unknown or missing value gives zeros."""
    return [
        F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}={v}") for v in values
    ]
