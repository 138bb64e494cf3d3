"""Balanced logistic regression over any number of categories, with its weights as a table.

Categories are numbered in a written dictionary and rows become sparse: one
number per categorical column, the scaled numbers beside them. Without numbers
equal rows are counted first and the fit goes over one row for each, laid out
by category. A step of the fit adds up gradients in each task, cut into
stripes of which a task sends those it touched; they are summed over groups of
tasks before they meet, so nothing is as wide as the square of the number of
columns. Scoring joins the weights, so the plan does not grow with the
categories either; it works on streams as on tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed
from ..session import materialise
from . import ordered
from .features import Scale, fit_scales, impute, medians, modes, value_counts
from .model import SCORE, class_weights

#: Weights of one stripe of the gradient, and groups of tasks whose gradients are added up first.
STRIPE, GROUPS = 1 << 16, 32
#: A table of weights up to so many rows is broadcast.
BROADCAST_ROWS = 1 << 18
#: Steps that the solver remembers.
MEMORY = 10
#: The column that says for how many equal rows a row stands.
ROWS = "__rows"


@dataclass(frozen=True)
class TableModel:
    """``weights``: feature, value, weight. Numeric columns have their fill, scale and weight here."""

    weights: DataFrame
    categorical: tuple[str, ...]
    fills: dict[str, object]
    scales: dict[str, Scale]
    slopes: dict[str, float]
    intercept: float

    def linear(self, df: DataFrame) -> tuple[DataFrame, Column]:
        """The filled frame with a weight for each categorical column, and the linear predictor."""
        small = self.weights.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        filled = impute(df.select("*", *(F.col(c).alias(f"__in_{c}") for c in (*self.categorical, *self.slopes))), {f"__in_{c}": v for c, v in self.fills.items()})
        total = F.lit(float(self.intercept))
        for c in self.categorical:
            own = self.weights.where(F.col("feature") == c).select(F.col("value").alias(f"__value_{c}"), F.col("weight").alias(f"__weight_{c}"))
            filled = filled.join(F.broadcast(own) if small else own, F.col(f"__in_{c}").cast("string") == F.col(f"__value_{c}"), "left")
            total = total + F.coalesce(F.col(f"__weight_{c}"), F.lit(0.0))
        for c, slope in self.slopes.items():
            total = total + self.scales[c].apply(F.col(f"__in_{c}")) * slope
        return filled, total

    def score(self, df: DataFrame, out: str = SCORE) -> DataFrame:
        """Add the probability of the positive class; unknown categories weigh nothing."""
        filled, total = self.linear(df)
        return filled.withColumn(out, 1.0 / (1.0 + F.exp(-total))).select(*df.columns, out)

    def save(self, path: str) -> None:
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")
        spark = self.weights.sparkSession
        rows = [("intercept", None, None, None, None, self.intercept), *((c, "categorical", _text(self.fills.get(c)), None, None, None) for c in self.categorical)]
        rows += [(c, "numeric", _text(self.fills.get(c)), self.scales[c].mean, self.scales[c].std, slope) for c, slope in self.slopes.items()]
        meta = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, name string, kind string, fill string, mean double, std double, slope double")
        meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TableModel:
        rows = spark.read.parquet(f"{path}/columns").orderBy("n").collect()
        numeric = {r["name"]: r for r in rows if r["kind"] == "numeric"}
        fills = {r["name"]: float(r["fill"]) if r["kind"] == "numeric" else r["fill"] for r in rows[1:] if r["fill"] is not None}
        return TableModel(
            spark.read.parquet(f"{path}/weights"), tuple(r["name"] for r in rows if r["kind"] == "categorical"), fills,
            {c: Scale(r["mean"], r["std"]) for c, r in numeric.items()}, {c: r["slope"] for c, r in numeric.items()}, rows[0]["slope"],
        )


def _text(value: object) -> str | None:
    return None if value is None else str(value)


def dictionary(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, int]:
    """feature, value, number of every category, numbered from 0 in order of feature and value, and how many there are."""
    distinct = value_counts(df, columns).where("value IS NOT NULL").select("feature", "value")
    return ordered.numbered(distinct, ["feature", "value"], "number")


def counted_rows(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str) -> DataFrame:
    """The columns of the fit and ``ROWS``, for how many equal rows each stands; with numbers every row stands for itself."""
    kinds = dict(df.dtypes)
    if numeric or {"float", "double"} & {kinds[c] for c in categorical}:
        return df.select(*categorical, *numeric, label, F.lit(1).cast("bigint").alias(ROWS))
    return materialise(df.groupBy(*categorical, label).agg(F.count(F.lit(1)).alias(ROWS)), "counted")


def sparse_rows(
    df: DataFrame, categorical: Sequence[str], numbers: DataFrame, size: int, dense: dict[str, Column], keep: dict[str, Column], clustered: bool = False,
) -> DataFrame:
    """at0, ...: the category numbers of each row (-1: none); x0, ...: the dense columns; and the columns ``keep``.

    ``clustered`` lays the rows out by their numbers, which must tell them apart.
    """
    rows = df.select(*(F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categorical)), *(v.cast("double").alias(f"x{i}") for i, v in enumerate(dense.values())), *(v.alias(k) for k, v in keep.items()))
    for i, c in enumerate(categorical):
        own = numbers.where(F.col("feature") == c).select(F.col("value").alias(f"c{i}"), F.col("number").alias(f"n{i}"))
        rows = rows.join(F.broadcast(own) if size <= BROADCAST_ROWS else own, f"c{i}", "left")
    at = [f"at{i}" for i in range(len(categorical))]
    rows = rows.select(*(F.coalesce(F.col(f"n{i}"), F.lit(-1)).cast("int").alias(a) for i, a in enumerate(at)), *(f"x{i}" for i in range(len(dense))), *keep)
    return materialise(rows.repartitionByRange(*at, *keep) if clustered and at else rows, "sparse")


def striped_sums(
    rows: DataFrame, n_categories: int, n_dense: int, terms: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
) -> tuple[float, np.ndarray]:
    """Sum of the first of the ``terms`` of all rows, and for each weight the sum of the second.

    ``terms`` gives, from category numbers, dense columns, label and row weight, a number and a share for each row, and by what
    the share counts for the dense columns. The categories' sums come first, then the dense columns' and the intercept's.
    """
    width = n_categories + n_dense + 1
    columns, dense = [c for c in rows.columns if c.startswith("at")], [f"x{i}" for i in range(n_dense)]

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total, out = 0.0, np.zeros(width)
        for frame in frames:
            if not len(frame):
                continue
            at, x = frame[columns].to_numpy(dtype="int64"), frame[dense].to_numpy(dtype="float64")
            value, share, factor = terms(at, x, frame["y"].to_numpy(), frame["w"].to_numpy())
            total += float(value.sum())
            known = at >= 0
            # Adds to the weights that occur, not to all of them for each batch.
            np.add.at(out, at[known], np.repeat(share, at.shape[1])[known.ravel()])
            out[n_categories:-1] += factor.T @ share
            out[-1] += share.sum()
        group = TaskContext.get().partitionId() % GROUPS
        for stripe in range(0, width, STRIPE):
            part = out[stripe:stripe + STRIPE]
            if stripe == 0 or part.any():
                yield pd.DataFrame({"grp": [group], "stripe": [stripe], "total": [total if stripe == 0 else 0.0], "part": [part.tobytes()]})

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        part = np.sum([np.frombuffer(p) for p in frame["part"]], axis=0)
        return pd.DataFrame({"grp": [0], "stripe": [frame["stripe"].iloc[0]], "total": [frame["total"].sum()], "part": [part.tobytes()]})

    schema = "grp int, stripe int, total double, part binary"
    parts = rows.mapInPandas(sums, schema).groupBy("grp", "stripe").applyInPandas(added, schema)
    total, out = 0.0, np.zeros(width)
    for r in parts.collect():  # at most GROUPS rows for each stripe of the weights
        total += r["total"]
        out[r["stripe"]:r["stripe"] + STRIPE] += np.frombuffer(r["part"])
    return total, out


def gradient(rows: DataFrame, beta: np.ndarray, n_categories: int) -> tuple[float, np.ndarray]:
    """Weighted loss and its gradient; ``beta`` holds the categories', the dense columns' and the intercept's weights."""
    shared = rows.sparkSession.sparkContext.broadcast(beta)

    def terms(at, x, y, w):
        b = shared.value
        z = np.where(at >= 0, b[at], 0.0).sum(1) + x @ b[n_categories:-1] + b[-1]
        return w * (np.logaddexp(0.0, z) - y * z), w * (1.0 / (1.0 + np.exp(-z)) - y), x

    found = striped_sums(rows, n_categories, len(beta) - n_categories - 1, terms)
    shared.unpersist()
    return found


def curvature(rows: DataFrame, n_categories: int, n_dense: int) -> np.ndarray:
    """The loss's second derivative by each weight where all weights are 0."""
    return striped_sums(rows, n_categories, n_dense, lambda at, x, y, w: (w, w / 4, x * x))[1]


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iterations: int, tolerance: float) -> np.ndarray:
    """Limited-memory quasi-Newton steps with a halving line search, for a smooth convex function."""
    x, (value, slope) = start, f(start)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(max_iterations):
        if float(np.max(np.abs(slope))) < tolerance:
            return x
        d, kept = slope.copy(), []
        for s, y, r in reversed(moves):
            a = r * (s @ d)
            d -= a * y
            kept.append(a)
        if moves:
            s, y, r = moves[-1]
            d *= 1.0 / (r * (y @ y))
        for (s, y, r), a in zip(moves, reversed(kept)):
            d += (a - r * (y @ d)) * s
        step, falls = 1.0 if moves else min(1.0, 1.0 / float(np.abs(slope).sum())), float(slope @ d)
        while True:
            new = x - step * d
            new_value, new_slope = f(new)
            # Near the optimum values differ by rounding alone: there the slopes decide.
            flat = abs(new_value - value) <= 1e-12 * abs(value) and float(np.abs(new_slope).max()) < float(np.abs(slope).max())
            if new_value <= value - 1e-4 * step * falls or flat:
                break
            step /= 2
            if step < 1e-12:
                return x
        s, y = new - x, new_slope - slope
        if float(s @ y) > 0:
            moves = [*moves, (s, y, 1.0 / float(s @ y))][-MEMORY:]
        x, value, slope = new, new_value, new_slope
    raise RuntimeError(f"the fit did not converge in {max_iterations} steps")


def fit_table_model(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str,
    inverse_regularisation: float = fixed.INVERSE_REGULARISATION, max_iterations: int = fixed.MAX_ITERATIONS, tolerance: float = 1e-9,
) -> TableModel:
    """Fit on a 0/1 label with balanced class weights, the intercept penalised with the weights.

    The driver holds one weight for each category while the fit runs; the
    model keeps them as a written table.
    """
    df = counted_rows(df, categorical, numeric, label)
    fills: dict[str, object] = {r["feature"]: r["fill"] for r in modes(df, categorical, ROWS).collect() if r["fill"] is not None} if categorical else {}
    if numeric:
        fills.update({c: v for c, v in medians(df, numeric).items() if v is not None})
    filled = impute(df, fills)
    scales = fit_scales(filled, numeric) if numeric else {}
    balance = class_weights(df, label, ROWS)
    numbers, n = dictionary(filled, categorical) if categorical else (None, 0)
    y = F.col(label).cast("double")
    rows = sparse_rows(
        filled.where(F.col(label).isNotNull()), categorical, numbers, n, {c: s.apply(F.col(c)) for c, s in scales.items()},
        {"y": y, "w": F.when(y == 1, balance[1]).otherwise(balance[0]) * F.col(ROWS)}, clustered=not numeric,
    )

    def objective(beta: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slope = gradient(rows, beta, n)
        return float(beta @ beta) / 2 + inverse_regularisation * loss, beta + inverse_regularisation * slope

    # The intercept's curvature goes with the rows, a category's with its own rows. In units of its own for each weight the
    # steps do not grow in number with the table.
    unit = 1.0 / np.sqrt(1.0 + inverse_regularisation * curvature(rows, n, len(scales)))

    def scaled(at: np.ndarray) -> tuple[float, np.ndarray]:
        value, slope = objective(at * unit)
        return value, slope * unit

    beta = unit * minimise(scaled, np.zeros(n + len(scales) + 1), max_iterations, tolerance)
    spark = df.sparkSession
    if n:
        fitted = spark.sparkContext.broadcast(beta)

        def weighed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield frame[["feature", "value"]].assign(weight=fitted.value[frame["number"].to_numpy(dtype="int64")])

        weights = materialise(numbers.mapInPandas(weighed, "feature string, value string, weight double"), "weights")
        fitted.unpersist()
    else:
        weights = spark.createDataFrame([], "feature string, value string, weight double")
    return TableModel(weights, tuple(categorical), fills, scales, dict(zip(scales, beta[n:-1].tolist())), float(beta[-1]))
