"""Balanced logistic regression, its scores, and isotonic calibration.

A fitted model is a ``PipelineModel``: one SQL stage that imputes, encodes,
scales and scores with literal coefficients (so scoring is a plain projection,
in batch and in streams), and for a calibrated model one isotonic stage more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from ..functions import fixed
from .isotonic import isotonic_steps
from .features import Scale, category_counts, fit_scales, impute, medians, one_hot_columns

BASE_SCORE = "prob_base"
SCORE = "prob_bad"
#: Steps that a calibration stage may hold.
MOST_STEPS = 1 << 17


@dataclass(frozen=True)
class Encoding:
    """Fitted preprocessing: fills, categories and scales in column order."""

    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    fills: dict[str, object]
    values: dict[str, list[str]]
    scales: dict[str, Scale]

    def filled(self, df: DataFrame) -> DataFrame:
        return impute(df, self.fills)

    def columns(self) -> list[Column]:
        """Encoded inputs ``x0, x1, ...`` of a filled frame; everything else is dropped."""
        raw = [c for name in self.categorical for c in one_hot_columns(name, self.values[name])]
        raw += [self.scales[name].apply(F.col(name)) for name in self.numeric]
        return [c.cast("double").alias(f"x{i}") for i, c in enumerate(raw)]

    @property
    def width(self) -> int:
        return sum(len(v) for v in self.values.values()) + len(self.numeric)


def fit_encoding(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], most_categories: int | None = None
) -> Encoding:
    """Most frequent category, sorted categories, median, then mean and population deviation.

    ``most_categories`` refuses a categorical column of more values; by default any number goes.
    """
    counts = category_counts(df, categorical, most_categories) if categorical else {}
    # Most frequent value, the smallest on a tie; filling it in adds no new category.
    fills: dict[str, object] = {c: min(v, key=lambda x: (-v[x], x)) if v else None for c, v in counts.items()}
    if numeric:
        fills.update(medians(df, numeric))
    return Encoding(
        tuple(categorical), tuple(numeric), fills,
        {c: sorted(v) for c, v in counts.items()},
        fit_scales(impute(df, {c: fills[c] for c in numeric}), numeric) if numeric else {},
    )


def class_weights(df: DataFrame, label: str, rows: str | None = None) -> dict[int, float]:
    """``rows / (2 x rows of the class)``; the column ``rows`` says for how many equal rows each stands."""
    number = F.col(rows) if rows else F.lit(1)
    positive, negative = df.agg(*(F.coalesce(F.sum(F.when(F.col(label) == y, number)), F.lit(0)) for y in (1, 0))).first()
    if not positive or not negative:
        raise ValueError(f"training needs both classes, found {positive} positive and {negative} negative rows")
    total = positive + negative
    return {1: total / (2.0 * positive), 0: total / (2.0 * negative)}


#: Groups of tasks whose sums are added up before they reach the driver.
GROUPS = 32


def _newton_sums(width: int, beta: np.ndarray):
    """Partial gradient and curvature of one partition, as one row."""
    names = [f"x{i}" for i in range(width)]

    def sums(batches):
        from pyspark import TaskContext

        gradient = np.zeros(width + 1)
        curvature = np.zeros((width + 1, width + 1))
        for pdf in batches:
            x = np.column_stack([pdf[names].to_numpy(), np.ones(len(pdf))])
            w = pdf["w"].to_numpy()
            p = 1.0 / (1.0 + np.exp(-x @ beta))
            gradient += x.T @ (w * (p - pdf["y"].to_numpy()))
            curvature += (x * (w * p * (1.0 - p))[:, None]).T @ x
        part = np.concatenate([gradient, curvature.ravel()]).tobytes()
        yield pd.DataFrame({"grp": [TaskContext.get().partitionId() % GROUPS], "part": [part]})

    return sums


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"grp": frame["grp"].iloc[:1], "part": [np.sum([np.frombuffer(p) for p in frame["part"]], axis=0).tobytes()]})


def fit_penalised_intercept(
    encoded: DataFrame, width: int, strength: float, max_iterations: int = 50, tolerance: float = 1e-10
) -> tuple[np.ndarray, float]:
    """Minimise ``|beta|^2 / 2 + strength x weighted loss``, the intercept being part of ``beta``.

    Newton steps; each sends one row of partial sums per partition, which are
    added up in groups, so the driver sees at most ``GROUPS`` rows of
    (width + 1)^2 numbers.
    """
    beta = np.zeros(width + 1)
    size = width + 1
    schema = "grp int, part binary"
    for _ in range(max_iterations):
        parts = encoded.mapInPandas(_newton_sums(width, beta), schema).groupBy("grp").applyInPandas(_added, schema)
        sums = np.zeros(size + size * size)
        for row in parts.collect():
            sums += np.frombuffer(row["part"])
        gradient = beta + strength * sums[:size]
        curvature = np.eye(size) + strength * sums[size:].reshape(size, size)
        step = np.linalg.solve(curvature, gradient)
        beta = beta - step
        if float(np.max(np.abs(step))) < tolerance:
            return beta[:-1], float(beta[-1])
    raise RuntimeError(f"the fit did not converge in {max_iterations} steps")


def fit_free_intercept(
    encoded: DataFrame, width: int, strength: float, rows: float, max_iterations: int = fixed.MAX_ITERATIONS
) -> tuple[np.ndarray, float]:
    """The same objective with an unpenalised intercept, by the ML library's solver."""
    vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(width)], outputCol="features").transform(encoded)
    solver = LogisticRegression(
        labelCol="y", weightCol="w", regParam=1.0 / (strength * rows), elasticNetParam=0.0,
        standardization=False, maxIter=max_iterations, tol=1e-10,
    )
    fitted = solver.fit(vectors.select("features", "y", "w"))
    return np.array(fitted.coefficients.toArray()), float(fitted.intercept)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def score_statement(encoding: Encoding, coefficients: Sequence[float], intercept: float, out: str) -> str:
    """SQL of the whole scorer."""
    weights = iter(coefficients)
    terms = [_number(intercept)]
    for name in encoding.categorical:
        pairs = [(v, next(weights)) for v in encoding.values[name]]
        value = f"CAST(`{name}` AS STRING)"
        if encoding.fills.get(name) is not None:
            value = f"COALESCE({value}, {_quoted(str(encoding.fills[name]))})"
        if pairs:
            entries = " ".join(f"WHEN {_quoted(v)} THEN {_number(w)}" for v, w in pairs)
            terms.append(f"CASE {value} {entries} ELSE 0D END")
    for name in encoding.numeric:
        value = f"NANVL(CAST(`{name}` AS DOUBLE), NULL)"
        if encoding.fills.get(name) is not None:
            value = f"COALESCE({value}, {_number(encoding.fills[name])})"
        scale = encoding.scales[name]
        terms.append(f"{_number(next(weights))} * (({value} - {_number(scale.mean)}) / {_number(scale.std)})")
    return f"SELECT *, 1D / (1D + EXP(-({' + '.join(terms)}))) AS {out} FROM __THIS__"


def fit_model(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    intercept: str = "penalised",
    inverse_regularisation: float = fixed.INVERSE_REGULARISATION,
    most_categories: int | None = None,
) -> PipelineModel:
    """Fit on a 0/1 label with balanced class weights; scores land in ``prob_bad``."""
    if intercept not in ("penalised", "free"):
        raise ValueError(f"unknown intercept mode {intercept!r}")
    encoding = fit_encoding(df, categorical, numeric, most_categories)
    weights = class_weights(df, label)
    encoded = encoding.filled(df).select(
        *encoding.columns(),
        F.col(label).cast("double").alias("y"),
        F.when(F.col(label) == 1, weights[1]).otherwise(weights[0]).alias("w"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if intercept == "penalised":
            beta, bias = fit_penalised_intercept(encoded, encoding.width, inverse_regularisation)
        else:
            beta, bias = fit_free_intercept(encoded, encoding.width, inverse_regularisation, encoded.count())
    finally:
        encoded.unpersist()
    return PipelineModel(stages=[SQLTransformer(statement=score_statement(encoding, beta, bias, SCORE))])


def fit_calibrator(scored: DataFrame, score: str, label: str, most_steps: int = MOST_STEPS) -> IsotonicRegressionModel:
    """Increasing step function from score to observed rate, as a stage that scores tables and streams.

    The fit is made on executors; the stage holds its steps, two numbers each
    for both ends. More than ``most_steps`` are an error: ``isotonic_steps``
    and ``apply_steps`` take any number, for tables.
    """
    steps = isotonic_steps(scored, score, label)
    n = steps.count()
    if n > most_steps:
        raise ValueError(f"the fit has {n} steps; a stage holds at most {most_steps}")
    ends = steps.select(F.explode(F.array("lo", "hi")).alias(score), F.col("value").alias("rate"), "weight")
    return IsotonicRegression(
        featuresCol=score, labelCol="rate", weightCol="weight", predictionCol="calibrated", isotonic=True
    ).fit(ends)


def calibrated(model: PipelineModel, calibrator: IsotonicRegressionModel) -> PipelineModel:
    """Base scorer followed by the calibrator; the base score stays in ``prob_base``."""
    base = model.stages[0]
    statement = base.getStatement()
    head, tail = statement.rsplit(f" AS {SCORE} ", 1)
    renamed = SQLTransformer(statement=f"{head} AS {BASE_SCORE} {tail}")
    stage = calibrator.copy()
    stage.setFeaturesCol(BASE_SCORE)
    stage.setPredictionCol(SCORE)
    return PipelineModel(stages=[renamed, stage])


def model_kind(model: object) -> str:
    """``base`` or ``calibrated``; anything else is no scorer."""
    if isinstance(model, PipelineModel) and model.stages and isinstance(model.stages[0], SQLTransformer):
        if len(model.stages) == 1:
            return "base"
        if len(model.stages) == 2 and isinstance(model.stages[1], IsotonicRegressionModel):
            return "calibrated"
    raise TypeError(f"unsupported model object: {type(model)!r}")


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prob_bad``, the probability of the positive class."""
    model_kind(model)
    return model.transform(df)
