"""Train, evaluate and calibrate on a table with a ``split`` column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..functions.decisions import binarise
from ..operators import contract as contracts
from ..operators import feature_stats, metrics, model as models, splits
from ..operators.ordered import side_by_side
from ..session import materialise
from ..sources.fingerprint import table_fingerprint

LABEL = "label"


@dataclass
class TrainingRun:
    model: PipelineModel
    table: DataFrame
    cutoffs: splits.Cutoffs
    summary: DataFrame
    split_report: DataFrame
    split_statistics: DataFrame | None
    training_stats: DataFrame
    metadata: DataFrame


def train(
    rows: DataFrame, contract: contracts.Contract, time_column: str, intercept: str = "penalised"
) -> TrainingRun:
    """Split in time, check for leaks, fit on the train part, and describe all of it.

    The split table is written once, partitioned by split, so every later step
    reads only its own part.
    """
    splits.require_dates(rows, time_column)
    cutoffs = splits.temporal_cutoffs(rows, time_column)
    labelled = splits.with_split(rows, time_column, cutoffs).withColumn(LABEL, binarise(F.col(contract.target)))
    table = materialise(labelled, "split", ("split",))
    splits.require_no_leakage(table, time_column)
    part = table.where(F.col("split") == splits.TRAIN)
    model = models.fit_model(part, contract.categorical, contract.numeric, LABEL, intercept)
    quality = metrics.evaluate_scores(models.score(model, part), models.SCORE, LABEL)
    content = table_fingerprint(rows).select(F.col("sum_hash").alias("data_hash"), "rows")
    metadata = side_by_side(quality, content).select(
        F.lit(fixed.MODEL_VERSION).alias("model_version"), "data_hash", "rows",
        F.lit(contract.width).alias("columns"), "decision_threshold", "roc_auc", "approval_rate",
    )
    return TrainingRun(
        model=model,
        table=table,
        cutoffs=cutoffs,
        summary=contracts.dataset_summary(table, contract),
        split_report=splits.split_report(table, time_column),
        split_statistics=splits.split_statistics(table, contract.numeric) if contract.numeric else None,
        training_stats=feature_stats.feature_stats(part, contract.features, contract.numeric),
        metadata=metadata,
    )


def evaluate(model: PipelineModel, table: DataFrame, split: str = splits.TEST) -> DataFrame:
    """AUC, approval rate and threshold on one split."""
    return metrics.evaluate_scores(models.score(model, table.where(F.col("split") == split)), models.SCORE, LABEL)


def calibrate(
    model: PipelineModel, table: DataFrame, split: str = splits.CALIBRATION, report_on: str | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Isotonic calibration on one split and its report.

    The report is made on the same rows unless ``report_on`` names another split.
    """
    fitted_on = models.score(model, table.where(F.col("split") == split))
    calibrator = models.fit_calibrator(fitted_on, models.SCORE, LABEL)
    final = models.calibrated(model, calibrator)
    reported = models.score(final, table.where(F.col("split") == (report_on or split)))
    report = metrics.calibration_report(reported, models.BASE_SCORE, models.SCORE, LABEL)
    return final, report
