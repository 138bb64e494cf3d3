"""How much label noise costs: train twice, compare on a clean test part."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..functions.decisions import binarise
from ..operators import contract as contracts
from ..operators import metrics, model as models, perturb, splits
from ..session import materialise


@dataclass
class NoiseRun:
    metadata: DataFrame
    comparison: DataFrame


def noise_robustness(
    rows: DataFrame, contract: contracts.Contract, time_column: str, key: str,
    fraction: float = fixed.NOISE_FRACTION, kind: str = "flip", seed: int = fixed.SEED, intercept: str = "penalised",
) -> NoiseRun:
    """Two-way split in time; one model on clean and one on noisy labels."""
    cutoffs = splits.temporal_cutoffs(rows, time_column, two_way=True)
    table = materialise(
        splits.with_split(rows, time_column, cutoffs).withColumn("label", binarise(F.col(contract.target))),
        "noise", ("split",),
    )
    train = table.where(F.col("split") == splits.TRAIN)
    noisy = perturb.inject_label_noise(train, key, "label", fraction, kind, seed)
    inputs = contract.categorical, contract.numeric
    clean_model = models.fit_model(train, *inputs, "label", intercept)
    noisy_model = models.fit_model(noisy, *inputs, "noisy_label", intercept)
    test = table.where(F.col("split") == splits.TEST)
    both = models.score(clean_model, test).withColumnRenamed(models.SCORE, "clean")
    both = models.score(noisy_model, both).withColumnRenamed(models.SCORE, "noisy")
    return NoiseRun(
        perturb.noise_metadata(noisy, "label", "noisy_label", fraction, kind, seed),
        metrics.compare_scores(both, "clean", "noisy", "label"),
    )
