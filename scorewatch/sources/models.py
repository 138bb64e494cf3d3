"""Saving, loading and resolving models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..operators.governance import RegistryError, latest_approved
from ..operators.model import model_kind
from .logs import path_exists


def save_model(model: PipelineModel, path: str) -> None:
    model_kind(model)
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    model = PipelineModel.load(path)
    model_kind(model)
    return model


def load_active_model(spark: SparkSession, registry_path: str, models_root: str) -> PipelineModel:
    """The latest approved model; no registry, or nothing approved in it, is an error."""
    if not path_exists(spark, registry_path):
        raise RegistryError(f"registry not found at {registry_path}")
    rows = latest_approved(spark.read.parquet(registry_path)).collect()
    if not rows:
        raise RegistryError("no approved model is active")
    return load_model(f"{models_root.rstrip('/')}/{rows[0]['active_model']}")
