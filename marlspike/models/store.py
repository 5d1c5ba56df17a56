"""Saving and loading any model of this package."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import SparkSession

from marlspike.models.joint import JointModel, load_joint, save_joint

Model = JointModel | LogisticRegressionModel | PipelineModel


def save_model(model: Model, spark: SparkSession, path: str) -> None:
    """Replace the model at path."""
    if isinstance(model, JointModel):
        save_joint(model, spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str, kind: str) -> Model:
    loaders = {
        "joint": lambda: load_joint(spark, path),
        "linear": lambda: LogisticRegressionModel.load(path),
        "text": lambda: PipelineModel.load(path),
    }
    if kind not in loaders:
        raise ValueError(f"kind is one of {', '.join(loaders)}")
    return loaders[kind]()
