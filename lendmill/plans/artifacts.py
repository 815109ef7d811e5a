"""Hand-over of a training job: preprocessing, classifier and background under one folder."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lendmill.operators.prep import PrepModel
from lendmill.operators.train import Fitted
from lendmill.plans.training import TrainingResult
from lendmill.sources.models import load_classifier, save_background, save_classifier


@dataclass
class Bundle:
    prep: PrepModel
    fitted: Fitted
    background: DataFrame = field(repr=False)


def save_bundle(result: TrainingResult, name: str, path: str, background_rows: int = 1000,
                id_col: str = "app_id") -> None:
    """Everything a scoring or explaining process needs of one trained model."""
    train_rows = result.features.where("split = 'train'")
    result.prep.save(f"{path}/prep")
    save_classifier(result.models[name], f"{path}/classifier", train_rows.sparkSession)
    save_background(train_rows, f"{path}/background", background_rows, id_col)


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    return Bundle(PrepModel.load(spark, f"{path}/prep"),
                  load_classifier(spark, f"{path}/classifier"),
                  spark.read.parquet(f"{path}/background"))
