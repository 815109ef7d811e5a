"""Persistence of classifiers, explanations and the background sample."""

from __future__ import annotations

import json

from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.sql import DataFrame, SparkSession

from lendmill.operators.boosting import BoostedTrees
from lendmill.operators.split import seeded_sample
from lendmill.operators.train import GROWTH, Fitted

LOADERS = {"boosted": GBTClassificationModel, "forest": RandomForestClassificationModel,
           "linear": LogisticRegressionModel}


def save_classifier(fitted: Fitted, path: str, spark: SparkSession) -> None:
    if fitted.kind in GROWTH:
        (spark.createDataFrame([(fitted.model.state(),)], "state string").coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/model"))
    else:
        fitted.model.write().overwrite().save(f"{path}/model")
    info = json.dumps({"kind": fitted.kind, "features": fitted.features,
                       "params": fitted.params, "cv_score": fitted.cv_score}, default=float)
    (spark.createDataFrame([(info,)], "info string").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/info"))


def load_classifier(spark: SparkSession, path: str) -> Fitted:
    info = json.loads(spark.read.schema("info string").parquet(f"{path}/info").first().info)
    if info["kind"] in GROWTH:
        stored = spark.read.schema("state string").parquet(f"{path}/model").first().state
        model = BoostedTrees.of_state(stored)
    else:
        model = LOADERS[info["kind"]].load(f"{path}/model")
    return Fitted(info["kind"], model, info["features"], info["params"], info["cv_score"])


def save_explanations(shap_table: DataFrame, features: list[str], path: str) -> None:
    """SHAP values with the feature names that give their order."""
    spark = shap_table.sparkSession
    shap_table.write.mode("overwrite").parquet(f"{path}/shap")
    (spark.createDataFrame(list(enumerate(features)), "position int, feature string").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/features"))


def load_explanations(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    names = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    return spark.read.parquet(f"{path}/shap"), [r.feature for r in names]


def save_background(train_rows: DataFrame, path: str, n: int = 1000,
                    id_col: str = "app_id") -> None:
    seeded_sample(train_rows, n, id_col).write.mode("overwrite").parquet(path)
