"""Model comparison and top-n tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_models(metrics: DataFrame, split: str = "validation") -> DataFrame:
    """One row per model, best ROC-AUC first."""
    return (metrics.where(F.col("split") == split)
            .select(F.upper("model").alias("model"), "roc_auc", "precision", "recall", "f1")
            .orderBy(F.desc("roc_auc"), "model"))


def best_model(metrics: DataFrame, metric: str = "roc_auc", split: str = "validation",
               order: str = "position") -> DataFrame:
    """The model with the highest positive metric; the earliest registered one wins a tie."""
    return (metrics.where((F.col("split") == split) & (F.col(metric) > 0))
            .orderBy(F.desc(metric), order).limit(1)
            .select("model", F.col(metric).alias("score")))


def top_n(df: DataFrame, by: str, n: int, name: str = "feature") -> DataFrame:
    """The ``n`` largest rows; ties go to the smaller name."""
    return df.orderBy(F.desc(by), name).limit(n)
