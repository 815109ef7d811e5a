"""Training job: split, fit preprocessing, search, evaluate, compare."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.config import PREP, SPLIT, PrepSpec, SplitSpec
from lendmill.operators.evaluate import evaluate
from lendmill.operators.prep import PrepModel, fit_prep
from lendmill.operators.ranking import best_model, compare_models
from lendmill.operators.split import stratified_split
from lendmill.operators.train import Fitted, grid_search, score, train
from lendmill.session import materialise


@dataclass
class TrainingResult:
    prep: PrepModel
    features: DataFrame = field(repr=False)   # id, default, split and the feature columns
    models: dict[str, Fitted] = field(default_factory=dict)
    metrics: DataFrame | None = field(default=None, repr=False)

    def comparison(self) -> DataFrame:
        return compare_models(self.metrics)

    def best(self, metric: str = "roc_auc") -> str:
        return best_model(self.metrics, metric).first().model


def prepare(df: DataFrame, target: str = "default", id_col: str = "app_id",
            split: SplitSpec = SPLIT, prep: PrepSpec = PREP, fit_on: str = "train"
            ) -> tuple[PrepModel, DataFrame]:
    """Split first, fit preprocessing on the training rows (``fit_on="all"``: on every row)."""
    # stored once: every pass of the fit would hash all ids again to find its rows
    marked = materialise(stratified_split(df, target, id_col, split), "split")
    basis = marked.where("split = 'train'") if fit_on == "train" else marked
    model = fit_prep(basis.drop("split"), target, [id_col], prep)
    return model, model.transform(marked, keep=[id_col, target, "split"])


def run(df: DataFrame, plans: dict[str, dict], target: str = "default", id_col: str = "app_id",
        split: SplitSpec = SPLIT, prep: PrepSpec = PREP, fit_on: str = "train",
        folds: int = 3) -> TrainingResult:
    """Train every named plan: ``{"kind", "params"}`` for one fit, or ``{"kind", "grid"}``;
    ``"weighting"`` overrides the learner's own ("positive" or "balanced")."""
    model, features = prepare(df, target, id_col, split, prep, fit_on)
    features = materialise(features, "features")  # read by every fit and every evaluation
    result = TrainingResult(model, features)
    train_rows = features.where("split = 'train'")
    for name, plan in plans.items():
        kind = plan.get("kind", "boosted")
        if "grid" in plan:
            fitted = grid_search(train_rows, model.features, plan["grid"], kind, folds, target,
                                 id_col, split.seed, weighting=plan.get("weighting"),
                                 categorical=model.categorical)
        else:
            fitted = train(train_rows, model.features, kind, plan.get("params"), target, id_col,
                           split.seed, plan.get("weighting"), model.categorical)
        result.models[name] = fitted
    result.metrics = evaluate_models(result, target, id_col)
    return result


def evaluate_models(result: TrainingResult, target: str = "default",
                    id_col: str = "app_id") -> DataFrame:
    """Metrics of every model on every split, with the order the models were trained in."""
    parts = []
    for position, (name, fitted) in enumerate(result.models.items()):
        scored = score(fitted, result.features, keep=[id_col, target, "split"])
        parts.append(scored.select(F.lit(name).alias("model"), F.lit(position).alias("position"),
                                   "split", target, F.col("p_model").alias("score")))
    scores = materialise(reduce(DataFrame.unionByName, parts), "scores")
    return evaluate(scores, target, "score", ["model", "position", "split"])
