"""Classifiers: weighting, grid search with stratified folds, importances, scores.

``histogram``, ``leafwise`` and ``ordered`` are boosted here (``operators.boosting``): trees with
a depth limit; trees with a leaf limit, best leaf first; symmetric trees over ordered target
statistics of the categories. ``boosted``, ``forest`` and ``linear`` are MLlib's.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.operators import boosting
from lendmill.operators.evaluate import class_counts, class_weights, roc_auc
from lendmill.operators.forest import cut_trees, share_column
from lendmill.operators.shap import node_table
from lendmill.operators.split import stratified_folds
from lendmill.operators.target_codes import ordered_codes
from lendmill.session import materialise, shared_dir

# Search grids under the names the configuration uses.
GRID_STANDARD = {"max_depth": [3, 4, 5], "n_estimators": [100, 200], "learning_rate": [0.05, 0.1],
                 "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0]}
GRID_QUICK = {"max_depth": [5, 6], "n_estimators": [200, 300], "learning_rate": [0.05, 0.1],
              "subsample": [0.8, 0.9], "colsample_bytree": [0.8]}
GRID_THOROUGH = {"max_depth": [5, 6, 7], "n_estimators": [300, 500], "learning_rate": [0.05, 0.1],
                 "subsample": [0.8, 0.9], "colsample_bytree": [0.8, 0.9],
                 "min_child_weight": [1, 3], "gamma": [0, 0.1]}
GRID_LEAFWISE = {"max_depth": [3, 4, 5], "n_estimators": [100, 200], "learning_rate": [0.05, 0.1],
                 "num_leaves": [31, 50]}
GRID_ORDERED = {"depth": [3, 4, 5], "iterations": [100, 200], "learning_rate": [0.05, 0.1]}
GRID_FOREST = {"max_depth": [3, 4, 5], "n_estimators": [100, 200]}
GRID_LINEAR = {"regularisation": [0.0, 0.01, 0.1]}

PARAM_NAMES = {
    "max_depth": "maxDepth", "depth": "maxDepth",
    "learning_rate": "stepSize", "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy", "min_child_weight": "minInstancesPerNode",
    "gamma": "minInfoGain", "regularisation": "regParam",
}


def _trees_param(kind: str) -> str:
    return "numTrees" if kind == "forest" else "maxIter"


def _spark_param(kind: str, name: str, value):
    if name in ("n_estimators", "iterations"):
        return _trees_param(kind), int(value)
    param = PARAM_NAMES.get(name, name)
    if param == "featureSubsetStrategy":
        return param, "all" if float(value) >= 1.0 else str(float(value))
    if param in ("maxDepth", "minInstancesPerNode"):
        return param, int(value)
    return param, float(value) if isinstance(value, (int, float)) else value


def learner(kind: str, params: dict | None = None, seed: int = 42):
    """``boosted`` (main), ``forest`` or ``linear`` classifier with the given settings."""
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    params = {k: v for k, v in (_spark_param(kind, n, v) for n, v in (params or {}).items())}
    if kind in ("boosted", "forest"):
        # walking a shallow tree again is cheaper than storing node ids; deep ones keep them.
        # The interval cuts the lineage of the boosting errors in either case.
        trees = {"cacheNodeIds": params.get("maxDepth", 5) > 8, "checkpointInterval": 10,
                 "maxMemoryInMB": 512, "seed": seed}
        est = (GBTClassifier if kind == "boosted" else RandomForestClassifier)(**trees, **common)
    elif kind == "linear":
        est = LogisticRegression(**common)
    else:
        raise ValueError(f"unknown learner {kind!r}")
    return est.copy({est.getParam(name): value for name, value in params.items()})


def vectorise(df: DataFrame, features: list[str], label: str | None = "default",
              keep: list[str] = ("app_id",)) -> DataFrame:
    """(kept columns, features vector[, label]) for the learners."""
    have = set(df.columns)
    columns = [k for k in keep if k in have]
    if label and label in have:
        df = df.withColumn("label", F.col(label).cast("double"))
        columns += [c for c in (label, "label") if c not in columns]
    return (VectorAssembler(inputCols=features, outputCol="features").transform(df)
            .select(*columns, "features"))


def positive_weight(df: DataFrame, label: str = "default") -> DataFrame:
    """weight = n0/n1 for positives, 1 for negatives."""
    w = class_counts(df, label).first()["scale_pos_weight"] or 1.0
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(w)).otherwise(F.lit(1.0)))


def balanced_weight(df: DataFrame, label: str = "default") -> DataFrame:
    """weight = n / (k * n_c) of the row's class."""
    out = F.lit(None).cast("double")
    for r in class_weights(df, label).collect():  # one row per class
        out = F.when(F.col(label) == r[label], F.lit(r.weight)).otherwise(out)
    return df.withColumn("weight", out)


def _weigher(kind: str, weighting: str | None):
    """Class weighting by name; boosted trees weigh positives, the others balance, by default."""
    name = weighting or ("positive" if kind in ("boosted", "histogram") else "balanced")
    return {"positive": positive_weight, "balanced": balanced_weight}[name]


# Kinds boosted by the library itself, with how their trees grow.
GROWTH = {"histogram": "best", "leafwise": "best", "ordered": "symmetric"}


def _boost(df: DataFrame, features: list[str], kind: str, grid: dict, folds: int, label: str,
           id_col: str, seed: int, weighting: str | None,
           categorical: list[str] | None) -> "Fitted":
    """All grid points and folds in one search; ``folds`` 0 fits the only point."""
    rows = df.select(*features, label, id_col)
    if folds:
        rows = stratified_folds(rows, folds, label, id_col, seed).withColumn(
            "fold", F.col("fold").cast("int"))
    rows = materialise(rows, "folds")
    found = _weigher(kind, weighting)(rows, label).groupBy(label).agg(
        F.first("weight").alias("w")).collect()  # a row per class
    by_class = {int(r[label]): r.w for r in found}
    weights = (by_class.get(0, 1.0), by_class.get(1, 1.0))
    versions = codes = None
    if kind == "ordered":
        coded = [c for c in features if c in (categorical or [])]
        rows, versions, codes = ordered_codes(rows, features, coded, label, id_col, folds, seed)
    model, point, table = boosting.search(
        rows, features, grid, GROWTH[kind], folds, label, id_col, seed, weights,
        versions=versions, codes=codes)
    score = max((s for _, s, _ in table if s is not None), default=None)
    return Fitted(kind, model, features, point, score,
                  [(p, s) for p, s, _ in table] if folds else None)


@dataclass
class Fitted:
    kind: str
    model: Model | boosting.BoostedTrees
    features: list[str]
    params: dict
    cv_score: float | None = None
    cv_scores: list | None = None


def train(df: DataFrame, features: list[str], kind: str = "boosted", params: dict | None = None,
          label: str = "default", id_col: str = "app_id", seed: int = 42,
          weighting: str | None = None, categorical: list[str] | None = None) -> Fitted:
    """Fit one learner on the whole of ``df``; ``weighting`` is "positive" or "balanced"."""
    shared_dir(df.sparkSession)
    if kind in GROWTH:
        grid = {name: [value] for name, value in (params or {}).items()}
        return _boost(df, features, kind, grid, 0, label, id_col, seed, weighting, categorical)
    data = _weigher(kind, weighting)(vectorise(df, features, label, [id_col]), label)
    return Fitted(kind, learner(kind, params, seed).fit(data), features, dict(params or {}))


def grid_search(df: DataFrame, features: list[str], grid: dict, kind: str = "boosted",
                folds: int = 3, label: str = "default", id_col: str = "app_id", seed: int = 42,
                parallelism: int | None = None, weighting: str | None = None,
                categorical: list[str] | None = None) -> Fitted:
    """Every grid point on every stratified fold by mean ROC-AUC, then a refit on all rows."""
    shared_dir(df.sparkSession)
    if kind in GROWTH:
        return _boost(df, features, kind, grid, folds, label, id_col, seed, weighting, categorical)
    # small fits leave cores idle; several run side by side
    parallelism = parallelism or max(2, df.sparkSession.sparkContext.defaultParallelism // 2)
    data = _weigher(kind, weighting)(vectorise(df, features, label, [id_col]), label)
    data = stratified_folds(data, folds, label, id_col, seed)
    # stored once: every fit and every evaluation reads the vectors from Parquet
    data = materialise(data.withColumn("fold", F.col("fold").cast("int")), "folds")
    builder = ParamGridBuilder()
    est = learner(kind, _deepest(grid), seed)
    for name, values in grid.items():
        converted = [_spark_param(kind, name, v) for v in values]
        builder = builder.addGrid(est.getParam(converted[0][0]), [v for _, v in converted])
    points = builder.build()
    means = (_cross_validate_forest(est, points, data, folds, features) if kind == "forest"
             else _cross_validate(est, points, data, folds, parallelism))
    best = max(range(len(points)), key=lambda i: (means[i], -i))
    named = [{p.name: v for p, v in point.items()} for point in points]
    return Fitted(kind, est.fit(data, points[best]), features, named[best], means[best],
                  list(zip(named, means)))


def _deepest(grid: dict) -> dict:
    """The grid's largest depth, which decides whether node ids are worth keeping."""
    depths = grid.get("max_depth") or grid.get("depth")
    return {"max_depth": max(depths)} if depths else {}


def _cross_validate(est, points: list, data: DataFrame, folds: int, parallelism: int) -> list[float]:
    """Mean exact ROC-AUC per grid point over the ``fold`` column. Folds are plain filters, so
    no row passes through Python."""
    judge = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="label",
                                          numBins=0)
    sums = [0.0] * len(points)
    for fold in range(folds):
        fit_on, held = data.where(F.col("fold") != fold), data.where(F.col("fold") == fold)
        models = est.fitMultiple(fit_on, points)

        def fit_and_judge(_):
            i, model = next(models)
            return i, judge.evaluate(model.transform(held))

        with ThreadPoolExecutor(parallelism) as pool:
            for i, value in pool.map(fit_and_judge, points):
                sums[i] += value
    return [s / folds for s in sums]


def _cross_validate_forest(est, points: list, data: DataFrame, folds: int,
                           features: list[str]) -> list[float]:
    """Mean exact ROC-AUC per grid point, from one fit a fold of the largest forest of the points
    that differ only in their number of trees and depth. Fits follow each other: each uses all
    cores, and what MLlib keeps a row grows with the number of trees."""
    groups: dict[tuple, list[int]] = {}
    shape = []
    for i, point in enumerate(points):
        own = est.copy(point)
        shape.append((own.getNumTrees(), own.getMaxDepth()))
        rest = {p.name: v for p, v in point.items() if p.name not in ("numTrees", "maxDepth")}
        groups.setdefault(tuple(sorted(rest.items())), []).append(i)
    sums = [0.0] * len(points)
    for fold in range(folds):
        fit_on, held = data.where(F.col("fold") != fold), data.where(F.col("fold") == fold)
        for members in groups.values():
            shapes = sorted({shape[i] for i in members})
            largest = est.copy({**points[members[0]], est.numTrees: max(n for n, _ in shapes),
                                est.maxDepth: max(d for _, d in shapes)})
            nodes = node_table(Fitted("forest", largest.fit(fit_on), features, {}),
                               data.sparkSession).collect()  # a row per node
            trees = cut_trees(nodes, sorted({d for _, d in shapes}))
            scored = held.select("label", F.posexplode(share_column(
                trees, shapes, len(features), vector_to_array("features"))).alias("at", "score"))
            areas = {r["at"]: r.roc_auc for r in roc_auc(scored, "label", "score", ["at"]).collect()}
            for i in members:
                sums[i] += areas[shapes.index(shape[i])]
    return [s / folds for s in sums]


def score(fitted: Fitted, df: DataFrame, keep: list[str] = ("app_id", "default"),
          with_features: bool = False) -> DataFrame:
    """Append ``p_model`` (probability of default) and ``class`` (at 0.5) to the kept columns."""
    columns = [c for c in keep if c in df.columns]
    if fitted.kind in GROWTH:
        values = F.array(*[F.col(c).cast("double") for c in fitted.features])
        p, out = fitted.model.probability(values), df
        if with_features:
            out = df.withColumn("features", array_to_vector(values))
    else:
        rows = vectorise(df, fitted.features, None, list(keep))
        out, p = fitted.model.transform(rows), vector_to_array("probability")[1]
    if with_features:
        columns.append("features")
    return out.select(*columns, p.alias("p_model")).withColumn(
        "class", (F.col("p_model") >= 0.5).cast("int"))


def feature_importance(fitted: Fitted, spark) -> DataFrame:
    """(feature, importance): tree importances, or absolute coefficients scaled to sum to one."""
    if fitted.kind in GROWTH:
        values = fitted.model.importance().tolist()
    elif fitted.kind == "linear":
        raw = [abs(float(v)) for v in fitted.model.coefficients.toArray()]
        total = sum(raw) or 1.0
        values = [v / total for v in raw]
    else:
        values = [float(v) for v in fitted.model.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(fitted.features, values)),
                                 "feature string, importance double")
