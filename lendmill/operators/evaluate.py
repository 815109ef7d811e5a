"""Model evaluation on (label, score) tables: one row per scored application.

A score that is null or NaN never reaches a threshold: it counts as a negative prediction
everywhere and ranks below every number in ROC curves.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.config import POLICY, RiskPolicy, threshold_grid
from lendmill.operators.ordering import running_totals
from lendmill.session import materialise


def class_counts(df: DataFrame, label: str = "default") -> DataFrame:
    """Negatives, positives and the positive-class weight n0/n1."""
    return df.agg(F.count_if(F.col(label) == 0).alias("n0"),
                  F.count_if(F.col(label) == 1).alias("n1")).withColumn(
        "scale_pos_weight", F.try_divide(F.col("n0").cast("double"), F.col("n1")))


def class_weights(df: DataFrame, label: str = "default") -> DataFrame:
    """Balanced weights n / (k * n_c), one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    classes = Window.partitionBy(F.lit(1))  # spans the few per-class counts only
    return counts.withColumn("weight", F.sum("n").over(classes)
                             / (F.count("*").over(classes) * F.col("n")))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def known_score(score: str) -> Column:
    """The score; minus infinity where it is null or NaN."""
    p = F.col(score).cast("double")
    return F.when(F.isnan(p) | p.isNull(), float("-inf")).otherwise(p)


def confusion(df: DataFrame, label: str = "default", predicted: str = "prediction",
              by: list[str] = ()) -> DataFrame:
    """tn, fp, fn, tp in one aggregation; a class that does not occur counts as zero."""
    y, z = F.col(label), F.coalesce(F.col(predicted).cast("int"), F.lit(0))
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (z == 0)).alias("tn"),
        F.count_if((y == 0) & (z == 1)).alias("fp"),
        F.count_if((y == 1) & (z == 0)).alias("fn"),
        F.count_if((y == 1) & (z == 1)).alias("tp"),
    )


def precision_recall_f1(counts: DataFrame) -> DataFrame:
    """Append precision, recall and F1 to confusion counts; undefined ratios are 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    })


def _flags(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    return df.select(*by, known_score(score).alias("score"),
                     (F.col(label) == 1).cast("long").alias("pos"),
                     (F.col(label) == 0).cast("long").alias("neg"))


# pairs a positive wins against the negatives below it, ties counted half
WINS = "pos * (neg_before + neg / 2D)"


def roc_auc(df: DataFrame, label: str = "default", score: str = "score",
            by: list[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null when a class is absent."""
    by = list(by)
    ranked = running_totals(_flags(df, label, score, by), "score", ["pos", "neg"], by)
    return (ranked.groupBy(*by)
            .agg(F.sum(F.expr(WINS)).alias("_wins"), F.sum("pos").alias("_p"),
                 F.sum("neg").alias("_n"))
            .select(*by, F.try_divide(F.col("_wins"), F.col("_p").cast("double") * F.col("_n"))
                    .alias("roc_auc")))


def roc_curve(df: DataFrame, label: str = "default", score: str = "score",
              by: list[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, predicting positive at score >= threshold."""
    by = list(by)
    ranked = running_totals(_flags(df, label, score, by), "score", ["pos", "neg"], by)
    # totals come from the ranked rows, one per distinct score, not from the input again
    ranked = materialise(ranked, "roc")
    totals = ranked.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    if by:
        totals = totals.withColumnsRenamed({k: f"_by_{k}" for k in by})
        ranked = ranked.join(totals, reduce(and_, [
            F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in by]))
    else:
        row = totals.first()  # one row of two numbers
        ranked = ranked.withColumns({"_p": F.lit(row["_p"]), "_n": F.lit(row["_n"])})
    return ranked.select(
        *by, F.col("score").alias("threshold"),
        _ratio(F.col("_n") - F.col("neg_before"), F.col("_n")).alias("fpr"),
        _ratio(F.col("_p") - F.col("pos_before"), F.col("_p")).alias("tpr"))


def evaluate(df: DataFrame, label: str = "default", score: str = "score",
             by: list[str] = ("model", "split"), cutoff: float = 0.5) -> DataFrame:
    """ROC-AUC, precision, recall, F1 and the confusion counts for every group."""
    by = list(by)
    ranked = running_totals(_flags(df, label, score, by), "score", ["pos", "neg"], by)
    called = F.col("score") >= cutoff

    def total(c: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(c)).otherwise(0)), F.lit(0))

    counts = ranked.groupBy(*by).agg(
        total("neg", ~called).alias("tn"), total("neg", called).alias("fp"),
        total("pos", ~called).alias("fn"), total("pos", called).alias("tp"),
        F.sum(F.expr(WINS)).alias("_wins"))
    p, n = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    return precision_recall_f1(counts).withColumn(
        "roc_auc", F.try_divide(F.col("_wins"), p.cast("double") * n)).select(
        *by, "roc_auc", "precision", "recall", "f1", "tn", "fp", "fn", "tp")


def metrics_long(wide: DataFrame, by: list[str] = ("model", "split")) -> DataFrame:
    """(model, split, metric, value) rows."""
    return wide.unpivot(list(by), ["roc_auc", "precision", "recall", "f1"], "metric", "value")


def business_cost(counts: DataFrame, policy: RiskPolicy = POLICY) -> DataFrame:
    """Append the cost of wrongly rejected and wrongly approved loans to confusion counts."""
    fp = F.col("fp") * F.lit(policy.false_positive_cost)
    fn = F.col("fn") * F.lit(policy.false_negative_cost)
    return counts.withColumns({"fp_cost": fp, "fn_cost": fn, "total_cost": fp + fn})


def threshold_sweep(df: DataFrame, label: str = "default", score: str = "score",
                    thresholds: list[float] | None = None,
                    policy: RiskPolicy = POLICY) -> DataFrame:
    """Cost of predicting positive at score >= t, for every t, from one pass over the data.

    Each row falls between two neighbouring thresholds; counts per gap are all that is needed,
    and the running sums go over len(thresholds) + 1 rows.
    """
    thresholds = threshold_grid() if thresholds is None else list(thresholds)
    cuts = sorted(set(thresholds))
    spark = df.sparkSession
    gaps = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_score",
                      outputCol="_gap")
    counted = (gaps.transform(df.withColumn("_score", known_score(score)))
               .groupBy(F.col("_gap").cast("int").alias("gap"))
               .agg(F.count_if(F.col(label) == 1).alias("pos"),
                    F.count_if(F.col(label) == 0).alias("neg")))
    gap_rows = spark.range(len(cuts) + 1).select(F.col("id").cast("int").alias("gap"))
    filled = gap_rows.join(counted, "gap", "left").na.fill(0, ["pos", "neg"])
    up_to = Window.partitionBy(F.lit(1)).orderBy("gap")
    whole = Window.partitionBy(F.lit(1))
    running = filled.select(
        "gap",
        F.sum("pos").over(up_to).alias("fn"),
        (F.sum("neg").over(whole) - F.sum("neg").over(up_to)).alias("fp"))
    listed = spark.createDataFrame(
        [(i, t, cuts.index(t)) for i, t in enumerate(thresholds)],
        "position int, threshold double, gap int")
    cost = (F.col("fp") * F.lit(policy.false_positive_cost)
            + F.col("fn") * F.lit(policy.false_negative_cost))
    return (listed.join(running, "gap")
            .select("position", "threshold", "fp", "fn", cost.alias("cost")))


def optimal_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold with the lowest cost."""
    best = sweep.agg(F.min_by(F.struct("threshold", "cost"),
                              F.struct("cost", "position")).alias("b"))
    return best.select(F.col("b.threshold").alias("optimal_threshold"),
                       F.col("b.cost").alias("optimal_cost"))
