"""Splits, folds, samples and evaluation against direct computations."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendmill.config import threshold_grid
from lendmill.operators import evaluate, split
from lendmill.operators.ordering import cut_points, even_cuts, running_max, running_totals


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_split_sizes_are_exact_and_stable(spark, apps):
    out = split.stratified_split(apps)
    counts = {(r.default, r.split): r["count"]
              for r in out.groupBy("default", "split").count().collect()}
    for label, n in as_dict(apps.groupBy("default").count(), "default", "count").items():
        test, val = math.floor(0.2 * n + 0.5), math.floor(0.1 * n + 0.5)
        assert counts[(label, "test")] == test and counts[(label, "validation")] == val
        assert counts[(label, "train")] == n - test - val
    again = split.stratified_split(apps.repartition(11))
    assert as_dict(out, "app_id", "split") == as_dict(again, "app_id", "split")


def test_split_of_tiny_and_null_classes(spark):
    rows = [(i, 1 if i < 3 else (0 if i < 20 else None)) for i in range(24)]
    out = split.stratified_split(spark.createDataFrame(rows, "app_id long, default int"))
    assert out.where("split IS NULL").count() == 0 and out.count() == 24


def test_folds_differ_by_at_most_one(spark, apps):
    out = split.stratified_folds(apps, 4)
    for label in (0, 1):
        sizes = [r["count"] for r in out.where(F.col("default") == label)
                 .groupBy("fold").count().collect()]
        assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_sample_depends_on_ids_alone(spark, apps, monkeypatch):
    a = {r.app_id for r in split.seeded_sample(apps, 137).collect()}
    monkeypatch.setattr(split, "BUCKET_ROWS", 3)
    b = {r.app_id for r in split.seeded_sample(apps.repartition(5), 137).collect()}
    assert a == b and len(a) == 137
    assert split.seeded_sample(apps, 10 ** 6).count() == apps.count()
    assert split.seeded_sample(apps, 0).count() == 0


def test_repeated_ids_do_not_change_sample_sizes(spark):
    rows = spark.range(30_000).select((F.col("id") % 100).alias("app_id"))
    for n in (1, 1000, 12_345):
        assert split.seeded_sample(rows, n).count() == n
        assert split.first_rows(rows, n).count() == n
    assert {r[0] for r in split.first_rows(rows, 600).distinct().collect()} == {0, 1}


def test_any_number_of_classes(spark):
    rows = spark.range(260_000).select(
        F.col("id").alias("app_id"),
        # a hundred thousand classes of two rows, one of 60,000 and rows without a class
        F.when(F.col("id") < 200_000, F.floor(F.col("id") / 2)).when(
            F.col("id") < 259_000, F.lit(-1)).alias("default"))
    counts = split.stratified_split(rows).groupBy("default", "split").count().collect()
    sizes = {}
    for r in counts:
        sizes.setdefault(r.default, {})[r.split] = r["count"]
    assert len(sizes) == 100_002 and sum(r["count"] for r in counts) == 260_000
    for found in sizes.values():
        n = sum(found.values())
        test, val = math.floor(0.2 * n + 0.5), math.floor(0.1 * n + 0.5)
        assert found.get("test", 0) == test and found.get("validation", 0) == val


@pytest.mark.parametrize("k", [1, 2, 3, 7])
def test_joined_cuts_equal_literal_cuts(spark, monkeypatch, k):
    rows = spark.createDataFrame(
        [(i, f"c{min(i % 12, i % 5)}" if i % 9 else None) for i in range(997)]
        + [(5, "c1"), (5, "c1"), (1000, "alone")], "app_id long, default string")

    def both():
        a = split.stratified_split(rows.repartition(3))
        return sorted(map(str, split.stratified_folds(a, k).collect()))

    literal = both()
    monkeypatch.setattr(split, "LITERAL_STRATA", 1)
    monkeypatch.setattr(split, "BUCKET_ROWS", 5)
    assert both() == literal
    assert split.stratified_folds(rows.limit(0), 3).count() == 0


def test_missing_scores_are_negative_predictions(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(1, None), (0, 0.2), (1, 0.9), (0, nan)],
                                 "default int, score double")
    counts = ("tn", "fp", "fn", "tp")
    found = evaluate.evaluate(rows, by=[], cutoff=0.5).first()
    assert [found[k] for k in counts] == [2, 0, 1, 1]
    sweep = evaluate.threshold_sweep(rows, thresholds=[0.1, 0.5]).orderBy("position").collect()
    assert [(r.fp, r.fn) for r in sweep] == [(1, 1), (0, 1)]
    # missing scores tie at the bottom: 1 wins against 2, the other ties one and loses one
    assert evaluate.roc_auc(rows).first().roc_auc == (2 + 0.5) / 4
    flagged = rows.withColumn("prediction", F.when(F.col("score") >= 0.5, 1))
    assert evaluate.confusion(flagged).first().tp == 1
    curve = evaluate.roc_curve(rows).collect()
    assert max(r.tpr for r in curve) == 1 and max(r.fpr for r in curve) == 1


def auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y]
    neg = [s for y, s in zip(labels, scores) if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.25, 0.5, 0.9, 0.91])),
                min_size=2, max_size=50))
def test_auc_matches_all_pairs(spark, rows):
    labels, scores = zip(*rows)
    df = spark.createDataFrame(rows, "default int, score double")
    got = evaluate.roc_auc(df).first().roc_auc
    if len(set(labels)) < 2:
        assert got is None
    else:
        assert got == pytest.approx(auc(labels, scores))


def test_running_sums_and_maxima_over_many_ranges(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(v), int(rng.integers(1, 9)), float(v) if rng.random() < 0.3 else None)
            for g in "ab" for v in np.unique(rng.normal(size=400).round(2))]
    df = spark.createDataFrame(rows, "g string, v double, n long, m double")
    sums = {(r.g, r.v): r.n_before
            for r in running_totals(df, "v", ["n"], ["g"], cut_points(df, "v", 37)).collect()}
    tops = {(r.g, r.v): r.m_so_far
            for r in running_max(df, "v", "m", ["g"], even_cuts(-3.0, 3.0, 41)).collect()}
    for g in "ab":
        total, top = 0, None
        for _, v, n, m in [r for r in rows if r[0] == g]:
            top = m if m is not None else top
            assert sums[(g, v)] == total and tops[(g, v)] == top
            total += n


def test_groups_named_null_are_kept(spark):
    rows = [(None, 1, 0.9), (None, 0, 0.1), ("a", 1, 0.2), ("a", 0, 0.4), ("a", 1, 0.4)]
    df = spark.createDataFrame(rows, "g string, default int, score double")
    got = as_dict(evaluate.evaluate(df, by=["g"]), "g", "roc_auc")
    assert got == {None: 1.0, "a": 0.25}
    assert evaluate.roc_curve(df, by=["g"]).count() == 4


def test_sweep_equals_direct_scans(spark, apps):
    rng = np.random.default_rng(2)
    # scores that sit exactly on thresholds, too
    scores = np.concatenate([rng.random(500), threshold_grid(), [0.9, 0.0, 1.0]])
    labels = rng.integers(0, 2, len(scores))
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)],
                               "default int, score double")
    for grid in (None, [0.5, 0.2, 0.5, 0.9]):
        rows = evaluate.threshold_sweep(df, thresholds=grid).orderBy("position").collect()
        expected = threshold_grid() if grid is None else grid
        assert [r.threshold for r in rows] == expected
        costs = []
        for r in rows:
            called = scores >= r.threshold
            fp, fn = int((called & (labels == 0)).sum()), int((~called & (labels == 1)).sum())
            assert (r.fp, r.fn) == (fp, fn)
            costs.append(5000.0 * fp + 20000.0 * fn)
        best = evaluate.optimal_threshold(evaluate.threshold_sweep(df, thresholds=grid)).first()
        assert best.optimal_cost == min(costs)
        assert best.optimal_threshold == expected[int(np.argmin(costs))]


def test_one_class_confusion_is_zero_filled(spark):
    df = spark.createDataFrame([(1, 1), (1, 0)], "default int, prediction int")
    row = evaluate.precision_recall_f1(evaluate.confusion(df)).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (0, 0, 1, 1)
    none = evaluate.precision_recall_f1(evaluate.confusion(df.where("prediction = 0"))).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_roc_curve_ends_and_area(spark):
    rng = np.random.default_rng(3)
    rows = [(int(rng.random() < s), float(round(s, 2))) for s in rng.random(300)]
    df = spark.createDataFrame(rows, "default int, score double")
    points = sorted((r.fpr, r.tpr) for r in evaluate.roc_curve(df).collect())
    xs, ys = [0.0] + [p[0] for p in points], [0.0] + [p[1] for p in points]
    assert points[-1] == (1.0, 1.0)
    assert np.trapezoid(ys, xs) == pytest.approx(evaluate.roc_auc(df).first().roc_auc)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "default int")
    assert as_dict(evaluate.class_weights(df), "default", "weight") == {0: 8 / 12, 1: 2.0}
    assert evaluate.class_counts(df).first().scale_pos_weight == 3.0
