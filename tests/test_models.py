"""Training, persistence, SHAP, LIME, counterfactuals and oversampling."""

import itertools
import math
import subprocess
import sys
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendmill.config import LimeSpec
from lendmill.operators import beyond, explain, forest, lime, ranking, shap, smote, split, train
from lendmill.operators.scorer import scorer_of
from lendmill.plans import explaining, scoring, training
from lendmill.schema import CATEGORICAL
from lendmill.session import scratch
from lendmill.sources import models
from registry import queries, variants
from registry.mapping import requests


def test_metrics_beat_chance_and_best_is_first_on_ties(spark, result):
    rows = result.metrics.where("split = 'validation'").collect()
    assert {r.model for r in rows} == {"boosted", "forest", "linear"}
    assert all(r.roc_auc > 0.75 for r in rows)
    best = max(rows, key=lambda r: r.roc_auc).model
    assert result.best() == best
    assert result.comparison().first().model == best.upper()
    tied = spark.createDataFrame([("late", 2, "validation", 0.8), ("early", 1, "validation", 0.8),
                                  ("zero", 0, "validation", 0.0)],
                                 "model string, position int, split string, f1 double")
    assert ranking.best_model(tied, "f1").first().model == "early"


def test_boosted_probability_is_a_logistic_margin(spark, result):
    fitted = result.models["boosted"]
    data = train.vectorise(result.features, fitted.features)
    worst = fitted.model.transform(data).select(F.max(F.abs(
        vector_to_array("probability")[1]
        - 1 / (1 + F.exp(-2 * vector_to_array("rawPrediction")[1]))))).first()[0]
    assert worst < 1e-12


def test_importances_sum_to_one(spark, result):
    for fitted in result.models.values():
        total = train.feature_importance(fitted, spark).agg(F.sum("importance")).first()[0]
        assert total == pytest.approx(1.0)


@pytest.mark.parametrize("kind", ["boosted", "forest", "linear"])
def test_saved_classifier_scores_the_same(spark, result, kind):
    fitted = result.models[kind]
    path = scratch(spark, "test-model")
    models.save_classifier(fitted, path, spark)
    again = models.load_classifier(spark, path)
    assert again.features == fitted.features
    a = train.score(fitted, result.features).orderBy("app_id").collect()
    b = train.score(again, result.features).orderBy("app_id").collect()
    assert a == b


def test_grid_search_refits_the_first_best(spark, result):
    found = train.grid_search(result.features.where("split = 'train'"), result.prep.features,
                              {"max_depth": [2, 3], "n_estimators": [3],
                               "colsample_bytree": [1.0]}, folds=2)
    scores = [s for _, s in found.cv_scores]
    assert len(scores) == 2 and found.cv_score == max(scores)
    assert found.params == found.cv_scores[int(np.argmax(scores))][0]
    assert found.model.getMaxDepth() == found.params["maxDepth"]


def test_grid_names_map_to_learner_settings():
    assert train._spark_param("boosted", "n_estimators", 7) == ("maxIter", 7)
    assert train._spark_param("forest", "n_estimators", 7) == ("numTrees", 7)
    assert train._spark_param("boosted", "colsample_bytree", 0.8) == ("featureSubsetStrategy", "0.8")
    assert train._spark_param("boosted", "min_child_weight", 3) == ("minInstancesPerNode", 3)


def test_fit_on_all_rows_is_available(spark, apps):
    on_train, _ = training.prepare(apps)
    on_all, _ = training.prepare(apps, fit_on="all")
    assert on_train.fill != on_all.fill


# ---- SHAP ------------------------------------------------------------------------------------

def _tree_value(tree, x, known):
    total = 0.0
    for leaf in tree.leaves:
        weight = 1.0
        for f, share, steps in zip(leaf.features, leaf.shares, leaf.steps):
            if f in known:
                weight *= all((x[f] <= tree.split_threshold[k]) == left for k, left in steps)
            else:
                weight *= share
        total += weight * leaf.value
    return total


def _brute_force(tree, x):
    used = sorted({f for leaf in tree.leaves for f in leaf.features})
    phi = np.zeros(len(x))
    for j in used:
        rest = [f for f in used if f != j]
        for size in range(len(rest) + 1):
            w = math.factorial(size) * math.factorial(len(used) - size - 1) / math.factorial(len(used))
            for known in itertools.combinations(rest, size):
                phi[j] += w * (_tree_value(tree, x, {*known, j}) - _tree_value(tree, x, set(known)))
    return phi


def test_tree_shap_equals_brute_force(spark, result):
    # depth 3 bounds a tree to seven distinct features
    fitted = train.train(result.features, result.prep.features, "boosted",
                         {"max_depth": 3, "n_estimators": 4})
    trees = shap.read_trees(fitted, spark)
    assert len(trees) == 4
    rows = np.array([[float(v) for v in r] for r in
                     result.features.select(*fitted.features).limit(4).collect()])
    for tree in trees:
        got = shap.shap_matrix([tree], rows)
        for i, x in enumerate(rows):
            assert np.allclose(got[i], _brute_force(tree, x), atol=1e-12)


def test_task_functions_need_no_installed_package(tmp_path):
    """What a task receives must load where this package cannot be imported."""
    from pyspark import cloudpickle
    tree = shap.Tree(np.array([0]), np.array([0.5]),
                     [shap.Leaf(1.0, [0], np.array([0.25]), [[(0, True)]]),
                      shap.Leaf(-1.0, [0], np.array([0.75]), [[(0, False)]])])
    (tmp_path / "f.bin").write_bytes(cloudpickle.dumps((shap.shap_matrix, [tree])))
    code = ("import numpy, pickle; f, t = pickle.load(open('f.bin', 'rb')); "
            "print(f(t, numpy.array([[0.0], [1.0]])).ravel().tolist())")
    out = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True,
                         text=True, timeout=60)
    assert out.stdout.strip() == "[1.5, -0.5]", out.stderr


def test_deep_trees_add_up(spark, result):
    deep = train.train(result.features, result.prep.features, "boosted",
                       {"max_depth": 14, "n_estimators": 2})
    trees = shap.read_trees(deep, spark)
    assert max(len(leaf.features) for t in trees for leaf in t.leaves) > 8
    table = shap.add_tree_shap(result.features, deep, trees)
    total = F.aggregate("shap", F.col("base_value"), lambda a, b: a + b)
    p = (1 / (1 + F.exp(-total))).alias("p")
    joined = table.select("app_id", p).join(train.score(deep, result.features), "app_id")
    assert joined.agg(F.max(F.abs(F.col("p") - F.col("p_model")))).first()[0] < 1e-12


def test_long_paths_use_the_same_formula():
    shares = np.linspace(0.2, 0.9, 14)
    patterns = np.array([0, 5, 2 ** 14 - 1])
    table = shap.leaf_table(3.0, shares, patterns)
    for row, pattern in zip(table, patterns):
        held = (pattern >> np.arange(14)) & 1
        whole = np.prod(np.where(held, 1.0, 0.0))
        assert row.sum() == pytest.approx(3.0 * (whole - shares.prod()))


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_shap_adds_up_to_the_prediction(spark, result, kind):
    fitted = result.models[kind]
    table = shap.add_tree_shap(result.features, fitted)
    total = F.aggregate("shap", F.col("base_value"), lambda a, b: a + b)
    p = 1 / (1 + F.exp(-total)) if kind == "boosted" else total
    joined = table.select("app_id", p.alias("p")).join(train.score(fitted, result.features), "app_id")
    row = joined.agg(F.max(F.abs(F.col("p") - F.col("p_model"))), F.count("*")).first()
    assert row[0] < 1e-12 and row[1] == result.features.count()


def test_explanation_reports_original_units(spark, apps, result):
    table = explaining.shap_table(apps, result.prep, result.models["boosted"])
    raw = {r.app_id: r.cibil_score for r in apps.collect()}
    assert all(r.cibil_score == raw[r.app_id] for r in
               table.select("app_id", "cibil_score").collect())


def test_top_contributions_are_sorted_and_labelled(spark, apps):
    means = shap.background_means(apps, list(variants.LINEAR_WEIGHTS))
    df = shap.add_linear_shap(apps, variants.LINEAR_WEIGHTS, means)
    rows = explain.top_features(df, list(variants.LINEAR_WEIGHTS), 3).where("app_id < 20").collect()
    for key, group in itertools.groupby(sorted(rows, key=lambda r: (r.app_id, r.rank)),
                                        key=lambda r: r.app_id):
        sizes = [r.abs_shap for r in group]
        assert len(sizes) == 3 and sizes == sorted(sizes, reverse=True)
    assert all(r.direction == ("Increases Risk" if r.shap_value > 0 else "Reduces Risk")
               for r in rows)


# ---- counterfactuals ----------------------------------------------------------------------------


def test_smaller_forests_of_a_fitted_one(spark, result):
    """Cut at its own depth a forest scores as MLlib does; a point's area is that of its forest."""
    rows = result.features.where("split = 'train'").limit(700)
    names = result.prep.features
    fitted = train.train(rows, names, "forest", {"n_estimators": 7, "max_depth": 4})
    trees = forest.cut_trees(shap.node_table(fitted, spark).collect(), [1, 2, 4])
    found = rows.select("app_id", forest.share_column(
        trees, [(7, 4), (3, 2)], len(names), shap.feature_array(names)).alias("s"))
    both = found.join(train.score(fitted, rows, ["app_id"]), "app_id").collect()
    assert max(abs(r.s[0] - r.p_model) for r in both) < 1e-12 and len(both) == rows.count()
    # cut by hand: leaves of one parent and class are one leaf
    split = lambda f: SimpleNamespace(featureIndex=f, numCategories=-1,
                                      leftCategoriesOrThreshold=[0.5])
    node = lambda t, i, a, b, y, s, f=0: SimpleNamespace(
        treeID=t, id=i, leftChild=a, rightChild=b, prediction=y, impurityStats=s, split=split(f))
    tree = [node(0, 0, 1, 4, 0.0, [6, 4]), node(0, 1, 2, 3, 0.0, [5, 1], 1),
            node(0, 2, -1, -1, 0.0, [5, 0]), node(0, 3, -1, -1, 1.0, [0, 1]),
            node(0, 4, -1, -1, 0.0, [3, 1])]
    x = np.array([[0.0, 0.0], [0.0, 1.0], [1.0, 0.0]])
    got = forest.shares(forest.cut_trees(tree, [1, 2]), [(1, 1), (1, 2)], x)
    assert got[:, 0].tolist() == [0.4, 0.4, 0.4]      # both sides predict 0
    assert got[:, 1].tolist() == [0.0, 1.0, 0.25]


def test_forest_grid_fits_one_forest_a_fold(spark, result, monkeypatch):
    fits = []
    original = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit",
                        lambda self, df: fits.append(self.getNumTrees()) or original(self, df))
    rows = result.features.where("split = 'train'")
    found = train.grid_search(rows, result.prep.features,
                              {"max_depth": [2, 4], "n_estimators": [3, 6]}, "forest", folds=2)
    assert fits == [6, 6, found.params["numTrees"]]
    assert len(found.cv_scores) == 4 and all(0.6 < s < 1 for _, s in found.cv_scores)


def test_medians_beyond_with_hot_and_foreign_values(spark):
    rng = np.random.default_rng(5)
    a = [0.0] * 400 + rng.integers(1, 9, 200).astype(float).tolist()      # one hot value
    b = rng.normal(size=600).round(3).tolist()
    population = spark.createDataFrame(list(zip(a, b)), "a double, b double").repartition(6)
    asked = [("a", v) for v in (0.0, 3.0, 8.0, 8.5, -1.0)] + [("b", v) for v in (-9.0, 0.0, 9.0, b[7])]
    got = explain.medians_beyond(population, spark.createDataFrame(asked, "feature string, value double"),
                                 ["a", "b"]).collect()
    assert len(got) == len(asked)
    for r in got:
        values = np.array(a if r.feature == "a" else b)
        for found, part in ((r.median_below, values[values < r.value]),
                            (r.median_above, values[values > r.value])):
            assert found == (pytest.approx(np.median(part)) if len(part) else None)


def test_force_table_is_checked_without_an_expanded_exchange(spark, sf_dir):
    # counting the different features by their names sent every cell through the exchange
    plan = queries.QUERIES["X4_force_table"](spark, sf_dir)._jdf.queryExecution().executedPlan() \
        .toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("bucket_rows", [7, 60, 100_000])
def test_sided_medians_over_ranges_equal_numpy(spark, bucket_rows):
    some = [None, -0.0, 0.0, 1.0, 2.5, 7.25, 1e300, float("inf")]
    rows = [(i, some[i * 7 % 8], float(i * i % 97), None) for i in range(300)]
    df = spark.createDataFrame(rows, "app_id long, a double, b double, c double")
    asked = [(f, v, s) for f, vs in {"a": [-1.0, 0.0, 2.0, 7.25, 1e301], "c": [0.0],
                                     "b": [-5.0, 0.0, 1.0, 40.5, 95.0, 96.0, 200.0]}.items()
             for v in vs for s in (0, 1)]
    questions = spark.createDataFrame(asked, "feature string, value double, side int")
    got = {(r.feature, r.value, r.side): r.median for r in beyond.sided_medians(
        df, questions.unionByName(questions), ["a", "b", "c"], bucket_rows).collect()}
    want = {}
    for f, v, s in asked:
        held = np.array([r["abc".index(f) + 1] for r in rows if r["abc".index(f) + 1] is not None])
        beyond_it = np.sort(held[held < v] if s == 0 else held[held > v])
        if n := len(beyond_it):
            want[f, v, s] = (beyond_it[(n - 1) // 2] + beyond_it[n // 2]) / 2
    assert got == want


def test_suggestions_shuffle_arrays_instead_of_a_row_per_value(spark):
    rows = [(i, float(i), i / 7) for i in range(2_000)]
    df = spark.createDataFrame(rows, "app_id long, a double, b double").withColumns(
        {"shap": F.array(F.lit(0.5), -F.col("a"))})
    asked = []
    original = beyond._pack_population

    def packed(rows, width, cuts):
        found = original(rows, width, cuts)
        asked.append(found.count())
        return found

    beyond._pack_population = packed
    try:
        assert explain.counterfactual(df, ["a", "b"], df).count() == 4_000
    finally:
        beyond._pack_population = original
    assert asked and asked[0] < 100


def test_counterfactual_falls_back_without_population(spark):
    df = spark.createDataFrame([(1, 10.0, 20.0, [1.0, -2.0])],
                               "app_id long, a double, b double, shap array<double>")
    rows = {r.feature: r for r in explain.counterfactual(df, ["a", "b"], df).collect()}
    assert (rows["a"].direction, rows["a"].suggested_value) == ("decrease", 8.0)
    assert (rows["b"].direction, rows["b"].suggested_value) == ("increase", 24.0)
    assert (rows["b"].rank, rows["a"].rank) == (1, 2)


def test_counts_beyond(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, None), (5, 9.0)],
                               "app_id long, x double")
    got = {r.app_id: (r.n_below, r.n_above) for r in explain.counts_beyond(df, df, "x").collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (None, None), 5: (3, 0)}


@pytest.mark.parametrize("p,target", [(0.8, 0.7), (0.5, 0.6), (0.2, 0.3)])
def test_target_probability(spark, p, target):
    assert spark.range(1).select(explain.target_probability(F.lit(p))).first()[0] \
        == pytest.approx(target)


# ---- LIME ---------------------------------------------------------------------------------------------

def test_lime_recovers_a_linear_model(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 3))
    p = 1 / (1 + np.exp(-(2.5 * x[:, 0] - 1.2 * x[:, 1])))
    rows = [(i, *map(float, r), int(rng.random() < q)) for i, (r, q) in enumerate(zip(x, p))]
    df = spark.createDataFrame(rows, "app_id long, big double, mid double, none double, default int")
    fitted = train.train(df, ["big", "mid", "none"], "linear")
    bins = lime.fit_bins(df, fitted.features)
    some = df.where("big > 1.2 AND mid > 1.0")
    out = lime.lime_explain(some, fitted, bins, LimeSpec(samples=800, top=3), partitions=3).collect()
    assert len(out) == some.count() > 0
    scored = {r.app_id: r.p_model for r in train.score(fitted, some).collect()}
    for r in out:
        weights = {x.feature: x.weight for x in r.contributions}
        assert weights["big"] > 0 > weights["mid"]
        assert abs(weights["big"]) > abs(weights["mid"]) > abs(weights["none"])
        assert r.prediction == pytest.approx(scored[r.app_id])
        assert any(x.rule.startswith("big > ") for x in r.contributions)


def test_lime_does_not_depend_on_partitioning(spark, result):
    fitted = result.models["boosted"]
    bins = lime.fit_bins(result.features, fitted.features)
    rows = result.features.where("app_id < 40")
    a, b = (lime.lime_explain(rows, fitted, bins, LimeSpec(samples=60), partitions=n)
            .orderBy("app_id").collect() for n in (1, 5))
    assert a == b and len(a) == rows.count()


def test_lime_block_equals_single_regressions():
    rng = np.random.default_rng(4)
    same = rng.random((3, 300, 9)) < 0.4
    same[:, 0] = True
    p = rng.random((3, 300))
    spec = LimeSpec(top=7)
    for g, fit in enumerate(lime.surrogates(same, p, 7, spec)):
        x = same[g].astype(float)
        w = np.sqrt(np.exp(-(1 - x).sum(1) / (np.sqrt(9) * spec.kernel_factor) ** 2))
        used = lime.select_features(x, p[g], w, 7, spec)
        weights, intercept = lime.ridge(x[:, used], p[g], w, spec.ridge)
        assert set(fit["features"]) == set(used)
        expected = dict(zip(used, weights))
        assert all(v == pytest.approx(expected[f]) for f, v in zip(fit["features"], fit["weights"]))
        assert fit["intercept"] == pytest.approx(intercept)
        assert fit["score"] == pytest.approx(lime._r2(x[:, used], p[g], w, weights, intercept))


def test_lime_samples_follow_the_bins(spark):
    values = [0.0] * 50 + [float(v) for v in range(1, 151)]
    df = spark.createDataFrame([(v, -v) for v in values], "a double, b double")
    bins = lime.fit_bins(df, ["a", "b"])
    sampler = lime.Sampler.of(bins)
    rows = np.array([[0.0, 0.0], [150.0, -3.0]])
    drawn, same = sampler.perturb(rows, [1, 2], 4000)
    assert (drawn[:, 0] == rows).all() and same[:, 0].all()
    assert drawn[..., 0].min() >= 0.0 and drawn[..., 0].max() <= 150.0
    again, _ = sampler.perturb(rows[1:], [2], 4000)
    assert (again[0] == drawn[1]).all()
    for i, b in enumerate(bins):
        hit = np.bincount(sampler.bin_of(drawn[0])[1:, i], minlength=len(b.shares)) / 3999
        assert np.allclose(hit, b.shares, atol=0.03)


def test_lime_forward_selection():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (400, 8)).astype(float)
    y = 3 * x[:, 2] - 2 * x[:, 5] + 0.1 * rng.normal(size=400)
    for selection in ("forward", "weights"):
        spec = LimeSpec(selection=selection)
        assert set(lime.select_features(x, y, np.ones(400), 2, spec)) == {2, 5}


# ---- SMOTE -----------------------------------------------------------------------------------------------

def test_neighbours_are_exact(spark, result):
    features = result.prep.features
    points = result.features.where("default = 0").select(
        "app_id", shap.feature_array(features).alias("x"), F.lit(True).alias("ask"))
    rows = points.collect()
    x, ids = np.stack([r.x for r in rows]), [r.app_id for r in rows]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    expected = {i: np.sort(d[k])[:5] for k, i in enumerate(ids)}
    got: dict = {}
    for r in smote.nearest(points, 5).orderBy("app_id", "rank").collect():
        got.setdefault(r.app_id, []).append(r.distance)
    assert set(got) == set(expected)
    assert all(np.allclose(got[i], expected[i], atol=1e-6) for i in ids)
    # many small buckets: near neighbours, never nearer than the nearest
    near: dict = {}
    for r in smote.nearest(points, 5, block_rows=100).orderBy("app_id", "rank").collect():
        near.setdefault(r.app_id, []).append(r.distance)
    assert all(near[i][0] >= expected[i][0] - 1e-6 for i in near)
    assert np.mean([near[i][0] <= expected[i][-1] + 1e-6 for i in near]) > 0.5


@pytest.mark.parametrize("columns,values", [(3, 50), (64, 4), (700, 10_000), (900, 3), (1_000, 40)])
def test_smallest_numbers_of_rows(columns, values):
    d = np.random.default_rng(columns).integers(0, values, (40, columns)).astype(float)
    d[np.arange(40), np.arange(40) % columns] = np.inf
    rows, cols = smote.smallest(d, 5)
    most = min(5, columns)
    assert rows.tolist() == np.repeat(np.arange(40), most).tolist()
    assert all(len(set(c)) == most for c in cols.reshape(40, most).tolist())
    assert np.array_equal(np.sort(d[rows, cols].reshape(40, most)), np.sort(d)[:, :most])


def test_hyperplane_sides_are_found_in_one_pass_of_arrays(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(500)]
    df = spark.createDataFrame(rows, "app_id long, x array<double>")
    codes = smote._codes(df, 3, 2, 42)   # was one interpreted lambda a plane
    planes = np.random.default_rng(42).standard_normal((6, 6))
    found = df.select("app_id", codes.alias("c")).collect()
    values = np.array([r[1] for r in rows]) @ planes.T
    middle = np.median(values, axis=0)
    clear = (np.abs(values - middle) > 0.2).all(axis=1)
    want = ((values > middle).reshape(-1, 2, 3) << np.arange(3)).sum(axis=2)
    assert clear.sum() > 50
    assert all(r.c == want[r.app_id].tolist() for r in found if clear[r.app_id])


def test_smote_refuses_missing_features_and_keeps_its_promise(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(i < 40), float(rng.normal()), 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "app_id bigint, default int, a double, b double")
    for block_rows in (4096, 2):
        out, info = smote.smote(df, ["a", "b"], block_rows=block_rows)
        assert info["added"] == 140 == out.where("synthetic").count()
    with pytest.raises(ValueError):
        smote.smote(df.withColumn("a", F.when(F.col("app_id") != 3, F.col("a"))), ["a", "b"])


@pytest.mark.parametrize("ratio", [0.5, 1.0])
def test_smote_ratio_and_interpolation(spark, result, ratio):
    features = result.prep.features
    rare = result.features.where("default = 0 OR app_id % 10 = 0")
    out, info = smote.smote(rare, features, ratio=ratio, categorical=CATEGORICAL, block_rows=64)
    counts = {(r.default, r.synthetic): r["count"]
              for r in out.groupBy("default", "synthetic").count().collect()}
    assert info["applied"] and counts[(1, True)] == info["added"]
    assert counts[(1, True)] + counts[(1, False)] == int(ratio * counts[(0, False)])
    real = np.array([[float(v) for v in r] for r in rare.where("default = 1").select(*features).collect()])
    made = [r for r in out.where("synthetic").collect()]
    low, high = real.min(0), real.max(0)
    for r in made:
        values = np.array([float(r[f]) for f in features])
        assert ((values >= low - 1e-9) & (values <= high + 1e-9)).all()
        for f in CATEGORICAL:
            assert r[f] in set(real[:, features.index(f)])


def test_smote_is_a_flagged_no_op_when_the_ratio_is_met(spark, result):
    out, info = smote.smote(result.features, result.prep.features)
    assert not info["applied"] and out.where("synthetic").count() == 0
    assert out.count() == result.features.count()


# ---- scoring ------------------------------------------------------------------------------------------------

def test_scoring_plan_is_one_narrow_stage(spark, sf_dir, result):
    df = scoring.score_applications(requests(spark, sf_dir), result.prep, result.models["boosted"])
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_floors_only_raise_the_model_score(spark, sf_dir, result):
    df, metrics = scoring.score_batch(requests(spark, sf_dir), result.prep, result.models["boosted"])
    assert df.where("p_final < p_model").count() == 0
    assert df.where("floor_applied <> (size(fired_rules) > 0)").count() == 0
    assert metrics.first().total_applicants == df.count()


def test_full_explanation_record(spark, sf_dir, apps, result):
    some = requests(spark, sf_dir).where("app_id < 30")
    rows = explaining.explain_applications(some, apps, result.prep, result.models["boosted"]).collect()
    assert len(rows) == some.count()
    for r in rows:
        assert len(r.top_features) == 10 and len(r.counterfactual.suggestions) == 3
        assert r.prediction["class"] == int(r.prediction.probability >= 0.5)
        assert [s.feature for s in r.counterfactual.suggestions] \
            == [t.feature for t in r.top_features[:3]]
        assert len(r.shap_values) == len(result.prep.features)


def test_background_sample_size(spark, result):
    path = scratch(spark, "test-background")
    models.save_background(result.features, path, 100)
    assert spark.read.parquet(path).count() == 100
    assert split.first_rows(result.features, 7).count() == 7


@pytest.mark.parametrize("kind", ["boosted", "forest", "linear"])
def test_scorer_equals_the_model(spark, result, kind):
    fitted = result.models[kind]
    rows = result.features.limit(200)
    x = np.array([r.x for r in rows.select(shap.feature_array(fitted.features).alias("x")).collect()])
    ours = scorer_of(fitted, spark)()(np.ascontiguousarray(x.T))
    theirs = np.array([r.p_model for r in train.score(fitted, rows).collect()])
    assert np.allclose(np.sort(ours), np.sort(theirs), atol=1e-12)


@pytest.mark.parametrize("kind,params", [("histogram", {"n_estimators": 12, "max_depth": 6}),
                                         ("ordered", {"iterations": 5, "depth": 3})])
def test_scorer_of_own_trees(spark, result, kind, params):
    rows = result.features.where("split = 'train'")
    fitted = train.train(rows, result.prep.features, kind, params,
                         categorical=result.prep.categorical)
    x = np.array([r.x for r in rows.select(shap.feature_array(fitted.features).alias("x")).collect()])
    ours = scorer_of(fitted, spark)()(np.ascontiguousarray(x.T))
    theirs = np.array([r.p_model for r in train.score(fitted, rows).collect()])
    assert np.allclose(np.sort(ours), np.sort(theirs), atol=1e-12)


def test_samples_are_scored_by_shared_splits(spark, result):
    """Equal splits of several trees are compared once, with the sums of trees walked one by one."""
    fitted = result.models["boosted"]
    ensemble = scorer_of(fitted, spark)().ensemble
    splits = [(int(f), float(v)) for tree in ensemble.trees
              for f, v in zip(tree.split_feature, tree.split_threshold)]
    assert len(ensemble.feature) == len(set(splits)) < len(splits)
    bins = lime.fit_bins(result.features, fitted.features)
    sampler = lime.Sampler.of(bins)
    x = np.array([r.x for r in result.features.limit(3).select(
        shap.feature_array(fitted.features).alias("x")).collect()])
    rows, flags = sampler.perturb(x, [5, 6, 7], 6_001)
    for i in range(3):   # a row's samples do not depend on those drawn before
        again, same = lime.Sampler.of(bins).perturb(x[i:i + 1], [5 + i], 6_001)
        assert (again[0] == rows[i]).all() and (same[0] == flags[i]).all()
    columns = np.ascontiguousarray(rows[0].T)
    walked = np.zeros(6_001)
    for tree in ensemble.trees:
        turns = columns[tree.split_feature] <= tree.split_threshold[:, None]
        value = np.zeros(6_001)
        for leaf in tree.leaves:
            met = np.ones(6_001, bool)
            for steps in leaf.steps:
                for k, left in steps:
                    met &= turns[k] == left
            value[met] = leaf.value
        walked += value
    assert (ensemble.total(columns) == walked).all()


def test_interactions_look_patterns_up_without_sorting(spark, result, monkeypatch):
    fitted = result.models["boosted"]
    trees = shap.read_trees(fitted, spark)
    rows = result.features.limit(40)
    x = np.array([r.x for r in rows.select(shap.feature_array(fitted.features).alias("x")).collect()])
    expected = np.zeros((len(x), x.shape[1], x.shape[1]))
    columns = np.ascontiguousarray(x.T)
    for tree in trees:
        turns = shap._turns(tree, columns)
        for leaf in tree.leaves:
            pattern = shap._patterns(leaf, turns, len(x)).astype(np.int64)
            found = shap.pair_table(leaf.value, leaf.shares, pattern)
            for a, b in itertools.permutations(range(len(leaf.features)), 2):
                expected[:, leaf.features[a], leaf.features[b]] += found[:, a, b]
    at = np.arange(x.shape[1])
    expected[:, at, at] = shap.shap_matrix(trees, x) - expected.sum(axis=2)
    monkeypatch.setattr(np, "unique", None)   # short paths need no sort of their patterns
    got = shap.interaction_matrix(trees, x)
    assert np.allclose(got, expected, atol=1e-12)
    assert (got == got.transpose(0, 2, 1)).all()
    monkeypatch.undo()
    df = shap.add_interactions(result.features.limit(40), fitted, trees)
    names = fitted.features
    values = np.abs(np.array([r[0] for r in df.select("interactions").collect()]))
    mean = values.mean(axis=0).reshape(len(names), -1)
    for r in shap.strongest_partners(df.repartition(7), names).collect():
        i, j = names.index(r.feature), names.index(r.partner)
        assert r.mean_abs_interaction == pytest.approx(mean[i, j])
        assert mean[i, j] == pytest.approx(max(mean[i, k] for k in range(len(names)) if k != i))


def test_the_split_is_stored_before_the_fit_reads_it(apps):
    """Passes of the fit and of the features read the stored split instead of hashing ids."""
    from lendmill.plans.training import prepare
    _, features = prepare(apps)
    assert "md5" not in features._jdf.queryExecution().optimizedPlan().toString()
    counts = {(r.split, r.default): r["count"] for r in features.groupBy("split", "default")
              .count().collect()}
    assert sum(counts.values()) == apps.count() and len(counts) == 6


def test_lime_scores_samples_from_their_draws(result, spark):
    """Split outcomes found from the draws alone are those of the values, to the last bit."""
    fitted = result.models["boosted"]
    bins = lime.fit_bins(result.features, fitted.features)
    bins[0].shares[:] = np.eye(len(bins[0].shares))[-1]     # bins without rows are never drawn
    sampler, score = lime.Sampler.of(bins), scorer_of(fitted, spark)()
    drawn = lime.DrawnScorer(score, sampler)
    rows = np.array([list(r) for r in result.features.select(*fitted.features).limit(4).collect()],
                    float)
    for i, (row, own) in enumerate(zip(rows, sampler.bin_of(rows))):
        draws = sampler.draw(i, 4_000)
        draws[:, 1], draws[:, 2] = 0, lime.DRAWS - 1
        values, same = sampler.around(row, own, draws)
        assert (drawn(row, draws) == score(values)).all()
        assert (same == sampler.same_bin(draws, own)).all()
        inside = sampler.bin_of(values.T).T == own[:, None]
        assert (same == inside).mean() > 0.99     # a draw on a cut belongs to the bin above it
    for j in range(len(bins)):
        draws = np.sort(sampler.draw(9, 4_000)[j])
        assert (np.diff(sampler.values_of(j, draws)) >= 0).all()
        thresholds = sampler.values_of(j, draws[::500])
        below = sampler.draws_below(j, thresholds)
        assert (sampler.values_of(j, np.maximum(below - 1, 0)) <= thresholds).all()
        assert (sampler.values_of(j, np.minimum(below, lime.DRAWS - 1))[below < lime.DRAWS]
                > thresholds[below < lime.DRAWS]).all()
