"""Pipeline stages, mergeable fit states and suggestions that the model has scored."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from lendmill.operators import fitstate, prep, recourse, shap, train
from lendmill.operators.scorer import scorer_of
from lendmill.operators.stages import Preprocessor
from lendmill.schema import CATEGORICAL, NUMERIC


def test_pipeline_equals_the_steps(spark, apps, tmp_path):
    learner = LogisticRegression(maxIter=15)
    fitted = Pipeline(stages=[Preprocessor(keepCols=["purpose"]), learner]).fit(apps)
    model, table = prep.fit_transform(apps)
    plain = learner.fit(train.vectorise(table, model.features))
    assert fitted.stages[0].features == model.features
    expected = {r.app_id: r.probability[1] for r in plain.transform(
        train.vectorise(table, model.features)).select("app_id", "probability").collect()}
    fitted.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    for some in (fitted, loaded):
        rows = some.transform(apps).select("app_id", "probability", "purpose").collect()
        assert len(rows) == len(expected)
        assert all(abs(r.probability[1] - expected[r.app_id]) < 1e-9 for r in rows)
    unlabelled = loaded.transform(apps.drop("default"))
    assert unlabelled.count() == len(expected) and "label" not in unlabelled.columns


def test_preprocessor_keeps_its_params(spark, tmp_path):
    stage = Preprocessor(outlierStd=2.0, minVariance=0.5, outputCol="v")
    stage.write().overwrite().save(str(tmp_path / "stage"))
    loaded = Preprocessor.load(str(tmp_path / "stage"))
    assert loaded.getOrDefault("outlierStd") == 2.0 and loaded.getOrDefault("outputCol") == "v"
    assert loaded.uid == stage.uid


# ---- mergeable state -------------------------------------------------------------------------

def parts_of(df, n=3):
    return [df.where(F.pmod(F.xxhash64("app_id"), F.lit(n)) == k) for k in range(n)]


def test_merged_state_equals_one_shot(spark, apps, tmp_path):
    df = apps.withColumn("foir", F.when(F.col("app_id") % 7 != 0, F.col("foir")))
    numeric = [c for c in NUMERIC if c in df.columns]
    once = fitstate.fit_state(df, numeric, CATEGORICAL)
    merged = fitstate.merge([fitstate.fit_state(p, numeric, CATEGORICAL) for p in parts_of(df)]
                            + [fitstate.fit_state(df.limit(0), numeric, CATEGORICAL)])
    merged.save(str(tmp_path / "state"))
    merged = fitstate.FitState.load(spark, str(tmp_path / "state"))
    a = {r.column: r for r in once.numeric.collect()}
    b = {r.column: r for r in merged.numeric.collect()}
    assert set(a) == set(b) == set(numeric)
    for c in numeric:
        for f in ("n", "nulls", "low", "high"):
            assert a[c][f] == b[c][f]
        assert a[c]["mean"] == pytest.approx(b[c]["mean"], rel=1e-12)
        assert a[c].m2 == pytest.approx(b[c].m2, rel=1e-9)
    assert {tuple(r) for r in once.categories.collect()} == {
        tuple(r) for r in merged.categories.collect()}
    assert fitstate.modes_of(merged) == prep.modes(df, CATEGORICAL)
    exact = prep.clip_bounds(df, numeric, 3.0)
    for c, found in fitstate.bounds_of(merged, 3.0).items():
        assert found == pytest.approx(exact[c], rel=1e-9)
    for c, found in fitstate.scaling_of(merged).items():
        assert found == pytest.approx(prep.scale_stats(df, numeric)[c], rel=1e-9)


def test_sketch_ranks_stay_within_the_bound(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.lognormal(0, 4, 30_000), np.full(5_000, 2.0)])
    rng.shuffle(x)
    df = spark.createDataFrame([(float(v), i % 4) for i, v in enumerate(x)], "v double, p int")
    merged = fitstate.merge([fitstate.fit_state(df.where(F.col("p") == k), ["v"]) for k in range(4)])
    ranks = [0.01, 0.1, 0.25, 0.5, 0.75, 0.99]
    for rank, found in zip(ranks, fitstate.quantiles_of(merged, ranks)["v"]):
        low, high = (x < found).mean(), (x <= found).mean()
        assert low - 0.01 <= rank <= high + 0.01


def test_state_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, 1.0)], "a double, b double")
    state = fitstate.merge([fitstate.fit_state(df, ["a", "b"]), fitstate.fit_state(df, ["a", "b"])])
    assert fitstate.medians_of(state) == {"b": 1.0}
    assert fitstate.bounds_of(state)["a"] is None and fitstate.scaling_of(state) == {"b": (1.0, 1.0)}


# ---- scored suggestions ----------------------------------------------------------------------

def test_suggestions_are_the_smallest_moves_that_reach(spark, result):
    fitted = result.models["boosted"]
    rows = result.features.orderBy("app_id").limit(40)
    found = recourse.scored_moves(rows, fitted, result.features, steps=11).collect()
    assert len(found) == 40
    names = fitted.features
    x = {r.app_id: np.array(r.x) for r in rows.select(
        "app_id", shap.feature_array(names).alias("x")).collect()}
    cuts = recourse.exact_quantiles(result.features, names, [k / 10 for k in range(11)])
    score = scorer_of(fitted, spark)()
    for r in found:
        own = x[r.app_id]
        p = score(own[:, None])[0]
        assert abs(p - r.probability) < 1e-12
        reach = (lambda q: q <= r.target) if p > 0.5 else (lambda q: q >= r.target)
        for m in r.suggestions:
            moved = own.copy()
            moved[names.index(m.feature)] = m.suggested_value
            assert abs(score(moved[:, None])[0] - m.probability) < 1e-12
            assert m.reaches == reach(m.probability)
        possible = set()
        for j, n in enumerate(names):
            for v in cuts[n]:
                moved = own.copy()
                moved[j] = v
                if reach(score(moved[:, None])[0]):
                    possible.add(n)
                    between = sum(min(own[j], v) < w < max(own[j], v) for w in cuts[n])
                    mine = [m for m in r.suggestions if m.feature == n]
                    if mine:  # no candidate that reaches lies nearer
                        nearer = sum(min(own[j], mine[0].suggested_value) < w
                                     < max(own[j], mine[0].suggested_value) for w in cuts[n])
                        assert nearer <= between
        assert len(r.suggestions) == (min(3, len(possible)) or 1)
        assert all(m.reaches for m in r.suggestions) == bool(possible)


def test_fixed_features_do_not_move(spark, result):
    fitted = result.models["linear"]
    found = recourse.scored_moves(result.features.limit(30), fitted, result.features,
                                  movable=["foir"]).collect()
    assert {m.feature for r in found for m in r.suggestions if m.reaches} <= {"foir"}
    none = recourse.scored_moves(result.features.limit(0), fitted, result.features)
    assert none.count() == 0


@pytest.mark.parametrize("kind", ["boosted", "deep"])
def test_moves_of_many_rows_are_scored_at_once(spark, result, kind):
    """Every candidate's score is that of the moved row, bit for bit, from one call a block."""
    rows = result.features.where("split = 'train'").limit(150)
    fitted = result.models["boosted"] if kind == "boosted" else train.train(
        rows, result.prep.features, "histogram", {"n_estimators": 4, "max_depth": 7,
                                                  "min_child_weight": 0.1})
    names = fitted.features
    x = np.array([r.x for r in rows.select(shap.feature_array(names).alias("x")).collect()])
    grid = np.quantile(x, np.linspace(0, 1, 9), axis=0, method="lower").T
    movable = np.arange(len(names)) % 4 != 1
    score = scorer_of(fitted, spark)()
    assert kind == "boosted" or any(t is None for t in score.ensemble.tables)
    found = score.moved(x.T, grid, movable)
    for j in range(len(names)):
        for b in range(9):
            moved = x.T.copy()
            if movable[j]:
                moved[j] = grid[j, b]
            assert (found[j, b] == score(moved)).all()
    calls = []

    class Counted:
        moved = score.moved

        def __call__(self, columns):
            calls.append(columns.shape[1])
            return score(columns)

    made = recourse.moves_of(x, grid, movable, Counted(), 0.1, 3, names)
    assert calls == [len(x)] and made.num_rows == len(x)
    plain = recourse.moves_of(x, grid, movable, lambda columns: score(columns), 0.1, 3, names)
    assert made.equals(plain)
