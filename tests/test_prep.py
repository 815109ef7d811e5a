"""Quantiles, single fitted steps and the preprocessing model."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendmill.config import PrepSpec
from lendmill.operators import gram, prep, quantiles
from lendmill.operators.quantiles import exact_quantiles
from lendmill.session import scratch
from registry import variants
from registry.mapping import applications

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.floats(-1e9, 1e9), st.sampled_from([0.0, 1.0, 1.0 + 1e-15])),
                min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    got = exact_quantiles(column(spark, values), ["x"], PROBABILITIES, bins=4)["x"]
    assert np.allclose(got, np.quantile(values, PROBABILITIES), rtol=1e-9, atol=1e-9)


def test_quantiles_with_infinities(spark):
    inf = float("inf")
    values = [-inf, -inf, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, inf]
    got = exact_quantiles(column(spark, values), ["x"], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0])["x"]
    assert got == [-inf, -inf, 1.25, 3.5, 5.75, inf]
    assert exact_quantiles(column(spark, [inf, 1.0]), ["x"], [0.5])["x"] == [inf]
    assert exact_quantiles(column(spark, [inf, inf]), ["x"], [0.5])["x"] == [inf]


def test_quantiles_of_skewed_columns(spark):
    values = [7.0] * 500 + [1e300, -1e300, 7.0000001] + np.linspace(6.9, 7.1, 200).tolist()
    df = column(spark, [*values, None, float("nan")]).repartition(7)
    got = exact_quantiles(df, ["x"], PROBABILITIES)["x"]
    assert np.allclose(got, np.quantile(values, PROBABILITIES))


def test_quantiles_of_an_empty_column(spark):
    assert exact_quantiles(column(spark, [None, float("nan")]), ["x"], [0.5]) == {"x": [None]}


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string")
    assert prep.modes(df, ["v"]) == {"v": "a"}


def test_clip_keeps_nulls_and_single_rows(spark):
    df = column(spark, [5.0])
    assert prep.clip_bounds(df, ["x"]) == {"x": None}
    assert prep.clip(df, {"x": None}).first().x == 5.0
    out = prep.clip(column(spark, [None, 100.0, -100.0]), {"x": (-1.0, 1.0)}).collect()
    assert [r.x for r in out] == [None, 1.0, -1.0]


def test_zero_deviation_scales_by_one(spark):
    df = column(spark, [3.0, 3.0])
    assert [r.x for r in prep.scale(df, prep.scale_stats(df, ["x"])).collect()] == [0.0, 0.0]


def test_population_deviation(spark):
    df = column(spark, [1.0, 2.0, 3.0, 10.0])
    assert prep.scale_stats(df, ["x"])["x"][1] == pytest.approx(np.std([1, 2, 3, 10]))


def test_join_encoding_equals_literal_encoding(spark, apps):
    small = prep.class_table(apps, ["purpose", "city_tier"], 400)
    large = prep.class_table(apps, ["purpose", "city_tier"], 0)  # forces the distributed path
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    assert prep.class_literals(large, 3) is None
    unseen = apps.withColumn("purpose", F.when(F.col("app_id") % 5 == 0, "yacht")
                             .otherwise(F.col("purpose")))
    names = ["purpose", "city_tier"]
    a = prep.encode(unseen, small, names, prep.class_literals(small, 400))
    b = prep.encode(unseen, large, names, None)
    keys = ["app_id", *names]
    assert sorted(map(tuple, a.select(keys).collect())) == sorted(map(tuple, b.select(keys).collect()))


def test_model_with_joined_classes(spark, apps):
    few = prep.fit_prep(apps, spec=PrepSpec(literal_classes=0))
    many = prep.fit_prep(apps)
    assert few.literals is None and few.features == many.features
    # two separate fits: averages may differ in the last bit with the order tasks finish in
    a = np.array(few.transform(apps).orderBy("app_id").collect(), dtype=float)
    b = np.array(many.transform(apps).orderBy("app_id").collect(), dtype=float)
    assert a.shape == b.shape and np.allclose(a, b, rtol=1e-9, atol=1e-12)


def test_columns_left_after_selection(spark, sf_dir):
    model = prep.fit_prep(applications(spark, "/root/testdata/sf0.01"))
    assert len(model.features) == 23
    assert set(model.dropped_correlated) == {"monthly_income", "cibil_score_high",
                                             "emi_income_ratio", "dti", "credit_utilization_ratio"}


def test_transform_does_not_depend_on_partitioning(spark, apps):
    model = prep.fit_prep(apps)
    dirty = variants.with_nulls(apps)
    a = model.transform(dirty).orderBy("app_id").collect()
    b = model.transform(dirty.repartition(13)).orderBy("app_id").collect()
    assert a == b


def test_transform_plan_has_no_shuffle(spark, apps):
    plan = prep.fit_prep(apps).transform(apps)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_missing_features_become_zero_and_single_rows_work(spark, apps):
    model = prep.fit_prep(apps)
    one = apps.where("app_id = 3").drop("age")
    row = model.transform(one).first()
    assert row.age == 0 and row.cibil_score is not None
    assert model.transform(one, stats_from="batch").count() == 1


def test_save_and_load(spark, apps):
    model = prep.fit_prep(apps)
    path = scratch(spark, "test-prep")
    model.save(path)
    again = prep.PrepModel.load(spark, path)
    assert again.features == model.features
    a, b = (m.transform(apps).orderBy("app_id").collect() for m in (model, again))
    assert a == b


def test_tiled_correlations_equal_the_matrix(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((500, 40)) + 1e6
    x[:, 7] = x[:, 3] * 2 + 0.01 * x[:, 9]
    x[:, 20], x[3, 21], x[4, 22] = 5.0, np.nan, np.inf
    x[:, 39] = -x[:, 0]
    names = [f"f{i}" for i in range(40)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).withColumn(
        "f23", F.when(F.col("f0") < 1e6, F.col("f23"))).repartition(5)
    x[~(x[:, 0] < 1e6), 23] = np.nan
    with np.errstate(all="ignore"):
        r = np.nan_to_num(np.abs(np.corrcoef(x.T)), nan=0.0)
    want = [r[:j, j].max(initial=0) for j in range(40)]
    monkeypatch.setattr(gram, "CHUNK_BYTES", 8 * 40 * 7)
    monkeypatch.setattr(gram, "FAN", 4)
    for block in (9, 40):
        got = gram.highest_earlier(df, names, block)
        assert np.allclose(list(got.values()), want, atol=1e-9)
    assert got["f39"] > 0.999999 and got["f20"] == got["f21"] == got["f22"] == got["f23"] == 0
    assert set(gram.highest_earlier(df.limit(0), names, 9).values()) == {0.0}


def test_wide_tables_take_tiles(spark, monkeypatch):
    x = np.random.default_rng(5).standard_normal((60, 30))
    x[:, 25] = x[:, 2]
    names = [f"f{i}" for i in range(30)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names))
    whole = prep.highest_earlier_correlation(df, names)
    monkeypatch.setattr(gram, "BLOCK", 10)
    tiled = prep.highest_earlier_correlation(df, names)
    assert np.allclose(list(whole.values()), list(tiled.values()), atol=1e-9)
    assert prep.correlated(df, names) == ["f25"]


def test_quantile_passes_count_whole_columns(spark, monkeypatch):
    """No row per value leaves a task, and few bins a column (a wide table) give the same values."""
    rng = np.random.default_rng(6)
    x = np.stack([rng.normal(size=2_000), rng.integers(0, 9, 2_000) * 1.0,
                  np.exp(rng.normal(size=2_000) * 20)], axis=1)
    x[::17, 0], x[:3, 2] = np.nan, [np.inf, -np.inf, np.inf]
    names = ["a", "b", "c"]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(5)
    kind, seen = type(df), []
    run = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **k: seen.append(self.columns)
                        or run(self, *a, **k))
    for counts in (1 << 20, 64):
        monkeypatch.setattr(quantiles, "COUNTS", counts)
        got = exact_quantiles(df, names, [0.25, 0.5, 0.999])
        for j, n in enumerate(names):
            want = np.nanquantile(x[:, j], [0.25, 0.5, 0.999])
            assert np.allclose(got[n], want, rtol=1e-12)
    assert seen[0] == names and all(set(s) <= set(names) for s in seen) and len(seen) > 4


def test_narrow_tables_are_one_tile(spark, monkeypatch):
    x = np.random.default_rng(7).standard_normal((200, 4))
    x[:, 3] = x[:, 1] - x[:, 0]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")))
    tiles, seen = gram._tiles, []
    monkeypatch.setattr(gram, "_tiles", lambda *a: seen.append(a[1]) or tiles(*a))
    got = prep.highest_earlier_correlation(df, list("abcd"))
    r = np.abs(np.corrcoef(x.T))
    assert seen == [4]
    assert np.allclose(list(got.values()), [r[:j, j].max(initial=0) for j in range(4)], atol=1e-12)
