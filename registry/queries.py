"""One query per operator of the inventory. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.config import LimeSpec
from lendmill.functions import finance, policy
from lendmill.operators import (evaluate, explain, fitstate, lime, portfolio, prep, profile,
                                ranking, recourse, shap, smote, split, train, validate)
from lendmill.operators.stages import Preprocessor
from lendmill.plans import artifacts, explaining, scoring, training
from lendmill.schema import CATEGORICAL, NUMERIC, PREDICTORS, REQUEST
from lendmill.session import materialise, scratch
from lendmill.sources import files, models
from lendmill.streaming import scoring as streaming
from registry import variants
from registry.mapping import applications, requests

c = F.col
LINEAR = list(variants.LINEAR_WEIGHTS)
PREP_FEATURES = [*PREDICTORS, "dti", "credit_utilization_ratio"]


def r6(x):
    """Six decimals, half up, after dropping binary noise below 1e-8 (same rule in the SQL).

    For comparing outputs across engines only; no operator works on values rounded this way.
    """
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x.try_cast("decimal(28,8)"), 6).cast("double")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else c(f.name) for f in df.schema.fields])


def derived(spark, sf) -> DataFrame:
    return finance.derive(requests(spark, sf))


def judged(spark, sf) -> DataFrame:
    """Applications with the scorecard as model."""
    df = applications(spark, sf)
    return df.withColumns({"p_model": policy.scorecard_pd()}).withColumns({
        "p_final": policy.apply_floors(c("p_model")),
        "prediction": (c("p_model") >= 0.5).cast("int")})


def with_linear_shap(spark, sf) -> DataFrame:
    df = judged(spark, sf)
    means = shap.background_means(df, LINEAR)
    return shap.add_linear_shap(df, variants.LINEAR_WEIGHTS, means)


# ---- shared trained models: small trees, fitted once per session and table folder -----------

BOOSTED = {"kind": "boosted", "params": {"n_estimators": 20, "max_depth": 4,
                                        "learning_rate": 0.1}}
# The published configuration of the main learner.
PUBLISHED = {"kind": "boosted", "params": {"n_estimators": 200, "max_depth": 5,
                                          "learning_rate": 0.05}}
_shared: dict = {}


def trained(spark: SparkSession, sf: str) -> training.TrainingResult:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _shared:
        _shared[key] = training.run(applications(spark, sf), {
            "boosted": BOOSTED,
            "forest": {"kind": "forest", "params": {"n_estimators": 20, "max_depth": 5}},
            "linear": {"kind": "linear", "params": {}},
        })
    return _shared[key]


# ---- projections ---------------------------------------------------------------------------

def p1(spark, sf):
    return requests(spark, sf).select("app_id", r6(finance.monthly_income("annual_inc"))
                                      .alias("monthly_income"))


def p2(spark, sf):
    return requests(spark, sf).select("app_id", r6(finance.instalment(
        c("loan_amnt"), c("int_rate"), c("term"))).alias("installment"))


def p3(spark, sf):
    return derived(spark, sf).select("app_id", r6("foir").alias("foir"))


def p4(spark, sf):
    return derived(spark, sf).select("app_id", r6("emi_income_ratio").alias("emi_income_ratio"))


def p5(spark, sf):
    return requests(spark, sf).select(
        "app_id", r6(finance.loan_to_income(c("loan_amnt"), c("annual_inc"))).alias("plain"),
        r6(finance.loan_to_income(c("loan_amnt"), c("annual_inc"), 1.0)).alias("offset_by_one"))


def p6(spark, sf):
    return requests(spark, sf).select(
        "app_id", finance.raised_score(c("cibil_score")).alias("cibil_score_high"))


def _engineered(spark, sf):
    return finance.engineer(variants.with_optional(requests(spark, sf)))


def p7(spark, sf):
    return _engineered(spark, sf).select("app_id", r6("dti").alias("dti"))


def p8(spark, sf):
    return _engineered(spark, sf).select(
        "app_id", r6("credit_utilization_ratio").alias("credit_utilization_ratio"))


def p9(spark, sf):
    return _engineered(spark, sf).select("app_id", r6("fico_avg").alias("fico_avg"))


def p10(spark, sf):
    return _engineered(spark, sf).select("app_id", "has_delinquency", "has_public_record")


def p11(spark, sf):
    return requests(spark, sf).select("app_id", r6(finance.revolving_balance(
        c("annual_inc"), c("revol_util"))).alias("revol_bal"))


def p12(spark, sf):
    return judged(spark, sf).select("app_id", r6(finance.confidence(c("p_final")))
                                    .alias("confidence"))


def p13(spark, sf):
    wanted = ["cibil_score", "pub_rec", "loan_amnt", "age"]  # pub_rec is not in the table
    return rounded(prep.align(applications(spark, sf), wanted, ["app_id"]))


def p14(spark, sf):
    return rounded(applications(spark, sf).drop("default"))


# ---- validation and selection ----------------------------------------------------------------

def f1(spark, sf):
    rows = variants.with_invalid(variants.with_nulls(requests(spark, sf)))
    return validate.validate_applications(rows).select(
        "app_id", "is_valid", F.concat_ws(";", "reasons").alias("reasons"))


def f2(spark, sf):
    df = requests(spark, sf).select(*[n for n in REQUEST.names if n in NUMERIC],
                                    F.lit(1).alias("always_one"),
                                    F.when(c("app_id") % 1000 == 0, 1).otherwise(0).alias("rare"))
    dropped = prep.low_variance(df, df.columns)
    values = prep.variances(df, df.columns)
    return spark.createDataFrame([(k, float(v), k in dropped) for k, v in values.items()],
                                 "feature string, variance double, dropped boolean").select(
        "feature", r6(F.log1p("variance")).alias("log_variance"), "dropped")


def _fitted_on_all(spark, sf):
    return prep.fit_prep(applications(spark, sf))


def f3(spark, sf):
    df = applications(spark, sf)
    model = prep.fit_prep(df)
    work = prep.clip(finance.engineer(prep.impute(df, model.fill)), model.bounds)
    work = prep.encode(work, model.classes, model.categorical, model.literals)
    found = prep.highest_earlier_correlation(work, PREP_FEATURES)
    return spark.createDataFrame(
        [(k, float(v), k in model.dropped_correlated) for k, v in found.items()],
        "feature string, correlation double, dropped boolean").select(
        "feature", r6("correlation").alias("correlation"), "dropped")


def f5(spark, sf):
    df = requests(spark, sf)
    return explain.counts_beyond(df, df, "revol_util").select(
        "app_id", "n_below", "n_above")


def j1(spark, sf):
    df = judged(spark, sf)
    pairs = scoring.pair_scores(df.select("app_id", "loan_amnt"), df.select("app_id", "p_final"))
    return pairs.select("app_id", r6("loan_amnt").alias("loan_amnt"), r6("p_final").alias("p"))


# ---- sources and sinks -------------------------------------------------------------------------

def s1(spark, sf):
    path = scratch(spark, "s1")
    files.write_table(applications(spark, sf), path, "csv")
    return rounded(files.read_table(spark, path, "csv"))


def s2(spark, sf):
    path = scratch(spark, "s2")
    files.write_table(applications(spark, sf), path, "parquet", ["city_tier"])
    df = files.read_table(spark, path, "parquet")
    return rounded(df.select("app_id", *PREDICTORS, "default"))


def s3(spark, sf):
    path = scratch(spark, "s3")
    files.write_comparison(k1_full(spark, sf), path)
    return rounded(files.read_comparison(spark, path))


def s4(spark, sf):
    path = scratch(spark, "s4")
    files.write_table(requests(spark, sf), path, "json")
    return rounded(files.read_requests(spark, path).select(REQUEST.names))


ASSESSED = ["app_id", "default_probability", "risk_category", "decision", "interest_rate",
            "interest_rate_pct", "expected_profit", "confidence_score"]


def s5(spark, sf):
    path = scratch(spark, "s5")
    assessed = policy.assess(judged(spark, sf)).select(ASSESSED)
    files.write_results(assessed, portfolio.portfolio_metrics(assessed), path)
    back = spark.read.schema(assessed.schema).json(f"{path}/predictions")
    return rounded(back)


def s6(spark, sf):
    model = _fitted_on_all(spark, sf)
    path = scratch(spark, "s6")
    model.save(path)
    again = prep.PrepModel.load(spark, path)
    return _wide_features(again, again.transform(_dirty(spark, sf)))


def s7(spark, sf):
    result = trained(spark, sf)
    path = scratch(spark, "s7")
    models.save_classifier(result.models["boosted"], path, spark)
    again = models.load_classifier(spark, path)
    before = train.score(result.models["boosted"], result.features, ["app_id"])
    after = train.score(again, result.features, ["app_id"])
    return (before.select("app_id", c("p_model").alias("p_before"))
            .join(after.select("app_id", c("p_model").alias("p_after")), "app_id")
            .select("app_id", (c("p_before") == c("p_after")).alias("equal")))


def s7_bundle(spark, sf):
    result = trained(spark, sf)
    path = scratch(spark, "bundle")
    artifacts.save_bundle(result, "boosted", path)
    bundle = artifacts.load_bundle(spark, path)
    rows = requests(spark, sf)
    before = scoring.score_applications(rows, result.prep, result.models["boosted"])
    after = scoring.score_applications(rows, bundle.prep, bundle.fitted)
    return (before.select("app_id", c("p_final").alias("p"), c("decision").alias("d"))
            .join(after.select("app_id", "p_final", "decision"), "app_id")
            .select("app_id", ((c("p") == c("p_final")) & (c("d") == c("decision")))
                    .alias("equal")))


def s8(spark, sf):
    path = scratch(spark, "s8")
    df = with_linear_shap(spark, sf).select("app_id", "base_value", "shap", *LINEAR)
    models.save_explanations(df, LINEAR, path)
    models.save_background(applications(spark, sf), f"{path}/background", 1000)
    table, names = models.load_explanations(spark, path)
    background = spark.read.parquet(f"{path}/background").select("app_id", F.lit(True).alias("b"))
    return (shap.shap_long(table, names).join(background, "app_id", "left")
            .select("app_id", "feature", r6("shap_value").alias("shap_value"),
                    F.coalesce("b", F.lit(False)).alias("in_background")))


# ---- fitted transforms ---------------------------------------------------------------------------

def _dirty(spark, sf):
    return variants.with_unseen(variants.with_nulls(applications(spark, sf)))


def _wide_features(model: prep.PrepModel, df: DataFrame) -> DataFrame:
    """All candidate features; the ones selection dropped are null."""
    have = set(model.features)
    return df.select("app_id", *[
        (r6(c(f).cast("double")) if f in have else F.lit(None).cast("double")).alias(f)
        for f in PREP_FEATURES])


def t1(spark, sf):
    df = variants.with_nulls(requests(spark, sf))
    columns = [n for n in REQUEST.names if n in NUMERIC]
    return spark.createDataFrame(list(prep.medians(df, columns).items()),
                                 "feature string, median double").select(
        "feature", r6("median").alias("median"))


def t2(spark, sf):
    return prep.modes_table(variants.with_nulls(requests(spark, sf)), CATEGORICAL)


def t3(spark, sf):
    df = requests(spark, sf)
    columns = [n for n in REQUEST.names if n in NUMERIC]
    return rounded(prep.clip(df, prep.clip_bounds(df, columns)).select("app_id", *columns))


def t4(spark, sf):
    df = requests(spark, sf)
    classes = prep.class_table(df, CATEGORICAL, 400)
    literals = prep.class_literals(classes, 400)
    coded = prep.encode(variants.with_unseen(df), classes, CATEGORICAL, literals)
    return coded.select("app_id", *CATEGORICAL)


def t5(spark, sf):
    df = requests(spark, sf)
    columns = [n for n in REQUEST.names if n in NUMERIC]
    return rounded(prep.scale(df, prep.scale_stats(df, columns)).select("app_id", *columns))


def t6(spark, sf):
    model, out = prep.fit_transform(applications(spark, sf))
    return _wide_features(model, out)


def t3_merged(spark, sf):
    """Clip bounds of the whole table from states of its parts, fitted apart."""
    df = requests(spark, sf)
    columns = [n for n in REQUEST.names if n in NUMERIC]
    parts = [fitstate.fit_state(df.where(F.pmod(c("app_id"), F.lit(4)) == k), columns, CATEGORICAL)
             for k in range(4)]
    bounds = fitstate.bounds_of(fitstate.merge(parts))
    return rounded(spark.createDataFrame([(n, float(b[0]), float(b[1])) for n, b in bounds.items()],
                                         "feature string, low double, high double"))


def t6_stage(spark, sf):
    """The pipeline stage beside the plain preprocessing: the same vectors."""
    df = applications(spark, sf)
    stage = Preprocessor().fit(df)
    vectors = stage.transform(df).select("app_id", vector_to_array("features").alias("v"))
    values = shap.feature_array(stage.features)
    plain = stage.prep.transform(df).select("app_id", values.alias("x"))
    return vectors.join(plain, "app_id").select("app_id", (c("v") == c("x")).alias("same"))


def t7(spark, sf):
    model = _fitted_on_all(spark, sf)
    return _wide_features(model, model.transform(_dirty(spark, sf)))


def t7_batch(spark, sf):
    model = _fitted_on_all(spark, sf)
    return _wide_features(model, model.transform(_dirty(spark, sf), stats_from="batch"))


# ---- aggregations ----------------------------------------------------------------------------------

def a1(spark, sf):
    return portfolio.portfolio_flat(policy.assess(judged(spark, sf)))


def a1_segments(spark, sf):
    return portfolio.portfolio_flat(policy.assess(judged(spark, sf)), ["purpose", "city_tier"])


def a2(spark, sf):
    df = variants.with_nulls(requests(spark, sf))
    return rounded(profile.feature_profile(df))


def a3(spark, sf):
    df = variants.with_nulls(requests(spark, sf))
    return rounded(profile.table_summary(df, ["app_id"]))


def a3_shape(spark, sf):
    return profile.table_shape(requests(spark, sf))


def a3_dtypes(spark, sf):
    return profile.dtype_counts(requests(spark, sf))


def a4(spark, sf):
    return rounded(profile.target_distribution(applications(spark, sf)))


def a4_rates(spark, sf):
    return rounded(profile.base_rates(applications(spark, sf)))


def a5(spark, sf):
    return rounded(evaluate.class_counts(applications(spark, sf)))


def a6(spark, sf):
    return rounded(evaluate.class_weights(applications(spark, sf)))


def a7(spark, sf):
    return evaluate.confusion(judged(spark, sf), by=["purpose"])


def a8(spark, sf):
    return rounded(evaluate.precision_recall_f1(
        evaluate.confusion(judged(spark, sf), by=["purpose"])))


def a9(spark, sf):
    return rounded(evaluate.roc_auc(judged(spark, sf), score="p_model"))


def a10(spark, sf):
    # thresholds that differ by noise only agree after rounding, so the last of them is taken
    curve = evaluate.roc_curve(judged(spark, sf), score="p_model")
    return curve.groupBy(r6("threshold").alias("threshold")).agg(
        F.max("fpr").alias("fpr"), F.max("tpr").alias("tpr")).select(
        c("threshold").alias("threshold"), r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


def a11(spark, sf):
    return evaluate.business_cost(evaluate.confusion(judged(spark, sf), by=["purpose"]))


def a12(spark, sf):
    return evaluate.threshold_sweep(judged(spark, sf), score="p_model").select(
        "position", r6("threshold").alias("threshold"), "fp", "fn", "cost")


def a12_optimal(spark, sf):
    return rounded(evaluate.optimal_threshold(
        evaluate.threshold_sweep(judged(spark, sf), score="p_model")))


def a13(spark, sf):
    return rounded(shap.global_importance(with_linear_shap(spark, sf), LINEAR))


# ---- ranking -----------------------------------------------------------------------------------------

def rival_metrics(spark, sf) -> DataFrame:
    """Three scores as competing models, evaluated on the three splits."""
    df = split.stratified_split(judged(spark, sf))
    scores = F.inline(F.array(
        F.struct(F.lit("scorecard").alias("model"), F.lit(0).alias("position"),
                 c("p_model").alias("score")),
        F.struct(F.lit("floored").alias("model"), F.lit(1).alias("position"),
                 c("p_final").alias("score")),
        F.struct(F.lit("bureau").alias("model"), F.lit(2).alias("position"),
                 ((900 - c("cibil_score")) / 600).alias("score"))))
    return evaluate.evaluate(df.select("default", "split", scores),
                             by=["model", "position", "split"])


def k1_full(spark, sf):
    return ranking.compare_models(rival_metrics(spark, sf))


def k1(spark, sf):
    return rounded(k1_full(spark, sf))


def k2(spark, sf):
    return rounded(ranking.best_model(rival_metrics(spark, sf), "f1"))


def k3(spark, sf):
    fitted = trained(spark, sf).models["boosted"]
    every = train.feature_importance(fitted, spark)
    top = ranking.top_n(every, "importance", 5)
    least = top.agg(F.min("importance").alias("least"))
    rest = every.join(top, "feature", "left_anti").crossJoin(least)
    return top.agg(F.count("*").alias("listed"),
                   F.bool_and(c("importance") > 0).alias("positive")).crossJoin(
        rest.agg(F.bool_and(c("importance") <= c("least")).alias("others_are_less")))


def k4(spark, sf):
    return rounded(explain.top_features(with_linear_shap(spark, sf), LINEAR, 5)
                   .select("app_id", "rank", "feature", "value", "shap_value"))


def k5(spark, sf):
    return split.seeded_sample(requests(spark, sf), 1000).select("app_id")


def k5_large(spark, sf):
    return split.seeded_sample(requests(spark, sf), 12_000).select("app_id")


def k5_first(spark, sf):
    return split.first_rows(requests(spark, sf), 1000).select("app_id", "cibil_score")


def u1(spark, sf):
    df = applications(spark, sf).select("app_id", "loan_amnt", "default")
    made = df.where("default = 0").select("default", (c("loan_amnt") * 1.1).alias("loan_amnt"),
                                          (c("app_id") + 1_000_000_000).alias("app_id"))
    return rounded(smote.append_synthetic(df, made))


# ---- policy ---------------------------------------------------------------------------------------------

def r1(spark, sf):
    return derived(spark, sf).select("app_id", r6(policy.scorecard_pd()).alias("p"))


def r2(spark, sf):
    return judged(spark, sf).select("app_id", r6("p_model").alias("p_model"),
                                    r6(policy.apply_floors(c("p_model") * 0.5)).alias("p_floored"))


def r3(spark, sf):
    halved = c("p_model") * 0.5
    return judged(spark, sf).select(
        "app_id", policy.floor_applied(halved).alias("floor_applied"),
        F.concat_ws(";", policy.fired_floors(halved)).alias("fired_rules"))


def r4(spark, sf):
    return judged(spark, sf).select("app_id", policy.risk_category(c("p_final"))
                                    .alias("risk_category"))


def r5(spark, sf):
    return judged(spark, sf).select("app_id", policy.decision(policy.risk_category(c("p_final")))
                                    .alias("decision"))


def r6_rate(spark, sf):
    return judged(spark, sf).select("app_id", r6(policy.interest_rate(c("p_final")))
                                    .alias("interest_rate"))


def r7(spark, sf):
    p, amount = c("p_final"), c("loan_amnt")
    return judged(spark, sf).select(
        "app_id", r6(policy.expected_profit(p, amount)).alias("profit_three_years"),
        r6(policy.expected_profit(p, amount, years=c("term") / 12)).alias("profit_over_term"))


def r8(spark, sf):
    return policy.assess(judged(spark, sf)).select(ASSESSED)


def r9(spark, sf):
    # scores without amounts or confidence: the optional outputs are null
    return policy.assess(judged(spark, sf), amount=None, with_confidence=False).select(ASSESSED)


def r10(spark, sf):
    assessed = scoring.score_with_scorecard(variants.with_invalid(requests(spark, sf)))
    return assessed.select("app_id", r6("p_model").alias("p_model"),
                           r6("p_final").alias("p_final"), "floor_applied", *ASSESSED[1:])


def r10_model(spark, sf):
    result = trained(spark, sf)
    assessed = scoring.score_applications(variants.with_invalid(requests(spark, sf)),
                                          result.prep, result.models["boosted"])
    priced = policy.interest_rate(c("p_final"))
    return assessed.select(
        "app_id", (c("p_model").between(0, 1) & (c("p_final") >= c("p_model"))
                   & (c("floor_applied") == (c("p_final") > c("p_model")))).alias("floored"),
        (c("risk_category") == policy.risk_category(c("p_final"))).alias("categorised"),
        ((F.abs(c("interest_rate") - priced) <= 0.5001e-4)
         & (F.abs(c("expected_profit") - c("loan_amnt") * (3 * priced - c("p_final"))) <= 0.006)
         ).alias("priced"))


# ---- sampling, training, evaluation -----------------------------------------------------------------------

def m1(spark, sf):
    return split.stratified_split(applications(spark, sf)).select("app_id", "default", "split")


def m1_folds(spark, sf):
    return split.stratified_folds(applications(spark, sf), 5).select("app_id", "fold")


def _checked(metrics: DataFrame) -> DataFrame:
    """Rows per split and the bounds that a useful model keeps; the SQL counts the rows."""
    return metrics.select(
        "split", (c("tn") + c("fp")).alias("negatives"), (c("fn") + c("tp")).alias("positives"),
        (c("roc_auc") >= 0.75).alias("useful"),
        (F.abs(c("precision") * (c("tp") + c("fp")) - c("tp")) < 1e-6).alias("precise"),
        (F.abs(c("recall") * (c("tp") + c("fn")) - c("tp")) < 1e-6).alias("recalled"))


def _searched(spark, sf, plan: dict) -> DataFrame:
    """Search, refit and evaluation of one comparison model."""
    return _checked(training.run(applications(spark, sf), {"model": plan}).metrics)


def train_boosted(spark, sf) -> training.TrainingResult:
    """The main learner as published, from raw applications to metrics."""
    return training.run(applications(spark, sf), {"boosted": PUBLISHED})


def m2(spark, sf):
    return _checked(train_boosted(spark, sf).metrics)


def m3(spark, sf):
    return _searched(spark, sf, {"kind": "forest", "grid": train.GRID_FOREST})


def m4(spark, sf):
    return _searched(spark, sf, {"kind": "linear", "grid": train.GRID_LINEAR})


def m4_balanced(spark, sf):
    return _searched(spark, sf, {"kind": "boosted", "weighting": "balanced", "params": {
        "iterations": 100, "depth": 4, "learning_rate": 0.1}})


def m5(spark, sf):
    result = trained(spark, sf)
    rows = result.features.where("split = 'train'")
    found = train.grid_search(rows, result.prep.features, {"max_depth": [2, 3],
                                                           "n_estimators": [5]}, folds=3)
    scores = spark.createDataFrame(
        [(int(p["maxDepth"]), int(p["maxIter"]), float(s), p == found.params)
         for p, s in found.cv_scores], "max_depth int, trees int, score double, chosen boolean")
    best = F.max("score").over(Window.partitionBy(F.lit(1)))  # one row per grid point
    return scores.select("max_depth", "trees", c("score").between(0.75, 1).alias("useful"),
                         (~c("chosen") | (c("score") == best)).alias("best_if_chosen"))


def _checked_search(spark, sf, fitted: train.Fitted) -> DataFrame:
    """Checks of a searched model on every split; ``near_scorecard``: its area comes within 0.02
    and two standard errors of that of the scorecard the labels were drawn from, on the same
    rows (the smallest table has splits of 150)."""
    features = trained(spark, sf).features
    scores = train.score(fitted, features, ["app_id", "default", "split"])
    known = judged(spark, sf).select("app_id", c("p_model").alias("drawn_from"))
    both = materialise(scores.join(known, "app_id"), "searched")
    found = evaluate.evaluate(both, "default", "p_model", ["split"])
    ideal = evaluate.roc_auc(both, "default", "drawn_from", ["split"])
    near = found.join(ideal.withColumnRenamed("roc_auc", "ideal"), "split")
    fewer = F.least(c("tn") + c("fp"), c("fn") + c("tp"))
    error = F.sqrt(c("ideal") * (1 - c("ideal")) / fewer)
    return _checked(near).join(near.select(
        "split", (c("roc_auc") >= c("ideal") - 0.02 - 2 * error).alias("near_scorecard")), "split")


def _grid(spark, sf, kind: str, grid: dict) -> train.Fitted:
    """A whole published grid on three folds, with the refit, searched once per session."""
    key = (spark.sparkContext.applicationId, sf, kind, str(grid))
    if key not in _shared:
        result = trained(spark, sf)
        _shared[key] = train.grid_search(result.features.where("split = 'train'"),
                                         result.prep.features, grid, kind, folds=3,
                                         categorical=result.prep.categorical)
    return _shared[key]


def _grid_rows(spark, fitted: train.Fitted) -> DataFrame:
    names = list(fitted.params)
    rows = [(*[float(p[n]) for n in names], float(s), p == fitted.params)
            for p, s in fitted.cv_scores]
    schema = ", ".join(f"{n} double" for n in names) + ", score double, chosen boolean"
    best = F.max("score").over(Window.partitionBy(F.lit(1)))  # one row per grid point
    return spark.createDataFrame(rows, schema).select(
        *names, c("score").between(0.8, 1).alias("useful"),
        (~c("chosen") | (c("score") == best)).alias("best_if_chosen"))


def m2_histogram(spark, sf):
    result = trained(spark, sf)
    fitted = train.train(result.features.where("split = 'train'"), result.prep.features,
                         "histogram", PUBLISHED["params"])
    return _checked_search(spark, sf, fitted)


def m3_leafwise(spark, sf):
    return _checked_search(spark, sf, _grid(spark, sf, "leafwise", train.GRID_LEAFWISE))


def m4_ordered(spark, sf):
    return _checked_search(spark, sf, _grid(spark, sf, "ordered", train.GRID_ORDERED))


def m5_quick(spark, sf):
    return _grid_rows(spark, _grid(spark, sf, "histogram", train.GRID_QUICK))


def m5_quick_model(spark, sf):
    return _checked_search(spark, sf, _grid(spark, sf, "histogram", train.GRID_QUICK))


def m6(spark, sf):
    return rounded(rival_metrics(spark, sf).drop("position"))


def m6_long(spark, sf):
    return rounded(evaluate.metrics_long(rival_metrics(spark, sf)))


def m7(spark, sf):
    parts = [train.feature_importance(fitted, spark).withColumn("model", F.lit(name))
             for name, fitted in trained(spark, sf).models.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("model").agg(
        F.bool_and(c("importance") >= 0).alias("not_negative"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))


def m8(spark, sf):
    result = trained(spark, sf)
    return train.score(result.models["boosted"], result.features).select(
        "app_id", "default", c("p_model").between(0, 1).alias("is_probability"),
        (c("class") == (c("p_model") >= 0.5).cast("int")).alias("class_fits"))


def m9(spark, sf):
    model, table = prep.fit_transform(applications(spark, sf))
    table = materialise(table, "smote-input")
    out, info = smote.smote(table, model.features, ratio=1.0,
                            categorical=[f for f in CATEGORICAL if f in model.features])
    out = materialise(out, "smote-output")
    held = (c("default") == info["minority"]) & ~c("synthetic")
    hull = out.where(held).agg(*[F.struct(F.min(f).alias("low"), F.max(f).alias("high")).alias(f)
                                 for f in model.features])
    inside = F.lit(True)
    for f in model.features:
        low, high = c(f"hull.{f}.low"), c(f"hull.{f}.high")
        inside = inside & c(f).between(low - 1e-9, high + 1e-9)
    return out.crossJoin(hull.select(F.struct("*").alias("hull"))).groupBy(  # one row of bounds
        "default", "synthetic").agg(
        F.count("*").alias("n"), F.bool_and(inside | ~c("synthetic")).alias("in_hull"),
        F.bool_and(c("synthetic") == c("app_id").isNull()).alias("marked"))


# ---- explanations ------------------------------------------------------------------------------------------

def _tree_shap(spark, sf):
    result = trained(spark, sf)
    return explaining.shap_table(applications(spark, sf), result.prep, result.models["boosted"]), \
        result.models["boosted"].features


def x1(spark, sf):
    df, names = _tree_shap(spark, sf)
    return df.select("app_id", (F.size("shap") == len(names)).alias("complete"),
                     (F.abs(_probability(c("base_value"), "shap") - c("p_model")) < 1e-9)
                     .alias("adds_up"))


def _probability(base, shap_column: str):
    """The probability whose margin is the base value plus all contributions."""
    total = F.aggregate(shap_column, base, lambda a, b: a + b)
    return 1 / (1 + F.exp(-total))


def x1_background(spark, sf):
    """Against the 1,000 background rows of a saved bundle."""
    result = trained(spark, sf)
    path = scratch(spark, "bundle")
    artifacts.save_bundle(result, "boosted", path, background_rows=1000)
    bundle = artifacts.load_bundle(spark, path)
    fitted = bundle.fitted
    trees = shap.read_trees(fitted, spark)
    found = shap.add_tree_shap(result.features, fitted, trees,
                               shap.background_of(bundle.background, trees, fitted.features))
    background = train.score(fitted, bundle.background, ["app_id"])
    mean = background.agg(F.avg(F.ln(c("p_model") / (1 - c("p_model"))))).first()[0]
    scored = train.score(fitted, result.features, ["app_id"]).select("app_id", "p_model")
    return found.join(scored, "app_id").select(
        "app_id", (F.abs(c("base_value") - F.lit(mean)) < 1e-9).alias("base_is_mean"),
        (F.abs(_probability(c("base_value"), "shap") - c("p_model")) < 1e-9).alias("adds_up"))


def _interactions(spark, sf):
    result = trained(spark, sf)
    fitted = result.models["boosted"]
    trees = shap.read_trees(fitted, spark)
    df = shap.add_tree_shap(result.features, fitted, trees)
    return shap.add_interactions(df, fitted, trees), fitted.features


def x5_interactions(spark, sf):
    df, names = _interactions(spark, sf)
    n = len(names)
    rows = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.aggregate(
        F.slice("interactions", i * n + 1, n), F.lit(0.0), lambda a, b: a + b))
    off = F.zip_with(rows, "shap", lambda a, b: F.abs(a - b))
    # a plain expression: a lambda that looks up both cells takes 20 times as long
    mirrored = c("interactions") == F.array(*[c("interactions")[j * n + i]
                                              for i in range(n) for j in range(n)])
    return df.select("app_id", (F.array_max(off) < 1e-9).alias("adds_up"),
                     mirrored.alias("symmetric"))


def x5_partners(spark, sf):
    df, names = _interactions(spark, sf)
    found = shap.strongest_partners(df, names)
    return found.select("feature", (c("partner") != c("feature")).alias("other"),
                        (c("mean_abs_interaction") >= 0).alias("measured"))


def x2(spark, sf):
    df = with_linear_shap(spark, sf)
    return df.select("app_id", r6("base_value").alias("base_value"),
                     *[r6(c("shap")[i]).alias(f"shap_{n}") for i, n in enumerate(LINEAR)])


def x3(spark, sf):
    df, _ = _tree_shap(spark, sf)
    # a mean of margins over the weighted training rows lies inside the range of margins
    margin = F.ln(c("p_model") / (1 - c("p_model")))
    return df.agg(F.count("*").alias("rows"),
                  (F.min("base_value") == F.max("base_value")).alias("constant"),
                  (F.max("base_value").between(F.min(margin), F.max(margin))).alias("centred"))


def x4(spark, sf):
    df, names = _tree_shap(spark, sf)
    # a bit per feature counts the different ones, so a row's cells meet before the exchange
    place = F.array_position(F.array(*[F.lit(n) for n in names]), c("feature"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int"))
    cells = shap.shap_long(df, names, ["app_id", "p_model"]).groupBy("app_id").agg(
        F.bit_count(F.bit_or(bit)).alias("features"), F.count("*").alias("cells"),
        F.sum("shap_value").alias("total"), F.first("p_model").alias("p_model"),
        F.first("base_value").alias("base_value"))
    p = 1 / (1 + F.exp(-(c("base_value") + c("total"))))
    return cells.select(
        "app_id", ((c("features") == len(names)) & (c("cells") == len(names))).alias("complete"),
        (F.abs(p - c("p_model")) < 1e-9).alias("adds_up"))


def x5(spark, sf):
    df = with_linear_shap(spark, sf)
    return rounded(shap.dependence(df, LINEAR, "foir", "cibil_score"))


def x6(spark, sf):
    return rounded(shap.shap_summary(with_linear_shap(spark, sf), LINEAR))


def x6_tree(spark, sf):
    df, names = _tree_shap(spark, sf)
    found = shap.shap_summary(materialise(df.select("shap"), "shap"), names)
    ordered = ((c("min_shap") <= c("q25_shap")) & (c("q25_shap") <= c("q50_shap"))
               & (c("q50_shap") <= c("q75_shap")) & (c("q75_shap") <= c("max_shap")))
    return found.agg((F.count("*") == min(20, len(names))).alias("complete"),
                     F.bool_and(ordered).alias("ordered"),
                     F.bool_and(c("mean_abs_shap") >= F.abs("mean_shap")).alias("bounded"))


def x7(spark, sf):
    result = trained(spark, sf)
    fitted = result.models["boosted"]
    train_rows = result.features.where("split = 'train'")
    bins = lime.fit_bins(train_rows, fitted.features)
    found = lime.lime_explain(result.features, fitted, bins, LimeSpec())
    scored = train.score(fitted, result.features).select("app_id", "p_model")
    weights = F.transform("contributions", lambda x: F.abs(x["weight"]))
    return found.join(scored, "app_id").select(
        "app_id", (F.abs(c("prediction") - c("p_model")) < 1e-12).alias("is_prediction"),
        F.size("contributions").alias("rules"),
        (weights == F.reverse(F.array_sort(weights))).alias("ordered"),
        (c("score") <= 1).alias("fits"))


def x8(spark, sf):
    df = with_linear_shap(spark, sf)
    return rounded(explain.counterfactual(df, LINEAR, df).select(
        "app_id", "rank", "feature", "current_value", "suggested_value", "direction"))


def x8_scored(spark, sf):
    """Every suggestion's probability is the model's own for the moved row, and it reaches the
    target where it says so."""
    result = trained(spark, sf)
    fitted = result.models["boosted"]
    moves = materialise(recourse.scored_moves(result.features, fitted, result.features), "moves")
    first = moves.select("app_id", "target", c("suggestions")[0].alias("m"),
                         (c("probability") > 0.5).alias("down"))
    rows = result.features.join(first, "app_id")
    moved = rows.select("app_id", "target", "m", "down", *[
        F.when(c("m.feature") == n, c("m.suggested_value")).otherwise(c(n)).alias(n)
        for n in fitted.features])
    again = train.score(fitted, moved, ["app_id", "target", "m", "down"])
    beyond = F.when(c("down"), c("m.probability") <= c("target")).otherwise(
        c("m.probability") >= c("target"))
    return again.select("app_id", (F.abs(c("p_model") - c("m.probability")) < 1e-12)
                        .alias("is_prediction"), (c("m.reaches") == beyond).alias("told_right"))


def x9(spark, sf):
    result = trained(spark, sf)
    fitted = result.models["boosted"]
    found = explaining.explain_applications(requests(spark, sf), applications(spark, sf),
                                            result.prep, fitted)
    shown = c("top_features")
    sizes = F.transform(shown, lambda x: F.abs(x["shap_value"]))
    moves = c("counterfactual.suggestions")
    right_way = F.forall(moves, lambda m: m["direction"] == F.when(
        F.element_at(F.map_from_entries(F.transform(shown, lambda x: F.struct(
            x["feature"], x["shap_value"]))), m["feature"]) > 0, "decrease").otherwise("increase"))
    return found.select(
        "app_id", (F.size("shap_values") == len(fitted.features)).alias("complete"),
        F.size(shown).alias("shown"), (sizes == F.reverse(F.array_sort(sizes))).alias("ordered"),
        F.size(moves).alias("suggested"), right_way.alias("right_way"),
        (c("prediction.class") == (c("prediction.probability") >= 0.5).cast("int"))
        .alias("class_fits"))


def x9_linear(spark, sf):
    df = with_linear_shap(spark, sf)
    out = explain.full_explanation(df, LINEAR, df)
    moves = c("counterfactual.suggestions")
    return out.select(
        "app_id", r6("prediction.probability").alias("probability"),
        c("prediction.class").alias("class"), c("prediction.risk_category").alias("risk_category"),
        r6("counterfactual.target_probability").alias("target_probability"),
        F.concat_ws(";", F.transform("top_features", lambda x: x["feature"])).alias("top"),
        F.concat_ws(";", F.transform(moves, lambda x: F.concat(x["feature"], F.lit(":"),
                                                               x["direction"]))).alias("moves"),
        r6(moves[0]["suggested_value"]).alias("first_suggestion"))


def x10(spark, sf):
    return explain.top_features(with_linear_shap(spark, sf), LINEAR, 8).select(
        "app_id", "rank", "feature", "direction")


# ---- streams ---------------------------------------------------------------------------------------------------

FILE_ROWS = 100_000   # requests of a file that a stream reads


def _request_files(spark, sf) -> tuple[str, int]:
    """A folder of request files per remainder of the id, and the number of files in each. The
    folders are written in turn, so as many files a micro-batch make four that hold the table."""
    df = requests(spark, sf).select(REQUEST.names)
    # a remainder without rows has fewer files than the others: then one file each
    for files_each in (max(1, df.count() // (4 * FILE_ROWS)), 1):
        path, counts = scratch(spark, "requests"), set()
        for part in range(4):
            folder = f"{path}/part={part}"
            (df.where(c("app_id") % 4 == part).repartition(files_each, "app_id")
             .write.json(folder))
            counts.add(len(spark.read.schema(REQUEST).json(folder).inputFiles()))
        if len(counts) == 1:
            break
    return path, max(counts)


def z2(spark, sf):
    (source, n), out, check = (_request_files(spark, sf), scratch(spark, "z2"),
                               scratch(spark, "z2-check"))
    stream = files.read_request_stream(spark, f"{source}/part=*", files_per_batch=n)
    scorer = lambda rows: scoring.score_with_scorecard(rows)
    streaming.score_stream(stream, scorer, out, check, available_now=True).awaitTermination()
    return rounded(spark.read.parquet(out).select(ASSESSED))


def z2_rejects(spark, sf):
    path, out, rejects, check = (scratch(spark, n) for n in ("z2r", "z2r-out", "z2r-rejects",
                                                             "z2r-check"))
    rows = variants.with_invalid(requests(spark, sf)).select(REQUEST.names)
    broken = requests(spark, sf).where("app_id % 43 = 0").select(
        F.concat(F.lit('{"app_id": '), c("app_id"), F.lit(', "term": ')).alias("value"))
    files.as_json(rows).unionByName(broken.select(c("value").alias("record"))) \
        .write.text(path)
    stream = files.read_request_stream(spark, path, files_per_batch=4, keep_raw=True)
    scorer = lambda rows: scoring.score_with_scorecard(rows)
    streaming.score_stream_with_rejects(stream, scorer, out, rejects, check,
                                        available_now=True).awaitTermination()
    scored = spark.read.parquet(f"{out}/batch=*").select(
        "app_id", F.lit("assessed").alias("outcome"), F.lit("").alias("reasons"))
    refused = spark.read.parquet(f"{rejects}/batch=*")
    raw_id = F.regexp_extract(files.RAW, r"(\d+)", 1).cast("long")
    return scored.unionByName(refused.select(
        F.coalesce(raw_id, "app_id").alias("app_id"),
        F.when(c(files.RAW).isNull(), "rejected").otherwise("unreadable").alias("outcome"),
        F.when(c(files.RAW).isNull(), F.concat_ws(";", "reasons")).otherwise("").alias("reasons")))


def z3(spark, sf):
    (source, n), out, check = (_request_files(spark, sf), scratch(spark, "z3"),
                               scratch(spark, "z3-check"))
    stream = files.read_request_stream(spark, f"{source}/part=*", files_per_batch=n)
    scorer = lambda rows: scoring.score_with_scorecard(rows).withColumn(
        "part", c("app_id") % 4)
    streaming.portfolio_stream(stream, scorer, out, check, available_now=True,
                               by=["part"]).awaitTermination()
    return streaming.read_portfolio(spark, out).drop("batch_id")


QUERIES = {
    "S1_csv_scan": s1, "S2_table_sink": s2, "S3_comparison_sink": s3, "S4_request_records": s4,
    "S5_result_records": s5, "S6_prep_save_load": s6, "S7_model_save_load": s7,
    "S7_bundle_hand_over": s7_bundle, "S8_explanation_sink": s8,
    "P1_monthly_income": p1, "P2_emi": p2, "P3_foir": p3, "P4_emi_income_ratio": p4,
    "P5_loan_income_ratio": p5, "P6_cibil_score_high": p6, "P7_dti": p7,
    "P8_credit_utilization_ratio": p8, "P9_fico_avg": p9, "P10_delinquency_flags": p10,
    "P11_revol_bal": p11, "P12_confidence": p12, "P13_align_features": p13,
    "P14_drop_target": p14,
    "F1_validate_applications": f1, "F2_constant_features": f2, "F3_correlated_features": f3,
    "F5_values_beyond": f5, "J1_pair_scores": j1,
    "T1_median_impute": t1, "T2_mode_impute": t2, "T3_outlier_clip": t3, "T4_label_encode": t4,
    "T5_standard_scale": t5, "T6_fit_transform": t6, "T7_transform": t7,
    "T7_transform_batch_stats": t7_batch, "T3_merged_bounds": t3_merged,
    "T6_pipeline_stage": t6_stage,
    "A1_portfolio_metrics": a1, "A1_portfolio_by_segment": a1_segments, "A2_feature_profile": a2,
    "A3_table_summary": a3, "A3_table_shape": a3_shape, "A3_dtype_counts": a3_dtypes, "A4_target_distribution": a4, "A4_base_rates": a4_rates,
    "A5_class_counts": a5, "A6_class_weights": a6, "A7_confusion_matrix": a7,
    "A8_precision_recall_f1": a8, "A9_roc_auc": a9, "A10_roc_curve": a10,
    "A11_business_cost": a11, "A12_threshold_sweep": a12, "A12_optimal_threshold": a12_optimal,
    "A13_mean_abs_shap": a13,
    "K1_compare_models": k1, "K2_best_model": k2, "K3_top_importance": k3,
    "K4_top_contributions": k4, "K5_seeded_sample": k5, "K5_large_sample": k5_large,
    "K5_first_rows": k5_first, "U1_append_rows": u1,
    "R1_scorecard_pd": r1, "R2_hard_rules": r2, "R3_rule_hits": r3, "R4_risk_category": r4,
    "R5_decision": r5, "R6_interest_rate": r6_rate, "R7_expected_profit": r7, "R8_assess": r8,
    "R9_batch_assess": r9, "R10_score_applications": r10, "R10_score_with_model": r10_model,
    "M1_stratified_split": m1, "M1_stratified_folds": m1_folds, "M2_train_boosted": m2,
    "M3_train_forest": m3, "M4_train_linear": m4,
    "M4_train_balanced_boosted": m4_balanced, "M5_grid_search": m5,
    "M2_histogram_boosted": m2_histogram, "M3_leafwise_grid": m3_leafwise,
    "M4_ordered_grid": m4_ordered, "M5_quick_grid": m5_quick,
    "M5_quick_grid_model": m5_quick_model, "M6_evaluate": m6,
    "M6_metrics_long": m6_long, "M7_feature_importance": m7, "M8_probability_class": m8,
    "M9_smote": m9,
    "X1_tree_shap": x1, "X2_linear_shap": x2, "X3_base_value": x3, "X4_force_table": x4,
    "X1_background_shap": x1_background, "X5_interactions": x5_interactions,
    "X5_strongest_partners": x5_partners, "X5_dependence": x5, "X6_shap_summary": x6, "X6_tree_shap_summary": x6_tree, "X7_lime": x7,
    "X8_counterfactual": x8, "X8_scored_moves": x8_scored, "X9_full_explanation": x9, "X9_linear_explanation": x9_linear,
    "X10_direction_label": x10,
    "Z2_score_stream": z2, "Z2_stream_rejects": z2_rejects, "Z3_batch_portfolio": z3,
}
