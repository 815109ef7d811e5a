"""Scorecard, regulatory floors, categories, decisions, prices and profit as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.config import POLICY, RiskPolicy

# Fixed values: (column, operator, bound, minimum probability). Within one column the
# strictest matching row wins because floors only ever raise the probability.
REGULATORY_FLOORS = [
    ("dpd_last_12m", ">", 90, 0.93),
    ("dpd_last_12m", ">", 60, 0.85),
    ("dpd_last_12m", ">", 30, 0.72),
    ("cibil_score", "<", 350, 0.93),
    ("cibil_score", "<", 450, 0.88),
    ("cheque_bounces", ">=", 5, 0.90),
    ("cheque_bounces", ">=", 3, 0.80),
    ("foir", ">", 100, 0.95),
    ("foir", ">", 80, 0.85),
]

# The scorecard's own floors; they differ from the regulatory ones.
SCORECARD_FLOORS = [
    ("foir", ">", 65, 0.73),
    ("foir", ">", 100, 0.95),
    ("cibil_score", "<", 600, 0.78),
    ("cibil_score", "<", 450, 0.88),
    ("cibil_score", "<", 350, 0.93),
    ("dpd_last_12m", ">", 30, 0.72),
    ("dpd_last_12m", ">", 60, 0.85),
    ("dpd_last_12m", ">", 90, 0.93),
    ("cheque_bounces", ">=", 3, 0.80),
    ("cheque_bounces", ">=", 5, 0.90),
]

SCORECARD_INPUTS = ["cibil_score", "foir", "dpd_last_12m", "annual_inc", "term", "cheque_bounces",
                    "num_unsecured_loans", "inq_last_6mths", "revol_util", "employment_type"]


def _holds(column: str, op: str, bound: float) -> Column:
    c = F.col(column)
    return {">": c > bound, ">=": c >= bound, "<": c < bound}[op]


def _floor(rules) -> Column:
    """Highest floor whose condition holds, null when none does."""
    return F.greatest(*[F.when(_holds(c, op, b), F.lit(v)) for c, op, b, v in rules])


def scorecard_pd() -> Column:
    """Rule-based probability of default over the affordability columns."""
    c = F.col

    def flag(condition: Column) -> Column:
        return F.when(condition, 1.0).otherwise(0.0)

    score_gap = (900 - c("cibil_score")) / 600
    burden = c("foir") / 65 * F.when(c("foir") > 100, 2.0).otherwise(1.0)
    lateness = c("dpd_last_12m") / 30 * (
        F.when(c("dpd_last_12m") > 90, 3.0).when(c("dpd_last_12m") > 60, 1.5).otherwise(1.0))
    low_income = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (5000000 - c("annual_inc")) / 4800000))
    term_effect = (F.when(c("term") <= 24, 0.08).when(c("term") == 36, 0.0).otherwise(-0.05))

    additive = (
        F.lit(-0.50) + score_gap * 0.55 + burden * 0.50 + lateness * 0.45 + low_income * 0.12
        + term_effect
        + flag(c("cheque_bounces") > 0) * 0.22
        + flag(c("cheque_bounces") >= 3) * 0.30
        + flag(c("num_unsecured_loans") >= 3) * 0.20
        + flag(c("inq_last_6mths") >= 3) * 0.15
        + flag(c("revol_util") > 70) * 0.20
        + flag(c("employment_type") == "Self-employed") * 0.10
    )
    joint = (
        flag((score_gap > 0.5) & (c("foir") > 60)) * 0.40
        + flag((c("dpd_last_12m") > 0) & (score_gap > 0.4)) * 0.30
        + flag((c("cheque_bounces") > 1) & (score_gap > 0.3)) * 0.25
    )
    stable = (flag(c("employment_type") == "Govt") * 0.15
              + flag(c("employment_type") == "MNC") * 0.08)
    raw = F.greatest(additive + joint - stable, _floor(SCORECARD_FLOORS))
    # greatest/least skip nulls, so an incomplete application is kept at null explicitly
    complete = F.lit(True)
    for name in SCORECARD_INPUTS:
        complete = complete & c(name).isNotNull()
    return F.when(complete, F.least(F.lit(0.98), F.greatest(F.lit(0.02), raw)))


def apply_floors(p: Column) -> Column:
    """Raise ``p`` to the regulatory minimum; never lowers it, null stays null."""
    return F.when(p.isNotNull(), F.greatest(p, _floor(REGULATORY_FLOORS)))


def floor_applied(p: Column) -> Column:
    return F.coalesce(_floor(REGULATORY_FLOORS) > p, F.lit(False))


def fired_floors(p: Column) -> Column:
    """Names of the rules whose floor exceeds ``p``."""
    return F.array_remove(F.array(*[
        F.when(_holds(c, op, b) & (F.lit(v) > p), F.lit(f"{c}{op}{b}")).otherwise("")
        for c, op, b, v in REGULATORY_FLOORS]), "")


def risk_category(p: Column, policy: RiskPolicy = POLICY) -> Column:
    return (F.when(p < policy.low_risk, "LOW")
             .when(p < policy.high_risk, "MODERATE")
             .when(p.isNotNull(), "HIGH"))


def decision(category: Column) -> Column:
    return (F.when(category == "LOW", "APPROVED")
             .when(category == "MODERATE", "REVIEW")
             .when(category.isNotNull(), "REJECTED"))


def interest_rate(p: Column, category: Column | None = None,
                  policy: RiskPolicy = POLICY) -> Column:
    """Base rate plus the category's adjustment; it grows linearly inside MODERATE."""
    category = risk_category(p, policy) if category is None else category
    share = (p - policy.low_risk) / (policy.high_risk - policy.low_risk)
    return policy.base_rate + (
        F.when(category == "LOW", F.lit(policy.low_adjustment))
         .when(category == "MODERATE", share * policy.moderate_adjustment)
         .when(category.isNotNull(), F.lit(policy.high_adjustment)))


def expected_profit(p: Column, amount: Column, rate: Column | None = None,
                    years=3, policy: RiskPolicy = POLICY) -> Column:
    """Interest over ``years`` minus the expected loss of principal."""
    rate = interest_rate(p, policy=policy) if rate is None else rate
    return amount * rate * years - p * amount


def round_half_up(x: Column, digits: int) -> Column:
    """Half-up rounding, once, of the number as it prints; NaN and infinities stay."""
    return F.round(x.cast("double"), digits)


def assess(df: DataFrame, p: str = "p_final", amount: str | None = "loan_amnt",
           with_confidence: bool = True, years=3, policy: RiskPolicy = POLICY,
           rounded: bool = True) -> DataFrame:
    """Append the seven assessment columns to ``df``: one projection for any number of rows."""
    prob = F.col(p)
    df = df.withColumn("risk_category", risk_category(prob, policy))
    df = df.withColumns({
        "decision": decision(F.col("risk_category")),
        "_rate": interest_rate(prob, F.col("risk_category"), policy),
    })
    profit = (expected_profit(prob, F.col(amount), F.col("_rate"), years, policy)
              if amount else F.lit(None).cast("double"))
    sure = F.abs(prob - 0.5) * 2 if with_confidence else F.lit(None).cast("double")
    keep = round_half_up if rounded else (lambda x, digits: x)
    return df.withColumns({
        "default_probability": keep(prob, 4),
        "interest_rate": keep(F.col("_rate"), 4),
        "interest_rate_pct": keep(F.col("_rate") * 100, 2),
        "expected_profit": keep(profit, 2),
        "confidence_score": keep(sure, 4),
    }).drop("_rate")
