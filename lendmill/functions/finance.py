"""Affordability features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def monthly_income(annual_inc) -> Column:
    return F.col(annual_inc) / 12 if isinstance(annual_inc, str) else annual_inc / 12


def instalment(amount: Column, rate_pct: Column, months: Column) -> Column:
    """Equal monthly instalment of an amortising loan; an interest-free loan pays amount/months."""
    r = rate_pct / 100 / 12
    growth = F.pow(1 + r, months)
    return F.when(r == 0, F.try_divide(amount, months)).otherwise(
        F.try_divide(amount * r * growth, growth - 1))


def obligation_ratio(existing: Column, new: Column, income: Column) -> Column:
    """Fixed obligations as a percentage of monthly income (FOIR)."""
    return F.try_divide(existing + new, income) * 100


def percent_of(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def loan_to_income(amount: Column, income: Column, offset: float = 0.0) -> Column:
    """``offset=1`` is the variant the fitted preprocessing uses."""
    return F.try_divide(amount, income + offset) if offset else F.try_divide(amount, income)


def raised_score(score: Column) -> Column:
    return (score + 50).cast("int")


def utilisation_share(util_pct: Column) -> Column:
    return util_pct / 100


def score_midpoint(low: Column, high: Column) -> Column:
    return (low + high) / 2


def positive_flag(x: Column) -> Column:
    return (x > 0).cast("int")


def revolving_balance(annual_inc: Column, util_pct: Column) -> Column:
    return annual_inc * 0.3 * util_pct / 100


def confidence(p: Column) -> Column:
    """Distance from the 0.5 decision boundary, scaled to 0..1."""
    return F.abs(p - 0.5) * 2


def derive(df: DataFrame) -> DataFrame:
    """Add the six affordability columns a request does not carry. Narrow, no shuffle."""
    c = F.col
    step = df.withColumns({
        "monthly_income": monthly_income(c("annual_inc")),
        "installment": instalment(c("loan_amnt"), c("int_rate"), c("term")),
    })
    return step.withColumns({
        "foir": obligation_ratio(c("existing_emi"), c("installment"), c("monthly_income")),
        "loan_income_ratio": loan_to_income(c("loan_amnt"), c("annual_inc")),
        "emi_income_ratio": percent_of(c("installment"), c("monthly_income")),
        "cibil_score_high": raised_score(c("cibil_score")),
    })


def engineer(df: DataFrame) -> DataFrame:
    """Schema-conditional derived features; each one appears only if its inputs exist."""
    have = set(df.columns)
    c = F.col
    new: dict[str, Column] = {}
    amounts = {"loan_amnt", "annual_inc"} <= have
    if amounts and "dti" not in have:
        new["dti"] = percent_of(c("loan_amnt"), c("annual_inc"))
    if {"revol_util", "revol_bal"} <= have:
        new["credit_utilization_ratio"] = utilisation_share(c("revol_util"))
    if amounts:
        new["loan_income_ratio"] = loan_to_income(c("loan_amnt"), c("annual_inc"), 1.0)
    if {"fico_range_low", "fico_range_high"} <= have:
        new["fico_avg"] = score_midpoint(c("fico_range_low"), c("fico_range_high"))
    if "delinq_2yrs" in have:
        new["has_delinquency"] = positive_flag(c("delinq_2yrs"))
    if "pub_rec" in have:
        new["has_public_record"] = positive_flag(c("pub_rec"))
    return df.withColumns(new) if new else df
