"""Portfolio metrics: one global (or per-segment) aggregate over assessed applications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.functions.policy import round_half_up


def _exact_sum(c: str):
    # rounded money sums exactly in decimal, so the total does not depend on task order
    return F.sum(F.col(c).cast("decimal(18,2)"))


def portfolio_flat(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Counts, rates and profit as flat columns; ``by`` adds segments."""
    d, r = F.col("decision"), F.col("risk_category")
    counted = df.groupBy(*by).agg(
        F.count("*").alias("total_applicants"),
        F.count_if(d == "APPROVED").alias("approved"),
        F.count_if(d == "REVIEW").alias("review"),
        F.count_if(d == "REJECTED").alias("rejected"),
        F.count_if(r == "LOW").alias("low"),
        F.count_if(r == "MODERATE").alias("moderate"),
        F.count_if(r == "HIGH").alias("high"),
        F.avg("default_probability").alias("_p"),
        F.avg("interest_rate").alias("_rate"),
        _exact_sum("expected_profit").alias("_profit"),
        F.count("expected_profit").alias("_priced"),
    )
    return counted.select(
        *by, "total_applicants", "approved", "review", "rejected", "low", "moderate", "high",
        F.coalesce(round_half_up(F.try_divide(F.col("approved").cast("double"),
                                              F.col("total_applicants")), 4),
                   F.lit(0.0)).alias("approval_rate"),
        round_half_up(F.col("_p"), 4).alias("avg_default_probability"),
        round_half_up(F.col("_rate"), 4).alias("avg_interest_rate"),
        round_half_up(F.try_divide(F.col("_profit").cast("double"), F.col("_priced")), 2)
        .alias("avg_expected_profit"),
        F.col("_profit").cast("double").alias("total_expected_profit"),
    )


def portfolio_metrics(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """The same metrics as one nested record per portfolio."""
    return portfolio_flat(df, by).select(
        *by,
        "total_applicants",
        F.struct("approved", "review", "rejected", "approval_rate").alias("decisions"),
        F.struct("low", "moderate", "high").alias("risk_distribution"),
        F.struct(F.col("avg_default_probability").alias("default_probability"),
                 F.col("avg_interest_rate").alias("interest_rate"),
                 F.col("avg_expected_profit").alias("expected_profit")).alias("averages"),
        "total_expected_profit",
    )
