"""Whole-table variants of the mapped applications (nulls, invalid values, unseen classes...)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def app_id():
    return F.col("app_id")


def null_when(df: DataFrame, column: str, modulus: int):
    return F.when(app_id() % modulus != 0, F.col(column))


def with_nulls(df: DataFrame) -> DataFrame:
    return df.withColumns({"revol_util": null_when(df, "revol_util", 17),
                           "annual_inc": null_when(df, "annual_inc", 19),
                           "purpose": null_when(df, "purpose", 23)})


def with_invalid(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "cibil_score": F.when(app_id() % 29 == 0, 1000).otherwise(F.col("cibil_score")),
        "term": F.when(app_id() % 31 == 0, 7).otherwise(F.col("term")),
        "loan_amnt": F.when(app_id() % 37 == 0, -1.0).otherwise(F.col("loan_amnt"))})


def with_unseen(df: DataFrame) -> DataFrame:
    return df.withColumn("employment_type", F.when(app_id() % 41 == 0, "Gig")
                         .otherwise(F.col("employment_type")))


def with_optional(df: DataFrame) -> DataFrame:
    low = (600 + app_id() % 200).cast("double")
    return df.withColumns({"fico_range_low": low, "fico_range_high": low + 4.0,
                           "delinq_2yrs": (app_id() % 4).cast("int"),
                           "pub_rec": (app_id() % 3).cast("int")})


# A linear score over raw columns, used where SHAP must be expressible in SQL.
LINEAR_WEIGHTS = {
    "cibil_score": -0.004,
    "foir": 0.01,
    "dpd_last_12m": 0.02,
    "cheque_bounces": 0.3,
    "num_unsecured_loans": 0.07,
    "revol_util": 0.006,
    "annual_inc": -0.0000001,
    "age": -0.011,
}
