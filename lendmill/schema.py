"""Schemas and column roles of the applications table."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "app_id"
TARGET = "default"

# The request record, in the order clients send it.
REQUEST_FIELDS = [
    ("loan_amnt", T.DoubleType()),
    ("int_rate", T.DoubleType()),
    ("term", T.IntegerType()),
    ("purpose", T.StringType()),
    ("age", T.IntegerType()),
    ("annual_inc", T.DoubleType()),
    ("emp_length", T.IntegerType()),
    ("employment_type", T.StringType()),
    ("home_ownership", T.StringType()),
    ("city_tier", T.StringType()),
    ("cibil_score", T.IntegerType()),
    ("existing_emi", T.DoubleType()),
    ("dpd_last_12m", T.IntegerType()),
    ("cheque_bounces", T.IntegerType()),
    ("inq_last_6mths", T.IntegerType()),
    ("num_unsecured_loans", T.IntegerType()),
    ("open_acc", T.IntegerType()),
    ("total_acc", T.IntegerType()),
    ("revol_bal", T.DoubleType()),
    ("revol_util", T.DoubleType()),
]

# Columns computed from the request (see functions.finance.derive).
DERIVED_FIELDS = [
    ("monthly_income", T.DoubleType()),
    ("installment", T.DoubleType()),
    ("foir", T.DoubleType()),
    ("loan_income_ratio", T.DoubleType()),
    ("emi_income_ratio", T.DoubleType()),
    ("cibil_score_high", T.IntegerType()),
]

# Predictor order of the training table.
PREDICTORS = [
    "loan_amnt", "int_rate", "term", "installment", "purpose", "age", "annual_inc",
    "monthly_income", "emp_length", "employment_type", "home_ownership", "city_tier",
    "cibil_score", "existing_emi", "foir", "dpd_last_12m", "cheque_bounces",
    "inq_last_6mths", "num_unsecured_loans", "open_acc", "total_acc", "revol_bal",
    "revol_util", "loan_income_ratio", "emi_income_ratio", "cibil_score_high",
]

CATEGORICAL = ["purpose", "employment_type", "home_ownership", "city_tier"]
NUMERIC = [c for c in PREDICTORS if c not in CATEGORICAL]


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


REQUEST = _struct([(ID, T.LongType())] + REQUEST_FIELDS)

_types = dict(REQUEST_FIELDS + DERIVED_FIELDS)
APPLICATIONS = _struct(
    [(ID, T.LongType())] + [(c, _types[c]) for c in PREDICTORS] + [(TARGET, T.IntegerType())]
)


def numeric_columns(df, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]
