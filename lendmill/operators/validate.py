"""Request validation: one projection builds the list of violated rules per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.schema import REQUEST_FIELDS

# Fixed values: (field, low, low is allowed, high); high is always allowed.
BOUNDS = [
    ("loan_amnt", 0, False, 50_000_000),
    ("int_rate", 0, False, 50),
    ("age", 18, True, 100),
    ("annual_inc", 0, False, 100_000_000),
    ("emp_length", 0, True, 50),
    ("cibil_score", 300, True, 900),
    ("existing_emi", 0, True, 1_000_000),
    ("dpd_last_12m", 0, True, 360),
    ("cheque_bounces", 0, True, 50),
    ("inq_last_6mths", 0, True, 20),
    ("num_unsecured_loans", 0, True, 20),
    ("open_acc", 0, True, 50),
    ("total_acc", 0, True, 100),
    ("revol_bal", 0, True, 10_000_000),
    ("revol_util", 0, True, 100),
]
TERMS = [12, 24, 36, 48, 60]


def rejection_reasons() -> Column:
    """``field:missing``, ``field:range`` or ``term:choice`` for every violated rule."""
    found = [F.when(F.col(n).isNull(), F.lit(f"{n}:missing")).otherwise("")
             for n, _ in REQUEST_FIELDS]
    for name, low, allowed, high in BOUNDS:
        c = F.col(name)
        # NaN sorts above every number, so it also lands outside the upper bound
        outside = ((c < low) if allowed else (c <= low)) | (c > high)
        found.append(F.when(outside, F.lit(f"{name}:range")).otherwise(""))
    found.append(F.when(~F.col("term").isin(TERMS), F.lit("term:choice")).otherwise(""))
    return F.array_remove(F.array(*found), "")


def validate_applications(df: DataFrame) -> DataFrame:
    """Append ``reasons`` and ``is_valid``; no row is dropped."""
    return (df.withColumn("reasons", rejection_reasons())
              .withColumn("is_valid", F.size("reasons") == 0))


def accepted(df: DataFrame) -> DataFrame:
    """Valid rows only, as plain comparisons that reach the Parquet scan as pushed filters."""
    for name, _ in REQUEST_FIELDS:
        df = df.where(F.col(name).isNotNull())
    for name, low, allowed, high in BOUNDS:
        c = F.col(name)
        df = df.where((c >= low) if allowed else (c > low)).where(c <= high)
    return df.where(F.col("term").isin(TERMS))


def quarantined(df: DataFrame) -> DataFrame:
    return validate_applications(df).where("NOT is_valid")


def write_validated(df: DataFrame, path: str) -> None:
    """Store accepted and quarantined rows in one pass, as two partitions of one table."""
    validate_applications(df).write.mode("overwrite").partitionBy("is_valid").parquet(path)
