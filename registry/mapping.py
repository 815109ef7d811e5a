"""Applications derived from the order tables. One SQL text serves Spark and the oracle.

One application per order: ``orders`` joined with ``customer`` and with per-order line counts.
Only integer arithmetic, plain double arithmetic and CASE are used, so every stored column is
bit-equal in both engines. No join hint is given: Catalyst broadcasts a side only when its
size is below the session's threshold, and AQE splits hot join keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.functions import finance, policy
from lendmill.schema import PREDICTORS
from lendmill.session import materialise

STORED = [
    "app_id", "loan_amnt", "int_rate", "term", "purpose", "age", "annual_inc", "emp_length",
    "employment_type", "home_ownership", "city_tier", "cibil_score", "existing_emi",
    "dpd_last_12m", "cheque_bounces", "inq_last_6mths", "num_unsecured_loans", "open_acc",
    "total_acc", "revol_bal", "revol_util",
]

BASE_CTE = """
line_counts AS (
  SELECT l_orderkey,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_r,
         sum(CASE WHEN l_discount >= 0.09e0 THEN 1 ELSE 0 END) AS n_d,
         sum(CASE WHEN l_tax >= 0.07e0 THEN 1 ELSE 0 END) AS n_t
  FROM {lineitem} GROUP BY l_orderkey
),
seeded AS (
  SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus,
         c_custkey, c_acctbal, c_mktsegment, c_nationkey,
         CAST(coalesce(n_r, 0) AS BIGINT) AS n_r,
         CAST(coalesce(n_d, 0) AS BIGINT) AS n_d,
         CAST(coalesce(n_t, 0) AS BIGINT) AS n_t,
         (o_orderkey * 48271 + o_custkey * 16807 + 12345) % 1000003 AS h,
         (o_orderkey * 69621 + o_custkey * 40692 + 777) % 999983 AS g
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey
  LEFT JOIN line_counts ON l_orderkey = o_orderkey
),
shaped AS (
  SELECT *,
         CAST(300 + least(600, CAST(floor(((h % 201) + CAST(floor(h / 201) AS BIGINT) % 201
              + g % 201) * 1.25e0) AS BIGINT)) AS INT) AS cibil_score,
         (g % 1000) / 1000e0 AS u1,
         (CAST(floor(g / 1000) AS BIGINT) % 1000) / 1000e0 AS u2,
         (h % 10007) / 10007e0 AS u3,
         (c_acctbal + 1000e0) * 400e0 + 200000e0 AS annual_inc,
         CAST(2 + CAST(floor(h / 7) AS BIGINT) % 18 AS INT) AS total_acc,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'Govt' WHEN 'FURNITURE' THEN 'MNC'
              WHEN 'BUILDING' THEN 'Self-employed' ELSE 'Private' END AS employment_type
  FROM seeded
),
detailed AS (
  SELECT *,
         CASE WHEN cibil_score >= 750 THEN (10e0 + (h % 8501) / 100e0) * 0.6e0
              ELSE 10e0 + (h % 8501) / 100e0 END AS revol_util
  FROM shaped
),
apps AS (
  SELECT o_orderkey AS app_id,
         o_totalprice * 4e0 + 40000e0 AS loan_amnt,
         CASE WHEN cibil_score >= 750 THEN 9e0 + 3e0 * u1
              WHEN cibil_score >= 650 THEN 12e0 + 4e0 * u1 ELSE 16e0 + 6e0 * u1 END AS int_rate,
         CAST(12 * CAST(substr(o_orderpriority, 1, 1) AS INT) AS INT) AS term,
         CASE o_orderkey % 8 WHEN 0 THEN 'personal' WHEN 1 THEN 'business'
              WHEN 2 THEN 'education' WHEN 3 THEN 'home_renovation' WHEN 4 THEN 'medical'
              WHEN 5 THEN 'wedding' WHEN 6 THEN 'vehicle' ELSE 'debt_consolidation' END AS purpose,
         CAST(23 + (c_custkey * 31) % 42 AS INT) AS age,
         annual_inc,
         CAST(CAST(floor(g / 7) AS BIGINT) % 15
              + CASE WHEN employment_type = 'Govt' THEN 3 ELSE 0 END AS INT) AS emp_length,
         employment_type,
         CASE o_orderstatus WHEN 'F' THEN 'RENT' WHEN 'O' THEN 'OWN' ELSE 'FAMILY' END
              AS home_ownership,
         CASE c_nationkey % 3 WHEN 0 THEN 'Metro' WHEN 1 THEN 'Tier1' ELSE 'Tier2' END AS city_tier,
         cibil_score,
         least(annual_inc / 12e0 * (0.1e0 + 0.3e0 * u2)
               * (1e0 + (900 - cibil_score) / 600e0 * 0.5e0), annual_inc / 12e0 * 0.6e0)
              AS existing_emi,
         CAST(CASE WHEN n_r <= 1 THEN 0 WHEN n_r = 2 THEN 5 WHEN n_r = 3 THEN 20
              WHEN n_r = 4 THEN 45 WHEN n_r = 5 THEN 75 ELSE 100 END AS INT) AS dpd_last_12m,
         CAST(n_d AS INT) AS cheque_bounces,
         CAST(n_t AS INT) AS inq_last_6mths,
         CAST(c_custkey % 5 AS INT) AS num_unsecured_loans,
         CAST(1 + CAST(floor(g / 13) AS BIGINT) % total_acc AS INT) AS open_acc,
         total_acc,
         annual_inc * 0.3e0 * revol_util / 100e0 AS revol_bal,
         revol_util,
         u3
  FROM detailed
)"""


def build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with the derived predictors and the binary target, as one lazy plan."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
              for t in ("orders", "customer", "lineitem")}
    df = finance.derive(spark.sql(f"WITH {BASE_CTE} SELECT * FROM apps", **tables))
    df = df.withColumn("default", (F.col("u3") < policy.scorecard_pd()).cast("int"))
    return df.select("app_id", *PREDICTORS, "default")


_stored: dict[tuple[str, str], DataFrame] = {}


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole applications table, stored once per session so that queries scan Parquet
    with their own column pruning and filters, as they would on a real table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = materialise(build(spark, sf_dir), "applications")
    return _stored[key]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request columns of every application."""
    return applications(spark, sf_dir).select(*STORED)
