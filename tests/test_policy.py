"""Decisions, prices, floors and validation on literal rows."""

import pytest
from pyspark.sql import functions as F

from lendmill.config import RiskPolicy
from lendmill.functions import finance, policy
from lendmill.operators.portfolio import portfolio_metrics
from lendmill.operators.validate import validate_applications
from lendmill.plans.scoring import score_with_scorecard
from lendmill.schema import REQUEST

# The published sample request.
SAMPLE = dict(app_id=1, loan_amnt=500000.0, int_rate=12.5, term=36, purpose="personal", age=32,
              annual_inc=600000.0, emp_length=5, employment_type="MNC", home_ownership="RENT",
              city_tier="Metro", cibil_score=720, existing_emi=15000.0, dpd_last_12m=0,
              cheque_bounces=0, inq_last_6mths=1, num_unsecured_loans=2, open_acc=5, total_acc=10,
              revol_bal=50000.0, revol_util=35.0)


def request(spark, *changes):
    rows = [{**SAMPLE, "app_id": i, **c} for i, c in enumerate(changes or [{}])]
    return spark.createDataFrame([tuple(r[n] for n in REQUEST.names) for r in rows], REQUEST)


VECTORS = [  # p, loan, category, decision, rate, profit
    (0.23, 15000.0, "LOW", "APPROVED", 0.08, 150.0),
    (0.12, 10000.0, "LOW", "APPROVED", 0.08, 1200.0),
    (0.45, 20000.0, "MODERATE", "REVIEW", 0.09875, -3075.0),
    (0.78, 15000.0, "HIGH", "REJECTED", 0.18, -3600.0),
    (0.25, 8000.0, "LOW", "APPROVED", 0.08, -80.0),
    (0.61, 25000.0, "MODERATE", "REVIEW", 0.11875, -6343.75),
]


def scores(spark, rows):
    return spark.createDataFrame(rows, "app_id int, p_final double, loan_amnt double")


def test_golden_assessments(spark):
    df = policy.assess(scores(spark, [(i, v[0], v[1]) for i, v in enumerate(VECTORS)]),
                       rounded=False)
    for row, (p, loan, category, decision, rate, profit) in zip(
            df.orderBy("app_id").collect(), VECTORS):
        assert (row.risk_category, row.decision) == (category, decision)
        assert row.interest_rate == pytest.approx(rate, abs=1e-12)
        assert row.interest_rate_pct == pytest.approx(rate * 100, abs=1e-10)
        assert row.expected_profit == pytest.approx(profit, abs=1e-8)
        assert row.confidence_score == pytest.approx(abs(p - 0.5) * 2)


def test_golden_portfolio(spark):
    df = policy.assess(scores(spark, [(i, v[0], v[1]) for i, v in enumerate(VECTORS[1:])]))
    m = portfolio_metrics(df).first()
    assert m.total_applicants == 5
    assert (m.decisions.approved, m.decisions.review, m.decisions.rejected) == (2, 2, 1)
    assert (m.risk_distribution.low, m.risk_distribution.moderate, m.risk_distribution.high) \
        == (2, 2, 1)
    assert m.decisions.approval_rate == 0.4
    assert m.averages.default_probability == 0.442
    assert m.total_expected_profit == -11898.75
    assert m.averages.expected_profit == -2379.75


def test_portfolio_of_nothing(spark):
    m = portfolio_metrics(policy.assess(scores(spark, []))).first()
    assert m.total_applicants == 0 and m.decisions.approval_rate == 0.0
    assert m.total_expected_profit is None


@pytest.mark.parametrize("p,category", [(0.2999999, "LOW"), (0.3, "MODERATE"),
                                        (0.6999999, "MODERATE"), (0.7, "HIGH"), (0.0, "LOW"),
                                        (1.0, "HIGH"), (None, None)])
def test_category_edges(spark, p, category):
    row = policy.assess(scores(spark, [(1, p, 10.0)])).first()
    assert row.risk_category == category
    assert row.decision == {"LOW": "APPROVED", "MODERATE": "REVIEW", "HIGH": "REJECTED",
                            None: None}[category]


def test_zero_confidence_and_profit_are_kept(spark):
    row = policy.assess(scores(spark, [(1, 0.5, 0.0)])).first()
    assert row.confidence_score == 0.0 and row.expected_profit == 0.0


def test_custom_policy(spark):
    strict = RiskPolicy(low_risk=0.1, high_risk=0.2, base_rate=0.05, high_adjustment=0.2)
    row = policy.assess(scores(spark, [(1, 0.25, 100.0)]), policy=strict).first()
    assert (row.risk_category, row.interest_rate) == ("HIGH", 0.25)


@pytest.mark.parametrize("change,floor", [
    ({"dpd_last_12m": 30}, 0.0), ({"dpd_last_12m": 31}, 0.72), ({"dpd_last_12m": 60}, 0.72),
    ({"dpd_last_12m": 61}, 0.85), ({"dpd_last_12m": 90}, 0.85), ({"dpd_last_12m": 91}, 0.93),
    ({"cibil_score": 300}, 0.93), ({"cibil_score": 349}, 0.93), ({"cibil_score": 350}, 0.88),
    ({"cibil_score": 449}, 0.88), ({"cibil_score": 450}, 0.0),
    ({"cheque_bounces": 2}, 0.0), ({"cheque_bounces": 3}, 0.80), ({"cheque_bounces": 4}, 0.80),
    ({"cheque_bounces": 5}, 0.90),
    ({"foir": 80.0}, 0.0), ({"foir": 80.001}, 0.85), ({"foir": 100.0}, 0.85),
    ({"foir": 100.001}, 0.95),
])
def test_regulatory_floor_edges(spark, change, floor):
    base = {"dpd_last_12m": 0, "cibil_score": 800, "cheque_bounces": 0, "foir": 20.0, **change}
    df = spark.createDataFrame([tuple(base.values()) + (p,) for p in (0.05, 0.5, 0.99)],
                               list(base) + ["p"])
    for row in df.withColumn("q", policy.apply_floors(F.col("p"))).collect():
        assert row.q == max(row.p, floor)


def test_scorecard_edges(spark):
    """Each scorecard floor at its edge, on an otherwise excellent profile."""
    good = {"cibil_score": 850, "annual_inc": 5000000.0, "existing_emi": 1000.0}
    cases = [({}, 0.02), ({"cibil_score": 599}, 0.78), ({"cibil_score": 449}, 0.88),
             ({"cibil_score": 349}, 0.93), ({"cheque_bounces": 3}, 0.80),
             ({"cheque_bounces": 5}, 0.90), ({"dpd_last_12m": 31}, 0.72)]
    df = finance.derive(request(spark, *[{**good, **c} for c, _ in cases]))
    got = [r.p for r in df.select("app_id", policy.scorecard_pd().alias("p"))
           .orderBy("app_id").collect()]
    for p, (change, floor) in zip(got, cases):
        assert floor <= p <= 0.98, change
    assert got[0] == 0.02


def test_scorecard_needs_complete_rows(spark):
    df = finance.derive(request(spark, {"annual_inc": None}, {"revol_util": None}))
    assert [r.p for r in df.select(policy.scorecard_pd().alias("p")).collect()] == [None, None]


def test_published_edge_cases(spark):
    cases = [{"dpd_last_12m": 90}, {"cibil_score": 300}, {"cheque_bounces": 5},
             {"loan_amnt": 500000.0, "term": 12, "annual_inc": 500000.0}]
    rows = {r.app_id: r for r in score_with_scorecard(request(spark, *cases)).collect()}
    for i, least in enumerate([0.85, 0.93, 0.90, 0.95]):
        assert rows[i].p_final >= least
        assert rows[i].decision == "REJECTED"


def test_instalment(spark):
    row = finance.derive(request(spark)).first()
    r = 12.5 / 100 / 12
    emi = 500000 * r * (1 + r) ** 36 / ((1 + r) ** 36 - 1)
    assert row.installment == pytest.approx(emi, rel=1e-12)
    assert row.foir == pytest.approx((15000 + emi) / 50000 * 100, rel=1e-12)
    free = finance.derive(request(spark, {"int_rate": 0.0})).first()
    assert free.installment == pytest.approx(500000 / 36)


@pytest.mark.parametrize("change,reason", [
    ({}, None), ({"cibil_score": 1000}, "cibil_score:range"),
    ({"cibil_score": 900}, None), ({"cibil_score": 299}, "cibil_score:range"),
    ({"loan_amnt": 0.0}, "loan_amnt:range"), ({"loan_amnt": 50000000.0}, None),
    ({"loan_amnt": 50000000.5}, "loan_amnt:range"), ({"int_rate": 0.0}, "int_rate:range"),
    ({"age": 18}, None), ({"age": 17}, "age:range"), ({"age": 101}, "age:range"),
    ({"revol_util": 100.0}, None), ({"revol_util": float("nan")}, "revol_util:range"),
    ({"dpd_last_12m": 361}, "dpd_last_12m:range"), ({"purpose": None}, "purpose:missing"),
    ({"annual_inc": None}, "annual_inc:missing"), ({"purpose": "yacht"}, None),
])
def test_validation(spark, change, reason):
    row = validate_applications(request(spark, change)).first()
    assert row.reasons == ([reason] if reason else []) and row.is_valid == (reason is None)


def test_validation_of_the_term(spark):
    row = validate_applications(request(spark, {"term": 7, "age": 5})).first()
    assert row.reasons == ["age:range", "term:choice"]


def test_rounding_happens_once(spark):
    values = [0.123449996, 0.299949996, 0.12345, 1e21, -0.00005, None]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in rows.select(policy.round_half_up(F.col("x"), 4)).collect()]
    assert got == [0.1234, 0.2999, 0.1235, 1e21, -0.0001, None]
