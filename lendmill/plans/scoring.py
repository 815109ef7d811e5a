"""End-to-end scoring: validate, derive, predict, floor, decide, price.

Every step is a projection, so the whole job is one narrow stage for any input size, and the
same functions serve batch tables and streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.config import POLICY, RiskPolicy
from lendmill.functions import policy as rules
from lendmill.functions.finance import derive
from lendmill.operators.portfolio import portfolio_metrics
from lendmill.operators.prep import PrepModel
from lendmill.operators.train import Fitted, score
from lendmill.operators.validate import accepted, quarantined


def finish(df: DataFrame, policy: RiskPolicy = POLICY, years=3) -> DataFrame:
    """From ``p_model`` to the assessment: floors, category, decision, price, profit."""
    p = F.col("p_model")
    floored = df.withColumns({"p_final": rules.apply_floors(p),
                              "floor_applied": rules.floor_applied(p),
                              "fired_rules": rules.fired_floors(p)})
    return rules.assess(floored, "p_final", "loan_amnt", True, years, policy)


def score_with_scorecard(requests: DataFrame, policy: RiskPolicy = POLICY,
                         validate: bool = True) -> DataFrame:
    """Scoring with the rule-based scorecard as the model."""
    rows = accepted(requests) if validate else requests
    return finish(derive(rows).withColumn("p_model", rules.scorecard_pd()), policy)


def score_applications(requests: DataFrame, prep: PrepModel, fitted: Fitted,
                       policy: RiskPolicy = POLICY, id_col: str = "app_id",
                       validate: bool = True) -> DataFrame:
    """Scoring with a trained classifier. The request travels beside its features, so scores
    are never joined back."""
    rows = derive(accepted(requests) if validate else requests)
    carried = rows.withColumn("request", F.struct("*"))
    features = prep.transform(carried, keep=[id_col, "request"])
    scored = score(fitted, features, keep=[id_col, "request"])
    return finish(scored.select("request.*", "p_model"), policy)


def score_with_rejects(requests: DataFrame, scorer) -> tuple[DataFrame, DataFrame]:
    """(assessed valid requests, rejected requests with their ``reasons``): every request is in
    one of the two. ``scorer`` takes requests and drops invalid ones, as the scorers here do."""
    return scorer(requests), quarantined(requests).drop("is_valid")


def score_batch(requests: DataFrame, prep: PrepModel, fitted: Fitted,
                policy: RiskPolicy = POLICY) -> tuple[DataFrame, DataFrame]:
    """(assessed applications, portfolio metrics of the batch)."""
    assessed = score_applications(requests, prep, fitted, policy)
    return assessed, portfolio_metrics(assessed)


def pair_scores(applications: DataFrame, scores: DataFrame, id_col: str = "app_id") -> DataFrame:
    """Amounts with separately delivered probabilities, by id."""
    return applications.join(scores, id_col)
