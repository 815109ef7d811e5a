"""SQL for DuckDB, written independently of the Spark expressions it checks."""

from __future__ import annotations

from lendmill.schema import CATEGORICAL, NUMERIC, PREDICTORS, REQUEST
from registry.mapping import BASE_CTE, STORED
from registry.variants import LINEAR_WEIGHTS

LINEAR = list(LINEAR_WEIGHTS)
REQUEST_COLUMNS = STORED[1:]
REQUEST_NUMERIC = [c for c in REQUEST_COLUMNS if c not in CATEGORICAL]
# request columns in record order
RECORD = [f.name for f in REQUEST.fields if f.name != "app_id"]
INTEGERS = [f.name for f in REQUEST.fields if f.dataType.simpleString() == "int"]

BASE = BASE_CTE.format(lineitem="lineitem", orders="orders", customer="customer")


def r(x: str, name: str | None = None, digits: int = 6) -> str:
    """Half-up rounding of the decimal value, after dropping binary noise below 1e-8."""
    cell = f"CAST(round(CAST({x} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"
    return cell + (f" AS {name or x}" if name != "" else "")


def plain(columns: list[str]) -> str:
    """Doubles at six places, everything else as it is."""
    whole = {*INTEGERS, *CATEGORICAL, "app_id", "cibil_score_high", "default"}
    quoted = {"default": '"default"'}
    return ", ".join(quoted.get(c, c) if c in whole else r(c) for c in columns)


DERIVED = """
d1 AS (
  SELECT *, annual_inc / 12e0 AS monthly_income, int_rate / 100e0 / 12e0 AS mr FROM apps
),
d2 AS (
  SELECT *, CASE WHEN mr = 0 THEN loan_amnt / term
                 ELSE loan_amnt * mr * pow(1e0 + mr, term) / (pow(1e0 + mr, term) - 1e0) END
            AS installment
  FROM d1
),
derived AS (
  SELECT *, (existing_emi + installment) / monthly_income * 100e0 AS foir,
         loan_amnt / annual_inc AS loan_income_ratio,
         installment / monthly_income * 100e0 AS emi_income_ratio,
         CAST(cibil_score + 50 AS INT) AS cibil_score_high
  FROM d2
)"""

SCORED = """
q1 AS (
  SELECT *, (900 - cibil_score) / 600e0 AS cn,
         CASE WHEN foir > 100 THEN foir / 65e0 * 2e0 ELSE foir / 65e0 END AS fn_,
         CASE WHEN dpd_last_12m > 90 THEN dpd_last_12m / 30e0 * 3e0
              WHEN dpd_last_12m > 60 THEN dpd_last_12m / 30e0 * 1.5e0
              ELSE dpd_last_12m / 30e0 END AS dn,
         CASE WHEN annual_inc >= 5000000 THEN 0e0 WHEN annual_inc <= 200000 THEN 1e0
              ELSE (5000000e0 - annual_inc) / 4800000e0 END AS ir,
         CASE WHEN term <= 24 THEN 0.08e0 WHEN term = 36 THEN 0e0 ELSE -0.05e0 END AS tr
  FROM derived
),
q2 AS (
  SELECT *, -0.5e0 + 0.55e0 * cn + 0.5e0 * fn_ + 0.45e0 * dn + 0.12e0 * ir + tr
    + CASE WHEN cheque_bounces > 0 THEN 0.22e0 ELSE 0 END
    + CASE WHEN cheque_bounces >= 3 THEN 0.3e0 ELSE 0 END
    + CASE WHEN num_unsecured_loans >= 3 THEN 0.2e0 ELSE 0 END
    + CASE WHEN inq_last_6mths >= 3 THEN 0.15e0 ELSE 0 END
    + CASE WHEN revol_util > 70 THEN 0.2e0 ELSE 0 END
    + CASE WHEN employment_type = 'Self-employed' THEN 0.1e0 ELSE 0 END
    + CASE WHEN cn > 0.5e0 AND foir > 60 THEN 0.4e0 ELSE 0 END
    + CASE WHEN dpd_last_12m > 0 AND cn > 0.4e0 THEN 0.3e0 ELSE 0 END
    + CASE WHEN cheque_bounces > 1 AND cn > 0.3e0 THEN 0.25e0 ELSE 0 END
    - CASE WHEN employment_type = 'Govt' THEN 0.15e0 WHEN employment_type = 'MNC' THEN 0.08e0
           ELSE 0 END AS raw_score
  FROM q1
),
q3 AS (
  SELECT *, greatest(raw_score,
    CASE WHEN foir > 100 THEN 0.95e0 WHEN foir > 65 THEN 0.73e0 ELSE -9e0 END,
    CASE WHEN cibil_score < 350 THEN 0.93e0 WHEN cibil_score < 450 THEN 0.88e0
         WHEN cibil_score < 600 THEN 0.78e0 ELSE -9e0 END,
    CASE WHEN dpd_last_12m > 90 THEN 0.93e0 WHEN dpd_last_12m > 60 THEN 0.85e0
         WHEN dpd_last_12m > 30 THEN 0.72e0 ELSE -9e0 END,
    CASE WHEN cheque_bounces >= 5 THEN 0.9e0 WHEN cheque_bounces >= 3 THEN 0.8e0 ELSE -9e0 END
    ) AS bounded
  FROM q2
),
scored AS (
  SELECT *, least(0.98e0, greatest(0.02e0, bounded)) AS pd,
         CAST(u3 < least(0.98e0, greatest(0.02e0, bounded)) AS INT) AS "default"
  FROM q3
)"""

FLOOR = """greatest(
    CASE WHEN dpd_last_12m > 90 THEN 0.93e0 WHEN dpd_last_12m > 60 THEN 0.85e0
         WHEN dpd_last_12m > 30 THEN 0.72e0 ELSE 0e0 END,
    CASE WHEN cibil_score < 350 THEN 0.93e0 WHEN cibil_score < 450 THEN 0.88e0 ELSE 0e0 END,
    CASE WHEN cheque_bounces >= 5 THEN 0.9e0 WHEN cheque_bounces >= 3 THEN 0.8e0 ELSE 0e0 END,
    CASE WHEN foir > 100 THEN 0.95e0 WHEN foir > 80 THEN 0.85e0 ELSE 0e0 END)"""


def judged_cte(p: str = "pd", source: str = "scored") -> str:
    return f"""
j1 AS (SELECT *, {p} AS p_model FROM {source}),
j2 AS (SELECT *, greatest(p_model, {FLOOR}) AS p_final, {FLOOR} > p_model AS floor_applied,
              CAST(p_model >= 0.5e0 AS INT) AS prediction FROM j1),
judged AS (
  SELECT *,
    CASE WHEN p_final < 0.3e0 THEN 'LOW' WHEN p_final < 0.7e0 THEN 'MODERATE' ELSE 'HIGH' END
      AS risk_category,
    CASE WHEN p_final < 0.3e0 THEN 'APPROVED' WHEN p_final < 0.7e0 THEN 'REVIEW'
         ELSE 'REJECTED' END AS decision,
    CASE WHEN p_final < 0.3e0 THEN 0.08e0
         WHEN p_final < 0.7e0 THEN 0.08e0 + (p_final - 0.3e0) / (0.7e0 - 0.3e0) * 0.05e0
         ELSE 0.08e0 + 0.1e0 END AS rate
  FROM j2
)"""


def dec(x: str, digits: int) -> str:
    """Half-up rounding, once, of the number as it prints."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


ASSESSED_CTE = f"""
assessed AS (
  SELECT *, {dec('p_final', 4)} AS default_probability, {dec('rate', 4)} AS interest_rate,
         {dec('rate * 100', 2)} AS interest_rate_pct,
         {dec('loan_amnt * rate * 3 - p_final * loan_amnt', 2)} AS expected_profit,
         {dec('abs(p_final - 0.5e0) * 2', 4)} AS confidence_score
  FROM judged
)"""
ASSESSED = ("app_id, default_probability, risk_category, decision, interest_rate, "
            "interest_rate_pct, expected_profit, confidence_score")


def q(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([BASE, *[c.strip() for c in ctes]]) + "\n" + body


def on_scored(body: str, *ctes: str) -> str:
    return q(body, DERIVED, SCORED, *ctes)


def on_judged(body: str, *ctes: str) -> str:
    return on_scored(body, judged_cte(), *ctes)


def on_assessed(body: str, *ctes: str) -> str:
    return on_judged(body, ASSESSED_CTE, *ctes)


# ---- variants ------------------------------------------------------------------------------

def nulls_cte(name: str, source: str, extra: str = "") -> str:
    return f"""{name} AS (SELECT * REPLACE (
      CASE WHEN app_id % 17 = 0 THEN NULL ELSE revol_util END AS revol_util,
      CASE WHEN app_id % 19 = 0 THEN NULL ELSE annual_inc END AS annual_inc,
      CASE WHEN app_id % 23 = 0 THEN NULL ELSE purpose END AS purpose{extra}) FROM {source})"""


INVALID = """REPLACE (
      CAST(CASE WHEN app_id % 29 = 0 THEN 1000 ELSE cibil_score END AS INT) AS cibil_score,
      CAST(CASE WHEN app_id % 31 = 0 THEN 7 ELSE term END AS INT) AS term,
      CASE WHEN app_id % 37 = 0 THEN -1e0 ELSE loan_amnt END AS loan_amnt)"""
GIG = ", CASE WHEN app_id % 41 = 0 THEN 'Gig' ELSE employment_type END AS employment_type"

RANGES = [("loan_amnt", "<= 0", 50000000), ("int_rate", "<= 0", 50), ("age", "< 18", 100),
          ("annual_inc", "<= 0", 100000000), ("emp_length", "< 0", 50),
          ("cibil_score", "< 300", 900), ("existing_emi", "< 0", 1000000),
          ("dpd_last_12m", "< 0", 360), ("cheque_bounces", "< 0", 50),
          ("inq_last_6mths", "< 0", 20), ("num_unsecured_loans", "< 0", 20),
          ("open_acc", "< 0", 50), ("total_acc", "< 0", 100), ("revol_bal", "< 0", 10000000),
          ("revol_util", "< 0", 100)]
REASONS = "concat_ws(';', " + ", ".join(
    [f"CASE WHEN {n} IS NULL THEN '{n}:missing' END" for n in RECORD]
    + [f"CASE WHEN {n} {low} OR {n} > {high} THEN '{n}:range' END" for n, low, high in RANGES]
    + ["CASE WHEN term NOT IN (12, 24, 36, 48, 60) THEN 'term:choice' END"]) + ")"

# ---- preprocessing -----------------------------------------------------------------------------

ENGINEERED = ["dti", "credit_utilization_ratio"]
CANDIDATES = [*PREDICTORS, *ENGINEERED]


def prep_fit_ctes(source: str = "scored") -> list[str]:
    """Statistics of every fitted step, from ``source``."""
    fill = "fill AS (SELECT " + ", ".join(
        [f"median({c}) AS f_{c}" for c in NUMERIC]
        + [f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} "
           f"ORDER BY count(*) DESC, {c} LIMIT 1) AS f_{c}" for c in CATEGORICAL]
    ) + f" FROM {source})"
    return [fill, *impute_ctes("fit", source),
            "bounds AS (SELECT " + ", ".join(
                f"avg({c}) - 3 * stddev_samp({c}) AS lo_{c}, avg({c}) + 3 * stddev_samp({c}) AS hi_{c}"
                for c in NUMERIC) + " FROM fit_engineered)",
            clip_cte("fit", "bounds"),
            *[f"classes_{c} AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM "
              f"(SELECT DISTINCT {c} AS v FROM fit_clipped))" for c in CATEGORICAL],
            "scaling AS (SELECT " + ", ".join(
                f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}"
                for c in NUMERIC) + " FROM fit_clipped)",
            encode_cte("fit"), *selection_ctes()]


def impute_ctes(prefix: str, source: str, fill: str = "fill") -> list[str]:
    return [f"{prefix}_imputed AS (SELECT t.* REPLACE (" + ", ".join(
        f"coalesce(t.{c}, f_{c}) AS {c}" for c in PREDICTORS) + f") FROM {source} t, {fill})",
        f"""{prefix}_engineered AS (SELECT * REPLACE (loan_amnt / (annual_inc + 1) AS
        loan_income_ratio), loan_amnt / annual_inc * 100 AS dti,
        revol_util / 100 AS credit_utilization_ratio FROM {prefix}_imputed)"""]


def clip_cte(prefix: str, bounds: str) -> str:
    return f"{prefix}_clipped AS (SELECT t.* REPLACE (" + ", ".join(
        f"CASE WHEN t.{c} < lo_{c} THEN lo_{c} WHEN t.{c} > hi_{c} THEN hi_{c} "
        f"ELSE CAST(t.{c} AS DOUBLE) END AS {c}" for c in NUMERIC
    ) + f") FROM {prefix}_engineered t, {bounds})"


def encode_cte(prefix: str) -> str:
    joins = " ".join(f"LEFT JOIN classes_{c} k_{c} ON k_{c}.v = t.{c}" for c in CATEGORICAL)
    return f"{prefix}_encoded AS (SELECT t.* REPLACE (" + ", ".join(
        f"CAST(coalesce(k_{c}.code, 0) AS DOUBLE) AS {c}" for c in CATEGORICAL
    ) + f") FROM {prefix}_clipped t {joins})"


def selection_ctes() -> list[str]:
    columns = ", ".join(CANDIDATES)
    position = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CANDIDATES))
    return [f"""long AS MATERIALIZED (SELECT app_id, feature, v, CASE feature {position} END AS pos
              FROM (UNPIVOT (SELECT app_id, {columns} FROM fit_encoded) ON {columns}
                    INTO NAME feature VALUE v))""",
            """related AS MATERIALIZED (SELECT b.feature, a.feature AS earlier,
                 abs(corr(a.v, b.v)) AS c
               FROM long a JOIN long b ON a.app_id = b.app_id AND a.pos < b.pos
               GROUP BY b.feature, a.feature)""",
            f"""chosen AS MATERIALIZED (SELECT f.feature, coalesce(max(c), 0e0) AS correlation,
                 coalesce(max(c), 0e0) > 0.95e0 AS dropped
               FROM (SELECT unnest([{', '.join(f"'{c}'" for c in CANDIDATES)}]) AS feature) f
               LEFT JOIN related ON related.feature = f.feature GROUP BY f.feature)"""]


def wide(source: str) -> str:
    cells = []
    for c in CANDIDATES:
        x = f"(t.{c} - m_{c}) / s_{c}" if c in NUMERIC else f"t.{c}"
        cells.append(f"CASE WHEN NOT (SELECT dropped FROM chosen WHERE feature = '{c}') "
                     f"THEN {r(x, '')} END AS {c}")
    return f"SELECT app_id, {', '.join(cells)} FROM {source} t, scaling"


# null and unseen variant of the derived table; derived columns keep the values of the clean row
DIRTY = nulls_cte("dirty", "scored", GIG)


def prep_query(body: str, *ctes: str) -> str:
    return on_scored(body, *prep_fit_ctes(), *ctes)


def t7_sql(batch: bool) -> str:
    if batch:
        own = ["batch_fill AS (SELECT " + ", ".join(
            [f"median({c}) AS f_{c}" for c in NUMERIC]
            + [f"(SELECT {c} FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} "
               f"ORDER BY count(*) DESC, {c} LIMIT 1) AS f_{c}" for c in CATEGORICAL]
        ) + " FROM dirty)", *impute_ctes("new", "dirty", "batch_fill"),
            "batch_bounds AS (SELECT " + ", ".join(
                f"avg({c}) - 3 * stddev_samp({c}) AS lo_{c}, avg({c}) + 3 * stddev_samp({c}) AS hi_{c}"
                for c in NUMERIC) + " FROM new_engineered)", clip_cte("new", "batch_bounds")]
    else:
        own = [*impute_ctes("new", "dirty"), clip_cte("new", "bounds")]
    return prep_query(wide("new_encoded"), DIRTY, *own, encode_cte("new"))


# ---- evaluation -----------------------------------------------------------------------------------

def auc(score: str, label: str = '"default"') -> str:
    """Mid-rank form over columns ``mid`` (average rank) of the grouped rows."""
    return (f"(sum(CASE WHEN {label} = 1 THEN mid END) - sum({label}) * (sum({label}) + 1) / 2e0)"
            f" / (sum({label}) * 1e0 * (count(*) - sum({label})))")


def mid_rank(score: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    same = f"PARTITION BY {by + ', ' if by else ''}{score}"
    return (f"rank() OVER ({part}ORDER BY {score}) + (count(*) OVER ({same}) - 1) / 2e0")


CONFUSION = """CAST(sum(CASE WHEN "default" = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN "default" = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN "default" = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN "default" = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp"""
RATIOS = f"""{r('CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / CAST(tp + fp AS DOUBLE) END', 'precision')},
  {r('CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / CAST(tp + fn AS DOUBLE) END', 'recall')},
  {r('CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END', 'f1')}"""

SPLIT = """
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY "default" ORDER BY md5('42:' || CAST(app_id AS VARCHAR)),
                               app_id) AS rn,
         count(*) OVER (PARTITION BY "default") AS class_rows
  FROM judged
),
split AS (
  SELECT *, CASE WHEN rn <= floor(0.2e0 * class_rows + 0.5e0) THEN 'test'
                 WHEN rn <= floor(0.2e0 * class_rows + 0.5e0) + floor(0.1e0 * class_rows + 0.5e0)
                 THEN 'validation' ELSE 'train' END AS split
  FROM ordered
)"""

RIVALS = f"""
rivals AS (
  SELECT app_id, "default", split, 'scorecard' AS model, 0 AS position, p_model AS score FROM split
  UNION ALL SELECT app_id, "default", split, 'floored', 1, p_final FROM split
  UNION ALL SELECT app_id, "default", split, 'bureau', 2, (900 - cibil_score) / 600e0 FROM split
),
rival_ranks AS (SELECT *, CAST(score >= 0.5e0 AS INT) AS prediction,
                       {mid_rank('score', 'model, split')} AS mid FROM rivals),
rival_counts AS (
  SELECT model, position, split, {auc('score')} AS roc_auc, {CONFUSION}
  FROM rival_ranks GROUP BY model, position, split
),
rival_metrics AS (SELECT model, position, split, {r('roc_auc')}, {RATIOS}, tn, fp, fn, tp
                  FROM rival_counts)"""


def on_rivals(body: str) -> str:
    return on_judged(body, SPLIT, RIVALS)


# ---- explanations -----------------------------------------------------------------------------------

MEANS = "means AS (SELECT " + ", ".join(f"avg({c}) AS mean_{c}" for c in LINEAR) + " FROM judged)"
SHAP = ("shap AS (SELECT t.*, " + ", ".join(
    f"CAST({w!r} AS DOUBLE) * (t.{c} - mean_{c}) AS shap_{c}" for c, w in LINEAR_WEIGHTS.items())
    + ", " + " + ".join(f"CAST({w!r} AS DOUBLE) * mean_{c}" for c, w in LINEAR_WEIGHTS.items())
    + " AS base_value FROM judged t, means)")


def long_cte(foir: str = "foir") -> str:
    return "shap_long AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT app_id, '{c}' AS feature, CAST({foir if c == 'foir' else c} AS DOUBLE) AS value, "
        f"shap_{c} AS shap_value FROM shap" for c in LINEAR) + ")"


RANKED = """shap_ranked AS MATERIALIZED (SELECT *, CAST(row_number() OVER (PARTITION BY app_id
    ORDER BY abs(shap_value) DESC, feature) AS INT) AS rank FROM shap_long)"""


def on_shap(body: str, *ctes: str) -> str:
    return on_judged(body, MEANS, SHAP, long_cte(), RANKED, *ctes)


BEYOND = """
sorted AS MATERIALIZED (SELECT feature, value,
    row_number() OVER (PARTITION BY feature ORDER BY value) AS rn FROM shap_long),
spots AS MATERIALIZED (SELECT feature, value, min(rn) - 1 AS below, max(rn) AS upto
          FROM sorted GROUP BY feature, value),
sizes AS (SELECT feature, count(*) AS n FROM sorted GROUP BY feature),
places AS MATERIALIZED (SELECT s.feature, s.value, below, n - upto AS above,
    (below + 1) // 2 AS b1, (below + 2) // 2 AS b2,
    upto + (n - upto + 1) // 2 AS a1, upto + (n - upto + 2) // 2 AS a2
  FROM spots s JOIN sizes USING (feature)),
middles AS MATERIALIZED (SELECT p.feature, p.value,
    CASE WHEN below > 0 THEN (x1.value + x2.value) / 2 END AS median_below,
    CASE WHEN above > 0 THEN (y1.value + y2.value) / 2 END AS median_above
  FROM places p
  LEFT JOIN sorted x1 ON x1.feature = p.feature AND x1.rn = p.b1
  LEFT JOIN sorted x2 ON x2.feature = p.feature AND x2.rn = p.b2
  LEFT JOIN sorted y1 ON y1.feature = p.feature AND y1.rn = p.a1
  LEFT JOIN sorted y2 ON y2.feature = p.feature AND y2.rn = p.a2),
moves AS MATERIALIZED (SELECT s.app_id, s.rank, s.feature, s.value AS current_value,
    CASE WHEN shap_value > 0 THEN coalesce(median_below, s.value * 0.8e0)
         ELSE coalesce(median_above, s.value * 1.2e0) END AS suggested_value,
    CASE WHEN shap_value > 0 THEN 'decrease' ELSE 'increase' END AS direction
  FROM shap_ranked s JOIN middles m ON m.feature = s.feature AND m.value = s.value
  WHERE s.rank <= 3)"""


def on_moves(body: str, *ctes: str) -> str:
    return on_judged(body, MEANS, SHAP, long_cte(), RANKED, BEYOND, *ctes)


THRESHOLDS = """
grid AS (SELECT CAST(i AS INT) AS position,
                CASE WHEN i = 49 THEN 0.9e0 ELSE 0.1e0 + i * ((0.9e0 - 0.1e0) / 49) END AS threshold
         FROM range(50) g(i)),
sweep AS (
  SELECT position, threshold,
         CAST(sum(CASE WHEN "default" = 0 AND p_model >= threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN "default" = 1 AND p_model < threshold THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM judged, grid GROUP BY position, threshold
),
priced AS (SELECT *, fp * 5000e0 + fn * 20000e0 AS cost FROM sweep)"""


def profile_sql() -> str:
    parts = []
    for c in RECORD:
        dtype = "string" if c in CATEGORICAL else ("int" if c in INTEGERS else "double")
        parts.append(
            f"SELECT '{c}' AS feature, '{dtype}' AS dtype, count(*) - count({c}) AS null_count, "
            f"{r(f'(count(*) - count({c})) * 100e0 / count(*)', 'null_pct')}, "
            f"count(DISTINCT {c}) AS distinct_count, "
            f"CAST((SELECT {c} FROM nulled ORDER BY app_id LIMIT 1) AS VARCHAR) AS sample FROM nulled")
    return q(" UNION ALL ".join(parts), nulls_cte("nulled", "apps"))


def summary_sql() -> str:
    parts = []
    for c in RECORD:
        if c in CATEGORICAL:
            parts.append(f"SELECT '{c}' AS feature, 'string' AS dtype, count({c}) AS count, "
                         f"count(*) - count({c}) AS nulls, " + ", ".join(
                             f"CAST(NULL AS DOUBLE) AS {n}" for n in
                             ("mean", "stddev", "min", "q25", "q50", "q75", "max"))
                         + " FROM nulled")
            continue
        dtype = "int" if c in INTEGERS else "double"
        parts.append(
            f"SELECT '{c}' AS feature, '{dtype}' AS dtype, count({c}) AS count, count(*) - count({c}) AS nulls, "
            + ", ".join(r(x, n) for x, n in [
                (f"avg({c})", "mean"), (f"stddev_samp({c})", "stddev"),
                (f"CAST(min({c}) AS DOUBLE)", "min"),
                (f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", "q25"),
                (f"quantile_cont(CAST({c} AS DOUBLE), 0.5)", "q50"),
                (f"quantile_cont(CAST({c} AS DOUBLE), 0.75)", "q75"),
                (f"CAST(max({c}) AS DOUBLE)", "max")]) + " FROM nulled")
    return q(" UNION ALL ".join(parts), nulls_cte("nulled", "apps"))


def portfolio_sql(by: str = "") -> str:
    count = lambda cond: f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
    keys = by + ", " if by else ""
    return f"""SELECT {keys}count(*) AS total_applicants,
  {count("decision = 'APPROVED'")} AS approved, {count("decision = 'REVIEW'")} AS review,
  {count("decision = 'REJECTED'")} AS rejected, {count("risk_category = 'LOW'")} AS low,
  {count("risk_category = 'MODERATE'")} AS moderate, {count("risk_category = 'HIGH'")} AS high,
  {dec("sum(CASE WHEN decision = 'APPROVED' THEN 1e0 ELSE 0e0 END) / count(*)", 4)} AS approval_rate,
  {dec('avg(default_probability)', 4)} AS avg_default_probability,
  {dec('avg(interest_rate)', 4)} AS avg_interest_rate,
  {dec('CAST(sum(CAST(expected_profit AS DECIMAL(18,2))) AS DOUBLE) / count(*)', 2)}
    AS avg_expected_profit,
  CAST(sum(CAST(expected_profit AS DECIMAL(18,2))) AS DOUBLE) AS total_expected_profit
FROM assessed{' GROUP BY ' + by if by else ''}"""


def rank_rules(p: str) -> str:
    """Names of the regulatory floors above ``p``, in rule order."""
    rules = [("dpd_last_12m", ">", 90, 0.93), ("dpd_last_12m", ">", 60, 0.85),
             ("dpd_last_12m", ">", 30, 0.72), ("cibil_score", "<", 350, 0.93),
             ("cibil_score", "<", 450, 0.88), ("cheque_bounces", ">=", 5, 0.9),
             ("cheque_bounces", ">=", 3, 0.8), ("foir", ">", 100, 0.95), ("foir", ">", 80, 0.85)]
    return "concat_ws(';', " + ", ".join(
        f"CASE WHEN {c} {o} {b} AND {v}e0 > {p} THEN '{c}{o}{b}' END" for c, o, b, v in rules) + ")"


MODEL_CHECKS = """SELECT split, CAST(sum(1 - "default") AS BIGINT) AS negatives,
  CAST(sum("default") AS BIGINT) AS positives, TRUE AS useful, TRUE AS precise, TRUE AS recalled
  FROM split GROUP BY split"""
SEARCH_CHECKS = MODEL_CHECKS.replace("TRUE AS recalled", "TRUE AS recalled, TRUE AS near_scorecard")
# The published quick grid.
QUICK_POINTS = """SELECT CAST(d AS DOUBLE) AS max_depth, CAST(n AS DOUBLE) AS n_estimators,
  CAST(r AS DOUBLE) AS learning_rate, CAST(s AS DOUBLE) AS subsample,
  CAST(0.8 AS DOUBLE) AS colsample_bytree, TRUE AS useful, TRUE AS best_if_chosen
  FROM (VALUES (5), (6)) a(d), (VALUES (200), (300)) b(n), (VALUES (0.05), (0.1)) c(r),
       (VALUES (0.8), (0.9)) e(s)"""
ALL_COLUMNS = plain(["app_id", *PREDICTORS, "default"])
PROFIT = "loan_amnt * rate * {y} - p_final * loan_amnt"
OPTIONAL = """opt AS (SELECT *, CAST(600 + app_id % 200 AS DOUBLE) AS low_,
                      app_id % 4 AS dq, app_id % 3 AS pr FROM apps)"""
FEATURE_LIST = ", ".join(f"'{c}'" for c in REQUEST_NUMERIC)

ORACLES = {
    "S1_csv_scan": on_scored(f"SELECT {ALL_COLUMNS} FROM scored"),
    "S2_table_sink": on_scored(f"SELECT {ALL_COLUMNS} FROM scored"),
    "S3_comparison_sink": on_rivals(
        "SELECT upper(model) AS model, roc_auc, precision, recall, f1 FROM rival_metrics "
        "WHERE split = 'validation'"),
    "S4_request_records": q(f"SELECT {plain(['app_id', *RECORD])} FROM apps"),
    "S5_result_records": on_assessed(f"SELECT {ASSESSED} FROM assessed"),
    "S6_prep_save_load": t7_sql(batch=False),
    "S8_explanation_sink": on_shap(
        f"SELECT app_id, feature, {r('shap_value')}, app_id IN (SELECT app_id FROM apps ORDER BY "
        "md5('42:' || CAST(app_id AS VARCHAR)), app_id LIMIT 1000) AS in_background FROM shap_long"),
    "S7_bundle_hand_over": q("SELECT app_id, TRUE AS equal FROM apps"),
    "A3_table_shape": q(f"SELECT count(*) AS rows, CAST({len(STORED)} AS BIGINT) AS columns "
                        "FROM apps"),
    "A3_dtype_counts": "SELECT dtype, CAST(n AS BIGINT) AS columns FROM (VALUES ('bigint', 1), "
                       f"('double', {len(RECORD) - len(CATEGORICAL) - len(INTEGERS)}), "
                       f"('int', {len(INTEGERS)}), ('string', {len(CATEGORICAL)})) t(dtype, n)",
    "Z2_stream_rejects": q(
        f"""SELECT app_id, CASE WHEN {REASONS} = '' THEN 'assessed' ELSE 'rejected' END AS outcome,
        {REASONS} AS reasons FROM bad
        UNION ALL SELECT app_id, 'unreadable', '' FROM apps WHERE app_id % 43 = 0""",
        f"bad AS (SELECT * {INVALID} FROM apps)"),
    "S7_model_save_load": q("SELECT app_id, TRUE AS equal FROM apps"),
    "P1_monthly_income": q(f"SELECT app_id, {r('annual_inc / 12e0', 'monthly_income')} FROM apps"),
    "P2_emi": q(f"SELECT app_id, {r('installment')} FROM derived", DERIVED),
    "P3_foir": q(f"SELECT app_id, {r('foir')} FROM derived", DERIVED),
    "P4_emi_income_ratio": q(f"SELECT app_id, {r('emi_income_ratio')} FROM derived", DERIVED),
    "P5_loan_income_ratio": q(
        f"SELECT app_id, {r('loan_amnt / annual_inc', 'plain')}, "
        f"{r('loan_amnt / (annual_inc + 1)', 'offset_by_one')} FROM apps"),
    "P6_cibil_score_high": q("SELECT app_id, CAST(cibil_score + 50 AS INT) AS cibil_score_high "
                             "FROM apps"),
    "P7_dti": q(f"SELECT app_id, {r('loan_amnt / annual_inc * 100', 'dti')} FROM apps"),
    "P8_credit_utilization_ratio": q(
        f"SELECT app_id, {r('revol_util / 100', 'credit_utilization_ratio')} FROM apps"),
    "P9_fico_avg": q(f"SELECT app_id, {r('(low_ + low_ + 4e0) / 2', 'fico_avg')} FROM opt",
                     OPTIONAL),
    "P10_delinquency_flags": q(
        "SELECT app_id, CAST(dq > 0 AS INT) AS has_delinquency, CAST(pr > 0 AS INT) AS "
        "has_public_record FROM opt", OPTIONAL),
    "P11_revol_bal": q(
        f"SELECT app_id, {r('0.3e0 * annual_inc * revol_util / 100e0', 'revol_bal')} FROM apps"),
    "P12_confidence": on_judged(
        f"SELECT app_id, {r('abs(p_final - 0.5e0) * 2', 'confidence')} FROM judged"),
    "P13_align_features": q(
        f"SELECT app_id, cibil_score, 0 AS pub_rec, {r('loan_amnt')}, age FROM apps"),
    "P14_drop_target": on_scored(f"SELECT {plain(['app_id', *PREDICTORS])} FROM scored"),
    "F1_validate_applications": q(
        f"SELECT app_id, {REASONS} = '' AS is_valid, {REASONS} AS reasons FROM bad",
        nulls_cte("nulled", "apps"), f"bad AS (SELECT * {INVALID} FROM nulled)"),
    "F2_constant_features": q(
        " UNION ALL ".join(
            f"SELECT '{n}' AS feature, {r(f'ln(1 + var_samp({x}))', 'log_variance')}, "
            f"var_samp({x}) < 0.01 AS dropped FROM apps"
            for n, x in [*[(n, n) for n in REQUEST_NUMERIC], ("always_one", "1"),
                         ("rare", "CASE WHEN app_id % 1000 = 0 THEN 1 ELSE 0 END")])),
    "F3_correlated_features": prep_query(
        f"SELECT feature, {r('correlation')}, dropped FROM chosen"),
    "F5_values_beyond": q(
        "SELECT app_id, rank() OVER (ORDER BY revol_util) - 1 AS n_below, "
        "rank() OVER (ORDER BY revol_util DESC) - 1 AS n_above FROM apps"),
    "J1_pair_scores": on_judged(
        f"SELECT a.app_id, {r('a.loan_amnt', 'loan_amnt')}, {r('b.p_final', 'p')} "
        "FROM apps a JOIN judged b ON a.app_id = b.app_id"),
    "T1_median_impute": q(" UNION ALL ".join(
        f"SELECT '{n}' AS feature, {r(f'median(CAST({n} AS DOUBLE))', 'median')} FROM nulled"
        for n in REQUEST_NUMERIC), nulls_cte("nulled", "apps")),
    "T2_mode_impute": q(" UNION ALL ".join(
        f"SELECT '{n}' AS feature, (SELECT {n} FROM nulled WHERE {n} IS NOT NULL GROUP BY {n} "
        f"ORDER BY count(*) DESC, {n} LIMIT 1) AS mode" for n in CATEGORICAL),
        nulls_cte("nulled", "apps")),
    "T3_outlier_clip": q(
        "SELECT app_id, " + ", ".join(
            r(f"least(greatest(CAST({n} AS DOUBLE), (SELECT avg({n}) - 3 * stddev_samp({n}) FROM apps)), "
              f"(SELECT avg({n}) + 3 * stddev_samp({n}) FROM apps))", n) for n in REQUEST_NUMERIC)
        + " FROM apps"),
    "T3_merged_bounds": q(" UNION ALL ".join(
        f"SELECT '{n}' AS feature, {r(f'avg({n}) - 3 * stddev_samp({n})', 'low')}, "
        f"{r(f'avg({n}) + 3 * stddev_samp({n})', 'high')} FROM apps" for n in REQUEST_NUMERIC)),
    "T6_pipeline_stage": q("SELECT app_id, TRUE AS same FROM apps"),
    "X8_scored_moves": q("SELECT app_id, TRUE AS is_prediction, TRUE AS told_right FROM apps"),
    "T4_label_encode": q(
        "SELECT app_id, " + ", ".join(
            f"CAST(coalesce((SELECT code FROM c_{n} WHERE v = t.{n}), 0) AS INT) AS {n}"
            for n in CATEGORICAL) + f" FROM (SELECT * REPLACE ({GIG[2:]}) FROM apps) t",
        *[f"c_{n} AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM "
          f"(SELECT DISTINCT {n} AS v FROM apps))" for n in CATEGORICAL]),
    "T5_standard_scale": q(
        "SELECT app_id, " + ", ".join(
            r(f"({n} - (SELECT avg({n}) FROM apps)) / (SELECT stddev_pop({n}) FROM apps)", n)
            for n in REQUEST_NUMERIC) + " FROM apps"),
    "T6_fit_transform": prep_query(wide("fit_encoded")),
    "T7_transform": t7_sql(batch=False),
    "T7_transform_batch_stats": t7_sql(batch=True),
    "A1_portfolio_metrics": on_assessed(portfolio_sql()),
    "A1_portfolio_by_segment": on_assessed(portfolio_sql("purpose, city_tier")),
    "A2_feature_profile": profile_sql(),
    "A3_table_summary": summary_sql(),
    "A4_target_distribution": on_scored(
        f"""SELECT "default", count(*) AS n, {r('count(*) / CAST((SELECT count(*) FROM scored) AS DOUBLE)',
        'share')} FROM scored GROUP BY "default" """),
    "A4_base_rates": on_scored(
        f"""SELECT {r('avg("default")', 'default_rate')}, {r('avg(cibil_score)', 'avg_cibil_score')},
        {r('avg(foir)', 'avg_foir')} FROM scored"""),
    "A5_class_counts": on_scored(
        f"""SELECT CAST(sum(1 - "default") AS BIGINT) AS n0, CAST(sum("default") AS BIGINT) AS n1,
        {r('sum(1 - "default") / CAST(sum("default") AS DOUBLE)', 'scale_pos_weight')}
        FROM scored"""),
    "A6_class_weights": on_scored(
        f"""SELECT "default", count(*) AS n, {r('(SELECT count(*) FROM scored) / (2e0 * count(*))',
        'weight')} FROM scored GROUP BY "default" """),
    "A7_confusion_matrix": on_judged(f"SELECT purpose, {CONFUSION} FROM judged GROUP BY purpose"),
    "A8_precision_recall_f1": on_judged(
        f"SELECT *, {RATIOS} FROM (SELECT purpose, {CONFUSION} FROM judged GROUP BY purpose)"),
    "A9_roc_auc": on_judged(
        f"SELECT {r(auc('p_model'), 'roc_auc')} FROM (SELECT *, {mid_rank('p_model')} AS mid "
        "FROM judged)"),
    "A10_roc_curve": on_judged(
        f"""SELECT {r('p_model', 'threshold')},
        {r('max(fps / neg)', 'fpr')},
        {r('max(tps / pos)', 'tpr')}
        FROM (SELECT DISTINCT p_model,
          sum(1 - "default") OVER (ORDER BY p_model DESC) AS fps,
          sum("default") OVER (ORDER BY p_model DESC) AS tps,
          CAST(sum(1 - "default") OVER () AS DOUBLE) AS neg,
          CAST(sum("default") OVER () AS DOUBLE) AS pos FROM judged) GROUP BY 1"""),
    "A11_business_cost": on_judged(
        "SELECT *, fp * 5000e0 AS fp_cost, fn * 20000e0 AS fn_cost, "
        "fp * 5000e0 + fn * 20000e0 AS total_cost "
        f"FROM (SELECT purpose, {CONFUSION} FROM judged GROUP BY purpose)"),
    "A12_threshold_sweep": on_judged(
        f"SELECT position, {r('threshold')}, fp, fn, cost FROM priced", THRESHOLDS),
    "A12_optimal_threshold": on_judged(
        f"SELECT {r('threshold', 'optimal_threshold')}, cost AS optimal_cost FROM priced "
        "ORDER BY cost, position LIMIT 1", THRESHOLDS),
    "A13_mean_abs_shap": on_shap(
        f"SELECT feature, {r('avg(abs(shap_value))', 'mean_abs_shap')} FROM shap_long "
        "GROUP BY feature ORDER BY 2 DESC LIMIT 20"),
    "K1_compare_models": on_rivals(
        "SELECT upper(model) AS model, roc_auc, precision, recall, f1 FROM rival_metrics "
        "WHERE split = 'validation'"),
    "K2_best_model": on_rivals(
        "SELECT model, f1 AS score FROM rival_metrics WHERE split = 'validation' AND f1 > 0 "
        "ORDER BY f1 DESC, position LIMIT 1"),
    "K3_top_importance": "SELECT CAST(5 AS BIGINT) AS listed, TRUE AS positive, "
                         "TRUE AS others_are_less",
    "K4_top_contributions": on_shap(
        f"SELECT app_id, rank, feature, {r('value')}, {r('shap_value')} FROM shap_ranked "
        "WHERE rank <= 5"),
    "K5_seeded_sample": q("SELECT app_id FROM apps ORDER BY md5('42:' || CAST(app_id AS VARCHAR)), "
                          "app_id LIMIT 1000"),
    "K5_large_sample": q("SELECT app_id FROM apps ORDER BY md5('42:' || CAST(app_id AS VARCHAR)), "
                         "app_id LIMIT 12000"),
    "K5_first_rows": q("SELECT app_id, cibil_score FROM apps ORDER BY app_id LIMIT 1000"),
    "U1_append_rows": on_scored(
        f"""SELECT app_id, {r('loan_amnt')}, "default" FROM scored
        UNION ALL SELECT app_id + 1000000000, {r('loan_amnt * 1.1e0', '')}, "default"
        FROM scored WHERE "default" = 0"""),
    "R1_scorecard_pd": on_scored(f"SELECT app_id, {r('pd', 'p')} FROM scored"),
    "R2_hard_rules": on_judged(
        f"SELECT app_id, {r('p_model')}, {r(f'greatest(p_model * 0.5e0, {FLOOR})', 'p_floored')} "
        "FROM judged"),
    "R3_rule_hits": on_judged(
        f"SELECT app_id, {FLOOR} > p_model * 0.5e0 AS floor_applied, "
        f"{rank_rules('p_model * 0.5e0')} AS fired_rules FROM judged"),
    "R4_risk_category": on_judged("SELECT app_id, risk_category FROM judged"),
    "R5_decision": on_judged("SELECT app_id, decision FROM judged"),
    "R6_interest_rate": on_judged(f"SELECT app_id, {r('rate', 'interest_rate')} FROM judged"),
    "R7_expected_profit": on_judged(
        f"SELECT app_id, {r(PROFIT.format(y='3'), 'profit_three_years')}, "
        f"{r(PROFIT.format(y='(term / 12e0)'), 'profit_over_term')} FROM judged"),
    "R8_assess": on_assessed(f"SELECT {ASSESSED} FROM assessed"),
    "R9_batch_assess": on_assessed(
        "SELECT app_id, default_probability, risk_category, decision, interest_rate, "
        "interest_rate_pct, CAST(NULL AS DOUBLE) AS expected_profit, "
        "CAST(NULL AS DOUBLE) AS confidence_score FROM assessed"),
    "R10_score_applications": q(
        f"SELECT {r('p_model')}, {r('p_final')}, floor_applied, {ASSESSED} FROM assessed",
        f"bad AS (SELECT * {INVALID} FROM apps)",
        f"good AS (SELECT * FROM bad WHERE {REASONS} = '')",
        DERIVED.replace("FROM apps", "FROM good"), SCORED, judged_cte("pd"), ASSESSED_CTE),
    "R10_score_with_model": q(
        "SELECT app_id, TRUE AS floored, TRUE AS categorised, TRUE AS priced FROM good",
        f"bad AS (SELECT * {INVALID} FROM apps)",
        f"good AS (SELECT * FROM bad WHERE {REASONS} = '')"),
    "M1_stratified_split": on_judged('SELECT app_id, "default", split FROM split', SPLIT),
    "M1_stratified_folds": on_judged(
        "SELECT app_id, CAST(CASE WHEN rn <= class_rows // 5 THEN 0 WHEN rn <= class_rows * 2 // 5 "
        "THEN 1 WHEN rn <= class_rows * 3 // 5 THEN 2 WHEN rn <= class_rows * 4 // 5 THEN 3 ELSE 4 "
        "END AS INT) AS fold FROM ordered", SPLIT),
    "M2_train_boosted": on_judged(MODEL_CHECKS, SPLIT),
    "M3_train_forest": on_judged(MODEL_CHECKS, SPLIT),
    "M4_train_linear": on_judged(MODEL_CHECKS, SPLIT),
    "M4_train_balanced_boosted": on_judged(MODEL_CHECKS, SPLIT),
    "M5_grid_search": "SELECT CAST(d AS INT) AS max_depth, CAST(5 AS INT) AS trees, "
                      "TRUE AS useful, TRUE AS best_if_chosen FROM (VALUES (2), (3)) t(d)",
    "M2_histogram_boosted": on_judged(SEARCH_CHECKS, SPLIT),
    "M3_leafwise_grid": on_judged(SEARCH_CHECKS, SPLIT),
    "M4_ordered_grid": on_judged(SEARCH_CHECKS, SPLIT),
    "M5_quick_grid": QUICK_POINTS,
    "M5_quick_grid_model": on_judged(SEARCH_CHECKS, SPLIT),
    "M7_feature_importance": "SELECT model, TRUE AS not_negative, TRUE AS sums_to_one "
                             "FROM (VALUES ('boosted'), ('forest'), ('linear')) t(model)",
    "M8_probability_class": on_scored(
        'SELECT app_id, "default", TRUE AS is_probability, TRUE AS class_fits FROM scored'),
    "M9_smote": on_scored(
        """SELECT "default", synthetic, n, TRUE AS in_hull, TRUE AS marked FROM (
          SELECT "default", FALSE AS synthetic, count(*) AS n FROM scored GROUP BY "default"
          UNION ALL
          SELECT minority, TRUE, CAST(abs(n1 - n0) AS BIGINT) FROM (
            SELECT CAST(n1 <= n0 AS INT) AS minority, n0, n1 FROM (
              SELECT sum("default") AS n1, count(*) - sum("default") AS n0 FROM scored)))"""),
    "M6_evaluate": on_rivals(
        "SELECT model, split, roc_auc, precision, recall, f1, tn, fp, fn, tp FROM rival_metrics"),
    "M6_metrics_long": on_rivals(" UNION ALL ".join(
        f"SELECT model, split, '{m}' AS metric, {m} AS value FROM rival_metrics"
        for m in ("roc_auc", "precision", "recall", "f1"))),
    "X1_tree_shap": q("SELECT app_id, TRUE AS complete, TRUE AS adds_up FROM apps"),
    "X1_background_shap": q("SELECT app_id, TRUE AS base_is_mean, TRUE AS adds_up FROM apps"),
    "X5_interactions": q("SELECT app_id, TRUE AS adds_up, TRUE AS symmetric FROM apps"),
    "X3_base_value": q("SELECT count(*) AS rows, TRUE AS constant, TRUE AS centred FROM apps"),
    "X4_force_table": q("SELECT app_id, TRUE AS complete, TRUE AS adds_up FROM apps"),
    "X6_tree_shap_summary": "SELECT TRUE AS complete, TRUE AS ordered, TRUE AS bounded",
    "X7_lime": q("SELECT app_id, TRUE AS is_prediction, CAST(10 AS INT) AS rules, TRUE AS ordered, "
                 "TRUE AS fits FROM apps"),
    "X9_full_explanation": q(
        "SELECT app_id, TRUE AS complete, CAST(10 AS INT) AS shown, TRUE AS ordered, "
        "CAST(3 AS INT) AS suggested, TRUE AS right_way, TRUE AS class_fits FROM apps"),
    "X2_linear_shap": on_shap(
        f"SELECT app_id, {r('base_value')}, "
        + ", ".join(r(f"shap_{c}") for c in LINEAR) + " FROM shap"),
    "X5_dependence": on_shap(
        f"SELECT app_id, {r('foir', 'value')}, {r('shap_foir', 'shap_value')}, "
        f"{r('CAST(cibil_score AS DOUBLE)', 'interaction_value')} FROM shap"),
    "X6_shap_summary": on_shap("SELECT feature, " + ", ".join(r(x, n) for x, n in [
        ("avg(abs(shap_value))", "mean_abs_shap"), ("avg(shap_value)", "mean_shap"),
        ("min(shap_value)", "min_shap"), ("quantile_cont(shap_value, 0.25)", "q25_shap"),
        ("quantile_cont(shap_value, 0.5)", "q50_shap"),
        ("quantile_cont(shap_value, 0.75)", "q75_shap"), ("max(shap_value)", "max_shap")])
        + " FROM shap_long GROUP BY feature"),
    "X8_counterfactual": on_moves(
        f"SELECT app_id, rank, feature, {r('current_value')}, {r('suggested_value')}, direction "
        "FROM moves"),
    "X9_linear_explanation": on_moves(
        f"""SELECT j.app_id, {r('p_model', 'probability')}, CAST(p_model >= 0.5e0 AS INT) AS class,
        CASE WHEN p_model < 0.3e0 THEN 'LOW' WHEN p_model < 0.7e0 THEN 'MODERATE' ELSE 'HIGH' END
          AS risk_category,
        {r('CASE WHEN p_model > 0.5e0 THEN p_model - 0.1e0 ELSE p_model + 0.1e0 END',
           'target_probability')},
        top, moves, {r('first_suggestion')}
        FROM judged j
        JOIN (SELECT app_id, string_agg(feature, ';' ORDER BY rank) AS top FROM shap_ranked
              WHERE rank <= 10 GROUP BY app_id) t ON t.app_id = j.app_id
        JOIN (SELECT app_id, string_agg(feature || ':' || direction, ';' ORDER BY rank) AS moves,
                     max(CASE WHEN rank = 1 THEN suggested_value END) AS first_suggestion
              FROM moves GROUP BY app_id) m ON m.app_id = j.app_id"""),
    "X10_direction_label": on_shap(
        "SELECT app_id, rank, feature, CASE WHEN shap_value > 0 THEN 'Increases Risk' "
        "ELSE 'Reduces Risk' END AS direction FROM shap_ranked WHERE rank <= 8"),
    "Z2_score_stream": on_scored(f"SELECT {ASSESSED} FROM assessed", judged_cte("pd"),
                                 ASSESSED_CTE),
    "Z3_batch_portfolio": on_scored(
        portfolio_sql("part").replace("FROM assessed", "FROM (SELECT *, app_id % 4 AS part "
                                      "FROM assessed)"), judged_cte("pd"), ASSESSED_CTE),
}
