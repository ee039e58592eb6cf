"""SQL each registered query is checked against, written from the definitions.

Plain windows and aggregates over the whole tables; nothing here knows how the
Spark side spreads the work.
"""

from __future__ import annotations

from holdfast.sources.derived import levels

# Fixed values, written out here so that a wrong list in the package shows: the columns of the five tables with
# their types, of the export with their names in the tables, and of the modeling dataset; the segments; payment methods.
TABLES = {
    "customers": {
        "customer_id": "bigint", "gender": "string", "senior_citizen": "int", "partner": "string", "dependents": "string",
        "tenure_months": "int", "contract_type": "string",
    },
    "services": {
        "customer_id": "bigint", "phone_service": "string", "multiple_lines": "string", "internet_service": "string",
        "online_security": "string", "online_backup": "string", "device_protection": "string", "tech_support": "string",
        "streaming_tv": "string", "streaming_movies": "string",
    },
    "billing": {
        "customer_id": "bigint", "monthly_charges": "double", "total_charges": "double", "payment_method": "string",
        "paperless_billing": "string", "customer_lifetime_value": "double",
    },
    "marketing": {"customer_id": "bigint", "marketing_offer_given": "int", "propensity_score": "double"},
    "churn_labels": {"customer_id": "bigint", "churn_label": "string", "churn_binary": "int"},
}
EXPORT = {
    "customerID": "customer_id", "gender": "gender", "SeniorCitizen": "senior_citizen", "Partner": "partner",
    "Dependents": "dependents", "tenure": "tenure_months", "PhoneService": "phone_service", "MultipleLines": "multiple_lines",
    "InternetService": "internet_service", "OnlineSecurity": "online_security", "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection", "TechSupport": "tech_support", "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies", "Contract": "contract_type", "PaperlessBilling": "paperless_billing",
    "PaymentMethod": "payment_method", "MonthlyCharges": "monthly_charges", "TotalCharges": "total_charges", "Churn": "churn_label",
}
MODELING_COLUMNS = [
    "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure_months", "contract_type", "internet_service",
    "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies", "phone_service",
    "num_premium_services", "monthly_charges", "total_charges", "payment_method", "paperless_billing", "clv", "treatment",
    "propensity_score", "churn_binary", "revenue_at_risk", "tenure_bucket",
]
QUADRANTS = ["Persuadable", "Sure Thing", "Lost Cause", "Sleeping Dog"]
PAYMENT_METHODS = ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"]


def R(expression: str, digits: int) -> str:
    """Half away from zero, once, on the shortest decimal that stands for the double."""
    return f"CAST(ROUND(CAST(CAST(CAST({expression} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def N(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


_PREMIUM = " + ".join(
    f"(CASE WHEN {name} = 'Yes' THEN 1 ELSE 0 END)"
    for name in ("online_security", "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies")
)
_BUCKET = (
    "CASE WHEN tenure_months <= 12 THEN '0-12 months' WHEN tenure_months <= 24 THEN '13-24 months' "
    "WHEN tenure_months <= 48 THEN '25-48 months' ELSE '49+ months' END"
)
_BAND = "CASE WHEN tenure_months <= 24 THEN '0-24' WHEN tenure_months <= 48 THEN '25-48' ELSE '49+' END"

_joined = (
    "SELECT *, customer_lifetime_value AS clv, marketing_offer_given AS treatment, "
    f"{_PREMIUM} AS num_premium_services, {R('monthly_charges * 12 * churn_binary', 2)} AS revenue_at_risk, "
    f"{_BUCKET} AS tenure_bucket FROM customers JOIN services USING (customer_id) JOIN billing USING (customer_id) "
    "JOIN marketing USING (customer_id) JOIN churn_labels USING (customer_id)"
)


def _quadrant(uplift: str, risk: str, threshold: str) -> str:
    return (
        f"CASE WHEN {uplift} > 0.01 AND {risk} > {threshold} THEN 'Persuadable' "
        f"WHEN {uplift} > 0.01 AND {risk} <= {threshold} THEN 'Sure Thing' "
        f"WHEN {uplift} < -0.01 THEN 'Sleeping Dog' ELSE 'Lost Cause' END"
    )


_CTES: dict[str, str] = dict(levels())
_CTES |= {name: f"SELECT {', '.join(columns)} FROM flat" for name, columns in TABLES.items()}
_CTES |= {
    "modeling": f"SELECT {', '.join(MODELING_COLUMNS)} FROM ({_joined})",
    "banded": f"SELECT *, {_BAND} AS tenure_band FROM modeling",
    "cells": (
        "SELECT contract_type, internet_service, tenure_band, "
        "AVG(CASE WHEN treatment = 0 THEN churn_binary END) AS mu_0_control, "
        "AVG(CASE WHEN treatment = 1 THEN churn_binary END) AS mu_1_treatment FROM banded GROUP BY ALL"
    ),
    "scored": (
        "SELECT banded.*, mu_0_control, mu_1_treatment, mu_0_control - mu_1_treatment AS uplift_score "
        "FROM banded JOIN cells USING (contract_type, internet_service, tenure_band)"
    ),
    "segmented": (
        "SELECT *, " + _quadrant("uplift_score", "mu_0_control", "(SELECT MEDIAN(mu_0_control) FROM scored)")
        + f" AS quadrant, {R('clv * uplift_score', 2)} AS value_at_risk FROM scored"
    ),
    "crossed_effects": (
        "SELECT contract_type, internet_service, "
        "AVG(CASE WHEN treatment = 1 THEN churn_binary - mu_0_control END) AS tau_1, "
        "AVG(CASE WHEN treatment = 0 THEN mu_1_treatment - churn_binary END) AS tau_0 FROM scored GROUP BY ALL"
    ),
    "paired": (
        "SELECT s.*, -(LEAST(0.95, GREATEST(0.05, propensity_score)) * tau_0 "
        "+ (1 - LEAST(0.95, GREATEST(0.05, propensity_score))) * tau_1) AS uplift_score_xl "
        "FROM scored s JOIN crossed_effects USING (contract_type, internet_service)"
    ),
    "long_scores": (
        "SELECT 'T-Learner' AS learner, customer_id, treatment AS t, churn_binary AS y, uplift_score AS score FROM paired "
        "UNION ALL SELECT 'X-Learner', customer_id, treatment, churn_binary, uplift_score_xl FROM paired"
    ),
    "ranked": (
        "SELECT *, ROW_NUMBER() OVER w AS k, COUNT(*) OVER (PARTITION BY learner) AS n, "
        "SUM(t) OVER w AS n_t, SUM(1 - t) OVER w AS n_c, SUM(t * y) OVER w AS y_t, SUM((1 - t) * y) OVER w AS y_c, "
        "AVG(CASE WHEN t = 0 THEN y END) OVER (PARTITION BY learner) "
        "- AVG(CASE WHEN t = 1 THEN y END) OVER (PARTITION BY learner) AS overall FROM long_scores "
        "WINDOW w AS (PARTITION BY learner ORDER BY score DESC NULLS LAST, customer_id ROWS UNBOUNDED PRECEDING)"
    ),
    "qini_points": (
        "SELECT learner, k, k / n AS fraction, (y_c / n_c - y_t / n_t) * (k / n) AS qini, overall * (k / n) AS random_qini "
        "FROM ranked WHERE (k - 1) % GREATEST(1, n // 100) = 0 AND n_t > 0 AND n_c > 0"
    ),
    "qini_areas": (
        "SELECT learner, (qini - random_qini + LAG(qini - random_qini) OVER w) / 2 * (fraction - LAG(fraction) OVER w) AS area "
        "FROM qini_points WINDOW w AS (PARTITION BY learner ORDER BY k)"
    ),
    "qini": "SELECT learner, COALESCE(SUM(area), 0) AS qini_coefficient FROM qini_areas GROUP BY learner",
    "gains": (
        "SELECT learner, k, k / n AS fraction, y_c / n_c - y_t / n_t AS gain FROM ranked "
        "WHERE k >= 100 AND (k - 100) % GREATEST(1, n // 100) = 0 AND n_t > 0 AND n_c > 0"
    ),
    "tops": (
        "SELECT learner, k_pct, MAX(n) * k_pct // 100 AS n_targeted, SUM(t) AS n_treated, SUM(1 - t) AS n_control, "
        "AVG(CASE WHEN t = 0 THEN y END) - AVG(CASE WHEN t = 1 THEN y END) AS raw_effect, MAX(overall) AS overall "
        "FROM ranked, (SELECT UNNEST([10, 20, 30, 40, 50]) AS k_pct) WHERE k <= n * k_pct // 100 GROUP BY learner, k_pct"
    ),
    "effects_at": (
        "SELECT learner, k_pct, CASE WHEN overall <> 0 THEN COALESCE(raw_effect, 0) ELSE 0 END AS effect, overall, "
        "n_targeted, n_treated, n_control FROM tops"
    ),
    "groups": (
        "SELECT 'gender' AS demographic, gender AS \"group\", * FROM segmented UNION ALL "
        "SELECT 'senior_label', CASE senior_citizen WHEN 0 THEN 'Non-Senior' WHEN 1 THEN 'Senior' END, * FROM segmented UNION ALL "
        "SELECT 'partner', partner, * FROM segmented"
    ),
    "rates": (
        "SELECT demographic, \"group\", COUNT(*) AS n_customers, "
        + ", ".join(
            f"100.0 * SUM(CASE WHEN quadrant = '{q}' THEN 1 ELSE 0 END) / COUNT(*) AS pct_{q.lower().replace(' ', '_')}"
            for q in QUADRANTS
        )
        + ", AVG(uplift_score) AS avg_uplift, AVG(clv) AS avg_clv FROM groups GROUP BY ALL"
    ),
    "weighted": (
        "SELECT *, treatment / LEAST(0.95::DOUBLE, GREATEST(0.05::DOUBLE, propensity_score)) AS w_treated, "
        "(1 - treatment) / (1 - LEAST(0.95::DOUBLE, GREATEST(0.05::DOUBLE, propensity_score))) AS w_control FROM modeling"
    ),
    "coded": "SELECT customer_id, treatment, w_treated, w_control, "
    + ", ".join(
        f"CAST(DENSE_RANK() OVER (ORDER BY {name}) - 1 AS DOUBLE) AS {name}"
        for name in ("contract_type", "internet_service", "payment_method", "partner", "dependents", "paperless_billing")
    )
    + ", tenure_months, monthly_charges, total_charges, senior_citizen, num_premium_services, clv FROM weighted",
    "eligible": "SELECT * FROM segmented WHERE quadrant = 'Persuadable' AND uplift_score >= 0.01",
    "chosen": "SELECT * FROM eligible ORDER BY value_at_risk DESC, customer_id LIMIT 100",
    "requests": (
        "SELECT * REPLACE (CASE WHEN customer_id % 10 = 0 THEN 'Cash' ELSE payment_method END AS payment_method, "
        "CASE WHEN customer_id % 11 = 0 THEN 99 ELSE tenure_months END AS tenure_months, "
        "CASE WHEN customer_id % 13 <> 0 THEN gender END AS gender, "
        "CASE WHEN customer_id % 19 = 0 THEN -1.0::DOUBLE ELSE total_charges END AS total_charges, "
        "CASE WHEN customer_id % 17 <> 0 THEN multiple_lines ELSE 'No' END AS multiple_lines) FROM flat"
    ),
    "judged": (
        "SELECT *, CONCAT_WS('; ', CASE WHEN gender IS NULL THEN 'gender is required' END, "
        "CASE WHEN tenure_months NOT BETWEEN 0 AND 72 THEN 'tenure_months is out of range' END, "
        "CASE WHEN total_charges < 0 THEN 'total_charges is out of range' END, "
        "CASE WHEN payment_method NOT IN ("
        + ", ".join(f"'{v}'" for v in PAYMENT_METHODS)
        + ") THEN 'payment_method is not an allowed value' END) AS errors FROM requests"
    ),
    "answers": (
        "SELECT r.customer_id, mu_0_control AS risk, mu_1_treatment AS offered, mu_0_control - mu_1_treatment AS uplift, "
        "monthly_charges * (LN(1 + tenure_months) * 3 + CASE contract_type WHEN 'Month-to-month' THEN 6 "
        "WHEN 'One year' THEN 14 WHEN 'Two year' THEN 26 ELSE 6 END) AS clv "
        f"FROM (SELECT *, {_BAND} AS tenure_band FROM judged WHERE errors = '') r "
        "JOIN cells USING (contract_type, internet_service, tenure_band)"
    ),
    "answered": (
        "SELECT *, " + _quadrant("uplift", "risk", "0.27") + f" AS quadrant, {R('clv * uplift', 2)} AS value_at_risk FROM answers"
    ),
    "responses": (
        f"SELECT CAST(customer_id AS VARCHAR) AS customer_id, {R('risk', 4)} AS churn_risk, "
        f"{R('offered', 4)} AS churn_risk_with_offer, {R('uplift', 4)} AS uplift_score, quadrant, "
        f"{R('clv', 2)} AS customer_lifetime_value, value_at_risk, CASE quadrant "
        "WHEN 'Persuadable' THEN 'HIGH PRIORITY: Target with retention offer. This customer has a ' "
        "|| format('{:.0f}', 100 * risk) || '% chance of churning without intervention, but the offer could reduce it by ' "
        "|| format('{:.0f}', 100 * uplift) || '%. Potential savings: $' || format('{:,.0f}', value_at_risk) || '.' "
        "WHEN 'Sure Thing' THEN 'LOW PRIORITY: Customer is likely to stay regardless. Churn risk is only ' "
        "|| format('{:.0f}', 100 * risk) || '%. Save your budget for Persuadable customers.' "
        "WHEN 'Sleeping Dog' THEN 'DO NOT CONTACT: Marketing outreach would INCREASE churn risk by ' "
        "|| format('{:.0f}', 100 * ABS(uplift)) || '%. This customer is better left alone. Contacting them could destroy $' "
        "|| format('{:,.0f}', ABS(value_at_risk)) || ' in value.' "
        "ELSE 'DEPRIORITIZE: Customer has ' || format('{:.0f}', 100 * risk) "
        "|| '% churn risk and the offer has minimal effect (uplift: ' || format('{:+.2f}', 100 * uplift) "
        "|| '%). Reallocate resources to Persuadable segment.' END AS recommendation, "
        "CASE WHEN ABS(uplift) > 0.15 THEN 'high' WHEN ABS(uplift) > 0.05 THEN 'medium' ELSE 'low' END AS confidence FROM answered"
    ),
}
_PREFIX = "WITH " + ", ".join(f"{name} AS ({text})" for name, text in _CTES.items()) + " "

ORACLES: dict[str, str] = {}


def oracle(name: str, text: str) -> None:
    ORACLES[name] = _PREFIX + text


# ------------------------------------------------------- sources and cleaning
_total_text = "CASE WHEN tenure_months = 0 THEN ' ' ELSE CAST(total_charges AS VARCHAR) END"
_raw = dict(EXPORT)
_raw |= {"TotalCharges": _total_text, "customerID": "CAST(customer_id AS VARCHAR)"}
oracle("customer_csv_round_trip", "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in _raw.items()) + " FROM flat")
_clean = {name: name for name in EXPORT.values()}
_clean |= {
    "customer_id": "CAST(customer_id AS VARCHAR)",
    "total_charges": "CASE WHEN tenure_months = 0 THEN 0 ELSE total_charges END",
    "churn_binary": "CASE churn_label WHEN 'Yes' THEN 1 ELSE 0 END",
}
oracle("cleaned_customers", "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _clean.items()) + " FROM flat")
oracle(
    "enriched_customers",
    "SELECT *, CASE WHEN risk_score > (SELECT QUANTILE_CONT(risk_score, 0.7) FROM risks) THEN 1 ELSE 0 END AS high_risk FROM risks"
    .replace(
        "risks",
        "(SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_lifetime_value, "
        + R(
            "LEAST(0.95, GREATEST(0.05, (CASE WHEN tenure_months < 24 THEN 0.3 ELSE 0 END) "
            "+ (CASE WHEN monthly_charges > 70 THEN 0.2 ELSE 0 END) "
            "+ (CASE WHEN contract_type = 'Month-to-month' THEN 0.3 ELSE 0 END) + churn_binary * 0.15))", 2,
        )
        + " AS risk_score FROM flat)",
    ),
)
_enriched = EXPORT | {
    "customerID": "CAST(customer_id AS VARCHAR)",
    "TotalCharges": "CASE WHEN tenure_months = 0 THEN 0 ELSE total_charges END",
    "Churn_Binary": "CASE churn_label WHEN 'Yes' THEN 1 ELSE 0 END",
    "Propensity_Score": "propensity_score",
    "Customer_Lifetime_Value": "customer_lifetime_value",
}
oracle("enriched_export", "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in _enriched.items()) + " FROM flat")
oracle(
    "enriched_export_checks",
    "SELECT *, n_bad = 0 AS passed FROM ("
    "SELECT 'Churn_Binary in 0,1' AS \"check\", COUNT(*) FILTER (churn_binary NOT IN (0, 1)) AS n_bad FROM flat UNION ALL "
    "SELECT 'Marketing_Offer_Given in 0,1', COUNT(*) FILTER (marketing_offer_given NOT IN (0, 1)) FROM flat UNION ALL "
    "SELECT 'Propensity_Score in [0,1]', COUNT(*) FILTER (propensity_score NOT BETWEEN 0 AND 1) FROM flat UNION ALL "
    "SELECT 'Customer_Lifetime_Value > 0', COUNT(*) FILTER (customer_lifetime_value <= 0) FROM flat UNION ALL "
    "SELECT 'customerID unique', COUNT(*) - COUNT(DISTINCT customer_id) FROM flat)",
)
for _name in TABLES:
    oracle(f"table_{_name}", f"SELECT * FROM {_name}")
oracle("table_refresh_and_append", "SELECT * FROM marketing")
oracle(
    "catalog_report",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", {i} AS position, '{column}' AS \"column\", "
        f"'{kind}' AS type, (SELECT COUNT(*) FROM {name}) AS n_rows"
        for name, columns in TABLES.items()
        for i, (column, kind) in enumerate(columns.items(), start=1)
    ),
)
oracle(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{name}' AS \"table\", COUNT(*) AS n_rows FROM {name}" for name in TABLES),
)
_LIMITS = {
    "customers": {"tenure_months >= 0": "tenure_months >= 0", "senior_citizen in 0,1": "senior_citizen IN (0, 1)"},
    "services": {},
    "billing": {
        "monthly_charges >= 0": "monthly_charges >= 0",
        "customer_lifetime_value > 0": "customer_lifetime_value > 0",
    },
    "marketing": {
        "marketing_offer_given in 0,1": "marketing_offer_given IN (0, 1)",
        "propensity_score in [0,1]": "propensity_score BETWEEN 0 AND 1",
    },
    "churn_labels": {"churn_binary in 0,1": "churn_binary IN (0, 1)"},
}
_checks = []
for _name, _columns in TABLES.items():
    _rules = {f"{c} not null": f"{c} IS NOT NULL" for c in _columns} | _LIMITS[_name]
    _checks += [
        f"SELECT '{_name}' AS \"table\", '{rule}' AS \"check\", COUNT(*) FILTER (NOT COALESCE({test}, FALSE)) AS n_bad FROM {_name}"
        for rule, test in _rules.items()
    ]
    _checks.append(
        f"SELECT '{_name}', 'customer_id unique', COUNT(*) - COUNT(DISTINCT customer_id) FROM {_name}"
    )
    if _name != "customers":
        _checks.append(
            f"SELECT '{_name}', 'customer_id known', COUNT(*) FROM {_name} c "
            "WHERE NOT EXISTS (SELECT 1 FROM customers p WHERE p.customer_id = c.customer_id)"
        )
oracle("table_checks", "SELECT *, n_bad = 0 AS passed FROM (" + " UNION ALL ".join(_checks) + ")")
oracle("table_checks_while_writing", "SELECT *, n_bad = 0 AS passed FROM (" + " UNION ALL ".join(_checks) + ")")

_NULLED = {
    "customers": ["customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure_months", "contract_type"],
    "services": [
        "customer_id", "phone_service", "multiple_lines", "internet_service", "online_security", "online_backup",
        "device_protection", "tech_support", "streaming_tv", "streaming_movies",
    ],
    "billing": ["customer_id", "monthly_charges", "total_charges", "payment_method", "paperless_billing", "customer_lifetime_value"],
    "marketing": ["customer_id", "marketing_offer_given", "propensity_score"],
    "churn_labels": ["customer_id", "churn_label", "churn_binary"],
}
_OUT = {
    "tenure_months": (50, "-1"), "senior_citizen": (51, "7"), "monthly_charges": (52, "-5.0::DOUBLE"),
    "customer_lifetime_value": (53, "0.0::DOUBLE"), "marketing_offer_given": (54, "2"), "propensity_score": (55, "1.5::DOUBLE"),
    "churn_binary": (56, "3"),
}
_dirty = []
for _name, _columns in _NULLED.items():
    _cells = []
    for _i, _column in enumerate(_columns):
        _wrong = f" WHEN customer_id % 101 = {_OUT[_column][0]} THEN {_OUT[_column][1]}" if _column in _OUT else ""
        _cells.append(f"CASE WHEN customer_id % 101 = {_i} THEN NULL{_wrong} ELSE {_column} END AS {_column}")
    _text = f"SELECT {', '.join(_cells)} FROM {_name} UNION ALL SELECT {', '.join(_columns)} FROM {_name} WHERE customer_id % 97 = 1"
    if _name != "customers":
        _text += f" UNION ALL SELECT customer_id + 10000000, {', '.join(_columns[1:])} FROM {_name} WHERE customer_id % 89 = 2"
    _dirty.append(f"dirty_{_name} AS ({_text})")
_PREFIX_DIRTY = _PREFIX.rstrip() + ", " + ", ".join(_dirty) + " "
_dirty_checks = []
for _name, _columns in _NULLED.items():
    _rules = {f"{c} not null": f"{c} IS NOT NULL" for c in _columns} | _LIMITS[_name]
    _dirty_checks += [
        f"SELECT '{_name}' AS \"table\", '{rule}' AS \"check\", COUNT(*) FILTER (NOT COALESCE({test}, FALSE)) AS n_bad FROM dirty_{_name}"
        for rule, test in _rules.items()
    ]
    _dirty_checks.append(
        f"SELECT '{_name}', 'customer_id unique', {N('SUM(n - 1)')} FROM (SELECT COUNT(*) AS n FROM dirty_{_name} GROUP BY customer_id)"
    )
    if _name != "customers":
        _dirty_checks.append(
            f"SELECT '{_name}', 'customer_id known', COUNT(*) FROM dirty_{_name} c "
            "WHERE NOT EXISTS (SELECT 1 FROM dirty_customers p WHERE p.customer_id = c.customer_id)"
        )
ORACLES["table_checks_of_broken_rows"] = _PREFIX_DIRTY + "SELECT *, n_bad = 0 AS passed FROM (" + " UNION ALL ".join(_dirty_checks) + ")"
ORACLES["null_total_of_broken_rows"] = (
    _PREFIX_DIRTY + "SELECT " + N(" + ".join(f"COUNT(*) FILTER ({c} IS NULL)" for c in _NULLED["services"])) + " AS n_nulls FROM dirty_services"
)
oracle(
    "offer_assignment",
    "SELECT customer_id, propensity_score, CASE WHEN CAST('0x' || substr(md5(customer_id || ':42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE "
    "< propensity_score THEN 1 ELSE 0 END AS offer FROM modeling",
)
oracle("modeling_export", "SELECT * FROM modeling")
oracle(
    "join_completeness",
    "SELECT n_joined, n_customers, n_joined = n_customers AS passed FROM "
    "(SELECT COUNT(*) AS n_joined FROM modeling), (SELECT COUNT(*) AS n_customers FROM customers)",
)
oracle(
    "null_total",
    "SELECT " + N(" + ".join(f"COUNT(*) FILTER ({c} IS NULL)" for c in MODELING_COLUMNS)) + " AS n_nulls FROM modeling",
)

# ------------------------------------------------------------------- reports
oracle("q1_modeling_dataset", "SELECT * FROM modeling")
_treated = "AVG(CASE WHEN treatment = 1 THEN churn_binary END)"
_control = "AVG(CASE WHEN treatment = 0 THEN churn_binary END)"
_exposure = R("SUM(monthly_charges * 12 * churn_binary)", 2)
oracle(
    "q2_tenure_cohorts",
    "SELECT CAST(tile AS INTEGER) AS tenure_decile, MIN(tenure_months) AS min_tenure, MAX(tenure_months) AS max_tenure, "
    f"COUNT(*) AS customer_count, {R('AVG(churn_binary) * 100', 1)} AS churn_rate_pct, "
    f"{R(_treated + ' * 100', 1)} AS treated_churn_pct, {R(_control + ' * 100', 1)} AS control_churn_pct, "
    f"{R('AVG(treatment) * 100', 1)} AS treatment_rate_pct, {R('AVG(clv)', 2)} AS avg_clv, {_exposure} AS total_revenue_at_risk "
    "FROM (SELECT *, NTILE(10) OVER (ORDER BY tenure_months, customer_id) AS tile FROM modeling) GROUP BY tile",
)
_arm = (
    f"COUNT(*) AS n_customers, {R('AVG(churn_binary) * 100', 2)} AS churn_rate_pct, {R('AVG(tenure_months)', 1)} AS avg_tenure, "
    f"{R('AVG(monthly_charges)', 2)} AS avg_monthly_charges, {R('AVG(clv)', 2)} AS avg_clv, "
    f"{R('AVG(propensity_score)', 4)} AS avg_propensity, {_exposure} AS total_revenue_at_risk FROM modeling WHERE treatment = "
)
_arms = f"SELECT 'Treatment' AS group_name, {_arm} 1 UNION ALL SELECT 'Control' AS group_name, {_arm} 0"
oracle("q3_treatment_comparison", _arms)
oracle("q3_treatment_comparison_union", _arms)
oracle(
    "q4_high_value_customers",
    "SELECT * FROM (SELECT customer_id, tenure_months, contract_type, monthly_charges, clv, treatment, propensity_score, "
    f"churn_binary, {R('monthly_charges * 12', 2)} AS annual_revenue, "
    "CAST(ROW_NUMBER() OVER (ORDER BY clv DESC, customer_id) AS INTEGER) AS clv_rank, "
    f"{R('PERCENT_RANK() OVER (ORDER BY clv DESC)', 4)} AS clv_percentile, "
    "LAG(clv, 1) OVER (ORDER BY clv DESC, customer_id) AS prev_customer_clv, "
    + R("SUM(monthly_charges * 12 * churn_binary) OVER (ORDER BY clv DESC, customer_id ROWS UNBOUNDED PRECEDING)", 2)
    + " AS cumulative_revenue_at_risk FROM modeling) WHERE clv_rank <= 100",
)
oracle(
    "q4_all_customers_by_value",
    "SELECT customer_id, tenure_months, contract_type, monthly_charges, clv, treatment, propensity_score, "
    f"churn_binary, {R('monthly_charges * 12', 2)} AS annual_revenue, "
    "ROW_NUMBER() OVER (ORDER BY clv DESC, customer_id) AS clv_rank, "
    f"{R('PERCENT_RANK() OVER (ORDER BY clv DESC)', 4)} AS clv_percentile, "
    "LAG(clv, 1) OVER (ORDER BY clv DESC, customer_id) AS prev_customer_clv, "
    + R("SUM(CAST(monthly_charges * 12 * churn_binary AS DECIMAL(18,4))) OVER (ORDER BY clv DESC, customer_id ROWS UNBOUNDED PRECEDING)", 2)
    + " AS cumulative_revenue_at_risk FROM modeling",
)
oracle("table_after_failed_refresh", "SELECT * FROM marketing JOIN billing USING (customer_id)")
oracle(
    "q5_segment_analysis",
    f"SELECT contract_type, internet_service, COUNT(*) AS n_customers, {R('AVG(churn_binary) * 100', 1)} AS churn_rate_pct, "
    f"{R('AVG(treatment) * 100', 1)} AS treatment_rate_pct, {R(_treated + ' * 100', 1)} AS treated_churn_pct, "
    f"{R(_control + ' * 100', 1)} AS control_churn_pct, {R('AVG(clv)', 2)} AS avg_clv, {_exposure} AS segment_revenue_at_risk "
    "FROM modeling GROUP BY contract_type, internet_service HAVING COUNT(*) >= 50",
)
oracle(
    "data_summary",
    f"SELECT COUNT(*) AS n_customers, {R('AVG(churn_binary)', 4)} AS churn_rate, {R('AVG(treatment)', 4)} AS offer_rate, "
    f"{R('AVG(clv)', 2)} AS avg_clv, {R('AVG(propensity_score)', 4)} AS avg_propensity, {R(_treated, 4)} AS treated_churn, "
    f"{R(_control, 4)} AS control_churn, {R(f'{_treated} - {_control}', 4)} AS naive_difference FROM modeling",
)
oracle("distinct_segments", "SELECT DISTINCT contract_type, internet_service FROM modeling")

# ------------------------------------------------------------- scale operators
oracle(
    "rank_all_customers",
    "SELECT customer_id, clv, ROW_NUMBER() OVER (ORDER BY clv DESC, customer_id) AS rank, COUNT(*) OVER () AS n_rows FROM modeling",
)
oracle(
    "rank_within_contract",
    "SELECT customer_id, contract_type, clv, ROW_NUMBER() OVER (PARTITION BY contract_type ORDER BY clv DESC, customer_id) AS rank, "
    "COUNT(*) OVER (PARTITION BY contract_type) AS n_rows FROM modeling",
)
oracle("tenure_tiles", "SELECT customer_id, CAST(NTILE(7) OVER (ORDER BY tenure_months, customer_id) AS INTEGER) AS tile FROM modeling")
oracle(
    "percentiles_by_contract",
    "SELECT contract_type, "
    + ", ".join(
        f"{R(f'QUANTILE_CONT(clv, {p})', 6)} AS {name}" for name, p in {"p10": 0.1, "median": 0.5, "p70": 0.7, "p99": 0.99}.items()
    )
    + " FROM modeling GROUP BY contract_type",
)
_prices = ", ".join(f"{R(f'QUANTILE_CONT(CAST(l_extendedprice AS DOUBLE), {p})', 6)} AS {name}" for name, p in {"p10": 0.1, "median": 0.5, "p99": 0.99}.items())
oracle(
    "percentiles_of_prices",
    f"SELECT 'all' AS l_returnflag, {_prices} FROM lineitem UNION ALL SELECT l_returnflag, {_prices} FROM lineitem GROUP BY l_returnflag",
)
oracle(
    "approximate_percentiles_within_promise",
    "SELECT contract_type, COUNT(*) AS n_rows, TRUE AS p10_within, TRUE AS median_within FROM modeling GROUP BY contract_type",
)
oracle(
    "merged_sketches_within_promise",
    "SELECT contract_type, COUNT(*) AS n_rows, TRUE AS p10_within, TRUE AS median_within, TRUE AS p99_within FROM modeling GROUP BY contract_type",
)
oracle(
    "prefix_counts",
    f"SELECT k, {N('n_treated')} AS n_treated, {N('n_churned')} AS n_churned, {N('a_t')} AS all_n_treated, "
    f"{N('a_c')} AS all_n_churned FROM (SELECT ROW_NUMBER() OVER w AS k, COUNT(*) OVER () AS n, SUM(treatment) OVER w AS n_treated, "
    "SUM(churn_binary) OVER w AS n_churned, SUM(treatment) OVER () AS a_t, SUM(churn_binary) OVER () AS a_c FROM modeling "
    "WINDOW w AS (ORDER BY clv DESC, customer_id ROWS UNBOUNDED PRECEDING)) WHERE k >= 100 AND (k - 100) % GREATEST(1, n // 100) = 0",
)
oracle("top_spenders", "SELECT customer_id, monthly_charges, clv FROM modeling ORDER BY monthly_charges DESC, customer_id LIMIT 50")

# ------------------------------------------------------------ closed-form uplift
oracle(
    "cell_means",
    f"SELECT contract_type, internet_service, tenure_band, {R('mu_0_control', 6)} AS mu_0_control, "
    f"{R('mu_1_treatment', 6)} AS mu_1_treatment FROM cells",
)
_scores = f"customer_id, {R('mu_0_control', 6)} AS mu_0_control, {R('mu_1_treatment', 6)} AS mu_1_treatment, {R('uplift_score', 6)} AS uplift_score"
oracle(
    "scored_customers",
    f"SELECT {_scores}, quadrant, value_at_risk, CASE WHEN ABS(uplift_score) > 0.15 THEN 'high' "
    "WHEN ABS(uplift_score) > 0.05 THEN 'medium' ELSE 'low' END AS confidence FROM segmented",
)
oracle(
    "scored_customers_serving_threshold",
    "SELECT customer_id, " + _quadrant("uplift_score", "mu_0_control", "0.27") + f" AS quadrant, {R('clv * uplift_score', 2)} AS value_at_risk FROM scored",
)
oracle(
    "scored_customers_crossed",
    f"SELECT customer_id, {R('mu_0_control', 6)} AS mu_0_xl, {R('mu_1_treatment', 6)} AS mu_1_xl, "
    f"{R('uplift_score_xl', 6)} AS uplift_score_xl, "
    + _quadrant("uplift_score_xl", "mu_0_control", "(SELECT MEDIAN(mu_0_control) FROM scored)")
    + f" AS quadrant_xl, {R('clv * uplift_score_xl', 2)} AS value_at_risk_xl FROM paired",
)
oracle(
    "paired_scores",
    f"SELECT customer_id, treatment, churn_binary, {R('uplift_score', 6)} AS uplift_score, {R('uplift_score_xl', 6)} AS uplift_score_xl FROM paired",
)
oracle(
    "score_distribution",
    f"SELECT COUNT(uplift_score) AS n_scored, {R('AVG(uplift_score)', 6)} AS mean_uplift, {R('MIN(uplift_score)', 6)} AS min_uplift, "
    f"{R('MAX(uplift_score)', 6)} AS max_uplift, {R('STDDEV_POP(uplift_score)', 6)} AS std_uplift, "
    "COUNT(*) FILTER (uplift_score > 0) AS n_positive, COUNT(*) FILTER (uplift_score < 0) AS n_negative, "
    f"{R('100.0 * COUNT(*) FILTER (uplift_score > 0) / COUNT(uplift_score)', 2)} AS pct_positive, "
    f"{R('100.0 * COUNT(*) FILTER (uplift_score < 0) / COUNT(uplift_score)', 2)} AS pct_negative, "
    f"{R('MEDIAN(uplift_score)', 6)} AS median_uplift FROM scored",
)
oracle(
    "quadrant_summary",
    f"SELECT quadrant, COUNT(*) AS n_customers, {R('AVG(uplift_score)', 4)} AS avg_uplift, {R('AVG(clv)', 2)} AS avg_clv, "
    f"{R('SUM(value_at_risk)', 2)} AS total_value_at_risk, {R('100.0 * COUNT(*) / (SELECT COUNT(*) FROM segmented)', 1)} AS pct_customers "
    "FROM segmented GROUP BY quadrant",
)
oracle("quadrant_counts", "SELECT quadrant, COUNT(*) AS n_customers FROM segmented GROUP BY quadrant")


def _value(quadrant: str) -> str:
    return f"COALESCE(SUM(value_at_risk) FILTER (quadrant = '{quadrant}'), 0)"


def _size(quadrant: str) -> str:
    return f"COUNT(*) FILTER (quadrant = '{quadrant}')"


oracle(
    "value_at_stake",
    f"SELECT {_size('Persuadable')} AS n_persuadable, {R(_value('Persuadable'), 2)} AS saveable_value, "
    f"{_size('Sleeping Dog')} AS n_sleeping_dog, {R('ABS(' + _value('Sleeping Dog') + ')', 2)} AS destroyable_value FROM segmented",
)
oracle("value_by_quadrant", f"SELECT quadrant, {R('SUM(value_at_risk)', 2)} AS total_value_at_risk FROM segmented GROUP BY quadrant")
oracle(
    "segment_deep_dive",
    " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, {name} AS segment, COUNT(*) AS customers, {R(R('AVG(churn_binary)', 4) + ' * 100', 1)} AS churn_rate_pct, "
        f"{R(R('AVG(uplift_score)', 4) + ' * 100', 2)} AS avg_uplift_pct, {R('SUM(value_at_risk)', 0)} AS total_value FROM segmented GROUP BY {name}"
        for name in ("contract_type", "internet_service")
    ),
)
oracle(
    "executive_kpis",
    f"SELECT {R('SUM(CASE WHEN churn_binary = 1 THEN revenue_at_risk ELSE 0 END)', 2)} AS total_revenue_at_risk, "
    f"{_size('Persuadable')} AS persuadable_count, {R(_value('Persuadable'), 2)} AS persuadable_value, "
    f"{_size('Sleeping Dog')} AS sleeping_dog_count, {R('ABS(' + _value('Sleeping Dog') + ')', 2)} AS sleeping_dog_value, "
    + R("COALESCE(AVG(uplift_score) FILTER (quadrant = 'Persuadable'), 0)", 4)
    + " AS avg_persuadable_uplift FROM segmented",
)

# ---------------------------------------------------------------- fairness
_pct = [f"pct_{q.lower().replace(' ', '_')}" for q in QUADRANTS]
oracle(
    "fairness_quadrant_rates",
    'SELECT demographic, "group", n_customers, ' + ", ".join(f"{R(p, 1)} AS {p}" for p in _pct)
    + f", {R('avg_uplift', 4)} AS avg_uplift, {R('avg_clv', 0)} AS avg_clv FROM rates",
)
oracle(
    "fairness_parity",
    f"SELECT demographic, {R('hi', 1)} AS max_rate, {R('lo', 1)} AS min_rate, {R('hi - lo', 1)} AS difference_pp, "
    f"{R('lo / hi', 3)} AS parity_ratio, CASE WHEN lo / hi >= 0.8 AND hi - lo < 10 THEN 'PASS' ELSE 'FLAG' END AS verdict "
    "FROM (SELECT demographic, COUNT(*) AS n, MAX(pct_persuadable) AS hi, MIN(pct_persuadable) AS lo FROM rates GROUP BY demographic) "
    "WHERE n >= 2 AND hi > 0",
)
oracle(
    "fairness_uplift_by_group",
    f'SELECT demographic, "group", {R("AVG(uplift_score)", 6)} AS mean_uplift, {R("MEDIAN(uplift_score)", 6)} AS median_uplift, '
    f'{R("STDDEV_SAMP(uplift_score)", 6)} AS std_uplift, COUNT(uplift_score) AS n_scored FROM groups GROUP BY ALL',
)
_gap = "(hi - lo) / (SELECT STDDEV_SAMP(uplift_score) FROM segmented)"
oracle(
    "fairness_uplift_gap",
    f"SELECT demographic, {R('hi - lo', 6)} AS max_difference, {R(_gap, 6)} AS effect_size, CASE WHEN {_gap} < 0.2 THEN 'negligible' "
    f"WHEN {_gap} < 0.5 THEN 'small' ELSE 'medium or large' END AS band "
    "FROM (SELECT demographic, MAX(avg_uplift) AS hi, MIN(avg_uplift) AS lo FROM rates GROUP BY demographic HAVING COUNT(*) >= 2)",
)
oracle(
    "fairness_persuadable_value",
    'SELECT p.*, ABS(pct_of_persuadables - pct_of_population) > 5 AS flagged FROM (SELECT demographic, "group", '
    f"COUNT(*) AS n_persuadable, {R('AVG(clv)', 2)} AS avg_clv, {R('SUM(value_at_risk)', 2)} AS total_value_at_risk, "
    f"{R('AVG(value_at_risk)', 2)} AS avg_value_at_risk, {R('AVG(uplift_score)', 2)} AS avg_uplift, "
    + R("100.0 * COUNT(*) / (SELECT COUNT(*) FROM segmented WHERE quadrant = 'Persuadable')", 1)
    + " AS pct_of_persuadables, "
    + R(
        '100.0 * (SELECT COUNT(*) FROM groups a WHERE a.demographic = g.demographic AND a."group" = g."group") '
        "/ (SELECT COUNT(*) FROM segmented)", 1,
    )
    + " AS pct_of_population FROM groups g WHERE quadrant = 'Persuadable' GROUP BY demographic, \"group\") p",
)
oracle(
    "fairness_report",
    f'SELECT r.demographic, r."group", n_customers, {R("pct_persuadable", 1)} AS pct_persuadable, '
    f'{R("pct_sleeping_dog", 1)} AS pct_sleeping_dog, {R("avg_uplift", 4)} AS mean_uplift, {R("avg_clv", 2)} AS mean_clv, '
    'total_value_at_risk FROM rates r JOIN (SELECT demographic, "group", '
    + R("SUM(value_at_risk)", 2)
    + ' AS total_value_at_risk FROM groups GROUP BY ALL) USING (demographic, "group")',
)

# ---------------------------------------------------------------- effects
_ipw_t, _ipw_c = "SUM(w_treated * churn_binary) / SUM(w_treated)", "SUM(w_control * churn_binary) / SUM(w_control)"
_effects = (
    f"(SELECT {_treated} AS nt, {_control} AS nc, {_ipw_t} AS it, {_ipw_c} AS ic FROM weighted)"
)
oracle(
    "ate_comparison",
    f"SELECT {R('nt', 6)} AS naive_treated_churn, {R('nc', 6)} AS naive_control_churn, {R('it', 6)} AS ipw_treated_churn, "
    f"{R('ic', 6)} AS ipw_control_churn, {R('nc - nt', 6)} AS naive_ate, {R('ic - it', 6)} AS ipw_ate, "
    f"{R('ABS((ic - it) - (nc - nt))', 6)} AS shift, CASE WHEN nc - nt > 0 THEN 'Offer REDUCES churn' ELSE 'Offer INCREASES churn' END "
    "AS naive_direction, CASE WHEN ic - it > 0 THEN 'Offer REDUCES churn' ELSE 'Offer INCREASES churn' END AS ipw_direction "
    f"FROM {_effects}",
)
oracle("inverse_weights", f"SELECT customer_id, {R('w_treated', 6)} AS w_treated, {R('w_control', 6)} AS w_control FROM weighted")
oracle(
    "weight_diagnostics",
    f"SELECT COUNT(*) AS n_rows, {R('AVG(w)', 4)} AS mean_weight, {R('MAX(w)', 4)} AS max_weight, {R('MIN(w)', 4)} AS min_weight, "
    f"{R('SUM(w) * SUM(w) / SUM(w * w)', 4)} AS effective_n FROM (SELECT w_treated + w_control AS w FROM weighted)",
)
_FEATURES = [
    "tenure_months", "monthly_charges", "total_charges", "senior_citizen", "contract_type", "internet_service",
    "payment_method", "partner", "dependents", "paperless_billing", "num_premium_services", "clv",
]
oracle("encoded_features", f"SELECT customer_id, {', '.join(_FEATURES)} FROM coded")
# The learners' features, in order; text ones take their place among the sorted values.
_NUMBERS = ["senior_citizen", "tenure_months", "num_premium_services", "monthly_charges", "total_charges", "clv", "propensity_score"]
_TEXTS = [
    "gender", "partner", "dependents", "contract_type", "internet_service", "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies", "phone_service", "payment_method", "paperless_billing",
]
_cell_rows = [f"SELECT customer_id, '{x}' AS feature, CAST({x} AS DOUBLE) AS value FROM modeling" for x in _NUMBERS]
_cell_rows += [f"SELECT customer_id, '{x}' AS feature, CAST(DENSE_RANK() OVER (ORDER BY {x}) - 1 AS DOUBLE) AS value FROM modeling" for x in _TEXTS]
oracle("feature_matrix", f"SELECT customer_id, feature, {R('value', 6)} AS value FROM ({' UNION ALL '.join(_cell_rows)})")
oracle(
    "fold_sizes",
    "SELECT treatment, CAST(place % 5 AS INTEGER) AS fold, COUNT(*) AS n_rows FROM (SELECT treatment, "
    "ROW_NUMBER() OVER (PARTITION BY treatment) AS place FROM modeling) GROUP BY treatment, place % 5",
)
oracle(
    "absent_tables",
    "SELECT 'customers' AS \"table\", COUNT(*) AS n_rows, CAST(NULL AS VARCHAR) AS advice FROM customers UNION ALL "
    "SELECT 'billing', COUNT(*), NULL FROM billing UNION ALL "
    "SELECT name, NULL, 'run write_tables first' FROM (VALUES ('services'), ('marketing'), ('churn_labels')) AS t(name)",
)
oracle(
    "encoded_unseen_values",
    "SELECT customer_id, CASE contract_type WHEN 'One year' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS code FROM modeling",
)
_smd = " UNION ALL ".join(
    f"SELECT '{x}' AS feature, SQRT((VAR_POP({x}) FILTER (treatment = 1) + VAR_POP({x}) FILTER (treatment = 0)) / 2) AS spread, "
    f"ABS(AVG({x}) FILTER (treatment = 1) - AVG({x}) FILTER (treatment = 0)) AS raw_gap, "
    f"ABS(SUM(w_treated * {x}) / SUM(w_treated) - SUM(w_control * {x}) / SUM(w_control)) AS ipw_gap FROM coded"
    for x in _FEATURES
)
_smd = (
    "(SELECT feature, CASE WHEN spread > 0 THEN raw_gap / spread ELSE 0 END AS r, "
    f"CASE WHEN spread > 0 THEN ipw_gap / spread ELSE 0 END AS w FROM ({_smd}))"
)
oracle(
    "covariate_balance",
    f"SELECT feature, {R('r', 6)} AS smd_raw, {R('w', 6)} AS smd_ipw, r < 0.1 AS balanced_before, w < 0.1 AS balanced_after FROM {_smd}",
)
oracle(
    "covariate_balance_summary",
    "SELECT COUNT(*) AS n_features, COUNT(*) FILTER (r < 0.1) AS n_balanced_before, COUNT(*) FILTER (w < 0.1) AS n_balanced_after, "
    f"COUNT(*) FILTER (w < 0.1) > COUNT(*) FILTER (r < 0.1) AS improved FROM {_smd}",
)

# ---------------------------------------------------------------- evaluation
oracle(
    "qini_curve",
    f"SELECT learner, k, {R('fraction', 6)} AS fraction, {R('qini', 6)} AS qini, {R('random_qini', 6)} AS random_qini FROM qini_points",
)
oracle("qini_coefficients", f"SELECT learner, {R('qini_coefficient', 6)} AS qini_coefficient FROM qini")
oracle(
    "uplift_at_k",
    f"SELECT learner, k_pct, {R('effect', 6)} AS effect, {R('COALESCE(effect / NULLIF(overall, 0), 0) * (k_pct / 100) * 100', 6)} AS capture_pct, "
    f"{N('n_targeted')} AS n_targeted, {N('n_treated')} AS n_treated, {N('n_control')} AS n_control FROM effects_at",
)
oracle("cumulative_gain", f"SELECT learner, k, {R('fraction', 6)} AS fraction, {R('gain', 6)} AS gain FROM gains")
oracle(
    "learner_report",
    f"SELECT s.learner AS model, {R('qini_coefficient', 6)} AS qini_coefficient, {R('AVG(score)', 4)} AS mean_uplift, "
    f"{R('MEDIAN(score)', 4)} AS median_uplift, {R('STDDEV_POP(score)', 4)} AS std_uplift, "
    f"{R('100.0 * COUNT(*) FILTER (score > 0) / COUNT(score)', 1)} AS pct_positive_uplift, "
    + ", ".join(
        R(f"(SELECT MAX(effect) FROM effects_at e WHERE e.learner = s.learner AND k_pct = {k})", 4) + f" AS uplift_at_{k}"
        for k in (10, 20, 50)
    )
    + " FROM long_scores s JOIN qini USING (learner) GROUP BY s.learner, qini_coefficient",
)
_corr = "(SELECT CORR(uplift_score, uplift_score_xl) FROM paired)"
_agree = f"CASE WHEN {_corr} > 0.7 THEN 'High agreement' ELSE 'Methods disagree significantly' END"
_sides = []
for _side, _learner in (("first", "T-Learner"), ("second", "X-Learner")):
    _sides.append(f"(SELECT qini_coefficient FROM qini WHERE learner = '{_learner}') AS qini_{_side}")
    _sides += [
        f"(SELECT effect FROM effects_at WHERE learner = '{_learner}' AND k_pct = {k}) AS effect_{k}_{_side}" for k in (10, 20, 30, 40, 50)
    ]
    _sides.append(f"(SELECT ARG_MIN(gain, k) FROM gains WHERE learner = '{_learner}' HAVING COUNT(*) > 1) AS first_gain_{_side}")
    _sides.append(f"(SELECT ARG_MAX(gain, k) FROM gains WHERE learner = '{_learner}' HAVING COUNT(*) > 1) AS last_gain_{_side}")
_names = [side.rsplit(" AS ", 1)[1] for side in _sides]
_better = "CASE WHEN qini_first > qini_second THEN 'T-Learner' ELSE 'X-Learner' END"
oracle(
    "compare_learners",
    "SELECT " + ", ".join(f"{R(name, 6)} AS {name}" for name in _names)
    + f", {R(_corr, 4)} AS correlation, {_agree} AS agreement, {_better} AS winner, "
    f"CASE WHEN ABS(qini_first - qini_second) < 0.001 THEN 'T-Learner' ELSE {_better} END AS recommended FROM (SELECT {', '.join(_sides)})",
)
oracle("score_correlation", f"SELECT {R(_corr, 4)} AS correlation, {_agree} AS agreement")

# ---------------------------------------------------------------- campaigns
_list = f"customer_id, contract_type, internet_service, tenure_months, monthly_charges, clv, {R('uplift_score', 6)} AS uplift_score, quadrant, value_at_risk"
oracle("campaign_targets", f"SELECT {_list} FROM chosen")
oracle(
    "campaign_targets_filtered",
    f"SELECT {_list} FROM (SELECT * FROM eligible WHERE uplift_score >= 0.05 AND contract_type IN ('Month-to-month', 'One year') "
    "AND internet_service IN ('Fiber optic') ORDER BY value_at_risk DESC, customer_id LIMIT 100)",
)
oracle("written_targets", f"SELECT {_list} FROM chosen")
oracle(
    "campaign_targets_large",
    "SELECT ROW_NUMBER() OVER (ORDER BY value_at_risk DESC, customer_id) AS place, customer_id, value_at_risk FROM eligible",
)
_roi = "COALESCE((savings / NULLIF(n * 25, 0) - 1) * 100, 0)"
oracle(
    "campaign_return",
    f"SELECT n AS n_selected, m AS n_eligible, m - n AS n_remaining, CAST(n * 25 AS DOUBLE) AS campaign_cost, {R('savings', 2)} AS projected_savings, "
    f"{R(_roi, 1)} AS roi_pct, {R('savings / NULLIF(n * 25, 0)', 2)} AS saved_per_dollar, CASE WHEN {_roi} > 100 THEN 'excellent' "
    f"WHEN {_roi} > 0 THEN 'positive' ELSE 'negative' END AS verdict FROM (SELECT COUNT(*) AS n, COALESCE(SUM(value_at_risk), 0) AS savings "
    "FROM chosen), (SELECT COUNT(*) AS m FROM eligible)",
)
oracle(
    "campaign_list_display",
    "SELECT customer_id, contract_type, internet_service, tenure_months, format('${:.2f}', monthly_charges) AS monthly_charges, "
    "format('${:,.0f}', clv) AS clv, format('{:.1f}%', 100 * uplift_score) AS uplift_score, quadrant, "
    "format('${:,.0f}', value_at_risk) AS value_at_risk FROM (SELECT * FROM chosen ORDER BY value_at_risk DESC, customer_id LIMIT 50)",
)

# ------------------------------------------------------------------- scoring
_errors = "SELECT CAST(customer_id AS VARCHAR) AS customer_id, errors FROM judged WHERE errors <> ''"
oracle("request_errors", _errors)
oracle("streamed_quarantine", _errors)
# Allowed texts and ranges of a request, field by field, in order.
_YES_NO, _ADD_ON = "'Yes', 'No'", "'Yes', 'No', 'No internet service'"
_FIELDS = [
    ("gender", None, None, "'??'"), ("senior_citizen", None, "BETWEEN 0 AND 1", "7"), ("partner", _YES_NO, None, "'??'"),
    ("dependents", _YES_NO, None, "'??'"), ("tenure_months", None, "BETWEEN 0 AND 72", "99"),
    ("contract_type", "'Month-to-month', 'One year', 'Two year'", None, "'??'"), ("internet_service", "'DSL', 'Fiber optic', 'No'", None, "'??'"),
    ("online_security", _ADD_ON, None, "'??'"), ("online_backup", _ADD_ON, None, "'??'"), ("device_protection", _ADD_ON, None, "'??'"),
    ("tech_support", _ADD_ON, None, "'??'"), ("streaming_tv", _ADD_ON, None, "'??'"), ("streaming_movies", _ADD_ON, None, "'??'"),
    ("phone_service", _YES_NO, None, "'??'"), ("multiple_lines", "'Yes', 'No', 'No phone service'", None, "'??'"),
    ("monthly_charges", None, "BETWEEN 0 AND 200", "500.0"), ("total_charges", None, ">= 0", "-1.0"),
    ("payment_method", "'Electronic check', 'Mailed check', 'Bank transfer (automatic)', 'Credit card (automatic)'", None, "'??'"),
    ("paperless_billing", _YES_NO, None, "'??'"),
]
_cells, _wrongs = [], []
for _i, (_field, _allowed, _range, _bad) in enumerate(_FIELDS):
    _cell = f"CASE WHEN customer_id % 101 = {_i} THEN NULL WHEN customer_id % 101 = {40 + _i} THEN {_bad} ELSE {_field} END"
    _cells.append((f"COALESCE({_cell}, 'No')" if _field == "multiple_lines" else _cell) + f" AS {_field}")
    _wrongs.append(f"CASE WHEN {_field} IS NULL THEN '{_field} is required' END")
    if _allowed:
        _wrongs.append(f"CASE WHEN {_field} NOT IN ({_allowed}) THEN '{_field} is not an allowed value' END")
    if _range:
        _wrongs.append(f"CASE WHEN NOT ({_field} {_range}) THEN '{_field} is out of range' END")
oracle(
    "request_errors_of_every_rule",
    f"SELECT * FROM (SELECT customer_id, CONCAT_WS('; ', {', '.join(_wrongs)}) AS errors "
    f"FROM (SELECT CAST(customer_id AS VARCHAR) AS customer_id, {', '.join(_cells)} FROM flat)) WHERE errors <> ''",
)
_odd = {
    "tenure_months": ("customer_id % 23 = 0", "'soon'", "customer_id % 23 = 1", "'12.5'"),
    "monthly_charges": ("customer_id % 29 = 0", "'$20'", "FALSE", "''"), "senior_citizen": ("customer_id % 31 = 0", "'no'", "FALSE", "''"),
}
_line_wrongs = []
for _field, _allowed, _range, _ in _FIELDS:
    _sent, _is_odd = _field, "FALSE"
    if _field in _odd:
        _a, _, _b, _ = _odd[_field]
        _is_odd = f"({_a} OR {_b})"
        _line_wrongs.append(f"CASE WHEN {_is_odd} THEN '{_field} has the wrong type' END")
    if _field == "tenure_months":
        _sent = "CASE WHEN customer_id % 23 <= 2 THEN NULL ELSE tenure_months END"
    if _field == "monthly_charges":
        _sent = "CASE WHEN customer_id % 29 = 0 THEN NULL ELSE monthly_charges END"
    if _field == "senior_citizen":
        _sent = "CASE WHEN customer_id % 31 <= 1 THEN NULL ELSE senior_citizen END"
    if _field == "multiple_lines":
        _sent = "COALESCE(multiple_lines, 'No')"
    _line_wrongs.append(f"CASE WHEN ({_sent}) IS NULL AND NOT {_is_odd} THEN '{_field} is required' END")
    if _allowed:
        _line_wrongs.append(f"CASE WHEN ({_sent}) NOT IN ({_allowed}) THEN '{_field} is not an allowed value' END")
    if _range:
        _line_wrongs.append(f"CASE WHEN NOT (({_sent}) {_range}) THEN '{_field} is out of range' END")
_odd_texts = ", ".join(f"CASE WHEN {a} THEN {x} WHEN {b} THEN {y} END" for _, (a, x, b, y) in sorted(_odd.items()))
oracle(
    "request_errors_of_lines",
    "SELECT CASE WHEN customer_id % 37 <> 0 THEN CAST(customer_id AS VARCHAR) END AS customer_id, "
    f"CASE WHEN customer_id % 37 = 0 THEN 'the record cannot be read' ELSE CONCAT_WS('; ', {', '.join(_line_wrongs)}) END AS errors, "
    f"CASE WHEN customer_id % 37 = 0 THEN '' ELSE CONCAT_WS('|', {_odd_texts}) END AS texts "
    f"FROM flat WHERE customer_id % 37 = 0 OR CONCAT_WS('; ', {', '.join(_line_wrongs)}) <> ''",
)
oracle("scored_requests", "SELECT * FROM responses")
oracle("streamed_scores", "SELECT * FROM responses")
_totals = (
    f"SELECT COUNT(*) AS total_customers, {R('COALESCE(SUM(value_at_risk), 0)', 2)} AS total_revenue_at_risk, "
    f"{_size('Persuadable')} AS persuadable_count, {R(_value('Persuadable'), 2)} AS persuadable_revenue, "
    f"{_size('Sleeping Dog')} AS sleeping_dog_count FROM answered"
)
oracle("batch_totals", _totals)
oracle("streamed_totals", _totals)
_promises = {
    "churn_risk in [0,1]": "churn_risk BETWEEN 0 AND 1",
    "churn_risk_with_offer in [0,1]": "churn_risk_with_offer BETWEEN 0 AND 1",
    "uplift_score not null": "uplift_score IS NOT NULL",
    "quadrant known": "quadrant IN (" + ", ".join(f"'{q}'" for q in QUADRANTS) + ")",
    "customer_lifetime_value >= 0": "customer_lifetime_value >= 0",
    "value_at_risk not null": "value_at_risk IS NOT NULL",
    "confidence known": "confidence IN ('high', 'medium', 'low')",
}
oracle(
    "response_checks",
    "SELECT *, n_bad = 0 AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", COUNT(*) FILTER (NOT COALESCE({test}, FALSE)) AS n_bad FROM responses" for name, test in _promises.items()
    )
    + ")",
)

ORACLES["written_model_report"] = ORACLES["learner_report"]
ORACLES["written_fairness_report"] = ORACLES["fairness_report"]

# ------------------------------------------------- fitted models, held against themselves
_zero = "CAST(0 AS BIGINT)"
oracle("fitted_scores_consistent", f"SELECT COUNT(*) AS n_rows, {_zero} AS n_uplift, {_zero} AS n_quadrant, {_zero} AS n_value FROM modeling")
oracle("saved_learner_consistent", f"SELECT COUNT(*) AS n_rows, {_zero} AS n_differ FROM judged WHERE errors = ''")
oracle(
    "fitted_logistic_moments",
    f"SELECT term, COUNT(*) AS n_rows, TRUE AS met FROM modeling, (SELECT unnest(['intercept', {', '.join(repr(x) for x in _FEATURES)}]) AS term) GROUP BY term",
)
oracle(
    "fitted_auc_by_rank_sum",
    f"SELECT 'control' AS model, COUNT(*) AS n_rows, {N('SUM(churn_binary)')} AS n_positive, TRUE AS agrees FROM modeling WHERE treatment = 0 UNION ALL "
    f"SELECT 'treated', COUNT(*), {N('SUM(churn_binary)')}, TRUE FROM modeling WHERE treatment = 1 UNION ALL "
    f"SELECT 'propensity', COUNT(*), {N('SUM(treatment)')}, TRUE FROM modeling",
)
oracle(
    "fitted_propensity_moments",
    f"SELECT COUNT(*) AS n_rows, {N('SUM(treatment)')} AS n_treated, TRUE AS sums_to_treated, {_zero} AS n_outside FROM modeling",
)
_part = "CAST(customer_id AS BIGINT) % 101"
_changed = {
    "churn_risk": (0, "1.5"), "churn_risk_with_offer": (2, "-0.1"), "uplift_score": (3, "NULL"), "quadrant": (4, "'Nobody'"),
    "customer_lifetime_value": (5, "-1.0"), "value_at_risk": (6, "NULL"), "confidence": (7, "'sure'"),
}
_replaced = ", ".join(f"CASE WHEN {_part} = {k} THEN {v} ELSE {name} END AS {name}" for name, (k, v) in _changed.items())
oracle(
    "response_checks_of_broken_rows",
    "SELECT *, n_bad = 0 AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", COUNT(*) FILTER (NOT COALESCE({test}, FALSE)) AS n_bad FROM (SELECT * REPLACE ({_replaced}) FROM responses)"
        for name, test in _promises.items()
    )
    + ")",
)
