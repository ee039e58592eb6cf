"""Explicit schemas: nothing is inferred on a read path."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _L = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Column names and order of the customer export.
RAW_CUSTOMERS = _struct(
    ("customerID", _S), ("gender", _S), ("SeniorCitizen", _I), ("Partner", _S),
    ("Dependents", _S), ("tenure", _I), ("PhoneService", _S), ("MultipleLines", _S),
    ("InternetService", _S), ("OnlineSecurity", _S), ("OnlineBackup", _S),
    ("DeviceProtection", _S), ("TechSupport", _S), ("StreamingTV", _S),
    ("StreamingMovies", _S), ("Contract", _S), ("PaperlessBilling", _S),
    ("PaymentMethod", _S), ("MonthlyCharges", _D), ("TotalCharges", _S), ("Churn", _S),
)

# Columns the enrichment step adds to the export.
ENRICHED_COLUMNS = ["Churn_Binary", "Propensity_Score", "Marketing_Offer_Given", "Customer_Lifetime_Value"]

# Export name to table column name.
SNAKE_CASE = {
    "customerID": "customer_id",
    "gender": "gender",
    "SeniorCitizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "tenure": "tenure_months",
    "PhoneService": "phone_service",
    "MultipleLines": "multiple_lines",
    "InternetService": "internet_service",
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
    "Contract": "contract_type",
    "PaperlessBilling": "paperless_billing",
    "PaymentMethod": "payment_method",
    "MonthlyCharges": "monthly_charges",
    "TotalCharges": "total_charges",
    "Churn": "churn_label",
    "Churn_Binary": "churn_binary",
    "Propensity_Score": "propensity_score",
    "Marketing_Offer_Given": "marketing_offer_given",
    "Customer_Lifetime_Value": "customer_lifetime_value",
}

# The five tables, all keyed by customer_id.
TABLES = {
    "customers": _struct(
        ("customer_id", _L), ("gender", _S), ("senior_citizen", _I), ("partner", _S),
        ("dependents", _S), ("tenure_months", _I), ("contract_type", _S),
    ),
    "services": _struct(
        ("customer_id", _L), ("phone_service", _S), ("multiple_lines", _S),
        ("internet_service", _S), ("online_security", _S), ("online_backup", _S),
        ("device_protection", _S), ("tech_support", _S), ("streaming_tv", _S),
        ("streaming_movies", _S),
    ),
    "billing": _struct(
        ("customer_id", _L), ("monthly_charges", _D), ("total_charges", _D),
        ("payment_method", _S), ("paperless_billing", _S), ("customer_lifetime_value", _D),
    ),
    "marketing": _struct(("customer_id", _L), ("marketing_offer_given", _I), ("propensity_score", _D)),
    "churn_labels": _struct(("customer_id", _L), ("churn_label", _S), ("churn_binary", _I)),
}

# Add-on services counted as premium.
PREMIUM_SERVICES = [
    "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies",
]

# Column order of the modeling dataset.
MODELING_COLUMNS = [
    "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure_months",
    "contract_type", "internet_service", "online_security", "online_backup",
    "device_protection", "tech_support", "streaming_tv", "streaming_movies",
    "phone_service", "num_premium_services", "monthly_charges", "total_charges",
    "payment_method", "paperless_billing", "clv", "treatment", "propensity_score",
    "churn_binary", "revenue_at_risk", "tenure_bucket",
]

# A scoring request. customer_id is carried when the caller has one.
REQUEST = _struct(
    ("customer_id", _S), ("gender", _S), ("senior_citizen", _I), ("partner", _S),
    ("dependents", _S), ("tenure_months", _I), ("contract_type", _S),
    ("internet_service", _S), ("online_security", _S), ("online_backup", _S),
    ("device_protection", _S), ("tech_support", _S), ("streaming_tv", _S),
    ("streaming_movies", _S), ("phone_service", _S), ("multiple_lines", _S),
    ("monthly_charges", _D), ("total_charges", _D), ("payment_method", _S),
    ("paperless_billing", _S),
)

# Allowed values of request fields.
YES_NO = ["Yes", "No"]
ADD_ON = ["Yes", "No", "No internet service"]
REQUEST_VALUES = {
    "partner": YES_NO,
    "dependents": YES_NO,
    "contract_type": ["Month-to-month", "One year", "Two year"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "online_security": ADD_ON,
    "online_backup": ADD_ON,
    "device_protection": ADD_ON,
    "tech_support": ADD_ON,
    "streaming_tv": ADD_ON,
    "streaming_movies": ADD_ON,
    "phone_service": YES_NO,
    "multiple_lines": ["Yes", "No", "No phone service"],
    "payment_method": [
        "Electronic check", "Mailed check",
        "Bank transfer (automatic)", "Credit card (automatic)",
    ],
    "paperless_billing": YES_NO,
}
REQUEST_RANGES = {
    "senior_citizen": (0, 1),
    "tenure_months": (0, 72),
    "monthly_charges": (0, 200),
    "total_charges": (0, None),
}
REQUEST_DEFAULTS = {"multiple_lines": "No"}

QUADRANTS = ["Persuadable", "Sure Thing", "Lost Cause", "Sleeping Dog"]
