"""Fixed values that must equal the reference pipeline's for the same results.

They are the raw feed's type hints, its PII column list, its quarantine rule
list, the default rule list used to preview quarantine reasons, silver's casts,
and the text templates of the deterministic fallbacks.
"""

# --- fixed values (kept as the reference states them) -----------------------
SCHEMA_HINTS: dict[str, str] = {
    "TransactionID": "string",
    "AccountID": "string",
    "TransactionAmount": "double",
    "TransactionDate": "timestamp",
    "TransactionType": "string",
    "Location": "string",
    "DeviceID": "string",
    "IP Address": "string",
    "MerchantID": "string",
    "Channel": "string",
    "CustomerAge": "integer",
    "CustomerOccupation": "string",
    "TransactionDuration": "integer",
    "LoginAttempts": "integer",
    "AccountBalance": "double",
    "PreviousTransactionDate": "timestamp",
}

PII_COLUMNS = ["AccountID", "MerchantID", "Location", "DeviceID", "IP Address"]

QUARANTINE_RULES = [
    "TransactionID IS NULL",
    "TransactionAmount IS NULL",
    "TransactionDate IS NULL",
    "AccountID IS NULL",
    "CAST(TransactionAmount AS DOUBLE) < 0",
    "CAST(LoginAttempts AS INT) < 0",
]

DEFAULT_REASON_RULES = ["amount IS NULL", "transaction_date IS NULL", "is_fraud NOT IN (0, 1)"]

# Silver's defensive casts (column → target type); every other column passes through.
SILVER_CASTS = {
    "TransactionAmount": "double",
    "TransactionDate": "date",
    "CustomerAge": "int",
    "LoginAttempts": "int",
    "AccountBalance": "double",
    "TransactionDuration": "int",
    "PreviousTransactionDate": "date",
}

PIPELINE_VERSION = "1.0"

ANSWER_PREFIX = "Fallback answer based on retrieved Gold summaries: "
ANSWER_SUFFIX = " | Suggested next step: validate the top-risk merchants in the Gold merchant summary."
GOLD_SUMMARY_FALLBACK = "Fallback summary: review merchant spikes, high-risk users, and rolling velocity anomalies."
ALERT_FALLBACK = ("Fallback executive alert: fraud volume has breached the statistical control band "
                  "and requires analyst review.")
# ------------------------------------------------------------------------------

# Business names the landing stage needs (the reference's default mapping only
# lower-cases names, which never yields them; see SURVEY D8).
BUSINESS_MAPPING = {
    "transactionid": "transaction_id",
    "accountid": "account_id",
    "transactionamount": "amount",
    "transactiondate": "transaction_date",
    "transactiontype": "transaction_type",
    "merchantid": "merchant_id",
}

# --- fixed values: the three demo questions asked of the retrieval stage ------
DEMO_QUESTIONS = [
    "Which merchant has the most fraud?",
    "Which users have rising transaction velocity?",
    "Summarize the highest-risk regions from the Gold tables.",
]
