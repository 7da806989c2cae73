"""DuckDB SQL oracles, one per registered query.

Each string runs on DuckDB with the driver tables registered as views. Shared
CTEs (``txn``, ``raw_txn``) are spelled once here and prefixed to the queries
that need them. Doubles are rounded to 6 places to match ``rounded``.
"""

from __future__ import annotations

TXN_CTE = """txn AS (
  SELECT event_id AS tr_id,
         CAST(ts AS DATE) AS tr_date,
         ts AS tr_timestamp,
         sha256(CAST(user_id AS VARCHAR)) AS account_hash,
         sha256(json_extract_string(props, '$.k')) AS merchant_hash,
         value AS amount,
         CAST(event_type = 'error' AS INTEGER) AS is_fraud,
         event_type AS transaction_type,
         'LOC_' || CAST(user_id % 25 AS VARCHAR) AS location
  FROM events)"""

RAW_BASE_CTE = """raw_base AS (
  SELECT CASE WHEN event_id % 71 = 0 THEN 'null_id'
              WHEN event_id % 73 = 0 THEN 'duplicate'
              WHEN event_id % 79 = 0 THEN 'negative_amount'
              WHEN event_id % 83 = 0 THEN 'future_date'
              WHEN event_id % 89 = 0 THEN 'bad_date'
              WHEN event_id % 97 = 0 THEN 'bad_amount'
              WHEN event_id % 101 = 0 THEN 'null_amount'
              ELSE 'none' END AS _kind,
         event_id, user_id, ts, value, event_type, props
  FROM events),
raw_txn AS (
  SELECT CASE WHEN _kind = 'null_id' THEN NULL ELSE 'TX' || CAST(event_id AS VARCHAR) END AS "TransactionID",
         'AC' || CAST(user_id AS VARCHAR) AS "AccountID",
         CASE WHEN _kind = 'negative_amount' THEN '-5.0'
              WHEN _kind = 'bad_amount' THEN 'bad-amount'
              WHEN _kind = 'null_amount' THEN NULL
              WHEN value > 0 THEN CAST(CAST(value AS DECIMAL(38,2)) AS VARCHAR) || CAST(event_id % 10 AS VARCHAR)
              ELSE CAST(CAST(value AS DECIMAL(38,2)) AS VARCHAR) END AS "TransactionAmount",
         CASE WHEN _kind = 'future_date' THEN '2999-01-01'
              WHEN _kind = 'bad_date' THEN 'unknown'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "TransactionDate",
         event_type AS "TransactionType",
         'LOC_' || CAST(user_id % 25 AS VARCHAR) AS "Location",
         'D' || CAST(user_id % 40 AS VARCHAR) AS "DeviceID",
         '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS "IP Address",
         'M' || json_extract_string(props, '$.k') AS "MerchantID",
         CASE WHEN event_id % 3 = 0 THEN 'Online' WHEN event_id % 3 = 1 THEN 'ATM' ELSE 'Branch' END AS "Channel",
         CAST(18 + user_id % 60 AS VARCHAR) AS "CustomerAge",
         CASE WHEN user_id % 4 = 0 THEN 'Doctor' WHEN user_id % 4 = 1 THEN 'Engineer'
              WHEN user_id % 4 = 2 THEN 'Student' ELSE 'Retired' END AS "CustomerOccupation",
         CAST(10 + event_id % 290 AS VARCHAR) AS "TransactionDuration",
         CAST(1 + event_id % 5 AS VARCHAR) AS "LoginAttempts",
         CAST(CAST(value * 37 AS DECIMAL(38,2)) AS VARCHAR) AS "AccountBalance",
         strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS "PreviousTransactionDate",
         _kind
  FROM raw_base),
raw_all AS (
  SELECT * FROM raw_txn UNION ALL SELECT * FROM raw_txn WHERE _kind = 'duplicate')"""

# raw_txn as the Spark builder emits it (duplicates included, no helper column)
RAW_CTE = RAW_BASE_CTE + """,
raw AS (SELECT * EXCLUDE (_kind) FROM raw_all)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ---------------------------------------------------------------- gold
register("txn_canonical", with_ctes(TXN_CTE) + """
SELECT tr_id, tr_date, tr_timestamp, account_hash, merchant_hash, round(amount, 6) AS amount,
       is_fraud, transaction_type, location
FROM txn""")

register("ml_features", with_ctes(TXN_CTE) + """
SELECT tr_id, tr_date, account_hash, merchant_hash, round(amount, 6) AS amount, is_fraud,
       transaction_type, location,
       round(lag(amount) OVER (PARTITION BY account_hash ORDER BY tr_timestamp, tr_id), 6) AS prev_amount,
       round(avg(amount) OVER (PARTITION BY account_hash ORDER BY tr_timestamp, tr_id
                               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_avg_amount_7,
       CAST(rank() OVER (PARTITION BY tr_date ORDER BY amount DESC) AS BIGINT) AS daily_amount_rank,
       round(percent_rank() OVER (PARTITION BY tr_date ORDER BY amount), 6) AS daily_amount_percent_rank
FROM txn""")

register("lead_amount", with_ctes(TXN_CTE) + """
SELECT tr_id, account_hash, tr_timestamp, round(amount, 6) AS amount,
       round(lead(amount) OVER (PARTITION BY account_hash ORDER BY tr_timestamp, tr_id), 6) AS next_amount
FROM txn""")

register("user_summary", with_ctes(TXN_CTE) + """
SELECT account_hash, count(*) AS transaction_count, round(sum(amount), 6) AS total_amount,
       round(avg(amount), 6) AS avg_amount, CAST(sum(is_fraud) AS BIGINT) AS fraud_count
FROM txn GROUP BY account_hash""")

MERCHANT_SQL = """merchant AS (
  SELECT merchant_hash, count(*) AS transaction_count, round(sum(amount), 6) AS total_amount,
         CAST(sum(is_fraud) AS BIGINT) AS fraud_count
  FROM txn GROUP BY merchant_hash),
merchant_ranked AS (
  SELECT *, CAST(rank() OVER (ORDER BY fraud_count DESC, total_amount DESC) AS BIGINT) AS fraud_rank
  FROM merchant)"""

register("merchant_summary", with_ctes(TXN_CTE, MERCHANT_SQL) + """
SELECT merchant_hash, transaction_count, total_amount, fraud_count, fraud_rank FROM merchant_ranked""")

register("top_fraud_merchant", with_ctes(TXN_CTE, MERCHANT_SQL) + """
SELECT merchant_hash, transaction_count, total_amount, fraud_count, fraud_rank
FROM merchant_ranked WHERE fraud_rank = 1""")

register("user_risk_score", with_ctes(TXN_CTE) + """
SELECT account_hash,
       round(CAST(sum(is_fraud) AS DOUBLE) / CAST(nullif(count(*), 0) AS DOUBLE), 6) AS risk_score
FROM txn GROUP BY account_hash""")

DAILY_SQL = """daily AS (
  SELECT tr_date,
         coalesce(sum(CASE WHEN is_fraud = 1 THEN amount END), 0.0) AS fraud_amount,
         CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
         count(*) AS transaction_count
  FROM txn GROUP BY tr_date)"""

register("daily_fraud_metrics", with_ctes(TXN_CTE, DAILY_SQL) + """
SELECT tr_date, round(fraud_amount, 6) AS fraud_amount, fraud_count, transaction_count FROM daily""")

register("region_risk", with_ctes(TXN_CTE) + """
SELECT location, transaction_count, fraud_count, fraud_rate,
       CAST(rank() OVER (ORDER BY fraud_rate DESC, fraud_count DESC) AS BIGINT) AS risk_rank
FROM (SELECT location, count(*) AS transaction_count, CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
             round(CAST(sum(is_fraud) AS DOUBLE) / CAST(nullif(count(*), 0) AS DOUBLE), 6) AS fraud_rate
      FROM txn GROUP BY location)""")

register("rising_velocity", with_ctes(TXN_CTE) + """
SELECT account_hash, tr_id AS last_tr_id, round(amount, 6) AS last_amount,
       round(rolling_avg_amount_7, 6) AS rolling_avg_amount_7
FROM (SELECT account_hash, tr_id, amount,
             avg(amount) OVER (PARTITION BY account_hash ORDER BY tr_timestamp, tr_id
                               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_avg_amount_7,
             row_number() OVER (PARTITION BY account_hash ORDER BY tr_timestamp DESC, tr_id DESC) AS rn
      FROM txn)
WHERE rn = 1 AND amount > rolling_avg_amount_7""")


# ---------------------------------------------------------------- cleaning (silver)
def _q(c: str) -> str:
    return '"' + c + '"'


RAW_COLS = [
    "TransactionID", "AccountID", "TransactionAmount", "TransactionDate",
    "TransactionType", "Location", "DeviceID", "IP Address", "MerchantID",
    "Channel", "CustomerAge", "CustomerOccupation", "TransactionDuration",
    "LoginAttempts", "AccountBalance", "PreviousTransactionDate",
]
SILVER_TYPES = {"TransactionAmount": "DOUBLE", "TransactionDate": "DATE", "CustomerAge": "INTEGER",
                "LoginAttempts": "INTEGER", "AccountBalance": "DOUBLE", "TransactionDuration": "INTEGER",
                "PreviousTransactionDate": "DATE"}


def _typed_select(types: dict[str, str], rnd: bool = True) -> str:
    out = []
    for c in RAW_COLS:
        if c in types:
            e = f"TRY_CAST({_q(c)} AS {types[c]})"
            if rnd and types[c] == "DOUBLE":
                e = f"round({e}, 6)"
            out.append(f"{e} AS {_q(c)}")
        else:
            out.append(_q(c))
    return ", ".join(out)


GOOD_COND = """TRY_CAST("TransactionAmount" AS DOUBLE) IS NOT NULL
  AND TRY_CAST("TransactionAmount" AS DOUBLE) > 0
  AND TRY_CAST("TransactionDate" AS DATE) IS NOT NULL
  AND TRY_CAST("TransactionDate" AS DATE) <= DATE '2026-12-01'"""
BAD_COND = """"TransactionAmount" IS NULL OR "TransactionDate" IS NULL
  OR "TransactionID" IS NULL OR "AccountID" IS NULL"""

register("silver_try_cast", with_ctes(RAW_CTE) + f"SELECT {_typed_select(SILVER_TYPES)} FROM raw")

register("silver_good", with_ctes(RAW_CTE) + f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY "TransactionID", "AccountID"
                               ORDER BY {", ".join(_q(c) + " NULLS FIRST" for c in RAW_COLS)}) AS rn
  FROM (SELECT {_typed_select(SILVER_TYPES)} FROM raw WHERE {GOOD_COND}))
WHERE rn = 1""")

def _good_once(where: str) -> str:
    """Good rows of a part of the feed, one per business key; rows with a NULL in the key all stay."""
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY "TransactionID", "AccountID"
                               ORDER BY {", ".join(_q(c) + " NULLS FIRST" for c in RAW_COLS)}) AS rn
  FROM (SELECT {_typed_select(SILVER_TYPES)} FROM raw WHERE {GOOD_COND} AND {where}))
WHERE rn = 1 OR "TransactionID" IS NULL OR "AccountID" IS NULL"""


register("dedup_across_batches", with_ctes(RAW_CTE, f"""first AS ({_good_once('CAST("CustomerAge" AS INTEGER) % 3 < 2')}),
second AS ({_good_once('CAST("CustomerAge" AS INTEGER) % 3 > 0')})""") + """
SELECT * FROM second WHERE NOT EXISTS (
  SELECT 1 FROM first WHERE first."TransactionID" = second."TransactionID" AND first."AccountID" = second."AccountID")""")

register("silver_quarantine", with_ctes(RAW_CTE) + f"SELECT * FROM raw WHERE {BAD_COND}")

register("silver_quarantine_strict", with_ctes(RAW_CTE) + f"""
SELECT * FROM raw
WHERE NOT coalesce({GOOD_COND} AND NOT isnan(TRY_CAST("TransactionAmount" AS DOUBLE)), false)""")

register("silver_reconcile", with_ctes(RAW_CTE) + f"""
, flags AS (SELECT coalesce({GOOD_COND}, false) AS g, coalesce({BAD_COND}, false) AS b,
                   "TransactionID", "AccountID" FROM raw)
SELECT count(*) AS rows_in,
       CAST(count_if(g) AS BIGINT) AS good_rows,
       CAST(count_if(b) AS BIGINT) AS quarantined,
       CAST(count_if(g AND NOT b) AS BIGINT) AS good_only,
       CAST(count_if(NOT g AND b) AS BIGINT) AS bad_only,
       CAST(count_if(g AND b) AS BIGINT) AS both,
       CAST(count_if(NOT g AND NOT b) AS BIGINT) AS neither,
       (SELECT count(*) FROM (SELECT 1 FROM flags WHERE g GROUP BY "TransactionID", "AccountID")) AS good_after_dedup
FROM flags""".replace("\n, flags", ", flags"))

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
register("dedup_business_key", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity, 6) AS l_quantity,
       round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount,
       round(l_tax, 6) AS l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY {", ".join(c + " NULLS FIRST" for c in LINEITEM_COLS)}) = 1""")

RULES_SQL = [
    ('"TransactionID" IS NULL', "TransactionID IS NULL"),
    ('"TransactionAmount" IS NULL', "TransactionAmount IS NULL"),
    ('"TransactionDate" IS NULL', "TransactionDate IS NULL"),
    ('"AccountID" IS NULL', "AccountID IS NULL"),
    ('TRY_CAST("TransactionAmount" AS DOUBLE) < 0', "CAST(TransactionAmount AS DOUBLE) < 0"),
    ('TRY_CAST("LoginAttempts" AS INTEGER) < 0', "CAST(LoginAttempts AS INT) < 0"),
]
register("quarantine_by_rules", with_ctes(RAW_CTE) + """
SELECT * FROM raw WHERE coalesce(""" + " OR ".join(f"({e})" for e, _ in RULES_SQL) + ", false)")

register("quarantine_reason", with_ctes(RAW_CTE) + """
SELECT "TransactionID", "AccountID", "TransactionAmount", "TransactionDate",
       CASE """ + " ".join(f"WHEN coalesce({e}, false) THEN '{t}'" for e, t in RULES_SQL)
         + """ ELSE NULL END AS quarantine_reason
FROM raw""")

register("sample_rows", with_ctes(RAW_CTE) + f"""
SELECT "TransactionID", "AccountID", "TransactionAmount", "TransactionDate", "CustomerAge",
       "LoginAttempts", "AccountBalance"
FROM (
  SELECT *, row_number() OVER (PARTITION BY "TransactionID", "AccountID"
                               ORDER BY {", ".join(_q(c) + " NULLS FIRST" for c in RAW_COLS)}) AS rn
  FROM (SELECT {_typed_select(SILVER_TYPES)} FROM raw WHERE {GOOD_COND}))
WHERE rn = 1
ORDER BY "TransactionID" NULLS LAST, "AccountID" NULLS FIRST LIMIT 5""")

_ALL_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()
register("row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL_TABLES))

# ---------------------------------------------------------------- landing
_BUSINESS = {"transactionid": "transaction_id", "accountid": "account_id", "transactionamount": "amount",
             "transactiondate": "transaction_date", "transactiontype": "transaction_type",
             "merchantid": "merchant_id"}
MAPPED = {c: _BUSINESS.get(c.lower().replace(" ", "_"), c.lower().replace(" ", "_")) for c in RAW_COLS}
RENAMED_CTE = "renamed AS (SELECT " + ", ".join(f"{_q(c)} AS {MAPPED[c]}" for c in RAW_COLS) + " FROM raw)"
COERCED_CTE = """coerced AS (
  SELECT * REPLACE (coalesce(try_strptime(transaction_date, '%Y-%m-%d %H:%M:%S'),
                             try_strptime(transaction_date, '%Y-%m-%d')) AS transaction_date,
                    TRY_CAST(amount AS DOUBLE) AS amount)
  FROM renamed),
parsed AS (SELECT *, strftime(transaction_date, '%Y-%m-%d') AS landing_partition FROM coerced)"""
LANDED_CTE = """as_text AS (SELECT * REPLACE (CAST(amount AS VARCHAR) AS amount) FROM parsed),
head AS (SELECT *, row_number() OVER (ORDER BY transaction_id NULLS LAST, transaction_date NULLS LAST,
                                               amount NULLS LAST) AS i
         FROM (SELECT * FROM as_text ORDER BY transaction_id NULLS LAST, transaction_date NULLS LAST,
                                              amount NULLS LAST LIMIT 2)),
landed AS (
  SELECT * FROM as_text
  UNION ALL BY NAME
  SELECT * EXCLUDE (i) REPLACE (CASE WHEN i = 1 THEN NULL ELSE 'bad-amount' END AS amount,
                                CAST(NULL AS TIMESTAMP) AS transaction_date)
  FROM head)"""

register("rename_mapped", with_ctes(RAW_CTE, RENAMED_CTE) + "SELECT * FROM renamed")
register("coerce_parse", with_ctes(RAW_CTE, RENAMED_CTE, COERCED_CTE) + """
SELECT transaction_id, account_id, round(amount, 6) AS amount, transaction_date, landing_partition FROM parsed""")
register("inject_bad_records", with_ctes(RAW_CTE, RENAMED_CTE, COERCED_CTE, LANDED_CTE) + """
SELECT transaction_id, account_id, amount, transaction_date, landing_partition FROM landed""")
register("landing_day_counts", with_ctes(RAW_CTE, RENAMED_CTE, COERCED_CTE, LANDED_CTE) + """
SELECT coalesce(landing_partition, 'unknown-date') AS landing_partition, count(*) AS row_count
FROM landed GROUP BY 1""")
register("landing_payload", with_ctes(RAW_CTE, RENAMED_CTE, COERCED_CTE, LANDED_CTE) + """
SELECT coalesce(landing_partition, 'unknown-date') AS landing_partition,
       * EXCLUDE (landing_partition) REPLACE (strftime(transaction_date, '%Y-%m-%dT%H:%M:%S.%g') AS transaction_date)
FROM landed""")

# ---------------------------------------------------------------- schema
HINT_TYPES = {"TransactionAmount": "DOUBLE", "TransactionDate": "TIMESTAMP", "CustomerAge": "INTEGER",
              "TransactionDuration": "INTEGER", "LoginAttempts": "INTEGER", "AccountBalance": "DOUBLE",
              "PreviousTransactionDate": "TIMESTAMP"}
register("schema_hint_cast", with_ctes(RAW_CTE) + f"SELECT {_typed_select(HINT_TYPES)} FROM raw")

_rescue_items = ", ".join(
    f"""CASE WHEN {_q(c)} IS NOT NULL AND TRY_CAST({_q(c)} AS {t}) IS NULL
             THEN '"{c}":' || CAST(to_json({_q(c)}) AS VARCHAR) END"""
    for c, t in HINT_TYPES.items())
register("rescue_type_drift", with_ctes(RAW_CTE) + f"""
SELECT "TransactionID", "AccountID", round(TRY_CAST("TransactionAmount" AS DOUBLE), 6) AS "TransactionAmount",
       TRY_CAST("TransactionDate" AS TIMESTAMP) AS "TransactionDate",
       CASE WHEN len(list_filter([{_rescue_items}], lambda x: x IS NOT NULL)) > 0
            THEN '{{' || array_to_string(list_filter([{_rescue_items}], lambda x: x IS NOT NULL), ',') || '}}'
       END AS _rescued_data
FROM raw""")

_DRIFT = """feed AS (
  SELECT *, CASE run WHEN 1 THEN "CustomerAge" WHEN 2 THEN "CustomerAge" || '.5' ELSE "CustomerAge" || ' years' END AS "Drift",
         lpad("CustomerAge", 5, '0') AS "Zip", CAST(CAST("CustomerAge" AS INTEGER) > 40 AS VARCHAR) AS "Flag",
         substr("PreviousTransactionDate", 1, 10) AS "Day", CAST(NULL AS VARCHAR) AS "Empty"
  FROM (SELECT *, CASE WHEN TRY_CAST("PreviousTransactionDate" AS DATE) < DATE '2024-01-11' THEN 1
                       WHEN TRY_CAST("PreviousTransactionDate" AS DATE) < DATE '2024-01-21' THEN 2 ELSE 3 END AS run FROM raw))"""
_FITS = {
    "int": "regexp_matches(v, '^(0|-?[1-9][0-9]{0,18})$') AND TRY_CAST(v AS INTEGER) IS NOT NULL",
    "bigint": "regexp_matches(v, '^(0|-?[1-9][0-9]{0,18})$') AND TRY_CAST(v AS BIGINT) IS NOT NULL",
    "double": "regexp_matches(v, '^-?(0|[1-9][0-9]*)([.][0-9]+)?$') AND length(regexp_replace(v, '[^0-9]', '', 'g')) <= 15",
    "boolean": "v IN ('true', 'false')",
    "date": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND TRY_CAST(v AS DATE) IS NOT NULL",
    "timestamp": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$')"
                 " AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
}
register("schema_infer_types", with_ctes(RAW_CTE, _DRIFT) + f"""
, long AS (SELECT run, "column", v FROM (SELECT COLUMNS(*) FROM feed)
           UNPIVOT INCLUDE NULLS (v FOR "column" IN ({", ".join(_q(c) for c in [*RAW_COLS, "Drift", "Zip", "Flag", "Day", "Empty"])}))),
per_run AS (SELECT run, "column", count(v) AS n, {", ".join(f"coalesce(bool_and({e}), true) AS {_q(t)}" for t, e in _FITS.items())}
            FROM long GROUP BY ALL),
so_far AS (SELECT run, "column", sum(n) OVER w AS n, {", ".join(f"bool_and({_q(t)}) OVER w AS {_q(t)}" for t in _FITS)}
           FROM per_run WINDOW w AS (PARTITION BY "column" ORDER BY run))
SELECT run, "column", CASE WHEN n = 0 THEN 'void' {" ".join(f"WHEN {_q(t)} THEN '{t}'" for t in _FITS)} ELSE 'string' END AS type
FROM so_far""".replace("\n, long", ", long"))

register("schema_merge_union", """
SELECT event_id, ts, user_id, round(value, 6) AS value FROM events WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL BY NAME
SELECT event_id, ts, user_id, round(value, 6) AS value, 'D' || CAST(user_id % 40 AS VARCHAR) AS device_id
FROM events WHERE ts >= TIMESTAMP '2024-01-16'""")

# ---------------------------------------------------------------- quality / monitoring
register("null_profile", with_ctes(RAW_CTE) + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal,
       CAST(count_if({_q(c)} IS NULL) AS BIGINT) AS null_count,
       round(CASE WHEN count(*) > 0 THEN count_if({_q(c)} IS NULL) / count(*) ELSE 0.0 END, 6) AS null_ratio
FROM raw""" for i, c in enumerate(RAW_COLS)))

_HINT_NAMES = {"TransactionAmount": "double", "TransactionDate": "timestamp", "CustomerAge": "integer",
               "TransactionDuration": "integer", "LoginAttempts": "integer", "AccountBalance": "double",
               "PreviousTransactionDate": "timestamp"}
_PII = {"AccountID", "MerchantID", "Location", "DeviceID", "IP Address"}
register("column_profile", with_ctes(RAW_CTE) + "\nUNION ALL\n".join(
    f"""SELECT count(*) AS record_count, CAST({len(RAW_COLS)} AS INTEGER) AS column_count,
       '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal,
       '{c.lower().replace(" ", "_")}' AS mapped_name, '{_HINT_NAMES.get(c, "string")}' AS schema_hint,
       {"true" if c in _PII else "false"} AS is_pii, CAST(count_if({_q(c)} IS NULL) AS BIGINT) AS null_count
FROM raw""" for i, c in enumerate(RAW_COLS)))

def _inferred_hint(c: str) -> str:
    x = _q(c)
    whole = f"regexp_full_match({x}, '-?[0-9]+')"

    def every(ok: str) -> str:
        return f"count_if({x} IS NOT NULL AND NOT coalesce({ok}, false)) = 0"

    return (f"CASE WHEN count({x}) = 0 THEN '' "
            f"WHEN {every(f'{whole} AND TRY_CAST({x} AS INTEGER) IS NOT NULL')} THEN 'integer' "
            f"WHEN {every(f'{whole} AND TRY_CAST({x} AS BIGINT) IS NOT NULL')} THEN 'bigint' "
            f"WHEN {every(whole)} THEN '' "
            f"WHEN {every(f'TRY_CAST({x} AS DOUBLE) IS NOT NULL')} THEN 'double' "
            f"WHEN {every(f'TRY_CAST({x} AS TIMESTAMP) IS NOT NULL')} THEN 'timestamp' ELSE '' END")


register("profile_override", with_ctes(RAW_CTE) + """, base AS (""" + "\nUNION ALL\n".join(
    f"""SELECT count(*) AS record_count, CAST({len(RAW_COLS)} AS INTEGER) AS column_count,
       '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal,
       '{c.lower().replace(" ", "_")}' AS mapped_name, '{_HINT_NAMES.get(c, "string")}' AS schema_hint,
       {"true" if c in _PII else "false"} AS is_pii, CAST(count_if({_q(c)} IS NULL) AS BIGINT) AS null_count
FROM raw""" for i, c in enumerate(RAW_COLS)) + """),
cand AS (""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, '{_BUSINESS.get(c.lower().replace(" ", "_"), "")}' AS mapped_name,
       {_inferred_hint(c)} AS schema_hint FROM raw""" for c in RAW_COLS) + """)
SELECT b.record_count, b.column_count, b.column_name, b.ordinal,
       coalesce(nullif(trim(c.mapped_name), ''), b.mapped_name) AS mapped_name,
       coalesce(nullif(trim(c.schema_hint), ''), b.schema_hint) AS schema_hint,
       b.is_pii, b.null_count, 'data_inference' AS generated_by
FROM base b LEFT JOIN cand c ON b.column_name = c.column_name""")

FLAGS_CTE = """flags AS (
  SELECT tr_date, fraud_amount, threshold, coalesce(fraud_amount > threshold, false) AS alert
  FROM daily, (SELECT avg(fraud_amount) + 2.0 * stddev_samp(fraud_amount) AS threshold FROM daily))"""
register("anomaly_threshold", with_ctes(TXN_CTE, DAILY_SQL, FLAGS_CTE) + """
SELECT tr_date, round(fraud_amount, 6) AS fraud_amount, round(threshold, 6) AS threshold, alert FROM flags""")
register("anomaly_days", with_ctes(TXN_CTE, DAILY_SQL, FLAGS_CTE) + """
SELECT tr_date, round(fraud_amount, 6) AS fraud_amount, round(threshold, 6) AS threshold FROM flags WHERE alert""")
register("alert_payload", with_ctes(TXN_CTE, DAILY_SQL, FLAGS_CTE) + """
SELECT round(threshold, 6) AS threshold, alert_count, flagged_days,
       'Fallback executive alert: fraud volume has breached the statistical control band and requires analyst review.'
         AS executive_summary,
       CASE WHEN alert_count > 0
            THEN format('Fraud amount breached the control limit of {} on {} day(s): {}.',
                        CAST(CAST(threshold AS DECIMAL(38,2)) AS VARCHAR), alert_count, flagged_days)
            ELSE 'No day breached the fraud control limit.' END AS alert_detail
FROM (SELECT max(threshold) AS threshold, CAST(count_if(alert) AS BIGINT) AS alert_count,
             coalesce(array_to_string(list_sort(list(strftime(tr_date, '%Y-%m-%d') || '='
                        || CAST(CAST(fraud_amount AS DECIMAL(38,2)) AS VARCHAR)) FILTER (WHERE alert)), ';'), '')
               AS flagged_days
      FROM flags)""")
register("class_weight", with_ctes(TXN_CTE) + """
SELECT negatives, positives, round(CAST(negatives AS DOUBLE) / greatest(positives, 1), 6) AS scale_pos_weight
FROM (SELECT CAST(count_if(is_fraud = 0) AS BIGINT) AS negatives, CAST(count_if(is_fraud = 1) AS BIGINT) AS positives
      FROM txn)""")


# ---------------------------------------------------------------- model metrics
SCORED_CTE = """scored AS (SELECT tr_id, is_fraud AS label, floor(amount / 5) / 100 AS score FROM txn),
per_score AS (SELECT score AS threshold, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
              FROM scored WHERE score IS NOT NULL GROUP BY score),
cum AS (SELECT threshold, pos, neg,
               CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
               CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
               CAST(sum(pos) OVER () AS BIGINT) AS p_total
        FROM per_score),
curve AS (SELECT threshold, pos, neg, tp, fp, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
                 CASE WHEN p_total > 0 THEN CAST(tp AS DOUBLE) / p_total END AS recall FROM cum)"""

register("pr_curve", with_ctes(TXN_CTE, SCORED_CTE) + """
SELECT round(threshold, 6) AS threshold, pos, neg, tp, fp, round(precision, 6) AS precision,
       round(recall, 6) AS recall FROM curve""")
register("average_precision", with_ctes(TXN_CTE, SCORED_CTE) + """
SELECT round(sum(pos * precision) / nullif(sum(pos), 0), 6) AS average_precision FROM curve""")
register("best_f1_threshold", with_ctes(TXN_CTE, SCORED_CTE) + """
, f AS (SELECT threshold, 2 * precision * recall / greatest(precision + recall, 1e-12) AS f1 FROM curve),
best AS (SELECT threshold, f1 FROM f WHERE f1 IS NOT NULL ORDER BY f1 DESC, threshold ASC LIMIT 1)
SELECT round(coalesce((SELECT threshold FROM best), 0.5), 6) AS threshold, round((SELECT f1 FROM best), 6) AS f1""".replace("\n, f AS", ", f AS"))

CELLS_CTE = """cells AS (
  SELECT CAST(count_if(label = 0 AND score < 0.1) AS BIGINT) AS tn,
         CAST(count_if(label = 0 AND score >= 0.1) AS BIGINT) AS fp,
         CAST(count_if(label = 1 AND score < 0.1) AS BIGINT) AS fn,
         CAST(count_if(label = 1 AND score >= 0.1) AS BIGINT) AS tp
  FROM scored)"""
register("confusion_matrix", with_ctes(TXN_CTE, SCORED_CTE, CELLS_CTE) + """
SELECT 0 AS actual, 0 AS predicted, tn AS row_count FROM cells UNION ALL
SELECT 0, 1, fp FROM cells UNION ALL SELECT 1, 0, fn FROM cells UNION ALL SELECT 1, 1, tp FROM cells""")
register("classification_report", with_ctes(TXN_CTE, SCORED_CTE, CELLS_CTE) + """
, m AS (
  SELECT CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
         CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
         tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n,
         CASE WHEN tn + fp + fn + tp > 0 THEN (tn + tp) / (tn + fp + fn + tp) ELSE 0.0 END AS acc
  FROM cells),
m2 AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
              CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1 FROM m)
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, s0 AS support FROM m2
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), n FROM m2
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM m2
UNION ALL SELECT 'weighted avg', round(CASE WHEN n > 0 THEN (p0 * s0 + p1 * s1) / n ELSE 0.0 END, 6),
                 round(CASE WHEN n > 0 THEN (r0 * s0 + r1 * s1) / n ELSE 0.0 END, 6),
                 round(CASE WHEN n > 0 THEN (f0 * s0 + f1 * s1) / n ELSE 0.0 END, 6), n FROM m2""".replace("\n, m AS", ", m AS"))

# ---------------------------------------------------------------- feature prep
register("one_hot_counts", with_ctes(TXN_CTE) + """
, cats AS (SELECT 'transaction_type' AS source_column, transaction_type AS category, count(*) AS row_count
           FROM txn GROUP BY transaction_type
           UNION ALL
           SELECT 'location', location, count(*) FROM txn GROUP BY location),
seen AS (SELECT source_column, category, row_count,
                CAST(row_number() OVER (PARTITION BY source_column ORDER BY row_count DESC, category) - 1 AS INTEGER)
                  AS category_index
         FROM cats WHERE category IS NOT NULL),
nulls AS (SELECT source_column, CAST(NULL AS VARCHAR) AS category,
                 CAST(coalesce(sum(CASE WHEN category IS NULL THEN row_count END), 0) AS BIGINT) AS row_count,
                 CAST(count_if(category IS NOT NULL) AS INTEGER) AS category_index
          FROM cats GROUP BY source_column)
SELECT *, source_column || '_' || coalesce(category, 'nan') AS feature
FROM (SELECT * FROM seen UNION ALL SELECT * FROM nulls)""".replace("\n, cats AS", ", cats AS"))

register("hash_frequencies", with_ctes(TXN_CTE) + """
SELECT tr_id, round(count(*) OVER (PARTITION BY account_hash) / count(*) OVER (), 6) AS account_hash_freq,
       round(count(*) OVER (PARTITION BY merchant_hash) / count(*) OVER (), 6) AS merchant_hash_freq
FROM txn""")

register("feature_align", with_ctes(TXN_CTE) + """
SELECT tr_id, round(coalesce(amount, 0.0), 6) AS amount, round(coalesce(prev_amount, 0.0), 6) AS prev_amount,
       round(coalesce(rolling_avg_amount_7, 0.0), 6) AS rolling_avg_amount_7,
       coalesce(CAST(transaction_type = 'click' AS DOUBLE), 0.0) AS transaction_type_click,
       coalesce(CAST(transaction_type = 'error' AS DOUBLE), 0.0) AS transaction_type_error,
       0.0 AS transaction_type_refund,
       coalesce(CAST(location = 'LOC_0' AS DOUBLE), 0.0) AS location_LOC_0,
       CAST(location IS NULL AS DOUBLE) AS location_nan
FROM (SELECT *, lag(amount) OVER (PARTITION BY account_hash ORDER BY tr_timestamp, tr_id) AS prev_amount,
             avg(amount) OVER (PARTITION BY account_hash ORDER BY tr_timestamp, tr_id
                               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_avg_amount_7
      FROM txn)""")

register("stratified_split", with_ctes(TXN_CTE) + """
, h AS (SELECT tr_id, is_fraud,
               CAST(('0x' || substr(sha256('42:' || CAST(tr_id AS VARCHAR)), 1, 12)) AS BIGINT) AS u FROM txn),
r AS (SELECT *, rank() OVER (PARTITION BY is_fraud ORDER BY u, tr_id) AS rk,
             count(*) OVER (PARTITION BY is_fraud) AS n FROM h)
SELECT tr_id, is_fraud, CASE WHEN rk <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r""".replace("\n, h AS", ", h AS"))

# ---------------------------------------------------------------- merge
RISK_SRC_CTE = """s1 AS (SELECT account_hash, CAST(sum(is_fraud) AS DOUBLE) / CAST(nullif(count(*), 0) AS DOUBLE) AS risk_score
       FROM txn WHERE tr_date < DATE '2024-01-16' GROUP BY account_hash),
s2 AS (SELECT account_hash, CAST(sum(is_fraud) AS DOUBLE) / CAST(nullif(count(*), 0) AS DOUBLE) AS risk_score
       FROM txn GROUP BY account_hash),
t1 AS (SELECT account_hash, risk_score, TIMESTAMP '2024-01-16 00:00:00' AS valid_from,
              TIMESTAMP '9999-12-31 00:00:00' AS valid_to, true AS is_current FROM s1)"""

register("scd2_single_pass", with_ctes(TXN_CTE, RISK_SRC_CTE) + """
, upd AS (
  SELECT t.account_hash, t.risk_score, t.valid_from,
         CASE WHEN s.account_hash IS NOT NULL AND t.is_current AND t.risk_score <> s.risk_score
              THEN TIMESTAMP '2024-01-31 00:00:00' ELSE t.valid_to END AS valid_to,
         CASE WHEN s.account_hash IS NOT NULL AND t.is_current AND t.risk_score <> s.risk_score
              THEN false ELSE t.is_current END AS is_current
  FROM t1 t LEFT JOIN s2 s ON t.account_hash = s.account_hash AND t.is_current),
ins AS (
  SELECT s.account_hash, s.risk_score, TIMESTAMP '2024-01-31 00:00:00' AS valid_from,
         TIMESTAMP '9999-12-31 00:00:00' AS valid_to, true AS is_current
  FROM s2 s WHERE NOT EXISTS (SELECT 1 FROM t1 t WHERE t.account_hash = s.account_hash AND t.is_current))
SELECT account_hash, round(risk_score, 6) AS risk_score, valid_from, valid_to, is_current
FROM (SELECT * FROM upd UNION ALL SELECT * FROM ins)""".replace("\n, upd AS", ", upd AS"))

register("scd2_complete", with_ctes(TXN_CTE, RISK_SRC_CTE) + """
, upd AS (
  SELECT t.account_hash, t.risk_score, t.valid_from,
         CASE WHEN s.present AND t.is_current AND t.risk_score IS DISTINCT FROM s.risk_score
              THEN TIMESTAMP '2024-01-31 00:00:00' ELSE t.valid_to END AS valid_to,
         CASE WHEN s.present AND t.is_current AND t.risk_score IS DISTINCT FROM s.risk_score
              THEN false ELSE t.is_current END AS is_current
  FROM t1 t LEFT JOIN (SELECT *, true AS present FROM s2) s
    ON t.account_hash IS NOT DISTINCT FROM s.account_hash AND t.is_current),
ins AS (
  SELECT s.account_hash, s.risk_score, TIMESTAMP '2024-01-31 00:00:00' AS valid_from,
         TIMESTAMP '9999-12-31 00:00:00' AS valid_to, true AS is_current
  FROM s2 s
  WHERE NOT EXISTS (SELECT 1 FROM t1 t WHERE t.account_hash IS NOT DISTINCT FROM s.account_hash AND t.is_current
                    AND t.risk_score IS NOT DISTINCT FROM s.risk_score))
SELECT account_hash, round(risk_score, 6) AS risk_score, valid_from, valid_to, is_current
FROM (SELECT * FROM upd UNION ALL SELECT * FROM ins)""".replace("\n, upd AS", ", upd AS"))

register("doc_upsert", """
WITH upd AS (
  SELECT doc_id, text || ' [rev2]' AS text, lang, source FROM documents WHERE lang = 'de'
  UNION ALL
  SELECT item_id + 1000000000 AS doc_id, text, 'xx' AS lang, 'benchmark' AS source FROM benchmark),
res AS (
  SELECT doc_id, text, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.doc_id = d.doc_id)
  UNION ALL SELECT doc_id, text, lang, source FROM upd)
SELECT doc_id, lang, source, CAST(length(text) AS INTEGER) AS n_chars, sha256(text) AS text_sha FROM res""")

# ---------------------------------------------------------------- retrieval
register("vector_topk", """
WITH cent AS (
  SELECT label AS query_id, list(x ORDER BY pos) AS q
  FROM (SELECT label, pos, avg(x) AS x
        FROM (SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
        GROUP BY label, pos)
  GROUP BY label),
d AS (
  SELECT c.query_id, e.vec_id, e.label,
         list_reduce(list_transform(range(1, len(e.embedding) + 1),
                                    lambda i: (CAST(e.embedding[i] AS DOUBLE) - c.q[i]) * (CAST(e.embedding[i] AS DOUBLE) - c.q[i])),
                     lambda a, b: a + b) AS distance
  FROM embeddings e, cent c)
SELECT query_id, vec_id, label, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 12), vec_id) AS rank FROM d)
WHERE rank <= 3""")

TFIDF_CTE = r"""qs AS (SELECT * FROM (VALUES (1, 'Which merchant has the most fraud?'),
                               (2, 'Which users have rising transaction velocity?'),
                               (3, 'Summarize the highest-risk regions from the Gold tables.')) AS t(question_id, question)),
dt AS (SELECT doc_id, term, count(*) AS tf
       FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term
             FROM documents WHERE doc_id IS NOT NULL)
       GROUP BY doc_id, term),
idf AS (SELECT term, ln((n + 1.0) / (count(*) + 1.0)) AS idf
        FROM dt, (SELECT count(*) AS n FROM documents WHERE doc_id IS NOT NULL) GROUP BY term, n),
w AS (SELECT doc_id, term, tf * idf AS w FROM dt JOIN idf USING (term)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS dnorm FROM w GROUP BY doc_id),
qt AS (SELECT question_id, term, count(*) AS tf
       FROM (SELECT question_id, unnest(regexp_extract_all(lower(question), '[\p{L}\p{N}]+')) AS term FROM qs)
       GROUP BY question_id, term),
qw AS (SELECT question_id, term, tf * idf AS qw FROM qt JOIN idf USING (term)),
qn AS (SELECT question_id, sqrt(sum(qw * qw)) AS qnorm FROM qw GROUP BY question_id),
dots AS (SELECT question_id, doc_id, sum(w * qw) AS dot FROM w JOIN qw USING (term) GROUP BY question_id, doc_id),
sc AS (SELECT question_id, doc_id, dot / nullif(qnorm * dnorm, 0) AS score
       FROM dots JOIN qn USING (question_id) JOIN norms USING (doc_id)),
top AS (SELECT question_id, doc_id, score, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 12) DESC, doc_id) AS rank FROM sc)
        WHERE rank <= 3)"""

register("tfidf_topk", with_ctes(TFIDF_CTE) + """
SELECT question_id, doc_id, round(score, 6) AS score, rank FROM top""")

register("answer_context", with_ctes(TFIDF_CTE) + """
, ctx AS (SELECT question_id,
                 string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS context_ids,
                 string_agg(CASE WHEN rank <= 2 THEN d.text END, ' ' ORDER BY rank) AS first_two
          FROM top JOIN documents d USING (doc_id)
          GROUP BY question_id)
SELECT q.question_id, q.question, coalesce(c.context_ids, '') AS context_ids,
       'Fallback answer based on retrieved Gold summaries: ' || coalesce(c.first_two, '')
         || ' | Suggested next step: validate the top-risk merchants in the Gold merchant summary.' AS answer
FROM qs q LEFT JOIN ctx c USING (question_id)""".replace("\n, ctx AS", ", ctx AS"))

_FEAT_SQL = """feat AS (
  SELECT tr_id, tr_date, account_hash, merchant_hash, amount, is_fraud, transaction_type, location,
         lag(amount) OVER (PARTITION BY account_hash ORDER BY tr_timestamp, tr_id) AS prev_amount,
         avg(amount) OVER (PARTITION BY account_hash ORDER BY tr_timestamp, tr_id
                           ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_avg_amount_7,
         CAST(rank() OVER (PARTITION BY tr_date ORDER BY amount DESC) AS BIGINT) AS daily_amount_rank,
         percent_rank() OVER (PARTITION BY tr_date ORDER BY amount) AS daily_amount_percent_rank
  FROM txn)"""


def _doc_sql(name: str, src: str, cols: list[tuple[str, bool]], order: str) -> str:
    texts = {"merchant_hash", "account_hash", "tr_date", "transaction_type", "location"}
    value = lambda c, dbl: (f"CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)" if dbl else
                            f"CAST(to_json(CAST({c} AS VARCHAR)) AS VARCHAR)" if c in texts else f"CAST({c} AS VARCHAR)")
    fields = " || ',' || ".join(f"""'"{c}":' || coalesce({value(c, dbl)}, 'null')""" for c, dbl in cols)
    return f"""SELECT '{name}' AS id,
       '[' || string_agg('{{' || {fields} || '}}', ',' ORDER BY {order}) || ']' AS text,
       'gold/{name}' AS source
FROM (SELECT * FROM {src} ORDER BY {order} LIMIT 50)"""


register("summary_documents", with_ctes(TXN_CTE, MERCHANT_SQL, _FEAT_SQL) + """
, usr AS (SELECT account_hash, count(*) AS transaction_count, sum(amount) AS total_amount,
                 avg(amount) AS avg_amount, CAST(sum(is_fraud) AS BIGINT) AS fraud_count
          FROM txn GROUP BY account_hash)
""".replace("\n, usr AS", ", usr AS") + "\nUNION ALL\n".join([
    _doc_sql("merchant_summary", "merchant_ranked",
             [("merchant_hash", False), ("transaction_count", False), ("total_amount", True),
              ("fraud_count", False), ("fraud_rank", False)], "fraud_rank, merchant_hash"),
    _doc_sql("user_summary", "usr",
             [("account_hash", False), ("transaction_count", False), ("total_amount", True),
              ("avg_amount", True), ("fraud_count", False)], "account_hash"),
    _doc_sql("ml_features", "feat",
             [("tr_id", False), ("tr_date", False), ("account_hash", False), ("merchant_hash", False),
              ("amount", True), ("is_fraud", False), ("transaction_type", False), ("location", False),
              ("prev_amount", True), ("rolling_avg_amount_7", True), ("daily_amount_rank", False),
              ("daily_amount_percent_rank", True)], "tr_id"),
]))

register("gold_narrative", with_ctes(TXN_CTE, MERCHANT_SQL, DAILY_SQL) + """
, m AS (SELECT * FROM merchant_ranked ORDER BY fraud_rank, merchant_hash LIMIT 1),
u AS (SELECT account_hash, CAST(sum(is_fraud) AS DOUBLE) / CAST(nullif(count(*), 0) AS DOUBLE) AS risk_score
      FROM txn GROUP BY account_hash ORDER BY risk_score DESC, account_hash LIMIT 1),
dd AS (SELECT * FROM daily ORDER BY fraud_amount DESC, tr_date LIMIT 1)
SELECT format('Top fraud merchant {} with {} fraud transactions; highest-risk account {} (risk {}); peak fraud day {} ({}).',
              m.merchant_hash, m.fraud_count, u.account_hash,
              CAST(CAST(u.risk_score AS DECIMAL(38,6)) AS VARCHAR), CAST(dd.tr_date AS VARCHAR),
              CAST(CAST(dd.fraud_amount AS DECIMAL(38,2)) AS VARCHAR)) AS narrative,
       'Fallback summary: review merchant spikes, high-risk users, and rolling velocity anomalies.' AS summary
FROM m, u, dd""".replace("\n, m AS", ", m AS"))

# ---------------------------------------------------------------- scans / PII
register("pii_hash", """
SELECT event_id AS tr_id, sha256(CAST(user_id AS VARCHAR)) AS account_hash,
       sha256('fjord|' || CAST(user_id AS VARCHAR)) AS account_hash_salted,
       sha256(json_extract_string(props, '$.k')) AS merchant_hash
FROM events""")

register("scan_parquet", "SELECT event_id, ts, round(value, 6) AS value FROM events WHERE value > 100")
