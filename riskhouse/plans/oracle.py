"""DuckDB oracle SQL for the registered queries.

Every statement re-derives its input from the raw parquet views
(``lineitem``, ``events``) through the shared CTEs below, so the oracle
never reuses anything our Spark code produced.
"""

from __future__ import annotations


def _fill0(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0 ELSE {c} END"


def _title(c: str) -> str:
    """Spark initcap for space-separated words (DuckDB has no initcap)."""
    return (
        f"array_to_string(list_transform(string_split(lower({c}), ' '), "
        f"lambda w: upper(w[1]) || w[2:]), ' ')"
    )


TXN = """
txn AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS DOUBLE) AS TransactionID,
         CAST(CASE WHEN l_returnflag = 'R' AND round(l_tax * 100) >= 6 AND l_orderkey % 3 = 0
                   THEN 1 ELSE 0 END AS DOUBLE) AS isFraud,
         CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS TransactionDT,
         l_extendedprice / 50 AS TransactionAmt,
         l_returnflag AS ProductCD,
         CAST(l_suppkey AS DOUBLE) AS card1,
         CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS card2,
         CASE l_suppkey % 5 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'discover'
                            WHEN 3 THEN 'american express' END AS card4,
         CASE l_suppkey % 3 WHEN 0 THEN 'debit' WHEN 1 THEN 'credit' END AS card6,
         CASE WHEN l_partkey % 30 < 28 THEN 'd' || CAST(l_partkey % 30 AS VARCHAR) || '.com'
              WHEN l_partkey % 30 = 28 THEN '0' END AS P_emaildomain,
         CAST(l_linenumber AS DOUBLE) AS C1,
         l_quantity AS C2,
         round(l_tax * 100) AS D1,
         CAST(l_shipdate AS TIMESTAMP) AS kafka_timestamp
  FROM lineitem
)"""

EV = """
ev_k AS (
  SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
ev AS (
  SELECT CAST(event_id AS DOUBLE) AS TransactionID,
         CAST(CASE WHEN k < 4 THEN 1 ELSE 0 END AS DOUBLE) AS isFraud,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS DOUBLE) AS TransactionDT,
         value * 4 AS TransactionAmt,
         upper(substr(event_type, 1, 1)) AS ProductCD,
         CAST(user_id AS DOUBLE) AS card1,
         CASE WHEN k % 10 = 0 THEN NULL ELSE 100.0 + k END::DOUBLE AS card2,
         CASE user_id % 5 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'discover'
                          WHEN 3 THEN 'american express' END AS card4,
         CASE user_id % 3 WHEN 0 THEN 'debit' WHEN 1 THEN 'credit' END AS card6,
         CASE WHEN user_id % 30 < 28 THEN 'd' || CAST(user_id % 30 AS VARCHAR) || '.com'
              WHEN user_id % 30 = 28 THEN '0' END AS P_emaildomain,
         CAST(k % 7 AS DOUBLE) AS C1,
         CAST(k % 11 AS DOUBLE) AS C2,
         CAST(k % 13 AS DOUBLE) AS D1,
         CAST(ts AS TIMESTAMP) AS kafka_timestamp
  FROM ev_k
)"""


def dedup_cte(src: str, name: str = "dedup") -> str:
    return f"""
{name} AS (
  SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY TransactionID
          ORDER BY kafka_timestamp DESC, TransactionAmt DESC, card1 DESC) = 1
)"""


def silver_cte(src: str, name: str = "silver") -> str:
    nums = ["isFraud", "TransactionDT", "TransactionAmt", "card1", "card2", "C1", "C2", "D1"]
    f = {c: f"{_fill0(c)} AS {c}" for c in nums}
    return f"""
{name}_clean AS (
  SELECT TRY_CAST(TransactionID AS INTEGER) AS TransactionID,
         {f['isFraud']}, {f['TransactionDT']}, {f['TransactionAmt']},
         ProductCD, {f['card1']}, {f['card2']},
         coalesce(card4, 'unknown') AS card4, coalesce(card6, 'unknown') AS card6,
         coalesce(P_emaildomain, 'unknown') AS P_emaildomain,
         {f['C1']}, {f['C2']}, {f['D1']}, kafka_timestamp
  FROM {src}
  WHERE TRY_CAST(TransactionID AS INTEGER) IS NOT NULL
),
{name} AS (
  SELECT *,
         CASE WHEN isFraud = 1.0 THEN 'FRAUD' ELSE 'LEGIT' END AS risk_label,
         md5(concat_ws('_', CAST(TransactionID AS VARCHAR), CAST(TransactionAmt AS VARCHAR),
                       CAST(TransactionDT AS VARCHAR))) AS row_hash
  FROM {name}_clean
)"""


BASE = "WITH " + TXN + "," + dedup_cte("txn") + "," + silver_cte("dedup")

TIER = """CASE WHEN TransactionAmt <= 25 THEN '$0-25' WHEN TransactionAmt <= 50 THEN '$25-50'
     WHEN TransactionAmt <= 100 THEN '$50-100' WHEN TransactionAmt <= 200 THEN '$100-200'
     WHEN TransactionAmt <= 500 THEN '$200-500' WHEN TransactionAmt <= 1000 THEN '$500-1K'
     ELSE '$1K+' END"""

GOLD = (
    BASE
    + f""",
gold_card AS (
  SELECT card4, count(*) AS total_transactions, sum(isFraud) AS fraud_count,
         round(avg(TransactionAmt), 2) AS avg_transaction_amt,
         round(avg(CASE WHEN isFraud = 1 THEN TransactionAmt END), 2) AS avg_fraud_amt,
         round(sum(isFraud) / count(*) * 100, 2) AS fraud_rate_pct
  FROM silver GROUP BY card4
),
gold_email AS (
  SELECT P_emaildomain, count(*) AS total_transactions, sum(isFraud) AS fraud_count,
         round(sum(isFraud) / count(*) * 100, 2) AS fraud_rate_pct,
         round(avg(TransactionAmt), 2) AS avg_transaction_amt
  FROM silver GROUP BY P_emaildomain
  ORDER BY fraud_count DESC, P_emaildomain LIMIT 20
),
gold_tier AS (
  SELECT {TIER} AS amount_tier, count(*) AS total_transactions, sum(isFraud) AS fraud_count,
         round(sum(isFraud) / count(*) * 100, 2) AS fraud_rate_pct,
         round(avg(TransactionAmt), 2) AS avg_transaction_amt
  FROM silver GROUP BY 1
),
gold_summary AS (
  SELECT count(*) AS total_transactions,
         count_if(isFraud = 1) AS fraud_count,
         count(*) - count_if(isFraud = 1) AS legit_count,
         round(count_if(isFraud = 1) / count(*) * 100, 2) AS fraud_rate_pct,
         round(avg(TransactionAmt), 2) AS avg_transaction_amt,
         round(avg(CASE WHEN isFraud = 1 THEN TransactionAmt END), 2) AS avg_fraud_amt
  FROM silver
)"""
)

BRONZE_COLS = (
    "TransactionID, isFraud, TransactionDT, TransactionAmt, ProductCD, card1, card2, "
    "card4, card6, P_emaildomain, C1, C2, D1"
)
TS_TEXT = "strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S') AS kafka_ts"


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# --- silver ----------------------------------------------------------------
register(
    "silver_dedup",
    "WITH " + TXN + "," + dedup_cte("txn") + f"\nSELECT {BRONZE_COLS}, {TS_TEXT} FROM dedup",
)
register(
    "silver_clean",
    BASE + f"\nSELECT {BRONZE_COLS}, {TS_TEXT} FROM silver",
)
register("silver_risk_label", BASE + "\nSELECT TransactionID, isFraud, risk_label FROM silver")
register("silver_row_hash", BASE + "\nSELECT TransactionID, row_hash FROM silver")
register(
    "silver_quality_counts",
    "WITH "
    + TXN
    + ","
    + dedup_cte("txn")
    + """
SELECT (SELECT count(*) FROM txn) AS bronze_rows,
       count(*) FILTER (WHERE TRY_CAST(TransactionID AS INTEGER) IS NOT NULL) AS silver_rows,
       count(*) FILTER (WHERE TRY_CAST(TransactionID AS INTEGER) IS NOT NULL AND isFraud = 1) AS fraud_rows,
       count(*) FILTER (WHERE TRY_CAST(TransactionID AS INTEGER) IS NOT NULL
                        AND coalesce(isFraud = 1, false) = false) AS legit_rows,
       (SELECT count(*) FROM txn WHERE TRY_CAST(TransactionID AS INTEGER) IS NULL) AS quarantined_rows
FROM dedup""",
)

# --- gold ------------------------------------------------------------------
register("gold_card_network", GOLD + "\nSELECT * FROM gold_card")
register("gold_email_domain", GOLD + "\nSELECT * FROM gold_email")
register("amount_tier", BASE + f"\nSELECT TransactionID, {TIER} AS amount_tier FROM silver")
register("gold_amount_tier", GOLD + "\nSELECT * FROM gold_tier")
register("gold_overall_summary", GOLD + "\nSELECT * FROM gold_summary")
register("gold_rollups_single_scan", GOLD + """
SELECT 'card' AS gset, card4 AS segment, total_transactions, fraud_count, fraud_rate_pct, avg_transaction_amt FROM gold_card
UNION ALL
SELECT 'email', P_emaildomain, total_transactions, fraud_count, fraud_rate_pct, avg_transaction_amt FROM gold_email
UNION ALL
SELECT 'tier', amount_tier, total_transactions, fraud_count, fraud_rate_pct, avg_transaction_amt FROM gold_tier
UNION ALL
SELECT 'overall', NULL, total_transactions, CAST(fraud_count AS DOUBLE), fraud_rate_pct, avg_transaction_amt FROM gold_summary""")

# --- insights --------------------------------------------------------------
register("fraud_only", BASE + "\nSELECT TransactionID, TransactionAmt FROM silver WHERE isFraud = 1")
register("legit_only", BASE + "\nSELECT TransactionID, TransactionAmt FROM silver WHERE isFraud = 0")
register("distinct_rows", BASE + "\nSELECT DISTINCT card4, card6, P_emaildomain FROM silver")
register(
    "card_risk_ranked",
    GOLD + f"\nSELECT {_title('card4')} AS card_network, fraud_rate_pct FROM gold_card WHERE card4 <> '0'",
)
register(
    "card_type_exposure",
    BASE
    + f"""
SELECT {_title('card6')} AS card_type, count(isFraud) AS total, sum(isFraud) AS fraud,
       count(isFraud) - sum(isFraud) AS legit
FROM silver GROUP BY card6 HAVING count(isFraud) > 10""",
)
TOP6 = """
top6 AS (
  SELECT P_emaildomain, count(*) AS fraud_count FROM silver WHERE isFraud = 1
  GROUP BY P_emaildomain ORDER BY fraud_count DESC, P_emaildomain LIMIT 6
)"""
register("top_fraud_domains", BASE + "," + TOP6 + "\nSELECT * FROM top6")
register(
    "risk_heatmap",
    BASE
    + ","
    + TOP6
    + """,
hm AS (SELECT * FROM silver WHERE P_emaildomain IN (SELECT P_emaildomain FROM top6) AND card4 <> '0'),
cell AS (SELECT card4, P_emaildomain, avg(isFraud) AS r FROM hm GROUP BY ALL)
SELECT c.card4, d.P_emaildomain, round(coalesce(cell.r, 0.0), 6) AS fraud_rate
FROM (SELECT DISTINCT card4 FROM hm) c CROSS JOIN (SELECT DISTINCT P_emaildomain FROM hm) d
LEFT JOIN cell ON cell.card4 = c.card4 AND cell.P_emaildomain = d.P_emaildomain""",
)
register(
    "amount_histogram",
    BASE
    + """
SELECT risk_label AS label,
       CAST(least(floor(least(TransactionAmt, 500.0) / 10.0), 49) * 10 AS DOUBLE) AS bin_start,
       count(*) AS cnt
FROM silver GROUP BY ALL""",
)
SEEDED = "md5(CAST(CAST(TransactionID AS INTEGER) AS VARCHAR) || '-42')"
register(
    "legit_sample",
    BASE
    + f"""
SELECT TransactionID, least(TransactionAmt, 500.0) AS amount_capped
FROM silver WHERE isFraud = 0 ORDER BY {SEEDED} LIMIT 1000""",
)
TIER_RANK = """CASE amount_tier WHEN '$0-25' THEN 0 WHEN '$25-50' THEN 1 WHEN '$50-100' THEN 2
     WHEN '$100-200' THEN 3 WHEN '$200-500' THEN 4 WHEN '$500-1K' THEN 5 WHEN '$1K+' THEN 6 END"""
register(
    "tier_status_long",
    GOLD
    + f"""
SELECT amount_tier AS spend_range, {TIER_RANK} AS tier_rank, 'Flagged as Fraud' AS status,
       CAST(fraud_count AS BIGINT) AS cnt FROM gold_tier
UNION ALL
SELECT amount_tier, {TIER_RANK}, 'Legitimate', CAST(total_transactions - fraud_count AS BIGINT)
FROM gold_tier""",
)
register(
    "email_hotspots",
    GOLD
    + """
SELECT P_emaildomain, fraud_count, fraud_rate_pct FROM gold_email WHERE P_emaildomain <> '0'
ORDER BY fraud_count DESC, P_emaildomain LIMIT 12""",
)
register(
    "key_findings",
    GOLD
    + f"""
(SELECT 'riskiest_card_network' AS finding, {_title('card4')} AS segment, fraud_rate_pct AS value
 FROM gold_card WHERE card4 <> '0' ORDER BY fraud_rate_pct DESC, segment LIMIT 1)
UNION ALL
(SELECT 'safest_card_network', {_title('card4')} AS segment, fraud_rate_pct
 FROM gold_card WHERE card4 <> '0' ORDER BY fraud_rate_pct, segment LIMIT 1)
UNION ALL
(SELECT 'riskiest_email_domain', P_emaildomain, fraud_rate_pct
 FROM gold_email WHERE P_emaildomain <> '0' ORDER BY fraud_rate_pct DESC, P_emaildomain LIMIT 1)
UNION ALL
(SELECT 'most_fraud_email_domain', P_emaildomain, fraud_count
 FROM gold_email WHERE P_emaildomain <> '0' ORDER BY fraud_count DESC, P_emaildomain LIMIT 1)
UNION ALL
(SELECT 'riskiest_spend_range', amount_tier, fraud_rate_pct
 FROM gold_tier ORDER BY fraud_rate_pct DESC, amount_tier LIMIT 1)
UNION ALL
SELECT 'estimated_exposure', NULL, round(avg_fraud_amt * fraud_count, 2) FROM gold_summary""",
)
register(
    "estimated_exposure",
    GOLD
    + """
SELECT fraud_count, avg_fraud_amt, round(avg_fraud_amt * fraud_count, 2) AS exposure FROM gold_summary""",
)
register(
    "top_flagged",
    BASE
    + f"""
SELECT TransactionAmt AS amount, {_title('card4')} AS card_network, {_title('card6')} AS card_type,
       CASE WHEN P_emaildomain <> '0' THEN P_emaildomain ELSE 'Unknown' END AS email_domain,
       'Fraud' AS status
FROM (SELECT DISTINCT TransactionAmt, card4, card6, P_emaildomain FROM silver WHERE isFraud = 1)
ORDER BY TransactionAmt DESC, card4, card6, P_emaildomain LIMIT 10""",
)
register(
    "headline_metrics",
    GOLD
    + """
SELECT coalesce(total_transactions, 0) AS transactions_monitored, coalesce(fraud_count, 0) AS fraud_alerts,
       coalesce(legit_count, 0) AS cleared, coalesce(fraud_rate_pct, 0.0) AS fraud_rate_pct,
       coalesce(avg_transaction_amt, 0.0) AS avg_transaction_amt, coalesce(avg_fraud_amt, 0.0) AS avg_fraud_amt
FROM gold_summary""",
)
register(
    "headline_text",
    GOLD
    + """
SELECT format('{:,}', total_transactions) AS transactions_text, format('{:,}', fraud_count) AS alerts_text,
       format('{:,}', legit_count) AS cleared_text, printf('%.2f%%', fraud_rate_pct) AS rate_text,
       '$' || format('{:,}', CAST(round(coalesce(avg_fraud_amt, 0.0) * fraud_count) AS BIGINT)) AS exposure_text
FROM gold_summary""",
)
register(
    "literal_requests",
    BASE
    + f"""
SELECT TransactionID, TransactionAmt, lower({_title('card4')}) AS card4, lower({_title('card6')}) AS card6,
       CASE P_emaildomain WHEN 'd0.com' THEN 'gmail.com' WHEN 'd1.com' THEN 'yahoo.com' WHEN 'd2.com' THEN 'hotmail.com'
            WHEN 'd3.com' THEN 'outlook.com' WHEN 'd4.com' THEN 'protonmail.com' ELSE 'unknown' END AS P_emaildomain
FROM silver""",
)

# --- features and evaluation ------------------------------------------------
CATEGORIES = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", "M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M9"]
NUMBERS = (
    ["TransactionAmt", "card1", "card2", "card3", "card5", "addr1", "addr2", "dist1"]
    + [f"C{k}" for k in range(1, 15)]
    + [f"D{k}" for k in range(1, 6)]
)
FEATURE_COLS = ", ".join(["TransactionID", *NUMBERS, *CATEGORIES, "isFraud"])
RAW = (
    "WITH "
    + TXN.replace("FROM lineitem", ", l_orderkey, l_partkey, l_suppkey, l_discount, l_linestatus FROM lineitem")
    + ","
    + dedup_cte("txn")
    + """,
wide AS (
  SELECT d.*, CAST(p_size AS DOUBLE) AS card3, CAST(c_nationkey AS DOUBLE) AS card5,
         CAST(c_nationkey * 100 + s_nationkey AS DOUBLE) AS addr1, CAST(s_nationkey AS DOUBLE) AS addr2,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS dist1,
         CASE WHEN o_custkey % 30 < 28 THEN 'd' || CAST(o_custkey % 30 AS VARCHAR) || '.com' WHEN o_custkey % 30 = 28 THEN '0' END AS R_emaildomain,
         round(l_discount * 100) AS C3, o_totalprice AS C4, p_retailprice AS C5, c_acctbal AS C6, s_acctbal AS C7,
         CAST(l_partkey % 100 AS DOUBLE) AS C8, CAST(o_custkey % 50 AS DOUBLE) AS C9, CAST(l_suppkey % 10 AS DOUBLE) AS C10,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(kafka_timestamp AS DATE)) AS DOUBLE) AS C11,
         CAST(month(o_orderdate) AS DOUBLE) AS C12, CAST(year(o_orderdate) AS DOUBLE) AS C13, C1 * C2 AS C14,
         TransactionDT AS D2, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS D3,
         CAST(day(kafka_timestamp) AS DOUBLE) AS D5,
         o_orderstatus AS M1, o_orderpriority AS M2, c_mktsegment AS M3, p_brand AS M4, p_type AS M5, l_linestatus AS M6,
         CASE WHEN l_discount > 0.05 THEN 'T' WHEN l_discount > 0 THEN 'F' END AS M7,
         'N' || CAST(c_nationkey AS VARCHAR) AS M8, split_part(p_name, ' ', 1) AS M9
  FROM dedup d LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
),
raw AS (
  SELECT * REPLACE (TRY_CAST(TransactionID AS INTEGER) AS TransactionID), CASE WHEN C11 >= 0 THEN C11 END AS D4
  FROM wide WHERE TRY_CAST(TransactionID AS INTEGER) IS NOT NULL
),
imputed AS (
  SELECT TransactionID, isFraud, """
    + ", ".join(f"CASE WHEN {c} IS NULL OR isnan({c}) THEN -999.0 ELSE {c} END AS {c}" for c in NUMBERS)
    + ", "
    + ", ".join(f"coalesce({c}, 'nan') AS {c}" for c in CATEGORIES)
    + """
  FROM raw
)"""
)


def _codes(suffix: str) -> str:
    return ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}{suffix}" for c in CATEGORIES)


register("feature_projection", RAW + f"\nSELECT {FEATURE_COLS} FROM raw")
register("feature_impute", RAW + f"\nSELECT {FEATURE_COLS} FROM imputed")
register("label_encode", RAW + f"\nSELECT TransactionID, {_codes('_ix')} FROM imputed")
SPLIT = (
    BASE
    + f""",
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY {SEEDED}, TransactionID) AS rn,
         count(*) OVER (PARTITION BY isFraud) AS n_class
  FROM silver
),
split AS (
  SELECT *, CASE WHEN rn <= (n_class * 80 + 99) // 100 THEN 'train' ELSE 'test' END AS split FROM ranked
)"""
)
register("stratified_split", SPLIT + "\nSELECT isFraud, split, count(*) AS cnt FROM split GROUP BY ALL")
register(
    "class_weights",
    SPLIT
    + """
SELECT count_if(isFraud = 0) AS neg, count_if(isFraud = 1) AS pos,
       round(count_if(isFraud = 0) / count_if(isFraud = 1), 6) AS pos_weight,
       round(count(*) / (2 * count_if(isFraud = 0)), 6) AS balanced_neg,
       round(count(*) / (2 * count_if(isFraud = 1)), 6) AS balanced_pos
FROM split WHERE split = 'train'""",
)
register(
    "stable_split",
    BASE
    + """
SELECT isFraud, CASE WHEN CAST('0x' || substr(md5(CAST(TransactionID AS VARCHAR) || '-42'), 1, 8) AS BIGINT) * 100 < 4294967296 * 80
                     THEN 'train' ELSE 'test' END AS split, count(*) AS cnt
FROM silver GROUP BY ALL""",
)
register(
    "auc_by_round",
    BASE
    + """,
staged AS (
  SELECT r AS round, isFraud, D1 * r + C1 * (5 - r) + CASE WHEN ProductCD = 'R' THEN r ELSE 0 END AS s
  FROM silver, (SELECT unnest(range(1, 6)) AS r)
),
st AS (SELECT round, s, count_if(isFraud = 1) AS pos, count_if(isFraud = 0) AS neg FROM staged GROUP BY ALL),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY round ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM st)
SELECT CAST(round AS INTEGER) AS round, round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM cum GROUP BY 1""",
)
register("label_rate", "WITH " + TXN + "\nSELECT round(avg(isFraud), 6) AS rate FROM txn")
SCORED = (
    BASE
    + """,
scored AS (
  SELECT TransactionID, TransactionAmt, card1, isFraud, D1 / 10.0 + CASE WHEN ProductCD = 'R' THEN 0.1 ELSE 0.0 END AS score FROM silver
),
pred AS (SELECT isFraud, CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM scored)"""
)
register(
    "roc_auc",
    SCORED
    + """,
st AS (SELECT score AS s, count_if(isFraud = 1) AS pos, count_if(isFraud = 0) AS neg FROM scored GROUP BY 1),
cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM st)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM cum""",
)
register(
    "classification_report",
    SCORED
    + """,
cm AS (
  SELECT CAST(count_if(isFraud = 0 AND prediction = 0) AS DOUBLE) AS tn,
         CAST(count_if(isFraud = 0 AND prediction = 1) AS DOUBLE) AS fp,
         CAST(count_if(isFraud = 1 AND prediction = 0) AS DOUBLE) AS fn,
         CAST(count_if(isFraud = 1 AND prediction = 1) AS DOUBLE) AS tp
  FROM pred
),
pr AS (
  SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
         coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
         tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n
  FROM cm
),
f AS (
  SELECT *, coalesce(p0 * r0 * 2 / nullif(p0 + r0, 0), 0) AS f0, coalesce(p1 * r1 * 2 / nullif(p1 + r1, 0), 0) AS f1
  FROM pr
)
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round((tn + tp) / n, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
                 round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM f""",
)

# --- sources and sinks ------------------------------------------------------
TXN_ONLY = "WITH " + TXN
register(
    "replay_capped_scan",
    TXN_ONLY
    + f"""
SELECT {BRONZE_COLS}, {TS_TEXT} FROM txn
ORDER BY TransactionID, kafka_timestamp, TransactionAmt, card1 LIMIT 10000""",
)
register("csv_scan", TXN_ONLY + f"\nSELECT {BRONZE_COLS}, {TS_TEXT} FROM txn")
register("parquet_glob_scan", TXN_ONLY + f"\nSELECT {BRONZE_COLS}, {TS_TEXT} FROM txn")
register("bronze_parse", TXN_ONLY + f"\nSELECT {BRONZE_COLS}, {TS_TEXT} FROM txn")
register(
    "replay_messages",
    TXN_ONLY
    + """
SELECT CAST(TRY_CAST(coalesce(TransactionID, 0) AS INTEGER) AS VARCHAR) AS key,
       coalesce(TransactionID, 0) AS transaction_id, coalesce(TransactionAmt, 0) AS amount,
       coalesce(card4, '0') AS card4
FROM txn""",
)
register("gold_overwrite", GOLD + "\nSELECT * FROM gold_summary")
register(
    "silver_append_idempotent",
    BASE + "\nSELECT count(*) AS total_rows, count(DISTINCT TransactionID) AS distinct_ids FROM silver",
)

# --- streaming --------------------------------------------------------------
EV_ONLY = "WITH " + EV
register(
    "stream_bronze",
    EV_ONLY
    + f"""
SELECT {BRONZE_COLS}, {TS_TEXT} FROM ev
UNION ALL
SELECT {BRONZE_COLS}, {TS_TEXT} FROM ev""",
)
register("stream_bronze_restart", EV_ONLY + f"\nSELECT {BRONZE_COLS}, {TS_TEXT} FROM ev")
EV_SILVER = "WITH " + EV + "," + dedup_cte("ev", "ev_dedup") + "," + silver_cte("ev_dedup", "ev_silver")
register("stream_silver", BASE + f"\nSELECT {BRONZE_COLS}, risk_label, row_hash, {TS_TEXT} FROM silver")
register(
    "exposure_trend",
    EV_SILVER
    + """,
d AS (
  SELECT CAST(kafka_timestamp AS DATE) AS d,
         round(sum(CASE WHEN isFraud = 1 THEN TransactionAmt ELSE 0.0 END), 2) AS exposure
  FROM ev_silver GROUP BY 1
)
SELECT strftime(d, '%Y-%m-%d') AS day, exposure, round(exposure - lag(exposure) OVER (ORDER BY d), 2) AS change
FROM d""",
)
register("gold_incremental", ORACLE["gold_rollups_single_scan"])
register("stream_exposure_trend", ORACLE["exposure_trend"])
register(
    "silver_quarantine",
    TXN_ONLY.rstrip()
    + f""",
sent AS (SELECT *, CAST(C2 AS BIGINT) % 25 AS k FROM txn),
kept AS (
  SELECT * EXCLUDE (k) REPLACE (CASE k WHEN 1 THEN TransactionID + 3e9 END AS TransactionID),
         CASE k WHEN 1 THEN 'id out of range' ELSE 'no id' END AS reason, TransactionAmt AS raw_amount, CAST(NULL AS VARCHAR) AS raw_text
  FROM sent WHERE k IN (0, 1)
  UNION ALL
  SELECT {", ".join("NULL" for _ in range(13))}, kafka_timestamp, 'malformed', NULL, '{{broken ' || CAST(CAST(round(TransactionAmt * 100) AS BIGINT) AS VARCHAR)
  FROM sent WHERE k = 2
)
SELECT {BRONZE_COLS}, {TS_TEXT}, reason, raw_amount, raw_text FROM (SELECT * FROM kept UNION ALL SELECT * FROM kept)""",
)


def _auc(name: str, expr: str) -> str:
    """CTEs that end in ``auc_<name>``: the rounded AUC of a score expression over ``scored``."""
    return f""",
st_{name} AS (SELECT {expr} AS s, count_if(isFraud = 1) AS pos, count_if(isFraud = 0) AS neg FROM scored GROUP BY 1),
cum_{name} AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM st_{name}),
auc_{name} AS (SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM cum_{name})"""


register(
    "comparison_fixed_scores",
    SCORED
    + _auc("amount", "TransactionAmt")
    + _auc("card", "card1")
    + _auc("fixed", "score")
    + """,
compared AS (
  SELECT 'amount' AS model, auc FROM auc_amount UNION ALL SELECT 'card', auc FROM auc_card UNION ALL SELECT 'fixed', auc FROM auc_fixed
)
SELECT model, auc, row_number() OVER (ORDER BY auc DESC, model) = 1 AS is_best FROM compared""",
)
register("metrics_roundtrip", ORACLE["comparison_fixed_scores"])
register(
    "headline_detection",
    f"""SELECT h.*, round(a.auc * 100, 2) AS detection_pct
FROM ({ORACLE["headline_metrics"]}) h, ({ORACLE["roc_auc"]}) a""",
)
register(
    "verdict_fixed_score",
    SCORED
    + """
SELECT TransactionID, round(score, 6) AS score, round(score * 100, 1) AS pct,
       CASE WHEN score > 0.5 THEN 'HIGH RISK — DO NOT APPROVE' ELSE 'LOW RISK — SAFE TO APPROVE' END AS verdict
FROM scored""",
)
_CONSTANTS = {
    "card1": 9000, "card2": 300, "card3": 150, "card5": 226, "addr1": 315, "addr2": 87, "dist1": 0,
    **{f"C{k}": int(k in (1, 2, 6, 11, 13, 14)) for k in range(1, 15)},
    "D1": 10, "D2": 0, "D3": 0, "D4": 0, "D5": 0,
    "ProductCD_code": 2, "R_emaildomain_code": 0, **{f"M{k}_code": int(k < 7) for k in range(1, 10)},
}
register(
    "request_features",
    f"""SELECT TransactionID, TransactionAmt, card4, card6, P_emaildomain, {", ".join(f"CAST({v} AS DOUBLE) AS {c}" for c, v in _CONSTANTS.items())}
FROM ({ORACLE["literal_requests"]})""",
)
register("assembled_features", RAW + f"\nSELECT TransactionID, {', '.join(NUMBERS)}, {_codes('_code')} FROM imputed")
register("tree_table_scores", RAW + "\nSELECT count(*) AS rows_scored, CAST(0 AS BIGINT) AS rows_differing FROM raw")
register("stream_tree_scores", "SELECT count(*) AS rows_scored, CAST(0 AS BIGINT) AS rows_differing FROM events")
register(
    "fit_certificates",
    SPLIT
    + """
SELECT model, (SELECT count(*) FROM split WHERE split = 'train') AS rows, true AS within
FROM (SELECT unnest(['Gradient Boosting', 'Logistic Regression']) AS model)""",
)
register(
    "saved_model_scores",
    RAW + "\nSELECT count(*) AS rows_scored, CAST(0 AS BIGINT) AS rows_changed, CAST(0 AS BIGINT) AS rows_outside FROM raw",
)
