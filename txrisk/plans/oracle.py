"""Independent DuckDB SQL for the registered queries.

Each string runs on a DuckDB connection where the test tables are views
(``events`` among them).  The transaction mapping and the enrichment are
common table expressions; rounded ratios use exact integer HALF_UP
arithmetic (DuckDB divides decimals in DOUBLE), so both engines agree to
the last bit.
"""

from __future__ import annotations

# 2**32 times the distribution function of a Poisson count of mean 1,
# rounded down, for counts from 0.
POISSON_STEPS = (1580030168, 3160060337, 3950075421, 4213413783, 4279248373, 4292415291, 4294609777, 4294923276, 4294962463, 4294966817, 4294967252, 4294967292, 4294967295)

TX = """
ev AS (
  SELECT event_id AS tx_id,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) + 1 AS INTEGER) AS step,
         CASE event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'click' THEN 'CASH_OUT'
                         WHEN 'view' THEN 'PAYMENT' WHEN 'signup' THEN 'CASH_IN'
                         ELSE 'DEBIT' END AS type,
         CAST(round(value * 100) AS BIGINT) AS c,
         user_id AS uid
  FROM events),
lab AS (
  SELECT *, CASE WHEN type IN ('TRANSFER', 'CASH_OUT')
                  AND (tx_id * 7919) % 1000 < (CASE WHEN step > 600 THEN 60 ELSE 20 END)
                                             + (CASE WHEN c > 10000 THEN 100 ELSE 0 END)
                 THEN 1 ELSE 0 END AS f
  FROM ev),
bal AS (
  SELECT *, CASE WHEN f = 1 THEN c ELSE (tx_id * 104729) % 20000 END AS ob,
            (uid * 3100 + step * 17) % 100000 AS od
  FROM lab),
tx AS (
  SELECT tx_id, step, type,
         CAST(CAST(c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS amount,
         'C' || CAST(CASE WHEN tx_id % 20 = 0 THEN uid ELSE 1000000 + tx_id END AS VARCHAR) AS nameOrig,
         CAST(CAST(ob AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS oldbalanceOrg,
         CAST(CAST(greatest(ob - c, 0) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS newbalanceOrig,
         'M' || CAST(uid AS VARCHAR) AS nameDest,
         CAST(CAST(od AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS oldbalanceDest,
         CAST(CAST(CASE WHEN (f = 1 AND tx_id % 2 = 0) OR (f = 0 AND tx_id % 10 = 0)
                        THEN od ELSE od + c END AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS newbalanceDest,
         CAST(f AS INTEGER) AS isFraud,
         CAST(CASE WHEN type = 'TRANSFER' AND c > 15000 THEN 1 ELSE 0 END AS INTEGER) AS isFlaggedFraud
  FROM bal)"""

RISKY = """
risky AS (SELECT * FROM tx WHERE type IN ('TRANSFER', 'CASH_OUT'))"""

ENRICHED = RISKY + """,
vel AS (
  SELECT *, count(*) OVER w AS dest_tx_last_24h, sum(amount) OVER w AS dest_amount_last_24h
  FROM risky
  WINDOW w AS (PARTITION BY nameDest ORDER BY step RANGE BETWEEN 24 PRECEDING AND CURRENT ROW)),
dif AS (
  SELECT *, round(oldbalanceOrg - newbalanceOrig - amount, 2) AS orig_balance_diff,
            round(newbalanceDest - oldbalanceDest - amount, 2) AS dest_balance_diff
  FROM vel),
enriched AS (
  SELECT *, CAST(abs(orig_balance_diff) > 0.01 AS INTEGER) AS orig_balance_mismatch,
            CAST(abs(dest_balance_diff) > 0.01 AS INTEGER) AS dest_balance_mismatch
  FROM dif),
test AS (SELECT * FROM enriched WHERE step > 600),
train AS (SELECT * FROM enriched WHERE step <= 600)"""

TX_COLS = ("tx_id, step, type, CAST(amount AS DOUBLE) AS amount, nameOrig, "
           "CAST(oldbalanceOrg AS DOUBLE) AS oldbalanceOrg, CAST(newbalanceOrig AS DOUBLE) AS newbalanceOrig, "
           "nameDest, CAST(oldbalanceDest AS DOUBLE) AS oldbalanceDest, "
           "CAST(newbalanceDest AS DOUBLE) AS newbalanceDest, isFraud, isFlaggedFraud")


def hu(p: str, q: str, digits: int, scale: int = 0) -> str:
    """HALF_UP(p / q) to ``digits`` decimals as DOUBLE; p has ``scale``
    decimals, q is an integer; NULL when q is 0 or NULL."""
    P = f"CAST(({p}) * {10 ** scale} AS HUGEINT)"
    Q = f"(CAST(({q}) AS HUGEINT) * {10 ** scale})"
    m = 10 ** digits
    return (f"(CASE WHEN ({q}) IS NULL OR ({q}) = 0 THEN NULL ELSE "
            f"CAST(sign({P}) * ((2 * abs({P}) * {m} + {Q}) // (2 * {Q})) AS DOUBLE) / {float(m)} END)")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    W_TX = _with(TX)
    W_R = _with(TX, RISKY)
    W_E = _with(TX, ENRICHED)

    q["risky_filter"] = W_TX + f"SELECT {TX_COLS} FROM tx WHERE type IN ('TRANSFER', 'CASH_OUT')"
    q["overview"] = W_TX + """SELECT count(*) AS tx_count,
  count(DISTINCT nameOrig) + coalesce(max(CASE WHEN nameOrig IS NULL THEN 1 ELSE 0 END), 0) AS origins,
  count(DISTINCT nameDest) + coalesce(max(CASE WHEN nameDest IS NULL THEN 1 ELSE 0 END), 0) AS destinations
FROM tx"""
    q["risky_overview"] = W_R + """SELECT count(*) AS tx_count,
  count(DISTINCT nameOrig) + coalesce(max(CASE WHEN nameOrig IS NULL THEN 1 ELSE 0 END), 0) AS origins,
  count(DISTINCT nameDest) + coalesce(max(CASE WHEN nameDest IS NULL THEN 1 ELSE 0 END), 0) AS destinations
FROM risky"""
    q["positive_rate"] = W_R + f"""SELECT rows, positives, {hu('positives * 100', 'rows', 3)} AS positive_rate_pct
FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE isFraud = 1) AS positives FROM risky)"""
    q["volume_by_type"] = W_TX + f"""SELECT type, count(*) AS tx_count,
  CAST(sum(amount) AS DOUBLE) AS total_amount,
  {hu('sum(amount)', 'count(amount)', 2, 2)} AS avg_amount
FROM tx GROUP BY type"""
    q["fraud_rate_by_type"] = W_TX + f"""SELECT type, count(*) AS total,
  CAST(sum(isFraud) AS BIGINT) AS fraud_count,
  {hu('sum(isFraud) * 100', 'count(*)', 4)} AS fraud_rate_pct
FROM tx GROUP BY type"""
    q["rule_recall"] = W_TX + f"""SELECT total_fraud, flagged_fraud,
  {hu('flagged_fraud * 100', 'total_fraud', 2)} AS recall_pct
FROM (SELECT count(*) FILTER (WHERE isFraud = 1) AS total_fraud,
             count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 1) AS flagged_fraud FROM tx)"""

    cf = f"""cf_raw AS (
  SELECT nameOrig, count(*) AS tx_count, sum(amount) AS s, count(amount) AS n, max(amount) AS mx,
         sum(CAST(round(amount * 100) AS HUGEINT)) AS s1,
         sum(CAST(round(amount * 100) AS HUGEINT) * CAST(round(amount * 100) AS HUGEINT)) AS s2,
         CAST(sum(CASE WHEN type = 'TRANSFER' THEN 1 ELSE 0 END) AS BIGINT) AS transfer_count,
         CAST(sum(CASE WHEN type = 'CASH_OUT' THEN 1 ELSE 0 END) AS BIGINT) AS cashout_count,
         CAST(sum(isFraud) AS BIGINT) AS fraud_count,
         sum(oldbalanceOrg) AS ob, count(oldbalanceOrg) AS obn,
         CAST(sum(CASE WHEN newbalanceOrig = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_balance_count
  FROM risky GROUP BY nameOrig),
cf AS (
  SELECT nameOrig, tx_count, s, CAST(s AS DOUBLE) AS total_sent,
         {hu('s', 'n', 2, 2)} AS avg_amount,
         CAST(mx AS DOUBLE) AS max_amount,
         CASE WHEN n > 1 THEN CAST(floor(sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE)
                                              / CAST(CAST(n AS HUGEINT) * (n - 1) AS DOUBLE)) + 0.5) AS DOUBLE) / 100.0
         END AS amount_stddev,
         transfer_count, cashout_count, fraud_count,
         {hu('ob', 'obn', 2, 2)} AS avg_balance_before,
         zero_balance_count,
         CAST(fraud_count > 0 AS INTEGER) AS is_fraud_customer
  FROM cf_raw)"""
    q["customer_features"] = _with(TX, RISKY, cf) + "SELECT * EXCLUDE (s) FROM cf"
    q["top_customers"] = _with(TX, RISKY, cf) + \
        "SELECT * EXCLUDE (s) FROM cf ORDER BY total_sent DESC NULLS LAST, nameOrig ASC NULLS LAST LIMIT 10"
    q["customer_profile"] = _with(TX, RISKY, cf) + f"""SELECT is_fraud_customer,
  count(*) AS customer_count,
  {hu('sum(tx_count)', 'count(tx_count)', 2)} AS avg_tx_count,
  {hu('sum(s)', 'count(total_sent)', 2, 2)} AS avg_total_sent,
  {hu('sum(CAST(avg_amount AS DECIMAL(18,2)))', 'count(avg_amount)', 2, 2)} AS avg_tx_amount,
  {hu('sum(zero_balance_count)', 'count(zero_balance_count)', 2)} AS avg_account_drains
FROM cf GROUP BY is_fraud_customer"""

    df_ = """df AS (
  SELECT nameDest, count(*) AS times_received, sum(amount) AS total_received,
         CAST(sum(isFraud) AS BIGINT) AS fraud_received
  FROM risky GROUP BY nameDest)"""
    q["dest_frequency"] = _with(TX, RISKY, df_) + \
        "SELECT nameDest, times_received, CAST(total_received AS DOUBLE) AS total_received, fraud_received FROM df"
    q["dest_reuse_histogram"] = _with(TX, RISKY, df_) + """SELECT times_received, count(*) AS "count"
FROM df GROUP BY times_received ORDER BY "count" DESC, times_received ASC LIMIT 10"""
    q["fraud_destinations"] = _with(TX, RISKY, df_) + """SELECT nameDest, times_received,
  CAST(total_received AS DOUBLE) AS total_received, fraud_received
FROM df WHERE fraud_received > 0 ORDER BY times_received DESC, nameDest ASC NULLS LAST LIMIT 10"""

    q["dest_velocity"] = W_E + """SELECT tx_id, nameDest, step, dest_tx_last_24h,
  CAST(dest_amount_last_24h AS DOUBLE) AS dest_amount_last_24h FROM enriched"""
    q["reconcile"] = W_E + """SELECT tx_id, CAST(orig_balance_diff AS DOUBLE) AS orig_balance_diff,
  CAST(dest_balance_diff AS DOUBLE) AS dest_balance_diff, orig_balance_mismatch, dest_balance_mismatch
FROM enriched"""
    q["enriched_transactions"] = W_E + f"""SELECT {TX_COLS}, dest_tx_last_24h,
  CAST(dest_amount_last_24h AS DOUBLE) AS dest_amount_last_24h,
  CAST(orig_balance_diff AS DOUBLE) AS orig_balance_diff,
  CAST(dest_balance_diff AS DOUBLE) AS dest_balance_diff,
  orig_balance_mismatch, dest_balance_mismatch FROM enriched"""
    q["velocity_by_label"] = W_E + f"""SELECT isFraud, count(*) AS tx_count,
  {hu('sum(dest_tx_last_24h)', 'count(dest_tx_last_24h)', 2)} AS avg_dest_velocity_24h,
  {hu('sum(dest_amount_last_24h)', 'count(dest_amount_last_24h)', 2, 2)} AS avg_dest_amount_24h
FROM enriched GROUP BY isFraud"""
    mm = f"""mm AS (SELECT isFraud, count(*) AS tx_count,
  {hu('sum(orig_balance_mismatch) * 100', 'count(orig_balance_mismatch)', 2)} AS orig_mismatch_pct,
  {hu('sum(dest_balance_mismatch) * 100', 'count(dest_balance_mismatch)', 2)} AS dest_mismatch_pct
FROM enriched GROUP BY isFraud)"""
    q["mismatch_by_label"] = _with(TX, ENRICHED, mm) + "SELECT * FROM mm"
    q["mismatch_long"] = _with(TX, ENRICHED, mm) + """SELECT isFraud, 'origin' AS side, orig_mismatch_pct AS mismatch_pct FROM mm
UNION ALL SELECT isFraud, 'destination' AS side, dest_mismatch_pct AS mismatch_pct FROM mm"""

    q["velocity_windows"] = W_E + """SELECT DISTINCT nameDest, step, dest_tx_last_24h,
  CAST(dest_amount_last_24h AS DOUBLE) AS dest_amount_last_24h FROM enriched"""

    sl = """sl AS (SELECT * FROM tx WHERE type IN ('TRANSFER', 'CASH_OUT', 'PAYMENT')
               AND step >= 100 AND step <= 600)"""
    q["slice_view"] = _with(TX, sl) + f"SELECT {TX_COLS} FROM sl"
    q["slice_domain"] = W_TX + """SELECT string_agg(DISTINCT type, ',' ORDER BY type) AS types,
  min(step) AS step_min, max(step) AS step_max FROM tx"""
    q["slice_summary"] = _with(TX, sl) + \
        "SELECT count(*) AS rows, CAST(coalesce(sum(isFraud), 0) AS BIGINT) AS fraud FROM sl"
    q["kpis"] = W_TX + f"""SELECT transactions, fraud_cases,
  coalesce({hu('fraud_cases * 100', 'n', 3)}, 0.0) AS fraud_rate_pct, origins, destinations
FROM (SELECT count(*) AS transactions, CAST(coalesce(sum(isFraud), 0) AS BIGINT) AS fraud_cases,
             count(isFraud) AS n, count(DISTINCT nameOrig) AS origins,
             count(DISTINCT nameDest) AS destinations FROM tx)"""
    q["activity_by_step"] = W_TX + """SELECT step, count(amount) AS transactions,
  CAST(sum(isFraud) AS BIGINT) AS fraud FROM tx GROUP BY step"""
    q["top_destinations"] = W_TX + """SELECT nameDest, count(amount) AS times_received,
  CAST(sum(amount) AS DOUBLE) AS total_received, CAST(sum(isFraud) AS BIGINT) AS fraud_received
FROM tx WHERE type IN ('TRANSFER', 'CASH_OUT') GROUP BY nameDest
ORDER BY times_received DESC, nameDest ASC NULLS LAST LIMIT 10"""
    q["amount_histogram"] = W_TX + """, v AS (
  SELECT isFraud, CAST(round(log10(CAST(amount AS DOUBLE) + 1.0) * 1e6) AS BIGINT) AS v
  FROM tx WHERE amount IS NOT NULL),
b AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
k AS (SELECT isFraud, CASE WHEN hi > lo THEN least(59, ((v - lo) * 60) // (hi - lo)) ELSE 0 END AS bin,
             lo, hi - lo AS width FROM v, b)
SELECT isFraud, bin,
  CAST(lo * 60 + bin * width AS DOUBLE) / 60000000.0 AS bin_lo,
  CAST(lo * 60 + (bin + 1) * width AS DOUBLE) / 60000000.0 AS bin_hi,
  count(*) AS "count"
FROM k GROUP BY isFraud, bin, lo, width"""
    q["split_summary"] = W_E + f"""SELECT split, rows, positives,
  {hu('positives * 100', 'rows', 3)} AS positive_rate_pct
FROM (SELECT CASE WHEN step <= 600 THEN 'train' ELSE 'test' END AS split, count(*) AS rows,
             count(*) FILTER (WHERE isFraud = 1) AS positives
      FROM enriched WHERE step IS NOT NULL GROUP BY 1)"""
    q["time_split"] = W_E + """SELECT tx_id, step, CASE WHEN step <= 600 THEN 'train' ELSE 'test' END AS split
FROM enriched WHERE step IS NOT NULL"""
    q["legit_sample"] = W_TX + """SELECT tx_id, step, type, CAST(amount AS DOUBLE) AS amount, isFraud
FROM tx WHERE isFraud = 0 ORDER BY md5('42' || CAST(tx_id AS VARCHAR)), tx_id LIMIT 50000"""
    q["stratified_sample"] = W_TX + """SELECT tx_id, step, type, CAST(amount AS DOUBLE) AS amount, isFraud
FROM tx WHERE isFraud = 1
UNION ALL
SELECT tx_id, step, type, CAST(amount AS DOUBLE) AS amount, isFraud FROM (
  SELECT *, row_number() OVER (ORDER BY md5('42' || CAST(tx_id AS VARCHAR)), tx_id) AS rn
  FROM tx WHERE isFraud = 0)
WHERE rn <= greatest(500000 - (SELECT count(*) FROM tx WHERE isFraud = 1), 0)"""

    q["class_weight"] = W_E + """SELECT tx_id, isFraud,
  CASE WHEN isFraud = 1 THEN (SELECT CASE WHEN p > 0 THEN CAST(n AS DOUBLE) / CAST(p AS DOUBLE) END
                              FROM (SELECT count(*) FILTER (WHERE isFraud = 1) AS p,
                                           count(*) FILTER (WHERE isFraud <> 1) AS n FROM train))
       ELSE 1.0 END AS class_weight
FROM train"""
    q["type_index"] = W_E + """SELECT type, CAST(row_number() OVER (ORDER BY "count" DESC, type) - 1 AS INTEGER) AS type_idx,
  "count" FROM (SELECT type, count(*) AS "count" FROM train GROUP BY type)"""

    conf = """conf AS (SELECT count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 1) AS tp,
                      count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 0) AS fn,
                      count(*) FILTER (WHERE isFraud = 0 AND isFlaggedFraud = 1) AS fp,
                      count(*) FILTER (WHERE isFraud = 0 AND isFlaggedFraud = 0) AS tn FROM test)"""
    q["confusion_rule"] = _with(TX, ENRICHED, conf) + "SELECT tp, fn, fp, tn FROM conf"
    q["confusion_cells"] = _with(TX, ENRICHED, conf) + """SELECT 1 AS actual, 1 AS predicted, tp AS n FROM conf
UNION ALL SELECT 1, 0, fn FROM conf UNION ALL SELECT 0, 1, fp FROM conf UNION ALL SELECT 0, 0, tn FROM conf"""
    q["prf_rule"] = _with(TX, ENRICHED, conf) + """SELECT tp, fn, fp, tn, precision, recall,
  CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS precision,
                CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS recall
      FROM conf)"""
    q["auc_amount"] = W_E + """, g AS (
  SELECT CAST(amount AS DOUBLE) AS score, count(*) FILTER (WHERE isFraud = 1) AS pos,
         count(*) FILTER (WHERE isFraud <> 1) AS neg
  FROM test WHERE amount IS NOT NULL AND isFraud IS NOT NULL GROUP BY 1),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM g)
SELECT CASE WHEN sum(pos) * sum(neg) > 0
            THEN CAST(sum(CAST(pos AS HUGEINT) * (2 * below + neg)) AS DOUBLE)
                 / CAST(2 * CAST(sum(pos) AS HUGEINT) * sum(neg) AS DOUBLE) END AS auc
FROM c"""
    q["rule_baseline_test"] = W_E + f"""SELECT test_fraud, baseline_tp,
  {hu('baseline_tp * 100', 'test_fraud', 3)} AS baseline_recall_pct
FROM (SELECT count(*) FILTER (WHERE isFraud = 1) AS test_fraud,
             count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 1) AS baseline_tp FROM test)"""
    q["rule_false_negatives"] = W_E + """SELECT tx_id, step, type, CAST(amount AS DOUBLE) AS amount
FROM test WHERE isFraud = 1 AND isFlaggedFraud = 0 ORDER BY tx_id"""
    q["rule_false_negatives_top"] = q["rule_false_negatives"] + " LIMIT 10"
    q["rule_false_positives"] = W_E + """SELECT tx_id, step, type, CAST(amount AS DOUBLE) AS amount
FROM test WHERE isFraud = 0 AND isFlaggedFraud = 1 ORDER BY tx_id"""
    q["rule_metrics_by_band"] = W_E + """SELECT band,
  CAST([0, 100, 1000, 10000, 100000, 1000000][band + 1] AS DOUBLE) AS band_lo,
  CAST([100, 1000, 10000, 100000, 1000000, NULL][band + 1] AS DOUBLE) AS band_hi,
  rows, tp, fn, fp,
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS recall
FROM (SELECT CASE WHEN amount >= 1000000 THEN 5 WHEN amount >= 100000 THEN 4 WHEN amount >= 10000 THEN 3
                  WHEN amount >= 1000 THEN 2 WHEN amount >= 100 THEN 1 WHEN amount >= 0 THEN 0 END AS band,
             count(*) AS rows,
             count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 1) AS tp,
             count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 0) AS fn,
             count(*) FILTER (WHERE isFraud = 0 AND isFlaggedFraud = 1) AS fp
      FROM test GROUP BY 1)"""
    tc = """sc AS (
  SELECT CAST(least(101, greatest(-1, floor(CAST(amount AS DOUBLE) / (CAST(amount AS DOUBLE) + 100.0) * 100))) AS INTEGER) AS cell,
         isFraud FROM test WHERE amount IS NOT NULL AND isFraud IS NOT NULL),
tc AS (
  SELECT CAST(k AS INTEGER) AS k, CAST(k AS DOUBLE) / 100.0 AS threshold,
         (SELECT count(*) FROM sc WHERE isFraud = 1 AND cell < k) AS fn,
         (SELECT count(*) FROM sc WHERE isFraud <> 1 AND cell >= k) AS fp
  FROM range(0, 102) AS g(k)),
costs AS (SELECT k, threshold, fn, fp, 10.0 * fn + 1.0 * fp AS cost FROM tc)"""
    q["threshold_costs_amount"] = _with(TX, ENRICHED, tc) + \
        "SELECT k, threshold, fn, fp, CAST(cost AS DOUBLE) AS cost FROM costs"
    q["best_threshold_exact_amount"] = W_E + """, sc AS (
  SELECT CAST(amount AS DOUBLE) / (CAST(amount AS DOUBLE) + 100.0) AS s, isFraud
  FROM test WHERE amount IS NOT NULL AND isFraud IS NOT NULL),
t AS (SELECT DISTINCT s AS threshold FROM sc UNION ALL SELECT NULL),
c AS (SELECT threshold,
        (SELECT count(*) FROM sc WHERE isFraud = 1 AND (threshold IS NULL OR s < threshold)) AS fn,
        (SELECT count(*) FROM sc WHERE isFraud <> 1 AND threshold IS NOT NULL AND s >= threshold) AS fp FROM t)
SELECT threshold, fn, fp, CAST(10.0 * fn + 1.0 * fp AS DOUBLE) AS cost FROM c
ORDER BY cost, threshold ASC NULLS LAST LIMIT 1"""
    am = """am AS (SELECT *, CAST(amount AS DOUBLE) / (CAST(amount AS DOUBLE) + 100.0) AS p FROM test)"""
    q["score_histogram_amount"] = _with(TX, ENRICHED, am) + """SELECT isFraud,
  CAST(least(39, floor(p * 40)) AS INTEGER) AS bin, count(*) AS "count" FROM am GROUP BY 1, 2"""
    q["model_vs_rule_amount"] = _with(TX, ENRICHED, am) + """SELECT positives, model_tp, rule_tp,
  CASE WHEN positives > 0 THEN CAST(model_tp AS DOUBLE) / CAST(positives AS DOUBLE) ELSE 0.0 END AS model_recall,
  CASE WHEN positives > 0 THEN CAST(rule_tp AS DOUBLE) / CAST(positives AS DOUBLE) ELSE 0.0 END AS rule_recall,
  CASE WHEN rule_tp > 0 THEN CAST(model_tp AS DOUBLE) / CAST(rule_tp AS DOUBLE) END AS improvement
FROM (SELECT count(*) FILTER (WHERE isFraud = 1) AS positives,
             count(*) FILTER (WHERE isFraud = 1 AND p > 0.5) AS model_tp,
             count(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 1) AS rule_tp FROM am)"""
    for name, cond in (("amount_false_negatives", "isFraud = 1 AND NOT p > 0.5"),
                       ("amount_false_positives", "isFraud = 0 AND p > 0.5")):
        q[name] = _with(TX, ENRICHED, am) + f"""SELECT tx_id, step, type, CAST(amount AS DOUBLE) AS amount,
  p AS fraud_prob FROM am WHERE {cond} ORDER BY tx_id"""
    q["gbt_invariants"] = W_E + """SELECT count(*) AS rows, count(DISTINCT tx_id) AS ids,
  CAST(sum(isFraud) AS BIGINT) AS positives, CAST(0 AS BIGINT) AS violations FROM test"""
    q["best_threshold_amount"] = _with(TX, ENRICHED, tc) + \
        "SELECT k, threshold, fn, fp, CAST(cost AS DOUBLE) AS cost FROM costs ORDER BY cost, k LIMIT 1"

    for name in ("legit_sample_one_scan", "legit_sample_merged"):
        q[name] = q["legit_sample"]
    for name in ("arrival_velocity", "layout_velocity"):
        q[name] = q["dest_velocity"]
    q["clustered_table"] = W_TX + f"SELECT {TX_COLS} FROM tx"
    q["clustered_steps"] = W_TX + f"SELECT {TX_COLS} FROM tx WHERE step >= 300 AND step <= 340"
    q["clustered_account"] = W_TX + f"SELECT {TX_COLS} FROM tx WHERE nameDest = (SELECT min(nameDest) FROM tx)"
    q["customer_features_merged"] = q["customer_features"]
    q["dest_frequency_merged"] = q["dest_frequency"]
    q["cube_slices"] = W_TX + """, w AS (SELECT DISTINCT t.type, CAST(d.day * 24 AS INTEGER) AS step_lo, CAST(d.day * 24 + 71 AS INTEGER) AS step_hi
  FROM (SELECT DISTINCT type FROM tx) t,
       (SELECT unnest(range((SELECT min(step) // 24 FROM tx), (SELECT max(step) // 24 FROM tx) + 1)) AS day) d)
SELECT w.type, w.step_lo, w.step_hi, count(tx.tx_id) AS rows, count(amount) AS amounts,
  CAST(coalesce(sum(isFraud), 0) AS BIGINT) AS fraud, count(isFraud) AS labelled
FROM w LEFT JOIN tx ON tx.type = w.type AND tx.step BETWEEN w.step_lo AND w.step_hi GROUP BY ALL"""
    q["cube_kpis"] = _with(TX, sl) + f"""SELECT transactions, fraud_cases, coalesce({hu('fraud_cases * 100', 'n', 3)}, 0.0) AS fraud_rate_pct
FROM (SELECT count(*) AS transactions, CAST(coalesce(sum(isFraud), 0) AS BIGINT) AS fraud_cases, count(isFraud) AS n FROM sl)"""
    q["cube_activity"] = q["activity_by_step"]
    q["sketch_bounds"] = W_TX + """SELECT type, count(DISTINCT nameOrig) AS origins, count(DISTINCT nameDest) AS destinations,
  CAST(1 AS INTEGER) AS origins_within, CAST(1 AS INTEGER) AS destinations_within FROM tx GROUP BY type"""
    drawn = " + ".join(f"CAST(u >= {at} AS INTEGER)" for at in POISSON_STEPS)
    boot = f"""boot AS (SELECT *, {drawn} AS w FROM (
  SELECT r AS replicate, isFraud AS y, isFlaggedFraud AS rule, CAST(p > 0.5 AS INTEGER) AS pred,
    CAST('0x' || substr(md5('42:' || r || ':' || tx_id), 1, 8) AS BIGINT) AS u FROM am, (SELECT unnest(range(1, 51)) AS r))),
bc AS (SELECT CAST(replicate AS INTEGER) AS replicate,
  CAST(coalesce(sum(w) FILTER (WHERE y = 1 AND pred = 1), 0) AS BIGINT) AS tp, CAST(coalesce(sum(w) FILTER (WHERE y = 1 AND pred = 0), 0) AS BIGINT) AS fn,
  CAST(coalesce(sum(w) FILTER (WHERE y = 0 AND pred = 1), 0) AS BIGINT) AS fp, CAST(coalesce(sum(w) FILTER (WHERE y = 0 AND pred = 0), 0) AS BIGINT) AS tn,
  CAST(coalesce(sum(w) FILTER (WHERE y = 1 AND rule = 1), 0) AS BIGINT) AS rule_tp FROM boot WHERE w > 0 GROUP BY 1)"""
    q["bootstrap_confusion_amount"] = _with(TX, ENRICHED, am, boot) + "SELECT * FROM bc"
    q["bootstrap_intervals_amount"] = _with(TX, ENRICHED, am, boot) + """, v AS (
  SELECT replicate, unnest(['precision', 'recall', 'rule_recall', 'model_vs_rule']) AS metric, unnest([
    CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END,
    CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END,
    CASE WHEN tp + fn > 0 THEN CAST(rule_tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END,
    CASE WHEN rule_tp > 0 THEN CAST(tp AS DOUBLE) / CAST(rule_tp AS DOUBLE) END]) AS value FROM bc),
k AS (SELECT metric, value, row_number() OVER (PARTITION BY metric ORDER BY value, replicate) AS i,
             count(*) OVER (PARTITION BY metric) AS n FROM v WHERE value IS NOT NULL)
SELECT metric, max(value) FILTER (WHERE i = greatest(1, (n * 10 + 199) // 200)) AS low,
  max(value) FILTER (WHERE i = greatest(1, (n * 100 + 199) // 200)) AS median,
  max(value) FILTER (WHERE i = greatest(1, (n * 190 + 199) // 200)) AS high, max(n) AS replicates FROM k GROUP BY metric"""
    q["permuted_amount"] = W_E + """, a AS (SELECT tx_id, row_number() OVER (ORDER BY md5('take-42:' || tx_id), tx_id) AS i FROM test),
b AS (SELECT amount, row_number() OVER (ORDER BY md5('give-42:amount:' || tx_id), tx_id) AS i FROM test)
SELECT tx_id, CAST(amount AS DOUBLE) AS amount FROM a JOIN b USING (i)"""
    folds = """folds AS (SELECT risky.*, CAST(f.fold AS INTEGER) AS fold, CASE WHEN step <= f.origin THEN 'train' ELSE 'test' END AS split
  FROM risky JOIN (VALUES (1, 300), (2, 400), (3, 500), (4, 600)) AS f(fold, origin) ON step <= f.origin + 100)"""
    q["rolling_folds"] = _with(TX, RISKY, folds) + """SELECT fold, split, count(*) AS rows, count(*) FILTER (WHERE isFraud = 1) AS positives,
  min(step) AS step_min, max(step) AS step_max FROM folds GROUP BY fold, split"""
    q["rolling_origin"] = _with(TX, RISKY, folds) + """SELECT fold, count(*) FILTER (WHERE split = 'train') AS train_rows,
  count(*) FILTER (WHERE split = 'test') AS test_rows, count(*) FILTER (WHERE split = 'test' AND isFraud = 1) AS positives,
  CAST(1 AS INTEGER) AS valid FROM folds GROUP BY fold"""
    q["csv_roundtrip"] = W_TX + f"SELECT {TX_COLS.replace('tx_id, ', '', 1)} FROM tx"
    q["partitioned_roundtrip"] = q["clustered_table"]
    q["enriched_roundtrip"] = q["enriched_transactions"]
    q["predictions_roundtrip"] = W_E + """SELECT count(*) AS rows, CAST(sum(isFraud) AS BIGINT) AS positives, CAST(0 AS BIGINT) AS differing FROM test"""
    q["model_roundtrip"] = W_E + "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM test"
    q["importance_invariants"] = "SELECT CAST(12 AS BIGINT) AS features, CAST(0 AS BIGINT) AS negative, CAST(1 AS INTEGER) AS sum_is_one"
    q["ablation_invariants"] = """SELECT unnest(['full', 'no_balance_diffs', 'no_balance_at_all']) AS feature_set, CAST(1 AS INTEGER) AS valid"""
    q["ablation_long_invariants"] = """SELECT unnest(['full', 'no_balance_diffs', 'no_balance_at_all']) AS feature_set,
  CAST(4 AS BIGINT) AS metrics, CAST(0 AS BIGINT) AS outside"""
    q["estimator_invariants"] = """SELECT unnest(['gbt', 'logistic_regression', 'random_forest']) AS estimator, CAST(1 AS INTEGER) AS valid"""
    return q


def oracle_sql() -> dict[str, str]:
    return _sql()
