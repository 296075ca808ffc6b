"""Registered queries: daily gold aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold, roles
from .registry import case

DAY = "CAST(CAST(transaction_ts AS DATE) AS VARCHAR) AS period_date"


def both(name: str, cond: str) -> str:
    return (f"count(*) FILTER ({cond}) AS {name}_count, "
            f"CAST(sum(CASE WHEN {cond} THEN amount ELSE 0 END) AS DOUBLE) AS {name}_amount")


def total(col: str, name: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE) AS {name}"


CROSS = f"""{both('inbound', "direction = 'INBOUND'")}, {both('outbound', "direction = 'OUTBOUND'")},
  CAST(sum(CASE WHEN direction = 'INBOUND' THEN amount ELSE 0 END) - sum(CASE WHEN direction = 'OUTBOUND' THEN amount ELSE 0 END) AS DOUBLE) AS net_amount,
  {both('on_us', 'is_on_us')}"""


@case("gold_by_payment_type", "txn", f"""
SELECT tenant_id, {DAY}, payment_type, count(*) AS txn_count, {total('amount', 'total_amount')}, CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount,
  {both('inbound', "direction = 'INBOUND'")}, {both('outbound', "direction = 'OUTBOUND'")}, {both('on_us', 'is_on_us')}, {both('off_us', 'NOT is_on_us')},
  {both('return', 'return_reason_code IS NOT NULL')}, count(*) FILTER (is_recurring) AS recurring_count,
  count(*) FILTER (settlement_currency_code IS NOT NULL) AS cross_currency_count,
  CAST(sum(CASE WHEN settlement_currency_code IS NOT NULL THEN settlement_amount ELSE 0 END) AS DOUBLE) AS cross_currency_amount
FROM txn GROUP BY 1, 2, 3""")
def _(t):
    return gold.gold_by_payment_type(t.txn)


ROLES = """r AS (
  SELECT transaction_id, tenant_id, transaction_ts, payment_type, amount, 'ORIGINATOR' AS party_role, originator_party_id AS party_id, originator_match_rule AS match_rule, originator_resolution_confidence AS conf FROM txn
  UNION ALL SELECT transaction_id, tenant_id, transaction_ts, payment_type, amount, 'BENEFICIARY', beneficiary_party_id, beneficiary_match_rule, beneficiary_resolution_confidence FROM txn)"""


@case("gold_ir_quality", "txn", f"""WITH {ROLES}
SELECT tenant_id, {DAY}, match_rule, party_role, count(*) AS txn_count, CAST(sum(conf) AS DOUBLE) / count(conf) AS avg_confidence,
  CAST(min(conf) AS DOUBLE) AS min_confidence, CAST(max(conf) AS DOUBLE) AS max_confidence, count(*) FILTER (match_rule = 'NEW_PARTY') AS new_party_count
FROM r WHERE match_rule IS NOT NULL GROUP BY 1, 2, 3, 4""")
def _(t):
    return gold.gold_ir_quality(t.txn)


@case("to_role_rows", "txn", f"""WITH {ROLES}
SELECT party_role, payment_type, party_id, count(*) AS role_rows, {total('amount', 'amount')} FROM r GROUP BY 1, 2, 3""")
def _(t):
    return roles.to_role_rows(t.txn).groupBy("party_role", "payment_type", "party_id").agg(
        F.count("*").alias("role_rows"), F.sum("amount").alias("amount"))


@case("gold_cross_rail", "txn", f"SELECT tenant_id, {DAY}, payment_type, {CROSS} FROM txn GROUP BY 1, 2, 3")
def _(t):
    return gold.gold_cross_rail(t.txn)


@case("gold_by_channel", "txn", f"""
SELECT tenant_id, {DAY}, coalesce(channel, 'UNKNOWN') AS channel, payment_type, count(*) AS txn_count, {total('amount', 'total_amount')},
  CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount, count(return_reason_code) AS return_count FROM txn GROUP BY 1, 2, 3, 4""")
def _(t):
    return gold.gold_by_channel(t.txn)


@case("gold_biller_volume", "txn biller_registry", f"""
SELECT x.tenant_id, {DAY}, coalesce(b.biller_category, 'OTHER') AS biller_category, coalesce(b.aggregator_name, 'OTHER') AS aggregator_name,
  json_extract_string(rail_details_json, '$.delivery_method') AS delivery_method, count(*) AS txn_count, {total('amount', 'total_amount')},
  count(*) FILTER (is_recurring) AS recurring_count, count(DISTINCT originator_party_id) AS unique_payers,
  count(DISTINCT json_extract_string(rail_details_json, '$.biller_id')) AS unique_billers
FROM txn x LEFT JOIN biller_registry b ON b.party_id = x.beneficiary_party_id WHERE payment_type = 'BILLPAY' GROUP BY 1, 2, 3, 4, 5""")
def _(t):
    return gold.gold_biller_volume(t.txn, t.biller_registry)


@case("gold_fx_summary", "txn", f"""
SELECT tenant_id, {DAY}, original_currency_code || '/' || settlement_currency_code AS currency_pair, payment_type, count(*) AS txn_count,
  {total('original_amount', 'total_original_amount')}, {total('settlement_amount', 'total_settlement_amount')},
  CAST(sum(settlement_amount) AS DOUBLE) / CAST(sum(original_amount) AS DOUBLE) AS avg_fx_rate,
  CAST(min(fx_rate) AS DOUBLE) AS min_fx_rate, CAST(max(fx_rate) AS DOUBLE) AS max_fx_rate, {total('fee_amount', 'total_fx_fee')}
FROM txn WHERE original_currency_code IS NOT NULL AND settlement_currency_code IS NOT NULL GROUP BY 1, 2, 3, 4""")
def _(t):
    return gold.gold_fx_summary(t.txn)


@case("gold_party_activity", "txn party", f"""WITH s AS (
  SELECT *, originator_party_id AS pid, beneficiary_party_id AS oid, 1 AS o, CASE WHEN originator_party_id = beneficiary_party_id THEN 1 ELSE 0 END AS b FROM txn
  UNION ALL SELECT *, beneficiary_party_id, originator_party_id, 0, 1 FROM txn WHERE originator_party_id IS DISTINCT FROM beneficiary_party_id),
a AS (SELECT tenant_id, {DAY}, pid, CASE WHEN max(o) = 1 AND max(b) = 1 THEN 'BOTH' WHEN max(o) = 1 THEN 'ORIGINATOR' ELSE 'BENEFICIARY' END AS role,
  count(*) AS txn_count, {total('amount', 'total_amount')}, count(DISTINCT payment_type) AS distinct_rails, count(DISTINCT oid) AS distinct_counterparties,
  count(*) FILTER (is_on_us) AS on_us_count, count(return_reason_code) AS return_count FROM s WHERE pid IS NOT NULL GROUP BY 1, 2, 3)
SELECT a.* EXCLUDE (pid), a.pid AS party_id, coalesce(p.party_type, 'UNKNOWN') AS party_type FROM a LEFT JOIN party p ON p.party_id = a.pid""")
def _(t):
    return gold.gold_party_activity(t.txn, t.party)


@case("gold_legacy", "txn", f"SELECT payment_type, {DAY}, count(*) AS txn_count, {total('amount', 'total_amount')} FROM txn GROUP BY 1, 2")
def _(t):
    return gold.gold_legacy(t.txn)


@case("refresh_gold", "txn", f"""
SELECT tenant_id, {DAY}, payment_type, {CROSS} FROM txn
WHERE CAST(transaction_ts AS DATE) IN (SELECT CAST(transaction_ts AS DATE) FROM txn WHERE _cdc_timestamp >= TIMESTAMP '2001-09-01 00:00:00') GROUP BY 1, 2, 3""")
def _(t):
    changed = t.txn.filter("_cdc_timestamp >= timestamp'2001-09-01 00:00:00'")
    return gold.refresh_gold(t.txn, changed)


@case("rollup_gold", "txn", f"""
SELECT CAST(CAST(date_trunc('month', transaction_ts) AS DATE) AS VARCHAR) AS period_start, tenant_id, payment_type,
  CAST(grouping(CAST(CAST(date_trunc('month', transaction_ts) AS DATE) AS VARCHAR), tenant_id, payment_type) AS BIGINT) AS level, {CROSS}
FROM txn GROUP BY ROLLUP (1, 2, 3)""")
def _(t):
    return gold.rollup_gold(gold.gold_cross_rail(t.txn))
