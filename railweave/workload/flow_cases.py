"""Registered queries: cross-rail flow and documented reports."""

from __future__ import annotations

from ..operators import gold
from ..plans import flows, reports
from ..sources.refdata import RETURN_CODES, ref_tables, sql_values
from .registry import AS_OF, case

S = "coalesce(settlement_amount, amount)"
YEAR = "status = 'SETTLED' AND CAST(transaction_ts AS DATE) BETWEEN DATE '2000-11-04' AND DATE '2001-11-04'"
ROWS = f"""rows AS (
SELECT 'Q' || quarter(transaction_ts) || ' ' || year(transaction_ts) AS period, payment_type,
  CASE WHEN direction = 'INBOUND' THEN 'CREDIT' ELSE 'DEBIT' END AS direction,
  CAST(min(date_trunc('quarter', transaction_ts)) AS DATE) AS period_start, sum({S}) AS total
FROM txn WHERE {YEAR} AND direction IN ('INBOUND', 'OUTBOUND') GROUP BY 1, 2, 3)"""


@case("monthly_flow", "txn", f"""
SELECT payment_type, strftime(transaction_ts, '%Y-%m') AS month,
  count(*) FILTER (direction = 'INBOUND') AS inflow_count,
  CAST(sum(CASE WHEN direction = 'INBOUND' THEN {S} ELSE 0 END) AS DOUBLE) AS inflow_usd,
  count(*) FILTER (direction = 'OUTBOUND') AS outflow_count,
  CAST(sum(CASE WHEN direction = 'OUTBOUND' THEN {S} ELSE 0 END) AS DOUBLE) AS outflow_usd,
  CAST(sum(CASE WHEN direction = 'INBOUND' THEN {S} ELSE -{S} END) AS DOUBLE) AS net_usd
FROM txn WHERE {YEAR} GROUP BY 1, 2 ORDER BY 2 DESC, 4 DESC""")
def _(t):
    return flows.monthly_flow(t.txn, AS_OF)


@case("sankey_rows", "txn", f"""WITH {ROWS}
SELECT period, payment_type, direction, CAST(period_start AS VARCHAR) AS period_start, CAST(total AS DOUBLE) AS total FROM rows""")
def _(t):
    return flows.sankey_rows(t.txn, AS_OF)


_NET = ", ".join(
    f"CAST(sum(CASE WHEN payment_type = '{r}' THEN net END) AS DOUBLE) AS {r.lower()}_net" for r in flows.PIVOT_RAILS)


@case("net_pivot", "txn", f"""
SELECT month, {_NET}, CAST(sum(net) AS DOUBLE) AS total_net FROM (
  SELECT strftime(transaction_ts, '%Y-%m') AS month, payment_type, sum(CASE WHEN direction = 'INBOUND' THEN {S} ELSE -{S} END) AS net
  FROM txn WHERE {YEAR} GROUP BY 1, 2) m GROUP BY 1""")
def _(t):
    return flows.net_pivot(t.txn, AS_OF)


@case("fx_flows", "txn", """
SELECT payment_type, original_currency_code, direction, count(*) AS txn_count, CAST(sum(original_amount) AS DOUBLE) AS original_amount,
  round(CAST(sum(fx_rate) AS DOUBLE) / count(fx_rate), 6) AS avg_fx_rate, CAST(sum(settlement_amount) AS DOUBLE) AS settled_usd
FROM txn WHERE status = 'SETTLED' AND original_currency_code <> 'USD' AND CAST(transaction_ts AS DATE) BETWEEN DATE '2001-08-04' AND DATE '2001-11-04'
GROUP BY 1, 2, 3""")
def _(t):
    return flows.fx_flows(t.txn, AS_OF)


@case("flow_kpis", "txn", f"""WITH {ROWS}
SELECT period, CAST(sum(CASE WHEN direction = 'CREDIT' THEN total ELSE 0 END) AS DOUBLE) AS total_in,
  CAST(sum(CASE WHEN direction = 'DEBIT' THEN total ELSE 0 END) AS DOUBLE) AS total_out,
  CAST(sum(CASE WHEN direction = 'CREDIT' THEN total ELSE -total END) AS DOUBLE) AS net FROM rows GROUP BY 1""")
def _(t):
    return flows.flow_kpis(flows.sankey_rows(t.txn, AS_OF))


NODES = """nodes AS (
  SELECT period, payment_type AS label, CAST(row_number() OVER (PARTITION BY period ORDER BY payment_type) AS INTEGER) AS node, 1 AS col
  FROM (SELECT DISTINCT period, payment_type FROM rows) d
  UNION ALL SELECT DISTINCT period, 'INFLOW', 0, 0 FROM rows
  UNION ALL SELECT period, 'OUTFLOW', CAST(count(DISTINCT payment_type) + 1 AS INTEGER), 2 FROM rows GROUP BY period)"""


@case("sankey_nodes", "txn", f"WITH {ROWS}, {NODES} SELECT * FROM nodes")
def _(t):
    return flows.sankey_nodes(flows.sankey_rows(t.txn, AS_OF))


@case("sankey_graph", "txn", f"""WITH {ROWS}, {NODES}
SELECT r.period, r.payment_type, r.direction, CASE WHEN r.direction = 'CREDIT' THEN 0 ELSE n.node END AS source,
  CASE WHEN r.direction = 'CREDIT' THEN n.node ELSE k.node END AS target, CAST(r.total AS DOUBLE) AS value
FROM rows r JOIN nodes n ON n.period = r.period AND n.label = r.payment_type AND n.col = 1 JOIN nodes k ON k.period = r.period AND k.col = 2""")
def _(t):
    return flows.sankey_links(flows.sankey_rows(t.txn, AS_OF))


@case("rail_share", "txn", f"""WITH {ROWS}, r AS (
SELECT period, payment_type, sum(CASE WHEN direction = 'CREDIT' THEN total ELSE 0 END) AS inflow,
  sum(CASE WHEN direction = 'DEBIT' THEN total ELSE 0 END) AS outflow, sum(total) AS volume FROM rows GROUP BY 1, 2)
SELECT period, payment_type, CAST(inflow AS DOUBLE) AS inflow, CAST(outflow AS DOUBLE) AS outflow, CAST(volume AS DOUBLE) AS volume,
  CAST(inflow - outflow AS DOUBLE) AS net,
  CAST(inflow AS DOUBLE) / nullif(CAST(sum(inflow) OVER (PARTITION BY period) AS DOUBLE), 0) AS inflow_share FROM r""")
def _(t):
    return flows.rail_share(flows.sankey_rows(t.txn, AS_OF))


@case("periods", "txn", f"WITH {ROWS} SELECT DISTINCT period FROM rows")
def _(t):
    return flows.periods(flows.sankey_rows(t.txn, AS_OF))


@case("rule_distribution", "txn", """
SELECT originator_match_rule, count(*) AS txn_count,
  CAST(sum(originator_resolution_confidence) AS DOUBLE) / count(originator_resolution_confidence) AS avg_confidence
FROM txn WHERE tenant_id = 'T1' AND originator_match_rule IS NOT NULL
  AND CAST(transaction_ts AS DATE) BETWEEN DATE '2001-10-28' AND DATE '2001-11-04' GROUP BY 1""")
def _(t):
    return reports.rule_distribution(t.txn, "T1", AS_OF)


@case("fx_by_pair", "txn", """
SELECT payment_type, original_currency_code, settlement_currency_code AS settlement_currency, count(*) AS txn_count,
  CAST(sum(original_amount) AS DOUBLE) AS total_original_amount, CAST(sum(settlement_amount) AS DOUBLE) AS total_settlement_amount,
  CAST(sum(fx_rate) AS DOUBLE) / count(fx_rate) AS avg_fx_rate
FROM txn WHERE tenant_id = 'T1' AND original_currency_code IS NOT NULL
  AND CAST(transaction_ts AS DATE) BETWEEN DATE '2001-10-05' AND DATE '2001-11-04' GROUP BY 1, 2, 3""")
def _(t):
    return reports.fx_by_pair(t.txn, "T1", AS_OF)


@case("party_total", "txn", f"""
SELECT CAST(sum({S}) AS DOUBLE) AS total_usd FROM txn WHERE originator_party_id = 'C10' AND status = 'SETTLED'""")
def _(t):
    return reports.party_total(t.txn, "C10")


@case("exposure", "txn", f"""
SELECT originator_party_id, beneficiary_party_id, payment_type, CAST(sum({S}) AS DOUBLE) AS exposure_usd
FROM txn WHERE originator_party_id IS NOT NULL AND beneficiary_party_id IS NOT NULL GROUP BY 1, 2, 3""")
def _(t):
    return reports.exposure(t.txn)


@case("ir_rate", "txn", """
SELECT payment_type, CAST(count(originator_party_id) AS DOUBLE) / count(*) AS ir_rate
FROM txn WHERE CAST(transaction_ts AS DATE) BETWEEN DATE '2001-10-05' AND DATE '2001-11-04' GROUP BY 1""")
def _(t):
    return reports.ir_rate(t.txn, AS_OF)


@case("on_us_volume", "txn", f"""
SELECT payment_type, count(*) FILTER (is_on_us) AS on_us_count, CAST(sum(CASE WHEN is_on_us THEN {S} END) AS DOUBLE) AS on_us_vol FROM txn GROUP BY 1""")
def _(t):
    return reports.on_us_volume(t.txn)


@case("settled_by_rail", "txn", f"""
SELECT payment_type, direction, CAST(sum({S}) AS DOUBLE) AS total FROM txn WHERE status = 'SETTLED' GROUP BY 1, 2""")
def _(t):
    return reports.settled_by_rail(t.txn)


@case("return_rates", "txn", f"""
SELECT c.payment_type, c.return_reason_code, coalesce(k.category, 'UNKNOWN') AS return_category, c.n AS return_count,
  CAST(c.n AS DOUBLE) / r.n AS return_rate
FROM (SELECT payment_type, return_reason_code, count(*) AS n FROM txn WHERE return_reason_code IS NOT NULL GROUP BY 1, 2) c
JOIN (SELECT payment_type, count(*) AS n FROM txn GROUP BY 1) r ON r.payment_type = c.payment_type
LEFT JOIN (VALUES {sql_values(RETURN_CODES)}) k(code, description, category) ON k.code = c.return_reason_code""")
def _(t):
    return reports.return_rates(t.txn, ref_tables(t.spark)["return_codes"])


@case("top_k", "txn", f"""
SELECT tenant_id, beneficiary_party_id, txn_count, CAST(volume AS DOUBLE) AS volume, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY volume DESC, beneficiary_party_id) AS rank
  FROM (SELECT tenant_id, beneficiary_party_id, count(*) AS txn_count, sum({S}) AS volume FROM txn GROUP BY 1, 2) a) b WHERE rank <= 10""")
def _(t):
    return reports.top_k(reports.counterparty_volume(t.txn), "tenant_id", "volume", "beneficiary_party_id", 10)


@case("settlement_latency", "txn", """
SELECT payment_type, count(*) AS settled_count, CAST(quantile_disc(h, 0.5) AS DOUBLE) AS p50_hours, CAST(quantile_disc(h, 0.95) AS DOUBLE) AS p95_hours,
  CAST(count(*) FILTER (same) AS DOUBLE) / count(*) AS same_day_share
FROM (SELECT payment_type, date_sub('hour', transaction_ts, settled_ts) AS h, CAST(settled_ts AS DATE) = CAST(transaction_ts AS DATE) AS same
  FROM txn WHERE settled_ts IS NOT NULL) x GROUP BY 1""")
def _(t):
    return reports.settlement_latency(t.txn)


@case("delivery_mix", "txn", """WITH m AS (
  SELECT strftime(transaction_ts, '%Y-%m') AS month, json_extract_string(rail_details_json, '$.delivery_method') AS delivery_method, count(*) AS txn_count
  FROM txn WHERE payment_type = 'BILLPAY' GROUP BY 1, 2),
s AS (SELECT *, CAST(txn_count AS DOUBLE) / CAST(sum(txn_count) OVER (PARTITION BY month) AS DOUBLE) AS month_share FROM m)
SELECT month, delivery_method, txn_count, month_share,
  month_share - lag(month_share) OVER (PARTITION BY delivery_method ORDER BY month) AS share_change FROM s""")
def _(t):
    return reports.delivery_mix(t.txn)


@case("channel_mix", "txn", """WITH m AS (
  SELECT payment_type, coalesce(channel, 'UNKNOWN') AS channel, count(*) AS txn_count FROM txn GROUP BY 1, 2),
w AS (SELECT payment_type, sum(txn_count) AS whole, sum(CASE WHEN channel IN ('ONLINE', 'MOBILE', 'API') THEN txn_count ELSE 0 END) AS digital FROM m GROUP BY 1)
SELECT m.payment_type, m.channel, m.txn_count, CAST(m.txn_count AS DOUBLE) / CAST(w.whole AS DOUBLE) AS channel_share,
  CAST(w.digital AS DOUBLE) / CAST(w.whole AS DOUBLE) AS digital_share FROM m JOIN w ON w.payment_type = m.payment_type""")
def _(t):
    return reports.channel_mix(t.txn)


@case("ir_drift", "txn", """WITH r AS (
  SELECT tenant_id, CAST(transaction_ts AS DATE) AS d, 'ORIGINATOR' AS party_role, originator_match_rule AS rule, originator_resolution_confidence AS conf FROM txn
  UNION ALL SELECT tenant_id, CAST(transaction_ts AS DATE), 'BENEFICIARY', beneficiary_match_rule, beneficiary_resolution_confidence FROM txn),
q AS (SELECT tenant_id, d, party_role, rule, count(*) AS n, CAST(sum(conf) AS DOUBLE) / count(conf) AS c FROM r WHERE rule IS NOT NULL GROUP BY 1, 2, 3, 4),
s AS (SELECT *, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY tenant_id, party_role, d) AS DOUBLE) AS rule_share FROM q)
SELECT tenant_id, party_role, rule AS match_rule, CAST(d AS VARCHAR) AS period_date, rule_share,
  rule_share - lag(rule_share) OVER w AS share_change, c - lag(c) OVER w AS confidence_change
FROM s WINDOW w AS (PARTITION BY tenant_id, party_role, rule ORDER BY d)""")
def _(t):
    return reports.ir_drift(gold.gold_ir_quality(t.txn))


@case("check_holds", "raw_check_rdc", """
SELECT hold_type, CAST(least(floor(risk_score / 25), 3) AS BIGINT) AS risk_band, count(*) AS item_count, CAST(sum(hold_amount) AS DOUBLE) AS held,
  CAST(sum(date_diff('day', CAST(deposit_timestamp AS DATE), funds_availability_date)) AS DOUBLE) / count(*) AS avg_days_to_funds
FROM raw_check_rdc GROUP BY 1, 2""")
def _(t):
    return reports.check_holds(t.raw_check_rdc)


@case("card_disputes", "txn", """
SELECT json_extract_string(rail_details_json, '$.chargeback_details.dispute_status') AS dispute_status,
  json_extract_string(rail_details_json, '$.chargeback_details.chargeback_reason_code') AS reason_code, count(*) AS dispute_count,
  CAST(sum(CAST(json_extract_string(rail_details_json, '$.chargeback_details.chargeback_amount') AS DECIMAL(18,2))) AS DOUBLE) AS disputed
FROM txn WHERE payment_type = 'CARD' AND json_extract(rail_details_json, '$.chargeback_details') IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return reports.card_disputes(t.txn)


@case("card_approval", "txn", """
SELECT json_extract_string(rail_details_json, '$.merchant_category_code') AS mcc, count(*) AS txn_count,
  CAST(count(*) FILTER (json_extract_string(rail_details_json, '$.issuer_response_code') = '00') AS DOUBLE) / count(*) AS approval_rate
FROM txn WHERE payment_type = 'CARD' GROUP BY 1""")
def _(t):
    return reports.card_approval(t.txn)
