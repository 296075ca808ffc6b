"""Registered queries: windowed and per-party features over the activity stream.

``SLOTS`` sets a low bound for hot keys, so that about half of the parties run cut into
time slots and the others whole; the SQL states plain windows.
"""

from __future__ import annotations

import datetime as dt

from ..plans import features as ft
from .registry import ACTIVITY_AS_OF, case

SLOTS = {"hot_rows": 66, "slots": 4}
DAY = 86_400_000_000
P = "PARTITION BY tenant_id, originator_party_id ORDER BY us"
A = "a AS (SELECT *, epoch_us(transaction_ts) AS us FROM activity)"


def prior(days: int, part: str = P) -> str:
    return f"({part} RANGE BETWEEN {days * DAY} PRECEDING AND 1 PRECEDING)"


def upto(days: int) -> str:
    return f"({P} RANGE BETWEEN {days * DAY} PRECEDING AND CURRENT ROW)"


def moments(col: str, window: str) -> str:
    return (f"count({col}) OVER {window} AS n, CAST(sum({col}) OVER {window} AS DOUBLE) AS s, "
            f"CAST(sum({col} * {col}) OVER {window} AS DOUBLE) AS q")


SIGMA = "sqrt(greatest(q / n - (s / n) * (s / n), 0.0))"


def z(col: str) -> str:
    return f"CASE WHEN n > 0 AND {SIGMA} > 0 THEN (CAST({col} AS DOUBLE) - s / n) / {SIGMA} END"


@case("velocity", "activity", f"""WITH {A}
SELECT transaction_id, count(*) OVER ({P} RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW) AS txn_velocity FROM a""")
def _(t):
    return ft.velocity(t.activity, **SLOTS).select("transaction_id", "txn_velocity")


@case("amount_deviation", "activity", f"""WITH {A}, w AS (SELECT transaction_id, amount, {moments('amount', prior(90))} FROM a)
SELECT transaction_id, CASE WHEN n > 0 AND s / n <> 0 THEN (CAST(amount AS DOUBLE) - s / n) / (s / n) END AS amt_deviation_pct FROM w""")
def _(t):
    return ft.amount_deviation(t.activity, **SLOTS).select("transaction_id", "amt_deviation_pct")


FIRST = "row_number() OVER (PARTITION BY tenant_id, originator_party_id, beneficiary_party_id ORDER BY transaction_ts, transaction_id) = 1"


@case("new_counterparty", "activity", f"SELECT transaction_id, {FIRST} AS new_counterparty_flag FROM activity")
def _(t):
    return ft.new_counterparty(t.activity).select("transaction_id", "new_counterparty_flag")


SWITCH = """CASE WHEN lag(payment_type) OVER (PARTITION BY tenant_id, originator_party_id ORDER BY transaction_ts, transaction_id) <> payment_type THEN 1 ELSE 0 END AS sw"""


@case("rail_switches", "activity", f"""WITH {A}, s AS (SELECT *, {SWITCH} FROM a)
SELECT transaction_id, CAST(sum(sw) OVER {upto(30)} AS BIGINT) AS rail_switch_count FROM s""")
def _(t):
    return ft.rail_switches(t.activity, **SLOTS).select("transaction_id", "rail_switch_count")


@case("fx_z", "activity", f"""WITH {A}, w AS (
SELECT transaction_id, fx_rate, {moments('fx_rate', prior(7, 'PARTITION BY original_currency_code, settlement_currency_code ORDER BY us'))}
FROM a WHERE fx_rate IS NOT NULL)
SELECT transaction_id, {z('fx_rate')} AS fx_rate_z_score FROM w""")
def _(t):
    return ft.fx_z(t.activity, **SLOTS).select("transaction_id", "fx_rate_z_score")


ABROAD = "payment_type = 'WIRE' AND coalesce(iban_country_code <> 'US', FALSE)"


@case("intl_wire_pct", "activity", f"""WITH {A}
SELECT transaction_id, CAST(sum(CASE WHEN {ABROAD} THEN 1 ELSE 0 END) OVER {upto(90)} AS DOUBLE) / count(*) OVER {upto(90)} AS intl_wire_pct FROM a""")
def _(t):
    return ft.intl_wire_pct(t.activity, **SLOTS).select("transaction_id", "intl_wire_pct")


@case("on_us_ratio", "activity", f"""WITH {A}
SELECT transaction_id, CAST(sum(CASE WHEN is_on_us THEN 1 ELSE 0 END) OVER {upto(60)} AS DOUBLE) / nullif(count(is_on_us) OVER {upto(60)}, 0) AS on_us_ratio FROM a""")
def _(t):
    return ft.on_us_ratio(t.activity, **SLOTS).select("transaction_id", "on_us_ratio")


CONF = "CAST(CASE originator_match_rule WHEN 'EXACT_TOKEN' THEN 1.0 WHEN 'ROUTING_ACCOUNT' THEN 0.95 WHEN 'PROXY_EXACT' THEN 0.9 WHEN 'NAME_ROUTING' THEN 0.8 ELSE 0.0 END AS DOUBLE)"


@case("ir_confidence", "activity", f"SELECT transaction_id, {CONF} AS ir_confidence_score FROM activity")
def _(t):
    return ft.ir_confidence(t.activity).select("transaction_id", "ir_confidence_score")


@case("party_age", "activity activity_party", """
SELECT a.transaction_id, CAST(date_diff('day', CAST(p.created_at AS DATE), CAST(a.transaction_ts AS DATE)) AS INTEGER) AS party_age_days
FROM activity a LEFT JOIN activity_party p ON p.party_id = a.originator_party_id""")
def _(t):
    return ft.party_age(t.activity, t.activity_party).select("transaction_id", "party_age_days")


BILL = "CASE WHEN payment_type = 'BILLPAY' AND status = 'SETTLED' THEN 1 ELSE 0 END"


@case("billpay_active", "activity", f"WITH {A} SELECT transaction_id, max({BILL}) OVER {upto(90)} = 1 AS billpay_active_flag FROM a")
def _(t):
    return ft.billpay_active(t.activity, **SLOTS).select("transaction_id", "billpay_active_flag")


OFF = "hour(transaction_ts) < 6 OR hour(transaction_ts) >= 22"


@case("off_hours", "activity", f"SELECT transaction_id, {OFF} AS off_hours_flag FROM activity")
def _(t):
    return ft.off_hours(t.activity).select("transaction_id", "off_hours_flag")


AGE = "date_diff('day', CAST(transaction_ts AS DATE), DATE '2024-01-31')"


@case("rail_mix_shift", "activity", f"""WITH d AS (SELECT tenant_id, originator_party_id, payment_type, {AGE} AS age FROM activity)
SELECT p.tenant_id, p.originator_party_id, p.now_count, p.then_count,
  {' + '.join(f"abs(CAST(now_{r} AS DOUBLE) / nullif(now_count, 0) - CAST(then_{r} AS DOUBLE) / nullif(then_count, 0))" for r in ft.RAILS)} AS mix_shift
FROM (SELECT tenant_id, originator_party_id, count(*) FILTER (age BETWEEN 0 AND 29) AS now_count, count(*) FILTER (age BETWEEN 30 AND 89) AS then_count,
  {', '.join(f"count(*) FILTER (age BETWEEN 0 AND 29 AND payment_type = '{r}') AS now_{r}, count(*) FILTER (age BETWEEN 30 AND 89 AND payment_type = '{r}') AS then_{r}" for r in ft.RAILS)}
  FROM (SELECT tenant_id, originator_party_id, payment_type, age + 15 AS age FROM d) s WHERE age BETWEEN 0 AND 89 GROUP BY 1, 2) p""")
def _(t):
    return ft.rail_mix_shift(t.activity, ACTIVITY_AS_OF + dt.timedelta(days=15))


@case("rfm", "activity", f"""WITH p AS (
  SELECT tenant_id, originator_party_id, CAST(min({AGE}) AS INTEGER) AS recency_days, count(*) AS frequency, sum(amount) AS monetary FROM activity GROUP BY 1, 2)
SELECT tenant_id, originator_party_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
  CAST(ntile(5) OVER (PARTITION BY tenant_id ORDER BY recency_days DESC, originator_party_id) AS INTEGER) AS r_quintile,
  CAST(ntile(5) OVER (PARTITION BY tenant_id ORDER BY frequency, originator_party_id) AS INTEGER) AS f_quintile,
  CAST(ntile(5) OVER (PARTITION BY tenant_id ORDER BY monetary, originator_party_id) AS INTEGER) AS m_quintile FROM p""")
def _(t):
    return ft.rfm(t.activity, ACTIVITY_AS_OF)


@case("activity_drop", "activity", f"""WITH d AS (
  SELECT tenant_id, originator_party_id, count(*) FILTER (age + 15 BETWEEN 0 AND 29) AS last_30d,
    count(*) FILTER (age + 15 BETWEEN 30 AND 59) AS prior_30d FROM (SELECT *, {AGE} AS age FROM activity) a GROUP BY 1, 2)
SELECT tenant_id, originator_party_id, last_30d, prior_30d, CAST(prior_30d - last_30d AS DOUBLE) / nullif(prior_30d, 0) AS drop_pct FROM d""")
def _(t):
    return ft.activity_drop(t.activity, ACTIVITY_AS_OF + dt.timedelta(days=15))


@case("iban_deviation", "activity", """WITH c AS (
  SELECT tenant_id, originator_party_id, iban_country_code, row_number() OVER (PARTITION BY tenant_id, originator_party_id ORDER BY count(*) DESC, iban_country_code) AS r
  FROM activity WHERE iban_country_code IS NOT NULL GROUP BY 1, 2, 3)
SELECT a.transaction_id, c.iban_country_code AS usual_country, a.iban_country_code <> c.iban_country_code AS iban_deviation_flag
FROM activity a JOIN c ON c.tenant_id = a.tenant_id AND c.originator_party_id = a.originator_party_id AND c.r = 1 WHERE a.iban_country_code IS NOT NULL""")
def _(t):
    return ft.iban_deviation(t.activity).select("transaction_id", "usual_country", "iban_deviation_flag")


@case("routing_change", "activity", """
SELECT transaction_id, coalesce(lag(originator_routing_number) OVER (PARTITION BY tenant_id, originator_party_id, payment_type ORDER BY transaction_ts, transaction_id)
  <> originator_routing_number, FALSE) AS routing_change_flag FROM activity""")
def _(t):
    return ft.routing_change(t.activity, hot_rows=15, slots=5).select("transaction_id", "routing_change_flag")


@case("new_bene_high_amount", "activity", f"""WITH {A}, w AS (SELECT transaction_id, amount, {FIRST} AS fresh, {moments('amount', prior(90))} FROM a)
SELECT transaction_id, fresh AND coalesce(n > 0 AND CAST(amount AS DOUBLE) > s / n + 3.0 * {SIGMA}, FALSE) AS new_bene_high_amount_flag FROM w""")
def _(t):
    return ft.new_bene_high_amount(t.activity, **SLOTS).select("transaction_id", "new_bene_high_amount_flag")


@case("amount_z", "activity", f"""WITH {A}, w AS (SELECT transaction_id, amount, {moments('amount', prior(90))} FROM a)
SELECT transaction_id, {z('amount')} AS amount_z_score FROM w""")
def _(t):
    return ft.amount_z(t.activity, **SLOTS).select("transaction_id", "amount_z_score")


@case("next_best_action", "activity", f"""
SELECT tenant_id, originator_party_id, count(*) FILTER ({ABROAD}) > 0 AS offer_fx,
  count(*) FILTER (payment_type = 'ZELLE') >= 5 AND count(*) FILTER (payment_type = 'ACH') >= 5 AS offer_instant,
  count(*) FILTER (payment_type = 'BILLPAY' AND NOT coalesce(is_recurring, FALSE)) > 0 AS offer_autopay
FROM activity WHERE {AGE} BETWEEN 0 AND 89 GROUP BY 1, 2""")
def _(t):
    return ft.next_best_action(t.activity, ACTIVITY_AS_OF)


@case("readiness", "txn", """WITH r AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(*) FILTER (status IN ('SETTLED', 'FAILED', 'RETURNED')) AS labelled,
  count(*) FILTER (status IN ('FAILED', 'RETURNED')) AS bad, count(transaction_ts) AS timed, count(DISTINCT payment_type) AS rails, count(originator_party_id) AS party,
  count(*) FILTER (transaction_id IS NOT NULL AND tenant_id IS NOT NULL AND payment_type IS NOT NULL AND direction IS NOT NULL AND amount IS NOT NULL AND status IS NOT NULL AND transaction_ts IS NOT NULL) AS full_rows,
  count(*) FILTER (regexp_matches(originator_account_token, '^[0-9a-f]{32,}$')) AS tokens FROM txn)
SELECT 'label_availability' AS metric, labelled / n AS score FROM r UNION ALL SELECT 'feature_completeness', full_rows / n FROM r
UNION ALL SELECT 'tokenised', tokens / n FROM r UNION ALL SELECT 'temporal_ordering', timed / n FROM r
UNION ALL SELECT 'class_balance', bad / CAST(labelled AS DOUBLE) FROM r UNION ALL SELECT 'rails_covered', rails / 9.0::DOUBLE FROM r
UNION ALL SELECT 'party_resolution', party / n FROM r""")
def _(t):
    return ft.readiness(t.txn)


@case("feature_table", "activity activity_party", f"""WITH {A}, s AS (SELECT *, {SWITCH} FROM a),
w AS (SELECT *, count(*) OVER ({P} RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW) AS velocity, {FIRST} AS fresh, {moments('amount', prior(90))},
  CAST(sum(sw) OVER {upto(30)} AS BIGINT) AS switches, CAST(sum(CASE WHEN {ABROAD} THEN 1 ELSE 0 END) OVER {upto(90)} AS DOUBLE) / count(*) OVER {upto(90)} AS iw,
  CAST(sum(CASE WHEN is_on_us THEN 1 ELSE 0 END) OVER {upto(60)} AS DOUBLE) / nullif(count(is_on_us) OVER {upto(60)}, 0) AS onus,
  max({BILL}) OVER {upto(90)} = 1 AS bill FROM s)
SELECT w.transaction_id, w.tenant_id, w.originator_party_id, velocity AS txn_velocity_24h,
  CASE WHEN n > 0 AND s / n <> 0 THEN (CAST(amount AS DOUBLE) - s / n) / (s / n) END AS amt_deviation_pct, {z('amount')} AS amount_z_score,
  fresh AS new_counterparty_flag, switches AS rail_switch_count, iw AS intl_wire_pct, onus AS on_us_ratio, {CONF} AS ir_confidence_score,
  CAST(date_diff('day', CAST(p.created_at AS DATE), CAST(w.transaction_ts AS DATE)) AS INTEGER) AS party_age_days, bill AS billpay_active_flag,
  {OFF} AS off_hours_flag, CASE WHEN status = 'SETTLED' THEN 0 WHEN status IN ('FAILED', 'RETURNED') THEN 1 END AS label
FROM w LEFT JOIN activity_party p ON p.party_id = w.originator_party_id""")
def _(t):
    return ft.feature_table(t.activity, t.activity_party, **SLOTS)
