"""Registered queries: views, linked transactions and the party graph."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import graph, views
from ..sources.refdata import RETURN_CODES, STATUS_CODES, ref_tables, sql_values
from .registry import AS_OF, case

S = "coalesce(settlement_amount, amount)"
MID = dt.date(2000, 1, 1)


@case("transactions_with_parties", "txn party party_account", """
SELECT t.transaction_id, t.payment_type, CAST(t.amount AS DOUBLE) AS amount, op.party_type AS orig_party_type, CAST(op.resolution_confidence AS DOUBLE) AS orig_resolution_confidence,
  oa.account_type AS orig_account_type, oa.institution_routing_number AS orig_fi_routing, oa.is_on_us AS orig_account_is_on_us, bp.party_type AS bene_party_type,
  bp.resolution_status AS bene_resolution_status, ba.account_type AS bene_account_type, ba.institution_swift_bic AS bene_fi_swift_bic, ba.institution_iban_country_code AS bene_iban_country_code
FROM txn t LEFT JOIN party op ON op.party_id = t.originator_party_id LEFT JOIN party_account oa ON oa.account_id = t.originator_account_id
LEFT JOIN party bp ON bp.party_id = t.beneficiary_party_id LEFT JOIN party_account ba ON ba.account_id = t.beneficiary_account_id""")
def _(t):
    return views.transactions_with_parties(t.txn, t.party, t.party_account).select(
        "transaction_id", "payment_type", "amount", "orig_party_type", "orig_resolution_confidence", "orig_account_type", "orig_fi_routing", "orig_account_is_on_us",
        "bene_party_type", "bene_resolution_status", "bene_account_type", "bene_fi_swift_bic", "bene_iban_country_code")


@case("authorized_signers", "party party_relationship", """
SELECT b.display_name AS business_name, i.display_name AS signer_name, r.role_b AS signer_role, CAST(r.effective_date AS VARCHAR) AS effective_date, CAST(r.expiry_date AS VARCHAR) AS expiry_date
FROM party_relationship r JOIN party b ON b.party_id = r.party_id_a JOIN party i ON i.party_id = r.party_id_b
WHERE r.tenant_id = 'T2' AND r.relationship_type = 'AUTHORIZED_SIGNER' AND r.is_active""")
def _(t):
    return views.authorized_signers(t.party_relationship, t.party, "T2")


@case("biller_transactions", "txn party party_account biller_registry", """
SELECT t.tenant_id, t.payment_type, CAST(t.amount AS DOUBLE) AS amount, CAST(t.transaction_ts AS VARCHAR) AS transaction_ts, b.biller_category, p.display_name AS biller_name
FROM txn t JOIN party_account a ON a.account_id = t.beneficiary_account_id JOIN biller_registry b ON b.party_id = a.party_id JOIN party p ON p.party_id = a.party_id
WHERE b.standard_biller_id = 'B3' AND CAST(t.transaction_ts AS DATE) BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'""")
def _(t):
    return views.biller_transactions(t.txn, t.party_account, t.biller_registry, t.party, "B3", dt.date(2001, 6, 30))


@case("active_relationships", "party_relationship", """
SELECT relationship_id, relationship_type FROM party_relationship WHERE is_active AND effective_date <= DATE '2001-01-01' AND (expiry_date IS NULL OR expiry_date >= DATE '2001-01-01')""")
def _(t):
    return graph.active_relationships(t.party_relationship, dt.date(2001, 1, 1)).select("relationship_id", "relationship_type")


@case("ubo_volume", "txn party_relationship", f"""
SELECT count(*) AS txn_count, CAST(sum({S}) AS DOUBLE) AS volume FROM txn WHERE originator_party_id IN
  (SELECT party_id_a FROM party_relationship WHERE relationship_type = 'BENEFICIAL_OWNER' AND party_id_b = 'C5')""")
def _(t):
    return graph.ubo_volume(t.txn, t.party_relationship, "C5")


@case("ubo_closure", "party_relationship", """WITH RECURSIVE e AS (
  SELECT party_id_b AS o, party_id_a AS n, CAST(ownership_percentage AS DOUBLE) / 100 AS s FROM party_relationship WHERE relationship_type = 'BENEFICIAL_OWNER' AND ownership_percentage IS NOT NULL),
p AS (SELECT o, n, s, 1 AS d, [o, n] AS path FROM e WHERE o <> n
  UNION ALL SELECT p.o, e.n, p.s * e.s, d + 1, list_append(path, e.n) FROM p JOIN e ON e.o = p.n WHERE NOT list_contains(path, e.n))
SELECT o AS owner, n AS entity, sum(s) AS effective_share, min(d) AS min_depth, count(*) AS path_count FROM p GROUP BY 1, 2""")
def _(t):
    return graph.ubo_closure(t.party_relationship)


@case("hierarchy", "party_relationship", """WITH RECURSIVE u AS (SELECT DISTINCT party_id_b AS c, party_id_a AS p FROM party_relationship WHERE relationship_type = 'PARENT_SUBSIDIARY'),
w AS (SELECT c, p, 1 AS d, [c, p] AS path FROM u UNION ALL SELECT w.c, u.p, d + 1, list_append(path, u.p) FROM w JOIN u ON u.c = w.p WHERE NOT list_contains(path, u.p))
SELECT c AS party_id, p AS root_party_id, CAST(min(d) AS INTEGER) AS depth FROM w WHERE p NOT IN (SELECT c FROM u) GROUP BY 1, 2""")
def _(t):
    return graph.hierarchy(t.party_relationship)


@case("joint_activity", "txn party_account party_relationship", f"""WITH h AS (SELECT party_id FROM party_account WHERE account_id = 'AC20'),
j AS (SELECT party_id_a AS a, party_id_b AS b FROM party_relationship WHERE relationship_type = 'JOINT_ACCOUNT' AND is_active),
m AS (SELECT party_id FROM h UNION SELECT b FROM j JOIN h ON h.party_id = j.a UNION SELECT a FROM j JOIN h ON h.party_id = j.b)
SELECT m.party_id, payment_type, CAST(sum({S}) AS DOUBLE) AS volume FROM txn t JOIN m ON m.party_id = t.originator_party_id GROUP BY 1, 2""")
def _(t):
    return views.joint_activity(t.txn, t.party_account, t.party_relationship, "AC20")


EDGES = f"""e AS (SELECT originator_party_id AS source, beneficiary_party_id AS target, payment_type, count(*) AS txn_count, sum({S}) AS v FROM txn
  WHERE originator_party_id IS NOT NULL AND beneficiary_party_id IS NOT NULL GROUP BY 1, 2, 3)"""


@case("graph_edges", "txn party_relationship", f"""WITH {EDGES}, r AS (SELECT least(party_id_a, party_id_b) AS lo, greatest(party_id_a, party_id_b) AS hi, string_agg(DISTINCT relationship_type, ',' ORDER BY relationship_type) AS relationship FROM party_relationship GROUP BY 1, 2)
SELECT source, target, payment_type, txn_count, CAST(v AS DOUBLE) AS volume, relationship FROM e LEFT JOIN r ON lo = least(source, target) AND hi = greatest(source, target)""")
def _(t):
    return graph.graph_edges(t.txn, t.party_relationship)


@case("graph_nodes", "txn party", f"""WITH {EDGES}, n AS (SELECT source AS pid, payment_type, txn_count FROM e UNION ALL SELECT target, payment_type, txn_count FROM e WHERE target <> source)
SELECT n.pid AS party_id, CAST(sum(txn_count) AS BIGINT) AS txn_count, count(*) AS connection_count, string_agg(DISTINCT payment_type, ',' ORDER BY payment_type) AS active_rails,
  CAST(count(DISTINCT payment_type) AS INTEGER) AS rail_count, p.party_type FROM n LEFT JOIN party p ON p.party_id = n.pid GROUP BY n.pid, p.party_type""")
def _(t):
    return graph.graph_nodes(t.txn, t.party)


@case("party_groups", "party_relationship", """WITH RECURSIVE e AS (
  SELECT party_id_a AS a, party_id_b AS b FROM party_relationship WHERE relationship_type = 'JOINT_ACCOUNT' UNION SELECT party_id_b, party_id_a FROM party_relationship WHERE relationship_type = 'JOINT_ACCOUNT'),
r AS (SELECT a, a AS b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT a AS party_id, min(b) AS group_id FROM r GROUP BY 1""")
def _(t):
    return graph.party_groups(t.party_relationship)


@case("enrich_refs", "txn", f"""
SELECT t.status, s.category AS status_category, s.terminal AS is_terminal, t.return_reason_code, c.description AS return_description, c.category AS return_category, count(*) AS n
FROM txn t LEFT JOIN (VALUES {sql_values(STATUS_CODES)}) s(code, name, category, terminal) ON s.code = t.status
LEFT JOIN (VALUES {sql_values(RETURN_CODES)}) c(code, description, category) ON c.code = t.return_reason_code GROUP BY ALL""")
def _(t):
    return views.enrich_refs(t.txn, ref_tables(t.spark)).groupBy(
        "status", "status_category", "is_terminal", "return_reason_code", "return_description", "return_category").agg(F.count("*").alias("n"))


@case("biller_methods", "biller_registry", """
SELECT biller_id, biller_category, unnest(payment_methods) AS payment_method, list_contains(payment_methods, 'RTP') AS accepts_instant FROM biller_registry""")
def _(t):
    return views.biller_methods(t.biller_registry)


CAPS = ", ".join(f"coalesce(bool_or(CASE WHEN rail_type = '{r}' THEN is_{w}_participant END), FALSE) AS {r.lower()}_{s}"
                 for r, *_ in views.PAYMENT_TYPES for w, s in (("originating", "send"), ("receiving", "receive")))


@case("rail_capability", "party_account_rail_ref", f"SELECT account_id, {CAPS} FROM party_account_rail_ref WHERE participant_status = 'ACTIVE' GROUP BY 1")
def _(t):
    return views.rail_capability(t.party_account_rail_ref)


NEWEST = "ORDER BY _cdc_timestamp DESC, _cdc_sequence_id DESC, ingestion_ts DESC, event_id DESC"


@case("link_returns", "txn", f"""WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, payment_type, source_transaction_id {NEWEST}) AS rn FROM txn WHERE status <> 'RETURNED') z WHERE rn = 1)
SELECT r.tenant_id, r.payment_type, r.transaction_id AS return_transaction_id, o.transaction_id, CAST(r.amount AS DOUBLE) AS returned_amount, CAST(o.amount AS DOUBLE) AS original_amount, r.return_reason_code
FROM txn r JOIN o ON o.tenant_id = r.tenant_id AND o.payment_type = r.payment_type AND o.source_transaction_id = r.original_reference WHERE r.status = 'RETURNED'""")
def _(t):
    return views.link_returns(t.txn)


@case("link_rfp", "txn", """WITH i AS (SELECT *, original_reference IS NOT NULL AND status <> 'RETURNED' AS ans FROM txn WHERE payment_type IN ('RTP', 'FEDNOW')),
p AS (SELECT a.tenant_id, a.payment_type, a.transaction_id AS aid, q.transaction_id AS qid, a.transaction_ts AS ats, q.transaction_ts AS qts,
  row_number() OVER (PARTITION BY a.transaction_id ORDER BY q.transaction_ts DESC, q.transaction_id DESC) AS rn
  FROM i a JOIN i q ON NOT q.ans AND q.tenant_id = a.tenant_id AND q.payment_type = a.payment_type AND q.source_transaction_id = a.original_reference AND q.transaction_ts <= a.transaction_ts WHERE a.ans)
SELECT tenant_id, payment_type, aid AS answer_transaction_id, qid AS request_transaction_id, date_sub('hour', qts, ats) AS hours_to_answer
FROM p WHERE rn = 1 AND qts >= ats - INTERVAL '400' DAY""")
def _(t):
    return views.link_rfp(t.txn, days=400, hot_rows=1, slots=3)


@case("link_billpay", "txn", f"""WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, payment_type, source_transaction_id {NEWEST}) AS rn FROM txn WHERE payment_type IN ('ACH', 'RTP', 'FEDNOW', 'CHECK')) f WHERE rn = 1)
SELECT b.tenant_id, b.transaction_id, f.payment_type AS underlying_rail, f.transaction_id AS underlying_transaction_id, CAST(f.amount - b.amount AS DOUBLE) AS amount_gap
FROM txn b LEFT JOIN o AS f ON f.tenant_id = b.tenant_id AND f.source_transaction_id = b.original_reference WHERE b.payment_type = 'BILLPAY'""")
def _(t):
    return views.link_billpay(t.txn)


BY = "tenant_id, payment_type, status, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount"


def _by(df):
    return df.groupBy("tenant_id", "payment_type", "status").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


@case("exceptions", "txn", f"SELECT {BY} FROM txn WHERE status IN ('FAILED', 'RETURNED', 'DECLINED', 'REJECTED') GROUP BY 1, 2, 3")
def _(t):
    return _by(views.exceptions(t.txn))


@case("active", "txn", f"SELECT {BY} FROM txn WHERE status NOT IN ({', '.join(repr(s) for s in views.TERMINAL)}) GROUP BY 1, 2, 3")
def _(t):
    return _by(views.active(t.txn))


@case("recent", "txn", f"SELECT {BY} FROM txn WHERE CAST(transaction_ts AS DATE) BETWEEN DATE '2001-08-06' AND DATE '2001-11-04' GROUP BY 1, 2, 3")
def _(t):
    return _by(views.recent_rows(t.txn, AS_OF))


@case("correspondents", "txn party_address", f"""
SELECT a.correspondent_bank_bic, a.correspondent_bank_name, count(*) AS wire_count, CAST(sum({S}) AS DOUBLE) AS volume, CAST(sum({S}) AS DOUBLE) / count(*) AS average
FROM txn t JOIN (SELECT DISTINCT party_id, correspondent_bank_bic, correspondent_bank_name FROM party_address WHERE address_type = 'CORRESPONDENT') a ON a.party_id = t.beneficiary_party_id WHERE t.payment_type = 'WIRE' AND t.payment_rail = 'SWIFT' GROUP BY 1, 2""")
def _(t):
    return views.correspondents(t.party_address, t.txn)
