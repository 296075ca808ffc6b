"""Registered queries: identity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import identity as ir
from ..plans import features
from ..session import stored
from .ingest_cases import ALL_RAW, NULLS, RULES, union_all
from .registry import case

ROLE = "transaction_id, tenant_id, '{r}' AS party_role, {l}_account_token AS account_token, {l}_routing_number AS routing_number, {l}_last4 AS last4, {l}_proxy_token AS proxy_token, {l}_name_token AS name_token"
OPEN = "q AS (" + " UNION ALL ".join(
    f"SELECT {ROLE.format(r=l.upper(), l=l)} FROM ir_queue WHERE {l}_resolution_status = 'UNRESOLVED'" for l in ("originator", "beneficiary")) + ")"


def _keyed(name: str, keys: str, source: str = "party_account") -> str:
    where = " AND ".join(f"{k.split(' AS ')[0]} IS NOT NULL" for k in keys.split(", "))
    return f"""{name} AS (SELECT tenant_id, {keys}, min(account_id) AS account_id, arg_min(party_id, account_id) AS party_id, count(*) AS shared
  FROM {source} WHERE {where} GROUP BY ALL)"""


MATCHES = f"""
{_keyed('m1', 'account_number_token AS k1')}, {_keyed('m2', 'institution_routing_number AS k1, card_last_four AS k2')}, {_keyed('m3', 'proxy_value_token AS k1')},
named AS (SELECT a.*, p.name_token FROM party_account a JOIN party p ON p.party_id = a.party_id), {_keyed('m4', 'name_token AS k1, institution_routing_number AS k2', 'named')},
res AS (SELECT q.*, coalesce('routing:' || q.routing_number, 'proxy:hash:' || sha256(q.proxy_token), 'account_prefix:' || substring(q.account_token, 1, 8)) AS block_key,
  CASE WHEN m1.shared IS NOT NULL THEN 'EXACT_TOKEN' WHEN m2.shared IS NOT NULL THEN 'ROUTING_ACCOUNT' WHEN m3.shared IS NOT NULL THEN 'PROXY_EXACT' WHEN m4.shared IS NOT NULL THEN 'NAME_ROUTING' WHEN q.account_token IS NOT NULL THEN 'NEW_PARTY' END AS match_rule,
  coalesce(m1.account_id, m2.account_id, m3.account_id, m4.account_id) AS account_id,
  coalesce(m1.party_id, m2.party_id, m3.party_id, m4.party_id, 'N' || sha256(q.tenant_id || '|' || q.account_token)) AS party_id,
  CASE WHEN coalesce(m1.shared, m2.shared, m3.shared, m4.shared) IS NULL THEN 'UNRESOLVED' WHEN coalesce(m1.shared, m2.shared, m3.shared, m4.shared) > 1 THEN 'CANDIDATE' ELSE 'CONFIRMED' END AS resolution_status
FROM q LEFT JOIN m1 ON m1.tenant_id = q.tenant_id AND m1.k1 = q.account_token LEFT JOIN m2 ON m2.tenant_id = q.tenant_id AND m2.k1 = q.routing_number AND m2.k2 = q.last4
LEFT JOIN m3 ON m3.tenant_id = q.tenant_id AND m3.k1 = q.proxy_token LEFT JOIN m4 ON m4.tenant_id = q.tenant_id AND m4.k1 = q.name_token AND m4.k2 = q.routing_number),
r AS (SELECT *, CAST(CASE match_rule WHEN 'EXACT_TOKEN' THEN 1.0 WHEN 'ROUTING_ACCOUNT' THEN 0.95 WHEN 'PROXY_EXACT' THEN 0.9 WHEN 'NAME_ROUTING' THEN 0.8 WHEN 'NEW_PARTY' THEN 0.0 END AS DOUBLE) AS resolution_confidence FROM res)"""
RES = f"{OPEN},{MATCHES}"
TABLES = "ir_queue party party_account"


def _resolved(t):
    return ir.resolve(ir.open_roles(t.ir_queue), t.party, t.party_account)


@case("ir_queue", "ir_queue", """
SELECT transaction_id, CAST(identity_resolution_hook_ts AS VARCHAR) AS identity_resolution_hook_ts FROM ir_queue
WHERE originator_resolution_status = 'UNRESOLVED' OR beneficiary_resolution_status = 'UNRESOLVED'""")
def _(t):
    return ir.ir_queue(t.ir_queue).select("transaction_id", "identity_resolution_hook_ts")


@case("block_keys", TABLES, f"WITH {RES} SELECT transaction_id, party_role, block_key FROM r")
def _(t):
    return ir.block_keys(ir.open_roles(t.ir_queue)).select("transaction_id", "party_role", "block_key")


def _rule(name: str, table: str, on: str, fn):
    rule = {"m1": "EXACT_TOKEN", "m2": "ROUTING_ACCOUNT", "m3": "PROXY_EXACT", "m4": "NAME_ROUTING"}[table]

    @case(name, TABLES, f"WITH {RES} SELECT q.transaction_id, q.party_role, m.account_id, m.shared FROM q JOIN {table} m ON m.tenant_id = q.tenant_id AND {on}")
    def _(t):
        rows = fn(ir.open_roles(t.ir_queue), t)
        return rows.filter(F.col(rule).isNotNull()).select("transaction_id", "party_role", F.col(f"{rule}.best.account_id").alias("account_id"), F.col(f"{rule}.shared").alias("shared"))


_rule("match_exact", "m1", "m.k1 = q.account_token", lambda q, t: ir.match_exact(q, t.party_account))
_rule("match_routing", "m2", "m.k1 = q.routing_number AND m.k2 = q.last4", lambda q, t: ir.match_routing(q, t.party_account))
_rule("match_proxy", "m3", "m.k1 = q.proxy_token", lambda q, t: ir.match_proxy(q, t.party_account))
_rule("match_name", "m4", "m.k1 = q.name_token AND m.k2 = q.routing_number", lambda q, t: ir.match_name(q, t.party, t.party_account))


@case("resolve", TABLES, f"WITH {RES} SELECT transaction_id, party_role, match_rule, account_id, party_id, resolution_status, resolution_confidence FROM r")
def _(t):
    return _resolved(t).select("transaction_id", "party_role", "match_rule", "account_id", "party_id", "resolution_status", "resolution_confidence")


@case("mint_parties", TABLES, f"""WITH {RES} SELECT tenant_id, party_id, count(*) AS first_seen_rows, 'UNRESOLVED' AS resolution_status FROM r WHERE match_rule = 'NEW_PARTY' GROUP BY 1, 2""")
def _(t):
    return ir.mint_parties(_resolved(t))


@case("resolution_events", TABLES, f"""WITH {RES} SELECT sha256(transaction_id || '|' || party_role) AS resolution_event_id, party_id AS source_party_id,
  CASE WHEN match_rule <> 'NEW_PARTY' THEN party_id END AS target_party_id,
  CASE WHEN match_rule = 'NEW_PARTY' THEN 'NEW_PARTY' WHEN resolution_status = 'CANDIDATE' THEN 'MATCH_CANDIDATE' ELSE 'MATCH_CONFIRMED' END AS event_type,
  match_rule AS resolution_method, block_key, resolution_confidence AS confidence_score, account_token AS compared_token,
  CASE WHEN match_rule = 'EXACT_TOKEN' THEN 'true' ELSE 'false' END AS token_match,
  CASE WHEN match_rule = 'EXACT_TOKEN' THEN account_token END AS expected_token, CASE WHEN match_rule = 'ROUTING_ACCOUNT' THEN last4 END AS expected_last4, name_token AS compared_name FROM r WHERE match_rule IS NOT NULL""")
def _(t):
    return ir.resolution_events(_resolved(t)).select(
        "resolution_event_id", "source_party_id", "target_party_id", "event_type", "resolution_method", "block_key", "confidence_score",
        F.get_json_object("match_attributes", "$.account_token.actual").alias("compared_token"),
        F.get_json_object("match_attributes", "$.account_token.match").alias("token_match"),
        F.get_json_object("match_attributes", "$.account_token.expected").alias("expected_token"),
        F.get_json_object("match_attributes", "$.last4.expected").alias("expected_last4"), F.get_json_object("match_attributes", "$.name_token.actual").alias("compared_name"))


@case("resolution_evidence", TABLES, f"""WITH {RES} SELECT r.transaction_id, r.party_role, r.match_rule AS resolution_method,
  a.account_number_token AS expected_token, r.account_token AS actual_token, a.institution_routing_number AS expected_routing, r.routing_number AS actual_routing,
  a.card_last_four AS expected_last4, r.last4 AS actual_last4, a.proxy_value_token AS expected_proxy, r.proxy_token AS actual_proxy,
  p.name_token AS expected_name, r.name_token AS actual_name
FROM r LEFT JOIN party_account a ON a.tenant_id = r.tenant_id AND a.account_id = r.account_id
LEFT JOIN party p ON p.tenant_id = r.tenant_id AND p.party_id = r.party_id AND r.match_rule <> 'NEW_PARTY' WHERE r.match_rule IS NOT NULL""")
def _(t):
    """Expected values are those of the chosen account and party, also for fields the rule did not compare."""
    return ir.resolution_evidence(_resolved(t), t.party, t.party_account)


@case("mark_identity_resolved", TABLES, f"""WITH {RES}
SELECT s.transaction_id, o.party_id AS originator_party_id, o.match_rule AS originator_match_rule, coalesce(o.resolution_status, s.originator_resolution_status) AS originator_resolution_status,
  b.party_id AS beneficiary_party_id, b.block_key AS beneficiary_block_key, coalesce(b.resolution_status, s.beneficiary_resolution_status) AS beneficiary_resolution_status,
  '2002-01-01 00:00:00' AS identity_resolution_hook_ts
FROM ir_queue s LEFT JOIN r o ON o.transaction_id = s.transaction_id AND o.party_role = 'ORIGINATOR' LEFT JOIN r b ON b.transaction_id = s.transaction_id AND b.party_role = 'BENEFICIARY'""")
def _(t):
    marked = ir.mark_identity_resolved(t.ir_queue, _resolved(t), F.lit("2002-01-01 00:00:00").cast("timestamp"))
    return marked.select("transaction_id", "originator_party_id", "originator_match_rule", "originator_resolution_status", "beneficiary_party_id",
                         "beneficiary_block_key", "beneficiary_resolution_status", "identity_resolution_hook_ts")


@case("survivor", "party", """WITH RECURSIVE w AS (
  SELECT party_id, merged_into_party_id AS spot, 1 AS n FROM party WHERE merged_into_party_id IS NOT NULL
  UNION ALL SELECT w.party_id, p.merged_into_party_id, n + 1 FROM w JOIN party p ON p.party_id = w.spot AND p.merged_into_party_id IS NOT NULL AND n < 50)
SELECT party_id, arg_max(spot, n) AS survivor_party_id, FALSE AS in_cycle FROM w GROUP BY 1""")
def _(t):
    return ir.survivor(t.party)


@case("apply_party_events", "party party_event", """WITH e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_party_id ORDER BY resolved_at DESC, resolution_event_id DESC) AS rn
  FROM party_event WHERE event_type IN ('MERGE', 'SPLIT', 'SUPERSEDED')) z WHERE rn = 1)
SELECT p.party_id, CASE e.event_type WHEN 'MERGE' THEN 'MERGED' WHEN 'SUPERSEDED' THEN 'SUPERSEDED' WHEN 'SPLIT' THEN 'CONFIRMED' ELSE p.resolution_status END AS resolution_status,
  CASE WHEN e.event_type = 'MERGE' THEN e.target_party_id WHEN e.event_type IS NULL THEN p.merged_into_party_id END AS merged_into_party_id,
  CASE WHEN e.event_type IN ('MERGE', 'SUPERSEDED') THEN FALSE WHEN e.event_type = 'SPLIT' THEN TRUE ELSE p.is_active END AS is_active
FROM party p LEFT JOIN e ON e.source_party_id = p.party_id""")
def _(t):
    return ir.apply_party_events(t.party, t.party_event).select("party_id", "resolution_status", "merged_into_party_id", "is_active")


@case("block_stats", "party_account", """
SELECT tenant_id, 'routing:' || institution_routing_number AS block_key, count(*) AS account_count, count(DISTINCT party_id) AS party_count
FROM party_account GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""")
def _(t):
    return ir.block_stats(t.party_account, 20)


@case("dup_parties", "party party_address", """WITH x AS (
  SELECT tenant_id, party_id, 'TAX_TOKEN' AS reason, tax_id_token AS evidence FROM party
  UNION ALL SELECT DISTINCT p.tenant_id, p.party_id, 'ADDRESS', a.address_line1_token FROM party p JOIN party_address a ON a.party_id = p.party_id),
g AS (SELECT *, min(party_id) OVER (PARTITION BY tenant_id, reason, evidence) AS keep_party_id, count(*) OVER (PARTITION BY tenant_id, reason, evidence) AS group_size FROM x WHERE evidence IS NOT NULL)
SELECT tenant_id, reason, keep_party_id, party_id AS duplicate_party_id, group_size FROM g WHERE party_id <> keep_party_id""")
def _(t):
    return ir.dup_parties(t.party, t.party_address)


# --- raw feeds to resolved silver to features, in one chain ------------------

NO_TEXT = "CAST(NULL AS VARCHAR)"
KEYS = {"card": {"originator_last4": "card_last_four"}, "zelle": {"originator_proxy_token": "sender_token", "beneficiary_proxy_token": "receiver_token"}}


def _side(rail: str, side: str) -> str:
    rule = NULLS | RULES[rail]
    keys = {k: KEYS.get(rail, {}).get(f"{side}_{k}", NO_TEXT) for k in ("last4", "proxy_token")}
    return (f"SELECT {rule['source_transaction_id']} AS transaction_id, tenant_id, {rule['payment_type']} AS payment_type, {rule['status']} AS status, '{side.upper()}' AS party_role, "
            f"{rule[f'{side}_account_token']} AS account_token, {rule[f'{side}_routing_number']} AS routing_number, {keys['last4']} AS last4, {keys['proxy_token']} AS proxy_token, "
            f"{NO_TEXT} AS name_token FROM raw_{rail}")


CHAIN = "q AS (" + " UNION ALL ".join(_side(rail, side) for rail in RULES for side in ("originator", "beneficiary")) + f"),{MATCHES}"


def _marked(t):
    silver = union_all(t)
    decided = ir.resolve(ir.open_roles(silver), t.party, t.party_account)
    return ir.mark_identity_resolved(silver, decided, F.lit("2002-01-01 00:00:00").cast("timestamp"))


@case("raw_to_resolved", f"{ALL_RAW} party party_account", f"""WITH {CHAIN}
SELECT payment_type, party_role, match_rule, resolution_status, count(*) AS n, count(account_id) AS accounts, count(DISTINCT party_id) AS parties FROM r GROUP BY 1, 2, 3, 4""")
def _(t):
    """Every rail normalised, both sides resolved and written back."""
    return ir.to_role_rows(_marked(t)).groupBy("payment_type", "party_role", "match_rule", "resolution_status").agg(
        F.count("*").alias("n"), F.count("account_id").alias("accounts"), F.countDistinct("party_id").alias("parties"))


@case("raw_to_features", f"{ALL_RAW} party party_account", f"""WITH {CHAIN}
SELECT tenant_id, count(*) AS n, count(DISTINCT party_id) AS parties, CAST(sum(CASE WHEN status = 'SETTLED' THEN 0 WHEN status IN ('FAILED', 'RETURNED') THEN 1 END) AS BIGINT) AS bad
FROM r WHERE party_role = 'ORIGINATOR' AND party_id IS NOT NULL GROUP BY 1""")
def _(t):
    """The same chain on to the feature table, which reads the resolved rows many times: stored once."""
    rows = features.feature_table(stored(_marked(t), "resolved"), t.party)
    return rows.groupBy("tenant_id").agg(F.count("*").alias("n"), F.countDistinct("originator_party_id").alias("parties"), F.sum("label").cast("bigint").alias("bad"))
