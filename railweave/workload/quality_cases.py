"""Registered queries: data quality and JSON contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts, quality as dq
from ..session import scratch_path
from ..sources import storage
from ..sources.refdata import DIRECTIONS, PAYMENT_TYPES, RETURN_CODES, STATUS_CODES, sql_values
from ..sources.schemas import REQUIRED_SILVER
from .registry import case


def words(items) -> str:
    return "(" + ", ".join(f"'{i}'" for i in items) + ")"


def js(path: str) -> str:
    return f"json_extract_string(rail_details_json, '$.{path}')"


VALID = "json_valid(rail_details_json)"
DOC = f"CASE WHEN {VALID} THEN rail_details_json END"
FILLED = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ("original_currency_code", "original_amount", "fx_rate", "fx_rate_source"))
NOT_NULL = {f"null:{c}": f"{c} IS NULL" for c in REQUIRED_SILVER}
DOMAINS = {"domain:payment_type": f"payment_type NOT IN {words(dq.TYPES)}", "domain:direction": f"direction NOT IN {words(dq.WAYS)}",
           "domain:_cdc_operation": "_cdc_operation NOT IN ('I', 'U', 'D')"}
CURRENCY = {"currency:case": "currency_code <> upper(currency_code)"}
AMOUNT = {"amount:negative": "amount < 0"}
OBJECT = {"json:not_object": f"rail_details_json IS NOT NULL AND NOT coalesce(CASE WHEN {VALID} THEN json_type(rail_details_json) = 'OBJECT' END, FALSE)"}
RESOLUTION = {f"domain:{s}_resolution_status": f"{s}_resolution_status NOT IN {words(dq.RESOLUTION)}" for s in ("originator", "beneficiary")}
FX = {"fx:inconsistent": "fx_rate IS NOT NULL AND NOT (original_currency_code IS NOT NULL AND original_amount IS NOT NULL AND original_currency_code <> settlement_currency_code)",
      "fx:partial": f"({FILLED}) NOT IN (0, 4)"}
TIMELINE = {"time:acknowledged_before_submitted": "acknowledged_ts < submitted_ts", "time:settled_before_acknowledged": "settled_ts < acknowledged_ts",
            "time:settlement_before_effective": "settlement_date < effective_date"}
SILVER = {**NOT_NULL, **DOMAINS, **CURRENCY, **AMOUNT, **OBJECT, **RESOLUTION, **FX}


def flagged(rules: dict[str, str], source: str = "dirty") -> str:
    cases = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules.items())
    return f"SELECT * FROM (SELECT *, unnest([{cases}]) AS flag FROM {source}) f WHERE flag IS NOT NULL"


def _count(df):
    return df.groupBy("tenant_id", "payment_type", "flag").agg(F.count("*").alias("row_count"))


def _rule_case(name: str, check, rules: dict[str, str]):
    @case(name, "dirty", f"SELECT tenant_id, payment_type, flag, count(*) AS row_count FROM ({flagged(rules)}) v GROUP BY 1, 2, 3")
    def _(t):
        return _count(check(t.dirty))


_rule_case("check_not_null", dq.check_not_null, NOT_NULL)
_rule_case("check_domains", dq.check_domains, DOMAINS)
_rule_case("check_currency", dq.check_currency, CURRENCY)
_rule_case("check_amount", dq.check_amount, AMOUNT)
_rule_case("check_json_object", dq.check_json_object, OBJECT)
_rule_case("check_resolution", dq.check_resolution, RESOLUTION)
_rule_case("check_fx", dq.check_fx, FX)
_rule_case("check_timeline", dq.check_timeline, TIMELINE)

KEYS = f"CASE WHEN {VALID} AND json_type(rail_details_json) = 'OBJECT' THEN json_keys(rail_details_json) ELSE [] END"
_rule_case("check_rail_keys", dq.check_rail_keys, {"json:first_contract_keys": "CASE payment_type " + " ".join(
    f"WHEN '{rail}' THEN NOT list_has_all({KEYS}, [{', '.join(repr(k) for k in keys)}])" for rail, keys in dq.FIRST_CONTRACT_KEYS.items()) + " END"})

TEXT = f"(CASE WHEN {VALID} THEN coalesce({js('company_entry_description')}, {js('originator_to_beneficiary_information')}, {js('remittance_information')}, {js('memo_line')}, {js('memo')}) END)"
CODE = f"(CASE WHEN {VALID} THEN {js('return_details.return_reason_code')} END)"
REC = f"(CASE WHEN {VALID} THEN {js('recurring_details.is_recurring')} = 'true' END)"
_rule_case("check_promotion", dq.check_promotion, {
    "promotion:description": f"{TEXT} IS NOT NULL AND description IS DISTINCT FROM {TEXT}",
    "promotion:return_reason_code": f"{CODE} IS NOT NULL AND return_reason_code IS DISTINCT FROM {CODE}",
    "promotion:is_recurring": f"payment_type = 'BILLPAY' AND {REC} IS NOT NULL AND is_recurring IS DISTINCT FROM {REC}"})


@case("check_unique", "dirty", """
SELECT 'change' AS key_name, source_transaction_id AS key_value, count(*) AS copies FROM dirty GROUP BY tenant_id, source_system, source_transaction_id, _cdc_sequence_id HAVING count(*) > 1
UNION ALL SELECT 'transaction', transaction_id, count(*) FROM dirty GROUP BY transaction_id HAVING count(*) > 1""")
def _(t):
    change = dq.check_unique(t.dirty, ["tenant_id", "source_system", "source_transaction_id", "_cdc_sequence_id"]).select(
        F.lit("change").alias("key_name"), F.col("source_transaction_id").alias("key_value"), "copies")
    row = dq.check_unique(t.dirty, ["transaction_id"]).select(F.lit("transaction"), "transaction_id", "copies")
    return change.union(row)


@case("check_fk", "dirty party", """
SELECT originator_party_id AS missing_key, count(*) AS reference_count FROM dirty d WHERE originator_party_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM party p WHERE p.party_id = d.originator_party_id) GROUP BY 1""")
def _(t):
    return dq.check_fk(t.dirty, t.party, "originator_party_id", "party_id")


LISTED = {"payment_type": PAYMENT_TYPES, "status": STATUS_CODES, "direction": DIRECTIONS, "return_reason_code": RETURN_CODES}


@case("check_ref", "dirty", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS code, count(*) AS row_count FROM dirty WHERE {c} NOT IN {words(r[0] for r in rows)} GROUP BY {c}" for c, rows in LISTED.items()))
def _(t):
    return dq.check_ref(t.dirty)


IDENTITY = {
    name: {f"domain:{c}": f"{c} NOT IN {words(allowed)}" for c, allowed in domains.items()} for name, domains in dq.IDENTITY_DOMAINS.items()}
IDENTITY["party"]["range:resolution_confidence"] = "NOT (resolution_confidence BETWEEN 0 AND 1)"
IDENTITY["party_relationship"] |= {"self_link": "party_id_a = party_id_b", "range:ownership_percentage": "NOT (ownership_percentage BETWEEN 0 AND 100)"}


@case("check_identity", " ".join(IDENTITY), " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, flag, count(*) AS row_count FROM ({flagged(rules, name)}) v GROUP BY 2" for name, rules in IDENTITY.items()))
def _(t):
    return dq.check_identity({name: getattr(t, name) for name in IDENTITY})


JOINED = "[" + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in SILVER.items()) + "]"
FLAG_COUNT = f"list_aggregate({JOINED}, 'count')"


@case("attach_dq_flags", "dirty", f"""SELECT event_id, '["' || list_aggregate(f, 'string_agg', '","') || '"]' AS dq_flags_json
FROM (SELECT event_id, {JOINED} AS f FROM dirty) v""")
def _(t):
    return dq.attach_dq_flags(t.dirty).select("event_id", "dq_flags_json")


@case("split_valid", "dirty", f"SELECT payment_type, {FLAG_COUNT} = 0 AS valid, count(*) AS row_count FROM dirty GROUP BY 1, 2")
def _(t):
    good, bad = dq.split_valid(t.dirty)
    count = lambda df, ok: df.groupBy("payment_type").agg(F.lit(ok).alias("valid"), F.count("*").alias("row_count"))
    return count(good, True).unionByName(count(bad, False))


@case("write_quarantine", "dirty", f"SELECT payment_type, count(*) AS row_count FROM dirty WHERE {FLAG_COUNT} > 0 GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "quarantine")
    storage.write_quarantine(dq.split_valid(t.dirty)[1], path, period="year")
    return t.spark.read.parquet(path).groupBy("payment_type").agg(F.count("*").alias("row_count"))


CARD = SILVER  # the whole rule set


@case("dq_scorecard", "dirty", "WITH g AS (SELECT tenant_id, payment_type, CAST(CAST(transaction_ts AS DATE) AS VARCHAR) AS period_date, count(*) AS row_count, "
      + ", ".join(f'count(*) FILTER ({cond}) AS "{name}"' for name, cond in CARD.items()) + " FROM dirty GROUP BY 1, 2, 3) "
      + " UNION ALL ".join(f"""SELECT tenant_id, payment_type, period_date, '{name}' AS flag, row_count, "{name}" AS broken_count,
  1.0 - CAST("{name}" AS DOUBLE) / CAST(row_count AS DOUBLE) AS pass_rate FROM g""" for name in CARD))
def _(t):
    return dq.dq_scorecard(t.dirty)


# --- JSON contracts -----------------------------------------------------------

DUCK = {"string": ["VARCHAR"], "boolean": ["BOOLEAN"], "integer": ["BIGINT", "UBIGINT"], "number": ["BIGINT", "UBIGINT", "DOUBLE"],
        "object": ["OBJECT"], "array": ["ARRAY"]}


def field_sql(path: str, spec: contracts.Field, required: bool, guard: str = "TRUE") -> list[str]:
    kind, value = f"json_type(rail_details_json, '$.{path}')", js(path)
    typed = f"coalesce({kind} IN {words(DUCK[spec.kind])}, FALSE)"
    tests = {}
    if required:
        tests["missing"] = f"{kind} IS NULL"
    tests["type"] = f"{kind} IS NOT NULL AND NOT {typed}" + (f" AND {kind} <> 'NULL'" if spec.null else "")
    if spec.one_of:
        tests["enum"] = f"{typed} AND {value} NOT IN {words(spec.one_of)}"
    if spec.pattern:
        tests["pattern"] = f"{typed} AND NOT regexp_matches({value}, '{spec.pattern}')"
    if spec.longest is not None:
        tests["length"] = f"{typed} AND length({value}) > {spec.longest}"
    bounds = ([f"CAST({value} AS DOUBLE) < {spec.low}"] if spec.low is not None else []) + ([f"CAST({value} AS DOUBLE) > {spec.high}"] if spec.high is not None else [])
    if bounds:
        tests["range"] = f"{typed} AND ({' OR '.join(bounds)})"
    out = [f"CASE WHEN {guard} AND ({cond}) THEN {{'path': '{path}', 'problem': '{name}'}} END" for name, cond in tests.items()]
    for name, part in spec.parts.items():
        out += field_sql(f"{path}.{name}", part, name in spec.needs, f"coalesce({kind} = 'OBJECT', FALSE)")
    return out


def contract_sql(version: str, source: str) -> str:
    selects = [f"SELECT transaction_id, payment_type, 'document' AS path, 'type' AS problem FROM {source} WHERE NOT coalesce({VALID}, FALSE) OR json_type({DOC}) <> 'OBJECT'"]
    for rail, (needs, fields) in contracts.CONTRACTS[version].items():
        tests = [c for name, spec in fields.items() for c in field_sql(name, spec, name in needs)]
        rows = f"(SELECT * FROM {source} WHERE payment_type = '{rail}' AND coalesce(json_type({DOC}) = 'OBJECT', FALSE)) d"
        selects.append(f"SELECT transaction_id, payment_type, p.path, p.problem FROM (SELECT transaction_id, payment_type, unnest([{', '.join(tests)}]) AS p FROM {rows}) u WHERE p IS NOT NULL")
        selects.append(f"SELECT transaction_id, payment_type, k, 'unknown' FROM (SELECT transaction_id, payment_type, unnest(json_keys(rail_details_json)) AS k FROM {rows}) u WHERE k NOT IN {words(fields)}")
        if version == "v1":
            selects.append(f"SELECT transaction_id, payment_type, 'fields.' || k, 'unknown' FROM (SELECT transaction_id, payment_type, unnest(json_keys(rail_details_json, '$.fields')) AS k FROM {rows}) u WHERE k NOT IN {words(fields['fields'].parts)}")
    return " UNION ALL ".join(selects)


@case("validate_rail_json", "dirty", f"SELECT payment_type, path, problem, count(*) AS row_count, min(transaction_id) AS first_id FROM ({contract_sql('v2', 'dirty')}) v GROUP BY 1, 2, 3")
def _(t):
    return contracts.validate_rail_json(t.dirty).groupBy("payment_type", "path", "problem").agg(
        F.count("*").alias("row_count"), F.min("transaction_id").alias("first_id"))


@case("validate_rail_json_v1", "rail_v1", contract_sql("v1", "rail_v1"))
def _(t):
    return contracts.validate_rail_json(t.rail_v1, "v1")
