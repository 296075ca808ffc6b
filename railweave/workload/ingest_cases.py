"""Registered queries: sources, sinks, normalisation and on-us."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import gold, normalize as nrm, onus
from ..sources import storage
from ..sources.schemas import RAW_DATED_BY
from ..session import scratch_path
from .registry import case

FROM, TO = dt.date(1998, 1, 1), dt.date(2000, 12, 31)
RAW_ID = {"ach": "ach_transaction_id", "wire": "wire_transaction_id", "card": "card_transaction_id", "zelle": "zelle_transaction_id",
          "rtp_fednow": "instant_payment_id", "check_rdc": "check_transaction_id", "billpay": "bill_pay_transaction_id"}


def _scan(rail: str):
    stamp = RAW_DATED_BY[rail]

    @case(f"read_raw_{rail}", f"raw_{rail}", f"""
SELECT tenant_id, status, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount, min({RAW_ID[rail]}) AS first_id
FROM raw_{rail} WHERE {stamp} IS NULL OR CAST({stamp} AS DATE) BETWEEN DATE '{FROM}' AND DATE '{TO}' GROUP BY 1, 2""")
    def _(t):
        path = scratch_path(t.spark, f"raw_{rail}")
        storage.write_raw(getattr(t, f"raw_{rail}"), rail, path, period="month")
        rows = storage.read_raw(t.spark, rail, path, FROM, TO, undated=True, period="month")
        return rows.groupBy("tenant_id", "status").agg(
            F.count("*").alias("n"), F.sum("amount").alias("amount"), F.min(RAW_ID[rail]).alias("first_id"))


for _rail in RAW_ID:
    _scan(_rail)

BY_TYPE = "payment_type, status, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount"


def _by_type(df):
    return df.groupBy("payment_type", "status").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


@case("read_staging", "txn", f"SELECT {BY_TYPE} FROM txn GROUP BY 1, 2")
def _(t):
    path = scratch_path(t.spark, "staging")
    t.txn.write.parquet(path)
    return _by_type(storage.read_staging(t.spark, path))


@case("tenant_scan", "txn", f"SELECT {BY_TYPE} FROM txn WHERE tenant_id = 'T2' GROUP BY 1, 2")
def _(t):
    return _by_type(storage.tenant_scan(t.txn, "T2"))


@case("scan_silver", "txn", f"""
SELECT {BY_TYPE} FROM txn WHERE CAST(transaction_ts AS DATE) BETWEEN DATE '{FROM}' AND DATE '{TO}' GROUP BY 1, 2""")
def _(t):
    return _by_type(storage.scan_silver(t.txn, FROM, TO))


@case("write_silver", "txn", f"""
SELECT {BY_TYPE} FROM txn WHERE CAST(transaction_ts AS DATE) BETWEEN DATE '{FROM}' AND DATE '{TO}' AND amount >= 20000 GROUP BY 1, 2""")
def _(t):
    """Store all, then replace every day by its large payments only; emptied days disappear."""
    path = scratch_path(t.spark, "silver")
    txn = t.txn.select("transaction_id", "tenant_id", "payment_type", "status", "amount", "transaction_ts")
    storage.write_silver(txn, path, period="month")
    days = txn.select(F.to_date("transaction_ts")).distinct()
    storage.write_silver(txn.filter("amount >= 20000"), path, days, period="month")
    return _by_type(storage.scan_silver(t.spark.read.parquet(path), FROM, TO, period="month"))


@case("write_gold", "txn", """
SELECT tenant_id, payment_type, count(*) AS days, CAST(sum(n) AS BIGINT) AS inbound_count FROM (
  SELECT tenant_id, payment_type, CAST(transaction_ts AS DATE) AS d, count(*) FILTER (direction = 'INBOUND') AS n FROM txn GROUP BY 1, 2, 3) x GROUP BY 1, 2""")
def _(t):
    """Writing the same days twice leaves one copy."""
    path = scratch_path(t.spark, "gold")
    daily = gold.gold_cross_rail(t.txn)
    stamp = dt.datetime(2002, 1, 1)
    storage.write_gold(daily, path, updated_at=stamp, period="month")
    storage.write_gold(gold.refresh_gold(t.txn, t.txn.filter("_cdc_timestamp >= timestamp'2001-10-01 00:00:00'"), period="month"), path, updated_at=stamp, period="month")
    return t.spark.read.parquet(path).groupBy("tenant_id", "payment_type").agg(
        F.count("*").alias("days"), F.sum("inbound_count").alias("inbound_count"))


# --- normalisation ------------------------------------------------------------

SHOWN = ["tenant_id", "source_transaction_id", "payment_type", "payment_rail", "payment_subtype", "direction", "amount", "currency_code",
         "settlement_amount", "settlement_currency_code", "original_currency_code", "original_amount", "fx_rate", "fx_rate_source", "fee_amount",
         "transaction_ts", "settlement_date", "status", "return_reason_code", "description", "is_recurring", "originator_account_token",
         "originator_routing_number", "beneficiary_account_token", "beneficiary_routing_number", "json_probe"]

NULLS = {c: "CAST(NULL AS DOUBLE)" for c in ("settlement_amount", "original_amount", "fx_rate", "fee_amount")} | {
    c: "CAST(NULL AS VARCHAR)" for c in ("settlement_currency_code", "original_currency_code", "fx_rate_source", "settlement_date", "return_reason_code",
                                         "description", "originator_routing_number", "beneficiary_routing_number")} | {
    "is_recurring": "CAST(NULL AS BOOLEAN)", "currency_code": "'USD'", "status": "status", "tenant_id": "tenant_id", "amount": "CAST(amount AS DOUBLE)"}

OUT = "CASE WHEN {c} IN ('INBOUND', 'RECEIVE', 'DEPOSIT') THEN 'INBOUND' ELSE 'OUTBOUND' END"
KIND = "CASE transaction_type WHEN 'CREDIT_TRANSFER' THEN 'CREDIT' WHEN 'REQUEST_FOR_PAYMENT' THEN 'RFP' ELSE transaction_type END"
RULES = {
    "ach": dict(
        source_transaction_id="ach_transaction_id", payment_type="'ACH'", payment_rail="'NACHA'", payment_subtype="'ACH_' || transaction_type",
        direction="direction", amount="CAST(abs(amount) AS DOUBLE)", transaction_ts="created_timestamp", settlement_date="CAST(settlement_date AS VARCHAR)",
        status="CASE WHEN status = '00' THEN 'SETTLED' WHEN status = '01' THEN 'PENDING' WHEN status LIKE 'R0%' THEN 'RETURNED' ELSE status END",
        return_reason_code="return_reason_code", description="company_entry_description", is_recurring="company_entry_description = 'AUTOPAY'",
        originator_account_token="originator_account_number", originator_routing_number="originator_routing_number",
        beneficiary_account_token="receiver_account_number", beneficiary_routing_number="receiver_routing_number", json_probe="trace_number"),
    "wire": dict(
        source_transaction_id="wire_transaction_id", payment_type="'WIRE'", payment_rail="CASE WHEN wire_type = 'DOMESTIC' THEN 'FEDWIRE' ELSE 'SWIFT' END",
        payment_subtype="'WIRE_' || wire_type", direction="direction", currency_code="currency_code",
        settlement_amount="CAST(usd_equivalent_amount AS DOUBLE)", settlement_currency_code="CASE WHEN currency_code <> 'USD' THEN 'USD' END",
        original_currency_code="CASE WHEN currency_code <> 'USD' THEN currency_code END", original_amount="CASE WHEN currency_code <> 'USD' THEN CAST(amount AS DOUBLE) END",
        fx_rate="CAST(CASE WHEN currency_code <> 'USD' THEN coalesce(fx_rate, CAST(CAST(usd_equivalent_amount AS DOUBLE) / CAST(amount AS DOUBLE) AS DECIMAL(18,8))) END AS DOUBLE)",
        fx_rate_source="CASE WHEN currency_code <> 'USD' THEN CASE WHEN fx_rate IS NULL THEN 'DERIVED' ELSE 'RAIL' END END",
        transaction_ts="initiated_timestamp", settlement_date="CAST(CAST(completed_timestamp AS DATE) AS VARCHAR)", description="reference_for_beneficiary",
        originator_account_token="sender_account_number", originator_routing_number="sender_routing_number",
        beneficiary_account_token="beneficiary_account_number", beneficiary_routing_number="beneficiary_routing_number", json_probe="imad"),
    "card": dict(
        source_transaction_id="card_transaction_id", payment_type="'CARD'", payment_rail="card_brand", payment_subtype="'CARD_' || card_type",
        direction="CASE WHEN transaction_type IN ('REFUND', 'REVERSAL') THEN 'INBOUND' ELSE 'OUTBOUND' END", currency_code="currency_code",
        settlement_amount="CASE WHEN currency_code <> 'USD' THEN CAST(billing_amount AS DOUBLE) END", settlement_currency_code="CASE WHEN currency_code <> 'USD' THEN 'USD' END",
        original_currency_code="CASE WHEN currency_code <> 'USD' THEN currency_code END", original_amount="CASE WHEN currency_code <> 'USD' THEN CAST(amount AS DOUBLE) END",
        fx_rate="CAST(CASE WHEN currency_code <> 'USD' THEN CAST(CAST(billing_amount AS DOUBLE) / CAST(amount AS DOUBLE) AS DECIMAL(18,8)) END AS DOUBLE)",
        fx_rate_source="CASE WHEN currency_code <> 'USD' THEN 'DERIVED' END", fee_amount="CAST(interchange_fee + network_fee + surcharge_amount AS DOUBLE)",
        transaction_ts="coalesce(auth_timestamp, settlement_timestamp, posted_timestamp)", settlement_date="CAST(CAST(settlement_timestamp AS DATE) AS VARCHAR)",
        is_recurring="is_recurring OR entry_mode = 'RECURRING'", originator_account_token="card_number_token", beneficiary_account_token="merchant_id",
        json_probe="merchant_category_code"),
    "zelle": dict(
        source_transaction_id="zelle_transaction_id", payment_type="'ZELLE'", payment_rail="'EWS'", payment_subtype="'ZELLE_' || transaction_type",
        direction=OUT.format(c="transaction_type"), transaction_ts="initiated_timestamp", settlement_date="CAST(CAST(completed_timestamp AS DATE) AS VARCHAR)",
        description="memo", originator_account_token="sender_account_token", originator_routing_number="sender_fi_id",
        beneficiary_account_token="receiver_account_token", beneficiary_routing_number="receiver_fi_id", json_probe="zelle_network_ref"),
    "rtp_fednow": dict(
        source_transaction_id="instant_payment_id", payment_type="payment_rail", payment_rail="CASE WHEN payment_rail = 'RTP' THEN 'TCH_RTP' ELSE payment_rail END",
        payment_subtype=f"payment_rail || '_' || {KIND}", direction=OUT.format(c="direction"), transaction_ts="initiated_timestamp",
        settlement_date="CAST(CAST(settled_timestamp AS DATE) AS VARCHAR)", return_reason_code="return_reason_code", description="remittance_info",
        originator_account_token="sender_account_token", originator_routing_number="sender_routing_number",
        beneficiary_account_token="receiver_account_token", beneficiary_routing_number="receiver_routing_number", json_probe="end_to_end_id"),
    "check_rdc": dict(
        source_transaction_id="check_transaction_id", payment_type="CASE WHEN deposit_type = 'MOBILE_RDC' THEN 'RDC' ELSE 'CHECK' END", payment_rail="'SVPCO'",
        payment_subtype="CASE WHEN deposit_type = 'MOBILE_RDC' THEN 'RDC_' ELSE 'CHECK_' END || check_type", direction=OUT.format(c="transaction_type"),
        transaction_ts="deposit_timestamp", settlement_date="CAST(CAST(cleared_timestamp AS DATE) AS VARCHAR)", return_reason_code="return_reason_code",
        originator_account_token="payer_account_number", originator_routing_number="payer_routing_number", beneficiary_account_token="payee_account_token",
        json_probe="check_number"),
    "billpay": dict(
        source_transaction_id="bill_pay_transaction_id", payment_type="'BILLPAY'", payment_rail="'MIXED'", payment_subtype="'BILLPAY_' || payment_type",
        direction="'OUTBOUND'", fee_amount="CAST(fee_amount AS DOUBLE)", transaction_ts="created_timestamp", settlement_date="CAST(delivery_date AS VARCHAR)",
        is_recurring="is_recurring", originator_account_token="coalesce(payer_account_token, payer_card_token)", beneficiary_account_token="biller_id",
        json_probe="biller_id"),
}
PROBE = {"ach": "trace_number", "wire": "imad", "card": "merchant_category_code", "zelle": "zelle_reference_id", "rtp_fednow": "end_to_end_id",
         "check_rdc": "check_number", "billpay": "biller_id"}
QUERY_NAME = {"rtp_fednow": "normalize_instant", "check_rdc": "normalize_check"}


def rail_select(rail: str, columns=SHOWN) -> str:
    rule = NULLS | RULES[rail]
    rule = rule | {"transaction_ts": f"CAST({rule['transaction_ts']} AS VARCHAR)"}
    return f"SELECT {', '.join(f'{rule[c]} AS {c}' for c in columns)} FROM raw_{rail}"


def _normalize(rail: str):
    @case(QUERY_NAME.get(rail, f"normalize_{rail}"), f"raw_{rail}", rail_select(rail))
    def _(t):
        silver = nrm.NORMALIZERS[rail](getattr(t, f"raw_{rail}"))
        return silver.withColumn("json_probe", F.get_json_object("rail_details_json", f"$.{PROBE[rail]}")).select(*SHOWN)


for _rail in RULES:
    _normalize(_rail)

ALL_RAW = " ".join(f"raw_{r}" for r in RULES)
UNION = " UNION ALL ".join(rail_select(r) for r in RULES)


def union_all(t):
    return nrm.union_rails(*[fn(getattr(t, f"raw_{rail}")) for rail, fn in nrm.NORMALIZERS.items()])


@case("union_rails", ALL_RAW, f"""
SELECT payment_type, direction, status, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount,
  CAST(sum(CAST(settlement_amount AS DECIMAL(18,2))) AS DOUBLE) AS settled FROM ({UNION}) u GROUP BY 1, 2, 3""")
def _(t):
    return union_all(t).groupBy("payment_type", "direction", "status").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount"), F.sum("settlement_amount").alias("settled"))


RESOLVED = """i AS (SELECT * FROM on_us_institutions WHERE is_active),
x AS (SELECT t.*, CAST(t.transaction_ts AS DATE) AS day, o.tenant_id AS ot, b.tenant_id AS bt,
  o.is_rtp_participant AND b.is_rtp_participant AS rtp, o.is_fednow_participant AND b.is_fednow_participant AS fednow,
  o.is_zelle_participant AND b.is_zelle_participant AS zelle,
  CASE WHEN o.tenant_id IS NOT NULL AND b.tenant_id IS NOT NULL THEN o.tenant_id = b.tenant_id
    ELSE t.originator_routing_number = t.beneficiary_routing_number END AS us
  FROM {source} t
  LEFT JOIN i o ON o.routing_number = t.originator_routing_number AND CAST(t.transaction_ts AS DATE) >= o.effective_date AND CAST(t.transaction_ts AS DATE) <= coalesce(o.expiry_date, DATE '9999-12-31')
  LEFT JOIN i b ON b.routing_number = t.beneficiary_routing_number AND CAST(t.transaction_ts AS DATE) >= b.effective_date AND CAST(t.transaction_ts AS DATE) <= coalesce(b.expiry_date, DATE '9999-12-31'))"""


@case("raw_to_daily_flow", ALL_RAW + " on_us_institutions", f"""WITH u AS ({UNION}), {RESOLVED.format(source='u')}
SELECT tenant_id, CAST(day AS VARCHAR) AS period_date, payment_type,
  count(*) FILTER (direction = 'INBOUND') AS inbound_count, CAST(sum(CASE WHEN direction = 'INBOUND' THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS inbound_amount,
  count(*) FILTER (direction = 'OUTBOUND') AS outbound_count, CAST(sum(CASE WHEN direction = 'OUTBOUND' THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS outbound_amount,
  CAST(sum(CASE WHEN direction = 'INBOUND' THEN CAST(amount AS DECIMAL(18,2)) WHEN direction = 'OUTBOUND' THEN -CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS net_amount,
  count(*) FILTER (us) AS on_us_count, CAST(sum(CASE WHEN us THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS on_us_amount
FROM x GROUP BY 1, 2, 3""")
def _(t):
    return gold.gold_cross_rail(onus.derive_on_us(union_all(t), t.on_us_institutions))


FEED = ["canon_direction", "canon_status", "parse_yymmdd", "abs_amount", "canon_flags"]
FEED_SQL = {
    "canon_direction": "flow, CASE WHEN flow IN ('CREDIT', 'RECEIVE') THEN 'INBOUND' ELSE 'OUTBOUND' END AS direction",
    "canon_status": "txn_status, CASE WHEN txn_status = '00' THEN 'SETTLED' WHEN txn_status = '01' THEN 'PENDING' WHEN txn_status LIKE 'R%' THEN 'RETURNED' ELSE txn_status END AS status",
    "parse_yymmdd": "eff_dt, CAST(CAST(TRY_STRPTIME('20' || eff_dt, '%Y%m%d') AS DATE) AS VARCHAR) AS effective_date",
    "abs_amount": "payment_type, CAST(abs(txn_amt) AS DOUBLE) AS amount",
    "canon_flags": "same_day_flg, txn_type, CASE same_day_flg WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS same_day_flag, CASE txn_type WHEN 'CR' THEN 'CREDIT' ELSE 'DEBIT' END AS transaction_type",
}
FEED_COLUMNS = {"canon_direction": ["flow", "direction"], "canon_status": ["txn_status", "status"], "parse_yymmdd": ["eff_dt", "effective_date"],
                "abs_amount": ["payment_type", "amount"], "canon_flags": ["same_day_flg", "txn_type", "same_day_flag", "transaction_type"]}


def _feed(name: str):
    @case(name, "source_feed", f"SELECT {FEED_SQL[name]}, count(*) AS n FROM source_feed GROUP BY ALL")
    def _(t):
        return nrm.canon_flags(t.source_feed).groupBy(*FEED_COLUMNS[name]).agg(F.count("*").alias("n"))


for _name in FEED:
    _feed(_name)


def js(path: str) -> str:
    return f"json_extract_string(rail_details_json, '$.{path}')"


DESCRIPTION = (f"coalesce({js('company_entry_description')}, {js('originator_to_beneficiary_information')}, {js('remittance_information')}, "
               f"{js('memo_line')}, {js('memo')})")


@case("promote_description", "txn", f"SELECT transaction_id, coalesce(description, {DESCRIPTION}) AS description FROM txn")
def _(t):
    return nrm.promote_description(t.txn).select("transaction_id", "description")


@case("promote_return_code", "txn", f"""
SELECT payment_type, status, coalesce(return_reason_code, {js('return_details.return_reason_code')}) AS return_reason_code, count(*) AS n
FROM (SELECT * REPLACE (CASE WHEN payment_type IN ('ACH', 'RTP', 'CHECK') THEN NULL ELSE return_reason_code END AS return_reason_code) FROM txn) x GROUP BY ALL""")
def _(t):
    blank = F.when(~F.col("payment_type").isin("ACH", "RTP", "CHECK"), F.col("return_reason_code"))
    return nrm.promote_return_code(t.txn.withColumn("return_reason_code", blank)).groupBy(
        "payment_type", "status", "return_reason_code").agg(F.count("*").alias("n"))


@case("promote_recurring", "txn", f"""
SELECT payment_type, CASE payment_type WHEN 'BILLPAY' THEN {js('recurring_details.is_recurring')} = 'true'
  WHEN 'CARD' THEN coalesce({js('card_entry_mode')} = 'RECURRING', FALSE) WHEN 'ACH' THEN coalesce({js('company_entry_description')} = 'AUTOPAY', FALSE) END AS is_recurring,
  count(*) AS n FROM txn GROUP BY ALL""")
def _(t):
    bare = t.txn.withColumn("is_recurring", F.lit(None).cast("boolean"))
    return nrm.promote_recurring(bare).groupBy("payment_type", "is_recurring").agg(F.count("*").alias("n"))


@case("derive_fx", "txn", """
SELECT transaction_id, original_currency_code, CAST(original_amount AS DOUBLE) AS original_amount, settlement_currency_code,
  CAST(CAST(CAST(settlement_amount AS DOUBLE) / CAST(amount AS DOUBLE) AS DECIMAL(18,8)) AS DOUBLE) AS fx_rate,
  CASE WHEN payment_type = 'WIRE' THEN CASE json_extract_string(rail_details_json, '$.charges_borne_by') WHEN 'SENDER' THEN 'OUR' WHEN 'RECEIVER' THEN 'BEN' ELSE 'SHA' END END AS charges
FROM txn WHERE payment_type IN ('WIRE', 'CARD')""")
def _(t):
    bare = t.txn.filter("payment_type in ('WIRE', 'CARD')").withColumns({
        "fx_rate": F.lit(None).cast("decimal(18,8)"), "original_currency_code": F.lit(None).cast("string")})
    return nrm.wire_charges(nrm.derive_fx(bare)).select(
        "transaction_id", "original_currency_code", "original_amount", "settlement_currency_code", "fx_rate", "charges")


@case("pack_rail_json", "raw_ach", """
SELECT ach_transaction_id AS id, transaction_type, entry_class_code, trace_number, CASE WHEN same_day_flag THEN 'true' ELSE 'false' END AS same_day, return_reason_code AS return_code
FROM raw_ach""")
def _(t):
    packed = nrm.pack_rail_json("ach")
    get = lambda p: F.get_json_object("j", f"$.{p}")
    return t.raw_ach.select(F.col("ach_transaction_id").alias("id"), packed.alias("j")).select(
        "id", get("transaction_type").alias("transaction_type"), get("entry_class_code").alias("entry_class_code"),
        get("trace_number").alias("trace_number"), get("same_day_flag").alias("same_day"),
        get("return_details.return_reason_code").alias("return_code"))


@case("unpack_rail_json", "txn", f"""
SELECT transaction_id, {js('wire_subtype')} AS wire_subtype, {js('imad')} AS imad, {js('foreign_exchange.original_currency_code')} AS fx_currency,
  CAST({js('foreign_exchange.original_amount')} AS DOUBLE) AS fx_amount FROM txn WHERE payment_type = 'WIRE'""")
def _(t):
    return nrm.unpack_rail_json(t.txn, "WIRE").select(
        "transaction_id", "rail.wire_subtype", "rail.imad", F.col("rail.foreign_exchange.original_currency_code").alias("fx_currency"),
        F.col("rail.foreign_exchange.original_amount").alias("fx_amount"))


@case("upgrade_rail_json", "rail_v1", """WITH o AS (SELECT *, json_extract(rail_details_json, '$.fields') AS f FROM rail_v1)
SELECT transaction_id, payment_type, 'v2' AS version,
  CASE payment_type WHEN 'ACH' THEN CASE WHEN json_extract_string(f, '$.transaction_type') IN ('CR', 'Credit') THEN 'CREDIT' ELSE 'DEBIT' END
    WHEN 'CARD' THEN CASE json_extract_string(f, '$.transaction_type') WHEN 'SETTLEMENT' THEN 'CAPTURE' ELSE json_extract_string(f, '$.transaction_type') END
    ELSE CASE json_extract_string(f, '$.wire_type') WHEN 'DOMESTIC' THEN 'FEDWIRE_DOMESTIC' ELSE 'SWIFT_INTERNATIONAL' END END AS kind,
  CASE payment_type WHEN 'CARD' THEN CASE json_extract_string(f, '$.card_entry_mode') WHEN 'MANUAL' THEN 'MANUAL_KEY' WHEN 'ECOM' THEN 'ECOMMERCE' ELSE 'CHIP' END
    WHEN 'WIRE' THEN CASE json_extract_string(f, '$.charges') WHEN 'OUR' THEN 'SENDER' WHEN 'BEN' THEN 'RECEIVER' ELSE 'SHARED' END END AS mode,
  payment_type = 'WIRE' AS has_imad,
  CASE payment_type WHEN 'ACH' THEN concat_ws('|', f ->> '$.batch_number', f ->> '$.file_id', f ->> '$.addenda_information', f ->> '$.return_reason_code', f ->> '$.return_date', f ->> '$.noc_code', f ->> '$.transaction_code', f ->> '$.trace_number')
    WHEN 'CARD' THEN concat_ws('|', f ->> '$.merchant_id', f ->> '$.authorization_code', f ->> '$.terminal_id', f ->> '$.network_reference_id', f ->> '$.card_present', f ->> '$.cvv_present')
    ELSE concat_ws('|', f ->> '$.wire_reference_number', f ->> '$.beneficiary_bank_name', f ->> '$.payment_instruction', f ->> '$.sender_reference', f ->> '$.beneficiary_country') END AS carried FROM o""")
def _(t):
    get = lambda p: F.get_json_object("rail_details_json", f"$.{p}")
    return nrm.upgrade_rail_json(t.rail_v1).select(
        "transaction_id", "payment_type", F.col("rail_schema_version").alias("version"),
        F.when(F.col("payment_type") == "ACH", get("transaction_type")).when(F.col("payment_type") == "CARD", get("transaction_subtype"))
        .otherwise(get("wire_subtype")).alias("kind"),
        F.coalesce(get("card_entry_mode"), get("charges_borne_by")).alias("mode"),
        F.array_contains(F.json_object_keys("rail_details_json"), "imad").alias("has_imad"),
        F.when(F.col("payment_type") == "ACH", F.concat_ws("|", get("batch_number"), get("file_id"), get("addenda_records[0].payment_related_information"),
                                                           get("return_details.return_reason_code"), get("return_details.return_date"), get("noc_details.noc_code"),
                                                           get("v1_fields.transaction_code"), get("trace_number")))
        .when(F.col("payment_type") == "CARD", F.concat_ws("|", get("merchant_id"), get("authorization_code"), get("terminal_id"), get("network_transaction_id"),
                                                           get("card_present"), get("v1_fields.cvv_present")))
        .otherwise(F.concat_ws("|", get("fed_reference_number"), get("beneficiary_fi_name"), get("originator_to_beneficiary_information"),
                               get("v1_fields.sender_reference"), get("v1_fields.beneficiary_country"))).alias("carried"))


@case("addenda", "txn", """WITH a AS (
  SELECT transaction_id, unnest(CAST(coalesce(json_extract(rail_details_json, '$.addenda_records'), '[null]') AS JSON[])) AS r FROM txn WHERE payment_type = 'ACH')
SELECT transaction_id, CAST(r ->> '$.sequence_number' AS INTEGER) AS sequence_number, r ->> '$.addenda_type_code' AS addenda_type_code,
  r ->> '$.payment_related_information' AS payment_related_information FROM a""")
def _(t):
    return nrm.addenda(t.txn)


@case("regulatory_codes", "txn", """WITH a AS (
  SELECT transaction_id, unnest(CAST(coalesce(json_extract(rail_details_json, '$.regulatory_reporting'), '[null]') AS JSON[])) AS r FROM txn WHERE payment_type = 'WIRE')
SELECT transaction_id, r ->> '$.authority' AS authority, r ->> '$.reporting_code' AS reporting_code, r ->> '$.information' AS information FROM a""")
def _(t):
    return nrm.regulatory_codes(t.txn)


@case("fee_breakdown", "txn", """WITH a AS (
  SELECT payment_type, unnest(CAST(fee_breakdown_json AS JSON[])) AS f FROM txn WHERE fee_breakdown_json IS NOT NULL)
SELECT payment_type, f ->> '$.type' AS fee_type, count(*) AS fee_count, CAST(sum(CAST(f ->> '$.amount' AS DECIMAL(18,4))) AS DOUBLE) AS fee_total FROM a GROUP BY 1, 2""")
def _(t):
    return nrm.fee_breakdown(t.txn)


@case("compliance_summary", "txn", """WITH a AS (
  SELECT payment_type, compliance_json AS c, unnest(CASE WHEN json_array_length(compliance_json, '$.flags') = 0 THEN ['NONE'] ELSE CAST(json_extract(compliance_json, '$.flags') AS VARCHAR[]) END) AS flag FROM txn)
SELECT payment_type, c ->> '$.aml_status' AS aml_status, c ->> '$.sanction_status' AS sanction_status, flag, count(*) AS row_count,
  max(CAST(c ->> '$.fraud_score' AS INTEGER)) AS max_fraud_score FROM a GROUP BY 1, 2, 3, 4""")
def _(t):
    return nrm.compliance_summary(t.txn)


# target column, source, kind, type, rule
MAPPING = [
    ("txn_id", "source_transaction_id", "DIRECT_MAP", "string", None),
    ("tenant_fi_id", "tenant_id", "DIRECT_MAP", "string", None),
    ("txn_amt", "amount", "EXPRESSION", "decimal(18,2)", "abs(txn_amt)"),
    ("eff_dt", "effective_date", "DERIVE", "date", "try_to_date(concat('20', eff_dt), 'yyyyMMdd')"),
    ("txn_status", "status", "LOOKUP", "string", "00=SETTLED;01=PENDING"),
    ("txn_type", "transaction_type", "CONDITIONAL", "string", "CASE WHEN txn_type = 'CR' THEN 'CREDIT' WHEN txn_type = 'DR' THEN 'DEBIT' END"),
    ("odfi_routing", "routing_pair", "CONCAT", "string", "concat_ws('>', odfi_routing, rdfi_routing)"),
    (None, "schema_version", "CONSTANT", "string", "v4"),
    ("trace_num", "trace_number", "CAST", "bigint", None),
    ("orig_acct_num", "ignored", "IGNORE", "string", None),
    ("orig_acct_num", "originator_account_token", "TOKENIZE", "string", None),
]


@case("apply_mapping", "source_feed", """
SELECT txn_id AS source_transaction_id, tenant_fi_id AS tenant_id, CAST(abs(txn_amt) AS DOUBLE) AS amount,
  CAST(CAST(TRY_STRPTIME('20' || eff_dt, '%Y%m%d') AS DATE) AS VARCHAR) AS effective_date,
  CASE txn_status WHEN '00' THEN 'SETTLED' WHEN '01' THEN 'PENDING' ELSE txn_status END AS status, CASE txn_type WHEN 'CR' THEN 'CREDIT' ELSE 'DEBIT' END AS transaction_type,
  concat_ws('>', odfi_routing, rdfi_routing) AS routing_pair, 'v4' AS schema_version, CAST(trace_num AS BIGINT) AS trace_number,
  'tok_' || sha256('pepper' || orig_acct_num) AS originator_account_token FROM source_feed""")
def _(t):
    mapping = t.spark.createDataFrame(
        MAPPING, "source_field string, target_field string, transformation_type string, target_data_type string, expression string")
    return nrm.apply_mapping(t.source_feed, mapping, salt="pepper")


@case("protect", "source_feed", """
SELECT txn_id, 'tok_' || sha256('pepper' || orig_acct_num) AS orig_acct_num, sha256('pepper' || odfi_routing) AS odfi_routing,
  repeat('*', length(trace_num) - 4) || right(trace_num, 4) AS trace_num FROM source_feed""")
def _(t):
    rules = {"orig_acct_num": "TOKENIZE", "odfi_routing": "HASH", "trace_num": "MASK"}
    return nrm.protect(t.source_feed, rules, "pepper").select("txn_id", *rules)


@case("derive_subtype", ALL_RAW, f"SELECT payment_type, payment_subtype, count(*) AS n FROM ({UNION}) u GROUP BY 1, 2")
def _(t):
    return union_all(t).groupBy("payment_type", "payment_subtype").agg(F.count("*").alias("n"))


# --- on-us --------------------------------------------------------------------

ONUS = f"WITH {RESOLVED.format(source='txn')}"


@case("resolve_institution", "txn on_us_institutions", f"{ONUS} SELECT payment_type, ot AS originator_tenant_id, bt AS beneficiary_tenant_id, count(*) AS n FROM x GROUP BY 1, 2, 3")
def _(t):
    return onus.resolve_institution(t.txn, t.on_us_institutions).groupBy(
        "payment_type", "originator_tenant_id", "beneficiary_tenant_id").agg(F.count("*").alias("n"))


@case("derive_on_us", "txn on_us_institutions", f"{ONUS} SELECT transaction_id, us AS is_on_us FROM x")
def _(t):
    return onus.derive_on_us(t.txn, t.on_us_institutions).select("transaction_id", "is_on_us")


@case("settlement_type", "txn on_us_institutions", f"""{ONUS} SELECT payment_type, us AS is_on_us,
  CASE WHEN us THEN CASE WHEN payment_type IN ('ACH', 'WIRE', 'ZELLE') THEN 'INTERNAL_' || payment_type WHEN payment_type IN ('CHECK', 'RDC') THEN 'INTERNAL_CHECK' ELSE 'BOOK_TRANSFER' END END AS on_us_settlement_type,
  count(*) AS n FROM x GROUP BY ALL""")
def _(t):
    return onus.derive_on_us(t.txn, t.on_us_institutions).groupBy("payment_type", "is_on_us", "on_us_settlement_type").agg(F.count("*").alias("n"))


@case("rail_eligibility", "txn on_us_institutions", f"""{ONUS} SELECT payment_type, coalesce(rtp, FALSE) AS could_use_rtp,
  coalesce(fednow, FALSE) AS could_use_fednow, coalesce(zelle, FALSE) AS could_use_zelle, count(*) AS n FROM x GROUP BY 1, 2, 3, 4""")
def _(t):
    return onus.rail_eligibility(t.txn, t.on_us_institutions).groupBy(
        "payment_type", "could_use_rtp", "could_use_fednow", "could_use_zelle").agg(F.count("*").alias("n"))


@case("on_us_from_accounts", "txn party_account", """
SELECT t.payment_type, t.is_on_us, o.is_on_us AND b.is_on_us AS accounts_on_us, (o.is_on_us AND b.is_on_us) <> t.is_on_us AS on_us_mismatch, count(*) AS n
FROM txn t LEFT JOIN party_account o ON o.account_id = t.originator_account_id LEFT JOIN party_account b ON b.account_id = t.beneficiary_account_id GROUP BY ALL""")
def _(t):
    return onus.on_us_from_accounts(t.txn, t.party_account).groupBy(
        "payment_type", "is_on_us", "accounts_on_us", "on_us_mismatch").agg(F.count("*").alias("n"))
