"""Raw rails to the silver fact, and work on the rail JSON it carries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import (abs_amount, canon_direction, canon_status, charges_code, credit_debit, frequency,
                               parse_yymmdd, yes_no)
from ..sources.schemas import raw_schema, silver_schema
from .contracts import V2, Field

CARRIED = ["tenant_id", "channel", "_cdc_sequence_id", "_cdc_operation", "_cdc_timestamp", "_cdc_source_system",
           "_cdc_load_timestamp"]


def declared(raw: DataFrame, rail: str) -> DataFrame:
    """The feed with every declared column; those it does not deliver are NULL."""
    return raw.withColumns({f.name: F.lit(None).cast(f.dataType) for f in raw_schema(rail) if f.name not in raw.columns})


def name_token(name: str) -> Column:
    """A party name as its digest, upper case and trimmed; blank names have none."""
    plain = F.upper(F.trim(F.col(name)))
    return F.when(plain != "", F.sha2(plain, 256))


def iban_country(account: str, country: Column) -> Column:
    """Country of an account number in IBAN form, else the stated one."""
    return F.coalesce(F.when(F.col(account).rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), F.substring(account, 1, 2)), country)


def fee_json(**fees: str) -> Column:
    """Fees above zero as a JSON list of type and amount."""
    items = F.array(*[F.when(F.col(c) > 0, F.struct(F.lit(kind).alias("type"), F.col(c).cast("decimal(18,4)").alias("amount"))) for kind, c in fees.items()])
    some = F.filter(items, lambda x: x.isNotNull())
    return F.when(F.size(some) > 0, F.to_json(some))


def _silver(raw: DataFrame, **columns: Column) -> DataFrame:
    """Project onto the silver schema; columns a rail does not have are NULL."""
    usd = F.lit("USD")
    columns = {
        "source_system": F.col("_cdc_source_system"),
        "currency_code": usd,
        "status": canon_status("status"),
        "rail_schema_version": F.lit("v2"),
        "schema_version": F.lit("v4"),
        "event_ts": columns["transaction_ts"],
        "ingestion_ts": F.col("_cdc_load_timestamp"),
        "originator_resolution_status": F.lit("UNRESOLVED"),
        "beneficiary_resolution_status": F.lit("UNRESOLVED"),
        **{c: F.col(c) for c in CARRIED},
        **columns,
    }
    key = [columns["tenant_id"], columns["source_system"], columns["source_transaction_id"]]
    columns["transaction_id"] = F.sha2(F.concat_ws("|", *key), 256)
    columns["event_id"] = F.sha2(F.concat_ws("|", *key, columns["_cdc_sequence_id"], columns["_cdc_timestamp"].cast("string")), 256)
    columns.setdefault("effective_date", F.to_date(columns["transaction_ts"]))
    out = [columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in silver_schema()]
    return derive_fx(raw.select(*out))


def pack_rail_json(rail: str) -> Column:
    """Rail-native columns as the v2 JSON object; absent values leave no key."""
    c = F.col
    day = lambda name: F.date_format(name, "yyyy-MM-dd")
    parts: dict[str, list[Column]] = {
        "ach": [
            F.lit("ACH").alias("rail_type"), c("entry_class_code"), credit_debit("transaction_type").alias("transaction_type"),
            c("trace_number"), c("batch_number"), c("file_id"), c("company_entry_description"), c("same_day_flag"),
            c("addenda_record_indicator"),
            F.when(c("return_reason_code").isNotNull(), F.struct(
                c("return_reason_code"), day("return_date").alias("return_date"))).alias("return_details"),
            c("originator_routing_number").alias("originator_fi_routing"), c("receiver_routing_number").alias("receiver_fi_routing"),
        ],
        "wire": [
            F.lit("WIRE").alias("rail_type"),
            F.when(c("wire_type") == "DOMESTIC", "FEDWIRE_DOMESTIC").otherwise("SWIFT_INTERNATIONAL").alias("wire_subtype"),
            c("imad"), c("omad"), c("sender_routing_number").alias("originator_fi_routing"),
            c("beneficiary_routing_number").alias("beneficiary_fi_routing"),
            c("reference_for_beneficiary").alias("originator_to_beneficiary_information"),
            c("fedwire_business_function").alias("business_function_code"), c("purpose_code"),
            F.when(c("currency_code") != "USD", F.struct(
                F.coalesce("fx_rate", F.try_divide(c("usd_equivalent_amount").cast("double"), c("amount").cast("double")).cast("decimal(18,8)")).alias("exchange_rate"),
                c("currency_code").alias("original_currency_code"),
                c("amount").alias("original_amount"))).alias("foreign_exchange"),
        ],
        "card": [
            F.lit("CARD").alias("rail_type"), c("card_type"), c("card_brand"), c("card_last_four"),
            c("card_number_token").alias("card_token"),
            F.when(c("transaction_type") == "PURCHASE", "AUTH_CAPTURE").otherwise(c("transaction_type")).alias("transaction_subtype"),
            c("authorization_code"), c("merchant_category_code"), c("merchant_id"),
            F.when(c("entry_mode") == "KEYED", "MANUAL_KEY").otherwise(c("entry_mode")).alias("card_entry_mode"),
            c("is_card_present").alias("card_present"), c("network_response_code").alias("issuer_response_code"),
            c("interchange_fee"),
            F.when(c("dispute_status").isNotNull(), F.struct(
                c("dispute_reason_code").alias("chargeback_reason_code"), c("dispute_status"))).alias("chargeback_details"),
        ],
        "zelle": [
            F.lit("ZELLE").alias("rail_type"), c("zelle_network_ref").alias("zelle_reference_id"),
            F.when(c("transaction_type").isin("REQUEST", "REQUEST_MONEY"), "REQUEST_MONEY").when(c("transaction_type") == "REFUND", "REFUND")
            .when(c("transaction_type").like("CANCEL%"), "CANCELLATION").otherwise("SEND_MONEY").alias("transaction_subtype"), c("sender_token").alias("originator_proxy_token"),
            c("sender_fi_id").alias("originator_fi_routing"), c("receiver_token").alias("beneficiary_proxy_token"),
            c("receiver_fi_id").alias("beneficiary_fi_routing"), c("memo"),
            F.when(c("is_enrolled_recipient"), "ENROLLED").otherwise("NOT_ENROLLED").alias("enrollment_status"),
        ],
        "rtp_fednow": [
            c("payment_rail").alias("rail_type"),
            F.when(c("transaction_type") == "RFP_RESPONSE", "REQUEST_FOR_PAYMENT_RESPONSE")
            .otherwise(c("transaction_type")).alias("transaction_subtype"),
            F.when(c("payment_rail") == "RTP", c("instant_payment_id")).alias("rtp_transaction_id"),
            F.when(c("payment_rail") == "FEDNOW", c("instant_payment_id")).alias("fednow_transaction_id"),
            c("end_to_end_id"), c("sender_routing_number").alias("instructing_agent_routing"),
            c("receiver_routing_number").alias("instructed_agent_routing"), c("remittance_info").alias("remittance_information"),
            F.when(c("return_reason_code").isNotNull(), F.struct(c("return_reason_code"))).alias("return_details"),
            F.when(c("rfp_expiry_timestamp").isNotNull(), F.struct(
                c("network_reference_id").alias("rfp_id"), F.when(canon_status("status") == "SETTLED", "FULFILLED").when(c("status").isin("REJECTED", "CANCELLED", "EXPIRED"), c("status"))
                .otherwise("OPEN").alias("rfp_status"),
                F.date_format("rfp_expiry_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("rfp_expiry_date"),
            )).alias("request_for_payment"),
        ],
        "check_rdc": [
            F.when(c("deposit_type") == "MOBILE_RDC", "RDC").otherwise("CHECK").alias("rail_type"),
            F.when(c("deposit_type") == "MOBILE_RDC", "RDC_MOBILE").when(c("deposit_type") == "BRANCH", "TELLER_CAPTURE")
            .otherwise("PAPER_CHECK").alias("check_subtype"),
            c("check_number"), c("payer_routing_number").alias("micr_routing_number"), c("payer_account_number").alias("micr_account_token"),
            F.when(c("return_reason_code").isNotNull(), F.struct(c("return_reason_code"))).alias("return_details"),
        ],
        "billpay": [
            F.lit("BILLPAY").alias("rail_type"), c("confirmation_number").alias("bill_pay_reference"), c("biller_id"),
            c("delivery_method"), day("scheduled_date").alias("scheduled_delivery_date"),
            F.struct(c("is_recurring"), frequency("recurrence_frequency").alias("frequency")).alias("recurring_details"),
        ],
    }
    return F.to_json(F.struct(F.lit("v2").alias("rail_schema_version"), *parts[rail]))


def derive_subtype(rail: Column, kind: Column) -> Column:
    """``RAIL_KIND`` with the wording of instant payments shortened."""
    short = (F.when(kind == "CREDIT_TRANSFER", "CREDIT").when(kind == "REQUEST_FOR_PAYMENT", "RFP")
             .when(kind == "RFP_RESPONSE", "RFP_RESPONSE").otherwise(kind))
    return F.concat_ws("_", rail, short)


def derive_fx(df: DataFrame) -> DataFrame:
    """FX columns from amount and settlement; domestic rows keep all of them NULL."""
    crossed = F.col("settlement_currency_code").isNotNull() & (F.col("settlement_currency_code") != F.col("currency_code"))
    implied = F.try_divide(F.col("settlement_amount").cast("double"), F.col("amount").cast("double")).cast("decimal(18,8)")
    return df.withColumns({
        "settlement_amount": F.when(crossed, F.col("settlement_amount")),
        "settlement_currency_code": F.when(crossed, F.col("settlement_currency_code")),
        "original_currency_code": F.when(crossed, F.col("currency_code")),
        "original_amount": F.when(crossed, F.col("amount")),
        "fx_rate_source": F.when(crossed, F.when(F.col("fx_rate").isNotNull(), "RAIL").otherwise("DERIVED")),
        "fx_rate": F.when(crossed, F.coalesce("fx_rate", implied)),
    })


def normalize_ach(raw: DataFrame) -> DataFrame:
    c = F.col
    return _silver(
        declared(raw, "ach"), source_transaction_id=c("ach_transaction_id"), payment_type=F.lit("ACH"), payment_rail=F.lit("NACHA"),
        payment_subtype=derive_subtype(F.lit("ACH"), credit_debit("transaction_type")),
        direction=canon_direction("direction"), amount=abs_amount("amount"), transaction_ts=c("created_timestamp"),
        effective_date=c("effective_entry_date"), settlement_date=c("settlement_date"),
        return_reason_code=c("return_reason_code"), description=c("company_entry_description"),
        is_recurring=c("company_entry_description").eqNullSafe("AUTOPAY"),
        originator_account_token=c("originator_account_number"), originator_routing_number=c("originator_routing_number"),
        beneficiary_account_token=c("receiver_account_number"), beneficiary_routing_number=c("receiver_routing_number"),
        originator_name_token=name_token("originator_name"), beneficiary_name_token=name_token("receiver_name"),
        rail_details_json=pack_rail_json("ach"))


def normalize_wire(raw: DataFrame) -> DataFrame:
    c = F.col
    foreign = c("currency_code") != "USD"
    return _silver(
        declared(raw, "wire"), source_transaction_id=c("wire_transaction_id"), payment_type=F.lit("WIRE"),
        payment_rail=F.when(c("wire_type") == "DOMESTIC", "FEDWIRE").otherwise("SWIFT"),
        payment_subtype=derive_subtype(F.lit("WIRE"), c("wire_type")), direction=canon_direction("direction"),
        amount=abs_amount("amount"), currency_code=c("currency_code"),
        settlement_amount=F.when(foreign, c("usd_equivalent_amount")), settlement_currency_code=F.when(foreign, "USD"),
        fx_rate=c("fx_rate"), transaction_ts=c("initiated_timestamp"), submitted_ts=c("sent_timestamp"),
        settled_ts=c("completed_timestamp"), settlement_date=F.to_date("completed_timestamp"),
        description=c("reference_for_beneficiary"),
        originator_account_token=c("sender_account_number"), originator_routing_number=c("sender_routing_number"),
        beneficiary_account_token=c("beneficiary_account_number"), beneficiary_routing_number=c("beneficiary_routing_number"),
        originator_name_token=name_token("sender_name"), beneficiary_name_token=name_token("beneficiary_name"),
        iban_country_code=iban_country("beneficiary_account_number", F.when(c("wire_type") != "DOMESTIC", c("beneficiary_country"))),
        swift_bic=F.when(c("intermediary_fi_routing").rlike("^[A-Z]{6}[A-Z0-9]{2}([A-Z0-9]{3})?$"), c("intermediary_fi_routing")),
        rail_details_json=pack_rail_json("wire"))


def normalize_card(raw: DataFrame) -> DataFrame:
    c = F.col
    billed = c("billing_currency").isNotNull() & (c("billing_currency") != c("currency_code"))
    fees = reduce(lambda a, b: a + b, [F.coalesce(c(f), F.lit(0).cast("decimal(18,4)")) for f in (
        "interchange_fee", "network_fee", "surcharge_amount")])
    return _silver(
        declared(raw, "card"), source_transaction_id=c("card_transaction_id"), payment_type=F.lit("CARD"), payment_rail=c("card_brand"),
        payment_subtype=derive_subtype(F.lit("CARD"), c("card_type")),
        direction=F.when(c("transaction_type").isin("REFUND", "REVERSAL"), "INBOUND").otherwise("OUTBOUND"),
        amount=abs_amount("amount"), currency_code=c("currency_code"),
        settlement_amount=F.when(billed, c("billing_amount")), settlement_currency_code=F.when(billed, c("billing_currency")),
        fee_amount=fees, transaction_ts=F.coalesce("auth_timestamp", "settlement_timestamp", "posted_timestamp"),
        settled_ts=c("settlement_timestamp"), settlement_date=F.to_date("settlement_timestamp"),
        is_recurring=F.coalesce("is_recurring", F.lit(False)) | (c("entry_mode") == "RECURRING"),
        originator_account_token=c("card_number_token"), beneficiary_account_token=c("merchant_id"), originator_last4=c("card_last_four"),
        originator_name_token=name_token("cardholder_name"), beneficiary_name_token=name_token("merchant_name"),
        fee_breakdown_json=fee_json(INTERCHANGE="interchange_fee", NETWORK="network_fee", SURCHARGE="surcharge_amount"),
        rail_details_json=pack_rail_json("card"))


def normalize_zelle(raw: DataFrame) -> DataFrame:
    c = F.col
    return _silver(
        declared(raw, "zelle"), source_transaction_id=c("zelle_transaction_id"), payment_type=F.lit("ZELLE"), payment_rail=F.lit("EWS"),
        payment_subtype=derive_subtype(F.lit("ZELLE"), c("transaction_type")), direction=canon_direction("transaction_type"),
        amount=abs_amount("amount"), transaction_ts=c("initiated_timestamp"), settled_ts=c("completed_timestamp"),
        settlement_date=F.to_date("completed_timestamp"), description=c("memo"),
        originator_account_token=c("sender_account_token"), originator_routing_number=c("sender_fi_id"),
        beneficiary_account_token=c("receiver_account_token"), beneficiary_routing_number=c("receiver_fi_id"),
        originator_proxy_token=c("sender_token"), beneficiary_proxy_token=c("receiver_token"),
        originator_name_token=name_token("sender_name"), beneficiary_name_token=name_token("receiver_name"),
        rail_details_json=pack_rail_json("zelle"))


def normalize_instant(raw: DataFrame) -> DataFrame:
    c = F.col
    return _silver(
        declared(raw, "rtp_fednow"), source_transaction_id=c("instant_payment_id"), payment_type=c("payment_rail"),
        payment_rail=F.when(c("payment_rail") == "RTP", "TCH_RTP").otherwise(c("payment_rail")),
        payment_subtype=derive_subtype(c("payment_rail"), c("transaction_type")), direction=canon_direction("direction"),
        amount=abs_amount("amount"), transaction_ts=c("initiated_timestamp"), acknowledged_ts=c("acceptance_timestamp"),
        settled_ts=c("settled_timestamp"), settlement_date=F.to_date("settled_timestamp"),
        return_reason_code=c("return_reason_code"), description=c("remittance_info"),
        originator_account_token=c("sender_account_token"), originator_routing_number=c("sender_routing_number"),
        beneficiary_account_token=c("receiver_account_token"), beneficiary_routing_number=c("receiver_routing_number"),
        originator_name_token=name_token("sender_name"), beneficiary_name_token=name_token("receiver_name"), original_reference=c("rfp_original_ref"),
        rail_details_json=pack_rail_json("rtp_fednow"))


def normalize_check(raw: DataFrame) -> DataFrame:
    c = F.col
    rail = F.when(c("deposit_type") == "MOBILE_RDC", "RDC").otherwise("CHECK")
    return _silver(
        declared(raw, "check_rdc"), source_transaction_id=c("check_transaction_id"), payment_type=rail, payment_rail=F.lit("SVPCO"),
        payment_subtype=derive_subtype(rail, c("check_type")), direction=canon_direction("transaction_type"),
        amount=abs_amount("amount"), transaction_ts=c("deposit_timestamp"), settled_ts=c("cleared_timestamp"),
        settlement_date=F.to_date("cleared_timestamp"), return_reason_code=c("return_reason_code"),
        originator_account_token=c("payer_account_number"), originator_routing_number=c("payer_routing_number"),
        beneficiary_account_token=c("payee_account_token"), originator_name_token=name_token("payer_name"), beneficiary_name_token=name_token("payee_name"),
        rail_details_json=pack_rail_json("check_rdc"))


def normalize_billpay(raw: DataFrame) -> DataFrame:
    c = F.col
    return _silver(
        declared(raw, "billpay"), source_transaction_id=c("bill_pay_transaction_id"), payment_type=F.lit("BILLPAY"), payment_rail=F.lit("MIXED"),
        payment_subtype=derive_subtype(F.lit("BILLPAY"), c("payment_type")), direction=F.lit("OUTBOUND"),
        amount=abs_amount("amount"), fee_amount=c("fee_amount"), transaction_ts=c("created_timestamp"),
        settlement_date=c("delivery_date"), status_reason_code=c("failure_reason"), is_recurring=c("is_recurring"),
        originator_account_token=F.coalesce("payer_account_token", "payer_card_token"),
        beneficiary_account_token=c("biller_id"), originator_name_token=name_token("payer_name"), beneficiary_name_token=name_token("biller_name"),
        fee_breakdown_json=fee_json(SERVICE="fee_amount"), rail_details_json=pack_rail_json("billpay"))


NORMALIZERS = {
    "ach": normalize_ach, "wire": normalize_wire, "card": normalize_card, "zelle": normalize_zelle,
    "rtp_fednow": normalize_instant, "check_rdc": normalize_check, "billpay": normalize_billpay,
}


def union_rails(*rails: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rails)


# --- promotion of JSON fields -------------------------------------------------

def _json(path: str) -> Column:
    return F.get_json_object("rail_details_json", "$." + path)


def promoted_description() -> Column:
    """The one free-text field of each rail."""
    return F.coalesce(_json("company_entry_description"), _json("originator_to_beneficiary_information"),
                      _json("remittance_information"), _json("memo_line"), _json("memo"))


def promote_description(df: DataFrame) -> DataFrame:
    return df.withColumn("description", F.coalesce("description", promoted_description()))


def promoted_return_code() -> Column:
    return _json("return_details.return_reason_code")


def promote_return_code(df: DataFrame) -> DataFrame:
    return df.withColumn("return_reason_code", F.coalesce("return_reason_code", promoted_return_code()))


def promoted_recurring() -> Column:
    """Recurring bill payments, scheduled cards and autopay ACH; unknown on other rails."""
    rail = F.col("payment_type")
    return (F.when(rail == "BILLPAY", _json("recurring_details.is_recurring").cast("boolean"))
            .when(rail == "CARD", F.coalesce(_json("card_entry_mode") == "RECURRING", F.lit(False)))
            .when(rail == "ACH", F.coalesce(_json("company_entry_description") == "AUTOPAY", F.lit(False))))


def promote_recurring(df: DataFrame) -> DataFrame:
    return df.withColumn("is_recurring", F.coalesce("is_recurring", promoted_recurring()))


def wire_charges(df: DataFrame) -> DataFrame:
    return df.withColumn("charges", F.when(F.col("payment_type") == "WIRE", charges_code(_json("charges_borne_by"))))


# --- typed access to rail JSON ------------------------------------------------

# fixed values: items of the lists in the second contract, and numbers that are not plain decimals
LIST_ITEMS = {
    "addenda_records": "struct<sequence_number:int, addenda_type_code:string, payment_related_information:string>",
    "regulatory_reporting": "struct<authority:string, reporting_code:string, information:string>",
    "exception_codes": "string",
}
SCALES = {"exchange_rate": "decimal(18,8)", "interchange_fee": "decimal(18,4)"}
PLAIN = {"string": "string", "boolean": "boolean", "integer": "int"}


def _type(name: str, field: Field) -> str:
    if field.kind == "object":
        return "struct<" + ", ".join(f"{n}:{_type(n, f)}" for n, f in field.parts.items()) + ">"
    if field.kind == "array":
        return f"array<{LIST_ITEMS[name]}>"
    return PLAIN.get(field.kind) or SCALES.get(name, "decimal(18,2)")


# every field of the second contract, by rail
RAIL_STRUCTS = {rail: ", ".join(f"{n} {_type(n, f)}" for n, f in fields.items()) for rail, (_, fields) in V2.items()}


def unpack_rail_json(df: DataFrame, rail: str) -> DataFrame:
    """Rows of one rail with their JSON as a typed struct, parsed once; unused fields are pruned."""
    return df.filter(F.col("payment_type") == rail).withColumn("rail", F.from_json("rail_details_json", RAIL_STRUCTS[rail]))


def upgrade_rail_json(df: DataFrame) -> DataFrame:
    """First contract (payload nested under ``fields``) to the flat second one.

    Every field is carried: renamed where the second contract has a place for it, else kept as
    it was under ``v1_fields``.
    """
    def old(name: str, kind: str = "string") -> Column:
        return F.get_json_object("rail_details_json", "$.fields." + name).cast(kind)

    def same(*names: str) -> list[Column]:
        return [old(n).alias(n) for n in names]

    def rest(*names: str) -> Column:
        present = reduce(lambda a, b: a | b, [old(n).isNotNull() for n in names])
        return F.when(present, F.struct(*same(*names))).alias("v1_fields")

    def head(rail: str) -> list[Column]:
        return [F.lit("v2").alias("rail_schema_version"), F.lit(rail).alias("rail_type")]

    note = old("addenda_information")
    ach = F.to_json(F.struct(
        *head("ACH"), *same("entry_class_code", "trace_number", "batch_number", "file_id", "company_entry_description"),
        credit_debit(old("transaction_type")).alias("transaction_type"), old("same_day_flag", "boolean").alias("same_day_flag"),
        old("addenda_record_indicator", "boolean").alias("addenda_record_indicator"),
        F.when(note.isNotNull(), F.array(F.struct(F.lit(1).alias("sequence_number"), note.alias("payment_related_information")))).alias("addenda_records"),
        F.when(old("return_reason_code").isNotNull() | old("return_date").isNotNull(), F.struct(*same("return_reason_code", "return_date"))).alias("return_details"),
        F.when(old("noc_code").isNotNull(), F.struct(old("noc_code").alias("noc_code"))).alias("noc_details"), rest("transaction_code")))
    kind, mode = old("transaction_type"), old("card_entry_mode")
    card = F.to_json(F.struct(
        *head("CARD"), *same("card_type", "card_brand", "merchant_category_code", "merchant_id", "merchant_name", "authorization_code", "terminal_id"),
        F.when(kind == "SETTLEMENT", "CAPTURE").otherwise(kind).alias("transaction_subtype"),
        F.when(mode == "MANUAL", "MANUAL_KEY").when(mode == "ECOM", "ECOMMERCE").otherwise(mode).alias("card_entry_mode"),
        old("card_present", "boolean").alias("card_present"), old("network_reference_id").alias("network_transaction_id"), rest("cvv_present")))
    paid = old("charges")
    wire = F.to_json(F.struct(
        *head("WIRE"), F.when(old("wire_type") == "DOMESTIC", "FEDWIRE_DOMESTIC").otherwise("SWIFT_INTERNATIONAL").alias("wire_subtype"),
        F.lit(None).cast("string").alias("imad"), old("wire_reference_number").alias("fed_reference_number"),
        F.when(paid == "OUR", "SENDER").when(paid == "BEN", "RECEIVER").when(paid == "SHA", "SHARED").alias("charges_borne_by"),
        old("beneficiary_bank_name").alias("beneficiary_fi_name"), old("beneficiary_bank_routing_number").alias("beneficiary_fi_routing"),
        old("swift_bic").alias("beneficiary_fi_swift_bic"), old("intermediary_bank_name").alias("intermediary_fi_name"),
        old("intermediary_bank_routing_number").alias("intermediary_fi_routing"), old("payment_instruction").alias("originator_to_beneficiary_information"),
        rest("sender_reference", "beneficiary_reference", "beneficiary_country")), {"ignoreNullFields": "false"})
    upgraded = F.when(F.col("payment_type") == "ACH", ach).when(F.col("payment_type") == "CARD", card).when(
        F.col("payment_type") == "WIRE", wire)
    old_row = F.col("rail_schema_version") == "v1"
    return df.withColumns({
        "rail_details_json": F.when(old_row & upgraded.isNotNull(), upgraded).otherwise(F.col("rail_details_json")),
        "rail_schema_version": F.when(old_row & upgraded.isNotNull(), "v2").otherwise(F.col("rail_schema_version")),
    })


def addenda(df: DataFrame) -> DataFrame:
    return unpack_rail_json(df, "ACH").select("transaction_id", F.explode_outer("rail.addenda_records").alias("a")).select(
        "transaction_id", "a.*")


def regulatory_codes(df: DataFrame) -> DataFrame:
    return unpack_rail_json(df, "WIRE").select("transaction_id", F.explode_outer("rail.regulatory_reporting").alias("r")).select(
        "transaction_id", "r.authority", "r.reporting_code", "r.information")


def fee_breakdown(df: DataFrame) -> DataFrame:
    """Total fees by rail and fee type."""
    fees = F.from_json("fee_breakdown_json", "array<struct<type:string, amount:decimal(18,4)>>")
    return (df.select("payment_type", F.explode(fees).alias("fee"))
            .groupBy("payment_type", F.col("fee.type").alias("fee_type"))
            .agg(F.count("*").alias("fee_count"), F.sum("fee.amount").alias("fee_total")))


def compliance_summary(df: DataFrame) -> DataFrame:
    """Screening outcomes and raised flags by rail; a row without flags counts under none."""
    state = F.from_json("compliance_json", "aml_status string, sanction_status string, fraud_score int, flags array<string>")
    rows = df.select("payment_type", state.alias("c")).select("payment_type", "c.*", F.explode_outer("c.flags").alias("flag"))
    return rows.groupBy("payment_type", "aml_status", "sanction_status", F.coalesce("flag", F.lit("NONE")).alias("flag")).agg(
        F.count("*").alias("row_count"), F.max("fraud_score").alias("max_fraud_score"))


# --- metadata-driven mapping and protection -----------------------------------

def pseudonym(value: Column, salt: str) -> Column:
    """Stable token of a value; null stays null."""
    return F.concat(F.lit("tok_"), F.sha2(F.concat(F.lit(salt), value.cast("string")), 256))


def apply_mapping(df: DataFrame, mapping: DataFrame, salt: str | None = None) -> DataFrame:
    """Project by mapping rows ``(source_field, target_field, transformation_type, target_data_type, expression)``.

    A mapping has one row per target column, so it is read on the driver to build the plan.
    ``TOKENIZE`` needs the ``salt`` that ``protect`` uses.
    """
    columns = []
    for row in mapping.orderBy("target_field").collect():
        kind, source, rule = row.transformation_type, row.source_field, row.expression
        if kind == "IGNORE":
            continue
        if kind in ("DIRECT_MAP", "CAST"):
            value = F.col(source)
        elif kind == "CONSTANT":
            value = F.lit(rule)
        elif kind == "TOKENIZE":
            if salt is None:
                raise ValueError("TOKENIZE needs a salt")
            value = pseudonym(F.col(source), salt)
        elif kind == "LOOKUP":  # rule: code=name;code=name
            pairs = [p.split("=") for p in rule.split(";")]
            value = F.coalesce(*[F.when(F.col(source) == code, name) for code, name in pairs], F.col(source))
        elif kind in ("CONDITIONAL", "EXPRESSION", "DERIVE", "CONCAT"):
            value = F.expr(rule)
        else:
            raise ValueError(f"unknown transformation {kind}")
        columns.append(value.cast(row.target_data_type).alias(row.target_field))
    return df.select(*columns)


def protect(df: DataFrame, rules: dict[str, str], salt: str) -> DataFrame:
    """Replace sensitive columns: ``HASH``, ``TOKENIZE`` (stable pseudonym) or ``MASK`` (last four stay)."""
    def cover(name: str, rule: str) -> Column:
        digest = F.sha2(F.concat(F.lit(salt), F.col(name).cast("string")), 256)
        if rule == "HASH":
            return digest
        if rule == "TOKENIZE":
            return pseudonym(F.col(name), salt)
        if rule == "MASK":
            return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(name) - 4, F.lit(0))), F.right(F.col(name), F.lit(4)))
        raise ValueError(f"unknown rule {rule}")

    return df.withColumns({name: cover(name, rule) for name, rule in rules.items()})


def canon_flags(df: DataFrame) -> DataFrame:
    """Source feed flags and codes in canonical form."""
    return df.withColumns({
        "same_day_flag": yes_no("same_day_flg"), "transaction_type": credit_debit("txn_type"),
        "effective_date": parse_yymmdd("eff_dt"), "amount": abs_amount("txn_amt"),
        "status": canon_status("txn_status"), "direction": canon_direction("flow"),
    })
