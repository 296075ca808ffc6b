"""Contracts of the rail JSON and a one-pass validator for all rails.

Contracts are fixed values: field names, types, vocabularies, patterns and lengths.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    kind: str
    null: bool = True
    one_of: tuple[str, ...] = ()
    pattern: str | None = None
    longest: int | None = None
    low: float | None = None
    high: float | None = None
    parts: dict = field(default_factory=dict)
    needs: tuple[str, ...] = ()


def text(longest: int | None = None, null: bool = True) -> Field:
    return Field("string", null, longest=longest)


def one_of(*words: str, null: bool = True) -> Field:
    return Field("string", null, one_of=words)


def like(pattern: str, null: bool = True) -> Field:
    return Field("string", null, pattern=pattern)


def number(low: float | None = None, high: float | None = None, null: bool = True) -> Field:
    return Field("number", null, low=low, high=high)


def integer(low: float | None = None, high: float | None = None) -> Field:
    return Field("integer", True, low=low, high=high)


def flag(null: bool = False) -> Field:
    return Field("boolean", null)


def array(null: bool = False) -> Field:
    return Field("array", null)


def group(needs: str = "", **parts: Field) -> Field:
    return Field("object", True, parts=parts, needs=tuple(needs.split()))


# formats of dates and moments, as patterns
DAY = "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"
MOMENT = "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
ABA = like("^[0-9]{9}$")
COUNTRY = like("^[A-Z]{2}$")
BIC = like("^[A-Z]{4}[A-Z]{2}[A-Z0-9]{2}([A-Z0-9]{3})?$")
UETR = like("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")


def _contract(rail: str, version: str, needs: str, **fields: Field) -> tuple[tuple[str, ...], dict[str, Field]]:
    rails = rail.split()
    head = {"rail_schema_version": one_of(version, null=False), "rail_type": one_of(*rails, null=False)}
    return ("rail_schema_version", "rail_type", *needs.split()), {**head, **fields}


# fixed values: second contract, flat, one per rail
V2 = {
    "ACH": _contract(
        "ACH", "v2", "entry_class_code transaction_type trace_number",
        entry_class_code=one_of("PPD", "CCD", "WEB", "TEL", "CTX", "IAT", "ARC", "BOC", "POP", "POS", "RCK", "XCK", "COR", null=False),
        transaction_type=one_of("CREDIT", "DEBIT", null=False), trace_number=like("^[0-9]{15}$", null=False),
        batch_number=text(7), file_id=text(128), company_id=text(10), company_name=text(16), company_entry_description=text(20),
        company_discretionary_data=text(20), individual_id=text(22), same_day_flag=flag(), addenda_record_indicator=flag(),
        addenda_records=array(),
        return_details=group("return_reason_code return_date", return_reason_code=like("^R[0-9]{2}$", null=False), return_date=like(DAY, null=False),
                             original_trace_number=like("^[0-9]{15}$"), return_settlement_date=like(DAY), dishonored_return_code=like("^R[0-9]{2}$")),
        noc_details=group(noc_code=like("^C[0-9]{2}$", null=False), corrected_data=text(null=False)),
        iat_details=group(foreign_exchange_indicator=one_of("FV", "VF", "FF", null=False), foreign_exchange_reference_indicator=integer(),
                          foreign_exchange_reference=text(15), foreign_routing_number=text(), foreign_correspondent_bank_name=text()),
        originator_fi_routing=ABA, receiver_fi_routing=ABA, settlement_routing=ABA, is_on_us=flag(),
        on_us_settlement_type=one_of("BOOK_TRANSFER", "INTERNAL_ACH")),
    "WIRE": _contract(
        "WIRE", "v2", "wire_subtype imad",
        wire_subtype=one_of("FEDWIRE_DOMESTIC", "SWIFT_INTERNATIONAL", "CHIPS", null=False), imad=text(22), omad=text(22),
        fed_reference_number=text(30), swift_uetr=UETR, chips_sequence_number=text(), originator_fi_routing=ABA, originator_fi_name=text(128),
        originator_fi_swift_bic=BIC, beneficiary_fi_routing=ABA, beneficiary_fi_name=text(128), beneficiary_fi_swift_bic=BIC,
        intermediary_fi_routing=ABA, intermediary_fi_name=text(128), sender_to_receiver_information=text(210),
        originator_to_beneficiary_information=text(140), business_function_code=one_of("CTR", "DEP", "DRW", "FFR", "SVC", "SUR"),
        charges_borne_by=one_of("SENDER", "RECEIVER", "SHARED"),
        foreign_exchange=group("exchange_rate original_currency_code original_amount", exchange_rate=number(low=0, null=False),
                               original_currency_code=like("^[A-Z]{3}$", null=False), original_amount=number(low=0, null=False), fx_reference=text()),
        purpose_code=text(4), regulatory_reporting=array(null=True), is_on_us=flag(), on_us_settlement_type=one_of("BOOK_TRANSFER", "INTERNAL_WIRE")),
    "CARD": _contract(
        "CARD", "v2", "card_type card_brand transaction_subtype",
        card_type=one_of("DEBIT", "CREDIT", "PREPAID", "FSA", "HSA", null=False),
        card_brand=one_of("VISA", "MASTERCARD", "AMEX", "DISCOVER", "UNIONPAY", "OTHER", null=False), card_last_four=like("^[0-9]{4}$"),
        card_token=text(), card_expiry_indicator=text(),
        transaction_subtype=one_of("AUTHORIZATION", "CAPTURE", "AUTH_CAPTURE", "REFUND", "VOID", "REVERSAL", "CHARGEBACK", "CHARGEBACK_REVERSAL",
                                   "BALANCE_INQUIRY", "CASH_ADVANCE", null=False),
        authorization_code=text(6), authorization_date=like(MOMENT), capture_date=like(DAY), retrieval_reference_number=text(12),
        system_trace_audit_number=text(6), network_transaction_id=text(), merchant_category_code=like("^[0-9]{4}$"), merchant_id=text(15),
        merchant_name=text(128), merchant_city=text(64), merchant_state=text(3), merchant_country_code=COUNTRY, terminal_id=text(8),
        card_entry_mode=one_of("SWIPE", "CHIP", "CONTACTLESS", "MANUAL_KEY", "ECOMMERCE", "RECURRING", "CREDENTIAL_ON_FILE", "ATM"),
        card_present=flag(), cvv_result=one_of("MATCH", "NO_MATCH", "NOT_PROVIDED", "ISSUER_NOT_CERTIFIED"), avs_result=text(2),
        issuer_response_code=text(2), issuer_response_description=text(128), acquirer_reference=text(64), interchange_fee=number(),
        original_transaction_reference=text(),
        chargeback_details=group(chargeback_reason_code=text(null=False), chargeback_reason_description=text(), chargeback_date=like(DAY, null=False),
                                 chargeback_amount=number(null=False), dispute_status=one_of("OPEN", "WON", "LOST", "WITHDRAWN", null=False)),
        is_on_us=flag(), issuer_routing=text(), acquirer_institution_id=text()),
    "ZELLE": _contract(
        "ZELLE", "v2", "zelle_reference_id transaction_subtype",
        zelle_reference_id=text(64, null=False), network_transaction_id=text(64),
        transaction_subtype=one_of("SEND_MONEY", "REQUEST_MONEY", "REQUEST_FULFILLMENT", "CANCELLATION", "REFUND", null=False),
        originator_proxy_type=one_of("EMAIL", "PHONE", "ZELLE_ALIAS"), originator_proxy_token=text(), originator_fi_routing=ABA,
        originator_fi_name=text(128), beneficiary_proxy_type=one_of("EMAIL", "PHONE", "ZELLE_ALIAS"), beneficiary_proxy_token=text(),
        beneficiary_fi_routing=ABA, beneficiary_fi_name=text(128), memo=text(255), request_for_payment_id=text(),
        request_for_payment_status=one_of("OPEN", "FULFILLED", "CANCELLED", "EXPIRED"),
        enrollment_status=one_of("ENROLLED", "NOT_ENROLLED", "PENDING"), payment_expiry_date=like(MOMENT), is_on_us=flag(),
        on_us_settlement_type=one_of("BOOK_TRANSFER", "INTERNAL_ZELLE")),
    "RTP": _contract(
        "RTP", "v2", "transaction_subtype rtp_transaction_id",
        transaction_subtype=one_of("CREDIT_TRANSFER", "REQUEST_FOR_PAYMENT", "REQUEST_FOR_PAYMENT_RESPONSE", "PAYMENT_ACKNOWLEDGEMENT",
                                   "PAYMENT_RETURN", "INQUIRY", null=False),
        rtp_transaction_id=text(36, null=False), end_to_end_id=text(35), instruction_id=text(35), uetr=UETR, instructing_agent_routing=ABA,
        instructing_agent_name=text(128), instructed_agent_routing=ABA, instructed_agent_name=text(128), remittance_information=text(140),
        structured_remittance=group(creditor_reference_type=text(null=False), creditor_reference=text(null=False), referred_doc_type=text(),
                                    referred_doc_number=text(), referred_doc_amount=number()),
        purpose_code=text(4), category_purpose=text(4), settlement_date=like(DAY), settlement_time=like(MOMENT),
        rtp_network_status=one_of("RECEIVED", "ACCEPTED", "ACCEPTED_WITH_CHANGE", "PENDING", "REJECTED", "RETURNED"),
        return_details=group(return_reason_code=text(null=False), return_reason_description=text(), original_rtp_transaction_id=text(),
                             return_ts=like(MOMENT, null=False)),
        request_for_payment=group(rfp_id=text(null=False), rfp_status=one_of("OPEN", "FULFILLED", "REJECTED", "CANCELLED", "EXPIRED", null=False),
                                  rfp_expiry_date=like(MOMENT, null=False), payer_response_code=text()),
        is_on_us=flag()),
    "FEDNOW": _contract(
        "FEDNOW", "v2", "transaction_subtype fednow_transaction_id",
        transaction_subtype=one_of("CREDIT_TRANSFER", "REQUEST_FOR_PAYMENT", "REQUEST_FOR_PAYMENT_RESPONSE", "PAYMENT_STATUS_REPORT", "RETURN",
                                   "LIQUIDITY_MANAGEMENT_TRANSFER", null=False),
        fednow_transaction_id=text(36, null=False), end_to_end_id=text(35), instruction_id=text(35), uetr=UETR, instructing_agent_routing=ABA,
        instructing_agent_name=text(128), instructed_agent_routing=ABA, instructed_agent_name=text(128), requested_execution_date=like(DAY),
        interbank_settlement_date=like(DAY), interbank_settlement_amount=number(), remittance_information=text(140), purpose_code=text(4),
        fednow_status=one_of("RCVD", "ACCP", "ACWC", "RJCT", "PDNG", "ACSC"), ultimate_debtor_account_token=text(),
        ultimate_creditor_account_token=text(),
        return_details=group(return_reason_code=text(null=False), return_reason_description=text(), original_fednow_transaction_id=text(),
                             return_ts=like(MOMENT, null=False)),
        request_for_payment=group(rfp_id=text(null=False), rfp_status=one_of("OPEN", "FULFILLED", "REJECTED", "CANCELLED", "EXPIRED", null=False),
                                  rfp_expiry_date=like(MOMENT)),
        is_on_us=flag()),
    "CHECK": _contract(
        "CHECK RDC", "v2", "check_subtype",
        check_subtype=one_of("PAPER_CHECK", "RDC_MOBILE", "RDC_SCANNER", "TELLER_CAPTURE", null=False), check_number=text(10),
        micr_routing_number=ABA, micr_account_token=text(), micr_amount=number(),
        micr_verification_status=one_of("VERIFIED", "FAILED", "NOT_PRESENT", "PARTIAL"), micr_raw_data_token=text(), check_date=like(DAY),
        payee_name_token=text(), memo_line=text(128),
        rdc_details=group(batch_id=text(64), sequence_number=text(), deposit_account_token=text(), check_front_image_id=text(),
                          check_back_image_id=text(), image_quality_score=integer(0, 100), iqv_result=one_of("PASS", "WARN", "FAIL"),
                          exception_codes=array(), substitute_check_id=text()),
        clearing_details=group(clearing_house=one_of("FRB", "SVPCO", "DIRECT"), presentment_routing=ABA, presentment_date=like(DAY),
                               truncation_status=one_of("TRUNCATED", "NOT_TRUNCATED", "SUBSTITUTE_CHECK")),
        return_details=group(return_reason_code=text(null=False), return_date=like(DAY, null=False), re_presentment_count=integer()),
        originator_fi_routing=ABA, depositing_fi_routing=ABA, is_on_us=flag(), on_us_settlement_type=one_of("BOOK_TRANSFER", "INTERNAL_CHECK")),
    "BILLPAY": _contract(
        "BILLPAY", "v2", "bill_pay_reference biller_id delivery_method",
        bill_pay_reference=text(64, null=False), biller_id=text(64, null=False), biller_name=text(128),
        biller_category=one_of("UTILITY", "TELECOMMUNICATIONS", "INSURANCE", "MORTGAGE", "AUTO_LOAN", "CREDIT_CARD", "GOVERNMENT", "HEALTHCARE",
                               "SUBSCRIPTION", "OTHER"),
        biller_account_number_token=text(), biller_routing_number=ABA,
        delivery_method=one_of("ELECTRONIC_ACH", "ELECTRONIC_REAL_TIME", "PAPER_CHECK", "LASER_DRAFT", null=False),
        underlying_rail=one_of("ACH", "RTP", "FEDNOW", "CHECK"), underlying_transaction_id=text(),
        payment_method=one_of("CHECKING", "SAVINGS", "CARD"), funding_account_token=text(), scheduled_delivery_date=like(DAY),
        actual_delivery_date=like(DAY), payment_submit_date=like(DAY), bill_reference_number=text(64), memo=text(255),
        recurring_details=group(is_recurring=flag(), frequency=one_of("WEEKLY", "BIWEEKLY", "MONTHLY", "QUARTERLY", "ANNUALLY"),
                                recurring_start_date=like(DAY), recurring_end_date=like(DAY), occurrence_number=integer(), total_occurrences=integer()),
        aggregator_name=text(), aggregator_transaction_id=text(), is_on_us=flag()),
}
V2["RDC"] = V2["CHECK"]


def _nested(rail: str, needs: str, **parts: Field):
    return _contract(rail, "v1", "fields", fields=Field("object", False, parts=parts, needs=tuple(needs.split())))


# fixed values: first contract, payload nested under ``fields`` (a closed object)
V1 = {
    "ACH": _nested(
        "ACH", "trace_number entry_class_code transaction_type", trace_number=like("^[0-9]{15}$", null=False), batch_number=text(64, null=False),
        file_id=text(128, null=False), transaction_code=text(8, null=False), entry_class_code=one_of("PPD", "CCD", "WEB", "TEL", "CTX", "IAT", null=False),
        transaction_type=one_of("CR", "DR", "Credit", "Debit", null=False), same_day_flag=flag(), company_entry_description=text(20, null=False),
        addenda_record_indicator=flag(), addenda_information=text(2048), return_reason_code=like("^R[0-9]{2}$"), return_date=text(),
        noc_code=like("^C[0-9]{2}$")),
    "CARD": _nested(
        "CARD", "card_brand transaction_type merchant_category_code", card_type=one_of("DEBIT", "CREDIT", "PREPAID"),
        card_brand=one_of("VISA", "MASTERCARD", "AMEX", "DISCOVER", "OTHER", null=False),
        card_entry_mode=one_of("CHIP", "SWIPE", "CONTACTLESS", "MANUAL", "ECOM"), merchant_category_code=like("^[0-9]{4}$", null=False),
        merchant_id=text(64), merchant_name=text(255), authorization_code=text(16),
        transaction_type=one_of("AUTHORIZATION", "CAPTURE", "SETTLEMENT", "REFUND", "VOID", "CHARGEBACK", null=False), card_present=flag(null=True),
        cvv_present=flag(null=True), network_reference_id=text(64), terminal_id=text(32)),
    "WIRE": _nested(
        "WIRE", "wire_reference_number wire_type", wire_reference_number=text(64, null=False), wire_type=one_of("DOMESTIC", "INTERNATIONAL", null=False),
        sender_reference=text(64), beneficiary_reference=text(64), beneficiary_bank_name=text(255), beneficiary_bank_routing_number=ABA,
        beneficiary_country=COUNTRY, intermediary_bank_name=text(255), intermediary_bank_routing_number=ABA, payment_instruction=text(2048),
        charges=one_of("OUR", "SHA", "BEN"), swift_bic=like("^[A-Z0-9]{8}([A-Z0-9]{3})?$")),
}
CONTRACTS = {"v1": V1, "v2": V2}

# what schema_of_variant says, in contract words
_KINDS = {"STRING": "string", "BOOLEAN": "boolean", "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number",
          "FLOAT": "number", "OBJECT": "object", "ARRAY": "array", "VOID": "null"}


def _spec_rows(version: str):
    """Contract as rows, one per (rail, path); nested fields carry ``parent.child``."""
    for rail, (_, fields) in CONTRACTS[version].items():
        for name, spec in fields.items():
            yield rail, name, spec
            for child, part in spec.parts.items():
                yield rail, f"{name}.{child}", part


def contract_table(spark: SparkSession, version: str, words: dict[tuple[str, str], list[str]] | None = None) -> DataFrame:
    """``words``: vocabularies that belong to a deployment, by rail and path."""
    words = words or {}
    rows = [(rail, path, s.kind, s.null, list(words.get((rail, path), s.one_of)) or None, s.pattern, s.longest,
             None if s.low is None else float(s.low), None if s.high is None else float(s.high))
            for rail, path, s in _spec_rows(version)]
    return spark.createDataFrame(rows, "payment_type string, path string, kind string, nullable boolean, one_of array<string>, "
                                       "pattern string, longest int, low double, high double")


def _required(version: str, parent: str | None = None) -> Column:
    """Required names of each rail (below ``parent``) as a lookup by rail."""
    entries = []
    for rail, (needs, fields) in CONTRACTS[version].items():
        names = needs if parent is None else fields[parent].needs if parent in fields else ()
        if names:
            entries += [F.lit(rail), F.array(*[F.lit(n) for n in names])]
    return F.create_map(*entries)[F.col("payment_type")] if entries else F.lit(None).cast("array<string>")


def _kind(value: Column) -> Column:
    names = F.create_map(*[F.lit(part) for pair in _KINDS.items() for part in pair])
    return names[F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)]


def _pair(path: Column, problem: str | None = None, value: Column | None = None, text: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        path.alias("path"), (none.cast("string") if problem is None else F.lit(problem)).alias("problem"),
        (none.cast("string") if value is None else _kind(value)).alias("found"), (none.cast("string") if text is None else text).alias("text"))


def _taken_apart(kinds: Column, texts: Column, required: Column, prefix: Column | None = None) -> Column:
    """Pairs for the keys of one object and for its required keys that are absent."""
    def under(key: Column) -> Column:
        return key if prefix is None else F.concat_ws(".", prefix, key)

    absent = F.array_except(F.coalesce(required, F.array().cast("array<string>")), F.map_keys(kinds))
    return F.concat(F.transform(F.map_entries(kinds), lambda e: _pair(under(e["key"]), None, e["value"], texts[e["key"]])),
                    F.transform(absent, lambda k: _pair(under(k), "missing")))


def _entries(version: str, df: DataFrame) -> DataFrame:
    """One row per key present in a document, nested keys included, plus ``missing`` rows.

    The variant map tells types, the plain map tells texts: reading a text out of a
    variant value by value costs far more than parsing the document a second time.
    """
    texts = "map<string,string>"
    docs = df.filter(F.col("rail_schema_version") == version).select(
        "transaction_id", "payment_type", F.ltrim("rail_details_json").startswith("{").alias("braced"), "rail_details_json",
        F.try_parse_json("rail_details_json").alias("doc"))
    has_contract = F.col("payment_type").isin(*CONTRACTS[version])
    top = docs.select("transaction_id", "payment_type", F.when(F.col("braced"), F.col("doc").cast("map<string,variant>")).alias("kinds"),
                      F.from_json("rail_details_json", texts).alias("texts"))
    pairs = F.when(F.col("kinds").isNull(), F.array(_pair(F.lit("document"), "type"))).when(
        has_contract, _taken_apart(F.col("kinds"), F.col("texts"), _required(version)))
    rows = top.select("transaction_id", "payment_type", F.explode(pairs).alias("e")).select("transaction_id", "payment_type", "e.*")
    parents = sorted({name for _, fields in CONTRACTS[version].values() for name, spec in fields.items() if spec.parts})
    wanted = F.coalesce(*[F.when(F.col("path") == p, _required(version, p)) for p in parents])
    parent = (F.col("found") == "object") & F.col("path").isin(*parents)
    inner = rows.select("*", F.when(parent, F.from_json("text", texts)).alias("texts"),
                        F.when(parent, F.try_parse_json("text").cast("map<string,variant>")).alias("kinds"))
    itself = F.array(F.struct("path", "problem", "found", "text"))
    below = F.when(F.col("kinds").isNotNull(), F.concat(itself, _taken_apart(F.col("kinds"), F.col("texts"), wanted, F.col("path"))))
    return inner.select("transaction_id", "payment_type", F.explode(F.coalesce(below, itself)).alias("e")).select(
        "transaction_id", "payment_type", "e.*")


def validate_rail_json(df: DataFrame, version: str = "v2", aggregators: list[str] | None = None) -> DataFrame:
    """Contract violations, one row each: ``transaction_id, payment_type, path, problem``.

    ``aggregators`` lists the bill-pay aggregators of a deployment; without it any name passes.

    Documents are parsed once and taken apart into the keys they really have; the
    contract of all rails is one small table joined by rail and path, so the work grows
    with the keys present and one scan serves every rail.  Text that is not an object has
    the single problem ``document:type``.
    """
    c, found, text = F.col, F.col("found"), F.col("text")
    spec = contract_table(df.sparkSession, version, {("BILLPAY", "aggregator_name"): aggregators} if aggregators else None)
    closed = [name for _, fields in CONTRACTS[version].values() for name, s in fields.items() if s.parts and version == "v1"]
    rows = _entries(version, df).join(F.broadcast(spec), ["payment_type", "path"], "left")  # a fixed table of a few hundred rows
    typed = c("kind").isNotNull() & ((found == c("kind")) | ((c("kind") == "number") & (found == "integer")))
    amount = text.try_cast("double")
    patterns = sorted({s.pattern for _, _, s in _spec_rows(version) if s.pattern})
    off_pattern = F.coalesce(*[F.when(c("pattern") == p, ~text.rlike(p)) for p in patterns])
    parent = F.substring_index("path", ".", 1)
    open_below = F.col("path").contains(".") & ~parent.isin(*closed) if closed else F.col("path").contains(".")

    def bad(name: str, cond: Column) -> Column:
        return F.when(c("problem").isNull() & cond, F.lit(name))

    # a plain array keeps the tests in generated code; rows without a problem fall to the filter
    problems = F.array(
        c("problem"),
        bad("unknown", c("kind").isNull() & ~open_below),
        bad("type", c("kind").isNotNull() & ~typed & ~(c("nullable") & (found == "null"))),
        bad("enum", typed & c("one_of").isNotNull() & ~F.array_contains("one_of", text)),
        bad("pattern", typed & off_pattern),
        bad("length", typed & (F.length(text) > c("longest"))),
        bad("range", typed & ((c("low").isNotNull() & (amount < c("low"))) | (c("high").isNotNull() & (amount > c("high"))))),
    )
    return rows.select("transaction_id", "payment_type", "path", F.explode(problems).alias("problem")).filter(
        "problem is not null")
