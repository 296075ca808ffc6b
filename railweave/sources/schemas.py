"""Declared schemas: raw rails, the silver fact, and the key of a business transaction.

Column names and types are fixed values of the data model; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

CDC_COLUMNS = """
_cdc_sequence_id string, _cdc_operation string, _cdc_timestamp timestamp,
_cdc_source_system string, _cdc_load_timestamp timestamp
"""

# fixed values: rail -> columns, timestamp that dates the row, and that names the source row
RAW_COLUMNS = {
    "ach": """
        ach_transaction_id string, tenant_id string, trace_number string, batch_number string, file_id string,
        transaction_code string, entry_class_code string, transaction_type string, amount decimal(18,2),
        effective_entry_date date, settlement_date date, same_day_flag boolean, direction string,
        originator_name string, originator_id string, originator_routing_number string, originator_account_number string,
        receiver_name string, receiver_routing_number string, receiver_account_number string, receiver_account_type string,
        company_entry_description string, addenda_record_indicator boolean, addenda_information string,
        return_reason_code string, return_date date, noc_code string, status string, source_product string,
        channel string, created_timestamp timestamp, updated_timestamp timestamp""",
    "wire": """
        wire_transaction_id string, tenant_id string, imad string, omad string, wire_type string, direction string,
        amount decimal(18,2), currency_code string, fx_rate decimal(18,8), usd_equivalent_amount decimal(18,2),
        sender_name string, sender_routing_number string, sender_account_number string, sender_address string,
        beneficiary_name string, beneficiary_routing_number string, beneficiary_account_number string,
        beneficiary_address string, beneficiary_country string, intermediary_fi_name string, intermediary_fi_routing string,
        purpose_code string, reference_for_beneficiary string, fi_to_fi_info string, fedwire_business_function string,
        iso20022_message_type string, ofac_screening_status string, status string, source_product string, channel string,
        initiated_timestamp timestamp, sent_timestamp timestamp, completed_timestamp timestamp""",
    "card": """
        card_transaction_id string, tenant_id string, authorization_code string, retrieval_reference_number string,
        card_type string, card_brand string, card_number_token string, card_last_four string, card_expiry_month bigint,
        card_expiry_year bigint, cardholder_name string, transaction_type string, entry_mode string, amount decimal(18,2),
        currency_code string, billing_amount decimal(18,2), billing_currency string, cashback_amount decimal(18,2),
        surcharge_amount decimal(18,2), merchant_name string, merchant_id string, merchant_category_code string,
        terminal_id string, merchant_city string, merchant_state string, merchant_country string, pos_condition_code string,
        network_response_code string, avs_response_code string, cvv_response_code string, is_pin_present boolean,
        is_recurring boolean, is_card_present boolean, digital_wallet_type string, dispute_status string,
        dispute_reason_code string, interchange_fee decimal(18,4), network_fee decimal(18,4), status string,
        source_product string, channel string, auth_timestamp timestamp, settlement_timestamp timestamp,
        posted_timestamp timestamp""",
    "zelle": """
        zelle_transaction_id string, tenant_id string, zelle_network_ref string, transaction_type string,
        payment_type string, amount decimal(18,2), sender_token string, sender_name string, sender_fi_id string,
        sender_account_token string, receiver_token string, receiver_name string, receiver_fi_id string,
        receiver_account_token string, memo string, is_enrolled_recipient boolean, token_validation_status string,
        fraud_score decimal(18,2), status string, source_product string, channel string, initiated_timestamp timestamp,
        completed_timestamp timestamp""",
    "rtp_fednow": """
        instant_payment_id string, tenant_id string, network_reference_id string, payment_rail string, message_type string,
        transaction_type string, direction string, amount decimal(18,2), sender_name string, sender_routing_number string,
        sender_account_token string, receiver_name string, receiver_routing_number string, receiver_account_token string,
        end_to_end_id string, remittance_info string, rfp_expiry_timestamp timestamp, rfp_original_ref string,
        return_reason_code string, rejection_reason string, rail_finder_selected boolean, status string,
        source_product string, channel string, initiated_timestamp timestamp, acceptance_timestamp timestamp,
        settled_timestamp timestamp""",
    "check_rdc": """
        check_transaction_id string, tenant_id string, check_number string, check_type string, deposit_type string,
        transaction_type string, amount decimal(18,2), payer_routing_number string, payer_account_number string,
        payer_name string, payee_name string, payee_account_token string, image_reference_id string,
        icl_sequence_number string, hold_type string, hold_amount decimal(18,2), funds_availability_date date,
        risk_score decimal(18,2), positive_pay_status string, ach_conversion_flag boolean, return_reason_code string,
        status string, source_product string, channel string, deposit_timestamp timestamp, cleared_timestamp timestamp""",
    "billpay": """
        bill_pay_transaction_id string, tenant_id string, payment_type string, payment_method string, amount decimal(18,2),
        fee_amount decimal(18,4), payer_name string, payer_account_token string, payer_card_token string,
        biller_name string, biller_id string, biller_account_number string, is_recurring boolean,
        recurrence_frequency string, is_expedited boolean, delivery_method string, scheduled_date date, delivery_date date,
        confirmation_number string, status string, failure_reason string, source_product string, channel string,
        created_timestamp timestamp, processed_timestamp timestamp, delivered_timestamp timestamp""",
}
RAW_DATED_BY = {
    "ach": "created_timestamp",
    "wire": "initiated_timestamp",
    "card": "auth_timestamp",
    "zelle": "initiated_timestamp",
    "rtp_fednow": "initiated_timestamp",
    "check_rdc": "deposit_timestamp",
    "billpay": "created_timestamp",
}
RAW_CLUSTERED_BY = {
    "ach": ["tenant_id", "entry_class_code", "direction"],
    "wire": ["tenant_id", "wire_type", "direction"],
    "card": ["tenant_id", "card_brand", "card_type"],
    "zelle": ["tenant_id", "payment_type"],
    "rtp_fednow": ["tenant_id", "payment_rail", "transaction_type"],
    "check_rdc": ["tenant_id", "deposit_type", "check_type"],
    "billpay": ["tenant_id", "payment_type", "delivery_method"],
}

SILVER_COLUMNS = """
transaction_id string, tenant_id string, source_system string, source_transaction_id string, event_id string,
payment_type string, payment_rail string, payment_subtype string, direction string, channel string,
amount decimal(18,2), currency_code string, settlement_amount decimal(18,2), settlement_currency_code string,
original_currency_code string, original_amount decimal(18,2), fx_rate decimal(18,8), fx_rate_source string,
fee_amount decimal(18,4), fee_breakdown_json string, transaction_ts timestamp, effective_date date, settlement_date date, submitted_ts timestamp,
acknowledged_ts timestamp, settled_ts timestamp, status string, status_reason_code string, return_reason_code string,
description string, original_reference string, iban_country_code string, swift_bic string, is_on_us boolean, on_us_settlement_type string, is_recurring boolean,
originator_party_id string, originator_account_id string, originator_account_token string, originator_routing_number string,
originator_last4 string, originator_proxy_token string, originator_name_token string,
originator_block_key string, originator_match_rule string, originator_resolution_status string,
originator_resolution_confidence decimal(5,4),
beneficiary_party_id string, beneficiary_account_id string, beneficiary_account_token string, beneficiary_routing_number string,
beneficiary_last4 string, beneficiary_proxy_token string, beneficiary_name_token string,
beneficiary_block_key string, beneficiary_match_rule string, beneficiary_resolution_status string,
beneficiary_resolution_confidence decimal(5,4), identity_resolution_hook_ts timestamp,
rail_schema_version string, rail_details_json string, dq_flags_json string, compliance_json string,
schema_version string, event_ts timestamp, ingestion_ts timestamp,
""" + CDC_COLUMNS

BUSINESS_KEY = ["tenant_id", "source_system", "source_transaction_id"]
# newest change first; event_id makes the order total
CHANGE_ORDER = ["_cdc_timestamp", "_cdc_sequence_id", "ingestion_ts", "event_id"]

REQUIRED_SILVER = """
transaction_id tenant_id source_system source_transaction_id event_id payment_type payment_rail direction amount
currency_code transaction_ts status rail_schema_version rail_details_json schema_version event_ts ingestion_ts
_cdc_sequence_id _cdc_operation _cdc_timestamp _cdc_source_system _cdc_load_timestamp
""".split()


def raw_schema(rail: str) -> StructType:
    return StructType.fromDDL(RAW_COLUMNS[rail] + ", " + CDC_COLUMNS)


def silver_schema() -> StructType:
    return StructType.fromDDL(SILVER_COLUMNS)
