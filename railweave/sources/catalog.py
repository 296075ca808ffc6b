"""Metadata: field mappings by rail and the registry of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: rail, source field, target table, target field, transformation, sensitivity, match role, role priority, on-us indicator
MAPPINGS = [
    ("ACH", "txn_id", "unified_transactions", "source_transaction_id", "DIRECT_MAP", "STANDARD", None, None, False),
    ("ACH", "tenant_fi_id", "unified_transactions", "tenant_id", "DIRECT_MAP", "STANDARD", None, None, False),
    ("ACH", "txn_amt", "unified_transactions", "amount", "DIRECT_MAP", "STANDARD", None, None, False),
    ("ACH", "eff_dt", "unified_transactions", "effective_date", "DERIVE", "STANDARD", None, None, False),
    ("ACH", "settle_dt", "unified_transactions", "settlement_date", "DERIVE", "STANDARD", None, None, False),
    ("ACH", "txn_status", "unified_transactions", "status", "LOOKUP", "STANDARD", None, None, False),
    ("ACH", "trace_num", "unified_transactions", "rail_details_json", "DERIVE", "STANDARD", None, None, False),
    ("ACH", "sec_code", "unified_transactions", "rail_details_json", "DERIVE", "STANDARD", None, None, False),
    ("ACH", "txn_type", "unified_transactions", "rail_details_json", "DERIVE", "STANDARD", None, None, False),
    ("ACH", "same_day_flg", "unified_transactions", "rail_details_json", "DERIVE", "STANDARD", None, None, False),
    ("ACH", "orig_acct_num", "unified_transactions", "originator_account_token", "TOKENIZE", "PCI", "ORIGINATOR_ACCOUNT_TOKEN", 1, False),
    ("ACH", "odfi_routing", "unified_transactions", "originator_routing_number", "DIRECT_MAP", "STANDARD", "ORIGINATOR_ROUTING", 2, True),
    ("ACH", "orig_name", "party", "name_token", "TOKENIZE", "PII", "ORIGINATOR_NAME_TOKEN", 3, False),
    ("ACH", "recv_acct_num", "unified_transactions", "beneficiary_account_token", "TOKENIZE", "PCI", "BENEFICIARY_ACCOUNT_TOKEN", 1, False),
    ("ACH", "rdfi_routing", "unified_transactions", "beneficiary_routing_number", "DIRECT_MAP", "STANDARD", "BENEFICIARY_ROUTING", 2, True),
    ("ACH", "recv_name", "party", "name_token", "TOKENIZE", "PII", "BENEFICIARY_NAME_TOKEN", 3, False),
    ("ACH", "[DERIVED]", "unified_transactions", "is_on_us", "DERIVE", "STANDARD", None, None, True),
    ("ACH", "cdc_seq", "unified_transactions", "_cdc_sequence_id", "DIRECT_MAP", "STANDARD", None, None, False),
    ("ACH", "cdc_op", "unified_transactions", "_cdc_operation", "DIRECT_MAP", "STANDARD", None, None, False),
    ("WIRE", "wire_txn_id", "unified_transactions", "source_transaction_id", "DIRECT_MAP", "STANDARD", None, None, False),
    ("WIRE", "imad", "unified_transactions", "rail_details_json", "DERIVE", "STANDARD", None, None, False),
    ("WIRE", "orig_acct", "unified_transactions", "originator_account_token", "TOKENIZE", "PCI", "ORIGINATOR_ACCOUNT_TOKEN", 1, False),
    ("WIRE", "orig_aba", "unified_transactions", "originator_routing_number", "DIRECT_MAP", "STANDARD", "ORIGINATOR_ROUTING", 2, True),
    ("WIRE", "bene_acct", "unified_transactions", "beneficiary_account_token", "TOKENIZE", "PCI", "BENEFICIARY_ACCOUNT_TOKEN", 1, False),
    ("WIRE", "bene_aba", "unified_transactions", "beneficiary_routing_number", "DIRECT_MAP", "STANDARD", "BENEFICIARY_ROUTING", 2, True),
    ("WIRE", "[DERIVED]", "unified_transactions", "is_on_us", "DERIVE", "STANDARD", None, None, True),
    ("ZELLE", "zelle_ref_id", "unified_transactions", "rail_details_json", "DERIVE", "STANDARD", None, None, False),
    ("ZELLE", "sender_email", "unified_transactions", "originator_account_token", "TOKENIZE", "PII", "ORIGINATOR_PROXY", 1, False),
    ("ZELLE", "sender_fi_routing", "unified_transactions", "originator_routing_number", "DIRECT_MAP", "STANDARD", "ORIGINATOR_ROUTING", 2, True),
    ("ZELLE", "receiver_proxy", "unified_transactions", "beneficiary_account_token", "TOKENIZE", "PII", "BENEFICIARY_PROXY", 1, False),
    ("ZELLE", "receiver_fi_routing", "unified_transactions", "beneficiary_routing_number", "DIRECT_MAP", "STANDARD", "BENEFICIARY_ROUTING", 2, True),
    ("ZELLE", "[DERIVED]", "unified_transactions", "is_on_us", "DERIVE", "STANDARD", None, None, True),
    ("RTP", "tch_txn_id", "unified_transactions", "source_transaction_id", "DIRECT_MAP", "STANDARD", None, None, False),
    ("RTP", "creditor_acct_token", "unified_transactions", "beneficiary_account_token", "DIRECT_MAP", "PCI", "BENEFICIARY_ACCOUNT_TOKEN", 1, False),
    ("RTP", "instructing_agent_aba", "unified_transactions", "originator_routing_number", "DIRECT_MAP", "STANDARD", "ORIGINATOR_ROUTING", 2, True),
    ("RTP", "instructed_agent_aba", "unified_transactions", "beneficiary_routing_number", "DIRECT_MAP", "STANDARD", "BENEFICIARY_ROUTING", 2, True),
    ("FEDNOW", "fn_txn_id", "unified_transactions", "source_transaction_id", "DIRECT_MAP", "STANDARD", None, None, False),
    ("FEDNOW", "instructing_agent_routing", "unified_transactions", "originator_routing_number", "DIRECT_MAP", "STANDARD", "ORIGINATOR_ROUTING", 2, True),
]

# fixed values: table and layer
REGISTRY = [
    ("raw_ach", "RAW"), ("raw_wire", "RAW"), ("raw_card", "RAW"), ("raw_zelle", "RAW"), ("raw_rtp_fednow", "RAW"),
    ("raw_check_rdc", "RAW"), ("raw_billpay", "RAW"), ("unified_transactions", "SILVER"), ("party", "IDENTITY"),
    ("party_name", "IDENTITY"), ("party_account", "IDENTITY"), ("party_account_rail_ref", "IDENTITY"), ("party_proxy", "IDENTITY"),
    ("party_relationship", "IDENTITY"), ("party_resolution_event", "IDENTITY"), ("biller_registry", "IDENTITY"),
    ("by_payment_type", "GOLD"), ("ir_quality_daily", "GOLD"), ("cross_rail_flow_daily", "GOLD"), ("by_channel", "GOLD"),
    ("biller_volume_daily", "GOLD"), ("fx_summary_daily", "GOLD"), ("party_activity_daily", "GOLD"), ("payment_types", "REFERENCE"),
    ("status_codes", "REFERENCE"), ("ach_return_codes", "REFERENCE"), ("transaction_directions", "REFERENCE"),
    ("on_us_institutions", "REFERENCE"), ("source_to_target", "METADATA"), ("data_catalog", "METADATA"), ("bq_dataset_layout", "METADATA"),
]


def mapping_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        MAPPINGS, "payment_type string, source_field string, target_table string, target_field string, transformation_type string, "
                  "sensitivity_class string, ir_role string, ir_priority int, is_on_us_indicator boolean")


def registry_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGISTRY, "table_name string, layer string")
