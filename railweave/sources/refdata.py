"""Seeded reference tables.

The rows are fixed values of the payments domain: code lists whose exact spelling
decides results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: code, name, rail, instant
PAYMENT_TYPES = [
    ("ACH", "ACH", "NACHA", False),
    ("WIRE", "Wire", "FEDWIRE", False),
    ("CARD", "Card", "CARD_NET", False),
    ("ZELLE", "Zelle", "EWS", True),
    ("RTP", "RTP", "TCH_RTP", True),
    ("FEDNOW", "FedNow", "FEDNOW", True),
    ("CHECK", "Check", "SVPCO", False),
    ("RDC", "Remote Deposit Capture", "SVPCO", False),
    ("BILLPAY", "Bill Payment", "MIXED", False),
]

# fixed values: code, name, category, terminal
STATUS_CODES = [
    ("INITIATED", "Initiated", "PENDING", False),
    ("PENDING", "Pending", "PENDING", False),
    ("AUTHORIZED", "Authorized", "ACTIVE", False),
    ("PROCESSING", "Processing", "ACTIVE", False),
    ("SETTLED", "Settled", "COMPLETED", True),
    ("COMPLETED", "Completed", "COMPLETED", True),
    ("RETURNED", "Returned", "REVERSED", True),
    ("REJECTED", "Rejected", "FAILED", True),
    ("FAILED", "Failed", "FAILED", True),
    ("CANCELLED", "Cancelled", "FAILED", True),
    ("REVERSED", "Reversed", "REVERSED", True),
    ("DISPUTED", "Disputed", "ACTIVE", False),
    ("HELD", "Held", "PENDING", False),
    ("EXPIRED", "Expired", "FAILED", True),
    ("ON_HOLD", "On Hold", "PENDING", False),
]

# fixed values: return code, description, category
RETURN_CODES = [
    ("R01", "Insufficient Funds", "RETURN"),
    ("R02", "Account Closed", "RETURN"),
    ("R03", "No Account/Unable to Locate Account", "RETURN"),
    ("R04", "Invalid Account Number", "RETURN"),
    ("R05", "Unauthorized Debit to Consumer Account", "UNAUTHORIZED"),
    ("R06", "Returned per ODFI Request", "ADMINISTRATIVE"),
    ("R07", "Authorization Revoked by Customer", "UNAUTHORIZED"),
    ("R08", "Payment Stopped", "RETURN"),
    ("R09", "Uncollected Funds", "RETURN"),
    ("R10", "Customer Advises Originator is Not Known", "UNAUTHORIZED"),
    ("R11", "Check Truncation Entry Return", "RETURN"),
    ("R12", "Branch Sold to Another DFI", "ADMINISTRATIVE"),
    ("R13", "RDFI Not Qualified to Participate", "ADMINISTRATIVE"),
    ("R14", "Representative Payee Deceased", "RETURN"),
    ("R15", "Beneficiary or Account Holder Deceased", "RETURN"),
    ("R16", "Account Frozen", "RETURN"),
    ("R17", "File Record Edit Criteria", "ADMINISTRATIVE"),
    ("R20", "Non-Transaction Account", "RETURN"),
    ("R21", "Invalid Company Identification", "ADMINISTRATIVE"),
    ("R22", "Invalid Individual ID Number", "ADMINISTRATIVE"),
    ("R23", "Credit Entry Refused by Receiver", "UNAUTHORIZED"),
    ("R24", "Duplicate Entry", "ADMINISTRATIVE"),
    ("R29", "Corporate Customer Advises Not Authorized", "UNAUTHORIZED"),
    ("R31", "Permissible Return Entry (CCD/CTX)", "RETURN"),
    ("R51", "Item Related to RCK Entry is Ineligible", "RETURN"),
    ("R61", "Misrouted Return", "DISHONORED"),
    ("R67", "Duplicate Return", "DISHONORED"),
    ("R68", "Untimely Return", "DISHONORED"),
    ("R69", "Field Error(s)", "DISHONORED"),
    ("R70", "Permissible Return Entry Not Accepted", "DISHONORED"),
]

# fixed values: code, name
DIRECTIONS = [("INBOUND", "Inbound"), ("OUTBOUND", "Outbound")]

# fixed values: match rule and its confidence, in priority order
MATCH_RULES = [
    ("EXACT_TOKEN", 1.0),
    ("ROUTING_ACCOUNT", 0.95),
    ("PROXY_EXACT", 0.9),
    ("NAME_ROUTING", 0.8),
    ("NEW_PARTY", 0.0),
]


def ref_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Small constant tables; callers may broadcast them since their size is fixed."""
    make = spark.createDataFrame
    return {
        "payment_types": make(PAYMENT_TYPES, "payment_type_code string, payment_type_name string, payment_rail string, is_instant boolean"),
        "status_codes": make(STATUS_CODES, "status_code string, status_name string, status_category string, is_terminal boolean"),
        "return_codes": make(RETURN_CODES, "return_code string, return_description string, category string"),
        "directions": make(DIRECTIONS, "direction_code string, direction_name string"),
    }


def sql_values(rows: list[tuple]) -> str:
    """Rows as a SQL VALUES list, for queries that state the table inline."""
    def text(value) -> str:
        if isinstance(value, str):
            return "'" + value.replace("'", "''") + "'"
        return str(value).upper()

    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
