"""Joined views of the fact: parties, billers, linked transactions, code lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import left_lookup
from ..functions.money import recent, settled, share
from ..functions.timeline import HOT_ROWS, SLOTS, latest_before
from ..sources.refdata import PAYMENT_TYPES, STATUS_CODES
from ..sources.schemas import CHANGE_ORDER

# fixed values
EXCEPTION_STATUSES = ["FAILED", "RETURNED", "DECLINED", "REJECTED"]
TERMINAL = [code for code, _, _, terminal in STATUS_CODES if terminal]

# fixed values: columns of the joined fact
FACT_COLUMNS = """
transaction_id tenant_id payment_type payment_rail payment_subtype direction amount currency_code status transaction_ts
settlement_date is_on_us on_us_settlement_type iban_country_code swift_bic original_currency_code original_amount fx_rate fx_rate_source settlement_currency_code
originator_account_token originator_routing_number originator_block_key originator_match_rule
beneficiary_account_token beneficiary_routing_number beneficiary_block_key beneficiary_match_rule
rail_schema_version rail_details_json compliance_json schema_version
""".split()


def transactions_with_parties(txn: DataFrame, parties: DataFrame, accounts: DataFrame) -> DataFrame:
    """The fact with both resolved parties and accounts; missing dimensions leave NULLs."""
    rows = txn
    for side, short in (("originator", "orig"), ("beneficiary", "bene")):
        party = parties.select(
            F.col("party_id").alias(f"{side}_party_id"), F.col("party_type").alias(f"{short}_party_type"),
            F.col("resolution_status").alias(f"{short}_resolution_status"), F.col("resolution_confidence").alias(f"{short}_resolution_confidence"))
        account = accounts.select(
            F.col("account_id").alias(f"{side}_account_id"), F.col("account_type").alias(f"{short}_account_type"),
            F.col("institution_routing_number").alias(f"{short}_fi_routing"), F.col("institution_swift_bic").alias(f"{short}_fi_swift_bic"),
            F.col("institution_name").alias(f"{short}_fi_name"), F.col("institution_iban_country_code").alias(f"{short}_iban_country_code"),
            F.col("is_on_us").alias(f"{short}_account_is_on_us"))
        rows = left_lookup(left_lookup(rows, party, [f"{side}_party_id"]), account, [f"{side}_account_id"])
    added = [c for c in rows.columns if c.startswith(("orig_", "bene_")) and c != "orig_iban_country_code"]
    return rows.select(*[c for c in FACT_COLUMNS if c in rows.columns], *added)


def authorized_signers(rel: DataFrame, parties: DataFrame, tenant: str, business: str | None = None) -> DataFrame:
    links = rel.filter((F.col("tenant_id") == tenant) & (F.col("relationship_type") == "AUTHORIZED_SIGNER") & F.col("is_active"))
    if business is not None:
        links = links.filter(F.col("party_id_a") == business)
    name = lambda side, alias: parties.select(F.col("party_id").alias(f"party_id_{side}"), F.col("display_name").alias(alias))
    return links.join(name("a", "business_name"), "party_id_a").join(name("b", "signer_name"), "party_id_b").select(
        "business_name", "signer_name", F.col("role_b").alias("signer_role"), "effective_date", "expiry_date")


def biller_transactions(txn: DataFrame, accounts: DataFrame, billers: DataFrame, parties: DataFrame, standard_id: str, as_of: dt.date) -> DataFrame:
    """Payments to a biller across tenants; the biller side is filtered before it meets the fact."""
    target = billers.filter(F.col("standard_biller_id") == standard_id).join(parties.select("party_id", "display_name"), "party_id").join(
        accounts.select("party_id", "account_id"), "party_id").select(
        F.col("account_id").alias("beneficiary_account_id"), "biller_category", F.col("display_name").alias("biller_name"))
    return txn.filter(recent(as_of, days=30)).join(target, "beneficiary_account_id").select(
        "tenant_id", "payment_type", "amount", "transaction_ts", "biller_category", "biller_name").orderBy(F.desc("transaction_ts"))


def joint_activity(txn: DataFrame, accounts: DataFrame, rel: DataFrame, account: str) -> DataFrame:
    """Activity of everyone tied to an account: its party and that party's joint holders."""
    holder = accounts.filter(F.col("account_id") == account).select("party_id")
    joint = rel.filter((F.col("relationship_type") == "JOINT_ACCOUNT") & F.col("is_active"))
    ends = joint.select(F.explode(F.array(
        F.struct(F.col("party_id_a").alias("party_id"), F.col("party_id_b").alias("partner")),
        F.struct(F.col("party_id_b").alias("party_id"), F.col("party_id_a").alias("partner")))).alias("e")).select("e.*")
    tied = holder.union(ends.join(holder, "party_id").select("partner")).distinct()
    return txn.join(tied.withColumnRenamed("party_id", "originator_party_id"), "originator_party_id").groupBy(
        F.col("originator_party_id").alias("party_id"), "payment_type").agg(F.sum(settled()).alias("volume"))


def enrich_refs(txn: DataFrame, refs: dict[str, DataFrame]) -> DataFrame:
    """Status category and finality, return description and category; both lists are fixed and small."""
    status = refs["status_codes"].select(F.col("status_code").alias("status"), "status_category", "is_terminal")
    code = refs["return_codes"].select(F.col("return_code").alias("return_reason_code"), "return_description", F.col("category").alias("return_category"))
    return txn.join(F.broadcast(status), "status", "left").join(F.broadcast(code), "return_reason_code", "left")


def biller_methods(billers: DataFrame) -> DataFrame:
    return billers.select("biller_id", "biller_category", F.explode("payment_methods").alias("payment_method"),
                          F.array_contains("payment_methods", "RTP").alias("accepts_instant"))


def rail_capability(refs: DataFrame) -> DataFrame:
    """Send and receive flags of an account, one column pair per rail, from its active references."""
    live = refs.filter(F.col("participant_status") == "ACTIVE")
    flags = [F.coalesce(F.bool_or(F.when(F.col("rail_type") == rail, F.col(f"is_{way}_participant"))), F.lit(False)).alias(f"{rail.lower()}_{short}")
             for rail, *_ in PAYMENT_TYPES for way, short in (("originating", "send"), ("receiving", "receive"))]
    return live.groupBy("account_id").agg(*flags)


def _one_per(rows: DataFrame, keys: dict[str, str], name: str) -> DataFrame:
    """The newest version per linked key: linking never multiplies rows."""
    newest = F.max_by(F.struct("transaction_id", "amount", "transaction_ts"), F.struct(*CHANGE_ORDER))
    return rows.groupBy(*[F.col(c).alias(k) for k, c in keys.items()]).agg(newest.alias(name))


def link_returns(txn: DataFrame) -> DataFrame:
    """Each returned payment with its original on the same tenant and rail."""
    original = _one_per(txn.filter(F.col("status") != "RETURNED"), {
        "tenant_id": "tenant_id", "payment_type": "payment_type", "original_reference": "source_transaction_id"}, "original")
    returned = txn.filter((F.col("status") == "RETURNED") & F.col("original_reference").isNotNull())
    return returned.join(original, ["tenant_id", "payment_type", "original_reference"]).select(
        "tenant_id", "payment_type", F.col("transaction_id").alias("return_transaction_id"), "original.transaction_id",
        F.col("amount").alias("returned_amount"), F.col("original.amount").alias("original_amount"), "return_reason_code")


def link_rfp(txn: DataFrame, days: int = 30, hot_rows: int = HOT_ROWS, slots: int = SLOTS) -> DataFrame:
    """Each answer to a request for payment with the newest request at most ``days`` older."""
    instant = txn.filter(F.col("payment_type").isin("RTP", "FEDNOW"))
    answers = F.col("original_reference").isNotNull() & (F.col("status") != "RETURNED")
    rows = instant.select(
        "tenant_id", "payment_type", F.when(answers, F.col("original_reference")).otherwise(F.col("source_transaction_id")).alias("request_key"),
        "transaction_id", "transaction_ts", answers.alias("is_answer"),
        F.when(~answers, F.struct("transaction_id", F.col("transaction_ts").alias("requested_ts"))).alias("request"))
    linked = latest_before(rows, ["tenant_id", "payment_type", "request_key"], "transaction_ts", "request", hot_rows, slots)
    late = F.col("latest.requested_ts") < F.col("transaction_ts") - F.make_dt_interval(F.lit(days))
    return linked.filter("is_answer and latest is not null").filter(~late).select(
        "tenant_id", "payment_type", F.col("transaction_id").alias("answer_transaction_id"),
        F.col("latest.transaction_id").alias("request_transaction_id"),
        F.timestamp_diff("HOUR", F.col("latest.requested_ts"), F.col("transaction_ts")).alias("hours_to_answer"))


def link_billpay(txn: DataFrame, rails: tuple[str, ...] = ("ACH", "RTP", "FEDNOW", "CHECK")) -> DataFrame:
    """Each bill payment with every transaction that moved its money, one per rail."""
    moved = _one_per(txn.filter(F.col("payment_type").isin(*rails)), {
        "tenant_id": "tenant_id", "original_reference": "source_transaction_id", "underlying_rail": "payment_type"}, "moved")
    return txn.filter(F.col("payment_type") == "BILLPAY").join(moved, ["tenant_id", "original_reference"], "left").select(
        "tenant_id", "transaction_id", "underlying_rail", F.col("moved.transaction_id").alias("underlying_transaction_id"),
        (F.col("moved.amount") - F.col("amount")).alias("amount_gap"))


def exceptions(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("status").isin(*EXCEPTION_STATUSES))


def active(txn: DataFrame) -> DataFrame:
    return txn.filter(~F.col("status").isin(*TERMINAL))


def recent_rows(txn: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    return txn.filter(recent(as_of, days=days))


def correspondents(addresses: DataFrame, txn: DataFrame) -> DataFrame:
    """International wires by correspondent bank of the beneficiary; with several banks a wire counts under each."""
    banks = addresses.filter(F.col("address_type") == "CORRESPONDENT").select(
        F.col("party_id").alias("beneficiary_party_id"), "correspondent_bank_bic", "correspondent_bank_name").distinct()
    wires = txn.filter((F.col("payment_type") == "WIRE") & (F.col("payment_rail") == "SWIFT"))
    return wires.join(banks, "beneficiary_party_id").groupBy("correspondent_bank_bic", "correspondent_bank_name").agg(
        F.count("*").alias("wire_count"), F.sum(settled()).alias("volume"), share(F.sum(settled()), F.count("*")).alias("average"))
