"""Documented reporting queries over the silver fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import mean, recent, settled, share


def rule_distribution(txn: DataFrame, tenant: str, as_of: dt.date) -> DataFrame:
    return (
        txn.filter((F.col("tenant_id") == tenant) & F.col("originator_match_rule").isNotNull() & recent(as_of, days=7))
        .groupBy("originator_match_rule")
        .agg(F.count("*").alias("txn_count"), mean("originator_resolution_confidence").alias("avg_confidence"))
        .orderBy(F.desc("txn_count"), "originator_match_rule")
    )


def fx_by_pair(txn: DataFrame, tenant: str, as_of: dt.date) -> DataFrame:
    return (
        txn.filter((F.col("tenant_id") == tenant) & F.col("original_currency_code").isNotNull() & recent(as_of, days=30))
        .groupBy("payment_type", "original_currency_code", F.col("settlement_currency_code").alias("settlement_currency"))
        .agg(
            F.count("*").alias("txn_count"),
            F.sum("original_amount").alias("total_original_amount"),
            F.sum("settlement_amount").alias("total_settlement_amount"),
            mean("fx_rate").alias("avg_fx_rate"),
        )
        .orderBy(F.desc("txn_count"), "payment_type", "original_currency_code")
    )


def party_total(txn: DataFrame, party: str) -> DataFrame:
    return txn.filter((F.col("originator_party_id") == party) & (F.col("status") == "SETTLED")).agg(
        F.sum(settled()).alias("total_usd")
    )


def exposure(txn: DataFrame, party: str | None = None, counterparty: str | None = None) -> DataFrame:
    """Money from one party to another by rail; without arguments, for every pair that traded."""
    if party is not None:
        txn = txn.filter(F.col("originator_party_id") == party)
    if counterparty is not None:
        txn = txn.filter(F.col("beneficiary_party_id") == counterparty)
    return (
        txn.filter(F.col("originator_party_id").isNotNull() & F.col("beneficiary_party_id").isNotNull())
        .groupBy("originator_party_id", "beneficiary_party_id", "payment_type")
        .agg(F.sum(settled()).alias("exposure_usd"))
    )


def ir_rate(txn: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        txn.filter(recent(as_of, days=30))
        .groupBy("payment_type")
        .agg(share(F.count("originator_party_id"), F.count("*")).alias("ir_rate"))
    )


def on_us_volume(txn: DataFrame) -> DataFrame:
    return txn.groupBy("payment_type").agg(
        F.count_if("is_on_us").alias("on_us_count"),
        F.sum(F.when(F.col("is_on_us"), settled())).alias("on_us_vol"),
    )


def settled_by_rail(txn: DataFrame) -> DataFrame:
    return (
        txn.filter(F.col("status") == "SETTLED")
        .groupBy("payment_type", "direction")
        .agg(F.sum(settled()).alias("total"))
    )


def return_rates(txn: DataFrame, codes: DataFrame) -> DataFrame:
    """Share of each rail's rows that came back, by code; one pass over the fact."""
    by_code = txn.groupBy("payment_type", "return_reason_code").agg(F.count("*").alias("txn_count"))
    rail_total = F.sum("txn_count").over(Window.partitionBy("payment_type"))  # rails x codes rows only
    known = codes.select(F.col("return_code").alias("return_reason_code"), F.col("category").alias("return_category"))
    return (
        by_code.withColumn("return_rate", share(F.col("txn_count"), rail_total))
        .filter(F.col("return_reason_code").isNotNull())
        .join(F.broadcast(known), "return_reason_code", "left")  # 30 fixed codes
        .select("payment_type", "return_reason_code", F.coalesce("return_category", F.lit("UNKNOWN")).alias("return_category"),
                F.col("txn_count").alias("return_count"), "return_rate")
    )


def top_k(df: DataFrame, group: str, value: str, tie: str, k: int) -> DataFrame:
    """First ``k`` rows of each group; Spark limits groups before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc(value), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def counterparty_volume(txn: DataFrame) -> DataFrame:
    return txn.groupBy("tenant_id", "beneficiary_party_id").agg(
        F.count("*").alias("txn_count"), F.sum(settled()).alias("volume")
    )


def hours_between(start: str, end: str) -> Column:
    return F.timestamp_diff("HOUR", F.col(start), F.col(end))


def settlement_latency(txn: DataFrame) -> DataFrame:
    """Hour-grained latency: the percentile state is one counter per distinct hour."""
    rows = txn.filter(F.col("settled_ts").isNotNull()).withColumn("hours", hours_between("transaction_ts", "settled_ts"))
    return rows.groupBy("payment_type").agg(
        F.count("*").alias("settled_count"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY hours)").cast("double").alias("p50_hours"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY hours)").cast("double").alias("p95_hours"),
        share(F.count_if(F.to_date("settled_ts") == F.to_date("transaction_ts")), F.count("*")).alias("same_day_share"),
    )


def delivery_mix(txn: DataFrame) -> DataFrame:
    """Billpay delivery methods by month: share, and change against the month before."""
    mix = (
        txn.filter(F.col("payment_type") == "BILLPAY")
        .groupBy(F.date_format("transaction_ts", "yyyy-MM").alias("month"),
                 F.get_json_object("rail_details_json", "$.delivery_method").alias("delivery_method"))
        .agg(F.count("*").alias("txn_count"))
        .withColumn("month_share", share(F.col("txn_count"), F.sum("txn_count").over(Window.partitionBy("month"))))
    )
    before = F.lag("month_share").over(Window.partitionBy("delivery_method").orderBy("month"))
    return mix.withColumn("share_change", F.col("month_share") - before)


def channel_mix(txn: DataFrame) -> DataFrame:
    mix = txn.groupBy("payment_type", F.coalesce("channel", F.lit("UNKNOWN")).alias("channel")).agg(
        F.count("*").alias("txn_count"))
    whole = Window.partitionBy("payment_type")
    digital = F.col("channel").isin("ONLINE", "MOBILE", "API")
    return mix.withColumn("channel_share", share(F.col("txn_count"), F.sum("txn_count").over(whole))).withColumn(
        "digital_share",
        share(F.sum(F.when(digital, F.col("txn_count")).otherwise(0)).over(whole), F.sum("txn_count").over(whole)))


def ir_drift(quality: DataFrame) -> DataFrame:
    """Day-over-day movement of each rule's share and mean confidence."""
    day = Window.partitionBy("tenant_id", "party_role", "period_date")
    rule = Window.partitionBy("tenant_id", "party_role", "match_rule").orderBy("period_date")
    shares = quality.withColumn("rule_share", share(F.col("txn_count"), F.sum("txn_count").over(day)))
    return shares.select(
        "tenant_id", "party_role", "match_rule", "period_date", "rule_share",
        (F.col("rule_share") - F.lag("rule_share").over(rule)).alias("share_change"),
        (F.col("avg_confidence") - F.lag("avg_confidence").over(rule)).alias("confidence_change"),
    )


def check_holds(raw: DataFrame) -> DataFrame:
    band = F.least(F.floor(F.col("risk_score") / 25), F.lit(3)).cast("bigint")
    days = F.datediff("funds_availability_date", F.to_date("deposit_timestamp"))
    return raw.groupBy("hold_type", band.alias("risk_band")).agg(
        F.count("*").alias("item_count"), F.sum("hold_amount").alias("held"),
        share(F.sum(days), F.count("*")).alias("avg_days_to_funds"))


def _card(txn: DataFrame) -> DataFrame:
    shape = ("merchant_category_code string, issuer_response_code string, "
             "chargeback_details struct<chargeback_reason_code:string, dispute_status:string, chargeback_amount:decimal(18,2)>")
    return txn.filter(F.col("payment_type") == "CARD").select(F.from_json("rail_details_json", shape).alias("card"))


def card_disputes(txn: DataFrame) -> DataFrame:
    dispute = F.col("card.chargeback_details")
    return _card(txn).filter(dispute.isNotNull()).groupBy(
        dispute["dispute_status"].alias("dispute_status"), dispute["chargeback_reason_code"].alias("reason_code")
    ).agg(F.count("*").alias("dispute_count"), F.sum(dispute["chargeback_amount"]).alias("disputed"))


def card_approval(txn: DataFrame) -> DataFrame:
    return _card(txn).groupBy(F.col("card.merchant_category_code").alias("mcc")).agg(
        F.count("*").alias("txn_count"),
        share(F.count_if(F.col("card.issuer_response_code") == "00"), F.count("*")).alias("approval_rate"))
