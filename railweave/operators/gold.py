"""Daily gold aggregates.

Every aggregate is one pass: conditional measures instead of one query per
measure, combined on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import is_inflow, is_outflow, mean, period_date, share, sum_if
from ..sources.refdata import PAYMENT_TYPES
from ..sources.storage import period_start
from .roles import to_role_rows

UNKNOWN = "UNKNOWN"


def _daily(txn: DataFrame, *keys: Column | str):
    return txn.groupBy("tenant_id", period_date().alias("period_date"), *keys)


def _both(name: str, cond: Column) -> list[Column]:
    return [F.count_if(cond).alias(f"{name}_count"), sum_if(cond, "amount").alias(f"{name}_amount")]


def gold_by_payment_type(txn: DataFrame) -> DataFrame:
    crossed = F.col("settlement_currency_code").isNotNull()
    return _daily(txn, "payment_type").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        mean("amount").alias("avg_amount"),
        *_both("inbound", is_inflow()),
        *_both("outbound", is_outflow()),
        *_both("on_us", F.col("is_on_us")),
        *_both("off_us", ~F.col("is_on_us")),
        *_both("return", F.col("return_reason_code").isNotNull()),
        F.count_if("is_recurring").alias("recurring_count"),
        F.count_if(crossed).alias("cross_currency_count"),
        sum_if(crossed, "settlement_amount").alias("cross_currency_amount"),
    )


def gold_ir_quality(txn: DataFrame) -> DataFrame:
    roles = to_role_rows(txn).filter(F.col("match_rule").isNotNull())
    return _daily(roles, "match_rule", "party_role").agg(
        F.count("*").alias("txn_count"),
        mean("resolution_confidence").alias("avg_confidence"),
        F.min("resolution_confidence").alias("min_confidence"),
        F.max("resolution_confidence").alias("max_confidence"),
        F.count_if(F.col("match_rule") == "NEW_PARTY").alias("new_party_count"),
    )


def gold_cross_rail(txn: DataFrame) -> DataFrame:
    return _daily(txn, "payment_type").agg(
        *_both("inbound", is_inflow()),
        *_both("outbound", is_outflow()),
        (sum_if(is_inflow(), "amount") - sum_if(is_outflow(), "amount")).alias("net_amount"),
        *_both("on_us", F.col("is_on_us")),
    )


def gold_by_channel(txn: DataFrame) -> DataFrame:
    return _daily(txn, F.coalesce("channel", F.lit(UNKNOWN)).alias("channel"), "payment_type").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        mean("amount").alias("avg_amount"),
        F.count("return_reason_code").alias("return_count"),
    )


def gold_biller_volume(txn: DataFrame, billers: DataFrame) -> DataFrame:
    """Bill payments by biller category; billers outside the registry count as OTHER."""
    registry = billers.groupBy("party_id").agg(
        F.min_by(F.struct("biller_category", "aggregator_name"), "biller_registry_id").alias("biller"))
    rows = (
        txn.filter(F.col("payment_type") == "BILLPAY")
        .withColumn("rail", F.from_json("rail_details_json", "biller_id string, delivery_method string"))
        .join(registry.withColumnRenamed("party_id", "beneficiary_party_id"), "beneficiary_party_id", "left")
    )
    return _daily(
        rows,
        F.coalesce("biller.biller_category", F.lit("OTHER")).alias("biller_category"),
        F.coalesce("biller.aggregator_name", F.lit("OTHER")).alias("aggregator_name"),
        F.col("rail.delivery_method").alias("delivery_method"),
    ).agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        F.count_if("is_recurring").alias("recurring_count"),
        F.countDistinct("originator_party_id").alias("unique_payers"),
        F.countDistinct("rail.biller_id").alias("unique_billers"),
    )


def gold_fx_summary(txn: DataFrame) -> DataFrame:
    pair = F.concat_ws("/", "original_currency_code", "settlement_currency_code").alias("currency_pair")
    rows = txn.filter(F.col("original_currency_code").isNotNull() & F.col("settlement_currency_code").isNotNull())
    return _daily(rows, pair, "payment_type").agg(
        F.count("*").alias("txn_count"),
        F.sum("original_amount").alias("total_original_amount"),
        F.sum("settlement_amount").alias("total_settlement_amount"),
        share(F.sum("settlement_amount"), F.sum("original_amount")).alias("avg_fx_rate"),
        F.min("fx_rate").alias("min_fx_rate"),
        F.max("fx_rate").alias("max_fx_rate"),
        F.sum("fee_amount").alias("total_fx_fee"),
    )


def rail_bit() -> Column:
    """One bit per payment type; a type outside the list has the last bit."""
    types = [code for code, *_ in PAYMENT_TYPES]
    return F.coalesce(*[F.when(F.col("payment_type") == code, F.lit(1 << i)) for i, code in enumerate(types)], F.lit(1 << len(types)))


def gold_party_activity(txn: DataFrame, parties: DataFrame) -> DataFrame:
    """Daily activity per party.  A payment from a party to itself is one row that takes both roles.

    Rails are a closed list that the domain rule guards, so a bit per rail counts them in a
    hash aggregate; counterparties are not, so they use Spark's two-level distinct count.
    """
    me, other = F.col("originator_party_id"), F.col("beneficiary_party_id")
    sides = F.array(
        F.struct(me.alias("party_id"), other.alias("other_id"), F.lit(True).alias("as_originator"),
                 F.coalesce(me == other, F.lit(False)).alias("as_beneficiary")),
        F.struct(F.when(~me.eqNullSafe(other), other).alias("party_id"), me.alias("other_id"),
                 F.lit(False).alias("as_originator"), F.lit(True).alias("as_beneficiary")),
    )
    rows = txn.select("tenant_id", "transaction_ts", "payment_type", "amount", "is_on_us", "return_reason_code",
                      F.explode(sides).alias("side")).select("*", "side.*").filter(F.col("party_id").isNotNull())
    daily = _daily(rows, "party_id").agg(
        F.when(F.bool_or("as_originator") & F.bool_or("as_beneficiary"), "BOTH")
        .when(F.bool_or("as_originator"), "ORIGINATOR").otherwise("BENEFICIARY").alias("role"),
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        F.bit_count(F.bit_or(rail_bit())).cast("bigint").alias("distinct_rails"),
        F.countDistinct("other_id").alias("distinct_counterparties"),
        F.count_if("is_on_us").alias("on_us_count"),
        F.count("return_reason_code").alias("return_count"),
    )
    return daily.join(parties.select("party_id", "party_type"), "party_id", "left").withColumn(
        "party_type", F.coalesce("party_type", F.lit(UNKNOWN)))


def gold_legacy(txn: DataFrame) -> DataFrame:
    return txn.groupBy("payment_type", period_date().alias("period_date")).agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("total_amount"))


def touched_days(changed: DataFrame, period: str = "day") -> DataFrame:
    return changed.select(period_start(period_date(), period).alias("period_date")).distinct()


def refresh_gold(txn: DataFrame, changed: DataFrame, build=gold_cross_rail, period: str = "day") -> DataFrame:
    """Rebuild only the partitions that a change batch touches; write it with dynamic overwrite.

    On a fact stored by ``txn_date`` the semi join prunes partitions at run time.
    """
    day = F.col("txn_date") if "txn_date" in txn.columns else period_start(period_date(), period)
    days = touched_days(changed, period)
    return build(txn.join(days, day == days["period_date"], "left_semi"))


def rollup_gold(daily: DataFrame, grain: str = "month") -> DataFrame:
    """Daily rows to a coarser period with tenant and overall subtotals; only additive measures."""
    additive = [c for c, kind in daily.dtypes
                if c.endswith(("_count", "_amount")) and c != "avg_amount" and kind != "double"]
    rolled = daily.withColumn("period_start", F.trunc("period_date", grain)).rollup("period_start", "tenant_id", "payment_type")
    return rolled.agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in additive])
