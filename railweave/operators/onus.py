"""On-us: do both sides of a payment bank with the same tenant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import left_lookup, spread_null

RAIL_FLAGS = ("is_rtp_participant", "is_fednow_participant", "is_zelle_participant")


def resolve_institution(txn: DataFrame, institutions: DataFrame) -> DataFrame:
    """Tenant and rail participation of both routings on the transaction date.

    Where validity periods of a routing number overlap, the one that begins later ends the one
    before it (of several that begin on one day the least tenant stays), so rows never multiply.
    Spark broadcasts the directory by measured size and falls back to a skew-split sort-merge
    join, in which rows without a routing number are spread.
    """
    period = Window.partitionBy("routing_number").orderBy("effective_date")
    active = institutions.filter("is_active").withColumn("_n", F.row_number().over(Window.partitionBy("routing_number", "effective_date").orderBy("tenant_id")))
    active = active.filter("_n = 1").withColumn("expiry_date", F.least("expiry_date", F.date_sub(F.lead("effective_date").over(period), 1)))
    day = F.to_date("transaction_ts")
    for side in ("originator", "beneficiary"):
        look = active.select(
            F.col("routing_number").alias("_routing"), F.col("effective_date").alias("_from"), F.col("expiry_date").alias("_to"),
            F.col("tenant_id").alias(f"{side}_tenant_id"), *[F.col(f).alias(f"{side}_{f}") for f in RAIL_FLAGS])
        txn = txn.join(
            look,
            (spread_null(f"{side}_routing_number", "transaction_id") == F.col("_routing")) & (day >= F.col("_from"))
            & (F.col("_to").isNull() | (day <= F.col("_to"))),
            "left").drop("_routing", "_from", "_to")
    return txn


def on_us_flag():
    """Same tenant; if a routing is unmapped, same routing; unknown without routings."""
    mine, theirs = F.col("originator_tenant_id"), F.col("beneficiary_tenant_id")
    return F.when(mine.isNotNull() & theirs.isNotNull(), mine == theirs).otherwise(
        F.col("originator_routing_number") == F.col("beneficiary_routing_number"))


def settlement_type():
    """How an on-us payment settles; NULL for any other."""
    rail = F.col("payment_type")
    return F.when(F.col("is_on_us"), F.when(rail.isin("ACH", "WIRE", "ZELLE"), F.concat(F.lit("INTERNAL_"), rail))
                  .when(rail.isin("CHECK", "RDC"), "INTERNAL_CHECK").otherwise("BOOK_TRANSFER"))


def derive_on_us(txn: DataFrame, institutions: DataFrame) -> DataFrame:
    return resolve_institution(txn, institutions).withColumn("is_on_us", on_us_flag()).withColumn(
        "on_us_settlement_type", settlement_type())


def rail_eligibility(txn: DataFrame, institutions: DataFrame) -> DataFrame:
    """Could this payment have used an instant rail: both institutions take part."""
    rows = resolve_institution(txn, institutions)
    both = {f"could_use_{f.split('_')[1]}": F.coalesce(F.col(f"originator_{f}") & F.col(f"beneficiary_{f}"), F.lit(False))
            for f in RAIL_FLAGS}
    return rows.withColumns(both)


def on_us_from_accounts(txn: DataFrame, accounts: DataFrame) -> DataFrame:
    """Compare the flag with the linked accounts: both held here."""
    for side in ("originator", "beneficiary"):
        held = accounts.select(F.col("account_id").alias(f"{side}_account_id"), F.col("is_on_us").alias(f"{side}_held_here"))
        txn = left_lookup(txn, held, [f"{side}_account_id"])
    held_here = F.col("originator_held_here") & F.col("beneficiary_held_here")
    return txn.withColumn("accounts_on_us", held_here).withColumn(
        "on_us_mismatch", F.col("accounts_on_us") != F.col("is_on_us"))
