"""Cross-rail flow: monthly and quarterly movement, pivots and Sankey shapes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import is_inflow, is_outflow, mean, recent, settled, share, sum_if

PIVOT_RAILS = ("ACH", "WIRE", "RTP", "FEDNOW", "ZELLE", "CARD", "CHECK", "BILLPAY")


def _settled_rows(txn: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    return txn.filter((F.col("status") == "SETTLED") & recent(as_of, months=months))


def _net():
    """Inflow counts up; every other row, also one without direction, counts down."""
    return F.sum(F.when(is_inflow(), settled()).otherwise(-settled()))


def monthly_flow(txn: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        _settled_rows(txn, as_of, 12)
        .groupBy("payment_type", F.date_format("transaction_ts", "yyyy-MM").alias("month"))
        .agg(
            F.count_if(is_inflow()).alias("inflow_count"),
            sum_if(is_inflow(), settled()).alias("inflow_usd"),
            F.count_if(is_outflow()).alias("outflow_count"),
            sum_if(is_outflow(), settled()).alias("outflow_usd"),
            _net().alias("net_usd"),
        )
        .orderBy(F.desc("month"), F.desc("inflow_usd"), "payment_type")
    )


def sankey_rows(txn: DataFrame, as_of: dt.date) -> DataFrame:
    day = F.to_date("transaction_ts")
    return (
        _settled_rows(txn, as_of, 12)
        .filter(is_inflow() | is_outflow())
        .groupBy(
            F.concat(F.lit("Q"), F.quarter(day), F.lit(" "), F.year(day)).alias("period"),
            "payment_type",
            F.when(is_inflow(), "CREDIT").otherwise("DEBIT").alias("direction"),
        )
        .agg(F.min(F.trunc(day, "quarter")).alias("period_start"), F.sum(settled()).alias("total"))
        .orderBy(F.desc("period"), "direction", F.desc("total"), "payment_type")
    )


def net_pivot(txn: DataFrame, as_of: dt.date) -> DataFrame:
    """One net column per named rail; a rail without a column only enters the total."""
    rail_net = [
        F.sum(F.when(F.col("payment_type") == rail, F.when(is_inflow(), settled()).otherwise(-settled())))
        .alias(f"{rail.lower()}_net")
        for rail in PIVOT_RAILS
    ]
    return (
        _settled_rows(txn, as_of, 12)
        .groupBy(F.date_format("transaction_ts", "yyyy-MM").alias("month"))
        .agg(*rail_net, _net().alias("total_net"))
        .orderBy(F.desc("month"))
    )


def fx_flows(txn: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        _settled_rows(txn, as_of, 3)
        .filter(F.col("original_currency_code") != "USD")
        .groupBy("payment_type", "original_currency_code", "direction")
        .agg(
            F.count("*").alias("txn_count"),
            F.sum("original_amount").alias("original_amount"),
            F.round(mean("fx_rate"), 6).alias("avg_fx_rate"),
            F.sum("settlement_amount").alias("settled_usd"),
        )
        .orderBy(F.desc("settled_usd"))
    )


def flow_kpis(rows: DataFrame) -> DataFrame:
    return rows.groupBy("period").agg(
        sum_if(is_inflow(), "total").alias("total_in"),
        sum_if(is_outflow(), "total").alias("total_out"),
        (sum_if(is_inflow(), "total") - sum_if(is_outflow(), "total")).alias("net"),
    )


def sankey_nodes(rows: DataFrame) -> DataFrame:
    """Per period: source node 0, one node per rail, then the sink node."""
    per_period = Window.partitionBy("period").orderBy("payment_type")  # a handful of rails per period
    rails = rows.select("period", "payment_type").distinct().select(
        "period", F.col("payment_type").alias("label"), F.row_number().over(per_period).alias("node"), F.lit(1).alias("col")
    )
    ends = rails.groupBy("period").agg(F.max("node").alias("rails")).select(
        "period",
        F.explode(F.array(
            F.struct(F.lit("INFLOW").alias("label"), F.lit(0).alias("node"), F.lit(0).alias("col")),
            F.struct(F.lit("OUTFLOW").alias("label"), (F.col("rails") + 1).alias("node"), F.lit(2).alias("col")),
        )).alias("end"),
    ).select("period", "end.*")
    return rails.unionByName(ends)


def sankey_links(rows: DataFrame) -> DataFrame:
    nodes = sankey_nodes(rows)
    rail = nodes.filter("col = 1").select("period", F.col("label").alias("payment_type"), F.col("node").alias("rail_node"))
    sink = nodes.filter("col = 2").select("period", F.col("node").alias("sink_node"))
    return rows.join(rail, ["period", "payment_type"]).join(sink, "period").select(
        "period", "payment_type", "direction",
        F.when(is_inflow(), F.lit(0)).otherwise(F.col("rail_node")).alias("source"),
        F.when(is_inflow(), F.col("rail_node")).otherwise(F.col("sink_node")).alias("target"),
        F.col("total").alias("value"),
    )


def rail_share(rows: DataFrame) -> DataFrame:
    rails = rows.groupBy("period", "payment_type").agg(
        sum_if(is_inflow(), "total").alias("inflow"),
        sum_if(is_outflow(), "total").alias("outflow"),
        F.sum("total").alias("volume"),
    )
    whole = F.sum("inflow").over(Window.partitionBy("period"))
    return rails.withColumn("net", F.col("inflow") - F.col("outflow")).withColumn(
        "inflow_share", share(F.col("inflow"), whole)
    )


def periods(rows: DataFrame) -> DataFrame:
    return rows.select("period").distinct()
