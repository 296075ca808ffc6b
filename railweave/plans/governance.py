"""Governance measured on the stored tables: catalog, sensitivity, leaks, lineage, isolation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: columns that hold tokens of card or account data, and of personal data
PCI_COLUMNS = ["originator_account_token", "beneficiary_account_token", "account_number_token", "institution_iban_token", "iban_token",
               "bank_address_token", "biller_fi_account_token", "card_expiry_token", "card_number_token"]
PII_COLUMNS = ["name_token", "tax_id_token", "address_line1_token", "address_line2_token", "proxy_value_token"]
PARTITION_COLUMNS = ["transaction_ts", "created_timestamp", "initiated_timestamp", "auth_timestamp", "deposit_timestamp", "period_date", "resolved_at"]

# fixed values: shapes of raw sensitive values
LEAK_PATTERNS = {
    "PAN": "(^|[^0-9])[0-9]{13,16}([^0-9]|$)",
    "SSN": "(^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}([^0-9]|$)",
    "EMAIL": "[A-Za-z0-9]@[A-Za-z0-9-]+[.][A-Za-z]{2}",
    "IBAN": "(^|[^A-Z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}([^A-Z0-9]|$)",
}


def build_catalog(tables: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """One row per column of ``{table: (layer, df)}`` with sensitivity flags and measured fill.

    Each table is read once: all columns are counted in the same aggregate.
    """
    parts = []
    for name, (layer, df) in tables.items():
        counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(df.columns)])
        entries = F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.lit(kind).alias("data_type"), F.lit(i + 1).alias("ordinal"),
            F.lit(c in PCI_COLUMNS).alias("is_pci"), F.lit(c in PII_COLUMNS).alias("is_pii"), F.lit(c in PARTITION_COLUMNS).alias("is_partition"),
            F.col(f"_c{i}").alias("filled_count")) for i, (c, kind) in enumerate(df.dtypes)])
        parts.append(counts.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.col("_rows").alias("row_count"),
                                   F.explode(entries).alias("e")).select("layer", "table_name", "row_count", "e.*"))
    return reduce(DataFrame.unionByName, parts)


def sensitivity_report(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("layer").agg(
        F.count("*").alias("column_count"), F.count_if("is_pci").alias("pci_columns"), F.count_if("is_pii").alias("pii_columns"),
        F.sum(F.when(F.col("is_pci") | F.col("is_pii"), F.col("filled_count")).otherwise(0)).alias("sensitive_values"))


def scan_leaks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column and kind that look like a raw sensitive value; whole texts, one pass."""
    pairs = [(c, kind) for c in columns for kind in LEAK_PATTERNS]
    counts = df.agg(*[F.count_if(F.col(c).rlike(LEAK_PATTERNS[kind])).alias(f"{c}|{kind}") for c, kind in pairs])
    hits = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("leak_kind"), F.col(f"`{c}|{kind}`").alias("row_count")) for c, kind in pairs])
    return counts.select(F.explode(hits).alias("h")).select("h.*")


def lineage(mapping: DataFrame, catalog: DataFrame, table: str = "unified_transactions") -> DataFrame:
    """Target columns no mapping feeds although they hold values."""
    targets = catalog.filter(F.col("table_name") == table)
    fed = mapping.filter(F.col("target_table") == table).select(F.col("target_field").alias("column_name")).distinct()
    return targets.join(fed, "column_name", "left_anti").select("column_name", "filled_count")


def ir_fields(mapping: DataFrame, catalog: DataFrame) -> DataFrame:
    """Fields that seed matching, by role and priority, with the measured fill of their target."""
    fill = catalog.select(F.col("table_name").alias("target_table"), F.col("column_name").alias("target_field"), "filled_count")
    return mapping.filter("ir_role is not null or is_on_us_indicator").join(fill, ["target_table", "target_field"], "left").select(
        "payment_type", "source_field", "target_field", "ir_role", "ir_priority", "is_on_us_indicator", "filled_count").orderBy(
        F.asc_nulls_last("ir_priority"), "ir_role", "payment_type", "source_field")


def registry_check(registry: DataFrame, catalog: DataFrame) -> DataFrame:
    """Registered tables against tables that exist."""
    actual = catalog.groupBy("table_name").agg(F.max("row_count").alias("row_count"), F.lit(True).alias("exists"))
    return registry.join(actual, "table_name", "full_outer").select(
        "table_name", F.when(F.col("layer").isNull(), "UNREGISTERED").when(F.col("exists").isNull(), "MISSING").otherwise("OK").alias("state"), "row_count")


def cross_tenant(txn: DataFrame, parties: DataFrame) -> DataFrame:
    """Facts whose party belongs to another tenant; counted per party first, so hot parties join as one row."""
    sides = F.array(*[F.struct(F.lit(role.upper()).alias("party_role"), F.col(f"{role}_party_id").alias("party_id"))
                      for role in ("originator", "beneficiary")])
    used = txn.select("tenant_id", F.explode(sides).alias("s")).select("tenant_id", "s.*").filter("party_id is not null").groupBy(
        "tenant_id", "party_role", "party_id").agg(F.count("*").alias("n"))
    home = parties.select("party_id", F.col("tenant_id").alias("party_tenant_id"))
    return used.join(home, "party_id").filter("tenant_id <> party_tenant_id").groupBy("tenant_id", "party_tenant_id", "party_role").agg(
        F.sum("n").alias("row_count"), F.count("*").alias("party_count"))
