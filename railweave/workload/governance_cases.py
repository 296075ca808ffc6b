"""Registered queries: governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import governance as gov
from ..sources.catalog import MAPPINGS, REGISTRY, mapping_table, registry_table
from ..sources.refdata import sql_values
from .registry import case

# every table that the package derives, under its registered name: layer and source
TABLES = {
    "unified_transactions": ("SILVER", "txn"), "party": ("IDENTITY", "party"), "party_account": ("IDENTITY", "party_account"),
    "party_address": ("IDENTITY", "party_address"), "party_account_rail_ref": ("IDENTITY", "party_account_rail_ref"),
    "party_relationship": ("IDENTITY", "party_relationship"), "party_resolution_event": ("IDENTITY", "party_event"),
    "biller_registry": ("IDENTITY", "biller_registry"), "on_us_institutions": ("REFERENCE", "on_us_institutions"),
    **{f"raw_{rail}": ("RAW", f"raw_{rail}") for rail in ("ach", "wire", "card", "zelle", "rtp_fednow", "check_rdc", "billpay")},
}
NAMES = " ".join(source for _, source in TABLES.values())


def flag(listed) -> str:
    return f"column_name IN ({', '.join(repr(c) for c in listed)})"


# the checking engine lists the columns of each table itself
CATALOG = "c AS (" + " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, (SELECT count(*) FROM {source}) AS row_count, column_name, CAST(row_number() OVER () AS INTEGER) AS ordinal, "
    f"{flag(gov.PCI_COLUMNS)} AS is_pci, {flag(gov.PII_COLUMNS)} AS is_pii, {flag(gov.PARTITION_COLUMNS)} AS is_partition, filled_count "
    f"FROM (UNPIVOT (SELECT count(COLUMNS(*)) AS '\\0' FROM {source}) ON COLUMNS(*) INTO NAME column_name VALUE filled_count) u_{source}"
    for name, (layer, source) in TABLES.items()) + ")"
MAP = f"m(payment_type, source_field, target_table, target_field, kind, sensitivity, ir_role, ir_priority, is_on_us_indicator) AS (VALUES {sql_values(MAPPINGS).replace('NONE', 'NULL')})"


def _catalog(t):
    return gov.build_catalog({name: (layer, getattr(t, source)) for name, (layer, source) in TABLES.items()})


@case("build_catalog", NAMES, f"WITH {CATALOG} SELECT * FROM c")
def _(t):
    return _catalog(t).drop("data_type")


@case("sensitivity_report", NAMES, f"""WITH {CATALOG} SELECT layer, count(*) AS column_count, count(*) FILTER (is_pci) AS pci_columns, count(*) FILTER (is_pii) AS pii_columns,
  CAST(sum(CASE WHEN is_pci OR is_pii THEN filled_count ELSE 0 END) AS BIGINT) AS sensitive_values FROM c GROUP BY 1""")
def _(t):
    return gov.sensitivity_report(_catalog(t))


SCANNED = [("documents", "text"), ("pages", "html"), ("conversations", "text")]


@case("scan_leaks", "", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{col}' AS column_name, '{kind}' AS leak_kind, count(*) FILTER (regexp_matches({col}, '{pattern}')) AS row_count FROM {table}"
    for table, col in SCANNED for kind, pattern in gov.LEAK_PATTERNS.items()))
def _(t):
    parts = [gov.scan_leaks(getattr(t, table), [col]).withColumn("table_name", F.lit(table)) for table, col in SCANNED]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@case("lineage", NAMES, f"""WITH {CATALOG}, {MAP} SELECT column_name, filled_count FROM c WHERE table_name = 'unified_transactions'
  AND column_name NOT IN (SELECT target_field FROM m WHERE target_table = 'unified_transactions')""")
def _(t):
    return gov.lineage(mapping_table(t.spark), _catalog(t))


@case("ir_fields", NAMES, f"""WITH {CATALOG}, {MAP}
SELECT m.payment_type, m.source_field, m.target_field, m.ir_role, CAST(m.ir_priority AS INTEGER) AS ir_priority, m.is_on_us_indicator, c.filled_count
FROM m LEFT JOIN c ON c.table_name = m.target_table AND c.column_name = m.target_field WHERE m.ir_role IS NOT NULL OR m.is_on_us_indicator""")
def _(t):
    return gov.ir_fields(mapping_table(t.spark), _catalog(t))


@case("registry_check", NAMES, f"""WITH {CATALOG}, r(table_name, layer) AS (VALUES {sql_values(REGISTRY)}), a AS (SELECT table_name, max(row_count) AS row_count FROM c GROUP BY 1)
SELECT coalesce(r.table_name, a.table_name) AS table_name, CASE WHEN r.table_name IS NULL THEN 'UNREGISTERED' WHEN a.table_name IS NULL THEN 'MISSING' ELSE 'OK' END AS state, a.row_count
FROM r FULL OUTER JOIN a ON a.table_name = r.table_name""")
def _(t):
    return gov.registry_check(registry_table(t.spark), _catalog(t))


@case("cross_tenant", "txn party", """WITH u AS (SELECT tenant_id, 'ORIGINATOR' AS party_role, originator_party_id AS pid FROM txn UNION ALL SELECT tenant_id, 'BENEFICIARY', beneficiary_party_id FROM txn)
SELECT u.tenant_id, p.tenant_id AS party_tenant_id, party_role, count(*) AS row_count, count(DISTINCT pid) AS party_count FROM u JOIN party p ON p.party_id = u.pid
WHERE u.tenant_id <> p.tenant_id GROUP BY 1, 2, 3""")
def _(t):
    return gov.cross_tenant(t.txn, t.party)
