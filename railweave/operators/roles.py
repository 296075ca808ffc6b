"""Facts seen from each party's side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLE_FIELDS = ("party_id", "account_id", "account_token", "routing_number", "block_key", "match_rule",
               "resolution_status", "resolution_confidence", "last4", "proxy_token", "name_token")


def to_role_rows(txn: DataFrame) -> DataFrame:
    """One row per (transaction, role) from a single scan.

    Role columns lose their ``originator_``/``beneficiary_`` prefix; all others stay.
    """
    have = [f for f in ROLE_FIELDS if f"originator_{f}" in txn.columns and f"beneficiary_{f}" in txn.columns]
    keep = [c for c in txn.columns
            if not any(c in (f"originator_{f}", f"beneficiary_{f}") for f in have)]

    def side(role: str):
        return F.struct(F.lit(role.upper()).alias("party_role"), *[F.col(f"{role}_{f}").alias(f) for f in have])

    return txn.select(*keep, F.explode(F.array(side("originator"), side("beneficiary"))).alias("_role")).select(
        *keep, "_role.*")
