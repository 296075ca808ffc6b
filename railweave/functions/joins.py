"""Left joins whose keys may be missing in most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_null(key: str, row_id: str) -> Column:
    """A text key with every NULL replaced by a value of its own.

    An outer join sends all NULL keys to one task although none can match; spread over
    row ids they travel evenly.  The marker cannot occur in stored keys.
    """
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col(row_id)))


def left_lookup(rows: DataFrame, look: DataFrame, keys: list[str], row_id: str = "transaction_id") -> DataFrame:
    """``rows`` LEFT JOIN ``look`` on text ``keys``; ``look`` has one row per key."""
    spread = rows.withColumns({f"_k_{k}": spread_null(k, row_id) for k in keys})
    right = look.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return spread.join(right, [f"_k_{k}" for k in keys], "left").drop(*[f"_k_{k}" for k in keys])
