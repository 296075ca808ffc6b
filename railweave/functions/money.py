"""Column helpers shared by aggregates: settled value, direction tests, ratios."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def settled() -> Column:
    """Value in settlement currency: domestic rows carry it in ``amount``."""
    return F.coalesce(F.col("settlement_amount"), F.col("amount"))


def is_inflow(col: str = "direction") -> Column:
    return F.col(col).isin("INBOUND", "CREDIT")


def is_outflow(col: str = "direction") -> Column:
    return F.col(col).isin("OUTBOUND", "DEBIT")


def sum_if(cond: Column, value: Column | str) -> Column:
    """Sum of ``value`` where ``cond``, zero when no row qualifies."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(cond, value).otherwise(F.lit(0).cast(MONEY)))


def mean(value: Column | str) -> Column:
    """Exact decimal sum over count, as double: independent of row order."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def period_date(ts: str = "transaction_ts") -> Column:
    return F.to_date(ts)


def months_before(day: dt.date, months: int) -> dt.date:
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    for last in (day.day, 30, 29, 28):
        try:
            return dt.date(year, month + 1, last)
        except ValueError:
            continue
    raise ValueError(day)


def recent(as_of: dt.date, days: int | None = None, months: int | None = None,
           ts: str = "transaction_ts") -> Column:
    """Rows dated in the trailing window that ends on ``as_of``.

    The bounds are literals on the bare timestamp column, so they reach the scan.
    """
    first = as_of - dt.timedelta(days=days) if days is not None else months_before(as_of, months or 0)
    after = as_of + dt.timedelta(days=1)
    return (F.col(ts) >= F.lit(first).cast("timestamp")) & (F.col(ts) < F.lit(after).cast("timestamp"))
