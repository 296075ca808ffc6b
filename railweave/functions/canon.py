"""Canonical spellings: direction, status, dates, flags and amounts as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: source spellings of the two directions
INBOUND_WORDS = ("INBOUND", "RECEIVE", "CREDIT", "DEPOSIT", "CR")
OUTBOUND_WORDS = ("OUTBOUND", "SEND", "DEBIT", "PRESENTED_CHECK", "DR")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def canon_direction(value: Column | str) -> Column:
    word = F.upper(F.trim(_col(value)))
    return F.when(word.isin(*INBOUND_WORDS), "INBOUND").when(word.isin(*OUTBOUND_WORDS), "OUTBOUND")


def canon_status(value: Column | str) -> Column:
    """Source codes to lifecycle status; canonical names pass through."""
    code = F.upper(F.trim(_col(value)))
    return (F.when(code == "00", "SETTLED").when(code == "01", "PENDING")
            .when(code.rlike("^R[0-9]"), "RETURNED").otherwise(code))


def parse_yymmdd(value: Column | str) -> Column:
    """Six-digit dates of this century; anything else is NULL."""
    return F.try_to_date(F.concat(F.lit("20"), _col(value)), "yyyyMMdd")


def abs_amount(value: Column | str) -> Column:
    return F.abs(_col(value))


def yes_no(value: Column | str) -> Column:
    return F.when(_col(value) == "Y", True).when(_col(value) == "N", False)


def credit_debit(value: Column | str) -> Column:
    return F.when(_col(value).isin("CR", "Credit", "CREDIT"), "CREDIT").when(
        _col(value).isin("DR", "Debit", "DEBIT"), "DEBIT")


def charges_code(value: Column | str) -> Column:
    """Who bears wire charges: rail wording to the SWIFT code."""
    return F.when(_col(value) == "SENDER", "OUR").when(_col(value) == "RECEIVER", "BEN").when(
        _col(value) == "SHARED", "SHA")


def biller_category(value: Column | str) -> Column:
    """Rail spelling to registry spelling."""
    return F.when(_col(value) == "UTILITY", "UTILITIES").when(
        _col(value) == "TELECOMMUNICATIONS", "TELECOM").otherwise(_col(value))


def frequency(value: Column | str) -> Column:
    return F.when(_col(value) == "ANNUAL", "ANNUALLY").otherwise(_col(value))
