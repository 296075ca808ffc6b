"""Data quality: row rules, keys, references, flags, quarantine and scorecards.

A rule is a named condition that is true for a broken row; as in SQL constraints, an
unknown condition passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.refdata import DIRECTIONS, PAYMENT_TYPES, ref_tables
from ..sources.schemas import REQUIRED_SILVER
from .normalize import promoted_description, promoted_recurring, promoted_return_code

Rules = dict[str, Column]

# fixed values: closed vocabularies
TYPES = [code for code, *_ in PAYMENT_TYPES]
WAYS = [code for code, _ in DIRECTIONS]
OPERATIONS = ["I", "U", "D"]
RESOLUTION = ["UNRESOLVED", "CANDIDATE", "CONFIRMED", "MERGED", "SUPERSEDED"]


def _outside(column: str, allowed: list[str]) -> Column:
    return ~F.col(column).isin(*allowed)


def not_null_rules() -> Rules:
    return {f"null:{c}": F.col(c).isNull() for c in REQUIRED_SILVER}


def domain_rules() -> Rules:
    return {"domain:payment_type": _outside("payment_type", TYPES), "domain:direction": _outside("direction", WAYS),
            "domain:_cdc_operation": _outside("_cdc_operation", OPERATIONS)}


def currency_rules() -> Rules:
    return {"currency:case": F.col("currency_code") != F.upper("currency_code")}


def amount_rules() -> Rules:
    return {"amount:negative": F.col("amount") < 0}


def json_object_rules() -> Rules:
    """Text that is not a JSON object: an object casts to a map of variants, anything else (array,
    scalar, JSON null, text that does not parse) does not; no schema of the document is built."""
    as_map = F.try_variant_get(F.try_parse_json("rail_details_json"), "$", "map<string,variant>")
    return {"json:not_object": F.col("rail_details_json").isNotNull() & as_map.isNull()}


def resolution_rules() -> Rules:
    return {f"domain:{side}_resolution_status": _outside(f"{side}_resolution_status", RESOLUTION)
            for side in ("originator", "beneficiary")}


def fx_rules() -> Rules:
    """A rate needs an original side in another currency; the four FX columns come together."""
    core = ["original_currency_code", "original_amount", "fx_rate", "fx_rate_source"]
    filled = sum((F.col(c).isNotNull().cast("int") for c in core), F.lit(0))
    sound = (F.col("original_currency_code").isNotNull() & F.col("original_amount").isNotNull()
             & (F.col("original_currency_code") != F.col("settlement_currency_code")))
    return {"fx:inconsistent": F.col("fx_rate").isNotNull() & ~sound, "fx:partial": ~filled.isin(0, 4)}


def timeline_rules() -> Rules:
    c = F.col
    return {"time:acknowledged_before_submitted": c("acknowledged_ts") < c("submitted_ts"),
            "time:settled_before_acknowledged": c("settled_ts") < c("acknowledged_ts"),
            "time:settlement_before_effective": c("settlement_date") < c("effective_date")}


def promotion_rules() -> Rules:
    """Promoted columns repeat their JSON source."""
    def differs(column: str, source: Column) -> Column:
        return source.isNotNull() & ~F.col(column).eqNullSafe(source)

    return {"promotion:description": differs("description", promoted_description()),
            "promotion:return_reason_code": differs("return_reason_code", promoted_return_code()),
            "promotion:is_recurring": F.when(F.col("payment_type") == "BILLPAY", differs("is_recurring", promoted_recurring()))}


def silver_rules() -> Rules:
    return {**not_null_rules(), **domain_rules(), **currency_rules(), **amount_rules(), **json_object_rules(),
            **resolution_rules(), **fx_rules()}


# fixed values: keys that the first JSON contract wants per rail
FIRST_CONTRACT_KEYS = {
    "ACH": ["trace_number", "entry_class_code", "transaction_type"],
    "WIRE": ["wire_reference_number"],
    "CARD": ["card_brand", "transaction_type"],
    "ZELLE": ["request_id"],
    "RTP": ["network_type", "instant_payment_id"],
    "FEDNOW": ["network_type", "instant_payment_id"],
    "CHECK": ["check_number"],
    "RDC": ["check_number"],
    "BILLPAY": ["confirmation_number"],
}


def rail_key_rules() -> Rules:
    keys = F.json_object_keys("rail_details_json")
    lacking = F.lit(None).cast("boolean")
    for rail, wanted in FIRST_CONTRACT_KEYS.items():
        missing = F.size(F.array_except(F.array(*[F.lit(k) for k in wanted]), F.coalesce(keys, F.array().cast("array<string>")))) > 0
        lacking = F.when(F.col("payment_type") == rail, missing).otherwise(lacking)
    return {"json:first_contract_keys": lacking}


def flags(rules: Rules) -> list[Column]:
    """Each rule's name where the rule is broken, else NULL."""
    return [F.when(broken, F.lit(name)) for name, broken in rules.items()]


def broken_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per (transaction, broken rule)."""
    return df.select("transaction_id", "tenant_id", "payment_type", F.explode(F.array(*flags(rules))).alias("flag")).filter(
        "flag is not null")


def check_not_null(df: DataFrame) -> DataFrame:
    return broken_rows(df, not_null_rules())


def check_domains(df: DataFrame) -> DataFrame:
    return broken_rows(df, domain_rules())


def check_currency(df: DataFrame) -> DataFrame:
    return broken_rows(df, currency_rules())


def check_amount(df: DataFrame) -> DataFrame:
    return broken_rows(df, amount_rules())


def check_json_object(df: DataFrame) -> DataFrame:
    return broken_rows(df, json_object_rules())


def check_resolution(df: DataFrame) -> DataFrame:
    return broken_rows(df, resolution_rules())


def check_fx(df: DataFrame) -> DataFrame:
    return broken_rows(df, fx_rules())


def check_rail_keys(df: DataFrame) -> DataFrame:
    return broken_rows(df, rail_key_rules())


def check_promotion(df: DataFrame) -> DataFrame:
    return broken_rows(df, promotion_rules())


def check_timeline(df: DataFrame) -> DataFrame:
    return broken_rows(df, timeline_rules())


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def check_fk(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Referenced keys without a parent; counted first, so a hot key is one row in the join."""
    used = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("missing_key")).agg(F.count("*").alias("reference_count"))
    return used.join(parent.select(F.col(pk).alias("missing_key")), "missing_key", "left_anti")


def check_ref(df: DataFrame, refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """Codes in use that the reference tables do not list, in one pass over the fact."""
    refs = refs or ref_tables(df.sparkSession)
    listed = {"payment_type": ("payment_types", "payment_type_code"), "status": ("status_codes", "status_code"),
              "direction": ("directions", "direction_code"), "return_reason_code": ("return_codes", "return_code")}
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("code")) for c in listed])
    used = (df.select(F.explode(pairs).alias("p")).select("p.*").filter("code is not null")
            .groupBy("column_name", "code").agg(F.count("*").alias("row_count")))
    known = None
    for column, (table, code) in listed.items():
        part = refs[table].select(F.lit(column).alias("column_name"), F.col(code).alias("code"))
        known = part if known is None else known.unionByName(part)
    return used.join(F.broadcast(known), ["column_name", "code"], "left_anti")  # the four fixed code lists


# fixed values: identity tables' checks
ACCOUNT_TYPES = ["CHECKING", "SAVINGS", "MONEY_MARKET", "LOAN", "CARD", "BILLER", "PREPAID", "WALLET", "TRUST", "UNKNOWN"]
IDENTITY_DOMAINS = {
    "party": {"party_type": ["INDIVIDUAL", "BUSINESS", "BILLER", "GOVERNMENT", "FINANCIAL_INSTITUTION"],
              "resolution_status": RESOLUTION},
    "party_account": {"account_type": ACCOUNT_TYPES, "account_status": ["ACTIVE", "CLOSED", "SUSPENDED", "BLOCKED", "UNKNOWN"],
                      "account_token_type": ["INTERNAL", "NETWORK", "ALIAS", "CARD_PAN", "BILLER_REF", "IBAN"]},
    "party_account_rail_ref": {"rail_type": TYPES},
    "party_address": {"address_type": ["MAILING", "LEGAL", "REGISTERED", "BILLING", "PHYSICAL", "CORRESPONDENT"]},
    "party_relationship": {"relationship_type": [
        "JOINT_ACCOUNT", "AUTHORIZED_SIGNER", "PARENT_SUBSIDIARY", "BENEFICIAL_OWNER", "TRUST_BENEFICIARY", "GUARANTOR",
        "POWER_OF_ATTORNEY", "CORRESPONDENT_BANK"]},
    "biller_registry": {"biller_category": [
        "UTILITIES", "TELECOM", "INSURANCE", "MORTGAGE", "AUTO_LOAN", "CREDIT_CARD", "GOVERNMENT", "HEALTHCARE", "SUBSCRIPTION", "OTHER"]},
    "party_event": {"event_type": ["MATCH_CANDIDATE", "MATCH_CONFIRMED", "MERGE", "SPLIT", "ALIAS_CREATED", "SUPERSEDED", "NEW_PARTY"],
                    "resolution_method": ["EXACT_TOKEN", "ROUTING_ACCOUNT", "PROXY_EXACT", "NAME_ROUTING", "MANUAL", "ADMIN_OVERRIDE", "NEW_PARTY"]},
}


def identity_rules(table: str) -> Rules:
    rules = {f"domain:{c}": _outside(c, allowed) for c, allowed in IDENTITY_DOMAINS[table].items()}
    if table == "party":
        rules["range:resolution_confidence"] = ~F.col("resolution_confidence").between(0, 1)
    if table == "party_relationship":
        rules["self_link"] = F.col("party_id_a") == F.col("party_id_b")
        rules["range:ownership_percentage"] = ~F.col("ownership_percentage").between(0, 100)
    return rules


def check_identity(tables: dict[str, DataFrame]) -> DataFrame:
    """Broken identity rules per table, one aggregate pass each."""
    out = None
    for name, df in tables.items():
        found = df.select(F.explode(F.array(*flags(identity_rules(name)))).alias("flag")).filter("flag is not null").groupBy("flag").agg(
            F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "flag", "row_count")
        out = found if out is None else out.unionByName(found)
    return out


def attach_dq_flags(df: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Add ``dq_flags_json``: a JSON array of broken rules, NULL for a clean row."""
    names = F.concat_ws('","', *flags(rules or silver_rules()))
    return df.withColumn("_flags", names).withColumn(
        "dq_flags_json", F.when(F.col("_flags") != "", F.concat(F.lit('["'), F.col("_flags"), F.lit('"]')))).drop("_flags")


def split_flagged(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return flagged.filter("dq_flags_json is null"), flagged.filter("dq_flags_json is not null")


def split_valid(df: DataFrame, rules: Rules | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean rows and rows for quarantine."""
    return split_flagged(attach_dq_flags(df, rules))


def dq_scorecard(df: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Pass rate per rule, tenant, rail and day; all rules are counted in the same aggregate."""
    rules = rules or silver_rules()
    names = list(rules)
    counts = df.groupBy("tenant_id", "payment_type", F.to_date("transaction_ts").alias("period_date")).agg(
        F.count("*").alias("row_count"), *[F.count_if(rules[n]).alias(f"_r{i}") for i, n in enumerate(names)])
    long = F.explode(F.array(*[F.struct(F.lit(n).alias("flag"), F.col(f"_r{i}").alias("broken_count")) for i, n in enumerate(names)]))
    return counts.select("tenant_id", "payment_type", "period_date", "row_count", long.alias("r")).select(
        "tenant_id", "payment_type", "period_date", "r.flag", "row_count", "r.broken_count",
        (F.lit(1.0) - F.col("r.broken_count").cast("double") / F.col("row_count").cast("double")).alias("pass_rate"))
