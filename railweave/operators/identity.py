"""Identity resolution: block keys, ordered match rules, write-back and party maintenance.

Each rule is an equi-join against accounts reduced to one row per match key, so a key
shared by many accounts yields one candidate with a count instead of many pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import left_lookup
from ..sources.refdata import MATCH_RULES
from .graph import follow
from .roles import to_role_rows

CONFIDENCE = dict(MATCH_RULES)


def ir_queue(silver: DataFrame) -> DataFrame:
    """Rows with an unresolved side; never-processed first, then oldest."""
    waiting = (F.col("originator_resolution_status") == "UNRESOLVED") | (F.col("beneficiary_resolution_status") == "UNRESOLVED")
    return silver.filter(waiting).orderBy(F.asc_nulls_first("identity_resolution_hook_ts"), F.asc("transaction_ts"), "transaction_id")


def open_roles(silver: DataFrame) -> DataFrame:
    """Unresolved (transaction, role) rows."""
    return to_role_rows(silver).filter(F.col("resolution_status") == "UNRESOLVED")


def block_keys(df: DataFrame) -> DataFrame:
    """The blocking key of each row: routing, else hashed proxy, else token prefix."""
    proxy = F.concat(F.lit("proxy:hash:"), F.sha2(F.col("proxy_token"), 256))
    return df.withColumn("block_key", F.coalesce(
        F.concat(F.lit("routing:"), F.col("routing_number")), proxy,
        F.concat(F.lit("account_prefix:"), F.substring("account_token", 1, 8))))


def _keyed(accounts: DataFrame, keys: dict[str, Column], rule: str) -> DataFrame:
    """One candidate per key: the lowest account id and how many accounts share the key."""
    rows = accounts.select("tenant_id", *[c.alias(k) for k, c in keys.items()], "account_id", "party_id")
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    return rows.groupBy("tenant_id", *keys).agg(
        F.struct(F.min(F.struct("account_id", "party_id")).alias("best"), F.count("*").alias("shared")).alias(rule))


def match_exact(queue: DataFrame, accounts: DataFrame) -> DataFrame:
    return left_lookup(queue, _keyed(accounts, {"account_token": F.col("account_number_token")}, "EXACT_TOKEN"), ["tenant_id", "account_token"])


def match_routing(queue: DataFrame, accounts: DataFrame) -> DataFrame:
    keys = {"routing_number": F.col("institution_routing_number"), "last4": F.col("card_last_four")}
    return left_lookup(queue, _keyed(accounts, keys, "ROUTING_ACCOUNT"), ["tenant_id", *keys])


def match_proxy(queue: DataFrame, accounts: DataFrame) -> DataFrame:
    return left_lookup(queue, _keyed(accounts, {"proxy_token": F.col("proxy_value_token")}, "PROXY_EXACT"), ["tenant_id", "proxy_token"])


def match_name(queue: DataFrame, parties: DataFrame, accounts: DataFrame) -> DataFrame:
    named = accounts.join(parties.select("party_id", "name_token"), "party_id")
    keys = {"name_token": F.col("name_token"), "routing_number": F.col("institution_routing_number")}
    return left_lookup(queue, _keyed(named, keys, "NAME_ROUTING"), ["tenant_id", *keys])


def new_party_id(tenant: str = "tenant_id", token: str = "account_token") -> Column:
    """Deterministic id, so that a rerun mints the same party; without a token there is none."""
    return F.concat(F.lit("N"), F.sha2(F.concat(F.col(tenant), F.lit("|"), F.col(token)), 256))


def resolve(queue: DataFrame, parties: DataFrame, accounts: DataFrame) -> DataFrame:
    """First rule that matches wins; a key shared by several accounts only makes a candidate.

    An unmatched token mints a party that is still to be confirmed; a row without match and
    token stays as it is, without party and rule.
    """
    rows = match_name(match_proxy(match_routing(match_exact(block_keys(queue), accounts), accounts), accounts), parties, accounts)
    rules = [r for r in CONFIDENCE if r != "NEW_PARTY"]
    hit = F.coalesce(*rules)
    rule = F.coalesce(*[F.when(F.col(r).isNotNull(), F.lit(r)) for r in rules], F.when(F.col("account_token").isNotNull(), "NEW_PARTY"))
    score = F.coalesce(*[F.when(F.col("match_rule") == r, F.lit(s)) for r, s in CONFIDENCE.items()]).cast("decimal(5,4)")
    return rows.select(
        *[c for c in queue.columns if c not in ("party_id", "account_id", "match_rule", "block_key", "resolution_status", "resolution_confidence")],
        "block_key", rule.alias("match_rule"), hit["best"]["account_id"].alias("account_id"),
        F.coalesce(hit["best"]["party_id"], new_party_id()).alias("party_id"),
        F.when(hit.isNull(), "UNRESOLVED").when(hit["shared"] > 1, "CANDIDATE").otherwise("CONFIRMED").alias("resolution_status"),
    ).withColumn("resolution_confidence", score)


def mint_parties(resolved: DataFrame) -> DataFrame:
    """New parties for unmatched identifiers, one per tenant and token."""
    return resolved.filter(F.col("match_rule") == "NEW_PARTY").groupBy("tenant_id", "party_id").agg(
        F.count("*").alias("first_seen_rows"), F.lit("UNRESOLVED").alias("resolution_status"))


def resolution_events(resolved: DataFrame) -> DataFrame:
    """Audit row per decision with a snapshot of the compared fields.

    ``expected`` is the value of the chosen account or party: equal to the actual one where the
    rule compared that field, else unknown here.
    """
    rule = F.col("match_rule")
    compares = {"account_token": ["EXACT_TOKEN"], "routing_number": ["ROUTING_ACCOUNT", "NAME_ROUTING"], "last4": ["ROUTING_ACCOUNT"],
                "proxy_token": ["PROXY_EXACT"], "name_token": ["NAME_ROUTING"]}
    compared = F.to_json(F.struct(*[
        F.struct(F.when(rule.isin(*rules), F.col(field)).alias("expected"), F.col(field).alias("actual"), rule.isin(*rules).alias("match")).alias(field)
        for field, rules in compares.items()]))
    return resolved.filter(rule.isNotNull()).select(
        F.sha2(F.concat_ws("|", "transaction_id", "party_role"), 256).alias("resolution_event_id"), "tenant_id", "transaction_id", "party_role",
        F.col("party_id").alias("source_party_id"), F.when(rule != "NEW_PARTY", F.col("party_id")).alias("target_party_id"),
        F.when(rule == "NEW_PARTY", "NEW_PARTY").when(F.col("resolution_status") == "CANDIDATE", "MATCH_CANDIDATE").otherwise("MATCH_CONFIRMED").alias("event_type"),
        rule.alias("resolution_method"), "block_key", F.col("resolution_confidence").alias("confidence_score"), compared.alias("match_attributes"))


#: compared field -> (column of the queue row, column of the chosen account or its party)
EVIDENCE = {"token": ("account_token", "account_number_token"), "routing": ("routing_number", "institution_routing_number"),
            "last4": ("last4", "card_last_four"), "proxy": ("proxy_token", "proxy_value_token"), "name": ("name_token", "name_token")}


def resolution_evidence(resolved: DataFrame, parties: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per decision, what the row said (``actual_*``) beside what the chosen account and its
    party hold (``expected_*``), for every compared field whatever the rule compared.

    Only the narrow columns of accounts and parties are read; both are joined on their own
    keys, so a much-chosen account is one row on the small side.  A new party or an
    unresolved row has no chosen account: its expected values are null.
    """
    chosen = accounts.select("tenant_id", "account_id", *(F.col(a).alias(f"expected_{f}") for f, (_, a) in EVIDENCE.items() if a != "name_token"))
    named = parties.select("tenant_id", "party_id", F.col("name_token").alias("expected_name"))
    rows = resolved.filter(F.col("match_rule").isNotNull()).select(
        "tenant_id", "transaction_id", "party_role", F.col("match_rule").alias("resolution_method"), "account_id",
        F.when(F.col("match_rule") != "NEW_PARTY", F.col("party_id")).alias("_party"),
        *(F.col(q).alias(f"actual_{f}") for f, (q, _) in EVIDENCE.items()))
    joined = rows.join(chosen, ["tenant_id", "account_id"], "left").join(
        named.withColumnRenamed("party_id", "_party"), ["tenant_id", "_party"], "left")
    return joined.select("transaction_id", "party_role", "resolution_method", *(
        c for f in EVIDENCE for c in (F.col(f"expected_{f}"), F.col(f"actual_{f}"))))


WRITTEN = ("party_id", "account_id", "resolution_status", "resolution_confidence", "block_key", "match_rule")


def mark_identity_resolved(silver: DataFrame, resolved: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Write both roles' decisions back in one join and stamp the rows; open sides keep their values."""
    def side(role: str) -> Column:
        return F.max(F.when(F.col("party_role") == role.upper(), F.struct(*WRITTEN))).alias(f"_{role}")

    decided = resolved.groupBy("transaction_id").agg(side("originator"), side("beneficiary"))
    rows = silver.join(decided, "transaction_id", "left")
    out = {}
    for role in ("originator", "beneficiary"):
        for f in WRITTEN:
            name = f"{role}_{f}"
            old = F.col(name) if name in silver.columns else F.lit(None)
            out[name] = F.coalesce(F.col(f"_{role}.{f}"), old)
    touched = F.col("_originator").isNotNull() | F.col("_beneficiary").isNotNull()
    out["identity_resolution_hook_ts"] = F.when(touched, F.current_timestamp() if stamp is None else stamp).otherwise(
        F.col("identity_resolution_hook_ts"))
    return rows.withColumns(out).drop("_originator", "_beneficiary")


def survivor(parties: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Surviving party of every merged one; parties in or before a cycle keep their own id."""
    links = parties.filter(F.col("merged_into_party_id").isNotNull()).select(
        "party_id", F.col("merged_into_party_id").alias("to"))
    ends = follow(links.withColumn("steps", F.lit(1)), "party_id", "to", max_rounds)
    return ends.select("party_id", F.when(F.col("cyclic"), F.col("party_id")).otherwise(F.col("to")).alias("survivor_party_id"),
                       F.col("cyclic").alias("in_cycle"))


def apply_party_events(parties: DataFrame, events: DataFrame) -> DataFrame:
    """Party table after the newest MERGE, SPLIT or SUPERSEDED event of each party."""
    newest = events.filter(F.col("event_type").isin("MERGE", "SPLIT", "SUPERSEDED")).groupBy(F.col("source_party_id").alias("party_id")).agg(
        F.max_by(F.struct("event_type", "target_party_id"), F.struct("resolved_at", "resolution_event_id")).alias("e"))
    kind = F.col("e.event_type")
    return parties.join(newest, "party_id", "left").withColumns({
        "resolution_status": F.when(kind == "MERGE", "MERGED").when(kind == "SUPERSEDED", "SUPERSEDED").when(kind == "SPLIT", "CONFIRMED")
        .otherwise(F.col("resolution_status")),
        "merged_into_party_id": F.when(kind == "MERGE", F.col("e.target_party_id")).when(kind.isin("SPLIT", "SUPERSEDED"), F.lit(None))
        .otherwise(F.col("merged_into_party_id")),
        "is_active": F.when(kind.isin("MERGE", "SUPERSEDED"), False).when(kind == "SPLIT", True).otherwise(F.col("is_active")),
    }).drop("e")


def block_stats(accounts: DataFrame, top: int) -> DataFrame:
    """Largest routing blocks: the skew that matching has to carry."""
    return accounts.groupBy("tenant_id", F.concat(F.lit("routing:"), "institution_routing_number").alias("block_key")).agg(
        F.count("*").alias("account_count"), F.countDistinct("party_id").alias("party_count")).orderBy(
        F.desc("account_count"), "tenant_id", "block_key").limit(top)


def dup_parties(parties: DataFrame, addresses: DataFrame, address_needs_name: bool = False) -> DataFrame:
    """Likely duplicates: same tax token, or an address in common, within a tenant.

    With ``address_needs_name`` an address counts only together with the same name token
    (reason ``NAME_ADDRESS``); parties without a name never meet that way.  Every member
    points to the lowest id of its group, so a group of n gives n - 1 rows instead of all
    its pairs.
    """
    taxed = parties.select("tenant_id", "party_id", F.lit("TAX_TOKEN").alias("reason"), F.col("tax_id_token").alias("evidence"))
    if address_needs_name:
        reason = F.lit("NAME_ADDRESS")
        evidence = F.when(F.col("name_token").isNotNull() & F.col("address_line1_token").isNotNull(),
                          F.concat_ws("|", "name_token", "address_line1_token"))
    else:
        reason, evidence = F.lit("ADDRESS"), F.col("address_line1_token")
    located = parties.select("tenant_id", "party_id", "name_token").join(addresses.select("party_id", "address_line1_token").distinct(), "party_id").select(
        "tenant_id", "party_id", reason.alias("reason"), evidence.alias("evidence")).distinct()
    rows = taxed.unionByName(located).filter("evidence is not null")
    lowest = rows.groupBy("tenant_id", "reason", "evidence").agg(F.min("party_id").alias("keep_party_id"), F.count("*").alias("group_size")).filter("group_size > 1")
    return rows.join(lowest, ["tenant_id", "reason", "evidence"]).filter("party_id <> keep_party_id").select(
        "tenant_id", "reason", "keep_party_id", F.col("party_id").alias("duplicate_party_id"), "group_size")
