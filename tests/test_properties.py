"""Properties and small literal cases that a comparison of two engines cannot show."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from railweave.functions import canon
from railweave.functions.timeline import Frame, neighbour, ntile, ordered_rank, trailing
from railweave.operators import cdc, gold, graph, identity, onus
from railweave.operators.normalize import derive_fx
from railweave.plans import flows
from railweave.sources import refdata, storage
from railweave.sources.catalog import MAPPINGS, REGISTRY
from railweave.workload import registry

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def txn(spark):
    return registry.Tables(spark, SMALL).txn


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_reference_sizes():
    assert [len(x) for x in (refdata.PAYMENT_TYPES, refdata.STATUS_CODES, refdata.RETURN_CODES, refdata.DIRECTIONS)] == [9, 15, 30, 2]
    assert (len(MAPPINGS), len(REGISTRY)) == (38, 31)


def test_canonical_spellings(spark):
    df = spark.createDataFrame([("00", "SEND", "010203"), ("R05", "CREDIT", "999999"), ("HELD", "?", None)], "s string, d string, y string")
    got = df.select(canon.canon_status("s"), canon.canon_direction("d"), canon.parse_yymmdd("y")).collect()
    assert [tuple(r) for r in got] == [("SETTLED", "OUTBOUND", dt.date(2001, 2, 3)), ("RETURNED", "INBOUND", None), ("HELD", None, None)]


def test_merge_twice_equals_once(txn):
    target = cdc.latest_changes(txn.filter("_cdc_timestamp < timestamp'1999-01-01 00:00:00'")).filter("_cdc_operation <> 'D'")
    batch = txn.filter("_cdc_timestamp >= timestamp'1999-01-01 00:00:00'")
    show = ["source_transaction_id", "event_id"]
    once = cdc.merge_cdc(target, batch)
    assert rows(once.select(*show)) == rows(cdc.merge_cdc(once, batch).select(*show))


def test_dedup_ignores_input_order(txn):
    shuffled = txn.orderBy(F.rand(7))
    show = ["source_transaction_id", "event_id"]
    assert rows(cdc.latest_changes(txn).select(*show)) == rows(cdc.latest_changes(shuffled).select(*show)) == rows(
        cdc.latest_changes_agg(txn).select(*show))


def test_remembered_delete_keeps_older_insert_out(txn):
    deletes = cdc.tombstones(txn)
    older = txn.filter("_cdc_operation <> 'D'")
    empty = older.limit(0)
    kept = cdc.merge_cdc(empty, older, guard_deletes=True, graves=deletes)
    dead = deletes.select(*cdc.KEY)
    newer = cdc.latest_changes(txn).filter("_cdc_operation = 'D'").select(*cdc.KEY)
    assert kept.join(newer, cdc.KEY, "left_semi").count() == 0 and dead.count() > 0


def test_gold_adds_up(txn):
    daily = gold.gold_by_payment_type(txn).agg(
        F.sum("total_amount"), F.sum("inbound_amount") + F.sum("outbound_amount"), F.sum("txn_count")).first()
    whole = txn.agg(F.sum("amount"), F.count("*")).first()
    assert daily[0] == daily[1] == whole[0] and daily[2] == whole[1]


def test_one_decision_per_role(spark):
    t = registry.Tables(spark, SMALL)
    queue = identity.open_roles(t.ir_queue)
    done = identity.resolve(queue, t.party, t.party_account)
    assert done.count() == queue.count() == done.select("transaction_id", "party_role").distinct().count()


def test_shared_key_makes_candidate_with_lowest_account(spark):
    queue = spark.createDataFrame([("x", "T", "ORIGINATOR", "tok", None, None, None, None)],
                                  "transaction_id string, tenant_id string, party_role string, account_token string, routing_number string, last4 string, proxy_token string, name_token string")
    accounts = spark.createDataFrame([("T", "A2", "P2", "tok"), ("T", "A1", "P1", "tok"), ("U", "A0", "P0", "tok")],
                                     "tenant_id string, account_id string, party_id string, account_number_token string").withColumns(
        {c: F.lit(None).cast("string") for c in ("institution_routing_number", "card_last_four", "proxy_value_token")})
    parties = spark.createDataFrame([("P1", "n")], "party_id string, name_token string")
    got = identity.resolve(queue, parties, accounts).first()
    assert (got.match_rule, got.account_id, got.party_id, got.resolution_status) == ("EXACT_TOKEN", "A1", "P1", "CANDIDATE")


def test_survivor_chains_and_cycles(spark):
    links = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("x", "y"), ("y", "x"), ("z", "x")]
    df = spark.createDataFrame(links + [("e", None)], "party_id string, merged_into_party_id string")
    got = {r.party_id: (r.survivor_party_id, r.in_cycle) for r in identity.survivor(df).collect()}
    assert got == {**{k: ("e", False) for k in "abcd"}, "x": ("x", True), "y": ("y", True), "z": ("z", True)}


def test_components_match_union_find(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(500, k) for k in range(501, 540)] + [(k, k + 1) for k in range(600, 640)]
    rel = spark.createDataFrame([(f"{a:04d}", f"{b:04d}", "JOINT_ACCOUNT") for a, b in pairs], "party_id_a string, party_id_b string, relationship_type string")
    parent = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for a, b in pairs:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    linked = {v for a, b in pairs if a != b for v in (a, b)}
    expect = {f"{v:04d}": f"{find(v):04d}" for v in linked}
    assert {r.party_id: r.group_id for r in graph.party_groups(rel).collect()} == expect


def test_ownership_sums_paths_and_stops_at_cycles(spark):
    edges = [("m", "o", 50.0), ("n", "o", 40.0), ("t", "m", 50.0), ("t", "n", 100.0), ("o", "t", 10.0)]
    rel = spark.createDataFrame([(a, b, p, "BENEFICIAL_OWNER") for a, b, p in edges], "party_id_a string, party_id_b string, ownership_percentage double, relationship_type string")
    got = {(r.owner, r.entity): (round(r.effective_share, 6), r.path_count) for r in graph.ubo_closure(rel).collect()}
    assert got[("o", "t")] == (0.65, 2) and ("o", "o") not in got


@pytest.mark.parametrize("hot_rows, n_slots", [(0, 2), (0, 40), (10, 7), (10_000, 256)])
def test_trailing_and_neighbour_match_brute_force(spark, hot_rows, n_slots):
    rng = random.Random(hot_rows)
    data = [(i, rng.choice("aab"), rng.randrange(40) * 3600 * 12, rng.randrange(100)) for i in range(150)]
    df = spark.createDataFrame(data, "id int, k string, s long, v int").withColumn("ts", F.timestamp_seconds("s"))
    slots = {"hot_rows": hot_rows, "slots": n_slots}  # equal-count slots of any number give the same answer
    frames = {"open": Frame("v", 86_400, closed=False), "closed": Frame("v", 86_400), "prior": Frame("v", 5 * 86_400, now=False)}
    got = {r.id: (r.open, r.closed, r.prior) for r in trailing(df, ["k"], "id", "ts", {"v": F.col("v")}, frames, **slots).collect()}
    near = {r.id: (r.prev_v, r.next_v) for r in neighbour(neighbour(df, ["k"], ["ts", "id"], ["v"], **slots), ["k"], ["ts", "id"], ["v"], following=True, **slots).collect()}
    for i, k, s, _ in data:
        mine = [(t, w) for _, q, t, w in data if q == k]
        assert got[i] == (sum(w for t, w in mine if s - 86_400 < t <= s), sum(w for t, w in mine if s - 86_400 <= t <= s),
                          sum(w for t, w in mine if s - 5 * 86_400 <= t < s))
        order = sorted((t, j, w) for j, q, t, w in data if q == k)
        at = next(n for n, (_, j, _) in enumerate(order) if j == i)
        assert near[i] == (order[at - 1][2] if at else None, order[at + 1][2] if at + 1 < len(order) else None)


def test_ordered_rank_matches_row_number(spark):
    df = spark.range(137).select((F.col("id") % 2).cast("string").alias("g"), (F.col("id") % 5).alias("v"), "id")
    got = ordered_rank(df, "g", [F.asc("v"), F.asc("id")]).withColumn("q", ntile(F.col("rank"), F.col("rank_of"), 5))
    from pyspark.sql import Window
    w = Window.partitionBy("g").orderBy("v", "id")
    expect = df.withColumn("rank", F.row_number().over(w)).withColumn("q", F.ntile(5).over(w))
    assert rows(got.select("id", "rank", "q")) == rows(expect.select("id", "rank", "q"))


def test_on_us_is_three_valued(spark):
    df = spark.createDataFrame([("T1", "T1", None, None), ("T1", "T2", "r", "r"), (None, "T2", "r", "r"), (None, None, "r", None)],
                               "originator_tenant_id string, beneficiary_tenant_id string, originator_routing_number string, beneficiary_routing_number string")
    assert [r[0] for r in df.select(onus.on_us_flag()).collect()] == [True, False, True, None]


def test_same_currency_has_no_fx(spark):
    df = spark.createDataFrame([(10.0, "USD", 10.0, "USD"), (10.0, "EUR", 12.5, "USD")], "amount double, currency_code string, settlement_amount double, settlement_currency_code string")
    got = derive_fx(df.withColumn("fx_rate", F.lit(None).cast("decimal(18,8)"))).select("original_currency_code", "fx_rate_source").collect()
    assert [tuple(r) for r in got] == [(None, None), ("EUR", "DERIVED")]


def test_sankey_sample_totals(spark):
    # fixed values: first sample quarter, in thousands
    sample = {"ACH": (184200, 162800), "WIRE": (890500, 940200), "CARD": (12100, 98400), "ZELLE": (34600, 31200),
              "RTP": (22900, 18700), "FEDNOW": (15400, 12100), "CHECK": (44300, 38600), "BILLPAY": (3200, 28900)}
    df = spark.createDataFrame([("Q1 2026", rail, way, total * 1000) for rail, pair in sample.items() for way, total in zip(("CREDIT", "DEBIT"), pair)],
                               "period string, payment_type string, direction string, total long").withColumn("total", F.col("total").cast("decimal(18,2)"))
    kpi = flows.flow_kpis(df).first()
    assert (kpi.total_in, kpi.total_out, kpi.net) == (1_207_200_000, 1_330_900_000, -123_700_000)
    assert flows.sankey_nodes(df).count() == 10 and flows.sankey_links(df).count() == 16


def test_unbounded_scan_is_refused(txn):
    with pytest.raises(ValueError):
        storage.scan_silver(txn, None, None)
    with pytest.raises(ValueError):
        storage.tenant_scan(txn, "")


def test_address_counts_with_the_name_only_when_asked(spark):
    parties = spark.createDataFrame([("t", "p1", "n1", None), ("t", "p2", "n1", None), ("t", "p3", "n2", None), ("t", "p4", None, None)],
                                    "tenant_id string, party_id string, name_token string, tax_id_token string")
    addresses = spark.createDataFrame([("p1", "a"), ("p2", "a"), ("p3", "a"), ("p4", "a"), ("p1", "b")], "party_id string, address_line1_token string")
    loose = rows(identity.dup_parties(parties, addresses))
    named = rows(identity.dup_parties(parties, addresses, address_needs_name=True))
    assert loose == [("t", "ADDRESS", "p1", "p2", 4), ("t", "ADDRESS", "p1", "p3", 4), ("t", "ADDRESS", "p1", "p4", 4)]
    assert named == [("t", "NAME_ADDRESS", "p1", "p2", 2)]
