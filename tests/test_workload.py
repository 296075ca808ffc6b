"""Registered queries against their SQL on the smallest given tables."""

import pytest

import check
from railweave import workload
from railweave.workload import registry

SMALL = "/root/testdata/sf0.001"
# one or more of each family; ``python tests/check.py`` runs all of them
SAMPLE = """
monthly_flow net_pivot sankey_graph rail_share return_rates settlement_latency
gold_by_payment_type gold_party_activity rollup_gold write_silver write_gold
read_raw_card normalize_card normalize_billpay raw_to_daily_flow upgrade_rail_json apply_mapping
latest_changes latest_changes_agg merge_cdc_interleaved merge_cdc_incremental merge_audit status_history
check_fx check_identity attach_dq_flags validate_rail_json validate_rail_json_v1
resolve mark_identity_resolved survivor dup_parties
link_returns link_rfp ubo_closure hierarchy party_groups graph_nodes
velocity rail_switches amount_z rfm feature_table scan_leaks lineage
start_cdc dedup_stream stream_sessions stream_expiry start_dq
""".split()
# nothing qualifies at this size
MAY_BE_EMPTY = {"link_rfp", "stream_expiry", "link_returns"}


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, name):
    con = check.connect(SMALL)
    said = check.compare(spark, con, SMALL, name)
    assert said == "" or (said == "no rows" and name in MAY_BE_EMPTY), said


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.ORACLES)
    assert len(workload.QUERIES) >= 180


def test_hot_and_ordinary_keys_both_occur(spark):
    """The feature checks must run keys cut into slots as well as whole keys."""
    from railweave.functions.timeline import hot_keys
    from railweave.plans.features import PARTY
    from railweave.workload.feature_cases import SLOTS

    rows = registry.Tables(spark, "/root/testdata/sf0.01").activity
    hot = hot_keys(rows, PARTY, SLOTS["hot_rows"]).count()
    everyone = rows.select(*PARTY).distinct().count()
    assert 0 < hot < everyone
