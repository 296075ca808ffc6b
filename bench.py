"""Seconds per headline query; prints one JSON line.

Derived payments tables are stored once first (``prepare_sec``), as a deployment would
hold them; each query then runs twice to a discarding sink: ``queries`` is the first run,
``warm`` the second.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

from railweave import workload  # noqa: F401  (registers the queries)
from railweave.session import build_session
from railweave.workload import registry

HEADLINE = """
monthly_flow net_pivot sankey_graph return_rates settlement_latency exposure top_k
gold_by_payment_type gold_cross_rail gold_party_activity gold_biller_volume rollup_gold
raw_to_daily_flow derive_on_us latest_changes latest_changes_agg merge_cdc merge_audit status_history
attach_dq_flags validate_rail_json dq_scorecard transactions_with_parties resolve mark_identity_resolved
graph_edges graph_nodes party_groups ubo_closure link_returns velocity amount_z feature_table rfm scan_leaks
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    folder = tempfile.mkdtemp(prefix="railweave-bench-")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g", "spark.checkpoint.dir": f"{folder}/checkpoint"})
    spark.sparkContext.setLogLevel("ERROR")
    tables = registry.StoredTables(spark, sf_dir, f"{folder}/tables")

    def once(name: str) -> float:
        began = time.perf_counter()
        registry.portable(registry.BODIES[name](tables)).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    began = time.perf_counter()
    for name in ("txn", "dirty", "party", "party_account", "party_relationship", "ir_queue", "activity", "activity_party", "on_us_institutions",
                 "biller_registry", "raw_ach", "raw_wire", "raw_card", "raw_zelle", "raw_rtp_fednow", "raw_check_rdc", "raw_billpay"):
        getattr(tables, name)
    prepare = round(time.perf_counter() - began, 3)
    first, warm = {}, {}
    for name in names:
        first[name] = once(name)
        warm[name] = once(name)
        print(name, first[name], warm[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total_first_run", "value": round(sum(first.values()), 3), "unit": "sec", "queries": first, "warm": warm,
        "warm_total": round(sum(warm.values()), 3), "prepare_sec": prepare, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus),
        "spark": spark.version}))
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)


if __name__ == "__main__":
    main()
