"""Registered queries: change data capture."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import cdc
from ..session import scratch_path
from ..sources import storage, versioned
from .registry import case

K = "tenant_id, source_system, source_transaction_id"
ORDER = "_cdc_timestamp DESC, _cdc_sequence_id DESC, ingestion_ts DESC, event_id DESC"
SHOW = ["tenant_id", "source_system", "source_transaction_id", "transaction_id", "status", "amount", "_cdc_operation", "_cdc_timestamp", "_cdc_sequence_id"]
SHOWN = ", ".join({"amount": "CAST(amount AS DOUBLE) AS amount", "_cdc_timestamp": "CAST(_cdc_timestamp AS VARCHAR) AS _cdc_timestamp"}.get(c, c) for c in SHOW)


def newest(source: str, where: str = "TRUE") -> str:
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY {ORDER}) AS rn FROM {source} WHERE {where}) z WHERE rn = 1"


CUT = "TIMESTAMP '1999-01-01 00:00:00'"
# two batches against a target: strictly later rows, and rows interleaved in time
SCENES = {
    "ordered": (f"_cdc_timestamp < {CUT}", f"_cdc_timestamp >= {CUT}"),
    "interleaved": ("CAST(_cdc_sequence_id AS BIGINT) % 2 = 0", "CAST(_cdc_sequence_id AS BIGINT) % 2 = 1"),
}


def sides(t, scene: str):
    before, after = SCENES[scene]
    target = cdc.latest_changes(t.txn.filter(before)).filter("_cdc_operation <> 'D'")
    return target, t.txn.filter(after)


def merged(scene: str, guard: bool = False) -> str:
    before, after = SCENES[scene]
    newer = "(s._cdc_timestamp > t._cdc_timestamp OR (s._cdc_timestamp = t._cdc_timestamp AND s._cdc_sequence_id > t._cdc_sequence_id))"
    match = "s.tenant_id = t.tenant_id AND s.source_system = t.source_system AND s.source_transaction_id = t.source_transaction_id"
    dead = f"s._cdc_operation = 'D'{f' AND {newer}' if guard else ''}"
    return f"""t AS (SELECT * FROM ({newest('txn', before)}) q WHERE _cdc_operation <> 'D'), s AS ({newest('txn', after)}),
m AS (SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {match} AND (({dead}) OR (s._cdc_operation IN ('I', 'U') AND {newer})))
  UNION ALL SELECT s.* FROM s WHERE s._cdc_operation IN ('I', 'U') AND (NOT EXISTS (SELECT 1 FROM t WHERE {match}) OR EXISTS (SELECT 1 FROM t WHERE {match} AND {newer})))"""


@case("latest_changes", "txn", f"SELECT {SHOWN} FROM ({newest('txn')}) n")
def _(t):
    return cdc.latest_changes(t.txn).select(*SHOW)


@case("latest_changes_agg", "txn", f"SELECT {SHOWN} FROM ({newest('txn')}) n")
def _(t):
    return cdc.latest_changes_agg(t.txn, columns=SHOW).select(*SHOW)


@case("merge_cdc", "txn", f"WITH {merged('ordered')} SELECT {SHOWN} FROM m")
def _(t):
    return cdc.merge_cdc(*sides(t, "ordered")).select(*SHOW)


@case("merge_cdc_interleaved", "txn", f"WITH {merged('interleaved')} SELECT {SHOWN} FROM m")
def _(t):
    return cdc.merge_cdc(*sides(t, "interleaved")).select(*SHOW)


@case("merge_cdc_guarded", "txn", f"WITH {merged('interleaved', guard=True)} SELECT {SHOWN} FROM m")
def _(t):
    return cdc.merge_cdc(*sides(t, "interleaved"), guard_deletes=True).select(*SHOW)


MATCHED = "s.tenant_id = t.tenant_id AND s.source_system = t.source_system AND s.source_transaction_id = t.source_transaction_id"


@case("is_newer", "txn", f"""WITH t AS (SELECT * FROM ({newest('txn', SCENES['interleaved'][0])}) a), s AS ({newest('txn', SCENES['interleaved'][1])})
SELECT s.tenant_id, s._cdc_timestamp > t._cdc_timestamp OR (s._cdc_timestamp = t._cdc_timestamp AND s._cdc_sequence_id > t._cdc_sequence_id) AS newer, count(*) AS n
FROM t JOIN s ON {MATCHED} GROUP BY 1, 2""")
def _(t):
    before, after = SCENES["interleaved"]
    key = ["tenant_id", "source_system", "source_transaction_id"]
    side = lambda rows, name: cdc.latest_changes(t.txn.filter(rows)).select(
        *key, F.struct("_cdc_timestamp", "_cdc_sequence_id").alias(name))
    return side(before, "_t").join(side(after, "_s"), key).groupBy("tenant_id", cdc.is_newer().alias("newer")).agg(F.count("*").alias("n"))


def audit(guard: bool) -> str:
    stale = "CASE WHEN newer THEN 'DELETE' ELSE 'STALE_DELETE' END" if guard else "'DELETE'"
    return f"""WITH t AS (SELECT * FROM ({newest('txn', SCENES['interleaved'][0])}) a WHERE _cdc_operation <> 'D'), s AS ({newest('txn', SCENES['interleaved'][1])}),
j AS (SELECT coalesce(t.tenant_id, s.tenant_id) AS tenant_id, t.tenant_id IS NOT NULL AS here, s._cdc_operation AS op,
  s._cdc_timestamp > t._cdc_timestamp OR (s._cdc_timestamp = t._cdc_timestamp AND s._cdc_sequence_id > t._cdc_sequence_id) AS newer FROM t FULL OUTER JOIN s ON {MATCHED})
SELECT tenant_id, CASE WHEN op IS NULL THEN 'KEEP' WHEN here AND op = 'D' THEN {stale}
  WHEN here THEN CASE WHEN newer THEN 'UPDATE' ELSE 'STALE' END WHEN op = 'D' THEN 'IGNORED_DELETE' ELSE 'INSERT' END AS action, count(*) AS key_count FROM j GROUP BY 1, 2"""


@case("merge_audit", "txn", audit(False))
def _(t):
    return cdc.merge_audit(*sides(t, "interleaved"))


@case("merge_audit_guarded", "txn", audit(True))
def _(t):
    return cdc.merge_audit(*sides(t, "interleaved"), guard_deletes=True)


@case("merge_cdc_incremental", "txn", f"WITH {merged('interleaved')} SELECT {SHOWN} FROM m")
def _(t):
    path = scratch_path(t.spark, "merge")
    target, changes = sides(t, "interleaved")
    storage.write_silver(target, path, period="year")
    cdc.merge_cdc_incremental(t.spark, path, changes, period="year")
    return t.spark.read.parquet(path).select(*SHOW)


@case("merge_cdc_graves", "txn", f"WITH {merged('ordered')} SELECT {SHOWN} FROM m")
def _(t):
    """After the merge the old rows arrive once more: what was deleted since stays out, and old deletes do not reach newer rows."""
    path = scratch_path(t.spark, "merge")
    target, changes = sides(t, "ordered")
    storage.write_silver(target, path, period="year")
    for batch in (changes, t.txn.filter(SCENES["ordered"][0])):
        cdc.merge_cdc_incremental(t.spark, path, batch, guard_deletes=True, period="year", graves=path + "-graves")
    return t.spark.read.parquet(path).select(*SHOW)


@case("merge_cdc_logged", "txn", f"WITH {merged('interleaved')} SELECT {SHOWN} FROM m")
def _(t):
    """Versioned silver with a key index: the batch reads the buckets and periods its keys touch."""
    path = scratch_path(t.spark, "logged")
    target, changes = sides(t, "interleaved")
    versioned.create(target, path, period="year", buckets=16)
    cdc.merge_cdc_logged(t.spark, path, changes)
    return versioned.snapshot(t.spark, path).select(*SHOW)


@case("merge_cdc_logged_graves", "txn", f"WITH {merged('ordered')} SELECT {SHOWN} FROM m")
def _(t):
    """The old rows arrive again after the merge: tombstones in the index keep deleted keys out."""
    path = scratch_path(t.spark, "logged")
    target, changes = sides(t, "ordered")
    versioned.create(target, path, period="year", buckets=16)
    for batch in (changes, t.txn.filter(SCENES["ordered"][0])):
        cdc.merge_cdc_logged(t.spark, path, batch, guard_deletes=True)
    return versioned.snapshot(t.spark, path).select(*SHOW)


@case("merge_cdc_logged_compacted", "txn", f"WITH {merged('ordered')} SELECT {SHOWN} FROM m")
def _(t):
    """Tombstones compacted by a horizon after every change: old rows arriving again are refused as late."""
    path = scratch_path(t.spark, "logged")
    target, changes = sides(t, "ordered")
    versioned.create(target, path, period="year", buckets=16)
    cdc.merge_cdc_logged(t.spark, path, changes, guard_deletes=True)
    cdc.compact_tombstones(t.spark, path, dt.datetime(2100, 1, 1))
    cdc.merge_cdc_logged(t.spark, path, t.txn.filter(SCENES["ordered"][0]), guard_deletes=True)
    return versioned.snapshot(t.spark, path).select(*SHOW)


@case("snapshot_as_of", "txn", f"SELECT {SHOWN} FROM ({newest('txn', f'_cdc_timestamp <= {CUT}')}) n WHERE _cdc_operation <> 'D'")
def _(t):
    return cdc.snapshot_as_of(t.txn, dt.datetime(1999, 1, 1)).select(*SHOW)


ASC = "_cdc_timestamp, _cdc_sequence_id, event_id"


@case("status_history", "txn", f"""WITH l AS (SELECT *, lag(status) OVER (PARTITION BY {K} ORDER BY {ASC}) AS prev FROM txn),
c AS (SELECT *, lead(_cdc_timestamp) OVER (PARTITION BY {K} ORDER BY {ASC}) AS upto FROM l WHERE prev IS DISTINCT FROM status)
SELECT {K}, status, CAST(_cdc_timestamp AS VARCHAR) AS valid_from, CAST(upto AS VARCHAR) AS valid_to, upto IS NULL AS is_current, event_id FROM c""")
def _(t):
    return cdc.status_history(t.txn, hot_rows=2, slots=3)


@case("cdc_lag", "txn", """WITH m AS (SELECT source_system, date_sub('minute', _cdc_timestamp, _cdc_load_timestamp) AS l, date_sub('minute', _cdc_timestamp, ingestion_ts) AS s FROM txn)
SELECT source_system, count(*) AS change_count, CAST(quantile_disc(l, 0.5) AS DOUBLE) AS load_p50, CAST(quantile_disc(l, 0.95) AS DOUBLE) AS load_p95,
  CAST(quantile_disc(s, 0.5) AS DOUBLE) AS silver_p50, CAST(quantile_disc(s, 0.95) AS DOUBLE) AS silver_p95, max(s) AS silver_max FROM m GROUP BY 1""")
def _(t):
    return cdc.cdc_lag(t.txn)
