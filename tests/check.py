"""Run registered queries beside their SQL: ``python tests/check.py [--sf DIR] [name or prefix ...]``."""

from __future__ import annotations

import importlib
import math
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))

from railweave.session import build_session  # noqa: E402
from railweave.sources import fixtures  # noqa: E402
from railweave.workload import registry  # noqa: E402

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in fixtures.GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty text when both engines agree."""
    df = registry.QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    mine = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    total = sum(mine.values())
    if name not in registry.ORACLES:
        return "" if total else "no rows"
    rel = con.sql(registry.ORACLES[name])
    if sorted(rel.columns) != names:
        return f"columns {names} vs {sorted(rel.columns)}"
    kinds = dict(zip(rel.columns, [str(k) for k in rel.types]))
    odd = [(c, k, kinds[c]) for c, k in df.dtypes if KINDS.get(k, k) != kinds[c]]
    if odd:
        return f"types {odd}"
    order = [rel.columns.index(c) for c in names]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    if mine != theirs:
        left, right = mine - theirs, theirs - mine
        return (f"rows {total} vs {sum(theirs.values())}; only here {sum(left.values())}: "
                f"{sorted(left, key=str)[:2]} only SQL {sum(right.values())}: {sorted(right, key=str)[:2]} {names}")
    return "" if total else "no rows"


def main(args: list[str]) -> int:
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    importlib.import_module("railweave.workload")
    families = [a for a in args if a.endswith("_cases")]
    wanted = [a for a in args if not a.endswith("_cases")]
    names = [n for n in registry.QUERIES
             if not args or registry.FAMILY[n] in families
             or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        began = time.time()
        try:
            said = compare(spark, con, sf_dir, name)
        except Exception as err:  # report every failing query, not only the first
            said = f"{type(err).__name__}: {str(err)[:700]}"
        bad += bool(said)
        print(f"{'FAIL' if said else 'ok  '} {name} {time.time() - began:.1f}s {said}", flush=True)
    print(f"{len(names)} queries, {bad} failing, {sum(n in registry.ORACLES for n in names)} with SQL")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
