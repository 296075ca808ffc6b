"""Roots of many-parent hierarchies against a plain walk, and a long chain."""

import random
from collections import deque

from railweave.operators import graph

REL = "party_id_a string, party_id_b string, relationship_type string"


def brute(edges):
    parents = {}
    for parent, child in set(edges):
        parents.setdefault(child, set()).add(parent)
    out = set()
    for start in parents:
        seen, todo = {start: 0}, deque([start])
        while todo:
            node = todo.popleft()
            for p in parents.get(node, ()):
                if p not in seen:
                    seen[p] = seen[node] + 1
                    todo.append(p)
        out |= {(start, r, d) for r, d in seen.items() if r != start and r not in parents}
    return sorted(out)


def run(spark, edges):
    rows = [(a, b, "PARENT_SUBSIDIARY") for a, b in edges] + [("x", "y", "JOINT_ACCOUNT")]
    return sorted(map(tuple, graph.hierarchy(spark.createDataFrame(rows, REL)).collect()))


def test_equals_a_walk_on_random_graphs(spark):
    r = random.Random(2)
    for n, m in ((30, 45), (60, 70)):
        nodes = [f"p{i:03d}" for i in range(n)]
        edges = [(r.choice(nodes), r.choice(nodes)) for _ in range(m)]  # cycles, self loops, several parents
        edges += [(nodes[i], nodes[i + 1]) for i in range(0, n - 1, 3)]
        assert run(spark, edges) == brute(edges)


def test_long_chain_in_few_rounds(spark):
    n = 100_000
    rows = [(f"c{i:06d}", f"c{i + 1:06d}", "PARENT_SUBSIDIARY") for i in range(n)] + [("r2", "c050000", "PARENT_SUBSIDIARY")]
    got = graph.hierarchy(spark.createDataFrame(rows, REL).repartition(8))
    assert got.count() == n + n // 2 + 1
    deepest = got.where("party_id = 'c100000'").orderBy("root_party_id").collect()
    assert [(r.root_party_id, r.depth) for r in deepest] == [("c000000", n), ("r2", n // 2 + 1)]


OWN = "party_id_a string, party_id_b string, relationship_type string, ownership_percentage double"


def owned(spark, edges):
    rows = [(e, o, "BENEFICIAL_OWNER", p) for o, e, p in edges] + [("x", "y", "JOINT_ACCOUNT", None), ("q", "r", "BENEFICIAL_OWNER", None)]
    return spark.createDataFrame(rows, OWN)


def close(a, b):
    return len(a) == len(b) and all(x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-9 and x[3:] == y[3:] for x, y in zip(a, b))


def test_ownership_equals_path_enumeration(spark):
    r = random.Random(7)
    nodes = [f"n{i:02d}" for i in range(14)]
    edges = [(r.choice(nodes), r.choice(nodes), float(r.randint(1, 90))) for _ in range(26)]  # cycles, parallel edges, self loops
    edges += [("n00", "n01", 50.0), ("n01", "n00", 20.0), ("n01", "n02", 30.0), ("n02", "n01", 10.0)]
    rel = owned(spark, edges)
    got = sorted(map(tuple, graph.ubo_closure(rel, path_rows=0).collect()))  # by components, not by listing paths
    plain = sorted(map(tuple, graph.ubo_paths(graph._owner_edges(rel)).select("owner", "entity", "effective_share", "min_depth", "path_count").collect()))
    assert close(got, plain)


def test_layered_ownership_of_width_and_depth_twenty(spark):
    edges = [(f"l{d:02d}w{i:02d}", f"l{d + 1:02d}w{j:02d}", 5.0) for d in range(20) for i in range(20) for j in range(20)]
    got = graph.ubo_closure(owned(spark, edges), path_rows=10_000)  # the walk gives up after a few rounds
    row = got.where("owner = 'l00w00' AND entity = 'l20w00'").first()
    assert row.path_count is None and row.min_depth == 20 and abs(row.effective_share - 0.05) < 1e-12  # 20^19 paths: more than a long holds
    row = got.where("owner = 'l00w00' AND entity = 'l14w03'").first()
    assert row.path_count == 20 ** 13 and row.min_depth == 14
    assert got.count() == sum(20 * 20 * (20 - d) for d in range(20))
