"""Party graph: ownership chains, hierarchies, groups, money edges and nodes.

Iterations cut lineage with a reliable checkpoint per round and stop by a count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import settled
from ..session import cut_lineage


def active_relationships(rel: DataFrame, as_of: dt.date) -> DataFrame:
    day = F.lit(as_of)
    return rel.filter(F.col("is_active") & (F.col("effective_date") <= day)
                      & (F.col("expiry_date").isNull() | (F.col("expiry_date") >= day)))


def follow(links: DataFrame, node: str, to: str, max_rounds: int) -> DataFrame:
    """End of every single-successor chain by pointer doubling, with ``steps`` and ``cyclic``.

    Each round doubles the distance covered.  While a chain is open some of its nodes
    finish every round, so an unchanged count of open nodes means only cycles are left.
    """
    links = cut_lineage(links)
    open_before = -1
    for _ in range(max_rounds):
        ahead = links.select(F.col(node).alias(to), F.col(to).alias("_to"), F.col("steps").alias("_steps"))
        links = cut_lineage(links.select(node, to, "steps").join(ahead, to, "left").select(
            node, F.coalesce("_to", to).alias(to), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.col("_to").isNotNull().alias("cyclic")))
        still_open = links.filter("cyclic").count()
        if still_open in (0, open_before):
            return links
        open_before = still_open
    raise RuntimeError(f"chains did not settle in {max_rounds} rounds")


def ubo_volume(txn: DataFrame, rel: DataFrame, owner: str) -> DataFrame:
    """Money sent by the entities that ``owner`` directly owns."""
    owned = rel.filter((F.col("relationship_type") == "BENEFICIAL_OWNER") & (F.col("party_id_b") == owner)).select(
        F.col("party_id_a").alias("originator_party_id")).distinct()
    return txn.join(owned, "originator_party_id").agg(F.count("*").alias("txn_count"), F.sum(settled()).alias("volume"))


def _owner_edges(rel: DataFrame) -> DataFrame:
    return rel.filter((F.col("relationship_type") == "BENEFICIAL_OWNER") & F.col("ownership_percentage").isNotNull()).select(
        F.col("party_id_b").alias("from"), F.col("party_id_a").alias("entity"), (F.col("ownership_percentage").cast("double") / 100).alias("share")) \
        .where(F.col("from") != F.col("entity"))


COUNT = "decimal(38,0)"  # paths are counted exactly up to 10^38; more than a long holds gives a null path_count


#: paths are listed while no round of the walk holds more than this many; beyond, components take over
PATH_ROWS = 1_000_000


def ubo_closure(rel: DataFrame, max_rounds: int = 256, path_rows: int = PATH_ROWS) -> DataFrame:
    """Effective ownership over all simple paths: product of shares along a path, summed over paths.

    Shallow graphs with few paths are walked path by path (``ubo_paths``), which is cheapest
    there; as soon as one round of that walk would hold more than ``path_rows`` paths, the walk
    is dropped and the sums are carried by components instead.  Both give the same rows.

    A simple path meets each strongly connected component once, in one piece, so sums are
    carried per (owner, party), never per path: paths are enumerated only inside components of
    more than one party (cycles), as transfers from where a path enters to where it leaves.
    Components: parties that are no source or sink are trimmed off round by round; among the
    rest, reachability by squaring names each party's component by its least mutual member.
    Then each round moves (owner, party) sums through one component and one edge between
    components: rounds grow with the number of components on a path, rows with the owned pairs.
    """
    edges = cut_lineage(_owner_edges(rel))
    listed = ubo_paths(edges, path_rows) if path_rows > 0 else None
    if listed is not None:
        return listed
    core, size = edges.select("from", "entity"), edges.count()
    for _ in range(max_rounds):
        kept = core.join(core.select(F.col("from").alias("entity")).distinct(), "entity", "left_semi") \
            .join(core.select(F.col("entity").alias("from")).distinct(), "from", "left_semi")
        kept = cut_lineage(kept)
        left = kept.count()
        if left == size:
            break
        core, size = kept, left
    else:
        raise RuntimeError(f"trimming did not settle in {max_rounds} rounds")
    reach = cut_lineage(core.select(F.col("from").alias("a"), F.col("entity").alias("b")).distinct())
    for _ in range(max_rounds):
        if not size:  # nothing left after trimming: no cycle
            break
        longer = reach.join(reach.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
        grown = cut_lineage(reach.union(longer).distinct())
        if grown.count() == reach.count():
            break
        reach = grown
    else:
        raise RuntimeError(f"reachability did not settle in {max_rounds} rounds")
    mutual = reach.join(reach.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"])
    comp = cut_lineage(mutual.groupBy(F.col("a").alias("party")).agg(F.min("b").alias("_m")).select(
        "party", F.least("party", "_m").alias("comp")))
    nodes = edges.select(F.col("from").alias("party")).union(edges.select(F.col("entity"))).distinct()
    comp = cut_lineage(nodes.join(comp, "party", "left").select("party", F.coalesce("comp", "party").alias("comp")))
    tagged = edges.join(comp.select(F.col("party").alias("from"), F.col("comp").alias("c_from")), "from") \
        .join(comp.select(F.col("party").alias("entity"), F.col("comp").alias("c_to")), "entity")
    inside = tagged.where(F.col("c_from") == F.col("c_to")).select("from", "entity", "share")
    across = cut_lineage(tagged.where(F.col("c_from") != F.col("c_to")).select(F.col("from").alias("node"), F.col("entity").alias("next"), "share"))
    # transfers inside cycles: every simple path between two members, enumerated there only
    transfer = ubo_paths(inside if size else inside.limit(0)).select(F.col("owner").alias("node"), F.col("entity").alias("to"),
                                        F.col("effective_share").alias("t_s"), F.col("path_count").cast(COUNT).alias("t_c"), F.col("min_depth").alias("t_d"))
    transfer = cut_lineage(transfer)
    arrived = edges.select(F.col("from").alias("owner")).distinct().select("owner", F.col("owner").alias("node"),
                                                                          F.lit(1.0).alias("s"), F.lit(1).cast(COUNT).alias("c"), F.lit(0).alias("d"))
    found = None
    for _ in range(max_rounds):
        moved = arrived.join(transfer, "node").select("owner", F.col("to").alias("node"), (F.col("s") * F.col("t_s")).alias("s"),
                                                      (F.col("c") * F.col("t_c")).alias("c"), (F.col("d") + F.col("t_d")).alias("d"))
        settled = cut_lineage(arrived.unionByName(moved).groupBy("owner", "node").agg(
            F.sum("s").alias("s"), F.sum("c").alias("c"), F.min("d").alias("d")))
        here = settled.where(F.col("owner") != F.col("node"))
        found = here if found is None else found.unionByName(here)
        arrived = cut_lineage(settled.join(across, "node").groupBy("owner", F.col("next").alias("node")).agg(
            F.sum(F.col("s") * F.col("share")).alias("s"), F.sum("c").alias("c"), F.min(F.col("d") + 1).alias("d")))
        if arrived.isEmpty():
            break
    else:
        raise RuntimeError(f"ownership did not settle in {max_rounds} rounds")
    total = found.groupBy("owner", F.col("node").alias("entity")).agg(
        F.sum("s").alias("effective_share"), F.min("d").cast("int").alias("min_depth"), F.sum("c").alias("_c"))
    return total.select("owner", "entity", "effective_share", "min_depth", F.col("_c").try_cast("long").alias("path_count"))


def ubo_paths(edges: DataFrame, limit_rows: int | None = None) -> DataFrame | None:
    """Every simple path of ``from, entity, share`` edges, enumerated, summed per (owner, entity).

    A path never visits a party twice, so the walk ends by itself, whatever the depth.  Used
    for graphs with few paths, inside cycles, and by tests as the plain form.  With
    ``limit_rows``, None as soon as one round holds more paths than that.
    """
    edges = cut_lineage(edges.where(F.col("from") != F.col("entity")))
    frontier = edges.select(
        F.col("from").alias("owner"), "entity", "share", F.array("from", "entity").alias("path"))
    found = frontier.select("owner", "entity", "share", F.lit(1).alias("depth"))
    step = edges.select(F.col("from").alias("at"), F.col("entity").alias("next"), F.col("share").alias("next_share"))
    depth = 1
    while True:
        depth += 1
        frontier = cut_lineage(frontier.join(step, F.col("entity") == F.col("at")).filter(
            ~F.array_contains("path", F.col("next"))).select(
            "owner", F.col("next").alias("entity"), (F.col("share") * F.col("next_share")).alias("share"),
            F.concat("path", F.array("next")).alias("path")))
        if limit_rows is None:
            if frontier.isEmpty():
                break
        else:
            held = frontier.count()
            if held > limit_rows:
                return None
            if held == 0:
                break
        found = found.unionByName(frontier.select("owner", "entity", "share", F.lit(depth).alias("depth")))
    return found.groupBy("owner", "entity").agg(
        F.sum("share").alias("effective_share"), F.min("depth").alias("min_depth"), F.count("*").alias("path_count"))


def hierarchy(rel: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Every corporate root above a subsidiary, with the least number of steps to it.

    No ancestor is ever listed.  Chains of single-parent parties are settled first by pointer
    doubling (``follow``), each party to the end of its chain: a root, a party with several
    parents (a junction), or a cycle.  Only junctions then carry roots downwards, round by round
    and along reduced edges that skip whole chains, keeping the least steps per (junction,
    root) and passing on only what improved.  A party inherits the roots of its chain's end
    with the chain's steps added.  A chain of n parties takes about log2(n) rounds and n rows;
    the carrying rounds grow with the number of junctions on a path, not with its length.
    Parties in or only below a cycle without root get no row.
    """
    up = cut_lineage(rel.filter(F.col("relationship_type") == "PARENT_SUBSIDIARY").select(
        F.col("party_id_b").alias("party_id"), F.col("party_id_a").alias("above")).distinct())
    parents = up.groupBy("party_id").agg(F.count(F.lit(1)).alias("n"))
    single = up.join(parents.where("n = 1"), "party_id").select("party_id", "above", F.lit(1).alias("steps"))
    ends = follow(single, "party_id", "above", max_rounds).where(~F.col("cyclic")).select(
        "party_id", F.col("above").alias("end"), "steps")
    junctions = parents.where("n > 1").select("party_id")
    roots = up.select(F.col("above").alias("end")).distinct().join(parents.select(F.col("party_id").alias("end")), "end", "left_anti")
    # a junction's parent stands for the end of its chain, one step further
    via = ends.select(F.col("party_id").alias("above"), F.col("end").alias("_end"), F.col("steps").alias("_steps"))
    cyclic = single.select(F.col("party_id").alias("above")).join(via.select("above"), "above", "left_anti")
    reduced = cut_lineage(up.join(junctions, "party_id").join(cyclic, "above", "left_anti").join(via, "above", "left").select(
        "party_id", F.coalesce("_end", "above").alias("end"), (F.coalesce("_steps", F.lit(0)) + 1).alias("w")))
    best = cut_lineage(reduced.join(roots, "end").groupBy("party_id", F.col("end").alias("root")).agg(F.min("w").alias("d")))
    fresh = best
    for _ in range(max_rounds):
        reached = fresh.join(reduced.withColumnRenamed("party_id", "_below"), F.col("party_id") == F.col("end")).groupBy(
            F.col("_below").alias("party_id"), "root").agg(F.min(F.col("d") + F.col("w")).alias("d"))
        fresh = cut_lineage(reached.join(best.withColumnRenamed("d", "_old"), ["party_id", "root"], "left").where(
            F.col("_old").isNull() | (F.col("d") < F.col("_old"))).drop("_old"))
        if fresh.isEmpty():
            break
        best = cut_lineage(best.join(fresh.select("party_id", "root"), ["party_id", "root"], "left_anti").unionByName(fresh))
    else:
        raise RuntimeError(f"roots did not settle in {max_rounds} rounds")
    at_root = ends.join(roots, "end").select("party_id", F.col("end").alias("root"), F.col("steps").alias("d"))
    at_junction = ends.join(best.withColumnRenamed("party_id", "end"), "end").select("party_id", "root", (F.col("steps") + F.col("d")).alias("d"))
    return best.unionByName(at_root).unionByName(at_junction).select(
        "party_id", F.col("root").alias("root_party_id"), F.col("d").cast("int").alias("depth"))


def party_groups(rel: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components over joint accounts; the lowest id names the group.

    Alternating star contraction: every node hands its neighbours above (then below) it to
    the smallest neighbour.  The edge set shrinks to one star per group in a logarithmic
    number of rounds; a hub is an aggregate plus an equi-join, never a collected list.
    """
    pairs = rel.filter(F.col("relationship_type") == "JOINT_ACCOUNT").select(
        F.least("party_id_a", "party_id_b").alias("v"), F.greatest("party_id_a", "party_id_b").alias("u")).filter("u <> v").distinct()
    edges = cut_lineage(pairs)  # u > v always

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()

    def small_star(e: DataFrame) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        moved = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()

    for _ in range(max_rounds):
        now = cut_lineage(small_star(large_star(edges)))
        if now.exceptAll(edges).isEmpty() and edges.exceptAll(now).isEmpty():
            break
        edges = now
    else:
        raise RuntimeError(f"groups did not settle in {max_rounds} rounds")
    members = edges.select(F.col("u").alias("party_id"), F.col("v").alias("group_id"))
    return members.union(edges.select(F.col("v"), F.col("v")).distinct())


def graph_edges(txn: DataFrame, rel: DataFrame) -> DataFrame:
    """Money edges by pair and rail, tagged with all relationships of the pair in either direction."""
    tags = rel.groupBy(F.least("party_id_a", "party_id_b").alias("low"), F.greatest("party_id_a", "party_id_b").alias("high")).agg(
        F.array_join(F.sort_array(F.collect_set("relationship_type")), ",").alias("relationship"))
    edges = txn.filter(F.col("originator_party_id").isNotNull() & F.col("beneficiary_party_id").isNotNull()).groupBy(
        F.col("originator_party_id").alias("source"), F.col("beneficiary_party_id").alias("target"), "payment_type").agg(
        F.count("*").alias("txn_count"), F.sum(settled()).alias("volume"))
    return edges.withColumns({"low": F.least("source", "target"), "high": F.greatest("source", "target")}).join(
        tags, ["low", "high"], "left").drop("low", "high")


def graph_nodes(txn: DataFrame, parties: DataFrame) -> DataFrame:
    """Per party: transactions, active rails and connections (edges at either end)."""
    edges = txn.filter(F.col("originator_party_id").isNotNull() & F.col("beneficiary_party_id").isNotNull()).groupBy(
        F.col("originator_party_id").alias("source"), F.col("beneficiary_party_id").alias("target"), "payment_type").agg(F.count("*").alias("n"))
    ends = F.array_distinct(F.array("source", "target"))
    nodes = edges.select(F.explode(ends).alias("party_id"), "payment_type", "n").groupBy("party_id").agg(
        F.sum("n").alias("txn_count"), F.count("*").alias("connection_count"), F.sort_array(F.collect_set("payment_type")).alias("active_rails"))
    return nodes.withColumn("rail_count", F.size("active_rails")).join(
        parties.select("party_id", "party_type"), "party_id", "left")
