"""Graph operators: components, near-node merging, turn penalties, route shapes and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.geo import oriented_line, turn
from geoloom.functions.rules import TURN_BASE, TURN_LEAST_DEGREES, TURN_MULTIPLIERS, TURN_OTHER, lookup
from geoloom.functions.text import any_contains, first_listed
from geoloom.operators.components import connected_components
from geoloom.operators.spatial import near_pairs
from geoloom.session import stage

#: Edges with all their tags that one task sorts.
TASK_EDGES = 100_000
GRADED_BRIDGES, GRADED_TUNNELS = ["yes", "viaduct", "movable", "cantilever"], ["yes", "building_passage", "covered"]


def weak_components(edges: DataFrame) -> DataFrame:
    """(node, component, size) of every node with an edge."""
    found = stage(connected_components(edges, "u", "v"))
    return found.join(found.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component").select("node", "component", "size")


def drop_small_components(edges: DataFrame, least: int = 75) -> DataFrame:
    """Edges of components of at least so many nodes; 1 or less keeps all."""
    if least <= 1:
        return edges
    big = weak_components(edges).where(F.col("size") >= least).select(F.col("node").alias("u"))
    return edges.join(big, "u", "left_semi")


def last_edge_wins(edges: DataFrame) -> DataFrame:
    """One edge for each (u, v): the one with the greatest key; of repeated keys, the one with the greatest other values.

    All columns are sorted by, so rows are dealt to as many tasks as keep a task's share small at every size.
    """
    rest = [F.desc(c) for c, k in edges.dtypes if c not in ("u", "v", "key") and "map" not in k]
    tasks = max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-edges.count() // TASK_EDGES))
    dealt = edges.repartition(tasks, "u", "v")
    return dealt.withColumn("_rn", F.row_number().over(Window.partitionBy("u", "v").orderBy(F.desc("key"), *rest))).where("_rn = 1").drop("_rn")


def with_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    a, b = (nodes.select(F.col("osmid").alias(k), F.col("x").alias(f"{k}_x"), F.col("y").alias(f"{k}_y")) for k in ("u", "v"))
    return edges.join(a, "u").join(b, "v")


def graph_union(base: DataFrame, extra: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of both; where both have a key the base's row stays, of one side's rows the one with the least other values."""
    both = base.withColumn("_p", F.lit(0)).unionByName(extra.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy("_p", *[c for c, k in both.dtypes if c not in (*key, "_p") and "map" not in k]))).where("_rn = 1").drop("_p", "_rn")


def node_tags(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Layers of a node's edges (its own layer without edges), and whether any is a bridge or tunnel."""
    graded = F.coalesce(F.lower("bridge").isin(GRADED_BRIDGES), F.lit(False)) | F.coalesce(F.lower("tunnel").isin(GRADED_TUNNELS), F.lit(False))
    ends = edges.select(F.explode(F.array("u", "v")).alias("osmid"), F.coalesce("layer", F.lit("0")).alias("l"), graded.alias("g"))
    tags = ends.groupBy("osmid").agg(F.collect_set("l").alias("layers"), F.bool_or("g").alias("graded"))
    return nodes.join(tags, "osmid", "left").select("osmid", F.coalesce("layers", F.array(F.coalesce("layer", F.lit("0")))).alias("layers"), F.coalesce("graded", F.lit(False)).alias("graded"))


def near_merge_map(nodes: DataFrame, edges: DataFrame, metres: float, mean_latitude: float, extra: DataFrame | None = None) -> DataFrame:
    """(drop, keep) of nodes that are one place: near, not adjacent, on a shared layer, equally graded.

    With ``extra`` (osmid) exactly one of a pair must be extra, and the other stays; else the smaller id stays. Of
    several partners the nearest, then the smallest id, is kept; chains are followed to their end.
    """
    tags = node_tags(edges, nodes)
    a, b = (tags.select(F.col("osmid").alias(k), F.col("layers").alias(f"l{k}"), F.col("graded").alias(f"g{k}")) for k in "ab")
    pairs = near_pairs(nodes, metres, mean_latitude).join(a, "a").join(b, "b").where(F.arrays_overlap("la", "lb") & (F.col("ga") == F.col("gb")))
    adjacent = edges.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    pairs = pairs.join(adjacent, ["a", "b"], "left_anti")
    if extra is not None:
        xa, xb = (extra.select(F.col("osmid").alias(k), F.lit(True).alias(f"x{k}")) for k in "ab")
        pairs = pairs.join(xa, "a", "left").join(xb, "b", "left").where("(xa is null) <> (xb is null)")
        pairs = pairs.select(F.when(F.col("xa").isNull(), F.col("b")).otherwise(F.col("a")).alias("drop"), F.when(F.col("xa").isNull(), F.col("a")).otherwise(F.col("b")).alias("keep"), "metres")
    else:
        pairs = pairs.select(F.col("b").alias("drop"), F.col("a").alias("keep"), "metres")
    mapped = stage(pairs.groupBy("drop").agg(F.min(F.struct("metres", "keep")).alias("m")).select("drop", "m.keep"))
    while True:  # pointer jumping: a chain of n links takes log2(n) rounds
        nxt = mapped.select(F.col("drop").alias("keep"), F.col("keep").alias("further"))
        jumped = stage(mapped.join(nxt, "keep", "left").select("drop", F.coalesce("further", "keep").alias("keep"), F.col("further").isNotNull().alias("moved")))
        if jumped.where("moved").isEmpty():
            return jumped.select("drop", "keep")
        mapped = jumped.select("drop", "keep")


def contract(edges: DataFrame, merged: DataFrame) -> DataFrame:
    """Edges with merged ends rewired; loops made by merging go."""
    a, b = (merged.select(F.col("drop").alias(k), F.col("keep").alias(f"k{k}")) for k in ("u", "v"))
    out = edges.join(a, "u", "left").join(b, "v", "left").withColumns({"nu": F.coalesce("ku", "u"), "nv": F.coalesce("kv", "v")})
    out = out.where((F.col("nu") != F.col("nv")) | (F.col("ku").isNull() & F.col("kv").isNull()))
    return out.drop("u", "v", "ku", "kv").withColumnsRenamed({"nu": "u", "nv": "v"})


def turn_penalties(edges: DataFrame, nodes: DataFrame, side: str = "left") -> DataFrame:
    """(a, b, c, penalty) of every transition a -> b -> c over directed edges (one edge per pair).

    0 where b has under 3 edges, the turn is under 45 degrees or not to the penalised side; else the base times the
    multiplier of the entered road. side "left" takes a left turn for what it is; "reference" takes a negative cross
    product, which is a right turn.
    """
    place = with_endpoints(edges, nodes).withColumn("bearing", F.atan2(F.col("v_x") - F.col("u_x"), F.col("v_y") - F.col("u_y")))
    degree = edges.select(F.explode(F.array("u", "v")).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("degree"))
    first = place.select(F.col("u").alias("a"), F.col("v").alias("b"), F.col("bearing").alias("b_in"))
    second = place.select(F.col("u").alias("b"), F.col("v").alias("c"), F.col("bearing").alias("b_out"), "highway")
    met = first.join(second, "b").join(degree, "b")
    angle, cross = turn(F.col("b_in"), F.col("b_out"))
    to_side = (-cross if side == "left" else cross) < 0
    times = lookup(first_listed(F.col("highway")), TURN_MULTIPLIERS, TURN_OTHER)
    hit = (F.col("degree") >= 3) & (F.round(angle, 6) >= TURN_LEAST_DEGREES) & to_side & (F.abs(cross) > 1e-9)
    return met.select("a", "b", "c", F.when(hit, TURN_BASE * times).otherwise(0.0).alias("penalty"))


def route_shape(routes: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Totals, street names and the line of each route; one from a node to itself has length 0 and one point.

    edges: u, v, length_m, name, line (one for each u, v). nodes: osmid, x, y. Requests without a way have no row.
    """
    legs = routes.where("size(path) > 1").select("pair", "cost", F.posexplode(F.expr("transform(sequence(1, size(path) - 1), i -> struct(element_at(path, i) as u, element_at(path, i + 1) as v))")).alias("pos", "e"))
    legs = legs.select("pair", "cost", "pos", "e.u", "e.v").join(edges.select("u", "v", "length_m", "name", "line"), ["u", "v"])
    out = legs.groupBy("pair").agg(
        F.round(F.first("cost"), 4).alias("cost"), F.round(F.sum("length_m"), 1).alias("length_m"), F.array_sort(F.collect_set("name")).alias("streets"), F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines")
    )
    ways = out.select("pair", "cost", "length_m", "streets", oriented_line(F.transform("lines", lambda s: s["line"])).alias("line"))
    stays = routes.where("size(path) = 1").select("pair", "cost", F.col("path")[0].alias("osmid")).join(nodes.select("osmid", "x", "y"), "osmid")
    return ways.unionByName(stays.select("pair", "cost", F.lit(0.0).alias("length_m"), F.array().cast("array<string>").alias("streets"), F.array(F.struct("x", "y")).alias("line")))


def route_checks(shapes: DataFrame, cases: DataFrame) -> DataFrame:
    """Failures of each case: streets that must be used or avoided, and the greatest cost. cases: pair, must_use, must_avoid, max_cost."""

    def failing(parts: str, wanted: bool, text: str) -> Column:
        hit = lambda p: any_contains(F.coalesce("streets", F.array().cast("array<string>")), p)
        return F.transform(F.filter(parts, lambda p: ~hit(p) if wanted else hit(p)), lambda p: F.concat(F.lit(text), p))

    dear = F.when(F.col("cost").isNull(), F.array(F.lit("no route"))).when(F.col("cost") > F.col("max_cost"), F.array(F.lit("too dear"))).otherwise(F.array().cast("array<string>"))
    met = cases.join(shapes, "pair", "left")
    return met.select("pair", F.concat(failing("must_use", True, "not used: "), failing("must_avoid", False, "used: "), dear).alias("failures")).withColumn("passed", F.size("failures") == 0)
