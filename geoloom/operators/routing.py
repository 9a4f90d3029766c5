"""Batch routing over cells of a street network.

The network is cut into cells of neighbouring nodes. A part of it that no street links with the rest stays in one cell if it
is small enough: its requests are answered there, each searched no further than its destination. Larger parts are cut. Within a cell, the least costs between the edges that cross its border,
from asked origins and to asked destinations are found at once, a task working on one cell. The search itself then
moves by whole cells: a state is a crossing edge that a request has reached, a round is one join with the costs across
cells, and a way of a hundred streets takes a handful of rounds. It is directed at the destination: what is left to go
costs at least the least cost of a metre times the straight distance, and states that can't beat the request's best
arrival are never made. States hold their weights only: at the end the best routes are followed back from crossing
to crossing, and the nodes between them are spelled out for their legs alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.components import connected_components
from geoloom.operators.order import numbered
from geoloom.session import stage

#: Costs are whole thousandths in the upper bits of a weight. The lower bits hold a number of its own for every edge, so that
#: of equally dear ways one is the least, the same one on every run and in every order of adding up.
UNITS, LOW = 1000, 32
_FAR = np.int64(2**62)
#: Sources of a cell that are worked on at once, so that their weights stay in a core's cache.
_BLOCK = 64

_GRAPH = "kind string, a long, b long, c long, w long"
_LEGS = "kind string, from_u long, from_v long, to_u long, to_v long, w long"
_PARTS = "node long, part long"
_PATHS = "kind string, from_u long, from_v long, to_u long, to_v long, nodes array<long>"
_LEG = ["kind", "from_u", "from_v", "to_u", "to_v"]


def _spread(bits: Column) -> Column:
    """16 bits with a gap after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return bits


def node_cells(nodes: DataFrame, cell_nodes: int) -> DataFrame:
    """(node, cell, x, y): runs of ``cell_nodes`` nodes along a Z-shaped curve; x is scaled to the length of y. Staged."""
    flat = nodes.join(F.broadcast(nodes.agg(F.cos(F.radians(F.avg("y"))).alias("shrink")))).select(F.col("osmid").cast("long").alias("node"), (F.col("x") * F.col("shrink")).alias("x"), "y")  # one row
    box = flat.agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"), F.lit(1e-12)).alias("side"))  # one row
    part = lambda v, low: F.floor((F.col(v) - F.col(low)) / F.col("side") * 65535).cast("long")
    placed = flat.join(F.broadcast(box)).select("node", "x", "y", _spread(part("x", "x0")).bitwiseOR(F.shiftleft(_spread(part("y", "y0")), 1)).alias("z"))
    return stage(numbered(placed, ["z", "node"]).select("node", F.floor(F.col("at") / cell_nodes).cast("long").alias("cell"), "x", "y"))


def _linked(cell: pa.Table) -> pa.Table:
    """The smallest node that each node is linked with by edges inside the cell."""
    top: dict[int, int] = {}

    def find(n: int) -> int:
        while top[n] != n:
            top[n] = n = top[top[n]]
        return n

    for u, v in zip(cell.column("u").to_pylist(), cell.column("v").to_pylist(), strict=True):
        a, b = (find(top.setdefault(n, n)) for n in (u, v))
        top[max(a, b)] = min(a, b)
    return pa.table({"node": pa.array(top, pa.int64()), "part": pa.array(map(find, top), pa.int64())})


def linked_cells(cells: DataFrame, steps: DataFrame, cell_nodes: int) -> DataFrame:
    """``cells`` with ``component`` (its smallest node) and ``whole``. Components of at most four cells' nodes are whole: each
    lies in one cell, with other such ones until ``cell_nodes`` are reached; the rest keep the runs they are in. Staged.
    """
    of = lambda n: cells.select(F.col("node").alias(n), F.col("cell").alias(f"cell_{n}"))
    ends = stage(steps.select("u", "v").join(of("u"), "u").join(of("v"), "v"))
    inside = ends.where("cell_u = cell_v").select(F.col("cell_u").alias("cell"), "u", "v").groupBy("cell").applyInArrow(_linked, _PARTS)
    parts = stage(cells.join(inside, "node", "left").select("node", "cell", "x", "y", F.coalesce("part", "node").alias("part")))
    part = lambda n: parts.select(F.col("node").alias(n), F.col("part").alias(f"part_{n}"))
    links = ends.where("cell_u <> cell_v").join(part("u"), "u").join(part("v"), "v").select("part_u", "part_v").distinct()
    found = connected_components(links, "part_u", "part_v").withColumnRenamed("node", "part")
    linked = stage(parts.join(found, "part", "left").select("node", "cell", "x", "y", F.coalesce("component", "part").alias("component")))
    small = linked.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") <= 4 * cell_nodes)
    packed = numbered(small, ["component"], "size").select("component", F.floor(F.col("before_size") / cell_nodes).cast("long").alias("pack"))
    own = F.coalesce(F.col("pack") * 2, F.col("cell") * 2 + 1)
    return stage(linked.join(packed, "component", "left").select("node", own.alias("cell"), "x", "y", "component", F.col("pack").isNotNull().alias("whole")))


def _weight(amount: Column) -> Column:
    return F.shiftleft(F.round(amount * UNITS).cast("long"), LOW)


def edge_mark(u: Column, v: Column) -> Column:
    """20 bits of its own for an edge."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", u.cast("string"), v.cast("string"))), 1, 5), 16, 10).cast("long")


def _heads(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each key begins."""
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.empty(0, int)


class _Cell:
    """Edge states of a cell and the moves between them."""

    def __init__(self, graph: pa.Table):
        kind = np.asarray(graph.column("kind").to_pylist())
        a, b, c, w = (graph.column(k).to_numpy() for k in "abcw")
        step, enter, move = kind == "edge", kind == "enter", kind == "move"
        ends = np.stack([np.concatenate([a[step], a[enter]]), np.concatenate([b[step], b[enter]])], axis=1)
        self.states, at = np.unique(ends, axis=0, return_inverse=True) if len(ends) else (ends, np.empty(0, int))
        at = at.ravel()
        self.cost = np.zeros(len(self.states), np.int64)
        self.cost[at[: step.sum()]] = w[step]
        self.enters = at[step.sum() :]
        self.inside = set(a[step].tolist()) | set(b[enter].tolist())
        self.exits = np.array([i for i, v in enumerate(self.states[:, 1].tolist()) if v not in self.inside], int) if len(self.states) else np.empty(0, int)
        index = {tuple(s): i for i, s in enumerate(self.states.tolist())}
        of = np.array([index.get(k, -1) for k in zip(a[move].tolist(), b[move].tolist(), strict=True)], np.int64)
        to = np.array([index.get(k, -1) for k in zip(b[move].tolist(), c[move].tolist(), strict=True)], np.int64)
        both = np.flatnonzero((of >= 0) & (to >= 0))
        both = both[np.argsort(to[both], kind="stable")]
        self.of, self.to, self.w = of[both], to[both], w[move][both]
        self.heads = _heads(self.to)
        self.index = index
        self.by_end = np.argsort(self.states[:, 1], kind="stable") if len(self.states) else np.empty(0, int)
        self.ends = self.states[self.by_end, 1] if len(self.states) else np.empty(0, np.int64)
        self.end_heads = _heads(self.ends)
        self.leaving: dict[int, list[int]] = {}
        self.coming: dict[int, list[int]] = {}
        for i, (u, v) in enumerate(self.states.tolist()):
            self.leaving.setdefault(u, []).append(i)
            self.coming.setdefault(v, []).append(i)

    def least(self, sources: list[tuple[int, int | None]], wanted: list[list[np.ndarray]] | None = None) -> np.ndarray:
        """Weights of all states (down) for each source (across): an entering edge (u, v), or an origin (node, None).

        ``wanted`` lists for each source groups of states of which the least is asked for. Then only weights up to the
        greatest of these leasts are right; the others may be too large.
        """
        d = np.full((len(self.states), len(sources)), _FAR)
        for i, (u, v) in enumerate(sources):
            if v is None:
                at = self.leaving.get(u, [])
                d[at, i] = self.cost[at]
            else:
                d[self.index[u, v], i] = 0
        limit = np.full(len(sources), _FAR)
        groups = [(i, g) for i, w in enumerate(wanted or []) for g in w]
        if groups:
            row, col = np.concatenate([g for _, g in groups]), np.repeat([i for i, _ in groups], [len(g) for _, g in groups])
            starts = np.cumsum([0] + [len(g) for _, g in groups[:-1]])
            of = np.array([i for i, _ in groups])
            firsts = _heads(of)
            limit[[i for i, w in enumerate(wanted) if not w]] = -1
        fresh = (d < _FAR).any(axis=1)
        while True:
            if groups:
                limit[of[firsts]] = np.maximum.reduceat(np.minimum.reduceat(d[row, col], starts), firsts)
            on = np.flatnonzero(fresh[self.of])
            if not len(on):
                return d
            heads = _heads(self.to[on])
            ends = self.to[on[heads]]
            nearer = d[self.of[on]]
            nearer += self.w[on, None]
            nearer = np.minimum.reduceat(nearer, heads, axis=0)
            had = d[ends]
            better = (nearer < had) & (nearer <= limit)
            d[ends] = np.where(better, nearer, had)
            fresh[:] = False
            fresh[ends] = better.any(axis=1)

    def arrivals(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes that a state ends in, and the least weight of an arrival there (down) for each source."""
        return self.ends[self.end_heads], np.minimum.reduceat(d[self.by_end], self.end_heads, axis=0) if len(self.ends) else d[:0]

    def before(self, d: np.ndarray) -> np.ndarray:
        """The state that each state was reached from, -1 where it is the first."""
        out = np.full(d.shape, -1, np.int64)
        if len(self.heads):
            hit = (d[self.of] + self.w[:, None] == d[self.to]) & (d[self.to] < _FAR)
            out[self.to[self.heads]] = np.maximum.reduceat(np.where(hit, self.of[:, None], -1), self.heads, axis=0)
        return out


def _legs(graph: pa.Table, asks: pa.Table) -> pa.Table:
    """Least weights within one cell."""
    cell = _Cell(graph)
    kind, u, v = np.asarray(asks.column("kind").to_pylist()), *(np.asarray(asks.column(k).fill_null(-1)) for k in "uv")
    goals = np.unique(v[kind == "to"])
    asked_of: dict[int, set[int]] = {}
    for o, t in zip(u[kind == "direct"].tolist(), v[kind == "direct"].tolist(), strict=True):
        asked_of.setdefault(o, set()).add(t)
    origins = sorted(set(u[(kind == "from") | (kind == "direct")].tolist()) & set(cell.leaving))
    out: list[list[np.ndarray]] = []
    none = np.full(1, -1)

    def add(kind: int, *columns: np.ndarray) -> None:
        n = len(columns[3])
        out.append([np.full(n, kind), *(np.broadcast_to(c, n) for c in columns)])

    enters, places = cell.states[cell.enters], cell.states[cell.exits]
    for at in range(0, len(enters), _BLOCK):
        some = enters[at : at + _BLOCK]
        d = cell.least([*map(tuple, some.tolist())])
        j, i = np.nonzero(d[cell.exits] < _FAR)
        add(1, some[i, 0], some[i, 1], places[j, 0], places[j, 1], d[cell.exits[j], i])
        nodes, least = cell.arrivals(d)
        j, i = np.nonzero((least < _FAR) & np.isin(nodes, goals)[:, None])
        add(2, some[i, 0], some[i, 1], none, nodes[j], least[j, i])
    for at in range(0, len(origins), _BLOCK):
        some = np.array(origins[at : at + _BLOCK])
        # without a way out of the cell nothing but its own destinations is asked for
        wanted = None if len(cell.exits) else [[np.array(cell.coming[t]) for t in asked_of.get(o, ()) if t in cell.coming] for o in some.tolist()]
        d = cell.least([(o, None) for o in some.tolist()], wanted)
        j, i = np.nonzero(d[cell.exits] < _FAR)
        add(0, some[i], none, places[j, 0], places[j, 1], d[cell.exits[j], i])
        nodes, least = cell.arrivals(d)
        row, col = {o: i for i, o in enumerate(some.tolist())}, {t: j for j, t in enumerate(nodes.tolist())}
        hit = np.array([(row[o], col[t]) for o in row for t in asked_of.get(o, ()) if t in col and least[col[t], row[o]] < _FAR], int).reshape(-1, 2)
        add(3, some[hit[:, 0]], none, none, nodes[hit[:, 1]], least[hit[:, 1], hit[:, 0]])
    columns = [np.concatenate(c) if out else np.empty(0, np.int64) for c in zip(*out, strict=True)]
    names = pa.DictionaryArray.from_arrays(pa.array(columns[0], pa.int32()), pa.array(["from", "across", "to", "direct"])).cast(pa.string())
    return pa.table({"kind": names} | {k: pa.array(c, pa.int64(), mask=c < 0) for k, c in zip([*_LEG[1:], "w"], columns[1:], strict=True)})


def _spell(graph: pa.Table, legs: pa.Table) -> pa.Table:
    """The nodes of legs within one cell, without those that the leg before has named."""
    cell, rows = _Cell(graph), list(zip(*(legs.column(k).to_pylist() for k in _LEG), strict=True))
    of_source: dict[tuple, dict[tuple, list[int]]] = {}
    for r in rows:
        of_source.setdefault((r[1], r[2]), {})[r] = [cell.index[r[3], r[4]]] if r[3] is not None else cell.coming[r[4]]
    sources = sorted(of_source, key=lambda s: (s[0], -1 if s[1] is None else s[1]))
    nodes = {}
    for at in range(0, len(sources), _BLOCK):
        some = sources[at : at + _BLOCK]
        d = cell.least(some, [[np.array(e) for e in of_source[s].values()] for s in some])
        before = cell.before(d)
        for i, s in enumerate(some):
            row, come_from = d[:, i].tolist(), before[:, i].tolist()
            for r, ends in of_source[s].items():
                state, back = min(ends, key=row.__getitem__), []
                while state >= 0:
                    back.append(state)
                    state = come_from[state]
                walk = cell.states[back[::-1], 1].tolist()
                nodes[r] = [r[1], *walk] if r[2] is None else walk[1:]
    kept = [r for r in dict.fromkeys(rows) if r in nodes]
    cols = {k: pa.array([r[i] for r in kept], pa.string() if k == "kind" else pa.int64()) for i, k in enumerate(_LEG)}
    return pa.table(cols | {"nodes": pa.array([nodes[r] for r in kept], pa.list_(pa.int64()))})


def route_batch(pairs: DataFrame, edges: DataFrame, penalties: DataFrame, nodes: DataFrame, cell_nodes: int = 256) -> DataFrame:
    """pair, origin, destination, cost, path of the cheapest way of every request, with turn penalties.

    pairs: pair, origin, destination. edges: u, v, cost (one for each u, v; at least 0). penalties: a, b, c, penalty
    for each way on from edge (a, b) to (b, c). nodes: osmid, x, y. Costs count in thousandths; of equally dear ways one
    is chosen, always the same. Without a way, cost and path are null; from a node to itself the cost is 0. Requests
    between the same nodes are searched once; those between parts that no street links are not searched. ``cell_nodes``
    (four times as many in parts that are kept whole) bounds what one task works on, and the number of rounds is that of the cells which a way crosses.
    """
    steps = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"), (_weight(F.col("cost")) + edge_mark(F.col("u"), F.col("v"))).alias("w"))
    steps = stage(steps)
    cells = linked_cells(node_cells(nodes, cell_nodes), steps, cell_nodes)
    at = lambda n: cells.select(F.col("node").alias(n), F.col("cell").alias(f"cell_{n}"))
    where = lambda n: cells.select(F.col("node").alias(n), F.col("x").alias(f"x_{n}"), F.col("y").alias(f"y_{n}"))
    steps = stage(steps.join(at("u"), "u").join(at("v"), "v"))
    turns = penalties.select(*[F.col(k).cast("long").alias(k) for k in "abc"], "penalty")
    moves = turns.join(steps.select(F.col("u").alias("b"), F.col("v").alias("c"), "w", F.col("cell_u").alias("cell")), ["b", "c"]).select("cell", F.lit("move").alias("kind"), "a", "b", "c", (F.col("w") + _weight(F.col("penalty"))).alias("w"))
    none = F.lit(None).cast("long")
    inner = steps.select(F.col("cell_u").alias("cell"), F.lit("edge").alias("kind"), F.col("u").alias("a"), F.col("v").alias("b"), F.lit(0).cast("long").alias("c"), "w")
    enter = steps.where("cell_u <> cell_v").select(F.col("cell_v").alias("cell"), F.lit("enter").alias("kind"), F.col("u").alias("a"), F.col("v").alias("b"), F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("w"))
    graph = stage(moves.unionByName(inner).unionByName(enter))

    asked = pairs.select(F.col("origin").cast("long").alias("o"), F.col("destination").cast("long").alias("d")).where("o <> d").distinct()
    part = lambda n: cells.select(F.col("node").alias(n), F.col("cell").alias(f"cell_{n}"), F.col("component").alias(f"in_{n}"), "whole")
    asked = stage(asked.join(part("o"), "o").join(part("d").drop("whole"), "d").where("in_o = in_d").drop("in_o", "in_d"))
    cut = asked.where("not whole")
    asks = cut.select(F.col("cell_o").alias("cell"), F.lit("from").alias("kind"), F.col("o").alias("u"), none.alias("v")).union(cut.select("cell_d", F.lit("to"), none, "d")).distinct()
    asks = asks.union(asked.where("cell_o = cell_d").select("cell_o", F.lit("direct"), "o", "d"))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda rows: rows.repartition(parts, "cell").groupBy("cell")  # noqa: E731  by number: small cells are dear, so they aren't put together
    legs = stage(dealt(graph).cogroup(dealt(asks)).applyInArrow(_legs, _LEGS))

    open_ = cut.join(where("d"), "d").select("o", "d", "x_d", "y_d")

    gap = lambda a, b: F.sqrt(F.pow(F.col(f"x_{a}") - F.col(f"x_{b}"), 2) + F.pow(F.col(f"y_{a}") - F.col(f"y_{b}"), 2))
    rate = edges.select("u", "v", "cost").join(where("u"), "u").join(where("v"), "v").agg(F.min(F.when(gap("u", "v") > 0, F.col("cost") * UNITS / gap("u", "v")))).first()[0]
    left = F.shiftleft(F.greatest(F.floor((rate or 0.0) * (1 - 1e-9) * gap("v", "d")) - 1, F.lit(0)).cast("long"), LOW)  # never more than what is left to go
    leads = stage(legs.where("kind in ('from', 'across')").withColumnRenamed("to_v", "v").join(where("v"), "v"))
    start = leads.where("kind = 'from'").select(F.col("from_u").alias("o"), F.col("to_u").alias("u"), "v", "w", "x_v", "y_v")
    across = leads.where("kind = 'across'").select(F.col("from_u").alias("u"), F.col("from_v").alias("v"), F.col("to_u").alias("next_u"), F.col("v").alias("next_v"), F.col("w").alias("more"), F.col("x_v").alias("next_x"), F.col("y_v").alias("next_y"))
    final = legs.where("kind = 'to'").select(F.col("from_u").alias("u"), F.col("from_v").alias("v"), F.col("to_v").alias("d"), F.col("w").alias("more"))
    state, fixed = ["o", "d", "u", "v"], ["x_d", "y_d", "x_v", "y_v"]
    columns = [*state, "w", *fixed]
    direct = legs.where("kind = 'direct'").select(F.col("from_u").alias("o"), F.col("to_v").alias("d"), "w")
    arrived = direct

    def worth(rows: DataFrame) -> DataFrame:
        """States that can still beat the request's best arrival."""
        limit = arrived.groupBy("o", "d").agg(F.min("w").alias("limit"))
        return rows.join(limit, ["o", "d"], "left").where(F.col("limit").isNull() | (F.col("w") + left < F.col("limit"))).drop("limit")

    def arrivals(rows: DataFrame) -> DataFrame:
        return rows.join(final, ["u", "v", "d"]).groupBy("o", "d").agg(F.min(F.col("w") + F.col("more")).alias("w"))

    front = stage(worth(open_.join(start, "o")).select(*columns))
    arrived = stage(arrived.unionByName(arrivals(front)))
    known = front.select(*state, F.col("w").alias("had"))
    while True:
        ahead = worth(front).join(across, ["u", "v"])
        ahead = ahead.select("o", "d", F.col("next_u").alias("u"), F.col("next_v").alias("v"), (F.col("w") + F.col("more")).alias("w"), "x_d", "y_d", F.col("next_x").alias("x_v"), F.col("next_y").alias("y_v"))
        least = worth(ahead).groupBy(*state).agg(*[F.min(c).alias(c) for c in ("w", *fixed)])
        front = stage(least.join(known, [*[least[c] == known[c] for c in state], known["had"] <= least["w"]], "left_anti"))
        if front.isEmpty():
            break
        arrived = arrived.unionByName(stage(arrivals(front)))
        known = known.unionByName(front.select(*state, F.col("w").alias("had")))
    known = stage(known.groupBy(*state).agg(F.min("had").alias("had")))
    routes = stage(arrived.groupBy("o", "d").agg(F.min("w").alias("w")))

    # back along the crossings: the one before is that whose weight and the leg's make up the weight here
    none_u, none_v = none.alias("from_v"), none.alias("to_u")
    whole = routes.join(direct, ["o", "d", "w"]).select("o", "d", F.lit(0).alias("back"), F.lit("direct").alias("kind"), F.col("o").alias("from_u"), none_u, none_v, F.col("d").alias("to_v"))
    rest = routes.join(direct, ["o", "d", "w"], "left_anti").join(final, "d").join(known, state).where(F.col("had") + F.col("more") == F.col("w"))
    now = stage(rest.select("o", "d", "u", "v", F.col("had").alias("w")))
    legs_of, back = [whole, now.select("o", "d", F.lit(0), F.lit("to"), "u", "v", none, "d")], 0
    begun = start.select("o", "u", "v", "w")
    while not now.isEmpty():
        back += 1
        first = now.join(begun, ["o", "u", "v", "w"], "left_semi")
        ahead = now.join(begun, ["o", "u", "v", "w"], "left_anti").select("o", "d", F.col("u").alias("next_u"), F.col("v").alias("next_v"), F.col("w").alias("next_w"))
        step = ahead.join(across.select("u", "v", "next_u", "next_v", "more"), ["next_u", "next_v"]).join(known, state).where(F.col("had") + F.col("more") == F.col("next_w"))
        legs_of.append(first.select("o", "d", F.lit(back), F.lit("from"), "o", none, "u", "v"))
        step = stage(step.select("o", "d", "u", "v", F.col("had").alias("w"), "next_u", "next_v"))
        legs_of.append(step.select("o", "d", F.lit(back), F.lit("across"), "u", "v", "next_u", "next_v"))
        now = step
    every = legs_of[0]
    for more in legs_of[1:]:
        every = every.union(more)
    legs_of = stage(every)
    used = legs_of.select(*_LEG).distinct().withColumn("in_cell", F.coalesce("from_v", "from_u")).join(at("in_cell").withColumnRenamed("cell_in_cell", "cell"), "in_cell").drop("in_cell")
    spelled = dealt(graph).cogroup(dealt(used)).applyInArrow(_spell, _PATHS)
    alike = [legs_of[c].eqNullSafe(spelled[c]) for c in _LEG]
    paths = legs_of.join(spelled, alike).groupBy("o", "d").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("pos"), "nodes"))), lambda s: s["nodes"])).alias("path"))
    found = stage(routes.select("o", "d", "w").join(paths, ["o", "d"]))
    out = pairs.join(found, (pairs["origin"] == found["o"]) & (pairs["destination"] == found["d"]), "left")
    same = F.col("origin") == F.col("destination")
    return out.select("pair", "origin", "destination", F.when(same, 0.0).otherwise(F.shiftright("w", LOW) / F.lit(float(UNITS))).alias("cost"), F.when(same, F.array(F.col("origin").cast("long"))).otherwise(F.col("path")).alias("path"))
