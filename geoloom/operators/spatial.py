"""Distance joins as equi-joins on grid cells with an exact filter.

A point lies in one cell; a line goes to every cell that its eps-wide surroundings touch. So a point meets a line at
most once, and no pair needs removing afterwards. Two lines may share several cells; their pair is kept only in the
cell of the lower-left corner of the boxes' intersection. Joins are plain shuffle joins on (cx, cy), which adaptive
execution splits where a cell is crowded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.geo import cell_of, line_line, local_metres, point_line, point_segment, segment_segment
from geoloom.session import stage

CELL = 0.002


def _cells(lo: Column, hi: Column, cell: float) -> Column:
    return F.explode(F.sequence(cell_of(lo, cell), cell_of(hi, cell)))


def _ends(line: str) -> list[Column]:
    """x0, y0, x1, y1 of a line's first leg, as plain numbers."""
    a, b = F.element_at(line, 1), F.element_at(line, 2)
    return [a["x"], a["y"], b["x"], b["y"]]


def line_cells(lines: DataFrame, line: str, eps: float, cell: float) -> DataFrame:
    """Lines once for each cell (cx, cy) that a leg's box, widened by eps, touches; with the line's widened box (_x0, _y0,
    _x1, _y1), and for lines of one leg its ends (_ax, _ay, _bx, _by)."""
    one = lines.where(F.size(line) == 2).withColumns(dict(zip(("_ax", "_ay", "_bx", "_by"), _ends(line), strict=True)))
    one = one.withColumns(
        {"_x0": F.least("_ax", "_bx") - eps, "_y0": F.least("_ay", "_by") - eps, "_x1": F.greatest("_ax", "_bx") + eps, "_y1": F.greatest("_ay", "_by") + eps}
    )
    one = one.withColumn("cx", _cells(F.col("_x0"), F.col("_x1"), cell)).withColumn("cy", _cells(F.col("_y0"), F.col("_y1"), cell))
    legs = F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def of_leg(s: Column) -> Column:
        xs = F.sequence(cell_of(F.least(s["a"]["x"], s["b"]["x"]) - eps, cell), cell_of(F.greatest(s["a"]["x"], s["b"]["x"]) + eps, cell))
        ys = F.sequence(cell_of(F.least(s["a"]["y"], s["b"]["y"]) - eps, cell), cell_of(F.greatest(s["a"]["y"], s["b"]["y"]) + eps, cell))
        return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(x.alias("cx"), y.alias("cy")))))

    many = lines.where(F.size(line) > 2).withColumns({f"_{k}": v for k, v in _box(line, eps).items()})
    many = many.withColumn("_cell", F.explode(F.array_distinct(F.flatten(F.transform(legs, of_leg))))).select("*", "_cell.*").drop("_cell")
    return one.unionByName(many, allowMissingColumns=True)


def point_line_within(points: DataFrame, lines: DataFrame, eps: float, x: str = "px", y: str = "py", line: str = "line", cell: float = CELL) -> DataFrame:
    """Inner join of points and lines at most eps apart, with the distance. Boxes are tested first; for lines of one leg
    the distance is plain arithmetic on numbers."""
    located = points.withColumns({"cx": cell_of(F.col(x), cell), "cy": cell_of(F.col(y), cell)})
    # distances are rounded to 9 places, so boxes are a little wider
    met = located.join(line_cells(lines, line, eps + 1e-9, cell), ["cx", "cy"]).where(F.col(x).between(F.col("_x0"), F.col("_x1")) & F.col(y).between(F.col("_y0"), F.col("_y1")))
    own = [F.col(c) for c in ("_ax", "_ay", "_bx", "_by")]
    distance = F.when(F.col("_ax").isNotNull(), point_segment(F.col(x), F.col(y), *own)).otherwise(point_line(F.col(x), F.col(y), F.col(line)))
    extra = ("cx", "cy", "_ax", "_ay", "_bx", "_by", "_x0", "_y0", "_x1", "_y1")
    return met.withColumn("distance", F.round(distance, 9)).where(F.col("distance") <= eps).drop(*extra)


def _box(line: str, wide: float) -> dict[str, Column]:
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return {"x0": F.array_min(xs) - wide, "x1": F.array_max(xs) + wide, "y0": F.array_min(ys) - wide, "y1": F.array_max(ys) + wide}


def line_line_within(left: DataFrame, right: DataFrame, eps: float, left_line: str = "line", right_line: str = "route", cell: float = CELL) -> DataFrame:
    """Inner join of lines at most eps apart, with the distance. Columns must differ by name."""

    def spread(df: DataFrame, line: str, wide: float, tag: str) -> DataFrame:
        df = df.withColumns({f"_{tag}{k}": v for k, v in _box(line, wide).items()})
        return df.withColumn("cx", _cells(F.col(f"_{tag}x0"), F.col(f"_{tag}x1"), cell)).withColumn("cy", _cells(F.col(f"_{tag}y0"), F.col(f"_{tag}y1"), cell))

    met = spread(left, left_line, eps + 1e-9, "l").join(spread(right, right_line, 0.0, "r"), ["cx", "cy"])
    here = (F.col("cx") == cell_of(F.greatest("_lx0", "_rx0"), cell)) & (F.col("cy") == cell_of(F.greatest("_ly0", "_ry0"), cell))
    touch = (F.col("_lx0") <= F.col("_rx1")) & (F.col("_rx0") <= F.col("_lx1")) & (F.col("_ly0") <= F.col("_ry1")) & (F.col("_ry0") <= F.col("_ly1"))
    met = met.where(here & touch).drop("cx", "cy", *[f"_{t}{k}" for t in "lr" for k in ("x0", "x1", "y0", "y1")])
    # lines of one leg each need no arrays
    plain = segment_segment(_ends(left_line), _ends(right_line))
    distance = F.when((F.size(left_line) == 2) & (F.size(right_line) == 2), plain).otherwise(line_line(F.col(left_line), F.col(right_line)))
    return met.withColumn("distance", F.round(distance, 9)).where(F.col("distance") <= eps)


def near_pairs(nodes: DataFrame, metres: float, mean_latitude: float, key: str = "osmid") -> DataFrame:
    """Pairs (a < b) of nodes at most so many local metres apart: the left node looks into its own and all neighbour cells."""
    mx, my = local_metres(F.col("x"), F.col("y"), F.lit(mean_latitude))
    at = nodes.select(F.col(key).alias("id"), mx.alias("mx"), my.alias("my")).withColumns({"cx": cell_of(F.col("mx"), metres), "cy": cell_of(F.col("my"), metres)})
    around = at.withColumn("cx", F.explode(F.array(*[F.col("cx") + d for d in (-1, 0, 1)]))).withColumn("cy", F.explode(F.array(*[F.col("cy") + d for d in (-1, 0, 1)])))
    a = around.select(F.col("id").alias("a"), F.col("mx").alias("ax"), F.col("my").alias("ay"), "cx", "cy")
    b = at.select(F.col("id").alias("b"), F.col("mx").alias("bx"), F.col("my").alias("by"), "cx", "cy")
    gap = F.sqrt(F.pow(F.col("ax") - F.col("bx"), 2) + F.pow(F.col("ay") - F.col("by"), 2))
    return a.join(b, ["cx", "cy"]).where("a < b").withColumn("metres", F.round(gap, 6)).where(F.col("metres") <= metres).select("a", "b", "metres")


def nearest_node(points: DataFrame, nodes: DataFrame, key: str, cell: float = CELL) -> DataFrame:
    """Each point's nearest node (ties to the smaller id).

    points: key, px, py. nodes: osmid, x, y. Points with a node within a cell's width find it among the neighbour cells.
    The others go down a pyramid of the cells that hold nodes: at each level a point keeps the cells that can be nearer
    than the farthest corner of its best one, so a far point meets a few cells of each size, never all nodes. Every
    located point gets a row if there is a node; points without coordinates get none.
    """
    left = points.select(key, "px", "py").where("px is not null and py is not null")
    n = nodes.select("osmid", F.col("x").alias("nx"), F.col("y").alias("ny")).where("nx is not null and ny is not null")
    n = stage(n.withColumns({"cx": cell_of(F.col("nx"), cell), "cy": cell_of(F.col("ny"), cell)}))
    distance = F.round(F.sqrt(F.pow(F.col("px") - F.col("nx"), 2) + F.pow(F.col("py") - F.col("ny"), 2)), 9)

    def nearest(met: DataFrame) -> DataFrame:
        best = met.groupBy(key).agg(F.min(F.struct(distance.alias("distance"), F.col("osmid"))).alias("b"))
        return best.select(key, "b.osmid", "b.distance")

    around = left.withColumns({"cx": cell_of(F.col("px"), cell), "cy": cell_of(F.col("py"), cell)})
    around = around.withColumn("cx", F.explode(F.array(*[F.col("cx") + d for d in (-1, 0, 1)]))).withColumn("cy", F.explode(F.array(*[F.col("cy") + d for d in (-1, 0, 1)])))
    found = stage(nearest(around.join(n, ["cx", "cy"])).where(F.col("distance") <= cell))
    left = stage(left.join(found.select(key), key, "left_anti"))
    if left.isEmpty():
        return found

    box = n.agg(F.min("cx").alias("x0"), F.max("cx").alias("x1"), F.min("cy").alias("y0"), F.max("cy").alias("y1")).first()
    if box["x0"] is None:
        return found
    level = max(box["x1"] - box["x0"], box["y1"] - box["y0"]).bit_length()  # here all nodes lie in four cells at most
    at = lambda up: n.select(F.shiftright("cx", up).alias("cx"), F.shiftright("cy", up).alias("cy")).distinct()
    open_ = left.join(F.broadcast(at(level)))  # by at most four cells
    while True:
        wide = cell * 2**level
        near = lambda p, c: F.greatest(F.col(c) * wide - F.col(p), F.col(p) - (F.col(c) + 1) * wide, F.lit(0.0))
        far = lambda p, c: F.greatest(F.abs(F.col(c) * wide - F.col(p)), F.abs((F.col(c) + 1) * wide - F.col(p)))
        size = lambda f: F.sqrt(F.pow(f("px", "cx"), 2) + F.pow(f("py", "cy"), 2))
        ranged = open_.withColumns({"low": size(near), "high": size(far)})
        bound = ranged.groupBy(key).agg(F.min("high").alias("bound"))
        open_ = stage(ranged.join(bound, key).where(F.col("low") <= F.col("bound") + 2e-9).select(key, "px", "py", "cx", "cy"))
        if not level:
            return found.unionByName(nearest(open_.join(n, ["cx", "cy"])))
        level -= 1
        below = lambda c: F.explode(F.array(F.col(c) * 2, F.col(c) * 2 + 1))
        open_ = open_.withColumn("cx", below("cx")).withColumn("cy", below("cy")).join(at(level), ["cx", "cy"])
