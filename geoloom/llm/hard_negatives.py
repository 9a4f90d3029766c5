"""Hard-negative mining over STR-packed R-trees.

Rows are tiled as Sort-Tile-Recursive packing does: slabs of equal counts along the coordinate that varies most, tiles
of equal counts along the next within each slab; a tile with more rows than a chunk holds (many equal vectors) is split by
id. Within a chunk the same packing goes on over further coordinates, down to pages of some rows, and minimum bounding
boxes are kept over pages and over runs of pages. A box gives an interval for every coordinate, and so bounds of the
inner product with an anchor from below and above.

Anchors are packed into blocks. A block goes through a chunk's boxes with one best-first queue, by the greatest upper bound
of its anchors: a box is opened only for anchors whose windows it meets and whose k-th score it reaches; a box strictly
below the k-th score or outside all windows is dropped. The first search finds each anchor's positives, the second the
negatives in the windows that their scores open. Chunks whose box misses all windows of a block aren't sent to it.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.vectors import coded, decoded, first_of, longs, matrix, one_each, product, whole_vectors
from geoloom.session import stage

PAGE, FAN = 64, 8


def str_order(x: np.ndarray, page: int = PAGE, axes: int = 3) -> np.ndarray:
    """The order of rows in an STR-packed tree: slabs along the coordinate that varies most, then along the next."""
    by = np.argsort(-x.std(0), kind="stable")[: max(1, min(axes, x.shape[1]))] if x.shape[1] else []

    def tile(rows: np.ndarray, by: np.ndarray) -> np.ndarray:
        rows = rows[np.argsort(x[rows, by[0]], kind="stable")]
        pages = -(-len(rows) // page)
        if len(by) == 1 or pages == 1:
            return rows
        run = -(-pages // int(np.ceil(pages ** (1 / len(by))))) * page
        return np.concatenate([tile(rows[i : i + run], by[1:]) for i in range(0, len(rows), run)])

    rows = np.arange(len(x))
    return tile(rows, by) if len(by) else rows


def boxes(x: np.ndarray, page: int = PAGE, fan: int = FAN) -> list[tuple[np.ndarray, np.ndarray]]:
    """(least, greatest) of every box, level by level from the pages up to one box."""
    at = np.arange(0, len(x), page)
    levels = [(np.minimum.reduceat(x, at), np.maximum.reduceat(x, at))]
    while len(levels[-1][0]) > 1:
        low, high = levels[-1]
        at = np.arange(0, len(low), fan)
        levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
    return levels


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query with each box."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    return product(plus, low) + product(minus, high), product(plus, high) + product(minus, low)


def search(q: np.ndarray, x: np.ndarray, allowed: Callable[[np.ndarray], np.ndarray], low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, window, row, score) of rows that may be among the ``k`` best of a query's window; ``x`` is in tree order.

    ``low`` and ``high``: queries x windows, scores that count (both ends in). ``allowed(rows)``: queries x rows.
    """
    levels, n, ways = boxes(x), len(q), low.shape[1]
    reach = [bounds(q, *level) for level in levels]
    kth = np.array(low, copy=True)  # a score has to reach this
    best = np.full((n, ways, k), -np.inf) if kth.dtype != object else np.full((n, ways, k), -float("inf"), object)
    found: list[tuple[np.ndarray, ...]] = []

    def open_for(level: int, box: int, among: np.ndarray) -> np.ndarray:
        under, over = reach[level][0][among, box], reach[level][1][among, box]
        return among[((over[:, None] >= kth[among]) & (under[:, None] <= high[among])).any(1)]

    top = len(levels) - 1
    queue = [(-reach[top][1][:, 0].max(), top, 0, np.arange(n))] if n else []
    while queue:
        _, level, box, among = heapq.heappop(queue)
        among = open_for(level, box, among)
        if not len(among):
            continue
        if level:
            for child in range(box * FAN, min((box + 1) * FAN, len(levels[level - 1][0]))):
                if len(some := open_for(level - 1, child, among)):
                    heapq.heappush(queue, (-reach[level - 1][1][some, child].max(), level - 1, child, some))
            continue
        rows = np.arange(box * PAGE, min((box + 1) * PAGE, len(x)))
        scores, may = product(q[among], x[rows]), allowed(rows)[among]
        for w in range(ways):
            fits = may & (scores >= kth[among, w][:, None]) & (scores <= high[among, w][:, None])
            hit = np.flatnonzero(fits.any(1))
            if not len(hit):
                continue
            i, j = np.nonzero(fits[hit])
            found.append((among[hit[i]], np.full(len(i), w), rows[j], scores[hit[i], j]))
            both = np.concatenate([best[among[hit], w], np.where(fits[hit], scores[hit], -np.inf)], axis=1)
            both = np.sort(both, axis=1)[:, ::-1][:, :k]
            best[among[hit], w] = both
            kth[among[hit], w] = np.maximum(kth[among[hit], w], both[:, -1])
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(z) for z in zip(*found, strict=True))


def _pack(keys: tuple[str, ...], tree: bool):
    def pack(table: pa.Table) -> pa.Table:
        x, ids, labels = matrix(table.column("v")), table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        order = str_order(x) if tree else np.argsort(ids)
        x, n = x[order], len(ids)
        one = {"n": pa.array([n], pa.int32()), "dim": pa.array([x.shape[1]], pa.int32()), "ids": pa.array([ids[order].tobytes()], pa.binary()), "labels": pa.array([labels[order].astype(np.int64).tobytes()], pa.binary()), "exact": pa.array([coded(x)], pa.binary())}
        return pa.table({k: table.column(k).slice(0, 1) for k in keys} | one | {"low": pa.array([x.min(0).tolist()], pa.list_(pa.float64())), "high": pa.array([x.max(0).tolist()], pa.list_(pa.float64()))})

    return pack


_PACKED = "n int, dim int, ids binary, labels binary, exact binary, low array<double>, high array<double>"


def pack_trees(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """One row for each chunk (numbered from 0) of ``rows`` (vec_id, label, v): its rows in tree order, and its box. Staged."""
    most = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    chunks = -(-most.n // chunk_rows)
    slabs = max(1, round(chunks**0.5))
    spread = rows.agg(*[F.stddev(F.get("v", F.lit(i))).alias(str(i)) for i in range(most.dim or 0)]).first() if most.dim else ()
    by = sorted(range(len(spread)), key=lambda i: -(spread[i] or 0))[:2] or [0]
    first, second = (F.coalesce(F.get("v", F.lit(i)), F.lit(0.0)) for i in (by[0], by[-1]))
    cuts = lambda c: F.percentile_approx(c, [i / slabs for i in range(1, slabs)], 10 * slabs) if slabs > 1 else F.array().cast("array<double>")
    place = lambda c, at: F.size(F.filter(at, lambda z: z < c))
    line = rows.select("vec_id", first.alias("x"), second.alias("y"))
    slab_at = F.broadcast(line.agg(cuts(F.col("x")).alias("slab_at")))  # one row of sqrt(n / chunk_rows) numbers
    line = stage(line.join(slab_at).select("vec_id", "y", place(F.col("x"), "slab_at").alias("slab")))
    tile_at = line.groupBy("slab").agg(cuts(F.col("y")).alias("tile_at"))
    tiled = line.join(tile_at, "slab").select("vec_id", "slab", place(F.col("y"), "tile_at").alias("tile"))
    sizes = tiled.groupBy("slab", "tile").agg(F.ceil(F.count(F.lit(1)) / chunk_rows).alias("parts"))
    dealt = tiled.join(sizes, ["slab", "tile"]).select("vec_id", "slab", "tile", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"))
    keys = ("slab", "tile", "part")
    packed = rows.join(dealt, "vec_id").groupBy(*keys).applyInArrow(_pack(keys, True), f"slab int, tile int, part int, {_PACKED}")
    return stage(packed.drop("part").withColumn("chunk", F.xxhash64("slab", "tile", "ids")).drop("slab", "tile"))


def _meets(low: Column, high: Column, q_low: Column, q_high: Column, worst: str) -> Column:
    """Bound of the inner product of any vector in one box with any in another."""
    ends = F.zip_with(F.arrays_zip(low.alias("a"), high.alias("b")), F.arrays_zip(q_low.alias("c"), q_high.alias("d")), lambda s, t: F.array(*[F.coalesce(s[i], F.lit(0.0)) * F.coalesce(t[j], F.lit(0.0)) for i in "ab" for j in "cd"]))
    return F.aggregate(F.transform(ends, F.array_max if worst == "high" else F.array_min), F.lit(0.0), lambda a, b: a + b)


def _search_all(asked: DataFrame, chunks: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run(block, chunk)`` for every pair of ``asked`` (chunk, block fields named q_*) and its chunk."""
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = asked.repartition(parts, "chunk").join(chunks.repartition(parts, "chunk"), "chunk")
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                dim = max(row["dim"], row["q_dim"])
                side = lambda p: (np.frombuffer(row[f"{p}ids"], np.int64), np.frombuffer(row[f"{p}labels"], np.int64), decoded(row[f"{p}exact"], row[f"{p}n"], dim))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in run(row, side("q_"), side(""))], names)

    return pairs.mapInArrow(work, schema)


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = 256, noisy: int = 7, labels: int = 10, chunk_rows: int = 4096, block_rows: int = 1024) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); where vec_id is divisible by ``noisy``, label becomes (label + 1) % ``labels``.
    Anchors are rows whose vec_id is divisible by ``every``. Scores are integer inner products, higher first, ties to
    smaller vec_id. An anchor's positives are its first other rows of its label; for each, negatives are the first rows
    of other labels with window[0] * positive <= 100 * negative <= window[1] * positive, so a negative positive score
    has none, and a score of 0 only rows of score 0.

    Rows without vec_id, label or vector, and those with a null or non-finite component, take no part. Of rows that
    repeat a vec_id the one with the least (label, vector) counts. Vectors of unequal length are compared as if the
    shorter ended in zeros; an empty vector scores 0. Scores are exact at any size; one that 64 bits can't hold becomes
    the nearest that they can. An anchor alone with its label has no rows; an empty table gives none. Other columns
    aren't read.
    """
    label = F.col("label").cast("long")
    rows = whole_vectors(vectors.where("label is not null"), scale, "label").withColumn("label", F.when(F.col("vec_id") % noisy == 0, (label + 1) % labels).otherwise(label))
    rows = stage(one_each(rows, "label"))
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-anchors.count() // block_rows))
    chunks = pack_trees(rows, chunk_rows)
    fields = ["n", "dim", "ids", "labels", "exact", "low", "high"]
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    packed = anchors.withColumn("block", block).groupBy("block").applyInArrow(_pack(("block",), False), f"block int, {_PACKED}")
    packed = stage(packed.select("block", *[F.col(c).alias(f"q_{c}") for c in fields]))
    every_chunk = chunks.select("chunk", F.col("low").alias("c_low"), F.col("high").alias("c_high"))
    met = packed.join(every_chunk)  # blocks of anchors against all chunks, by number and box only
    inner = chunks.drop("low", "high")

    def of_label(row: dict, a: tuple, c: tuple) -> tuple[np.ndarray, ...]:
        (a_ids, a_labels, q), (ids, lab, x) = a, c
        allowed = lambda r: (a_labels[:, None] == lab[r]) & (a_ids[:, None] != ids[r])
        ends = np.full((len(q), 1), np.inf)
        i, _, j, s = search(q, x, allowed, -ends, ends, positives)
        top = first_of(i, ids[j], s, positives) if len(i) else i
        return a_ids[i[top]], ids[j[top]], longs(s[top])

    schema = "anchor_id long, positive_id long, positive_score long"
    near = _search_all(met.drop("c_low", "c_high", "q_low", "q_high"), inner, of_label, schema)
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    near = stage(near.withColumn("place", rank).where(F.col("place") <= positives))

    # ends of the windows, in whole scores
    tens = F.expr("(positive_score - pmod(positive_score, 100L)) div 100")
    lo = tens * window[0] + F.expr(f"-((-{window[0]}L * pmod(positive_score, 100L) - pmod(-{window[0]}L * pmod(positive_score, 100L), 100L)) div 100)")
    hi = tens * window[1] + F.expr(f"({window[1]}L * pmod(positive_score, 100L) - pmod({window[1]}L * pmod(positive_score, 100L), 100L)) div 100")
    asked = near.select(F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int").alias("block"), "anchor_id", "positive_id", "positive_score", lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    windows = asked.groupBy("block").agg(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score", "lo", "hi")).alias("q_windows"), F.min("lo").cast("double").alias("least"), F.max("hi").cast("double").alias("most"))
    over = _meets(F.col("c_low"), F.col("c_high"), F.col("q_low"), F.col("q_high"), "high")
    under = _meets(F.col("c_low"), F.col("c_high"), F.col("q_low"), F.col("q_high"), "low")
    slack = (F.abs(over) + F.abs(under)) * 1e-9 + 1  # sums of doubles are rounded
    second = met.join(windows, "block").where((over + slack >= F.col("least")) & (under - slack <= F.col("most"))).drop("c_low", "c_high", "q_low", "q_high", "least", "most")

    def of_windows(row: dict, a: tuple, c: tuple) -> tuple[np.ndarray, ...]:
        (a_ids, a_labels, q), (ids, lab, x) = a, c
        where = {v: i for i, v in enumerate(a_ids.tolist())}
        ways: list[list[dict]] = [[] for _ in a_ids]
        for w in row["q_windows"]:
            ways[where[w["anchor_id"]]].append(w)
        wide = max(map(len, ways))
        low, high = np.full((len(q), wide), np.inf), np.full((len(q), wide), -np.inf)
        if any(abs(w[e]) >= 2**53 for w in row["q_windows"] for e in ("lo", "hi")):
            low, high = low.astype(object), high.astype(object)
        for i, own in enumerate(ways):
            for j, w in enumerate(own):
                low[i, j], high[i, j] = w["lo"], w["hi"]
        allowed = lambda r: a_labels[:, None] != lab[r]
        i, w, j, s = search(q, x, allowed, low, high, negatives)
        top = first_of(i * wide + w, ids[j], s, negatives) if len(i) else i
        i, w, j, s = i[top], w[top], j[top], s[top]
        return a_ids[i], np.array([ways[m][n]["positive_id"] for m, n in zip(i, w, strict=True)], np.int64), np.array([ways[m][n]["positive_score"] for m, n in zip(i, w, strict=True)], np.int64), ids[j], longs(s)

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    hard = _search_all(second, inner, of_windows, schema)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return hard.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
with v as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as e from embeddings
  where vec_id is not null and label is not null and embedding is not null and len([1 for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
), s as (
  select a.vec_id as a, b.vec_id as b, a.label = b.label as same, cast(coalesce(list_sum([z[1] * z[2] for z in list_zip(a.e, b.e)]), 0) as bigint) as score
  from v a join v b on a.vec_id % 50 = 0 and b.vec_id <> a.vec_id
), p as (
  select a, b, score from (select *, row_number() over (partition by a order by score desc, b) as k from s where same) where k <= 5
), n as (
  select p.a, p.b as pos, p.score as pos_score, s.b as neg, s.score as neg_score, row_number() over (partition by p.a, p.b order by s.score desc, s.b) as rank
  from p join s on s.a = p.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
)
select a as anchor_id, pos as positive_id, cast(rank as integer) as rank, neg as negative_id, pos_score as positive_score, neg_score as negative_score from n where rank <= 3
"""
