"""Links inside crowds: documents that share most of a template, where all pairs would be a group's square.

Two sets that reach ``percent`` share one of the first n - ceil(percent * n / 100) + 1 shingles of either, in any one order
of all shingles; here the rarest come first, and those of a single document need no partner. All pairs that share a leading
shingle of at most ``FEW`` documents are taken (exact). What only commoner shingles lead are variants of one text. MinHash
tells variants at 0.66 and at 0.76 apart badly, so each of these documents is described by what sets it apart:

- Documents with the same first minimum in a tree are a region. Its template is the set of shingles that more than half of
  a sample of the region hold; the sample is bounded and any template gives right results, only the speed depends on it.
- With D ^ T for a set's difference from the template, D ^ E = (D ^ T) ^ (E ^ T): distances stay as they are while what
  all have in common is gone. So ``far`` = |D ^ T| bounds distances, and small differences are told apart by their own minima.
- By the triangle inequality, D and E are linked if far(D) + far(E) is small enough. Of all documents of a region the one
  with the most slack is linked to every document that any other could be linked to in this way, so one link each gives the
  component of all of them, without pairs.
- The others need common differences, whose least number follows from the sizes. A forest over the differences, with
  permutations of its own for each region, brings these together; a sketch of the differences drops pairs that miss that
  number by over four standard deviations before anything is emitted. Here a row looks back at ``LOOK`` rows in each of
  ``REGIONS`` x ``ORDERS`` orders, so a pair can be missed: nothing exact takes the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrow import WORD_BYTES, mix, shingle_sets, slices
from geoloom.llm.skew import spread
from geoloom.session import stage

#: Documents of a leading shingle all of whose pairs are looked at.
FEW = 16
#: Trees whose first minima make regions. Two sets at 0.75 share at least one of these in 0.9998 of cases.
REGIONS = 6
#: Documents of a region that its template is taken from, on average.
SAMPLE = 32
#: Orders of each region, minima of a label, and rows that a row looks back at.
ORDERS, DEPTH, LOOK = 6, 4, 64
#: Minima of a sketch, one byte each.
PLACES = 96
#: Bytes that are sent to every executor at most.
BROADCAST_BYTES = 32 << 20


def leading_sets(docs: DataFrame, reps: DataFrame, k: int, percent: int, depth: int) -> DataFrame:
    """Staged id, n, own (shingles of this document alone), lead (array of f, g), shared (array of g), heads (its regions).

    docs: doc_id, text of the crowd; reps: doc_id, sig. f: documents of the crowd that hold shingle g.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=WORD_BYTES):
            flat, sizes = shingle_sets(batch, k)
            row = np.repeat(np.arange(len(sizes)), sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(np.repeat(sizes, sizes)), pa.array(flat.view(np.int64))], ["id", "n", "g"])

    held = stage(docs.select("doc_id", "text").mapInArrow(grams, "id long, n long, g long"))
    often = stage(held.groupBy("g").agg(F.count(F.lit(1)).alias("f")).where("f > 1"))
    rows, counts, keys = spread(held, often, ["g"], "f", F.col("id"))
    # a document without any shared shingle has no partner
    sets = rows.join(counts, keys).groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("f", "g"))).alias("fg"))
    heads = ", ".join(f"xxhash64({t}, substring(sig, {4 * depth * t + 1}, 4))" for t in range(REGIONS))
    lead = f"slice(fg, 1, cast(greatest(n - (n * {percent} + 99) div 100 + 1 - (n - size(fg)), 0) as int)) as lead"
    return stage(sets.join(reps.withColumnRenamed("doc_id", "id"), "id").selectExpr("id", "n", "n - size(fg) as own", lead, "fg.g as shared", f"array({heads}) as heads"))


def few_pairs(sets: DataFrame, of: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) in different components that share a rare leading shingle and may reach the bar by size alone."""
    rare = sets.select("id", "n", F.explode("lead").alias("x")).where(F.col("x.f") <= FEW).join(of.withColumnRenamed("node", "id"), "id", "left")
    p, q = (rare.select("x.g", F.coalesce("component", "id").alias(f"c{x}"), F.col("id").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    return p.join(q, "g").where(f"ca < cb and 100 * least(na, nb) >= {percent} * greatest(na, nb)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _to_rows(rows: DataFrame, groups: DataFrame, size: int) -> DataFrame:
    """Rows with their region's columns; ``size`` bytes for all groups, which are staged and have run and held."""
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(groups), "run")
    left, right, keys = spread(rows, groups, ["run"], "held", F.col("id"))
    return left.join(right, keys)


def region_rows(sets: DataFrame) -> DataFrame:
    """Staged run, id, n, far, held, labels (``ORDERS`` labels end to end) and sketch of each document in each of its regions."""
    apart = sets.where(F.exists("lead", lambda x: x["f"] > FEW))
    heads = apart.select("id", F.explode(F.array_distinct("heads")).alias("run"))
    held = stage(heads.groupBy("run").agg(F.count(F.lit(1)).alias("held")).where("held > 1"))
    small = held.count() * 16
    some = stage(_to_rows(heads, held, small).where(f"pmod(xxhash64(id, run), held) < {SAMPLE}").select("id", "run"))
    votes = some.join(apart.select("id", F.explode("shared").alias("g")), "id").groupBy("run", "g").agg(F.count(F.lit(1)).alias("votes"))
    most = votes.join(some.groupBy("run").agg(F.count(F.lit(1)).alias("cast")), "run").where("2 * votes > cast").groupBy("run").agg(F.collect_list("g").alias("template"))
    regions = stage(held.join(most, "run", "left").select("run", "held", F.coalesce("template", F.array().cast("array<long>")).alias("template")))
    size = regions.agg(F.sum(F.size("template") * 8 + 64)).first()[0] or 0

    rng = np.random.Generator(np.random.PCG64(11))
    total = ORDERS * DEPTH + PLACES
    factor = rng.integers(0, 2**31, total, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 2**32, total, dtype=np.uint32)

    def sketch(rows: pa.RecordBatch) -> pa.RecordBatch:
        run = rows.column("run").to_numpy()
        parts = []
        for i in range(rows.num_rows):
            mine, common = (rows.column(c)[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in ("shared", "template"))
            parts.append(mix(np.setxor1d(mine, common, assume_unique=True) ^ mix(run[i : i + 1].view(np.uint64))))
        sizes = np.array([len(x) for x in parts], np.int64)
        full = np.flatnonzero(sizes)
        out = np.full((rows.num_rows, total), 2**32 - 1, np.uint32)
        if len(full):
            short = (np.concatenate(parts) >> np.uint64(32)).astype(np.uint32)
            first = np.cumsum(sizes[full]) - sizes[full]
            for j in range(total):
                v = short * factor[j] + shift[j]
                v ^= v >> np.uint32(15)
                out[full, j] = np.minimum.reduceat(v * np.uint32(0x2C1B3C6D), first)
        own, n = rows.column("own").to_numpy(), rows.column("n").to_numpy()
        numbers = np.ascontiguousarray(np.stack([sizes, own, n], 1).astype("<i8")).view(np.uint8)
        tail = np.concatenate([numbers, (out[:, ORDERS * DEPTH :] & np.uint32(255)).astype(np.uint8)], 1)
        labels = out[:, : ORDERS * DEPTH].astype(">u4")
        cols = [rows.column("run"), rows.column("id"), rows.column("n"), pa.array(sizes + own), rows.column("held"), pa.array([x.tobytes() for x in labels], pa.binary()), pa.array([x.tobytes() for x in tail], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, ["run", "id", "n", "far", "held", "labels", "sketch"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.cumsum(np.asarray(batch.column("wide"), np.int64))
            at = 0
            while at < batch.num_rows:
                done = weight[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(weight, done + (1 << 20), "right")))
                yield sketch(batch.slice(at, end - at))
                at = end

    rows = apart.select("id", "n", "own", "shared", F.explode(F.array_distinct("heads")).alias("run"))
    rows = _to_rows(rows, regions, size).withColumn("wide", F.size("shared") + F.size("template"))
    return stage(rows.select("run", "id", "n", "own", "held", "wide", "shared", "template").mapInArrow(run, "run long, id long, n long, far long, held long, labels binary, sketch binary"))


def star_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a < b) of a region's document with the most slack to all that the sizes of the differences alone prove linked."""
    slack = rows.selectExpr("run", "id", "held", f"{100 + percent} * far - {100 - percent} * n as slack")
    best = stage(slack.groupBy("run").agg(F.min(F.struct("slack", "id")).alias("best"), F.max("held").alias("held")))
    met = _to_rows(slack.drop("held"), best, best.count() * 40).where("id <> best.id and slack + best.slack <= 0")
    return met.select(F.least("id", "best.id").alias("a"), F.greatest("id", "best.id").alias("b")).distinct()


def region_labels(rows: DataFrame, of: DataFrame) -> DataFrame:
    """tree, label, doc_id, part, sketch of each order of each region. of: node, component."""
    orders = F.transform(F.sequence(F.lit(0), F.lit(ORDERS - 1)), lambda j: F.struct(F.xxhash64("run", j).alias("tree"), F.substring("labels", j * (4 * DEPTH) + 1, F.lit(4 * DEPTH)).alias("label")))
    part = rows.join(of.withColumnRenamed("node", "id"), "id", "left").withColumn("x", F.explode(orders))
    return part.select("x.tree", "x.label", F.col("id").alias("doc_id"), F.coalesce("component", "id").alias("part"), "sketch")


def may_reach(percent: int):
    """Test of two equally long arrays of sketches: could these pairs reach ``percent`` by common differences?"""

    def test(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        (dx, ox, nx), (dy, oy, ny) = (np.ascontiguousarray(s[:, :24]).view("<i8").T for s in (x, y))
        # numbers of differences that have to be common: at most (100 - percent) / (100 + percent) of both sizes may differ
        need = -((-(dx + dy + ox + oy) + (nx + ny) * (100 - percent) // (100 + percent)) // 2)
        able = (need > 0) & (need <= np.minimum(dx, dy))  # need <= 0: linked to the region's best document
        ok = np.zeros(len(x), bool)
        at = np.flatnonzero(able)
        if len(at):
            share = need[at] / (dx[at] + dy[at] - need[at])
            equal = (x[at, 24:] == y[at, 24:]).mean(1)
            ok[at] = equal >= share - 4 * np.sqrt(share * (1 - share) / PLACES)
        return ok

    return test
