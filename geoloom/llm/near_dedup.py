"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Every document's distinct word shingles give a signature of trees x depth minima. Documents with one and the same set
are a class; one of them stands for it. For each tree all representatives are put in the order of the tree's label
(its minima, most significant first) by a range shuffle, and each looks back at the nearest rows of that order whose
label shares a prefix with its own: the longest-common-prefix neighbours, at most trees x look pairs a row. The rows before
a partition's first ones, one packed row from each partition that holds some, are looked at in a second, small step.

A tree can lose a pair only where it shares no minimum or where ``look`` rows stand between the two, all with their
first minimum. Documents whose row at distance look still has their first minimum in ``CROWDED`` trees or more are
therefore joined once more, across components: see :mod:`geoloom.llm.crowds`.

Pairs are screened by their whole signatures, then confirmed on the full sets: first each document's best partner,
then those pairs that are still in different components (a pair inside a component can't change it).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import crowds
from geoloom.llm.arrow import WORD_BYTES, mix, shingle_sets, slices
from geoloom.llm.skew import spread
from geoloom.operators.components import connected_components
from geoloom.session import stage

#: Ids that are sent to every executor at most (16 MB); beyond it the texts are shuffled to the ids.
BROADCAST_ROWS = 1_000_000
#: Trees in which a document must be crowded to be joined exactly. With fewer, at least 13 of 16 trees would have to
#: share no minimum for a pair to be lost: 4 in a million at the bar.
CROWDED = 4


def signatures(docs: DataFrame, k: int, trees: int, depth: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (128 bits that name the set), sig (trees x depth minima, big-endian 32-bit)."""
    rng = np.random.Generator(np.random.PCG64(7))
    factor = rng.integers(0, 2**31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 2**32, trees * depth, dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=WORD_BYTES):
            flat, sizes = shingle_sets(batch, k)
            some = np.flatnonzero(sizes)
            sig = np.zeros((batch.num_rows, trees * depth), np.uint32)
            key = np.zeros((2, batch.num_rows), np.int64)
            if len(some):
                heads = np.cumsum(sizes[some]) - sizes[some]
                short = (mix(flat) >> np.uint64(32)).astype(np.uint32)
                for j in range(trees * depth):
                    v = short * factor[j] + shift[j]
                    v ^= v >> np.uint32(15)
                    sig[some, j] = np.minimum.reduceat(v * np.uint32(0x2C1B3C6D), heads)
                key[0, some] = np.add.reduceat(mix(flat + np.uint64(1)), heads).view(np.int64)
                key[1, some] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), heads).view(np.int64)
            raw = sig.astype(">u4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(key[0]), pa.array(key[1]), pa.array([r.tobytes() for r in raw], pa.binary())],
                ["doc_id", "n_shingles", "k1", "k2", "sig"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, sig binary")


def forest_labels(reps: DataFrame, trees: int, depth: int) -> DataFrame:
    """tree, label, doc_id of every tree. reps: doc_id, sig."""
    width = 4 * depth
    labels = reps.select("doc_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.cast("long").alias("tree"), F.substring("sig", t * width + 1, F.lit(width)).alias("label")))).alias("x"))
    return labels.select("x.tree", "x.label", "doc_id", F.col("doc_id").alias("part"))


def neighbours(labels: DataFrame, depth: int, look: int, test: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b, repeated) of the ``look`` nearest rows in any tree's order that share a first minimum, and the rows (id,
    tree) whose row at distance ``look`` still does. labels: tree, label (``depth`` minima), doc_id, part; rows of one part
    never make a pair. ``test`` (of two arrays of rows' bytes) drops pairs; it needs a column sketch of equal lengths."""
    columns = ["doc_id", "tree", "label", "part", *(["sketch"] if test else [])]
    parts = max(int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = labels.select(columns).repartitionByRange(parts, "tree", "label", "doc_id").sortWithinPartitions("tree", "label", "doc_id")
    kind = pa.struct([("tree", pa.int64()), ("label", pa.binary()), ("doc_id", pa.int64()), ("part", pa.int64()), ("sketch", pa.binary())])

    def bytes_of(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)

    def back(rows: tuple[np.ndarray, ...], first: int, stop: int) -> tuple[np.ndarray, ...]:
        """Pairs of each row from ``first`` on with those of the ``look`` rows before it that lie before ``stop`` and share a
        label prefix; and, without ``test``, the rows at either end of a whole ``look`` that does."""
        tree, label, ids, own, sketch = rows
        found_a, found_b, far = [], [], np.empty(0, np.int64)
        for d in range(1, look + 1):
            lo, hi = max(first, d), min(len(ids), stop + d)
            if lo >= hi:
                continue
            at = np.flatnonzero((tree[lo:hi] == tree[lo - d : hi - d]) & (label[lo:hi, 0] == label[lo - d : hi - d, 0])) + lo
            if d == look and not test:
                far = np.union1d(at, at - look)
            at = at[own[at] != own[at - d]]
            if test and len(at):
                at = at[test(sketch[at], sketch[at - d])]
            found_a.append(ids[at])
            found_b.append(ids[at - d])
        a = np.concatenate(found_a) if found_a else np.empty(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.empty(0, np.int64)
        return np.minimum(a, b), np.maximum(a, b), ids[far], tree[far]

    def arrays(tree: pa.Array, label: pa.Array, ids: pa.Array, own: pa.Array, sketch: pa.Array | None) -> tuple[np.ndarray, ...]:
        n = len(ids)
        tail = bytes_of(sketch) if test else np.empty((n, 0), np.uint8)
        return tree.to_numpy(), bytes_of(label).view(">u4").reshape(n, depth), ids.to_numpy(), own.to_numpy(), tail

    def joined(*parts: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def found(a: np.ndarray, b: np.ndarray, far: np.ndarray, tree: np.ndarray) -> list[pa.Array]:
        """a, b, tree: pairs (tree null), then crowded rows (b null)."""
        n, m = len(a), len(far)
        return [pa.array(np.concatenate([a, far])), pa.concat_arrays([pa.array(b), pa.nulls(m, pa.int64())]), pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(tree)])]

    def packed(rows: tuple[np.ndarray, ...]) -> pa.Array:
        """The rows as one list."""
        tree, label, ids, own, sketch = rows
        text = [pa.array([x.tobytes() for x in y], pa.binary()) for y in (label.astype(">u4"), sketch)]
        return pa.ListArray.from_arrays([0, len(ids)], pa.StructArray.from_arrays([pa.array(tree), text[0], pa.array(ids), pa.array(own), text[1]], fields=list(kind)))

    names = ["a", "b", "tree", "place", "held", "head", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs and crowded rows inside a partition, and one row with its place, its rows and the first and last ``look``."""
        head, keep, held = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = arrays(*(batch.column(c) for c in ("tree", "label", "doc_id", "part")), batch.column("sketch") if test else None)
            held += batch.num_rows
            first = 0 if keep is None else len(keep[2])
            rows = rows if keep is None else joined(keep, rows)
            some = found(*back(rows, first, len(rows[2])))
            n = len(some[0])
            if n:
                yield pa.RecordBatch.from_arrays([*some, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(kind)), pa.nulls(n, pa.list_(kind))], names)
            if head is None or len(head[2]) < look:  # until then nothing has left ``rows``
                head = tuple(x[:look] for x in rows)
            keep = tuple(x[-look:] for x in rows)
        if held:
            number = [pa.nulls(1, pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*number, pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([held]), packed(head), packed(keep)], names)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first rows of a partition with the ``look`` rows before it."""
        for batch in batches:
            for i in range(batch.num_rows):
                rows = pa.concat_arrays([batch.column(c)[i].values for c in ("tail", "head")])
                before = len(batch.column("tail")[i].values)
                rows = arrays(*(rows.field(c) for c in ("tree", "label", "doc_id", "part", "sketch")))
                skip = max(before - look, 0)
                yield pa.RecordBatch.from_arrays(found(*back(tuple(x[skip:] for x in rows), before - skip, before - skip)), names[:3])

    rows = "array<struct<tree:long,label:binary,doc_id:long,part:long,sketch:binary>>"
    made = stage(ordered.mapInArrow(run, f"a long, b long, tree long, place int, held long, head {rows}, tail {rows}"))
    ends = made.where("place is not null")
    # which partitions hold the ``look`` rows before another: from the partitions' numbers of rows alone
    sizes = sorted((r["place"], r["held"]) for r in ends.select("place", "held").collect())
    meets = []
    for i, (to, _) in enumerate(sizes):
        wanted, j = look, i - 1
        while wanted > 0 and j >= 0:
            meets.append((sizes[j][0], to))
            wanted -= sizes[j][1]
            j -= 1
    meets = F.broadcast(labels.sparkSession.createDataFrame(meets, "place int, to int"))
    tails = ends.select("place", "tail").join(meets, "place").groupBy("to").agg(F.sort_array(F.collect_list(F.struct("place", "tail"))).alias("x"))
    tails = tails.select(F.col("to").alias("place"), F.flatten("x.tail").alias("tail"))
    over = ends.select("place", "head").join(tails, "place").select("tail", "head").mapInArrow(across, "a long, b long, tree long")
    every = made.where("place is null").select("a", "b", "tree").union(stage(over))
    return every.where("b is not null").select("a", "b"), every.where("b is null").select(F.col("a").alias("id"), "tree")


def crowd_links(docs: DataFrame, crowd: DataFrame, reps: DataFrame, of: DataFrame, k: int, percent: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """Components (node, component) with the links that sizes prove, and the pairs (a < b) still to be confirmed."""
    wanted = F.broadcast(crowd) if crowd.count() <= BROADCAST_ROWS else crowd.hint("merge")
    texts = docs.join(wanted, docs.doc_id == wanted.id, "left_semi").dropDuplicates(["doc_id"])
    sets = crowds.leading_sets(texts, reps, k, percent, depth)
    rows = crowds.region_rows(sets)
    of = _components(crowds.star_links(rows, percent), of)
    near, _ = neighbours(crowds.region_labels(rows, of), crowds.DEPTH, crowds.LOOK, crowds.may_reach(percent))
    return of, crowds.few_pairs(sets, of, percent).union(near).distinct()


def _components(links: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Staged (node, component). ``of``: components so far, of which only those that ``links`` touch are worked on."""
    if of is None:
        return stage(connected_components(links))
    ca, cb = (of.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    between = stage(links.join(ca, "a", "left").join(cb, "b", "left").select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")))
    new = between.where("a = ca").select(F.col("a").alias("node")).union(between.where("b = cb").select(F.col("b").alias("node"))).distinct()
    nodes = of.union(new.join(of, "node", "left_anti").select("node", F.col("node").alias("component")))
    top = connected_components(between.select("ca", "cb"), "ca", "cb").select(F.col("component").alias("top"), F.col("node").alias("component"))
    return stage(nodes.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component")))


def _confirm(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) with 100 * intersection >= percent * union of their full shingle sets."""
    pairs = stage(pairs.select("a", "b"))
    ids = stage(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids.hint("merge")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=WORD_BYTES):
            flat, sizes = shingle_sets(batch, k)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([flat[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary())], ["doc_id", "set"])

    held = docs.join(wanted, docs.doc_id == wanted.id, "left_semi").mapInArrow(sets, "doc_id long, set binary")
    held = stage(held.dropDuplicates(["doc_id"]))
    left, right = (held.select(F.col("doc_id").alias(x), F.col("set").alias(f"s{x}")).hint("merge") for x in "ab")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "sb"):
                keep = []
                for sa, sb in zip(batch.column("sa"), batch.column("sb"), strict=True):
                    p, q = np.frombuffer(sa.as_buffer(), np.uint64), np.frombuffer(sb.as_buffer(), np.uint64)
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * both >= percent * (len(p) + len(q) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return stage(joined.mapInArrow(test, "a long, b long"))


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 75, trees: int = 16, depth: int = 6, look: int = 4, screen: float = 0.52) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Documents are linked when 100 * intersection >= ``percent`` * union of their ``k``-word shingle sets (lower-case
    A-Z); a component is named by its smallest doc_id. Null and empty texts, and texts without words, have no shingles
    and link with nothing. Rows that repeat a doc_id are returned each; they share a component_id. A null doc_id has a
    null component_id and is kept. An empty table gives no rows. Other columns are not read. ``screen``: share of equal
    signature places under which a pair is not looked at again, over four standard deviations below ``percent``.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sig = stage(signatures(docs, k, trees, depth))
    some = sig.where("n_shingles > 0 and doc_id is not null")
    groups = stage(some.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    reps = stage(some.join(groups.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "sig").dropDuplicates(["doc_id"]))

    pairs, tight = neighbours(forest_labels(reps, trees, depth), depth, look)
    crowd = stage(tight.distinct().groupBy("id").count().where(F.col("count") >= min(CROWDED, trees)).select("id"))
    n = trees * depth

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, n) for c in ("pa", "pb"))
            score = (p == q).mean(1)
            ok = score >= screen
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok)), pa.array(score[ok])], ["a", "b", "score"])

    # one byte of each minimum is enough to screen
    low = F.expr(f"unhex(array_join(transform(sequence(0, {n - 1}), i -> hex(substring(sig, 4 * i + 4, 1))), ''))")
    small = stage(reps.select("doc_id", low.alias("low")))

    def screened(pairs: DataFrame) -> DataFrame:
        # merged at every size: pairs lie in files with wide columns beside them, of which the planner takes them for a small share
        left, right = (small.select(F.col("doc_id").alias(x), F.col("low").alias(f"p{x}")).hint("merge") for x in "ab")
        return stage(pairs.join(left, "a").join(right, "b").select("a", "b", "pa", "pb").mapInArrow(alike, "a long, b long, score double"))

    scored = screened(pairs.distinct())
    ends = scored.select("a", "b", "score", F.col("b").alias("me")).union(scored.select("a", "b", "score", F.col("a").alias("me")))
    best = ends.groupBy("me").agg(F.max(F.struct("score", F.struct("a", "b").alias("pair"))).alias("top")).select("top.pair.*").distinct()
    links = _confirm(docs, best, k, percent)
    of = _components(links)
    ca, cb = (of.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in ("a", "b"))
    apart = scored.join(ca, "a", "left").join(cb, "b", "left").where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b").join(best, ["a", "b"], "left_anti")
    of = _components(_confirm(docs, apart, k, percent), of)
    if not crowd.isEmpty():
        of, more = crowd_links(docs, crowd, reps, of, k, percent, depth)
        more = screened(more)
        of = _components(_confirm(docs, more, k, percent), of)
    # a class learns its component once; the members of a large class are spread over tasks
    of = of.withColumnsRenamed({"node": "rep"})
    classes = groups.join(of, "rep", "left").select("k1", "k2", "n", "rep", F.coalesce("component", "rep").alias("component_id"))
    classes = stage(classes.where("n > 1 or component_id <> rep").select("k1", "k2", "n", "component_id"))
    keyed, classes, keys = spread(sig.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("k1")).alias("k1"), "k2"), classes, ["k1", "k2"], "n")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return keyed.join(classes, keys, "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents
), s as (
  select distinct doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from w where len(ws) > 0)
), n as (
  select w.doc_id, count(s.g) as n_shingles from w left join s on s.doc_id = w.doc_id group by w.doc_id
), pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as both
  from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by x.doc_id, y.doc_id
), links as (
  select a, b from pairs join n p on p.doc_id = a join n q on q.doc_id = b
  where 100 * pairs.both >= 75 * (p.n_shingles + q.n_shingles - pairs.both)
), e as (
  select a as u, b as v from links union all select b, a from links
), reach as (
  select doc_id as u, doc_id as c from n
  union
  select e.v, reach.c from reach join e on e.u = reach.u
)
select n.doc_id, cast(n.n_shingles as bigint) as n_shingles, min(reach.c) as component_id, n.doc_id = min(reach.c) as kept
from n join reach on reach.u = n.doc_id group by n.doc_id, n.n_shingles
"""
