"""Sequence packing by cutting-stock column generation.

A document of n tokens gives n // size full pieces and a remainder of r tokens, 0 <= r < size. Remainders are the
items; their length histogram (at most size - 1 counts, whatever the corpus) goes to the driver, where a linear program
over patterns (multisets of lengths that fill a sequence exactly) is solved: a simplex master whose columns are priced
by a knapsack dynamic program over the lengths' shadow prices. The rounded pattern counts become rank ranges: within
its length class each remainder has a rank, and a small range table maps ranks to sequences and offsets. What the
rounding leaves, and lengths that fill no pattern, are laid end to end in rank order and cut at the sequence size; the
last partial sequence is cut into powers of two. So only that tail's sequences are short, and none is padded.

Ranks are made of counts per (length, salt), so that a length shared by a third of all documents is spread out.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.arrow import slices, texts
from geoloom.llm.chunks import Cache, spaced_chunks, spelling
from geoloom.session import stage

#: Rows of (id, cuts) that are sent to every executor at most; beyond it both sides are shuffled.
BROADCAST_ROWS = 200_000


# -- the linear program (driver; its size depends on the sequence size alone) ----------------------------------------


def _price(lengths: np.ndarray, worth: np.ndarray, size: int, many: int) -> list[np.ndarray]:
    """Exact fills of ``size`` of least summed worth: one knapsack table, and from it the best fills that hold each of
    the ``many`` cheapest first items. Each is the times that every length is used."""
    best = np.full(size + 1, np.inf)
    best[0], pick = 0.0, np.full(size + 1, -1)
    count_at = np.searchsorted(lengths, np.arange(size + 1), "right")
    for c in range(1, size + 1):
        k = count_at[c]
        if k:
            tried = best[c - lengths[:k]] + worth[:k]
            j = int(tried.argmin())
            best[c], pick[c] = tried[j], j
    first = worth + best[size - lengths]
    fills: dict[bytes, np.ndarray] = {}
    for j in np.argsort(first, kind="stable")[:many]:
        if not np.isfinite(first[j]):
            break
        used = np.zeros(len(lengths))
        used[j] += 1
        c = size - lengths[j]
        while c:
            used[pick[c]] += 1
            c -= lengths[pick[c]]
        fills.setdefault(used.tobytes(), used)
    return list(fills.values())


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, size: int, pivots: int = 2000, gap: float = 0.004, many: int = 48) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole counts, using at most ``demand`` of each length.

    Maximises the number of exactly filled sequences over real counts, then rounds down and tops up greedily. Stops
    when all but ``gap`` of the tokens are in patterns, when no column prices in, or after ``pivots`` pivots.
    """
    m = len(lengths)
    if not m:
        return []
    inverse, x, gain, dual = np.eye(m), demand.astype(float), np.zeros(m), np.zeros(m)
    columns: list[np.ndarray | None] = [None] * m
    most = float((lengths * demand).sum()) / size
    done, moved = 0, True
    while moved and done < pivots and gain @ x < most * (1 - gap):
        moved = False
        dual = gain @ inverse
        # of equal fills the one with fewer items
        for used in _price(lengths, np.maximum(dual, 0) + 1e-7, size, many):
            profit = 1 - dual @ used
            if profit <= 1e-6:
                continue
            move = inverse @ used
            can = np.flatnonzero(move > 1e-9)
            if not len(can):
                continue
            ratio = np.maximum(x[can], 0) / move[can]
            out = int(can[ratio.argmin()])
            step = float(ratio.min())
            x = x - step * move
            x[out] = step
            row = inverse[out] / move[out]
            inverse -= np.outer(move, row)
            inverse[out] = row
            dual = dual + profit * row
            columns[out], gain[out] = used, 1.0
            done, moved = done + 1, True
    left, plan = demand.astype(np.int64).copy(), []
    found = sorted(((x[i] - np.floor(x[i] + 1e-9), i) for i, c in enumerate(columns) if c is not None and x[i] > 1e-9), reverse=True)
    counts = {}
    for _, i in found:
        use = columns[i].astype(np.int64)
        counts[i] = int(min(np.floor(x[i] + 1e-9), (left[use > 0] // use[use > 0]).min()))
        left -= counts[i] * use
    for _, i in found:  # top up, largest lost fraction first
        use = columns[i].astype(np.int64)
        more = int((left[use > 0] // use[use > 0]).min())
        counts[i] += more
        left -= more * use
    for _, i in found:
        if counts[i]:
            plan.append((columns[i].astype(np.int64), counts[i]))
    return plan


# -- tokens ----------------------------------------------------------------------------------------------------------

_caches: dict[str, Cache] = {}
#: Fixed value: the split that byte-level tokenizers of this family make before merging.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _cache(path: str) -> Cache:
    """Chunk -> ids of a byte-level BPE tokenizers file.

    Ids of such a file are merge ranks, so the quicker tiktoken coder gives the library's ids from the file's own
    vocabulary (the tests hold both against each other). Chunks with a special token's string go to the library.
    """
    if path not in _caches:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import tiktoken
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        special = [t.content for t in library.get_added_tokens_decoder().values()]
        byte = {c: b for b, c in spelling().items()}
        ranks = {bytes(byte[c] for c in t): i for t, i in library.get_vocab(with_added_tokens=False).items() if t not in special}
        quick = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def ids(chunk: str) -> list[int]:
            if "<" in chunk and any(s in chunk for s in special):
                return library.encode(chunk, add_special_tokens=False).ids
            return quick(chunk)

        _caches[path] = Cache(lambda chunks: [array("I", ids(c)).tobytes() for c in chunks])
    return _caches[path]


def _coded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    cache = _cache(path)
    for batch in slices(batches):
        chunks = [spaced_chunks(t) for t in texts(batch)]
        cache.fill(chunks)
        yield batch, [b"".join(map(cache.__getitem__, c)) + b"\0\0\0\0" for c in chunks]


def _sizes(docs: DataFrame, path: str, size: int) -> DataFrame:
    """doc_id, doc_tokens, full (checksums of the full pieces), rest (tokens of the remainder), rest_crc."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = 4 * size
        for batch, coded in _coded(batches, path):
            cut = [len(c) // step * step for c in coded]
            full = [[zlib.crc32(c[i : i + step]) for i in range(0, k, step)] for c, k in zip(coded, cut, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array(full, pa.list_(pa.int64())),
                 pa.array([(len(c) - k) // 4 for c, k in zip(coded, cut, strict=True)], pa.int32()), pa.array([zlib.crc32(c[k:]) for c, k in zip(coded, cut, strict=True)], pa.int64())],
                ["doc_id", "doc_tokens", "full", "rest", "rest_crc"],
            )

    return docs.mapInArrow(run, "doc_id long, doc_tokens long, full array<long>, rest int, rest_crc long")


def _checksums(docs: DataFrame, cuts: DataFrame, path: str) -> DataFrame:
    """Checksums of chosen pieces. cuts: d, n, c (which document), at (array of piece starts and lengths)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, coded in _coded(batches, path):
            rows: list[tuple] = []
            for code, d, n, c, at in zip(coded, *(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                if len(code) == 4 * n and any(p["whole"] and zlib.crc32(code[4 * p["start"] :]) == c for p in at):
                    rows += [(d, n, c, p["start"], p["length"], zlib.crc32(code[4 * p["start"] : 4 * (p["start"] + p["length"])])) for p in at if not p["whole"]]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], ["d", "n", "c", "start", "length", "crc"])

    few = cuts.count() <= BROADCAST_ROWS
    named = cuts if not few else F.broadcast(cuts)
    joined = docs.join(named, docs.doc_id.eqNullSafe(named.d)).select("doc_id", "text", "d", "n", "c", "at")
    return joined.mapInArrow(run, "d long, n long, c long, start long, length long, crc long").dropDuplicates(["d", "n", "c", "start", "length"])


def pack(docs: DataFrame, path: str, size: int = 1024) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's tokens are its ids followed by id 0, so null and empty texts have one. Rows that repeat a doc_id are
    packed each on its own; null ids stay null. Equal lengths are ranked by doc_id. An empty table gives no rows. Other
    columns are not read. Sequence ids are unique, not dense.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sized = stage(_sizes(docs, path, size))
    salts = max(16, int(sized.count() // 2_000_000))
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("doc_id", "rest_crc"), F.lit(salts)))
    per_salt = salted.groupBy("rest", "salt").agg(F.count(F.lit(1)).alias("n"))
    per_salt = stage(per_salt.withColumn("before", F.sum("n").over(Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))))
    in_salt = F.row_number().over(Window.partitionBy("rest", "salt").orderBy("doc_id", "doc_tokens", "rest_crc")) - 1
    ranked = salted.withColumn("in_salt", in_salt).join(per_salt.select("rest", "salt", "before"), ["rest", "salt"])
    ranked = ranked.select("doc_id", "doc_tokens", "full", "rest", "rest_crc", (F.coalesce("before", F.lit(0)) + F.col("in_salt")).alias("rank"))
    ranked = stage(ranked)

    counts = {r["rest"]: r["n"] for r in per_salt.groupBy("rest").agg(F.sum("n").alias("n")).collect() if r["rest"]}
    lengths = np.array(sorted(counts), np.int64)
    demand = np.array([counts[k] for k in lengths], np.int64)
    plan, used, sequences = [], np.zeros(len(lengths), np.int64), 0
    for pattern, times in solve_patterns(lengths, demand, size):
        offset = 0
        for j in np.flatnonzero(pattern):
            each = int(pattern[j])
            plan.append((int(lengths[j]), int(used[j]), int(used[j] + each * times), each, sequences, offset))
            used[j] += each * times
            offset += each * int(lengths[j])
        sequences += times
    base, laid = 0, []
    for j, k in enumerate(lengths):
        laid.append((int(k), int(used[j]), int(demand[j]), 0, 0, base))
        base += int(k) * int(demand[j] - used[j])
    whole, edges = base // size * size, [base // size * size]
    for bit in reversed(range(size.bit_length())):
        if (base - whole) >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    ranges = spark.createDataFrame([r for r in plan + laid if r[1] < r[2]] or [(0, 0, 0, 0, 0, 0)], "rest int, lo long, hi long, each int, sequence long, base long")

    # full pieces: a sequence each
    longest = sized.agg(F.max(F.size("full"))).first()[0] or 0
    first_full = sequences + base // size + len(edges)
    full = ranked.where(F.size("full") > 0).select("doc_id", "doc_tokens", "rest", "rank", F.posexplode("full").alias("k", "ids_crc32"))
    full = full.select(
        "doc_id", (F.col("k") * size).cast("long").alias("start"), F.lit(size).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.lit(first_full) + (F.col("rank") * size + F.col("rest")) * F.lit(max(1, longest)) + F.col("k")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )

    # remainders: the range table has at most a few rows for each length and pattern, so it is broadcast
    ranges = F.broadcast(ranges.withColumnRenamed("rest", "of"))
    items = ranked.where("rest > 0").join(ranges, (F.col("rest") == F.col("of")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    items = items.withColumn("begin", F.col("doc_tokens") - F.col("rest"))
    q = F.col("rank") - F.col("lo")
    fitted = items.where("each > 0").select(
        "doc_id", F.col("begin").alias("start"), F.col("rest").cast("long").alias("length"), F.col("rest_crc").alias("ids_crc32"), "doc_tokens",
        (F.col("sequence") + F.floor(q / F.col("each"))).cast("long").alias("sequence_id"), (F.col("base") + q % F.col("each") * F.col("rest")).cast("long").alias("offset"),
    )
    inner = F.array(*[F.lit(e).cast("long") for e in edges])
    g = F.col("base") + q * F.col("rest")
    line = items.where("each = 0").withColumn("g", g).withColumn("h", F.col("g") + F.col("rest"))
    next_edge = (F.floor(F.col("g") / size) + 1) * size
    cuts = F.filter(F.array_distinct(F.concat(F.array(next_edge.cast("long")), inner)), lambda e: (e > F.col("g")) & (e < F.col("h")) & (e <= F.lit(base)))
    line = line.withColumn("marks", F.array_sort(F.concat(F.array("g", "h"), cuts)))
    line = line.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("marks") - 1)))
    line = line.withColumn("a", F.element_at("marks", F.col("k"))).withColumn("b", F.element_at("marks", F.col("k") + 1))
    tail = F.size(F.filter(inner, lambda e: e <= F.col("a")))
    line = line.select(
        "doc_id", "doc_tokens", "rest_crc", "begin", "rest", (F.col("begin") + F.col("a") - F.col("g")).alias("start"), (F.col("b") - F.col("a")).alias("length"),
        F.when(F.col("a") < whole, F.floor(F.col("a") / size)).otherwise(F.lit(whole // size - 1) + tail).alias("at"),
        F.when(F.col("a") < whole, F.col("a") % size).otherwise(F.col("a") - F.element_at(inner, F.greatest(tail, F.lit(1)))).cast("long").alias("offset"),
    )
    line = stage(line.withColumn("sequence_id", (F.lit(sequences) + F.col("at")).cast("long")))
    plain = line.where("length = rest").select("doc_id", "start", "length", F.col("rest_crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    parted = line.where("length < rest")
    named = parted.groupBy(F.col("doc_id").alias("d"), F.col("doc_tokens").alias("n"), F.col("rest_crc").alias("c")).agg(
        F.array_union(
            F.collect_set(F.struct("start", "length", F.lit(False).alias("whole"))),
            F.array(F.struct(F.min("begin").alias("start"), F.lit(0).cast("long").alias("length"), F.lit(True).alias("whole"))),
        ).alias("at")
    )
    sums = _checksums(docs, stage(named), path).withColumnsRenamed({"start": "s", "length": "l"})
    parted = parted.join(
        sums,
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("doc_tokens") == F.col("n")) & (F.col("rest_crc") == F.col("c")) & (F.col("start") == F.col("s")) & (F.col("length") == F.col("l")),
    ).select("doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    return full.unionByName(fitted).unionByName(plain).unionByName(parted)
