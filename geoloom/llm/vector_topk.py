"""Exact top-k inner products with vector-approximation files.

Vectors are packed into chunks. A chunk keeps, beside the exact vectors, a cell number of a few bits for every
component (equal-width cells between the chunk's least and greatest value of that component). Queries are packed into
blocks, and each block meets each chunk once. There the cells are scanned: they bound every score from below and
above. Vectors whose upper bound is under the k-th best lower bound are out; the others are read exactly in the order
of their bounds, until the k-th exact score is above the next bound. The best k of all chunks are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.vectors import first_of, longs, matrix, one_each, product, whole_vectors
from geoloom.session import stage

_PACKED = "{n} int, dim int, ids binary, exact binary, cells binary"
#: Components from here on are left out of the cells; their products are taken in integers of any size.
_LARGE = 2.0**46


def _pack(key: str, bits: int):
    def pack(table: pa.Table) -> pa.Table:
        """One row for a group of (vec_id, v): ids, vectors that end in zeros, and cells."""
        ids, exact = table.column("vec_id").to_numpy(), matrix(table.column("v"))
        order = np.argsort(ids)
        ids, exact = ids[order], np.ascontiguousarray(exact[order])
        plain = np.where(np.abs(exact) < _LARGE, exact, 0).astype(np.int64)
        low, width = plain.min(0), plain.max(0) - plain.min(0) + 1
        cells = ((plain - low) * (1 << bits) // width).astype(np.uint8)
        return pa.table(
            {key: table.column(key).slice(0, 1), "dim": pa.array([exact.shape[1]], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()), "exact": pa.array([exact.tobytes()], pa.binary()), "cells": pa.array([cells.tobytes()], pa.binary())}
        )

    return pack


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while every partial sum is under 2**53, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return a.astype(float) @ b.T.astype(float)
    return a @ b.T if most < 2**62 else product(a.astype(float), b.astype(float))


def scan(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, exact: np.ndarray, cells: np.ndarray, bits: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of each query's best ``k`` among whole doubles: by cells where components are under
    ``_LARGE`` and scores under 2**62, else by products with all vectors, one query at a time."""
    dim = max(q.shape[1], 1)
    reach = min(_LARGE, 2.0**62 / dim / max(float(np.abs(q[np.abs(q) < _LARGE]).max(initial=1)), 1.0))
    plain_q, plain = (np.abs(q) < _LARGE).all(1), (np.abs(exact) < reach).all(1)
    found = [best_of_chunk(q_ids[plain_q], q[plain_q].astype(np.int64), ids[plain], exact[plain].astype(np.int64), cells[plain], bits, k, exact)] if plain.any() else []
    for i in range(len(q_ids)):
        rest = np.flatnonzero((~plain if plain_q[i] else np.ones(len(ids), bool)) & (ids != q_ids[i]))
        if len(rest):
            score = longs(product(q[i : i + 1], exact[rest])[0])
            top = first_of(np.zeros(len(rest), int), ids[rest], score.astype(object), k)
            found.append((np.full(len(top), q_ids[i]), ids[rest[top]], score[top]))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3


def best_of_chunk(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, exact: np.ndarray, cells: np.ndarray, bits: int, k: int, whole: np.ndarray, step: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of each query's best ``k`` in a chunk, ties to smaller ids. ``whole``: the vectors that the
    cells were made of."""
    plain = np.where(np.abs(whole) < _LARGE, whole, 0).astype(np.int64)
    low = plain.min(0)
    width = plain.max(0) - low + 1
    grid = 1 << bits
    floor = low + -(-cells.astype(np.int64) * width // grid)  # least value in the cell
    ceil = low + -(-(cells.astype(np.int64) + 1) * width // grid) - 1  # greatest
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    upper = _product(plus, ceil) + _product(minus, floor)
    lower = _product(plus, floor) + _product(minus, ceil)
    lower[q_ids[:, None] == ids] = -np.inf if lower.dtype.kind == "f" else np.iinfo(np.int64).min
    out_q, out_v, out_s = [], [], []
    for i in range(len(q_ids)):
        bar = np.partition(lower[i], -k)[-k] if lower.shape[1] > k else -np.inf
        may = np.flatnonzero((upper[i] >= bar) & (ids != q_ids[i]))
        may = may[np.argsort(-upper[i, may], kind="stable")]
        got_s, got_v = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(may), step):
            if len(got_s) >= k and upper[i, may[at]] < got_s[-1]:
                break
            part = may[at : at + step]
            score = _product(q[i : i + 1], exact[part])[0]
            got_s = np.concatenate([got_s, np.rint(score).astype(np.int64) if score.dtype.kind == "f" else score.astype(np.int64)])
            got_v = np.concatenate([got_v, ids[part]])
            top = np.lexsort([got_v, -got_s])[:k]
            got_s, got_v = got_s[top], got_v[top]
        out_q.append(np.full(len(got_v), q_ids[i]))
        out_v.append(got_v)
        out_s.append(got_s)
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_q, out_v, out_s))


def vector_topk(vectors: DataFrame, k: int = 20, every: int = 20, bits: int = 4, chunk_rows: int = 8192, block_rows: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` greatest integer inner products, ties to the smaller vec_id.

    Components become floor(64 * x), held as doubles, which hold such numbers exactly at any size. Scores are exact while
    they fit 64 bits; those that don't become the nearest number that does, and then tie to the smaller vec_id. Queries are rows whose vec_id is divisible by ``every``. Vectors that are null or
    hold a null or non-finite component, and rows without a vec_id, take no part. Vectors of unequal length are
    compared as if the shorter ended in zeros; an empty vector scores 0. Of rows that repeat a vec_id the one with the
    least vector counts. A query with fewer than k other vectors gets all. An empty table gives no rows.
    """
    whole = one_each(whole_vectors(vectors, 64))
    n = whole.count()
    chunks, blocks = max(1, -(-n // chunk_rows)), max(1, -(-n // (every * block_rows)))
    chunked = whole.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))
    blocked = whole.where(F.col("vec_id") % every == 0).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    chunked = stage(chunked.groupBy("chunk").applyInArrow(_pack("chunk", bits), _PACKED.format(n="chunk")))
    blocked = stage(blocked.groupBy("block").applyInArrow(_pack("block", bits), _PACKED.format(n="block")))
    asked = blocked.select("block", F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("exact").alias("q_exact"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = max(row["dim"], row["q_dim"])
                wide = lambda raw, d: np.pad(np.frombuffer(raw, float).reshape(-1, d), ((0, 0), (0, dim - d)))
                q_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                exact = wide(row["exact"], row["dim"]) if row["dim"] else np.zeros((len(ids), dim))
                q = wide(row["q_exact"], row["q_dim"]) if row["q_dim"] else np.zeros((len(q_ids), dim))
                cells = np.zeros((len(ids), dim), np.uint8)
                if row["dim"]:
                    cells[:, : row["dim"]] = np.frombuffer(row["cells"], np.uint8).reshape(-1, row["dim"])
                found = scan(q_ids, q, ids, exact, cells, bits, k)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in found], ["query_id", "vec_id", "score"])

    # merged at every size: the planner sees the blocks' files, not that each block is there once for every chunk
    met = asked.join(chunked.hint("merge"), "chunk").select("q_dim", "q_ids", "q_exact", "dim", "ids", "exact", "cells")
    best = met.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (
  select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as e from embeddings
  where vec_id is not null and embedding is not null and len([1 for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(coalesce(list_sum([z[1] * z[2] for z in list_zip(q.e, c.e)]), 0) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""
