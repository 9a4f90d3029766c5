"""Exact integer vectors in packed chunks, shared by the vector searches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LEAST, _MOST = -(2**63), 2**63 - 1


def whole_vectors(vectors: DataFrame, scale: int, *more: str) -> DataFrame:
    """(vec_id, v, more) of rows with a vec_id and a vector without null and non-finite components; v holds
    floor(scale * x) as doubles, which hold such numbers exactly at any size."""
    x = F.col("embedding")
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    scaled = lambda c: c.cast("double") * scale
    floored = lambda c: F.when(F.abs(scaled(c)) < F.lit(2.0**52), F.floor(scaled(c)).cast("double")).otherwise(scaled(c))  # noqa: E731  larger ones are whole
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, floored).alias("v"), *more)


def one_each(rows: DataFrame, *more: str) -> DataFrame:
    """Of rows that repeat a vec_id the one with the least (more, v). Only repeated ids are grouped with their vectors."""
    again = rows.groupBy("vec_id").count().where("count > 1").select("vec_id")
    if again.isEmpty():
        return rows
    best = rows.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct(*more, "v")).alias("s")).select("vec_id", *[F.col(f"s.{c}").alias(c) for c in ("v", *more)])
    return rows.join(again, "vec_id", "left_anti").select("vec_id", "v", *more).unionByName(best)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as the rows of a matrix; shorter ones end in zeros."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lens = np.diff(np.asarray(flat.offsets))
    values = np.asarray(flat.flatten(), float)
    out = np.zeros((len(lens), int(lens.max(initial=0))))
    out[np.arange(out.shape[1]) < lens[:, None]] = values
    return out


def coded(a: np.ndarray) -> bytes:
    """A matrix of whole numbers as bytes, in 16 bits each where they fit; the first byte says which."""
    small = bool(np.abs(a).max(initial=0) < 2**15)
    return bytes([small]) + a.astype(np.int16 if small else float).tobytes()


def decoded(raw: bytes, n: int, dim: int) -> np.ndarray:
    """The ``n`` rows of :func:`coded`, as doubles, widened to ``dim`` columns."""
    a = np.frombuffer(raw, np.int16 if raw[0] else float, offset=1).reshape(n, -1).astype(float) if len(raw) > 1 else np.zeros((n, 0))
    return np.pad(a, ((0, 0), (0, dim - a.shape[1])))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole doubles: in doubles while all partial sums are under 2**53, in 64-bit integers
    while under 2**63, else in Python's integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return a @ b.T
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = lambda x: np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)
    return whole(a) @ whole(b).T


def longs(a: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; what doesn't fit becomes the nearest that does."""
    return np.array([min(max(int(v), _LEAST), _MOST) for v in a], np.int64) if a.dtype == object else a.astype(np.int64)


def first_of(group: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores of each group, ties to smaller ids, in that order."""
    order = np.lexsort([ids, -scores, group])
    g = group[order]
    heads = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.empty(0, int)
    rank = np.arange(len(g)) - np.repeat(heads, np.diff(np.append(heads, len(g))))
    return order[rank < k]
