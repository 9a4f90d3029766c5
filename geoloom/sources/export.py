"""Exports: GeoJSON features, simplified lines, routing tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.graph import drop_small_components, last_edge_wins, with_endpoints


def clean_float(c: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def geojson_features(df: DataFrame, lat: str, lon: str, properties: Sequence[str]) -> DataFrame:
    """One compact feature text a row; rows without usable coordinates are left out, NaN and infinite properties are null."""
    kinds = dict(df.dtypes)
    ok = df.withColumns({"_x": clean_float(F.col(lon)), "_y": clean_float(F.col(lat))}).where("_x is not null and _y is not null")
    values = [(clean_float(F.col(p)) if kinds[p] in ("double", "float") else F.col(p) if kinds[p] in ("int", "bigint", "boolean", "string") else F.col(p).cast("string")).alias(p) for p in properties]
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("_x", "_y").alias("coordinates")).alias("geometry"), F.struct(*values).alias("properties"))
    return ok.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def simplify_points(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices stay: those farther than ``tolerance`` from the chord of what is kept around them."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    todo = [(0, len(x) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        square = dx * dx + dy * dy
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        t = np.clip((px * dx + py * dy) / square, 0, 1) if square else np.zeros(b - a - 1)
        far = np.hypot(px - t * dx, py - t * dy)
        i = int(far.argmax())
        if far[i] > tolerance:
            keep[a + 1 + i] = True
            todo += [(a, a + 1 + i), (a + 1 + i, b)]
    return keep


def simplify_lines(df: DataFrame, key: str, line: str, tolerance: float = 0.00005) -> DataFrame:
    """(key, line) with fewer vertices. Arrow batches: the recursion over vertices has no column form."""
    kind = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pts in batch.column(1).to_pylist():
                if pts and len(pts) > 2:
                    keep = simplify_points(np.array([p["x"] for p in pts]), np.array([p["y"] for p in pts]), tolerance)
                    pts = [p for p, k in zip(pts, keep, strict=True) if k]
                out.append(pts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], [key, "line"])

    return df.select(F.col(key).cast("string"), line).mapInArrow(run, f"{key} string, line array<struct<x:double,y:double>>")


def routing_tables(edges: DataFrame, nodes: DataFrame, min_component: int = 75) -> tuple[DataFrame, DataFrame]:
    """Edges (one for each u, v, with end coordinates) of components large enough, and the nodes they use."""
    kept = with_endpoints(drop_small_components(last_edge_wins(edges), min_component), nodes)
    used = kept.select(F.explode(F.array("u", "v")).alias("osmid")).distinct()
    return kept, nodes.join(used, "osmid", "left_semi")
