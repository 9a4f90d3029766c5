"""Readers and element decoders: delimited text, GeoJSON features, OSM elements, bike records, WKB."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.session import stage


def read_csv(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Header text files: everything a string, empty fields null, white space and quoted line ends kept."""
    return spark.read.csv(path, header=True, sep=delimiter, encoding=encoding, multiLine=True, nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"')


def parse_features(df: DataFrame, column: str, properties: dict[str, str]) -> DataFrame:
    """GeoJSON feature texts to property columns, gtype, coordinates (JSON text), and whether the feature is valid."""
    kinds = ", ".join(f"`{k}`: {t}" for k, t in properties.items())
    f = F.from_json(column, f"type string, properties struct<{kinds}>, geometry struct<type: string, coordinates: string>")
    out = df.select("*", f.alias("_f"))
    gtype = F.col("_f.geometry.type")
    known = gtype.isin("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")
    return out.select(*df.columns, *[F.col(f"_f.properties.`{k}`").alias(k) for k in properties], gtype.alias("gtype"), F.col("_f.geometry.coordinates").alias("coordinates"), F.coalesce(known & F.col("_f.geometry.coordinates").isNotNull(), F.lit(False)).alias("is_valid"))


def unknown_properties(df: DataFrame, column: str, properties: list[str]) -> DataFrame:
    """How often each property that no column takes occurs."""
    keys = F.json_object_keys(F.get_json_object(column, "$.properties"))
    return df.select(F.explode(keys).alias("property")).where(~F.col("property").isin(properties)).groupBy("property").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Features:
    """What :func:`read_features` found: the locked property names, good rows, failed rows, and how often properties came
    that no column takes."""

    properties: list[str]
    good: DataFrame
    failed: DataFrame
    unknown: DataFrame


_DEPTH = {"Point": 1, "MultiPoint": 2, "LineString": 2, "MultiLineString": 3, "Polygon": 3, "MultiPolygon": 4}


def read_features(df: DataFrame, column: str, order: Sequence[str], keep: Sequence[str] = (), lowercase: bool = False) -> Features:
    """GeoJSON features, one text a row, as rows with columns locked by the first valid feature.

    The first is the one with the least ``order`` (file and position, say) wherever its split is read. Its properties are
    the columns, all as text; a later feature without one has null there, properties that it doesn't name are dropped but
    counted. A text that isn't a feature, has no geometry, an unknown kind of geometry or coordinates of another depth
    than its kind has goes to ``failed`` with the reason. Good, failed and unknown are read from one staged pass.
    ``lowercase``: property names in lower case; of names that then are one, the first in the text counts.
    """
    f = F.from_json(column, "type string, properties map<string,string>, geometry struct<type: string, coordinates: string>")
    gtype, at = F.col("_f.geometry.type"), F.col("_f.geometry.coordinates")
    depth = F.length(F.regexp_extract(F.regexp_replace(at, r"\s", ""), r"^(\[*)-?[0-9]", 1))
    known = F.create_map(*[F.lit(x) for pair in _DEPTH.items() for x in pair])
    failure = (
        F.when(F.col("_f").isNull() | (F.coalesce(F.col("_f.type"), F.lit("")) != "Feature"), F.lit("not a feature"))
        .when(gtype.isNull(), F.lit("no geometry"))
        .when(known[gtype].isNull(), F.lit("unknown geometry"))
        .when(at.isNull() | (depth != known[gtype]), F.lit("bad coordinates"))
    )
    names = F.coalesce(F.json_object_keys(F.get_json_object(column, "$.properties")), F.array().cast("array<string>"))
    values = F.col("_f.properties")
    parsed = df.select(*dict.fromkeys([*order, *keep]), F.col(column).alias("_text"), f.alias("_f"), names.alias("_names"))
    if lowercase:
        entries = F.map_entries("_f.properties")
        lowered = F.transform(entries, lambda e: F.lower(e["key"]))
        firsts = F.filter(entries, lambda e, i: F.array_position(lowered, F.lower(e["key"])) == i + 1)
        values = F.map_from_entries(F.transform(firsts, lambda e: F.struct(F.lower(e["key"]), e["value"])))
        parsed = parsed.withColumn("_low", F.array_distinct(F.transform("_names", F.lower)))
    names = F.col("_low" if lowercase else "_names")
    parsed = stage(parsed.select(*dict.fromkeys([*order, *keep]), "_text", names.alias("_names"), values.alias("_values"), gtype.alias("gtype"), at.alias("coordinates"), failure.alias("failure")))
    first = parsed.where("failure is null").agg(F.min_by("_names", F.struct(*order)).alias("n")).first()[0]
    locked = list(first or [])
    good = parsed.where("failure is null").select(*keep, *[F.col("_values")[p].alias(p) for p in locked], "gtype", "coordinates")
    failed = parsed.where("failure is not null").select(*keep, "failure", F.col("_text").alias("feature"))
    unknown = parsed.where("failure is null").select(F.explode("_names").alias("property")).where(~F.col("property").isin(locked)).groupBy("property").agg(F.count(F.lit(1)).alias("n"))
    return Features(locked, good, failed, unknown)


def promote(gtype: Column, coordinates: Column) -> tuple[Column, Column]:
    """Single geometries as Multi ones."""
    single = gtype.isin("Point", "LineString", "Polygon")
    return F.when(single, F.concat(F.lit("Multi"), gtype)).otherwise(gtype), F.when(single, F.concat(F.lit("["), coordinates, F.lit("]"))).otherwise(coordinates)


def osm_nodes(df: DataFrame) -> DataFrame:
    """Node elements: tags as JSON with sorted keys; the epoch counts as no timestamp."""
    tags = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("tags"))))
    return df.select(F.col("id").alias("osm_id"), tags.alias("tags"), F.nullif(F.col("timestamp"), F.lit("1970-01-01").cast("timestamp")).alias("timestamp"), "version", "changeset", "lon", "lat")


def assemble_ways(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways with their vertices in order. Refs without a place are left out; under two vertices is a failure; a closed
    way of four vertices or more is a polygon."""
    at = nodes.where("lon is not null and lat is not null").select(F.col("id").alias("ref"), "lon", "lat")
    refs = ways.select("id", F.posexplode("refs").alias("pos", "ref")).join(at, "ref")
    line = refs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("p"))
    line = line.select("id", F.transform("p", lambda s: F.struct(s["lon"].alias("x"), s["lat"].alias("y"))).alias("line"))
    out = ways.select("id").join(line, "id", "left")
    n = F.coalesce(F.size("line"), F.lit(0))
    closed = (n >= 4) & (F.element_at("line", 1) == F.element_at("line", -1))
    return out.select("id", "line", n.alias("vertices"), F.when(n < 2, "failure").when(closed, "Polygon").otherwise("LineString").alias("gtype"))


def osm_relations(df: DataFrame) -> DataFrame:
    """Members as JSON, empty roles kept."""
    return df.select(F.col("id").alias("osm_id"), F.to_json(F.transform("members", lambda m: F.struct(m["type"].alias("type"), m["ref"].alias("ref"), F.coalesce(m["role"], F.lit("")).alias("role")))).alias("members"), F.size("members").alias("n_members"))


def rows_from_header_array(df: DataFrame, column: str, names: list[str], key: str) -> DataFrame:
    """List-of-lists responses: the first list is the header; under two lists gives no rows."""
    lists = df.where(F.size(column) > 1).select(key, F.element_at(column, 1).alias("header"), F.posexplode(F.slice(column, 2, F.size(column))).alias("pos", "row"))
    at = F.map_from_arrays("header", "row")
    return lists.select(key, "pos", *[at[n].alias(n) for n in names])


def flatten_bikes(df: DataFrame) -> DataFrame:
    """Nested bike records as flat rows; coordinates only from pairs."""
    c = F.col("stolen_coordinates")
    return df.select("id", "title", F.to_json("frame_colors").alias("frame_colors"), F.when(F.size(c) == 2, c[0]).alias("latitude"), F.when(F.size(c) == 2, c[1]).alias("longitude"), F.timestamp_seconds("date_stolen").alias("stolen_at"))


def encode_wkb(df: DataFrame, line: str, key: str, srid: int) -> DataFrame:
    """(key, hex): lines as hexadecimal EWKB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pts in batch.column(1).to_pylist():
                out.append(None if pts is None else (struct.pack("<BIII", 1, 2 | 0x20000000, srid, len(pts)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in pts)).hex().upper())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, "hex"])

    return df.select(F.col(key).cast("string"), line).mapInArrow(run, f"{key} string, hex string")


def decode_wkb(df: DataFrame, column: str, key: str) -> DataFrame:
    """(key, gtype, srid, parts, failure): geometries from hexadecimal WKB or EWKB; null stays null, srid 0 if unknown. What
    can't be read is null with its failure: "not hexadecimal", "cut short" or "unknown geometry"."""
    names = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}

    def one(data: bytes, at: int) -> tuple[str, int, list, int]:
        end = "<" if data[at] else ">"
        (kind,) = struct.unpack_from(f"{end}I", data, at + 1)
        at, srid = at + 5, 0
        if kind & 0x20000000:
            (srid,) = struct.unpack_from(f"{end}I", data, at)
            at += 4
        dims = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
        kind &= 0xFF
        if kind not in names:
            raise KeyError(kind)

        def points(n: int, at: int) -> tuple[list, int]:
            if at + 8 * n * dims > len(data):
                raise IndexError(n)
            flat = struct.unpack_from(f"{end}{n * dims}d", data, at)
            return [{"x": flat[i * dims], "y": flat[i * dims + 1]} for i in range(n)], at + 8 * n * dims

        if kind == 1:
            pts, at = points(1, at)
            return names[kind], srid, [pts], at
        (n,) = struct.unpack_from(f"{end}I", data, at)
        at += 4
        if kind == 2:
            pts, at = points(n, at)
            return names[kind], srid, [pts], at
        parts = []
        for _ in range(n):
            if kind == 3:
                (m,) = struct.unpack_from(f"{end}I", data, at)
                pts, at = points(m, at + 4)
                parts.append(pts)
            else:
                _, _, more, at = one(data, at)
                parts += more
        return names[kind], srid, parts, at

    def read(text: str | None) -> tuple[str | None, int | None, list | None, str | None]:
        if not text:
            return None, None, None, None
        try:
            return *one(bytes.fromhex(text), 0)[:3], None
        except (struct.error, IndexError):
            return None, None, None, "cut short"
        except (KeyError, RecursionError):
            return None, None, None, "unknown geometry"
        except ValueError:
            return None, None, None, "not hexadecimal"

    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [read(h) for h in batch.column(1).to_pylist()]
            types = [pa.string(), pa.int32(), kind, pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([g[i] for g in got], t) for i, t in enumerate(types)]], [key, "gtype", "srid", "parts", "failure"])

    return df.select(F.col(key).cast("string"), column).mapInArrow(run, f"{key} string, gtype string, srid int, parts array<array<struct<x:double,y:double>>>, failure string")
