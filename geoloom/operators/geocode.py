"""The address cache and a set-wise geocoding pass over an address-range table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.session import stage


def coordinate_pick(df: DataFrame, key: str, lat0: float, lon0: float) -> DataFrame:
    """One coordinate for each address: the far side of the origin its average lies on."""
    g = df.groupBy(key).agg(*[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))])
    pick = lambda c, o: F.when(F.col(f"avg_{c}") < o, F.col(f"min_{c}")).otherwise(F.col(f"max_{c}"))
    return g.select(key, pick("latitude", lat0).alias("latitude"), pick("longitude", lon0).alias("longitude"))


def best_per_hash(df: DataFrame, key: str = "address_hash") -> DataFrame:
    """One row for each hash: the best quality, then a known latitude, then the address."""
    w = Window.partitionBy(key).orderBy(F.asc("quality"), F.asc_nulls_last("latitude"), F.asc("address"))
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def parse_address(df: DataFrame, column: str) -> DataFrame:
    """Number, direction, street name and street type of an address."""
    s = F.upper(F.col(column))
    rule = r"^\s*(\d+)\s+(?:([NSEW])\s+)?(.*?)\s+(ST|AVE|BLVD|RD|DR|PL|CT)\b"
    part = lambda i: F.nullif(F.regexp_extract(s, rule, i), F.lit(""))
    return df.withColumns({"number": part(1).try_cast("int"), "direction": part(2), "street": part(3), "street_type": part(4)})


def range_candidates(parsed: DataFrame, ranges: DataFrame) -> DataFrame:
    """Street segments whose number range holds a parsed address, with the place along the segment and a rating.

    ranges: segment_id, street, street_type, direction, from_number, to_number, parity (0, 1 or null), x0, y0, x1, y1.
    The rating is 0 for a full match, plus 5 for another direction, 10 for the other side of the street.
    """
    r = ranges.select("segment_id", F.col("street").alias("r_street"), F.col("street_type").alias("r_type"), F.col("direction").alias("r_direction"), "from_number", "to_number", "parity", "x0", "y0", "x1", "y1")
    # a range lies in one or two cells as wide as the next power of two; an address looks into its cell of every width there is
    wide = F.length(F.bin(F.col("to_number").cast("long") - F.col("from_number")))
    r = r.where("from_number <= to_number").withColumn("_wide", wide)
    at = lambda c: F.expr(f"shiftright(cast({c} as bigint), _wide)")
    r = r.withColumn("_cell", F.explode(F.array_distinct(F.array(at("from_number"), at("to_number")))))
    widths = r.select("_wide").distinct()  # at most one for each bit of a number
    looked = parsed.join(F.broadcast(widths)).withColumn("_cell", at("number")).withColumnsRenamed({"_wide": "_p_wide", "_cell": "_p_cell"})
    same = (F.col("street") == F.col("r_street")) & (F.col("street_type") == F.col("r_type")) & (F.col("_p_wide") == F.col("_wide")) & (F.col("_p_cell") == F.col("_cell"))
    met = looked.join(r, same & F.col("number").between(F.col("from_number"), F.col("to_number"))).drop("_wide", "_cell", "_p_wide", "_p_cell")
    share = (F.col("number") - F.col("from_number")) / F.greatest(F.col("to_number") - F.col("from_number"), F.lit(1)).cast("double")
    rating = F.when(F.coalesce("direction", F.lit("")) != F.coalesce("r_direction", F.lit("")), 5).otherwise(0) + F.when(F.col("parity").isNotNull() & (F.col("parity") != F.col("number") % 2), 10).otherwise(0)
    return met.withColumns({"rating": rating, "longitude": F.col("x0") + share * (F.col("x1") - F.col("x0")), "latitude": F.col("y0") + share * (F.col("y1") - F.col("y0"))})


def is_pending(latitude: Column, failure: Column) -> Column:
    """No coordinates yet, and no failure but a passing one."""
    return latitude.isNull() & (failure.isNull() | failure.startswith("error:"))


def geocode(cache: DataFrame, ranges: DataFrame, threshold: int = 20, key: str = "address_hash") -> DataFrame:
    """Outcome of one pass over the pending rows of a cache: each row is tried once.

    key, rating, latitude, longitude (if the best rating is at most ``threshold``) and failure (no_result or
    below_threshold:rating_n). Addresses that read alike are looked up once.
    """
    todo = stage(parse_address(cache.where(is_pending(F.col("latitude"), F.col("failure"))).select(key, "address"), "address").drop("address"))
    read = ["number", "direction", "street", "street_type"]
    alike = todo.where("number is not null and street is not null and street_type is not null").select(*read).distinct()
    best = range_candidates(alike, ranges).groupBy(*read).agg(F.min(F.struct("rating", "segment_id", "latitude", "longitude")).alias("b"))
    best = best.select(*[F.coalesce(c, F.lit("")).alias(f"_{c}") if c == "direction" else F.col(c).alias(f"_{c}") for c in read], "b")
    met = todo.withColumn("direction", F.coalesce("direction", F.lit(""))).join(best, [F.col(c) == F.col(f"_{c}") for c in read])
    out = todo.select(key).join(met.groupBy(key).agg(F.min("b").alias("b")), key, "left")
    good = F.col("b").isNotNull() & (F.col("b.rating") <= threshold)
    failure = F.when(F.col("b").isNull(), F.lit("no_result")).when(~good, F.concat(F.lit("below_threshold:rating_"), F.col("b.rating").cast("string")))
    return out.select(key, F.col("b.rating").alias("rating"), F.when(good, F.col("b.latitude")).alias("latitude"), F.when(good, F.col("b.longitude")).alias("longitude"), failure.alias("failure"))
