"""Street-network marts: classification, crash scores, safety cost, node profiles, official routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.geo import azimuth, point_line
from geoloom.functions.rules import ROAD_CLASSES, ROUTE_INFRA, ROUTE_RANKS, control_penalty, infra_columns, lookup, oneway_fits, road_rank, safety_factors, severity, side_tag
from geoloom.functions.text import either_contains
from geoloom.operators.spatial import line_line_within, point_line_within

KEY = ["u", "v", "key"]


def with_severity(crashes: DataFrame) -> DataFrame:
    kinds = ("fatal", "incapacitating", "non_incapacitating", "not_evident")
    return crashes.withColumn("severity", severity(*[F.col(f"injuries_{k}") for k in kinds]))


def severity_grid(crashes: DataFrame, cell: float) -> DataFrame:
    """Crash counts and severities on a snapped grid."""
    c = with_severity(crashes).withColumns({"gx": F.round(F.round(F.col("px") / cell) * cell, 6), "gy": F.round(F.round(F.col("py") / cell) * cell, 6)})
    return c.groupBy("gx", "gy").agg(
        F.count(F.lit(1)).alias("crash_count"),
        F.round(F.avg("severity"), 6).alias("avg_severity"),
        F.max("severity").alias("max_severity"),
        F.sum(F.when(F.col("severity") >= 4, 1).otherwise(0)).alias("severe_count"),
        F.min("crash_date").alias("first_crash"),
        F.max("crash_date").alias("last_crash"),
    )


def crash_scores(edges: DataFrame, crashes: DataFrame, eps: float, as_of: str, power: float = 2.0, decay: float = 0.2) -> DataFrame:
    """(u, v, key, crash_count, crash_score) of edges with crashes in reach: severity^power fading with age in years.

    Every version of a crash row counts, so a crash joined to two people counts twice. Crashes at one place meet the same
    edges, so they are added up before the join.
    """
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("crash_date")) / F.lit(365.25 * 86400)
    weight = F.pow(F.col("severity").cast("double"), F.lit(power)) * F.exp(-F.lit(decay) * age)
    places = with_severity(crashes).groupBy("px", "py").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("weight"))
    met = point_line_within(places, edges.select(*KEY, "line"), eps)
    return met.groupBy(*KEY).agg(F.sum("n").alias("crash_count"), F.sum("weight").alias("crash_score"))


def with_crash_scores(edges: DataFrame, crashes: DataFrame, eps: float, as_of: str, power: float = 1.0) -> DataFrame:
    """All edges; those out of reach of crashes score 0."""
    found = crash_scores(edges, crashes, eps, as_of, power)
    return edges.join(found, KEY, "left").withColumns({"crash_count": F.coalesce("crash_count", F.lit(0)), "crash_score": F.coalesce("crash_score", F.lit(0.0))})


def classify(edges: DataFrame, keep_all: bool = False) -> DataFrame:
    """infra_category and infra_type of edges that have any."""
    category, kind = infra_columns()
    out = edges.withColumns({"infra_category": category, "infra_type": kind, "has_buffer": side_tag("buffer").isNotNull(), "is_lit": F.col("lit").isNotNull() & (F.col("lit") != "no")})
    return out if keep_all else out.where("infra_category is not null")


def route_types(routes: DataFrame) -> DataFrame:
    return routes.withColumn("infra_type", lookup(F.col("display_route_type"), ROUTE_INFRA, "other"))


def node_profile(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Degree (in and out edges), intersection flag, worst road and penalty of nodes that have edges: one shuffle."""
    ends = edges.select(F.explode(F.array("u", "v")).alias("osmid"), road_rank(F.col("highway")).alias("rank"))
    found = ends.groupBy("osmid").agg(F.count(F.lit(1)).alias("degree"), F.max("rank").alias("max_road_rank"))
    out = nodes.select("osmid", F.col("highway").alias("traffic_control")).join(found, "osmid")
    out = out.withColumn("is_intersection", F.col("degree") >= 3)
    out = out.withColumn("max_road_class", F.element_at(F.array(*[F.lit(c) for c in ROAD_CLASSES[::-1]]), F.col("max_road_rank")))
    return out.withColumn("traffic_control_penalty", control_penalty(F.col("traffic_control"), F.col("max_road_class"), F.col("is_intersection")))


def route_candidates(edges: DataFrame, routes: DataFrame, eps: float) -> DataFrame:
    """Edges near official routes, with the signals that rank the matches."""
    met = line_line_within(edges.select(*KEY, "name", "line"), routes.select("route_segment_id", "display_route_type", "bike_route_oneway", "bike_route_oneway_dir", "street_name", "route"), eps)
    a, b = F.element_at("line", 1), F.element_at("line", -1)
    turn = azimuth(a["x"], a["y"], b["x"], b["y"])
    return met.withColumns(
        {
            "is_endpoints_near": (F.round(point_line(a["x"], a["y"], F.col("route")), 9) <= eps) & (F.round(point_line(b["x"], b["y"], F.col("route")), 9) <= eps),
            "is_name_match": either_contains(F.col("name"), F.col("street_name")),
            "is_direction_compatible": oneway_fits(F.col("bike_route_oneway"), F.col("bike_route_oneway_dir"), turn),
            "safety_rank": lookup(F.col("display_route_type"), ROUTE_RANKS, 6),
        }
    )


def best_routes(edges: DataFrame, routes: DataFrame, eps: float) -> DataFrame:
    """One official route for each edge: the safest, then by name and direction, then by route id.

    Of routes alike in all but their id only the first id can be chosen, so only it is joined.
    """
    alike = ["display_route_type", "bike_route_oneway", "bike_route_oneway_dir", "street_name", "route"]
    first = F.when(F.count("route_segment_id") == F.count(F.lit(1)), F.min("route_segment_id"))  # a null is the first
    routes = routes.groupBy(*alike).agg(first.alias("route_segment_id"))
    found = route_candidates(edges, routes, eps).where("is_endpoints_near")
    fits = F.coalesce("is_direction_compatible", F.lit(True))
    order = Window.partitionBy(*KEY).orderBy(F.asc("safety_rank"), F.desc_nulls_first("is_name_match"), fits.desc_nulls_first(), F.asc("route_segment_id"))
    best = found.withColumn("rn", F.row_number().over(order)).where("rn = 1")
    best = best.select(*KEY, "route_segment_id", "display_route_type", "is_name_match", "is_direction_compatible")
    return edges.join(best, KEY, "left")


def merged_routes(osm: DataFrame, official: DataFrame, eps: float) -> DataFrame:
    """Both route layers without official segments that an OSM segment near by already has.

    osm: source_id, street_name, infra_type, line. official: source_id, street_name, infra_type, route.
    """
    met = line_line_within(osm.select(F.col("street_name").alias("osm_name"), "line"), official.select("source_id", "street_name", "route"), eps)
    alike = F.coalesce(F.col("osm_name").isNull() | either_contains(F.col("osm_name"), F.col("street_name")), F.lit(False))
    a, b = F.element_at("route", 1), F.element_at("route", -1)
    ends = (F.round(point_line(a["x"], a["y"], F.col("line")), 9) <= eps) & (F.round(point_line(b["x"], b["y"], F.col("line")), 9) <= eps)
    flags = met.groupBy("source_id").agg(F.bool_or(alike).alias("likely"), F.bool_or(ends & alike).alias("ends_near"))
    left = official.join(flags.where("likely and ends_near"), "source_id", "left_anti")
    cols = ["source_id", "street_name", "infra_type"]
    return osm.select(*cols, F.lit("osm").alias("data_source")).unionByName(left.select(*cols, F.lit("official").alias("data_source")))


def safety_edges(edges: DataFrame, crashes: DataFrame, routes: DataFrame, nodes: DataFrame, eps: float, dupe: float, as_of: str, crash_weight: float = 50.0) -> DataFrame:
    """The safety-weighted network: factors, crash and node penalties, cost."""
    full = best_routes(classify(edges, keep_all=True), routes, dupe)
    full = full.join(crash_scores(edges, crashes, eps, as_of), KEY, "left")
    full = full.join(node_profile(edges, nodes).select(F.col("osmid").alias("v"), "traffic_control_penalty"), "v", "left")
    score = F.coalesce("crash_score", F.lit(0.0))
    full = full.withColumns(
        {
            **safety_factors(),
            "crash_count": F.coalesce("crash_count", F.lit(0)),
            "crash_score": score,
            "crash_score_per_meter": F.when(F.col("length_m") > 0, score / F.col("length_m")).otherwise(0.0),
            "traffic_control_penalty": F.coalesce("traffic_control_penalty", F.lit(0.0)),
        }
    )
    penalty = F.col("crash_score_per_meter") * F.col("length_m") * crash_weight
    product = F.col("length_m") * F.col("speed_factor") * F.col("road_type_factor") * F.col("infrastructure_factor") * F.col("surface_factor") * F.col("lighting_factor")
    return full.withColumns({"crash_penalty": penalty, "safety_cost": F.greatest(product + penalty + F.col("traffic_control_penalty"), F.lit(0.0))})
