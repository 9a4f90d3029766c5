"""Registered queries over the street network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.geo import azimuth, haversine, local_metres
from geoloom.functions.rules import ROUTE_FACTORS
from geoloom.operators import network
from geoloom.operators.spatial import line_line_within, near_pairs, nearest_node, point_line_within
from geoloom.plans import lattice as L

KEY = ["u", "v", "key"]
_N, _E, _C, _R, _S = L.NODES, L.EDGES, L.CRASHES, L.ROUTES, L.SUPPLEMENT
_SEG = ("e.x0", "e.y0", "e.x1", "e.y1")
_ROUTE = ("r.rx0", "r.ry", "r.rx1", "r.ry")

# Written from the published tag rules: each side's effective tag first, then the right side before the left one.
_CLASSIFIED = """sides as (
  select *, coalesce(cycleway_left, cycleway_both, cycleway) as left_way, coalesce(cycleway_right, cycleway_both, cycleway) as right_way,
    coalesce(cycleway_left_buffer, cycleway_right_buffer, cycleway_both_buffer, cycleway_buffer) is not null as has_buffer,
    coalesce(cycleway_left_separation, cycleway_right_separation, cycleway_both_separation, cycleway_separation) as separation,
    coalesce(cycleway_left_shared_lane, cycleway_right_shared_lane, cycleway_both_shared_lane, cycleway_shared_lane) as shared_mark
  from edges
), one_way as (select *, coalesce(right_way, left_way, '') as way, coalesce(separation not in ('no', 'none'), false) as separated from sides
), classified as (
  select *, lit is not null and lit <> 'no' as is_lit,
    case when highway in ('cycleway', 'path', 'pedestrian') or way in ('track', 'separate') or separated then 'separated'
      when way in ('lane', 'exclusive') or has_buffer then 'on_road'
      when way in ('shared_lane', 'shared', 'share_busway') or shared_mark is not null or bicycle_road = 'yes' or cyclestreet = 'yes' then 'shared'
      when highway in ('footway', 'bridleway', 'steps') and bicycle in ('yes', 'designated', 'permissive') then 'path'
      when bicycle in ('designated', 'yes') then 'shared' end as infra_category,
    case when separated and way in ('track', 'lane', 'separate') then 'protected_lane' when highway = 'cycleway' or way in ('track', 'separate') then 'track'
      when has_buffer then 'buffered_lane' when way in ('lane', 'exclusive') then 'bike_lane' when way in ('shared_lane', 'shared') or shared_mark is not null then 'sharrow'
      when bicycle_road = 'yes' or cyclestreet = 'yes' then 'bicycle_road' when way = 'share_busway' then 'share_busway'
      when highway in ('path', 'footway', 'bridleway', 'pedestrian', 'steps') then 'shared_path' when bicycle = 'designated' then 'designated_path' end as infra_type
  from one_way)"""

_PL = L.sql_point_segment("c.px", "c.py", *_SEG)
_NEAR_CELL = "c.px between least(e.x0, e.x1) - 0.001 and greatest(e.x0, e.x1) + 0.001 and c.py between least(e.y0, e.y1) - 0.001 and greatest(e.y0, e.y1) + 0.001"
_MET = f"met as (select e.u, e.v, e.key, c.*, round({_PL}, 9) as distance from crashes c join edges e on {_NEAR_CELL} and round({_PL}, 9) <= 0.0004::double)"


def _scores(power: int) -> str:
    return f"""scores as (select u, v, key, count(*) as crash_count,
      sum(pow(severity::double, {power}) * exp(-0.2::double * ((epoch(timestamp '2025-01-01') - floor(epoch(crash_date))) / (365.25::double * 86400)))) as crash_score from met group by u, v, key)"""


_LL = L.sql_segments(_SEG, _ROUTE)
_BOX = "least(e.x0, e.x1) - 0.00015 <= r.rx1 and r.rx0 <= greatest(e.x0, e.x1) + 0.00015 and least(e.y0, e.y1) - 0.00015 <= r.ry and r.ry <= greatest(e.y0, e.y1) + 0.00015"
_LMET = f"lmet as (select e.*, r.*, round({_LL}, 9) as distance from edges e join routes r on {_BOX} and round({_LL}, 9) <= 0.00015::double)"
_AZ = L.sql_azimuth("x0", "y0", "x1", "y1")


def _near(px: str, py: str, seg: tuple[str, ...]) -> str:
    return f"round({L.sql_point_segment(px, py, *seg)}, 9) <= 0.00015::double"


_CAND = f"""cand as (
  select *, {_near('x0', 'y0', ('rx0', 'ry', 'rx1', 'ry'))} and {_near('x1', 'y1', ('rx0', 'ry', 'rx1', 'ry'))} as is_endpoints_near,
    (contains(lower(name), lower(street_name)) or contains(lower(street_name), lower(coalesce(name, '')))) as is_name_match,
    case when bike_route_oneway = '2W' then true when bike_route_oneway_dir = '-' then null when bike_route_oneway_dir = 'N' and {_AZ} between 315 and 360 or {_AZ} < 45 then true
      when bike_route_oneway_dir = 'S' and {_AZ} between 135 and 225 then true when bike_route_oneway_dir = 'E' and {_AZ} between 45 and 135 then true
      when bike_route_oneway_dir = 'W' and {_AZ} between 225 and 315 then true when bike_route_oneway_dir = 'NW' and {_AZ} between 270 and 360 then true else false end as is_direction_compatible,
    case display_route_type when 'Protected Bike Lane' then 1 when 'Neighborhood Greenway' then 2 when 'Buffered Bike Lane' then 3 when 'Bike Lane' then 4 when 'Marked Shared Lane' then 5 else 6 end as safety_rank
  from lmet), best as (
  select u, v, key, route_segment_id, display_route_type, is_name_match, is_direction_compatible from (
    select *, row_number() over (partition by u, v, key order by safety_rank, is_name_match desc nulls first, coalesce(is_direction_compatible, true) desc nulls first, route_segment_id) as rn
    from cand where is_endpoints_near) where rn = 1)"""

_RANK = "case when highway like '%primary%' then 4 when highway like '%secondary%' then 3 when highway like '%tertiary%' then 2 else 1 end"


def _penalty(a: str, b: str, c: str, d: str) -> str:
    return f"case max_road_rank when 4 then {a} when 3 then {b} when 2 then {c} else {d} end"


PROFILE = f"""ends as (select u as osmid, {_RANK} as rank from edges union all select v, {_RANK} from edges
), deg as (select osmid, count(*) as degree, max(rank) as max_road_rank from ends group by osmid
), profile as (
  select n.osmid, n.highway as traffic_control, degree, degree >= 3 as is_intersection, max_road_rank,
    case max_road_rank when 4 then 'primary' when 3 then 'secondary' when 2 then 'tertiary' else 'minor' end as max_road_class,
    cast(case when n.highway = 'traffic_signals' then {_penalty('0', '2', '5', '7')} when n.highway in ('crossing', 'stop') then {_penalty('7', '7', '8', '9')}
      when n.highway = 'mini_roundabout' then {_penalty('7', '7', '7', '8')} when n.highway = 'give_way' then 10
      when n.highway is null and degree >= 3 then {_penalty('25', '20', '15', '12')} else 0 end as double) as traffic_control_penalty
  from nodes n join deg using (osmid))"""


def severity_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = network.with_severity(L.crashes(spark, sf_dir))
    return c.select("crash_record_id", F.round("px", 6).alias("px"), F.round("py", 6).alias("py"), "severity", F.year("crash_date").alias("crash_year"), F.hour("crash_date").alias("crash_hour"))


def severity_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.severity_grid(L.crashes(spark, sf_dir), 0.002)


def bbox_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = L.crashes(spark, sf_dir).where("px >= -87.95D and px <= -87.90D and py >= 41.64D and py <= 41.69D")
    return c.select("crash_record_id", F.round("px", 6).alias("px"), F.round("py", 6).alias("py"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("crash_record_id")).alias("stolen_at"))


def edge_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = L.edges(spark, sf_dir).where("greatest(x0, x1) >= -87.96D and least(x0, x1) <= -87.88D and greatest(y0, y1) >= 41.63D and least(y0, y1) <= 42.05D")
    return e.select(*KEY, F.md5(F.concat(F.col("u").cast("string"), F.lit("|"), F.col("v").cast("string"), F.lit("|"), F.col("key").cast("string"))).alias("segment_id"), F.round("length_m", 6).alias("length_m"), F.coalesce("oneway", F.lit("no")).alias("oneway"))


def infra_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.classify(L.edges(spark, sf_dir)).select(*KEY, "infra_category", "infra_type", "is_lit", "has_buffer")


def route_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = network.route_types(L.routes(spark, sf_dir))
    key = F.md5(F.concat_ws("|", F.coalesce("street_name", F.lit("")), F.lit(""), F.coalesce(F.col("row").cast("string"), F.lit("")), F.coalesce("display_route_type", F.lit(""))))
    return r.select("route_segment_id", key.alias("route_key"), "display_route_type", "infra_type")


def point_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_line_within(L.crashes(spark, sf_dir), L.edges(spark, sf_dir).select(*KEY, "line"), L.EPS).select("crash_record_id", *KEY, "distance")


def line_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_line_within(L.edges(spark, sf_dir).select(*KEY, "line"), L.routes(spark, sf_dir).select("route_segment_id", "route"), L.DUPE).select(*KEY, "route_segment_id", "distance")


def line_line_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = L.routes(spark, sf_dir)
    met = line_line_join(spark, sf_dir).groupBy("route_segment_id").agg(F.count(F.lit(1)).alias("n_edges"), F.min("distance").alias("nearest"))
    return routes.select("route_segment_id").join(met, "route_segment_id", "left").withColumn("n_edges", F.coalesce("n_edges", F.lit(0)))


def edge_best_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.best_routes(L.edges(spark, sf_dir), L.routes(spark, sf_dir), L.DUPE).select(*KEY, "route_segment_id", "display_route_type", "is_name_match", "is_direction_compatible")


def route_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    osm = network.classify(L.edges(spark, sf_dir)).select(F.concat_ws("-", *[F.col(k).cast("string") for k in KEY]).alias("source_id"), F.col("name").alias("street_name"), "infra_type", "line")
    short = F.expr("array(element_at(route, 1), named_struct('x', element_at(route, 1).x + 0.002D, 'y', element_at(route, 1).y))")
    official = network.route_types(L.routes(spark, sf_dir)).select(F.col("route_segment_id").cast("string").alias("source_id"), "street_name", "infra_type", short.alias("route"))
    return network.merged_routes(osm, official, L.DUPE)


def edge_crash_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = network.with_crash_scores(L.edges(spark, sf_dir), L.crashes(spark, sf_dir), L.EPS, L.AS_OF)
    return e.select(*KEY, "crash_count", F.round("crash_score", 6).alias("crash_score"))


def node_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.node_profile(L.edges(spark, sf_dir), L.nodes(spark, sf_dir))


def safety_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = network.safety_edges(L.edges(spark, sf_dir), L.crashes(spark, sf_dir), L.routes(spark, sf_dir), L.nodes(spark, sf_dir), L.EPS, L.DUPE, L.AS_OF)
    rounded = ["crash_score", "crash_score_per_meter", "crash_penalty", "safety_cost"]
    return e.select(*KEY, "infra_type", "display_route_type", "crash_count", "speed_factor", "road_type_factor", "infrastructure_factor", "surface_factor", "lighting_factor", "traffic_control_penalty", *[F.round(c, 6).alias(c) for c in rounded])


def haversine_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.edges(spark, sf_dir).select(*KEY, F.round(haversine(F.col("y0"), F.col("x0"), F.col("y1"), F.col("x1")), 6).alias("metres"))


def azimuth_deg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.edges(spark, sf_dir).select(*KEY, F.round(azimuth(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")), 6).alias("azimuth"))


def local_metre_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    mx, my = local_metres(F.col("x"), F.col("y"), F.lit(L.MEAN_LATITUDE))
    return L.nodes(spark, sf_dir).select("osmid", F.round(mx, 6).alias("mx"), F.round(my, 6).alias("my"))


def near_node_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = L.nodes(spark, sf_dir).select("osmid", "x", "y").unionByName(L.supplement(spark, sf_dir).select("osmid", "x", "y"))
    return near_pairs(both, 12.0, L.MEAN_LATITUDE)


def nearest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_node(L.crashes(spark, sf_dir), L.nodes(spark, sf_dir), "crash_record_id")


def unmatched_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = L.edges(spark, sf_dir)
    hit = point_line_within(L.crashes(spark, sf_dir), e.select(*KEY, "line"), L.EPS).select(*KEY)
    return e.join(hit, KEY, "left_anti").select(*KEY, "highway")


QUERIES = (
    severity_points, severity_grid, bbox_stage, edge_stage, infra_classify, route_type_map, point_line_join, line_line_join, line_line_outer, edge_best_route, route_dedupe, edge_crash_score,
    node_profile, safety_edges, haversine_len, azimuth_deg, local_metre_xy, near_node_pairs, nearest_nodes, unmatched_edges,
)

_FACTORS = """
    cast(case when maxspeed is null then 1.4 when try_cast(regexp_replace(maxspeed, '[^0-9].*', '') as int) <= 20 then 1.0 when try_cast(regexp_replace(maxspeed, '[^0-9].*', '') as int) <= 25 then 1.3
      when try_cast(regexp_replace(maxspeed, '[^0-9].*', '') as int) <= 30 then 1.6 when try_cast(regexp_replace(maxspeed, '[^0-9].*', '') as int) > 30 then 2.0 else 1.4 end as double) as speed_factor,
    cast(case when highway like '%cycleway%' then 0.6 when highway in ('footway', 'bridleway') or highway like '%path%' then 0.7 when highway = 'pedestrian' then 0.8 when highway = 'living_street' then 0.9
      when highway = 'service' and service = 'alley' then 1.3 when highway = 'service' then 1.0 when highway like '%residential%' then 1.1 when highway in ('unclassified', 'busway') then 1.4
      when highway like '%tertiary%' then 1.7 when highway like '%secondary%' then 2.2 when highway like '%primary%' then 2.7 else 1.3 end as double) as road_type_factor,
    cast(coalesce(case infra_type when 'protected_lane' then 0.4 when 'track' then 0.5 when 'shared_path' then 0.6 when 'buffered_lane' then 0.7 when 'designated_path' then 0.7 when 'bicycle_road' then 0.8
      when 'bike_lane' then 0.85 when 'share_busway' then 0.9 when 'sharrow' then 0.95 end, {routes}, 1.0) as double) as infrastructure_factor,
    cast(case when surface in ('paving_stones', 'sett', 'cobblestone', 'unhewn_cobblestone') then 1.3 when surface in ('unpaved', 'gravel', 'fine_gravel', 'compacted', 'dirt', 'grass', 'ground', 'mud', 'sand') then 1.5 else 1.0 end as double) as surface_factor,
    cast(case lit when 'yes' then 1.0 when 'no' then 1.2 else 1.1 end as double) as lighting_factor""".format(
    routes="case display_route_type " + " ".join(f"when '{k}' then {v}" for k, v in ROUTE_FACTORS.items()) + " end"
)

SQL = {
    "severity_points": f"with {_C} select crash_record_id, round(px, 6) as px, round(py, 6) as py, severity, cast(year(crash_date) as integer) as crash_year, cast(hour(crash_date) as integer) as crash_hour from crashes",
    "severity_grid": f"""with {_C} select round(round(px / 0.002::double) * 0.002::double, 6) as gx, round(round(py / 0.002::double) * 0.002::double, 6) as gy, count(*) as crash_count, round(avg(severity), 6) as avg_severity,
      max(severity) as max_severity, cast(sum(case when severity >= 4 then 1 else 0 end) as bigint) as severe_count, min(crash_date) as first_crash, max(crash_date) as last_crash from crashes group by 1, 2""",
    "bbox_stage": f"""with {_C} select crash_record_id, round(px, 6) as px, round(py, 6) as py, to_timestamp(1700000000 + crash_record_id) at time zone 'UTC' as stolen_at from crashes
      where px >= -87.95::double and px <= -87.90::double and py >= 41.64::double and py <= 41.69::double""",
    "edge_stage": f"""with {_N}, {_E} select u, v, key, md5(u::varchar || '|' || v::varchar || '|' || key::varchar) as segment_id, round(length_m, 6) as length_m, coalesce(oneway, 'no') as oneway from edges
      where greatest(x0, x1) >= -87.96::double and least(x0, x1) <= -87.88::double and greatest(y0, y1) >= 41.63::double and least(y0, y1) <= 42.05::double""",
    "infra_classify": f"with {_N}, {_E}, {_CLASSIFIED} select u, v, key, infra_category, infra_type, is_lit, has_buffer from classified where infra_category is not null",
    "route_type_map": """select s_suppkey as route_segment_id, md5(concat('STREET ', s_suppkey % 40, '|', '', '|', s_suppkey % 40, '|', t)) as route_key, t as display_route_type,
      case t when 'Protected Bike Lane' then 'protected_lane' when 'Buffered Bike Lane' then 'buffered_lane' when 'Bike Lane' then 'bike_lane' when 'Marked Shared Lane' then 'sharrow' when 'Neighborhood Greenway' then 'neighborhood_greenway' else 'other' end as infra_type
      from (select *, case s_suppkey % 6 when 0 then 'Protected Bike Lane' when 1 then 'Neighborhood Greenway' when 2 then 'Buffered Bike Lane' when 3 then 'Bike Lane' when 4 then 'Marked Shared Lane' else 'Other' end as t from supplier)""",
    "point_line_join": f"with {_N}, {_E}, {_C}, {_MET} select crash_record_id, u, v, key, distance from met",
    "line_line_join": f"with {_N}, {_E}, {_R}, {_LMET} select u, v, key, route_segment_id, distance from lmet",
    "line_line_outer": f"""with {_N}, {_E}, {_R}, {_LMET} select r.route_segment_id, count(m.u) as n_edges, min(m.distance) as nearest from routes r left join lmet m on m.route_segment_id = r.route_segment_id group by 1""",
    "edge_best_route": f"with {_N}, {_E}, {_R}, {_LMET}, {_CAND} select u, v, key, route_segment_id, display_route_type, is_name_match, is_direction_compatible from edges left join best using (u, v, key)",
    "route_dedupe": f"""with {_N}, {_E}, {_CLASSIFIED}, {_R}, o as (
        select concat_ws('-', u, v, key) as source_id, name as street_name, infra_type, x0, y0, x1, y1 from classified where infra_category is not null
      ), f as (select cast(route_segment_id as varchar) as source_id, street_name, rx0, ry, rx0 + 0.002::double as rx1,
        case display_route_type when 'Protected Bike Lane' then 'protected_lane' when 'Buffered Bike Lane' then 'buffered_lane' when 'Bike Lane' then 'bike_lane' when 'Marked Shared Lane' then 'sharrow' when 'Neighborhood Greenway' then 'neighborhood_greenway' else 'other' end as infra_type from routes
      ), m as (select r.source_id, e.street_name is null or contains(lower(e.street_name), lower(r.street_name)) or contains(lower(r.street_name), lower(e.street_name)) as alike,
          {_near('r.rx0', 'r.ry', _SEG)} and {_near('r.rx1', 'r.ry', _SEG)} as ends from o e join f r on {_BOX} and round({_LL}, 9) <= 0.00015::double
      ), d as (select source_id from m group by source_id having bool_or(alike) and bool_or(ends and alike))
      select source_id, street_name, infra_type, 'osm' as data_source from o union all select source_id, street_name, infra_type, 'official' from f where source_id not in (select source_id from d)""",
    "edge_crash_score": f"with {_N}, {_E}, {_C}, {_MET}, {_scores(1)} select u, v, key, coalesce(crash_count, 0) as crash_count, round(coalesce(crash_score, 0), 6) as crash_score from edges left join scores using (u, v, key)",
    "node_profile": f"with {_N}, {_E}, {PROFILE} select * from profile",
    "safety_edges": f"""with {_N}, {_E}, {_CLASSIFIED}, {_C}, {_MET}, {_scores(2)}, {_R}, {_LMET}, {_CAND}, {PROFILE}, f as (
        select c.u, c.v, c.key, infra_type, display_route_type, coalesce(crash_count, 0) as crash_count, length_m, {_FACTORS}, coalesce(traffic_control_penalty, 0.0::double) as traffic_control_penalty,
          coalesce(crash_score, 0.0::double) as crash_score, case when length_m > 0 then coalesce(crash_score, 0.0::double) / length_m else 0.0::double end as per
        from classified c left join best using (u, v, key) left join scores using (u, v, key) left join profile p on p.osmid = c.v)
      select u, v, key, infra_type, display_route_type, crash_count, speed_factor, road_type_factor, infrastructure_factor, surface_factor, lighting_factor, traffic_control_penalty, round(crash_score, 6) as crash_score,
        round(per, 6) as crash_score_per_meter, round(per * length_m * 50.0::double, 6) as crash_penalty,
        round(greatest(length_m * speed_factor * road_type_factor * infrastructure_factor * surface_factor * lighting_factor + per * length_m * 50.0::double + traffic_control_penalty, 0.0::double), 6) as safety_cost from f""",
    "haversine_len": f"""with {_N}, {_E}, h as (select *, pow(sin(radians(y1 - y0) / 2), 2) + cos(radians(y0)) * cos(radians(y1)) * pow(sin(radians(x1 - x0) / 2), 2) as a from edges)
      select u, v, key, round(12742000.0::double * atan2(sqrt(a), sqrt(1 - a)), 6) as metres from h""",
    "azimuth_deg": f"with {_N}, {_E} select u, v, key, round({_AZ}, 6) as azimuth from edges",
    "local_metre_xy": f"with {_N} select osmid, round(x * 111320 * cos(radians(41.83::double)), 6) as mx, round(y * 111320, 6) as my from nodes",
    "near_node_pairs": f"""with {_N}, {_S}, b as (select osmid, x, y from nodes union all select osmid, x, y from supplement), m as (select osmid, x * 111320 * cos(radians(41.83::double)) as mx, y * 111320 as my from b)
      select p.osmid as a, q.osmid as b, round(sqrt(pow(p.mx - q.mx, 2) + pow(p.my - q.my, 2)), 6) as metres from m p join m q on p.osmid < q.osmid and abs(p.mx - q.mx) <= 13 and abs(p.my - q.my) <= 13
      where round(sqrt(pow(p.mx - q.mx, 2) + pow(p.my - q.my, 2)), 6) <= 12""",
    "nearest_nodes": f"""with {_N}, {_C}, d as (select crash_record_id, osmid, round(sqrt(pow(px - x, 2) + pow(py - y, 2)), 9) as distance from crashes join nodes on true)
      select crash_record_id, osmid, distance from (select *, row_number() over (partition by crash_record_id order by distance, osmid) as rn from d) where rn = 1""",
    "unmatched_edges": f"with {_N}, {_E}, {_C}, {_MET} select u, v, key, highway from edges e where not exists (select 1 from met m where m.u = e.u and m.v = e.v and m.key = e.key)",
}
