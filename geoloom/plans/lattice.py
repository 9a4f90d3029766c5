"""A street network laid over the given tables, in Spark and in reference SQL.

All arithmetic is integer modulo followed by one division or product, so both give the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

X0, Y0, STEP = -87.97, 41.62, 0.002
MEAN_LATITUDE = 41.83
EPS, DUPE = 0.0004, 0.00015
AS_OF = "2025-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "part").selectExpr("p_partkey as osmid", "p_partkey % 50 as col", "p_partkey div 50 as row")
    return n.selectExpr(
        "osmid", "col", "row", "-87.97D + col * 0.002D as x", "41.62D + row * 0.002D as y",
        "case osmid % 11 when 0 then 'traffic_signals' when 1 then 'stop' when 2 then 'crossing' when 3 then 'give_way' when 4 then 'mini_roundabout' end as highway",
        "case when osmid % 23 = 0 then '1' else '0' end as layer",
    )


NODES = """nodes as (
  select p_partkey as osmid, p_partkey % 50 as col, p_partkey // 50 as row,
    (-87.97)::double + (p_partkey % 50) * 0.002::double as x, 41.62::double + (p_partkey // 50) * 0.002::double as y,
    case p_partkey % 11 when 0 then 'traffic_signals' when 1 then 'stop' when 2 then 'crossing' when 3 then 'give_way' when 4 then 'mini_roundabout' end as highway,
    case when p_partkey % 23 = 0 then '1' else '0' end as layer
  from part)"""

_TAGS = """
  case least(u, v) % 9 when 0 then 'residential' when 1 then 'tertiary' when 2 then 'secondary' when 3 then 'primary' when 4 then 'cycleway'
    when 5 then 'path' when 6 then 'service' when 7 then 'footway' else '[''residential'', ''tertiary'']' end as highway,
  case when least(u, v) % 9 = 6 and u % 2 = 0 then 'alley' end as service,
  case u % 6 when 0 then '20 mph' when 1 then '25 mph' when 2 then '30 mph;50 mph' when 3 then '48' when 4 then 'none' end as maxspeed,
  case u % 7 when 0 then 'lane' when 1 then 'track' when 2 then 'shared_lane' end as cycleway_right,
  case u % 5 when 0 then 'lane' when 1 then 'share_busway' end as cycleway_left,
  case u % 13 when 0 then 'separate' when 1 then 'shared' end as cycleway_both,
  cast(null as string) as cycleway,
  case when u % 8 = 0 then 'yes' end as cycleway_buffer,
  case u % 10 when 0 then 'bollard' when 1 then 'no' end as cycleway_separation,
  case when u % 29 = 0 then 'pictogram' end as cycleway_shared_lane,
  case when v % 43 = 0 then 'yes' end as cycleway_left_buffer,
  case when v % 47 = 0 then '0.5' end as cycleway_right_buffer,
  case when v % 53 = 0 then 'yes' end as cycleway_both_buffer,
  case v % 41 when 0 then 'kerb' when 1 then 'none' end as cycleway_left_separation,
  case v % 59 when 0 then 'bollard' when 1 then 'no' end as cycleway_right_separation,
  case when v % 61 = 0 then 'planter' end as cycleway_both_separation,
  case when v % 67 = 0 then 'pictogram' end as cycleway_left_shared_lane,
  case when v % 71 = 0 then 'advisory' end as cycleway_right_shared_lane,
  case when v % 73 = 0 then 'yes' end as cycleway_both_shared_lane,
  case v % 4 when 0 then 'designated' when 1 then 'yes' when 2 then 'no' end as bicycle,
  case when v % 31 = 0 then 'yes' end as bicycle_road,
  case when v % 37 = 0 then 'yes' end as cyclestreet,
  case v % 5 when 0 then 'asphalt' when 1 then 'concrete' when 2 then 'gravel' when 3 then 'sett' end as surface,
  case u % 3 when 0 then 'yes' when 1 then 'no' end as lit,
  case when u % 31 = 0 then 'yes' end as bridge,
  case when u % 19 = 0 then null when across then concat('Street ', cast({row} as string)) else concat('Avenue ', cast(u % 50 as string)) end as name,
  case when u % 17 = 0 then 'yes' end as oneway"""

_LENGTH = "111320 * sqrt((y1 - y0) * (y1 - y0) + (x1 - x0) * cos(radians({lat})) * ((x1 - x0) * cos(radians({lat}))))"


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """u, v, key, x0, y0, x1, y1, line, length_m and tags.

    Nodes are dealt out before edges are made of them: a file of few row groups would give few tasks for all that follows.
    """
    n = nodes(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "osmid")
    top = F.broadcast(table(spark, sf_dir, "part").agg((F.max("p_partkey") + 1).alias("n")))  # one row
    steps = n.join(top).selectExpr(
        "osmid as u", "n",
        "explode(array(named_struct('v', if(col < 49, osmid + 1, null), 'across', true), named_struct('v', if(col > 0, osmid - 1, null), 'across', true), "
        "named_struct('v', osmid + 50, 'across', false), named_struct('v', osmid - 50, 'across', false))) as s",
    ).selectExpr("u", "s.v as v", "s.across as across", "n").where("v is not null and v >= 0 and v < n")
    w = F.least("u", "v")
    cut = ((w * 7) % 41 == 0) | (~F.col("across") & (F.expr("least(u, v) div 50") % 10 == 9)) | (F.col("across") & (w % 50 == 44) & (F.expr("least(u, v) div 50") < 10))
    kept = steps.where(~cut).withColumn("key", F.explode(F.expr("if(u % 97 = 0, array(0, 1), array(0))")))
    full = kept.selectExpr(
        "u", "v", "cast(key as bigint) as key", "across",
        "-87.97D + (u % 50) * 0.002D as x0", "41.62D + (u div 50) * 0.002D as y0", "-87.97D + (v % 50) * 0.002D as x1", "41.62D + (v div 50) * 0.002D as y1",
    )
    tags = [t.strip() for t in _split(_TAGS.format(row="(u div 50)"))]
    full = full.selectExpr("u", "v", "key", "x0", "y0", "x1", "y1", *tags)
    return full.selectExpr("*", f"{_LENGTH.format(lat='41.83D')} as length_m", "array(named_struct('x', x0, 'y', y0), named_struct('x', x1, 'y', y1)) as line")


def _split(text: str) -> list[str]:
    """Parts at commas outside brackets and quotes."""
    out, depth, quoted, part = [], 0, False, ""
    for c in text.replace("''", "\x00"):
        quoted ^= c == "'"
        depth += (c == "(") - (c == ")") if not quoted else 0
        if c == "," and not depth and not quoted:
            out.append(part)
            part = ""
        else:
            part += c
    return [p.replace("\x00", "\\'").replace("concat(\\'", "concat('") for p in [*out, part]]


EDGES = f"""steps as (
  select osmid as u, unnest([osmid + 1, osmid - 1, osmid + 50, osmid - 50]) as v, unnest([true, true, false, false]) as across, col, unnest([1, 2, 3, 4]) as d from nodes
), kept as (
  select u, v, across, unnest(case when u % 97 = 0 then [0, 1] else [0] end)::bigint as key from steps
  where v >= 0 and v < (select max(p_partkey) + 1 from part) and not (d = 1 and col = 49) and not (d = 2 and col = 0)
    and not ((least(u, v) * 7) % 41 = 0) and not (not across and (least(u, v) // 50) % 10 = 9) and not (across and least(u, v) % 50 = 44 and least(u, v) // 50 < 10)
), placed as (
  select *, (-87.97)::double + (u % 50) * 0.002::double as x0, 41.62::double + (u // 50) * 0.002::double as y0,
    (-87.97)::double + (v % 50) * 0.002::double as x1, 41.62::double + (v // 50) * 0.002::double as y1 from kept
), edges as (
  select u, v, key, x0, y0, x1, y1, {_LENGTH.format(lat='41.83::double')} as length_m, {_TAGS.format(row='(u // 50)')} from placed
)"""


def crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").selectExpr(
        "event_id as crash_record_id", "-87.97D + (event_id * 7919 % 9800) / 100000.0D as px", "41.62D + (event_id * 104729 % 8000) / 100000.0D as py", "ts as crash_date",
        "if(event_id % 200 = 0, 1, 0) as injuries_fatal", "if(event_id % 50 = 0, 1, 0) as injuries_incapacitating",
        "if(event_id % 10 = 0, 1, 0) as injuries_non_incapacitating", "if(event_id % 4 = 0, 1, 0) as injuries_not_evident",
    )
    return e


SEVERITY = "case when event_id % 200 = 0 then 5 when event_id % 50 = 0 then 4 when event_id % 10 = 0 then 3 when event_id % 4 = 0 then 2 else 1 end"
CRASHES = f"""crashes as (
  select event_id as crash_record_id, (-87.97)::double + (event_id * 7919 % 9800) / 100000.0::double as px, 41.62::double + (event_id * 104729 % 8000) / 100000.0::double as py,
    ts as crash_date, {SEVERITY} as severity from events)"""


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official routes: five steps along a row."""
    s = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as route_segment_id", "s_suppkey % 40 as row", "-87.97D + (s_suppkey % 30) * 0.002D as rx0", "41.62D + (s_suppkey % 40) * 0.002D + (s_suppkey % 3) * 0.0001D as ry",
        "-87.97D + (s_suppkey % 30 + 5) * 0.002D as rx1",
        "case s_suppkey % 6 when 0 then 'Protected Bike Lane' when 1 then 'Neighborhood Greenway' when 2 then 'Buffered Bike Lane' when 3 then 'Bike Lane' when 4 then 'Marked Shared Lane' else 'Other' end as display_route_type",
        "case when s_suppkey % 4 = 0 then '2W' else '1W' end as bike_route_oneway", "case s_suppkey % 5 when 0 then 'E' when 1 then 'W' when 2 then 'N' when 3 then '-' end as bike_route_oneway_dir",
        "concat('STREET ', cast(s_suppkey % 40 as string)) as street_name",
    )
    return s.withColumn("route", F.expr("array(named_struct('x', rx0, 'y', ry), named_struct('x', rx1, 'y', ry))"))


ROUTES = """routes as (
  select s_suppkey as route_segment_id, (-87.97)::double + (s_suppkey % 30) * 0.002::double as rx0, 41.62::double + (s_suppkey % 40) * 0.002::double + (s_suppkey % 3) * 0.0001::double as ry,
    (-87.97)::double + (s_suppkey % 30 + 5) * 0.002::double as rx1,
    case s_suppkey % 6 when 0 then 'Protected Bike Lane' when 1 then 'Neighborhood Greenway' when 2 then 'Buffered Bike Lane' when 3 then 'Bike Lane' when 4 then 'Marked Shared Lane' else 'Other' end as display_route_type,
    case when s_suppkey % 4 = 0 then '2W' else '1W' end as bike_route_oneway, case s_suppkey % 5 when 0 then 'E' when 1 then 'W' when 2 then 'N' when 3 then '-' end as bike_route_oneway_dir,
    concat('STREET ', cast(s_suppkey % 40 as varchar)) as street_name from supplier)"""


def supplement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra nodes near lattice nodes."""
    top = F.broadcast(table(spark, sf_dir, "part").agg((F.max("p_partkey") + 1).alias("n")))  # one row
    s = table(spark, sf_dir, "supplier").join(top).selectExpr("1000000 + s_suppkey as osmid", "s_suppkey % n as base", "(s_suppkey % 4) * 0.00006D as shift", "s_suppkey")
    return s.selectExpr("osmid", "base", "-87.97D + (base % 50) * 0.002D + shift as x", "41.62D + (base div 50) * 0.002D as y", "cast(null as string) as highway", "case when base % 23 = 0 and s_suppkey % 7 <> 0 then '1' else '0' end as layer")


SUPPLEMENT = """supplement as (
  select 1000000 + s_suppkey as osmid, s_suppkey % n as base, (-87.97)::double + ((s_suppkey % n) % 50) * 0.002::double + (s_suppkey % 4) * 0.00006::double as x,
    41.62::double + ((s_suppkey % n) // 50) * 0.002::double as y, case when (s_suppkey % n) % 23 = 0 and s_suppkey % 7 <> 0 then '1' else '0' end as layer
  from supplier, (select max(p_partkey) + 1 as n from part))"""


# -- geometry in reference SQL ---------------------------------------------------------------------------------------


def sql_point_segment(px: str, py: str, x0: str, y0: str, x1: str, y1: str) -> str:
    t = f"(case when (({x1}-{x0})*({x1}-{x0})+({y1}-{y0})*({y1}-{y0})) > 0 then greatest(0.0::double, least(1.0::double, (({px}-{x0})*({x1}-{x0})+({py}-{y0})*({y1}-{y0}))/(({x1}-{x0})*({x1}-{x0})+({y1}-{y0})*({y1}-{y0})))) else 0.0::double end)"
    ex, ey = f"({px}-({x0}+{t}*({x1}-{x0})))", f"({py}-({y0}+{t}*({y1}-{y0})))"
    return f"sqrt({ex}*{ex}+{ey}*{ey})"


def sql_segments(a: tuple[str, ...], b: tuple[str, ...]) -> str:
    def side(s, px, py):
        return f"(({s[2]}-{s[0]})*({py}-{s[1]})-({s[3]}-{s[1]})*({px}-{s[0]}))"

    near = ", ".join([sql_point_segment(a[0], a[1], *b), sql_point_segment(a[2], a[3], *b), sql_point_segment(b[0], b[1], *a), sql_point_segment(b[2], b[3], *a)])
    return f"(case when {side(a, b[0], b[1])}*{side(a, b[2], b[3])} < 0 and {side(b, a[0], a[1])}*{side(b, a[2], a[3])} < 0 then 0.0::double else least({near}) end)"


def sql_azimuth(x0: str, y0: str, x1: str, y1: str) -> str:
    return f"(case when degrees(atan2({x1}-{x0}, {y1}-{y0})) < 0 then degrees(atan2({x1}-{x0}, {y1}-{y0})) + 360 else degrees(atan2({x1}-{x0}, {y1}-{y0})) end)"
