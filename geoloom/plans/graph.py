"""Registered queries: graph operators, element sources, exports, the request-log stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.labels import ABBREVIATIONS, FILLERS, compress_labels, variable_filter
from geoloom.operators import graph as G
from geoloom.operators import routing
from geoloom.functions.rules import severity
from geoloom.plans import lattice as L
from geoloom.plans.lattice import table
from geoloom.session import shared_dir, stage
from geoloom.sources import elements as S
from geoloom.sources import export as X
from geoloom.streaming import logs

_N, _E, _C, _S = L.NODES, L.EDGES, L.CRASHES, L.SUPPLEMENT


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.edges(spark, sf_dir)


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.weak_components(_edges(spark, sf_dir))


def component_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.drop_small_components(_edges(spark, sf_dir), 75).select("u", "v", "key")


def last_edge_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.last_edge_wins(_edges(spark, sf_dir)).select("u", "v", "key", "highway")


def edge_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = G.with_endpoints(_edges(spark, sf_dir).select("u", "v", "key"), L.nodes(spark, sf_dir))
    return out.select("u", "v", "key", *[F.round(c, 6).alias(c) for c in ("u_x", "u_y", "v_x", "v_y")])


def graph_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = L.nodes(spark, sf_dir).select("osmid", "highway", "layer")
    extra = base.where("osmid % 5 = 0").select("osmid", F.lit("extra").alias("highway"), "layer").unionByName(L.supplement(spark, sf_dir).select("osmid", "highway", "layer"))
    return G.graph_union(base.where("osmid % 10 <> 0"), extra, ["osmid"])


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes and edges of the lattice with the supplement, whose nodes lead to the node above their base."""
    extra = L.supplement(spark, sf_dir)
    nodes = L.nodes(spark, sf_dir).select("osmid", "x", "y", "layer").unionByName(extra.select("osmid", "x", "y", "layer"))
    base = _edges(spark, sf_dir).selectExpr("u", "v", "key", "if(u % 23 = 0, '1', '0') as layer", "bridge", "cast(null as string) as tunnel")
    more = extra.selectExpr("osmid as u", "base + 50 as v", "0L as key", "layer", "cast(null as string) as bridge", "if(osmid % 9 = 0, 'covered', null) as tunnel")
    return nodes, base.unionByName(more), extra


def merge_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges, extra = _both(spark, sf_dir)
    return G.near_merge_map(nodes, edges, 15.0, L.MEAN_LATITUDE, extra.select("osmid"))


def contracted_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges, extra = _both(spark, sf_dir)
    return G.contract(edges, G.near_merge_map(nodes, edges, 15.0, L.MEAN_LATITUDE, extra.select("osmid"))).select("u", "v", "key")


def turn_penalties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.turn_penalties(G.last_edge_wins(_edges(spark, sf_dir)), L.nodes(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two requests an event: to a node up to two steps away each way, and to one anywhere in the network."""
    n = F.broadcast(table(spark, sf_dir, "part").agg((F.max("p_partkey") + 1).alias("n")))  # one row
    e = table(spark, sf_dir, "events").join(n).selectExpr("event_id", "event_id % n as origin", "n")
    near = e.selectExpr("2 * event_id as pair", "origin", "(origin + event_id % 3 + 50 * (event_id div 3 % 3)) % n as destination")
    return near.union(e.selectExpr("2 * event_id + 1", "origin", "event_id * 31 % n"))


def _routing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    edges = G.last_edge_wins(_edges(spark, sf_dir)).withColumn("cost", F.round("length_m", 3))
    edges = stage(edges.select("u", "v", "length_m", "name", "line", "highway", "cost"))
    return edges, G.turn_penalties(edges, L.nodes(spark, sf_dir))


def _routes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Routes of all requests, and the edges they run over."""
    edges, penalties = _routing(spark, sf_dir)
    return routing.route_batch(_requests(spark, sf_dir), edges, penalties, L.nodes(spark, sf_dir)), edges


def route_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routes(spark, sf_dir)[0].withColumn("path", F.array_join("path", ">"))


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.route_shape(*_routes(spark, sf_dir), L.nodes(spark, sf_dir))


def route_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and street names; of the line the number of points, and the sums of x and y at six digits."""
    total = lambda k: F.aggregate("line", F.lit(0).cast("long"), lambda a, p: a + F.round(p[k] * 1000000).cast("long"))
    return _shapes(spark, sf_dir).select("pair", "cost", "length_m", F.array_join("streets", "|").alias("streets"), F.size("line").alias("points"), total("x").alias("sum_x"), total("y").alias("sum_y"))


def route_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _requests(spark, sf_dir)
    cases = pairs.select("pair", F.when(F.col("pair") % 2 == 0, F.array(F.lit("street"))).otherwise(F.array().cast("array<string>")).alias("must_use"), F.when(F.col("pair") % 3 == 0, F.array(F.lit("avenue 7"))).otherwise(F.array().cast("array<string>")).alias("must_avoid"), F.lit(900.0).alias("max_cost"))
    checked = G.route_checks(_shapes(spark, sf_dir).select("pair", "cost", "streets"), cases)
    return checked.withColumn("failures", F.array_join("failures", "|"))


# -- sources and exports ---------------------------------------------------------------------------------------------


def _variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('B', lpad(cast(p_partkey div 4 as string), 5, '0'), '_', lpad(cast(p_partkey % 90 as string), 3, '0'), element_at(array('E', 'M', 'EA', 'MA', 'PE', 'PM'), cast(p_partkey % 6 + 1 as int))) as variable",
        "concat('Estimate!!Total:!!', p_name, '!!', p_type, ' of the ', p_type, ' Household by Number') as label", "concat(p_brand, ' for the Population in ', p_brand, ' Households') as concept", "if(p_partkey % 41 = 0, null, 'int') as predicate_type",
    )


def variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variable_filter(_variables(spark, sf_dir))


def label_compress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_labels(variable_filter(_variables(spark, sf_dir)))


def header_array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of up to three rows under a header; every 11th is empty but for the header."""
    p = table(spark, sf_dir, "part")
    rows = F.transform(F.sequence(F.lit(0), F.col("p_partkey") % 3), lambda i: F.array(F.col("p_brand"), (F.col("p_size") + i).cast("string")))
    body = F.when(F.col("p_partkey") % 11 == 0, F.array(F.array(F.lit("NAME"), F.lit("B1")))).otherwise(F.concat(F.array(F.array(F.lit("NAME"), F.lit("B1"))), rows))
    return S.rows_from_header_array(p.select("p_partkey", body.alias("body")), "body", ["NAME", "B1"], "p_partkey").select("p_partkey", F.col("pos").cast("long").alias("pos"), F.col("NAME").alias("name"), F.col("B1").try_cast("int").alias("b1"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [F.col(f"injuries_{k}") for k in ("fatal", "incapacitating", "non_incapacitating", "not_evident")]
    c = L.crashes(spark, sf_dir).withColumn("severity", severity(*kinds))
    c = c.withColumns({"py": F.when(F.col("crash_record_id") % 100 == 7, F.lit(float("nan"))).otherwise(F.round("py", 6)), "px": F.round("px", 6), "weight": F.when(F.col("crash_record_id") % 50 == 3, F.lit(float("inf"))).otherwise(F.col("severity") * 0.5)})
    return X.geojson_features(c, "py", "px", ["crash_record_id", "severity", "weight", "crash_date"])


def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


def feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported features read back: locked columns, coordinates, validity."""
    f = S.parse_features(_features(spark, sf_dir), "feature", {"crash_record_id": "bigint", "severity": "int", "weight": "double"})
    at = F.from_json("coordinates", "array<double>")
    return f.select("crash_record_id", "severity", "weight", "gtype", "is_valid", at[0].alias("px"), at[1].alias("py"))


def feature_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    gtype = F.when(k % 5 == 0, "Point").when(k % 5 == 1, "LineString").when(k % 5 == 2, "MultiPoint")
    promoted, coordinates = S.promote(gtype, F.when(k % 5 == 1, "[[0,0],[1,1]]").when(k % 5 == 2, "[[0,0]]").otherwise("[0,0]"))
    return p.select("p_partkey", promoted.alias("gtype"), F.when(gtype.isNotNull(), coordinates).alias("coordinates"))


def osm_node_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = L.nodes(spark, sf_dir)
    tags = F.map_filter(F.create_map(F.lit("layer"), F.col("layer"), F.lit("highway"), F.col("highway")), lambda k, v: v.isNotNull())
    raw = n.select(F.col("osmid").alias("id"), tags.alias("tags"), F.when(F.col("osmid") % 7 == 0, F.lit("1970-01-01").cast("timestamp")).otherwise(F.lit("2024-05-01").cast("timestamp")).alias("timestamp"), F.lit(1).alias("version"), F.col("osmid").alias("changeset"), F.round("x", 6).alias("lon"), F.round("y", 6).alias("lat"))
    return S.osm_nodes(raw)


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways around a lattice cell; some refs lead nowhere."""
    n = L.nodes(spark, sf_dir).select(F.col("osmid").alias("id"), F.col("x").alias("lon"), F.col("y").alias("lat"))
    k = F.col("osmid")
    refs = F.when(k % 3 == 0, F.array(k, k + 1, k + 51, k + 50, k)).when(k % 3 == 1, F.array(k, k + 1, F.lit(-1).cast("long"))).otherwise(F.array(k, F.lit(-2).cast("long")))
    w = S.assemble_ways(L.nodes(spark, sf_dir).select(k.alias("id"), refs.alias("refs")), n)
    return w.select("id", F.col("vertices").cast("long").alias("vertices"), "gtype", F.round(F.element_at("line", 1)["x"], 6).alias("x0"), F.round(F.element_at("line", -1)["y"], 6).alias("y1"))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    member = F.struct("l_linenumber", F.when(F.col("l_returnflag") == "N", "node").otherwise("way").alias("type"), F.col("l_partkey").alias("ref"), F.when(F.col("l_returnflag") == "A", "outer").alias("role"))
    r = l.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    return S.osm_relations(r).select("osm_id", F.col("n_members").cast("long").alias("n_members"), F.get_json_object("members", "$[0].type").alias("first_type"), F.get_json_object("members", "$[0].role").alias("first_role"))


def bike_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    pair = F.when(i % 4 == 0, F.array(F.lit(1.5))).when(i % 4 != 1, F.array(i / 100.0, i / 50.0))
    return S.flatten_bikes(e.select(i.alias("id"), F.col("event_type").alias("title"), F.array(F.col("event_type"), F.lit("red")).alias("frame_colors"), pair.alias("stolen_coordinates"), F.unix_timestamp("ts").alias("date_stolen")))


def csv_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as delimited text with blanks, quotes and line ends, and read back."""
    path = f"{shared_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), F.concat(F.col("c_name"), F.lit(', "x"\n '), F.col("c_mktsegment")).alias("note"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("segment"))
    c.write.csv(path, header=True, quoteAll=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return S.read_csv(spark, path).select("c_custkey", F.md5("note").alias("note_md5"), "segment")


def _row_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line along each lattice row, with small bends."""
    n = L.nodes(spark, sf_dir).select("row", "col", "x", (F.col("y") + (F.col("osmid") % 7) * 0.00002).alias("y"))
    line = n.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("col", "x", "y"))).alias("p"))
    return line.select(F.col("row").cast("string").alias("row"), F.transform("p", lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"))).alias("line"))


def wkb_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = S.encode_wkb(L.edges(spark, sf_dir).select(F.concat_ws("-", *[F.col(k).cast("string") for k in ("u", "v", "key")]).alias("id"), "line"), "line", "id", 4326)
    p = F.col("parts")[0]
    return S.decode_wkb(coded, "hex", "id").select("id", "gtype", "srid", F.round(p[0]["x"], 6).alias("x0"), F.round(p[0]["y"], 6).alias("y0"), F.round(p[1]["x"], 6).alias("x1"), F.round(p[1]["y"], 6).alias("y1"))


def wkb_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged hexadecimal geometries are told apart and fail alone."""
    e = L.edges(spark, sf_dir).select(F.concat_ws("-", *[F.col(k).cast("string") for k in ("u", "v", "key")]).alias("id"), "line")
    way = F.pmod(F.element_at(F.split("id", "-"), 1).cast("long"), F.lit(5))
    coded = S.encode_wkb(e, "line", "id", 4326).withColumn("hex", F.when(way == 1, F.substring("hex", 1, 40)).when(way == 2, F.concat(F.lit("zz"), "hex")).when(way == 3, F.lit("0163000000")).otherwise(F.col("hex")))
    return S.decode_wkb(coded, "hex", "id").select("id", "gtype", "failure")


def simplify_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.simplify_lines(_row_lines(spark, sf_dir), "row", "line").select("row", F.size("line").alias("vertices"), F.round(F.element_at("line", 1)["x"], 6).alias("x0"), F.round(F.element_at("line", -1)["x"], 6).alias("x1"))


def export_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, _ = X.routing_tables(_edges(spark, sf_dir), L.nodes(spark, sf_dir))
    return edges.select("u", "v", *[F.round(c, 6).alias(c) for c in ("u_x", "u_y", "v_x", "v_y", "length_m")], "highway")


def export_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes that exported edges use."""
    _, nodes = X.routing_tables(_edges(spark, sf_dir), L.nodes(spark, sf_dir))
    return nodes.select("osmid", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "highway")


def route_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a request log with every tenth line twice: landed as JSON, streamed, deduplicated, read back."""
    base = f"{shared_dir(spark).rstrip('/')}/log-{uuid.uuid4().hex}"
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("server_timestamp"), F.col("event_id").cast("string").alias("request_id"), F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")).alias("source_ip"), F.lit("agent").alias("user_agent_header"), F.col("props").alias("client_payload"))
    e.unionAll(e.where("cast(request_id as bigint) % 10 = 0")).write.option("timestampFormat", logs.TIMES).json(f"{base}/in")
    logs.land(logs.route_log_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/state")
    out = spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out").drop("batch", "bucket")
    return logs.retained(out, 365, "2024-12-31").select("request_id", "server_timestamp", "source_ip", "client_payload")


def _sql_words(text: str) -> str:
    short = "map([" + ", ".join(f"'{k}'" for k in ABBREVIATIONS) + "], [" + ", ".join(f"'{v}'" for v in ABBREVIATIONS.values()) + "])"
    listed = ", ".join(f"'{w}'" for w in FILLERS)
    bare = f"[w for w in string_split_regex(regexp_replace(lower({text}), '[^a-z0-9\\s]', '', 'g'), '\\s+') if w <> '' and w not in ({listed})]"
    return f"[w for w in [coalesce({short}[w], w) for w in {bare}] if w <> '']"


def _sql_once(words: str) -> str:
    return f"[{words}[i] for i in range(1, len({words}) + 1) if i = 1 or {words}[i] <> {words}[i - 1]]"


def _sql_fit(words: str, room: str) -> str:
    return f"[array_to_string({words}[1:n], '_') for n in range(len({words}), -1, -1) if length(array_to_string({words}[1:n], '_')) <= greatest({room}, 0)][1]"


LABEL_SQL = f"""with v as (select p_partkey, concat('B', lpad(cast(p_partkey // 4 as varchar), 5, '0'), '_', lpad(cast(p_partkey % 90 as varchar), 3, '0'), ['E', 'M'][p_partkey % 6 + 1]) as variable,
    [s for s in [p_name, p_type || ' of the ' || p_type || ' Household by Number']] as segments, concat(p_brand, ' for the Population in ', p_brand, ' Households') as concept
    from part where p_partkey % 6 in (0, 1) and p_partkey % 41 <> 0
), w as (select distinct variable, flatten([{_sql_words('s')} for s in segments]) as label, {_sql_words('concept')} as concept, case p_partkey % 6 when 0 then '_est_' else '_moe_' end || variable as tail from v
), o as (select variable, tail, {_sql_once('label')} as l, {_sql_once('concept')} as c from w
), p as (select variable, tail, l, {_sql_fit('c', "61 - length(tail) - length(array_to_string(l, '_'))")} as concept from o
), q as (select variable, tail, concept, {_sql_fit('l', '61 - length(tail) - length(concept)')} as label from p)
select variable, array_to_string([x for x in [concept, label] if x <> ''], '__') || tail as column_name from q"""

QUERIES = (
    components, component_filter, last_edge_wins, edge_endpoints, graph_union, merge_map, contracted_edges, turn_penalties, route_batch, route_shape, route_checks, variables, label_compress, header_array_rows, geojson_features,
    feature_collection, feature_promotion, osm_node_rows, ways, relations, bike_flatten, csv_nulls, wkb_decode, wkb_failures, simplify_lines, export_edges, export_nodes, route_log_stream,
)

_COMP = """und as (select distinct u as a, v as b from edges union select distinct v, u from edges), reach as (
  select distinct a as node, a as c from und union select und.b, reach.c from reach join und on und.a = reach.node
), comp as (select node, min(c) as component from reach group by node), sized as (select node, component, count(*) over (partition by component) as size from comp)"""
_BOTH = f"""bothn as (select osmid, x, y, layer from nodes union all select osmid, x, y, layer from supplement
), bothe as (select u, v, key, case when u % 23 = 0 then '1' else '0' end as layer, bridge = 'yes' as g from edges
  union all select osmid, base + 50, 0, layer, osmid % 9 = 0 from supplement
), tagx as (select osmid, list(distinct layer) as ls, bool_or(coalesce(g, false)) as g from (select u as osmid, layer, g from bothe union all select v, layer, g from bothe) group by osmid
), tags as (select n.osmid, coalesce(ls, [layer]) as ls, coalesce(g, false) as g, x * 111320 * cos(radians(41.83::double)) as mx, y * 111320 as my from bothn n left join tagx using (osmid)
), near as (select p.osmid as keep, q.osmid as drop_id, round(sqrt(pow(p.mx - q.mx, 2) + pow(p.my - q.my, 2)), 6) as m from tags p join tags q on p.osmid < 1000000 and q.osmid >= 1000000
    and abs(p.mx - q.mx) <= 16 and abs(p.my - q.my) <= 16 and list_has_any(p.ls, q.ls) and p.g = q.g where round(sqrt(pow(p.mx - q.mx, 2) + pow(p.my - q.my, 2)), 6) <= 15
      and not exists (select 1 from bothe e where (e.u = p.osmid and e.v = q.osmid) or (e.u = q.osmid and e.v = p.osmid))
), merged as (select drop_id, keep from (select *, row_number() over (partition by drop_id order by m, keep) as rn from near) where rn = 1)"""
_ONE = "one as (select * from (select *, row_number() over (partition by u, v order by key desc) as rn from edges) where rn = 1)"
_TURNS = f"""deg as (select b, count(*) as d from (select u as b from one union all select v from one) group by b
      ), p as (select u, v, highway, atan2(x1 - x0, y1 - y0) as t from one
      ), m as (select f.u as a, f.v as b, s.v as c, d, s.highway, f.t as t1, s.t as t2, sin(f.t) * cos(s.t) - cos(f.t) * sin(s.t) as cr, case when abs(degrees(s.t - f.t)) <= 180 then abs(degrees(s.t - f.t)) else 360 - abs(degrees(s.t - f.t)) end as ang
        from p f join p s on s.u = f.v join deg on deg.b = f.v), turns as (select a, b, c, cast(case when d >= 3 and round(ang, 6) >= 45 and -cr < 0 and abs(cr) > 1e-9 then 30.0 * case case when highway like '[%' then 'residential' else highway end when 'primary' then 2.5 when 'secondary' then 2.0 when 'tertiary' then 1.5
        when 'residential' then 0.8 when 'service' then 0.5 when 'cycleway' then 0.0 when 'path' then 0.0 else 1.0 end else 0.0 end as double) as penalty from m)"""
#: Least weights of all (node, previous node) states from every origin; rows of a keyed recursion give way to better ones.
_ROUTES = f"""{_N}, {_E}, {_ONE}, {_TURNS}, asked as (
  select 2 * event_id as pair, event_id % n as origin, (event_id % n + event_id % 3 + 50 * (event_id // 3 % 3)) % n as destination from events, (select max(p_partkey) + 1 as n from part)
  union all select 2 * event_id + 1, event_id % n, event_id * 31 % n from events, (select max(p_partkey) + 1 as n from part)
), w1 as (select u, v, round(round(length_m, 3) * 1000)::bigint * 4294967296 + ('0x' || substr(md5(u || '-' || v), 1, 5))::bigint as w from one
), mv as (select a, b, c, w1.w + round(penalty * 1000)::bigint * 4294967296 as w from turns join w1 on w1.u = b and w1.v = c
), r(o, a, b, w, p) using key (o, a, b) as (
  select o, u, v, w, cast(null as bigint) from (select distinct origin as o from asked where origin <> destination) join w1 on w1.u = o
  union
  select o, a, b, min(w), arg_min(p, w) from (select r.o, mv.b as a, mv.c as b, r.w + mv.w as w, r.a as p from r join mv on mv.a = r.a and mv.b = r.b) z
  where not exists (select 1 from recurring.r k where k.o = z.o and k.a = z.a and k.b = z.b and k.w <= z.w) group by o, a, b
), ends as (
  select o, d, min(w) as w, arg_min(a, w) as a from r join (select distinct origin as o, destination as d from asked where origin <> destination) using (o) where b = d group by o, d
), walk(o, d, a, b, w, path) as (
  select o, d, a, d, w, [a, d] from ends
  union all
  select o, d, r.p, walk.a, walk.w, list_prepend(r.p, path) from walk join r using (o, a, b) where r.p is not null
), whole as (
  select walk.o, walk.d, walk.w >> 32 as w, walk.path from walk join r using (o, a, b) where r.p is null
), routes as (
  select pair, origin, destination, case when origin = destination then 0 else w end as w, case when origin = destination then [origin] else path end as path from asked left join whole on o = origin and d = destination)"""
_SHAPES = """legs as (select pair, w, path[i] as u, path[i + 1] as v from (select pair, w, path, unnest(range(1, len(path))) as i from routes where len(path) > 1)
), spots as (select pair, sum(round(x * 1000000)::bigint)::bigint as sum_x, sum(round(y * 1000000)::bigint)::bigint as sum_y, count(*)::integer as points from (select pair, unnest(path) as osmid from routes where path is not null) join nodes using (osmid) group by pair
), shapes as (select pair, any_value(w) / 1000.0::double as cost, round(sum(length_m), 1) as length_m, coalesce(array_to_string(list_sort(list_distinct(list(name) filter (where name is not null))), '|'), '') as streets, any_value(points) as points, any_value(sum_x) as sum_x, any_value(sum_y) as sum_y
  from legs join (select u, v, length_m, name from (select *, row_number() over (partition by u, v order by key desc) as rn from edges) where rn = 1) using (u, v) join spots using (pair) group by pair
  union all select pair, 0.0::double, 0.0::double, '', points, sum_x, sum_y from routes join spots using (pair) where len(path) = 1)"""

SQL = {
    "components": f"with recursive {_N}, {_E}, {_COMP} select node, component, size from sized",
    "component_filter": f"with recursive {_N}, {_E}, {_COMP} select u, v, key from edges where u in (select node from sized where size >= 75)",
    "last_edge_wins": f"with {_N}, {_E}, {_ONE} select u, v, key, highway from one",
    "edge_endpoints": f"with {_N}, {_E} select u, v, key, round(a.x, 6) as u_x, round(a.y, 6) as u_y, round(b.x, 6) as v_x, round(b.y, 6) as v_y from edges join nodes a on a.osmid = u join nodes b on b.osmid = v",
    "graph_union": f"""with {_N}, {_S}, both_sides as (select 0 as side, osmid, highway, layer from nodes where osmid % 10 <> 0
        union all select 1, osmid, 'extra', layer from nodes where osmid % 5 = 0
        union all select 1, osmid, null, layer from supplement)
      select osmid, highway, layer from (select *, row_number() over (partition by osmid order by side, highway nulls first, layer nulls first) as rn from both_sides) where rn = 1""",
    "merge_map": f"with {_N}, {_E}, {_S}, {_BOTH} select drop_id as drop, keep from merged",
    "contracted_edges": f"""with {_N}, {_E}, {_S}, {_BOTH}, c as (select coalesce(a.keep, u) as u, coalesce(b.keep, v) as v, key, a.keep is null and b.keep is null as plain from bothe left join merged a on a.drop_id = u left join merged b on b.drop_id = v)
      select u, v, key from c where u <> v or plain""",
    "turn_penalties": f"with {_N}, {_E}, {_ONE}, {_TURNS} select a, b, c, penalty from turns",
    "route_batch": f"with recursive {_ROUTES} select pair, origin, destination, w / 1000.0::double as cost, array_to_string(path, '>') as path from routes",
    "route_shape": f"with recursive {_ROUTES}, {_SHAPES} select pair, cost, length_m, streets, points, sum_x, sum_y from shapes",
    "route_checks": f"""with recursive {_ROUTES}, {_SHAPES}, checked as (
        select pair, list_concat(case when pair % 2 = 0 and not coalesce(lower(streets) like '%street%', false) then ['not used: street'] else [] end, case when pair % 3 = 0 and lower(streets) like '%avenue 7%' then ['used: avenue 7'] else [] end,
          case when cost is null then ['no route'] when cost > 900 then ['too dear'] else [] end) as failed from asked left join shapes using (pair))
      select pair, array_to_string(failed, '|') as failures, len(failed) = 0 as passed from checked""",
    "variables": """with v as (select concat('B', lpad(cast(p_partkey // 4 as varchar), 5, '0'), '_', lpad(cast(p_partkey % 90 as varchar), 3, '0'), ['E', 'M', 'EA', 'MA', 'PE', 'PM'][p_partkey % 6 + 1]) as variable,
        concat('Estimate!!Total:!!', p_name, '!!', p_type, ' of the ', p_type, ' Household by Number') as label, concat(p_brand, ' for the Population in ', p_brand, ' Households') as concept, p_partkey % 41 = 0 as untyped, p_partkey % 6 as k from part)
      select distinct variable, label, concept from v where k in (0, 1) and not untyped""",
    "label_compress": LABEL_SQL,
    "header_array_rows": "select p_partkey, cast(i as bigint) as pos, p_brand as name, cast(p_size + i as integer) as b1 from (select *, unnest(range(0, p_partkey % 3 + 1)) as i from part where p_partkey % 11 <> 0)",
    "geojson_features": f"""with {_C} select concat('{{"type":"Feature","geometry":{{"type":"Point","coordinates":[', round(px, 6), ',', round(py, 6), ']}},"properties":{{"crash_record_id":', crash_record_id, ',"severity":', severity,
      ',"weight":', case when crash_record_id % 50 = 3 then 'null' else cast(severity * 0.5::double as varchar) end, ',"crash_date":"', crash_date, '"}}}}') as feature from crashes where crash_record_id % 100 <> 7""",
    "simplify_lines": f"""with recursive {_N}, p as (select row, col as i, x, y + (osmid % 7) * 0.00002::double as y from nodes), seg(row, a, b) as (
        select row, min(i), max(i) from p group by row
        union all
        select row, unnest([a, m]), unnest([m, b]) from (
          select row, a, b, i as m, far, row_number() over (partition by row, a, b order by far desc, i) as k from (
            select s.row, s.a, s.b, p.i, sqrt(pow(p.x - q.x - t * (z.x - q.x), 2) + pow(p.y - q.y - t * (z.y - q.y), 2)) as far
            from seg s join p on p.row = s.row and p.i > s.a and p.i < s.b join p q on q.row = s.row and q.i = s.a join p z on z.row = s.row and z.i = s.b,
              lateral (select greatest(0.0::double, least(1.0::double, ((p.x - q.x) * (z.x - q.x) + (p.y - q.y) * (z.y - q.y)) / (pow(z.x - q.x, 2) + pow(z.y - q.y, 2)))) as t))) where k = 1 and far > 0.00005::double
      ), kept as (select distinct row, unnest([a, b]) as i from seg)
      select cast(row as varchar) as row, count(*)::integer as vertices, round(arg_min(x, i), 6) as x0, round(arg_max(x, i), 6) as x1 from kept join p using (row, i) group by row""",
    "feature_collection": f"""with {_C} select crash_record_id, severity, case when crash_record_id % 50 = 3 then null else severity * 0.5::double end as weight, 'Point' as gtype, true as is_valid, round(px, 6) as px, round(py, 6) as py from crashes where crash_record_id % 100 <> 7""",
    "feature_promotion": """select p_partkey, case p_partkey % 5 when 0 then 'MultiPoint' when 1 then 'MultiLineString' when 2 then 'MultiPoint' end as gtype, case p_partkey % 5 when 0 then '[[0,0]]' when 1 then '[[[0,0],[1,1]]]' when 2 then '[[0,0]]' end as coordinates from part""",
    "osm_node_rows": f"""with {_N} select osmid as osm_id, case when highway is null then concat('{{"layer":"', layer, '"}}') else concat('{{"highway":"', highway, '","layer":"', layer, '"}}') end as tags,
      case when osmid % 7 <> 0 then timestamp '2024-05-01' end as timestamp, 1 as version, osmid as changeset, round(x, 6) as lon, round(y, 6) as lat from nodes""",
    "ways": f"""with {_N}, r as (select osmid as id, case osmid % 3 when 0 then [osmid, osmid + 1, osmid + 51, osmid + 50, osmid] when 1 then [osmid, osmid + 1, -1] else [osmid, -2] end as refs from nodes
      ), p as (select id, unnest(refs) as ref, unnest(range(0, len(refs))) as pos from r), j as (select p.id, pos, ref, x, y from p join nodes on osmid = ref
      ), a as (select id, count(*) as vertices, arg_min(x, pos) as fx, arg_max(y, pos) as ly, arg_min(ref, pos) = arg_max(ref, pos) as closed from j group by id)
      select id, vertices, case when vertices < 2 then 'failure' when closed and vertices >= 4 then 'Polygon' else 'LineString' end as gtype, round(fx, 6) as x0, round(ly, 6) as y1 from a""",
    "relations": """select l_orderkey as osm_id, count(*) as n_members, arg_min(case when l_returnflag = 'N' then 'node' else 'way' end, k) as first_type, arg_min(case when l_returnflag = 'A' then 'outer' else '' end, k) as first_role
      from (select *, row_number() over (partition by l_orderkey order by l_linenumber, case when l_returnflag = 'N' then 'node' else 'way' end, l_partkey, case when l_returnflag = 'A' then 'outer' end nulls first) as k from lineitem) group by l_orderkey""",
    "bike_flatten": """select event_id as id, event_type as title, concat('["', event_type, '","red"]') as frame_colors, case when event_id % 4 in (2, 3) then event_id / 100.0::double end as latitude, case when event_id % 4 in (2, 3) then event_id / 50.0::double end as longitude,
      to_timestamp(floor(epoch(ts))) at time zone 'UTC' as stolen_at from events""",
    "csv_nulls": """select cast(c_custkey as varchar) as c_custkey, md5(concat(c_name, ', "x"', chr(10), ' ', c_mktsegment)) as note_md5, case when c_custkey % 3 <> 0 then concat(' ', c_mktsegment) end as segment from customer""",
    "wkb_failures": f"""with {L.NODES}, {L.EDGES} select concat(u, '-', v, '-', key) as id, case when u % 5 in (0, 4) then 'LineString' end as gtype,
      case u % 5 when 1 then 'cut short' when 2 then 'not hexadecimal' when 3 then 'unknown geometry' end as failure from edges""",
    "wkb_decode": f"with {_N}, {_E} select concat_ws('-', u, v, key) as id, 'LineString' as gtype, 4326 as srid, round(x0, 6) as x0, round(y0, 6) as y0, round(x1, 6) as x1, round(y1, 6) as y1 from edges",
    "export_edges": f"""with recursive {_N}, {_E}, {_ONE}, {_COMP} select u, v, round(x0, 6) as u_x, round(y0, 6) as u_y, round(x1, 6) as v_x, round(y1, 6) as v_y, round(length_m, 6) as length_m, highway from one where u in (select node from sized where size >= 75)""",
    "export_nodes": f"""with recursive {_N}, {_E}, {_ONE}, {_COMP} select osmid, round(x, 6) as x, round(y, 6) as y, highway from nodes
      where osmid in (select unnest([u, v]) from one where u in (select node from sized where size >= 75))""",
    "route_log_stream": """select cast(event_id as varchar) as request_id, ts as server_timestamp, concat('10.0.0.', user_id % 250) as source_ip, props as client_payload from events where ts >= timestamp '2024-01-01'""",
}
