"""Registered queries: merges, staging, addresses, increments, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import text as T
from geoloom.functions.rules import road_rank
from geoloom.operators import geocode as G
from geoloom.operators import incremental as I
from geoloom.operators import merge as M
from geoloom.operators import network
from geoloom.operators import quality as Q
from geoloom.plans import lattice as L
from geoloom.plans.lattice import table
from geoloom.plans.network import PROFILE

# -- staging ---------------------------------------------------------------------------------------------------------


def bike_crash_union_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crashes that any of three sources flags, with their flagged people."""
    people, crash, customer = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    ids = people.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    ids = ids.union(crash.where("o_orderstatus = 'P'").select("o_orderkey"))
    ids = ids.union(crash.join(customer.where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey")).distinct()
    local = F.from_utc_timestamp("o_orderdate", "America/Chicago")
    crash = crash.join(ids, F.col("o_orderkey") == F.col("id"), "left_semi").select(
        "o_orderkey", local.alias("local_at"), F.rpad(F.date_format(local, "EEEE"), 9, " ").alias("day_of_week"), F.date_format(local, "HH:mm:ss").alias("time_of_day")
    )
    riders = people.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_linestatus")
    return crash.join(riders, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.broadcast(table(spark, sf_dir, "part").agg((F.max("p_partkey") + 1).alias("n")))  # one row
    c = table(spark, sf_dir, "customer").join(n)
    return c.selectExpr(
        "c_custkey", "c_mktsegment", "concat(lpad(cast(c_custkey % 120 as string), 3, '0'), 'XX  w ', c_mktsegment, '  st') as block",
        "if(c_custkey % 13 = 0, null, 41.62D + ((c_custkey % n) div 50) * 0.002D) as latitude", "if(c_custkey % 13 = 0, null, -87.97D + ((c_custkey % n) % 50) * 0.002D) as longitude", "c_custkey % 3 as quality",
    )


BLOCKS = """blocks as (
  select c_custkey, c_mktsegment, concat(lpad(cast(c_custkey % 120 as varchar), 3, '0'), 'XX  w ', c_mktsegment, '  st') as block,
    case when c_custkey % 13 = 0 then null else 41.62::double + ((c_custkey % n) // 50) * 0.002::double end as latitude,
    case when c_custkey % 13 = 0 then null else (-87.97)::double + ((c_custkey % n) % 50) * 0.002::double end as longitude, c_custkey % 3 as quality
  from customer, (select max(p_partkey) + 1 as n from part))"""
_CLEAN = "trim(upper(regexp_replace(regexp_replace(concat(regexp_replace(block, 'XX', '00', 'g'), ', CHICAGO, IL'), '\\s+', ' ', 'g'), '\\s+,', ',', 'g')))"


def crime_address_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _blocks(spark, sf_dir)
    number = lambda c: F.round(F.col(c).cast("decimal(18,6)"), 3).cast("double")
    return b.select("c_custkey", T.clean_address(T.fill_block(F.col("block"))).alias("address"), number("latitude").alias("latitude"), number("longitude").alias("longitude"))


def _cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _blocks(spark, sf_dir).withColumn("address", T.clean_address(T.fill_block(F.col("block"))))
    picked = G.coordinate_pick(b, "address", 41.63, -87.9)
    full = b.select("address", "quality").join(picked, "address")
    full = full.withColumn("address_hash", T.address_hash(F.col("address"), F.lit(None).cast("string"), F.lit(""), F.lit(" "), F.lit(None).cast("string")))
    return G.best_per_hash(full)


_PICKED = f"""clean as (select *, {_CLEAN} as address from blocks), picked as (
  select address, case when avg(latitude) < 41.63 then min(latitude) else max(latitude) end as latitude, case when avg(longitude) < -87.9 then min(longitude) else max(longitude) end as longitude from clean group by address
), cache as (select md5(address) as address_hash, address, min(quality) as quality, any_value(p.latitude) as latitude, any_value(p.longitude) as longitude from clean join picked p using (address) group by address)"""


def theft_coord_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thefts by code with coordinates filled from the cache."""
    b = _blocks(spark, sf_dir).where("c_custkey % 4 = 1").withColumn("address", T.clean_address(T.fill_block(F.col("block"))))
    cache = _cache(spark, sf_dir).select("address", F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"))
    return b.join(cache, "address", "left").select("c_custkey", F.round(F.coalesce("latitude", "lat2"), 6).alias("latitude"), F.round(F.coalesce("longitude", "lon2"), 6).alias("longitude"))


def theft_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("event_id").cast("string").alias("source_id"), F.col("ts").alias("stolen_at"), "value", F.lit("events").alias("data_source"))
    b = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("source_id"), F.col("o_orderdate").alias("stolen_at"), F.lit("orders").alias("data_source"))
    both = a.unionByName(b, allowMissingColumns=True)
    return both.select("source_id", "stolen_at", "value", "data_source", F.year("stolen_at").alias("theft_year"), F.hour(F.from_utc_timestamp("stolen_at", "America/Chicago")).alias("theft_hour"))


def parking_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Racks of two sources; one has its tags as JSON."""
    tags = F.to_json(F.create_map(F.lit("capacity"), F.when(F.col("p_partkey") % 7 == 0, "many").otherwise((F.col("p_partkey") % 20).cast("string")), F.lit("covered"), F.when(F.col("p_partkey") % 3 == 0, "yes").otherwise("no")))
    a = table(spark, sf_dir, "part").where("p_partkey % 5 = 0").withColumn("tags", tags)
    a = a.select(F.col("p_partkey").alias("rack_id"), F.get_json_object("tags", "$.capacity").try_cast("int").alias("capacity"), F.get_json_object("tags", "$.covered").alias("covered"), F.lit("osm").alias("data_source"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rack_id"), F.col("s_name").alias("location"), F.lit("city").alias("data_source"))
    return a.unionByName(b, allowMissingColumns=True)


def address_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cache(spark, sf_dir).select("address_hash", "address", "quality", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"))


def address_cache_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key the cache lacks; null keys never go in."""
    known = _cache(spark, sf_dir).where("quality = 0").select("address_hash")
    return _cache(spark, sf_dir).where("address_hash is not null").join(known, "address_hash", "left_anti").select("address_hash", "quality")


def staging_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.staging_select(table(spark, sf_dir, "nation"), {"n_nationkey": "geoid", "n_name": "name"}, ["n_regionkey"])


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_totalprice").try_cast("decimal(19,4)").cast("double").alias("price"), F.to_date("o_orderdate").cast("string").alias("day"), F.col("o_orderpriority").substr(1, 1).try_cast("int").alias("priority"))


def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two vintages with different columns as one table."""
    o = table(spark, sf_dir, "orders")
    a = o.where("year(o_orderdate) % 2 = 0").select(F.col("o_orderkey").cast("string").alias("geoid"), F.lit("even").alias("vintage"), F.col("o_totalprice").cast("string").alias("b1"))
    b = o.where("year(o_orderdate) % 2 = 1").select(F.col("o_orderkey").cast("string").alias("geoid"), F.lit("odd").alias("vintage"), F.col("o_orderstatus").alias("b2"))
    return M.conform([a, b], {"geoid": "string", "vintage": "string", "b1": "double", "b2": "string"}, "2024-01-01")


def location_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """{latitude, longitude} objects, GeoJSON points or neither, as text, to coordinates; and road ranks."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    i = F.col("event_id")
    shape = F.when(i % 3 == 0, F.format_string('{"latitude": "%d", "longitude": "%d"}', i % 90, i % 180)).when(i % 3 == 1, F.format_string('{"type": "Point", "coordinates": [%d.5, %d.25]}', i % 180, i % 90)).otherwise("{}")
    at = F.from_json(shape, "latitude string, longitude string, type string, coordinates array<double>")
    lat = F.coalesce(at["latitude"].try_cast("double"), F.when(F.size(at["coordinates"]) == 2, at["coordinates"][1]))
    lon = F.coalesce(at["longitude"].try_cast("double"), F.when(F.size(at["coordinates"]) == 2, at["coordinates"][0]))
    return e.select("event_id", lat.alias("latitude"), lon.alias("longitude"), road_rank(F.concat(F.lit("x_"), F.when(i % 2 == 0, "primary").otherwise("tertiary_link"))).alias("rank"))


def json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal-style text becomes JSON; fields are then read from it."""
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("{'type': '"), F.col("event_type"), F.lit("', 'ok': True, 'note': None, 'k': "), (F.col("event_id") % 10).cast("string"), F.lit("}")).alias("raw"))
    j = T.json_text(F.col("raw"))
    return e.select("event_id", F.get_json_object(j, "$.type").alias("kind"), F.get_json_object(j, "$.k").cast("int").alias("k"), F.coalesce(F.nullif(F.get_json_object(j, "$.note"), F.lit("null")), F.lit("none")).alias("note"))


def align_and_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    out = M.align_to_target(d, {"doc_id": "bigint", "text": "string", "lang": "string", "region": "string"})
    out = M.sanitize_text(out).withColumnsRenamed({"doc_id": "id"})
    return out.select("id", F.md5("text").alias("text_md5"), "lang", "region", F.lit("v1").alias("vintage"))


# -- merges ----------------------------------------------------------------------------------------------------------

_KEY = ["c_custkey"]


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def _second(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    n = F.broadcast(c.agg(F.count(F.lit(1)).alias("n")))  # one row
    changed = c.where("c_custkey % 17 <> 0").withColumns({"c_acctbal": F.expr("if(c_custkey % 10 = 0, c_acctbal + 1, c_acctbal)"), "c_mktsegment": F.expr("if(c_custkey % 29 = 0, null, c_mktsegment)")})
    new = c.join(n).where("c_custkey <= n div 50").selectExpr("n + c_custkey as c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return changed.unionByName(new)


def _history(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return M.scd2_merge(M.scd2_start(_customers(spark, sf_dir), _KEY, "2024-01-01"), _second(spark, sf_dir), _KEY, "2024-02-01", **how)


_OUT = ["c_custkey", "c_acctbal", "c_mktsegment", "valid_from", "valid_to"]


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.current(_history(spark, sf_dir)).select(*_OUT)


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).select(*_OUT)


def scd2_invalidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, invalidate_missing=True).select(*_OUT)


def scd2_revert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third batch gives some keys their first value back: they end without a current row."""
    third = _customers(spark, sf_dir).where("c_custkey % 20 = 0")
    return M.scd2_merge(_history(spark, sf_dir), third, _KEY, "2024-03-01").select(*_OUT)


def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.as_of(_history(spark, sf_dir, invalidate_missing=True), "2024-01-15").select(*_OUT)


def _suppliers(spark: SparkSession, sf_dir: str, lo: int) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return s.where("s_suppkey % 3 <> 0") if not lo else s.where("s_suppkey % 2 = 0").withColumns({"s_name": F.concat("s_name", F.lit(" new")), "s_acctbal": F.col("s_acctbal") + lo})


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.upsert(_suppliers(spark, sf_dir, 0), _suppliers(spark, sf_dir, 5), ["s_suppkey"], ["s_acctbal"])


def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _suppliers(spark, sf_dir, 5).unionByName(_suppliers(spark, sf_dir, 7))
    return M.insert_ignore(_suppliers(spark, sf_dir, 0), batch, ["s_suppkey"], ["s_acctbal"])


def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.append(_suppliers(spark, sf_dir, 0), _suppliers(spark, sf_dir, 5))


# -- increments ------------------------------------------------------------------------------------------------------


def incremental_keyset(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    mark = I.pair_mark(e.where("event_id % 1000 = 0"), "ts", "event_id").first()
    return I.incremental_filter(e, "ts", "event_id", mark["mark_value"] or "", mark["mark_id"] or 0, "event_type <> 'view'").select("event_id", "ts")


def pair_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_id") % 9 != 0, F.col("ts")))
    return I.pair_mark(e, "ts", "event_id").join(I.high_water(e, "event_id"))  # one row each


def skip_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    return I.skip_seen(e, "ts", "2024-01-15").select("event_id", "ts")


def work_list_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    work = o.select(F.year("o_orderdate").alias("vintage"), F.col("o_orderpriority").alias("state")).distinct()
    done = o.where("o_orderkey % 500 = 0").select(F.year("o_orderdate").alias("vintage"), F.col("o_orderpriority").alias("state"), F.col("o_orderdate").alias("ingested_at"))
    return I.pending(work, done, ["vintage", "state"], "1996-01-01")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as run_id", "event_type as source", "user_id % 20 as dataset_id", "if(event_id % 2 = 0, 'full', 'incremental') as mode", "ts as started_at", "ts + make_interval(0, 0, 0, 0, 0, 0, floor(value)) as completed_at",
        "if(event_id % 7 = 0, 'failed', 'success') as status", "if(event_id % 5 = 0, null, date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")) as high_water_mark",
    )


LOG = """log as (select event_id as run_id, event_type as source, user_id % 20 as dataset_id, case when event_id % 2 = 0 then 'full' else 'incremental' end as mode, ts as started_at, ts + to_seconds(cast(floor(value) as bigint)) as completed_at,
  case when event_id % 7 = 0 then 'failed' else 'success' end as status, case when event_id % 5 = 0 then null else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end as high_water_mark from events)"""


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.run_stats(_log(spark, sf_dir))


def last_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.last_mark(_log(spark, sf_dir))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.run_history(_log(spark, sf_dir), "click")


def soql_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third page of 100 in a stable order."""
    return table(spark, sf_dir, "part").where("p_size > 10").selectExpr("p_partkey", "p_name", "p_size").orderBy("p_partkey").offset(200).limit(100)


def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(5)


def id_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, l = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    return l.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 6).alias("quantity"))


def column_chunk_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide result fetched in column chunks, joined on the key; the first chunk fixes the rows."""
    l = table(spark, sf_dir, "lineitem")
    key = ["l_suppkey"]
    chunks = [l.where("l_quantity > 10").groupBy(*key).agg(F.count(F.lit(1)).alias("n")), l.where("l_discount > 0.05").groupBy(*key).agg(F.round(F.max("l_extendedprice"), 6).alias("top_price")), l.groupBy(*key).agg(F.round(F.max("l_tax"), 6).alias("top_tax"))]
    out = chunks[0]
    for more in chunks[1:]:
        out = out.join(more, key, "left")
    return out


def two_phase_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary rows merged first, then detail for ids past the mark that held before."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type", "value")
    old = M.scd2_start(e.where("id % 4 <> 0").select("id", "event_type", F.lit(None).cast("double").alias("value")), ["id"], "2024-01-01")
    mark = I.high_water(M.current(old), "id").first()["high_water"]
    summary = e.select("id", "event_type", F.lit(None).cast("double").alias("value"))
    first = M.scd2_merge(old, summary, ["id"], "2024-02-01")
    detail = e.where((F.col("id") > mark) | (F.col("id") % 8 == 0))
    return M.current(M.scd2_merge(first, detail, ["id"], "2024-03-01")).select("id", "event_type", "value", "valid_from")


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a merge: staged, merged, invalidated."""
    before = M.scd2_start(_customers(spark, sf_dir), _KEY, "2024-01-01")
    batch = _second(spark, sf_dir)
    return M.merge_counts(before, M.scd2_merge(before, batch, _KEY, "2024-02-01"), batch)


def partial_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages staged before an error are merged; the failed page is left for the next run."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    pages = [lambda k=k: e.where(F.col("event_id") % 4 == k) if k != 2 else (_ for _ in ()).throw(OSError("page 2")) for k in range(4)]
    target = e.where("event_id % 8 = 1").withColumn("event_type", F.lit("old"))
    try:
        return I.merge_pages(pages, target, lambda old, new: M.upsert(old, new, ["event_id"]))
    except I.PartialLoad as broken:
        return broken.merged


# -- text, time, quality ---------------------------------------------------------------------------------------------


def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _blocks(spark, sf_dir)
    k = F.col("c_custkey")
    street = F.when(k % 4 == 0, F.lit("  ")).otherwise(F.concat(k.cast("string"), F.lit("  main  st")))
    state, zipped = F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise("il"), F.when(k % 3 == 0, "60601")
    listed = F.when(k % 2 == 0, "['residential', 'tertiary']").otherwise("primary")
    return c.select(
        "c_custkey", T.normalize_address(F.col("block"), street, F.lit("chicago"), state, zipped).alias("normal"), T.address_hash(F.col("block"), street, F.lit("chicago"), state, zipped).alias("hash"),
        T.first_number(F.concat((k % 90).cast("string"), F.lit(" mph;50 mph"))).alias("speed"), T.first_listed(listed).alias("road"), T.geocoder_input(F.col("block"), street, F.lit("chicago"), state, zipped).alias("geocoder"),
        T.any_contains(F.array(F.lit("Main Street"), F.col("c_mktsegment")), F.lit("BUILD")).alias("on_route"),
    )


def time_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    age = (F.unix_timestamp(F.lit(L.AS_OF).cast("timestamp")) - F.unix_timestamp("ts")) / F.lit(365.25 * 86400)
    return e.select("event_id", F.round(age, 6).alias("age_years"), I.mark_text(F.col("ts")).alias("mark"), (F.col("ts") >= F.add_months(F.lit("2024-07-01").cast("date"), -6).cast("timestamp")).alias("is_fresh"))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, n = L.edges(spark, sf_dir), network.node_profile(L.edges(spark, sf_dir), L.nodes(spark, sf_dir))
    raw = _blocks(spark, sf_dir).withColumn("expected", F.upper(F.concat(F.expr("lpad(cast(c_custkey % 120 as string), 3, '0')"), F.lit("00 W "), F.col("c_mktsegment"), F.lit(" ST, CHICAGO, IL"))))
    checks = [
        ("edge_length_positive", Q.between("length_m", 0, strict=True), "error"), ("edge_name_present", Q.not_null("name"), "warn"), ("edge_lit_known", Q.accepted("lit", ["yes", "no"]), "warn"),
        ("edge_u_over_v", Q.where(F.col("oneway") == "yes", F.col("u") > F.col("v")), "warn"),
    ]
    nodes = [("node_rank_range", Q.between("max_road_rank", 1, 4), "error"), ("node_class_known", Q.accepted("max_road_class", ["primary", "secondary", "tertiary"]), "warn"), ("node_penalty_range", Q.between("traffic_control_penalty", 0, 20), "error")]
    return Q.report([Q.row_checks(e, checks), Q.row_checks(n, nodes), Q.unique(e, ["u", "v", "key"], "edge_key_unique"), Q.unique(e, ["u", "v"], "edge_pair_unique", "warn"), Q.expect_pairs(raw, "expected", T.clean_address(T.fill_block(F.col("block"))), "clean_address_pairs")])


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as segment_id", "element_at(array('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD'), cast(s_suppkey % 5 + 1 as int)) as street", "'ST' as street_type", "if(s_suppkey % 4 = 0, 'E', 'W') as direction",
        "cast((s_suppkey div 5) * 400 as int) as from_number", "cast((s_suppkey div 5) * 400 + 398 as int) as to_number", "cast(if(s_suppkey % 3 = 0, 1, null) as int) as parity",
        "-87.9D as x0", "41.7D as y0", "-87.9D + (s_suppkey % 10) * 0.001D as x1", "41.7D + (s_suppkey % 7) * 0.001D as y1",
    )


def geocode_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    blocks = _blocks(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")  # a file of few row groups would give few tasks
    cache = blocks.select(
        k.cast("string").alias("address_hash"), T.clean_address(T.fill_block(F.col("block"))).alias("address"), F.when(k % 6 == 0, F.lit(41.8)).alias("latitude"),
        F.when(k % 7 == 0, "no_result").when(k % 11 == 0, "error: timeout").alias("failure"),
    )
    return G.geocode(cache, _ranges(spark, sf_dir), 12).select("address_hash", "rating", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "failure")


QUERIES = (
    bike_crash_union_semi, crime_address_clean, theft_coord_fill, theft_union, parking_union, address_cache, address_cache_increment, staging_select, typed_cast, conform, location_points, json_text, align_and_sanitize,
    scd2_current, scd2_history, scd2_invalidate, scd2_revert, scd2_as_of, upsert, insert_ignore, append, incremental_keyset, pair_mark, skip_seen, work_list_pending, run_stats, last_mark, run_history, soql_page, top_rows,
    id_lookup, column_chunk_join, two_phase_enrich, ingest_log, partial_merge, text_helpers, time_helpers, dq_report, geocode_outcomes,
)

_V1 = "v1 as (select c_custkey, c_name, c_acctbal, c_mktsegment from customer)"
_V2 = f"""{_V1}, cnt as (select count(*) as n from customer), v2 as (
  select c_custkey, c_name, case when c_custkey % 10 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal, case when c_custkey % 29 = 0 then null else c_mktsegment end as c_mktsegment from v1 where c_custkey % 17 <> 0
  union all select n + c_custkey, c_name, c_acctbal, c_mktsegment from v1, cnt where c_custkey <= n // 50
), same as (select v1.c_custkey from v1 join v2 using (c_custkey) where v1.c_acctbal is not distinct from v2.c_acctbal and v1.c_mktsegment is not distinct from v2.c_mktsegment)"""


def _hist(missing: bool) -> str:
    closed = "c_custkey not in (select c_custkey from same)" + ("" if missing else " and c_custkey in (select c_custkey from v2)")
    return f"""{_V2}, hist as (
      select c_custkey, c_acctbal, c_mktsegment, timestamp '2024-01-01' as valid_from, case when {closed} then timestamp '2024-02-01' end as valid_to from v1
      union all select c_custkey, c_acctbal, c_mktsegment, timestamp '2024-02-01', null from v2 where c_custkey not in (select c_custkey from same))"""


_NORMAL = "upper(trim(regexp_replace(case when street is null and city is null and state is null and zip is null then block else concat_ws(', ', street, city, state, zip) end, '\\s+', ' ', 'g')))"
_PARTS = """parts as (select c_custkey, c_mktsegment, block, case when c_custkey % 4 = 0 then null else concat(c_custkey, '  main  st') end as street, 'chicago' as city,
  case when c_custkey % 5 = 0 then null else 'il' end as state, case when c_custkey % 3 = 0 then '60601' end as zip from blocks)"""

SQL = {
    "bike_crash_union_semi": """with ids as (select l_orderkey as id from lineitem where l_returnflag = 'R' union select o_orderkey from orders where o_orderstatus = 'P'
        union select o_orderkey from orders join customer on o_custkey = c_custkey where c_mktsegment = 'BUILDING'
      ), c as (select o_orderkey, timezone('America/Chicago', timezone('UTC', o_orderdate)) as local_at from orders where o_orderkey in (select id from ids))
      select c.o_orderkey, local_at, rpad(dayname(local_at), 9, ' ') as day_of_week, strftime(local_at, '%H:%M:%S') as time_of_day, l_linenumber, l_linestatus
      from c left join (select * from lineitem where l_returnflag = 'R') on l_orderkey = o_orderkey""",
    "crime_address_clean": f"with {BLOCKS} select c_custkey, {_CLEAN} as address, cast(round(cast(latitude as decimal(18,6)), 3) as double) as latitude, cast(round(cast(longitude as decimal(18,6)), 3) as double) as longitude from blocks",
    "theft_coord_fill": f"with {BLOCKS}, {_PICKED} select c_custkey, round(coalesce(c.latitude, k.latitude), 6) as latitude, round(coalesce(c.longitude, k.longitude), 6) as longitude from clean c left join cache k using (address) where c_custkey % 4 = 1",
    "theft_union": """select *, cast(year(stolen_at) as integer) as theft_year, cast(hour(timezone('America/Chicago', timezone('UTC', stolen_at))) as integer) as theft_hour from (
      select cast(event_id as varchar) as source_id, ts as stolen_at, value, 'events' as data_source from events where event_type = 'click'
      union all select cast(o_orderkey as varchar), o_orderdate, null, 'orders' from orders where o_orderstatus = 'F')""",
    "parking_union": """select p_partkey as rack_id, case when p_partkey % 7 = 0 then null else cast(p_partkey % 20 as integer) end as capacity, case when p_partkey % 3 = 0 then 'yes' else 'no' end as covered, 'osm' as data_source, null::varchar as location from part where p_partkey % 5 = 0
      union all select s_suppkey, null, null, 'city', s_name from supplier""",
    "address_cache": f"with {BLOCKS}, {_PICKED} select address_hash, address, quality, round(latitude, 6) as latitude, round(longitude, 6) as longitude from cache",
    "address_cache_increment": f"with {BLOCKS}, {_PICKED} select address_hash, quality from cache where address_hash not in (select address_hash from cache where quality = 0)",
    "staging_select": "select n_nationkey as geoid, n_name as name, n_regionkey from nation",
    "typed_cast": "select cast(o_orderkey as varchar) as id, cast(cast(o_totalprice as decimal(19,4)) as double) as price, cast(cast(o_orderdate as date) as varchar) as day, try_cast(o_orderpriority[1:1] as integer) as priority from orders",
    "conform": """select cast(o_orderkey as varchar) as geoid, case when year(o_orderdate) % 2 = 0 then 'even' else 'odd' end as vintage, case when year(o_orderdate) % 2 = 0 then o_totalprice end as b1,
      case when year(o_orderdate) % 2 = 1 then o_orderstatus end as b2, timestamp '2024-01-01' as ingested_at from orders""",
    "location_points": """select event_id, case event_id % 3 when 0 then (event_id % 90)::double when 1 then event_id % 90 + 0.25::double end as latitude, case event_id % 3 when 0 then (event_id % 180)::double when 1 then event_id % 180 + 0.5::double end as longitude,
      case when event_id % 2 = 0 then 4 else 2 end as rank from events""",
    "json_text": "select event_id, event_type as kind, cast(event_id % 10 as integer) as k, 'none' as note from events",
    "align_and_sanitize": "select doc_id as id, md5(translate(text, chr(9) || chr(10) || chr(13), '   ')) as text_md5, lang, null::varchar as region, 'v1' as vintage from documents",
    "scd2_current": f"with {_hist(False)} select * from hist where valid_to is null",
    "scd2_history": f"with {_hist(False)} select * from hist",
    "scd2_invalidate": f"with {_hist(True)} select * from hist",
    "scd2_revert": f"""with {_hist(False)}, back as (select * from v1 where c_custkey % 20 = 0)
      select h.c_custkey, h.c_acctbal, h.c_mktsegment, valid_from, case when valid_to is null and b.c_custkey is not null and not (h.c_acctbal is not distinct from b.c_acctbal and h.c_mktsegment is not distinct from b.c_mktsegment) then timestamp '2024-03-01' else valid_to end as valid_to
      from hist h left join back b on b.c_custkey = h.c_custkey""",
    "scd2_as_of": f"with {_hist(True)} select * from hist where valid_from <= timestamp '2024-01-15' and (valid_to is null or valid_to > timestamp '2024-01-15')",
    "upsert": """select coalesce(t.s_suppkey, s.s_suppkey) as s_suppkey, case when t.s_suppkey is null then concat(s.s_name, ' new') else t.s_name end as s_name, case when s.s_suppkey is not null then s.s_acctbal + 5 else t.s_acctbal end as s_acctbal
      from (select * from supplier where s_suppkey % 3 <> 0) t full join (select * from supplier where s_suppkey % 2 = 0) s using (s_suppkey)""",
    "insert_ignore": "select s_suppkey, s_name, s_acctbal from supplier where s_suppkey % 3 <> 0 union all select s_suppkey, concat(s_name, ' new'), s_acctbal + 5 from supplier where s_suppkey % 3 = 0 and s_suppkey % 2 = 0",
    "append": "select s_suppkey, s_name, s_acctbal from supplier where s_suppkey % 3 <> 0 union all select s_suppkey, concat(s_name, ' new'), s_acctbal + 5 from supplier where s_suppkey % 2 = 0",
    "incremental_keyset": """with m as (select ts, event_id from events where event_id % 1000 = 0 order by ts desc, event_id desc limit 1)
      select e.event_id, e.ts from events e, m where (e.ts > m.ts or (e.ts = m.ts and e.event_id > m.event_id)) and event_type <> 'view'""",
    "pair_mark": """select strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as mark_value, event_id as mark_id, concat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '|', event_id) as mark, (select max(event_id) from events) as high_water
      from events where event_id % 9 <> 0 order by ts desc, event_id desc limit 1""",
    "skip_seen": "select event_id, case when event_id % 50 <> 0 then ts end as ts from events where event_id % 50 = 0 or ts > timestamp '2024-01-15'",
    "work_list_pending": """select distinct cast(year(o_orderdate) as integer) as vintage, o_orderpriority as state from orders o where not exists (
      select 1 from orders d where d.o_orderkey % 500 = 0 and d.o_orderdate >= timestamp '1996-01-01' and year(d.o_orderdate) = year(o.o_orderdate) and d.o_orderpriority = o.o_orderpriority)""",
    "run_stats": f"with {LOG} select source, mode, round(coalesce(avg(case when status = 'success' then (floor(epoch(completed_at)) - floor(epoch(started_at))) / 60.0 end), 5), 6) as avg_minutes, count(*) as runs from log group by source, mode",
    "last_mark": f"""with {LOG} select source, dataset_id, run_id, high_water_mark from (select *, row_number() over (partition by source, dataset_id order by completed_at desc, run_id desc) as rn from log
      where status = 'success' and high_water_mark is not null) where rn = 1""",
    "run_history": f"with {LOG} select run_id, dataset_id, mode, status, cast(floor(epoch(completed_at)) - floor(epoch(started_at)) as double) as seconds from log where source = 'click'",
    "soql_page": "select p_partkey, p_name, p_size from part where p_size > 10 order by p_partkey limit 100 offset 200",
    "top_rows": "select event_id, ts from events order by ts desc, event_id desc limit 5",
    "id_lookup": "select p_brand, count(*) as n, round(sum(l_quantity), 6) as quantity from lineitem join part on l_partkey = p_partkey group by p_brand",
    "column_chunk_join": """select a.l_suppkey, n, top_price, top_tax from (select l_suppkey, count(*) as n from lineitem where l_quantity > 10 group by 1) a
      left join (select l_suppkey, round(max(l_extendedprice), 6) as top_price from lineitem where l_discount > 0.05 group by 1) b using (l_suppkey) left join (select l_suppkey, round(max(l_tax), 6) as top_tax from lineitem group by 1) c using (l_suppkey)""",
    "two_phase_enrich": """with m as (select max(event_id) as mark from events where event_id % 4 <> 0)
      select event_id as id, event_type, case when event_id > mark or event_id % 8 = 0 then value end as value,
        case when event_id > mark or event_id % 8 = 0 then timestamp '2024-03-01' when event_id % 4 = 0 then timestamp '2024-02-01' else timestamp '2024-01-01' end as valid_from from events, m""",
    "ingest_log": f"""with {_V2} select (select count(*) from v2) as staged, (select count(*) from v2 where c_custkey not in (select c_custkey from same)) as merged,
      (select count(*) from v1 where c_custkey in (select c_custkey from v2) and c_custkey not in (select c_custkey from same)) as invalidated""",
    "partial_merge": "select event_id, event_type, value from events where event_id % 4 in (0, 1)",
    "text_helpers": f"""with {BLOCKS}, {_PARTS} select c_custkey, {_NORMAL} as normal, md5({_NORMAL}) as hash, cast(c_custkey % 90 as integer) as speed, case when c_custkey % 2 = 0 then 'residential' else 'primary' end as road,
      case when street is not null then concat_ws(', ', trim(street), city, nullif(concat_ws(' ', state, zip), '')) else block end as geocoder, contains(lower(c_mktsegment), 'build') as on_route from parts""",
    "time_helpers": """select event_id, round((epoch(timestamp '2025-01-01') - floor(epoch(ts))) / (365.25::double * 86400), 6) as age_years, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as mark, ts >= timestamp '2024-01-01' as is_fresh from events""",
    "dq_report": f"""with {L.NODES}, {L.EDGES}, {PROFILE}, r as (
        select 'edge_length_positive' as check_name, count(*) filter (not length_m > 0) as failures, 'error' as severity from edges
        union all select 'edge_name_present', count(*) filter (name is null), 'warn' from edges union all select 'edge_lit_known', count(*) filter (lit not in ('yes', 'no')), 'warn' from edges
        union all select 'edge_u_over_v', count(*) filter (oneway = 'yes' and not u > v), 'warn' from edges
        union all select 'node_rank_range', count(*) filter (max_road_rank not between 1 and 4), 'error' from profile union all select 'node_class_known', count(*) filter (max_road_class not in ('primary', 'secondary', 'tertiary')), 'warn' from profile
        union all select 'node_penalty_range', count(*) filter (traffic_control_penalty not between 0 and 20), 'error' from profile
        union all select 'edge_key_unique', count(*), 'error' from (select 1 from edges group by u, v, key having count(*) > 1) union all select 'edge_pair_unique', count(*), 'warn' from (select 1 from edges group by u, v having count(*) > 1)
        union all select 'clean_address_pairs', 0, 'error')
      select *, failures = 0 as passed from r""",
    "geocode_outcomes": f"""with {BLOCKS}, ranges as (select s_suppkey as segment_id, ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD'][s_suppkey % 5 + 1] as street, case when s_suppkey % 4 = 0 then 'E' else 'W' end as direction, (s_suppkey // 5) * 400 as lo, (s_suppkey // 5) * 400 + 398 as hi,
          case when s_suppkey % 3 = 0 then 1 end as parity, (-87.9)::double as x0, 41.7::double as y0, (-87.9)::double + (s_suppkey % 10) * 0.001::double as x1, 41.7::double + (s_suppkey % 7) * 0.001::double as y1 from supplier
      ), todo as (select c_custkey, (c_custkey % 120) * 100 as number, c_mktsegment as street from blocks where c_custkey % 6 <> 0 and (c_custkey % 7 <> 0)
      ), cand as (select c_custkey, case when direction <> 'W' then 5 else 0 end + case when parity is not null and parity <> number % 2 then 10 else 0 end as rating, segment_id,
          y0 + (number - lo) / 398.0::double * (y1 - y0) as latitude, x0 + (number - lo) / 398.0::double * (x1 - x0) as longitude from todo join ranges r on r.street = todo.street and number between lo and hi
      ), best as (select * from (select *, row_number() over (partition by c_custkey order by rating, segment_id) as rn from cand) where rn = 1)
      select cast(t.c_custkey as varchar) as address_hash, cast(rating as integer) as rating, case when rating <= 12 then round(latitude, 6) end as latitude, case when rating <= 12 then round(longitude, 6) end as longitude,
        case when rating is null then 'no_result' when rating > 12 then concat('below_threshold:rating_', rating) end as failure from todo t left join best b on b.c_custkey = t.c_custkey""",
}
