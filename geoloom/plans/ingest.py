"""Registered queries: streams merged into tables, locked features, catalogue casts, exports, builds and deliveries."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.operators import catalog as C
from geoloom.operators import delivery as D
from geoloom.operators import incremental as I
from geoloom.operators import merge as M
from geoloom.plans import lattice as L
from geoloom.plans.lattice import table
from geoloom.session import shared_dir, stage
from geoloom.sources import elements as S
from geoloom.streaming import merge as SM

# -- streams ---------------------------------------------------------------------------------------------------------

_CHANGES = "user_id long, event_type string, ts timestamp"


def _base(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def _merged(spark: SparkSession, sf_dir: str, how) -> DataFrame:
    """Events landed as files that aren't in order of time, every tenth line twice, merged in several batches."""
    base = _base(spark, "changes")
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    e.unionAll(e.where("event_id % 10 = 0")).repartition(6, F.xxhash64("event_id")).drop("event_id").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(_CHANGES).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
    to = SM.VersionedTable(spark, f"{base}/out", ["user_id"], _CHANGES, buckets=8)
    SM.merge_stream(stream, to, how, f"{base}/state")
    return to.read()


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each user."""
    return _merged(spark, sf_dir, SM.newest(["user_id"], "ts", ["event_type"]))


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's versions by event time."""
    return SM.history(_merged(spark, sf_dir, SM.observed), ["user_id"], "ts", ["event_type"])


# -- features --------------------------------------------------------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crashes as feature texts with two names' case mixed; some broken in each of the four ways, some with more properties."""
    i = F.col("crash_record_id")
    c = L.crashes(spark, sf_dir).select("crash_record_id", F.round("px", 6).alias("px"), F.round("py", 6).alias("py"))
    geometry = F.when(i % 40 == 3, "null").when(i % 40 == 5, '{"type":"Circle","coordinates":[1,2]}').when(i % 40 == 7, '{"type":"Point","coordinates":[[1,2]]}').otherwise(F.concat(F.lit('{"type":"Point","coordinates":['), F.col("px"), F.lit(","), F.col("py"), F.lit("]}")))
    more = F.when(i % 30 == 11, ',"note":"x"').when(i % 30 == 12, ',"Extra":1,"note":null').otherwise("")
    less = F.when(i % 9 == 4, "").otherwise(F.concat(F.lit(',"Kind":"k'), (i % 5).cast("string"), F.lit('"')))
    good = F.concat(F.lit('{"type":"Feature","properties":{"CRASH_ID":'), i.cast("string"), less, more, F.lit('},"geometry":'), geometry, F.lit("}"))
    return c.select(F.lpad((i % 4).cast("string"), 2, "0").alias("file"), i.alias("position"), F.when(i % 40 == 9, '{"type":').otherwise(good).alias("feature"))


def _read(spark: SparkSession, sf_dir: str) -> S.Features:
    return S.read_features(_features(spark, sf_dir), "feature", ["file", "position"], keep=["position"], lowercase=True)


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _read(spark, sf_dir)
    gtype, coordinates = S.promote(F.col("gtype"), F.col("coordinates"))
    return f.good.select(F.col("crash_id").cast("long").alias("crash_id"), "kind", gtype.alias("gtype"), F.round(F.from_json(coordinates, "array<array<double>>")[0][0], 6).alias("px"))


def feature_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir).failed.select("position", "failure")


def feature_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir).unknown


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse and merge counters of one run, as its log entry has them; no pass is made to count."""
    log = _base(spark, "run-log")

    def load() -> dict:
        counts = I.Counters()
        read = S.parse_features(_features(spark, sf_dir), "feature", {"CRASH_ID": "bigint", "Kind": "string"}).select(F.col("CRASH_ID").alias("id"), F.col("Kind").alias("kind"), "is_valid")
        parsed = stage(counts.tap(read, parsed=F.col("is_valid"), failed=~F.col("is_valid")).where("is_valid").select("id", "kind"))
        before = stage(M.scd2_start(parsed.where("id % 3 = 0").select("id", F.when(F.col("id") % 2 == 0, F.lit("old")).otherwise(F.col("kind")).alias("kind")), ["id"], "2024-01-01"))
        at = F.lit("2024-02-01").cast("timestamp")
        after = M.scd2_merge(before, counts.tap(parsed, staged=F.lit(True)), ["id"], "2024-02-01")
        stage(counts.tap(after, merged=F.col("valid_from") == at, invalidated=F.coalesce(F.col("valid_to") == at, F.lit(False))))
        seen = counts.values()
        return {"rows_staged": seen["staged"], "rows_merged": seen["merged"], "high_water_mark": "|".join(f"{k}={seen[k]}" for k in ("parsed", "failed", "invalidated"))}

    I.run_units(spark, log, "crashes", "full", {"all": load})
    return spark.read.schema(I.LOG).parquet(log).select("source", "unit", "status", "rows_staged", "rows_merged", F.col("high_water_mark").alias("counters"))


def resumed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stored mark, an override and an empty override load, in rows and ids."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    mark = I.pair_mark(e.where("event_id % 1000 = 0"), "ts", "event_id").first()["mark"]
    loads = {"stored": I.resume(e, "ts", "event_id", mark), "override": I.resume(e, "ts", "event_id", mark, "2024-01-15T00:00:00.000000|7", "event_type <> 'view'"), "full": I.resume(e, "ts", "event_id", mark, ""), "first": I.resume(e, "ts", "event_id", None)}
    out = None
    for name, rows in loads.items():
        one = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("event_id"), F.lit(0)).alias("ids")).select(F.lit(name).alias("load"), "n", "ids")
        out = one if out is None else out.unionByName(one)
    return out


def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of work of four shapes that no load covers: vintage and state, region, tile with freshness, and forced."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("vintage"), F.col("o_orderpriority").alias("state"), (F.col("o_custkey") % 40).alias("region"), (F.col("o_orderkey") % 300).alias("tile"), F.col("o_orderdate").alias("ingested_at"), "o_orderkey")
    done = o.where("o_orderkey % 8 = 3")
    unit = lambda key: o.select(*key).distinct()
    text = lambda df, shape, key: df.select(F.lit(shape).alias("shape"), F.concat_ws("/", *[F.col(k).cast("string") for k in key]).alias("unit"))
    out = text(I.pending(unit(["vintage", "state"]), done.where("o_orderkey % 64 = 3"), ["vintage", "state"]), "vintage/state", ["vintage", "state"])
    out = out.unionByName(text(I.pending(unit(["region"]), done.where("region % 3 = 0"), ["region"]), "region", ["region"]))
    out = out.unionByName(text(I.pending(unit(["tile"]), done, ["tile"], "1997-01-01"), "tile", ["tile"]))
    return out.unionByName(text(I.pending(unit(["region"]), done, ["region"], force=True), "forced", ["region"]))


# -- catalogues ------------------------------------------------------------------------------------------------------

_PORTAL = {"id": ("portal", "number"), "price": ("portal", "money"), "sold": ("portal", "checkbox"), "on_date": ("shape", "date:10"), "at_time": ("shape", "time"), "size": ("shape", "int32:9"), "total": ("census", "int"), "place": ("portal", "point"), "other": ("portal", "no such type")}


def _portal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as id", "if(p_partkey % 7 = 0, 'n/a', concat(p_partkey, '.5')) as price", "if(p_partkey % 5 = 0, 'maybe', if(p_partkey % 2 = 0, 'true', 'false')) as sold",
        "if(p_partkey % 11 = 0, '2024-13-01', '2024-02-03') as on_date", "if(p_partkey % 13 = 0, '25:00:00', '07:30:00') as at_time", "if(p_partkey % 17 = 0, '99999999999', cast(p_size as string)) as size",
        "if(p_partkey % 3 = 0, null, cast(p_partkey * 2 as string)) as total", "'{\"type\":\"Point\"}' as place", "p_brand as other",
    )


def catalog_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.cast_by_catalog(_portal_rows(spark, sf_dir), _PORTAL)
    return out.select(F.col("id").cast("long").alias("id"), F.col("price").cast("double").alias("price"), "sold", F.col("on_date").cast("string").alias("on_date"), "at_time", "size", F.col("total").cast("long").alias("total"), "place", "other", F.array_join(F.transform("rejects", lambda r: F.concat(r["column"], F.lit("="), r["value"])), ";").alias("rejects"))


def conform_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two vintages: geoid repeats, geoidfq has nulls, linearid tells rows apart."""
    p = table(spark, sf_dir, "part").selectExpr("cast(p_partkey % 50 as string) as geoid", "if(p_partkey % 9 = 0, null, concat('fq', p_partkey)) as geoidfq", "concat('l', p_partkey) as linearid", "cast(p_size as string) as size", "'x' as secret", "p_brand as `:id`", "'7' as `:@computed_region_1`", "p_type as kind")
    listed = [{"name": ":id", "type": "text"}, {"name": "geoid", "type": "text"}, {"name": "geoidfq", "type": "text"}, {"name": "linearid", "type": "text"}, {"name": "secret", "type": "text", "hidden": True}, {"name": ":@computed_region_1", "type": "number"}, {"name": "size", "type": "number"}, {"name": "kind", "type": "text"}]
    whole, key = C.conform_table({2023: p.drop("kind"), 2024: p.where("size > 10")}, listed, "portal", "2024-05-01")
    return whole.select(F.lit(",".join(key or [])).alias("entity_key"), F.lit(",".join(whole.columns)).alias("columns"), "linearid", "vintage", F.col("size").cast("long").alias("size"), "kind", "socrata_id", "valid_from", "valid_to")


def file_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as files of a year and a county each, read back with what the files' names tell."""
    base = _base(spark, "files")
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as `:id`", "s_name as `Name Of It`", "'1' as `:@computed_region_a`", "2020 + s_suppkey % 3 as y", "lpad(cast(s_suppkey % 4 + 17029 as string), 5, '0') as c")
    s.withColumn("f", F.format_string("tl_%d_%s_part", "y", "c")).drop("y", "c").write.partitionBy("f").json(base)
    read = spark.read.schema("`:id` long, `Name Of It` string, `:@computed_region_a` string").json(base).withColumn("_file", F.regexp_extract("_metadata.file_path", "/f=([^/]+)/", 1)).drop("f")
    named = C.portal_columns(read, {"Name Of It": "name"}, "2024-05-01T00:00:00")
    return C.file_defaults(named, F.col("_file")).drop("_file")


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = L.edges(spark, sf_dir)
    plain = ["name", "maxspeed", "surface", "lit", "bridge", "bicycle", "cyclestreet", "cycleway_left", "cycleway_right_buffer"]
    quoted = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    entries = [(c.replace("cycleway_left", "cycleway:left").replace("cycleway_right_buffer", "cycleway:right:buffer"), F.when(F.col(c).isNotNull(), quoted(F.col(c)))) for c in plain]
    entries.append(("highway", F.when(F.col("highway").startswith("["), '["residential","tertiary"]').otherwise(quoted(F.col("highway")))))
    entries += [("oneway", F.when(F.col("oneway") == "yes", "true").when(F.col("u") % 2 == 0, "false")), ("width", F.when(F.col("u") % 3 == 0, "NaN").when(F.col("u") % 3 == 1, "2.5"))]
    tags = F.map_filter(F.create_map(*[x for k, v in entries for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    return e.select("u", "v", "key", tags.alias("tags"))


def edge_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tags(spark, sf_dir).select("u", "v", "key", *C.tag_columns(F.col("tags")))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the JSON of all events and features has against what a target expects."""
    e = table(spark, sf_dir, "events").select("event_id", "props")
    both = F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(F.get_json_object("props", "$.k").cast("long").alias("k"), F.array(F.struct(F.lit("a").alias("name"), F.col("event_id").alias("n"))).alias("parts")).alias("body"), F.lit("x").alias(":id"), F.when(F.col("event_id") % 100 == 7, "late").alias("late")))
    target = T.StructType.fromDDL("id bigint, body struct<k:string, parts:array<struct<name:string, gone:int>>>, missing string")
    return C.schema_drift(e, C.json_schema(e.select(both.alias("j")), "j"), target, ignore=[":id"])


# -- delivery --------------------------------------------------------------------------------------------------------


def geojson_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ordered layers and one that fails; what is read back of each is in order."""
    base = _base(spark, "layers")
    c = L.crashes(spark, sf_dir).withColumn("px", F.when(F.col("crash_record_id") % 100 == 7, F.lit(float("nan"))).otherwise(F.col("px")))
    e = L.edges(spark, sf_dir).withColumn("id", F.col("u") * 1000000 + F.col("v") * 10 + F.col("key"))
    ends = lambda p: F.array(p["x"], p["y"])
    line = F.transform("line", ends)
    layers = {
        "crashes": lambda: D.Layer(c, "Point", F.array("px", "py"), ["crash_record_id", "crash_date"], order=["crash_record_id"]),
        "edges": lambda: D.Layer(e, "LineString", line, ["id", "length_m"], where="highway <> 'footway'", order=["id"]),
        "first": lambda: D.Layer(e, "MultiLineString", F.array(line), ["id"], order=["id"], limit=25),
        "broken": lambda: D.Layer(e, "Point", F.col("no_such_column"), ["id"]),
    }
    report = D.export_layers(layers, base)
    back = None
    for name, key in (("crashes", "crash_record_id"), ("edges", "id"), ("first", "id")):
        read = spark.read.text(f"{base}/{name}").select(F.col("_metadata.file_name").alias("file"), F.get_json_object("value", f"$.properties.{key}").cast("long").alias("id"))
        spans = read.groupBy("file").agg(F.min("id").alias("low"), F.max("id").alias("high"))  # one row a file
        over = spans.alias("a").join(spans.alias("b"), F.expr("a.file < b.file and a.high >= b.low")).agg(F.count(F.lit(1)).alias("n"))
        one = over.select(F.lit(name).alias("layer"), (F.col("n") == 0).alias("ordered"))
        back = one if back is None else back.unionByName(one)
    return report.join(back, "layer", "left")


def built_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A protected table: built, appended to twice, its full refresh refused."""
    to = D.Built(spark, _base(spark, "built"), protected=True)
    c = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 41 != 0, F.col("c_custkey")).alias("id"), "c_mktsegment")
    to.build(c.where("id % 3 = 0").withColumn("load", F.lit(1)))
    to.append(c.where("id % 2 = 0 or id is null").withColumn("load", F.lit(2)), ["id"])
    to.append(c.withColumn("load", F.lit(3)), ["id"])
    try:
        to.build(c.withColumn("load", F.lit(4)))
    except D.Protected:
        return to.read()
    raise AssertionError("a protected table was rebuilt")


def delivered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders sent in batches of 1,000 rows into the shared folder; what arrived, by batch."""
    base = _base(spark, "sent")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    inbox = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    inbox.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(inbox)
    from pyarrow import fs, parquet

    store, at = fs.FileSystem.from_uri(base if "://" in base else f"file://{base}")

    def send(number: int, rows: pa.Table) -> None:
        parquet.write_table(rows, f"{at}/{number:09d}.tmp", filesystem=store)
        store.move(f"{at}/{number:09d}.tmp", f"{at}/{number:09d}.parquet")

    def has(number: int) -> bool:
        return store.get_file_info(f"{at}/{number:09d}.parquet").type != fs.FileType.NotFound

    total = D.deliver(o, ["o_orderkey"], 1000, send, has)
    again = D.deliver(o, ["o_orderkey"], 1000, send, has)
    got = spark.read.schema(o.schema).parquet(base).select(F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("long").alias("batch"), "o_orderkey")
    return got.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")).withColumn("total", F.lit(total if total == again else -1).cast("long"))


QUERIES = (stream_upsert, stream_scd2, feature_rows, feature_failures, feature_unknown, run_counters, resumed_loads, pending_units, catalog_cast, conform_key, file_loads, edge_tags, schema_drift, geojson_layers, built_cache, delivered_batches)

_BAD = "case when event_id % 40 = 9 then 'not a feature' when event_id % 40 = 3 then 'no geometry' when event_id % 40 = 5 then 'unknown geometry' when event_id % 40 = 7 then 'bad coordinates' end"
_TAGGED = {"name": "name", "maxspeed": "maxspeed", "surface": "surface", "lit": "lit", "bridge": "bridge", "bicycle": "bicycle", "cyclestreet": "cyclestreet", "cycleway_left": "cycleway_left", "cycleway_right_buffer": "cycleway_right_buffer", "highway": "highway", "oneway": "coalesce(oneway = 'yes', false)", "width": "case when u % 3 = 1 then '2.5' end"}

SQL = {
    "stream_upsert": "select user_id, event_type, ts from (select *, row_number() over (partition by user_id order by ts desc, event_type desc) as rn from events) where rn = 1",
    "stream_scd2": """with one as (select user_id, ts, max(event_type) as event_type from events group by user_id, ts), s as (select *, lag(event_type) over (partition by user_id order by ts) as was from one)
      select user_id, event_type, ts as valid_from, lead(ts) over (partition by user_id order by ts) as valid_to from s where was is null or was <> event_type""",
    "feature_rows": f"""with {L.CRASHES} select crash_record_id as crash_id, case when crash_record_id % 9 <> 4 then concat('k', crash_record_id % 5) end as kind, 'MultiPoint' as gtype, round(px, 6) as px from crashes join events on event_id = crash_record_id where ({_BAD}) is null""",
    "feature_failures": f"select event_id as position, {_BAD} as failure from events where ({_BAD}) is not null",
    "feature_unknown": f"select unnest(case event_id % 30 when 11 then ['note'] when 12 then ['extra', 'note'] else [] end) as property, count(*) as n from events where ({_BAD}) is null group by property",
    "run_counters": f"""with f as (select event_id as id, ({_BAD}) is null or event_id % 40 = 7 as ok, case when event_id % 9 <> 4 then concat('k', event_id % 5) end as kind from events
      ), g as (select id, kind, id % 3 = 0 as there, id % 3 = 0 and id % 2 = 0 as changed from f where ok)
      select 'crashes' as source, 'all' as unit, 'success' as status, count(*) as rows_staged, count(*) filter (where not there or changed) as rows_merged,
        concat('parsed=', count(*), '|failed=', (select count(*) from f where not ok), '|invalidated=', count(*) filter (where changed)) as counters from g""",
    "resumed_loads": """with m as (select ts, event_id from events where event_id % 1000 = 0 order by ts desc, event_id desc limit 1)
      select 'stored' as load, count(*) as n, coalesce(sum(e.event_id), 0)::bigint as ids from events e, m where e.ts > m.ts or (e.ts = m.ts and e.event_id > m.event_id)
      union all select 'override', count(*), coalesce(sum(event_id), 0)::bigint from events where event_type <> 'view' and (ts > timestamp '2024-01-15' or (ts = timestamp '2024-01-15' and event_id > 7))
      union all select 'full', count(*), sum(event_id)::bigint from events union all select 'first', count(*), sum(event_id)::bigint from events""",
    "pending_units": """with o as (select year(o_orderdate) as vintage, o_orderpriority as state, o_custkey % 40 as region, o_orderkey % 300 as tile, o_orderdate, o_orderkey from orders), d as (select * from o where o_orderkey % 8 = 3)
      select 'vintage/state' as shape, concat(vintage, '/', state) as unit from (select distinct vintage, state from o) where (vintage, state) not in (select (vintage, state) from d where o_orderkey % 64 = 3)
      union all select 'region', region::varchar from (select distinct region from o) where region not in (select region from d where region % 3 = 0)
      union all select 'tile', tile::varchar from (select distinct tile from o) where tile not in (select tile from d where o_orderdate >= date '1997-01-01')
      union all select 'forced', region::varchar from (select distinct region from o)""",
    "catalog_cast": """select p_partkey as id, case when p_partkey % 7 <> 0 then p_partkey + 0.5::double end as price, case when p_partkey % 5 <> 0 then p_partkey % 2 = 0 end as sold, case when p_partkey % 11 <> 0 then '2024-02-03' end as on_date,
      case when p_partkey % 13 <> 0 then '07:30:00' end as at_time, case when p_partkey % 17 <> 0 then p_size::integer end as size, case when p_partkey % 3 <> 0 then p_partkey * 2 end as total, '{"type":"Point"}' as place, p_brand as other,
      array_to_string([x for x in [case when p_partkey % 7 = 0 then 'price=n/a' end, case when p_partkey % 5 = 0 then 'sold=maybe' end, case when p_partkey % 11 = 0 then 'on_date=2024-13-01' end, case when p_partkey % 13 = 0 then 'at_time=25:00:00' end, case when p_partkey % 17 = 0 then 'size=99999999999' end] if x is not null], ';') as rejects from part""",
    "conform_key": """select 'linearid,vintage' as entity_key, 'socrata_id,geoid,geoidfq,linearid,size,kind,vintage,ingested_at,record_hash,valid_from,valid_to' as columns, concat('l', p_partkey) as linearid, vintage, p_size::bigint as size,
      case when vintage = 2024 then p_type end as kind, p_brand as socrata_id, timestamp '2024-05-01' as valid_from, null::timestamp as valid_to from part, (select unnest([2023, 2024]) as vintage) where vintage = 2023 or p_size > 10""",
    "file_loads": """select s_suppkey as socrata_id, s_name as name, '2024-05-01T00:00:00' as socrata_updated_at, null::varchar as socrata_created_at, null::varchar as socrata_version,
      (2020 + s_suppkey % 3)::integer as vintage, '17' as statefp, lpad((s_suppkey % 4 + 29)::varchar, 3, '0') as countyfp from supplier""",
    "edge_tags": f"with {L.NODES}, {L.EDGES} select u, v, key, " + ", ".join(f"{_TAGGED.get(t.replace(':', '_'), 'null::varchar')} as {t.replace(':', '_')}" for t in C.EDGE_TAGS) + " from edges",
    "schema_drift": """with d as (select max(event_id) as m from events) select * from (values ('body.k', 'type', 'error', 'bigint', 'string'), ('body.parts[].gone', 'missing', 'warning', null, 'int'), ('body.parts[].n', 'new', 'error', 'bigint', null),
      ('late', 'new', 'error', 'string', null), ('missing', 'missing', 'warning', null, 'string')) t(path, change, severity, source_type, target_type) where path <> 'late' or (select m from d) >= 7""",
    "geojson_layers": f"""with {L.NODES}, {L.EDGES} select 'crashes' as layer, count(*) filter (where event_id % 100 <> 7) as written, count(*) filter (where event_id % 100 = 7) as skipped, null::varchar as error, true as ordered from events
      union all select 'edges', count(*), 0, null, true from edges where highway <> 'footway' union all select 'first', 25, 0, null, true union all select 'broken', null, null, 'AnalysisException', null""",
    "built_cache": """with c as (select case when c_custkey % 41 <> 0 then c_custkey end as id, c_mktsegment from customer) select id, c_mktsegment, case when id % 3 = 0 then 1 when id % 2 = 0 then 2 else 3 end as load from c where id is not null""",
    "delivered_batches": "select k // 1000 as batch, count(*) as n, min(o_orderkey) as first_key, max(o_orderkey) as last_key, (select count(*) from orders) as total from (select o_orderkey, row_number() over (order by o_orderkey) - 1 as k from orders) group by batch",
}
