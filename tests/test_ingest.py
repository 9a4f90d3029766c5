"""Streams merged by batch, locked features, catalogues, builds, layers and deliveries."""

import itertools
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.operators import catalog, delivery, incremental
from geoloom.operators.order import numbered
from geoloom.sources import elements
from geoloom.streaming import merge

ROWS = "k long, v string, at long"


def table(spark, tmp_path, name="t", buckets=4):
    return merge.VersionedTable(spark, str(tmp_path / name), ["k"], ROWS, buckets)


def test_replayed_and_late_batches(spark, tmp_path):
    """Any order of batches, and any batch again, gives the same versions."""
    batches = [[(1, "a", 1), (2, "x", 1)], [(1, "a", 3), (2, "y", 4)], [(1, "b", 2), (3, "z", 9)]]
    want = [(1, "a", 1, 2), (1, "a", 3, None), (1, "b", 2, 3), (2, "x", 1, 4), (2, "y", 4, None), (3, "z", 9, None)]
    for n, order in enumerate(itertools.permutations(batches)):
        if n in (0, 3, 5):
            t = table(spark, tmp_path, f"t{n}")
            for number, rows in enumerate(order):
                for _ in range(2):  # each batch is replayed
                    t.merge(spark.createDataFrame(rows, ROWS), number, merge.observed)
            got = merge.history(t.read(), ["k"], "at", ["v"]).collect()
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_an_unfinished_batch_is_not_seen(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(spark.createDataFrame([(1, "a", 1)], ROWS), 0, merge.newest(["k"], "at"))

    def broken(old, batch):
        raise OSError("lost")

    with pytest.raises(OSError):
        t.merge(spark.createDataFrame([(1, "b", 2)], ROWS), 1, broken)
    assert [tuple(r) for r in t.read().collect()] == [(1, "a", 1)]
    # files without a manifest don't count either
    spark.createDataFrame([(1, "c", 3)], ROWS).write.parquet(f"{tmp_path}/t/data/version=1/bucket=0")
    assert [tuple(r) for r in t.read().collect()] == [(1, "a", 1)]
    t.merge(spark.createDataFrame([(1, "b", 2), (5, "e", 1)], ROWS), 1, merge.newest(["k"], "at"))
    t.merge(spark.createDataFrame([(1, "z", 0)], ROWS), 2, merge.newest(["k"], "at"))  # late
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "b", 2), (5, "e", 1)]
    assert sorted(tuple(r) for r in t.read(before=1).collect()) == [(1, "a", 1)]


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = table(spark, tmp_path, buckets=16)
    t.merge(spark.createDataFrame([(k, "a", 1) for k in range(100)], ROWS), 0, merge.newest(["k"], "at"))
    t.merge(spark.createDataFrame([(7, "b", 2)], ROWS), 1, merge.newest(["k"], "at"))
    assert sorted(t.versions().values()) == [0] * 15 + [1] and t.read().count() == 100
    with pytest.raises(Exception, match="null in a key"):
        t.merge(spark.createDataFrame([(None, "b", 2)], ROWS), 2, merge.newest(["k"], "at"))
    t.merge(spark.createDataFrame([], ROWS), 3, merge.observed)
    assert t.read().count() == 100


def test_a_merge_may_empty_a_bucket(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], ROWS), 0, merge.newest(["k"], "at"))
    t.merge(spark.createDataFrame([(1, "gone", 2)], ROWS), 1, lambda old, batch: old.join(batch, "k", "left_anti"))
    assert [tuple(r) for r in t.read().collect()] == [(2, "b", 1)]
    t.merge(spark.createDataFrame([(1, "back", 3)], ROWS), 2, merge.newest(["k"], "at"))
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "back", 3), (2, "b", 1)]


def test_stream_merges_every_file_once(spark, tmp_path):
    for i in range(5):
        spark.createDataFrame([(k, f"v{i}", 10 - i) for k in range(i, 20)], ROWS).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    t = table(spark, tmp_path)
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    merge.merge_stream(stream, t, merge.newest(["k"], "at"), str(tmp_path / "state"))
    assert sorted(tuple(r) for r in t.read().collect()) == [(k, "v0", 10) for k in range(20)]


def feature(props, geometry='{"type":"Point","coordinates":[1,2]}'):
    return f'{{"type":"Feature","properties":{json.dumps(props)},"geometry":{geometry}}}'


def test_columns_are_locked_by_the_first_valid_feature(spark):
    rows = [
        ("b", 0, feature({"z": 1})), ("a", 2, feature({"late": 1, "B": None})), ("a", 1, feature({"A": "x", "B": 2})), ("a", 0, feature({"bad": 1}, "null")), ("c", 0, "{"), ("c", 1, '{"type":"FeatureCollection"}'),
        ("c", 2, feature({"A": "y"}, '{"type":"Polygon","coordinates":[[[0,0],[1,0],[0,0]]]}')), ("c", 3, feature({"A": "q"}, '{"type":"Polygon","coordinates":[[0,0],[1,0]]}')), ("c", 4, feature({}, '{"type":"Blob","coordinates":[1]}')), ("d", 0, None),
    ]
    f = elements.read_features(spark.createDataFrame(rows, "file string, at int, t string").repartition(4), "t", ["file", "at"], keep=["file", "at"])
    assert f.properties == ["A", "B"]
    assert sorted((r["file"], r["at"], r["A"], r["B"], r["gtype"]) for r in f.good.collect()) == [("a", 1, "x", "2", "Point"), ("a", 2, None, None, "Point"), ("b", 0, None, None, "Point"), ("c", 2, "y", None, "Polygon")]
    assert sorted((r["file"], r["at"], r["failure"]) for r in f.failed.collect()) == [("a", 0, "no geometry"), ("c", 0, "not a feature"), ("c", 1, "not a feature"), ("c", 3, "bad coordinates"), ("c", 4, "unknown geometry"), ("d", 0, "not a feature")]
    assert {r["property"]: r["n"] for r in f.unknown.collect()} == {"late": 1, "z": 1}
    low = elements.read_features(spark.createDataFrame([("a", 0, feature({"Ab": 1, "aB": 2, "c": 3}))], "file string, at int, t string"), "t", ["file", "at"], lowercase=True)
    assert [r.asDict() for r in low.good.select("ab", "c").collect()] == [{"ab": "1", "c": "3"}]
    none = elements.read_features(spark.createDataFrame([("a", 0, "x")], "file string, at int, t string"), "t", ["file", "at"])
    assert none.properties == [] and none.good.count() == 0 and none.failed.count() == 1


def test_casts_report_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "x", "12:00:00", "2024-02-30"), (None, "2.5", "24:00:00", "2024-02-29")], "a string, b string, c string, d string")
    got = catalog.cast_by_catalog(df, {"a": ("shape", "int:9"), "b": ("census", "int"), "c": ("shape", "time"), "d": ("portal", "calendar_date"), "e": ("portal", "money"), "c2": ("portal", "widget")})
    assert dict(got.dtypes) == {"a": "bigint", "b": "decimal(38,10)", "c": "string", "d": "timestamp", "e": "decimal(19,4)", "c2": "string", "rejects": "array<struct<column:string,value:string>>"}
    assert [[tuple(x) for x in r["rejects"]] for r in got.collect()] == [[("b", "x"), ("d", "2024-02-30")], [("c", "24:00:00")]]


def test_entity_key_is_the_first_that_is_unique(spark):
    rows = spark.range(2000).selectExpr("id % 1000 as geoid", "if(id = 7, 8, id) as geoidfq", "id as linearid", "id as tlid", "id div 1000 as vintage")
    assert catalog.entity_key(rows.drop("vintage")) == ["linearid"]  # geoidfq misses by one row, which no sketch sees
    assert catalog.entity_key(rows) == ["geoid", "vintage"]
    assert catalog.entity_key(rows.withColumn("geoid", F.expr("nullif(geoid, 3)"))) == ["linearid", "vintage"]
    assert catalog.entity_key(rows.select("vintage")) is None


def test_tags_of_every_shape(spark):
    tags = [({"name": '"A \\"b\\""', "highway": '["x","y"]', "oneway": "true", "width": "NaN", "lanes": "2", "cycleway:left:lane": '"c"', "lit": "null"},), ({"oneway": "false"},), ({},)]
    got = spark.createDataFrame(tags, "t map<string,string>").select(*catalog.tag_columns(F.col("t"))).collect()
    assert len(got[0]) == len(catalog.EDGE_TAGS) and (got[0]["name"], got[0]["highway"], got[0]["oneway"], got[0]["width"], got[0]["lanes"], got[0]["cycleway_left_lane"], got[0]["lit"]) == ('A "b"', "['x', 'y']", True, None, "2", "c", None)
    assert got[1]["oneway"] is False and got[2]["oneway"] is False and got[2]["name"] is None


def test_drift_at_any_depth(spark):
    d = T.StructType.fromDDL
    got = catalog.schema_drift(spark.range(1), d("a int, b struct<c: array<struct<d: int, e: string>>>, m map<string, int>, sys string"), d("a int, b struct<c: array<struct<d: bigint>>>, m map<string, int>, gone date"), ["sys"])
    assert sorted((r["path"], r["change"], r["severity"]) for r in got.collect()) == [("b.c[].d", "type", "error"), ("b.c[].e", "new", "error"), ("gone", "missing", "warning")]


def test_a_failed_build_leaves_the_table(spark, tmp_path):
    t = delivery.Built(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        t.read()
    t.build(spark.range(5))
    with pytest.raises(Exception, match="no good"):
        t.build(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no good")).cast("long")).otherwise(F.col("id")).alias("id")))
    assert t.read().count() == 5
    t.append(spark.range(3, 8), ["id"])
    t.append(spark.range(3, 8), ["id"])
    assert sorted(r["id"] for r in t.read().collect()) == list(range(8))
    t.build(spark.range(2))
    assert t.read().count() == 2
    with pytest.raises(delivery.Protected):
        delivery.Built(spark, str(tmp_path / "t"), protected=True).build(spark.range(1))


def test_batches_are_not_sent_twice(spark, tmp_path):
    """A task fails after the batches before it went out; the next run sends the rest only."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    broken = tmp_path / "broken"
    broken.touch()

    def send(number: int, rows: pa.Table) -> None:
        if number == 3 and broken.exists():
            broken.unlink()
            raise OSError("lost")
        with open(inbox / f"{number}", "x") as f:  # a second time would be an error
            f.write(",".join(map(str, rows.column("id").to_pylist())))

    has = lambda number: (inbox / f"{number}").exists()
    with pytest.raises(Exception, match="lost"):
        delivery.deliver(spark.range(95).repartition(5), ["id"], 10, send, has)
    assert delivery.deliver(spark.range(95).repartition(3), ["id"], 10, send, has) == 95
    assert [[int(x) for x in (inbox / f"{n}").read_text().split(",")] for n in range(10)] == [list(range(10 * n, min(10 * n + 10, 95))) for n in range(10)]
    assert delivery.deliver(spark.range(0), ["id"], 10, send, has) == 0


def test_layers_keep_their_order_and_fail_alone(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "if(id % 10 = 3, double('nan'), id * 1.0D) as x", "if(id % 10 = 4, null, 2.0D) as y", "double('inf') as w").repartition(6)
    report = delivery.export_layers({
        "all": lambda: delivery.Layer(rows, "Point", F.array("x", "y"), ["id", "w"], order=["id"]),
        "bad": lambda: 1 / 0,
        "few": lambda: delivery.Layer(rows, "LineString", F.array(F.array("x", "y"), F.array("y", "x")), ["id"], where="id > 100", order=["id"], limit=7),
    }, str(tmp_path))
    assert sorted(map(tuple, report.collect())) == [("all", 400, 100, None), ("bad", None, None, "ZeroDivisionError"), ("few", 7, 80, None)]
    read = [json.loads(x) for f in sorted((tmp_path / "all").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["properties"]["id"] for x in read] == [i for i in range(500) if i % 10 not in (3, 4)] and read[0]["properties"]["w"] is None
    few = [json.loads(x)["properties"]["id"] for f in sorted((tmp_path / "few").glob("part-*")) for x in f.read_text().splitlines()]
    assert few == [101, 102, 105, 106, 107, 108, 109]


def test_counters_ride_along(spark, tmp_path):
    counts = incremental.Counters()
    df = counts.tap(spark.range(100), even=F.col("id") % 2 == 0, none=F.lit(None).cast("boolean")).where("id > 50")
    counts.tap(df, late=F.lit(True)).write.parquet(str(tmp_path / "x"))
    assert counts.values() == {"even": 50, "none": 0, "late": 49}


def test_places_over_partitions(spark):
    got = numbered(spark.range(100).repartition(5).withColumn("w", F.col("id") * 2), ["id"], "w").collect()
    assert all(r["at"] == r["id"] and r["before_w"] == r["id"] * (r["id"] - 1) for r in got) and len(got) == 100


def test_marks(spark):
    assert incremental.parse_mark("2024-01-01T00:00:00.000000|12") == ("2024-01-01T00:00:00.000000", 12)
    assert incremental.parse_mark("a|b|3") == ("a|b", 3) and incremental.parse_mark("2024")[0] == "2024"
    assert incremental.parse_mark(None) is None and incremental.parse_mark("") is None and incremental.parse_mark("x|1", "") is None and incremental.parse_mark("x|1", "y|2") == ("y", 2)


def test_standard_names(spark):
    from geoloom.functions.text import standard_name
    from geoloom.operators.merge import staging_select

    assert [standard_name(x) for x in ("Total Pop.", "geoIDfq", "2020 Count", "a__b", "%", ":id")] == ["total_pop", "geo_idfq", "_2020_count", "a_b", "column", "id"]
    df = spark.createDataFrame([(1, 2, 3)], "`Total Pop.` int, keep int, `2020 Count` int")
    assert staging_select(df, {"Total Pop.": "pop"}, ["keep"], rest=True).columns == ["pop", "keep", "_2020_count"]


def test_names_and_defaults_of_files(spark):
    df = spark.createDataFrame([("a", 1, "x", "031")], "`:id` string, n int, `:@computed_region_z` string, COUNTYFP string")
    assert catalog.portal_columns(df, {"n": "number"}).columns == ["socrata_id", "number", "COUNTYFP"]
    row = catalog.portal_columns(df.drop(":id"), exported_at="2024-01-02").first()
    assert (row["socrata_updated_at"], row["socrata_id"], row["socrata_version"]) == ("2024-01-02", None, None)
    file = F.lit("s3://here/tl_2023_06075_roads.zip")
    assert tuple(catalog.file_defaults(df.select("n", "COUNTYFP"), file, lowercase=False).first()) == (1, "031", 2023, "06")
    assert tuple(catalog.file_defaults(df.select("n"), F.lit("tl_2023_us_state.zip")).first()) == (1, 2023, None, None)
    assert tuple(catalog.file_defaults(df.select("n"), F.lit("readme"), county=False).first()) == (1, None)


def test_damaged_geometries_fail_alone(spark):
    good = "0101000000000000000000F03F0000000000000040"
    rows = {"good": good, "null": None, "short": good[:-2], "odd": good[:-1], "text": "hello", "kind": "0163000000", "many": "0102000000FFFFFFFF" + "00" * 16, "deep": "0107000000"}
    got = {r["id"]: (r["gtype"], r["failure"]) for r in elements.decode_wkb(spark.createDataFrame(list(rows.items()), "id string, h string"), "h", "id").collect()}
    assert got == {"good": ("Point", None), "null": (None, None), "short": (None, "cut short"), "odd": (None, "not hexadecimal"), "text": (None, "not hexadecimal"), "kind": (None, "unknown geometry"), "many": (None, "cut short"), "deep": (None, "unknown geometry")}
