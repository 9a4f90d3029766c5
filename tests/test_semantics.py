"""Behaviours that a naive rewrite gets wrong, one test each."""

import heapq
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geoloom.functions import text as T
from geoloom.functions.geo import line_line, oriented_line, point_line
from geoloom.functions.rules import oneway_fits
from geoloom.operators import catalog, geocode, graph, incremental, merge, quality, routing
from geoloom.operators.components import connected_components
from geoloom.sources import elements, export
from geoloom.streaming import logs

CLEAN = [
    ("  123  N  Main St ,  Chicago , IL ", "123 N MAIN ST, CHICAGO, IL"),
    ("1 a st", "1 A ST"),
    ("5\tb  ave,il", "5 B AVE,IL"),
    ("", ""),
]


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize("raw, want", CLEAN)
def test_clean_address(spark, raw, want):
    assert one(spark, a=T.clean_address(F.lit(raw)))["a"] == want


def test_q26_blank_parts_are_missing(spark):
    n = lambda *p: one(spark, a=T.normalize_address(*[F.lit(x).cast("string") for x in p]), h=T.address_hash(*[F.lit(x).cast("string") for x in p]))
    assert n("x", "1 a st", " ", None, "60601")["a"] == "1 A ST, 60601"
    assert n(" ", "", None, " ", None)["h"] is None
    assert n("raw  addr", "", None, " ", None)["a"] == "RAW ADDR"


def history(spark, batches, **how):
    h = merge.scd2_start(spark.createDataFrame(batches[0], "k int, v string"), ["k"], "2024-01-01")
    for i, b in enumerate(batches[1:], 2):
        h = merge.scd2_merge(h, spark.createDataFrame(b, "k int, v string"), ["k"], f"2024-0{i}-01", **how)
    return h


def test_q1_reverted_value_is_not_current(spark):
    batches = [[(1, "a")], [(1, "b")], [(1, "a")]]
    assert merge.current(history(spark, batches)).count() == 0
    assert [r["v"] for r in merge.current(history(spark, batches, reopen_reverted=True)).collect()] == ["a"]


def test_q2_two_values_of_one_key_are_both_current(spark):
    batches = [[(1, "a")], [(1, "b"), (1, "c")]]
    assert sorted(r["v"] for r in merge.current(history(spark, batches)).collect()) == ["b", "c"]
    assert [r["v"] for r in merge.current(history(spark, batches, dedupe_order=["v"])).collect()] == ["b"]


def test_q3_null_key_is_an_error(spark):
    with pytest.raises(Exception, match="null in an entity key"):
        history(spark, [[(1, "a")], [(None, "b")]]).collect()


def test_q4_null_and_empty_hash_alike(spark):
    assert history(spark, [[(1, "")], [(1, None)]]).count() == 1


def test_scd2_is_idempotent_and_counts(spark):
    h = history(spark, [[(1, "a"), (2, "b")], [(1, "x"), (2, "b"), (3, "c")], [(1, "x"), (2, "b"), (3, "c")]])
    assert h.count() == 4
    assert merge.as_of(h, "2024-01-15").count() == 2
    before = merge.scd2_start(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], "2024-01-01")
    batch = spark.createDataFrame([(1, "x")], "k int, v string")
    assert tuple(merge.merge_counts(before, merge.scd2_merge(before, batch, ["k"], "2024-02-01"), batch).first()) == (1, 1, 1)
    gone = merge.scd2_merge(before, batch, ["k"], "2024-02-01", invalidate_missing=True)
    assert merge.current(gone).count() == 1


def test_q27_key_twice_in_an_upsert(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="twice"):
        merge.upsert(t, s, ["k"]).collect()
    assert merge.upsert(t, s, ["k"], dedupe_order=[F.desc("v")]).first()["v"] == "c"


def test_q8_low_azimuth_fits_every_letter(spark):
    fits = lambda way, letter, a: one(spark, f=oneway_fits(F.lit(way), F.lit(letter).cast("string"), F.lit(float(a))))["f"]
    assert fits("1W", "S", 10) is True and fits("1W", "-", 10) is None and fits("1W", "W", 100) is False and fits("2W", "-", 100) is True and fits("1W", "N", 330) is True


def test_q20_null_passes_unless_told(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    check = [("positive", F.col("v") > 0, "error")]
    assert quality.row_checks(df, check).first()["failures"] == 1
    assert quality.row_checks(df, check, null_is_failure=True).first()["failures"] == 2


def test_q21_drift(spark):
    got = {tuple(r) for r in catalog.schema_drift(spark.range(1), StructType.fromDDL("a int, new int"), StructType.fromDDL("a int, old int")).select("path", "change").collect()}
    assert got == {("new", "new"), ("old", "missing")}
    with pytest.raises(ValueError, match="new"):
        merge.align_to_target(spark.createDataFrame([(1, 2)], "a int, new int"), {"a": "int"}, on_extra="error")


def test_watermark_ties_go_by_id(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (3, "2024-01-02"), (2, "2024-01-02"), (9, None)], "id int, t string").withColumn("t", F.col("t").cast("timestamp"))
    m = incremental.pair_mark(df, "t", "id").first()
    assert m["mark"] == "2024-01-02T00:00:00.000000|3"
    assert [r["id"] for r in incremental.incremental_filter(df, "t", "id", m["mark_value"], 2).collect()] == [3]


def test_distances(spark):
    line = F.expr("array(named_struct('x', 0D, 'y', 0D), named_struct('x', 2D, 'y', 0D), named_struct('x', 2D, 'y', 2D))")
    other = F.expr("array(named_struct('x', 1D, 'y', -1D), named_struct('x', 1D, 'y', 1D))")
    r = one(spark, a=point_line(F.lit(1.0), F.lit(1.0), line), b=point_line(F.lit(3.0), F.lit(3.0), line), c=line_line(line, other))
    assert r["a"] == 1.0 and abs(r["b"] - math.sqrt(2)) < 1e-12 and r["c"] == 0.0


def test_oriented_line_flips_legs(spark):
    legs = F.expr("array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D)), array(named_struct('x', 2D, 'y', 0D), named_struct('x', 1D, 'y', 0D)))")
    assert [p["x"] for p in one(spark, a=oriented_line(legs))["a"]] == [0, 1, 2]


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (200, 200), (None, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 200}


def test_q14_q16_turn_aware_routes_are_least(spark):
    """Against a search over (node, previous node) states."""
    n = 5
    nodes = [(r * n + c, float(c), float(r)) for r in range(n) for c in range(n)]
    edges = [(a[0], b[0], 100.0 + (a[0] * 7 + b[0] * 3) % 50, ["residential", "primary", "cycleway"][(a[0] + b[0]) % 3]) for a in nodes for b in nodes if abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1]
    e = spark.createDataFrame(edges, "u int, v int, cost double, highway string")
    penalties = graph.turn_penalties(e, spark.createDataFrame(nodes, "osmid int, x double, y double"))
    p = {(r["a"], r["b"], r["c"]): r["penalty"] for r in penalties.collect()}
    # east then north is a left turn
    assert p[0, 1, 6] > 0 and p[5, 6, 1] == 0
    cost = {(u, v): c for u, v, c, _ in edges}

    def least(o, d):
        heap, done = [(0.0, o, None)], set()
        while heap:
            c, x, prev = heapq.heappop(heap)
            if x == d:
                return c
            if (x, prev) in done:
                continue
            done.add((x, prev))
            for (u, v), w in cost.items():
                if u == x:
                    heapq.heappush(heap, (c + w + (p.get((prev, x, v), 0.0) if prev is not None else 0.0), v, x))
        return None

    asked = [(i, i, (i * 7) % 25) for i in range(25)] + [(99, 3, 999)]
    got = {r["pair"]: r for r in routing.route_batch(spark.createDataFrame(asked, "pair int, origin int, destination int"), e, penalties, spark.createDataFrame(nodes, "osmid int, x double, y double"), 6).collect()}
    for pair, o, d in asked[:-1]:
        assert abs(got[pair]["cost"] - (least(o, d) if o != d else 0)) < 1e-6
    assert got[99]["cost"] is None


def test_merge_chains_follow_to_the_end(spark):
    step = 0.0001
    nodes = spark.createDataFrame([(i, step * i, 0.0, "0") for i in range(1, 5)], "osmid int, x double, y double, layer string")
    edges = spark.createDataFrame([(8, 9, "0", None, None)], "u int, v int, layer string, bridge string, tunnel string")
    got = {r["drop"]: r["keep"] for r in graph.near_merge_map(nodes, edges, 12.0, 0.0).collect()}
    assert got == {2: 1, 3: 1, 4: 1}


def test_geocode_outcomes(spark):
    ranges = spark.createDataFrame([(1, "MAIN", "ST", "N", 100, 198, 0, 0.0, 0.0, 1.0, 1.0)], "segment_id int, street string, street_type string, direction string, from_number int, to_number int, parity int, x0 double, y0 double, x1 double, y1 double")
    cache = spark.createDataFrame([("a", "100 N Main St", None, None), ("b", "150 S Main St", None, "error: x"), ("c", "1 Oak Ave", None, None), ("d", "101 S MAIN ST", None, None), ("e", "100 N MAIN ST", 1.0, None), ("f", "100 N MAIN ST", None, "no_result")], "address_hash string, address string, latitude double, failure string")
    got = {r["address_hash"]: r for r in geocode.geocode(cache, ranges, 10).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    assert got["a"]["rating"] == 0 and got["a"]["latitude"] == 0 and got["b"]["rating"] == 5
    assert got["c"]["failure"] == "no_result" and got["d"]["failure"] == "below_threshold:rating_15"


def test_csv_rules(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a|b\n" x "|\n"l1\nl2"|2\n')
    got = [tuple(r) for r in elements.read_csv(spark, str(tmp_path / "a.csv"), "|").collect()]
    assert got == [(" x ", None), ("l1\nl2", "2")]


def test_features(spark):
    rows = ['{"type":"Feature","properties":{"name":"a","value":1,"more":2},"geometry":{"type":"Point","coordinates":[1,2]}}', '{"type":"Feature","properties":{"name":"b"}}', "junk"]
    df = spark.createDataFrame([(r,) for r in rows], "f string")
    got = elements.parse_features(df, "f", {"name": "string", "value": "int"}).collect()
    assert [(r["name"], r["value"], r["is_valid"]) for r in got] == [("a", 1, True), ("b", None, False), (None, None, False)]
    assert [tuple(r) for r in elements.unknown_properties(df, "f", ["name", "value"]).collect()] == [("more", 1)]


def test_geometry_of_every_kind(spark):
    import struct

    point = struct.pack("<BIIdd", 1, 1 | 0x20000000, 4326, 1.5, 2.5).hex()
    polygon = (struct.pack(">BII", 0, 3, 1) + struct.pack(">I", 3) + struct.pack(">6d", 0, 0, 1, 0, 0, 1)).hex()
    multi = (struct.pack("<BII", 1, 4, 1) + struct.pack("<BIdd", 1, 1, 3.0, 4.0)).hex()
    df = spark.createDataFrame([("a", point), ("b", polygon), ("c", multi), ("d", None)], "id string, h string")
    got = {r["id"]: r for r in elements.decode_wkb(df, "h", "id").collect()}
    assert (got["a"]["gtype"], got["a"]["srid"], got["a"]["parts"][0][0]["y"]) == ("Point", 4326, 2.5)
    assert got["b"]["gtype"] == "Polygon" and len(got["b"]["parts"][0]) == 3 and got["b"]["srid"] == 0
    assert got["c"]["gtype"] == "MultiPoint" and got["c"]["parts"][0][0]["x"] == 3.0 and got["d"]["gtype"] is None


def test_simplify(spark):
    import numpy as np

    x, y = np.arange(6.0), np.array([0, 0.1, 0, 5, 0, 0])
    assert export.simplify_points(x, y, 0.5).tolist() == [True, False, True, True, True, True]


def test_late_requests_land_once(spark, tmp_path):
    """More files than a few batches take, newest first, with repeats in the same and in other batches."""
    import datetime
    import json
    import os

    (tmp_path / "in").mkdir()
    at = lambda i: (datetime.datetime(2024, 3, 28, tzinfo=datetime.UTC) - datetime.timedelta(hours=6 * i)).isoformat(timespec="microseconds")
    for i in range(320):
        lines = [{"request_id": f"r{k}", "server_timestamp": at(k), "source_ip": "x"} for k in (i, i, i // 3)] + [{"server_timestamp": at(i)}]
        f = tmp_path / "in" / f"{i:03d}.json"
        f.write_text("\n".join(map(json.dumps, lines)))
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    logs.land(logs.route_log_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch").distinct().count() == 4
    assert sorted(r["request_id"] for r in got.where("request_id is not null").collect()) == sorted(f"r{i}" for i in range(320))
    assert got.where("request_id is null").count() == 320


def test_registered_routes_are_complete(spark, monkeypatch):
    """The registered query over near and far requests against a search over (node, previous node) states."""
    import os

    from geoloom.plans import graph as plans

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    edges, penalties = plans._routing(spark, sf)
    out, p = {}, {(r["a"], r["b"], r["c"]): r["penalty"] for r in penalties.collect()}
    for r in edges.select("u", "v", "cost").collect():
        out.setdefault(r["u"], []).append((r["v"], r["cost"]))

    def least(o, d):
        heap, done = [(0.0, o, -1)], set()
        while heap:
            c, x, prev = heapq.heappop(heap)
            if x == d:
                return c
            if (x, prev) not in done:
                done.add((x, prev))
                for v, w in out.get(x, ()):
                    if prev < 0 or (prev, x, v) in p:
                        heapq.heappush(heap, (c + w + p.get((prev, x, v), 0.0), v, x))
        return None

    asked = [(i, i * 5 % 200, (i * 83 + 49) % 200) for i in range(40)] + [(40, 0, 49), (41, 49, 50), (42, 7, 7)]
    monkeypatch.setattr(plans, "_requests", lambda *_: spark.createDataFrame(asked, "pair long, origin long, destination long"))
    rows = plans._routes(spark, sf).collect()
    assert len(rows) == len(asked) and max(len(r["path"]) for r in rows if r["path"]) > 40
    cost = {(u, v): w for u, to in out.items() for v, w in to}
    for r in rows:
        want = least(r["origin"], r["destination"])
        assert (r["cost"] is None) == (want is None), r
        if want is not None:
            assert abs(r["cost"] - want) < 1e-3, r
            walk = sum(cost[e] for e in zip(r["path"], r["path"][1:])) + sum(p[t] for t in zip(r["path"], r["path"][1:], r["path"][2:]))
            assert abs(walk - want) < 1e-3


def test_label_names(spark):
    """Structural segments in any case, filler words, short forms, repeated words, cut at words, codes as they are."""
    from geoloom.functions.labels import compress_labels

    concept = "MEANS OF TRANSPORTATION TO WORK (BLACK OR AFRICAN AMERICAN ALONE)"
    rows = [
        ("B08105B_001E", "Estimate!!Total:", concept),
        ("B08105B_004M", "Margin of Error!!TOTAL:!!Public transportation (excluding taxicab):", concept),
        ("B08105B_002E", "Annotation of Estimate!!Total:!!Car, truck, or van - drove alone", "Sex by sex"),
        ("B24012_010E", "Estimate!!Total:!!" + "management " * 3 + "business science and arts occupations computer engineering", concept),
        ("B00001_001E", "Estimate!!" + " ".join(f"word{i}" for i in range(20)), "C"),
        ("C24010_003E", "Estimate!!Total:!!Male:!!Management, business, science, and arts occupations:", "SEX BY OCCUPATION FOR THE CIVILIAN EMPLOYED POPULATION 16 YEARS AND OVER"),
        ("B05001_002E", "Estimate!!Total:!!U.S. citizen, born in the United States", "NATIVITY AND CITIZENSHIP STATUS IN THE UNITED STATES"),
        ("B00001_001EA", "x", "y"),
        ("B00001_002E", None, None),
    ]
    got = {r[0]: r[1] for r in compress_labels(spark.createDataFrame(rows, "variable string, label string, concept string")).collect()}
    assert got["B08105B_001E"] == "transpo_work_blk_afr_amer_aln__tot_est_B08105B_001E"
    assert got["B08105B_004M"].endswith("__pub_transpo_excl_taxi_moe_B08105B_004M")
    assert got["B08105B_002E"] == "sex__car_truck_van_drv_aln_est_B08105B_002E"
    assert got["B00001_002E"] == "tot_est_B00001_002E"
    # by the published rules, counted by hand: the concept gives way at a word, down to 63 characters
    assert got["C24010_003E"] == "sex_occ_civ_emp_pop_16__m_mgmt_bus_sci_arts_occ_est_C24010_003E" and len(got["C24010_003E"]) == 63
    assert got["B05001_002E"] == "nativity_ctzn_stat__us_ctzn_brn_united_states_est_B05001_002E"
    assert got["B00001_001E"].startswith("word0_word1_") and got["B00001_001E"].endswith("_est_B00001_001E")
    assert "B00001_001EA" not in got and all(len(x) <= 63 for x in got.values())


def test_side_tags(spark):
    """The right side, then both, the plain tag and the left side; buffers and separations of any side count."""
    from geoloom.operators.network import classify

    names = ["cycleway_right", "cycleway_both", "cycleway", "cycleway_left", "highway", "bicycle", "bicycle_road", "cyclestreet", "lit"]
    names += [f"cycleway_{s}{t}" for s in ("left_", "right_", "both_", "") for t in ("buffer", "separation", "shared_lane")]
    cases = [{"cycleway_both": "lane", "cycleway_left": "track"}, {"cycleway_left": "track"}, {"cycleway_right": "lane", "cycleway_left_separation": "kerb"}, {"cycleway_right_buffer": "yes"}, {"cycleway_both_shared_lane": "yes"}, {"cycleway": "lane", "cycleway_left": "track"}]
    df = spark.createDataFrame([(i, *[c.get(n) for n in names]) for i, c in enumerate(cases)], "id int, " + ", ".join(f"{n} string" for n in names))
    got = {r["id"]: (r["infra_category"], r["infra_type"]) for r in classify(df, keep_all=True).collect()}
    assert got == {0: ("on_road", "bike_lane"), 1: ("separated", "track"), 2: ("separated", "protected_lane"), 3: ("on_road", "buffered_lane"), 4: ("shared", "sharrow"), 5: ("on_road", "bike_lane")}


def test_partial_load_merges_and_raises(spark):
    from geoloom.operators import incremental as I
    from geoloom.operators import merge as M

    target = spark.createDataFrame([(1, "old"), (2, "old")], "id long, v string")

    def broken():
        raise OSError("no answer")

    pages = [lambda: spark.createDataFrame([(2, "new"), (3, "new")], "id long, v string"), broken, lambda: spark.createDataFrame([(4, "late")], "id long, v string")]
    with pytest.raises(I.PartialLoad) as e:
        I.merge_pages(pages, target, lambda old, new: M.upsert(old, new, ["id"]))
    assert "no answer" in str(e.value) and {tuple(r) for r in e.value.merged.collect()} == {(1, "old"), (2, "new"), (3, "new")}


def test_run_units_keeps_a_log(spark, tmp_path):
    from geoloom.operators import incremental as I

    path = f"{tmp_path}/log"
    seen = I.run_units(spark, path, "portal", "incremental", {"a": lambda: {"rows_staged": 5, "rows_merged": 4, "high_water_mark": "2024"}, "b": lambda: 1 / 0, "c": lambda: None})
    assert [(r["unit"], r["status"]) for r in seen.collect()] == [("a", "success"), ("b", "failed"), ("c", "success")]
    I.run_units(spark, path, "portal", "full", {"d": lambda: {}})
    log = {r["unit"]: r for r in spark.read.parquet(path).collect()}
    assert set(log) == set("abcd") and log["a"]["rows_merged"] == 4 and "division" in log["b"]["error"] and log["d"]["completed_at"] >= log["d"]["started_at"]


def test_nearest_node_far_away(spark):
    from geoloom.operators.spatial import nearest_node

    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.1, 0.0)], "osmid long, x double, y double")
    points = spark.createDataFrame([(7, 60.0, 10.0), (8, 0.09, 0.0), (9, None, 1.0)], "id long, px double, py double")
    assert {r["id"]: r["osmid"] for r in nearest_node(points, nodes, "id").collect()} == {7: 2, 8: 2}


def test_nearest_nodes_of_far_points(spark):
    """Clustered nodes, points in, around and very far from them: nobody meets all nodes, all get the nearest."""
    import random

    from geoloom.operators.spatial import nearest_node

    rng = random.Random(8)
    nodes = [(i, round(rng.choice([-88.0, -87.5, 3.0]) + rng.random() * 0.02, 6), round(41.8 + rng.random() * 0.02, 6)) for i in range(300)] + [(900, None, 1.0)]
    points = [(i, round(rng.uniform(-89, 5), 5), round(rng.uniform(40, 44), 5)) for i in range(60)] + [(100, -5000.0, 70.0), (101, 400.0, -4000.0), (102, nodes[5][1], nodes[5][2]), (103, None, 2.0)]
    got = {r["k"]: (r["distance"], r["osmid"]) for r in nearest_node(spark.createDataFrame(points, "k int, px double, py double"), spark.createDataFrame(nodes, "osmid int, x double, y double"), "k").collect()}
    want = {k: min((round(math.sqrt((x - a) ** 2 + (y - b) ** 2), 9), i) for i, a, b in nodes if a is not None) for k, x, y in points if x is not None}
    assert got.keys() == want.keys() and all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-8 for k in want)
    assert nearest_node(spark.createDataFrame(points, "k int, px double, py double"), spark.createDataFrame([], "osmid int, x double, y double"), "k").count() == 0


def test_routes_on_one_way_streets(spark):
    """A directed network without any order, in cells of five nodes: costs and paths against a search over states."""
    import random

    rng = random.Random(4)
    nodes = [(i, rng.random(), rng.random()) for i in range(45)]
    edges = {(u, v): round(rng.uniform(0, 40), 3) for u in range(40) for v in rng.sample(range(45), 3) if u != v}
    rows = [(u, v, c, rng.choice(["primary", "residential", "path"])) for (u, v), c in edges.items()]
    e = spark.createDataFrame(rows, "u int, v int, cost double, highway string")
    n = spark.createDataFrame(nodes, "osmid int, x double, y double")
    penalties = graph.turn_penalties(e, n)
    p = {(r["a"], r["b"], r["c"]): r["penalty"] for r in penalties.collect()}

    def least(o, d):
        heap, done = [(0.0, o, -1)], set()
        while heap:
            c, x, prev = heapq.heappop(heap)
            if x == d:
                return c
            if (x, prev) not in done:
                done.add((x, prev))
                for (u, v), w in edges.items():
                    if u == x:
                        heapq.heappush(heap, (c + w + (p[prev, x, v] if prev >= 0 else 0.0), v, x))
        return None

    asked = [(i, i * 7 % 45, i * 11 % 45) for i in range(45)] + [(50, 42, 3), (51, 3, 3), (52, 3, 10), (53, 3, 10), (54, None, 3)]
    got = routing.route_batch(spark.createDataFrame(asked, "pair int, origin int, destination int"), e, penalties, n, 5).collect()
    assert sorted(r["pair"] for r in got) == sorted(a[0] for a in asked)
    for r in got:
        want = None if r["origin"] is None else least(r["origin"], r["destination"])
        assert (r["cost"] is None) == (want is None) == (r["path"] is None), r
        if want is not None:
            path = r["path"]
            walk = sum(edges[s] for s in zip(path, path[1:])) + sum(p[t] for t in zip(path, path[1:], path[2:]))
            assert path[0] == r["origin"] and path[-1] == r["destination"] and abs(r["cost"] - want) < 1e-6 and abs(walk - want) < 1e-6


def test_address_ranges_of_all_widths(spark):
    """Ranges from one number to millions wide against all pairs; the join goes by cells of numbers, not by streets alone."""
    import random

    rng = random.Random(3)
    spans = [(a, a + rng.choice([0, 1, 98, 255, 256, 5000, 3_000_000])) for a in (rng.randrange(20000) for _ in range(80))] + [(9, 3), (0, 2**31 - 1)]
    ranges = [(i, "MAIN", "ST", rng.choice("NS"), a, b, rng.choice([0, 1, None]), 0.0, 0.0, 1.0, 1.0) for i, (a, b) in enumerate(spans)]
    r = spark.createDataFrame(ranges, "segment_id int, street string, street_type string, direction string, from_number int, to_number int, parity int, x0 double, y0 double, x1 double, y1 double")
    cache = [(f"{n}{d}{i}", f"{n} {d}Main St", None, None) for n in [0, 1, *(rng.randrange(40000) for _ in range(60))] for d in ("N ", "") for i in range(2)]
    out = geocode.geocode(spark.createDataFrame(cache, "address_hash string, address string, latitude double, failure string"), r, 99)
    got = {row["address_hash"]: row["rating"] for row in out.collect()}
    rate = lambda n, d, s: (5 if d.strip() != s[3] else 0) + (10 if s[6] is not None and s[6] != n % 2 else 0)
    for key, text, _, _ in cache:
        n, d = int(text.split()[0]), "N" if " N " in text else ""
        assert got[key] == min((rate(n, d, s) for s in ranges if s[4] <= n <= s[5]), default=None), text
    assert "_cell" in out._jdf.queryExecution().optimizedPlan().toString()


def test_graph_union_where_ids_meet(spark, tmp_path):
    """Supplement ids that are lattice ids too: one row for each id, in the query and in its SQL."""
    import duckdb

    from geoloom.plans import graph as plans

    spark.range(999_990, 1_000_060).withColumnRenamed("id", "p_partkey").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    spark.range(90).withColumnRenamed("id", "s_suppkey").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    duck = duckdb.connect()
    for t in ("part", "supplier"):
        duck.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    got = sorted(map(tuple, plans.graph_union(spark, str(tmp_path)).select("osmid", "highway", "layer").collect()), key=str)
    assert got == sorted(duck.execute(f"select osmid, highway, layer from ({plans.SQL['graph_union']})").fetchall(), key=str)
    assert len(got) == len({r[0] for r in got}) == 100


def test_edges_are_made_by_many_tasks(spark, tmp_path):
    """A file with one row group must not make one task of all edges."""
    from geoloom.plans import lattice

    spark.range(500).withColumnRenamed("id", "p_partkey").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    edges = lattice.edges(spark, str(tmp_path)).select("u")
    assert edges.rdd.glom().filter(lambda rows: len(rows) > 50).count() > 1


def test_last_edges_are_dealt_to_enough_tasks(spark, monkeypatch):
    """A task's share of edges is bounded: more edges make more tasks, not larger ones."""
    rows = [(i % 300, i % 7, i % 2, f"n{i}") for i in range(900)]
    monkeypatch.setattr(graph, "TASK_EDGES", 50, raising=False)
    out = graph.last_edge_wins(spark.createDataFrame(rows, "u int, v int, key int, name string"))
    assert out.rdd.getNumPartitions() == 18
    want = {}
    for u, v, key, name in rows:
        want[u, v] = max(want.get((u, v), (-1, "")), (key, name))
    assert {(r["u"], r["v"]): (r["key"], r["name"]) for r in out.collect()} == want


def _one_street(spark):
    line = "array(named_struct('x', 0D, 'y', 0D), named_struct('x', 0.001D, 'y', 0D))"
    return spark.range(1).selectExpr("1L as u", "2L as v", "0L as key", "'Main' as name", f"{line} as line")


def test_crashes_at_one_place_are_added_up_before_the_join(spark):
    from geoloom.operators import network

    flags = [f"0 as injuries_{k}" for k in ("fatal", "incapacitating", "non_incapacitating", "not_evident")]
    crashes = spark.range(50).selectExpr("(id % 5) * 0.0001D as px", "0D as py", "timestamp'2024-01-01' as crash_date", *flags)
    out = network.crash_scores(_one_street(spark), crashes, 0.0004, "2024-01-01")
    assert [(r["crash_count"], round(r["crash_score"], 9)) for r in out.collect()] == [(50, 50.0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2


def test_routes_alike_are_joined_once(spark):
    """Of routes alike in all but their id the first is chosen, and only it meets the edges."""
    from geoloom.operators import network

    routes = _one_street(spark).selectExpr("'Bike Lane' as display_route_type", "'2W' as bike_route_oneway", "cast(null as string) as bike_route_oneway_dir", "'MAIN' as street_name", "line as route", "explode(sequence(7L, 60L)) as route_segment_id")
    out = network.best_routes(_one_street(spark), routes, 0.00015)
    assert [r["route_segment_id"] for r in out.collect()] == [7]
    assert "Aggregate" in out._jdf.queryExecution().optimizedPlan().toString()


def test_streets_of_small_parts_stay_in_one_cell(spark):
    """Rows of streets without links between them: no request needs a round, all arrive; larger parts are still cut."""
    n = spark.createDataFrame([(i, float(i % 10), float(i // 10)) for i in range(60)], "osmid int, x double, y double")
    e = spark.createDataFrame([(i, j, 1.0) for i in range(60) for j in (i - 1, i + 1) if 0 <= j < 60 and i // 10 == j // 10], "u int, v int, cost double")
    cells = {r["node"]: r for r in routing.linked_cells(routing.node_cells(n, 3), e, 3).collect()}
    assert len(cells) == 60 and all(r["whole"] and r["component"] == k // 10 * 10 and r["cell"] == cells[k // 10 * 10]["cell"] for k, r in cells.items())
    assert not any(r["whole"] for r in routing.linked_cells(routing.node_cells(n, 2), e, 2).collect())
    turns = spark.createDataFrame([(i - k, i, i + j, 0.0) for i in range(60) for k in (-1, 1) for j in (-1, 1)], "a int, b int, c int, penalty double")
    asked = [(i * 60 + j, i, j) for i in range(0, 60, 7) for j in range(60)]
    got = routing.route_batch(spark.createDataFrame(asked, "pair int, origin int, destination int"), e, turns, n, 3).collect()
    assert {r["pair"]: (r["cost"], r["path"]) for r in got} == {p: (float(abs(o - d)), list(range(o, d + 1)) or list(range(o, d - 1, -1))) if o // 10 == d // 10 else (None, None) for p, o, d in asked}
