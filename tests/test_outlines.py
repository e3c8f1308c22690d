from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from geoalloc.functions.geometry import (
    EQUAL_AREA, EQUIDISTANT, LONLAT, MERCATOR, geodesic_area, planar_area, project,
)
from geoalloc.operators import outlines, spatial
from geoalloc.sources import writers
from tests.helpers import area_of, blob, box, closed, shapes


def ring(df, i):
    g = df.where(F.col("id") == i).first()["geom"]
    return [(p["x"], p["y"]) for p in g["polys"][0][0]]


def test_repair(spark):
    tied = [[closed([(0, 0), (4, 4), (4, 0), (0, 4)])]]
    at_vertex = [[closed([(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4)])]]
    inline_hole = [[closed([(0, 0), (9, 0), (9, 9), (5, 9), (5, 5), (4, 5), (4, 6), (5, 6), (5, 9), (0, 9)])]]
    s = shapes(spark, [
        ("open", [[[(0, 0), (2, 0), (2, 0), (2, 2), (0, 2)]]]), ("tied", tied), ("vertex", at_vertex),
        ("flat", [[closed([(0, 0), (1, 1), (2, 2)])]]), ("fine", [[box(0, 0, 3, 3), box(1, 1, 2, 2)]]),
        ("inline", inline_hole)])
    out = outlines.repair_geometries(s, "id")
    got = {r["id"]: (r["repaired"], r["a"], r["n"]) for r in out.select(
        "id", "repaired", planar_area(F.col("geom")).alias("a"), F.size("geom.polys").alias("n")).collect()}
    assert got["open"] == (False, 4.0, 1) and got["fine"] == (False, 8.0, 1) and got["flat"] == (False, 0.0, 0)
    assert got["tied"] == (True, 8.0, 2) and got["vertex"] == (True, 8.0, 2)
    assert got["inline"][0] and got["inline"][1] == pytest.approx(80.0)
    whole = shapes(spark, [("w", [[box(-9, -9, 20, 20)]])])
    o = {r["src_id"]: r["area"] for r in spatial.overlap_area(out, whole, "id", "id").collect()}
    assert o["tied"] == pytest.approx(8.0) and o["inline"] == pytest.approx(80.0)


def test_projections(spark):
    s = shapes(spark, [("a", [[box(-100, 30, -99, 31)]])], srid=LONLAT)
    m = project(s, MERCATOR).first()
    assert m["xmin"] == pytest.approx(-11131949.0793, abs=1e-3) and m["ymin"] == pytest.approx(3503549.8435, abs=1e-3)
    for srid in (MERCATOR, EQUIDISTANT):
        back = project(project(s, srid), LONLAT, srid)
        assert ring(back, "a") == [pytest.approx(p, abs=1e-9) for p in box(-100, 30, -99, 31)]
    # the equal-area plane keeps spheroidal areas; a degree box has a known area
    e = project(s, EQUAL_AREA).select(planar_area(F.col("geom"))).first()[0]
    g = s.select(geodesic_area(F.col("geom"))).first()[0]
    assert e == pytest.approx(g, rel=1e-12) and g == pytest.approx(1.0633e10, rel=2e-3)
    globe = shapes(spark, [("g", [[box(-180, -90, 180, 90)]])], srid=LONLAT)
    assert globe.select(geodesic_area(F.col("geom"))).first()[0] == pytest.approx(510065621724088.44, rel=1e-9)


def test_small_cells_on_the_spheroid(spark):
    """Slanted edges of county size: cut into 1/64 or taken whole, the area is the same to 1e-8."""
    rng = random.Random(8)
    s = shapes(spark, [("a", [[blob(rng, -90, 45, 0.1, 9)]]), ("b", [[blob(rng, -150, 65, 0.1, 9)]])], srid=LONLAT)
    whole = {r[0]: r[1] for r in s.select("id", geodesic_area(F.col("geom"))).collect()}
    fine = project(s, EQUAL_AREA, step=0.002)
    cut = {r[0]: r[1] for r in fine.select("id", planar_area(F.col("geom"))).collect()}
    for k in whole:
        assert cut[k] == pytest.approx(whole[k], rel=1e-6)
    o = spatial.overlap_area(s, s, "id", "id", srid=LONLAT).where("src_id = tgt_id").collect()
    assert {r["src_id"]: r["area"] for r in o} == pytest.approx(whole, rel=1e-5)


def _wavy(n, y, shift, rng):
    return [(x * 10.0 / n + shift, y + rng.uniform(-0.002, 0.002)) for x in range(1, n)]


def test_simplify_keeps_neighbours_matched(spark):
    rng = random.Random(6)
    border = [(0, 5), *[(x, 5 + rng.uniform(-1, 1)) for x in range(1, 10)], (10, 5)]
    low = closed([(0, 0), (5, 0.001), (10, 0), *reversed(border)])
    high = closed([*border, (10, 10), (5, 10.001), (0, 10)])
    island = blob(rng, 30, 30, 3, 40)
    s = shapes(spark, [("low", [[low]]), ("high", [[high]]), ("isle", [[island]])])
    out = outlines.simplify(s, "id", 0.5, srid=0)
    total = out.where("id <> 'isle'").agg(F.sum(planar_area(F.col("geom")))).first()[0]
    assert total == pytest.approx(100, abs=0.02)
    meet = spatial.overlap_area(out, out, "id", "id").where("src_id = 'low' and tgt_id = 'high'").count()
    assert meet == 0
    a, b = ring(out, "low"), ring(out, "high")
    shared = {p for p in a} & {p for p in b}
    assert {(0.0, 5.0), (10.0, 5.0)} <= shared and len(shared) < 11 and (5.0, 0.001) not in a
    assert shared == {p for p in a if 3 < p[1] < 7} == {p for p in b if 3 < p[1] < 7}
    isle = ring(out, "isle")
    assert 4 <= len(isle) < 41 and isle[0] == isle[-1] and area_of([[isle]]) == pytest.approx(area_of([[island]]), rel=0.2)
    assert outlines.simplify(s, "id", 0.0, srid=0).where("id = 'isle'").select(planar_area(F.col("geom"))).first()[0] == pytest.approx(
        area_of([[island]]))


def test_simplify_in_metres_on_the_globe(spark):
    bump = 5 / 111_000
    s = shapes(spark, [("a", [[closed([(-90, 40), (-89.5, 40 + bump), (-89, 40), (-89, 41), (-90, 41)])]])], srid=LONLAT)
    assert len(ring(outlines.simplify(s, "id", 2000.0), "a")) == 5
    assert len(ring(outlines.simplify(s, "id", 0.5), "a")) == 6


def test_shared_edges(spark):
    s = shapes(spark, [("a", [[box(0, 0, 1, 1)]]), ("b", [[box(1, 0, 2, 1)]]), ("c", [[box(5, 5, 6, 6)]])])
    e = outlines.shared_edges(s, "id").where("sharers > 1").collect()
    assert {r["id"] for r in e} == {"a", "b"} and {(r["ax"], r["ay"], r["bx"], r["by"]) for r in e} == {(1, 0, 1, 1)}
    q = outlines.shared_edges(s, "id", quantize=4).collect()
    assert all(float(v).is_integer() and 0 <= v <= 3 for r in q for v in (r["ax"], r["ay"], r["bx"], r["by"]))


def test_geojson_features(spark):
    s = shapes(spark, [("a", [[box(0, 0, 1 / 3, 1)]]), ("m", [[box(0, 0, 1, 1)], [box(2, 2, 3, 3)]])]).withColumn(
        "pop", F.expr("if(id = 'a', 5, null)"))
    f = outlines.to_geojson_features(s)
    got = {json.loads(r["feature"])["properties"]["id"]: json.loads(r["feature"]) for r in f.collect()}
    assert got["a"]["geometry"]["coordinates"][0][1] == [0.333333, 0.0] and got["a"]["properties"]["pop"] == 5
    assert got["m"]["geometry"]["type"] == "MultiPolygon" and got["m"]["properties"] == {"id": "m", "pop": None}
    c = json.loads(outlines.collect_features(f).first()["collection"])
    assert c["type"] == "FeatureCollection" and len(c["features"]) == 2
    assert math.isclose(got["a"]["geometry"]["coordinates"][0][2][1], 1.0)


def test_quantized_map_that_ends_at_zero(spark):
    for shift in (0, -10):
        m = shapes(spark, [("a", [[box(shift, shift, shift + 10, shift + 10)]]), ("b", [[box(shift, shift, shift + 0.05, shift + 0.04)]])])
        got = outlines.shared_edges(m, "id", quantize=101).agg(F.max("bx"), F.max("by")).first()
        assert tuple(got) == (100.0, 100.0)


def test_holes_of_a_split_ring_stay_in_their_part(spark):
    bow = closed([(0, 0), (8, 8), (8, 0), (0, 8)])  # two triangles that meet at (4, 4)
    m = shapes(spark, [("bow", [[bow, box(0.5, 3.5, 1.5, 4.5), box(6.5, 3.5, 7.5, 4.5)]])])
    polys = outlines.repair_geometries(m, "id").first().geom.polys
    assert len(polys) == 2 and all(len(rings) == 2 for rings in polys)
    for shell, hole in polys:
        assert min(p.x for p in shell) <= min(p.x for p in hole) and max(p.x for p in hole) <= max(p.x for p in shell)


def test_collections_are_written_whole(spark, tmp_path):
    features = spark.createDataFrame([(i % 2, json.dumps({"type": "Feature", "n": i})) for i in range(51)], "state int, feature string")
    writers.write_feature_collections(features, str(tmp_path / "out"), "state")
    for state in (0, 1):
        files = [f for f in (tmp_path / "out" / f"state={state}").iterdir() if f.suffix == ".txt"]
        assert len(files) == 1
        found = json.loads(files[0].read_text())
        assert found["type"] == "FeatureCollection" and sorted(f["n"] for f in found["features"]) == list(range(state, 51, 2))
