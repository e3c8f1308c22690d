from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from geoalloc.functions.geometry import LONLAT
from geoalloc.operators import dasymetric, raster
from geoalloc.spec import Grid, InterpolationSpec
from tests.helpers import blob, box, closed, inside, shapes

GRID = Grid(0.0, 0.0, 1.0, 1.0, tile=8)
NORTH_UP = Grid(-3.0, 30.0, 0.5, -0.5, tile=8)


def pixel_table(spark, rng, cols, rows, gaps=0.1):
    data = [(c, r, rng.choice([11, 21, 22, 24, 41, 82])) for r in range(rows) for c in range(cols) if rng.random() > gaps]
    return data, spark.createDataFrame(data, "pcol bigint, prow bigint, cls int")


def centre(grid, c, r):
    return grid.x0 + (c + 0.5) * grid.px_w, grid.y0 + (r + 0.5) * grid.px_h


@pytest.mark.parametrize("grid", [GRID, NORTH_UP])
def test_clip_count_against_point_tests(spark, grid):
    rng = random.Random(4)
    data, px = pixel_table(spark, rng, 30, 20)
    tiles = raster.reclass_raster(raster.tile_raster(px, grid))
    runs = raster.raster_runs(tiles, grid)
    dev = {(c, r) for c, r, k in data if 20 <= k <= 29}
    got = {(c, r["prow"]) for r in runs.collect() for c in range(r["c_from"], r["c_to"])}
    assert got == dev
    x0, y0 = (v + 0.0137 for v in centre(grid, 15, 10))
    size = 6 * abs(grid.px_w)
    areas = [(f"p{i}", [[blob(rng, x0 + rng.uniform(-size, size), y0 + rng.uniform(-size, size), size, rng.randint(3, 15))]])
             for i in range(12)]
    areas.append(("ring", [[box(x0 - size, y0 - size, x0 + size, y0 + size), blob(rng, x0, y0, size / 2, 9)]]))
    areas.append(("two", [[box(x0 - size, y0, x0, y0 + size)], [box(x0 + 1, y0, x0 + size, y0 + size)]]))
    s = shapes(spark, areas)
    clips = raster.clip_raster_to_geometries(runs, s, "id", grid)
    counts = {r["geom_id"]: r["dev"] for r in raster.clip_count(clips, "geom_id").collect()}
    both = raster.clip_runs(clips, raster.scan_spans(s, "id", grid, "other"))
    pairs = {(r["geom_id"], r["other"]): r["dev"] for r in raster.clip_count(both, "geom_id", "other").collect()}
    at = {i: {(c, r) for c, r in dev if inside(p, *centre(grid, c, r))} for i, p in areas}
    assert counts == {i: len(v) for i, v in at.items() if v}
    assert pairs == {(i, j): len(at[i] & at[j]) for i in at for j in at if at[i] & at[j]}
    union = {r["geom_id"]: r["dev"] for r in raster.raster_union_by_geom(clips).collect()}
    assert union == counts


def test_pixel_centres_on_a_shared_edge_go_to_one_side(spark):
    px = spark.createDataFrame([(c, r, 21) for c in range(8) for r in range(8)], "pcol bigint, prow bigint, cls int")
    runs = raster.raster_runs(raster.reclass_raster(raster.tile_raster(px, GRID)), GRID)
    parts = [("a", [[closed([(0, 0), (8, 0), (0, 8)])]]), ("b", [[closed([(8, 0), (8, 8), (0, 8)])]]),
             ("c", [[box(0, 0, 2.5, 8)]]), ("d", [[box(2.5, 0, 8, 8)]]), ("e", [[box(0, 0, 8, 3.5)]]), ("f", [[box(0, 3.5, 8, 8)]])]
    n = {r["geom_id"]: r["dev"] for r in raster.clip_count(
        raster.clip_raster_to_geometries(runs, shapes(spark, parts), "id", GRID), "geom_id").collect()}
    assert n["a"] + n["b"] == n["c"] + n["d"] == n["e"] + n["f"] == 64


def test_tiles_keep_classes_gaps_and_files(spark):
    rng = random.Random(2)
    data, px = pixel_table(spark, rng, 19, 11, gaps=0.3)
    tiles = raster.union_tiles(raster.tile_raster(px, GRID, "one"), raster.tile_raster(px, GRID, "two"))
    seen = set()
    for t in tiles.where("filename = 'two'").collect():
        assert len(t["band"]) == t["cols"] * t["rows"] and t["bits"] == 8
        for i, v in enumerate(t["band"]):
            if v != t["nodata"]:
                seen.add((t["tx"] * 8 + i % t["cols"], t["ty"] * 8 + i // t["cols"], v))
    assert seen == set(data)
    assert {r[0] for r in tiles.select("filename").distinct().collect()} == {"one", "two"}


def test_spheroidal_pixel_areas_add_up(spark):
    grid = Grid(-100.0, 40.0, 0.01, -0.01, tile=64, srid=LONLAT)
    one = spark.range(1).select(raster.pixel_area(grid, F.lit(0)).alias("a"), raster.pixel_area(grid, F.lit(1000)).alias("b")).first()
    assert one["a"] == pytest.approx(0.01 * 0.01 * 111_320 * 111_035 * 0.7660, rel=2e-3)
    assert one["b"] > one["a"]


def test_sources_across_a_tile_border_meet_only_tiles_they_share_ground_with(spark):
    px = spark.createDataFrame([(c, r, 21) for c in range(16) for r in range(16)], "pcol bigint, prow bigint, cls int")
    tiles = raster.reclass_raster(raster.tile_raster(px, GRID))
    s = shapes(spark, [("low", [[closed([(1, 1), (15, 1), (1, 15)])]]), ("in", [[box(1, 1, 7, 7)]]), ("edge", [[box(4, 4, 8, 6)]])])
    near = dasymetric.tiles_touched(s, "id", tiles, GRID, exact=False).groupBy("src_id").count()
    exact = dasymetric.tiles_touched(s, "id", tiles, GRID).groupBy("src_id").count()
    assert {tuple(r) for r in near.collect()} == {("low", 4), ("in", 1), ("edge", 2)}
    assert {tuple(r) for r in exact.collect()} == {("low", 3), ("in", 1), ("edge", 2)}


def test_dasymetric_rules(spark):
    """No developed pixel gives weight 0; pixels outside every target count below the line."""
    px = spark.createDataFrame([(c, r, 21 if c < 4 else 11) for c in range(8) for r in range(4)], "pcol bigint, prow bigint, cls int")
    tiles = raster.reclass_raster(raster.tile_raster(px, GRID))
    runs = raster.raster_runs(tiles, GRID)
    src = shapes(spark, [("dev", [[box(0, 0, 4, 4)]]), ("wild", [[box(4, 0, 8, 4)]])]).selectExpr(
        "*", "id as geoid", "100L as AQNFE001", "if(id = 'dev', 10L, null) as AQRAE001", "8L as AQM4E002")
    tgt = shapes(spark, [("half", [[box(1, 0, 3, 4)]]), ("wild", [[box(5, 0, 9, 4)]]), ("off", [[box(50, 0, 60, 4)]])]).selectExpr(
        "id as id_0", "id as name", "geom", "xmin", "ymin", "xmax", "ymax")
    got = {r["ID"]: r for r in dasymetric.dasymetric_interpolate(
        src, tgt, tiles, runs, GRID, InterpolationSpec.for_vintage(2022)).collect()}
    assert set(got) == {"half", "wild"}
    assert got["half"]["TotalPopulation"] == 50 and got["half"]["AQM4E002"] == 4 and got["half"]["PerCapitaIncome"] == 10
    assert got["half"]["DevSqKm"] == pytest.approx(8e-6) and got["half"]["PopPerDevSqKm"] == pytest.approx(50 / 8e-6)
    assert got["wild"]["TotalPopulation"] == 0 and got["wild"]["PerCapitaIncome"] is None
    one = dasymetric.dasymetric_overlap_pairs(tgt, tgt, src, tiles, runs, GRID, "AQNFE001").collect()
    assert {(r["name_1"], r["name_2"]): (r["d_pop_in_s1_s2"], r["a_pop_in_s1_s2"]) for r in one} == {
        ("half", "half"): (50.0, 50.0), ("wild", "wild"): (0.0, 75.0)}
    m = dasymetric.overlap_matrix(spark.createDataFrame(one), tgt, "name", ["half", "wild"]).collect()
    assert {(r["NAME"], r["TotalPopulation"], r["half"], r["wild"]) for r in m} == {("half", 50, 50, 0), ("wild", 0, 0, 0), (None, None, 0, 0)}
