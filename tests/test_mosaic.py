"""Coverages of several origins and pixel sizes, held against tests of single pixel centres."""

from __future__ import annotations

import math
import random

import pytest

from geoalloc.functions.geometry import LONLAT
from geoalloc.operators import dasymetric, mosaic, raster
from geoalloc.spec import Grid, InterpolationSpec
from tests.helpers import blob, box, inside, shapes

GRIDS = {"z": Grid(0.0, 0.0, 1.0, 1.0, tile=8), "a": Grid(14.3, 22.1, 0.75, -0.75, tile=8), "m": Grid(-5.2, -4.1, 2.5, 2.5, tile=8)}


def centre(g, c, r):
    return g.x0 + (c + 0.5) * g.px_w, g.y0 + (r + 0.5) * g.px_h


def made(spark, rng, gaps=0.2):
    data = {(f, c, r): rng.choice([11, 21, 24, 82]) for f in GRIDS for c in range(20) for r in range(20) if rng.random() > gaps}
    return data, spark.createDataFrame([(*k, v) for k, v in data.items()], "filename string, pcol bigint, prow bigint, cls int")


def counting(data):
    """Developed pixels whose centre is in no pixel of an earlier file."""
    names, out = list(GRIDS), set()
    for (f, c, r), k in data.items():
        x, y = centre(GRIDS[f], c, r)
        earlier = names[:names.index(f)]
        held = any((e, math.floor((x - g.x0) / g.px_w), math.floor((y - g.y0) / g.px_h)) in data for e in earlier for g in [GRIDS[e]])
        if 20 <= k <= 29 and not held:
            out.add((f, c, r))
    return out


def test_tiles_have_the_grid_of_their_file(spark):
    data, px = made(spark, random.Random(1))
    seen = {}
    for t in mosaic.tile_files(px, GRIDS).collect():
        g = GRIDS[t["filename"]]
        for i, v in enumerate(t["band"]):
            if v != t["nodata"]:
                x, y = t["ulx"] + (i % t["cols"] + 0.5) * t["px_w"], t["uly"] + (i // t["cols"] + 0.5) * t["px_h"]
                seen[t["filename"], round((x - g.x0) / g.px_w - 0.5), round((y - g.y0) / g.px_h - 0.5)] = v
    assert seen == data
    with pytest.raises(Exception, match="no grid for the file"):
        mosaic.tile_files(px, {"a": GRIDS["a"]}).collect()
    with pytest.raises(ValueError, match="one tile side"):
        mosaic.tile_files(px, {"a": GRIDS["a"], "b": Grid(0.0, 0.0, 1.0, 1.0, tile=16)})


def test_ground_covered_twice_counts_for_the_first_file(spark):
    data, px = made(spark, random.Random(2))
    tiles = mosaic.tile_files(px, GRIDS)
    names = list(GRIDS)
    got = [(names[r["file"]], c, r["prow"]) for r in mosaic.mosaic_runs(tiles, GRIDS).collect() for c in range(r["c_from"], r["c_to"])]
    want = counting(data)
    assert len(got) == len(set(got)) and set(got) == want and {f for f, _, _ in want} == set(GRIDS)
    one = mosaic.mosaic_runs(tiles.where("filename = 'a'"), {"a": GRIDS["a"]})
    assert sum(r["c_to"] - r["c_from"] for r in one.collect()) == sum(f == "a" and 20 <= k <= 29 for (f, _, _), k in data.items())
    assert mosaic.mosaic_runs(tiles.where("false"), GRIDS).count() == 0


def test_clips_and_weights_against_point_tests(spark):
    rng = random.Random(3)
    data, px = made(spark, rng)
    dev = counting(data)
    areas = {k: [(f"{k}{i}", [[blob(rng, rng.uniform(0, 25), rng.uniform(0, 20), size, rng.randint(3, 12))]]) for i in range(8)] for k, size in (("s", 5), ("t", 9))}
    areas["s"].append(("s_far", [[box(500, 500, 501, 501)]]))
    src, tgt = (shapes(spark, areas[k]) for k in "st")
    tiles = mosaic.tile_files(px, GRIDS)
    runs = mosaic.mosaic_runs(tiles, GRIDS)
    at = {i: {p for p in dev if inside(polys, *centre(GRIDS[p[0]], *p[1:]))} for k in "st" for i, polys in areas[k]}

    def ground(pixels):
        return sum(abs(GRIDS[f].px_w * GRIDS[f].px_h) for f, _, _ in pixels)

    clips = raster.clip_runs(runs, mosaic.mosaic_spans(src, "id", tiles, GRIDS, "src_id"))
    got = {r["src_id"]: (r["dev"], r["dev_area_m2"]) for r in mosaic.ground(clips, GRIDS, "src_id").collect()}
    assert set(got) == {i for i, p in at.items() if i[0] == "s" and p}
    assert all(n == len(at[i]) and m2 == pytest.approx(ground(at[i])) for i, (n, m2) in got.items())
    weights = mosaic.mosaic_weights(src, tgt, tiles, runs, GRIDS, "id", "id")
    rows = {(r["src_id"], r["tgt_id"]): r for r in weights.collect()}
    shared = {(i, j) for i in at for j in at if i[0] == "s" and j[0] == "t" and at[i] & at[j]}
    assert shared <= set(rows) and len(shared) > 10
    for (i, j), r in rows.items():
        assert r["dev_in_both"] == len(at[i] & at[j]) and r["dev_in_source"] == len(at[i])
        assert r["rast_wgt"] == pytest.approx(ground(at[i] & at[j]) / ground(at[i]) if at[i] else 0)
        assert r["rast_area_m2"] > 0 or not at[i] & at[j]
    people = src.selectExpr("*", "id as geoid", "100L as AQNFE001", "10L as AQRAE001")
    out = {r["ID"]: r for r in dasymetric.dasymetric_interpolate(people, tgt.selectExpr("*", "id as name"), tiles, runs, GRIDS["z"],
           InterpolationSpec.for_vintage(2022), tgt_id="id", weights=weights).collect()}
    assert all(out[j]["TotalPopulation"] == int(sum(100 * r["rast_wgt"] for (_, t), r in rows.items() if t == j) + 1e-9) for j in out)


def test_spheroidal_ground_of_two_pixel_sizes(spark):
    grids = {"wide": Grid(-100.0, 40.0, 0.01, -0.01, tile=8, srid=LONLAT), "fine": Grid(-99.9, 40.0, 0.005, -0.005, tile=8, srid=LONLAT)}
    px = spark.createDataFrame([("wide", c, r, 21) for c in range(4) for r in range(2)] + [("fine", c, r, 21) for c in range(8) for r in range(4)],
                               "filename string, pcol bigint, prow bigint, cls int")
    tiles = mosaic.tile_files(px, grids)
    m2 = {r["file"]: r["dev_area_m2"] for r in mosaic.ground(mosaic.mosaic_runs(tiles, grids), grids, "file").collect()}
    assert m2[0] == pytest.approx(m2[1], rel=1e-9) and m2[0] == pytest.approx(8 * 0.01 * 0.01 * 111_320 * 111_035 * 0.7660, rel=2e-3)
