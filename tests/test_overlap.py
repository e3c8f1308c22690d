from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from geoalloc.functions.geometry import LONLAT, planar_area
from geoalloc.operators import areal, cells, spatial
from tests.helpers import area_of, blob, box, closed, shapes

DIAMOND = [[closed([(2, 0), (4, 2), (2, 4), (0, 2)])]]
L = [[closed([(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)])]]
RING = [[box(0, 0, 6, 6), box(2, 2, 4, 4)]]
MULTI = [[box(0, 0, 1, 1)], [box(3, 3, 5, 5)]]
TRIANGLE = [[closed([(0, 0), (4, 0), (0, 4)])]]
KNOWN = {"diamond": DIAMOND, "l": L, "ring": RING, "multi": MULTI, "triangle": TRIANGLE}


def pairs(df, *keys):
    return {tuple(r[k] for k in keys): r["area"] for r in df.collect()}


@pytest.mark.parametrize("cell", [0.5, 1.0, 8.0])
def test_known_shapes(spark, cell):
    left = shapes(spark, KNOWN.items())
    right = shapes(spark, [("b1", [[box(1, 1, 3, 3)]]), ("far", [[box(20, 20, 21, 21)]]), ("all", [[box(-9, -9, 9, 9)]])])
    got = pairs(spatial.overlap_area(left, right, "id", "id", cell=cell), "src_id", "tgt_id")
    want = {(n, "b1"): area_of(p, [[box(1, 1, 3, 3)]]) for n, p in KNOWN.items()}
    want.update({(n, "all"): area_of(p) for n, p in KNOWN.items()})
    assert set(got) == {k for k, v in want.items() if v > 0}
    for k, v in got.items():
        assert v == pytest.approx(want[k], abs=1e-9), k


def test_ring_direction_does_not_matter(spark):
    turned = [[list(reversed(box(0, 0, 6, 6))), list(reversed(box(2, 2, 4, 4)))]]
    s = shapes(spark, [("a", RING), ("b", turned)])
    got = [r[0] for r in s.select(planar_area(F.col("geom"))).collect()]
    assert got == [32.0, 32.0]
    strip = cells.area_by(cells.strips(s, "id", 1.0), "id")
    assert {r["id"]: r["area"] for r in strip.collect()} == pytest.approx({"a": 32.0, "b": 32.0})


def _random_map(rng, n, spread, size, holes=True):
    out = []
    for i in range(n):
        cx, cy = rng.uniform(0, spread), rng.uniform(0, spread)
        shell = blob(rng, cx, cy, size, rng.randint(3, 30))
        out.append((f"p{i}", [[shell]]))
    return out


@pytest.mark.parametrize("seed,cell", [(1, None), (2, 0.25), (3, 2.0)])
def test_random_polygons_against_slabs(spark, seed, cell):
    rng = random.Random(seed)
    a, b = _random_map(rng, 12, 10, 3, ), _random_map(rng, 12, 10, 2)
    # one with a hole that is itself a blob
    a.append(("holed", [[box(0, 0, 9, 9), blob(rng, 4, 4, 3, 12)]]))
    got = pairs(spatial.overlap_area(shapes(spark, a), shapes(spark, b), "id", "id", cell=cell), "src_id", "tgt_id")
    for i, p in a:
        for j, q in b:
            assert got.get((i, j), 0.0) == pytest.approx(area_of(p, q), abs=1e-9), (i, j)
    # each shape cut into cells is whole again
    own = {r["id"]: r["area"] for r in cells.area_by(cells.strips(shapes(spark, a), "id", cell or 1.0), "id").collect()}
    for i, p in a:
        assert own[i] == pytest.approx(area_of(p), abs=1e-9)


def test_vertices_and_edges_on_grid_lines(spark):
    """Whole-number shapes on a grid of side 1 hit every border case."""
    rng = random.Random(7)
    made = []
    for i in range(25):
        pts = sorted({(rng.randint(0, 5), rng.randint(0, 5)) for _ in range(9)})
        low, high = pts[0], pts[-1]
        up = [p for p in pts[1:-1] if (high[0] - low[0]) * (p[1] - low[1]) - (high[1] - low[1]) * (p[0] - low[0]) > 0]
        down = [p for p in pts[1:-1] if p not in up and (high[0] - low[0]) * (p[1] - low[1]) != (high[1] - low[1]) * (p[0] - low[0])]
        ring = closed([low, *down, high, *reversed(up)])
        if len(ring) >= 4 and area_of([[ring]]) > 0:
            made.append((f"p{i}", [[ring]]))
    s = shapes(spark, made)
    own = {r["id"]: r["area"] for r in cells.area_by(cells.strips(s, "id", 1.0), "id").collect()}
    got = pairs(spatial.overlap_area(s, s, "id", "id", cell=1.0), "src_id", "tgt_id")
    for i, p in made:
        assert own[i] == pytest.approx(area_of(p), abs=1e-9)
        for j, q in made:
            assert got.get((i, j), 0.0) == pytest.approx(area_of(p, q), abs=1e-9), (i, j)


def test_three_maps(spark):
    rng = random.Random(5)
    a, b, c = (_random_map(rng, 5, 6, 3) for _ in range(3))
    got = pairs(spatial.overlap_area_3(shapes(spark, a), shapes(spark, b), shapes(spark, c), ("id", "id", "id")),
                "id_1", "src_id", "id_2")
    for i, p in a:
        for j, q in b:
            for k, r in c:
                assert got.get((i, j, k), 0.0) == pytest.approx(area_of(p, q, r), abs=1e-9)


def test_splitting_crowded_cells_changes_nothing(spark):
    rng = random.Random(9)
    rows = _random_map(rng, 10, 6, 2)
    a = shapes(spark, [*rows, *[(f"copy{i}", rows[0][1]) for i in range(20)]])
    b, c = (shapes(spark, _random_map(rng, 10, 6, 2)) for _ in range(2))
    hot = cells.choose_cell(a, b, c, hot_rows=3)
    plain = cells.Cell(hot)
    parts = hot.hot.agg(F.max("p0"), F.max("p1"), F.max("p2")).first()
    assert parts[0] > 3 and parts[1] > 1
    for left, right, layers in ((a, b, (0, 1)), (b, a, (1, 0)), (b, c, (1, 2))):
        want = pairs(spatial.overlap_area(left, right, "id", "id", cell=plain), "src_id", "tgt_id")
        got = pairs(spatial.overlap_area(left, right, "id", "id", cell=hot, layers=layers), "src_id", "tgt_id")
        assert got == pytest.approx(want)
        boxes = {tuple(r) for r in spatial.bbox_join(left, right, "id", "id", cell=plain).select("src_id", "tgt_id").collect()}
        split = [tuple(r) for r in spatial.bbox_join(left, right, "id", "id", cell=hot, layers=layers).select("src_id", "tgt_id").collect()]
        assert len(split) == len(set(split)) and set(split) == boxes
    three = [pairs(spatial.overlap_area_3(a, b, c, ("id", "id", "id"), cell=k), "id_1", "src_id", "id_2") for k in (plain, hot)]
    assert three[0] == pytest.approx(three[1])
    assert cells.choose_cell(a, b).hot is None


def test_predicates(spark):
    left = shapes(spark, [("m", [[box(0, 0, 4, 4)]])])
    right = shapes(spark, [
        ("in", [[box(1, 1, 2, 2)]]), ("same", [[box(0, 0, 4, 4)]]), ("over", [[box(-1, -1, 9, 9)]]),
        ("cut", [[box(3, 3, 6, 6)]]), ("edge", [[box(4, 1, 6, 2)]]), ("corner", [[box(4, 4, 5, 5)]]),
        ("tip", [[closed([(4, 2), (6, 1), (6, 3)])]]), ("near", [[closed([(4.5, 5), (5, 3.9), (5, 5)])]]),
        ("hook", [[closed([(3.9, 6), (5, 6), (5, 3), (4.9, 3), (4.9, 5.9), (3.9, 5.9)])]])])
    got = {r["tgt_id"]: r for r in spatial.geometry_predicates(left, right, "id", "id").collect()}
    flags = {k: (r["intersects"], r["overlaps"], r["contains"], r["within"]) for k, r in got.items()}
    assert flags == {
        "in": (True, False, True, False), "same": (True, False, True, True), "over": (True, False, False, True),
        "cut": (True, True, False, False), "edge": (True, False, False, False), "corner": (True, False, False, False),
        "tip": (True, False, False, False), "hook": (False, False, False, False)}
    hits = {r["tgt_id"] for r in spatial.spatial_join_intersects(left, right, "id", "id").collect()}
    assert hits == set(flags) - {"hook"}
    semi = spatial.intersects_any(right, left, "id", "id").select("id").collect()
    assert {r["id"] for r in semi} == hits
    # a district inside one tract does not match; slivers of 1 % do not either
    tract = shapes(spark, [("t", [[box(0, 0, 10, 10)]])])
    d = shapes(spark, [("in", [[box(1, 1, 9, 9)]]), ("cut", [[box(5, -1, 20, 11)]]), ("sliver", [[box(9.95, -1, 20, 11)]]),
                       ("all", [[box(-1, -1, 20, 11)]])])
    kept = {r["tgt_id"] for r in spatial.spatial_join_overlaps_or_contains(tract, d, "id", "id").collect()}
    assert kept == {"cut", "all"}


def test_boxes_that_meet_but_shapes_do_not(spark):
    u = [[closed([(0, 0), (6, 0), (6, 6), (5, 6), (5, 1), (1, 1), (1, 6), (0, 6)])]]
    left, right = shapes(spark, [("u", u)]), shapes(spark, [("mid", [[box(2, 2, 4, 4)]]), ("foot", [[box(2, 1, 4, 4)]])])
    assert spatial.bbox_join(left, right, "id", "id").count() == 2
    assert [r["tgt_id"] for r in spatial.spatial_join_intersects(left, right, "id", "id").collect()] == ["foot"]


def test_interpolation_invariants(spark):
    rng = random.Random(3)
    src = shapes(spark, _random_map(rng, 15, 6, 2)).withColumn("v", F.col("xmin") + 1.0)
    tiling = shapes(spark, [(f"t{i}{j}", [[box(i * 3 - 6, j * 3 - 6, i * 3 - 3, j * 3 - 3)]]) for i in range(7) for j in range(7)])
    est = areal.areal_interpolate_extensive(src, tiling, ["v"], "id", "id")
    total = src.agg(F.sum("v")).first()[0]
    assert est.count() == 49 and est.agg(F.sum("v")).first()[0] == pytest.approx(total)
    grid = tiling.withColumn("v", F.xxhash64("id") % 100 + 0.0)
    back = areal.areal_interpolate_extensive(grid, tiling, ["v"], "id", "id")
    assert {tuple(r) for r in back.select("id", "v").collect()} == {tuple(r) for r in grid.select("id", "v").collect()}
    flat = areal.areal_interpolate_intensive(grid.withColumn("v", F.lit(7.0)), src, ["v"], "id", "id")
    assert {round(r["v"], 9) for r in flat.collect()} == {7.0}
    # two totals: all of a source that touches a target, or only the part inside
    half = shapes(spark, [("h", [[box(0, 0, 1, 2)]])])
    one = shapes(spark, [("s", [[box(0, 0, 2, 2)]])]).withColumn("v", F.lit(10.0)).withColumn("bad", F.lit(float("nan")))
    assert areal.areal_interpolate_extensive(one, half, ["v", "bad"], "id", "id").first()[1:] == (10.0, 0.0)
    assert areal.areal_interpolate_extensive(one, half, ["v"], "id", "id", allocate_total=False).first()["v"] == 5.0


def test_no_nested_loops_in_spatial_plans(spark):
    rng = random.Random(1)
    a, b = (shapes(spark, _random_map(rng, 4, 6, 2)) for _ in range(2))
    for df in (spatial.overlap_area(a, b, "id", "id"), spatial.spatial_join_intersects(a, b, "id", "id"),
               spatial.overlap_area_3(a, b, a, ("id", "id", "id"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_cell_size_is_bounded(spark):
    tiny = [(f"s{i}", [[box(i * 0.001, 0, i * 0.001 + 0.001, 0.001)]]) for i in range(50)]
    s, big = shapes(spark, tiny), shapes(spark, [("b", [[box(0, 0, 1000, 1000)]])])
    cell = cells.choose_cell(s, big)
    assert cells.box_cells(big, cell, "id").count() < 10_000
    got = pairs(spatial.overlap_area(s, big, "id", "id"), "src_id", "tgt_id")
    assert len(got) == 50 and sum(got.values()) == pytest.approx(50e-6)


def coast(rng, cx, cy, radius, n):
    """A ring whose outline wiggles on every scale, and stays near a circle."""
    reach = [radius * (1 + 0.1 * math.sin(7 * a) + 0.5 / n * rng.uniform(-1, 1)) for a in (2 * math.pi * k / n for k in range(n))]
    return closed([(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k, r in enumerate(reach)])


def test_candidates_grow_with_edges(spark):
    rng, seen = random.Random(11), []
    for n in (500, 2000, 4000):
        a = shapes(spark, [(f"a{i}", [[coast(rng, 10 * i, 0, 6, n)]]) for i in range(3)])
        b = shapes(spark, [(f"b{i}", [[coast(rng, 10 * i + 4, 3, 6, n)]]) for i in range(3)])
        cell = cells.choose_cell(a, b)
        left, right = (cells.strips(x, "id", cell) for x in (a, b))
        keys = [*cells.CELL, *cells.BIN]
        met = cells._binned(left, cell, "array(0, 1)", "array(0)").join(cells._binned(right, cell, "array(0)", "array(1)").select(keys), keys)
        seen.append(met.count())
    assert seen[1] <= 2.5**2 * seen[0] and seen[2] <= 2.5 * seen[1], seen


@pytest.mark.parametrize("n", [8, 64])
def test_polygons_above_one_another_are_not_summed(spark, n):
    """Flat boxes piled up in one cell: each goes on with the two it meets, not with all of the pile."""
    h = 8 / n
    a = shapes(spark, [(str(i), [[box(0, i * h, 8, (i + 1) * h)]]) for i in range(n)])
    # the last shape has a part at either end of the pile
    b = shapes(spark, [(str(i), [[box(1, (i + 0.5) * h, 7, (i + 1.5) * h)]]) for i in range(n - 1)] + [("ends", [[box(0, 0, 1, h / 2)], [box(7, 8 - h / 2, 8, 8)]])])
    left, right = cells.strips(a, "id", 8.0), cells.strips(b, "id", 8.0)
    met = cells._paired(left, right.withColumnRenamed("id", "r"), ["r"], 8.0, (0, 1))
    assert met.count() <= 12 * n
    assert cells.intersect_strips(left, right.withColumnRenamed("id", "r"), ["r"], 8.0).count() <= 12 * n
    want = {(str(i + k), str(i)): 3 * h for i in range(n - 1) for k in (0, 1)} | {("0", "ends"): h / 2, (str(n - 1), "ends"): h / 2}
    assert pairs(spatial.overlap_area(a, b, "id", "id", cell=8.0), "src_id", "tgt_id") == pytest.approx(want)


def test_latitudes_beyond_the_poles_are_not_folded_back(spark):
    """Shapes meet as they do in lon/lat: the ground at 100 degrees has the size of that at 80, but is not it."""
    boxes = {"north": (79, 80), "over": (100, 101), "across": (89, 91), "round": (439, 440), "south": (-80, -79), "under": (-101, -100), "cap": (89, 90)}
    s = shapes(spark, [(k, [[box(0, y0, 1, y1)]]) for k, (y0, y1) in boxes.items()], srid=LONLAT)
    got = pairs(spatial.overlap_area(s, s, "id", "id", srid=LONLAT), "src_id", "tgt_id")
    assert set(got) == {(k, k) for k in boxes} | {("across", "cap"), ("cap", "across")}
    area = {k: got[k, k] for k in boxes}
    assert all(area[k] == pytest.approx(area["north"], rel=1e-9) for k in ("over", "round", "south", "under"))
    assert area["across"] == pytest.approx(2 * area["cap"], rel=1e-9) and got["across", "cap"] == pytest.approx(area["cap"], rel=1e-9)
