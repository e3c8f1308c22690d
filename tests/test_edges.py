"""Edges met in bins, contacts along long borders, and tangled polygons against even-odd slabs."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from geoalloc.functions.geometry import planar_area
from geoalloc.operators import edges, noding, outlines, spatial
from geoalloc.sources.writers import stored
from tests.helpers import area_of, box, closed, shapes


def tangle(rng, kind):
    def ring(n):
        if kind < 2:  # on a lattice: shared corners, edges on one another, spikes
            return closed([(rng.randrange(8), rng.randrange(8)) for _ in range(n)])
        return closed([(rng.random() * 10, rng.random() * 10) for _ in range(n)])

    if kind in (0, 2):
        return [[ring(rng.randrange(3, 14))]]
    if kind in (1, 3):
        return [[ring(rng.randrange(3, 9)) for _ in range(rng.randrange(1, 4))]]
    return [[ring(rng.randrange(20, 40))], [box(20, 20, 25, 25), box(21, 21, 23, 23)]]


def test_tangled_polygons_keep_their_even_odd_ground(spark):
    rng = random.Random(3)
    rows = [(str(k), tangle(rng, k % 5)) for k in range(100)]
    out = stored(outlines.repair_geometries(shapes(spark, rows), "id"))
    got = {r["id"]: r for r in out.withColumn("area", planar_area(F.col("geom"))).collect()}
    assert len(got) == len(rows) and sum(r["repaired"] for r in got.values()) > 70
    for i, polys in rows:
        if got[i]["repaired"]:  # rings that do not meet stay shell and holes as given
            assert got[i]["area"] == pytest.approx(sum(area_of([p]) for p in polys), abs=1e-8)
            for shell, *holes in got[i]["geom"]["polys"]:
                for ring in (shell, *holes):
                    points = [(p["x"], p["y"]) for p in ring]
                    # simple: closed, no point twice, from the least one
                    assert points[0] == points[-1] == min(points) and len(set(points)) == len(points) - 1 > 2
    # loops may touch in points, but nothing crosses any more
    assert noding.edge_meetings(noding.polygon_edges(out.where("id % 5 > 1"), "id")).where("tangled").count() == 0


def test_rings_that_cancel_and_rings_in_rings(spark):
    square, back = box(0, 0, 4, 4), [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]
    rows = [
        ("twice", [[square, square]]), ("both ways", [[square, back]]), ("thrice", [[square, back, square]]),
        ("spike", [[closed([(0, 0), (4, 0), (4, 2), (9, 2), (4, 2), (4, 4), (0, 4)])]]),
        ("touch", [[square, closed([(0, 2), (2, 1), (2, 3)])]]),  # a hole that touches in a point is fine
        ("across", [[square, box(2, 2, 6, 6)]]), ("nested", [[closed([(0, 0), (9, 0), (9, 9), (0, 9)]), box(1, 1, 8, 8), box(2, 2, 7, 7), closed([(3, 3), (6, 6), (6, 3), (3, 6)])]]),
    ]
    out = outlines.repair_geometries(shapes(spark, rows), "id")
    got = {r["id"]: (r["repaired"], r["a"], [len(p) for p in r["geom"]["polys"]]) for r in out.withColumn("a", planar_area(F.col("geom"))).collect()}
    assert got["twice"] == got["both ways"] == (True, 0.0, []) and got["thrice"] == (True, 16.0, [1])
    assert got["spike"] == (True, 16.0, [1]) and got["touch"] == (False, 14.0, [2])
    assert got["across"][0] and got["across"][1] == pytest.approx(24.0) and got["across"][2] == [1, 1]
    assert got["nested"][0] and got["nested"][1] == pytest.approx(81 - 49 + 25 - 4.5) and sorted(got["nested"][2]) == [2, 3]
    nothing = shapes(spark, rows).where("false")
    assert outlines.repair_geometries(nothing, "id").count() == 0


def outline(kind, n):
    """A ring of n edges: round, saw-toothed, a comb of long teeth, or crossing itself all along."""
    if kind == "round":
        return closed([(math.cos(2 * math.pi * k / n), math.sin(2 * math.pi * k / n)) for k in range(n)])
    if kind == "saw":
        return closed([((1 + k % 2 / n) * math.cos(2 * math.pi * k / n), (1 + k % 2 / n) * math.sin(2 * math.pi * k / n)) for k in range(n)])
    if kind == "comb":
        return closed([(k // 2, 0 if k % 4 in (0, 3) else n) for k in range(n - 2)] + [(n, -1), (-1, -1)])
    wave = [(k, math.sin(k)) for k in range(n // 2)]
    return closed(wave + [(x, -y / 2 + 0.01) for x, y in reversed(wave)])


@pytest.mark.parametrize("kind", ["round", "saw", "comb", "plait"])
def test_candidates_follow_the_edges(spark, kind):
    sizes = (1000, 2000, 4000)
    e = noding.polygon_edges(shapes(spark, [(str(n), [[outline(kind, n)]]) for n in sizes]), "id").drop("least")
    many = {int(r["id"]): r["count"] for r in edges.candidates(e, e, noding.POLY).groupBy("id").count().collect()}
    assert all(many[2 * n] <= 2.5 * many[n] for n in sizes[:2]) and many[4000] < 200 * 4000


def test_a_long_plait_is_untangled(spark):
    rows = [("p", [[outline("plait", 600)]])]
    out = outlines.repair_geometries(shapes(spark, rows), "id").withColumn("a", planar_area(F.col("geom"))).first()
    assert out["repaired"] and len(out["geom"]["polys"]) > 90 and out["a"] == pytest.approx(area_of(rows[0][1][0:1]), rel=1e-9)


def test_contacts_along_a_border_are_linear(spark):
    """Two neighbours with one border of n edges that only one of them halves."""
    many = {}
    for n in (500, 1000, 2000):
        border = [(0.1 * math.sin(9 * k / n), k / n) for k in range(n + 1)]
        left = shapes(spark, [("l", [[closed([*border, (-5, 1), (-5, 0)])]])])
        right = shapes(spark, [("r", [[closed([*border[::2], (5, 1), (5, 0)])]])])
        pairs = spatial.bbox_join(left, right, "id", "id", cell=0.5)
        a, b = spatial.border_edges(pairs, left, right, "id", "id", spatial.PAIR, 0.5)
        many[n] = edges.candidates(a, b, [*spatial.PAIR, "cx", "cy"]).count()
        assert [tuple(r) for r in spatial._contacts(pairs, left, right, "id", "id", spatial.PAIR, 0.5).collect()] == [("l", "r")]
    assert many[1000] <= 2.5 * many[500] and many[2000] <= 2.5 * many[1000] and many[2000] < 60_000


def meets(p, q):
    def turn(a, b, c):
        v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return (v > 0) - (v < 0)

    (a, b), (c, d) = p, q
    boxes = all(min(a[k], b[k]) <= max(c[k], d[k]) and min(c[k], d[k]) <= max(a[k], b[k]) for k in (0, 1))
    return boxes and turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0


def test_meeting_edges_against_all_pairs(spark):
    rng = random.Random(11)

    def some(n, span):
        return [((x := rng.uniform(-20, 20), y := rng.uniform(-20, 20)), (x + rng.uniform(-span, span), y + rng.uniform(-span, span) * rng.choice([0, 0.01, 1]))) for _ in range(n)]

    left, right = some(60, 0.5) + some(20, 30), some(60, 3) + [((0, 0), (0, 5)), ((0, 2), (3, 2))]
    left += [((0, 1), (0, 2)), ((3, 2), (9, 9))]

    def table(rows):
        df = spark.createDataFrame([(i, *map(float, (*p, *q))) for i, (p, q) in enumerate(rows)], "n int, x1 double, y1 double, x2 double, y2 double")
        return edges.with_class(df.withColumn("least", F.lit(0.25))).drop("least").withColumn("k", F.lit(1))

    a, b = table(left), table(right)
    of = {s: t.select(F.struct("sx", "sy").alias("c")).distinct().agg(F.collect_list("c").alias("other")) for s, t in (("a", a), ("b", b))}
    met = edges.with_turns(edges.meeting(a.crossJoin(of["b"]), b.crossJoin(of["a"]), ["k"])).where(edges.HAVE_A_POINT)
    got = [(r.a_n, r.b_n) for r in met.select("a_n", "b_n").collect()]
    want = [(i, j) for i, p in enumerate(left) for j, q in enumerate(right) if meets(p, q)]
    assert sorted(got) == want and len(want) > 8
