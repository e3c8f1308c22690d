"""Small shapes, and slow independent answers to compare with."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from geoalloc.functions.geometry import GEOM_TYPE, with_box


def shapes(spark, rows, srid=0, **extra):
    """``rows``: (id, [polygon = [ring = [(x, y)]]]) to a shape table."""
    data = [(i, [[[(float(x), float(y)) for x, y in r] for r in p] for p in polys]) for i, polys in rows]
    df = spark.createDataFrame(data, "id string, polys array<array<array<struct<x:double,y:double>>>>")
    return with_box(df.withColumn("geom", F.struct(F.lit(srid).alias("srid"), "polys").cast(GEOM_TYPE)).drop("polys"))


def closed(points):
    return [*points, points[0]]


def box(x0, y0, x1, y1):
    return closed([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def blob(rng: random.Random, cx, cy, radius, n):
    """A simple ring: jittered angles about a centre."""
    angles = [2 * math.pi * (k + rng.uniform(0.1, 0.9)) / n for k in range(n)]
    reach = [radius * rng.uniform(0.4, 1) for _ in angles]
    return closed([(cx + r * math.cos(a), cy + r * math.sin(a)) for r, a in zip(reach, angles)])


def _sides(polys):
    return [(p, q) for poly in polys for ring in poly for p, q in zip(ring, ring[1:])]


def _spans(sides, x):
    ys = sorted(p[1] + (x - p[0]) * (q[1] - p[1]) / (q[0] - p[0]) for p, q in sides if (p[0] <= x) != (q[0] <= x))
    return list(zip(ys[::2], ys[1::2]))


def _common(a, b):
    return [(max(p, r), min(q, s)) for p, q in a for r, s in b if max(p, r) < min(q, s)]


def area_of(*maps):
    """Area common to all the given shapes (even-odd), by upright slabs."""
    sides = [_sides(m) for m in maps]
    every = [s for one in sides for s in one]
    xs = {p[0] for p, _ in every}
    for i, (p, q) in enumerate(every):
        for r, s in every[:i]:
            den = (q[0] - p[0]) * (s[1] - r[1]) - (q[1] - p[1]) * (s[0] - r[0])
            if den:
                t = ((r[0] - p[0]) * (s[1] - r[1]) - (r[1] - p[1]) * (s[0] - r[0])) / den
                if 0 <= t <= 1:
                    xs.add(p[0] + t * (q[0] - p[0]))
    total, xs = 0.0, sorted(xs)
    for x0, x1 in zip(xs, xs[1:]):
        spans = _spans(sides[0], (x0 + x1) / 2)
        for s in sides[1:]:
            spans = _common(spans, _spans(s, (x0 + x1) / 2))
        total += (x1 - x0) * sum(b - a for a, b in spans)
    return total


def inside(polys, x, y):
    return any(a <= y < b for a, b in _spans(_sides(polys), x))
