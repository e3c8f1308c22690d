"""Outlines of areas: repair, shared borders, simplification, GeoJSON."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoalloc.functions.geometry import BOX, EQUIDISTANT, GEOM_TYPE, LONLAT, project, tidy, with_box
from geoalloc.operators import cells, noding
from geoalloc.sources.writers import stored

RING_SCHEMA = "id string, poly int, ring int, xs array<double>, ys array<double>"


def rings(shapes: DataFrame, id: str) -> DataFrame:
    """One row per ring: ``id, poly, ring, xs, ys``."""
    return (shapes.selectExpr(f"`{id}` as id", "posexplode(geom.polys) as (poly, rs)")
            .selectExpr("id", "poly", "posexplode(rs) as (ring, pts)")
            .selectExpr("id", "poly", "ring", "pts.x as xs", "pts.y as ys"))


def _with_rings(shapes: DataFrame, id: str, ring_rows: DataFrame) -> DataFrame:
    """Shapes with their points replaced by the given rings."""
    polys = ring_rows.selectExpr("id", "poly", "ring", "transform(xs, (x, i) -> struct(x as x, ys[i] as y)) as pts").groupBy(
        "id", "poly").agg(F.expr("transform(sort_array(collect_list(struct(ring, pts))), r -> r.pts)").alias("rs"))
    geoms = polys.groupBy(F.col("id").alias(id)).agg(
        F.expr("transform(sort_array(collect_list(struct(poly, rs))), p -> p.rs)").alias("__polys"))
    srid = F.col("geom.srid").alias("srid")
    j = shapes.join(geoms, id, "left")
    g = F.struct(srid, F.coalesce("__polys", F.col("geom.polys")).alias("polys")).cast(GEOM_TYPE)
    return with_box(j.withColumn("geom", g)).select(*shapes.columns)


# --- repair ----------------------------------------------------------------

def repair_geometries(shapes: DataFrame, id: str) -> DataFrame:
    """Closes rings, drops repeated points and rings without area, and turns polygons
    whose rings cross or touch themselves, or cross one another, into simple loops with
    even-odd ground. Rings that do not meet stay shell and holes as they are given.

    ``repaired`` marks those; it is null for a shape that stays as it was because
    roundings of its crossings contradict one another. Rings of repaired shapes start at
    their least point, shells counter-clockwise, holes clockwise. Edges meet in bins
    of their own size; loops are traced in tables (``noding``).
    """
    clean = with_box(shapes.withColumn("geom", tidy(F.col("geom"))))
    meetings = stored(noding.polygon_meetings(clean, id).selectExpr("id", "poly", *(f"{s}_{c}" for s in "ab" for c in ("ring", "i", "x1", "y1", "x2", "y2")), "cuts", "tangled"))
    bad = stored(meetings.where("tangled").select("id").distinct())
    if bad.isEmpty():
        return clean.withColumn("repaired", F.lit(False))
    e = noding.polygon_edges(clean.join(bad.withColumnRenamed("id", id), id, "left_semi"), id)
    loops, lost = noding.untangled(e, meetings.join(bad, "id", "left_semi"))
    loops = loops.selectExpr("id", "struct(poly, part) as poly", "ring", "xs", "ys")
    marks = bad.join(lost.withColumn("repaired", F.lit(False)), "id", "left").selectExpr(f"id as `{id}`", "repaired is null as repaired", "true as tangled")
    rows = clean.join(marks, id, "left")
    fixed = _with_rings(rows.where("repaired").withColumn("geom", F.struct("geom.srid", F.array().cast("array<array<array<struct<x:double,y:double>>>>").alias("polys"))), id, loops)
    rest = rows.where("repaired is null or not repaired").withColumn("repaired", F.when(F.col("tangled").isNull(), F.lit(False)))
    return rest.select(*clean.columns, "repaired").unionByName(fixed.select(*clean.columns, "repaired"))


# --- borders ---------------------------------------------------------------

def shared_edges(shapes: DataFrame, id: str, quantize: int | None = None) -> DataFrame:
    """Borders and the areas on them: ``ax, ay, bx, by, id, sharers``.

    One row per area on an edge, so a border with very many areas stays spread
    out. ``quantize`` first snaps points to that many steps along each axis of
    the map; edges that shrink to a point fall out.
    """
    e = cells.edges(shapes, id)
    if quantize:
        b = shapes.agg(F.min("xmin").alias("x0"), F.min("ymin").alias("y0"), F.max("xmax").alias("x1"), F.max("ymax").alias("y1")).first()
        for axis in "xy":
            lo, hi = b[f"{axis}0"], b[f"{axis}1"]
            step = (hi - lo) / (quantize - 1) if hi is not None and hi > lo else 1.0
            e = e.withColumns({f"{axis}{k}": F.rint((F.col(f"{axis}{k}") - lo) / step) for k in (1, 2)})
        e = e.where("x1 <> x2 or y1 <> y2")
    flip = "(x1 > x2 or (x1 = x2 and y1 > y2))"
    edge = ["ax", "ay", "bx", "by"]
    e = e.selectExpr(f"if({flip}, x2, x1) as ax", f"if({flip}, y2, y1) as ay",
                     f"if({flip}, x1, x2) as bx", f"if({flip}, y1, y2) as by", f"id as {id}").distinct()
    return e.join(e.groupBy(*edge).agg(F.count("*").alias("sharers")).hint("merge"), edge)


def _thinned(xy: np.ndarray, tol: float) -> np.ndarray:
    """Douglas-Peucker on one chain, walked in the same direction by both neighbours."""
    ends = (xy[0].tolist(), xy[-1].tolist()) if (xy[0] != xy[-1]).any() else (xy[1].tolist(), xy[-2].tolist())
    flip = ends[0] > ends[1]
    p = xy[::-1] if flip else xy
    keep = np.zeros(len(p), dtype=bool)
    keep[[0, -1]] = True
    todo = [(0, len(p) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        q, line = p[a + 1:b] - p[a], p[b] - p[a]
        length = np.hypot(*line)
        if length == 0:
            dist = np.hypot(q[:, 0], q[:, 1])
        else:
            along = np.clip((q @ line) / length ** 2, 0, 1)
            dist = np.hypot(*(q - along[:, None] * line).T)
        k = int(dist.argmax())
        if dist[k] > tol:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    out = p[keep]
    return out[::-1] if flip else out


def _thin_ring(xs, ys, stops, tol: float) -> np.ndarray:
    xy = np.column_stack([xs, ys])
    body = xy[:-1]
    if len(stops) == 0:
        first = int(np.lexsort((body[:, 1], body[:, 0]))[0])
        far = int(np.hypot(*(body - body[first]).T).argmax())
        stops = [first, far]
    stops = sorted(set(int(s) for s in stops))
    turn = np.roll(body, -stops[0], axis=0)
    cuts = [s - stops[0] for s in stops] + [len(body)]
    turn = np.vstack([turn, turn[:1]])
    parts = [_thinned(turn[a:b + 1], tol)[:-1] for a, b in zip(cuts, cuts[1:])]
    out = np.vstack([*parts, turn[:1]])
    return out if len(out) >= 4 else xy


def simplify(shapes: DataFrame, id: str, tolerance_m: float = 10.0, srid: int = LONLAT) -> DataFrame:
    """Thins outlines by ``tolerance_m``, so that neighbours stay matched.

    Borders are cut at junctions, the points with other than two neighbours over
    the whole map. The chain between two junctions is thinned the same way from
    both of its sides. Lon/lat shapes are thinned on the equidistant plane. A
    ring that would shrink to less than a triangle keeps its points.
    """
    plane = project(shapes, EQUIDISTANT, LONLAT) if srid == LONLAT else shapes
    r = rings(plane, id)
    v = (r.selectExpr("id", "poly", "ring", "xs", "ys", "size(xs) - 1 as n", "explode(sequence(0, size(xs) - 2)) as i")
         .selectExpr("id", "poly", "ring", "i", "xs[i] as x", "ys[i] as y",
                     "struct(xs[pmod(i - 1, n)] as x, ys[pmod(i - 1, n)] as y) as before", "struct(xs[i + 1] as x, ys[i + 1] as y) as after"))
    ends = v.selectExpr("x", "y", "explode(array(before, after)) as q")
    junctions = ends.groupBy("x", "y").agg(F.count_distinct("q").alias("degree")).where("degree <> 2").select("x", "y")
    stops = v.join(junctions.hint("merge"), ["x", "y"]).groupBy("id", "poly", "ring").agg(F.expr("sort_array(collect_list(i))").alias("stops"))
    work = r.join(stops, ["id", "poly", "ring"], "left").selectExpr(
        "cast(id as string) as id", "poly", "ring", "xs", "ys", "coalesce(stops, cast(array() as array<int>)) as stops")

    def thin(batches):
        for pdf in batches:
            done = [_thin_ring(x, y, s, tolerance_m) for x, y, s in zip(pdf["xs"], pdf["ys"], pdf["stops"])]
            yield pdf.assign(xs=[d[:, 0] for d in done], ys=[d[:, 1] for d in done]).drop(columns="stops")

    thinned = work.mapInPandas(thin, RING_SCHEMA)
    keyed = plane.withColumn("__id", F.col(id)).withColumn(id, F.col(id).cast("string"))
    out = _with_rings(keyed, id, thinned).drop(id).withColumnRenamed("__id", id).select(*shapes.columns)
    return project(out, LONLAT, EQUIDISTANT) if srid == LONLAT else out


# --- GeoJSON ---------------------------------------------------------------

def geojson_geometry(geom: Column, maxdec: int = 6) -> Column:
    """GeoJSON text of a geometry, coordinates rounded."""
    coords = F.transform(geom["polys"], lambda poly: F.transform(poly, lambda ring: F.transform(
        ring, lambda p: F.array(F.round(p.x, maxdec), F.round(p.y, maxdec)))))
    single = F.concat(F.lit('{"type":"Polygon","coordinates":'), F.to_json(coords[0]), F.lit("}"))
    multi = F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json(coords), F.lit("}"))
    return F.when(F.size(geom["polys"]) == 1, single).otherwise(multi)


def to_geojson_features(shapes: DataFrame, maxdec: int = 6, keep: Sequence[str] = ()) -> DataFrame:
    """``feature``: one GeoJSON feature per shape, all other columns as properties."""
    props = [c for c in shapes.columns if c not in ("geom", *BOX)]
    text = F.concat(F.lit('{"type":"Feature","geometry":'), geojson_geometry(F.col("geom"), maxdec), F.lit(',"properties":'),
                    F.to_json(F.struct(*props), {"ignoreNullFields": "false"}), F.lit("}"))
    return shapes.select(*keep, text.alias("feature"))


def collect_features(features: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One FeatureCollection document per key (or one in all), as a single value.

    For maps that are wanted as a value; ``write_feature_collections`` writes
    documents of any size without holding one in memory.
    """
    body = F.concat(F.lit('{"type":"FeatureCollection","features":['),
                    F.array_join(F.sort_array(F.collect_list("feature")), ","), F.lit("]}"))
    return features.groupBy(*by).agg(body.alias("collection"))
