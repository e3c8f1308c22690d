"""Spatial joins and overlap areas of two or three maps.

All joins are equi-joins on grid cells; ids and boxes travel, polygons do not.
Inputs are shape tables with ``geom`` and its box. Results are keyed by
``names``, by default ``src_id`` and ``tgt_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoalloc.functions.geometry import BOX, EQUAL_AREA, LONLAT, planar_area, project
from geoalloc.operators import cells, edges
from geoalloc.sources.writers import stored

PAIR = ("src_id", "tgt_id")
#: Cut of lon/lat edges, in degrees, before areas are taken on the equal-area plane.
EDGE_STEP = 0.05


def on_area_plane(shapes: DataFrame, srid: int) -> DataFrame:
    """Lon/lat shapes move to the equal-area plane, where areas are spheroidal."""
    return project(shapes, EQUAL_AREA, LONLAT, step=EDGE_STEP) if srid == LONLAT else shapes


def _cut(shapes: DataFrame, id: str, name: str, cell: float) -> DataFrame:
    return cells.strips(shapes, id, cell).withColumnRenamed("id", name)


def bbox_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
              names: tuple[str, str] = PAIR, cell: float | None = None, layers: tuple[int, int] = (0, 1)) -> DataFrame:
    """Pairs whose closed boxes meet, touching included, with the boxes of both.

    A pair is kept only in the cell holding the lower left corner of the shared
    box, so no ``distinct`` is needed.
    """
    cell = cell or cells.choose_cell(left, right)
    lo = cells.box_cells(left.withColumnRenamed(left_id, names[0]), cell, names[0])
    hi = cells.box_cells(right.withColumnRenamed(right_id, names[1]), cell, names[1])
    hi = hi.select(names[1], *cells.CELL, *[F.col(b).alias(f"r_{b}") for b in BOX])
    lo, hi, keys = cells.split_hot(lo, hi, cell, layers)
    met = "xmin <= r_xmax and r_xmin <= xmax and ymin <= r_ymax and r_ymin <= ymax"
    once = (f"cx = floor(greatest(xmin, r_xmin) / {float(cell)!r}D) and cy = floor(greatest(ymin, r_ymin) / {float(cell)!r}D)")
    return lo.join(hi.hint("merge"), keys).where(met).where(once).drop(*keys)


def overlap_area(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                 names: tuple[str, str] = PAIR, srid: int = 0, cell: float | None = None,
                 layers: tuple[int, int] = (0, 1)) -> DataFrame:
    """``area`` of every pair that shares ground; touching pairs fall out."""
    left, right = on_area_plane(left, srid), on_area_plane(right, srid)
    cell = cell or cells.choose_cell(left, right)
    return cells.overlap_by_pair(_cut(left, left_id, names[0], cell), _cut(right, right_id, names[1], cell),
                                 [names[0]], [names[1]], cell, layers)


def overlap_area_3(a: DataFrame, b: DataFrame, c: DataFrame, ids: tuple[str, str, str],
                   names: tuple[str, str, str] = ("id_1", "src_id", "id_2"), srid: int = 0,
                   cell: float | None = None) -> DataFrame:
    """``area`` of every triple that shares ground."""
    a, b, c = (on_area_plane(x, srid) for x in (a, b, c))
    cell = cell or cells.choose_cell(a, b, c)
    first = cells.intersect_strips(_cut(b, ids[1], names[1], cell), _cut(a, ids[0], names[0], cell), [names[0]], cell, (1, 0))
    out = cells.overlap_by_pair(first, _cut(c, ids[2], names[2], cell), [names[1], names[0]], [names[2]], cell, (1, 2))
    return out.select(*names, "area")


def edge_cells(edge_rows: DataFrame, cell: float, p: str = "") -> DataFrame:
    """Edges (``x1, y1, x2, y2`` and any keys) with every cell they pass through,
    borders counted on both sides. End points become ``ax, ay, bx, by``, left to
    right, with the prefix ``p``."""
    c = f"{float(cell)!r}D"
    pad = f"(1e-9D * {c})"
    kept = [k for k in edge_rows.columns if k not in ("x1", "y1", "x2", "y2", "turn")]
    e = edge_rows.selectExpr(
        *kept, "if(x1 <= x2, x1, x2) as ax", "if(x1 <= x2, y1, y2) as ay",
        "if(x1 <= x2, x2, x1) as bx", "if(x1 <= x2, y2, y1) as by")
    e = e.selectExpr("*", f"explode(sequence(floor(ax / {c}), floor(bx / {c}))) as cx",
                     "coalesce(try_divide(by - ay, bx - ax), 0D) as slope")
    e = e.selectExpr("*", f"if(ax = bx, ay, ay + slope * (greatest(ax, cx * {c}) - ax)) as ya",
                     f"if(ax = bx, by, ay + slope * (least(bx, (cx + 1) * {c}) - ax)) as yb")
    e = e.selectExpr("*", f"""explode(sequence(floor((least(ya, yb) - {pad}) / {c}),
                                               floor((greatest(ya, yb) + {pad}) / {c}))) as cy""")
    return e.select(*kept, *cells.CELL, *[F.col(k).alias(p + k) for k in ("ax", "ay", "bx", "by")])


def sized_edges(shapes: DataFrame, id: str, name: str) -> DataFrame:
    """All edges of a map with their size classes: ``name, sx, sy, x1, y1, x2, y2``."""
    rings = edges.with_classes(shapes, "flatten(geom.polys)").selectExpr(f"`{id}` as `{name}`", "least", "explode(flatten(geom.polys)) as r")
    each = "inline(zip_with(slice(r, 1, greatest(size(r) - 1, 0)), slice(r, 2, greatest(size(r) - 1, 0)), (p, q) -> struct(p.x as x1, p.y as y1, q.x as x2, q.y as y2)))"
    return edges.with_class(rings.selectExpr(f"`{name}`", "least", each).where("x1 <> x2 or y1 <> y2")).drop("least")


def border_edges(pairs: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                 names: tuple[str, str], cell: float) -> tuple[DataFrame, DataFrame]:
    """Edges of both sides of each box pair in the cells of the shared box, ready to meet by ``names`` and cell."""
    c = f"{float(cell)!r}D"

    def span(lo, hi):
        return f"explode(sequence(floor(greatest({lo}, r_{lo}) / {c} - 1e-9D), floor(least({hi}, r_{hi}) / {c} + 1e-9D)))"

    def classes(shapes, id, name, column):
        return edges.with_classes(shapes, "flatten(geom.polys)").selectExpr(f"`{id}` as `{name}`", f"classes as {column}")

    shared = pairs.join(classes(left, left_id, names[0], "l_classes"), names[0]).join(classes(right, right_id, names[1], "r_classes"), names[1])
    shared = shared.selectExpr("*", f"{span('xmin', 'xmax')} as cx").selectExpr("*", f"{span('ymin', 'ymax')} as cy")

    def near(shapes, id, name, other):
        e = edge_cells(sized_edges(shapes, id, name), cell).withColumnsRenamed({"ax": "x1", "ay": "y1", "bx": "x2", "by": "y2"})
        j = shared.select(*names, *cells.CELL, F.col(other).alias("other"), *BOX, *[f"r_{b}" for b in BOX]).join(e.hint("merge"), [name, *cells.CELL])
        j = j.where("greatest(xmin, r_xmin) <= greatest(x1, x2) and least(x1, x2) <= least(xmax, r_xmax) and greatest(ymin, r_ymin) <= greatest(y1, y2) and least(y1, y2) <= least(ymax, r_ymax)")
        return j.select(*names, *cells.CELL, "other", "sx", "sy", "x1", "y1", "x2", "y2")

    return near(left, left_id, names[0], "r_classes"), near(right, right_id, names[1], "l_classes")


def _contacts(pairs: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str,
              names: tuple[str, str], cell: float) -> DataFrame:
    """Those of the given box pairs whose outlines meet in at least one point.

    Outlines can meet only in the cells of the shared box, so a pair takes the edges of
    both sides from there alone, and these meet in bins of their own size.
    """
    a, b = border_edges(pairs, left, right, left_id, right_id, names, cell)
    met = edges.with_turns(edges.meeting(a, b, [*names, *cells.CELL]))
    return met.where(edges.HAVE_A_POINT).select(*names).distinct()


def box_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, names: tuple[str, str] = PAIR,
              cell: float | None = None, layers: tuple[int, int] = (0, 1)) -> DataFrame:
    """Pairs whose boxes meet, with both boxes and the ``area`` they share (null: none).

    Kept in the checkpoint folder: what shares ground is settled, what does not is looked
    at edge by edge, and neither branch works the pairs out again.
    """
    cell = cell or cells.choose_cell(left, right)
    ground = overlap_area(left, right, left_id, right_id, names, cell=cell, layers=layers)
    return stored(bbox_join(left, right, left_id, right_id, names, cell, layers).join(ground, list(names), "left"))


def touching(pairs: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str,
             names: tuple[str, str], cell: float) -> DataFrame:
    """Those of ``box_pairs`` that share a point but no ground."""
    return _contacts(pairs.where("area is null").drop("area"), left, right, left_id, right_id, names, cell)


def spatial_join_intersects(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                            names: tuple[str, str] = PAIR, cell: float | None = None, layers: tuple[int, int] = (0, 1),
                            boxes: bool = False) -> DataFrame:
    """Pairs that share at least a point, with the boxes of both if ``boxes``.

    Shared ground settles most pairs; only those whose boxes meet without any
    are looked at edge by edge.
    """
    cell = cell or cells.choose_cell(left, right)
    pairs = box_pairs(left, right, left_id, right_id, names, cell, layers)
    touch = touching(pairs, left, right, left_id, right_id, names, cell)
    if boxes:
        touch = pairs.join(touch, list(names), "left_semi").drop("area")
    return pairs.where("area is not null").select(*touch.columns).unionByName(touch)


def geometry_predicates(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                        names: tuple[str, str] = PAIR, cell: float | None = None) -> DataFrame:
    """Box pairs with ``area`` and the flags intersects, overlaps, contains, within.

    ``contains``: the left area holds the right one; ``within``: the other way
    round; ``overlaps``: shared ground, but neither holds the other. For areas
    these follow from the overlap, compared within 1e-9 of the smaller one.
    """
    cell = cell or cells.choose_cell(left, right)
    pairs = box_pairs(left, right, left_id, right_id, names, cell)
    touch = touching(pairs, left, right, left_id, right_id, names, cell).withColumn("touch", F.lit(True))
    la = left.select(F.col(left_id).alias(names[0]), planar_area(F.col("geom")).alias("l_area"))
    ra = right.select(F.col(right_id).alias(names[1]), planar_area(F.col("geom")).alias("r_area"))
    j = pairs.select(*names, "area").join(touch, list(names), "left").join(la, names[0]).join(ra, names[1])
    within, contains = "area >= l_area * (1 - 1e-9D)", "area >= r_area * (1 - 1e-9D)"
    return j.selectExpr(
        *names, "coalesce(area, 0D) as area", "area is not null or touch is not null as intersects",
        f"coalesce(not ({within}) and not ({contains}), false) as overlaps",
        f"coalesce({contains}, false) as contains", f"coalesce({within}, false) as within")


def spatial_join_overlaps_or_contains(src: DataFrame, tgt: DataFrame, src_id: str, tgt_id: str,
                                      min_ratio: float = 0.01, names: tuple[str, str] = PAIR,
                                      cell: float | None = None) -> DataFrame:
    """Pairs where the source overlaps the target or lies in it, by more than
    ``min_ratio`` of its own area. A target wholly inside one source does not
    match, unless the two are the same area. ``area`` and ``src_area`` are planar.
    """
    shared = overlap_area(src, tgt, src_id, tgt_id, names, cell=cell)
    sa = src.select(F.col(src_id).alias(names[0]), planar_area(F.col("geom")).alias("src_area"))
    ta = tgt.select(F.col(tgt_id).alias(names[1]), planar_area(F.col("geom")).alias("tgt_area"))
    j = shared.join(sa, names[0]).join(ta, names[1])
    return j.where("area < tgt_area * (1 - 1e-9D) or area >= src_area * (1 - 1e-9D)").where(
        f"area > {min_ratio!r}D * src_area").select(*names, "area", "src_area")


def intersects_any(src: DataFrame, shapes: DataFrame, src_id: str, shape_id: str,
                   cell: float | None = None) -> DataFrame:
    """Sources that meet at least one shape; no union of the shapes is built."""
    pairs = spatial_join_intersects(src, shapes, src_id, shape_id, cell=cell)
    return src.join(pairs.select(F.col("src_id").alias(src_id)), src_id, "left_semi")
