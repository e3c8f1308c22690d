"""Coverages of different origin and pixel size as one raster.

Every file has its own grid; runs and spans carry the number of their file and are in its
pixels, and the ground they cover is taken in metres. Ground that several files cover counts
once, for the first of them, in the order of ``grids``, that has a pixel around the centre.
All files share one reference system and one tile side. Nothing depends on the number of files:
their origins are a table that joins, not branches of the plan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoalloc.functions.geometry import BOX, LONLAT, box_area
from geoalloc.operators import cells, raster
from geoalloc.operators.spatial import bbox_join, spatial_join_intersects
from geoalloc.sources.writers import stored
from geoalloc.spec import Grid

TILE_COLUMNS = [c.split()[0] for c in raster.TILE_SCHEMA.split(", ")]


def common(grids: Mapping[str, Grid]) -> Grid:
    """The first grid, after a look that all have its tile side and reference system."""
    if len({(g.tile, g.srid) for g in grids.values()}) != 1:
        raise ValueError("the grids of a mosaic need one tile side and one reference system")
    return next(iter(grids.values()))


def grid_table(spark: SparkSession, grids: Mapping[str, Grid]) -> DataFrame:
    """``file, filename, x0, y0, gw, gh``; files count up in order of precedence.

    As small as the given grids, so it goes to the rows it joins: dealt by file, all rows of one would be one task.
    """
    rows = [(n, name, float(g.x0), float(g.y0), float(g.px_w), float(g.px_h)) for n, (name, g) in enumerate(grids.items())]
    types = [pa.int64(), pa.string(), *[pa.float64()] * 4]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["file", "filename", "x0", "y0", "gw", "gh"])
    return F.broadcast(spark.createDataFrame(table))


def tile_files(pixels: DataFrame, grids: Mapping[str, Grid], nodata: int = 255) -> DataFrame:
    """Pixel rows (``filename, pcol, prow, cls``) to tiles, each file on its own grid. A file without a grid is an error."""
    one = common(grids)
    tiles = raster.tile_raster(pixels, one, nodata=nodata).drop("ulx", "uly", "px_w", "px_h")
    known = "if(file is null, cast(raise_error(concat('no grid for the file ', filename)) as double), x0 + tx * {t} * gw) as ulx"
    out = tiles.join(grid_table(pixels.sparkSession, grids), "filename", "left").selectExpr(
        *[c for c in TILE_COLUMNS if c in tiles.columns], known.format(t=one.tile), f"y0 + ty * {one.tile} * gh as uly", "gw as px_w", "gh as px_h")
    return out.select(*TILE_COLUMNS)


def _numbered(tiles: DataFrame, grids: Mapping[str, Grid]) -> DataFrame:
    return tiles.join(grid_table(tiles.sparkSession, grids), "filename")


def extents(tiles: DataFrame, grids: Mapping[str, Grid]) -> DataFrame:
    """Box of all tiles of each file: ``file, xmin, ymin, xmax, ymax``."""
    e = _numbered(tiles, grids).selectExpr("file", "ulx as ax", "uly as ay", "ulx + cols * px_w as bx", "uly + rows * px_h as by")
    return e.groupBy("file").agg(*[F.expr(f"{low}({of}(a{axis}, b{axis})) as {axis}{low}")
                                   for low, of in (("min", "least"), ("max", "greatest")) for axis in "xy"]).select("file", *BOX)


def _as_runs(tiles: DataFrame, grids: Mapping[str, Grid], rules) -> DataFrame:
    side = common(grids)
    return raster.raster_runs(_numbered(raster.reclass_raster(tiles, rules), grids), side, keep=("file",))


def covered_before(tiles: DataFrame, grids: Mapping[str, Grid], nodata: int = 255) -> DataFrame:
    """Pixel centres of a file inside pixels of files before it: ``file, prow, tx, held``.

    ``held`` are stretches ``c_from, c_to``, at most a tile side of them for each earlier file
    at that place. Pixels of an earlier file are laid on the grid of the later one.
    """
    side = common(grids).tile
    boxes = extents(tiles, grids)
    over = F.broadcast(bbox_join(boxes, boxes, "file", "file", ("late", "early")).where("early < late").select("late", "early"))
    g = grid_table(tiles.sparkSession, grids).drop("filename")
    own = g.withColumnsRenamed({c: f"e_{c}" for c in ("x0", "y0", "gw", "gh")})

    def first(axis, index, size):
        """The first pixel of the later grid with its centre at or behind the edge of an earlier pixel."""
        return f"(e_{axis}0 + ({index}) * e_{size} - {axis}0) / {size} - 0.5D"

    data = _as_runs(tiles, grids, tuple((low, high, 1) for low, high in ((0, nodata - 1), (nodata + 1, 255)) if low <= high))
    j = data.join(own, "file").withColumnRenamed("file", "early").join(over, "early").join(g.withColumnRenamed("file", "late"), "late")
    ends = {"ra": first("y", "prow", "gh"), "rb": first("y", "prow + 1", "gh"), "ca": first("x", "c_from", "gw"), "cb": first("x", "c_to", "gw")}
    j = j.selectExpr("late as file", *(f"ceil({v}) as {k}" for k, v in ends.items())).selectExpr(
        "file", *(f"{f}({a}, {b}) as {n}" for n, f, a, b in (("r0", "least", "ra", "rb"), ("r1", "greatest", "ra", "rb"), ("c0", "least", "ca", "cb"), ("c1", "greatest", "ca", "cb"))))
    j = j.where("r0 < r1 and c0 < c1").selectExpr("file", "explode(sequence(r0, r1 - 1)) as prow", "c0", "c1")
    j = j.selectExpr("file", "prow", "c0", "c1", f"explode(sequence(floor(c0 / {side}), floor((c1 - 1) / {side}))) as tx")
    return j.selectExpr("file", "prow", "tx", f"struct(greatest(c0, tx * {side}) as c_from, least(c1, (tx + 1) * {side}) as c_to) as h").groupBy(
        "file", "prow", "tx").agg(F.expr("sort_array(collect_set(h)) as held"))


def mosaic_runs(tiles: DataFrame, grids: Mapping[str, Grid], rules=raster.DEVELOPED, nodata: int = 255) -> DataFrame:
    """Set pixels of all files as runs ``file, rid, tx, prow, c_from, c_to``, ground covered twice once.

    ``tiles`` hold classes; ``rules`` say which of them are set. A pixel of a class that is not
    set still holds its ground against later files; a gap does not.
    """
    runs = _as_runs(tiles, grids, rules)
    free = """if(held is null, array(struct(c_from as a, c_to as b)), aggregate(held,
        struct(c_from as pos, cast(array() as array<struct<a: bigint, b: bigint>>) as out),
        (s, h) -> struct(greatest(s.pos, h.c_to) as pos, if(least(h.c_from, c_to) > s.pos,
            concat(s.out, array(struct(s.pos as a, least(h.c_from, c_to) as b))), s.out) as out),
        s -> if(s.pos < c_to, concat(s.out, array(struct(s.pos as a, c_to as b))), s.out)))"""
    j = runs.join(covered_before(tiles, grids, nodata), ["file", "prow", "tx"], "left")
    return j.selectExpr("file", "rid", "tx", "prow", f"inline({free}) as (c_from, c_to)")


def near_files(shapes: DataFrame, id: str, tiles: DataFrame, grids: Mapping[str, Grid], name: str, *keep: str) -> DataFrame:
    """Each shape with the files whose box meets its own: ``name, file``, the grid of the file, the box of the shape and ``keep``.

    There is a box for each of the given grids, so the boxes go to the shapes, in cells that are
    large enough for both: a file that reaches over very many shapes takes few cells, and no shape is shuffled.
    """
    boxes = extents(tiles, grids)
    side = max(cells.choose_cell(df, hot_rows=math.inf) for df in (shapes, boxes))
    own = shapes.where(F.col(id).isNotNull()).select(F.col(id).alias(name), *keep, *BOX)
    own = cells.box_cells(own, side, name, *keep)
    far = cells.box_cells(boxes.join(grid_table(tiles.sparkSession, grids).drop("filename"), "file"), side, "file", "x0", "y0", "gw", "gh")
    j = own.join(F.broadcast(far.withColumnsRenamed({b: f"r_{b}" for b in BOX})), list(cells.CELL))
    j = j.where("xmin <= r_xmax and r_xmin <= xmax and ymin <= r_ymax and r_ymin <= ymax")
    return j.where(f"cx = floor(greatest(xmin, r_xmin) / {float(side)!r}D) and cy = floor(greatest(ymin, r_ymin) / {float(side)!r}D)").drop(
        *cells.CELL, *(f"r_{b}" for b in BOX))


def mosaic_spans(shapes: DataFrame, id: str, tiles: DataFrame, grids: Mapping[str, Grid], name: str = "geom_id") -> DataFrame:
    """Pixel centres inside each shape, for every file whose box meets the shape's: ``name, file, prow, tx, c_from, c_to``."""
    near = near_files(shapes, id, tiles, grids, name, "geom").selectExpr("geom", f"struct({name}, file, x0, y0, gw, gh) as own")
    e = cells.edges(near, "own").selectExpr("id.*", "x1", "y1", "x2", "y2")
    e = e.selectExpr(name, "file", *[f"({k} - x0) / gw as {k}" for k in ("x1", "x2")], *[f"({k} - y0) / gh as {k}" for k in ("y1", "y2")])
    return raster.spans_of(e, [name, "file"], common(grids).tile)


def ground(clips: DataFrame, grids: Mapping[str, Grid], *by: str) -> DataFrame:
    """``dev`` and ``dev_area_m2``: set pixels per key, and the ground they cover in pixels of their own file."""
    n, y = F.col("c_to") - F.col("c_from"), F.expr("y0 + prow * gh")
    size = F.expr("abs(gw * gh)") if common(grids).srid != LONLAT else F.abs(box_area(F.lit(0.0), y, F.col("gw"), y + F.col("gh"), LONLAT))
    j = clips.join(grid_table(clips.sparkSession, grids).drop("filename"), "file")
    return j.groupBy(*by).agg(F.sum(n).alias("dev"), F.sum(n * size).alias("dev_area_m2"))


def envelopes(pairs: DataFrame, src: DataFrame, src_id: str, tiles: DataFrame, grids: Mapping[str, Grid]) -> DataFrame:
    """``rast_area_m2``: the shared box of each pair in whole pixels of every tile that the source's box meets, added up.

    Pairs without such a tile fall out. Boxes in ground that two files cover add up as well.
    """
    one = common(grids)
    t = one.tile

    def in_pixels(df, p=""):
        lo, hi = (f"({p}{e} - y0) / gh" for e in ("ymin", "ymax"))
        return df.selectExpr("*", f"({p}xmin - x0) / gw as {p}u0", f"({p}xmax - x0) / gw as {p}u1", f"least({lo}, {hi}) as {p}v0", f"greatest({lo}, {hi}) as {p}v1")

    s = in_pixels(near_files(src, src_id, tiles, grids, "src_id")).drop(*BOX).selectExpr("*", f"explode(sequence(ceil(u0 / {t}) - 1, floor(u1 / {t}))) as tx")
    s = s.selectExpr("*", f"explode(sequence(ceil(v0 / {t}) - 1, floor(v1 / {t}))) as ty")
    boxes = raster.tile_boxes(_numbered(tiles, grids), one, keep=("file",))
    s = s.join(boxes, ["file", "tx", "ty"]).where("u0 <= t_c1 and t_c0 <= u1 and v0 <= t_r1 and t_r0 <= v1")
    j = in_pixels(pairs.select("src_id", "tgt_id", *[f"r_{b}" for b in BOX]).join(s, "src_id"), "r_").selectExpr(
        "src_id", "tgt_id", "x0", "y0", "gw", "gh",
        "greatest(floor(u0), floor(r_u0), t_c0) as c0", "least(ceil(u1), ceil(r_u1), t_c1) as c1",
        "greatest(floor(v0), floor(r_v0), t_r0) as r0", "least(ceil(v1), ceil(r_v1), t_r1) as r1")
    corners = [F.expr(k) for k in ("x0 + c0 * gw", "y0 + r0 * gh", "x0 + c1 * gw", "y0 + r1 * gh")]
    size = F.when(F.expr("c1 > c0 and r1 > r0"), F.abs(box_area(*corners, one.srid))).otherwise(0.0)
    return j.groupBy("src_id", "tgt_id").agg(F.sum(size).alias("rast_area_m2"))


def mosaic_weights(src: DataFrame, tgt: DataFrame, tiles: DataFrame, runs: DataFrame, grids: Mapping[str, Grid],
                   src_id: str, tgt_id: str, clips: DataFrame | None = None) -> DataFrame:
    """Weights of all (source, target) pairs that meet, for ``dasymetric_interpolate(weights=...)``.

    As pixels differ in size, ``rast_wgt`` is developed ground in both over developed ground of the
    source. ``tiles`` give extents only; ``clips`` may pass the stored runs of each source (``src_id``).
    """
    if clips is None:
        clips = stored(raster.clip_runs(runs, mosaic_spans(src, src_id, tiles, grids, "src_id")))
    both = ground(raster.clip_runs(clips, mosaic_spans(tgt, tgt_id, tiles, grids, "tgt_id")), grids, "src_id", "tgt_id")
    own = ground(clips, grids, "src_id").withColumnsRenamed({"dev": "dev_in_source", "dev_area_m2": "own_m2"})
    pairs = spatial_join_intersects(src, tgt, src_id, tgt_id, boxes=True)
    j = envelopes(pairs, src, src_id, tiles, grids).join(both, ["src_id", "tgt_id"], "left").join(own, "src_id", "left")
    return j.selectExpr("src_id", "tgt_id", "coalesce(dev, 0) as dev_in_both", "coalesce(dev_in_source, 0) as dev_in_source",
                        "coalesce(dev_area_m2 / own_m2, 0D) as rast_wgt", "coalesce(dev_area_m2, 0D) as dev_area_m2", "rast_area_m2")
