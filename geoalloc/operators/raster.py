"""Land-cover rasters as tables: tiles for storage, pixel runs for work.

A tile row holds its pixels as bytes (or bits). For joins a coverage becomes
*runs*, stretches of set pixels in one pixel row, and a polygon becomes *spans*,
the stretches of pixel centres it covers in one pixel row. Both are cut at tile
borders, so clipping is an equi-join on (pixel row, tile column) and counting is
a sum. A clip of a clip is the same join once more.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoalloc.functions.geometry import BOX, LONLAT, box_area
from geoalloc.operators import cells
from geoalloc.spec import EXCLUDED_TRACTS, Grid

TILE_SCHEMA = ("rid bigint, filename string, tx bigint, ty bigint, ulx double, uly double, px_w double, "
               "px_h double, cols int, rows int, nodata int, bits int, band binary")
# Land-cover classes 20-29 are developed land.
DEVELOPED = ((0, 19, 0), (20, 29, 1), (30, 255, 0))


def tile_raster(pixels: DataFrame, grid: Grid, filename: str = "pixels", nodata: int = 255) -> DataFrame:
    """Pixel rows (``pcol, prow, cls`` and optionally ``filename``) to tiles.

    A tile is as wide and high as the pixels it has; gaps are ``nodata``. Groups
    are bounded by the tile side, never by the data. Tile ids count up from those
    of the first file by name, so they are unique over all files. A pixel of a
    file that is given two classes is an error.
    """
    t = grid.tile
    if "filename" not in pixels.columns:
        pixels = pixels.withColumns({"filename": F.lit(filename), "file_no": F.lit(0).cast("long")})
    else:  # a row for each file
        files = pixels.select("filename").distinct().withColumn("file_no", F.row_number().over(Window.orderBy("filename")).cast("long") - 1)
        pixels = pixels.drop("file_no").join(F.broadcast(files), "filename")  # dealt by file, its pixels would be one task
    gap = f"{nodata:02X}"
    keys = ["filename", "file_no", "ty", "tx"]
    lines = (pixels.selectExpr("filename", "file_no", f"floor(prow / {t}) as ty", f"floor(pcol / {t}) as tx",
                               f"cast(pmod(prow, {t}) as int) as r", f"cast(pmod(pcol, {t}) as int) as c", "cls")
             .groupBy(*keys, "r").agg(F.expr("sort_array(collect_set(struct(c, cls)))").alias("px"))
             .selectExpr(*keys, "r", "element_at(px, -1).c + 1 as w", f"""
                 aggregate(if(size(array_distinct(px.c)) = size(px), px, raise_error(concat('a pixel of ', filename, ' has two classes'))),
                     struct(0 as pos, '' as s), (a, p) -> if(p.c < a.pos, a, struct(p.c + 1 as pos,
                     concat(a.s, repeat('{gap}', p.c - a.pos), lpad(hex(p.cls), 2, '0')) as s)),
                     a -> rpad(a.s, {2 * t}, '{gap}')) as s"""))
    return (lines.groupBy(*keys).agg(F.max("w").alias("cols"), F.expr("sort_array(collect_list(struct(r, s)))").alias("ls"))
            .selectExpr(*keys, "cols", f"""
                aggregate(ls, struct(0 as pos, '' as s), (a, l) -> struct(l.r + 1 as pos, concat(a.s,
                    repeat('{gap}', (l.r - a.pos) * cols), substr(l.s, 1, 2 * cols)) as s)) as t""")
            .selectExpr("file_no * 4503599627370496 + ty * 4294967296 + tx as rid", "filename", "tx", "ty",
                        f"{grid.x0!r}D + tx * {t} * {grid.px_w!r}D as ulx", f"{grid.y0!r}D + ty * {t} * {grid.px_h!r}D as uly",
                        f"{grid.px_w!r}D as px_w", f"{grid.px_h!r}D as px_h", "cols", "t.pos as rows",
                        f"{nodata} as nodata", "8 as bits", "unhex(t.s) as band"))


def union_tiles(*tables: DataFrame) -> DataFrame:
    """Several coverages on one grid as one tiled table; ``filename`` tells them apart."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _pixels_of(row) -> np.ndarray:
    raw = np.frombuffer(row.band, dtype=np.uint8)
    if row.bits == 1:
        return np.unpackbits(raw.reshape(row.rows, -1), axis=1)[:, :row.cols]
    return raw.reshape(row.rows, row.cols)


def reclass_raster(tiles: DataFrame, rules=DEVELOPED, nodata: int = 0) -> DataFrame:
    """Maps classes by ``(low, high, value)`` rules to a one-bit raster.

    Classes no rule names become ``nodata``.
    """
    lookup = np.full(256, nodata, dtype=np.uint8)
    for low, high, value in rules:
        lookup[low:high + 1] = value

    def recode(batches):
        for pdf in batches:
            bands = [np.packbits(lookup[_pixels_of(row)], axis=1).tobytes() for row in pdf.itertuples(index=False)]
            yield pdf.assign(band=bands, bits=1, nodata=nodata)

    return tiles.mapInPandas(recode, TILE_SCHEMA)


def raster_runs(tiles: DataFrame, grid: Grid, value: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """Set pixels as runs: ``rid, tx, prow, c_from, c_to`` (``c_to`` excluded), and the columns ``keep`` of their tile."""
    side = grid.tile
    kept = "".join(f", {k} {tiles.schema[k].dataType.simpleString()}" for k in keep)

    def runs(batches):
        for pdf in batches:
            found = []
            for row in pdf.itertuples(index=False):
                on = np.pad((_pixels_of(row) == value).astype(np.int8), ((0, 0), (1, 1)))
                step = np.diff(on, axis=1)
                r, start = np.nonzero(step == 1)
                found.append((row.ty * side + r, row.tx * side + start, row.tx * side + np.nonzero(step == -1)[1]))
            if found:
                own = pdf[["rid", "tx", *keep]].iloc[np.repeat(np.arange(len(pdf)), [len(f[0]) for f in found])].reset_index(drop=True)
                yield own.assign(**{c: np.concatenate(v) for c, v in zip(("prow", "c_from", "c_to"), zip(*found))})[["rid", "tx", "prow", "c_from", "c_to", *keep]]

    return tiles.select("rid", "tx", "ty", "cols", "rows", "bits", "band", *keep).mapInPandas(
        runs, f"rid bigint, tx bigint, prow bigint, c_from bigint, c_to bigint{kept}")


def scan_spans(shapes: DataFrame, id: str, grid: Grid, name: str = "geom_id") -> DataFrame:
    """Pixel centres inside each shape: ``name, prow, tx, c_from, c_to``.

    Outline crossings of a pixel row's centre line, sorted and taken in pairs.
    Rows and columns are half open, and an edge is always walked the same way, so
    two shapes that share an edge never both claim a pixel.
    """
    e = cells.edges(shapes, id).selectExpr(
        f"id as {name}", *[f"({k} - {grid.x0!r}D) / {grid.px_w!r}D as {k}" for k in ("x1", "x2")],
        *[f"({k} - {grid.y0!r}D) / {grid.px_h!r}D as {k}" for k in ("y1", "y2")])
    return spans_of(e, [name], grid.tile)


def spans_of(e: DataFrame, keys: list[str], t: int) -> DataFrame:
    """Spans of outlines given as edges in pixels, cut at every ``t`` columns."""
    e = e.selectExpr(*keys, *[f"if(y1 < y2, {a}, {b}) as {o}" for a, b, o in (
        ("x1", "x2", "ux"), ("y1", "y2", "uy"), ("x2", "x1", "wx"), ("y2", "y1", "wy"))])
    e = e.where("ceil(wy - 0.5D) > ceil(uy - 0.5D)")
    e = e.selectExpr("*", "explode(sequence(ceil(uy - 0.5D), ceil(wy - 0.5D) - 1)) as prow")
    rows = e.selectExpr(*keys, "prow", "ux + (prow + 0.5D - uy) * ((wx - ux) / (wy - uy)) as x").groupBy(
        *keys, "prow").agg(F.expr("sort_array(collect_list(x))").alias("xs"))
    spans = rows.selectExpr(*keys, "prow", """explode(transform(sequence(1, cast(size(xs) / 2 as int)),
        i -> struct(ceil(xs[2 * i - 2] - 0.5D) as a, ceil(xs[2 * i - 1] - 0.5D) as b))) as s""").where("s.b > s.a")
    spans = spans.selectExpr(*keys, "prow", "s.a as a", "s.b as b", f"explode(sequence(floor(s.a / {t}), floor((s.b - 1) / {t}))) as tx")
    return spans.selectExpr(*keys, "prow", "tx", f"greatest(a, tx * {t}) as c_from", f"least(b, (tx + 1) * {t}) as c_to")


def clip_runs(runs: DataFrame, spans: DataFrame) -> DataFrame:
    """Runs inside spans: every column of both sides, with the shared stretch.

    Runs and spans of several files meet inside their ``file``. Spans are explosions whose size the planner cannot know: never broadcast.
    """
    s = spans.withColumnsRenamed({"c_from": "s_from", "c_to": "s_to"})
    kept = [c for c in runs.columns if c not in ("c_from", "c_to")] + [
        c for c in s.columns if c not in ("file", "prow", "tx", "s_from", "s_to")]
    on = [c for c in ("file", "prow", "tx") if c in runs.columns]
    return runs.join(s.hint("merge"), on).where("c_from < s_to and s_from < c_to").selectExpr(
        *kept, "greatest(c_from, s_from) as c_from", "least(c_to, s_to) as c_to")


def clip_raster_to_geometries(runs: DataFrame, shapes: DataFrame, id: str, grid: Grid, name: str = "geom_id",
                              pop: str | None = None, excluded=EXCLUDED_TRACTS) -> DataFrame:
    """Each geometry's own raster, as runs: ``name, rid, tx, prow, c_from, c_to``.

    Only geometries with people and not on the excluded list, when ``pop`` is
    given. A tile without a set pixel has no runs and so falls out by itself.
    """
    if pop is not None:
        shapes = shapes.where((F.col(pop) > 0) & ~F.col(id).cast("string").isin(*excluded))
    return clip_runs(runs, scan_spans(shapes, id, grid, name)).select(name, "rid", "tx", "prow", "c_from", "c_to")


def pixel_area(grid: Grid, row: Column) -> Column:
    """Area of one pixel of a row, on the spheroid for lon/lat grids."""
    if grid.srid != LONLAT:
        return F.lit(abs(grid.px_w * grid.px_h))
    y = F.lit(grid.y0) + row * grid.px_h
    return F.abs(box_area(F.lit(0.0), y, F.lit(grid.px_w), y + grid.px_h, LONLAT))


def clip_count(clips: DataFrame, *by: str) -> DataFrame:
    """``dev``: set pixels per key of a clip."""
    return clips.groupBy(*by).agg(F.sum(F.col("c_to") - F.col("c_from")).alias("dev"))


def clip_developed_area(clips: DataFrame, grid: Grid, *by: str) -> DataFrame:
    """``dev`` and ``dev_area_m2``: set pixels per key, and the ground they cover."""
    n = F.col("c_to") - F.col("c_from")
    return clips.groupBy(*by).agg(F.sum(n).alias("dev"), F.sum(n * pixel_area(grid, F.col("prow"))).alias("dev_area_m2"))


def raster_union_by_geom(clips: DataFrame, name: str = "geom_id") -> DataFrame:
    """What callers read from the merged raster of a geometry: set pixels and extent."""
    return clips.groupBy(name).agg(
        F.sum(F.col("c_to") - F.col("c_from")).alias("dev"), F.countDistinct("rid").alias("tiles"),
        F.min("c_from").alias("c_from"), F.max("c_to").alias("c_to"),
        F.min("prow").alias("r_from"), (F.max("prow") + 1).alias("r_to"))


def tile_boxes(tiles: DataFrame, grid: Grid, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pixel extent of every tile; the pixels themselves are not read."""
    t = grid.tile
    return tiles.selectExpr("rid", *keep, "tx", "ty", f"tx * {t} as t_c0", f"tx * {t} + cols as t_c1",
                            f"ty * {t} as t_r0", f"ty * {t} + rows as t_r1")


def _pixel_box(df: DataFrame, grid: Grid, prefix: str = "") -> DataFrame:
    """Box columns in pixel units: ``u0, u1`` across and ``v0, v1`` along the rows."""
    def at(c, origin, size):
        return f"({prefix}{c} - {origin!r}D) / {size!r}D"
    lo, hi = at("ymin", grid.y0, grid.px_h), at("ymax", grid.y0, grid.px_h)
    return df.selectExpr("*", f"{at('xmin', grid.x0, grid.px_w)} as {prefix}u0", f"{at('xmax', grid.x0, grid.px_w)} as {prefix}u1",
                         f"least({lo}, {hi}) as {prefix}v0", f"greatest({lo}, {hi}) as {prefix}v1")


def tiles_of(shapes: DataFrame, id: str, tiles: DataFrame, grid: Grid, name: str = "geom_id") -> DataFrame:
    """(geometry, tile) pairs whose boxes meet, with the tile's extent in pixels.

    ``inside``: the whole geometry lies in the tile; ``touch``: the boxes share
    no more than a border.
    """
    t = grid.tile
    s = _pixel_box(shapes.selectExpr(f"{id} as {name}", *BOX).where("xmin is not null"), grid)
    # a tile reaches from its first pixel to at most the next tile's, border included
    s = s.selectExpr(name, "u0", "u1", "v0", "v1", f"explode(sequence(ceil(u0 / {t}) - 1, floor(u1 / {t}))) as tx",
                     f"sequence(ceil(v0 / {t}) - 1, floor(v1 / {t})) as tys")
    s = s.selectExpr(name, "u0", "u1", "v0", "v1", "tx", "explode(tys) as ty")
    return s.join(tile_boxes(tiles, grid), ["tx", "ty"]).where(
        "u0 <= t_c1 and t_c0 <= u1 and v0 <= t_r1 and t_r0 <= v1").selectExpr(
        name, "rid", "t_c0", "t_c1", "t_r0", "t_r1", "u0 >= t_c0 and u1 <= t_c1 and v0 >= t_r0 and v1 <= t_r1 as inside",
        "u0 = t_c1 or u1 = t_c0 or v0 = t_r1 or v1 = t_r0 as touch")


def clip_envelope_area(pairs: DataFrame, pair_tiles: DataFrame, grid: Grid, src: str = "src_id",
                       merged: bool = False) -> DataFrame:
    """``rast_area_m2`` of the box of each clipped raster, per pair.

    ``pairs`` carry both boxes (``xmin..`` and ``r_xmin..``). A clip is cropped to
    whole pixels around either shape. Boxes are taken tile by tile and summed, or,
    with ``merged``, once per pair inside the extent of all tiles of the source.
    """
    if merged:
        pair_tiles = pair_tiles.groupBy(src).agg(
            F.min("t_c0").alias("t_c0"), F.max("t_c1").alias("t_c1"),
            F.min("t_r0").alias("t_r0"), F.max("t_r1").alias("t_r1"))
    keys = [c for c in pairs.columns if c not in BOX and not c.startswith("r_")]
    j = _pixel_box(_pixel_box(pairs, grid), grid, "r_").join(pair_tiles, src)
    j = j.selectExpr(
        *keys, "greatest(floor(u0), floor(r_u0), t_c0) as c0", "least(ceil(u1), ceil(r_u1), t_c1) as c1",
        "greatest(floor(v0), floor(r_v0), t_r0) as r0", "least(ceil(v1), ceil(r_v1), t_r1) as r1")
    x0, x1 = (F.lit(grid.x0) + F.col(c) * grid.px_w for c in ("c0", "c1"))
    y0, y1 = (F.lit(grid.y0) + F.col(c) * grid.px_h for c in ("r0", "r1"))
    size = F.when((F.col("c1") > F.col("c0")) & (F.col("r1") > F.col("r0")),
                  F.abs(box_area(x0, y0, x1, y1, grid.srid))).otherwise(0.0)
    return j.groupBy(*keys).agg(F.sum(size).alias("rast_area_m2"))
