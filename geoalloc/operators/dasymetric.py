"""Dasymetric interpolation: values split by developed pixels in the overlap.

A raster coverage enters as ``runs`` of developed pixels with the ``tiles`` they
come from (the tiles' extents only are read). The per-source clip can be made
once, stored, and passed as ``clips`` for every further map.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoalloc.functions.columns import extensive_columns, half_even, quoted, truncated
from geoalloc.functions.geometry import BOX, LONLAT, area, box_geom, planar_area
from geoalloc.functions.measures import (
    density, pop_weighted_log_density, weighted_extensive_sum, weighted_intensive_mean, weighted_population,
)
from geoalloc.operators import cells, raster
from geoalloc.operators.spatial import bbox_join, on_area_plane, overlap_area, spatial_join_intersects
from geoalloc.sources.writers import stored
from geoalloc.spec import Grid, InterpolationSpec


def tiles_touched(src: DataFrame, id: str, tiles: DataFrame, grid: Grid, exact: bool = True) -> DataFrame:
    """(source, tile) pairs that meet, with the tile's extent in pixels.

    By boxes. With ``exact``, a source that reaches over a tile's border must also
    share ground with the tile, unless the two boxes no more than touch.
    """
    near = raster.tiles_of(src, id, tiles, grid, "src_id")
    if not exact:
        return near.drop("inside", "touch")
    across = near.where("not inside and not touch")
    rows = [F.lit(grid.y0) + F.col(c) * grid.px_h for c in ("t_r0", "t_r1")]
    rect = box_geom(F.lit(grid.x0) + F.col("t_c0") * grid.px_w, F.least(*rows),
                    F.lit(grid.x0) + F.col("t_c1") * grid.px_w, F.greatest(*rows))
    rects = raster.tile_boxes(tiles, grid).select("rid", rect.alias("geom"))
    cut = src.join(across.select(F.col("src_id").alias(id)), id, "left_semi")
    ground = overlap_area(cut, rects, id, "rid", ("src_id", "rid"), cell=abs(grid.tile * grid.px_w))
    kept = across.join(ground, ["src_id", "rid"], "left_semi")
    return near.where("inside or touch").unionByName(kept).drop("inside", "touch")


def raster_weight_by_pair(both: DataFrame, clips: DataFrame, envelopes: DataFrame) -> DataFrame:
    """``rast_wgt`` per pair: developed pixels in both over developed pixels of the
    source (0 if it has none), with the developed and the box area of the clip."""
    own = raster.clip_count(clips, "src_id").withColumnRenamed("dev", "dev_in_source")
    j = envelopes.join(both, ["src_id", "tgt_id"], "left").join(own, "src_id", "left")
    return j.selectExpr("src_id", "tgt_id", "coalesce(dev, 0) as dev_in_both", "coalesce(dev_in_source, 0) as dev_in_source",
                        "coalesce(dev / dev_in_source, 0D) as rast_wgt", "coalesce(dev_area_m2, 0D) as dev_area_m2",
                        "rast_area_m2")


def dasymetric_weights(src: DataFrame, tgt: DataFrame, tiles: DataFrame, runs: DataFrame, grid: Grid, src_id: str,
                       tgt_id: str, clips: DataFrame | None = None, preclipped: bool = False,
                       cell: float | None = None) -> DataFrame:
    """Weights of all (source, target) pairs that meet, where the source has a tile.

    ``preclipped`` takes each source's merged clip as its raster: pairs by box
    only, sources only if their clip has a tile with a developed pixel.
    """
    cell = cell or cells.choose_cell(src, tgt)
    if clips is None:
        clips = stored(raster.clip_raster_to_geometries(runs, src, src_id, grid, "src_id"))
    if preclipped:
        pairs = bbox_join(src, tgt, src_id, tgt_id, cell=cell)
        lit = tiles.select("rid", "tx", "ty", "cols", "rows").join(runs.select("rid"), "rid", "left_semi")
        pair_tiles = tiles_touched(src, src_id, lit, grid, exact=False)
    else:
        pairs = spatial_join_intersects(src, tgt, src_id, tgt_id, cell=cell, boxes=True)
        pair_tiles = tiles_touched(src, src_id, tiles, grid)
    envelopes = raster.clip_envelope_area(pairs, pair_tiles, grid, merged=preclipped)
    in_both = raster.clip_runs(clips, raster.scan_spans(tgt, tgt_id, grid, "tgt_id"))
    both = raster.clip_developed_area(in_both, grid, "src_id", "tgt_id")
    return raster_weight_by_pair(both, clips, envelopes)


def target_measures(weights: DataFrame, src: DataFrame, spec: InterpolationSpec,
                    extensive: Sequence[str] | None = None, null_mode: str = "keep") -> DataFrame:
    """Weighted sums, means and densities per ``tgt_id``; whole-number counts.

    The weights stay narrow until here, where the wide columns join once.
    """
    cols = extensive_columns(src, spec) if extensive is None else list(extensive)
    wide = [spec.pop, *(c for c, _ in spec.intensive), *cols]
    data = src.select(F.col(spec.id).alias("src_id"), *quoted(dict.fromkeys(wide)))
    return weights.join(data, "src_id").groupBy("tgt_id").agg(
        (F.sum("dev_area_m2") * 1e-6).alias("DevSqKm"), (F.sum("rast_area_m2") * 1e-6).alias("RasterSqKm"),
        truncated(weighted_population(spec.pop)).alias("TotalPopulation"),
        density(spec.pop, "rast_area_m2").alias("PopPerSqKm"),
        density(spec.pop, "dev_area_m2").alias("PopPerDevSqKm"),
        pop_weighted_log_density(spec.pop, "rast_area_m2").alias("pwPopPerSqKm"),
        pop_weighted_log_density(spec.pop, "dev_area_m2").alias("pwPopPerDevSqKm"),
        *[weighted_intensive_mean(c, spec.pop, null_mode=null_mode).alias(n) for c, n in spec.intensive],
        *weighted_extensive_sum(cols))


def dasymetric_interpolate(src: DataFrame, tgt: DataFrame, tiles: DataFrame, runs: DataFrame, grid: Grid,
                           spec: InterpolationSpec, tgt_id: str = "id_0", name: str = "name",
                           area_from: str = "shape", weights: DataFrame | None = None, keep: Sequence[str] = (),
                           **options) -> DataFrame:
    """Districts with people, densities, averages and counts split by developed land.

    ``area_from='shape'`` takes the district's own area; ``'envelope'`` the sum of
    the clipped boxes. Targets that meet no source with a tile do not appear.
    """
    if weights is None:
        weights = dasymetric_weights(src, tgt, tiles, runs, grid, spec.id, tgt_id, **options)
    m = target_measures(weights, src, spec).withColumnRenamed("tgt_id", tgt_id)
    size = F.col("RasterSqKm") if area_from == "envelope" else area(F.col("geom"), grid.srid) * 1e-6
    j = tgt.select(tgt_id, F.col(name).alias("DistrictName"), "geom", *keep).join(m, tgt_id)
    rest = [c for c in m.columns if c not in (tgt_id, "DevSqKm", "RasterSqKm")]
    return j.select(F.col(tgt_id).alias("ID"), "DistrictName", size.alias("SqKm"), "DevSqKm", *keep, *quoted(rest))


def dasymetric_interpolate_preclipped(src, tgt, tiles, runs, grid, spec, **options) -> DataFrame:
    """From stored per-source clips: populated, not excluded sources only."""
    clips = stored(raster.clip_raster_to_geometries(runs, src, spec.id, grid, "src_id", pop=spec.pop))
    listed = src.where((F.col(spec.pop) > 0) & ~F.col(spec.id).cast("string").isin(*raster.EXCLUDED_TRACTS))
    return dasymetric_interpolate(listed, tgt, tiles, runs, grid, spec, clips=clips, preclipped=True, **options)


# --- overlap of two maps ---------------------------------------------------

def overlap_sum_by_pair(people_1: DataFrame, people_12: DataFrame, near: DataFrame, map1: DataFrame, map2: DataFrame,
                        ids: tuple[str, str], names: tuple[str, str], states: tuple[str, str] | None = None) -> DataFrame:
    """Sums per (name_1, name_2) of the people in both and in the first map.

    ``near`` are the id pairs whose boxes meet; the first-map figures count once
    for each, so that maps with repeated names add up the same way. With
    ``states``, the state columns of both maps, only pairs inside one state count
    and the sums are per (state, name_1, name_2).
    """
    n1 = map1.select(F.col(ids[0]).alias("id_1"), F.col(names[0]).alias("name_1"), *([F.col(states[0]).alias("state")] if states else []))
    n2 = map2.select(F.col(ids[1]).alias("id_2"), F.col(names[1]).alias("name_2"), *([F.col(states[1]).alias("state_2")] if states else []))
    j = near.join(people_1, "id_1", "left").join(people_12, ["id_1", "id_2"], "left").join(n1, "id_1").join(n2, "id_2")
    if states:
        j = j.where("state = state_2")
    zero = F.lit(0.0)
    return j.groupBy(*(["state"] if states else []), "name_1", "name_2").agg(
        F.sum(F.coalesce("d_12", zero)).alias("d_pop_in_s1_s2"), F.sum(F.coalesce("a_12", zero)).alias("a_pop_in_s1_s2"),
        F.sum(F.coalesce("d_1", zero)).alias("d_pop_in_s1"), F.sum(F.coalesce("a_1", zero)).alias("a_pop_in_s1"))


def dasymetric_overlap_pairs(map1: DataFrame, map2: DataFrame, src: DataFrame, tiles: DataFrame, runs: DataFrame,
                             grid: Grid, pop: str, src_id: str = "geoid", ids: tuple[str, str] = ("id_0", "id_0"),
                             names: tuple[str, str] = ("name", "name"), min_pop: float | None = 0.0,
                             order: bool = False, clips: DataFrame | None = None, cell: float | None = None,
                             states: tuple[str, str] | None = None) -> DataFrame:
    """People living in both of two areas, by developed pixels (``d_``) and by ground (``a_``).

    Long rows ``name_1, name_2, d_pop_in_s1_s2, a_pop_in_s1_s2, d_pop_in_s1,
    a_pop_in_s1``; only sources that have a tile count. Pairs stay if either
    overlap is above ``min_pop``; with None all pairs whose boxes meet stay. With
    ``states`` rows also have the ``state``, and maps meet inside a state only.
    """
    cell = cell or cells.choose_cell(src, map1, map2)
    if clips is None:
        clips = stored(raster.clip_raster_to_geometries(runs, src, src_id, grid, "src_id"))
    # people per developed pixel and per unit of ground of each source that has a tile
    has_tile = raster.tiles_of(src, src_id, tiles, grid, "src_id").select("src_id")
    ground = on_area_plane(src.select(src_id, pop, "geom", *BOX), grid.srid)
    rates = (ground.select(F.col(src_id).alias("src_id"), F.col(pop).alias("people"), planar_area(F.col("geom")).alias("m2"))
             .join(has_tile, "src_id", "left_semi").join(raster.clip_count(clips, "src_id"), "src_id", "left")
             .selectExpr("src_id", "try_divide(people, dev) as per_pixel", "try_divide(people, m2) as per_m2"))

    def people(counts, rate, what, *by):
        return counts.join(rates, "src_id").groupBy(*by).agg(F.sum(F.col(rate) * F.col(what)).alias("people"))

    runs_1 = raster.clip_runs(clips, raster.scan_spans(map1, ids[0], grid, "id_1"))
    runs_12 = raster.clip_runs(runs_1, raster.scan_spans(map2, ids[1], grid, "id_2"))
    d_1 = people(raster.clip_count(runs_1, "id_1", "src_id"), "per_pixel", "dev", "id_1")
    d_12 = people(raster.clip_count(runs_12, "id_1", "id_2", "src_id"), "per_pixel", "dev", "id_1", "id_2")

    map1_p, map2_p = on_area_plane(map1, grid.srid), on_area_plane(map2, grid.srid)
    side = cell if grid.srid != LONLAT else cells.choose_cell(ground, map1_p, map2_p)
    s = cells.strips(ground, src_id, side).withColumnRenamed("id", "src_id")
    s_1 = cells.strips(map1_p, ids[0], side).withColumnRenamed("id", "id_1")
    s_2 = cells.strips(map2_p, ids[1], side).withColumnRenamed("id", "id_2")
    in_1 = cells.intersect_strips(s, s_1, ["id_1"], side, (0, 1))
    a_1 = people(cells.ground_by(in_1, side, "id_1", "src_id"), "per_m2", "area", "id_1")
    a_12 = people(cells.overlap_by_pair(in_1, s_2, ["id_1", "src_id"], ["id_2"], side, (0, 2)), "per_m2", "area", "id_1", "id_2")

    near = bbox_join(map1, map2, ids[0], ids[1], ("id_1", "id_2"), cell, (1, 2)).select("id_1", "id_2")
    if min_pop is None:
        # without a floor on people, a first-map area still needs a source with a tile near it
        held = bbox_join(map1, src, ids[0], src_id, ("id_1", "src_id"), cell, (1, 0)).select("id_1", "src_id")
        near = near.join(held.join(has_tile, "src_id", "left_semi"), "id_1", "left_semi")
    people_1 = d_1.withColumnRenamed("people", "d_1").join(a_1.withColumnRenamed("people", "a_1"), "id_1", "full")
    people_12 = d_12.withColumnRenamed("people", "d_12").join(
        a_12.withColumnRenamed("people", "a_12"), ["id_1", "id_2"], "full")
    out = overlap_sum_by_pair(people_1, people_12, near, map1, map2, ids, names, states)
    if min_pop is not None:
        out = out.where((F.col("d_pop_in_s1_s2") > min_pop) | (F.col("a_pop_in_s1_s2") > min_pop))
    return out.orderBy("name_1") if order else out


def overlap_matrix(pairs: DataFrame, names_1: DataFrame, name: str, names_2: Sequence[str], state: str | None = None) -> DataFrame:
    """``NAME, TotalPopulation`` and one column per second-map name, whole people.

    One row per first-map name, or per state and name with the state column of
    ``names_1`` given. A name without any pair has no NAME and no TotalPopulation,
    but zeros in its cells.
    """
    by = ["state"] if state else []
    heads = names_1.select(*([F.col(state).alias("state")] if state else []), F.col(name).alias("name_1")).distinct()
    rows = heads.join(pairs, [*by, "name_1"], "left")
    people = half_even(F.col("d_pop_in_s1_s2"))
    cells_ = [F.coalesce(F.sum(F.when(F.col("name_2") == n, people)), F.lit(0).cast("bigint")).alias(n) for n in names_2]
    out = rows.groupBy(*by, "name_1").agg(F.max(F.when(F.col("name_2").isNotNull(), F.col("name_1"))).alias("NAME"),
                                          F.max(half_even(F.col("d_pop_in_s1"))).alias("TotalPopulation"), *cells_)
    return out.select(*by, "NAME", "TotalPopulation", *quoted(names_2))
