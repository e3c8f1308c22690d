"""End-to-end jobs: each is one lazy plan over whole tables, for all states at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoalloc.functions.columns import (
    CENSUS_GROUPS, CITIZEN_GROUPS, TRACT_POPULATION, attach_state_fips, derive_census_groups, derive_citizen_groups,
    format_numbers, quoted, rename_columns,
)
from geoalloc.functions.geometry import BOX, LONLAT, MERCATOR, area, project
from geoalloc.functions.measures import (
    add_areal_measures, add_district_measures, add_pop_income, add_source_density_terms, add_target_area,
    add_tract_measures,
)
from geoalloc.operators import areal, assign, dasymetric, outlines, raster
from geoalloc.operators.spatial import overlap_area
from geoalloc.operators.tables import (
    build_data_geometries, clean_blocks, drop_placeholder_districts, join_attribute_tables, join_shapes_with_data,
    positional_concat, sum_all_by_key, union_all_frames,
)
from geoalloc.sources.writers import assert_unique_key, skip_if_current, write_csv_fixed
from geoalloc.spec import MEASURES, Grid, InterpolationSpec, SourceSpec, TargetSpec


def run_if_stale(spark: SparkSession, output: str, inputs: Sequence[str], build: Callable[[], DataFrame],
                 decimals: int = 2, partition_by: Sequence[str] = ()) -> bool:
    """Builds and writes a table unless it is newer than all its inputs; True if it ran."""
    if skip_if_current(spark, output, inputs):
        return False
    write_csv_fixed(build(), output, decimals, partition_by)
    return True


def on_web_plane(shapes: DataFrame, srid: int) -> DataFrame:
    """Overlaps of the simple areal jobs are taken on the web Mercator plane."""
    return project(shapes, MERCATOR, LONLAT) if srid == LONLAT else shapes


def job_attribute_table(groups: DataFrame, group_shapes: DataFrame, tract_tables: Sequence[DataFrame],
                        tract_shapes: DataFrame, districts: DataFrame, district: str = "CD116FP",
                        state: str = "STATEFP", id: str = "id_0", srid: int = 0, compat: bool = False) -> DataFrame:
    """Block-group and tract counts on one district map, with densities and income."""
    key = "GISJOIN"
    block = join_shapes_with_data(group_shapes, derive_census_groups(groups, (key,), compat), key)
    tracts = join_shapes_with_data(
        tract_shapes, join_attribute_tables([derive_citizen_groups(t, (key,)) for t in tract_tables], key), key)
    d = on_web_plane(districts, srid)
    counts, people = list(CENSUS_GROUPS), [*TRACT_POPULATION, *CITIZEN_GROUPS]
    by_group = areal.areal_interpolate_extensive(on_web_plane(block, srid), d, counts, key, id)
    by_tract = areal.areal_interpolate_extensive(on_web_plane(tracts, srid), d, people, key, id)
    heads = add_target_area(districts, srid).select(id, state, district, "SqMiles")
    out = positional_concat(positional_concat(heads, by_group, id, id), by_tract, id, id)
    out = drop_placeholder_districts(out, district)
    out = rename_columns(out, {state: "StateFIPS", district: "CongressionalDistrict"})
    out = add_areal_measures(out.withColumn("TotalPopulation", F.col("BG_Population")))
    shown = [c for c in counts if c != "TotalIncome"]
    return out.select("StateFIPS", "CongressionalDistrict", *shown, *people, "SqMiles", "PopPerSqMile", "PerCapitaIncome")


def job_aggregate_districts(tables: Sequence[DataFrame], shapes: DataFrame, districts: DataFrame, source: SourceSpec,
                            target: TargetSpec, data_cols: Sequence[str], key: str = "GISJOIN", state: str = "STATEFP",
                            id: str = "id_0", srid: int = 0, formatted: bool = True) -> DataFrame:
    """Census tracts to districts by shared ground, all states in one run."""
    data = add_pop_income(join_attribute_tables(tables, key), source.pop, source.income)
    src = join_shapes_with_data(shapes.withColumn("SqKm", area(F.col("geom"), srid) * 1e-6), data, key)
    src = add_source_density_terms(src)
    tgt = add_target_area(attach_state_fips(districts, target.state), srid)
    cols = ["TotalPopulation", "TotalIncome", "SqKmPop", "PWLogPopPerSqKm", *data_cols]
    src_plane, tgt_plane = on_web_plane(src, srid), on_web_plane(tgt, srid)
    weights = areal.same_state(overlap_area(src_plane, tgt_plane, key, id), src, tgt, key, id, state, "STATEFP")
    est = areal.areal_interpolate_extensive(src_plane, tgt_plane, cols, key, id, weights=weights)
    heads = tgt.select(id, F.col("STATEFP").alias("StateFIPS"), F.col(target.name).alias(target.out_name), "SqMiles", "SqKm")
    out = drop_placeholder_districts(positional_concat(heads, est, id, id), target.out_name)
    out = add_areal_measures(out).withColumn("DistrictType", F.lit(target.district_type))
    if formatted:
        out = format_numbers(out, [*data_cols, "TotalPopulation"], MEASURES)
    return out.select("StateFIPS", "DistrictType", target.out_name, "TotalPopulation", *MEASURES, *quoted(data_cols))


def job_dasymetric_districts(src: DataFrame, maps: dict[str, DataFrame], tiles: DataFrame, runs: DataFrame, grid: Grid,
                             spec: InterpolationSpec, state: str = "statefp", id: str = "id_0", name: str = "name",
                             clips: DataFrame | None = None) -> DataFrame:
    """District tables of the given chambers (kind -> map) by developed land, in one run."""
    keyed = union_all_frames([
        districts.select(F.struct(F.lit(kind).alias("kind"), F.col(state).alias("state"), F.col(id).alias("id")).alias("key"),
                         F.col(name).alias("name"), "geom", *BOX) for kind, districts in maps.items()])
    out = dasymetric.dasymetric_interpolate(src, keyed, tiles, runs, grid, spec, "key", "name", clips=clips)
    return add_district_measures(out, F.col("ID.kind"), F.col("ID.state"))


def job_sld_cd_overlaps(src: DataFrame, map1: DataFrame, map2: DataFrame, tiles: DataFrame, runs: DataFrame, grid: Grid,
                        pop: str, names_2: Sequence[str], src_id: str = "geoid", id: str = "id_0", name: str = "name",
                        clips: DataFrame | None = None, state: str | None = None) -> DataFrame:
    """People of each first-map area by second-map area, by developed land, as a matrix.

    With ``state``, the state column of both maps, areas meet and are added up
    inside their state alone, and rows have the ``state``; names may then repeat. Without
    it a name that occurs twice in a map is an error.
    """
    if state is None:
        map1, map2 = (assert_unique_key(m, name) for m in (map1, map2))
    pairs = dasymetric.dasymetric_overlap_pairs(map1, map2, src, tiles, runs, grid, pop, src_id, (id, id), (name, name),
                                                clips=clips, states=(state, state) if state else None)
    return dasymetric.overlap_matrix(pairs, map1, name, names_2, state)


def job_areal_overlaps(src: DataFrame, components: DataFrame, targets: DataFrame, pop: str, names: Sequence[str],
                       src_id: str = "geoid", id: str = "id_0", name: str = "name", srid: int = 0,
                       state: str | None = None) -> DataFrame:
    """People of each target by component, by shared ground, one column per component.

    With ``state``, the state column of all three maps, every state is a run of
    its own: slivers over its border do not count, and rows have the ``state``. Without it
    a name that occurs twice among the components or the targets is an error.
    """
    if state is None:
        components, targets = (assert_unique_key(m, name) for m in (components, targets))
    src, components, targets = (on_web_plane(x, srid) for x in (src, components, targets))
    long = areal.population_overlaps(src, components, targets, pop, src_id, id, id, name, name, states=(state,) * 3 if state else None)
    by = ["state"] if state else []
    wide = areal.pivot_overlaps(long, ["tgt_id", *by, "name", "TotalPopulation"], "component", "pop", names)
    return wide.select(*by, "name", "TotalPopulation", *quoted(names))


def job_tract_measures(tracts: DataFrame, states: DataFrame, spec: InterpolationSpec, srid: int = 0,
                       state: str = "statefp") -> DataFrame:
    return add_tract_measures(assign.tract_measures(tracts, states, spec, srid, state))


def job_tract_assignment(tracts: DataFrame, states: DataFrame, congressional: DataFrame, upper: DataFrame,
                         lower: DataFrame, **options) -> DataFrame:
    return assign.tract_assignment(tracts, states, congressional, upper, lower, **options)


def job_voterfile_tracts(blocks: DataFrame, key: str = "geoid20", check: bool = False) -> DataFrame:
    """Raw voter-file blocks cleaned and summed to tracts."""
    out = sum_all_by_key(clean_blocks(blocks, key), key=key)
    return assert_unique_key(out, "geoid") if check else out


def job_build_data_geometries(shapes: DataFrame, tables: Sequence[DataFrame], **options) -> DataFrame:
    """Shapes with the census columns of every table, to be stored clustered by place."""
    return build_data_geometries(shapes, tables, **options)


def job_tract_rasters(tiles: DataFrame, src: DataFrame, grid: Grid, spec: InterpolationSpec) -> DataFrame:
    """Land cover to developed land, then each populated tract's own part of it."""
    runs = raster.raster_runs(raster.reclass_raster(tiles), grid)
    return raster.clip_raster_to_geometries(runs, src, spec.id, grid, "geom_id", pop=spec.pop)


def job_export_geojson(shapes: DataFrame, id: str, tolerance_m: float = 10.0, srid: int = LONLAT, maxdec: int = 6,
                       keep: Sequence[str] = ("statefp",)) -> DataFrame:
    """Thinned outlines as GeoJSON features, with the columns to write them by."""
    return outlines.to_geojson_features(outlines.simplify(shapes, id, tolerance_m, srid), maxdec, keep)
