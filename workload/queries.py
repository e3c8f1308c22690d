"""One query per operator and job, over the stand-ins of the driver's whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoalloc.functions import columns as cols
from geoalloc.functions import measures as ms
from geoalloc.functions.geometry import (
    GEOM_TYPE, MERCATOR, geodesic_area, planar_area, point, project, with_box,
)
from geoalloc.operators import areal, assign, cells, dasymetric, mosaic, outlines, raster, spatial, tables
from geoalloc.plans import jobs
from geoalloc.sources import readers, writers
from geoalloc.spec import InterpolationSpec, SourceSpec, TargetSpec
from workload import standins as st

SPEC = InterpolationSpec.for_vintage(2022)
REGIONS = [f"R{i}" for i in range(5)]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def settle(df: DataFrame) -> DataFrame:
    """Doubles rounded to 4 places, whole numbers as bigint, for the comparison."""
    out = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        if t in ("double", "float"):
            # summation noise off first, then halves away from zero as the SQL side rounds
            col = F.round(col, 9)
            col = F.signum(col) * F.floor(F.abs(col) * 10000.0 + 0.5) / 10000.0
        elif t in ("int", "smallint", "tinyint"):
            col = col.cast("bigint")
        out.append(col.alias(c))
    return df.select(*out)


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = lambda spark, sf_dir: settle(fn(Maps(spark, sf_dir)))
    return fn


class Maps:
    """Stand-ins of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self.made = spark, sf_dir, {}

    def _once(self, key, make):
        if key not in self.made:
            self.made[key] = make()
        return self.made[key]

    def flat(self, name: str) -> DataFrame:
        return self._once(name, lambda: getattr(st, name)(self.spark, self.dir))

    def shapes(self, name: str) -> DataFrame:
        return self._once((name, "geom"), lambda: st.shapes(self.flat(name)))

    @property
    def states(self):
        return self.flat("states")

    @property
    def src(self):
        return self.shapes("src_tracts")

    @property
    def tiles(self):
        return self._once("tiles", lambda: writers.stored(raster.tile_raster(self.flat("pixels"), st.GRID)))

    @property
    def dev_tiles(self):
        return self._once("dev_tiles", lambda: writers.stored(raster.reclass_raster(self.tiles)))

    @property
    def runs(self):
        return self._once("runs", lambda: raster.raster_runs(self.dev_tiles, st.GRID))

    @property
    def file_tiles(self):
        """All pixels as two files: the east has larger pixels and reaches over the west."""
        return self._once("file_tiles", lambda: writers.stored(mosaic.tile_files(st.two_files(self.flat("pixels")), st.GRIDS)))

    @property
    def file_runs(self):
        return self._once("file_runs", lambda: mosaic.mosaic_runs(self.file_tiles, st.GRIDS))

    @property
    def clips(self):
        return raster.clip_raster_to_geometries(self.runs, self.src, "k", st.GRID)

    @property
    def overlaps(self):
        return spatial.overlap_area(self.src, self.shapes("tgt_a"), "k", "id_0")

    @property
    def weighted(self):
        """Overlap pairs with share, ground and source values."""
        w = self.overlaps
        shares = areal.source_shares(w, self.src, "k").join(w, ["src_id", "tgt_id"])
        return tables.join_back_measures(shares, self.flat("src_tracts").drop("x0", "y0", "x1", "y1"), "src_id", "k")

    @property
    def land(self):
        return dict(tiles=self.dev_tiles, runs=self.runs, grid=st.GRID)


# --- files and stored tables: written from a table, read back ---------------

@query
def q_read_wide_csv(m):
    path = st.scratch(m.spark)
    m.flat("src_tracts").withColumnRenamed("geoid", "GISJOIN").drop("k").write.option("encoding", "ISO-8859-1").csv(path, header=True)
    return readers.read_wide_csv(m.spark, path, keep=["statefp"])[0]


@query
def q_read_state_dictionary(m):
    path = st.scratch(m.spark)
    flags = {c: F.initcap(F.col(c).cast("string")) for c in ("OneDistrict", "SLDUpperOnly")}
    m.states.withColumns(flags).write.csv(path, header=True)
    return readers.read_state_dictionary(m.spark, path)


@query
def q_read_voterfile_blocks(m):
    """A file for each remainder of the count by four, without some of the small parties."""
    path = st.scratch(m.spark)
    rows = m.flat("vf_blocks").withColumn("f", F.col("party_lib"))
    for f, left_out in enumerate(([], ["party_grn"], ["party_lib"], ["party_lib", "party_grn"])):
        own = rows.where(F.col("f") == f).drop("f", *left_out)
        own.select("geoid20", *reversed(own.columns[1:])).write.csv(f"{path}/{f}", header=True)
    return readers.read_voterfile_blocks(m.spark, [f"{path}/{f}" for f in range(4)])


@query
def q_write_csv_fixed(m):
    path = st.scratch(m.spark)
    src = m.flat("src_tracts").select("geoid", "statefp", "k", (F.col("AQNFE001") / 8).alias("eighths"), (F.col("AQRAE001") * 1.0).alias("income"))
    writers.write_csv_fixed(src, path, partition_by=["statefp"])
    return m.spark.read.csv(path, header=True, schema="geoid string, k string, eighths string, income string, statefp bigint")


@query
def q_write_map_stats(m):
    path = st.scratch(m.spark)
    shapes = m.shapes("tgt_a").withColumns({"id": F.col("id_0"), "color": F.lit("red"), "opacity": F.lit(0.5)})
    writers.write_map_stats(shapes, path)
    return m.spark.read.csv(path, header=True, schema="id_0 bigint, name string, statefp bigint")


def _corners(shapes, *keys):
    p = shapes.select(*keys, F.posexplode(F.expr("geom.polys[0][0]")).alias("n", "p"))
    return p.select(*keys, "n", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


@query
def q_write_geojson(m):
    """One feature a line, in folders by state, read back by lines."""
    path = st.scratch(m.spark)
    writers.write_geojson(outlines.to_geojson_features(m.src.select("geoid", "statefp", "geom"), keep=["statefp"]), path, ["statefp"])
    return _corners(readers.read_geojson_shapes(m.spark, f"{path}/*/*.txt", "geoid:string,statefp:bigint", srid=0, lines=True), "geoid", "statefp")


@query
def q_read_geojson_shapes(m):
    """A FeatureCollection for each state, read back in blocks."""
    path = st.scratch(m.spark)
    features = outlines.to_geojson_features(m.src.withColumn("state", F.col("statefp")).select("geoid", "statefp", "state", "geom"), keep=["state"])
    writers.write_feature_collections(features, path, "state")
    return _corners(readers.read_geojson_shapes(m.spark, f"{path}/*/*.txt", "geoid:string,statefp:bigint", srid=0), "geoid", "statefp")


@query
def q_read_shapefile_shapes(m):
    path = st.scratch(m.spark)
    st.write_shapefiles(m.src, path, "statefp", "geoid")
    read = readers.read_shapefile_shapes(m.spark, path, ["GEOID"], srid=0, range_bytes=1 << 16)
    return _corners(read.select(F.col("GEOID").alias("geoid"), F.col("id_0").alias("record"), "geom"), "geoid", "record")


@query
def q_materialize_table(m):
    name = f"tracts_{uuid.uuid4().hex}"
    return writers.materialize_table(m.flat("src_tracts"), name, partition_by=["statefp"], cluster_by=["statefp", "geoid"])


@query
def q_materialize_cells(m):
    """Tract cells stored in buckets, met by district cells: pairs that share a cell."""
    cell = 16 * st.UNIT
    kept = writers.materialize_table(cells.box_cells(m.src, cell, "k"), f"cells_{uuid.uuid4().hex}", bucket_by=["cx", "cy"], buckets=8)
    met = kept.select("cx", "cy", "k").join(cells.box_cells(m.shapes("tgt_a"), cell, "id_0").select("cx", "cy", "id_0").hint("merge"), ["cx", "cy"])
    return met.groupBy("k", "id_0").agg(F.count("*").alias("cells"))


@query
def q_append_keyed(m):
    name = f"tracts_{uuid.uuid4().hex}"
    src = m.flat("src_tracts").select("geoid", "statefp", "AQNFE001")
    for rest in range(2):
        writers.append_keyed(src.where(F.col("statefp") % 2 == rest), name, "geoid")
    return m.spark.table(name)


@query
def q_assert_unique_key(m):
    return writers.assert_unique_key(m.flat("src_tracts"), "geoid")


@query
def q_skip_if_current(m):
    """Which of the tables have a copy that need not be made again."""
    path, out = st.scratch(m.spark), None
    for name in ("customer", "supplier", "orders"):
        st.table(m.spark, m.dir, name).groupBy().count().write.parquet(f"{path}/{name}")
        made, none = (writers.skip_if_current(m.spark, f"{path}/{n}", [f"{m.dir}/{name}.parquet"]) for n in (name, f"no-{name}"))
        row = m.spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("name"), F.col("count").alias("rows"), F.lit(made).alias("made"), F.lit(none).alias("none"))
        out = row if out is None else out.unionByName(row)
    return out


@query
def q_rebuild_stale(m):
    """People by state, built for all and again after one state's rows changed: only that one runs twice."""
    path, src, runs = st.scratch(m.spark), m.flat("src_tracts"), []
    for more in (0, 1):
        rows = src.select("geoid", "statefp", (F.col("AQNFE001") + F.when(F.col("statefp") == 7, more).otherwise(0)).alias("people"))
        runs.append(writers.rebuild_stale(m.spark, path, {"tracts": rows}, lambda own: own["tracts"].groupBy("statefp").agg(F.sum("people").alias("people"), F.count("*").alias("tracts")), "statefp"))
    found = m.spark.read.csv(path, header=True, schema="people bigint, tracts bigint, statefp bigint")
    return found.select("statefp", "people", "tracts", *(F.col("statefp").cast("string").isin(r).alias(f"run_{i}") for i, r in enumerate(runs)))


@query
def q_validate_common_columns(m):
    return cols.validate_common_columns(m.flat("src_tracts"), ["geoid", "statefp", "AQNFE001"]).select("geoid", "statefp", "AQNFE001")


# --- columns ---------------------------------------------------------------

@query
def q_select_by_pattern(m):
    return cols.select_by_pattern(m.flat("src_tracts"), r"A[QR]..E\d\d\d", "fullmatch", keep=["geoid"])


@query
def q_drop_by_pattern(m):
    return cols.drop_by_pattern(m.flat("vf_blocks"), tables.VOTER_COLUMNS_DROPPED)


@query
def q_extensive_columns(m):
    df = m.flat("src_tracts")
    return df.select("geoid", *cols.extensive_columns(df, SPEC))


@query
def q_derive_census_groups(m):
    return cols.derive_census_groups(m.flat("code_table"))


@query
def q_derive_citizen_groups(m):
    return cols.derive_citizen_groups(m.flat("code_table"))


@query
def q_add_pop_income(m):
    return ms.add_pop_income(m.flat("src_tracts"), "AQNFE001", "AQRAE001").select("geoid", "TotalPopulation", "TotalIncome")


@query
def q_add_source_density_terms(m):
    df = m.src.withColumns({"SqKm": planar_area(F.col("geom")) / 1e6, "TotalPopulation": F.col("AQNFE001")})
    return ms.add_source_density_terms(df).select("geoid", "SqKmPop", "PWLogPopPerSqKm")


@query
def q_add_district_measures(m):
    df = ms.add_target_area(m.shapes("tgt_a")).withColumns({
        "DistrictName": F.col("name"), "TotalPopulation": F.col("id_0") * 7 + 1, "PerCapitaIncome": F.col("id_0") + 1000.0,
        "AQM4E002": F.col("id_0") * 3})
    df = df.withColumn("PopPerSqKm", F.col("TotalPopulation") / F.col("SqKm"))
    df = df.withColumn("pwPopPerSqKm", F.col("PopPerSqKm") * 1.5)
    return ms.add_district_measures(df, "StateUpper", F.col("statefp"))


@query
def q_add_tract_measures(m):
    df = m.src.select(F.lit("S").alias("StateAbbreviation"), F.col("geoid").alias("TractId"),
                      F.col("AQNFE001").alias("TotalPopulation"), F.col("AQRAE001").alias("PerCapitaIncome"),
                      (planar_area(F.col("geom")) / 1e6).alias("SqKm"), "AQM4E002")
    return ms.add_tract_measures(df)


@query
def q_add_areal_measures(m):
    df = ms.add_pop_income(m.src, "AQNFE001", "AQRAE001")
    df = ms.add_source_density_terms(ms.add_target_area(df))
    return ms.add_areal_measures(df).select("geoid", "PerCapitaIncome", "PopPerSqMile", "pwPopPerSqMile")


@query
def q_add_target_area(m):
    return ms.add_target_area(m.shapes("tgt_b")).select("id_0", "SqMiles", "SqKm")


@query
def q_attach_state_fips(m):
    df = cols.attach_state_fips(m.flat("tgt_a"), 8, "A")
    return cols.attach_state_fips(df, "statefp", "B").select("id_0", "A", "B")


@query
def q_filter_state(m):
    return tables.filter_state(m.flat("src_tracts"), 7).select("geoid")


@query
def q_filter_territories(m):
    return tables.filter_territories(m.flat("src_tracts")).select("geoid")


@query
def q_filter_populated(m):
    return tables.filter_populated(m.flat("src_tracts"), "AQNFE001").select("geoid", "AQNFE001")


@query
def q_filter_excluded_ids(m):
    return tables.filter_excluded_ids(m.flat("tgt_b"), "name", ["U1", "U5", "U77"]).select("name")


@query
def q_drop_placeholder_districts(m):
    named = m.flat("tgt_a").withColumn("code", F.expr("if(id_0 % 9 = 0, 'ZZ', cast(id_0 as string))"))
    return tables.drop_placeholder_districts(named, "code").select("id_0", "code")


@query
def q_prefix_match(m):
    return tables.prefix_match(m.flat("src_tracts"), "geoid", "03").select("geoid")


@query
def q_valid_block_rows(m):
    return tables.valid_block_rows(m.flat("vf_blocks")).select("geoid20")


@query
def q_split_geoid(m):
    return tables.split_geoid(m.flat("vf_blocks")).select("geoid20", *tables.BLOCK_PART_NAMES)


@query
def q_fold_other_parties(m):
    return tables.fold_other_parties(m.flat("vf_blocks"))


@query
def q_round_counts(m):
    df = m.flat("src_tracts").select("geoid", (F.col("k") * 2.5).alias("even"), (F.col("k") * -1.7).alias("cut"))
    return cols.round_counts(cols.round_counts(df, ["even"]), ["cut"], "truncate")


@query
def q_format_numbers(m):
    df = m.flat("src_tracts").select("geoid", "AQM4E002", (F.col("k") * 2.5).alias("n"), (F.col("k") / 8.0).alias("m"))
    return cols.format_numbers(df, ["AQM4E002", "n"], ["m"])


@query
def q_rename_columns(m):
    return cols.rename_columns(m.flat("tgt_a").select("statefp", "name"), {"statefp": "StateFIPS", "name": "DistrictName"})


# --- attribute joins -------------------------------------------------------

def _half_tables(m):
    df = m.flat("src_tracts").withColumn("GISJOIN", F.concat(F.lit("G"), F.col("k").cast("string")))
    common = [F.lit("x").alias(c) for c in ("STUSAB", "COUNTY", "COUNTYA", "GEO_ID")]
    return (df.where("k % 10 <> 3").select("GISJOIN", *common, "AQM4E002", "AQPZE003"),
            df.select("GISJOIN", *common, "AQNFE001", "AQRAE001"))


@query
def q_join_attribute_tables(m):
    a, b = (cols.select_by_pattern(t, r"^[A-Z0-9]+E\d+$", keep=["GISJOIN"]) for t in _half_tables(m))
    return tables.join_attribute_tables([a, b])


@query
def q_join_shapes_with_data(m):
    shapes = m.src.select(F.concat(F.lit("G"), F.col("k").cast("string")).alias("GISJOIN"), "geom")
    out = tables.join_shapes_with_data(shapes, _half_tables(m)[0])
    return out.select("GISJOIN", "AQM4E002", (planar_area(F.col("geom")) / 1e6).alias("km2"))


@query
def q_build_data_geometries(m):
    shapes = m.src.select(F.concat(F.lit("G"), F.col("k").cast("string")).alias("gisjoin"), "geoid", "geom", "statefp")
    out = tables.build_data_geometries(shapes, list(_half_tables(m)))
    return out.select("gisjoin", "geoid", "statefp", "AQM4E002", "AQPZE003", "AQNFE001", "AQRAE001",
                      (planar_area(F.col("geom")) / 1e6).alias("km2"))


@query
def q_join_states(m):
    return tables.join_states(m.flat("src_tracts"), m.states).select("geoid", "StateAbbreviation", "OneDistrict")


@query
def q_join_back_measures(m):
    return tables.join_back_measures(m.overlaps, m.flat("src_tracts").select("k", "AQNFE001"), "src_id", "k")


@query
def q_positional_concat(m):
    est = areal.areal_interpolate_extensive(m.src, m.shapes("tgt_a"), ["AQM4E002"], "k", "id_0")
    return tables.positional_concat(m.flat("tgt_a").select("id_0", "name"), est, "id_0", "id_0")


# --- spatial joins ---------------------------------------------------------

@query
def q_bbox_join(m):
    return spatial.bbox_join(m.src, m.shapes("tgt_a"), "k", "id_0").select("src_id", "tgt_id")


@query
def q_spatial_join_intersects(m):
    return spatial.spatial_join_intersects(m.src, m.shapes("tgt_a"), "k", "id_0")


@query
def q_spatial_join_overlaps_or_contains(m):
    return spatial.spatial_join_overlaps_or_contains(m.src, m.shapes("tgt_a"), "k", "id_0")


@query
def q_intersects_any(m):
    return spatial.intersects_any(m.src, m.shapes("tgt_a"), "k", "id_0").select("geoid")


@query
def q_geometry_predicates(m):
    return spatial.geometry_predicates(m.shapes("tgt_b"), m.src, "id_0", "k", ("tgt_id", "src_id"))


@query
def q_overlap_area(m):
    return m.overlaps


def _stepped(m, name, n=24):
    """The same boxes with ``n`` points on every side: many edges, the same ground."""
    df = m.flat(name)
    x0, y0, x1, y1 = (F.col(c) * st.UNIT for c in ("x0", "y0", "x1", "y1"))

    def side(ax, ay, bx, by):
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: point(ax + (bx - ax) * i / n, ay + (by - ay) * i / n))

    ring = F.concat(side(x0, y0, x1, y0), side(x1, y0, x1, y1), side(x1, y1, x0, y1), side(x0, y1, x0, y0), F.array(point(x0, y0)))
    return with_box(df.withColumn("geom", F.struct(F.lit(0).alias("srid"), F.array(F.array(ring)).alias("polys")).cast(GEOM_TYPE)))


@query
def q_overlap_area_dense(m):
    return spatial.overlap_area(_stepped(m, "src_tracts"), _stepped(m, "tgt_a", 120), "k", "id_0")


def _halved(m, name):
    """Every box as two triangles, which need cuts at a slant."""
    df = m.flat(name)
    x0, y0, x1, y1 = (F.col(c) * st.UNIT for c in ("x0", "y0", "x1", "y1"))
    low = F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y0))
    high = F.array(point(x0, y0), point(x1, y1), point(x0, y1), point(x0, y0))
    df = df.withColumn("ring", F.explode(F.array(low, high)))
    return with_box(df.withColumn("geom", F.struct(F.lit(0).alias("srid"), F.array(F.array("ring")).alias("polys")).cast(GEOM_TYPE)))


@query
def q_overlap_area_triangles(m):
    t = _halved(m, "tgt_a").withColumn("half", F.struct("id_0", F.expr("ring[1].y").alias("n")))
    pairs = spatial.overlap_area(m.src, t, "k", "half")
    return pairs.groupBy("src_id", F.col("tgt_id.id_0").alias("tgt_id")).agg(F.sum("area").alias("area"))


@query
def q_overlap_area_3(m):
    return spatial.overlap_area_3(m.shapes("tgt_a"), m.src, m.shapes("tgt_b"), ("id_0", "k", "id_0"))


# --- sums ------------------------------------------------------------------

@query
def q_sum_all_by_key(m):
    return tables.sum_all_by_key(tables.clean_blocks(m.flat("vf_blocks")))


@query
def q_weighted_extensive_sum(m):
    return m.weighted.groupBy("tgt_id").agg(*ms.weighted_extensive_sum(["AQM4E002", "AQPZE003"], "share"))


@query
def q_weighted_population(m):
    return m.weighted.groupBy("tgt_id").agg(ms.weighted_population("AQNFE001", "share").alias("pop"))


@query
def q_weighted_intensive_mean(m):
    return m.weighted.groupBy("tgt_id").agg(
        ms.weighted_intensive_mean("AQRAE001", "AQNFE001", "share").alias("kept"),
        ms.weighted_intensive_mean("AQRAE001", "AQNFE001", "share", "skip").alias("skipped"))


@query
def q_density(m):
    return m.weighted.groupBy("tgt_id").agg(ms.density("AQNFE001", "area", "share").alias("per_km2"))


@query
def q_pop_weighted_log_density(m):
    return m.weighted.groupBy("tgt_id").agg(ms.pop_weighted_log_density("AQNFE001", "area", "share").alias("pw_per_km2"))


# --- simple areal ----------------------------------------------------------

COUNTS = ["AQNFE001", "AQM4E002", "AQPZE003"]


@query
def q_areal_interpolate_extensive(m):
    return areal.areal_interpolate_extensive(m.src, m.shapes("tgt_a"), COUNTS, "k", "id_0")


@query
def q_areal_interpolate_extensive_source_area(m):
    return areal.areal_interpolate_extensive(m.src, m.shapes("tgt_a"), COUNTS, "k", "id_0", allocate_total=False)


@query
def q_areal_interpolate_intensive(m):
    return areal.areal_interpolate_intensive(m.src, m.shapes("tgt_b"), ["AQRAE001", "AQM4E002"], "k", "id_0")


@query
def q_one_hot_shares(m):
    return areal.one_hot_shares(m.src, m.shapes("tgt_b"), "k", "id_0")


@query
def q_population_overlaps(m):
    return areal.population_overlaps(m.src, m.shapes("tgt_b"), m.shapes("tgt_a"), "AQNFE001", "k", "id_0", "id_0", "name", "name")


# --- rasters ---------------------------------------------------------------

@query
def q_tile_raster(m):
    return m.tiles.select("rid", "filename", "ulx", "uly", "cols", "rows", F.hex("band").alias("band"))


@query
def q_reclass_raster(m):
    n = F.col("c_to") - F.col("c_from")
    return m.runs.groupBy("rid", "prow").agg(F.sum(n).alias("dev"), F.min("c_from").alias("first"), F.max("c_to").alias("last"))


@query
def q_clip_raster_to_geometries(m):
    return m.clips.select("geom_id", "rid", "prow", "c_from", "c_to")


@query
def q_clip_count(m):
    return raster.clip_count(m.clips, "geom_id")


@query
def q_clip_developed_area(m):
    return raster.clip_developed_area(m.clips, st.GRID, "geom_id", "rid")


@query
def q_clip_envelope_area(m):
    pairs = spatial.bbox_join(m.src, m.shapes("tgt_a"), "k", "id_0")
    return raster.clip_envelope_area(pairs, raster.tiles_of(m.src, "k", m.tiles, st.GRID, "src_id"), st.GRID)


@query
def q_raster_union_by_geom(m):
    return raster.raster_union_by_geom(m.clips)


@query
def q_tile_raster_files(m):
    return m.file_tiles.select("filename", "tx", "ty", "ulx", "uly", "px_w", "cols", "rows", F.hex("band").alias("band"))


@query
def q_mosaic_clips(m):
    clips = raster.clip_runs(m.file_runs, mosaic.mosaic_spans(m.src, "k", m.file_tiles, st.GRIDS))
    return mosaic.ground(clips, st.GRIDS, "geom_id", "file")


# --- dasymetric ------------------------------------------------------------

@query
def q_raster_weight_by_pair(m):
    return dasymetric.dasymetric_weights(m.src, m.shapes("tgt_a"), src_id="k", tgt_id="id_0", **m.land)


@query
def q_dasymetric_interpolate(m):
    return dasymetric.dasymetric_interpolate(m.src, m.shapes("tgt_a"), spec=SPEC, **m.land)


@query
def q_dasymetric_interpolate_nomap(m):
    return dasymetric.dasymetric_interpolate(m.src, m.shapes("tgt_b"), spec=SPEC, area_from="envelope", **m.land)


@query
def q_dasymetric_interpolate_mosaic(m):
    weights = mosaic.mosaic_weights(m.src, m.shapes("tgt_a"), m.file_tiles, m.file_runs, st.GRIDS, "geoid", "id_0")
    out = dasymetric.dasymetric_interpolate(m.src, m.shapes("tgt_a"), m.file_tiles, m.file_runs, st.GRID, SPEC, weights=weights)
    return out.select("ID", "DistrictName", "SqKm", "DevSqKm", "TotalPopulation", "PopPerDevSqKm", "PerCapitaIncome", "AQM4E002", "AQPZE003").where("DevSqKm > 0")


@query
def q_dasymetric_interpolate_preclipped(m):
    return dasymetric.dasymetric_interpolate_preclipped(m.src, m.shapes("tgt_a"), spec=SPEC, **m.land)


def _pairs(m, **options):
    return dasymetric.dasymetric_overlap_pairs(m.shapes("tgt_b"), m.shapes("tgt_a"), m.src, pop="AQNFE001", **m.land, **options)


@query
def q_overlap_sum_by_pair(m):
    return _pairs(m, min_pop=None).groupBy("name_1").agg(
        F.sum("d_pop_in_s1_s2").alias("d_sum"), F.sum("a_pop_in_s1_s2").alias("a_sum"), F.count("*").alias("pairs"))


@query
def q_dasymetric_overlap_pairs(m):
    return _pairs(m)


@query
def q_dasymetric_overlap_pairs_v1(m):
    return _pairs(m, min_pop=None)


@query
def q_dasymetric_overlap_pairs_v2(m):
    return _pairs(m, min_pop=1.0, order=True)


def _matrix_pairs(m):
    return dasymetric.dasymetric_overlap_pairs(m.shapes("tgt_a"), m.shapes("tgt_r"), m.src, pop="AQNFE001", **m.land)


@query
def q_overlap_matrix(m):
    return dasymetric.overlap_matrix(_matrix_pairs(m), m.flat("tgt_a"), "name", REGIONS)


@query
def q_pivot_overlaps(m):
    o = spatial.overlap_area(m.shapes("tgt_b"), m.shapes("tgt_r"), "id_0", "id_0").join(
        m.flat("tgt_r").select(F.col("id_0").alias("tgt_id"), "name"), "tgt_id")
    return areal.pivot_overlaps(o, ["src_id"], "name", "area", REGIONS)


# --- assignment ------------------------------------------------------------

@query
def q_tracts_by_district(m):
    return assign.tracts_by_district(m.src, m.shapes("tgt_b"), tables.state_selection(m.states, "upper"), "StateUpper")


@query
def q_at_large_tracts(m):
    return assign.at_large_tracts(m.flat("src_tracts"), tables.state_selection(m.states, "at_large"))


@query
def q_tract_assignment(m):
    return assign.tract_assignment(m.src, m.states, m.shapes("tgt_a"), m.shapes("tgt_b"), m.shapes("tgt_b"))


@query
def q_tract_measures(m):
    return assign.tract_measures(m.src, m.states, SPEC)


# --- geometry --------------------------------------------------------------

@query
def q_planar_area(m):
    return _halved(m, "tgt_b").groupBy("id_0").agg(F.sum(planar_area(F.col("geom"))).alias("area"))


@query
def q_geodesic_area(m):
    return st.lonlat(m.flat("src_tracts")).select("geoid", (geodesic_area(F.col("geom")) * 1e-6).alias("km2"))


@query
def q_geodesic_overlap_area(m):
    src, tgt = st.lonlat(m.flat("src_tracts")), st.lonlat(m.flat("tgt_a"))
    o = spatial.overlap_area(src, tgt, "k", "id_0", srid=4326)
    return o.select("src_id", "tgt_id", (F.col("area") * 1e-6).alias("km2"))


@query
def q_project(m):
    p = project(st.lonlat(m.flat("tgt_a")), MERCATOR)
    return p.select("id_0", *[F.round(c, 3).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query
def q_repair_geometries(m):
    x0, y0, x1, y1 = (F.col(c) * st.UNIT for c in ("x0", "y0", "x1", "y1"))
    a, b, c, d = point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)
    ring = F.when(F.col("k") % 5 == 0, F.array(a, c, b, d)).otherwise(F.array(a, a, b, c, c, d))
    spot = F.array(a, a, a)
    raw = m.flat("src_tracts").withColumn(
        "geom", F.struct(F.lit(0).alias("srid"), F.array(F.array(ring, spot)).alias("polys")).cast(GEOM_TYPE))
    out = outlines.repair_geometries(with_box(raw), "k")
    rings = out.select("k", "repaired", F.posexplode("geom.polys").alias("poly", "rings")).select("k", "repaired", "poly", F.posexplode("rings").alias("ring", "points"))
    return rings.select("k", "repaired", "poly", "ring", F.posexplode("points").alias("n", "p")).select("k", "repaired", "poly", "ring", "n", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


@query
def q_shared_edges(m):
    return outlines.shared_edges(m.src, "k")


def _points(df, *keys):
    """Every point of single rings, in order."""
    p = df.select(*keys, F.posexplode(F.expr("geom.polys[0][0]")).alias("n", "p"))
    return p.select(*keys, "n", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


@query
def q_project_points(m):
    p = _points(project(st.lonlat(m.flat("tgt_a")), MERCATOR), "id_0")
    return p.select("id_0", "n", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


def _dented(m):
    """Tracts with a slight bend in two sides and a straight point in the others."""
    x0, y0, x1, y1 = (F.col(c) * st.UNIT for c in ("x0", "y0", "x1", "y1"))
    mid = (x0 + x1) / 2
    ring = F.array(point(x0, y0), point(mid, y0 + 5), point(x1, y0), point(x1, (y0 + y1) / 2), point(x1, y1),
                   point(mid, y1 + 5), point(x0, y1), point(x0, (y0 + y1) / 2), point(x0, y0))
    return with_box(m.flat("src_tracts").withColumn(
        "geom", F.struct(F.lit(0).alias("srid"), F.array(F.array(ring)).alias("polys")).cast(GEOM_TYPE)))


@query
def q_simplify(m):
    out = outlines.simplify(_dented(m), "k", 10.0, srid=0)
    return out.select("k", F.size(F.expr("geom.polys[0][0]")).alias("points"), planar_area(F.col("geom")).alias("area"))


@query
def q_simplify_points(m):
    return _points(outlines.simplify(_dented(m), "k", 10.0, srid=0), "k").drop("n").distinct()


def _feature_points(df):
    """Every point of the features' outer rings, by position."""
    f = "feature"
    return df.select(F.get_json_object(f, "$.properties.geoid").alias("geoid"), F.posexplode(F.from_json(
        F.get_json_object(f, "$.geometry.coordinates[0]"), "array<array<double>>")).alias("n", "p")).select(
        "geoid", "n", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


@query
def q_to_geojson_points(m):
    return _feature_points(outlines.to_geojson_features(st.lonlat(m.flat("src_tracts"))))


@query
def q_job_export_geojson_points(m):
    p = _feature_points(jobs.job_export_geojson(st.lonlat(m.flat("src_tracts")), "k"))
    return p.select("geoid", F.round("x", 4).alias("x"), F.round("y", 4).alias("y")).distinct()


def _feature_fields(df):
    f = "feature"
    return df.select(
        F.get_json_object(f, "$.type").alias("type"), F.get_json_object(f, "$.geometry.type").alias("kind"),
        F.get_json_object(f, "$.properties.geoid").alias("geoid"),
        F.get_json_object(f, "$.properties.AQRAE001").cast("bigint").alias("income"),
        F.get_json_object(f, "$.geometry.coordinates[0][2][0]").cast("double").alias("x"),
        F.get_json_object(f, "$.geometry.coordinates[0][2][1]").cast("double").alias("y"))


@query
def q_to_geojson_features(m):
    return _feature_fields(outlines.to_geojson_features(st.lonlat(m.flat("src_tracts"))))


@query
def q_collect_features(m):
    f = outlines.to_geojson_features(st.lonlat(m.flat("tgt_a")), keep=["statefp"])
    c = outlines.collect_features(f, ["statefp"])
    return c.select("statefp", F.get_json_object("collection", "$.type").alias("type"),
                    F.json_array_length(F.get_json_object("collection", "$.features")).alias("n"))


# --- sets ------------------------------------------------------------------

@query
def q_order_by_name(m):
    return tables.order_by_name(m.flat("tgt_b").select("name", "id_0"), "name")


@query
def q_first_row(m):
    return tables.first_row(m.tiles.select("rid", "cols", "rows"), "rid")


@query
def q_union_all_frames(m):
    parts = [m.flat(n).select("id_0", "name", F.lit(n).alias("map")) for n in ("tgt_a", "tgt_b", "tgt_r")]
    return tables.union_all_frames(parts)


@query
def q_state_selection(m):
    return tables.union_all_frames([
        tables.state_selection(m.states, c).select(F.lit(c).alias("chamber"), "StateAbbreviation")
        for c in ("congressional", "at_large", "upper", "lower", "overlap")])


# --- jobs ------------------------------------------------------------------

@query
def q_job_attribute_table(m):
    codes = m.flat("code_table")
    shapes = m.src.select(F.concat(F.lit("G"), F.col("k").cast("string")).alias("GISJOIN"), "geom", "xmin", "ymin", "xmax", "ymax")
    districts = m.shapes("tgt_a").withColumns({
        "STATEFP": F.col("statefp").cast("string"),
        "CD116FP": F.expr("if(id_0 % 9 = 0, 'ZZ', lpad(cast(id_0 as string), 4, '0'))")}) \
        .select("id_0", F.col("STATEFP"), "CD116FP", "geom", "xmin", "ymin", "xmax", "ymax")
    tract_tables = [codes.select("GISJOIN", *[c for c in codes.columns if c.startswith("JWBE")]), codes.select("GISJOIN", "JMAE001")]
    return jobs.job_attribute_table(codes, shapes, tract_tables, shapes, districts)


@query
def q_job_aggregate_districts(m):
    a, b = (cols.select_by_pattern(t, r"^[A-Z0-9]+E\d+$", keep=["GISJOIN"]) for t in _half_tables(m))
    shapes = m.src.select(F.concat(F.lit("G"), F.col("k").cast("string")).alias("GISJOIN"),
                          F.col("statefp").alias("STATEFP"), "geom", "xmin", "ymin", "xmax", "ymax")
    districts = m.shapes("tgt_a").withColumnRenamed("statefp", "st").withColumnRenamed("name", "NAME")
    return jobs.job_aggregate_districts(
        [a, b], shapes, districts, SourceSpec.for_vintage(2022), TargetSpec("Congressional", state="st"),
        ["AQM4E002", "AQPZE003"])


@query
def q_job_dasymetric_districts(m):
    maps = {"Congressional": m.shapes("tgt_a"), "StateUpper": m.shapes("tgt_b")}
    return jobs.job_dasymetric_districts(m.src, maps, spec=SPEC, **m.land)


@query
def q_job_sld_cd_overlaps(m):
    return jobs.job_sld_cd_overlaps(m.src, m.shapes("tgt_b"), m.shapes("tgt_r"), pop="AQNFE001", names_2=REGIONS, **m.land)


def _renamed(m, table, prefix, n):
    """A map whose names repeat in every state."""
    return m.shapes(table).withColumn("name", F.concat(F.lit(prefix), (F.col("id_0") % n).cast("string")))


@query
def q_job_sld_cd_overlaps_states(m):
    return jobs.job_sld_cd_overlaps(m.src, _renamed(m, "tgt_b", "N", 2), _renamed(m, "tgt_a", "R", 5), pop="AQNFE001",
                                    names_2=REGIONS, state="statefp", **m.land)


@query
def q_job_areal_overlaps_states(m):
    return jobs.job_areal_overlaps(m.src, _renamed(m, "tgt_a", "R", 5), _renamed(m, "tgt_b", "N", 2), "AQNFE001", REGIONS, "k",
                                   state="statefp")


@query
def q_job_areal_overlaps(m):
    return jobs.job_areal_overlaps(m.src, m.shapes("tgt_r"), m.shapes("tgt_a"), "AQNFE001", REGIONS, "k")


@query
def q_job_tract_measures(m):
    return jobs.job_tract_measures(m.src, m.states, SPEC)


@query
def q_job_tract_assignment(m):
    return jobs.job_tract_assignment(m.src, m.states, m.shapes("tgt_b"), m.shapes("tgt_a"), m.shapes("tgt_b"))


@query
def q_job_voterfile_tracts(m):
    return jobs.job_voterfile_tracts(m.flat("vf_blocks"))


@query
def q_job_build_data_geometries(m):
    shapes = m.src.select(F.concat(F.lit("G"), F.col("k").cast("string")).alias("gisjoin"), "geoid", "geom", "statefp")
    out = jobs.job_build_data_geometries(shapes, list(_half_tables(m)))
    return out.select("gisjoin", "geoid", "AQM4E002", "AQPZE003", "AQNFE001", "AQRAE001")


@query
def q_job_tract_rasters(m):
    return jobs.job_tract_rasters(m.tiles, m.src, st.GRID, SPEC).select("geom_id", "rid", "prow", "c_from", "c_to")


@query
def q_job_export_geojson(m):
    out = jobs.job_export_geojson(st.lonlat(m.flat("src_tracts")), "k")
    f = "feature"
    return out.select("statefp", F.get_json_object(f, "$.type").alias("type"), F.get_json_object(f, "$.geometry.type").alias("kind"),
                      F.get_json_object(f, "$.properties.geoid").alias("geoid"),
                      F.json_array_length(F.get_json_object(f, "$.geometry.coordinates[0]")).alias("points"))
