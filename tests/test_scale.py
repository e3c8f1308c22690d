"""Work on large maps is spread over tasks, whatever the files and the number of rasters."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from geoalloc.operators import mosaic, noding
from geoalloc.spec import Grid
from tests.helpers import box, shapes
from tests.test_edges import tangle
from workload import standins as st
from workload.queries import Maps, _dented, _stepped


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """One file each of 11,000 customers, 2,500 suppliers and 600 orders."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.range(25).selectExpr("cast(id as int) as n_nationkey", "cast(id % 5 as int) as n_regionkey").coalesce(1).write.parquet(f"{path}/nation.parquet")
    made = {"customer": (11_000, "id as c_custkey", "cast(id % 25 as int) as c_nationkey", "1.5D as c_acctbal"),
            "supplier": (2_500, "id as s_suppkey", "cast(id % 25 as int) as s_nationkey", "concat('S', id) as s_name"),
            "orders": (600, "id as o_orderkey", "id as o_custkey", "if(id % 2 = 0, '1-URGENT', '5-LOW') as o_orderpriority")}
    for name, (rows, *columns) in made.items():
        spark.range(rows).selectExpr(*columns).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def test_edges_of_a_small_file_are_the_work_of_several_tasks(spark, folder):
    m = Maps(spark, folder)
    dense = _stepped(m, "src_tracts").select("k", "geom"), _stepped(m, "tgt_a", 120).select("id_0", "geom")
    assert [df.rdd.getNumPartitions() for df in dense] == [3, 3]
    assert [df.count() for df in dense] == [11_000, 2_500]
    assert dense[0].agg(F.count_distinct("k"), F.max("k")).first() == (11_000, 10_999)


def test_rings_to_thin_are_dealt_into_tasks(spark, folder):
    sizes = _dented(Maps(spark, folder)).select("k", "geom").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 11_000 and max(sizes) <= st.TASK_ROWS["customer"]


def test_small_polygons_meet_in_place_as_they_do_in_bins(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(str(k), tangle(rng, k % 5)) for k in range(40)]
    rows += [("wide", [[box(0, 0, 3, 3), box(1, 1, 2, 5)], tangle(rng, 2)[0]]), (None, [[box(0, 0, 1, 1), box(0, 0, 1, 1)]]),
             ("again", tangle(rng, 0)), ("again", tangle(rng, 2)), ("empty", [])]
    s = shapes(spark, rows)

    def seen(df):
        # the two edges of a pair may be named in either order only by their own numbers
        return sorted(str(r) for r in df.select("id", "poly", "a_ring", "a_i", "b_ring", "b_i", F.sort_array("cuts").alias("cuts"), "tangled").distinct().collect())

    want = seen(noding.edge_meetings(noding.polygon_edges(s, "id")))
    assert len(want) > 100 and seen(noding.polygon_meetings(s, "id")) == want
    # nothing small is left to the bins
    left = []
    monkeypatch.setattr(noding, "polygon_edges", lambda df, id, was=noding.polygon_edges: left.append(df.count()) or was(df, id))
    noding.polygon_meetings(shapes(spark, [(str(k), [[box(0, 0, 2, 2)]]) for k in range(5)]), "id")
    assert left == [0]


GRIDS = {"west": Grid(0.0, 0.0, 1.0, 1.0, tile=4), "east": Grid(5.0, 0.0, 1.5, 1.5, tile=4)}


def mosaic_tiles(spark):
    pixels = [(f, c, r, 21) for f in GRIDS for c in range(8) for r in range(8)]
    return mosaic.tile_files(spark.createDataFrame(pixels, "filename string, pcol bigint, prow bigint, cls int"), GRIDS)


def test_shapes_meet_files_without_being_shuffled(spark):
    s = shapes(spark, [(str(k), [[box(k, 1, k + 2, 3)]]) for k in range(16)])
    near = mosaic.near_files(s, "id", mosaic_tiles(spark), GRIDS, "geom_id")
    # the box of the west is 0 to 8, of the east 5 to 17
    want = {(str(k), f) for k in range(16) for f, a, b in ((0, 0, 8), (1, 5, 17)) if k <= b and a <= k + 2}
    got = [(r["geom_id"], r["file"]) for r in near.collect()]
    assert set(got) == want and len(got) == len(want)
    assert "SortMergeJoin" not in plan(mosaic.mosaic_spans(s, "id", mosaic_tiles(spark), GRIDS))


def test_rows_of_a_file_are_not_gathered_by_it(spark):
    tiles = mosaic_tiles(spark)
    clips = spark.createDataFrame([("a", 1, 0, 0, 4)], "geom_id string, file bigint, prow bigint, c_from bigint, c_to bigint")
    for df in (tiles, mosaic.ground(clips, GRIDS, "geom_id"), mosaic._numbered(tiles, GRIDS)):
        assert "BroadcastHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)


def test_tiles_are_made_once_for_all_that_reads_them(spark, folder):
    m = Maps(spark, folder)
    for tiles in (m.land["tiles"], m.file_tiles):
        assert "ExistingRDD" in plan(tiles) and "Aggregate" not in plan(tiles) and "MapInPandas" not in plan(tiles)
    assert m.land["tiles"].count() == 13
