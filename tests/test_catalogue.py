"""Catalogue queries beside their SQL at the smallest scale.

A quick selection by default; ``CATALOGUE=all`` runs every query.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from workload.oracle import ORACLE as SQL
from workload.queries import QUERIES
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"
QUICK = ("areal_interpolate_extensive", "overlap_area_triangles", "tile_raster", "clip_raster_to_geometries",
         "dasymetric_interpolate_preclipped", "job_voterfile_tracts", "job_tract_measures", "format_numbers",
         "geodesic_overlap_area", "job_export_geojson", "tract_assignment")


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("CATALOGUE") == "all" else QUICK)
def test_query_matches_sql(spark, name):
    diff, _ = differences(spark, duck(SF_DIR), SF_DIR, QUERIES[name], SQL[name])
    assert diff is None, diff


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
