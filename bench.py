"""Times the headline queries once each and prints one JSON line.

``BENCH_SF_DIR`` (default the sf0.1 tables) and ``BENCH_CPUS`` (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "areal_interpolate_extensive", "areal_interpolate_intensive", "overlap_area", "overlap_area_3",
    "spatial_join_intersects", "tract_assignment", "population_overlaps", "tile_raster", "clip_raster_to_geometries",
    "dasymetric_interpolate", "dasymetric_interpolate_preclipped", "dasymetric_overlap_pairs", "overlap_matrix",
    "job_aggregate_districts", "job_attribute_table", "job_voterfile_tracts", "job_tract_measures",
    "shared_edges", "simplify", "job_export_geojson",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="geoalloc-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.codegen.cache.maxEntries", "2000")
             .config("spark.checkpoint.dir", f"{work}/checkpoints").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["areal_interpolate_extensive"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    took = {}
    for name in names:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - t, 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
