from __future__ import annotations

import json
import os
import random
import struct
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoalloc.functions import columns as cols
from geoalloc.functions import measures as ms
from geoalloc.functions.geometry import planar_area
from geoalloc.operators import areal, raster, tables
from geoalloc.plans.jobs import job_voterfile_tracts, run_if_stale
from geoalloc.sources import readers, writers
from geoalloc.spec import Grid, InterpolationSpec
from tests.helpers import box, shapes

SPEC = InterpolationSpec.for_vintage(2022)
GRID = Grid(0.0, 0.0, 1.0, 1.0, tile=8)


def test_three_ways_to_match(spark):
    df = spark.range(1).selectExpr("1 as AQM4E002", "1 as xAQM4E002", "1 as AQM4E002x")
    assert cols.matching(df.columns, r"A...E\d\d\d") == ["AQM4E002", "AQM4E002x"]
    assert cols.matching(df.columns, r"A...E\d\d\d", "fullmatch") == ["AQM4E002"]
    assert cols.matching(df.columns, r"A...E\d\d\d", "search") == df.columns
    assert cols.select_by_pattern(df, "x", "match", keep=["AQM4E002"]).columns == ["AQM4E002", "xAQM4E002"]


def test_extensive_columns_and_compat(spark):
    df = spark.range(1).selectExpr("1 as geoid", "1 as AQRAE001", "1 as AQNFE001", "1 as AQPZE003", "1 as AQM4E002")
    assert cols.extensive_columns(df, SPEC) == ["AQM4E002", "AQPZE003"]
    assert cols.extensive_columns(df, SPEC, compat=True) == ["AQM4E002", "AQPZE003", "AQRAE001"]


def test_groups_and_compat(spark):
    names = [f"{p}{n:03d}" for p, ns in cols.CENSUS_GROUPS.values() for n in ns]
    df = spark.range(1).select(F.lit("g").alias("GISJOIN"), *[F.lit(int(n[-3:])).alias(n) for n in dict.fromkeys(names)])
    assert cols.derive_census_groups(df).first()["E_BA"] == 15 + 32
    assert cols.derive_census_groups(df, compat=True).first()["E_BA"] == 15 + 28
    missing = df.withColumn("JN9E015", F.lit(None).cast("int"))
    assert cols.derive_census_groups(missing).first()["E_BA"] is None


def test_common_columns_are_required(spark):
    with pytest.raises(ValueError, match="GEO_ID"):
        cols.validate_common_columns(spark.range(1).selectExpr("1 as GISJOIN", "1 as STUSAB", "1 as COUNTY", "1 as COUNTYA"))


def test_rounding(spark):
    df = spark.createDataFrame([(2.5, -2.7, 0.125), (3.5, 2.7, 2.675), (None, None, None)], "a double, b double, c double")
    df = cols.round_counts(cols.round_counts(df, ["a"]), ["b"], "truncate")
    assert [(r["a"], r["b"]) for r in df.collect()] == [(2, -2), (4, 2), (None, None)]
    out = cols.format_numbers(df.withColumn("d", F.col("c") * 20), ["a", "d"], ["c"])
    assert [(r["a"], r["d"], r["c"]) for r in out.collect()] == [(2, "2", "0.12"), (4, "54", "2.67"), (None, None, None)]


def test_missing_income_in_the_mean(spark):
    df = spark.createDataFrame([(1.0, 10, 100), (1.0, 30, None)], "rast_wgt double, p int, i int")
    kept, skipped = df.agg(ms.weighted_intensive_mean("i", "p"), ms.weighted_intensive_mean("i", "p", null_mode="skip")).first()
    assert (kept, skipped) == (25.0, 100.0)
    assert df.where("p < 0").agg(ms.density("p", "i")).first()[0] is None
    assert df.withColumn("z", F.lit(0.0)).agg(ms.density("p", "z")).first()[0] is None


def test_states_and_chambers(spark, tmp_path):
    path = str(tmp_path / "states.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write("Name,StateAbbreviation,StateFIPS,OneDistrict,SLDUpperOnly\nA,AK,2,True,False\nN,NE,31,False,True\n"
                "C,CO,8,False,False\nD,DC,11,True,False\nP,PR,72,False,False\n")
    s = readers.read_state_dictionary(spark, path)

    def of(chamber):
        return {r["StateAbbreviation"] for r in tables.state_selection(s, chamber).collect()}
    assert of("congressional") == of("overlap") == {"NE", "CO"} and of("at_large") == {"AK", "DC"}
    assert of("upper") == {"AK", "NE", "CO"} and of("lower") == {"AK", "CO"}
    rows = spark.createDataFrame([("02", 1), ("72", 2), ("31", 3)], "statefp string, v int")
    assert {r["v"] for r in tables.filter_territories(rows).collect()} == {1, 3}
    assert [r["v"] for r in tables.filter_state(rows, 2).collect()] == [1]


def test_wide_csv(spark, tmp_path):
    path = str(tmp_path / "acs.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write("GISJOIN,NAME,AQNFE001,AQNFM001,AQRAE001\nG1,Do\xf1a Ana,5,9,\nG2,X,7,9,12.5\n")
    df, data = readers.read_wide_csv(spark, path, keep=["NAME"])
    assert data == ["AQNFE001", "AQRAE001"] and df.columns == ["GISJOIN", "NAME", *data]
    assert [tuple(r) for r in df.orderBy("GISJOIN").collect()] == [("G1", "Doña Ana", 5.0, None), ("G2", "X", 7.0, 12.5)]


def test_last_table_leads(spark):
    a = spark.createDataFrame([("1", 1), ("3", 3)], "GISJOIN string, a int")
    b = spark.createDataFrame([("1", 1), ("2", 2)], "GISJOIN string, b int")
    out = tables.join_attribute_tables([a, b])
    assert out.columns == ["GISJOIN", "b", "a"]
    assert {tuple(r) for r in out.collect()} == {("1", 1, 1), ("2", 2, None)}
    with pytest.raises(ValueError):
        tables.join_attribute_tables([])


def _voter_folder(tmp_path, second="geoid20,party_oth,party_dem,party_rep,total_reg,party_lib\n120010000020002,,2,1,5,4\n"):
    (tmp_path / "b_co.csv").write_text("geoid20,party_dem,party_rep,party_oth,party_grn,total_reg,votes2020,p1x,reg_pct\n"
                                       "080010001001000,3,2,1,1,9,8,7,0.5\n080010001001001A,1,1,,2,6,5,4,0.5\nunassigned,9,9,9,9,9,9,9,9\n")
    (tmp_path / "c_fl.csv").write_text(second)
    return str(tmp_path)


def test_voter_files(spark, tmp_path):
    blocks = readers.read_voterfile_blocks(spark, _voter_folder(tmp_path))
    assert blocks.columns == ["geoid20", "StateFIPS", "CountyFIPS", "TractId", "BlockId", "party_dem", "party_rep", "party_oth", "total_reg"]
    got = {r["geoid20"]: r for r in blocks.collect()}
    assert set(got) == {"080010001001000", "080010001001001A", "120010000020002"}
    assert got["080010001001001A"]["party_oth"] == 2 and got["080010001001001A"]["BlockId"] == "1001A"
    assert got["120010000020002"]["party_oth"] == 4
    tracts = {r["geoid"]: r["total_reg"] for r in job_voterfile_tracts(blocks, check=True).collect()}
    assert tracts == {"08001000100": 15, "12001000002": 5}


def test_voter_file_without_a_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="total_reg"):
        readers.read_voterfile_blocks(spark, _voter_folder(tmp_path, "geoid20,party_oth,party_dem,party_rep\n120010000020002,1,2,1\n"))


def test_fixed_csv_and_staleness(spark, tmp_path):
    source, out = str(tmp_path / "in.txt"), str(tmp_path / "out")
    with open(source, "w") as f:
        f.write("x")
    df = spark.createDataFrame([("CO", 1, 0.125), ("AK", 2, None)], "s string, n int, d double")
    assert run_if_stale(spark, out, [source], lambda: df, partition_by=["s"])
    back = {r["n"]: (r["d"], r["s"]) for r in spark.read.csv(out, header=True).collect()}
    assert back == {"1": ("0.12", "CO"), "2": (None, "AK")}
    assert not run_if_stale(spark, out, [source], lambda: df)
    later = time.time() + 100
    os.utime(source, (later, later))
    assert not writers.skip_if_current(spark, out, [source])
    writers.write_csv_fixed(df, str(tmp_path / "one"), decimals=1)
    assert {r["d"] for r in spark.read.csv(str(tmp_path / "one"), header=True).collect()} == {"0.1", None}


def test_only_touched_states_are_built_again(spark, tmp_path):
    out = str(tmp_path / "out")

    def run(people, areas, recipe="1"):
        inputs = {"people": spark.createDataFrame(people, "st string, id int, n int").repartition(3), "areas": spark.createDataFrame(areas, "st string, km double")}
        built = []

        def build(own):
            built.extend(r.st for r in own["people"].select("st").distinct().collect())
            return own["people"].groupBy("st").agg(F.sum("n").alias("n")).join(own["areas"], "st")

        return writers.rebuild_stale(spark, out, inputs, build, "st", recipe), sorted(built)

    def folders():
        return {d.name: sorted((f.name, f.stat().st_mtime_ns) for f in d.iterdir()) for d in (tmp_path / "out").iterdir() if d.is_dir()}

    people, areas = [("CO", 1, 5), ("CO", 2, 6), ("AK", 3, 7), ("FL", 4, 8)], [("CO", 1.0), ("AK", 2.0), ("FL", 3.0)]
    assert run(people, areas) == (["AK", "CO", "FL"], ["AK", "CO", "FL"])
    first = folders()
    assert run(people[::-1], areas) == ([], []) and folders() == first
    people[1] = ("CO", 2, 60)
    assert run(people, areas) == (["CO"], ["CO"])
    second = folders()
    assert {s for s in first if first[s] != second[s]} == {"st=CO"}
    areas[2] = ("FL", 3.5)
    assert run(people, areas)[0] == ["FL"]
    assert run(people[:2], areas[:1])[0] == ["AK", "FL"] and set(folders()) == {"st=CO"}
    assert {(r.st, r.n, r.km) for r in spark.read.csv(out, header=True).collect()} == {("CO", "65", "1.00")}
    assert run(people, areas)[0] == ["AK", "FL"] and run(people, areas, "2")[0] == ["AK", "CO", "FL"]


def test_stored_tables_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert writers.materialize_table(df, "geo_t1", cluster_by=["k"]).count() == 2
    assert writers.materialize_table(df.limit(1), "geo_t1").count() == 1
    spark.sql("drop table if exists geo_t2")
    writers.append_keyed(df, "geo_t2", "k")
    writers.append_keyed(df.selectExpr("k + 10 as k", "v"), "geo_t2", "k")
    with pytest.raises(ValueError, match="already stored"):
        writers.append_keyed(df, "geo_t2", "k")
    with pytest.raises(ValueError, match="duplicate"):
        writers.append_keyed(df.selectExpr("7 as k", "v"), "geo_t2", "k")
    assert spark.table("geo_t2").count() == 4
    assert writers.assert_unique_key(df, "k") is df


def test_layouts_of_stored_cells(spark):
    rng = random.Random(2)
    spots = [(rng.choice([0, -1, 1, 5, -2**31, 2**31 - 1, rng.randrange(-2**31, 2**31)]), rng.randrange(-2**31, 2**31)) for _ in range(200)]
    frame = spark.createDataFrame(spots, "cx long, cy long")
    got = [(r.p, r.cx, r.cy) for r in frame.select(writers.curve_place(F.col("cx"), F.col("cy")).alias("p"), "cx", "cy").collect()]

    def plain(x, y):
        x, y = x + 2**31, y + 2**31
        return sum((x >> k & 1) << 2 * k | (y >> k & 1) << 2 * k + 1 for k in range(32))

    assert [(x, y) for _, x, y in sorted(got)] == sorted(spots, key=lambda s: plain(*s))
    grid = spark.range(64 * 64).selectExpr("id % 64 - 32 as cx", "id div 64 - 32 as cy", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small files stay apart
    laid = writers.materialize_table(grid.repartition(3), "laid_cells", curve=("cx", "cy"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    boxes = laid.groupBy(F.input_file_name()).agg((F.max("cx") - F.min("cx") + 1).alias("w"), (F.max("cy") - F.min("cy") + 1).alias("h"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in boxes) == 4096 and len(boxes) > 1 and all(r.w * r.h <= 4 * 4096 / len(boxes) for r in boxes)
    kept = writers.materialize_table(grid, "dealt_cells", bucket_by=["cx", "cy"], buckets=5)
    other = grid.select("cx", "cy", F.col("id").alias("other"))
    j = kept.join(other.hint("merge"), ["cx", "cy"])
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert j.where("id = other").count() == 4096 and plan.count("Exchange hashpartitioning") == 1  # the other side alone
    with pytest.raises(ValueError):
        writers.materialize_table(grid, "none", bucket_by=["cx"], curve=("cx", "cy"))


def test_geojson_files(spark, tmp_path):
    def feature(name, kind, coords):
        return {"type": "Feature", "geometry": {"type": kind, "coordinates": coords}, "properties": {"NAME": name, "pop": 3, "id": 9}}
    fs = [feature("a", "Polygon", [box(0, 0, 2, 2), box(0.5, 0.5, 1, 1)]), feature("b", "MultiPolygon", [[box(0, 0, 1, 1)], [box(5, 5, 6, 6)]])]
    (tmp_path / "m.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": fs}, indent=1))
    (tmp_path / "l.jsonl").write_text("\n".join(json.dumps(f) for f in fs))
    for path, lines in (("m.geojson", False), ("l.jsonl", True)):
        df = readers.read_geojson_shapes(spark, str(tmp_path / path), "NAME:string,pop:bigint", lines=lines)
        got = [(r["id_0"], r["NAME"], r["a"], r["xmax"]) for r in df.select("*", planar_area(F.col("geom")).alias("a")).orderBy("NAME").collect()]
        assert got == [(1, "a", 3.75, 2.0), (2, "b", 2.0, 6.0)]
    out = str(tmp_path / "stats")
    writers.write_map_stats(df.withColumn("color", F.lit("red")).drop("file"), out)
    assert spark.read.csv(out, header=True).columns == ["id_0", "NAME", "pop"]
    writers.write_geojson(df.select(F.col("NAME").alias("s"), F.lit("{}").alias("feature")), str(tmp_path / "gj"), ["s"])
    assert spark.read.text(str(tmp_path / "gj")).count() == 2


def _shapefile(path, records):
    body = b""
    for i, rings in enumerate(records):
        points = [p for r in rings for p in r]
        starts, n = [], 0
        for r in rings:
            starts.append(n)
            n += len(r)
        rec = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(starts)}i", *starts)
        rec += b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">2i", i + 1, len(rec) // 2) + rec
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i", 1000, 5) + b"\0" * 64
    path.with_suffix(".shp").write_bytes(head + body)
    names = [("GISJOIN", 6), ("STATEFP", 2)]
    width = 1 + sum(w for _, w in names)
    dbf = struct.pack("<B3BIHH20x", 3, 1, 1, 1, len(records), 32 + 32 * len(names) + 1, width)
    dbf += b"".join(n.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, w in names) + b"\r"
    dbf += b"".join(b" " + f"G{i}".ljust(6).encode() + b"08" for i in range(len(records)))
    path.with_suffix(".dbf").write_bytes(dbf)


def test_shapefiles(spark, tmp_path):
    cw = [list(reversed(box(0, 0, 4, 4))), box(1, 1, 2, 2)]
    two = [list(reversed(box(0, 0, 1, 1))), list(reversed(box(5, 5, 7, 7)))]
    _shapefile(tmp_path / "tract", [cw, two])
    _shapefile(tmp_path / "group", [[list(reversed(box(0, 0, 3, 3)))]])
    df = readers.read_shapefile_shapes(spark, str(tmp_path), ["GISJOIN", "STATEFP"])
    got = {(r["file"].rsplit("/", 1)[1], r["id_0"], r["GISJOIN"], r["a"], r["n"]) for r in df.select(
        "*", planar_area(F.col("geom")).alias("a"), F.size("geom.polys").alias("n")).collect()}
    assert got == {("tract", 1, "G0", 15.0, 1), ("tract", 2, "G1", 5.0, 2), ("group", 1, "G0", 9.0, 1)}


def test_placeholders_and_prefixes(spark):
    df = spark.createDataFrame([("01",), ("ZZ",), (None,)], "d string")
    assert {r["d"] for r in tables.drop_placeholder_districts(df, "d").collect()} == {"01", None}
    assert tables.prefix_match(df, "d", "0").count() == 1
    s = shapes(spark, [("a", [[box(0, 0, 1, 1)]])])
    assert tables.filter_excluded_ids(s, "id", ["a"]).count() == 0


def test_feature_numbers_over_files_and_blocks(spark, tmp_path):
    for name in ("a", "b"):
        lines = [json.dumps({"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [box(0, 0, 1, 1)]}, "properties": {"n": i}}) for i in range(400)]
        (tmp_path / f"{name}.jsonl").write_text("\n\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = readers.read_geojson_shapes(spark, str(tmp_path), "n:int", lines=True).select("file", "id_0", "n").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 800 and all(r.id_0 == r.n + 1 for r in got)


def test_unreadable_values_are_errors(spark, tmp_path):
    (tmp_path / "wide.csv").write_text('GISJOIN,AQNFE001\nG1,"1,234"\nG2,\n')
    df, _ = readers.read_wide_csv(spark, str(tmp_path / "wide.csv"))
    with pytest.raises(Exception, match="wide.csv, column AQNFE001"):
        df.collect()
    (tmp_path / "fine.csv").write_text("GISJOIN,AQNFE001\nG1, 12 \nG2,\n")
    df, _ = readers.read_wide_csv(spark, str(tmp_path / "fine.csv"))
    assert [tuple(r) for r in df.orderBy("GISJOIN").collect()] == [("G1", 12.0), ("G2", None)]


def test_shapefile_pairs(spark, tmp_path):
    square = [list(reversed(box(0, 0, 1, 1)))]
    _shapefile(tmp_path / "UP", [square, square])
    (tmp_path / "UP.shp").rename(tmp_path / "UP.SHP")
    (tmp_path / "UP.dbf").rename(tmp_path / "UP.DBF")
    raw = bytearray((tmp_path / "UP.DBF").read_bytes())
    raw[raw.index(b"G0") - 1] = ord("*")  # deleted
    (tmp_path / "UP.DBF").write_bytes(raw)
    got = readers.read_shapefile_shapes(spark, str(tmp_path), ["GISJOIN"])
    assert [(r.GISJOIN, r.id_0) for r in got.collect()] == [("G1", 2)]
    (tmp_path / "alone.shp").write_bytes((tmp_path / "UP.SHP").read_bytes())
    with pytest.raises(Exception, match="no .dbf"):
        readers.read_shapefile_shapes(spark, str(tmp_path), ["GISJOIN"]).collect()


def test_holes_belong_to_the_shell_around_them(spark, tmp_path):
    far, near = list(reversed(box(10, 10, 14, 14))), list(reversed(box(0, 0, 4, 4)))
    _shapefile(tmp_path / "two", [[near, far, box(1, 1, 2, 2)]])
    geom = readers.read_shapefile_shapes(spark, str(tmp_path), ["GISJOIN"]).first().geom
    assert [len(p) for p in geom.polys] == [2, 1] and geom.polys[0][0][0].x < 5


def test_shapefile_ranges(spark, tmp_path):
    """One file read by several tasks, with and without its index, same rows."""
    records = [[list(reversed(box(i, 0, i + 1, 2)))] + ([box(i + 0.2, 0.5, i + 0.5, 1)] if i % 3 == 0 else []) for i in range(700)]
    _shapefile(tmp_path / "a", records)
    shp = (tmp_path / "a.shp").read_bytes()
    plain = readers.read_shapefile_shapes(spark, str(tmp_path), ["GISJOIN"])
    rows = {r.id_0: r for r in plain.collect()}
    at, index = 100, b""
    while at < len(shp):
        size = struct.unpack(">2i", shp[at:at + 8])[1]
        index += struct.pack(">2i", at // 2, size)
        at += 8 + 2 * size
    (tmp_path / "a.shx").write_bytes(shp[:100] + index)
    many = readers.read_shapefile_shapes(spark, f"file:{tmp_path}", ["GISJOIN", "NONE"], range_bytes=10_000)
    assert many.rdd.getNumPartitions() > 5 and "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
    got = {r.id_0: r for r in many.collect()}
    assert len(got) == 700 and all(got[i].geom == rows[i].geom and got[i].GISJOIN == rows[i].GISJOIN == f"G{i - 1}" and got[i].NONE is None for i in rows)
    assert [len(got[i].geom.polys[0]) for i in (1, 2, 4)] == [2, 1, 2] and got[5].xmin == 4.0
    (tmp_path / "a.shp").write_bytes(shp[:108] + struct.pack("<i", 3) + shp[112:])
    with pytest.raises(Exception, match="no area"):
        many.collect()


def test_many_holes(spark):
    from geoalloc.sources.shapefiles import polygons

    shells = [np.array(list(reversed(box(40 * k, 0, 40 * k + 40, 40))), float) for k in range(3)] + [np.array(list(reversed(box(10, 10, 12, 12))), float)]
    holes = [np.array(box(x + 0.1, y + 0.1, x + 0.4, y + 0.4), float) for x in range(120) for y in range(40)] + [np.array(box(500, 0, 501, 1), float)]
    found = polygons([*shells, *holes])
    assert [len(p) - 1 for p in found] == [1600 - 4, 1600, 1600, 4, 0]


def test_collections_in_blocks(spark, tmp_path):
    """Texts with brackets and quotes, members around the features, one line or many, split anywhere."""
    rng = random.Random(3)
    odd = ['a{b', 'c}d"', '[{"x":1}]', "\\", '\\"', "}", "{", "é日\u2028", "", "[ {", "\n\t", "Feature"]

    def feature(i):
        ring = [[float(i), 0.0], [i + 1.0, 0.0], [i + 1.0, 1.0], [float(i), 0.0]]
        kind = ({"type": "Polygon", "coordinates": [ring]}, {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}, None)[i % 3]
        return {"type": "Feature", "id": rng.choice(odd), "properties": {"NAME": rng.choice(odd) + str(i) + rng.choice(odd), "more": {"x": [{"y": rng.choice(odd)}]}}, "geometry": kind}

    before = {"type": "FeatureCollection", "name": 'x[{"', "bbox": [0, 1, 2], "crs": {"type": "name", "properties": {"name": "urn", "list": [{"a": []}]}}}
    want = {}
    for name, n, indent in (("one", 300, None), ("two", 200, 2), ("none", 0, None), ("first", 3, 1)):
        doc = {**({} if name == "first" else before), "features": [feature(i) for i in range(n)], "after": {"x": {"y": {}}}, "last": [[], [1]]}
        (tmp_path / f"{name}.geojson").write_text(json.dumps(doc, indent=indent, ensure_ascii=name == "two"))
        want |= {(name, i + 1): f for i, f in enumerate(doc["features"])}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for part in (size, "1500b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", part)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if part != size else "4m")
        try:
            df = readers.read_geojson_shapes(spark, str(tmp_path / "*.geojson"), "NAME:string")
            tasks = spark.read.option("lineSep", "}").text(str(tmp_path / "one.geojson")).rdd.getNumPartitions()
            got = {(r.file.rsplit("/", 1)[1].split(".")[0], r.id_0): r for r in df.collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        assert set(got) == set(want) and (part == size or tasks > 10)
        for k, f in want.items():
            kind = f["geometry"] and f["geometry"]["type"]
            assert got[k].NAME == f["properties"]["NAME"] and (got[k].geom.polys is None if kind is None else len(got[k].geom.polys) == 1 + (kind == "MultiPolygon"))
            assert kind is None or got[k].xmin == float(k[1] - 1)
    for bad, word in (({"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, "Point"), ({"type": "x"}, "no feature")):
        (tmp_path / "bad.json").write_text(json.dumps({"type": "FeatureCollection", "features": [bad]}))
        with pytest.raises(Exception, match=word):
            readers.read_geojson_shapes(spark, str(tmp_path / "bad.json"), "NAME:string").collect()


def test_nine_hundred_columns_in_one_pair_join(spark):
    src = shapes(spark, [("s", [[box(0, 0, 2, 2)]]), ("t", [[box(2, 0, 4, 2)]])]).withColumns({f"c{i}": F.lit(float(i)) for i in range(900)})
    tgt = shapes(spark, [("a", [[box(1, 0, 4, 2)]])])
    out = areal.areal_interpolate_extensive(src, tgt, [f"c{i}" for i in range(900)], "id", "id", allocate_total=False)
    row = out.first()
    assert row["c0"] == 0.0 and row["c899"] == 899 * 1.5
    assert out._jdf.queryExecution().optimizedPlan().toString().count("r_xa") < 200


def test_tiles_of_two_files(spark):
    rows = [("x", 0, 0, 21), ("x", 17, 0, 11), ("y", 0, 0, 24)]
    tiles = raster.tile_raster(spark.createDataFrame(rows, "filename string, pcol long, prow long, cls int"), GRID)
    assert tiles.count() == tiles.select("rid").distinct().count() == 3
    twice = spark.createDataFrame([("x", 0, 0, 82), ("x", 0, 0, 11)], "filename string, pcol long, prow long, cls int")
    with pytest.raises(Exception, match="two classes"):
        raster.tile_raster(twice, GRID).collect()
