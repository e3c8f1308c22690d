"""Attribute tables, the state dictionary, voter files and map files as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoalloc.functions.columns import matching, quoted
from geoalloc.functions.geometry import GEOM_TYPE, with_box
from geoalloc.operators.tables import VOTER_COLUMNS_DROPPED, clean_blocks
from geoalloc.sources.shapefiles import read_shapefile_shapes
from geoalloc.sources.writers import stored
from geoalloc.spec import CENSUS_COLUMNS

__all__ = ["read_geojson_shapes", "read_shapefile_shapes", "read_state_dictionary", "read_voterfile_blocks", "read_wide_csv"]


def strict(name: str, kind: str, file: str = "_metadata.file_path"):
    """A text column read as ``kind``: blank is null, anything else that cannot be read an error."""
    c = f"trim(`{name}`)"
    return F.expr(f"""case when {c} is null or {c} = '' then null when try_cast({c} as {kind}) is null
        then raise_error(concat({file}, ', column {name}: cannot read ', `{name}`)) else try_cast({c} as {kind}) end""")


def read_wide_csv(spark: SparkSession, path: str | list[str], pattern: str = CENSUS_COLUMNS, key: str = "GISJOIN",
                  keep: Sequence[str] = (), cast: str = "double") -> tuple[DataFrame, list[str]]:
    """Latin-1 CSV with header: key, kept columns and the data columns whose name
    matches, with the list of the latter. Other columns are not parsed. A value that
    is not a number is an error that names the file and the column."""
    raw = spark.read.csv(path, header=True, encoding="ISO-8859-1")
    data = [c for c in matching(raw.columns, pattern) if c not in (key, *keep)]
    return raw.select(*quoted([key, *keep]), *[strict(c, cast).alias(c) for c in data]), data


def read_state_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """State abbreviations, numbers and the two district flags; territories left out."""
    raw = spark.read.csv(path, header=True, encoding="ISO-8859-1")
    return raw.select(
        "StateAbbreviation", F.col("StateFIPS").cast("int").alias("StateFIPS"),
        *[(F.lower(F.trim(c)) == "true").alias(c) for c in ("OneDistrict", "SLDUpperOnly")]).where("StateFIPS < 60")


def read_voterfile_blocks(spark: SparkSession, folder: str, key: str = "geoid20", example: str | None = None) -> DataFrame:
    """All CSV files of a folder, cleaned, with the count columns of an example file.

    Files differ by state in the order of their columns and the small parties they have. All are
    read in one scan of lines; each file's first line, a row of a small table, tells where
    its values belong. A file that lacks one of the example's columns (by default the first
    file by name) is an error. Quoted values may hold commas, but no line ends.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.where("trim(value) <> ''").withColumn("n", F.monotonically_increasing_id())
    heads = lines.where("block = 0").groupBy("file").agg(F.min(F.struct("n", "value")).alias("head"))
    names = "transform(split(head.value, ','), c -> trim(BOTH '\\ufeff\"' FROM trim(c)))"
    heads = stored(heads.selectExpr("file", "head.n as head", f"{names} as names"))
    leader = heads.where(F.endswith("file", F.lit(example or ""))).orderBy("file").first()
    if leader is None:
        raise FileNotFoundError(f"no csv files in {folder}" if example is None else f"no file {example} in {folder}")
    wanted = [c for c in leader["names"] if c != key and c not in matching(leader["names"], VOTER_COLUMNS_DROPPED, "search")]
    lacks = heads.select("file", F.array_except(F.lit([key, *wanted]), "names").alias("missing")).where("size(missing) > 0").orderBy("file").first()
    if lacks is not None:
        raise ValueError(f"{lacks['file']} lacks columns: {', '.join(lacks['missing'])}")
    every = [r[0] for r in heads.select(F.explode("names").alias("c")).distinct().orderBy("c").collect()]  # names, not files
    width = heads.agg(F.max(F.size("names"))).first()[0]
    values = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width))).alias("v")
    rows = lines.join(heads, "file").where("n <> head").select("file", "names", values)
    rows = rows.select("file", "names", F.array(*(F.col(f"v.c{i}") for i in range(width))).alias("v"))
    rows = rows.select("file", *(F.get("v", F.array_position("names", F.lit(c)).cast("int") - 1).alias(c) for c in every))
    counts = rows.select(key, *[strict(c, "double", "file").cast("bigint").alias(c) for c in every if c != key])
    return clean_blocks(counts, key).select(key, "StateFIPS", "CountyFIPS", "TractId", "BlockId", *quoted(wanted))


# --- shapes ----------------------------------------------------------------

def _feature_schema(props: T.StructType | str) -> str:
    inner = props if isinstance(props, str) else ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in props)
    return f"type:string,geometry:struct<type:string,coordinates:string>,properties:struct<{inner}>"


def _geom_from_json(kind, coords, srid: int):
    points = "transform(r, p -> struct(p[0] as x, p[1] as y))"
    poly = f"transform(from_json({coords}, 'array<array<array<double>>>'), r -> {points})"
    multi = (f"transform(from_json({coords}, 'array<array<array<array<double>>>>'), g -> transform(g, r -> {points}))")
    polys = f"""case {kind} when 'Polygon' then array({poly}) when 'MultiPolygon' then {multi}
        else if({kind} is null, null, raise_error(concat('a geometry of kind ', {kind}, ' is no area'))) end"""
    return F.expr(f"struct({srid} as srid, {polys} as polys)").cast(GEOM_TYPE)


def _sums_before(pieces: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all pieces of the file ahead of each one: inside its block, and of the blocks ahead."""
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("file", "block").agg(F.sum(value).alias("__sum")).select("file", "block", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__before"))
    pieces = pieces.withColumn("__own", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(blocks, ["file", "block"])
    return pieces.withColumn(name, F.col("__before") + F.col("__own")).drop("__own", "__before")


def collection_features(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, pos, text``: the features of FeatureCollections, cut out of files that are read in blocks.

    A file is split behind every closing brace, which any number of tasks do at once. Whether
    a piece begins inside a text follows from the quotes ahead of it, its depth from the
    brackets outside of texts, and a feature ends where a brace closes depth 3 in an array of
    the document: three prefix sums over pieces, block by block. The few pieces of a
    feature are then put together; nothing larger than a feature is held.
    """
    p = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    p = p.withColumn("n", F.monotonically_increasing_id()).withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
    p = _sums_before(p.withColumn("quotes", F.expr("length(bare) - length(replace(bare, '\"', ''))")), "quotes", "quotes_before")
    outside = F.when(F.col("quotes_before") % 2 == 1, F.regexp_replace("bare", '^[^"]*("|$)', "")).otherwise(F.col("bare"))
    p = p.withColumn("outer", F.regexp_replace(outside, '"[^"]*("|$)', "")).withColumn("in_text", (F.col("quotes_before") + F.col("quotes")) % 2 == 1)
    p = p.withColumn("squares", F.expr("length(translate(outer, ']', '')) - length(translate(outer, '[', ''))"))
    p = p.withColumn("step", F.expr("squares + length(outer) - length(translate(outer, '{', '')) - if(in_text, 0, 1)"))
    p = p.select("value", "file", "block", "n", "squares", "step", "in_text")
    p = _sums_before(_sums_before(p, "step", "depth"), "squares", "array_depth")
    p = p.withColumn("ends", F.expr("if(not in_text and depth + step = 2 and array_depth + squares = 1, 1, 0)"))
    p = _sums_before(p, "ends", "pos")
    # what stands ahead of the first feature: other members, texts and arrays of anything but objects
    head = r'(?s)^(?:[^"\[]|"(?:[^"\\]|\\.)*+"|\[(?!\s*+\{))*+\[\s*+'
    text = F.when(F.col("depth") > 2, F.col("value")).when((F.col("depth") == 2) & (F.col("array_depth") == 1), F.regexp_replace("value", r"(?s)^[^{]*", "")).otherwise(F.regexp_replace("value", head, ""))
    p = p.select("file", "pos", "ends", F.struct("block", "n", (F.col("depth") <= 2).alias("begins"), text.alias("text")).alias("piece"))
    f = p.groupBy("file", "pos").agg(F.max("ends").alias("ends"), F.sort_array(F.collect_list("piece")).alias("pieces")).where("ends = 1")
    last = "array_max(transform(pieces, (x, i) -> if(x.begins, i, 0)))"
    return f.selectExpr("file", "pos", f"concat(array_join(transform(slice(pieces, {last} + 1, size(pieces)), x -> x.text), '}}'), '}}') as text")


def read_geojson_shapes(spark: SparkSession, path: str | list[str], properties: str, srid: int = 4326,
                        lines: bool = False, id: str = "id_0") -> DataFrame:
    """GeoJSON features, one row each: id, file, properties, geometry and box.

    ``properties`` is a schema such as ``"NAME:string,pop:bigint"``. One
    FeatureCollection per file by default, read in blocks by any number of tasks; ``lines``
    reads one feature per line. The id counts features from 1 in each file, as loaders
    number them. Points, lines and objects that are no features are errors; a feature
    without a geometry has none here.
    """
    if lines:
        # numbers inside each block of a file, and how many features stand before the block
        read = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).where("trim(value) <> ''")
        read = read.withColumn("n", F.monotonically_increasing_id())
        ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = read.groupBy("file", "block").agg(F.min("n").alias("first"), F.count("*").alias("many"))
        blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("many").over(ahead), F.lit(0)).alias("before"))
        raw = read.join(blocks, ["file", "block"]).select(
            "file", (F.col("n") - F.col("first") + F.col("before")).alias("pos"),
            F.from_json("value", f"struct<{_feature_schema(properties)}>").alias("f"))
    else:
        raw = collection_features(spark, path).select("file", "pos", F.from_json("text", f"struct<{_feature_schema(properties)}>").alias("f"))
        raw = raw.where(F.expr("if(f.type = 'Feature', true, raise_error(concat(file, ': object ', pos + 1, ' is no feature')))"))
    rows = raw.select((F.col("pos") + 1).cast("bigint").alias(id), "file", "f.properties.*",
                      _geom_from_json("f.geometry.type", "f.geometry.coordinates", srid).alias("geom"))
    return with_box(rows)
