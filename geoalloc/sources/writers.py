"""Tables, CSV and GeoJSON out, with the checks that go with them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoalloc.functions.columns import fixed


def write_csv_fixed(df: DataFrame, path: str, decimals: int = 2, partition_by: Sequence[str] = (), only_given: bool = False) -> None:
    """CSV with header, doubles with a fixed number of decimals, whole numbers as they are.

    One folder per value of ``partition_by`` (a state, say) in place of one file
    per value. ``only_given`` replaces the folders of the values that occur and leaves
    the others alone; they change over when all are written.
    """
    doubles = [c for c, t in df.dtypes if t in ("double", "float") and c not in partition_by]
    out = df.withColumns({c: fixed(F.col(f"`{c}`").cast("double"), decimals) for c in doubles})
    write = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_given else "static")
    write.partitionBy(*partition_by).csv(path, header=True)


def write_map_stats(shapes: DataFrame, path: str, drop: Sequence[str] = ("id", "color", "opacity", "geom")) -> None:
    """The attributes of a map without its drawing columns."""
    shapes.drop(*drop, "xmin", "ymin", "xmax", "ymax").write.mode("overwrite").csv(path, header=True)


def write_geojson(features: DataFrame, path: str, partition_by: Sequence[str] = (), column: str = "feature") -> None:
    """One feature (or collection) per line, in folders per partition value."""
    keys = list(partition_by)
    features.select(*keys, F.col(column).alias("value")).write.mode("overwrite").partitionBy(*keys).text(path)


def write_feature_collections(features: DataFrame, path: str, by: str) -> None:
    """A FeatureCollection file in a folder of its own for each value of ``by``.

    Written line by line from sorted rows: opening, features, end. No document is
    held in memory, whatever its size.
    """
    order = Window.partitionBy(by).orderBy("feature")
    rows = features.select(by, "feature").withColumn("n", F.row_number().over(order))
    lines = rows.select(by, F.lit(1).alias("step"), "n", F.concat(F.when(F.col("n") > 1, ",").otherwise(""), "feature").alias("value"))
    keys = features.select(by).distinct()
    ends = [keys.select(by, F.lit(step).alias("step"), F.lit(0).alias("n"), F.lit(text).alias("value"))
            for step, text in ((0, '{"type":"FeatureCollection","features":['), (2, "]}"))]
    every = lines.unionByName(ends[0]).unionByName(ends[1])
    every.repartition(by).sortWithinPartitions(by, "step", "n").select(by, "value").write.mode("overwrite").partitionBy(by).text(path)


def curve_place(x: Column, y: Column) -> Column:
    """Place of a cell on a space-filling curve (Z order): the bits of both numbers by turns, from 2^31 below zero on."""
    def spread(c):
        c = c.cast("bigint") + F.lit(2**31)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
        return c

    # the highest bit of y is the sign of a long: turned over, places sort as unsigned numbers
    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1)).bitwiseXOR(F.lit(-(2**63)))


def materialize_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
                      curve: tuple[str, str] | None = None, bucket_by: Sequence[str] = (), buckets: int = 0) -> DataFrame:
    """Replaces a stored table and returns it read back, its lineage cut.

    ``cluster_by`` sorts the files by those columns (state and cell, say), so that
    readers skip the rest; ``curve`` names two whole-number columns (a cell) and lays the files
    along a space-filling curve, so that each holds a compact part of the map. ``bucket_by``
    deals rows into ``buckets`` files by hash: a join on just these columns (a cell join of a
    map that is met again and again) then reads the table without an exchange.
    """
    spark = df.sparkSession
    if bucket_by:
        if curve or cluster_by or buckets < 1:
            raise ValueError("buckets need a number of their own, and no other layout")
        df = df.repartition(buckets, *bucket_by)
    elif curve:
        place = curve_place(*(F.col(c) for c in curve))
        df = df.repartitionByRange(place).sortWithinPartitions(place)
    elif cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    spark.sql(f"drop table if exists {name}")
    write = df.write.mode("overwrite").partitionBy(*partition_by).format("parquet")
    if bucket_by:
        write = write.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    write.saveAsTable(name)
    return spark.table(name)


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the cluster's checkpoint folder.

    For tables that several branches of a plan read. The folder is the one the
    cluster names in ``spark.checkpoint.dir``; where that is unset, one in the
    warehouse, which executors share as well.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints")
    return df.checkpoint()


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def assert_unique_key(df: DataFrame, *key: str) -> DataFrame:
    """The same rows, if every key occurs once; an error naming some keys otherwise."""
    some = duplicate_keys(df, *key).limit(5).collect()
    if some:
        raise ValueError("duplicate key " + ", ".join(str(tuple(r[k] for k in key)) for r in some))
    return df


def append_keyed(df: DataFrame, name: str, key: str) -> None:
    """Appends to a table whose key must stay unique; on a clash nothing is written."""
    spark = df.sparkSession
    assert_unique_key(df, key)
    if spark.catalog.tableExists(name):
        clash = df.select(key).join(spark.table(name).select(key), key, "left_semi").limit(5).collect()
        if clash:
            raise ValueError("key already stored: " + ", ".join(str(r[0]) for r in clash))
    df.write.mode("append").format("parquet").saveAsTable(name)


def _newest(spark: SparkSession, paths: Sequence[str]):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.agg(F.max("modificationTime")).first()[0]


def skip_if_current(spark: SparkSession, output: str, inputs: Sequence[str]) -> bool:
    """True when the output exists and no input is newer than it."""
    try:
        made = _newest(spark, [output])
    except AnalysisException:
        return False
    return made is not None and _newest(spark, inputs) <= made


def input_marks(inputs: Mapping[str, DataFrame], state: str, recipe: str = "") -> DataFrame:
    """``state, input, rows, mark, recipe``: a fingerprint of the rows that each input has of each state.

    Two sums of row hashes that no order of rows changes. Rows without a state have one
    of their own.
    """
    out = None
    for name, df in inputs.items():
        row = F.xxhash64(*(F.col(f"`{c}`") for c in sorted(df.columns)))
        own = df.select(F.col(f"`{state}`").cast("string").alias("state"), row.alias("h")).groupBy("state").agg(
            F.count("*").alias("rows"), F.concat_ws(":", F.hex(F.bit_xor("h")), F.sum(F.pmod("h", F.lit(1_000_000_007))).cast("string")).alias("mark"))
        own = own.select("state", F.lit(name).alias("input"), "rows", "mark", F.lit(recipe).alias("recipe"))
        out = own if out is None else out.unionByName(own)
    return out


def stale_states(spark: SparkSession, marks: DataFrame, known: str) -> DataFrame:
    """``state, gone``: states whose marks are not those stored at ``known``; ``gone`` if no input has them any more."""
    if not _exists(spark, known):
        return marks.select("state", F.lit(False).alias("gone")).distinct()
    key = ["state", "input", "rows", "mark", "recipe"]
    both = marks.select(*key, F.lit(1).alias("now")).unionByName(spark.read.parquet(known).select(*key, F.lit(0).alias("now")))
    rows = both.groupBy(*key).agg(F.count("*").alias("times"), F.max("now").alias("now"))
    return rows.groupBy("state").agg(F.min("times").alias("times"), (F.max("now") == 0).alias("gone")).where("times = 1").select("state", "gone")


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    where, store = _path(spark, path)
    return store.exists(where)


def rebuild_stale(spark: SparkSession, output: str, inputs: Mapping[str, DataFrame], build: Callable[[dict[str, DataFrame]], DataFrame],
                  state: str, recipe: str = "", decimals: int = 2) -> list[str | None]:
    """Writes the folders of those states whose input rows, or whose ``recipe``, changed since the last run; returns these states.

    ``build`` gets the inputs with the rows of stale states alone and gives the rows to write,
    with the column ``state``. Folders of states that no input has any more go. The marks of
    the inputs are kept beside the output and replaced last, so a run that breaks off is made
    up for by the next one.
    """
    known = f"{output.rstrip('/')}_marks"
    marks = stored(input_marks(inputs, state, recipe))
    stale = stored(stale_states(spark, marks, known))
    names = [r["state"] for r in stale.orderBy("state").collect()]  # a row for each state
    if not names:
        return []
    own = {n: df.join(F.broadcast(stale.select(F.col("state").alias("__state"))), F.col(f"`{state}`").cast("string").eqNullSafe(F.col("__state")), "left_semi") for n, df in inputs.items()}
    write_csv_fixed(build(own), output, decimals, [state], only_given=True)
    for r in stale.where("gone").collect():
        where, store = _path(spark, f"{output.rstrip('/')}/{state}={r['state'] or '__HIVE_DEFAULT_PARTITION__'}")
        store.delete(where, True)
    marks.write.mode("overwrite").parquet(known)
    return names
