"""Token counts by a separator scan over flat token files without an index.

Files hold nothing but little-endian ids, documents one after another, each closed by an
end-of-document id. A file of any size is dealt in ranges of blocks to the tasks, which read
theirs by offset, a block at a time; a vectorised comparison finds the separators of a block. A
prefix scan over the blocks (small rows: how many ids, where the last separator) tells each
block where its first document began, which stitches documents over the bounds of blocks and tasks.

Spark lists the files; Arrow opens them, so they lie on paths that all executors see or in stores that it knows.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoalloc.llm.common import shared_folder, stored
from geoalloc.llm.op6_packing import BATCH, TOKENIZER, chunk_ids
from geoalloc.sources.shapefiles import open_files

BLOCK_IDS = 1 << 18
RANGE_BLOCKS = 64  # blocks that one task reads of a file at a stretch
MOST_TASKS = 10_000
END_ID = 49_407  # <|endoftext|> of the default tokenizer


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> int:
    """Writes the ids of all texts as flat files into a new folder; returns the bytes of an id.

    Spark's text writer puts down raw bytes: each row is a document's ids without the last
    byte of its separator, which the writer adds as the end of the line. A null or empty text
    is a separator alone. The separator's own name in a text is ordinary text, so its id
    never comes from one.
    """
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    close = end_id.to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = chunk_ids(tokenizer, f"<u{width}", names_are_text=True)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                yield pa.RecordBatch.from_arrays([pa.array([ids.of(x) + close[:-1] for x in whole["text"].slice(at, BATCH).to_pylist()], pa.binary())], ["ids"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "ids binary")
    rows.select(F.col("ids").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", chr(close[-1])).text(path)
    return width


def scan_blocks(spark: SparkSession, path: str, width: int, end_id: int, block_ids: int = BLOCK_IDS, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """``file, block, n, ends``: per block of each file its number of ids and the places after its separators in the file."""
    size = block_ids * width
    files = spark.read.format("binaryFile").load(path).where("length > 0").selectExpr("path", "regexp_extract(path, '[^/]*$', 0) as file", "length")  # contents are not read
    ranges = files.selectExpr("*", f"explode(sequence(0L, (length - 1) div {size * range_blocks})) as part")
    tasks = min(max(ranges.count(), 1), MOST_TASKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            if row["length"] % width:
                raise ValueError(f"{row['file']} ends inside an id")
            store, place = open_files(quote(row["path"], safe="/:@"))
            with store.open_input_file(place) as f:
                first, last = row["part"] * range_blocks, -(-row["length"] // size)
                for block in range(first, min(first + range_blocks, last)):
                    own = np.frombuffer(f.read_at(min(size, row["length"] - block * size), block * size), f"<u{width}")
                    ends = np.flatnonzero(own == end_id) + block * block_ids + 1
                    yield pa.RecordBatch.from_arrays([pa.array([row["file"]]), pa.array([block], pa.int64()), pa.array([len(own)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], ["file", "block", "n", "ends"])

    return ranges.repartition(tasks).mapInArrow(run, "file string, block long, n long, ends array<long>")


def count_tokens(spark: SparkSession, path: str, width: int, end_id: int = END_ID, block_ids: int = BLOCK_IDS, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """``file, number, start, tokens, closed`` for every document of the files below ``path``.

    ``number`` counts from 0 in a file, ``start`` is the place of the first id, ``tokens``
    counts the separator. Ids after the last separator are a document that is not closed and
    has no separator to count. Documents do not go on from one file to the next. Empty files
    have none; a file that ends inside an id is an error.
    """
    blocks = stored(scan_blocks(spark, path, width, end_id, block_ids, range_blocks))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block of a file
    after = Window.partitionBy("file").orderBy("block").rowsBetween(1, 1)
    small = blocks.select("file", "block", "n", F.size("ends").cast("long").alias("closed"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    small = small.select("file", "block", F.coalesce(F.max("last").over(ahead), F.lit(0)).alias("begun"), F.coalesce(F.sum("closed").over(ahead), F.lit(0)).alias("before"),
                         F.max("n").over(after).isNull().alias("final"))
    both = blocks.join(small, ["file", "block"])
    starts = F.slice(F.concat(F.array("begun"), "ends"), F.lit(1), F.size("ends"))
    ends = both.select("file", "before", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))).alias("place", "at"))
    closed = ends.select("file", (F.col("before") + F.col("place")).alias("number"), "at.start", "at.end", F.lit(True).alias("closed"))
    size = F.col("block") * block_ids + F.col("n")
    begun = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("begun"))
    rest = both.where(F.col("final") & (size > begun)).select("file", (F.col("before") + F.size("ends")).alias("number"), begun.alias("start"), size.alias("end"), F.lit(False).alias("closed"))
    return closed.unionByName(rest).select("file", "number", "start", (F.col("end") - F.col("start")).alias("tokens"), "closed")


def op10_separators(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents, from flat files of their ids; files by their number."""
    path = shared_folder(spark)
    width = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    found = count_tokens(spark, path, width)
    return found.withColumn("file", F.regexp_extract("file", r"part-(\d+)", 1).cast("long"))
