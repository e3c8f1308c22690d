"""What several operators share: stored tables, word hashes, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
EDGES = 500_000  # that a task holds at a time


def shared_folder(spark: SparkSession) -> str:
    """A new folder where every executor can write and read.

    Below ``spark.checkpoint.dir``; where that is unset, as in tests, below the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept as Parquet in the shared folder.

    Lost executors do not cost the rows; the folder belongs to the session's scratch space.
    """
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well-mixed 64-bit values (splitmix finaliser)."""
    h = h + U((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class WordHashes(dict):
    """Eight-byte hashes of words, remembered up to a bounded number."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_digest(word)
        return h


def shingles(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of a whole text.

    Words are runs of other characters than ASCII white space, A-Z lower-cased. A text of
    fewer words is one shingle; without words there is none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, U)
    h = np.frombuffer(b"".join(map(hashes.__getitem__, words)), "<u8")
    if len(h) < k:
        return mix(np.array([xxhash.xxh3_64_intdigest(h.tobytes())], U), 1 + len(h))
    out = mix(h[: len(h) - k + 1], 0)
    for i in range(1, k):
        out = mix(out ^ h[i : len(h) - k + 1 + i], i)
    return np.unique(out)


def contracted(edges: DataFrame) -> DataFrame:
    """``u, v``: for up to ``EDGES`` edges of a task at a time, each node with the smallest that it reaches by them."""
    def forest(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        nodes, at = np.unique(np.concatenate([table["u"].to_numpy(), table["v"].to_numpy()]), return_inverse=True)
        joined = Forest(len(nodes))
        for x, y in zip(at[: table.num_rows].tolist(), at[table.num_rows :].tolist()):
            joined.join(x, y)
        root = np.array([joined.root(x) for x in range(len(nodes))])
        leaf = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[leaf]), pa.array(nodes[root[leaf]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= EDGES:
                yield forest(held)
                held, size = [], 0
        if size:
            yield forest(held)

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node with an edge to another.

    Tasks contract the edges that they hold; then large-star and small-star steps alternate on
    stored edge tables, contracted again, until every node has one edge, to a node that has
    none to a smaller one. Hubs are minima of aggregates with a map-side part, joined back under
    skew handling. Edges are dealt into tasks by their number, so few of them take few tasks.
    """
    e = stored(edges.select(F.greatest(u, v).cast("long").alias("u"), F.least(u, v).cast("long").alias("v")).where("u != v"))
    tasks = max(e.sparkSession.sparkContext.defaultParallelism, e.count() // EDGES + 1)
    e = stored(contracted(e.coalesce(tasks)))
    while True:
        ups = e.select(F.col("u").alias("node"), F.col("v").alias("up")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("up")))
        ups = ups.groupBy("node").agg(F.min("up").alias("component"), F.max("up").alias("other"))
        if ups.agg(F.count_if(F.col("component") != F.col("other"))).first()[0] == 0:
            return ups.select("node", "component")
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(contracted(small.unionByName(low.select("u", F.col("m").alias("v"))).coalesce(tasks)))


class Forest:
    """Union-find over the local numbers of one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y
