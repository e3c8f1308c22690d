"""Embedding near-duplicates by product quantisation over coarse inverted lists.

Vectors are scaled to length one; equal ones of a label form one class. Coarse centroids and
sub-space codebooks of residuals are fitted on a bounded sample. Every vector goes to the list
of its nearest centroid with its codes, and as a query to the lists of its ``PROBES`` nearest.
There, asymmetric distances from look-up tables choose candidates: a vector's table sum plus
the length of what its codes leave out bounds its true cosine from above, so the codes alone
never lose a pair. Candidates are tested by the exact cosine in double precision. Large lists
are dealt in blocks of members and of askers, and a pair that two lists meet is counted in one
of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoalloc.llm.common import Forest, components, stored

SUBSPACES, CODES, PROBES, PER_LIST, MOST_LISTS, SAMPLE, BLOCK, ASKERS = 16, 256, 8, 256, 4096, 20_000, 2048, 8192


def unit_rows(vectors: list) -> tuple[np.ndarray, list[int]]:
    """Rows of length one, and the numbers of the vectors that have a direction."""
    rows, good = [], []
    for i, v in enumerate(vectors):
        if v is not None and len(v) and not any(x is None for x in v):
            a = np.asarray(v, np.float64)
            if np.isfinite(a).all() and (top := np.abs(a).max()) > 0:
                a = a / top  # no overflow or underflow in the squares
                rows.append(a / np.sqrt(a @ a))
                good.append(i)
    return rows, good


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Plain Lloyd rounds; empty centroids take random points anew."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres)
        counts = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, weights=x[:, j], minlength=k) for j in range(x.shape[1])], 1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.integers(len(x), size=k)])
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmax(x[a : a + 4096] @ centres.T - (centres**2).sum(1) / 2, 1) for a in range(0, len(x), 4096)])


class Index:
    """Coarse centroids and codebooks for vectors of one length."""

    def __init__(self, x: np.ndarray, lists: int):
        self.width = x.shape[1]
        self.coarse = k_means(x, lists)
        self.cuts = np.linspace(0, self.width, min(SUBSPACES, self.width) + 1).astype(int)
        rest = x - self.coarse[nearest(x, self.coarse)]
        self.books = [k_means(rest[:, a:b], CODES) for a, b in zip(self.cuts, self.cuts[1:])]

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the length of what they leave out."""
        rest = x - self.coarse[home]
        codes = np.stack([nearest(rest[:, a:b], book) for (a, b), book in zip(zip(self.cuts, self.cuts[1:]), self.books)], 1)
        back = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], 1)
        return codes.astype(np.uint8), np.sqrt(((rest - back) ** 2).sum(1))

    def tables(self, queries: np.ndarray) -> list[np.ndarray]:
        """Per sub-space the products of each query with each code word."""
        return [queries[:, a:b] @ book.T for (a, b), book in zip(zip(self.cuts, self.cuts[1:]), self.books)]


def fit_index(classes: DataFrame, width: int, rows: int) -> Index | None:
    """Index of the vectors of one width, from at most ``SAMPLE`` of them chosen by hash."""
    some = classes.where(F.col("width") == width).orderBy(F.xxhash64("unit"), "id").limit(SAMPLE).select("unit").collect()  # bounded
    x = np.array([np.frombuffer(r[0], "<f8") for r in some])
    return Index(x, int(min(max(1, rows // PER_LIST), MOST_LISTS)))


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", probes: int = PROBES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Links join rows of equal labels whose cosine is at least ``least``. A null label, and a
    null, empty or zero vector, or one with null or non-finite components, links with nothing;
    so do vectors of different lengths. Equal vectors (after scaling) are one class in the
    search and all link with one another. Repeated rows of an id are vectors of their own that
    share a component. Rows with a null id keep null results and link with nothing. Other
    columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, good = unit_rows(batch["v"].to_pylist())
            out, widths = [None] * batch.num_rows, [0] * batch.num_rows
            for u, i in zip(units, good):
                out[i], widths[i] = u.astype("<f8").tobytes(), len(u)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], pa.array(out, pa.binary()), pa.array(widths, pa.int32())], ["id", "label", "unit", "width"])

    rows = stored(rows.mapInArrow(scale, "id long, label string, unit binary, width int"))
    classes = stored(rows.where("id is not null and label is not null and unit is not null").groupBy("label", "unit", "width").agg(F.count("*").alias("copies"))
                     .withColumn("id", F.monotonically_increasing_id()))  # a number of the class, for an id may have several
    sizes = {r[0]: r[1] for r in classes.groupBy("width").count().collect()}  # vector lengths, one in practice
    links = None
    for width, count in sorted(sizes.items()):
        own = list_links(classes.where(F.col("width") == width), fit_index(classes, width, count), least, probes)
        links = own if links is None else links.unionByName(own)
    if links is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    links = stored(links)
    degrees = links.where("v is null").groupBy(F.col("u").alias("label_of"), F.col("w").alias("of_class")).agg(F.sum("n").alias("near"))
    members = rows.join(classes.select("label", "unit", F.col("id").alias("class"), "copies"), ["label", "unit"], "left")
    members = stored(members.select("id", "label", F.when(F.col("id").isNotNull(), F.col("class")).alias("class"), "copies"))
    # an id in several classes holds them together
    several = members.where("class is not null").groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a != b")
    several = members.join(several.select("id", "a"), "id").where("class is not null").select("a", F.col("class").alias("b"))
    found = components(links.where("v is not null").select(F.col("v").alias("a"), F.col("w").alias("b")).unionByName(several), "a", "b")
    members = members.join(degrees, (F.col("label") == F.col("label_of")) & (F.col("class") == F.col("of_class")), "left")
    members = members.join(found, F.col("class") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class"))
    # a row without a class of an id that has one belongs to that one's component
    lowest = members.where("component is not null").groupBy("component").agg(F.min("id").alias("component_id"))
    of_id = members.where("component is not null").groupBy("id").agg(F.min("component").alias("of_id"))
    members = members.join(of_id, "id", "left").withColumn("component", F.coalesce("component", "of_id")).join(lowest, "component", "left")
    component = F.coalesce("component_id", "id")
    return members.select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.coalesce(F.col("near") + F.col("copies") - 1, F.col("copies") - 1, F.lit(0))).alias("n_links"),
                          component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def dealt(placed: DataFrame) -> DataFrame:
    """Members and askers by ``label, list, part, ask_part``, about ``BLOCK`` and ``ASKERS`` of them at most; each asker meets each member of the list once."""
    members = placed.groupBy("label", "home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).withColumnRenamed("home", "list")
    askers = placed.select("label", F.explode("lists").alias("list")).groupBy("label", "list").agg(F.ceil(F.count("*") / ASKERS).cast("int").alias("ask_parts"))
    crowds = members.join(askers, ["label", "list"])  # members ask their own list, so none is lost
    block = lambda name, seed: F.pmod(F.xxhash64("id", F.lit(seed)), name).cast("int")
    blocks = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    # members stay in one block of their list and meet all blocks of askers, askers stay in one block and meet all blocks of members
    member = placed.withColumn("list", F.col("home")).join(crowds, ["label", "list"]).withColumn("part", block("parts", 0)).withColumn("ask_part", blocks("ask_parts")).withColumn("asks", F.lit(False))
    query = placed.withColumn("list", F.explode("lists")).join(crowds, ["label", "list"]).withColumn("part", blocks("parts")).withColumn("ask_part", block("ask_parts", 1)).withColumn("asks", F.lit(True))
    columns = ["label", "list", "part", "ask_part", "asks", "id", "copies", "unit", "home", "lists", "codes", "rest"]
    return member.select(columns).unionByName(query.select(*columns[:8], "home", "lists", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("rest")))


def list_links(classes: DataFrame, index: Index, least: float, probes: int) -> DataFrame:
    """``u, v, w, n``: degrees (label, null, class, copies near it) and spanning links (label, class, class, null)."""
    shared = classes.sparkSession.sparkContext.broadcast(index)  # bounded by MOST_LISTS and CODES

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([np.frombuffer(u, "<f8") for u in batch["unit"].to_pylist()])
            home = nearest(x, index.coarse)
            codes, left = index.encode(x, home)
            far = -(x @ index.coarse.T - (index.coarse**2).sum(1) / 2)
            far[np.arange(len(x)), home] = -np.inf  # the own list is always among the probes
            lists = np.sort(np.argsort(far, 1, kind="stable")[:, :probes], 1)
            yield pa.RecordBatch.from_arrays([
                batch["label"], batch["id"], batch["copies"], batch["unit"], pa.array(home.astype(np.int32)), pa.array(lists.astype(np.int32).tolist(), pa.list_(pa.int32())),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left)], ["label", "id", "copies", "unit", "home", "lists", "codes", "rest"])

    placed = stored(classes.select("label", "id", "copies", "unit").mapInArrow(deal, "label string, id long, copies long, unit binary, home int, lists array<int>, codes binary, rest double"))
    work = dealt(placed)

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        index, label, at = shared.value, key[0].as_py(), key[1].as_py()
        asks = table["asks"].to_numpy()
        ask, own = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        rows = {"u": [], "v": [], "w": [], "n": []}
        if own.num_rows and ask.num_rows:
            x, y = (np.frombuffer(b"".join(t["unit"].to_pylist()), "<f8").reshape(t.num_rows, -1) for t in (ask, own))
            ids, own_ids = ask["id"].to_numpy(), own["id"].to_numpy()
            codes, rest = np.frombuffer(b"".join(own["codes"].to_pylist()), np.uint8).reshape(own.num_rows, -1), own["rest"].to_numpy()
            visits = [frozenset(v) for v in own["lists"].to_pylist()]
            homes, copies, own_copies = ask["home"].to_numpy(), ask["copies"].to_numpy(), own["copies"].to_numpy()
            base = x @ index.coarse[at]
            number = {i: n for n, i in enumerate(dict.fromkeys([*own_ids.tolist(), *ids.tolist()]))}
            forest, near = Forest(len(number)), {}
            for a in range(0, len(x), 256):
                bound = base[a : a + 256, None] + rest[None] + 1e-9
                for j, products in enumerate(index.tables(x[a : a + 256])):
                    bound = bound + products[:, codes[:, j]]
                i, j = np.nonzero(bound >= least)
                i += a
                i, j = i[ids[i] != own_ids[j]], j[ids[i] != own_ids[j]]
                exact = np.einsum("ij,ij->i", x[i], y[j])
                i, j = i[exact >= least], j[exact >= least]
                for p, q in zip(i.tolist(), j.tolist()):
                    u, v = int(ids[p]), int(own_ids[q])
                    # met a second time, in the asker's list, if this member asks there
                    if int(homes[p]) in visits[q] and u > v:
                        continue
                    near[u] = near.get(u, 0) + int(own_copies[q])
                    near[v] = near.get(v, 0) + int(copies[p])
                    if forest.join(number[u], number[v]):
                        for c, value in zip("uvwn", (label, u, v, None)):
                            rows[c].append(value)
            for u, n in near.items():
                for c, value in zip("uvwn", (label, None, u, n)):
                    rows[c].append(value)
        return pa.table({"u": pa.array(rows["u"], pa.string()), "v": pa.array(rows["v"], pa.int64()), "w": pa.array(rows["w"], pa.int64()), "n": pa.array(rows["n"], pa.int64())})

    return work.groupBy("label", "list", "part", "ask_part").applyInArrow(search, "u string, v long, w long, n long")


def op8_product_quantisation(spark, sf_dir: str) -> DataFrame:
    """All embeddings, cosine of at least 0.93 within a label."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
