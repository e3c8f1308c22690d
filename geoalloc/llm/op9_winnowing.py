"""Winnowing fingerprints: of every window of rolling k-gram hashes the rightmost minimum is kept.

A passage of ``window + k - 1`` characters that two texts share is marked in both by at least
one common hash, and the kept positions say where.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoalloc.llm.common import U, mix

K, WINDOW, BATCH = 16, 32, 256
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SPAN = 1 << 16


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def gram_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hashes of all k-grams of code points; a shorter text is one gram, an empty one none.

    Rolling by prefix sums: with weights of falling powers, a gram is a difference of two
    sums, scaled back to its place. Long texts go in spans, so memory stays small.
    """
    if len(points) < k:
        whole = np.sum((points.astype(U) + U(1)) * powers(BASE, len(points)), dtype=U) if len(points) else None
        return np.empty(0, np.uint32) if whole is None else (mix(np.array([whole]), len(points)) >> U(32)).astype(np.uint32)
    out = []
    for at in range(0, len(points) - k + 1, SPAN):
        own = points[at : at + SPAN + k - 1].astype(U) + U(1)
        sums = np.concatenate([[U(0)], np.cumsum(own * powers(INVERSE, len(own)), dtype=U)])
        out.append((sums[k:] - sums[:-k]) * powers(BASE, len(own) - k + 1))
    return (mix(np.concatenate(out), k) >> U(32)).astype(np.uint32)


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the rightmost minimum of every window, ascending; a short text is one window."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64)
    # smaller hash first, then the larger place
    low = (hashes.astype(U) << U(32)) | (U(0xFFFFFFFF) - np.arange(n, dtype=U))
    done, window = 1, min(window, n)
    while done < window:  # minima of spans, doubled
        step = min(done, window - done)
        low = np.minimum(low[:-step], low[step:])
        done += step
    keep = np.concatenate([[True], low[1:] != low[:-1]])
    return (U(0xFFFFFFFF) - (low[keep] & U(0xFFFFFFFF))).astype(np.int64)


def fingerprint(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions, by position."""
    hashes = gram_hashes(points)
    places = winnow(hashes)
    return hashes[places], places


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of kept hashes (sorted, distinct); two empty ones are alike."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    whole = len(a) + len(b) - common
    return common / whole if whole else 1.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_chars, marks``: every row's kept ``(pos, hash)``, by position.

    Null and empty texts have none; a text below ``K`` characters has one mark over all of it.
    Repeated rows, null ids and other columns need no care: each row stands alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                points = [code_points(x) for x in batch["text"].to_pylist()]
                marks = [fingerprint(x) for x in points]
                bounds = np.concatenate([[0], np.cumsum([len(h) for h, _ in marks])])
                flat = pa.StructArray.from_arrays([pa.array(np.concatenate([p for _, p in marks])), pa.array(np.concatenate([h for h, _ in marks]).astype(np.int64))], ["pos", "hash"])
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array([len(x) for x in points], pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)], ["id", "n_chars", "marks"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_chars long, marks array<struct<pos:long,hash:long>>")


def with_next(docs: DataFrame, rows_per_range: int = 4000, most_ranges: int = 10_000) -> DataFrame:
    """``range, id, text, extra``: rows dealt by falling id, each range closed by the next one's first row.

    Within a range the order is by falling id (null ids last), then by text. The last range of
    all is closed by the very first row. Only ids and ranges are looked at globally; ranges
    grow in length beyond ``most_ranges``, and their rows are streamed in any case.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = docs.count()
    parts = min(most_ranges, max(1, count // rows_per_range))
    bounds = docs.where("id is not null").approxQuantile("id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    bounds = np.unique(np.array(bounds, np.float64)).astype(np.int64)

    @F.pandas_udf("int")
    def range_of(ids):  # the highest ids in range 0, null ids in the last
        at = len(bounds) - np.searchsorted(bounds, ids.fillna(-(2**63)).astype("int64"), side="right")
        return pd.Series(np.where(ids.isna(), len(bounds) + 1, at).astype("int32"))

    dealt = docs.withColumn("range", range_of("id"))
    top = dealt.groupBy("range").agg(F.max("id").alias("id"))
    order = Window.orderBy("range")  # a row for each range
    top = top.withColumn("closes", F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy())))
    top = F.broadcast(top)  # a row for each of at most ``most_ranges`` ranges and the null ids
    firsts = dealt.join(top, (dealt["range"] == top["range"]) & dealt["id"].eqNullSafe(top["id"])).groupBy("closes").agg(F.min(dealt["text"]).alias("text"))
    closing = firsts.select(F.col("closes").alias("range"), F.lit(None).cast("long").alias("id"), "text", F.lit(1).alias("extra"))
    return dealt.select("range", "id", "text", F.lit(0).alias("extra")).unionByName(closing)


def edited_digests(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text (its last third replaced by the next one's start) and the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_marks``. The next document is the one of the next smaller id; after the last comes the
    first. Rows of equal ids follow one another by text; null ids come last. Null texts are
    empty; two texts without marks are fully alike. One document is its own next one. The
    fingerprint strings are digests of all kept hashes and positions. Other columns are not read.
    """
    rows = with_next(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "range").sortWithinPartitions("range", "extra", F.desc_nulls_last("id"), "text")

    def digest(hashes, places):
        return hashlib.md5(hashes.astype("<u4").tobytes() + places.astype("<i8").tobytes()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: range, id, extra, points, hashes, places, sorted hashes
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                out = []
                for part, id_, text, extra in zip(*(whole[c].slice(at, BATCH).to_pylist() for c in ("range", "id", "text", "extra"))):
                    points = code_points(text)
                    hashes, places = fingerprint(points)
                    now = (part, id_, extra, points, hashes, places, np.unique(hashes))
                    if held is not None and held[0] == part and not held[2]:
                        _, own_id, _, own, h, p, marks = held
                        third = len(own) // 3
                        edited = np.concatenate([own[: len(own) - third], points[:third]])
                        eh, ep = fingerprint(edited)
                        sha = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
                        out.append((own_id, len(own), sha, digest(h, p), digest(eh, ep), likeness(marks, np.unique(eh)), likeness(marks, now[6]), len(h)))
                    held = now
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=arrow)

    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_marks")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
    arrow = pa.schema(list(zip(names, kinds)))
    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_marks long")


def op9_winnowing(spark, sf_dir: str) -> DataFrame:
    """Every document beside its edited text and its neighbour."""
    return edited_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
