"""Ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds turn
its score into probabilities, ``P(grade <= j) = sigmoid(threshold_j - score)``. The grade is
the number of good ratings of a document: ``quality + (1 - toxic)``, 0 to 2. Features are
words, their beginnings, endings and shapes, and a few about repetition; weights speak only
against a document, so that no amount of plain text hides a bad passage. The model is fitted
on a bounded sample of labelled rows in one task; all documents are scored whole.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, GRADES, SAMPLE_ROWS, EPOCHS, STEEP = 22, 3, 8000, 300, 4.0


LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


class WordFeatures(dict):
    """Per word the numbers of its features (word, beginnings, ending, shape), remembered up to a bounded number.

    With a table of weights only features of some weight are given.
    """

    def __init__(self, weights: np.ndarray | None = None, most: int = 600_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        shape = b"a" if not word.translate(None, LETTERS) else re.sub(rb"[0-9]+", b"0", re.sub(rb"[a-zA-Z\x80-\xff]+", b"a", word))[:24]
        numbers = [number(x) for x in (b"w" + word, b"3" + word[:3], b"4" + word[:4], b"5" + word[:5], b"e" + word[-3:], b"s" + shape)]
        if self.weights is not None:
            numbers = [x for x in numbers if self.weights[x]]
        out = self[word] = b"".join([x.to_bytes(4, "little") for x in numbers])
        return out


def number(x: bytes) -> int:
    return xxhash.xxh3_64_intdigest(x) >> (64 - BITS)


def features(text: str | None, words_of: WordFeatures) -> np.ndarray:
    """Distinct feature numbers of a whole text; a null or empty one has the mark of emptiness alone."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.array([number(b"empty")], np.uint32)
    share = sum(map(operator.eq, words, words[1:])) / len(words)  # words said twice running
    fresh = len(set(words)) / len(words)
    own = np.frombuffer(b"".join(map(words_of.__getitem__, words)), "<u4")
    return np.unique(np.append(own, np.array([number(b"twice%d" % (20 * share)), number(b"fresh%d" % (10 * fresh)), number(b"long%d" % np.log2(len(words)))], np.uint32)))


@dataclass(frozen=True)
class Model:
    numbers: np.ndarray  # of the features that speak against a document
    weights: np.ndarray  # positive, one for each number
    thresholds: np.ndarray  # GRADES - 1, ascending

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.numbers] = self.weights
        return out

    def tails(self, evidence: np.ndarray) -> np.ndarray:
        """``P(grade >= j)`` for j = 1..GRADES-1, one column each."""
        return sigmoid(score(evidence)[:, None] - self.thresholds[None])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def score(evidence):
    """Falls with the summed evidence, ever slower, so that much of it does not mean another grade."""
    return -STEEP * np.log1p(evidence)


def telling(rows: list[np.ndarray], grades: np.ndarray, least_rows: int = 4, deviations: float = 4.0) -> np.ndarray:
    """Features whose rows have a mean grade clearly below that of all rows."""
    flat, at = np.concatenate(rows), np.repeat(grades.astype(np.float64), [len(x) for x in rows])
    rows_with, sums = np.bincount(flat, minlength=1 << BITS), np.bincount(flat, weights=at, minlength=1 << BITS)
    found = np.flatnonzero(rows_with >= least_rows)
    away = (sums[found] / rows_with[found] - grades.mean()) * np.sqrt(rows_with[found]) / max(grades.std(), 1e-9)
    return found[away <= -deviations]


def fit_rows(rows: list[np.ndarray], grades: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, worth_below_top: float = 3.0) -> Model:
    """Maximum likelihood by full gradients (Adam) over non-negative weights and ordered thresholds.

    The thresholds are a first one and logarithms of the steps to the next, so they stay in order.
    """
    n = len(rows)
    if n == 0:  # nothing known: every document is taken
        return Model(np.empty(0, np.int64), np.empty(0), np.full(GRADES - 1, -40.0))
    numbers = telling(rows, grades)
    place = np.full(1 << BITS, -1, np.int32)
    place[numbers] = np.arange(len(numbers))
    flat, at = place[np.concatenate(rows)], np.repeat(np.arange(n), [len(x) for x in rows])
    flat, at = flat[flat >= 0], at[place[np.concatenate(rows)] >= 0]
    counts = np.bincount(grades, minlength=GRADES) + 0.5
    below = np.cumsum(counts)[:-1] / counts.sum()
    logits = np.log(below / (1 - below))
    at_start = np.concatenate([np.zeros(len(numbers)), logits[:1], np.log(np.maximum(np.diff(logits), 0.05))])
    values, first, second = at_start, np.zeros_like(at_start), np.zeros_like(at_start)
    speed = np.where(np.arange(len(values)) < len(numbers), rate, 0.2 * rate)
    worth = np.where(grades < GRADES - 1, worth_below_top, 1.0) / n
    m = len(numbers)
    for epoch in range(1, epochs + 1):
        steps = np.exp(values[m + 1 :])
        thresholds = np.concatenate([values[m : m + 1], values[m] + np.cumsum(steps)])
        evidence = np.bincount(at, weights=values[flat], minlength=n)
        s = score(evidence)
        upper, lower = sigmoid(np.append(thresholds, 40.0)[grades] - s), sigmoid(np.append(-40.0, thresholds)[grades] - s)
        mass = np.maximum(upper - lower, 1e-9)
        rise = worth * upper * (1 - upper) / mass * (grades < GRADES - 1)  # by the threshold above
        fall = worth * lower * (1 - lower) / mass * (grades > 0)  # by the one below
        by_evidence = -(rise - fall) * STEEP / (1 + evidence)
        by_threshold = np.bincount(np.maximum(grades - 1, 0), weights=fall, minlength=GRADES - 1) - np.bincount(np.minimum(grades, GRADES - 2), weights=rise, minlength=GRADES - 1)
        later = np.cumsum(by_threshold[::-1])[::-1]
        slope = np.concatenate([np.bincount(flat, weights=by_evidence[at], minlength=m), later[:1], later[1:] * steps])
        slope += np.where(np.arange(len(values)) < m, 1e-6, 1e-4) * values
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        values = values - speed * first / (1 - 0.9**epoch) / (np.sqrt(second / (1 - 0.99**epoch)) + 1e-6)
        values[:m] = np.maximum(values[:m], 0)
    return Model(numbers, values[:m], np.concatenate([values[m : m + 1], values[m] + np.cumsum(np.exp(values[m + 1 :]))]))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model of at most ``sample_rows`` labelled documents, chosen by a hash of their ids.

    Labels with a null, or without a document, are not used; a document rated several times
    is learnt with each rating. Without labels the model takes every document.
    """
    rated = labels.select(F.col("doc_id").alias("id"), (F.col("quality") + 1 - F.col("toxic")).cast("int").alias("grade")).where(f"id is not null and grade between 0 and {GRADES - 1}")
    rated = rated.orderBy(F.xxhash64("id"), "id", "grade").limit(sample_rows)
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(rated), "id")  # at most sample_rows rows

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, xs, ys = WordFeatures(), [], []
        for batch in batches:
            xs += [features(x, words) for x in batch["text"].to_pylist()]
            ys += batch["grade"].to_pylist()
        model = fit_rows(xs, np.array(ys, np.int64))
        yield pa.RecordBatch.from_pydict({"numbers": [model.numbers.astype("<i8").tobytes()], "weights": [model.weights.astype("<f8").tobytes()], "thresholds": [model.thresholds.astype("<f8").tobytes()]})

    row = rows.select("text", "grade").repartition(1).sortWithinPartitions("grade", "text").mapInArrow(train, "numbers binary, weights binary, thresholds binary").first()
    if row is None:  # no rows at all, so no task called
        return fit_rows([], np.empty(0, np.int64))
    return Model(*(np.frombuffer(x, kind) for x, kind in zip(row, ("<i8", "<f8", "<f8"))))


def graded(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """All columns of ``docs`` with ``expected_grade, tail_1, tail_2, kept``.

    ``tail_j`` is ``P(grade >= j)``; a row is kept if its highest tail is at least ``least``.
    Null and empty texts are graded by the mark of emptiness, repeated rows alike.
    Columns of ``docs`` with one of the four names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    @F.pandas_udf("struct<expected_grade:double,tail_1:double,tail_2:double,kept:boolean>")
    def grade(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        table = known.table()
        words = WordFeatures(table)
        for texts in batches:
            tails = known.tails(np.array([table[features(x, words)].sum(dtype=np.float64) for x in texts]))
            yield pd.DataFrame({"expected_grade": tails.sum(1), "tail_1": tails[:, 0], "tail_2": tails[:, 1], "kept": tails[:, -1] >= least})

    names = ("expected_grade", "tail_1", "tail_2", "kept")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), grade(F.col("text").cast("string")).alias("found"))
    return rows.select(*(F.col(f"doc.`{c}`") for c in docs.columns if c not in names), "found.*")


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Every document with its expected grade, tail probabilities and whether it is kept."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return graded(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", "expected_grade", "tail_1", "tail_2", "kept")
