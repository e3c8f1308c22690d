"""Mixing sources to target weights by Pfair scheduling of source blocks.

Every source's documents are dealt into blocks of equal size. Block j of a source of weight w
may not start before slot ``floor(j / w)`` and is due by slot ``ceil((j + 1) / w)``. Taking the
released block with the earliest deadline in each slot keeps every source within less than
one block of ``w t`` after t slots. Weights are whole parts of ``PERIOD``, so the schedule of
one period, worked out once, repeats: a block's slot follows from its number by a join.

Where a source has run out its slots stay empty and the others keep theirs, so no document
is dropped or repeated: the order is exact until a source ends, and the order among the
remaining ones is unchanged after that.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoalloc.llm.common import stored

PERIOD, BLOCK_CHARS, GROUP_ROWS = 10_000, 200_000, 5_000


def pfair_period(parts: dict) -> list[tuple]:
    """``(source, block, slot, release, deadline)`` of one period; ``parts`` sum to its length.

    Ties of deadlines go to the smaller source name (None first).
    """
    period = sum(parts.values())
    waiting: dict[int, list] = {}
    rank = {s: i for i, s in enumerate(sorted(parts, key=lambda s: (s is not None, s)))}

    def window(s, j):
        return j * period // parts[s], -((-(j + 1) * period) // parts[s])

    for s, n in parts.items():
        if n:
            waiting.setdefault(0, []).append((s, 0))
    ready, out = [], []
    for slot in range(period):
        for s, j in waiting.pop(slot, ()):
            heapq.heappush(ready, (window(s, j)[1], rank[s], j, s))
        due, _, j, s = heapq.heappop(ready)
        out.append((s, j, slot, window(s, j)[0], due))
        if j + 1 < parts[s]:
            waiting.setdefault(max(slot + 1, window(s, j + 1)[0]), []).append((s, j + 1))
    return out


def whole_parts(weights: dict, period: int = PERIOD) -> dict:
    """Weights as whole parts of the period by largest remainders, at least one for a positive weight."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items() if w > 0}
    if not exact:
        return {}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (parts[s] - exact[s], s is not None, s))
    while (left := period - sum(parts.values())) != 0:
        for s in (by_rest if left > 0 else [s for s in reversed(by_rest) if parts[s] > 1])[: abs(left)]:
            parts[s] += 1 if left > 0 else -1
    return parts


def tempered_weights(sizes: dict, power: float = 0.7) -> dict:
    """Target weights by size to a power below one: small sources are raised."""
    return {s: float(n) ** power for s, n in sizes.items() if n > 0}


def running_sums(df: DataFrame, by: str, size: str, order: list[Column | str]) -> DataFrame:
    """Adds ``start``: the sum of ``size`` before each row among the rows of equal ``by``.

    Rows are dealt by hash into groups of bounded length, summed inside those, and the totals
    of groups are summed once more, so no value of ``by`` is gathered in one task. The order is
    that of the groups, then ``order``.
    """
    rows = df.count()
    groups = max(1, rows // GROUP_ROWS)
    dealt = df.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(groups)))
    totals = dealt.groupBy(by, "part").agg(F.sum(size).alias("total"))
    ahead = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(by, "part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy(by, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("inner", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    totals = totals.withColumnsRenamed({by: "of", "part": "group"})
    return (dealt.join(totals, (F.col(by).eqNullSafe(F.col("of"))) & (F.col("part") == F.col("group")))
            .withColumn("start", F.col("base") + F.col("inner")).drop("part", "group", "of", "base", "inner"))


def schedule(docs: DataFrame, weights: dict | None = None, block_chars: int = BLOCK_CHARS, period: int = PERIOD) -> DataFrame:
    """``doc_id, source, chars, row, block, release, deadline, slot, start``: a place for every row of ``docs``.

    ``slot`` and then ``start`` (characters of the source before the row) order the mix; ``row``
    is a hash of the text that tells rows of equal ids apart. Sizes count characters, at least
    one for each row, so null and empty texts have a place. A row belongs to the block in which
    it starts. A null source is a source; null ids are allowed; equal rows follow one another.
    Sources without a weight come after all slots of the others, as if due at the end, and so
    do all rows where no source of the table has one; ``weights`` default to tempered sizes.
    A negative or infinite weight is an error. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.greatest(F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(1)).cast("long").alias("chars"),
                       F.xxhash64(F.col("text").cast("string")).alias("row"))
    rows = stored(rows)
    sizes = {r[0]: r[1] for r in rows.groupBy("source").agg(F.sum("chars")).collect()}  # a row for each source
    if not sizes:
        return rows.select("*", *(F.lit(0).cast("long").alias(c) for c in ("block", "release", "deadline", "slot", "start")))
    period = max(period, 4 * len(sizes))
    weights = tempered_weights(sizes) if weights is None else weights
    if any(not 0 <= w < float("inf") for w in weights.values()):
        raise ValueError("weights must be finite and not negative")
    parts = whole_parts({s: w for s, w in weights.items() if s in sizes}, period)
    table = docs.sparkSession.createDataFrame(pfair_period(parts), "of string, turn long, at long, opens long, due long")  # period rows
    quota = docs.sparkSession.createDataFrame(list(parts.items()), "name string, quota long")
    placed = running_sums(rows, "source", "chars", ["doc_id", "row"]).withColumn("block", F.floor(F.col("start") / block_chars))
    placed = placed.join(F.broadcast(quota), F.col("source").eqNullSafe(F.col("name")), "left").withColumns(
        {"cycle": F.floor(F.col("block") / F.col("quota")), "number": F.col("block") % F.col("quota")})
    placed = placed.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("of")) & (F.col("number") == F.col("turn")), "left")
    last = F.lit(2**62)
    shift = F.col("cycle") * period
    return placed.select("doc_id", "source", "chars", "row", "block", *(F.coalesce(F.col(c) + shift, last).alias(n) for c, n in (("opens", "release"), ("due", "deadline"), ("at", "slot"))), "start")


def mixed(docs: DataFrame, weights: dict | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows and columns of ``docs``, in the order of the schedule: ranges of slots follow one another in its files.

    Repeated rows take the first of their places together.
    """
    plan = schedule(docs, weights, block_chars).groupBy("doc_id", "row").agg(F.min(F.struct("slot", "start")).alias("at")).select("doc_id", "row", "at.*")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    both = rows.join(plan, F.col("doc.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.col("doc.text").cast("string")) == F.col("row")))
    return both.repartitionByRange("slot", "start").sortWithinPartitions("slot", "start", "doc_id").select("doc.*")


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """The place of every document in a mix of the sources by tempered weights."""
    return schedule(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row")
