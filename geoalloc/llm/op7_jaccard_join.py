"""N-gram Jaccard join by prefix filters under several global token orders.

Two sets with a Jaccard similarity of at least t share a token among the first
``n - ceil(t n) + 1`` of each, whatever order of all tokens is taken. Rare-first orders make
those prefixes selective. The join runs in five steps:

1. ``counted``: one pass over the texts gives every row's set size and signature, and sends
   its tokens, packed by hash range, to the tasks that count in how many sets each occurs (up
   to 256). Tokens of one set only can never match. Tokens that are frequent in one task
   already skip the count. Equal sets form one class with a number of its own.
2. ``gathered``: the shared tokens, packed by class. A class can have a partner only if
   enough of its tokens are shared.
3. ``crowds``: classes with a common least token under one of several hashes are tested
   against one of them, drawn by hash. What links forms groups, so a crowd of near copies is one
   group before any pairs are listed.
4. ``near_pairs``: for each of three orders (rare first, ties by different hashes) the
   remaining prefix tokens meet in buckets, which are dealt out in blocks where they are
   large. Only classes of different groups are paired, and a position bound prunes there.
   Surviving pairs are packed by pairs of home blocks.
5. In a pair of blocks only pairs that every order brought are verified exactly, on the
   shared tokens and the sizes. Pairs already joined there need no test; the links of a
   spanning forest go on to connected components.

Nothing is capped: a bucket of any size is cut into blocks, and each pair of blocks is met.

Hash ranges and stored tables are dealt into tasks by the size of the texts (``parts_for``):
where ``spark.sql.shuffle.partitions`` is far more than a small input needs, the partitions of
a shuffle share tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoalloc.llm.common import Forest, U, WordHashes, components, mix, shingles, stored
from geoalloc.llm.op5_url_filter import KEYS_PER_BLOCK, MOST_BLOCKS, block_of, bloom_filter, mask_of

ORDERS = 3
BATCH, FLUSH, BLOCK, HOME, HOT = 512, 1_500_000, 512, 256, 256
FEW = 250_000  # tokens that are worth a hash range of their own
HASHES = 8
SIDE = 7  # bytes of a token below its hash range


def signature(s: np.ndarray) -> tuple[int, int]:
    """96 bits of a set: 64 and 32."""
    whole = xxhash.xxh3_128_intdigest(s.tobytes())
    return whole >> 64, whole & (1 << 32) - 1


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0..length-1 for each length, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def cut(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def pack_by(group: np.ndarray, n_groups: int, width_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by group, and the bounds of groups among items and their values."""
    order = np.argsort(group, kind="stable")
    items = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=n_groups))])
    values = np.concatenate([[0], np.cumsum(np.bincount(group, weights=width_counts, minlength=n_groups).astype(np.int64))])
    return order, items, values


PACKED = "bucket int, direct boolean, hi binary, lo binary, n binary, counts binary, tokens binary, dfs binary"


def bucket_of(tokens: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of each token; rising with the token."""
    return ((tokens >> U(40)) * U(parts) >> U(24)).astype(np.int64)


def wide(low: np.ndarray, bucket) -> np.ndarray:
    """Tokens from what is left of them below their range; those of different ranges stay apart."""
    return mix(low, 0) ^ mix(np.atleast_1d(np.asarray(bucket)).astype(U), 1)


def packed(group: np.ndarray, marks: np.ndarray, sizes: np.ndarray, counts: np.ndarray, starts: np.ndarray, values: np.ndarray, dfs: np.ndarray | None, parts: int, direct: bool) -> pa.RecordBatch:
    """A row for each group: classes of its entries, and each entry's run of values."""
    order, items, bounds = pack_by(group, parts, counts)
    at = np.repeat(starts[order], counts[order]) + ragged(counts[order])
    some = np.flatnonzero(np.diff(items))
    columns = [cut(x, items) for x in (marks["hi"][order], marks["lo"][order], sizes[order].astype("<u4"), counts[order].astype("<u4"))]
    columns += [cut(values[at], bounds), cut(dfs[at], bounds) if dfs is not None else None]
    return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([direct] * len(some), pa.bool_()),
                                       *(pa.array([x[i] for i in some] if x is not None else [None] * len(some), pa.binary()) for x in columns)], NAMES)


NAMES = [c.split()[0] for c in PACKED.split(", ")]
MARK = np.dtype([("hi", "<u8"), ("lo", "<u4")])


def entries_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks, set sizes and run lengths of the packed rows."""
    hi, lo, n, counts = (joined(table, c, t) for c, t in (("hi", "<u8"), ("lo", "<u4"), ("n", "<u4"), ("counts", "<u4")))
    marks = np.empty(len(hi), MARK)
    marks["hi"], marks["lo"] = hi, lo
    return marks, n, counts.astype(np.int64)


def class_bucket(marks: np.ndarray, parts: int) -> np.ndarray:
    return ((marks["hi"] >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def _send(sets: list[np.ndarray], pairs: list[tuple[int, int]], parts: int) -> Iterator[pa.RecordBatch]:
    """Token sets of distinct classes, packed by hash range of the tokens.

    A token that many of these classes hold is shared without counting: it goes straight to
    its classes, and the count gets one entry for all of them (a class of none, size 0).
    """
    sizes = np.array([len(s) for s in sets])
    marks = np.empty(len(sets), MARK)
    marks["hi"], marks["lo"] = [p[0] for p in pairs], [p[1] for p in pairs]
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, inverse, seen = np.unique(tokens, return_inverse=True, return_counts=True)
    hot = (seen >= HOT)[inverse]

    def runs_of(owners, groups):
        edge = np.flatnonzero(np.concatenate([[True], (owners[1:] != owners[:-1]) | (groups[1:] != groups[:-1])]))
        return edge, np.diff(np.append(edge, len(owners)))

    def lows(x):
        return x.view(np.uint8).reshape(-1, 8)[:, :SIDE]

    cold, bucket = tokens[~hot], bucket_of(tokens[~hot], parts)
    if len(cold):  # sets are sorted, so the tokens of a range stand together
        edge, counts = runs_of(owner[~hot], bucket)
        own = owner[~hot][edge]
        yield packed(bucket[edge], marks[own], sizes[own], counts, edge, lows(cold), None, parts, False)
    if hot.any():
        known = np.unique(tokens[hot])
        ranges = bucket_of(known, parts)
        edge, counts = runs_of(np.zeros(len(known), int), ranges)
        yield packed(ranges[edge], np.zeros(len(edge), MARK), np.zeros(len(edge), int), counts, edge, lows(known), None, parts, False)
        full = wide(tokens[hot] & U((1 << 8 * SIDE) - 1), bucket_of(tokens[hot], parts))
        edge, counts = runs_of(owner[hot], np.zeros(hot.sum(), int))
        own = owner[hot][edge]
        yield packed(class_bucket(marks[own], parts), marks[own], sizes[own], counts, edge, full, np.full(len(full), HOT, "<u4"), parts, True)


def _set_rows(ids: list, marks: list[tuple[int, int]], sizes: list[int], bucket: int) -> pa.RecordBatch:
    """Ids, signatures and sizes of rows, packed as one row; ``tokens`` holds the ids, ``dfs`` which of them are null."""
    columns = [[np.array(x, kind).tobytes()] for x, kind in (([m[0] for m in marks], "<u8"), ([m[1] for m in marks], "<u4"), (sizes, "<u4"), ([], "<u4"),
                                                           ([i or 0 for i in ids], "<i8"), ([i is None for i in ids], np.uint8))]
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([True]), *(pa.array(c, pa.binary()) for c in columns)], NAMES)


def parts_for(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Number of hash ranges: the shuffle partitions, but at least ``FEW`` tokens each, and about ``FLUSH`` at most. Number of tasks for what is stored.

    A word counts as six characters. There are never more tasks than partitions, and cores are not left idle for either.
    """
    chars = docs.agg(F.coalesce(F.sum(F.length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
    cores, shuffle = docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = int(chars // 6 // FLUSH + 1)
    return max(min(shuffle, max(cores, int(chars // 6 // FEW + 1))), most), max(cores, most)


def counted(docs: DataFrame, parts: int, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed rows, stored: in buckets below ``parts`` the shared tokens by class, beyond them the sets of all rows.

    The number kept with a token is that of the sets that hold it, ``HOT`` standing for that
    many and more. That is all the orders need, and it lets a task tell the holders of a
    frequent token right away, so no task gathers all of them.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept, held, own = WordHashes(), {}, 0, ([], [], [])
        bucket = parts + TaskContext.get().partitionId() % parts
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                for id_, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                    s = shingles(text, k, hashes)
                    mark = signature(s)
                    for xs, x in zip(own, (id_, mark, len(s))):
                        xs.append(x)
                    if len(s) and id_ is not None and mark not in kept:
                        kept[mark] = s
                        held += len(s)
                    if held >= FLUSH:
                        yield from _send([*kept.values()], [*kept], parts)
                        kept, held = {}, 0
                if len(own[0]) >= 50_000:
                    yield _set_rows(*own, bucket)
                    own = ([], [], [])
        if kept:
            yield from _send([*kept.values()], [*kept], parts)
        if own[0]:
            yield _set_rows(*own, bucket)

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() >= parts:
            return table.select(NAMES)
        straight = table["direct"].to_numpy(zero_copy_only=False)
        through, table = table.filter(pa.array(straight)), table.filter(pa.array(~straight))
        marks, n, counts = entries_of(table)
        low = np.zeros((counts.sum(), 8), np.uint8)
        low[:, :SIDE] = joined(table, "tokens", np.uint8).reshape(-1, SIDE)
        tokens = low.view("<u8").ravel()
        first = n == 0  # an entry for many classes stays; a class that several tasks sent counts once
        first[np.unique(marks, return_index=True)[1]] = True
        tokens, entry = tokens[np.repeat(first, counts)], np.repeat(np.flatnonzero(first), counts[first])
        _, inverse = np.unique(tokens, return_inverse=True)
        df = np.minimum(np.bincount(inverse, weights=np.where(n[entry] == 0, HOT, 1)), HOT).astype("<u4")[inverse]
        keep = (df > 1) & (n[entry] > 0)
        full, entry, df = wide(tokens[keep], key[0].as_py()), entry[keep], df[keep]
        own, counts = np.unique(entry, return_counts=True)
        out = packed(class_bucket(marks[own], parts), marks[own], n[own], counts, np.cumsum(counts) - counts, full, df, parts, False)
        return pa.concat_tables([pa.Table.from_batches([out]), through.select(NAMES)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sent = rows.mapInArrow(send, PACKED)
    return stored(sent.repartition(parts, "bucket").groupBy("bucket").applyInArrow(count, PACKED))


def set_rows(packed_rows: DataFrame, parts: int) -> DataFrame:
    """``id, n, hi, lo``: set size and signature of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hi, lo, n, ids, null in zip(*(batch[c].to_pylist() for c in ("hi", "lo", "n", "tokens", "dfs"))):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(ids, "<i8"), mask=np.frombuffer(null, np.uint8).astype(bool)), pa.array(np.frombuffer(n, "<u4").astype(np.int64)),
                    pa.array(np.frombuffer(hi, "<i8")), pa.array(np.frombuffer(lo, "<u4").astype(np.int64))], ["id", "n", "hi", "lo"])

    return packed_rows.where(F.col("bucket") >= parts).mapInArrow(run, "id long, n long, hi long, lo long")


def gathered(packed_rows: DataFrame, parts: int, percent: int) -> DataFrame:
    """``hi, lo, n, tokens, dfs``: classes that may have a partner, with their shared tokens, ascending."""
    def gather(table: pa.Table) -> pa.Table:
        marks, n, counts = entries_of(table)
        tokens, dfs = joined(table, "tokens", "<u8"), joined(table, "dfs", "<u4")
        classes, at, inverse = np.unique(marks, return_index=True, return_inverse=True)
        inverse = np.repeat(inverse, counts)
        order = np.lexsort((tokens, inverse))
        tokens, dfs, inverse = tokens[order], dfs[order], inverse[order]
        fresh = np.concatenate([[True], (inverse[1:] != inverse[:-1]) | (tokens[1:] != tokens[:-1])])[: len(tokens)]  # told by several tasks
        tokens, dfs, inverse = tokens[fresh], dfs[fresh], inverse[fresh]
        shared = np.bincount(inverse, minlength=len(classes))
        may = 100 * shared >= percent * n[at].astype(np.int64)
        tokens, dfs = tokens[may[inverse]], dfs[may[inverse]]
        bounds = np.concatenate([[0], np.cumsum(shared[may])])
        return pa.table({"hi": pa.array(classes["hi"][may].view("<i8")), "lo": pa.array(classes["lo"][may].astype(np.int64)), "n": pa.array(n[at][may].astype(np.int64)),
                         "tokens": pa.array(cut(tokens, bounds), pa.binary()), "dfs": pa.array(cut(dfs, bounds), pa.binary())})

    back = packed_rows.where(F.col("bucket") < parts)
    return back.repartition(parts, "bucket").groupBy("bucket").applyInArrow(gather, "hi long, lo long, n long, tokens binary, dfs binary")


def prefixes(id_: int, n: int, tokens: np.ndarray, dfs: np.ndarray, percent: int, trail: int = 6):
    """Per order: the shared tokens of the prefix, their places in the set, and the tokens just before each."""
    left = n - (percent * n + 99) // 100 + 1 - (n - len(tokens))  # prefix places behind the unshared tokens
    for k in range(ORDERS):
        rank = dfs.astype(np.int64) if k == 0 else np.log2(dfs).astype(np.int64)
        order = np.lexsort((mix(tokens, 100 + k), rank))[:left]
        own = tokens[order]
        before = np.zeros((len(own), trail), U)
        for j in range(1, min(trail + 1, len(own))):
            before[j:, j - 1] = own[: len(own) - j]
        yield k, own, n - len(tokens) + np.arange(len(own)), before


PAIRS = "one long, two long, ord int, pairs binary, ids array<long>"
LINKS = "u long, v long"


def homes_of(classes: DataFrame) -> DataFrame:
    """``id, homes``: the least token of each class under ``HASHES`` hashes."""
    def run(batches):
        for b in batches:
            tokens = [np.frombuffer(x, "<u8") for x in b["tokens"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array([[int(mix(t, 77 + k).min() >> U(1)) for k in range(HASHES)] for t in tokens], pa.list_(pa.int64()))], ["id", "homes"])

    return classes.select("id", "tokens").mapInArrow(run, "id long, homes array<long>")


def in_blocks(classes: DataFrame, tasks: int) -> DataFrame:
    """Classes with ``homes`` and ``block``, stored: up to ``HOME`` or so classes of one first home."""
    homes = homes_of(classes).withColumn("home", F.col("homes")[0])
    many = homes.groupBy("home").agg(F.ceil(F.count("*") / HOME).alias("parts"))
    homes = homes.join(many, "home").select("id", "homes", F.xxhash64("home", F.pmod(F.xxhash64("id"), "parts")).alias("block"))
    return stored(classes.join(homes, "id").coalesce(tasks))


def crowds(classes: DataFrame, percent: int, tasks: int) -> DataFrame:
    """``u, v``: links of classes with the one drawn from each of their homes, stored.

    The draw of a home is a minimum with a map-side part, so a home of any size is no
    group; every class meets at most ``HASHES`` others here.
    """
    at = classes.select("id", "block", F.posexplode("homes").alias("k", "home"))
    first = at.groupBy("k", "home").agg(F.min(F.struct(F.xxhash64("id", "k").alias("draw"), "id", "block")).alias("first"), F.count("*").alias("many"))
    first = first.where("many > 1").select("k", "home", "first")  # another one for each hash
    pairs = at.join(first, ["k", "home"]).where("id != first.id")
    swap = "block < first.block or block = first.block and id < first.id"
    pairs = pairs.selectExpr(f"if({swap}, block, first.block) as one", f"if({swap}, first.block, block) as two", f"if({swap}, id, first.id) as u", f"if({swap}, first.id, id) as v").distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield packed_pairs(*(b[c].to_numpy() for c in ("one", "two")), np.zeros(b.num_rows, np.int64), *(b[c].to_numpy() for c in ("u", "v")))

    return stored(tested(stored(pairs.coalesce(tasks).mapInArrow(pack, PAIRS)), classes, percent, 1, tasks))


def tested(pairs: DataFrame, classes: DataFrame, percent: int, orders: int, tasks: int) -> DataFrame:
    """``u, v``: those of the packed pairs that all ``orders`` brought and that link, a spanning forest for each pair of blocks."""
    # the blocks of a pair get the sets of the classes that pairs there name
    need = pairs.select("one", "two", F.explode("ids").alias("id")).distinct()
    members = need.join(classes.select("id", "n", "tokens"), "id").select("one", "two", F.lit(-1).alias("ord"), F.lit(None).cast("binary").alias("pairs"), "id", "n", "tokens")
    work = pairs.select("one", "two", "ord", "pairs", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("tokens")).unionByName(members)

    def verify(table: pa.Table) -> pa.Table:
        brought, chosen = table["ord"].to_pylist(), None
        for k in range(orders):
            seen = [p for o, p in zip(brought, table["pairs"].to_pylist()) if o == k]
            seen = np.unique(np.frombuffer(b"".join(seen), [("u", "<i8"), ("v", "<i8")]))
            chosen = seen if chosen is None else np.intersect1d(chosen, seen, assume_unique=True)
        sets = {i: (n, np.frombuffer(t, "<u8")) for o, i, n, t in zip(brought, *(table[c].to_pylist() for c in ("id", "n", "tokens"))) if o == -1}
        number = {i: x for x, i in enumerate(sets)}
        forest, links = Forest(len(sets)), []
        for u, v in chosen.tolist():
            (m, x), (n, y) = sets[u], sets[v]
            if forest.root(number[u]) != forest.root(number[v]) and enough(len(np.intersect1d(x, y, assume_unique=True)), m + n, percent):
                forest.join(number[u], number[v])
                links.append((u, v))
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([x for _, x in links], pa.int64())})

    return work.groupBy("one", "two").applyInArrow(verify, LINKS).coalesce(tasks)


def near_pairs(classes: DataFrame, percent: int, tasks: int) -> DataFrame:
    """``u, v``: links between classes ``id, n, tokens, dfs``, enough of them to connect all that link."""
    classes = in_blocks(classes, tasks)
    known = crowds(classes, percent, tasks)
    groups = components(known)
    groups = stored(groups.coalesce(tasks))
    classes = classes.join(groups.withColumnsRenamed({"node": "id", "component": "crowd"}), "id", "left").withColumn("crowd", F.coalesce("crowd", "id"))
    classes = stored(classes.coalesce(tasks))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                out = [[] for _ in range(8)]
                for id_, n, block, crowd, tokens, dfs in zip(*(batch[c].to_pylist() for c in ("id", "n", "block", "crowd", "tokens", "dfs"))):
                    for k, own, places, before in prefixes(id_, n, np.frombuffer(tokens, "<u8"), np.frombuffer(dfs, "<u4"), percent):
                        m = len(own)
                        for xs, x in zip(out, (own.view("<i8").tolist(), [k] * m, [id_] * m, [n] * m, places.tolist(), [block] * m, [crowd] * m, [x.tobytes() for x in before])):
                            xs += x
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                                 ["token", "ord", "id", "n", "place", "block", "crowd", "before"])

    rows = stored(classes.mapInArrow(spread, "token long, ord int, id long, n long, place long, block long, crowd long, before binary"))
    buckets = rows.groupBy("token", "ord").agg(F.count("*").alias("many"), F.min("crowd").alias("low"), F.max("crowd").alias("high")).where("low < high")
    buckets = buckets.select("token", "ord", F.ceil(F.col("many") / BLOCK).cast("int").alias("parts"))
    deal = rows.join(buckets, ["token", "ord"]).withColumn("own", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    deal = deal.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    deal = deal.withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")})
    # many small buckets share a task call
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = deal.select("ord", "token", "one", "two", "own", "crowd", "id", "n", "place", "block", "before").repartition(parts, "ord", "token", "one", "two").coalesce(tasks)
    deal = deal.sortWithinPartitions("ord", "token", "one", "two", F.col("own") != F.col("one"), "crowd")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for rows in whole_buckets(batches):
            for a, b in bucket_pairs(rows, percent):
                ids, blocks = rows["id"], rows["block"]
                swap = (blocks[a] > blocks[b]) | (blocks[a] == blocks[b]) & (ids[a] > ids[b])
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                found.append((blocks[a], blocks[b], rows["ord"][a].astype(np.int64), ids[a], ids[b]))
                size += len(a)
                if size > 400_000:
                    yield packed_pairs(*map(np.concatenate, zip(*found)))
                    found, size = [], 0
        if size:
            yield packed_pairs(*map(np.concatenate, zip(*found)))

    links = tested(stored(deal.mapInArrow(meet, PAIRS)), classes, percent, ORDERS, tasks)
    return groups.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(links)


def enough(common, sizes, percent: int):
    """100 * intersection >= percent * union, in whole numbers."""
    return 100 * common >= percent * (sizes - common)


KEYS = ("ord", "token", "one", "two")


def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Columns of whole buckets, many at a time, over a sorted stream of batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.Table.from_batches([batch])
        held = batch if held is None else pa.concat_tables([held, batch])
        last = held.slice(held.num_rows - 1)
        same = np.all([held[c].to_numpy() == last[c][0].as_py() for c in KEYS], axis=0)
        done = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if done:
            yield unpacked(held.slice(0, done))
            held = held.slice(done).combine_chunks()
    if held is not None:
        yield unpacked(held)


def unpacked(table: pa.Table) -> dict:
    out = {c: table[c].to_numpy() for c in table.column_names if c != "before"}
    return out | {"before": joined(table, "before", "<u8").reshape(table.num_rows, -1)}


def run_ends(*columns: np.ndarray) -> np.ndarray:
    """For each row the end of the run of rows with equal values that it stands in."""
    edge = np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns], axis=0)) + 1
    ends = np.append(edge, len(columns[0]))
    return np.repeat(ends, np.diff(ends, prepend=0))


def bucket_pairs(rows: dict, percent: int, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within buckets (or of two blocks of one) that may link and share no token just before.

    Rows stand by bucket, side and crowd. A pair whose first common token stands here has at
    most the tokens from here on in common; pairs that share an earlier token were met there
    under a looser bound.
    """
    keys = [rows[c] for c in KEYS]
    end, same = run_ends(*keys), rows["one"] == rows["two"]
    side = rows["own"] != rows["one"]
    # inside one block a row meets what stands behind its crowd, across blocks the whole other side
    start = np.where(same, run_ends(*keys, rows["crowd"]), run_ends(*keys, side))
    many = np.where(same | ~side, end - start, 0)
    n, rest, before, crowd = rows["n"], rows["n"] - rows["place"], rows["before"], rows["crowd"]
    upto = np.cumsum(many)
    low = 0
    while low < len(many):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + most, side="right")))
        i = np.repeat(np.arange(low, high), many[low:high])
        j = np.repeat(start[low:high], many[low:high]) + ragged(many[low:high])
        low = high
        may = (crowd[i] != crowd[j]) & enough(np.minimum(rest[i], rest[j]), n[i] + n[j], percent)
        i, j = i[may], j[may]
        earlier = np.zeros(len(i), bool)
        for c in range(before.shape[1]):
            earlier |= ((before[i] == before[j, c][:, None]) & (before[i] != 0)).any(1)
        if not earlier.all():
            yield i[~earlier], j[~earlier]


def packed_pairs(one: np.ndarray, two: np.ndarray, order: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Distinct pairs, a row for each pair of blocks and order, with the ids named there."""
    rows = np.unique(np.stack([one, two, order, u, v], 1).astype(np.int64), axis=0)
    edge = np.flatnonzero(np.any(np.diff(rows[:, :3], axis=0, prepend=rows[:1, :3] - 1) != 0, axis=1))
    group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(rows))))
    named = np.unique(np.stack([np.repeat(group, 2), rows[:, 3:].ravel()], 1), axis=0)
    bounds = np.searchsorted(named[:, 0], np.arange(len(edge) + 1))
    flat = np.ascontiguousarray(rows[:, 3:]).astype("<i8")
    pairs = [flat[s:e].tobytes() for s, e in zip(edge, [*edge[1:], len(rows)])]
    return pa.RecordBatch.from_arrays([pa.array(rows[edge, 0]), pa.array(rows[edge, 1]), pa.array(rows[edge, 2].astype(np.int32)), pa.array(pairs, pa.binary()),
                                       pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(named[:, 1]))], ["one", "two", "ord", "pairs", "ids"])


def linked_classes(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """``id, n, hi, lo`` of every row; ``hi, lo, class, class_id`` of the classes; ``u, v``, links of class numbers; number of tasks to store tables by."""
    parts, tasks = parts_for(docs, text_col)
    both = counted(docs, parts, k, id_col, text_col)
    sets = stored(set_rows(both, parts))
    # apart, so that a join with the rows can split a class of many copies
    classes = sets.where("id is not null and n > 0").groupBy("hi", "lo").agg(F.min("id").alias("class_id"))
    classes = stored(classes.coalesce(tasks).withColumn("class", F.monotonically_increasing_id()))
    may = gathered(both, parts, percent).join(classes.withColumnRenamed("class", "id"), ["hi", "lo"]).select("id", "n", "tokens", "dfs")
    return sets, classes, near_pairs(stored(may.coalesce(tasks)), percent, tasks), tasks


def jaccard_join(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, class_id, component_id`` for every row of ``docs``.

    Links: Jaccard similarity of the ``k``-word shingle sets of at least ``percent`` / 100.
    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id
    reachable by links. Null and empty texts have an empty set and link with nothing (their
    own ids). Rows with a null id keep their size and get null ids; they join nobody.
    Repeated rows are links of their id to itself; an id with several texts links with all
    their partners. Other columns are not read, whatever their names.
    """
    sets, classes, links, tasks = linked_classes(docs, k, percent, id_col, text_col)
    mine = stored(sets.where("id is not null and n > 0").join(classes, ["hi", "lo"]).select("id", "hi", "lo", "class", "class_id").coalesce(tasks))
    # one id on several sets holds their classes together
    several = mine.groupBy("id").agg(F.min("class").alias("u"), F.max("class").alias("v")).where("u != v")
    several = mine.join(several.select("id", "u"), "id").select("u", F.col("class").alias("v"))
    found = components(links.unionByName(several.coalesce(tasks)))
    of = classes.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    lowest = of.groupBy("component").agg(F.min("class_id").alias("component_id"))
    of = of.join(lowest, "component").select("hi", "lo", "class_id", "component_id")
    out = sets.join(of, ["hi", "lo"], "left")
    own = lambda c: F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col(c)).otherwise(F.col("id"))).alias(c)
    return out.select("id", F.col("n").alias("n_shingles"), own("component_id"), own("class_id"))


def screened(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with ``__may``: whether the ``doc_id`` may be in ``ids``, a stored table of distinct ones.

    Never false for one that is. The filter has a greatest size, so it is broadcast, and rows that
    it clears need no join: more ids than it was made for raise the share of the others only.
    """
    blocks = min(MOST_BLOCKS, 1 << max(4, (ids.count() // KEYS_PER_BLOCK).bit_length()))
    words = bloom_filter(ids.select(F.col("doc_id").alias("key")), blocks).withColumnsRenamed({"block": "__block", "word": "__word"})
    key = F.col("doc_id").cast("long")
    rows = docs.join(F.broadcast(words), block_of(key, blocks) == F.col("__block"), "left")
    may = F.coalesce(F.col("__word").bitwiseAND(mask_of(key)) == mask_of(key), F.lit(False))
    return rows.withColumn("__may", may).drop("__block", "__word")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is not in ``ids``; texts of those that the filter leaves open only are shuffled."""
    rows = screened(docs, ids)
    rest = rows.where("__may").join(ids, "doc_id", "left_anti")
    return rows.where("not __may").select(docs.columns).unionByName(rest.select(docs.columns))


def one_of_each(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``docs`` with one row of each component of linked texts: of its smallest id, the least row.

    Rows with a null id and those without words stay. Texts are linked by their sets alone, so
    an id with several texts loses none that is no near copy.
    """
    sets, classes, links, tasks = linked_classes(docs, k, percent)
    found = components(links)
    of = classes.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    first = of.groupBy("component").agg(F.min(F.struct("class_id", "hi", "lo")).alias("first")).select("first.*")
    stay = stored(first.withColumnRenamed("class_id", "doc_id").coalesce(tasks))
    worded = sets.where("id is not null and n > 0")
    again = stored(sets.where("id is not null").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("id").alias("doc_id")).coalesce(tasks))
    left_out = worded.join(stay.withColumnRenamed("doc_id", "id"), ["id", "hi", "lo"], "left_anti").select(F.col("id").alias("doc_id")).distinct()
    left_out = stored(left_out.coalesce(tasks))
    if again.isEmpty():
        return without(docs, left_out)
    # rows of repeated ids are told apart by their sets
    rows = screened(docs, again).where("__may").join(again, "doc_id", "left_semi").select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.select("row", F.col("row.text").cast("string").alias("text"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            own = [shingles(x, k, hashes) for x in batch["text"].to_pylist()]
            marks = [signature(s) for s in own]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array([len(s) for s in own], pa.int64()), pa.array(np.array([m[0] for m in marks], U).view("<i8")), pa.array([m[1] for m in marks], pa.int64())], ["row", "n", "hi", "lo"])

    rows = rows.mapInArrow(signed, f"row {rows.schema['row'].dataType.simpleString()}, n long, hi long, lo long").withColumn("doc_id", F.col("row.doc_id"))
    rows = stored(rows)
    least = rows.where("n > 0").join(stay, ["doc_id", "hi", "lo"], "left_semi").groupBy("doc_id", "hi", "lo").agg(F.min("row").alias("row"))
    more = rows.where("n = 0").select("row.*").unionByName(least.select("row.*"))
    single = without(docs, stored(left_out.unionByName(again.select("doc_id")).distinct()))
    return single.unionByName(more.select(docs.columns))


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """All documents, four-word shingles, similarity 0.85."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_join(docs, 4, 85).withColumnRenamed("id", "doc_id")
