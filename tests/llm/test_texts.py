"""Operators on texts against brute force, with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geoalloc.llm import op2_quality as op2
from geoalloc.llm import op4_mixing as op4
from geoalloc.llm.common import components, shared_folder
from geoalloc.llm.op6_packing import TOKENIZER, ChunkIds, pack
from geoalloc.llm.op7_jaccard_join import jaccard_join, one_of_each, screened, without
from geoalloc.llm.op9_winnowing import WINDOW, code_points, edited_digests, fingerprints, gram_hashes, winnow
from geoalloc.llm.op10_separators import END_ID, count_tokens, scan_blocks, write_token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: columns whose names the operators use inside
CLASH = ("id", "n", "hi", "lo", "part", "row", "slot", "start", "tokens", "file", "u", "v", "range", "extra", "class_id", "grade_of_text", "k0")


def some_docs(rng: random.Random, many: int = 60) -> list[tuple]:
    words = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "λ", "mu,", "nu.", "xi"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(rng.choice([2, 5, 60, 200]))) for _ in range(many // 3)]
    texts = []
    for _ in range(many):
        t = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 8])):
            t[rng.randrange(len(t))] = rng.choice(words)
        texts.append(rng.choice([" ", "  ", "\n", "\t "]).join(t))
    texts += [None, "", " \n", "one", "ONE", "two words", "x" * 50_000, "wörd " * 20_000, "a b c d e", "<|endoftext|> is text"]
    rows = [(i * 3, t, "en", rng.choice(["s1", "s2", None]), 0) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, base[0], "en", "s1", 0), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return some_docs(random.Random(5))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 301), (301, 302), (302, 300), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = roots({x for p in links for x in p}, links)
    assert found == {n: c for n, c in want.items()}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_in_few_rounds(spark, monkeypatch):
    import geoalloc.llm.common as common

    tables, keep = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df: tables.append(keep(df)) or tables[-1])
    links = [(i, i + 1) for i in range(600)] + [(i, i) for i in range(5)] + [(i, i + 1) for i in range(0, 600, 7)] + [(1000, i) for i in range(1001, 1100)]
    random.Random(2).shuffle(links)
    for most in (500_000, 50):  # edges of a task at once, and in several lots
        monkeypatch.setattr(common, "EDGES", most, raising=False)
        tables.clear()
        got = [(r.node, r.component) for r in components(spark.createDataFrame(links, "u long, v long")).collect()]
        assert sorted(got) == [(i, 0) for i in range(601)] + [(i, 1000) for i in range(1000, 1100)]
        assert len(tables) <= 6


def test_small_texts_take_few_tasks(spark, monkeypatch):
    """Stored tables are dealt by their size, not by a number of shuffle partitions far beyond it."""
    import geoalloc.llm.common as common
    import geoalloc.llm.op7_jaccard_join as op7

    files, keep = [], common.stored

    def seen(df):
        out = keep(df)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(common, "stored", seen)
    monkeypatch.setattr(op7, "stored", seen)
    rng, rows = random.Random(8), []
    for i in range(300):
        t = words(rng, 60)
        rows += [(2 * i, " ".join(t)), (2 * i + 1, " ".join([*t[:-1], "end"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r.id: r.component_id for r in jaccard_join(docs, 4, 85).collect()}
        assert got == {i: i - i % 2 for i in range(600)}
        assert sorted(r.doc_id for r in one_of_each(docs, 4, 85).collect()) == [*range(0, 600, 2)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(files) <= 3 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join(docs, rows, k, percent):
    sets = {}
    for i, text, *_ in rows:
        words = (text or "").encode().lower().split()
        sets.setdefault(i, set()).add(frozenset(zip(*(words[j:] for j in range(k))) if len(words) >= k else [tuple(words)] if words else []))
    flat = [(i, s) for i, ss in sets.items() if i is not None for s in ss if s]
    links = [(i, j) for (i, s), (j, t) in combinations(flat, 2) if 100 * len(s & t) >= percent * len(s | t)]
    want = roots([i for i in sets if i is not None], links)
    got = jaccard_join(docs, k, percent).collect()
    assert len(got) == len(rows) and len(set(want.values())) < len(want)
    for r in got:
        assert r.component_id == want.get(r.id) and r.n_shingles in {len(s) for s in sets[r.id]}


def test_jaccard_join_of_a_crowd(spark):
    """One base, many edits: a bucket of several blocks, and links that only some share."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(700):
        t = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 6])):
            t[rng.randrange(80)] = f"e{rng.randrange(9)}"
        rows.append((i, " ".join(t)))
    got = {r.id: r.component_id for r in jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    sets = {i: frozenset(zip(*(t.split()[j:] for j in range(4)))) for i, t in rows}
    links = [(i, j) for (i, s), (j, t) in combinations(sets.items(), 2) if 100 * len(s & t) >= 85 * len(s | t)]
    assert got == roots(sets, links)


def words(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def test_an_id_with_several_texts(spark):
    rng = random.Random(4)
    a, b, c = (words(rng, 200) for _ in range(3))
    rows = [(5, a), (5, b), (7, a[1:]), (9, b[1:]), (11, c), (11, c), (12, c[2:])]
    rows = [(i, " ".join(t)) for i, t in rows] + [(13, ""), (13, "a b"), (13, None), (14, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.id, r.component_id) for r in jaccard_join(docs, 4, 85).collect())
    assert got == [(5, 5), (5, 5), (7, 5), (9, 5), (11, 11), (11, 11), (12, 11), (13, 13), (13, 13), (13, 13), (14, 14)]
    kept = sorted((r.doc_id, r.text or "") for r in one_of_each(docs, 4, 85).collect())
    assert kept == sorted([(5, rows[0][1]), (5, rows[1][1]), (11, rows[4][1]), (13, ""), (13, ""), (13, "a b"), (14, "")])


def test_a_crowd_stores_no_square_of_pairs(spark, monkeypatch):
    import geoalloc.llm.op7_jaccard_join as op7

    sizes, keep = [], op7.stored

    def seen(df):
        out = keep(df)
        if "pairs" in out.columns:
            sizes.append(out.agg(F.coalesce(F.sum(F.octet_length("pairs")), F.lit(0))).first()[0])
        return out

    monkeypatch.setattr(op7, "stored", seen)
    rng = random.Random(6)
    base = words(rng, 150)
    stored_bytes = []
    for n in (300, 600):
        rows = []
        for i in range(n):
            t = list(base)
            t[rng.randrange(150)] = rng.choice(base)
            rows.append((i, " ".join(t)))
        sizes.clear()
        got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
        assert sum(r.component_id == 0 for r in got) > 0.9 * n
        stored_bytes.append(sum(sizes))
    assert stored_bytes[1] < 2.5 * stored_bytes[0] and stored_bytes[1] < 16 * 600 * 20


def test_jaccard_join_of_nothing(none, spark):
    assert jaccard_join(none, 4, 85).count() == 0
    alone = jaccard_join(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), 4, 85)
    assert {tuple(r) for r in alone.select("id", "n_shingles", "component_id").collect()} == {(1, 0, 1), (2, 0, 2)}


def test_one_of_each(docs, rows):
    kept = one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns
    want = {r.component_id for r in jaccard_join(docs, 5, 80).collect() if r.id is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want) and got.count(None) == 2


def test_texts_that_stay_are_not_shuffled(spark, tmp_path, monkeypatch):
    spark.range(4000).selectExpr("id as doc_id", "concat('text ', id) as text", "7 as key", "7 as block").unionByName(
        spark.sql("select cast(null as bigint) as doc_id, 'none' as text, 7 as key, 7 as block")).write.parquet(f"{tmp_path}/docs")
    spark.range(0, 5000, 10).withColumnRenamed("id", "doc_id").write.parquet(f"{tmp_path}/ids")
    docs, ids = spark.read.parquet(f"{tmp_path}/docs"), spark.read.parquet(f"{tmp_path}/ids")
    want = sorted(x for x in range(4000) if x % 10)

    def kept():
        out = without(docs, ids)
        assert out.columns == docs.columns
        got = [r.doc_id for r in out.collect()]
        assert got.count(None) == 1 and sorted(x for x in got if x is not None) == want
        return out

    open_ = {r.doc_id for r in screened(docs, ids).where("__may").collect()}
    assert set(range(0, 4000, 10)) <= open_ and len(open_) < 500 and None not in open_
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        cleared = kept()._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]
        assert "NOT" in cleared and "Exchange hashpartitioning(doc_id" not in cleared
        assert "shiftright" in one_of_each(docs, 5, 80)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr("geoalloc.llm.op7_jaccard_join.MOST_BLOCKS", 4)  # a filter of far too few words
    kept()


def test_packing(docs, rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = {}
    for i, text, *_ in rows:
        want.setdefault(i, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    got = pack(docs, ["doc_id"], window=64).collect()
    total = sum(len(x) for xs in want.values() for x in xs)
    got.sort(key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in got:
        assert r.sequence_id * 64 + r.offset == at and r.offset + r.length <= 64
        assert any(len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 and r.ids == np.array(x[r.start : r.start + r.length], "<u4").tobytes() for x in want[r.doc_id])
        at += r.length
    assert at == total


def test_packing_of_nothing(none):
    assert pack(none, ["doc_id"]).count() == 0


def test_packing_in_a_given_order(spark, tmp_path):
    spark.range(0, 200).selectExpr("199 - id as doc_id", "repeat('word ', cast(id as int)) as text").repartition(4).write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d")).select("*", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("r"))
    order = [x.doc_id for x in read.orderBy("f", "r").collect()]
    got = pack(read.select("doc_id", "text", "f", "r"), ["doc_id"], window=128, order=("f", "r")).orderBy("sequence_id", "offset").collect()
    assert list(dict.fromkeys(x.doc_id for x in got)) == order


def test_chunks_have_the_ids_of_whole_texts(rows):
    ids, tokenizer = ChunkIds(TOKENIZER, "<u4"), Tokenizer.from_file(TOKENIZER)
    assert ids.chunks and ids.plain
    texts = [t for _, t, *_ in rows if t] + ["ÉCOLE école’s İstanbul ΣΑΣ. a,b.c,,. x.́ ﬁn ①② 東京。 don't I'LL", "éa \x1cq\x0b.", "Ünï, ſtraße K Å."]
    for t in texts:
        assert np.frombuffer(ids.of(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_chunks_of_mixed_strings():
    ids, tokenizer, rng = ChunkIds(TOKENIZER, "<u4"), Tokenizer.from_file(TOKENIZER), random.Random(8)
    letters = list("abcXYZéÉßñÑçÇİıŞşĞŁœŒæĿŉſǅǆÅΣσςЖж東ﬁ\u0301\u0307\u200b09.,.,.,;:'’-_$%#<|>\t\x0b\x1c\u00a0  \n") + ["the", "schung", "İKİ", "SERGİ", "école", "nation", "don't"]
    texts = ["İKİ.", "yeni bir SERGİ, ve"] + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(100_000)]
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, w in zip(texts, want) if np.frombuffer(ids.of(t), "<u4").tolist() != w.ids]
    assert not wrong, wrong[:20]


def test_words_are_asked_for_once(monkeypatch):
    """Capitals and signs after a word do not make it another one, and words met again outlive those met once."""
    asked = []
    for name in ("encoded", "modelled"):
        monkeypatch.setattr(ChunkIds, name, lambda self, text, keep=getattr(ChunkIds, name): asked.append(text) or keep(self, text))
    ids, tokenizer = ChunkIds(TOKENIZER, "<u2"), Tokenizer.from_file(TOKENIZER)
    asked.clear()
    text = "nation Nation NATION nation. nation, Nation: nation***\nnation.*** nation) école École ÉCOLE, école!"
    assert np.frombuffer(ids.of(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert asked.count("nation") == 1 and asked.count("école") == 1 and len(asked) <= 10
    ids = ChunkIds(TOKENIZER, "<u2", most=20)
    asked.clear()
    for i in range(200):
        ids.of(f"nation word{'abcdefghij'[i % 10]}{'abcdefghijklmnopqrst'[i // 10]} " + "x" * (200 + i))
    assert asked.count("nation") == 1 and len(ids) + len(ids.old) <= 20 and max(map(len, ids)) <= 100


def test_tasks_of_a_process_share_what_they_know(tmp_path):
    import shutil

    from geoalloc.llm.op6_packing import chunk_ids

    path = shutil.copy(TOKENIZER, tmp_path / "t.json")
    ids = chunk_ids(str(path), "<u2")
    assert chunk_ids(str(path), "<u2") is ids and chunk_ids(str(path), "<u2", names_are_text=True) is not ids
    os.utime(path, ns=(1, 1))
    assert chunk_ids(str(path), "<u2") is not ids


def test_names_of_tokens_inside_texts():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    letters = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|endof", "text|>", "<|", "|>", "A", "É", "é", "İ", "’", "\u0307", "'S", "'", "n'T", "9", "Σ", " ", " ", "\n", "\x1c", ".", ",", "*"]
    rng = random.Random(9)
    for as_text in (False, True):
        ids = ChunkIds(TOKENIZER, "<u4", names_are_text=as_text)
        tokenizer.encode_special_tokens = as_text
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(20_000)]
        wrong = [t for t, w in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)) if np.frombuffer(ids.of(t), "<u4").tolist() != w.ids]
        assert not wrong, wrong[:20]


def test_winnowing_keeps_the_rightmost_minimum_of_every_window():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, WINDOW, WINDOW + 1, 200):
        hashes = rng.integers(0, 6, n).astype(np.uint32)  # many ties
        spans = [range(i, min(i + WINDOW, n)) for i in range(max(1, n - WINDOW + 1))] if n else []
        assert winnow(hashes).tolist() == sorted({max(s, key=lambda j: (-int(hashes[j]), j)) for s in spans})


def test_rolling_hashes_depend_on_the_gram_alone():
    text = "".join(random.Random(3).choice("abé\U0001f600 ") for _ in range(70_000))
    hashes, other = gram_hashes(code_points(text)), gram_hashes(code_points("zz" + text[65_500:]))
    assert hashes[65_500:].tolist() == other[2:].tolist()


def test_shared_passages_share_marks(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(WINDOW + 15))
    a, b = ("".join(rng.choice("ijklmn ") for _ in range(400)) for _ in range(2))
    one, two = (fingerprints(spark.createDataFrame([(1, x)], "doc_id long, text string")).first() for x in (a + passage + a, b[:77] + passage))
    common = {m.hash for m in one.marks} & {m.hash for m in two.marks}
    assert any(m.hash in common and len(a) <= m.pos < len(a) + len(passage) for m in one.marks)


def test_edited_digests(docs, rows, none, spark):
    got = edited_digests(docs).collect()
    assert len(got) == len(rows) and edited_digests(none).count() == 0
    order = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for (i, x), (_, y) in zip(order, order[1:] + order[:1]):
        third = len(x) // 3
        want.append((i, len(x), hashlib.sha256((x[: len(x) - third] + y[:third]).encode()).hexdigest()))
    assert sorted(((r.doc_id or -1, r.n_chars, r.edited_sha256) for r in got)) == sorted((i or -1, n, h) for i, n, h in want)
    by_text, marks = {}, {i: t for i, t, *_ in rows}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            assert by_text.setdefault(marks[r.doc_id], r.fingerprint) == r.fingerprint
    one = edited_digests(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_edited_digests_over_many_ranges(spark):
    rows = [(i * 7 % 9001, f"text {i} " * (i % 5)) for i in range(9001)]
    got = {r.doc_id: r.edited_sha256 for r in edited_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(rows, reverse=True)
    for (i, x), (_, y) in zip(order, order[1:] + order[:1]):
        third = len(x) // 3
        assert got[i] == hashlib.sha256((x[: len(x) - third] + y[:third]).encode()).hexdigest()


def test_token_counts(docs, rows, none, spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    path = shared_folder(spark)
    width = write_token_files(docs, path)
    want = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in rows)
    for block, at_once in ((1, 1 << 16), (5, 4000), (1000, 3), (1 << 18, 64)):
        got = count_tokens(spark, path, width, block_ids=block, range_blocks=at_once).collect()
        assert sorted(r.tokens for r in got) == want and all(r.closed for r in got)
        for name in {r.file for r in got}:
            own = sorted((r.number, r.start, r.tokens) for r in got if r.file == name)
            assert [n for n, *_ in own] == list(range(len(own))) and all(a[1] + a[2] == b[1] for a, b in zip(own, own[1:]))
    path = shared_folder(spark)
    write_token_files(none, path)
    assert count_tokens(spark, path, width).count() == 0


def test_token_counts_of_unclosed_ends(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([5, 6, END_ID, END_ID, 9, 9, 9], "<u4").tobytes())
    (tmp_path / "b.bin").write_bytes(np.array([7], "<u4").tobytes())
    (tmp_path / "c.bin").write_bytes(b"")
    for block, at_once in ((1, 1), (2, 1), (3, 2), (100, 64)):
        got = sorted(tuple(r) for r in count_tokens(spark, str(tmp_path), 4, block_ids=block, range_blocks=at_once).collect())
        assert got == [("a.bin", 0, 0, 3, True), ("a.bin", 1, 3, 1, True), ("a.bin", 2, 4, 3, False), ("b.bin", 0, 0, 1, False)]
    (tmp_path / "d.bin").write_bytes(b"123")
    with pytest.raises(Exception, match="inside an id"):
        count_tokens(spark, str(tmp_path), 4).count()


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    """Documents from one id to several ranges long, in a file whose name needs escapes."""
    rng = random.Random(8)
    lengths = [rng.choice([1, 2, 7, 40, 300]) for _ in range(60)]
    ids = [i for n in lengths for i in [3] * (n - 1) + [END_ID]]
    (tmp_path / "a b%20c.bin").write_bytes(np.array(ids, "<u2").tobytes())
    blocks = scan_blocks(spark, str(tmp_path), 2, END_ID, block_ids=10, range_blocks=4)
    tasks = blocks.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count("*").alias("n")).collect()
    assert len(tasks) > 8 and sum(t.n for t in tasks) == -(-len(ids) // 10)
    got = sorted(tuple(r) for r in count_tokens(spark, str(tmp_path), 2, block_ids=10, range_blocks=4).collect())
    starts = np.cumsum([0, *lengths[:-1]]).tolist()
    assert got == [("a b%20c.bin", k, at, n, True) for k, (at, n) in enumerate(zip(starts, lengths))]


def test_periods_deviate_by_less_than_a_block():
    for parts in ({"a": 5, "b": 3, "c": 2}, {"a": 1, None: 99}, {"a": 333, "b": 333, "c": 334}, {"a": 7}):
        period, done = sum(parts.values()), dict.fromkeys(parts, 0)
        found = op4.pfair_period(parts)
        assert [slot for _, _, slot, _, _ in found] == list(range(period))
        for source, number, slot, release, deadline in found:
            assert done[source] == number and release <= slot < deadline
            done[source] += 1
            assert all(abs(done[s] - parts[s] * (slot + 1) / period) < 1 for s in parts)
    parts = op4.whole_parts({"a": 1e-9, "b": 1, "c": 1}, 100)
    assert sum(parts.values()) == 100 and min(parts.values()) == 1


def test_mixing(docs, rows, none):
    plan = op4.schedule(docs, block_chars=500, period=20).collect()
    assert len(plan) == len(rows) and op4.schedule(none).count() == 0 and op4.mixed(none).count() == 0
    for source in ("s1", "s2", None):
        own = sorted((r.start, r.chars, r.block, r.slot) for r in plan if r.source == source)
        assert [b for _, _, b, _ in own] == [s // 500 for s, *_ in own] and [x[3] for x in own] == sorted(x[3] for x in own)
        assert sum(c for _, c, *_ in own) == sum(max(1, len(t or "")) for _, t, _, s, _ in rows if s == source)
    for r in plan:
        assert r.release <= r.slot < r.deadline
    mixed = op4.mixed(docs, block_chars=500)
    assert mixed.columns == docs.columns and sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))


def test_mixing_without_usable_weights(docs, rows, none):
    assert op4.whole_parts({}, 10) == {} == op4.whole_parts({"a": 0}, 10)
    for weights in ({}, {"nobody": 1.0}, {"s1": 0.0}):
        plan = op4.schedule(docs, weights, block_chars=500, period=20)
        assert plan.count() == len(rows) and plan.select("slot").distinct().collect() == [(2**62,)]
    for weights in ({"s1": -1.0, "s2": 1.0}, {"s1": float("nan")}, {"s1": float("inf")}):
        with pytest.raises(ValueError):
            op4.schedule(docs, weights)


def test_quality(spark):
    rng = random.Random(2)
    good = ["sun", "tree", "river", "stone", "cloud", "field", "bird", "leaf"]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(good) + rng.choice("abcdefg") for _ in range(rng.randrange(5, 120))]
        toxic, junk = i % 5 == 0, i % 7 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["scoundrel", "villain"])
        if junk:
            words = [w + "$%" for w in words]
        rows.append((i, " ".join(words)))
        if i < 600:
            labels.append((i, int(not junk), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels += [(1, None, 0), (None, 1, 1), (99_999, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = op2.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in op2.graded(docs.withColumns({c: F.lit(7) for c in CLASH}), model).collect()}
    held_out = range(600, 900)
    assert np.mean([got[i].kept == (i % 5 != 0 and i % 7 != 0) for i in held_out]) > 0.98
    assert all(1 >= r.tail_1 >= r.tail_2 >= 0 and abs(r.expected_grade - r.tail_1 - r.tail_2) < 1e-9 for r in got.values())
    by_grade = [np.mean([got[i].expected_grade for i in held_out if (i % 5 != 0) + (i % 7 != 0) == g]) for g in (1, 2)]
    assert by_grade[0] < by_grade[1]


def test_quality_without_labels_or_texts(docs, rows, none, spark):
    model = op2.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    got = op2.graded(docs, model)
    assert got.count() == len(rows) and got.where("not kept").count() == 0
    assert set(docs.columns) - {"grade_of_text"} <= set(got.columns)
    assert op2.graded(none, model).count() == 0


def test_quality_against_plain_sums(spark):
    """Likelihood and tails worked out term by term; the fit is a low point of the former."""
    import math

    rng = random.Random(12)
    words_of = op2.WordFeatures()
    texts = [" ".join(rng.choice(["sun", "tree", "stone", "bird"] + ["rot", "mud"] * (i % 3 == 0) + ["vile"] * (i % 5 == 0)) for _ in range(rng.randrange(4, 40))) for i in range(400)]
    grades = [2 - (i % 3 == 0) - (i % 5 == 0) if rng.random() < 0.8 else rng.randrange(3) for i in range(400)]
    rows = [op2.features(t, words_of) for t in texts]
    model = op2.fit_rows(rows, np.array(grades))
    assert len(model.numbers) > 5 and (model.weights >= 0).all()

    def tails(row, weights, thresholds):
        known = dict(zip(model.numbers.tolist(), weights))
        s = -op2.STEEP * math.log(1 + sum(known.get(x, 0.0) for x in row.tolist()))
        return [1 / (1 + math.exp(t - s)) for t in thresholds]

    def loss(weights, thresholds):
        total = 0.0
        for row, g in zip(rows, grades):
            at = [1.0, *tails(row, weights, thresholds), 0.0]
            total -= (3.0 if g < 2 else 1.0) * math.log(max(at[g] - at[g + 1], 1e-9)) / len(rows)
        return total + 0.5e-6 * sum(w * w for w in weights) + 0.5e-4 * (thresholds[0] ** 2 + math.log(thresholds[1] - thresholds[0]) ** 2)

    weights, thresholds = model.weights.tolist(), model.thresholds.tolist()
    least = loss(weights, thresholds)
    assert least < 0.9 * loss([0.0] * len(weights), thresholds)
    for j in range(2):
        for step in (-0.3, 0.3):
            moved = [t + step * (k == j) for k, t in enumerate(thresholds)]
            assert moved[0] >= moved[1] or loss(weights, moved) > least - 2e-3
    for j in rng.sample(range(len(weights)), 6):
        for step in (-0.3, 0.3):
            assert loss([max(0.0, w + step * (k == j)) for k, w in enumerate(weights)], thresholds) > least - 2e-3
    docs = spark.createDataFrame(list(enumerate([*texts, None, "", "vile " * 5000])), "doc_id long, text string")
    got = {r.doc_id: r for r in op2.graded(docs, model).collect()}
    for i, t in enumerate([*texts, None, "", "vile " * 5000]):
        want = tails(op2.features(t, words_of), weights, thresholds)
        assert [got[i].tail_1, got[i].tail_2] == pytest.approx(want, abs=1e-6) and got[i].expected_grade == pytest.approx(sum(want), abs=1e-6) and got[i].kept == (got[i].tail_2 >= 0.5)
