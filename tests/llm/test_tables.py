"""Operators on mail, files, URLs and vectors, the queries beside their SQL, and the pipeline."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from geoalloc.llm import op1_quotations as op1
from geoalloc.llm import op3_licences as op3
from geoalloc.llm import op5_url_filter as op5
from geoalloc.llm import op8_product_quantisation as op8
from geoalloc.llm.op6_packing import ChunkIds, TOKENIZER
from geoalloc.llm.queries import ORACLE, QUERIES
from tests.compare import differences

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, con, name):
    diff, _ = differences(spark, con, SF_DIR, QUERIES[name], ORACLE[name])
    assert diff is None, diff


def test_all_are_registered():
    names = entry_point.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# quotations

MAIL = [
    ("a", 1, "Hello all,\nhow do we start?"),
    ("b", 2, "Like this.\n\na wrote:\n> hello   ALL,\n> how do we start?"),
    ("c", 3, "> Like this.\nNo, like that.\n>> Hello all,\n>> how do we start?\nBye"),
    ("d", 4, "lost parent\n> something nobody said\n> > No, like that.\n"),
    ("e", 5, "> No, like that.\n> Bye\nin two parts\n"),
    ("f", 6, None),
    ("g", 7, ""),
    ("h", 8, ">\n> \n>> \nquotes blanks"),
    ("i", 9, "Hello all,\nhow do we start?"),
    ("j", 10, "> Hello all,\n> how do we start?\nanswer to the first of two"),
    ("k", 0, "> answer to the first of two\nbefore it was written"),
    (None, 11, "> Like this.\nno id"),
]


def test_quotations(spark):
    rows = spark.createDataFrame([(i, t, x, 1) for i, t, x in [*MAIL, MAIL[1]]], "name string, at long, body string, level int").withColumn("found", F.lit(1))
    got = op1.link(rows, F.col("name"), F.col("body"), F.col("at")).collect()
    assert len(got) == len(MAIL)
    found = {r.id: (r.parent, r.level, r.root, r.depth) for r in got}
    assert found["a"] == (None, None, "a", 0)
    assert found["b"] == ("a", 1, "a", 1)
    assert found["c"] == ("b", 1, "a", 2)
    assert found["e"] == ("c", 1, "a", 3)
    assert found["j"] == ("a", 1, "a", 1)
    assert found["f"] == (None, None, "f", 0) and found["g"] == (None, None, "g", 0) and found["h"] == (None, None, "h", 0)
    assert found["k"] == (None, None, "k", 0) and found[None] == (None, None, None, 0)
    own = {r.id: r.own for r in got}
    assert own["b"] == "Like this." and own["c"] == "No, like that.\nBye" and own["f"] == "" and own["h"] == "quotes blanks"


def test_missing_messages_are_bridged(spark):
    rows = spark.createDataFrame([("a", 1, "first"), ("c", 3, "third\n> never sent\n>> first")], "name string, at long, body string")
    got = {r.id: r for r in op1.link(rows, F.col("name"), F.col("body"), F.col("at")).collect()}
    assert (got["c"].parent, got["c"].level, got["c"].root) == ("a", 2, "a")
    none = rows.where("false")
    assert op1.link(none, F.col("name"), F.col("body"), F.col("at")).count() == 0


def test_long_threads_and_scopes(spark):
    rows = [(s, f"{n:03}", n, f"{s} message {n}" + (f"\n> {s} message {n - 1}" if n else "")) for s in ("x", "y") for n in range(40)]
    frame = spark.createDataFrame(rows, "list string, name string, at long, body string")
    got = op1.link(frame, F.col("name"), F.col("body"), F.col("at"), F.col("list")).collect()
    assert {(r.scope, r.id, r.root, r.depth) for r in got} == {(s, name, "000", n) for s, name, n, _ in rows}


def test_quotes_of_parts_are_linked(spark):
    letter = "Dear all,\n\nfirst point,\nin two lines\n\nsecond point\nRegards\nA"
    rows = [
        ("a", 1, letter), ("b", 2, "> second point\nyes"), ("c", 3, "> first point, in\n> two lines\nno\n\n> second point\nyes again"),
        ("d", 4, "> Dear all,\n>\n> yes again\n> in two lines\nmixed"), ("e", 5, "> No, like that.\n> no\nlost otherwise"),
        ("f", 6, "> second point\n> Regards\nthanks"), ("g", 7, "second point"), ("h", 8, "> second point\nof g, who wrote nothing else"),
        ("i", 9, "nothing\n> unknown\n>> second point"),
    ]
    frame = spark.createDataFrame(rows, "name string, at long, body string")
    got = {r.id: (r.parent, r.level, r.root) for r in op1.link(frame, F.col("name"), F.col("body"), F.col("at")).collect()}
    assert got["b"] == ("a", 1, "a") == got["c"] == got["f"]
    assert got["d"] == ("a", 1, "a")  # a's lines outweigh c's
    assert got["e"] == ("c", 1, "a") and got["h"] == ("g", 1, "g") and got["i"] == ("g", 2, "g")
    mail = op1.link(spark.createDataFrame(MAIL, "name string, at long, body string"), F.col("name"), F.col("body"), F.col("at"))
    assert [(r.parent, r.level, r.root, r.depth) for r in mail.where("id = 'e'").collect()] == [("c", 1, "a", 3)]


def test_mail_quotes_parts(spark):
    turns = [(1, n, "user", f"a{n}\nb{n}\n\nc{n}\nd{n}") for n in range(7)]
    mail = op1.as_mail(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    texts = {r.turn: r.text for r in mail.collect()}
    assert texts[1] == "a1\nb1\n\nc1\nd1\nuser wrote:\n> a0\n> b0\n> "
    assert texts[2].startswith("\nuser wrote:\n> a1\n> b1\n> \na2\n> c1\n> d1\nb2\n\nc2\nd2\n> user wrote:\n> > a0")
    got = {r.id: (r.parent, r.own) for r in op1.link(mail, F.col("turn"), F.col("text"), F.col("turn"), F.col("conv_id")).collect()}
    assert got == {str(n): (None if n == 0 else str(n - (2 if n % 3 == 0 else 1)), turns[n][3]) for n in range(7)}


def test_every_turn_is_in_the_answer(spark, tmp_path):
    import duckdb

    from tests.compare import plain

    rows = [(c, t, r, f"text {c} {t}") for c in (1, 2) for t in range(6) for r in ("user",)]
    rows += [(1, 3, "user", "another third"), (1, 3, "user", "another third"), (1, 4, "model", "text 1 4"), (2, 0, None, None), (2, 0, None, None), (2, 2, "user", "text 2 0"), (2, 5, "user", ""),
             (None, 3, "user", "nowhere"), (None, 3, "user", "nowhere"), (1, None, "user", "no turn"), (1, None, "user", "no turn"), (None, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("id", "mark", "name", "scope", "sent")}).write.parquet(str(tmp_path / "conversations.parquet"))
    got = op1.op1_quotations(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(op1.SQL)
    assert sorted(got.columns) == sorted(want.columns) and got.count() == len(rows)
    columns = sorted(got.columns)
    mine = sorted(tuple(plain(r[c]) or "" for c in columns) for r in got.collect())
    theirs = sorted(tuple(plain(v) or "" for v in r) for r in want.select(*columns).fetchall())
    # a message without a turn has no root
    theirs = sorted(r if r[columns.index("turn")] else tuple("" if c == "root_turn" else v for c, v in zip(columns, r)) for r in theirs)
    assert mine == theirs


# licences

def test_rows_of_one_path(spark):
    rows = [("a", "Released under the MIT License."), ("a", "Licensed under CC BY-NC 4.0."), ("a", "All rights reserved."), ("b", "Released under the MIT License."), ("b", "words\nReleased under the MIT License."),
            ("c", "Released under the MIT License."), ("c", "Released under the MIT License.")]
    got = {r.path: (r.licence, r.score) for r in op3.own_licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["b"] == got["c"] == ("MIT", 1.0) and got["a"][1] == 1.0
    assert op3.scan(spark.createDataFrame(rows, "path string, text string")).where("licence is null").count() == 0


def test_licences(spark):
    files = [
        ("LICENSE", "words\nReleased under the MIT License."),
        ("a/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/c/own.py", "Licensed under CC BY-NC 4.0.\ncode"),
        ("a/b/c/takes.py", "code"), ("ab/takes.py", ""), ("a/none.py", None), ("top.py", "mit license of another kind, which goes on and on with words"),
        (None, "All rights reserved."), ("a/none.py", None),
        ("z/LICENSE", "ALL RIGHTS\tRESERVED"), ("z/y/x.py", "x" * 100_000), ("z/two.py", "Released under the MIT License.\nAll rights reserved."),
    ]
    frame = spark.createDataFrame(files, "path string, text string").withColumns({c: F.lit(0) for c in ("line", "term", "folder", "score", "licence")})
    got = op3.scan(frame).collect()
    assert len(got) == len(files)
    found = {r.path: (r.licence, r.how, r.source_path) for r in got}
    assert found["LICENSE"] == ("MIT", "own", "LICENSE") and found["a/LICENSE"][0] == "GPL-3.0"
    assert found["a/b/c/own.py"] == ("CC-BY-NC-4.0", "own", "a/b/c/own.py")
    assert found["a/b/c/takes.py"] == ("GPL-3.0", "inherited", "a/LICENSE") == found["a/none.py"]
    assert found["ab/takes.py"] == ("MIT", "inherited", "LICENSE") == found["top.py"]
    assert found["z/y/x.py"] == ("proprietary", "inherited", "z/LICENSE") and found["z/two.py"][0] == "MIT"
    assert found[None][1] != "inherited"
    assert op3.scan(frame.where("false")).count() == 0


def test_licence_files_end_and_begin_as_they_like(spark):
    files = [
        ("ends/LICENSE.txt", "Released under the MIT License.\n"), ("ends/x.py", "code"),
        ("blank/notes", "words\nReleased under the MIT License.\n \r\n\n"), ("blank/x.py", "code"),
        ("head/COPYING", "MIT License\n\nCopyright 2024 Example\n\nwords that go on"), ("head/x.py", "code"), ("head/z.py", "code\nLicensed under CC BY-NC 4.0."),
        ("code/license.py", "Released under the MIT License.\ncode"), ("code/x.py", "code"),
    ]
    found = {r.path: (r.licence, r.how, r.source_path) for r in op3.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert found["ends/x.py"] == ("MIT", "inherited", "ends/LICENSE.txt")
    assert found["blank/x.py"] == ("MIT", "inherited", "blank/notes")
    assert found["head/x.py"] == ("MIT", "inherited", "head/COPYING") and found["head/z.py"][0] == "CC-BY-NC-4.0"
    assert found["code/x.py"] == (None, None, None)


def test_other_wordings_of_licences(spark):
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n#\n"
    texts = dict(op3.full_texts())
    files = {
        "a1": ("Licensed under the MIT License.", "MIT"), "a2": ("Copyright 2024 Example Inc. All rights reserved.", "proprietary"),
        "a3": ("// SPDX-License-Identifier: MIT\ncode", "MIT"), "a4": ("# Copyright 2024 Someone\n#\n" + gpl + "import os\n", "GPL-3.0"),
        "a5": (gpl.replace("version 3", "version 2").replace("#", " *"), "GPL-2.0"), "a6": ("x = 1  # SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"),
        "a7": ("/*\n * Copyright 2020 X\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance with the License.\n */\ncode", "Apache-2.0"),
        "a8": ("much said before and released under the MIT License. Many words follow it", "MIT"),
        "a9": ("the license of mit has rights that nobody reserved", None), "b1": ("words " * 50, None),
        "b2": ("Permission is hereby granted, free of charge, " + texts["MIT"].split("free of charge, ")[1].split("\n\n")[0], "MIT"),
    }
    files |= {f"t{i}/x/{name}": (f"Copyright 2024 Some Body\n\n{text}\n", name) for i, (name, text) in enumerate(texts.items())}
    files |= {f"t{i}/y/code": ("code", None) for i in range(len(texts))} | {f"t{i}/x/code": ("code", name) for i, name in enumerate(texts)}
    got = op3.scan(spark.createDataFrame([(p, t) for p, (t, _) in files.items()], "path string, text string")).collect()
    assert {r.path: r.licence for r in got} == {p: n for p, (_, n) in files.items()}


def test_anchors_lose_no_line(spark):
    idf, vectors = op3.template_weights()
    some = set(op3.anchors(vectors, op3.LEAST))
    for vector in vectors.values():
        assert sum(w * w for t, w in vector.items() if t not in some) < op3.LEAST**2
    lines = [(str(i), text) for i, (_, text) in enumerate(op3.TEMPLATES)]
    got = {r.path: (r.licence, r.score) for r in op3.own_licences(spark.createDataFrame(lines, "path string, text string")).collect()}
    assert got == {str(i): (name, 1.0) for i, (name, _) in enumerate(op3.TEMPLATES)}


# URLs

URLS = [
    ("http://Sub.Example.COM/en/a?x", "sub.example.com", "/en/a", "example.com/en/", "block"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://m.www.example.com/en/x#y", "m.www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("x://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    ("http://a.net/esp/1", "a.net", "/esp/1", None, "allow"),
    ("http://example.com?q=/en/", "example.com", "", None, "allow"),
    ("http://ÉA.org/A%20b\nc", "Éa.org", "/A%20b\nc", None, "allow"),
    ("http://listed.org/x/", "listed.org", "/x/", None, "block"),
    ("https://www.listed.org/x?again", "www.listed.org", "/x", None, "block"),
    ("http://a://b/c", "a:", "//b/c", None, "allow"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("://", "", "", None, "allow"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] + [(None, URLS[8][0]), (8, URLS[8][0])], "page_id long, url string")
    pages = pages.withColumns({c: F.lit(1) for c in ("key", "block", "word", "may", "listed", "host")})
    listed = spark.createDataFrame([("http://listed.org/x",), ("https://LISTED.org/x//",), (None,), ("none",), ("http://example.com/en/z",)], "url string")
    got = op5.judge(pages, listed).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        want = URLS[8 if r.page_id is None else r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == want[1:]
    assert {r.verdict for r in op5.judge(pages, listed.where("false")).collect() if r.rule is None} == {"allow"}
    assert op5.judge(pages.where("false"), listed).count() == 0


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    pages = spark.range(4000).selectExpr("id as page_id", "concat('http://h', id, '.org/', id) as url")
    monkeypatch.setattr(op5, "MOST_BLOCKS", 4)
    got = op5.judge(pages, pages.where("page_id < 900")).where("listed")
    assert got.count() == 900 and got.agg(F.max("page_id")).first()[0] == 899


# vectors

def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24))
    rows = []
    for i in range(1500):
        v = centres[rng.integers(40)] + rng.normal(size=24) * rng.choice([0.05, 0.3, 1.0])
        rows.append((i * 2, v.tolist(), int(rng.integers(3))))
    rows += [(5000 + i, rows[0][1], rows[0][2]) for i in range(300)]
    rows += [(7001, None, 1), (7003, [], 1), (7005, [0.0] * 24, 1), (7007, [float("nan")] * 24, 1), (7009, [None, *[1.0] * 23], 1), (7011, [float("inf"), *[1.0] * 23], 1),
             (7013, rows[0][1], None), (7015, [1.0, 2.0], 1), (7017, [2.0, 4.1], 1), (7019, [1e300] * 24, 1), (7021, [1e-300] * 24, 1), (None, rows[0][1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(0) for c in ("id", "v", "unit", "list", "copies")})
    got = op8.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    good = {i: (np.array(v, float), label) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {i: (v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()), label) for i, (v, label) in good.items()}
    ids, near = sorted(unit), {i: [] for i, *_ in rows if i is not None}
    for label in {x for _, x in unit.values()}:
        for width in (2, 24):
            own = [i for i in ids if unit[i][1] == label and len(unit[i][0]) == width]
            x = np.array([unit[i][0] for i in own]).reshape(len(own), width)
            for a, b in zip(*np.nonzero(x @ x.T >= 0.93)):
                if a != b:
                    near[own[a]].append(own[b])
    found = sum(r.n_links for r in got if r.vec_id is not None)
    true = sum(map(len, near.values()))
    assert 0.98 * true <= found <= true  # recall of the lists; nothing below the threshold is linked
    for r in got:
        if r.vec_id is not None:
            assert r.n_links <= len(near[r.vec_id]) and r.kept == (r.vec_id == r.component_id) and (near[r.vec_id] or r.n_links == 0)
    assert {r.vec_id: r.n_links for r in got}[7015] == 1 and {r.vec_id: r.n_links for r in got}[7019] == 1


def test_an_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.01, 1.0, 0.0]), (4, [0.0, 1.0, 0.01]), (9, [0.0, 0.0, 1.0]), (4, None), (0, [0.0, 0.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in op8.near_duplicates(frame).collect())
    assert got == [(0, 1, 0, True), (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 0, 1, False), (4, 2, 1, False), (9, 1, 0, False)]


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert op8.near_duplicates(none).count() == 0
    one = op8.near_duplicates(spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")).first()
    assert tuple(one) == (1, 0, 1, True)


# pipeline

def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF_DIR).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert seen[-1].columns == docs.columns
    graded, single, mixed, packed = seen[1:]
    assert 0 < single.count() <= graded.count() < docs.count() and mixed.count() == single.count()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    clean = labels.where("quality = 1 and toxic = 0").join(docs, "doc_id")
    assert clean.join(graded, "doc_id", "left_anti").count() <= 0.05 * clean.count()
    ids, texts = ChunkIds(TOKENIZER, "<u4"), {r.doc_id: r.text for r in mixed.collect()}
    end = np.array([2], "<u4").tobytes()
    pieces = {}
    for r in packed.orderBy("sequence_id", "offset").collect():
        assert zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + r.ids
    assert pieces == {i: ids.of(t) + end for i, t in texts.items()}
    order = [r.doc_id for r in mixed.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()]
    assert list(pieces) == order
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_crowds_are_dealt_on_both_sides(spark, monkeypatch):
    monkeypatch.setattr(op8, "BLOCK", 64)
    monkeypatch.setattr(op8, "ASKERS", 64, raising=False)
    sizes, deal = [], op8.dealt

    def seen(placed):
        work = deal(placed)
        sizes.extend(work.groupBy("label", "list", "part", "ask_part", "asks").count().select("count").toPandas()["count"])
        return work

    monkeypatch.setattr(op8, "dealt", seen)
    x = np.random.default_rng(3).normal(size=16) + np.random.default_rng(4).normal(size=(400, 16)) * 0.01
    rows = spark.createDataFrame([(i, "a", v.tolist()) for i, v in enumerate(x)], "vec_id long, label string, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op8.near_duplicates(rows).collect()}
    assert got == {i: (399, 0, i == 0) for i in range(400)}
    assert len(sizes) > 20 and max(sizes) < 128
