"""Licence scan: TF-IDF cosine of lines to licence templates, then inheritance by directory.

Templates are a short fixed list; term weights come from it, and common words have none. A
line can reach the threshold only if it holds one of a template's heaviest terms (what is left of the template is shorter
than the threshold), and if its other words do not outweigh the known ones; only such lines
are exploded. A file has the licence of its
best line. If that is its last line that is not blank, or the file is named as one (LICENSE,
COPYING.txt), the file is a licence file, which speaks for its folder; a file without a licence takes that of the nearest folder above it, found by joining every
folder's ancestors. Besides lines, whole files are compared with full licence texts and blocks (paragraphs
without comment marks) with usual headers; short forms are found inside longer lines.
All of it is native expressions.
"""

from __future__ import annotations

import functools
import math
import operator
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoalloc.llm.common import stored

#: Fixed values: (licence, notice).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "This library is free software under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
)
#: Words without weight.
STOP = "a all and are as at be by for from in is it of on or that the this to under use was with".split()
LEAST = 0.7
TERM = "[a-z0-9]+(?:[-.][a-z0-9]+)*"
#: Names of licence files, whatever their folder; not of code (license.py).
NAMED = "(?i)(?:^|/)(?:[a-z0-9.]+[-_])?(?:un)?(?:licen[cs]es?|copying)(?:[-_.](?:mit|apache|bsd|l?gpl|mpl|cc|lesser|lib)[^/]*?)?(?:[.](?:txt|md|rst|html?))?$"
#: Fixed values: (licence, header block).
_GNU = "{} is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_LICENSED = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
HEADERS = (
    ("AGPL-3.0", _GNU.format("This program", "Affero General Public License", 3)),
    ("Apache-2.0", _LICENSED),
    ("Apache-2.0", _LICENSED + " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"),
    ("GPL-2.0", _GNU.format("This program", "General Public License", 2)),
    ("GPL-3.0", _GNU.format("This program", "General Public License", 3)),
    ("LGPL-2.1", _GNU.format("This library", "Lesser General Public License", 2.1)),
    ("LGPL-3.0", _GNU.format("This library", "Lesser General Public License", 3)),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)
#: Names after "licensed under" and the like, and SPDX identifiers, as patterns of terms without common words.
NAMES = (
    ("AGPL-3.0", "(?:gnu )?(?:affero general public license (?:version |v )?(?:v?3|3.0)|agpl-?v?3(?:.0)?)", "agpl-3.0(?:-only|-or-later)?"),
    ("Apache-2.0", "apache (?:software )?(?:license )?(?:version |v )?(?:v?2|v?2.0)|apache-2.0", "apache-2.0"),
    ("BSD-2-Clause", "(?:2-clause bsd|simplified bsd|bsd 2-clause|bsd-2-clause)", "bsd-2-clause"),
    ("BSD-3-Clause", "(?:3-clause bsd|new bsd|modified bsd|bsd 3-clause|bsd-3-clause)", "bsd-3-clause"),
    ("CC-BY-4.0", "(?:creative commons attribution 4.0|cc 4.0|cc-by 4.0|cc-by-4.0)", "cc-by-4.0"),
    ("CC-BY-NC-4.0", "(?:creative commons attribution-?(?: |-)?noncommercial 4.0|cc by-nc 4.0|cc-by-nc 4.0|cc-by-nc-4.0)", "cc-by-nc-4.0"),
    ("CC0-1.0", "(?:cc0 1.0|cc0-1.0|creative commons zero)", "cc0-1.0"),
    ("GPL-2.0", "(?:gnu )?(?:general public license (?:version |v )?(?:v?2|2.0)|gpl ?(?:version |-)?v?2(?:.0)?)", "gpl-2.0(?:-only|-or-later)?"),
    ("GPL-3.0", "(?:gnu )?(?:general public license (?:version |v )?(?:v?3|3.0)|gpl ?(?:version |-)?v?3(?:.0)?)", "gpl-3.0(?:-only|-or-later)?"),
    ("LGPL-2.1", "(?:gnu )?(?:lesser general public license (?:version |v )?v?2.1|lgpl ?(?:version |-)?v?2.1)", "lgpl-2.1(?:-only|-or-later)?"),
    ("LGPL-3.0", "(?:gnu )?(?:lesser general public license (?:version |v )?(?:v?3|3.0)|lgpl ?(?:version |-)?v?3(?:.0)?)", "lgpl-3.0(?:-only|-or-later)?"),
    ("MIT", "(?:mit licen[sc]e|mit/x11 licen[sc]e|expat licen[sc]e)", "mit"),
    ("MPL-2.0", "(?:mozilla public license (?:version |v )?v?2.0|mpl ?(?:version |-)?v?2.0)", "mpl-2.0"),
)
SAID = "(?:licensed|licenced|released|distributed|available|published|provided|covered|terms) "
CUES = ("licen", "permission", "redistribution", "rights reserved", "spdx-")
COMMENT = r"(?m)^[ \t]*(?:/\*+|\*+/?|//+!?|#+|;+|--+|%+|<!--+|dnl\b|rem\b|\.\.)?[ \t\r]*"
#: Whole texts have much in common, so they must be closer than lines and blocks.
LEAST_TEXT = 0.85


def full_texts() -> tuple[tuple[str, str], ...]:
    """``licence, text`` of the licences kept beside this module."""
    return tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licences").glob("*.txt")))


def terms_of(text: str) -> Counter:
    return Counter(t for t in re.findall(TERM, text.lower()) if t not in STOP)


def template_weights(templates=TEMPLATES) -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """Inverse frequencies of terms among the templates, and each template's vector of length one."""
    terms = {name: terms_of(text) for name, text in templates}
    among = Counter(t for c in terms.values() for t in c)
    idf = {t: math.log((1 + len(terms)) / (1 + n)) + 1 for t, n in among.items()}
    vectors = {}
    for name, counts in terms.items():
        own = {t: n * idf[t] for t, n in counts.items()}
        length = math.sqrt(sum(w * w for w in own.values()))
        vectors[name] = {t: w / length for t, w in own.items()}
    return idf, vectors


def anchors(vectors: dict[str, dict[str, float]], least: float) -> list[str]:
    """Terms of which every line at the threshold holds one: without them no template reaches it.

    Long terms come first, as they are rarer in ordinary text.
    """
    out = set()
    for vector in vectors.values():
        rest = 1.0
        for term, weight in sorted(vector.items(), key=lambda x: (len(x[0]) < 3, -x[1], x[0])):
            if rest < least * least * 0.999:
                break
            out.add(term)
            rest -= weight * weight
    return sorted(out)


def inline(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A short constant table as part of the plan."""
    return spark.range(1).select(F.inline(F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(names, row))) for row in rows))))


def own_licences(files: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``path, licence, score, last``: each path's best line at the threshold, and whether only blank lines follow it.

    Ties go to the earlier line, then to the smaller licence name.
    """
    idf, vectors = template_weights(templates)
    some = functools.reduce(operator.or_, (F.contains("text", F.lit(w)) for w in anchors(vectors, least)))
    spark, unknown = files.sparkSession, math.log(1 + len(templates)) + 1
    terms = F.broadcast(inline(spark, [(t, w) for t, w in idf.items()], "term", "idf"))
    weights = F.broadcast(inline(spark, [(t, n, w) for n, v in vectors.items() for t, w in v.items()], "term", "licence", "weight"))
    texts = files.select("path", F.explode(F.array(F.lower(F.col("text").cast("string")))).alias("text")).where(some)
    key = ["path", "of_text", "line"]  # rows may repeat a path with other texts
    lines = texts.withColumn("lines", F.split(F.rtrim("text", F.lit(" \t\r\n")), "\n")).select("path", F.xxhash64("text").alias("of_text"), F.size("lines").alias("count"), F.posexplode("lines").alias("line", "text")).where(some)
    # exploding a single value keeps it from being worked out again wherever it is used
    split = F.filter(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda t: ~t.isin(STOP))
    lines = lines.select(*key, "count", F.explode(F.array(split)).alias("terms"))
    lines = lines.select("*", F.explode(F.array(F.filter("terms", lambda t: t.isin(list(idf))))).alias("known"))
    # the cosine is at most that of the known part of a line to the whole of it
    weight_of = F.create_map(*(F.lit(x) for pair in idf.items() for x in pair))
    matched = F.aggregate(F.array_distinct("known"), F.lit(0.0), lambda a, t: a + F.pow(F.size(F.filter("known", lambda x: x == t)) * weight_of[t], 2.0))
    others = F.size(F.array_distinct(F.filter("terms", lambda t: ~t.isin(list(idf)))))
    lines = lines.where(others * unknown**2 * least**2 <= matched * (1 - least**2) * 1.001)
    words = stored(lines.select(*key, "count", "terms")).withColumn("term", F.explode("terms"))  # few lines; texts are read once
    counted = words.groupBy(*key, "count", "term").agg(F.count("*").alias("times"))
    weighed = counted.join(terms, "term", "left").withColumn("own", F.col("times") * F.coalesce("idf", F.lit(unknown)))
    lengths = weighed.groupBy(*key, "count").agg(F.sqrt(F.sum(F.col("own") ** 2)).alias("length"))
    products = weighed.join(weights, "term").groupBy(*key, "licence").agg(F.sum(F.col("own") * F.col("weight")).alias("product"))
    scored = products.join(lengths, key).withColumn("score", F.round(F.col("product") / F.col("length"), 6)).where(F.col("score") >= least)
    best = scored.groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("minus"), "line", "licence", "count")).alias("best"))
    return best.select("path", "best.licence", (-F.col("best.minus")).alias("score"), (F.col("best.line") == F.col("best.count") - 1).alias("last"))


def constants(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A longer constant table, as one text in the plan."""
    lines = F.explode(F.split(F.lit("\n".join("\t".join(map(str, row)) for row in rows)), "\n")).alias("row")
    names = [x.strip().split(" ") for x in schema.split(",")]
    return spark.range(1).select(lines).select(*(F.split("row", "\t")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(names)))


def wider_licences(files: DataFrame, least: float = LEAST) -> DataFrame:
    """``path, rank, licence, score``: what whole texts, blocks and short forms say of a path.

    ``rank`` 0 is a full licence text, 1 a header block or an SPDX identifier, 3 a short form
    inside a line, 4 reserved rights inside one; 2 is left to whole lines. Lowest rank first,
    then the best score, the earlier block and the smaller licence name.
    """
    spark = files.sparkSession
    kept = [(0, n, t) for n, t in full_texts()] + [(1, n, t) for n, t in HEADERS]
    idf, vectors = template_weights([(i, t) for i, (_, _, t) in enumerate(kept)])
    unknown = math.log(1 + len(kept)) + 1
    terms = F.broadcast(constants(spark, list(idf.items()), "term string, idf double"))
    weights = F.broadcast(constants(spark, [(t, *kept[i][:2], i, w) for i, v in vectors.items() for t, w in v.items()], "of string, kind int, licence string, template int, weight double"))
    cued = functools.reduce(operator.or_, (F.contains("text", F.lit(c)) for c in CUES))
    texts = files.where("path is not null").select("path", F.explode(F.array(F.lower(F.col("text").cast("string")))).alias("text")).where(cued)
    texts = texts.select("path", F.xxhash64("text").alias("of_text"), F.explode(F.array(F.regexp_replace("text", F.lit(COMMENT), F.lit("")))).alias("text"))
    blocks = F.transform(F.split("text", "\n\\s*\n"), lambda x, i: F.struct((i + 1).alias("block"), x.alias("text")))
    units = texts.select("path", "of_text", F.explode(F.concat(F.array(F.struct(F.lit(0).alias("block"), F.col("text"))), blocks)).alias("unit")).select("path", "of_text", "unit.*").where(cued)
    split = F.filter(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda t: ~t.isin(STOP))
    units = stored(units.select("path", "of_text", "block", F.explode(F.array(split)).alias("terms")))
    key = ["path", "of_text", "block"]
    counted = units.select(*key, F.explode("terms").alias("term")).groupBy(*key, "term").agg(F.count("*").alias("times"))
    weighed = stored(counted.join(terms, "term", "left").select(*key, "term", (F.col("times") * F.coalesce("idf", F.lit(unknown))).alias("own")))
    lengths = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("own") ** 2)).alias("length"))
    met = weighed.join(weights, (F.col("term") == F.col("of")) & ((F.col("kind") == 0) == (F.col("block") == 0)))
    products = met.groupBy(*key, "kind", "licence", "template").agg(F.sum(F.col("own") * F.col("weight")).alias("product"))
    scored = products.join(lengths, key).select("path", F.col("kind").alias("rank"), F.round(F.col("product") / F.col("length"), 6).alias("score"), "block", "licence")
    scored = scored.where((F.col("score") >= least) & ((F.col("rank") > 0) | (F.col("score") >= LEAST_TEXT)))
    said = [(rank, licence, pattern) for licence, name, spdx in NAMES for rank, pattern in ((1, f" spdx-license-identifier (?:{spdx}) "), (3, f" {SAID}(?:{name}) "))]
    said += [(4, "proprietary", " rights reserved ")]
    forms = F.array(*(F.when(F.rlike("all", F.lit(pattern.replace(".", "[.]"))), F.struct(F.lit(rank).alias("rank"), F.lit(licence).alias("licence"))) for rank, licence, pattern in said))
    short = units.where("block > 0").select("path", "block", F.explode(F.array(F.concat(F.lit(" "), F.array_join("terms", " "), F.lit(" ")))).alias("all"))
    short = short.select("path", "block", F.explode(F.array_compact(forms)).alias("form")).select("path", "form.rank", F.lit(1.0).alias("score"), "block", "form.licence")
    best = scored.unionByName(short).groupBy("path").agg(F.min(F.struct("rank", (-F.col("score")).alias("minus"), "block", "licence")).alias("best"))
    return best.select("path", "best.rank", "best.licence", (-F.col("best.minus")).alias("score"))


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``path, licence, score, how, source_path`` for every row of ``files`` (``path, text``).

    ``how`` is own, inherited or null. Among a folder's licence files those named as such come
    first, then the best score, then the smaller path. Null and empty texts have no licence of their own; a null path has
    no folder and takes none. Rows that repeat a path are judged together: the best line of
    any. The root folder is the empty path. Other columns are not read.
    A full licence text decides before header blocks and SPDX identifiers, these before whole
    lines, and short forms inside lines come last; a full text speaks for its folder.
    """
    lines = own_licences(files, templates, least).select("path", F.lit(2).alias("rank"), "licence", "score", "last")
    found = lines.unionByName(wider_licences(files, least).withColumn("last", F.col("rank") == 0))
    own = found.groupBy("path").agg(F.min(F.struct("rank", "licence", "score")).alias("best"), F.max("last").alias("last"))
    own = stored(own.select("path", "best.licence", "best.score", "last"))
    paths = files.select("path").withColumn("folder", folder_of(F.col("path")))
    speakers = own.withColumn("named", F.rlike("path", F.lit(NAMED))).where("last or named").withColumn("folder", folder_of(F.col("path")))
    speakers = speakers.groupBy("folder").agg(F.min(F.struct(~F.col("named"), (-F.col("score")).alias("minus"), "path", "licence")).alias("best"))
    speakers = speakers.select(F.col("folder").alias("above"), F.col("best.licence").alias("given"), F.col("best.path").alias("giver"))
    folders = paths.where("folder is not null").select("folder").distinct()
    steps = F.split("folder", "/")
    chain = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/")))
    above = folders.select("folder", F.explode(F.array_distinct(chain)).alias("above")).join(speakers, "above")
    nearest = above.groupBy("folder").agg(F.max(F.struct(F.length("above").alias("depth"), "given", "giver")).alias("best")).select("folder", "best.given", "best.giver")
    rows = paths.join(own.drop("last"), "path", "left").join(nearest, "folder", "left")
    how = F.when(F.col("licence").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited")
    return rows.select("path", F.coalesce("licence", "given").alias("licence"), "score", how.alias("how"), F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("giver")).alias("source_path"))


def tree(docs: DataFrame) -> DataFrame:
    """Documents as files: ``source/lang/hundreds/id``; those of over 2,000 characters that end in a notice one folder higher."""
    folder = F.concat_ws("/", "source", "lang", F.when(~((F.length("text") > 2000) & F.rlike(F.substring_index("text", "\n", -1), F.lit("(?i)licen[sc]e|rights reserved"))) | F.col("text").isNull(), F.floor(F.col("doc_id") / 100).cast("string")))
    return docs.select("doc_id", F.concat_ws("/", folder, F.col("doc_id").cast("string")).alias("path"), "text")


def op3_licences(spark, sf_dir: str) -> DataFrame:
    """The licence of every document, its own or inherited in a tree of sources and languages."""
    files = tree(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scan(files.select("path", "text")).withColumn("doc_id", F.element_at(F.split("path", "/"), -1).cast("long"))


_STOP = ", ".join(f"'{t}'" for t in STOP)
_VALUES = ", ".join("('{}', '{}')".format(*x) for x in TEMPLATES)
SQL = f"""
with recursive templates(licence, notice) as (values {_VALUES}),
template_terms as (
  select licence, term, count(*) as times from (select licence, unnest(regexp_extract_all(lower(notice), '{TERM}')) as term from templates) where term not in ({_STOP}) group by all),
idf as (select term, ln((1.0 + (select count(*) from templates)) / (1 + count(*))) + 1 as idf from template_terms group by term),
raw as (select licence, term, times * idf as w from template_terms join idf using (term)),
weights as (select licence, term, w / sqrt(sum(w * w) over (partition by licence)) as weight from raw),
files as (
  select doc_id, text, source || '/' || lang || case when length(text) > 2000 and regexp_matches(regexp_extract(text, '[^\\n]*$'), '(?i)licen[sc]e|rights reserved')
    then '' else '/' || (doc_id // 100) end as folder from documents),
lines as (
  select doc_id, len(ls) as n, generate_subscripts(ls, 1) as line, unnest(ls) as line_text
  from (select doc_id, string_split(lower(text), chr(10)) as ls from files)
  where len(list_filter(ls, lambda x: regexp_matches(x, 'licen|rights|redistribution|released|subject|permitted'))) > 0),
terms as (select doc_id, n, line, term, count(*) as times from (select doc_id, n, line, unnest(regexp_extract_all(line_text, '{TERM}')) as term from lines) where term not in ({_STOP}) group by all),
weighed as (select terms.*, times * coalesce(idf, ln(1.0 + (select count(*) from templates)) + 1) as own from terms left join idf using (term)),
lengths as (select doc_id, line, n, sqrt(sum(own * own)) as length from weighed group by all),
scored as (
  select doc_id, line, n, licence, round(sum(own * weight) / any_value(length), 6) as score
  from weighed join weights using (term) join lengths using (doc_id, line, n) group by doc_id, line, n, licence),
own as (
  select doc_id, licence, score, line = n as speaks from scored where score >= {LEAST}
  qualify row_number() over (partition by doc_id order by score desc, line, licence) = 1),
speakers as (
  select folder, licence, folder || '/' || doc_id as path from own join files using (doc_id) where speaks
  qualify row_number() over (partition by folder order by score desc, path) = 1),
nearest as (
  select f.folder, s.licence, s.path from (select distinct folder from files) f join speakers s on f.folder = s.folder or starts_with(f.folder, s.folder || '/')
  qualify row_number() over (partition by f.folder order by length(s.folder) desc) = 1)
select f.doc_id, f.folder || '/' || f.doc_id as path, coalesce(o.licence, n.licence) as licence, o.score,
  case when o.licence is not null then 'own' when n.licence is not null then 'inherited' end as how,
  case when o.licence is not null then f.folder || '/' || f.doc_id else n.path end as source_path
from files f left join own o using (doc_id) left join nearest n on n.folder = f.folder
"""
