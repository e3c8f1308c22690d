"""Quotation linking: from messages that quote one another to reply-ordered conversations.

Lines are split into quote levels by their leading marks. Runs of one level are passages,
hashed in normal form (lower case, single blanks) as a whole, by paragraphs and by lines, as
replies quote parts. The earliest message that wrote a part itself is found by an equi-join on
the hash, so a text that many wrote has one row to meet.
Parents are followed to the root by doubling steps on stored tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoalloc.llm.common import stored

MARK = re.compile(r"[ \t]*((?:>[ \t]?)+)")
BLANK = re.compile(r"\n(?:[^\S\n]*\n)+")
SAID = re.compile(r"\S.* wrote:[ \t]*$")


def levels(text: str | None) -> list[tuple[int, str]]:
    """Lines with their quote level and without marks; a line that only announces a quote is left out."""
    out = []
    for line in (text or "").split("\n"):
        m = MARK.match(line)
        level = m[1].count(">") if m else 0
        while level and out and out[-1][0] < level and SAID.match(out[-1][1]):
            out.pop()
        out.append((level, line[m.end():] if m else line))
    return out


def passages(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """What the message says itself, and its passages ``(level, text)``: all of its own lines, and every run of one level."""
    lines = levels(text)
    own = "\n".join(x for level, x in lines if level == 0).strip()
    runs = [(level, "\n".join(x for _, x in run)) for level, run in groupby(lines, key=lambda x: x[0])]
    return own, [(0, own), *runs]


def parts(passage: str) -> list[tuple[int, int, str]]:
    """``(kind, paragraph, text)``: the whole (kind 0), its paragraphs (1) and their lines (2), each where it has several."""
    paragraphs = [x for x in BLANK.split(passage) if x.strip()]
    out = [(0, -1, passage), *((1, n, x) for n, x in enumerate(paragraphs) if len(paragraphs) > 1)]
    for n, paragraph in enumerate(paragraphs):
        lines = [x for x in paragraph.split("\n") if x.strip()]
        out += [(2, n, x) for x in lines if len(lines) > 1]
    return out


def normal(passage: str) -> str:
    return " ".join(passage.lower().split())


def mark_of(plain: str) -> str:
    return xxhash.xxh3_128_hexdigest(plain.encode("utf-8", "surrogatepass"))


def marked(found: list[tuple[int, str]]) -> list[dict]:
    """The parts of the passages that are not blank: own ones once by mark, as the greatest kind of part; quoted ones by place."""
    own, quoted = {}, []
    for run, (level, passage) in enumerate(found):
        for kind, paragraph, text in parts(passage):
            if plain := normal(text):
                row = {"level": level, "run": run, "paragraph": paragraph, "kind": kind, "mark": mark_of(plain), "size": len(plain)}
                if level:
                    quoted.append(row)
                elif row["mark"] not in own or kind < own[row["mark"]]["kind"]:
                    own[row["mark"]] = row
    return [*own.values(), *quoted]


PART = [("level", pa.int32()), ("run", pa.int32()), ("paragraph", pa.int32()), ("kind", pa.int32()), ("mark", pa.string()), ("size", pa.int64())]


def parsed(messages: DataFrame) -> DataFrame:
    """``scope, sent, id, own, found``: own text, and ``PART`` of the passages' parts, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [passages(x) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["scope"], batch["sent"], batch["id"], pa.array([x for x, _ in texts], pa.string()),
                                              pa.array([marked(ps) for _, ps in texts], pa.list_(pa.struct(PART)))], ["scope", "sent", "id", "own", "found"])

    return stored(messages.mapInArrow(run, "scope string, sent long, id string, own string, found array<struct<level:int,run:int,paragraph:int,kind:int,mark:string,size:long>>"))


def link(messages: DataFrame, id_col: Column, text_col: Column, sent_col: Column, scope_col: Column | None = None) -> DataFrame:
    """``scope, sent, id, own, parent, level, root, depth`` for every message.

    ``parent`` is the earliest message (by ``sent``, then ``id``) of the same scope that itself
    wrote what this one quotes, and came before it. A quoted run is looked up as a whole, else
    by paragraphs, and a paragraph that is not found by lines; each goes to the first that
    wrote it as a whole text or run, else as a paragraph, else as a line. Of the shallowest
    quoted level that is found, the parent with the greatest length of found text decides, then
    the earliest. ``level`` above 1 says that the messages between are missing. ``root`` is the message at the end of the parents, ``depth`` their
    number; a conversation in reply order is a root's messages by depth, sent and id.
    Null and empty texts say and quote nothing. Messages with a null id keep their own text and
    are linked with nothing; a null scope is a scope, a null time comes before all others.
    Rows that repeat an id give one row, with the earliest time and then the least text.
    Other columns of the table are not read.
    """
    rows = messages.select((scope_col if scope_col is not None else F.lit(None)).cast("string").alias("scope"), F.coalesce(sent_col.cast("long"), F.lit(-(2**63))).alias("sent"), id_col.cast("string").alias("id"), text_col.cast("string").alias("text"))
    named = rows.where("id is not null").groupBy("scope", "id").agg(F.min(F.struct("sent", "text")).alias("row")).select("scope", "row.sent", "id", "row.text")
    nameless = rows.where("id is null")
    texts = parsed(named.select("scope", "sent", "id", "text").unionByName(nameless))
    spans = texts.where("id is not null").select("scope", "sent", "id", F.explode("found").alias("p")).select("scope", "sent", "id", "p.*")
    # the first writer of a text as a whole, as a paragraph and as a line
    written = spans.where("level = 0").groupBy("scope", "mark").agg(*(F.min(F.when(F.col("kind") == k, F.struct("sent", "id"))).alias(f"first{k}") for k in range(3)))
    written = written.select(F.col("scope").alias("in"), F.col("mark").alias("of"), "first0", "first1", "first2")
    quoted = spans.where("level > 0").join(written, F.col("scope").eqNullSafe(F.col("in")) & (F.col("mark") == F.col("of")))
    writer = F.coalesce(*(F.when(F.col(f"first{k}") < F.struct("sent", "id"), F.col(f"first{k}")) for k in range(3)))
    quoted = quoted.select("scope", "id", "level", "run", "paragraph", "kind", "size", writer.alias("first")).where("first is not null")
    # a paragraph counts where its run is not found, a line where its paragraph is not
    of_run = F.min("kind").over(Window.partitionBy("scope", "id", "level", "run"))
    of_paragraph = F.min("kind").over(Window.partitionBy("scope", "id", "level", "run", "paragraph"))
    quoted = quoted.withColumn("of_run", of_run).withColumn("of_paragraph", of_paragraph).where("kind = if(of_run = 0, 0, of_paragraph)")
    sums = quoted.groupBy("scope", "id", "level", "first").agg(F.sum("size").alias("size"))
    best = sums.groupBy("scope", "id").agg(F.min(F.struct("level", (-F.col("size")).alias("minus"), "first")).alias("best"))
    best = best.select(F.col("scope").alias("in"), F.col("id").alias("reply"), F.col("best.first.id").alias("parent"), F.col("best.level").alias("level"))
    found = texts.join(best, F.col("scope").eqNullSafe(F.col("in")) & (F.col("id") == F.col("reply")), "left")
    found = stored(found.select("scope", "sent", "id", "own", "parent", "level"))
    # steps from each reply double in length until they end at a root; those that do rest
    steps = stored(found.where("parent is not null").select("scope", "id", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"), F.lit(True).alias("open")))
    while not steps.where("open").isEmpty():
        further = steps.select(F.col("scope").alias("in"), F.col("id").alias("at"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("open").alias("on"))
        joined = steps.where("open").join(further, F.col("scope").eqNullSafe(F.col("in")) & (F.col("up") == F.col("at")), "left")
        moved = joined.select("scope", "id", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("on", F.lit(False)).alias("open"))
        steps = stored(steps.where("not open").unionByName(moved))
    ends = steps.select(F.col("scope").alias("in"), F.col("id").alias("at"), F.col("up").alias("root"), "depth")
    out = found.join(ends, F.col("scope").eqNullSafe(F.col("in")) & (F.col("id") == F.col("at")), "left")
    sent = F.when(F.col("sent") > -(2**63), F.col("sent"))
    return out.select("scope", sent.alias("sent"), "id", "own", "parent", "level", F.coalesce("root", "id").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, text, role, mark`` of every row; a null text is empty, a null role someone."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit("someone"))
    return conversations.select("conv_id", "turn", text.alias("text"), role.alias("role"), F.sha2(F.concat(role, F.lit("\n"), text), 256).alias("mark"))


def as_mail(conversations: DataFrame, depth: int = 3) -> DataFrame:
    """Turns as messages that quote the turn they answer, and what that one quoted, to some depth.

    Each turn answers the one before; every third turn the one before that. Of four turns one
    quotes the first half of the lines only, and one answers between two parts of the quote.
    Rows that repeat a turn of a conversation are messages of their own, told apart by ``mark``, a
    hash of role and text (equal rows are one message); where such a turn is answered, its least
    text is quoted. Rows without a conversation quote nothing; those without a turn are
    messages without an id, as often as they stand there.
    """
    rows = turns_of(conversations)
    turns = rows.where("turn is not null").distinct()
    mail = turns.unionByName(rows.where("turn is null"))
    quoted = turns.where("conv_id is not null").groupBy("conv_id", "turn").agg(F.min(F.struct("text", "role")).alias("m")).select("conv_id", "turn", "m.*")
    answers = F.col("turn") - F.when(F.col("turn") % 3 == 0, 2).otherwise(1)
    mail = mail.select("conv_id", "turn", "mark", F.col("text").alias("body"), answers.alias("next"))
    told = quoted.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("text").alias("said"), F.col("role").alias("who"), answers.alias("then"))
    for level in range(1, depth + 1):
        marks = "> " * level
        joined = mail.join(told, (F.col("conv_id") == F.col("c")) & (F.col("next") == F.col("t")), "left")
        says, quote = F.concat(F.lit("\n" + "> " * (level - 1)), F.col("who"), F.lit(" wrote:")), lambda text: F.concat(F.lit("\n" + marks), F.regexp_replace(text, "\n", "\n" + marks))
        body = F.concat("body", F.coalesce(F.concat(says, quote(F.col("said"))), F.lit("")))
        if level == 1:
            lines, answer = F.split("said", "\n"), F.split("body", "\n", 2)
            half = F.ceil(F.size(lines) / 2).cast("int")
            head, tail = F.array_join(F.slice(lines, F.lit(1), half), "\n"), F.array_join(F.slice(lines, half + 1, F.size(lines)), "\n")
            both = (F.trim(F.regexp_replace(head, r"\s", "")) != "") & (F.trim(F.regexp_replace(tail, r"\s", "")) != "")
            between = F.concat(says, quote(head), F.lit("\n"), answer[0], quote(tail), F.lit("\n"), F.coalesce(F.get(answer, F.lit(1)), F.lit("")))
            body = F.when(both & (F.col("turn") % 4 == 1), F.concat("body", says, quote(head))).when(both & (F.col("turn") % 4 == 2), between).otherwise(body)
        mail = joined.select("conv_id", "turn", "mark", body.alias("body"), F.col("then").alias("next"))
    return mail.select("conv_id", "turn", "mark", F.col("body").alias("text"))


def op1_quotations(spark, sf_dir: str) -> DataFrame:
    """All turns as mail, linked again by what they quote; the answer lists turns of the conversation, a row for each of the table."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    name = F.concat(F.lpad(F.col("turn").cast("string"), 12, "0"), F.lit("|"), "mark")
    found = link(as_mail(table), name, F.col("text"), F.col("turn"), F.col("conv_id"))
    found = stored(found.withColumnRenamed("id", "name").drop("sent"))
    rows = turns_of(table).where("turn is not null").select(F.col("conv_id").cast("string").alias("of"), name.alias("id"))
    every = rows.join(found, F.col("of").eqNullSafe(F.col("scope")) & (F.col("id") == F.col("name"))).drop("of", "id").unionByName(found.where("name is null"))
    turn = lambda c: F.substring_index(c, "|", 1).cast("long")
    return every.select(F.col("scope").cast("long").alias("conv_id"), turn("name").alias("turn"), turn("parent").alias("parent_turn"),
                        "level", turn("root").alias("root_turn"), "depth", F.col("own").alias("text"))


SQL = """
with recursive rows as (
  select conv_id, turn, coalesce(text, '') as text, coalesce(role, 'someone') as role, turn - case when turn % 3 = 0 then 2 else 1 end as answers from conversations),
turns as (
  select *, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) as plain, sha256(role || chr(10) || text) as mark from rows),
heard as (select conv_id, turn, answers, arg_min(plain, (text, role)) as plain from turns where conv_id is not null and turn is not null group by all),
named as (select distinct conv_id, turn, mark, plain, answers from turns where conv_id is not null and turn is not null),
chain as (  -- what each turn quotes, by level
  select t.conv_id, t.turn, t.mark, 1 as level, q.plain, q.answers from named t join heard q on q.conv_id = t.conv_id and q.turn = t.answers
  union all
  select c.conv_id, c.turn, c.mark, c.level + 1, q.plain, q.answers from chain c join heard q on q.conv_id = c.conv_id and q.turn = c.answers where c.level < 3),
found as (
  select c.conv_id, c.turn, c.mark, c.level, min((w.turn, w.mark)) as parent from chain c join named w on w.conv_id = c.conv_id and w.plain = c.plain and (w.turn, w.mark) < (c.turn, c.mark)
  where c.plain <> '' group by all),
best as (select * from found qualify row_number() over (partition by conv_id, turn, mark order by level) = 1),
climb as (
  select conv_id, turn, mark, (turn, mark) as reached, 0 as depth from named
  union all
  select k.conv_id, k.turn, k.mark, b.parent, k.depth + 1 from climb k join best b on b.conv_id = k.conv_id and (b.turn, b.mark) = k.reached),
top as (select conv_id, turn, mark, arg_max(reached, depth) as root, max(depth) as depth from climb group by all)
select t.conv_id, t.turn, b.parent[1] as parent_turn, b.level, coalesce(p.root[1], t.turn) as root_turn, coalesce(p.depth, 0) as depth, trim(t.text) as text
from turns t left join best b using (conv_id, turn, mark) left join top p using (conv_id, turn, mark)
"""
