"""Concatenate and cut: all documents as one stream of ids, cut into windows of fixed length.

Two passes. The first turns every document into ids and notes, inside its task, how many ids
came before it there; the table is stored. Prefix sums over the tasks' totals (one small row
for each task) then give every document its place in the whole stream, and the second pass
cuts the stored ids at the multiples of the window. No ids are shuffled, and only the last
window of all can be short.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoalloc.llm.common import stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BATCH = 1024
LONGEST = 100  # characters of a chunk that is remembered
PROBES = ("a b\nc", "The end, thoner$$$ Erheit\u00e4t. 10 x!", "\u00c9\u00ealle l'eau  cci\u00f3n", "zzqvx", "a",
          "don't. \u00e9\u00e9! x" + "x".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalpha()))
#: an ASCII sign or digit after a letter below U+0180; dotted capital I is none, as its dot comes off when it is lower-cased
WORD_END = re.compile("[!-@\\[-`{-~](?<=[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f].)")
UNSURE = re.compile("[\u0130\u0180-\U0010ffff]")  # other characters are composed, and lower-cased one by one


class ChunkIds(dict):
    """Little-endian ids of texts, from those of their chunks, remembered up to a bounded number.

    Some tokenizers drop white space and never join text across it, so a text has the ids of
    its chunks. Chunks are split at blanks and line feeds alone; other white space stays
    inside a chunk, where the tokenizer itself sees it. Others get whole texts. Which kind a
    tokenizer is, and whether its model may be asked for plain words directly, is probed; if it
    may, words are also split from the signs after them, and texts of ASCII and Latin letters are lower-cased first.
    When half of ``most`` chunks are new, older ones go unless they were met again meanwhile.
    """

    def __init__(self, path: str, kind: str, most: int = 600_000, names_are_text: bool = False):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer, self.kind, self.most, self.old = Tokenizer.from_file(path), kind, most, {}
        self.tokenizer.encode_special_tokens = names_are_text
        by_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.ask, self.letters = self.tokenizer.model.tokenize, {c: by_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x180)}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.names = [x.content.lower() for x in added]
        whole = [self.encoded(x) for x in PROBES]
        self.plain = False
        self.chunks = whole == [b"".join(map(self.encoded, x.replace("\n", " ").split(" "))) for x in PROBES]
        words = [w for x in PROBES for w in x.lower().split() if is_plain(w)]
        self.plain = self.chunks and not any(x.normalized for x in added) and [*map(self.encoded, words)] == [*map(self.modelled, words)]
        self.plain = self.plain and whole == [*map(self.of, PROBES)]
        self.clear()

    def encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def modelled(self, word: str) -> bytes:
        ids = [x.id for x in self.ask(word if word.isascii() else word.translate(self.letters))]
        return struct.pack(f"<{len(ids)}{'H' if self.kind == '<u2' else 'I'}", *ids)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            low = chunk.lower()
            ids = self.modelled(low) if self.plain and is_plain(low) else self.encoded(chunk)
        if len(chunk) <= LONGEST:
            if 2 * len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def parted(self, text: str) -> str:
        """A blank before each sign after a letter; names of added tokens, in any case, must stay as they are."""
        low = text.lower()
        if any(name in low for name in self.names):
            return text
        return WORD_END.sub(r" \g<0>", low if text.isascii() or not UNSURE.search(text) else text)

    def of(self, text: str | None) -> bytes:
        if not self.chunks:
            return self.encoded(text or "")
        text = self.parted(text or "") if self.plain else text or ""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=1)
def known(path: str, kind: str, names_are_text: bool, changed: int) -> ChunkIds:
    return ChunkIds(path, kind, names_are_text=names_are_text)


def chunk_ids(path: str, kind: str, names_are_text: bool = False) -> ChunkIds:
    """The ids that this process remembers, from one task to the next."""
    return known(path, kind, names_are_text, os.stat(path).st_mtime_ns)


def is_plain(low: str) -> bool:
    """Lower-case letters below U+0180 in composed form, which any normaliser leaves alone."""
    return low.isalpha() and (low.isascii() or max(low) < "\u0180" and unicodedata.is_normalized("NFC", low) and low.lower() == low)


def token_table(docs: DataFrame, keys: list[str], tokenizer: str = TOKENIZER, end_id: int = 2, order: tuple[str, str] | None = None) -> DataFrame:
    """``keys..., part, part_start, before, tokens, ids``: every document's ids, stored.

    ``ids`` are little-endian, of two bytes each where the vocabulary allows and else four,
    the end id last. ``before`` counts ids ahead in the same run of rows ``(part, part_start)``.
    ``order`` names a text and a long column that order the stream (rows of each text value
    numbered one by one, such as file and row number); else rows follow their tasks.
    A null text is empty: the end id alone. Rows with equal ids of any kind are kept apart.
    """
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    place = list(order or ())
    part = docs.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col("text").cast("string").alias("text"), *(F.col(c).alias(n) for c, n in zip(place, ("file", "row"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = chunk_ids(tokenizer, kind), np.array([end_id], kind).tobytes()
        name, start, following, before = f"{TaskContext.get().partitionId():012d}", 0, None, 0
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                own = [ids.of(x) + end for x in batch["text"].to_pylist()]
                lengths = [len(x) // int(kind[-1]) for x in own]
                names, starts, befores = [], [], []
                places = zip(batch["file"].to_pylist(), batch["row"].to_pylist()) if order else [(name, None)] * len(own)
                for (file, row), n in zip(places, lengths):
                    if order and (file, row) != (name, following):
                        name, start, before = file, row, 0
                    following = row + 1 if order else None
                    names.append(name), starts.append(start), befores.append(before)
                    before += n
                columns = {f"k{i}": batch[f"k{i}"] for i in range(len(keys))} | {
                    "part": pa.array(names, pa.string()), "part_start": pa.array(starts, pa.int64()), "before": pa.array(befores, pa.int64()),
                    "tokens": pa.array(lengths, pa.int64()), "ids": pa.array(own, pa.binary())}
                yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join([f"k{i} {part.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys))] + ["part string, part_start long, before long, tokens long, ids binary"])
    table = stored(part.mapInArrow(run, schema))
    return table.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


def with_offsets(table: DataFrame) -> DataFrame:
    """Adds ``stream_start``: ids of the whole stream before each document."""
    totals = table.groupBy("part", "part_start").agg(F.max(F.col("before") + F.col("tokens")).alias("total"))
    ahead = Window.orderBy("part", "part_start").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    totals = totals.select("part", "part_start", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    if totals.count() <= 100_000:  # some tens of bytes each
        totals = F.broadcast(totals)
    return table.join(totals, ["part", "part_start"]).withColumn("stream_start", F.col("base") + F.col("before")).drop("base")


def pack(docs: DataFrame, keys: list[str], window: int = 4096, tokenizer: str = TOKENIZER, end_id: int = 2,
         order: tuple[str, str] | None = None, whole_ids: bool = True) -> DataFrame:
    """Boundary records: a row for each piece of a document inside one sequence.

    ``keys..., start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]``. Every id
    lies in exactly one piece; sequences are full but the last one, whose padding is
    ``window`` less its ids (none if these are a power of two). Null and empty texts are
    one piece of the end id. An empty table gives no rows. Other columns play no part,
    whatever their names; repeated rows each get their own place.
    """
    table = with_offsets(token_table(docs, keys, tokenizer, end_id, order))
    inner = table.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), "tokens", "stream_start", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                pieces = []
                for i, (n, first, own) in enumerate(zip(batch["tokens"].to_pylist(), batch["stream_start"].to_pylist(), batch["ids"].to_pylist())):
                    wide = np.frombuffer(own, f"<u{len(own) // n}").astype("<u4").tobytes()
                    for sequence in range(first // window, (first + n - 1) // window + 1):
                        a, b = max(first, sequence * window) - first, min(first + n, (sequence + 1) * window) - first
                        piece = wide[4 * a : 4 * b]
                        pieces.append((i, a, b - a, zlib.crc32(piece), n, sequence, first + a - sequence * window, piece if whole_ids else None))
                rows, *columns = zip(*pieces) if pieces else [()] * 8
                rows = pa.array(rows, pa.int64())
                out = {f"k{i}": batch[f"k{i}"].take(rows) for i in range(len(keys))}
                out |= {c: pa.array(x, pa.int64()) for c, x in zip(PIECE, columns)}
                if whole_ids:
                    out["ids"] = pa.array(columns[-1], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    schema = ", ".join([f"k{i} {inner.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys))] + [f"{c} long" for c in PIECE] + ["ids binary"] * whole_ids)
    return inner.mapInArrow(run, schema).withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


PIECE = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_pack_documents(spark, sf_dir: str) -> DataFrame:
    """Every document in sequences of 4096 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"], whole_ids=False)
