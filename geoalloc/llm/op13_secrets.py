"""Secret scan with a worklist of decoded layers.

A text is the first layer. Every layer is scanned by the same rules and searched for encoded
stretches; what they decode to is a new layer, until nothing new is left:

* *escapes*: percent codes, or backslash, ``&#`` and ``U+`` codes, replaced inside a copy of the layer,
* *base64*: runs of either alphabet, also over line ends, at each of the four offsets,
* *wide text*: zero bytes between the characters (UTF-16) left out,
* *compressed*: gzip, zlib, bzip2, xz and zstandard streams inside decoded bytes.

A layer keeps, for each of its bytes, the stretch of the text that it came from, so findings
are spans of the text itself. A layer with the content and place of an earlier one is
not entered again; that ends streams that unpack to themselves.
"""

from __future__ import annotations

import bz2
import hashlib
import lzma
import re
import zlib
from binascii import a2b_base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the report, each with its rule and the least length of the group named.
RULES = (
    ("assign", re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 1, 12),
    ("access", re.compile(rb"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(rb"[0-9a-f]+"), 0, 16),
)
KINDS = tuple(r[0] for r in RULES)
#: Bytes that the decompressed layers of one text may have together.
MOST_BYTES = 64 << 20
BATCH = 256

LONG_HEX = re.compile(rb"[0-9a-f]{16,}")
PERCENT = re.compile(rb"%([0-9A-Fa-f]{2})")
ESCAPE = re.compile(rb"""\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&\#x([0-9A-Fa-f]{1,6});?|&\#([0-9]{1,7});?|U\+([0-9A-Fa-f]{4,6})""")
#: Runs that could hold the shortest secret, 16 bytes; lines are joined where they are long.
BASE64 = (re.compile(rb"(?:[A-Za-z0-9+/]{40,}\r?\n)*[A-Za-z0-9+/]{22,}"), re.compile(rb"(?:[A-Za-z0-9_-]{40,}\r?\n)*[A-Za-z0-9_-]{22,}"))
URL_SAFE = bytes.maketrans(b"-_", b"+/")
#: Pieces in which streams are unpacked.
PIECE = 1 << 20


def _deflated(bits: int):
    def pieces(data: bytes) -> Iterator[bytes]:
        stream = zlib.decompressobj(bits)
        for at in range(0, len(data), PIECE):
            rest = data[at : at + PIECE]
            while not stream.eof and (piece := stream.decompress(rest, PIECE)):
                yield piece
                rest = stream.unconsumed_tail
            if stream.eof:
                return
    return pieces


def _blocks(make):
    def pieces(data: bytes) -> Iterator[bytes]:
        stream = make()
        yield stream.decompress(data, PIECE)
        while not stream.eof and not stream.needs_input:
            yield stream.decompress(b"", PIECE)
    return pieces


def _frames(data: bytes) -> Iterator[bytes]:
    with zstandard.ZstdDecompressor().stream_reader(data) as stream:
        while piece := stream.read(PIECE):
            yield piece


#: First bytes of streams, and their readers.
STREAMS = (
    (b"\x1f\x8b\x08", _deflated(31)), (b"\x78\x01", _deflated(15)), (b"\x78\x5e", _deflated(15)), (b"\x78\x9c", _deflated(15)), (b"\x78\xda", _deflated(15)),
    (b"BZh", _blocks(bz2.BZ2Decompressor)), (b"\xfd7zXZ\x00", _blocks(lzma.LZMADecompressor)), (b"\x28\xb5\x2f\xfd", _frames))


@dataclass
class Layer:
    """Decoded bytes; byte k stands for ``low[k]..high[k]`` of the text (itself where these are None)."""

    data: bytes
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    way: tuple[str, ...] = ()

    def part(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        if self.low is None:
            return np.arange(start, end), np.arange(start + 1, end + 1)
        return self.low[start:end], self.high[start:end]

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.low is None:
            return start, end
        return int(self.low[start:end].min()), int(self.high[start:end].max())

    def key(self) -> tuple:
        place = (0, len(self.data)) if self.low is None else (int(self.low.min()), int(self.high.max()))
        return (hashlib.blake2b(self.data, digest_size=16).digest(), *place)


def matches(data: bytes) -> Iterator[tuple[str, int, int]]:
    """Spans of all rules in a run of bytes: leftmost matches, those that are too short dropped."""
    for kind, rule, group, least in RULES:
        # a run of hex digits is matched whole, so asking for its length at once gives the same spans
        for m in (LONG_HEX if kind == "hex" else rule).finditer(data):
            if m.end(group) - m.start(group) >= least:
                yield kind, m.start(), m.end()


def code_of(m: re.Match) -> bytes | None:
    """What an escape stands for: a byte for ``\\x``, else a character; None where there is no such one."""
    digits = m.group(m.lastindex)
    if m.lastindex == 4:
        return bytes([int(digits, 16)])
    code = int(digits, 10 if m.lastindex == 6 else 16)
    return chr(code).encode("utf-8", "surrogatepass") if code < 0x110000 else None


def replaced(layer: Layer, rule: re.Pattern, code, way: str) -> Layer | None:
    """The layer with all matches of a rule decoded in place."""
    out, lows, highs, last = [], [], [], 0
    for m in rule.finditer(layer.data):
        value = code(m)
        if value is None:
            continue
        low, high = layer.part(last, m.start())
        a, b = layer.span(*m.span())
        out += [layer.data[last : m.start()], value]
        lows += [low, np.full(len(value), a)]
        highs += [high, np.full(len(value), b)]
        last = m.end()
    if not out:
        return None
    low, high = layer.part(last, len(layer.data))
    data = b"".join([*out, layer.data[last:]])
    return Layer(data, np.concatenate([*lows, low]), np.concatenate([*highs, high]), (*layer.way, way)) if data else None


def joined_surrogates(layer: Layer) -> Layer:
    """Pairs of surrogates, as JSON writes characters above U+FFFF, as the one character they mean.

    Each half is three bytes, the pair becomes four; the fifth and sixth fall out of the map.
    """
    pair = re.compile(rb"\xed([\xa0-\xaf][\x80-\xbf])\xed([\xb0-\xbf][\x80-\xbf])")

    def one(m):
        return m.group().decode("utf-8", "surrogatepass").encode("utf-16-le", "surrogatepass").decode("utf-16-le").encode()

    return (replaced(layer, pair, one, "") if pair.search(layer.data) else None) or layer


def from_base64(layer: Layer) -> Iterator[Layer]:
    for alphabet, rule in enumerate(BASE64):
        for m in rule.finditer(layer.data):
            run = m.group()
            if alphabet and not (b"-" in run or b"_" in run):
                continue  # the same in both alphabets
            at = np.flatnonzero(~np.isin(np.frombuffer(run, np.uint8), (10, 13)))
            low, high = layer.part(*m.span())
            low, high = low[at], high[at]
            digits = np.frombuffer(run, np.uint8)[at].tobytes().translate(URL_SAFE)
            for skip in range(4):
                own = digits[skip:]
                n = len(own) * 6 // 8
                own = own[:-1] if len(own) % 4 == 1 else own
                data = a2b_base64(own + b"=" * (-len(own) % 4))
                k = np.arange(n)
                # byte k takes its bits from one digit up to another
                yield Layer(data, low[skip + k * 8 // 6], high[skip + (k * 8 + 7) // 6], (*layer.way, "base64"))


def unpacked(data: bytes, pieces, most: int) -> tuple[bytes, bool]:
    """What a stream at the head of ``data`` holds, up to ``most`` bytes, and whether that was all.

    A stream that breaks off or is damaged gives what stands before that.
    """
    out, size = [], 0
    try:
        for piece in pieces(data):
            out.append(piece)
            size += len(piece)
            if size > most:
                return b"".join(out)[:most], False
    except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
        pass
    return b"".join(out), True


class Scan:
    """The worklist of one text."""

    def __init__(self, text: str, most: int = MOST_BYTES):
        self.data = text.encode("utf-8", "surrogatepass")
        self.room, self.whole, self.layers = most, True, 0
        self.found: dict[tuple[str, int, int], tuple[bool, str, bytes]] = {}

    def children(self, layer: Layer) -> Iterator[Layer]:
        data = layer.data
        if b"%" in data:
            yield replaced(layer, PERCENT, lambda m: bytes([int(m.group(1), 16)]), "url")
        if b"\\" in data or b"&#" in data or b"U+" in data:
            out = replaced(layer, ESCAPE, code_of, "unicode")
            yield out and joined_surrogates(out)
        yield from from_base64(layer)
        if layer.low is None:
            return  # the text itself is no stream, and has no zero bytes between characters
        zero = np.frombuffer(data, np.uint8) == 0
        if 3 * zero.sum() > len(data) > zero.sum():
            some = np.flatnonzero(~zero)
            yield Layer(data.replace(b"\0", b""), layer.low[some], layer.high[some], (*layer.way, "unicode"))
        for head, pieces in STREAMS:
            at = data.find(head)
            while at >= 0:
                out, whole = unpacked(data[at:], pieces, self.room)
                self.whole &= whole
                self.room -= len(out)
                if out:
                    low, high = layer.span(at, len(data))
                    yield Layer(out, np.broadcast_to(np.int64(low), len(out)), np.broadcast_to(np.int64(high), len(out)), (*layer.way, "compressed"))
                at = data.find(head, at + 1)

    def run(self) -> Scan:
        todo, seen = [Layer(self.data)], set()
        while todo:
            layer = todo.pop()
            if layer is None or not layer.data or (key := layer.key()) in seen:
                continue
            seen.add(key)
            self.layers += 1
            for kind, start, end in matches(layer.data):
                span = (kind, *layer.span(start, end))
                self.found.setdefault(span, (layer.low is None, "/".join(layer.way), layer.data[start:end]))
            todo.extend(self.children(layer))
        return self

    def findings(self) -> list[dict]:
        """All spans in code points, by start, kind and end."""
        first = None
        if not self.data.isascii() and self.found:
            first = np.concatenate([[0], np.cumsum((np.frombuffer(self.data, np.uint8) & 0xC0) != 0x80)])
        place = (lambda x: int(first[x])) if first is not None else (lambda x: x)
        rows = [{"kind": kind, "start": place(a), "end": place(b), "base": base, "way": way, "secret": secret.decode("utf-8", "replace")}
                for (kind, a, b), (base, way, secret) in self.found.items()]
        return sorted(rows, key=lambda r: (r["start"], KINDS.index(r["kind"]), r["end"]))


FINDING = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("way", pa.string()), ("secret", pa.string())])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """``id, findings, layers, whole`` for every row.

    ``findings`` have ``kind, start, end`` in code points of the text (``end`` exclusive), ``base``
    (in the text as it stands), ``way`` (the decodings that lead there) and ``secret`` (as decoded);
    equal spans stand once, the plain one first. Spans through compressed layers are those of
    the whole stream. ``whole`` is false where decompressed layers of a text came to more than
    ``most_bytes`` and the rest was not looked at; base spans are never affected. Null and empty
    texts have no findings. Each row stands alone, so repeated rows and ids and null ids need no
    care; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                scans = [Scan(x or "", most_bytes).run() for x in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array([s.findings() for s in scans], pa.list_(FINDING)),
                                                  pa.array([s.layers for s in scans], pa.int64()), pa.array([s.whole for s in scans])], ["id", "findings", "layers", "whole"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, findings array<struct<kind:string,start:long,end:long,base:boolean,way:string,secret:string>>, layers long, whole boolean")


def listed(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def op13_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document, as they stand and behind any layers of encoding."""
    rows = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("findings", lambda f: f["base"])
    counts = [F.expr(f"cast(size(filter(findings, f -> f.base and f.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return rows.select(F.col("id").alias("doc_id"), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"),
                       F.size("findings").cast("long").alias("n_spans"), "layers", "whole")
