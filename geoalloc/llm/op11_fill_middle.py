"""Fill-in-the-middle by displacement scatter.

A batch of texts is one run of bytes. Cuts come from a scan for line feeds. Where a piece of
a text moves by another distance than the piece before it, that difference is noted; the
running sum of the differences is every byte's own displacement, and one scatter writes all
bytes of the batch to their places, marks included. The inverse reads pieces and marks off
the outputs, works out differences the other way round and gathers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of texts that are moved together, and bytes whose places are held at once.
SLICE, SPAN = 4 << 20, 4 << 20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the bounds of its rows; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    return data, bounds - bounds[0]


def text_column(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    wide = len(data) >= 1 << 31
    kind, ints = (pa.large_string(), np.int64) if wide else (pa.string(), np.int32)
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype(ints)), pa.py_buffer(data)])


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with up to ``SLICE`` bytes of text, a longer row alone."""
    ends = flat(batch[column])[1]
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def places(at: np.ndarray, delta: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``low, high, place`` of the bytes ``low..high``: their own number plus all differences noted up to them.

    ``at`` ascends. One span of bytes after another, the running sum carried along.
    """
    carry = 0
    for low in range(0, n, SPAN):
        high = min(n, low + SPAN)
        i, j = np.searchsorted(at, (low, high))
        shift = np.zeros(high - low, np.int64)
        np.add.at(shift, at[i:j] - low, delta[i:j])
        np.cumsum(shift, out=shift)
        shift += carry
        carry = int(shift[-1])
        shift += np.arange(low, high)
        yield low, high, shift


def differences(starts: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the displacement of pieces changes and by how much; empty pieces cancel out."""
    shift = targets - starts
    return starts, np.diff(shift, prepend=0)


def found(data: np.ndarray, bounds: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of a mark that lies inside one row."""
    at = np.flatnonzero(data[: max(0, len(data) - len(mark) + 1)] == mark[0])
    for k in range(1, len(mark)):
        at = at[data[at + k] == mark[k]]
    row = np.searchsorted(bounds, at, side="right") - 1
    inside = at + len(mark) <= bounds[row + 1] if len(at) else np.empty(0, bool)
    return row[inside], at[inside]


def line_cuts(data: np.ndarray, bounds: np.ndarray, choose) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of lines of every row, and the bytes where its two chosen cuts lie.

    ``choose(n)`` gives two arrays of line numbers between 0 and ``n``. A line ends behind its
    line feed; what follows the last one is a line if it is not empty.
    """
    start, end = bounds[:-1], bounds[1:]
    feeds = np.flatnonzero(data == 10)
    first = np.searchsorted(feeds, start)
    closed = np.searchsorted(feeds, end) - first
    rest = end > start
    rest[rest] = data[end[rest] - 1] != 10
    n = closed + rest

    def behind(line):
        out = np.where(line > 0, end, start)
        some = (line > 0) & (line <= closed)
        out[some] = feeds[(first + line - 1)[some]] + 1
        return out

    one, two = choose(n)
    return n, behind(np.minimum(one, two)), behind(np.maximum(one, two))


def check_marks(marks: tuple[str, str, str]) -> list[bytes]:
    """The marks as bytes; those that could overlap with one another or with text around them are an error."""
    raw = [m.encode() for m in marks]
    if not all(raw) or any(a in b for i, a in enumerate(raw) for j, b in enumerate(raw) if i != j):
        raise ValueError("marks must be distinct, not empty and not part of one another")
    if any(a[:k] == b[-k:] for a in raw for b in raw for k in range(1, min(len(a), len(b)))):
        raise ValueError("no mark may begin as another one ends")
    return raw


def moved(data: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray, psm: np.ndarray, spm: np.ndarray, marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of all rows as bytes and bounds; rows that are neither ``psm`` nor ``spm`` stay as they are."""
    p, s, m = (len(x) for x in marks)
    start, end = bounds[:-1], bounds[1:]
    formed = psm | spm
    out_bounds = np.concatenate([[0], np.cumsum(end - start + np.where(formed, p + s + m, 0))])
    at = out_bounds[:-1]
    # psm: P prefix S suffix M middle; spm: S suffix P prefix M middle
    prefix = at + np.where(psm, p, np.where(spm, s + (end - b) + p, 0))
    suffix = np.where(psm, prefix + (a - start) + s, np.where(spm, at + s, b - start + at))
    middle = np.where(formed, at + p + s + m + (a - start) + (end - b), a - start + at)
    out = np.empty(out_bounds[-1], np.uint8)
    ways = differences(np.stack([start, a, b], 1).ravel(), np.stack([prefix, middle, suffix], 1).ravel())
    for low, high, place in places(*ways, len(data)):
        out[place] = data[low:high]
    for mark, piece in zip(marks, (prefix, suffix, middle)):
        for k, byte in enumerate(mark):
            out[piece[formed] - len(mark) + k] = byte
    return out, out_bounds


def restored(data: np.ndarray, bounds: np.ndarray, psm: np.ndarray, spm: np.ndarray, marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts of all rows as bytes and bounds, read from outputs and forms alone."""
    formed = np.flatnonzero(psm | spm)
    begin = []
    for mark in marks:
        row, at = found(data, bounds, mark)
        mine = (psm | spm)[row]
        row, at = row[mine], at[mine]
        if len(row) != len(formed) or (row != formed).any():
            raise ValueError(f"an output in parts needs {mark!r} exactly once")
        begin.append(at + len(mark))
    p, s, m = (len(x) for x in marks)
    start, end = bounds[:-1].copy(), bounds[1:]
    # pieces in the order of the text: prefix, middle, suffix; a plain output is all prefix
    heads = [start, end.copy(), end.copy()]
    tails = [end.copy(), end.copy(), end.copy()]
    first = psm[formed]
    heads[0][formed], heads[2][formed], heads[1][formed] = begin
    tails[0][formed] = np.where(first, begin[1] - s, begin[2] - m)
    tails[2][formed] = np.where(first, begin[2] - m, begin[0] - p)
    heads, tails = np.stack(heads, 1), np.stack(tails, 1)
    sizes = (tails - heads).ravel()
    if (sizes < 0).any():
        raise ValueError("the marks of an output do not stand in the order of its form")
    starts = np.cumsum(sizes) - sizes
    out_bounds = np.concatenate([starts[::3], [sizes.sum()]])
    out = np.empty(out_bounds[-1], np.uint8)
    for low, high, place in places(*differences(starts, heads.ravel()), len(out)):
        out[low:high] = data[place]
    return out, out_bounds


def draws(ids: list, seed: int) -> np.ndarray:
    """Four 32-bit numbers for each id: the first groups of the sha256 of ``seed:id``; a null id counts as no digits."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").astype(np.int64).reshape(-1, 4)


def chars(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[int]:
    first = (data & 0xC0) != 0x80
    return [int(np.count_nonzero(first[i:j])) for i, j in zip(low.tolist(), high.tolist())]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100,
                   spm_rate: int = 50, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` for every row.

    A text of ``n`` lines is cut in front of two of them or at its end, by numbers drawn from
    ``seed`` and the id. ``rate`` of 100 texts are reordered, ``spm_rate`` of 100 of those with
    the suffix first. Empty and null texts and those that hold a mark stay plain, with null
    lengths. Each row stands alone: equal ids get equal numbers, null ids those of an id without
    digits. Other columns are not read. Memory is the slice of a batch (a long text alone) and
    its output, besides places of ``SPAN`` bytes.
    """
    raw = check_marks(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, bounds = flat(batch["text"])
                drawn = draws(batch["id"].to_pylist(), seed)
                n, a, b = line_cuts(data, bounds, lambda n: (drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)))
                plain = (bounds[1:] == bounds[:-1]) | (drawn[:, 2] % 100 >= rate)
                for mark in raw:
                    plain[found(data, bounds, mark)[0]] = True
                spm = ~plain & (drawn[:, 3] % 100 < spm_rate)
                out = moved(data, bounds, a, b, ~plain & ~spm, spm, raw)
                form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"], "n": pa.array(n, pa.int64()), "form": pa.array(form.tolist(), pa.string()),
                    "prefix_chars": pa.array(chars(data, bounds[:-1], a), pa.int64(), mask=plain),
                    "middle_chars": pa.array(chars(data, a, b), pa.int64(), mask=plain), "output": text_column(*out)})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(rows: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``rows`` with ``restored``: the exact text, from ``output`` and ``form`` alone.

    A null output is empty, a null form plain. A form without its marks is an error.
    """
    raw = check_marks(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "output"):
                form = np.array(batch["form"].to_pylist(), object)
                text = restored(*flat(batch["output"]), form == PSM, form == SPM, raw)
                yield pa.RecordBatch.from_arrays([*batch.columns, text_column(*text)], [*batch.schema.names, "restored"])

    return rows.mapInArrow(run, rows.drop("restored").schema.add("restored", "string"))


def op11_fill_middle(spark, sf_dir: str) -> DataFrame:
    """Every document reordered and put back, as digests."""
    rows = restore(fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return rows.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


SQL = r"""
with drawn as (select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h,
                      regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines from documents),
cuts as (select *, len(lines) as n,
                cast('0x' || substr(h, 1, 8) as bigint) % (len(lines) + 1) as one, cast('0x' || substr(h, 9, 8) as bigint) % (len(lines) + 1) as two,
                text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or cast('0x' || substr(h, 17, 8) as bigint) % 100 >= 100 as plain,
                cast('0x' || substr(h, 25, 8) as bigint) % 100 < 50 as back from drawn),
pieces as (select *, case when plain then 'plain' when back then 'spm' else 'psm' end as form,
                  array_to_string(lines[1:least(one, two)], '') as prefix, array_to_string(lines[least(one, two) + 1:greatest(one, two)], '') as middle,
                  array_to_string(lines[greatest(one, two) + 1:n], '') as suffix from cuts)
select doc_id, cast(n as bigint) as n, form, case when not plain then cast(length(prefix) as bigint) end as prefix_chars,
       case when not plain then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(text) as restored_sha256
from pieces
"""
