"""Fill-in-the-middle, whitening and secret scans against brute force."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import json
import lzma
import random
import re
import zlib
from urllib.parse import quote

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from geoalloc.llm import op11_fill_middle as op11
from geoalloc.llm import op12_whitening as op12
from geoalloc.llm import op13_secrets as op13

CLASH = ("id", "n", "form", "output", "restored", "at", "dim", "x", "i", "row", "task", "vector", "component", "findings", "layers", "whole", "spans")
TEXTS = [None, "", "one line", "a\nb\nc", "a\nb\nc\n", "\n\n\n", "é\nß\r\n\u2028 same line\n日本\n𝔘𝔫𝔦", "x <P> y\nz", "x\n<S>", "<M>\n", "<\nP>\n<\nS>\nM>\n<", "a<\n<P\n>S>\n" * 5,
         "long line " * 9000 + "\n" + "more\n" * 3000, "<P", ">\n<", "a\nb\nc"]


def plain_fill(i, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = [int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in op11.MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "a\nb\nc\nd"), (3, "a\nb\nc"), (3, "a\nb\nc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in CLASH}).repartition(2)
    for extra in ({}, {"seed": 3, "rate": 60, "spm_rate": 10}):
        got = op11.restore(op11.fill_in_middle(docs, **extra)).collect()
        want = [(i, *plain_fill(i, t, extra.get("seed", 7), extra.get("rate", 100), extra.get("spm_rate", 50)), t or "") for i, t in rows]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert op11.restore(op11.fill_in_middle(docs.where("false"))).count() == 0


def test_fill_in_middle_in_small_spans(monkeypatch):
    monkeypatch.setattr(op11, "SPAN", 7)
    rng, raw = random.Random(1), op11.check_marks(op11.MARKS)
    import pyarrow as pa

    for _ in range(60):
        texts = ["".join(rng.choice("a<P>SMé\n\n") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 9))]
        texts = [t for t in texts if not any(m in t for m in op11.MARKS)]
        data, bounds = op11.flat(pa.array(["skipped", *texts, "y"], pa.string())[1:-1])
        kind = np.array([rng.randrange(3) for _ in texts], int)
        a, b = np.zeros((2, len(texts)), np.int64)
        for i, t in enumerate(texts):
            cuts = sorted(len("".join(t[:rng.randrange(len(t) + 1)]).encode()) for _ in "ab")
            a[i], b[i] = bounds[i] + cuts[0], bounds[i] + cuts[1]
        out, ends = op11.moved(data, bounds, a, b, kind == 1, kind == 2, raw)
        for i, t in enumerate(texts):
            t = t.encode()
            p, m, s = t[: a[i] - bounds[i]], t[a[i] - bounds[i] : b[i] - bounds[i]], t[b[i] - bounds[i] :]
            assert out[ends[i] : ends[i + 1]].tobytes() == (t, b"<P>" + p + b"<S>" + s + b"<M>" + m, b"<S>" + s + b"<P>" + p + b"<M>" + m)[kind[i]]
        back, starts = op11.restored(out, ends, kind == 1, kind == 2, raw)
        assert back.tobytes() == data.tobytes() and starts.tolist() == bounds.tolist()


def test_marks_and_broken_outputs(spark):
    for marks in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("aa", "b", "abba"), ("aba", "x", "y")):
        with pytest.raises(ValueError):
            op11.check_marks(marks)
    docs = spark.createDataFrame([(i, "a\nb\nc\n") for i in range(9)], "doc_id long, text string")
    other = ("[pre]", "{suffix}", "§m§".replace("§", "|") + "x")
    got = op11.restore(op11.fill_in_middle(docs, marks=other), other).collect()
    assert {r.restored for r in got} == {"a\nb\nc\n"} and all(r.output.count("[pre]") == 1 for r in got)
    broken = spark.createDataFrame([("psm", "<P>a<M>b"), ("plain", "x")], "form string, output string")
    with pytest.raises(Exception, match="exactly once"):
        op11.restore(broken).collect()
    fine = op11.restore(spark.createDataFrame([(None, None), ("plain", "<P>")], "form string, output string")).collect()
    assert [r.restored for r in fine] == ["", "<P>"]


# whitening

def plain_whitening(vectors, most=16):
    """Integers, distinct rows, covariance and eigenvectors with numpy on all rows at once."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1]
    k = min(most, int((values > values.max() * 1e-20).sum()))
    values, axes = values[order], axes[:, order]
    own = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return n, deviation, own @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def spread(rows):
    out = {}
    for r in rows:
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def test_whitening_against_eigenvectors(spark):
    rng = np.random.default_rng(5)
    scales = 2.0 ** np.linspace(6, -1, 24)
    base = (rng.normal(size=(700, 24)) * scales) @ np.linalg.qr(rng.normal(size=(24, 24)))[0]
    good = [(i, v.tolist()) for i, v in enumerate(base)] + [(900 + i, base[0].tolist()) for i in range(300)] + [(5, base[7].tolist())]
    bad = [(2000, None), (2001, [float("nan")] * 24), (2002, [None, *[1.0] * 23]), (2003, [float("inf"), *[0.0] * 23]), (2004, [1e300] * 24), (2005, []), (2006, [3.0, 4.0])]
    frame = spark.createDataFrame(good + bad + [(None, base[1].tolist())], "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in CLASH}).repartition(5)
    got = op12.whitened_components(frame).collect()
    assert len(got) == 16 * (len(good) + 1)
    n, deviation, white, explained = plain_whitening([v for _, v in good])
    assert n == 700 and {r.n for r in got} == {700} and max(r.identity_error for r in got) < 1e-10 and len({r.identity_error for r in got}) == 1
    rows, signs = spread(r for r in got if r.vec_id != 5), None
    for (i, _), dev, w in zip(good, deviation, white):
        if i == 5:
            continue
        own = rows[i]
        assert [own[c].deviation for c in range(1, 17)] == [dev] * 16
        mine = np.array([own[c].whitened for c in range(1, 17)])
        signs = np.sign(mine * w) if signs is None else signs
        assert np.allclose(mine * signs, w, rtol=1e-7, atol=1e-9)
        assert np.allclose([own[c].explained for c in range(1, 17)], explained, rtol=1e-9)


def test_whitening_of_lower_rank_and_small_tables(spark):
    rng = np.random.default_rng(6)
    free = rng.integers(-300, 300, size=(200, 4)) / 64.0
    rows = np.column_stack([free, free[:, 0], np.full(200, 0.25), free[:, 1] + free[:, 2]])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>")
    got = spread(op12.whitened_components(frame).collect())
    assert {len(r) for r in got.values()} == {4}  # directions without variance are none
    white = np.array([[got[i][c].whitened for c in range(1, 5)] for i in range(200)])
    assert np.allclose(np.cov(white.T, bias=True), np.eye(4), atol=1e-9) and got[0][1].identity_error < 1e-9
    assert abs(sum(got[0][c].explained for c in range(1, 5)) - 1) < 1e-12
    _, _, want, _ = plain_whitening(rows, 4)
    assert np.allclose(np.abs(white), np.abs(want), rtol=1e-6, atol=1e-8)
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.5]), (4, [1.5])], "vec_id long, embedding array<double>")
    got = op12.whitened_components(one).collect()
    assert sorted((r.vec_id, r.n, r.deviation, round(abs(r.whitened), 12), round(r.explained, 12)) for r in got) == [(3, 2, 64**2, 1.0, 1.0), (4, 2, 64**2, 1.0, 1.0)]
    assert op12.whitened_components(one.where("false")).count() == 0


def test_exact_numbers_of_any_size():
    m = op12.Model(3, [10, 1 << 70])
    y = m.scaled(np.array([[4, 5]]))
    assert y.tolist() == [[2, 15 - (1 << 70)]] and op12.deviations(y) == [None]
    assert op12.deviations(np.array([[1 << 30, 3]])) == [(1 << 60) + 9]
    assert op12.deviations(np.array([[1 << 31, 1 << 30]])) == [(1 << 62) + (1 << 60)]
    r = np.triu(np.random.default_rng(1).normal(size=(9, 9))) + 5 * np.eye(9)
    a = np.random.default_rng(2).normal(size=(30, 9))
    assert np.allclose(op12.solved(a, r) @ r, a)


# secrets

ASSIGN = re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_spans(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out, key=lambda s: (s[1], op13.KINDS.index(s[0])))


def b64(x, safe=False):
    x = x.encode() if isinstance(x, str) else x
    return (base64.urlsafe_b64encode if safe else base64.b64encode)(x).decode()


def found(text, **extra):
    return [(r["kind"], r["start"], r["end"], r["base"], r["secret"]) for r in op13.Scan(text, **extra).run().findings()]


def test_base_spans_against_plain_rules(spark):
    rng = random.Random(9)
    parts = ["password", "PassWD", "SECRET", "to\u212aen", "ſecret", "token", "api_key", "apikey", '"', "'", " ", "  ", ":", "=", "abcdef0123456789", "AKIA", "AKIAABCDEFGHIJ1234", "é", "日", "\n",
             "abcdefghijkl", "xyz+/=_.-", "0123", "deadbeef", "%", "\\u", "𝔘"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(400)] + [None, "", "word " * 20_000 + "token: " + "a" * 50_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "secret=abcdefghijklm"), (0, texts[0])], "doc_id long, text string").withColumns({c: F.lit(1) for c in CLASH})
    got = op13.scan_secrets(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = plain_spans("secret=abcdefghijklm" if r.id is None else texts[r.id] or "")
        assert [(f.kind, f.start, f.end) for f in r.findings if f.base] == want
        assert len({(f.kind, f.start, f.end) for f in r.findings}) == len(r.findings) and r.whole
    assert op13.scan_secrets(docs.where("false")).count() == 0


KEY = "password=hunter2hunter2"


@pytest.mark.parametrize("wrapped", [
    quote(KEY, safe=""), quote(quote(KEY, safe=""), safe=""), "".join(f"%{ord(c):02x}" for c in KEY), "".join(f"\\u{ord(c):04x}" for c in KEY), "".join(f"&#{ord(c)};" for c in KEY),
    "".join(f"\\x{ord(c):02X}" for c in KEY), "".join(f"\\u{{{ord(c):x}}}" for c in KEY), json.dumps("".join(f"\\u{ord(c):04x}" for c in KEY))[1:-1].replace("\\\\", "\\"),
    b64(KEY), b64("𝔘 ñ " + KEY), b64("é" * 5 + "?>?>" + KEY, True), b64(KEY).rstrip("="), b64(b64(b64(KEY))), b64(gzip.compress(KEY.encode())), b64(zlib.compress(KEY.encode())),
    b64(bz2.compress(KEY.encode())), b64(lzma.compress(KEY.encode())), b64(zstandard.compress(KEY.encode())), b64(gzip.compress(b64(zlib.compress(quote(KEY, safe="").encode())).encode())),
    quote(b64(gzip.compress(KEY.encode())), safe=""), b64(KEY.encode("utf-16-le")), b64(KEY.encode("utf-16")), "x/y" + b64("ab" + KEY), b64(quote(b64("\\u0070assword\\u003dhunter2hunter2"), safe="")),
    "\n".join(re.findall(".{1,76}", b64(" words and" * 30 + KEY + " words" * 20))),
])
def test_nested_layers(wrapped):
    for left, right in (("", ""), ("Æ some words, then: ", " and more wörds.")):
        text = f"{left}{wrapped}{right}"
        hits = [f for f in found(text) if f[0] == "assign" and "hunter2hunter2" in f[4]]
        assert hits and not plain_spans(text)
        for _, start, end, base, secret in hits:
            assert not base and secret.startswith(KEY)
            assert len(left) <= start < end <= len(left) + len(wrapped)


def test_spans_point_at_the_encoded_bytes():
    text = "ünder " + b64("0123456789012345 " + KEY) + " end"
    (hit,) = [f for f in found(text) if f[0] == "assign"]
    run = text.index(" ", 1) + 1
    assert hit[1:3] == (run + 17 * 8 // 6, run + -(-(17 + len(KEY)) * 8 // 6))
    text = "é pass%77ord=" + "a%62cdefghijklm ok"
    (hit,) = [f for f in found(text) if f[0] == "assign"]
    assert text[hit[1] : hit[2]] == "pass%77ord=a%62cdefghijklm" and hit[4] == "password=abcdefghijklm"
    assert [f for f in found('say "\\ud83d\\ude00 tok\\u0065n: abcdefghijklm"') if f[0] == "assign"][0][1:3] == (18, 43)
    both = "secret=abcdefghijkl%6Dn"
    assert [(f[1:3], f[3]) for f in found(both)] == [((0, 19), True), ((0, len(both)), False)]


def test_layers_end(monkeypatch):
    scan = op13.Scan("first")
    same = op13.Layer(b"again", np.zeros(5, int), np.ones(5, int))
    monkeypatch.setattr(scan, "children", lambda layer: iter([same, None]))
    assert scan.run().layers == 2  # a layer that unpacks to itself is entered once
    bomb = b64(zlib.compress(b"0" * 10_000_000 + KEY.encode()))
    scan = op13.Scan("hex 0123456789abcdef " + bomb, most=1 << 20).run()
    assert not scan.whole and ("hex", 4, 20) in scan.found and not any(k[0] == "assign" for k in scan.found)
    scan = op13.Scan(bomb).run()
    assert scan.whole and any(k[0] == "assign" for k in scan.found)
    cut = b64(gzip.compress(random.Random(1).randbytes(5000) + KEY.encode() + random.Random(2).randbytes(200_000))[:100_000])
    assert any(f[0] == "assign" for f in found(cut))  # a stream that breaks off


def test_clean_texts_have_no_added_spans():
    rng = random.Random(4)
    words = ["https://example.com/a/b?q=%20x&y=%C3%A9", "C:\\users\\x", "internationalisation/of/very/long/paths/and/words", "U+00E9", "100%", b64(rng.randbytes(60)), "&amp;", "BZh", "x^", "plain"]
    for _ in range(200):
        text = " ".join(rng.choice(words) for _ in range(30))
        assert [f for f in found(text) if not f[3]] == []
