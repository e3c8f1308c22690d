"""Edges met in bins of their own size.

The width and the height of an edge each have a class, the power of two above them. Two
edges whose boxes meet share a bin as wide as the wider and as high as the higher of them, and
an edge touches at most two bins along an axis there. So every edge is listed in the few
bins that fit it and each class of edge on the other side, and edges meet by an equi-join.
Candidates follow the edges that lie near each other, whatever their number in one outline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Edges shorter than this share of all edges of a shape are binned like those.
SHORT = 0.1


def _extents(rings: str) -> str:
    """Width and height of all edges of an array of rings."""
    return f"""flatten(transform({rings}, r -> zip_with(slice(r, 1, greatest(size(r) - 1, 0)), slice(r, 2, greatest(size(r) - 1, 0)),
        (p, q) -> struct(abs(q.x - p.x) as w, abs(q.y - p.y) as h))))"""


def with_classes(shapes: DataFrame, rings: str) -> DataFrame:
    """Adds ``least``, the extent below which edges count as short, and ``classes``, the distinct ``(sx, sy)`` of all edges."""
    # exploding a single value keeps it from being worked out again for every edge that uses it
    df = shapes.selectExpr("*", f"explode(array(filter({_extents(rings)}, e -> e.w > 0 or e.h > 0))) as __all")
    df = df.selectExpr("*", f"explode(array(get(array_sort(transform(__all, e -> greatest(e.w, e.h))), cast(ceil(size(__all) * {SHORT}D) as int) - 1))) as least")
    return df.selectExpr("*", f"explode(array(array_distinct(transform(__all, e -> struct({size_class('e.w')} as sx, {size_class('e.h')} as sy))))) as classes").drop("__all")


def size_class(extent: str) -> str:
    return f"cast(ceil(log2(greatest({extent}, least))) as int)"


def with_class(edge_rows: DataFrame) -> DataFrame:
    """Adds the class ``sx, sy`` of every edge ``x1, y1, x2, y2`` with ``least``."""
    return edge_rows.selectExpr("*", f"{size_class('abs(x2 - x1)')} as sx", f"{size_class('abs(y2 - y1)')} as sy")


def listed(edge_rows: DataFrame) -> DataFrame:
    """One row per bin of an edge, for each class in ``other``: adds ``ox, oy, bx, by``."""
    def bins(axis):
        side = f"pow(2D, greatest(s{axis}, o{axis}))"
        return f"explode(sequence(floor(least({axis}1, {axis}2) / {side}), floor(greatest({axis}1, {axis}2) / {side}))) as b{axis}"

    e = edge_rows.selectExpr("*", "inline(other) as (ox, oy)").drop("other")
    return e.selectExpr("*", bins("x")).selectExpr("*", bins("y"))


def candidates(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of edges of equal ``keys`` that share a bin, as often as they do: all columns of both with ``a_`` and ``b_``.

    Both sides have ``x1, y1, x2, y2, sx, sy`` and ``other``, the classes of the other side.
    """
    kept = [c for c in left.columns if c not in (*keys, "other")]
    a = listed(left).selectExpr(*keys, *(f"{c} as a_{c}" for c in kept), "sx as lx", "ox as rx", "sy as ly", "oy as ry", "bx", "by")
    kept = [c for c in right.columns if c not in (*keys, "other")]
    b = listed(right).selectExpr(*keys, *(f"{c} as b_{c}" for c in kept), "ox as lx", "sx as rx", "oy as ly", "sy as ry", "bx", "by")
    return a.join(b.hint("merge"), [*keys, "lx", "rx", "ly", "ry", "bx", "by"])


def meeting(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The candidates whose boxes meet, each once: in the bin of the lower left corner of what they share."""
    j = candidates(left, right, keys)
    for axis in "xy":
        low = [f"least({s}_{axis}1, {s}_{axis}2)" for s in "ab"]
        high = [f"greatest({s}_{axis}1, {s}_{axis}2)" for s in "ab"]
        j = j.where(f"{low[0]} <= {high[1]} and {low[1]} <= {high[0]} and floor(greatest({low[0]}, {low[1]}) / pow(2D, greatest(l{axis}, r{axis}))) = b{axis}")
    return j.drop("lx", "rx", "ly", "ry", "bx", "by")


def turn(a: str, b: str, c: str) -> str:
    """Sign of the turn from a to b to c; exact zero where the products agree."""
    return f"(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))"


A1, A2, B1, B2 = (("a_x1", "a_y1"), ("a_x2", "a_y2"), ("b_x1", "b_y1"), ("b_x2", "b_y2"))


def with_turns(pairs: DataFrame) -> DataFrame:
    """Adds on which sides of one edge the ends of the other lie: ``s1, s2`` (b's ends of a), ``s3, s4`` (a's ends of b)."""
    return pairs.selectExpr("*", f"{turn(A1, A2, B1)} as s1", f"{turn(A1, A2, B2)} as s2", f"{turn(B1, B2, A1)} as s3", f"{turn(B1, B2, A2)} as s4")


#: Two closed edges whose boxes meet have a point in common.
HAVE_A_POINT = "signum(s1) * signum(s2) <= 0 and signum(s3) * signum(s4) <= 0"
