"""Shapes cut along a square grid, so that every spatial question is an equi-join.

A polygon becomes *strips*: signed pieces of "the ground below an edge", each
inside one grid cell. The strips of a polygon in a cell add up to the polygon's
part of that cell, holes included. For two polygons the area of the overlap is
the sum, over the strips that share a cell, of ``sign * sign`` times the integral
of the lower of the two edges. Nothing larger than an edge is ever shuffled, a
cell that lies inside a polygon costs one row, and the sums are ordinary
aggregates with a map-side part.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoalloc.functions.geometry import BOX
from geoalloc.sources.writers import stored

CELL = ("cx", "cy")
#: Shapes of one map in one cell that a task should have to meet at most.
HOT_ROWS = 100_000
#: Share of a cell to which heights of edges are exact.
ROUNDING = 1e-12
STRIP = ("cx", "cy", "sign", "xa", "xb", "ya", "yb", "bottom", "top")
BIN = ("level", "bin", "role")
#: Levels of bins across a cell; the finest are 2^-30 of it.
MOST_LEVELS = 30


class Cell(float):
    """Side of the grid cells, with the table of crowded cells if there are any.

    ``hot`` has ``cx, cy`` and, for each of the maps the cell was chosen for,
    ``p0, p1, ...``: into how many parts the rows of that map are to be split.
    """

    hot: DataFrame | None = None


def choose_cell(*shapes: DataFrame, cells_per_shape: int = 16, hot_rows: int = HOT_ROWS) -> Cell:
    """Cell side for a join of shape tables: the smallest median box side.

    Widened where needed so that all shapes together touch at most about
    ``cells_per_shape`` cells each, and rounded up to a power of two so that cell
    borders are exact in floating point. Cells with more than ``hot_rows`` shapes
    of one map are listed for splitting; maps smaller than that cannot have any.
    Reads the boxes only; one row per map comes back to the driver.
    """
    boxes = None
    for i, df in enumerate(shapes):
        one = df.select(F.lit(i).alias("layer"), *BOX)
        boxes = one if boxes is None else boxes.unionByName(one)
    rows = boxes.selectExpr("layer", "xmax - xmin as w", "ymax - ymin as h").groupBy("layer").agg(
        F.expr("percentile_approx(greatest(w, h), 0.5)").alias("median"), F.count("w").alias("n"),
        F.sum(F.expr("w + h")).alias("rim"), F.sum(F.expr("w * h")).alias("body")).collect()
    medians = [r["median"] for r in rows if r["median"]]
    if not medians:
        return Cell(1.0)
    n, rim, body = (sum(r[k] or 0 for r in rows) for k in ("n", "rim", "body"))
    # n + rim/c + body/c^2 cells in all; solve for the c that just fits the room.
    room = (max(cells_per_shape, 2) - 1) * n + 4096
    fits = (rim + math.sqrt(rim ** 2 + 4 * room * body)) / (2 * room)
    cell = Cell(2.0 ** math.ceil(math.log2(max(min(medians), fits))))
    if max(r["n"] for r in rows) > hot_rows:
        counts = [F.count(F.when(F.col("layer") == i, 1)).alias(f"p{i}") for i in range(len(shapes))]
        crowds = box_cells(boxes, cell, "layer").groupBy(*CELL).agg(*counts)
        crowds = crowds.where(F.greatest(*[f"p{i}" for i in range(len(shapes))], F.lit(0)) > hot_rows)
        hot = stored(crowds.select(*CELL, *[F.ceil(F.col(f"p{i}") / hot_rows).alias(f"p{i}") for i in range(len(shapes))]))
        cell.hot = None if hot.isEmpty() else hot
    return cell


def split_hot(left: DataFrame, right: DataFrame, cell: float, layers: tuple[int, int]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a cell join with the columns to join on.

    In a crowded cell the left rows are dealt into parts, and so are the right
    rows; each left part meets each right part in a task of its own. A row is
    repeated once per part of the other side, in crowded cells only.
    """
    hot = getattr(cell, "hot", None)
    if hot is None:
        return left, right, list(CELL)
    parts = hot.selectExpr(*CELL, f"greatest(p{layers[0]}, 1L) as lp", f"greatest(p{layers[1]}, 1L) as rp")

    def dealt(df, own, other, own_part, other_part):
        kept = df.columns
        return (df.join(parts, list(CELL), "left")
                .selectExpr(*kept, f"pmod(xxhash64({', '.join(kept)}), coalesce({own}, 1L)) as {own_part}",
                            f"explode(sequence(0L, coalesce({other}, 1L) - 1)) as {other_part}"))

    return (dealt(left, "lp", "rp", "part_l", "part_r"), dealt(right, "rp", "lp", "part_r", "part_l"),
            [*CELL, "part_l", "part_r"])


def box_cells(df: DataFrame, cell: float, *keep: str) -> DataFrame:
    """One row per cell that the closed box of a shape touches."""
    def span(lo, hi):
        return f"explode(sequence(floor({lo} / {float(cell)!r}D), floor({hi} / {float(cell)!r}D)))"
    return (df.where("xmin is not null").select(*keep, *BOX)
            .selectExpr("*", f"{span('xmin', 'xmax')} as cx").selectExpr("*", f"{span('ymin', 'ymax')} as cy"))


def edges(shapes: DataFrame, id: str, geom: str = "geom") -> DataFrame:
    """One row per edge: end points and ``turn``, +1 if the area lies to its left.

    Rings may be given in either direction: the first of a polygon is its shell,
    the others are holes. ``bottom`` and ``top`` are the least and the greatest y of
    the polygon.
    """
    def each(measure):
        # over the edges p -> q of ring r
        return f"zip_with(slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1), (p, q) -> {measure})"

    area = f"aggregate({each('(p.x - r[0].x) * (q.y - r[0].y) - (q.x - r[0].x) * (p.y - r[0].y)')}, 0D, (s, v) -> s + v)"
    ring = f"""struct(signum({area}) * if(i = 0, 1D, -1D) as turn,
        {each('struct(p.x as x1, p.y as y1, q.x as x2, q.y as y2)')} as edges)"""
    polys = shapes.selectExpr(f"`{id}` as id", f"""explode(transform(transform({geom}.polys, poly -> filter(poly, r -> size(r) > 1)),
        poly -> struct(array_min(transform(flatten(poly), p -> p.y)) as bottom, array_max(transform(flatten(poly), p -> p.y)) as top,
                       transform(poly, (r, i) -> {ring}) as rings))) as g""")
    rows = polys.selectExpr("id", "g.bottom as bottom", "g.top as top", "explode(g.rings) as r")
    return rows.selectExpr("id", "bottom", "top", "r.turn as turn", "inline(r.edges) as (x1, y1, x2, y2)")


def _cut_at_columns(edge_rows: DataFrame, cell: float) -> DataFrame:
    """Edges turned to run left to right (or up), cut at the vertical grid lines.

    ``sign`` is +1 when the area lies below a piece; for an upright edge, when a
    walk to the right across it enters the area.
    """
    back = "(x1 > x2 or (x1 = x2 and y1 > y2))"
    e = edge_rows.where("x1 <> x2 or y1 <> y2").selectExpr(
        "id", "bottom", "top", f"if({back}, turn, -turn) as sign",
        f"if({back}, x2, x1) as ax", f"if({back}, y2, y1) as ay",
        f"if({back}, x1, x2) as bx", f"if({back}, y1, y2) as by")
    c = f"{float(cell)!r}D"
    e = e.selectExpr("*", f"explode(sequence(floor(ax / {c}), greatest(floor(ax / {c}), ceil(bx / {c}) - 1))) as cx")
    e = e.selectExpr("*", f"cx * {c} as x0", f"(cx + 1) * {c} as x9", "try_divide(by - ay, bx - ax) as slope")
    return e.selectExpr(
        "id", "bottom", "top", "sign", "cx", "x0", "ax = bx as upright",
        "greatest(ax, x0) as px", "if(ax < x0, ay + slope * (x0 - ax), ay) as py",
        "least(bx, x9) as qx", "if(bx > x9, ay + slope * (x9 - ax), by) as qy")


def strips(shapes: DataFrame, id: str, cell: float, geom: str = "geom") -> DataFrame:
    """Cuts shapes into signed strips: ``id, cx, cy, sign, xa, xb, ya, yb, bottom, top``.

    ``xa..xb`` and the heights ``ya, yb`` of the edge above the strip are relative
    to the lower left corner of the cell. ``bottom`` and ``top`` are those of the whole
    polygon: a strip reaches down to the cell border, its polygon does not. Three kinds
    of strip make up a cell:

    * *edge pieces* inside the cell,
    * *steps*: where the outline crosses the top of the cell, the ground to the
      right of the crossing is gained or lost in full height,
    * *floors*: full-width strips for the state at the top left corner, found by
      counting the edges above it along the grid line. Inner cells get only this.

    Every decision "above this grid line or not" is made on the same cut points,
    so the three kinds agree with one another.
    """
    c = f"{float(cell)!r}D"
    cut = _cut_at_columns(edges(shapes, id, geom), cell)

    # Rows of the pieces, and rows under the grid lines k with low <= k*c < high.
    # A line met while rising from the left border belongs to the floor there.
    own = (cut.selectExpr("*", "qy > py as rising", "least(py, qy) as low", "greatest(py, qy) as high")
           .selectExpr("*", f"ceil(high / {c}) - 1 as top_row",
                       f"if(px = x0 and rising, floor(low / {c}), ceil(low / {c}) - 1) as step_row")
           .selectExpr("id", "bottom", "top", "cx", "x0", "sign", "upright", "rising", "px", "py", "qx", "qy", f"""explode(concat(
               if(upright, array(), transform(sequence(least(floor(low / {c}), top_row), top_row),
                  r -> struct(true as piece, r as cy))),
               if((upright and px = x0) or top_row - 1 < step_row, array(), transform(sequence(step_row, top_row - 1),
                  r -> struct(false as piece, r as cy))))) as k""")
           .selectExpr("*", "k.piece as piece", "k.cy as cy", f"k.cy * {c} as y0", f"(k.cy + 1) * {c} as y9",
                       "try_divide(qx - px, qy - py) as run")
           # where the piece meets the bottom and the top of its cell
           .selectExpr("*", "least(greatest(px + (y0 - py) * run, px), qx) as x_y0",
                       "least(greatest(px + (y9 - py) * run, px), qx) as x_y9")
           .selectExpr(
               "id", "cx", "cy",
               "if(piece or upright or rising, sign, -sign) as sign",
               """case when not piece then x_y9
                  when rising then if(py < y0, x_y0, px) else if(py > y9, x_y9, px) end - x0 as xa""",
               f"""case when not piece then x0 + {c}
                  when rising then if(qy > y9, x_y9, qx) else if(qy < y0, x_y0, qx) end - x0 as xb""",
               f"if(piece, least(greatest(py - y0, 0D), {c}), {c}) as ya",
               f"if(piece, least(greatest(qy - y0, 0D), {c}), {c}) as yb", "bottom", "top")
           .where("xa < xb and (ya > 0 or yb > 0)"))

    # For each edge that starts on a vertical grid line, j is the first row it is not above.
    floors = (cut.where("not upright and px = x0")
              .selectExpr("id", "bottom", "top", "cx", "sign", f"if(qy > py, floor(py / {c}), ceil(py / {c}) - 1) as j")
              .selectExpr("id", "bottom", "top", "cx", "j", "sum(sign) over (partition by id, bottom, top, cx order by j desc) as sign",
                          "lead(j) over (partition by id, bottom, top, cx order by j desc) as next")
              .where("next < j and sign <> 0")
              .selectExpr("id", "cx", "explode(sequence(next, j - 1)) as cy", "sign",
                          "0D as xa", f"{c} as xb", f"{c} as ya", f"{c} as yb", "bottom", "top"))
    return own.unionByName(floors)


def area_by(strip_rows: DataFrame, *keys: str) -> DataFrame:
    return strip_rows.groupBy(*keys).agg(F.sum(F.expr("sign * (xb - xa) * (ya + yb) / 2")).alias("area"))


def ground_by(strip_rows: DataFrame, cell: float, *keys: str) -> DataFrame:
    """Areas that are more than the rounding of their own strips."""
    sums = strip_rows.groupBy(*keys).agg(F.sum(F.expr("sign * (xb - xa) * (ya + yb) / 2")).alias("area"), F.sum(F.expr("xb - xa")).alias("wide"))
    return sums.where(f"area > {ROUNDING * cell!r}D * wide").drop("wide")


def _binned(strip_rows: DataFrame, cell: float, own_roles: str, coarse_roles: str) -> DataFrame:
    """Strips dealt by x, so that those far apart in a cell do not meet.

    A cell has bins of ``cell / 2^level``. A strip stands in the one or two bins of
    its width (its own level) and in the bins of all coarser levels around them.
    ``role`` keeps coarse entries of both sides apart.
    """
    c = f"{float(cell)!r}D"
    return (strip_rows
            .selectExpr("*", f"cast(least(greatest(floor(log2({c} / (xb - xa))), 0), {MOST_LEVELS}) as int) as fits")
            .selectExpr("*", "explode(sequence(0, fits)) as level")
            .selectExpr("*", f"{c} / pow(2D, level) as wide")
            .selectExpr("*", "explode(sequence(floor(xa / wide), greatest(floor(xa / wide), ceil(xb / wide) - 1))) as bin",
                        f"if(level = fits, {own_roles}, {coarse_roles}) as roles")
            .selectExpr("*", "explode(roles) as role").drop("fits", "roles"))


def _paired(left: DataFrame, right: DataFrame, right_keys: list[str], cell: float, layers: tuple[int, int]) -> DataFrame:
    """Strips of both sides that share a cell and an x range, with both heights there.

    Of two strips the narrower one is looked up at the level of the wider: role 0
    is the right one at its own level, role 1 the left one. The pair counts in the
    bin where the shared x range begins. Candidates are then in proportion to the
    pairs that do share an x range. Strips of two polygons of which one ends below
    the other add up to nothing and go no further. A merge join: the strips are
    explosions, whose size the planner cannot know, so neither side may be broadcast.
    """
    kept = [k for k in left.columns if k not in STRIP]
    left = _binned(left, cell, "array(0, 1)", "array(0)")
    right = _binned(right, cell, "array(0)", "array(1)")
    right = right.selectExpr(*CELL, *BIN, *right_keys, "sign as r_sign", "xa as r_xa", "xb as r_xb", "ya as r_ya", "yb as r_yb", "bottom as r_bottom", "top as r_top")
    left, right, keys = split_hot(left, right, cell, layers)
    j = left.join(right.hint("merge"), [*keys, *BIN]).where(
        "xa < r_xb and r_xa < xb and bottom < r_top and r_bottom < top and floor(greatest(xa, r_xa) / wide) = bin")
    j = j.selectExpr("*", "greatest(xa, r_xa) as lo", "least(xb, r_xb) as hi",
                     "(yb - ya) / (xb - xa) as slope", "(r_yb - r_ya) / (r_xb - r_xa) as r_slope")
    return j.selectExpr(
        *kept, *right_keys, *CELL, "sign * r_sign as sign", "lo", "hi",
        "greatest(bottom, r_bottom) as bottom", "least(top, r_top) as top",
        "if(lo = xa, ya, ya + slope * (lo - xa)) as l0", "if(hi = xb, yb, ya + slope * (hi - xa)) as l1",
        "if(lo = r_xa, r_ya, r_ya + r_slope * (lo - r_xa)) as r0",
        "if(hi = r_xb, r_yb, r_ya + r_slope * (hi - r_xa)) as r1")


def overlap_by_pair(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str],
                    cell: float, layers: tuple[int, int] = (0, 1)) -> DataFrame:
    """Sums the overlap of two strip tables by the given keys of both.

    A sum within the rounding of its own terms is no ground: heights are exact to
    ``ROUNDING`` of a cell, over the width that the strips of the two share.
    ``layers`` tells which of the maps that ``cell`` was chosen for the two are.
    """
    # integral of min(l, r) = integral of l minus the part where l exceeds r
    part = """sign * (hi - lo) * ((l0 + l1) / 2 - if((l0 - r0) * (l1 - r1) < 0,
        pow(greatest(l0 - r0, l1 - r1), 2) / (2 * (abs(l0 - r0) + abs(l1 - r1))),
        (greatest(l0 - r0, 0D) + greatest(l1 - r1, 0D)) / 2))"""
    j = _paired(left, right, right_keys, cell, layers)
    sums = (j.selectExpr(*left_keys, *right_keys, f"{part} as part", "hi - lo as wide")
            .groupBy(*left_keys, *right_keys).agg(F.sum("part").alias("area"), F.sum("wide").alias("wide")))
    return sums.where(f"area > {ROUNDING * cell!r}D * wide").drop("wide")


def intersect_strips(left: DataFrame, right: DataFrame, right_keys: list[str], cell: float,
                     layers: tuple[int, int] = (0, 1)) -> DataFrame:
    """Strips of the intersection, keyed by both sides, ready to meet a third map."""
    j = _paired(left, right, right_keys, cell, layers)
    kept = [k for k in j.columns if k not in (*CELL, "sign", "lo", "hi", "l0", "l1", "r0", "r1")]
    return (j.selectExpr("*", "if((l0 - r0) * (l1 - r1) < 0, (l0 - r0) / ((l0 - r0) - (l1 - r1)), null) as t")
            .selectExpr(*kept, *CELL, "sign", """explode(if(t is null,
                array(struct(lo as xa, hi as xb, least(l0, r0) as ya, least(l1, r1) as yb)),
                array(struct(lo as xa, lo + t * (hi - lo) as xb, least(l0, r0) as ya, l0 + t * (l1 - l0) as yb),
                      struct(lo + t * (hi - lo) as xa, hi as xb, l0 + t * (l1 - l0) as ya, least(l1, r1) as yb)))) as p""")
            .selectExpr(*kept, *CELL, "sign", "p.*").where("xa < xb and (ya > 0 or yb > 0)"))
