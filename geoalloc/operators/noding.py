"""Ground of tangled outlines, as loops that do not cross themselves.

All rings of a polygon are cut where their edges meet, and every piece is turned so that the
ground (by even and odd) lies to its left. At each point the pieces around it then go in and
out by turns, and one that comes in goes on with the one that holds the same wedge of ground.

* Ring by ring, arcs between points where several strands meet are numbered by prefix sums.
* Along a ring the side of the ground changes where an odd number of other ends lies between
  the two ends of a pass; a prefix sum of these changes and one ray per ring tell the side of
  every arc. Strands on the same ground are thought apart by their number, the one with the
  higher number to the left; they cancel in pairs.
* Loops are found by pointer doubling on the table of arcs: after k rounds an arc knows the
  least arc of the 2^k ahead of it. A loop that touches itself is cut there in a second run.

No ring is ever gathered before its points are put into the resulting row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoalloc.operators import edges as ed
from geoalloc.sources.writers import stored

POLY = ["id", "poly"]
RING = [*POLY, "ring"]
ARC = [*RING, "arc"]
EDGE = [*RING, "i"]
#: Crossings are rounded to this many bits of the largest coordinate, so that those of several edges in one point agree.
GRID_BITS = 42
#: Neighbouring rows whose prefix sum one window works out.
RUN = 4096
#: Polygons of at most so many edges try all pairs of them in place, without a join.
FEW_EDGES = 32


def polygon_edges(shapes: DataFrame, id: str) -> DataFrame:
    """Edges of all rings: ``id, poly, ring, n, i, x1, y1, x2, y2`` with their classes and those of their polygon."""
    polys = shapes.selectExpr(f"`{id}` as id", "posexplode(geom.polys) as (poly, rs)")
    polys = ed.with_classes(polys, "rs").withColumnRenamed("classes", "other")
    polys = polys.selectExpr("*", f"explode(array({_grid('rs')})) as grid")
    rings = polys.selectExpr(*POLY, "least", "other", "grid", "posexplode(rs) as (ring, r)").selectExpr(*RING, "least", "other", "grid", "size(r) - 1 as n", "r")
    each = "posexplode(zip_with(slice(r, 1, n), slice(r, 2, n), (p, q) -> struct(p.x as x1, p.y as y1, q.x as x2, q.y as y2))) as (i, e)"
    return ed.with_class(rings.selectExpr(*RING, "least", "other", "grid", "n", each).selectExpr(*EDGE, "least", "other", "grid", "n", "e.*"))


def edge_meetings(edge_rows: DataFrame) -> DataFrame:
    """Pairs of edges of a polygon that have a point in common besides the joint of neighbours.

    ``cuts`` are the points where the two are to be cut, ``tangled`` says that the polygon needs
    repair: rings that meet themselves, or cross or overlap one another. A hole that touches
    its shell in points is fine.
    """
    e = edge_rows.drop("least")
    return _judged(ed.meeting(e, e, POLY).where("a_ring < b_ring or a_ring = b_ring and a_i < b_i"))


def polygon_meetings(shapes: DataFrame, id: str) -> DataFrame:
    """``edge_meetings`` of all polygons of a map.

    Where no polygon of a shape has more than ``FEW_EDGES`` edges they meet inside their row, all
    against all; other shapes, and those of an id that repeats, go through the bins.
    """
    few = f"coalesce(forall(geom.polys, rs -> size(flatten(rs)) - size(rs) <= {FEW_EDGES}), false)"
    again = stored(shapes.groupBy(F.col(id)).agg(F.count("*").alias("many")).where("many > 1").select(id))
    small, rest = shapes.where(few), shapes.where(f"not {few}")
    if not again.isEmpty():
        rest = rest.unionByName(small.join(again, id, "left_semi").select(*shapes.columns))
        small = small.join(again, id, "left_anti")
    polys = small.where(F.col(id).isNotNull()).selectExpr(f"`{id}` as id", "posexplode(geom.polys) as (poly, rs)")
    each = "transform(slice(r, 1, size(r) - 1), (p, i) -> struct(ring, i, size(r) - 1 as n, p.x as x1, p.y as y1, r[i + 1].x as x2, r[i + 1].y as y2))"
    # exploding a single value keeps it from being worked out again for every pair
    polys = polys.selectExpr(*POLY, f"explode(array({_grid('rs')})) as grid", "rs")
    polys = polys.selectExpr(*POLY, "grid", f"explode(array(flatten(transform(filter(rs, r -> size(r) > 1), (r, ring) -> {each})))) as es")
    pairs = polys.selectExpr(*POLY, "grid", "es", "posexplode(es) as (k, a)").selectExpr(*POLY, "grid", "a", "explode(slice(es, k + 2, size(es))) as b")
    for axis in "xy":
        low, high = ([f"{f}({s}.{axis}1, {s}.{axis}2)" for s in "ab"] for f in ("least", "greatest"))
        pairs = pairs.where(f"{low[0]} <= {high[1]} and {low[1]} <= {high[0]}")
    columns = [f"{s}.{c} as {s}_{c}" for s in "ab" for c in ("ring", "i", "n", "x1", "y1", "x2", "y2")]
    own = _judged(pairs.selectExpr(*POLY, "grid as a_grid", *columns))
    return edge_meetings(polygon_edges(rest, id)).select(own.columns).unionByName(own)


def _grid(rings: str) -> str:
    return f"pow(2D, ceil(log2(array_max(transform(flatten({rings}), p -> greatest(abs(p.x), abs(p.y)))))) - {GRID_BITS})"


def _judged(j: DataFrame) -> DataFrame:
    """Pairs of edges whose boxes meet, with ``cuts`` and ``tangled``; those without a point in common fall out."""
    j = ed.with_turns(j.selectExpr("*", "a_ring = b_ring and (b_i = a_i + 1 or a_i = 0 and b_i = a_n - 1) as joined"))
    j = j.selectExpr("*", "s1 = 0 and s2 = 0 as inline")

    def inside(s, x, y):
        return f"({x} between least({s}_x1, {s}_x2) and greatest({s}_x1, {s}_x2) and {y} between least({s}_y1, {s}_y2) and greatest({s}_y1, {s}_y2))"

    ends = ", ".join(f"if({inside(s, f'{o}_x{k}', f'{o}_y{k}')}, struct({o}_x{k} as x, {o}_y{k} as y), null)" for s, o in ("ab", "ba") for k in (1, 2))
    along = "s3 / (s3 - s4)"
    point = f"""case when s3 = 0 then struct(a_x1 as x, a_y1 as y) when s4 = 0 then struct(a_x2 as x, a_y2 as y)
        when s1 = 0 then struct(b_x1 as x, b_y1 as y) when s2 = 0 then struct(b_x2 as x, b_y2 as y)
        else struct(rint((a_x1 + {along} * (a_x2 - a_x1)) / a_grid) * a_grid as x, rint((a_y1 + {along} * (a_y2 - a_y1)) / a_grid) * a_grid as y) end"""
    j = j.selectExpr("*", f"""case when inline then array_distinct(array_compact(array({ends})))
        when joined then array() when {ed.HAVE_A_POINT} then array({point}) else array() end as cuts""")
    own = "a_ring = b_ring and not joined"
    j = j.where(f"size(cuts) > if(joined, 1, 0)")
    return j.selectExpr("*", f"joined or {own} or size(cuts) > 1 or not inline and signum(s1) * signum(s2) * signum(s3) * signum(s4) > 0 as tangled")


def pieces_of(edge_rows: DataFrame, meetings: DataFrame) -> DataFrame:
    """Edges cut at the given points: ``ring, i, j`` in the order of the ring, from ``px, py`` to ``qx, qy``."""
    def side(s):
        return meetings.selectExpr(*POLY, f"{s}_ring as ring", f"{s}_i as i", f"{s}_x1 as x1", f"{s}_y1 as y1", f"{s}_x2 as x2", f"{s}_y2 as y2", "inline(cuts)")

    cuts = side("a").unionByName(side("b")).where("not (x = x1 and y = y1) and not (x = x2 and y = y2)")
    t = "(x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)"
    nodes = cuts.selectExpr(*EDGE, f"{t} as t", "x", "y", "x2", "y2").distinct()
    nodes = nodes.unionByName(edge_rows.selectExpr(*EDGE, "-1D as t", "x1 as x", "y1 as y", "x2", "y2"))
    order = Window.partitionBy(*EDGE).orderBy("t", "x", "y")
    after = {c: F.coalesce(F.lead(c).over(order), F.col(f"{c}2")) for c in "xy"}
    return nodes.withColumns({"j": F.row_number().over(order), "qx": after["x"], "qy": after["y"]}).selectExpr(*EDGE, "j", "x as px", "y as py", "qx", "qy")


def prefix_sums(df: DataFrame, by: list[str], place: str, order: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of equal ``by`` up to each row, itself included.

    Rows are summed in runs of ``RUN`` of the whole number ``place`` and the runs among one
    another, so a long sequence is no single group.
    """
    df = df.withColumn("__run", F.floor(F.col(place) / RUN))
    totals = df.groupBy(*by, "__run").agg(F.sum(value).alias("__sum"))
    ahead = Window.partitionBy(*by).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, "__run", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__before"), F.sum("__sum").over(Window.partitionBy(*by)).alias("__whole"))
    inside = Window.partitionBy(*by, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("__own", F.sum(value).over(inside)).join(totals, [*by, "__run"])
    return df.withColumn(name, F.col("__before") + F.col("__own")).withColumnRenamed("__whole", f"{name}_total").drop("__run", "__own", "__before")


def with_arcs(pieces: DataFrame) -> DataFrame:
    """Adds ``arc``, the number of the run of pieces between two joints, and ``wrapped`` for its part behind the start of the ring.

    Joints are points where several pieces begin, and the ends of pieces on the same ground (a
    ring may turn back there). Arcs count from 1; a ring without joints is arc 0.
    """
    joints = pieces.groupBy(*POLY, "px", "py").agg(F.count("*").alias("many")).where("many > 1").select(*POLY, "px", "py")
    low = "(px < qx or px = qx and py < qy)"
    same = pieces.selectExpr(*POLY, f"if({low}, struct(px, py), struct(qx as px, qy as py)) as p", f"if({low}, struct(qx as px, qy as py), struct(px, py)) as q")
    same = same.groupBy(*POLY, "p", "q").agg(F.count("*").alias("many")).where("many > 1").selectExpr(*POLY, "inline(array(p, q))")
    joints = joints.unionByName(same).distinct().withColumn("joint", F.lit(1))
    p = pieces.join(joints.hint("merge"), [*POLY, "px", "py"], "left").withColumn("joint", F.coalesce("joint", F.lit(0)))
    p = prefix_sums(p, RING, "i", ["i", "j"], "joint", "count")
    return p.selectExpr(*EDGE, "j", "px", "py", "qx", "qy", "if(count = 0, count_total, count) as arc", "if(count = 0 and count_total > 0, 1, 0) as wrapped")


def arcs_of(pieces: DataFrame) -> DataFrame:
    """One row per arc: its ends, and the points next to them, which give its directions there."""
    at = "struct(wrapped, i, j)"
    first, last = f"min_by(struct(px, py, qx, qy), {at})", f"max_by(struct(px, py, qx, qy), {at})"
    a = pieces.groupBy(*ARC).agg(F.expr(first).alias("f"), F.expr(last).alias("l"), F.count("*").alias("pieces"))
    return a.selectExpr(*ARC, "pieces", "f.px as ax", "f.py as ay", "f.qx as ax1", "f.qy as ay1", "l.qx as bx", "l.qy as by", "l.px as bx1", "l.py as by1")


def ranked_ends(arcs: DataFrame, start: str = "0", end: str = "1") -> DataFrame:
    """Both ends of arcs with joints, ranked by angle around their point: ``x, y, out, rank, around``."""
    def half(x, y, x1, y1, out):
        return arcs.where("arc > 0").selectExpr(*ARC, f"{x} as x", f"{y} as y", f"{x1} as tx", f"{y1} as ty", f"{out} as out")

    h = half("ax", "ay", "ax1", "ay1", start).unionByName(half("bx", "by", "bx1", "by1", end))
    # ends on the same ground: higher numbers lie to the left, seen from the lower point
    h = h.selectExpr("*", "atan2(ty - y, tx - x) as angle", "if(x < tx or x = tx and y < ty, 1, -1) as up")
    order = Window.partitionBy(*POLY, "x", "y").orderBy("angle", F.col("up") * F.col("ring"), F.col("up") * F.col("arc"), "out")
    return h.withColumns({"rank": F.row_number().over(order) - 1, "around": F.count("*").over(Window.partitionBy(*POLY, "x", "y"))}).drop("tx", "ty", "angle", "up")


def above(tests: DataFrame, pieces: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of the tests and ``of`` of each piece above their point ``(mx, my)``, in the same polygon.

    Pieces count by a half-open x range. One on the same ground as the test's own piece
    (``t_ring, t_arc``) lies above it if its number is higher. They meet in bins of the pieces' width.
    """
    p = pieces.selectExpr("*", "px < qx or px = qx and py < qy as ahead")
    p = p.selectExpr(*POLY, "ring as p_ring", "arc as p_arc", "of", "if(ahead, px, qx) as lx", "if(ahead, py, qy) as ly", "if(ahead, qx, px) as hx", "if(ahead, qy, py) as hy").where("lx < hx")
    p = p.withColumn("wide", F.expr("cast(ceil(log2(hx - lx)) as int)"))
    widths = p.select(*POLY, "wide").distinct()
    t = tests.join(widths, POLY).withColumn("bin", F.expr("floor(mx / pow(2D, wide))"))
    p = p.withColumn("bin", F.expr("explode(sequence(floor(lx / pow(2D, wide)), floor(hx / pow(2D, wide))))"))
    j = t.join(p.hint("merge"), [*POLY, "wide", "bin"]).where("lx <= mx and mx < hx").withColumn("y", F.expr("ly + (mx - lx) * ((hy - ly) / (hx - lx))"))
    return j.where("y > my or y = my and (p_ring > t_ring or p_ring = t_ring and p_arc > t_arc)").select(*keys, "of")


def flattest(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """The widest piece of each group and its middle, on the line that ``above`` works out: ``mx, my, ahead, t_ring, t_arc``."""
    p = pieces.groupBy(*keys).agg(F.expr("max_by(struct(ring as t_ring, arc as t_arc, px, py, qx, qy), struct(abs(qx - px), -ring, -i, -j))").alias("t")).selectExpr(*keys, "t.*")
    p = p.selectExpr(*keys, "t_ring", "t_arc", "px < qx as ahead", "if(px < qx, px, qx) as lx", "if(px < qx, py, qy) as ly", "if(px < qx, qx, px) as hx", "if(px < qx, qy, py) as hy")
    p = p.where("lx < hx").withColumn("mx", F.expr("lx + (hx - lx) / 2")).withColumn("my", F.expr("ly + (mx - lx) * ((hy - ly) / (hx - lx))"))
    return p.drop("lx", "ly", "hx", "hy")


def ground_sides(pieces: DataFrame, arcs: DataFrame) -> DataFrame:
    """``side`` of every arc: 1 where the ground lies to the left of its direction, else 0."""
    h = ranked_ends(arcs)
    ends = h.where("out = 1").select(*ARC, F.col("rank").alias("r_in"))
    starts = h.where("out = 0").select(*ARC, F.col("rank").alias("r_out"))
    count = arcs.groupBy(*RING).agg(F.max("arc").alias("arcs"))
    # what changes from an arc to the next one
    passes = ends.join(count, RING).selectExpr(*RING, "arc % arcs + 1 as arc", "r_in").join(starts, ARC)
    changes = passes.selectExpr(*ARC, "if(arc = 1, 0, (r_in + r_out + 1) % 2) as change")
    changes = arcs.select(*ARC).join(changes, ARC, "left").withColumn("change", F.coalesce("change", F.lit(0)))
    changes = prefix_sums(changes, RING, "arc", ["arc"], "change", "sum").select(*ARC, "sum")
    tests = flattest(pieces, RING)
    rays = above(tests, pieces.withColumn("of", F.lit(1)), RING).groupBy(*RING).agg(F.sum("of").alias("over"))
    known = tests.join(rays, RING, "left").selectExpr(*RING, "t_arc", "(coalesce(over, 0) + if(ahead, 0, 1)) % 2 as t_left")
    known = known.join(changes.withColumnsRenamed({"arc": "t_arc", "sum": "t_sum"}), [*RING, "t_arc"])
    return changes.join(known.select(*RING, "t_left", "t_sum"), RING).selectExpr(*ARC, "cast((t_left + sum + t_sum) % 2 as int) as side")


def loops_of(links: DataFrame) -> DataFrame:
    """``loop`` and ``ahead``, the least arc of the loop of each arc and the steps to it, from ``arc_id, next``.

    Pointer doubling: each round every arc looks twice as far along its loop; it ends when
    that brings nothing new. A link that leads nowhere leaves its arc without an answer.
    """
    key = [*POLY, "arc_id"]
    now = stored(links.selectExpr(*key, "next", "arc_id as loop", "0L as ahead", "1L as step", "true as moved"))
    while not now.where("moved").isEmpty():
        far = now.selectExpr(*POLY, "arc_id as next", "next as beyond", "loop as l2", "ahead as a2")
        now = stored(now.join(far.hint("merge"), [*POLY, "next"]).selectExpr(
            *key, "beyond as next", "least(loop, l2) as loop", "if(l2 < loop, step + a2, ahead) as ahead", "step * 2 as step", "l2 != loop as moved"))
    return now.select(*key, "loop", "ahead")


ARC_ID = "ring * 4294967296L + arc"


def untangled(edge_rows: DataFrame, meetings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, poly, part, ring, xs, ys``: closed rings of the ground of the given polygons, and ``id`` of shapes that rounding keeps from being solved.

    ``part`` is the least point of a shell and its number, which comes first in its part (``ring`` sorts the
    others behind it by their least point). Every ring starts at its least point; shells run
    counter-clockwise and holes clockwise.
    """
    pieces = stored(with_arcs(pieces_of(edge_rows, meetings)))
    arcs = stored(arcs_of(pieces))
    arcs = arcs.join(ground_sides(pieces, arcs), ARC)
    # strands on the same ground cancel in pairs; of an odd number the lowest stays
    low = "ax < bx or ax = bx and ay < by"
    stack = Window.partitionBy(*POLY, "single", "x1", "y1", "x2", "y2")
    arcs = arcs.selectExpr("*", f"if(pieces = 1, 0L, {ARC_ID}) as single", f"if({low}, ax, bx) as x1", f"if({low}, ay, by) as y1", f"if({low}, bx, ax) as x2", f"if({low}, by, ay) as y2")
    arcs = arcs.withColumns({"many": F.count("*").over(stack), "least": F.min(F.expr(ARC_ID)).over(stack)})
    arcs = stored(arcs.where(f"many = 1 or many % 2 = 1 and least = {ARC_ID}").selectExpr(*ARC, f"{ARC_ID} as arc_id", "side", "ax", "ay", "ax1", "ay1", "bx", "by", "bx1", "by1"))

    ends = stored(ranked_ends(arcs, "side", "1 - side"))  # out: 1 where the turned arc leaves
    ins = ends.where("out = 0").selectExpr(*POLY, "x", "y", f"{ARC_ID} as arc_id", "pmod(rank - 1, around) as rank")
    outs = ends.where("out = 1").selectExpr(*POLY, "x", "y", f"{ARC_ID} as next", "rank")
    links = ins.join(outs, [*POLY, "x", "y", "rank"], "left").selectExpr(*POLY, "arc_id", "next", "x", "y")
    alone = arcs.where("arc = 0").selectExpr(*POLY, "arc_id", "arc_id as next", "ax as x", "ay as y")
    links = stored(links.unionByName(alone))
    # a piece that nothing takes up, or two that one takes up
    twice = links.groupBy(*POLY, "next").agg(F.count("*").alias("many")).where("many > 1 or next is null")
    lost = stored(twice.select("id").distinct())
    links = links.join(lost, "id", "left_anti")
    loops = loops_of(links)
    # a loop that comes to a point several times is cut there
    visits = links.join(loops, [*POLY, "arc_id"]).withColumn("many", F.count("*").over(Window.partitionBy(*POLY, "loop", "x", "y")))
    visits = stored(visits.where("many > 1"))
    if not visits.isEmpty():
        order = Window.partitionBy(*POLY, "loop", "x", "y").orderBy(F.col("ahead") != 0, F.desc("ahead"))
        last = F.last("next").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        cut = visits.select(*POLY, "arc_id", F.coalesce(F.lag("next").over(order), last).alias("instead"))
        loops = loops_of(links.join(cut, [*POLY, "arc_id"], "left").withColumn("next", F.coalesce("instead", "next")).drop("instead"))

    turned = arcs.join(loops, [*POLY, "arc_id"]).select(*ARC, "side", "loop", "ahead")
    p = pieces.join(turned, ARC).selectExpr(
        *POLY, "loop", "ring", "arc", "i", "j", "px", "py", "qx", "qy", "if(side = 1, px, qx) as x", "if(side = 1, py, qy) as y",
        "struct(ahead != 0 as later, -ahead as ahead, if(side = 1, wrapped, -wrapped) as w, if(side = 1, i, -i) as i, if(side = 1, j, -j) as j) as place")
    p = stored(p)
    rows = p.groupBy(*POLY, "loop").agg(F.expr("transform(sort_array(collect_list(struct(place, x, y))), e -> struct(e.x as x, e.y as y))").alias("pts"), F.expr("min(struct(x, y))").alias("first"))
    rows = rows.where("size(pts) > 2").selectExpr(*POLY, "loop", "first", "cast(array_position(pts, first) as int) as k", "pts")
    rows = rows.selectExpr(*POLY, "loop", "first", "concat(slice(pts, k, size(pts) - k + 1), slice(pts, 1, k)) as pts")
    area = "aggregate(zip_with(slice(pts, 1, size(pts) - 1), slice(pts, 2, size(pts) - 1), (p, q) -> (p.x - first.x) * (q.y - first.y) - (q.x - first.x) * (p.y - first.y)), 0D, (s, v) -> s + v)"
    rows = stored(rows.selectExpr("*", f"{area} as area").where("area <> 0"))
    shells = rows.where("area > 0").selectExpr(*POLY, "loop as of", "area as shell_area", "struct(first, loop) as part")
    holes = rows.where("area < 0").select(*POLY, "loop")
    tests = flattest(p.join(holes, [*POLY, "loop"], "left_semi"), [*POLY, "loop"])
    walls = p.withColumnRenamed("loop", "of").join(shells.select(*POLY, "of"), [*POLY, "of"], "left_semi")
    around = above(tests, walls, [*POLY, "loop"]).groupBy(*POLY, "loop", "of").agg(F.count("*").alias("walls")).where("walls % 2 = 1").join(shells, [*POLY, "of"])
    around = around.groupBy(*POLY, "loop").agg(F.min(F.struct("shell_area", "part")).alias("s")).select(*POLY, "loop", F.col("s.part").alias("part"))
    rows = rows.join(around, [*POLY, "loop"], "left").selectExpr(*POLY, "coalesce(part, struct(first, loop)) as part", "struct(part is not null as hole, first) as ring", "pts.x as xs", "pts.y as ys")
    return rows, lost
