"""Simple areal interpolation: values split by shared ground."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoalloc.functions.columns import quoted, truncated
from geoalloc.functions.geometry import planar_area
from geoalloc.operators.cells import choose_cell
from geoalloc.operators.spatial import on_area_plane, overlap_area

def zero_if_missing(c: Column) -> Column:
    """Null, NaN and infinite values count as 0."""
    v = c.cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v)


def source_shares(weights: DataFrame, src: DataFrame | None = None, src_id: str | None = None) -> DataFrame:
    """``share`` of each source that goes to each target.

    Of the ground a source shares with any target, so that all of it is handed
    out; or, given the sources, of the whole source area. Totals are an ordinary
    sum by source joined back, so one source with very many targets is not
    gathered in one task.
    """
    if src is None:
        total = weights.groupBy("src_id").agg(F.sum("area").alias("total"))
    else:
        total = src.select(F.col(src_id).alias("src_id"), planar_area(F.col("geom")).alias("total"))
    return weights.join(total, "src_id").select(
        "src_id", "tgt_id", (F.col("area") / F.when(F.col("total") == 0, 1.0).otherwise(F.col("total"))).alias("share"))


def _spread(shares: DataFrame, src: DataFrame, src_id: str, cols: Sequence[str]) -> DataFrame:
    """Sum of share times value per target, for all columns in one join and one aggregate."""
    values = src.select(F.col(src_id).alias("src_id"), *[zero_if_missing(c).alias(n) for n, c in zip(cols, quoted(cols))])
    return shares.join(values, "src_id").groupBy("tgt_id").agg(*[F.sum(F.col("share") * c).alias(n) for n, c in zip(cols, quoted(cols))])


def _on_targets(estimates: DataFrame, tgt: DataFrame, tgt_id: str, cols: Sequence[str]) -> DataFrame:
    ids = tgt.select(F.col(tgt_id))
    return ids.join(estimates.withColumnRenamed("tgt_id", tgt_id), tgt_id, "left").na.fill(0.0, list(cols))


def areal_interpolate_extensive(src: DataFrame, tgt: DataFrame, cols: Sequence[str], src_id: str, tgt_id: str,
                                allocate_total: bool = True, srid: int = 0, weights: DataFrame | None = None,
                                cell: float | None = None) -> DataFrame:
    """Counts split over the targets: one row per target, 0 where nothing lands.

    ``allocate_total`` hands out all of a source that touches any target;
    without it the part outside all targets is lost.
    """
    if weights is None:
        weights = overlap_area(src, tgt, src_id, tgt_id, srid=srid, cell=cell)
    shares = source_shares(weights) if allocate_total else source_shares(weights, on_area_plane(src, srid), src_id)
    return _on_targets(_spread(shares, src, src_id, cols), tgt, tgt_id, cols)


def areal_interpolate_intensive(src: DataFrame, tgt: DataFrame, cols: Sequence[str], src_id: str, tgt_id: str,
                                srid: int = 0, weights: DataFrame | None = None,
                                cell: float | None = None) -> DataFrame:
    """Averages weighted by shared ground: one row per target, 0 where nothing lies."""
    if weights is None:
        weights = overlap_area(src, tgt, src_id, tgt_id, srid=srid, cell=cell)
    w = weights.withColumnRenamed("area", "share")
    sums = _spread(w, src.withColumn("__ground", F.lit(1.0)), src_id, [*cols, "__ground"])
    means = sums.select("tgt_id", *[F.try_divide(c, F.col("__ground")).alias(n) for n, c in zip(cols, quoted(cols))])
    return _on_targets(means, tgt, tgt_id, cols)


def same_state(weights: DataFrame, src: DataFrame, tgt: DataFrame, src_id: str, tgt_id: str, src_state: str,
               tgt_state: str, names: tuple[str, str] = ("src_id", "tgt_id")) -> DataFrame:
    """Only pairs inside one state, as if every state were a run of its own."""
    s = src.select(F.col(src_id).alias(names[0]), F.col(src_state).cast("int").alias("s"))
    t = tgt.select(F.col(tgt_id).alias(names[1]), F.col(tgt_state).cast("int").alias("t"))
    return weights.join(s, names[0]).join(t, names[1]).where("s = t").drop("s", "t")


def one_hot_shares(src: DataFrame, components: DataFrame, src_id: str, comp_id: str, srid: int = 0,
                   cell: float | None = None, layers: tuple[int, int] = (0, 1),
                   states: tuple[str, str] | None = None) -> DataFrame:
    """Percent of each source's covered ground that lies in each component.

    Long rows ``src_id, component, share``: what interpolating one 0/100 column
    per component would give, without the columns. With ``states``, the state
    columns of both maps, components of other states do not count.
    """
    w = overlap_area(src, components, src_id, comp_id, ("src_id", "component"), srid, cell, layers)
    if states:
        w = same_state(w, src, components, src_id, comp_id, *states, names=("src_id", "component"))
    ground = w.groupBy("src_id").agg(F.sum("area").alias("ground"))
    return w.join(ground, "src_id").selectExpr("src_id", "component", "100 * area / ground as share")


def population_overlaps(src: DataFrame, components: DataFrame, targets: DataFrame, pop: str, src_id: str,
                        comp_id: str, tgt_id: str, comp_name: str, tgt_name: str, srid: int = 0,
                        cell: float | None = None, states: tuple[str, str, str] | None = None) -> DataFrame:
    """People of each target by component: ``tgt_id, name, component, pop, TotalPopulation``.

    Each source's people are split over the components by ground, and each part
    over the targets by ground; both figures are cut to whole people. With
    ``states``, the state columns of the three maps, all of this happens inside
    each state alone and rows also have the target's ``state``.
    """
    src, components, targets = (on_area_plane(x, srid) for x in (src, components, targets))
    cell = cell or choose_cell(src, components, targets)
    people = src.select(F.col(src_id).alias("src_id"), zero_if_missing(F.col(pop)).alias("people"))
    on_targets = overlap_area(src, targets, src_id, tgt_id, cell=cell, layers=(0, 2))
    if states:
        on_targets = same_state(on_targets, src, targets, src_id, tgt_id, states[0], states[2])
    in_target = source_shares(on_targets).join(people, "src_id")
    parts = one_hot_shares(src, components, src_id, comp_id, cell=cell, layers=(0, 1), states=states and states[:2])
    by_pair = (in_target.withColumnRenamed("share", "in_share").join(parts, "src_id")
               .groupBy("tgt_id", "component").agg(F.sum(F.expr("(share * people / 100) * in_share")).alias("pop")))
    totals = in_target.groupBy("tgt_id").agg(F.sum(F.expr("people * share")).alias("TotalPopulation"))
    state = [F.col(states[2]).alias("state")] if states else []
    names = targets.select(F.col(tgt_id).alias("tgt_id"), F.col(tgt_name).alias("name"), *state)
    comp = components.select(F.col(comp_id).alias("component"), F.col(comp_name).alias("component_name"))
    return (names.join(totals, "tgt_id", "left").join(by_pair, "tgt_id", "left").join(comp, "component", "left")
            .select("tgt_id", *(["state"] if states else []), "name", F.col("component_name").alias("component"),
                    truncated(F.coalesce("pop", F.lit(0.0))).alias("pop"),
                    truncated(F.coalesce("TotalPopulation", F.lit(0.0))).alias("TotalPopulation")))


def pivot_overlaps(pairs: DataFrame, rows: Sequence[str], column: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long pairs to one column per name, zero filled. The names are given, so
    nothing is collected to find them."""
    wide = pairs.groupBy(*rows).pivot(column, list(names)).agg(F.sum(value))
    return wide.na.fill(0, list(names))
