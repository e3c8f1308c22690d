"""Filters, joins and sums of attribute tables: no geometry involved."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoalloc.functions.columns import drop_by_pattern, matching, quoted, select_by_pattern, validate_common_columns
from geoalloc.spec import COMMON_COLUMNS

# Voter-file column patterns and the parts of a block id.
PARTIES_KEPT = r"^party_(dem|rep|oth)"
VOTER_COLUMNS_DROPPED = (r"^(\w*2020|\w*2021|cg|[p,s]*\d.*|\w*pct|languages|commercial|absentee|eth2"
                         r"|party_(?!dem|rep|oth))")
BLOCK_ID = r"^\d+\w?$"
BLOCK_PARTS = r"(\d{2})(\d{3})(\d{6})(\d{4}\w?)"
BLOCK_PART_NAMES = ("StateFIPS", "CountyFIPS", "TractId", "BlockId")
#: The district of Columbia has seats in neither state house.
NO_STATE_HOUSE = "DC"


# --- filters ---------------------------------------------------------------

def filter_state(df: DataFrame, fips: int, col: str = "statefp") -> DataFrame:
    """One state's rows; state codes may be numbers or padded text."""
    return df.where(F.col(col).cast("int") == fips)


def filter_territories(df: DataFrame, col: str = "statefp") -> DataFrame:
    return df.where(F.col(col).cast("int") < 60)


def filter_populated(df: DataFrame, pop: str) -> DataFrame:
    return df.where(F.col(pop).isNotNull() & (F.col(pop) > 0))


def filter_excluded_ids(df: DataFrame, col: str, ids: Sequence[str]) -> DataFrame:
    return df.where(~F.col(col).isin(*ids))


def drop_placeholder_districts(df: DataFrame, col: str, code: str = "ZZ") -> DataFrame:
    """Removes placeholder districts; to be done after interpolation, so that
    they still take their share. Rows without a name stay."""
    return df.where(F.col(col).isNull() | (F.col(col) != code))


def prefix_match(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.where(F.col(col).startswith(prefix))


# --- joins -----------------------------------------------------------------

def join_attribute_tables(dfs: Sequence[DataFrame], key: str = "GISJOIN") -> DataFrame:
    """The last table, left-joined with the others in order on ``key``."""
    if not dfs:
        raise ValueError("no attribute tables given")
    *others, base = dfs
    return reduce(lambda left, right: left.join(right, key, "left"), others, base)


def join_shapes_with_data(shapes: DataFrame, data: DataFrame, key: str = "GISJOIN") -> DataFrame:
    return shapes.join(data, key, "inner")


def build_data_geometries(shapes: DataFrame, tables: Sequence[DataFrame], key: str = "GISJOIN",
                          shape_key: str = "gisjoin", pattern: str = r"[A-Z\d]+E\d\d\d",
                          required: Sequence[str] = COMMON_COLUMNS) -> DataFrame:
    """Shapes left-joined with the census columns of every data table."""
    out = shapes
    for i, table in enumerate(tables):
        view = select_by_pattern(validate_common_columns(table, required), pattern, keep=[key])
        join_key = f"__key{i}"
        out = out.join(view.withColumnRenamed(key, join_key), F.col(shape_key) == F.col(join_key), "left").drop(join_key)
    return out


def join_states(df: DataFrame, states: DataFrame, col: str = "statefp") -> DataFrame:
    """Rows of known states with the state columns.

    No hint: the planner sees how small the dictionary is and broadcasts it.
    """
    return df.join(states, df[col].cast("int") == states["StateFIPS"], "inner")


def join_back_measures(weights: DataFrame, data: DataFrame, src_id: str, data_id: str) -> DataFrame:
    """Narrow weights joined with the wide source columns, late."""
    return weights.join(data.withColumnRenamed(data_id, src_id), src_id, "inner")


def positional_concat(targets: DataFrame, estimates: DataFrame, id: str, est_id: str) -> DataFrame:
    """Puts keys and areas back beside the estimates: by id, one row per target."""
    return targets.join(estimates.withColumnRenamed(est_id, id), id, "left")


# --- sets, order -----------------------------------------------------------

def union_all_frames(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def order_by_name(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.col(col).asc())


def first_row(df: DataFrame, *order: str) -> DataFrame:
    """One row, the first in a stated order."""
    return df.orderBy(*order).limit(1)


def state_selection(states: DataFrame, chamber: str) -> DataFrame:
    """States with work to do for a chamber.

    ``congressional`` and ``overlap``: more than one district; ``at_large``: one
    district; ``upper``: all but DC; ``lower``: those of them with a lower house.
    """
    s = states.where("StateFIPS < 60")
    if chamber in ("congressional", "overlap"):
        return s.where("not OneDistrict")
    if chamber == "at_large":
        return s.where("OneDistrict")
    if chamber == "upper":
        return s.where(F.col("StateAbbreviation") != NO_STATE_HOUSE)
    if chamber == "lower":
        return s.where((F.col("StateAbbreviation") != NO_STATE_HOUSE) & ~F.col("SLDUpperOnly"))
    raise ValueError(f"unknown chamber: {chamber}")


# --- voter file ------------------------------------------------------------

def valid_block_rows(df: DataFrame, col: str = "geoid20") -> DataFrame:
    return df.where(F.col(col).rlike(BLOCK_ID))


def split_geoid(df: DataFrame, col: str = "geoid20") -> DataFrame:
    """State, county, tract and block parts of a block id; null where it is too short."""
    parts = {n: F.when(F.col(col).rlike(BLOCK_PARTS), F.regexp_extract(col, BLOCK_PARTS, i + 1))
             for i, n in enumerate(BLOCK_PART_NAMES)}
    return df.withColumns(parts)


def fold_other_parties(df: DataFrame, keep: str = PARTIES_KEPT) -> DataFrame:
    """Small parties added to ``party_oth``; missing counts are 0."""
    others = [c for c in matching(df.columns, r"party_") if c not in matching(df.columns, keep, "search")]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in quoted(["party_oth", *others])])
    return df.withColumn("party_oth", total).drop(*others)


def clean_blocks(df: DataFrame, key: str = "geoid20") -> DataFrame:
    """Voter-file blocks: parties folded, columns dropped, ids checked and split, key first."""
    out = split_geoid(valid_block_rows(drop_by_pattern(fold_other_parties(df), VOTER_COLUMNS_DROPPED), key), key)
    data = [c for c in out.columns if c not in (key, *BLOCK_PART_NAMES)]
    return out.select(key, *BLOCK_PART_NAMES, *quoted(data))


def sum_all_by_key(df: DataFrame, keys: Sequence[str] = BLOCK_PART_NAMES[:3],
                   id_parts: Sequence[str] = BLOCK_PART_NAMES, key: str = "geoid20") -> DataFrame:
    """Sums every count by the keys; ``geoid`` is the keys in one piece."""
    data = [c for c in df.columns if c not in (*id_parts, key)]
    out = df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in zip(data, quoted(data))])
    return out.select(F.concat(*keys).alias("geoid"), *keys, *quoted(data))
