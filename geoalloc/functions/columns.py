"""Choosing, deriving, rounding and formatting columns of wide tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoalloc.spec import COMMON_COLUMNS, DISTRICT_COLUMNS, InterpolationSpec

_MODES = {"match": re.match, "fullmatch": re.fullmatch, "search": re.search}


def matching(columns: Iterable[str], pattern: str, mode: str = "match") -> list[str]:
    """Names that match from the start, as a whole, or anywhere."""
    test = _MODES[mode]
    return [c for c in columns if test(pattern, c)]


def quoted(names: Iterable[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def select_by_pattern(df: DataFrame, pattern: str, mode: str = "match", keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*quoted(keep), *quoted(c for c in matching(df.columns, pattern, mode) if c not in keep))


def drop_by_pattern(df: DataFrame, pattern: str, mode: str = "search") -> DataFrame:
    return df.drop(*matching(df.columns, pattern, mode))


def fixed_order(df: DataFrame, first: Sequence[str], pattern: str = DISTRICT_COLUMNS) -> DataFrame:
    """The named columns, then every column whose whole name matches."""
    return df.select(*quoted(first), *quoted(c for c in matching(df.columns, pattern, "fullmatch") if c not in first))


def extensive_columns(df: DataFrame, spec: InterpolationSpec, compat: bool = False) -> list[str]:
    """Count columns, sorted, without the population.

    The averaged columns are left out although the pattern may match them;
    ``compat`` keeps them in.
    """
    out = {spec.pop} if compat else {spec.pop, *(c for c, _ in spec.intensive)}
    return sorted(c for c in matching(df.columns, spec.extensive_pattern) if c not in out)


def validate_common_columns(df: DataFrame, required: Sequence[str] = COMMON_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"data table lacks common columns: {', '.join(missing)}")
    return df


# Census codes that make up each group, as prefix and code numbers.
CENSUS_GROUPS = {
    "BG_Population": ("JLZE", (1,)),
    "S_Male": ("JLZE", (2,)),
    "S_Female": ("JLZE", (26,)),
    "A_Under18": ("JLZE", (3, 4, 5, 6, 27, 28, 29, 30)),
    "A_18To24": ("JLZE", (7, 8, 9, 10, 31, 32, 33, 34)),
    "A_25To44": ("JLZE", (11, 12, 13, 14, 35, 36, 37, 38)),
    "A_45To64": ("JLZE", (15, 16, 17, 18, 19, 39, 40, 41, 42, 43)),
    "A_65AndOver": ("JLZE", (20, 21, 22, 23, 24, 25, 44, 45, 46, 47, 48, 49)),
    "R_White": ("JMBE", (2,)),
    "R_Black": ("JMBE", (3,)),
    "R_Asian": ("JMBE", (5,)),
    "R_Other": ("JMBE", (4, 6, 7, 8, 9, 10)),
    "Eth_Hispanic": ("JMKE", (3,)),
    "Eth_NotHispanic": ("JMKE", (2,)),
    "E_L9": ("JN9E", (3, 4, 5, 6, 20, 21, 22, 23)),
    "E_9To12": ("JN9E", (7, 8, 9, 10, 24, 25, 26, 27)),
    "E_HSGrad": ("JN9E", (11, 28)),
    "E_AS": ("JN9E", (12, 13, 14, 29, 30, 31)),
    "E_BA": ("JN9E", (15, 32)),
    "E_AD": ("JN9E", (16, 17, 18, 33, 34, 35)),
    "TotalIncome": ("JQLE", (1,)),
}
# Citizen counts of the tract tables.
CITIZEN_GROUPS = {"C_U18": ("JWBE", (4, 6, 15, 17)), "C_O18": ("JWBE", (9, 11, 20, 22))}
TRACT_POPULATION = {"T_Population": ("JMAE", (1,))}


def derive_groups(df: DataFrame, mapping: Mapping[str, tuple[str, Sequence[int]]], keep: Sequence[str] = ()) -> DataFrame:
    """Sums of code columns; a missing term makes the sum missing."""
    def total(prefix, codes):
        first, *rest = (F.col(f"{prefix}{n:03d}") for n in codes)
        for c in rest:
            first = first + c
        return first
    return df.select(*quoted(keep), *[total(p, ns).alias(name) for name, (p, ns) in mapping.items()])


def derive_census_groups(df: DataFrame, keep: Sequence[str] = ("GISJOIN",), compat: bool = False) -> DataFrame:
    """Sex, age, race, ethnicity and schooling groups of a block-group table.

    ``compat`` counts code 028 a second time among the bachelors, where the
    layout has 032.
    """
    mapping = {**CENSUS_GROUPS, "E_BA": ("JN9E", (15, 28))} if compat else CENSUS_GROUPS
    return derive_groups(df, mapping, keep)


def derive_citizen_groups(df: DataFrame, keep: Sequence[str] = ("GISJOIN",)) -> DataFrame:
    mapping = {k: v for k, v in {**TRACT_POPULATION, **CITIZEN_GROUPS}.items() if f"{v[0]}{v[1][0]:03d}" in df.columns}
    return derive_groups(df, mapping, keep)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def attach_state_fips(df: DataFrame, fips: int | str, name: str = "STATEFP") -> DataFrame:
    """A number becomes a constant column, a name an existing column."""
    return df.withColumn(name, F.lit(fips) if isinstance(fips, int) else F.col(fips))


def state_code(col: str | Column) -> Column:
    """State number as two digits of text."""
    return F.lpad((F.col(col) if isinstance(col, str) else col).cast("string"), 2, "0")


# --- rounding and text -----------------------------------------------------

def settled(c: Column) -> Column:
    """A sum with its summation noise removed, so that a rounding step after it
    does not depend on the order in which Spark added up the rows."""
    return F.round(c.cast("double"), 9)


def half_even(c: Column) -> Column:
    return F.rint(settled(c)).cast("bigint")


def truncated(c: Column) -> Column:
    return settled(c).cast("bigint")


def round_counts(df: DataFrame, cols: Sequence[str], mode: str = "half_even") -> DataFrame:
    """Whole numbers by ``half_even`` or ``truncate``."""
    fn = {"half_even": half_even, "truncate": truncated}[mode]
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in cols})


def fixed(c: Column, decimals: int) -> Column:
    """A double as text with so many decimals, rounded by its exact binary value
    (a true tie goes to the even digit), where ``format_string`` alone would round
    the shortest decimal form up."""
    scale = float(10 ** decimals)
    scaled = c * scale
    # what the product lost: the upper half of the digits multiplies without loss
    upper = c * 134217729.0 - (c * 134217729.0 - c)
    lost = (upper * scale - scaled) + (c - upper) * scale
    tie = F.abs(scaled - F.rint(scaled)) == 0.5
    whole = F.when(tie & (lost > 0), F.ceil(scaled).cast("double")).when(
        tie & (lost < 0), F.floor(scaled).cast("double")).otherwise(F.rint(scaled))
    return F.when(c.isNotNull(), F.format_string(f"%.{decimals}f", whole / scale))


def format_numbers(df: DataFrame, count_cols: Sequence[str], measure_cols: Sequence[str]) -> DataFrame:
    """Counts as whole numbers in text (whole columns stay as they are), measures with two decimals."""
    kinds = dict(df.dtypes)
    out = {c: half_even(F.col(f"`{c}`")).cast("string") for c in count_cols if kinds[c] in ("double", "float")}
    out.update({c: fixed(F.col(f"`{c}`").cast("double"), 2) for c in measure_cols})
    return df.withColumns(out)
