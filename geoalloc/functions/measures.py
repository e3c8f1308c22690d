"""Population, income and density measures.

Division by zero gives null. ``weighted_*`` and the densities are aggregate
columns, to be used inside ``groupBy(...).agg``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoalloc.functions.columns import fixed_order, half_even
from geoalloc.functions.geometry import area
from geoalloc.spec import DISTRICT_LAYOUT, SQKM_PER_SQMI, SQM_PER_SQKM, SQM_PER_SQMI, TRACT_LAYOUT


def add_pop_income(df: DataFrame, pop: str, income: str) -> DataFrame:
    """``TotalPopulation`` and ``TotalIncome``: the average becomes a sum."""
    return df.withColumns({"TotalPopulation": F.col(pop), "TotalIncome": F.col(pop) * F.col(income)})


def add_source_density_terms(df: DataFrame, pop: str = "TotalPopulation", area_km2: str = "SqKm") -> DataFrame:
    """People times km2, and people times log density (0 where nobody lives)."""
    p, a = F.col(pop).cast("double"), F.col(area_km2)
    return df.withColumns({
        "SqKmPop": p * a,
        "PWLogPopPerSqKm": F.when(p > 0, p * F.ln(F.try_divide(p, a))).otherwise(0.0)})


def add_target_area(df: DataFrame, srid: int = 0) -> DataFrame:
    """``SqMiles`` and ``SqKm`` of every shape."""
    m2 = area(F.col("geom"), srid)
    return df.withColumns({"SqMiles": m2 / SQM_PER_SQMI, "SqKm": m2 / SQM_PER_SQKM})


def add_areal_measures(df: DataFrame) -> DataFrame:
    """Income per head and densities from interpolated sums."""
    pop = F.col("TotalPopulation")
    out = {"PerCapitaIncome": F.try_divide(F.col("TotalIncome"), pop),
           "PopPerSqMile": F.try_divide(pop, F.col("SqMiles"))}
    if "PWLogPopPerSqKm" in df.columns:
        out["pwPopPerSqMile"] = F.exp(F.try_divide(F.col("PWLogPopPerSqKm"), pop)) * SQKM_PER_SQMI
    return df.withColumns(out)


def add_district_measures(df: DataFrame, chamber: str | Column, fips: Column | str | int | None = None) -> DataFrame:
    """Finishes a dasymetric district table: per-mile figures, kind, state and column order."""
    if fips is not None:
        value = fips if isinstance(fips, Column) else F.lit(fips)
        df = df.withColumn("StateFIPS", value)
    df = df.withColumns({
        "DistrictType": F.lit(chamber), "StateFIPS": F.col("StateFIPS").cast("string"),
        "SqKmPop": F.col("SqKm") * F.col("TotalPopulation"), "SqMiles": F.col("SqKm") / SQKM_PER_SQMI,
        "PopPerSqMile": F.col("PopPerSqKm") * SQKM_PER_SQMI,
        "pwPopPerSqMile": F.col("pwPopPerSqKm") * SQKM_PER_SQMI})
    return fixed_order(df, DISTRICT_LAYOUT)


def add_tract_measures(df: DataFrame) -> DataFrame:
    """The same for tracts, whose weighted density is the plain one."""
    density = F.try_divide(F.lit(SQKM_PER_SQMI) * F.col("TotalPopulation"), F.col("SqKm"))
    df = df.withColumns({
        "SqKmPop": F.col("SqKm") * F.col("TotalPopulation"), "SqMiles": F.col("SqKm") / SQKM_PER_SQMI,
        "PopPerSqMile": density, "pwPopPerSqMile": density})
    return fixed_order(df, TRACT_LAYOUT)


# --- aggregates over (weight, source values) -------------------------------

def weighted_extensive_sum(cols: Sequence[str], w: str = "rast_wgt") -> list[Column]:
    return [half_even(F.sum(F.col(w) * F.col(f"`{c}`"))).alias(c) for c in cols]


def weighted_population(pop: str, w: str = "rast_wgt") -> Column:
    return F.sum(F.col(w) * F.col(pop))


def weighted_intensive_mean(value: str, pop: str, w: str = "rast_wgt", null_mode: str = "keep") -> Column:
    """Mean by people. A missing value counts its people but adds nothing
    (``keep``), or leaves both sums (``skip``)."""
    wp = F.col(w) * F.col(pop)
    base = wp if null_mode == "keep" else F.when(F.col(value).isNotNull(), wp)
    return F.try_divide(F.sum(wp * F.col(value)), F.sum(base))


def density(pop: str, area_m2: str, w: str = "rast_wgt") -> Column:
    return F.try_divide(weighted_population(pop, w), F.sum(area_m2)) * 1e6


def pop_weighted_log_density(pop: str, area_m2: str, w: str = "rast_wgt") -> Column:
    """Geometric mean density per km2, weighted by people."""
    wp = F.col(w) * F.col(pop)
    term = F.when(wp > 0, wp * F.ln(F.try_divide(wp * 1e6, F.col(area_m2)))).otherwise(0.0)
    return F.exp(F.try_divide(F.sum(term), F.sum(wp)))
