"""Plain records that name the columns a job reads."""

from __future__ import annotations

from dataclasses import dataclass

# Column patterns and key columns of the census tables.
#: Columns matched by this pattern hold census values (``AQNFE001`` and the like).
CENSUS_COLUMNS = r"^[A-Z0-9]+E\d+$"
#: Census columns carried into the district and tract tables.
DISTRICT_COLUMNS = r"A...E\d\d\d"
#: Key columns a census table must have before it is joined to shapes.
COMMON_COLUMNS = ("GISJOIN", "STUSAB", "COUNTY", "COUNTYA", "GEO_ID")

# Population and per-capita income code of each census vintage.
VINTAGES = {
    2012: ("QSPE001", "QWUE001"),
    2014: ("ABA1E001", "ABFIE001"),
    2016: ("AF2LE001", "AF6AE001"),
    2018: ("AJWME001", "AJ0EE001"),
    2020: ("AMPVE001", "AMTCE001"),
    2021: ("AON4E001", "AORME001"),
    2022: ("AQNFE001", "AQRAE001"),
}

# Extensive columns of the two vintages used with land cover.
EXTENSIVE_2020 = r"A[M,N]..E\d\d\d"
EXTENSIVE_2022 = r"A[Q,R]..E\d\d\d"

#: Tracts left out of the per-tract rasters (fixed values).
EXCLUDED_TRACTS = ("02016000100", "02185000200", "15003981200")

SQKM_PER_SQMI = 2.58999
SQM_PER_SQMI = 1609.34 * 1609.34
SQM_PER_SQKM = 1e6


@dataclass(frozen=True)
class InterpolationSpec:
    """Which columns of a source table are weights, averages and counts."""

    pop: str
    intensive: tuple[tuple[str, str], ...] = ()
    extensive_pattern: str = EXTENSIVE_2022
    id: str = "geoid"

    @classmethod
    def for_vintage(cls, year: int, pattern: str = EXTENSIVE_2022, id: str = "geoid"):
        pop, income = VINTAGES[year]
        return cls(pop, ((income, "PerCapitaIncome"),), pattern, id)


@dataclass(frozen=True)
class SourceSpec:
    """One census vintage: its attribute files, shapes and two key columns."""

    pop: str
    income: str
    attribute_files: tuple[str, ...] = ()
    shapes: str = ""
    raster: str = ""

    @classmethod
    def for_vintage(cls, year: int, **files):
        pop, income = VINTAGES[year]
        return cls(pop, income, **files)


@dataclass(frozen=True)
class TargetSpec:
    """A district map: its kind, where it lies and how its columns are called."""

    district_type: str
    name: str = "NAME"
    out_name: str = "DistrictName"
    state: int | str = "STATEFP"
    shapes: str = ""
    out: str = ""
    stats: str = ""


@dataclass(frozen=True)
class Grid:
    """Pixel grid shared by all tiles of a coverage.

    ``x0, y0`` is the outer corner of pixel (0, 0). ``px_h`` is negative for
    north-up rasters. ``tile`` is the tile side in pixels. ``srid`` 4326 makes
    pixel areas spheroidal, anything else planar.
    """

    x0: float
    y0: float
    px_w: float
    px_h: float
    tile: int = 256
    srid: int = 0


# Column order of the written tables.
DISTRICT_LAYOUT = (
    "StateFIPS", "DistrictType", "DistrictName", "TotalPopulation", "PerCapitaIncome",
    "SqKm", "SqMiles", "PopPerSqMile", "pwPopPerSqMile", "SqKmPop",
)
TRACT_LAYOUT = (
    "StateAbbreviation", "TractId", "TotalPopulation", "PerCapitaIncome",
    "SqKm", "SqMiles", "PopPerSqMile", "pwPopPerSqMile", "SqKmPop",
)
MEASURES = ("PerCapitaIncome", "SqKm", "SqMiles", "PopPerSqMile", "pwPopPerSqMile", "SqKmPop")
