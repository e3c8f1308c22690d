"""Which tract lies in which district."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoalloc.functions.columns import extensive_columns, quoted, state_code
from geoalloc.functions.geometry import BOX, area
from geoalloc.operators.spatial import spatial_join_overlaps_or_contains
from geoalloc.operators.tables import (
    filter_populated, filter_territories, join_states, state_selection, union_all_frames,
)
from geoalloc.spec import InterpolationSpec

COLUMNS = ("StateAbbreviation", "StateFIPS", "DistrictType", "DistrictName", "TractGeoId")


def _state_districts(districts: DataFrame, states: DataFrame, district_type: str, district_id: str, state: str) -> DataFrame:
    """The districts of the given states, keyed by kind, state and district."""
    d = join_states(districts.select(F.col(district_id).alias("district"), F.col(state).alias("__state"), "geom", *BOX),
                    states, "__state")
    key = F.struct(F.lit(district_type).alias("kind"), "StateFIPS", "StateAbbreviation", "district")
    return d.select(key.alias("key"), "geom", *BOX)


def _assigned(tracts: DataFrame, keyed: DataFrame, tract_id: str, min_ratio: float, cell: float | None) -> DataFrame:
    pairs = spatial_join_overlaps_or_contains(tracts, keyed, tract_id, "key", min_ratio, cell=cell)
    return pairs.select(
        F.col("tgt_id.StateAbbreviation"), state_code("tgt_id.StateFIPS").alias("StateFIPS"),
        F.col("tgt_id.kind").alias("DistrictType"), F.col("tgt_id.district").cast("string").alias("DistrictName"),
        F.col("src_id").alias("TractGeoId"))


def tracts_by_district(tracts: DataFrame, districts: DataFrame, states: DataFrame, district_type: str,
                       tract_id: str = "geoid", district_id: str = "id_0", state: str = "statefp",
                       min_ratio: float = 0.01, cell: float | None = None) -> DataFrame:
    """Districts of the given states with the tracts that lie in them by more than 1 %.

    One job for all states: the state rides on the district map.
    """
    return _assigned(tracts, _state_districts(districts, states, district_type, district_id, state), tract_id, min_ratio, cell)


def at_large_tracts(tracts: DataFrame, states: DataFrame, tract_id: str = "geoid") -> DataFrame:
    """All tracts of the given one-district states, by the state prefix of the id."""
    s = states.select("StateAbbreviation", state_code("StateFIPS").alias("StateFIPS"))
    t = tracts.select(F.col(tract_id).alias("TractGeoId"), F.substring(tract_id, 1, 2).alias("StateFIPS"))
    return t.join(s, "StateFIPS").select(
        "StateAbbreviation", "StateFIPS", F.lit("Congressional").alias("DistrictType"),
        F.lit("1").alias("DistrictName"), "TractGeoId")


def tract_assignment(tracts: DataFrame, states: DataFrame, congressional: DataFrame, upper: DataFrame,
                     lower: DataFrame, tract_id: str = "geoid", district_id: str = "id_0",
                     state: str = "statefp", cell: float | None = None) -> DataFrame:
    """At-large, congressional, upper and lower house assignments in one list.

    The three maps go through a single spatial join.
    """
    maps = ((congressional, "congressional", "Congressional"), (upper, "upper", "StateUpper"), (lower, "lower", "StateLower"))
    keyed = union_all_frames([_state_districts(d, state_selection(states, chamber), kind, district_id, state)
                              for d, chamber, kind in maps])
    return union_all_frames([at_large_tracts(tracts, state_selection(states, "at_large"), tract_id),
                             _assigned(tracts, keyed, tract_id, 0.01, cell)]).select(*COLUMNS)


def tract_measures(tracts: DataFrame, states: DataFrame, spec: InterpolationSpec, srid: int = 0,
                   state: str = "statefp") -> DataFrame:
    """Populated tracts of the states with area, averages (0 where missing) and counts."""
    cols = extensive_columns(tracts, spec)
    t = filter_populated(filter_territories(tracts, state), spec.pop)
    return join_states(t, states, state).select(
        "StateAbbreviation", F.col(spec.id).alias("TractId"), F.col(spec.pop).alias("TotalPopulation"),
        (area(F.col("geom"), srid) * 1e-6).alias("SqKm"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(n) for c, n in spec.intensive], *quoted(cols))
