"""The same results in SQL: box arithmetic in place of polygon work."""

from __future__ import annotations

from workload.standins import SQL

KM2 = "1e6::DOUBLE"
MI = "2.58999::DOUBLE"

_OVER = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
_MEET = "a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1"
_SHARE = "a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1"


def _over(name: str, left: str, right: str, lid: str, rid: str, l: str, r: str, also: str = "") -> str:
    return (f"{name} as (select a.{lid} as {l}, b.{rid} as {r}, {KM2} * {_OVER} as area "
            f"from {left} a join {right} b on {_SHARE} {also})")


SAME_STATE = "and a.statefp = b.statefp"
#: Maps whose names repeat in every state.
NAMED = """tgt_an as (select * replace ('R' || (id_0 % 5) as name) from tgt_a),
tgt_bn as (select * replace ('N' || (id_0 % 2) as name) from tgt_b)"""


OVL = _over("ovl", "src_tracts", "tgt_a", "k", "id_0", "src_id", "tgt_id")
OVL_B = _over("ovl_b", "src_tracts", "tgt_b", "k", "id_0", "src_id", "tgt_id")
OVL_R = _over("ovl_r", "src_tracts", "tgt_r", "k", "id_0", "src_id", "tgt_id")
ALLOC = ("alloc as (select src_id, tgt_id, area, area / sum(area) over (partition by src_id) as share from ovl)")
BY_AREA = f"by_area as (select src_id, tgt_id, area, area / (16 * {KM2}) as share from ovl)"

# rasters: developed pixels with their tract, tile extents, pairs
RASTER = f"""
dev as (select pcol, prow from pixels where cls between 20 and 29),
tiles as (select (prow // 16) * 4294967296 + pcol // 16 as rid, pcol // 16 as tx, prow // 16 as ty,
  (pcol // 16) * 16 as c0, max(pcol) + 1 as c1, (prow // 16) * 16 as r0, max(prow) + 1 as r1 from pixels group by 1, 2, 3, 4, 6),
pix as (select s.k, s.geoid, s."AQNFE001" as pop, p.pcol, p.prow from dev p join src_tracts s
  on (p.pcol // 4) * 4 = s.x0 and (p.prow // 4) * 4 = s.y0),
own as (select k, count(*) as n from pix group by k),
src_tiles as (select s.k, s.x0, s.y0, s.x1, s.y1, t.rid, t.c0, t.c1, t.r0, t.r1 from src_tracts s join tiles t
  on s.x0 <= t.c1 and t.c0 <= s.x1 and s.y0 <= t.r1 and t.r0 <= s.y1)"""


def _weights(tgt: str, name: str = "wgt", merged: bool = False, where: str = "true") -> str:
    """Raster weights of the tracts on a map."""
    tiles_sql = ("(select k, x0, y0, x1, y1, min(c0) as c0, max(c1) as c1, min(r0) as r0, max(r1) as r1 from src_tiles "
                 "where rid in (select (prow // 16) * 4294967296 + pcol // 16 from dev) group by 1, 2, 3, 4, 5)"
                 if merged else "src_tiles")
    span = "least(s.{c}1, t.{x}1, s.{x}1) - greatest(s.{c}0, t.{x}0, s.{x}0)"
    w, h = span.format(c="c", x="x"), span.format(c="r", x="y")
    return f"""{name}_env as (select s.k, t.id_0, sum(case when {w} > 0 and {h} > 0 then ({w}) * ({h}) * {KM2} else 0 end) as env
  from {tiles_sql} s join src_tracts z on z.k = s.k join {tgt} t
  on s.x0 <= t.x1 and t.x0 <= s.x1 and s.y0 <= t.y1 and t.y0 <= s.y1 where {where} group by 1, 2),
{name}_both as (select p.k, t.id_0, count(*) as n from pix p join {tgt} t
  on p.pcol >= t.x0 and p.pcol < t.x1 and p.prow >= t.y0 and p.prow < t.y1 group by 1, 2),
{name} as (select e.k as src_id, e.id_0 as tgt_id, coalesce(b.n, 0) as dev_in_both, coalesce(o.n, 0) as dev_in_source,
  coalesce(b.n / o.n, 0) as rast_wgt, coalesce(b.n, 0) * {KM2} as dev_area_m2, e.env as rast_area_m2
  from {name}_env e left join {name}_both b on b.k = e.k and b.id_0 = e.id_0 left join own o on o.k = e.k)"""


# two files: centre and ground of each pixel; the east counts where the west has no pixel around the centre
FILES = f"""
fp as (select case when pcol < 100 then 'west' else 'east' end as filename, case when pcol < 100 then pcol else pcol - 100 end as c, prow as r, cls from pixels),
fpx as (select *, filename = 'west' as w, case when filename = 'west' then c + 0.5 else 90.125 + (c + 0.5) * 1.5 end::double as x,
  case when filename = 'west' then r + 0.5 else 0.125 + (r + 0.5) * 1.5 end::double as y, case when filename = 'west' then 1 else 2.25 end * {KM2} as m2 from fp),
fdev as (select a.* from fpx a left join (select c as wc, r as wr from fpx where w) b on b.wc = floor(a.x)::bigint and b.wr = floor(a.y)::bigint
  where a.cls between 20 and 29 and (a.w or b.wc is null)),
fpix as (select s.k, p.* from fdev p join src_tracts s on floor(p.x / 4)::bigint * 4 = s.x0 and floor(p.y / 4)::bigint * 4 = s.y0),
fown as (select k, sum(m2) as m2 from fpix group by k),
fwgt as (select p.k as src_id, t.id_0 as tgt_id, sum(p.m2) / any_value(o.m2) as rast_wgt, sum(p.m2) as dev_area_m2, 1 as rast_area_m2
  from fpix p join fown o on o.k = p.k join tgt_a t on p.x >= t.x0 and p.x < t.x1 and p.y >= t.y0 and p.y < t.y1 group by 1, 2)"""


def _log_density(area: str) -> str:
    return (f"exp(sum(case when w.rast_wgt * s.\"AQNFE001\" > 0 then w.rast_wgt * s.\"AQNFE001\" * "
            f"ln(w.rast_wgt * s.\"AQNFE001\" * {KM2} / w.{area}) else 0 end) / nullif(sum(w.rast_wgt * s.\"AQNFE001\"), 0))")


def _dasymetric(weights: str, name: str = "das") -> str:
    wp = 'sum(w.rast_wgt * s."AQNFE001")'
    return f"""{name} as (select w.tgt_id, sum(w.dev_area_m2) / {KM2} as dev_km2, sum(w.rast_area_m2) / {KM2} as env_km2,
  trunc(round({wp}, 9))::bigint as pop, {wp} / nullif(sum(w.rast_area_m2), 0) * {KM2} as per_km2,
  {wp} / nullif(sum(w.dev_area_m2), 0) * {KM2} as per_dev_km2, {_log_density('rast_area_m2')} as pw_km2,
  {_log_density('dev_area_m2')} as pw_dev_km2,
  sum(w.rast_wgt * s."AQNFE001" * s."AQRAE001") / nullif({wp}, 0) as income,
  round_even(round(sum(w.rast_wgt * s."AQM4E002"), 9), 0)::bigint as m4,
  round_even(round(sum(w.rast_wgt * s."AQPZE003"), 9), 0)::bigint as pz
  from {weights} w join src_tracts s on s.k = w.src_id group by 1)"""


_DAS_COLS = """round(round(d.dev_km2, 9), 4) as "DevSqKm", d.pop as "TotalPopulation",
  round(round(d.per_km2, 9), 4) as "PopPerSqKm", round(round(d.per_dev_km2, 9), 4) as "PopPerDevSqKm", round(round(d.pw_km2, 9), 4) as "pwPopPerSqKm",
  round(round(d.pw_dev_km2, 9), 4) as "pwPopPerDevSqKm", round(round(d.income, 9), 4) as "PerCapitaIncome", d.m4 as "AQM4E002", d.pz as "AQPZE003" """


def _das_select(tgt: str, size: str) -> str:
    return f"""select t.id_0 as "ID", t.name as "DistrictName", round(round({size}, 9), 4) as "SqKm", {_DAS_COLS}
  from das d join {tgt} t on t.id_0 = d.tgt_id"""


def _district_out(kind: str, tgt: str, das: str) -> str:
    return f"""select t.statefp::varchar as "StateFIPS", '{kind}' as "DistrictType", t.name as "DistrictName",
  d.pop as "TotalPopulation", round(round(d.income, 9), 4) as "PerCapitaIncome",
  round(round(((t.x1 - t.x0) * (t.y1 - t.y0))::double, 9), 4) as "SqKm",
  round(round((t.x1 - t.x0) * (t.y1 - t.y0) / {MI}, 9), 4) as "SqMiles", round(round(d.per_km2 * {MI}, 9), 4) as "PopPerSqMile",
  round(round(d.pw_km2 * {MI}, 9), 4) as "pwPopPerSqMile", round(round(((t.x1 - t.x0) * (t.y1 - t.y0) * d.pop)::double, 9), 4) as "SqKmPop",
  d.m4 as "AQM4E002", d.pz as "AQPZE003" from {das} d join {tgt} t on t.id_0 = d.tgt_id"""


def _pair_sums(m1: str, m2: str, name: str = "pairs", by_state: bool = False) -> str:
    """People in both of two maps, by pixel and by ground; sources need a tile."""
    same, state = ("and a.statefp = b.statefp", "a.statefp as state,") if by_state else ("", "")
    of_state = "n.state," if by_state else ""
    return f"""listed as (select * from src_tracts where k in (select k from src_tiles)),
{name}_near as (select {state} a.id_0 as i, b.id_0 as j, a.name as name_1, b.name as name_2 from {m1} a join {m2} b on {_MEET} {same}
  where a.id_0 in (select a.id_0 from {m1} a join listed b on {_MEET})),
p1 as (select t.id_0 as i, p.k, p.pop, p.pcol, p.prow from pix p join {m1} t
  on p.pcol >= t.x0 and p.pcol < t.x1 and p.prow >= t.y0 and p.prow < t.y1),
d1 as (select i, sum(p1.pop / o.n) as d from p1 join own o using (k) group by 1),
d12 as (select p1.i, t.id_0 as j, sum(p1.pop / o.n) as d from p1 join own o using (k) join {m2} t
  on p1.pcol >= t.x0 and p1.pcol < t.x1 and p1.prow >= t.y0 and p1.prow < t.y1 group by 1, 2),
b1 as (select a.id_0 as i, s.k, s."AQNFE001" as pop, greatest(a.x0, s.x0) as x0, least(a.x1, s.x1) as x1,
  greatest(a.y0, s.y0) as y0, least(a.y1, s.y1) as y1 from {m1} a join listed s
  on a.x0 < s.x1 and s.x0 < a.x1 and a.y0 < s.y1 and s.y0 < a.y1),
a1 as (select i, sum(pop * (x1 - x0) * (y1 - y0) / 16) as a from b1 group by 1),
a12 as (select a.i, b.id_0 as j, sum(a.pop * {_OVER} / 16) as a from b1 a join {m2} b on {_SHARE} group by 1, 2),
{name} as (select {of_state} n.name_1, n.name_2, sum(coalesce(d12.d, 0)) as d_pop_in_s1_s2, sum(coalesce(a12.a, 0)) as a_pop_in_s1_s2,
  sum(coalesce(d1.d, 0)) as d_pop_in_s1, sum(coalesce(a1.a, 0)) as a_pop_in_s1
  from {name}_near n left join d12 on d12.i = n.i and d12.j = n.j left join a12 on a12.i = n.i and a12.j = n.j
  left join d1 on d1.i = n.i left join a1 on a1.i = n.i group by {of_state} n.name_1, n.name_2)"""


_PAIR_COLS = """name_1, name_2, round(round(d_pop_in_s1_s2, 9), 4) as d_pop_in_s1_s2, round(round(a_pop_in_s1_s2, 9), 4) as a_pop_in_s1_s2,
  round(round(d_pop_in_s1, 9), 4) as d_pop_in_s1, round(round(a_pop_in_s1, 9), 4) as a_pop_in_s1"""


def _matrix(m1: str, by_state: bool = False) -> str:
    head, same, by = ("n.statefp as state,", "and p.state = n.statefp", "n.statefp,") if by_state else ("", "", "")
    cells = ", ".join(f"coalesce(sum(case when name_2 = 'R{i}' then round_even(round(d_pop_in_s1_s2, 9), 0)::bigint end), 0)::bigint"
                      f" as \"R{i}\"" for i in range(5))
    return f"""select {head} max(p.name_1) as "NAME", max(round_even(round(d_pop_in_s1, 9), 0)::bigint) as "TotalPopulation", {cells}
  from (select distinct {by.replace("n.", "")} name from {m1}) n left join (select * from pairs where d_pop_in_s1_s2 > 0 or a_pop_in_s1_s2 > 0) p
  on p.name_1 = n.name {same} group by {by} n.name"""


def _assigned(districts: str, chamber: str, kind: str) -> str:
    where = {"congressional": 'not "OneDistrict"', "upper": "true", "lower": 'not "SLDUpperOnly"'}[chamber]
    return f"""select st."StateAbbreviation", lpad(st."StateFIPS"::varchar, 2, '0') as "StateFIPS", '{kind}' as "DistrictType",
  b.id_0::varchar as "DistrictName", a.geoid as "TractGeoId" from src_tracts a join {districts} b on {_SHARE}
  join states st on st."StateFIPS" = b.statefp where st."StateFIPS" < 60 and {where}
  and ({_OVER} < (b.x1 - b.x0) * (b.y1 - b.y0) or {_OVER} = 16) and {_OVER} > 0.16"""


AT_LARGE = """select st."StateAbbreviation", lpad(st."StateFIPS"::varchar, 2, '0') as "StateFIPS", 'Congressional' as "DistrictType",
  '1' as "DistrictName", geoid as "TractGeoId" from src_tracts join states st
  on starts_with(geoid, lpad(st."StateFIPS"::varchar, 2, '0')) where st."OneDistrict" and st."StateFIPS" < 60"""

BLOCKS = r"""blocks as (select geoid20, substr(geoid20, 1, 2) as "StateFIPS", substr(geoid20, 3, 3) as "CountyFIPS",
  substr(geoid20, 6, 6) as "TractId", party_dem, party_rep,
  coalesce(party_oth, 0) + party_grn + party_lib as party_oth, total_reg
  from vf_blocks where regexp_full_match(geoid20, '\d+\w?'))"""
TRACT_SUMS = """select "StateFIPS" || "CountyFIPS" || "TractId" as geoid, "StateFIPS", "CountyFIPS", "TractId",
  sum(party_dem)::bigint as party_dem, sum(party_rep)::bigint as party_rep, sum(party_oth)::bigint as party_oth,
  sum(total_reg)::bigint as total_reg from blocks group by 2, 3, 4"""

# Code numbers of each census group.
_GROUPS = {
    "BG_Population": (1,),
    "S_Male": (2,),
    "S_Female": (26,),
    "A_Under18": (3, 4, 5, 6, 27, 28, 29, 30),
    "A_18To24": (7, 8, 9, 10, 31, 32, 33, 34),
    "A_25To44": (11, 12, 13, 14, 35, 36, 37, 38),
    "A_45To64": (15, 16, 17, 18, 19, 39, 40, 41, 42, 43),
    "A_65AndOver": (20, 21, 22, 23, 24, 25, 44, 45, 46, 47, 48, 49),
    "R_White": (2,),
    "R_Black": (3,),
    "R_Asian": (5,),
    "R_Other": (4, 6, 7, 8, 9, 10),
    "Eth_Hispanic": (3,),
    "Eth_NotHispanic": (2,),
    "E_L9": (3, 4, 5, 6, 20, 21, 22, 23),
    "E_9To12": (7, 8, 9, 10, 24, 25, 26, 27),
    "E_HSGrad": (11, 28),
    "E_AS": (12, 13, 14, 29, 30, 31),
    "E_BA": (15, 32),
    "E_AD": (16, 17, 18, 33, 34, 35),
    "TotalIncome": (1,),
}


def _sum_of(codes: tuple[int, ...], mod: int = 89) -> str:
    return " + ".join(f"(c_custkey * {n}) % {mod}" for n in codes)


GROUPS = "select 'G' || c_custkey as \"GISJOIN\", " + ", ".join(
    f'({_sum_of(v)})::bigint as "{k}"' for k, v in _GROUPS.items()) + " from customer"
CITIZENS = (f"select 'G' || c_custkey as \"GISJOIN\", c_custkey % 1000 as \"T_Population\", "
            f"({_sum_of((4, 6, 15, 17), 83)})::bigint as \"C_U18\", ({_sum_of((9, 11, 20, 22), 83)})::bigint as \"C_O18\" from customer")


def _attribute_job() -> str:
    shown = [g for g in _GROUPS if g != "TotalIncome"]
    people = ["T_Population", "C_U18", "C_O18"]
    sums = ", ".join(f'coalesce(sum(a.share * g."{c}"), 0) as "{c}"' for c in [*_GROUPS])
    sums_t = ", ".join(f'coalesce(sum(a.share * c."{c}"), 0) as "{c}"' for c in people)
    out = ", ".join(f'round(round(e."{c}", 9), 4) as "{c}"' for c in [*shown, *people])
    return f"""with {SQL}, {OVL}, {ALLOC}, groups as ({GROUPS}), citizens as ({CITIZENS}),
est as (select t.id_0, {sums}, {sums_t} from tgt_a t left join alloc a on a.tgt_id = t.id_0
  left join groups g on g."GISJOIN" = 'G' || a.src_id left join citizens c on c."GISJOIN" = 'G' || a.src_id group by 1)
select t.statefp::varchar as "StateFIPS", lpad(t.id_0::varchar, 4, '0') as "CongressionalDistrict", {out},
  round(round((t.x1 - t.x0) * (t.y1 - t.y0) * {KM2} / (1609.34::DOUBLE * 1609.34), 9), 4) as "SqMiles",
  round(round(e."BG_Population" / ((t.x1 - t.x0) * (t.y1 - t.y0) * {KM2} / (1609.34::DOUBLE * 1609.34)), 9), 4) as "PopPerSqMile",
  round(round(e."TotalIncome" / nullif(e."BG_Population", 0), 9), 4) as "PerCapitaIncome"
  from tgt_a t join est e using (id_0) where t.id_0 % 9 <> 0"""


def _aggregate_job() -> str:
    mi2 = f"((t.x1 - t.x0) * (t.y1 - t.y0) * {KM2} / (1609.34::DOUBLE * 1609.34))"
    return f"""with {SQL}, {OVL},
local as (select o.src_id, o.tgt_id, o.area / sum(o.area) over (partition by o.src_id) as share from ovl o
  join src_tracts s on s.k = o.src_id join tgt_a t on t.id_0 = o.tgt_id where s.statefp = t.statefp),
est as (select t.id_0, coalesce(sum(l.share * s."AQNFE001"), 0) as pop,
  coalesce(sum(l.share * coalesce(s."AQNFE001" * s."AQRAE001", 0)), 0) as inc,
  coalesce(sum(l.share * s."AQNFE001" * 16), 0) as kmpop,
  coalesce(sum(l.share * case when s."AQNFE001" > 0 then s."AQNFE001" * ln(s."AQNFE001" / 16) else 0 end), 0) as lg,
  coalesce(sum(l.share * case when s.k % 10 <> 3 then s."AQM4E002" else 0 end), 0) as m4,
  coalesce(sum(l.share * case when s.k % 10 <> 3 then s."AQPZE003" else 0 end), 0) as pz
  from tgt_a t left join local l on l.tgt_id = t.id_0 left join src_tracts s on s.k = l.src_id group by 1)
select t.statefp::bigint as "StateFIPS", 'Congressional' as "DistrictType", t.name as "DistrictName",
  round_even(round(e.pop, 9), 0)::bigint::varchar as "TotalPopulation", printf('%.2f', e.inc / nullif(e.pop, 0)) as "PerCapitaIncome",
  printf('%.2f', ((t.x1 - t.x0) * (t.y1 - t.y0))::double) as "SqKm", printf('%.2f', {mi2}) as "SqMiles",
  printf('%.2f', e.pop / {mi2}) as "PopPerSqMile", printf('%.2f', exp(e.lg / nullif(e.pop, 0)) * {MI}) as "pwPopPerSqMile",
  printf('%.2f', e.kmpop::double) as "SqKmPop", round_even(round(e.m4, 9), 0)::bigint::varchar as "AQM4E002",
  round_even(round(e.pz, 9), 0)::bigint::varchar as "AQPZE003" from tgt_a t join est e using (id_0)"""


def _population_overlaps(comp: str, sel: str, tgt: str = "tgt_a", also: str = "") -> str:
    ovl = _over("ovl", "src_tracts", tgt, "k", "id_0", "src_id", "tgt_id", also)
    return f"""with {SQL}, {NAMED}, {ovl}, {ALLOC}, {_over('ovc', 'src_tracts', comp, 'k', 'id_0', 'src_id', 'c_id', also)},
parts as (select src_id, c_id, 100 * area / sum(area) over (partition by src_id) as share from ovc),
people as (select a.src_id, a.tgt_id, a.share, s."AQNFE001" as n from alloc a join src_tracts s on s.k = a.src_id),
tot as (select tgt_id, sum(n * share) as n from people group by 1),
pair as (select p.tgt_id, q.c_id, sum(q.share * p.n / 100 * p.share) as n from people p join parts q using (src_id) group by 1, 2),
long as (select t.id_0 as tgt_id, t.statefp as state, t.name, c.name as component, trunc(round(coalesce(pair.n, 0), 9))::bigint as pop,
  trunc(round(coalesce(tot.n, 0), 9))::bigint as "TotalPopulation" from {tgt} t left join tot on tot.tgt_id = t.id_0
  left join pair on pair.tgt_id = t.id_0 left join {comp} c on c.id_0 = pair.c_id)
{sel}"""


_Q = "(1 - e2) * (sin(radians({lat})) / (1 - e2 * pow(sin(radians({lat})), 2)) - ln((1 - sqrt(e2) * sin(radians({lat}))) / (1 + sqrt(e2) * sin(radians({lat})))) / (2 * sqrt(e2))) / 2"
_ELL = "ell as (select 6378137.0::DOUBLE as a, (1 / 298.257223563::DOUBLE) * (2 - 1 / 298.257223563::DOUBLE) as e2)"


def _globe(x0: str, y0: str, x1: str, y1: str) -> str:
    lat = "(({y}) * 0.05::DOUBLE + 10)".format
    return (f"a * a * radians(0.4::DOUBLE * (({x1}) - ({x0}))) * "
            f"({_Q.format(lat=lat(y=y1))} - ({_Q.format(lat=lat(y=y0))})) / 1e6")


_RUNS = """runs as (select k as geom_id, (prow // 16) * 4294967296 + pcol // 16 as rid, prow, min(pcol) as c_from, max(pcol) + 1 as c_to
  from (select *, pcol - row_number() over (partition by k, prow order by pcol) as island from pix) group by k, rid, prow, island)"""

HALF = """select 'G' || k as "GISJOIN", "AQNFE001", "AQRAE001", case when k % 10 <> 3 then "AQM4E002" end as "AQM4E002",
  case when k % 10 <> 3 then "AQPZE003" end as "AQPZE003" from src_tracts"""


def build() -> dict[str, str]:
    q = {}

    def add(name, sql, *ctes):
        q[name] = f"with {', '.join([SQL, *ctes])} {sql}"

    add("select_by_pattern", 'select geoid, "AQNFE001", "AQRAE001", "AQM4E002", "AQPZE003" from src_tracts')
    tract_columns = 'geoid, statefp, x0, y0, x1, y1, "AQNFE001", "AQRAE001", "AQM4E002", "AQPZE003"'
    add("read_wide_csv", """select geoid as "GISJOIN", statefp::varchar as statefp, "AQNFE001"::double as "AQNFE001", "AQRAE001"::double as "AQRAE001",
      "AQM4E002"::double as "AQM4E002", "AQPZE003"::double as "AQPZE003" from src_tracts""")
    add("read_state_dictionary", 'select "StateAbbreviation", "StateFIPS"::bigint as "StateFIPS", "OneDistrict", "SLDUpperOnly" from states where "StateFIPS" < 60')
    block_parts = [f"regexp_extract(geoid20, '(\\d{{2}})(\\d{{3}})(\\d{{6}})(\\d{{4}}\\w?)', {i}) as \"{c}\"" for i, c in enumerate(("StateFIPS", "CountyFIPS", "TractId", "BlockId"), 1)]
    # what a file leaves out does not count as another party
    other = "coalesce(party_oth, 0) + case when party_lib in (0, 2) then party_grn else 0 end + case when party_lib in (0, 1) then party_lib else 0 end"
    add("read_voterfile_blocks", f"""select geoid20, {', '.join(block_parts)}, party_dem::bigint as party_dem, party_rep::bigint as party_rep, ({other})::bigint as party_oth,
      total_reg::bigint as total_reg from vf_blocks where regexp_full_match(geoid20, '\\d+\\w?')""")
    add("write_csv_fixed", """select geoid, k::varchar as k, printf('%.2f', "AQNFE001" / 8.0) as eighths, case when "AQRAE001" is not null then "AQRAE001" || '.00' end as income, statefp::bigint as statefp from src_tracts""")
    add("write_map_stats", "select id_0::bigint as id_0, name, statefp::bigint as statefp from tgt_a")
    box = (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))

    def ring(keys, points):
        return " union all ".join(f"select {keys}, {n}::bigint as n, {x} * 1000::DOUBLE as x, {y} * 1000::DOUBLE as y from src_tracts" for n, (x, y) in enumerate(points))

    add("write_geojson", ring("geoid, statefp::bigint as statefp", box))
    add("read_geojson_shapes", ring("geoid, statefp::bigint as statefp", box))
    add("read_shapefile_shapes", f"select geoid, dense_rank() over (partition by statefp order by geoid) as record, n, x, y from ({ring('geoid, statefp', box[::-1])})")
    add("materialize_table", f"select k, {tract_columns} from src_tracts")
    span = "(floor(least(a.{1}, b.{1}) / 16.0) - floor(greatest(a.{0}, b.{0}) / 16.0) + 1)"
    across, up = span.format("x0", "x1"), span.format("y0", "y1")
    add("materialize_cells", f"select a.k, b.id_0, ({across} * {up})::bigint as cells from src_tracts a, tgt_a b where {across} > 0 and {up} > 0")
    add("append_keyed", 'select geoid, statefp, "AQNFE001" from src_tracts')
    add("assert_unique_key", f"select k, {tract_columns} from src_tracts")
    add("skip_if_current", " union all ".join(f"select '{t}' as name, count(*) as rows, true as made, false as none from {t}" for t in ("customer", "supplier", "orders")))
    add("rebuild_stale", """select statefp::bigint as statefp, (sum("AQNFE001") + case when statefp = 7 then count(*) else 0 end)::bigint as people, count(*) as tracts,
      true as run_0, statefp = 7 as run_1 from src_tracts group by statefp""")
    add("validate_common_columns", 'select geoid, statefp, "AQNFE001" from src_tracts')
    add("drop_by_pattern", "select geoid20, party_dem, party_rep, party_oth::bigint as party_oth, total_reg::bigint as total_reg from vf_blocks")
    add("extensive_columns", 'select geoid, "AQM4E002", "AQPZE003" from src_tracts')
    q["derive_census_groups"] = GROUPS
    q["derive_citizen_groups"] = CITIZENS
    add("add_pop_income", 'select geoid, "AQNFE001" as "TotalPopulation", "AQNFE001" * "AQRAE001" as "TotalIncome" from src_tracts')
    add("add_source_density_terms", """select geoid, ("AQNFE001" * 16)::double as "SqKmPop",
      round(round(case when "AQNFE001" > 0 then "AQNFE001" * ln("AQNFE001" / 16) else 0 end, 9), 4) as "PWLogPopPerSqKm" from src_tracts""")
    add("add_district_measures", f"""select statefp::varchar as "StateFIPS", 'StateUpper' as "DistrictType", name as "DistrictName",
      id_0 * 7 + 1 as "TotalPopulation", (id_0 + 1000)::double as "PerCapitaIncome", km::double as "SqKm", round(round(km / {MI}, 9), 4) as "SqMiles",
      round(round((id_0 * 7 + 1) / km * {MI}, 9), 4) as "PopPerSqMile", round(round((id_0 * 7 + 1) / km * 1.5 * {MI}, 9), 4) as "pwPopPerSqMile",
      (km * (id_0 * 7 + 1))::double as "SqKmPop", id_0 * 3 as "AQM4E002"
      from (select *, (x1 - x0) * (y1 - y0) as km from tgt_a)""")
    add("add_tract_measures", f"""select 'S' as "StateAbbreviation", geoid as "TractId", "AQNFE001" as "TotalPopulation",
      "AQRAE001" as "PerCapitaIncome", 16::double as "SqKm", round(round(16 / {MI}, 9), 4) as "SqMiles",
      round(round({MI} * "AQNFE001" / 16, 9), 4) as "PopPerSqMile", round(round({MI} * "AQNFE001" / 16, 9), 4) as "pwPopPerSqMile",
      (16 * "AQNFE001")::double as "SqKmPop", "AQM4E002" from src_tracts""")
    mi2 = f"(16 * {KM2} / (1609.34::DOUBLE * 1609.34))"
    add("add_areal_measures", f"""select geoid, round(round("AQNFE001" * "AQRAE001" / nullif("AQNFE001", 0), 9), 4) as "PerCapitaIncome",
      round(round("AQNFE001" / {mi2}, 9), 4) as "PopPerSqMile", round(round(case when "AQNFE001" > 0 then "AQNFE001" / 16 * {MI} end, 9), 4) as "pwPopPerSqMile"
      from src_tracts""")
    add("add_target_area", f"""select id_0, round(round(m2 / (1609.34::DOUBLE * 1609.34), 9), 4) as "SqMiles", (m2 / 1e6)::double as "SqKm"
      from (select id_0, (x1 - x0) * (y1 - y0) * {KM2} as m2 from tgt_b)""")
    add("attach_state_fips", 'select id_0, 8::bigint as "A", statefp::bigint as "B" from tgt_a')
    add("filter_state", "select geoid from src_tracts where statefp = 7")
    add("filter_territories", "select geoid from src_tracts where statefp < 60")
    add("filter_populated", 'select geoid, "AQNFE001" from src_tracts where "AQNFE001" > 0')
    add("filter_excluded_ids", "select name from tgt_b where name not in ('U1', 'U5', 'U77')")
    add("drop_placeholder_districts", "select id_0, id_0::varchar as code from tgt_a where id_0 % 9 <> 0")
    add("prefix_match", "select geoid from src_tracts where statefp = 3")
    add("valid_block_rows", r"select geoid20 from vf_blocks where regexp_full_match(geoid20, '\d+\w?')")
    pat = r"'(\d{2})(\d{3})(\d{6})(\d{4}\w?)'"
    parts = ", ".join(f"case when regexp_matches(geoid20, {pat}) then regexp_extract(geoid20, {pat}, {i + 1}) end as \"{n}\""
                      for i, n in enumerate(("StateFIPS", "CountyFIPS", "TractId", "BlockId")))
    add("split_geoid", f"select geoid20, {parts} from vf_blocks")
    add("fold_other_parties", """select geoid20, party_dem, party_rep, (coalesce(party_oth, 0) + party_grn + party_lib)::bigint as party_oth,
      total_reg::bigint as total_reg, votes2020::bigint as votes2020, reg_pct::double as reg_pct from vf_blocks""")
    add("round_counts", "select geoid, round_even((k * 2.5)::double, 0)::bigint as even, trunc((k * -1.7)::double)::bigint as cut from src_tracts")
    add("format_numbers", """select geoid, "AQM4E002", round_even((k * 2.5)::double, 0)::bigint::varchar as n,
      printf('%.2f', (k / 8)::double) as m from src_tracts""")
    add("rename_columns", 'select statefp::bigint as "StateFIPS", name as "DistrictName" from tgt_a')

    add("join_attribute_tables", HALF)
    add("join_shapes_with_data", """select 'G' || k as "GISJOIN", "AQM4E002", 16::double as km2 from src_tracts where k % 10 <> 3""")
    add("build_data_geometries", """select "GISJOIN" as gisjoin, s.geoid, s.statefp::bigint as statefp, h."AQM4E002", h."AQPZE003", h."AQNFE001",
      h."AQRAE001", 16::double as km2 from half h join src_tracts s on 'G' || s.k = h."GISJOIN" """, f"half as ({HALF})")
    add("job_build_data_geometries", """select "GISJOIN" as gisjoin, s.geoid, h."AQM4E002", h."AQPZE003", h."AQNFE001", h."AQRAE001"
      from half h join src_tracts s on 'G' || s.k = h."GISJOIN" """, f"half as ({HALF})")
    add("join_states", 'select geoid, "StateAbbreviation", "OneDistrict" from src_tracts join states on "StateFIPS" = statefp')
    add("join_back_measures", 'select src_id, tgt_id, area, s."AQNFE001" from ovl join src_tracts s on s.k = src_id', OVL)
    add("positional_concat", """select t.id_0, t.name, round(round(coalesce(sum(a.share * s."AQM4E002"), 0), 9), 4) as "AQM4E002" from tgt_a t
      left join alloc a on a.tgt_id = t.id_0 left join src_tracts s on s.k = a.src_id group by 1, 2""", OVL, ALLOC)

    meet = f"from src_tracts a join tgt_a b on {_MEET}"
    add("bbox_join", f"select a.k as src_id, b.id_0 as tgt_id {meet}")
    add("spatial_join_intersects", f"select a.k as src_id, b.id_0 as tgt_id {meet}")
    add("spatial_join_overlaps_or_contains", f"""select a.k as src_id, b.id_0 as tgt_id, {KM2} * {_OVER} as area, 16 * {KM2} as src_area
      from src_tracts a join tgt_a b on {_SHARE} where ({_OVER} < (b.x1 - b.x0) * (b.y1 - b.y0) or {_OVER} = 16) and {_OVER} > 0.16""")
    add("intersects_any", f"select distinct a.geoid {meet}")
    add("geometry_predicates", f"""select b.id_0 as tgt_id, a.k as src_id, {KM2} * {_OVER} as area, true as intersects,
      {_OVER} > 0 and {_OVER} < 16 and {_OVER} < (b.x1 - b.x0) * (b.y1 - b.y0) as overlaps, {_OVER} = 16 as contains,
      {_OVER} = (b.x1 - b.x0) * (b.y1 - b.y0) as within from src_tracts a join tgt_b b on {_MEET}""")
    add("overlap_area", "select * from ovl", OVL)
    add("overlap_area_triangles", "select * from ovl", OVL)
    add("overlap_area_dense", "select * from ovl", OVL)
    add("overlap_area_3", f"""select a.i as id_1, a.k as src_id, b.id_0 as id_2, {KM2} * {_OVER} as area from
      (select t.id_0 as i, s.k, greatest(t.x0, s.x0) as x0, least(t.x1, s.x1) as x1, greatest(t.y0, s.y0) as y0, least(t.y1, s.y1) as y1
       from tgt_a t join src_tracts s on t.x0 < s.x1 and s.x0 < t.x1 and t.y0 < s.y1 and s.y0 < t.y1) a join tgt_b b on {_SHARE}""")

    add("sum_all_by_key", TRACT_SUMS, BLOCKS)
    add("job_voterfile_tracts", TRACT_SUMS, BLOCKS)
    j = "from by_area a join src_tracts s on s.k = a.src_id group by 1"
    wp = 'a.share * s."AQNFE001"'
    add("weighted_extensive_sum", f"""select tgt_id, round_even(round(sum(a.share * s."AQM4E002"), 9), 0)::bigint as "AQM4E002",
      round_even(round(sum(a.share * s."AQPZE003"), 9), 0)::bigint as "AQPZE003" {j}""", OVL, BY_AREA)
    add("weighted_population", f"select tgt_id, round(round(sum({wp}), 9), 4) as pop {j}", OVL, BY_AREA)
    add("weighted_intensive_mean", f"""select tgt_id, round(round(sum({wp} * s."AQRAE001") / nullif(sum({wp}), 0), 9), 4) as kept,
      round(round(sum({wp} * s."AQRAE001") / nullif(sum(case when s."AQRAE001" is not null then {wp} end), 0), 9), 4) as skipped {j}""", OVL, BY_AREA)
    add("density", f"select tgt_id, round(round(sum({wp}) / sum(a.area) * {KM2}, 9), 4) as per_km2 {j}", OVL, BY_AREA)
    add("pop_weighted_log_density", f"""select tgt_id, round(round(exp(sum(case when {wp} > 0 then {wp} * ln({wp} * {KM2} / a.area) else 0 end)
      / nullif(sum({wp}), 0)), 9), 4) as pw_per_km2 {j}""", OVL, BY_AREA)

    def spread(cte):
        return ("select t.id_0, " + ", ".join(f'round(round(coalesce(sum(a.share * s."{c}"), 0), 9), 4) as "{c}"' for c in ("AQNFE001", "AQM4E002", "AQPZE003"))
                + f" from tgt_a t left join {cte} a on a.tgt_id = t.id_0 left join src_tracts s on s.k = a.src_id group by 1")
    add("areal_interpolate_extensive", spread("alloc"), OVL, ALLOC)
    add("areal_interpolate_extensive_source_area", spread("by_area"), OVL, BY_AREA)
    add("areal_interpolate_intensive", """select t.id_0, round(round(coalesce(sum(o.area * coalesce(s."AQRAE001", 0)) / sum(o.area), 0), 9), 4) as "AQRAE001",
      round(round(coalesce(sum(o.area * s."AQM4E002") / sum(o.area), 0), 9), 4) as "AQM4E002" from tgt_b t left join ovl_b o on o.tgt_id = t.id_0
      left join src_tracts s on s.k = o.src_id group by 1""", OVL_B)
    add("one_hot_shares", """select src_id, tgt_id as component, round(round(100 * area / sum(area) over (partition by src_id), 9), 4) as share from ovl_b""", OVL_B)
    q["population_overlaps"] = _population_overlaps("tgt_b", "select * exclude (state) from long")
    cells = ", ".join(f"coalesce(sum(case when component = 'R{i}' then pop end), 0)::bigint as \"R{i}\"" for i in range(5))
    q["job_areal_overlaps"] = _population_overlaps("tgt_r", f'select name, "TotalPopulation", {cells} from long group by tgt_id, name, "TotalPopulation"')

    q["job_areal_overlaps_states"] = _population_overlaps(
        "tgt_an", f'select state, name, "TotalPopulation", {cells} from long group by tgt_id, state, name, "TotalPopulation"', "tgt_bn", SAME_STATE)

    add("tile_raster", f"""select t.rid, 'pixels' as filename, (t.c0 * 1000)::double as ulx, (t.r0 * 1000)::double as uly,
      (t.c1 - t.c0)::bigint as cols, (t.r1 - t.r0)::bigint as rows,
      (select string_agg(upper(lpad(to_hex(coalesce(p.cls, 255)), 2, '0')), '' order by g.r, g.c) from
        (select t.r0 + r as r, t.c0 + c as c from range(16) x(r), range(16) y(c) where t.r0 + r < t.r1 and t.c0 + c < t.c1) g
        left join pixels p on p.prow = g.r and p.pcol = g.c) as band from tiles t""", RASTER)
    add("reclass_raster", """select (prow // 16) * 4294967296 + pcol // 16 as rid, prow, count(*) as dev, min(pcol) as first, max(pcol) + 1 as last
      from dev group by 1, 2""", RASTER)
    add("clip_raster_to_geometries", "select geom_id, rid, prow, c_from, c_to from runs", RASTER, _RUNS)
    add("clip_count", "select k as geom_id, count(*) as dev from pix group by 1", RASTER)
    add("clip_developed_area", f"""select k as geom_id, (prow // 16) * 4294967296 + pcol // 16 as rid, count(*) as dev,
      count(*) * {KM2} as dev_area_m2 from pix group by 1, 2""", RASTER)
    add("clip_envelope_area", "select k as src_id, id_0 as tgt_id, env as rast_area_m2 from wgt_env", RASTER, _weights("tgt_a"))
    add("raster_union_by_geom", """select k as geom_id, count(*) as dev, count(distinct (prow // 16) * 4294967296 + pcol // 16) as tiles,
      min(pcol) as c_from, max(pcol) + 1 as c_to, min(prow) as r_from, max(prow) + 1 as r_to from pix group by 1""", RASTER)

    add("raster_weight_by_pair", "select src_id, tgt_id, dev_in_both, dev_in_source, round(round(rast_wgt, 9), 4) as rast_wgt, dev_area_m2, rast_area_m2 from wgt",
        RASTER, _weights("tgt_a"))
    km = "((t.x1 - t.x0) * (t.y1 - t.y0))::double"
    add("dasymetric_interpolate", _das_select("tgt_a", km), RASTER, _weights("tgt_a"), _dasymetric("wgt"))
    add("tile_raster_files", """select t.filename, t.tx, t.ty, case when w then t.tx * 16000 else 90125 + t.tx * 24000 end::double as ulx,
      case when w then t.ty * 16000 else 125 + t.ty * 24000 end::double as uly, case when w then 1000 else 1500 end::double as px_w, t.cols, t.rows,
      (select string_agg(upper(lpad(to_hex(coalesce(p.cls, 255)), 2, '0')), '' order by g.r, g.c) from
        (select t.ty * 16 + r as r, t.tx * 16 + c as c from range(16) x(r), range(16) y(c) where r < t.rows and c < t.cols) g
        left join fp p on p.filename = t.filename and p.r = g.r and p.c = g.c) as band
      from (select filename, any_value(w) as w, c // 16 as tx, r // 16 as ty, max(c % 16) + 1 as cols, max(r % 16) + 1 as rows from fpx group by 1, 3, 4) t""", FILES)
    add("mosaic_clips", """select k as geom_id, case when w then 0 else 1 end::bigint as file, count(*) as dev, sum(m2)::double as dev_area_m2 from fpix group by 1, 2""", FILES)
    add("dasymetric_interpolate_mosaic", f"""select t.id_0 as "ID", t.name as "DistrictName", {km} as "SqKm", round(round(d.dev_km2, 9), 4) as "DevSqKm",
      d.pop as "TotalPopulation", round(round(d.per_dev_km2, 9), 4) as "PopPerDevSqKm", round(round(d.income, 9), 4) as "PerCapitaIncome",
      d.m4 as "AQM4E002", d.pz as "AQPZE003" from tgt_a t join das d on d.tgt_id = t.id_0""", FILES, _dasymetric("fwgt"))
    add("dasymetric_interpolate_nomap", _das_select("tgt_b", "d.env_km2"), RASTER, _weights("tgt_b"), _dasymetric("wgt"))
    add("dasymetric_interpolate_preclipped", _das_select("tgt_a", km), RASTER,
        _weights("tgt_a", merged=True, where='z."AQNFE001" > 0'), _dasymetric("wgt"))
    das2 = [RASTER, _weights("tgt_a", "wa"), _weights("tgt_b", "wb"), _dasymetric("wa", "da"), _dasymetric("wb", "db")]
    add("job_dasymetric_districts", _district_out("Congressional", "tgt_a", "da") + " union all " + _district_out("StateUpper", "tgt_b", "db"), *das2)
    two = [RASTER, _pair_sums("tgt_b", "tgt_a")]
    keep = "where d_pop_in_s1_s2 > {0} or a_pop_in_s1_s2 > {0}"
    add("overlap_sum_by_pair", """select name_1, round(round(sum(d_pop_in_s1_s2), 9), 4) as d_sum, round(round(sum(a_pop_in_s1_s2), 9), 4) as a_sum,
      count(*) as pairs from pairs group by 1""", *two)
    add("dasymetric_overlap_pairs", f"select {_PAIR_COLS} from pairs {keep.format(0)}", *two)
    add("dasymetric_overlap_pairs_v1", f"select {_PAIR_COLS} from pairs", *two)
    add("dasymetric_overlap_pairs_v2", f"select {_PAIR_COLS} from pairs {keep.format(1)} order by name_1", *two)
    add("overlap_matrix", _matrix("tgt_a"), RASTER, _pair_sums("tgt_a", "tgt_r"))
    add("job_sld_cd_overlaps_states", _matrix("tgt_bn", True), NAMED, RASTER, _pair_sums("tgt_bn", "tgt_an", by_state=True))
    add("job_sld_cd_overlaps", _matrix("tgt_b"), RASTER, _pair_sums("tgt_b", "tgt_r"))
    bands = ", ".join(f"coalesce(sum(case when c.name = 'R{i}' then {KM2} * {_OVER} end), 0) as \"R{i}\"" for i in range(5))
    add("pivot_overlaps", f"select a.id_0 as src_id, {bands} from tgt_b a join (select * from tgt_r) b on {_SHARE} join tgt_r c on c.id_0 = b.id_0 group by 1")

    add("tracts_by_district", _assigned("tgt_b", "upper", "StateUpper"))
    add("at_large_tracts", AT_LARGE)
    add("tract_assignment", " union all ".join([AT_LARGE, _assigned("tgt_a", "congressional", "Congressional"),
                                                _assigned("tgt_b", "upper", "StateUpper"), _assigned("tgt_b", "lower", "StateLower")]))
    add("job_tract_assignment", " union all ".join([AT_LARGE, _assigned("tgt_b", "congressional", "Congressional"),
                                                    _assigned("tgt_a", "upper", "StateUpper"), _assigned("tgt_b", "lower", "StateLower")]))
    tm = 'from src_tracts join states on "StateFIPS" = statefp where statefp < 60 and "AQNFE001" > 0'
    add("tract_measures", f"""select "StateAbbreviation", geoid as "TractId", "AQNFE001" as "TotalPopulation", 16::double as "SqKm",
      coalesce("AQRAE001", 0) as "PerCapitaIncome", "AQM4E002", "AQPZE003" {tm}""")
    add("job_tract_measures", f"""select "StateAbbreviation", geoid as "TractId", "AQNFE001" as "TotalPopulation",
      coalesce("AQRAE001", 0) as "PerCapitaIncome", 16::double as "SqKm", round(round(16 / {MI}, 9), 4) as "SqMiles",
      round(round({MI} * "AQNFE001" / 16, 9), 4) as "PopPerSqMile", round(round({MI} * "AQNFE001" / 16, 9), 4) as "pwPopPerSqMile",
      (16 * "AQNFE001")::double as "SqKmPop", "AQM4E002", "AQPZE003" {tm}""")

    add("planar_area", f"select id_0, (x1 - x0) * (y1 - y0) * {KM2} as area from tgt_b")
    add("geodesic_area", f"select geoid, round(round({_globe('x0', 'y0', 'x1', 'y1')}, 9), 4) as km2 from src_tracts, ell", _ELL)
    ov = ("greatest(s.x0, t.x0)", "greatest(s.y0, t.y0)", "least(s.x1, t.x1)", "least(s.y1, t.y1)")
    add("geodesic_overlap_area", f"""select s.k as src_id, t.id_0 as tgt_id, round(round({_globe(*ov)}, 9), 4) as km2 from src_tracts s join tgt_a t
      on s.x0 < t.x1 and t.x0 < s.x1 and s.y0 < t.y1 and t.y0 < s.y1, ell""", _ELL)

    def mx(c):
        return f"round(radians({c} * 0.4::DOUBLE - 140) * a, 3)"

    def my(c):
        return f"round(ln(tan(pi() / 4 + radians({c} * 0.05::DOUBLE + 10) / 2)) * a, 3)"
    add("project", f"select id_0, {mx('x0')} as xmin, {my('y0')} as ymin, {mx('x1')} as xmax, {my('y1')} as ymax from tgt_a, ell", _ELL)
    mid, low, high, left, right = ("(x0 + x1) / 2", "(y0 + y1) / 2"), ("x1", "y0"), ("x1", "y1"), ("x0", "y0"), ("x0", "y1")
    # bow ties fall into their two triangles, each from its least point; boxes stay
    loops = [(True, 0, (left, mid, right, left)), (True, 1, (mid, low, high, mid)), (False, 0, (left, low, high, right, left))]
    add("repair_geometries", " union all ".join(
        f"select k, {tied} as repaired, {poly}::bigint as poly, 0::bigint as ring, {n}::bigint as n, {x} * 1000::DOUBLE as x, {y} * 1000::DOUBLE as y from src_tracts where (k % 5 = 0) = {tied}"
        for tied, poly, points in loops for n, (x, y) in enumerate(points)))
    e = 'select k, {0} * 1000::DOUBLE as ax, {1} * 1000::DOUBLE as ay, {2} * 1000::DOUBLE as bx, {3} * 1000::DOUBLE as "by" from src_tracts'
    sides = [e.format(*c) for c in (("x0", "y0", "x1", "y0"), ("x0", "y1", "x1", "y1"), ("x0", "y0", "x0", "y1"), ("x1", "y0", "x1", "y1"))]
    add("shared_edges", 'select ax, ay, bx, "by", k, count(*) over (partition by ax, ay, bx, "by") as sharers from e', f"e as ({' union all '.join(sides)})")
    corners = (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))

    def every(select, n):
        return " union all ".join(select.format(n=i, x=x, y=y) for i, (x, y) in enumerate(corners[:n]))

    add("project_points", " union all ".join(f"select id_0, {i}::bigint as n, {mx(x)} as x, {my(y)} as y from tgt_a, ell" for i, (x, y) in enumerate(corners)), _ELL)
    add("simplify_points", every("select k, {x} * 1000::DOUBLE as x, {y} * 1000::DOUBLE as y from src_tracts", 4))
    degrees = "round(round({x} * 0.4::DOUBLE - 140, 9), 4) as x, round(round({y} * 0.05::DOUBLE + 10, 9), 4) as y from src_tracts"
    add("to_geojson_points", every("select geoid, {n}::bigint as n, " + degrees, 5))
    add("job_export_geojson_points", every("select geoid, " + degrees, 4))
    add("simplify", f"select k, 5::bigint as points, 16 * {KM2} as area from src_tracts")
    feature = """select 'Feature' as type, 'Polygon' as kind, geoid, "AQRAE001" as income, round(round(x1 * 0.4::DOUBLE - 140, 9), 4) as x,
      round(round(y1 * 0.05::DOUBLE + 10, 9), 4) as y from src_tracts"""
    add("to_geojson_features", feature)
    add("job_export_geojson", "select statefp::bigint as statefp, 'Feature' as type, 'Polygon' as kind, geoid, 5::bigint as points from src_tracts")
    add("collect_features", "select statefp::bigint as statefp, 'FeatureCollection' as type, count(*) as n from tgt_a group by 1")

    add("order_by_name", "select name, id_0 from tgt_b order by name")
    add("first_row", "select rid, (c1 - c0)::bigint as cols, (r1 - r0)::bigint as rows from tiles order by rid limit 1", RASTER)
    add("union_all_frames", " union all ".join(f"select id_0, name, '{t}' as map from {t}" for t in ("tgt_a", "tgt_b", "tgt_r")))
    add("state_selection", " union all ".join(
        f"select '{c}' as chamber, \"StateAbbreviation\" from states where \"StateFIPS\" < 60 and {w}" for c, w in (
            ("congressional", 'not "OneDistrict"'), ("at_large", '"OneDistrict"'), ("upper", "true"),
            ("lower", 'not "SLDUpperOnly"'), ("overlap", 'not "OneDistrict"'))))
    q["job_attribute_table"] = _attribute_job()
    q["job_aggregate_districts"] = _aggregate_job()
    add("job_tract_rasters", """select s.geoid as geom_id, rid, prow, c_from, c_to from runs join src_tracts s on s.k = runs.geom_id
      where s."AQNFE001" > 0""", RASTER, _RUNS)
    return q


ORACLE = build()
