"""Test relations derived from the driver tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.session import use_utc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# A synthetic power curve (m/s, W), not a real turbine, and its rated power in kW.
CURVE_POINTS = [
    (0, 0), (3, 20000), (5, 200000), (7, 600000), (9, 1300000), (11, 2100000), (13, 2500000), (20, 2500000), (28, 0),
]
RATED_KW = 2500.0

SQL = {
    "weather_grid": """
        select cell, -50.0e0 + 20.0e0 * (cell % 6) as lat, 60.0e0 * floor(cell / 6.0e0) as lon, t, rsds, tas, uas, vas
        from (select cast(user_id % 36 as int) as cell, date_trunc('hour', ts) as t,
                avg(least(value * 6.0e0, 1200.0e0)) as rsds,
                avg(case when event_id % 50 = 0 then null else 263.15e0 + (event_id % 45) end) as tas,
                avg(cast(event_id % 23 as double) - 11.0e0) as uas,
                avg(cast((event_id * 7) % 19 as double) - 9.0e0) as vas
              from {events} group by 1, 2) g""",
    "weather_gaps": """
        select cell, lat, lon, t, case when hour(t) % 5 = 0 then null else rsds end as rsds, tas,
          case when hour(t) % 7 = 0 then null else uas end as uas, case when hour(t) % 11 = 0 then null else vas end as vas
        from {weather_grid} w""",
    "instant_grid": "select cell, t, tas, uas, vas from {weather_grid} w where hour(t) % 3 = 0",
    "dense_grid": """
        select c.cell, s.t, s.tas + 0.1e0 * c.cell as tas, s.uas - 0.05e0 * c.cell as uas, s.vas + 0.02e0 * c.cell as vas
        from (select distinct cell from {weather_grid} w) c
          cross join (select t, avg(tas) as tas, avg(uas) as uas, avg(vas) as vas from {instant_grid} i group by t) s""",
    "flux_axis": "select distinct cell, t + interval 90 minutes as t from {weather_grid} w where hour(t) % 3 = 0",
    "flux_grid": """
        select cell, lat, lon, t + interval 90 minutes as t, rsds from {weather_grid} w where hour(t) % 3 = 0""",
    "accum_grid": """
        select cell, lat, lon, t, tas, uas, vas,
          sum(rsds * 3600.0e0) over (partition by cell, cast(t - interval 1 hour as date) order by t
            rows between unbounded preceding and current row) as ssrd
        from {weather_grid} w""",
    "accum_months": "select cell, lat, lon, t + interval 20 days as t, tas, uas, vas, ssrd from {accum_grid} a",
    "accum_gap": "select cell, t + case when cell % 2 = 0 and day(t) > 15 then interval 40 days else interval 0 days end as t, ssrd from {accum_grid} a",
    "component_u": """
        select cast(user_id % 36 as int) as cell, 0.5e0 * (user_id % 36) as lat, 1.5e0 * (user_id % 36) as lon,
          date_trunc('hour', ts) as t, avg(cast(event_id % 23 as double) - 11.0e0) as uas
        from {events} e group by 1, 2, 3, 4""",
    "component_v": """
        select cast(user_id % 40 as int) as cell,
          0.5e0 * (user_id % 40) + case when user_id % 40 in (5, 15) then 0.001e0 else 0.0000001e0 end as lat,
          1.5e0 * (user_id % 40) + case when user_id % 40 in (7, 15) then 0.001e0 else 0.0e0 end as lon,
          date_trunc('hour', ts) as t, avg(cast((event_id * 7) % 19 as double) - 9.0e0) as vas
        from {events} e group by 1, 2, 3, 4""",
    "land_mask": "select distinct cell, cell % 3 <> 0 as is_land from {weather_grid} w",
    "cf_daily": """
        select case when l_linestatus = 'O' then 'solar' else 'wind' end as energy, n_name as region, l_suppkey as cell,
          cast(year(l_shipdate) as int) as year, l_shipdate as t, avg(l_discount * 10.0e0) as cf
        from {lineitem} l join {supplier} s on l_suppkey = s_suppkey join {nation} n on s_nationkey = n_nationkey
        group by 1, 2, 3, 4, 5""",
    "daily_mask": "select s_suppkey as cell, s_suppkey % 3 <> 0 as is_land from {supplier} s",
    "region_cells_raw": """
        select l_linenumber as region, round(40.0e0 - 0.1e0 * (l_partkey % 50), 1) as lat,
          round((355.0e0 + 0.1e0 * ((l_suppkey * 37) % 100)) % 360.0e0, 1) as lon,
          avg(l_discount * 10.0e0) as cf, l_linenumber as ord
        from {lineitem} l group by 1, 2, 3, 5""",
    "lattice_cf": """
        select case when l_linestatus = 'O' then 'solar' else 'wind' end as energy,
          cast(500 + l_partkey % 50 as int) as lat_idx, cast((3550 + (l_suppkey * 37) % 100) % 3600 as int) as lon_idx,
          cast(year(l_shipdate) as int) as year, l_shipdate as t, avg(l_discount * 10.0e0) as cf
        from {lineitem} l group by 1, 2, 3, 4, 5""",
    "region_points": """
        select region, lat + 0.03e0 as lat, lon + 0.055e0 as lon, (region * 7 + cast(round(lat * 10.0e0, 0) as int)) % 3 <> 0 as is_land
        from {region_cells_raw} r""",
    "turbine_curves": """
        select p_brand as turbine, p_size * 0.62e0 as ws, avg(p_retailprice * 1000.0e0) as power_w
        from {part} p group by 1, 2""",
    "source_catalog": """
        select distinct region, model, scenario, var, technology,
          case when o_orderkey % 7 < 3 then var || '_3h_bcsd_on_0p1deg_' || region || '_' || model || '_' || scenario || '_' || period || '.nc'
               when o_orderkey % 7 < 5 then var || '_day_' || region || '_' || model || '_' || scenario || '_' || period || '.nc'
               when o_orderkey % 7 = 5 then var || '_x_' || scenario || '_' || region || '_' || period || '.nc'
               else 'other_' || var || '_' || period || '.nc' end as path
        from (select o_orderkey,
                case when o_custkey % 17 = 0 then '_R' else 'R' end || cast(o_custkey % 60 as varchar(10)) ||
                case when o_custkey % 13 = 0 then '_' when o_custkey % 11 = 0 then '_repeated' else '' end as region,
                'M' || cast(o_custkey % 2 as varchar(10)) as model,
                case when o_orderstatus = 'F' then 'ssp126' when o_orderstatus = 'O' then 'ssp245' else 'ssp585' end as scenario,
                case when o_orderkey % 2 = 0 then 'tas' else 'uas' end as var,
                case when o_orderkey % 2 = 0 then 'solar' else 'wind' end as technology,
                case when o_orderkey % 11 = 0 then 'latest'
                     when o_orderkey % 5 = 0 then cast(2015 + o_orderkey % 9 as varchar(10))
                     else cast(2015 + o_orderkey % 3 as varchar(10)) || '-' ||
                          cast(2016 + o_orderkey % 3 + cast(floor(o_totalprice) as bigint) % 90 as varchar(10)) end as period
              from {orders} o) c""",
    "cf_catalog": """
        select distinct region, scenario, technology,
          technology || '_CF_' || region || '_' || model || '_' || scenario || '_' ||
          case when o_orderkey % 3 = 0 then '2015-2060' when o_orderkey % 3 = 1 then '2020-2040' else '2010-2015' end ||
          '_' || cast(o_orderkey % 4 as varchar(10)) || '_allmonths.nc' as path,
          cast(2010 + o_orderkey % 30 as int) as year
        from (select o_orderkey, 'R' || cast(o_custkey % 60 as varchar(10)) as region, 'M' || cast(o_custkey % 2 as varchar(10)) as model,
                case when o_orderstatus = 'F' then 'ssp126' else 'ssp245' end as scenario,
                case when o_orderkey % 2 = 0 then 'solar' else 'wind' end as technology
              from {orders} o) c""",
    "yearly_catalog": """
        select distinct var, gcm, realization, rcm, scenario,
          var || '_NAM-12_' || gcm || '_' || realization || '_1hr_' ||
          case when o_orderkey % 9 = 0 then 'fixed.nc'
               else cast(2015 + o_orderkey % 50 as varchar(10)) || '01010000-' || cast(2015 + o_orderkey % 50 as varchar(10)) || '12312300.nc' end as name
        from (select o_orderkey,
                case when o_orderkey % 3 = 0 then 'uas' when o_orderkey % 3 = 1 then 'vas' else 'tas' end as var,
                case when o_custkey % 10 = 3 then '_G' else 'G' end || cast(o_custkey % 7 as varchar(10)) as gcm,
                'r' || cast(o_custkey % 3 as varchar(10)) || 'i1p1f1' as realization,
                'C' || cast(o_custkey % 2 as varchar(10)) as rcm,
                case when o_orderstatus = 'F' then 'ssp126' when o_orderstatus = 'O' then 'ssp245_' else '_ssp585' end as scenario
              from {orders} o) c""",
    "variable_years": """
        select distinct n_name as region, case when l_linenumber % 3 = 0 then 'rsds' when l_linenumber % 3 = 1 then 'uas' else 'vas' end as var,
          cast(800 + (l_orderkey * 7 + l_suppkey) % 1200 as int) as year
        from {lineitem} l join {supplier} s on l_suppkey = s_suppkey join {nation} n on s_nationkey = n_nationkey""",
}


def parents(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", SQL[name])))


def _closure(names, seen: list[str]) -> list[str]:
    for name in names:
        if name in SQL and name not in seen:
            _closure(parents(name), seen)
            seen.append(name)
    return seen


def with_clause(names) -> str:
    """``with a as (...), b as (...)`` of the relations and what they need, for plain SQL."""
    order = _closure(names, [])
    if not order:
        return ""
    bodies = [f"{n} as ({SQL[n].format(**{p: p for p in parents(n)})})" for n in order]
    return "with " + ",\n".join(bodies) + "\n"


class Data:
    """Driver tables and test relations as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = use_utc(spark), folder
        self._known: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        local = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in local}) if local else df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            if name in SQL:
                inputs = {p: getattr(self, p) for p in parents(name)}
                self._known[name] = self.spark.sql(SQL[name], **inputs)
            elif name in TABLES:
                self._known[name] = self._table(name)
            else:
                raise AttributeError(name)
        return self._known[name]
