"""Lattice, regions, mosaic, annual means, diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridyield.checks.cases_kernels import WEATHER_SQL, knots, solar_sql, weather_rows, wind_sql
from gridyield.checks.registry import case
from gridyield.checks.relations import RATED_KW
from gridyield.functions import geo
from gridyield.operators import diagnostics, filters, mosaic, regions, snapping
from gridyield.plans import annual, comparison, maps

LATTICE_SQL = """select region, lat, lon, cf, ord, cast(round_even((90.0e0 - lat) / 0.1e0, 0) as int) as lat_idx,
    cast(round_even(lon / 0.1e0, 0) as int) % 3600 as lon_idx from region_cells_raw"""


def lattice(d):
    return snapping.add_lattice_index(d.region_cells_raw)


# --- lattice ------------------------------------------------------------------------------------------------

@case("region_grid_extract", "region_cells_raw", "#region ~lat ~lon", "select distinct region, lat, lon from region_cells_raw")
def _(d):
    return snapping.region_grid(d.region_cells_raw)


@case("lattice_index", "region_cells_raw", "#region ~lat ~lon #lat_idx #lon_idx on_lattice", """
    select region, lat, lon, lat_idx, lon_idx,
      abs(90.0e0 - lat_idx / 10.0e0 - lat) <= 0.001e0 and abs(lon_idx / 10.0e0 - lon) <= 0.001e0 as on_lattice
    from (select region, lat, lon, cast(round_even((90.0e0 - lat) / 0.1e0, 0) as int) as lat_idx,
            cast(round_even(lon / 0.1e0, 0) as int) % 3600 as lon_idx
          from (select region, lat + case when region = 3 then 0.02e0 else 0.0e0 end as lat, lon from region_cells_raw) y) x""")
def _(d):
    lat = F.col("lat") + F.when(F.col("region") == 3, 0.02).otherwise(0.0)
    return snapping.add_lattice_index(d.region_cells_raw.withColumn("lat", lat))


NEAREST_SQL = """
    select region, lat, lon, is_land, 900 - la as gi_lat, least(lo, 3599) as gi_lon from (
      select *, case when abs(lat - floor(lat * 10.0e0) / 10.0e0) <= abs(lat - (floor(lat * 10.0e0) + 1.0e0) / 10.0e0)
          then cast(floor(lat * 10.0e0) as int) else cast(floor(lat * 10.0e0) as int) + 1 end as la,
        case when abs(w - floor(w * 10.0e0) / 10.0e0) <= abs(w - (floor(w * 10.0e0) + 1.0e0) / 10.0e0)
          then cast(floor(w * 10.0e0) as int) else cast(floor(w * 10.0e0) as int) + 1 end as lo
      from (select *, lon % 360.0e0 as w from {}) y) x"""


@case("nearest_axis_snap", "region_points", "#region ~lat ~lon #gi_lat #gi_lon", NEAREST_SQL.format("region_points"))
def _(d):
    return snapping.snap_to_lattice(d.region_points)


@case("nearest_point_snap", "region_cells_raw", "#region ~lat ~lon #gi_lat #gi_lon", NEAREST_SQL.format("""
    (select region, lat * 0.97e0 + 0.004e0 * lon as lat, lon + 0.03e0 * lat as lon, true as is_land from region_cells_raw)"""))
def _(d):
    tilted = d.region_cells_raw.select(
        "region", (F.col("lat") * 0.97 + F.col("lon") * 0.004).alias("lat"), (F.col("lon") + F.col("lat") * 0.03).alias("lon"))
    return snapping.snap_to_lattice(tilted)


@case("nearest_snap_cyclic", "region_cells_raw", "#region ~lon #gi_lon", """
    select region, lon, (case when abs(w - floor(w * 10.0e0) / 10.0e0) <= abs(w - (floor(w * 10.0e0) + 1.0e0) / 10.0e0)
          then cast(floor(w * 10.0e0) as int) else cast(floor(w * 10.0e0) as int) + 1 end) % 3600 as gi_lon
    from (select region, lon + 0.07e0 as lon, (lon + 0.07e0) % 360.0e0 as w from region_cells_raw) x""")
def _(d):
    shifted = d.region_cells_raw.withColumn("lon", F.col("lon") + 0.07)
    return shifted.withColumn("gi_lon", geo.nearest_lon_idx(F.col("lon"), cyclic=True))


@case("nearest_axis_snap_irregular", "", "#c_custkey ~axis_value #s_suppkey", """
    with ax as (select s_acctbal as v, min(s_suppkey) as s_suppkey from supplier group by 1)
    select c_custkey, v as axis_value, s_suppkey from (
      select c_custkey, v, s_suppkey, row_number() over (partition by c_custkey order by abs(c_acctbal - v), v) as n
      from customer, ax) x where n = 1""")
def _(d):
    axis = d.supplier.groupBy(F.col("s_acctbal").alias("axis_value")).agg(F.min("s_suppkey").alias("s_suppkey"))
    points = d.customer.select("c_custkey", "c_acctbal")
    return snapping.snap_to_axis(points, "c_acctbal", axis.withColumn("v", F.col("axis_value")), "v",
                                 ["axis_value", "s_suppkey"], chunk_width=500.0)


@case("nearest_axis_snap_quantiles", "", "#l_orderkey #l_linenumber ~axis_value", """
    with ax as (select distinct o_totalprice * o_totalprice / 1000000.0e0 as v from orders),
      p as (select distinct l_extendedprice * l_extendedprice / 250000.0e0 as x from lineitem),
      near as (select x, (select max(v) from ax where v <= x) as a, (select min(v) from ax where v >= x) as b from p)
    select l_orderkey, l_linenumber, case when b is null or a is not null and x - a <= b - x then a else b end as axis_value
    from lineitem join near on x = l_extendedprice * l_extendedprice / 250000.0e0""")
def _(d):
    # Squares lie far apart at one end and close together at the other: stretches of equal width would not be equal in rows.
    axis = d.orders.select((F.col("o_totalprice") * F.col("o_totalprice") / 1e6).alias("v")).distinct().withColumn("axis_value", F.col("v"))
    points = d.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.col("l_extendedprice") / 250000.0).alias("x"))
    return snapping.snap_to_axis(points, "x", axis, "v", ["axis_value"])


# --- mosaic ------------------------------------------------------------------------------------------------------

for _policy, _value in [("mean", "avg(cf)"), ("first", "arg_min(cf, ord)"), ("last", "arg_max(cf, ord)"), ("max", "max(cf)")]:

    @case(f"mosaic_{_policy}", "region_cells_raw", "#lat_idx #lon_idx ~cf #overlap_count", f"""
        select lat_idx, lon_idx, {_value} as cf, {'count(*)' if _policy == 'mean' else '1'} as overlap_count
        from ({LATTICE_SQL}) x where cf is not null group by 1, 2""")
    def _(d, policy=_policy):
        return mosaic.mosaic(lattice(d), policy)


@case("mosaic_totals", "region_cells_raw", "#filled_cells #overlap_cells #max_overlap", f"""
    select count(*) as filled_cells, count(*) filter (where n > 1) as overlap_cells, max(n) as max_overlap
    from (select count(*) as n from ({LATTICE_SQL}) x where cf is not null group by lat_idx, lon_idx) y""")
def _(d):
    return mosaic.mosaic_totals(mosaic.mosaic(lattice(d), "mean"))


CROPPED_SQL = f"""
    with x as (select lat_idx, lon_idx, case when lat between 37.0e0 and 39.0e0 and (lon > 356.5e0 or lon < 3.2e0) then cf end as cf, region,
        (lon_idx + 1800) % 3600 as col from ({LATTICE_SQL}) y),
      b as (select greatest(min(lat_idx) - 5, 0) as r0, least(max(lat_idx) + 5, 1800) as r1, greatest(min(col) - 5, 0) as c0,
        least(max(col) + 5, 3599) as c1 from x where cf is not null)"""


def crop_input(d):
    inside = F.col("lat").between(37.0, 39.0) & ((F.col("lon") > 356.5) | (F.col("lon") < 3.2))
    return lattice(d).withColumn("cf", F.when(inside, F.col("cf")))


@case("valid_bbox_crop", "region_cells_raw", "#region #lat_idx #lon_idx #col ~cf", CROPPED_SQL + """
    select region, lat_idx, lon_idx, col, cf from x, b where lat_idx between r0 and r1 and col between c0 and c1""")
def _(d):
    return filters.crop_to_valid(crop_input(d), pad_degrees=0.5)


@case("valid_extent", "region_cells_raw", "#r0 #r1 #c0 #c1 ~lon_min ~lon_max ~lat_min ~lat_max", CROPPED_SQL + """
    select r0, r1, c0, c1, c0 / 10.0e0 - 180.0e0 as lon_min, c1 / 10.0e0 - 180.0e0 as lon_max,
      90.0e0 - r1 / 10.0e0 as lat_min, 90.0e0 - r0 / 10.0e0 as lat_max from b""")
def _(d):
    return filters.valid_extent(crop_input(d), pad_degrees=0.5)


ANNUAL_MAP = """
    select lat_idx, lon_idx, avg(cf) as cf, count(*) as overlap_count from (
      select region, 500 + cell % 50 as lat_idx, 3550 + cell % 40 as lon_idx, avg(cf) as cf
      from cf_daily where year = 1997 group by 1, 2, 3) x where cf is not null group by 1, 2"""


@case("annual_map", "cf_daily", "#lat_idx #lon_idx ~cf #overlap_count", ANNUAL_MAP)
def _(d):
    placed = d.cf_daily.withColumns({
        "lat": F.lit(90.0) - (F.lit(500) + F.col("cell") % 50) / 10.0, "lon": (F.lit(3550) + F.col("cell") % 40) / 10.0})
    return maps.annual_map(placed, 1997)


@case("annual_map_plot_table", "cf_daily", "#lat_idx #lon_idx ~cf",
      f"select lat_idx, lon_idx, case when cf > 0.2137e0 then cf end as cf from ({ANNUAL_MAP}) m")
def _(d):
    placed = d.cf_daily.withColumns({
        "lat": F.lit(90.0) - (F.lit(500) + F.col("cell") % 50) / 10.0, "lon": (F.lit(3550) + F.col("cell") % 40) / 10.0})
    return maps.plot_table(maps.annual_map(placed, 1997), 0.2137, "data")


# --- annual means ---------------------------------------------------------------------------------------------------

def region_year_sql(mask: bool) -> str:
    kept = "case when m.is_land then cf end" if mask else "cf"
    return f"""select c.energy, c.region, c.year, mean_cf, n_timesteps, n_land_cells from (
          select energy, region, year, avg({kept}) as mean_cf, count({kept}) as n_land_cells
          from (select energy, region, year, cell, avg(cf) as cf from cf_daily group by 1, 2, 3, 4) x
            left join daily_mask m on m.cell = x.cell group by 1, 2, 3) c
        join (select energy, region, year, count(distinct t) as n_timesteps from cf_daily group by 1, 2, 3) s
          on s.energy = c.energy and s.region = c.region and s.year = c.year"""


REGION_COLUMNS = "energy region #year ~mean_cf #n_timesteps #n_land_cells"


@case("cell_year_mean", "cf_daily", "energy region cell #year ~cf",
      "select energy, region, cell, year, avg(cf) as cf from cf_daily group by 1, 2, 3, 4")
def _(d):
    return regions.cell_year_mean(d.cf_daily, ["energy", "region"])


@case("region_annual_mean", "cf_daily daily_mask", REGION_COLUMNS, region_year_sql(True))
def _(d):
    return regions.region_annual_mean(d.cf_daily, d.daily_mask)


@case("region_annual_mean_nomask", "cf_daily daily_mask", REGION_COLUMNS, region_year_sql(False))
def _(d):
    return regions.region_annual_mean(d.cf_daily)


WEIGHTED_SQL = """select energy, year, sum(mean_cf * n_land_cells) / sum(n_land_cells) as mean_cf, count(*) as n_regions,
    sum(n_land_cells) as total_land_cells from ({}) r where mean_cf is not null and n_land_cells > 0 group by 1, 2"""


@case("global_weighted_mean", "cf_daily daily_mask", "energy #year ~mean_cf #n_regions #total_land_cells",
      WEIGHTED_SQL.format(region_year_sql(True)))
def _(d):
    return annual.from_regions(d.cf_daily, d.daily_mask, ["energy"])[1]


EXCLUDED = ["NATION_3", "NATION_7"]


@case("global_mean_excluding", "cf_daily daily_mask", "energy #year ~mean_cf_all ~mean_cf_kept #kept_land_cells", f"""
    select a.energy, a.year, a.mean_cf as mean_cf_all, k.mean_cf as mean_cf_kept, k.total_land_cells as kept_land_cells
    from ({WEIGHTED_SQL.format(region_year_sql(True))}) a
    join ({WEIGHTED_SQL.format("select * from (" + region_year_sql(True) + ") y where region not in ('NATION_3', 'NATION_7')")}) k
      on a.energy = k.energy and a.year = k.year""")
def _(d):
    return regions.global_mean_excluding(regions.region_annual_mean(d.cf_daily, d.daily_mask), EXCLUDED)


@case("dataset_ratio", "cf_daily daily_mask", "energy #year ~value ~other ~ratio", f"""
    select a.energy, a.year, a.mean_cf as value, case when b.year <= 1998 then b.mean_cf end as other,
      case when b.year <= 1998 and b.mean_cf > 0 then a.mean_cf / b.mean_cf end as ratio
    from ({WEIGHTED_SQL.format(region_year_sql(True))}) a left join (select * from ({WEIGHTED_SQL.format(region_year_sql(False))}) z
      ) b on a.energy = b.energy and a.year = b.year""")
def _(d):
    masked = annual.from_regions(d.cf_daily, d.daily_mask, ["energy"])[1]
    # all years are computed; later ones lose their value, as an entry that the other data set does not have
    plain = annual.from_regions(d.cf_daily, None, ["energy"])[1]
    plain = plain.withColumn("mean_cf", F.when(F.col("year") <= 1998, F.col("mean_cf")))
    return regions.dataset_ratio(masked, plain)


@case("country_comparison", "cf_daily daily_mask", "energy region #year ~mean_cf ~mean_cf_published ~mean_cf_ratio", f"""
    select r.energy, r.region, r.year, r.mean_cf, p as mean_cf_published, case when p > 0 then mean_cf / p end as mean_cf_ratio
    from ({region_year_sql(True)}) r left join (
      select n_name as region, case when n_name <> 'EGYPT' then avg(c_acctbal) / 10000.0e0 end as p
      from customer join nation on n_nationkey = c_nationkey group by 1) q on q.region = r.region""")
def _(d):
    published = d.customer.join(d.nation, F.col("n_nationkey") == F.col("c_nationkey")).groupBy(
        F.col("n_name").alias("region")).agg((F.avg("c_acctbal") / 10000.0).alias("mean_cf"))
    published = published.withColumn("mean_cf", F.when(F.col("region") != "EGYPT", F.col("mean_cf")))  # one value is missing
    return comparison.with_published(
        regions.region_annual_mean(d.cf_daily, d.daily_mask), published, ["region"], ["mean_cf"])


@case("global_vs_land_mean", "cf_daily daily_mask", "energy #year #month ~mean_global ~mean_land", """
    select energy, year, month(t) as month, avg(cf) as mean_global, avg(case when m.is_land then cf end) as mean_land
    from cf_daily c left join daily_mask m on m.cell = c.cell group by 1, 2, 3""")
def _(d):
    return regions.global_and_land_means(d.cf_daily, d.daily_mask)


@case("monthly_mean_table", "cf_daily daily_mask", "#year #month ~wind_cf_global ~wind_cf_land ~solar_cf_global ~solar_cf_land", """
    select year, month(t) as month, avg(case when energy = 'wind' then cf end) as wind_cf_global,
      avg(case when energy = 'wind' and m.is_land then cf end) as wind_cf_land,
      avg(case when energy = 'solar' then cf end) as solar_cf_global,
      avg(case when energy = 'solar' and m.is_land then cf end) as solar_cf_land
    from cf_daily c left join daily_mask m on m.cell = c.cell group by 1, 2
    having count(case when energy = 'wind' then 1 end) > 0 and count(case when energy = 'solar' then 1 end) > 0""")
def _(d):
    of = {e: d.cf_daily.where(F.col("energy") == e) for e in ("wind", "solar")}
    return regions.monthly_means(of["wind"], of["solar"], d.daily_mask)


# --- regions on the global lattice --------------------------------------------------------------------------------------

CELLS_SQL = NEAREST_SQL.format("region_points")
SNAPPED_CELLS = f"""select c.region, c.lat, c.lon, c.is_land, c.gi_lat as lat_idx, c.gi_lon as lon_idx, g.energy, g.year, g.cf
    from ({CELLS_SQL}) c join (select energy, year, lat_idx, lon_idx, avg(cf) as cf from lattice_cf group by 1, 2, 3, 4) g
      on g.lat_idx = c.gi_lat and g.lon_idx = c.gi_lon"""
SNAPPED_SQL = f"""
    select s.energy, r.region, s.year, x.mean_cf, s.n_timesteps, coalesce(x.n_land_cells, 0) as n_land_cells
    from (select energy, year, count(distinct t) as n_timesteps from lattice_cf group by 1, 2) s
    cross join (select distinct region from region_points) r
    left join (select energy, region, year, avg(case when is_land then cf end) as mean_cf, count(case when is_land then cf end) as n_land_cells
      from ({SNAPPED_CELLS}) q group by 1, 2, 3) x on x.energy = s.energy and x.year = s.year and x.region = r.region"""


def snapped_cells(d):
    # the land flag belongs to the region's own coordinates, so it travels with the region cell
    return snapping.snap_to_lattice(d.region_points)


@case("region_cells_join", "region_points lattice_cf", "#region ~lat ~lon is_land #lat_idx #lon_idx energy #year ~cf", SNAPPED_CELLS)
def _(d):
    return regions.snapped_cell_means(d.lattice_cf, snapped_cells(d))


@case("region_annual_mean_snapped", "region_points lattice_cf", REGION_COLUMNS.replace("region", "#region"), SNAPPED_SQL)
def _(d):
    return regions.region_annual_mean_snapped(d.lattice_cf, snapped_cells(d))


@case("global_weighted_mean_snapped", "region_points lattice_cf", "energy #year ~mean_cf #n_regions #total_land_cells",
      WEIGHTED_SQL.format(f"select * from ({SNAPPED_SQL}) z where region <> 5"))
def _(d):
    grid = d.region_points.select(F.col("region").cast("string").alias("region"), "lat", "lon")
    land = d.region_points.select("lat", "lon", "region", "is_land")
    cells = annual.region_cells(grid, None, exclude="5").drop("is_land").join(
        land.withColumn("region", F.col("region").cast("string")), ["region", "lat", "lon"], "left")
    return annual.from_lattice(d.lattice_cf, cells, ["energy"])[1]


# --- diagnostics -------------------------------------------------------------------------------------------------------------

STATS_SQL = """select {k} count(cf) as n_values, avg(cf) as mean_cf, max(cf) as max_cf,
    cast(count(*) filter (where cf > 0) as double) / count(cf) as share_positive, avg(case when cf > 0 then cf end) as mean_positive"""


@case("cf_run_stats", "cf_daily", "energy region #n_values ~mean_cf ~max_cf ~share_positive ~mean_positive",
      STATS_SQL.format(k="energy, region,") + " from cf_daily group by 1, 2")
def _(d):
    return diagnostics.cf_statistics(d.cf_daily, keys=["energy", "region"])


LOG_SQL = """select c.region, n_time, n_valid, mean_cf, lat_min, lat_max, lon_min_0360, lon_max_0360 from (
      select region, count(cf) as n_valid, avg(cf) as mean_cf, min(lat) as lat_min, max(lat) as lat_max,
        min((lon + 360.0e0) % 360.0e0) as lon_min_0360, max((lon + 360.0e0) % 360.0e0) as lon_max_0360
      from (select region, cell % 90 - 45.0e0 as lat, cell % 360 - 180.0e0 as lon, avg(cf) as cf from cf_daily group by 1, 2, 3) x
      group by 1) c
    join (select region, count(distinct t) as n_time from cf_daily group by 1) s on s.region = c.region"""


def log_input(d):
    return d.cf_daily.withColumns(
        {"lat": F.col("cell") % 90 - 45.0, "lon": F.col("cell") % 360 - 180.0})


@case("region_log", "cf_daily", "region #n_time #n_valid ~mean_cf ~lat_min ~lat_max ~lon_min_0360 ~lon_max_0360", LOG_SQL)
def _(d):
    return diagnostics.region_log(log_input(d))


@case("region_log_text", "cf_daily", "region lat_min lat_max lon_min_0360 lon_max_0360", f"""
    select region, printf('%.4f', lat_min) as lat_min, printf('%.4f', lat_max) as lat_max, printf('%.4f', lon_min_0360) as lon_min_0360,
      printf('%.4f', lon_max_0360) as lon_max_0360 from ({LOG_SQL}) x""")
def _(d):
    return diagnostics.formatted_region_log(diagnostics.region_log(log_input(d)))


@case("country_weather_stats", "weather_gaps land_mask",
      "#country ~land_share ~mean_wind_speed ~max_wind_speed ~mean_rsds ~max_rsds", """
    with x as (select cast(w.cell % 5 as int) as country, w.cell, is_land, sqrt(uas * uas + vas * vas) as ws, rsds
        from weather_gaps w join land_mask m on m.cell = w.cell)
    select a.country, land_share, mean_wind_speed, max_wind_speed, mean_rsds, max_rsds from (
      select country, avg(ws) as mean_wind_speed, max(ws) as max_wind_speed, avg(rsds) as mean_rsds, max(rsds) as max_rsds
      from x where is_land group by 1) a
    join (select country, avg(cast(is_land as int)) as land_share from (select distinct country, cell, is_land from x) y group by 1) b
      on a.country = b.country""")
def _(d):
    rows = d.weather_gaps.withColumn("country", (F.col("cell") % 5).cast("int"))
    return diagnostics.weather_statistics(rows, d.land_mask)


_STEPS = f"select *, dense_rank() over (order by t) - 1 as step from ({WEATHER_SQL}) w"
_BLOCKS = f"""select cell, lat, lon, case when count(ghi_kw) = 3 then avg(ghi_kw) end as ghi_kw, case when count(tas_c) = 3 then avg(tas_c) end as tas_c,
    avg(uas) as uas, avg(vas) as vas, avg(cast(dayofyear(t) as double)) as doy, avg(hour(t)) as hr
  from ({_STEPS}) s group by cell, lat, lon, step // 3 having count(*) = 3"""


def _both_sql(rows: str, t: str | None, keep: str) -> str:
    solar_part = solar_sql(rows, t=t)
    return wind_sql(f"select cell, {keep} uas, vas, cf as solar from ({solar_part}) s", "sqrt(uas * uas + vas * vas)", "wind")


_FULL = _both_sql(_STEPS, "t", "step,")
_VARIANTS = " union all ".join(
    [f"select 'hourly' as variant, cell, solar, wind from ({_FULL}) f"]
    + [f"select 'phase_{k}', cell, solar, wind from ({_FULL}) f where step % 3 = {k}" for k in range(3)]
    + [f"select 'block_mean', cell, solar, wind from ({_both_sql(_BLOCKS, None, '')}) b"]
)


@case("resolution_experiment", "weather_grid land_mask", "variant ~solar_cf ~wind_cf", f"""
    select variant, avg(case when is_land then solar end) as solar_cf, avg(case when is_land then wind end) as wind_cf
    from (select variant, cell, avg(solar) as solar, avg(wind) as wind from ({_VARIANTS}) v group by 1, 2) x
    join land_mask m on m.cell = x.cell group by 1""")
def _(d):
    rows = weather_rows(d.weather_grid).withColumnsRenamed({"uas": "u", "vas": "v"})
    return diagnostics.resolution_experiment(rows, d.land_mask, knots(d.spark), RATED_KW)
