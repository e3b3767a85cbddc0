"""Running totals, interpolation, alignment and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridyield.checks.cases_kernels import knots, solar_sql, wind_sql
from gridyield.checks.registry import case
from gridyield.checks.relations import RATED_KW
from gridyield.functions import units
from gridyield.operators import accumulation, alignment, climate, interpolation, masking
from gridyield.operators.filters import select_period
from gridyield.plans import reanalysis, regional
from gridyield.session import shared_path
from gridyield.sources import sinks, tables

# --- running totals -----------------------------------------------------------------------------------------


def increment_sql(rows: str, first: str) -> str:
    return f"""select i1.*, case when raw is not null then greatest(case when raw < 0 then ssrd else raw end, 0.0e0) end as increment
        from (select i0.*, case when hour(t) = 1 then ssrd when prev_t is null or 12 * (year(t) - year(prev_t)) + month(t) - month(prev_t) > 1 then {first} else ssrd - prev end as raw
          from (select *, lag(ssrd) over w as prev, lag(t) over w as prev_t from {rows}
                window w as (partition by cell order by t)) i0) i1"""


for _policy, _key, _first in [("zero", "zero", "0.0e0"), ("nan", "null", "null"), ("current", "current", "ssrd")]:

    @case(f"deaccumulate_{_key}", "accum_grid", "cell t ~increment", increment_sql("accum_grid", _first))
    def _(d, policy=_policy):
        return accumulation.deaccumulate(d.accum_grid, "ssrd", policy=policy)


@case("deaccumulate_cross_month", "accum_months", "cell t ~increment",
      f"select * from ({increment_sql('accum_months', '0.0e0')}) x where month(t) = 2")
def _(d):
    return select_period(accumulation.deaccumulate(d.accum_months, "ssrd"), "2024", "2")


@case("deaccumulate_missing_month", "accum_gap", "cell t ~increment", increment_sql("accum_gap", "ssrd"))
def _(d):
    return accumulation.deaccumulate(d.accum_gap, "ssrd", policy="current")


@case("deaccumulate_daily_chunks", "accum_months", "cell t ~increment", increment_sql("accum_months", "null"))
def _(d):
    day = F.to_date("t")
    return accumulation.deaccumulate(d.accum_months, "ssrd", policy="nan", chunk=day)


@case("monthly_increment", "accum_months", "cell t ~increment", """
    select cell, t, greatest(ssrd - coalesce(lag(ssrd) over (partition by cell, year(t), month(t) order by t), 0.0e0), 0.0e0) as increment
    from accum_months""")
def _(d):
    return accumulation.monthly_difference(d.accum_months, "ssrd")


@case("ghi_from_accumulated", "accum_grid", "cell t ~ghi_kw",
      f"select cell, t, coalesce(increment / 3600000.0e0, 0.0e0) as ghi_kw from ({increment_sql('accum_grid', 'null')}) x")
def _(d):
    steps = accumulation.deaccumulate(d.accum_grid, "ssrd", policy="nan")
    return steps.withColumn("ghi_kw", units.ghi_kw_from_increment(F.col("increment")))


@case("precip_from_accumulated", "accum_grid", "cell t ~mm_h",
      f"select cell, t, coalesce(increment / 1000000.0e0 * 1000.0e0, 0.0e0) as mm_h from ({increment_sql('accum_grid', 'null')}) x")
def _(d):
    steps = accumulation.deaccumulate(d.accum_grid, "ssrd", policy="nan")
    return steps.withColumn("mm_h", units.precipitation_mm_h(F.col("increment") / 1_000_000.0))


# --- interpolation ---------------------------------------------------------------------------------------------


def interpolation_sql(policy: str) -> str:
    """Bracket by largest time below and smallest above, looked up for every target."""
    edges = """select f.cell, f.t, (select max(s.t) from instant_grid s where s.cell = f.cell and s.t <= f.t) as t0,
          (select min(s.t) from instant_grid s where s.cell = f.cell and s.t >= f.t) as t1,
          (select min(s.t) from instant_grid s where s.cell = f.cell) as t_first,
          (select max(s.t) from instant_grid s where s.cell = f.cell) as t_last from flux_axis f"""
    filled = f"select cell, t, coalesce(t0, t1) as t0, coalesce(t1, t0) as t1, t_first, t_last from ({edges}) e"
    weighted = f"""select *, case when t1 > t0 then (epoch_us(t) - epoch_us(t0)) / cast(epoch_us(t1) - epoch_us(t0) as double)
          else 0.0e0 end as w from ({filled}) f"""
    value = "a.tas * (1.0e0 - w) + b.tas * w"
    if policy == "nan":
        value = f"case when x.t > t_first and x.t < t_last then {value} end"
    return f"""select x.cell, x.t, {value} as tas from ({weighted}) x
        join instant_grid a on a.cell = x.cell and a.t = x.t0 join instant_grid b on b.cell = x.cell and b.t = x.t1"""


@case("interp_join_linear", "flux_axis instant_grid", "cell t ~tas", interpolation_sql("nearest"))
def _(d):
    return interpolation.interpolate(d.flux_axis, d.instant_grid, ["tas"])


@case("interp_join_boundary_null", "flux_axis instant_grid", "cell t ~tas", interpolation_sql("nan"))
def _(d):
    return interpolation.interpolate(d.flux_axis, d.instant_grid, ["tas"], policy="nan")


@case("interp_join_daily_chunks", "flux_axis instant_grid", "cell t ~tas", interpolation_sql("nearest"))
def _(d):
    return interpolation.interpolate(d.flux_axis, d.instant_grid, ["tas"], chunk=F.to_date("t"))


SHARED_AXIS_SQL = """
    with ax as (select distinct t from instant_grid),
      b as (select f.t, coalesce(max(case when ax.t <= f.t then ax.t end), min(case when ax.t >= f.t then ax.t end)) as t0,
              coalesce(min(case when ax.t >= f.t then ax.t end), max(case when ax.t <= f.t then ax.t end)) as t1
            from (select distinct t from flux_axis) f, ax group by f.t),
      w as (select *, case when t1 > t0 then (epoch_us(t) - epoch_us(t0)) / cast(epoch_us(t1) - epoch_us(t0) as double) else 0.0e0 end as w from b)
    select f.cell, f.t, case when t0 = t1 then x.tas else x.tas * (1.0e0 - w) + y.tas * w end as tas
    from flux_axis f join w on w.t = f.t left join instant_grid x on x.cell = f.cell and x.t = t0
      left join instant_grid y on y.cell = f.cell and y.t = t1"""


@case("interp_join_shared_axis", "flux_axis instant_grid", "cell t ~tas", SHARED_AXIS_SQL)
def _(d):
    table = interpolation.bracket_table(d.flux_axis.select("t").distinct(), d.instant_grid.select("t").distinct())
    found = interpolation.interpolate_shared_axis(table, d.instant_grid, ["tas"])
    return d.flux_axis.join(found, ["cell", "t"], "left")


# --- alignment -----------------------------------------------------------------------------------------------------

@case("align_inner", "component_u component_v", "cell t ~uas ~vas", """
    select u.cell, u.t, uas, vas from component_u u join component_v v on u.cell = v.cell and u.t = v.t""")
def _(d):
    return alignment.align_inner(d.component_u, d.component_v.select("cell", "t", "vas"))


@case("align_several_variables", "component_u component_v weather_grid", "cell t ~uas ~vas ~rsds", """
    select u.cell, u.t, u.uas, v.vas, w.rsds from component_u u join component_v v on u.cell = v.cell and u.t = v.t
      join weather_grid w on w.cell = u.cell and w.t = u.t""")
def _(d):
    rsds = d.weather_grid.select("cell", "t", "rsds")
    return alignment.combine({"uas": d.component_u, "vas": d.component_v, "rsds": rsds}, strict=False, tolerance=1.0)


@case("combine_delivered_variables", "weather_grid", "cell ~lat ~lon t ~rsds ~tas ~uas",
      "select cell, lat, lon, t, rsds, tas, uas from weather_grid")
def _(d):
    return alignment.combine({v: d.weather_grid.select("cell", "lat", "lon", "t", v) for v in ("rsds", "tas", "uas")})


@case("alignment_report", "component_u component_v", "variable #n_rows #n_kept #n_lost #n_doubled", """
    select 'uas' as variable, count(*) as n_rows, count(v.t) as n_kept, count(*) - count(v.t) as n_lost, 0 as n_doubled
    from component_u u left join component_v v on u.cell = v.cell and u.t = v.t
    union all select 'vas', count(*), count(u.t), count(*) - count(u.t), 0
    from component_v v left join component_u u on u.cell = v.cell and u.t = v.t""")
def _(d):
    return alignment.alignment_report({"uas": d.component_u, "vas": d.component_v})


SPATIAL_SQL = """
    select coalesce(a.cell, b.cell) as cell, case when b.cell is null then 'missing_in_other' when a.cell is null then 'missing_in_reference'
        when abs(a.lat - b.lat) > 1e-6 then 'latitude_differs' when abs(a.lon - b.lon) > 1e-6 then 'longitude_differs' end as issue
    from (select distinct cell, lat, lon from component_u) a full join (select distinct cell, lat, lon from component_v) b on a.cell = b.cell"""


@case("grid_mismatch_report", "component_u component_v", "axis cell t issue", f"""
    select 'time' as axis, null::bigint as cell, coalesce(a.t, b.t) as t,
      case when b.t is null then 'missing_in_other' else 'missing_in_reference' end as issue
    from (select distinct t from component_u) a full join (select distinct t from component_v) b on a.t = b.t
    where a.t is null or b.t is null
    union all select 'cell', cast(cell as bigint), null, issue from ({SPATIAL_SQL}) s where issue is not null""")
def _(d):
    return alignment.grid_report(d.component_u, d.component_v)


@case("spatial_mismatch_report", "component_u component_v", "#cell issue",
      f"select * from ({SPATIAL_SQL}) s where issue is not null")
def _(d):
    return alignment.spatial_report(d.component_u, d.component_v)


@case("monotonic_check", "", "user_id #n_steps #n_violations", """
    select user_id, count(*) as n_steps, count(*) filter (where t <= prev) as n_violations
    from (select user_id, t, lag(t) over (partition by user_id order by event_id) as prev
          from (select user_id, event_id, date_trunc('hour', ts) as t from events) e) x group by user_id""")
def _(d):
    rows = d.events.select("user_id", "event_id", F.date_trunc("hour", "ts").alias("t"))
    return alignment.monotonic_violations(rows, ["user_id"], "event_id", "t", block=4096)


# --- climatologies ---------------------------------------------------------------------------------------------------

@case("mean_wind_speed_100m", "weather_gaps", "cell ~value", """
    select cell, avg(sqrt(uas * uas + vas * vas) * pow(10.0e0, 1.0e0 / 7.0e0)) as value from weather_gaps group by cell""")
def _(d):
    return climate.mean_hub_wind_speed(d.weather_gaps, "uas", "vas")


@case("mean_temperature", "weather_grid", "cell ~value", "select cell, avg(tas - 273.15e0) as value from weather_grid group by cell")
def _(d):
    return climate.mean_temperature(d.weather_grid, "tas")


@case("climatology_table", "weather_grid", "var cell ~value units long_name", """
    select 'mean_temperature' as var, cell, cast(cast(avg(tas - 273.15e0) as float) as double) as value, 'degC' as units, 'Multi-year mean temperature' as long_name
    from weather_grid group by cell""")
def _(d):
    means = climate.mean_temperature(d.weather_grid, "tas")
    return climate.climatology(means, "mean_temperature", "degC", "Multi-year mean temperature")


@case("mean_sunshine_hours", "accum_months", "cell ~value", """
    select cell, avg(h) as value from (
      select cell, cast(t as date) as d, count(*) filter (where inc / 3600.0e0 > 120.0e0) as h from (
        select cell, t, ssrd, greatest(ssrd - coalesce(lag(ssrd) over (partition by cell, year(t), month(t) order by t), 0.0e0), 0.0e0) as inc
        from accum_months) x group by 1, 2 having count(ssrd) > 0) y group by cell""")
def _(d):
    return climate.mean_sunshine_hours(d.accum_months)


@case("mean_sunshine_hours_reset", "accum_months", "cell ~value", f"""
    select cell, avg(h) as value from (
      select cell, cast(t as date) as d, count(*) filter (where increment / 3600.0e0 > 120.0e0) as h
      from ({increment_sql('accum_months', '0.0e0')}) x group by 1, 2 having count(ssrd) > 0) y group by cell""")
def _(d):
    return climate.mean_sunshine_hours(d.accum_months, rule="reset")


# --- mean profiles (daily steps: positions are days) ---------------------------------------------------------------------

DAYS = "(case month when 2 then 28 when 4 then 30 when 6 then 30 when 9 then 30 when 11 then 30 else 31 end)"
BEFORE = ("(case month when 1 then 0 when 2 then 31 when 3 then 59 when 4 then 90 when 5 then 120 when 6 then 151 "
          "when 7 then 181 when 8 then 212 when 9 then 243 when 10 then 273 when 11 then 304 else 334 end)")


def profile_sql(position: str, source: str = "cf_daily") -> str:
    return f"""select p.energy, p.cell, month, position, case when m.is_land then avg(cf) end as cf, count(cf) as n_years
        from (select energy, cell, cf, month(t) as month, {position} as position from {source}) p
          left join daily_mask m on m.cell = p.cell
        where position < {DAYS} group by p.energy, p.cell, month, position, m.is_land"""


ROW_POSITION = "row_number() over (partition by energy, cell, year(t), month(t) order by t) - 1"
AXIS_POSITION = "dense_rank() over (partition by year(t), month(t) order by t) - 1"


@case("hour_of_month_position", "cf_daily", "energy cell t #position",
      f"select energy, cell, t, {ROW_POSITION} as position from cf_daily")
def _(d):
    return climate.month_position(d.cf_daily, ["energy", "cell"], "t", "row", 1)


for _how, _key, _position in [
    ("row", "multi_year_mean_hourly", ROW_POSITION),
    ("axis", "multi_year_mean_hourly_axis", AXIS_POSITION),
    ("calendar", "multi_year_mean_hourly_calendar", "day(t) - 1"),
]:

    @case(_key, "cf_daily daily_mask", "energy cell #month #position ~cf #n_years", profile_sql(_position))
    def _(d, how=_how):
        return climate.mean_profile(d.cf_daily, keys=("energy", "cell"), mask=d.daily_mask, how=how, steps_per_day=1)


@case("merge_months_8760", "cf_daily daily_mask", "energy cell #hour_of_year ~cf",
      f"select energy, cell, {BEFORE} + position as hour_of_year, cf from ({profile_sql(AXIS_POSITION)}) x")
def _(d):
    profile = climate.mean_profile(d.cf_daily, keys=("energy", "cell"), mask=d.daily_mask, how="axis", steps_per_day=1)
    return climate.merge_months(profile, 1)


@case("month_grid_sizes", "cf_daily", "#month #n_cells",
      "select month(t) as month, count(distinct cell) as n_cells from cf_daily group by 1")
def _(d):
    return climate.month_grid_sizes(d.cf_daily.withColumn("month", F.month("t")))


# --- complete jobs ---------------------------------------------------------------------------------------------------------

REGIONAL_SQL = solar_sql(f"""
    select x.cell, g.lat, g.lon, x.t, g.rsds / 1000.0e0 as ghi_kw, x.tas - 273.15e0 as tas_c, x.uas, x.vas
    from ({interpolation_sql('nearest').replace(
        'a.tas * (1.0e0 - w) + b.tas * w as tas',
        ', '.join(f'a.{v} * (1.0e0 - w) + b.{v} * w as {v}' for v in ('tas', 'uas', 'vas')))}) x
    join flux_grid g on g.cell = x.cell and g.t = x.t""")


@case("regional_solar_job", "flux_axis flux_grid instant_grid land_mask", "cell t ~cf",
      f"select s.cell, s.t, case when m.is_land then s.cf end as cf from ({REGIONAL_SQL}) s join land_mask m on m.cell = s.cell")
def _(d):
    return regional.solar(d.flux_grid, d.instant_grid, d.land_mask, shared_axis=False)


@case("regional_solar_job_shared_axis", "flux_axis flux_grid dense_grid land_mask", "cell t ~cf",
      "select s.cell, s.t, case when m.is_land then s.cf end as cf from ("
      + REGIONAL_SQL.replace("instant_grid", "dense_grid") + ") s join land_mask m on m.cell = s.cell")
def _(d):
    years = {"year": F.year("t"), "month": F.month("t")}
    return regional.solar(d.flux_grid.withColumns(years), d.dense_grid.withColumns(years), d.land_mask, "2000-2100")


@case("regional_solar_job_unknown_units", "flux_axis flux_grid instant_grid land_mask", "cell t ~cf",
      f"select s.cell, s.t, case when m.is_land then s.cf end as cf from ({REGIONAL_SQL}) s join land_mask m on m.cell = s.cell")
def _(d):
    flux, states = (df.withColumn("file", F.lit("a")) for df in (d.flux_grid, d.instant_grid))
    return regional.solar(flux, states, d.land_mask, shared_axis=False, irradiance_units=None, temperature_units=None, file_keys=["file"])


@case("regional_wind_job", "component_u component_v land_mask", "cell t ~cf", "select c.cell, c.t, case when m.is_land then c.cf end as cf from ("
      + wind_sql("select u.cell, u.t, uas, vas from component_u u join component_v v on u.cell = v.cell and u.t = v.t",
                 "sqrt(uas * uas + vas * vas)") + ") c left join land_mask m on m.cell = c.cell")
def _(d):
    return regional.wind(d.component_u, d.component_v, d.land_mask, knots(d.spark), RATED_KW)


@case("reanalysis_solar_job", "accum_months land_mask", "cell t ~cf", "select s.cell, s.t, case when m.is_land then s.cf end as cf from ("
      + solar_sql(f"""select cell, lat, lon, t, increment / 3600000.0e0 as ghi_kw, tas - 273.15e0 as tas_c, uas, vas
          from ({increment_sql('accum_months', '0.0e0')}) i where month(t) = 2""")
      + ") s join land_mask m on m.cell = s.cell")
def _(d):
    weather = d.accum_months.withColumnsRenamed({"tas": "t2m", "uas": "u10", "vas": "v10"})
    return reanalysis.solar(weather, d.land_mask, "2024", "2")


JOB_SQL = ("select s.cell, s.t, case when m.is_land then s.cf end as cf from ("
           + solar_sql(f"""select cell, lat, lon, t, increment / 3600000.0e0 as ghi_kw, tas - 273.15e0 as tas_c, uas, vas
               from ({increment_sql('accum_months', '0.0e0')}) i where month(t) = 2""")
           + ") s join land_mask m on m.cell = s.cell")


@case("reanalysis_solar_job_tails", "accum_months land_mask", "cell t ~cf", JOB_SQL)
def _(d):
    # Months with their last steps on shared storage; the job reads February, and of January the last steps only.
    folder = shared_path(d.spark, "reanalysis")
    weather = d.accum_months.withColumnsRenamed({"tas": "t2m", "uas": "u10", "vas": "v10"})
    dated = weather.withColumns({"year": F.year("t"), "month": F.month("t")})
    dated.write.partitionBy("year", "month").parquet(f"{folder}/months")
    stored = d.spark.read.parquet(f"{folder}/months")
    sinks.write_month_tails(stored, f"{folder}/tails")
    tails = tables.tails_before(d.spark, f"{folder}/tails", "2024", "2")
    return reanalysis.solar(stored, d.land_mask, "2024", "2", tails=tails)


@case("reanalysis_solar_job_separate", "accum_months land_mask", "cell t ~cf", JOB_SQL)
def _(d):
    weather = d.accum_months.withColumnsRenamed({"tas": "t2m", "uas": "u10", "vas": "v10"})
    delivered = {v: weather.select("cell", "lat", "lon", "t", v) for v in ("ssrd", "t2m", "u10", "v10")}
    return reanalysis.solar(delivered, d.land_mask, "2024", "2")


@case("month_tails", "accum_months", "cell #year #month t ~ssrd", """
    select cell, year(t) as year, month(t) as month, t, ssrd from accum_months
    qualify row_number() over (partition by cell, year(t), month(t) order by t desc) = 1""")
def _(d):
    return accumulation.month_tails(d.accum_months, "ssrd")


@case("reanalysis_wind_job", "accum_grid land_mask", "cell t ~cf", "select s.cell, s.t, case when m.is_land then s.cf end as cf from ("
      + wind_sql("select cell, t, uas, vas from accum_grid", "sqrt(uas * uas + vas * vas)")
      + ") s join land_mask m on m.cell = s.cell")
def _(d):
    weather = d.accum_grid.withColumnsRenamed({"tas": "t2m", "uas": "u10", "vas": "v10"})
    return reanalysis.wind(weather, d.land_mask, knots(d.spark), RATED_KW)


@case("reanalysis_wind_job_kmh", "accum_grid land_mask", "cell t ~cf", "select s.cell, s.t, case when m.is_land then s.cf end as cf from ("
      + wind_sql("select cell, t, uas / 3.6e0 as uas, vas / 3.6e0 as vas from accum_grid", "sqrt(uas * uas + vas * vas)")
      + ") s join land_mask m on m.cell = s.cell")
def _(d):
    weather = d.accum_grid.withColumnsRenamed({"tas": "t2m", "uas": "u10", "vas": "v10"})
    return reanalysis.wind(weather, d.land_mask, knots(d.spark), RATED_KW, wind_units="km/h")


# --- land mask ----------------------------------------------------------------------------------------------------------------

@case("land_mask_apply", "weather_grid land_mask", "cell t ~rsds", """
    select w.cell, t, case when m.is_land then rsds end as rsds from weather_grid w left join land_mask m on m.cell = w.cell""")
def _(d):
    return masking.apply_land_mask(d.weather_grid, d.land_mask, ["rsds"])


@case("drop_ocean", "weather_grid land_mask", "cell t ~rsds", """
    select w.cell, t, rsds from weather_grid w join land_mask m on m.cell = w.cell where m.is_land""")
def _(d):
    return masking.drop_ocean(d.weather_grid, d.land_mask)


@case("remask_ocean", "cf_daily daily_mask", "energy region cell t ~cf", """
    select energy, region, c.cell, t, case when m.is_land then cf end as cf from cf_daily c left join daily_mask m on m.cell = c.cell""")
def _(d):
    return masking.apply_land_mask(d.cf_daily, d.daily_mask)


@case("land_share", "land_mask", "~land_share #n_cells",
      "select avg(cast(is_land as int)) as land_share, count(*) as n_cells from land_mask")
def _(d):
    return masking.land_share(d.land_mask)
