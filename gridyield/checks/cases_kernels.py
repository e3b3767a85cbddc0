"""Scalar kernels: calendar, coordinates, units, sun, wind."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridyield.checks.registry import case
from gridyield.checks.relations import CURVE_POINTS, RATED_KW
from gridyield.functions import calendar as C
from gridyield.functions import geo, solar, units, wind
from gridyield.functions.nulls import clip, or_zero
from gridyield.operators import filters, photovoltaic, unit_flags, windpower

_KNOTS: list[tuple[float, float]] = []


def knots(spark) -> list[tuple[float, float]]:
    """Prepared knots of the test turbine; a parameter of the queries, so computed once per process."""
    if not _KNOTS:
        rows = ", ".join(f"('T', {x}.0e0, {y}.0e0)" for x, y in CURVE_POINTS)
        curve = spark.sql(f"select turbine, ws, power_w from values {rows} as v(turbine, ws, power_w)")
        _KNOTS.extend(windpower.curve_knots(windpower.prepare_power_curves(curve)))
    return _KNOTS


# --- SQL building blocks of the expected results --------------------------------------------------------

def curve_sql(rows: str, ws: str) -> str:
    """Power in kW by a join with the segments of the curve."""
    points = [(x, y / 1000.0) for x, y in CURVE_POINTS if x <= 25] + [(25, 2500.0), (25.01, 0.0), (1e9, 0.0)]
    values = ", ".join(
        f"({x0}e0, {y0}e0, {x1}e0, {y1}e0)" for (x0, y0), (x1, y1) in zip(points, points[1:])
    )
    return f"""select r.*, y0 + (y1 - y0) * (r.{ws} - x0) / (x1 - x0) as power_kw
        from ({rows}) r join (values {values}) s(x0, y0, x1, y1) on r.{ws} >= x0 and r.{ws} < x1"""


def geometry_sql(rows: str, t: str = "t") -> str:
    """rows plus b (day angle), cosz; rows have lat, lon and either a timestamp or doy and hour."""
    timed = rows if t is None else f"""select r0.*, cast(dayofyear({t}) as double) as doy,
        hour({t}) + minute({t}) / 60.0e0 + second({t}) / 3600.0e0 as hr from ({rows}) r0"""
    angle = f"select r1.*, 2.0e0 * pi() * (doy - 1.0e0) / 365.0e0 as b from ({timed}) r1"
    series = f"""select r2.*,
          0.006918e0 - 0.399912e0 * cos(b) + 0.070257e0 * sin(b) - 0.006758e0 * cos(2.0e0 * b) + 0.000907e0 * sin(2.0e0 * b)
            - 0.002697e0 * cos(3.0e0 * b) + 0.00148e0 * sin(3.0e0 * b) as decl,
          229.18e0 * (0.000075e0 + 0.001868e0 * cos(b) - 0.032077e0 * sin(b) - 0.014615e0 * cos(2.0e0 * b)
            - 0.040849e0 * sin(2.0e0 * b)) as eot
        from ({angle}) r2"""
    return f"""select r3.*, greatest(0.0e0, sin(radians(lat)) * sin(decl) + cos(radians(lat)) * cos(decl)
          * cos(radians((60.0e0 * hr + eot + 4.0e0 * lon) / 4.0e0 - 180.0e0))) as cosz from ({series}) r3"""


def plane_sql(rows: str, ghi: str = "ghi_kw", t: str | None = "t") -> str:
    """rows plus etr, kt, fd, plane."""
    etr = f"""select r4.*, 1.367e0 * (1.00011e0 + 0.034221e0 * cos(b) + 0.00128e0 * sin(b) + 0.000719e0 * cos(2.0e0 * b)
        + 0.000077e0 * sin(2.0e0 * b)) * cosz as etr from ({geometry_sql(rows, t)}) r4"""
    kt = f"""select r5.*, case when etr > 1e-6 then least(greatest({ghi} / etr, 0.0e0), 1.0e0) else 0.0e0 end as kt
        from ({etr}) r5"""
    fd = f"""select r6.*, case when kt <= 0.0e0 then 1.0e0 when kt <= 0.22e0 then 1.0e0 - 0.09e0 * kt
          when kt <= 0.8e0 then 0.9511e0 - 0.1604e0 * kt + 4.388e0 * kt * kt - 16.638e0 * kt * kt * kt
            + 12.336e0 * kt * kt * kt * kt else 0.165e0 end as fd from ({kt}) r6"""
    return f"""select r7.*, case when cosz > 0.0e0 then
          case when cosz > 1e-4 then greatest({ghi} - {ghi} * fd, 0.0e0) / cosz else 0.0e0 end
          + {ghi} * fd * (1.0e0 + cosz) / 2.0e0 else 0.0e0 end as plane from ({fd}) r7"""


def solar_sql(rows: str, speed: str = "sqrt(uas * uas + vas * vas)", ghi: str = "ghi_kw", t: str | None = "t") -> str:
    """rows plus factor, cf."""
    factor = f"""select r8.*, greatest(0.0e0, coalesce(1.0e0 - 0.005e0 * (4.3e0 + 0.943e0 * tas_c + 0.028e0 * plane * 1000.0e0
        - 1.528e0 * ({speed}) - 25.0e0), 0.0e0)) as factor from ({plane_sql(rows, ghi, t)}) r8"""
    return f"select r9.*, least(greatest(plane * factor * 0.8056e0, 0.0e0), 1.0e0) as cf from ({factor}) r9"


def wind_sql(rows: str, speed: str, name: str = "cf") -> str:
    hub = f"select w0.*, coalesce({speed}, 0.0e0) * pow(10.0e0, 1.0e0 / 7.0e0) as hub from ({rows}) w0"
    return f"""select w1.*, least(greatest(power_kw / {RATED_KW}e0, 0.0e0), 1.0e0) as {name}
        from ({curve_sql(hub, 'hub')}) w1"""


WEATHER = """select cell, lat, lon, t, coalesce(rsds, 0.0e0) / 1000.0e0 as ghi_kw, tas - 273.15e0 as tas_c, uas, vas
    from {}"""
WEATHER_SQL = WEATHER.format("weather_grid")
GAPS_SQL = WEATHER.format("weather_gaps")


def weather_rows(df):
    return df.withColumns({"ghi_kw": or_zero(F.col("rsds")) / 1000.0, "tas_c": F.col("tas") - 273.15})


# --- calendar ---------------------------------------------------------------------------------------------

def half_hours(d):
    """All rows at times that are not whole hours."""
    return d.weather_grid.withColumn("t", F.col("t") + F.expr("interval 90 minutes"))


@case("calendar_features", "weather_grid", "cell t #doy ~hour_decimal", """
    select cell, t, dayofyear(t) as doy, hour(t) + minute(t) / 60.0e0 + second(t) / 3600.0e0 as hour_decimal
    from (select cell, t + interval 90 minutes as t from weather_grid) w""")
def _(d):
    return half_hours(d).withColumns({"doy": C.day_of_year(F.col("t")), "hour_decimal": C.hour_decimal(F.col("t"))})


# --- coordinates --------------------------------------------------------------------------------------------

@case("lon_lat_normalize", "region_cells_raw", "#region lat lon ~lon_180 ~lat_clipped", """
    select region, lat, lon, ((lon + 180.0e0) % 360.0e0) - 180.0e0 as lon_180,
      least(greatest(lat * 2.6e0 - 15.0e0, -90.0e0), 90.0e0) as lat_clipped from region_cells_raw""")
def _(d):
    lat = F.col("lat") * 2.6 - 15.0
    return d.region_cells_raw.withColumns({"lon_180": geo.lon_180(F.col("lon")), "lat_clipped": geo.lat_clipped(lat)})


@case("lon_0360", "region_cells_raw", "#region lat lon ~lon_0360", """
    select region, lat, lon, case when w >= 359.9964e0 then 0.0e0 else w end as lon_0360
    from (select region, lat, lon, ((lon - 720.0e0 + 0.0999e0) % 360.0e0 + 360.0e0) % 360.0e0 as w from region_cells_raw) x""")
def _(d):
    return d.region_cells_raw.withColumn("lon_0360", geo.lon_0360(F.col("lon") - 720.0 + 0.0999))


# --- units ----------------------------------------------------------------------------------------------------

@case("irradiance_units", "weather_gaps", "cell t ~ghi_kw", """
    with x as (select cell, t, case when cell % 8 < 4 then rsds else rsds / 1000.0e0 end as v,
        case cell % 4 when 0 then 'W m-2' when 1 then 'kW m-2' when 2 then '' end as units from weather_gaps),
      q as (select cell, quantile_cont(v, 0.99) > 10 as watt from x group by cell)
    select x.cell, t, greatest(0.0e0, coalesce(case when units = 'W m-2' or (coalesce(units, '') = '' and watt)
      then v / 1000.0e0 else v end, 0.0e0)) as ghi_kw from x join q on x.cell = q.cell""")
def _(d):
    units_text = F.when(F.col("cell") % 4 == 0, "W m-2").when(F.col("cell") % 4 == 1, "kW m-2").when(F.col("cell") % 4 == 2, "")
    value = F.when(F.col("cell") % 8 < 4, F.col("rsds")).otherwise(F.col("rsds") / 1000.0)
    x = d.weather_gaps.select("cell", "t", value.alias("v"), units_text.alias("units"))
    return unit_flags.convert_irradiance(x, "v", keys=["cell"])


@case("temperature_units", "weather_grid", "cell t ~tas_c", """
    with x as (select cell, t, case when cell % 8 < 4 then tas else tas - 273.15e0 end as v,
        case cell % 4 when 0 then 'K' when 1 then 'degC' when 2 then '' end as units from weather_grid),
      q as (select cell, median(v) > 100 as kelvin from x group by cell)
    select x.cell, t, case when units = 'K' or (coalesce(units, '') = '' and kelvin) then v - 273.15e0 else v end as tas_c
    from x join q on x.cell = q.cell""")
def _(d):
    units_text = F.when(F.col("cell") % 4 == 0, "K").when(F.col("cell") % 4 == 1, "degC").when(F.col("cell") % 4 == 2, "")
    value = F.when(F.col("cell") % 8 < 4, F.col("tas")).otherwise(F.col("tas") - 273.15)
    x = d.weather_grid.select("cell", "t", value.alias("v"), units_text.alias("units"))
    return unit_flags.convert_temperature(x, "v", keys=["cell"])


@case("wind_units", "weather_gaps", "cell t ~uas", """
    select cell, t, coalesce(case when cell % 4 in (1, 2) then uas / 3.6e0 else uas end, 0.0e0) as uas from weather_gaps""")
def _(d):
    units_text = F.when(F.col("cell") % 4 == 0, "m s-1").when(F.col("cell") % 4 == 1, "KM / h").when(F.col("cell") % 4 == 2, "km hr-1")
    return unit_flags.convert_wind(d.weather_gaps.withColumn("units", units_text), "uas")


@case("sunshine_flag", "accum_grid", "cell t is_sunny", """
    select cell, t, coalesce(ssrd / 3600.0e0 > 120.0e0, false) as is_sunny from accum_grid""")
def _(d):
    return d.accum_grid.withColumn("is_sunny", units.is_sunny(F.col("ssrd")))


# --- sun ---------------------------------------------------------------------------------------------------------

@case("cos_zenith", "weather_grid", "cell t ~cosz", geometry_sql("select cell, lat, lon, t from weather_grid"))
def _(d):
    return photovoltaic.add_geometry(d.weather_grid).withColumnRenamed("_cosz", "cosz")


@case("cos_zenith_rotated", "weather_grid", "cell t ~cosz", geometry_sql(
    "select cell, lat * 0.9e0 + 0.01e0 * lon as lat, lon - 180.0e0 + 0.1e0 * lat as lon, t + interval 90 minutes as t from weather_grid"))
def _(d):
    tilted = half_hours(d).select("cell", (F.col("lat") * 0.9 + F.col("lon") * 0.01).alias("lat"),
                                (F.col("lon") - 180.0 + F.col("lat") * 0.1).alias("lon"), "t")
    return photovoltaic.add_geometry(tilted).withColumnRenamed("_cosz", "cosz")


@case("extraterrestrial_irradiance", "weather_grid", "cell t ~etr", plane_sql(WEATHER_SQL))
def _(d):
    with_sun = photovoltaic.add_geometry(d.weather_grid)
    return with_sun.withColumn("etr", solar.extraterrestrial_kw(F.col("_doy"), F.col("_cosz")))


@case("erbs_diffuse_fraction", "weather_grid", "cell t ~kt ~fd", plane_sql(WEATHER_SQL))
def _(d):
    rows = photovoltaic.add_diffuse_fraction(photovoltaic.add_geometry(weather_rows(d.weather_grid)))
    return rows.withColumnsRenamed({"_kt": "kt", "_fd": "fd"})


@case("plane_irradiance", "weather_grid", "cell t ~plane", plane_sql(WEATHER_SQL))
def _(d):
    rows = photovoltaic.add_diffuse_fraction(photovoltaic.add_geometry(weather_rows(d.weather_grid)))
    return photovoltaic.add_plane(rows).withColumnRenamed("_plane", "plane")


@case("temperature_coefficient", "weather_gaps", "cell t ~factor", solar_sql(GAPS_SQL))
def _(d):
    rows = photovoltaic.add_solar_cf(weather_rows(d.weather_gaps), keep_stages=True)
    return rows.withColumnRenamed("_factor", "factor")


@case("solar_cf", "weather_grid", "cell t ~cf", solar_sql(WEATHER_SQL))
def _(d):
    return photovoltaic.add_solar_cf(weather_rows(d.weather_grid))


@case("solar_cf_missing_wind_zero_cf", "weather_gaps", "cell t ~cf", solar_sql(GAPS_SQL))
def _(d):
    return photovoltaic.add_solar_cf(weather_rows(d.weather_gaps), missing_wind="zero_cf")


@case("solar_cf_missing_wind_calm", "weather_gaps", "cell t ~cf", solar_sql(
    GAPS_SQL, "sqrt(coalesce(uas, 0.0e0) * coalesce(uas, 0.0e0) + coalesce(vas, 0.0e0) * coalesce(vas, 0.0e0))"))
def _(d):
    return photovoltaic.add_solar_cf(weather_rows(d.weather_gaps), missing_wind="zero_wind")


@case("solar_cf_scalar_speed", "weather_gaps", "cell t ~cf", solar_sql(GAPS_SQL, "abs(vas) * 2.0e0"))
def _(d):
    rows = weather_rows(d.weather_gaps).withColumn("sfcWind", F.abs("vas") * 2.0)
    return photovoltaic.add_solar_cf(rows, speed="sfcWind")


# --- wind ----------------------------------------------------------------------------------------------------------

@case("wind_speed", "weather_grid", "cell t ~ws", "select cell, t, sqrt(uas * uas + vas * vas) as ws from weather_grid")
def _(d):
    return d.weather_grid.withColumn("ws", wind.speed(F.col("uas"), F.col("vas")))


@case("hub_wind_speed", "weather_grid", "cell t ~ws", """
    select cell, t, sqrt(uas * uas + vas * vas) * pow(100.0e0 / 10.0e0, 1.0e0 / 7.0e0) as ws from weather_grid""")
def _(d):
    return d.weather_grid.withColumn("ws", wind.hub_speed(wind.speed(F.col("uas"), F.col("vas"))))


@case("power_curve_prepare", "turbine_curves", "turbine ~ws ~power_kw", """
    with kept as (select turbine, ws, power_w / 1000.0e0 as power_kw from turbine_curves where ws <= 25.0e0),
      tail as (select turbine, max(ws) as w, arg_max(power_kw, ws) as p from kept group by turbine),
      grown as (select turbine, w + 0.5e0 * i as ws, p as power_kw from tail, range(1, 60) r(i)
        where w + 0.5e0 * i < 25.001e0 and w < 25.0e0)
    select * from kept union all select * from grown
    union all select turbine, 25.0e0, p from tail where w < 25.0e0
      and not exists (select 1 from grown g where g.turbine = tail.turbine and g.ws >= 25.0e0)""")
def _(d):
    return windpower.prepare_power_curves(d.turbine_curves)


@case("power_curve_lookup", "weather_grid", "cell t ~ws ~power_kw", curve_sql(
    "select cell, t, rsds / 30.0e0 as ws from weather_grid", "ws"))
def _(d):
    rows = d.weather_grid.select("cell", "t", (F.col("rsds") / 30.0).alias("ws"))
    return rows.withColumn("power_kw", wind.curve_power(F.col("ws"), knots(d.spark)))


@case("wind_cf", "weather_gaps", "cell t ~cf", wind_sql(
    "select cell, t, coalesce(uas, 0.0e0) as u, coalesce(vas, 0.0e0) as v from weather_gaps", "sqrt(u * u + v * v)"))
def _(d):
    return windpower.add_wind_cf(d.weather_gaps, knots(d.spark), RATED_KW)


@case("wind_cf_scalar_speed", "weather_gaps", "cell t ~cf", wind_sql(
    "select cell, t, abs(vas) * 2.0e0 as s from weather_gaps", "s"))
def _(d):
    rows = d.weather_gaps.withColumn("sfcWind", F.abs("vas") * 2.0)
    return windpower.add_wind_cf(rows, knots(d.spark), RATED_KW, speed="sfcWind")


# --- filters ---------------------------------------------------------------------------------------------------------

@case("time_filter", "cf_daily", "energy region cell t ~cf", """
    select energy, region, cell, t, cf from cf_daily where year between 1996 and 1998 and month(t) in (1, 2, 7)""")
def _(d):
    return filters.select_period(d.cf_daily, "1996-1998", "1,2,7")


@case("region_include_exclude", "cf_daily", "energy region cell t ~cf", """
    select energy, region, cell, t, cf from cf_daily where region in ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')
      and region <> 'NATION_3'""")
def _(d):
    return filters.select_regions(d.cf_daily, ["NATION_1,NATION_2", "NATION_3", "NATION_4"], "NATION_3")


@case("zero_mask", "cf_daily", "energy region cell t ~cf", """
    select energy, region, cell, t, case when cf > 0.2837e0 then cf end as cf from cf_daily""")
def _(d):
    return filters.mask_zero(d.cf_daily, threshold=0.2837)  # no mean of one-digit values lies on it


@case("first_n_steps", "weather_grid", "cell t ~rsds", """
    select cell, t, rsds from weather_grid where t in (select distinct t from weather_grid order by t limit 240)""")
def _(d):
    return filters.first_steps(d.weather_grid, 240)


@case("step_index", "cf_daily", "t #step", """
    select t, dense_rank() over (order by t) - 1 as step from (select distinct t from cf_daily) x""")
def _(d):
    return filters.step_index(d.cf_daily)


@case("phase_subsample", "weather_grid", "cell t #step ~rsds", """
    select * from (select cell, t, dense_rank() over (order by t) - 1 as step, rsds from weather_grid) x
    where step >= 1 and (step - 1) % 3 = 0""")
def _(d):
    return filters.with_step(d.weather_grid).where(filters.on_phase(F.col("step"), 1, 3))


@case("block_mean_3h", "weather_grid", "cell #block ~rsds ~tas ~hour", """
    select cell, step // 3 as block, avg(rsds) as rsds, case when count(tas) = 3 then avg(tas) end as tas, avg(hour(t)) as hour
    from (select *, dense_rank() over (order by t) - 1 as step from weather_grid) x
    group by cell, step // 3 having count(*) = 3""")
def _(d):
    rows = filters.with_step(d.weather_grid).withColumn("hour", F.hour("t"))
    return filters.block_means(rows, ["rsds", "tas", "hour"])


@case("value_clip", "weather_grid", "cell t ~tas", """
    select cell, t, case when tas is not null then least(greatest(tas, 270.0e0), 290.0e0) end as tas from weather_grid""")
def _(d):
    return d.weather_grid.withColumn("tas", clip(F.col("tas"), 270.0, 290.0))
