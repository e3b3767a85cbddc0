"""Kernels against hand-computed values and a numpy derivation of the published formulas."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridyield.functions import calendar as C
from gridyield.functions import geo, nulls, solar, units, wind
from gridyield.operators import photovoltaic, unit_flags, windpower

CURVE = [(0.0, 0.0), (3.0, 20.0), (5.0, 200.0), (13.0, 2500.0), (20.0, 2500.0)]


def one(spark, column, rows=None, ddl=None):
    df = spark.createDataFrame(rows, ddl) if rows is not None else spark.range(1)
    return [r[0] for r in df.select(column).collect()]


def test_nan_and_infinity_become_null(spark):
    got = one(spark, nulls.finite(F.col("x")), [(1.5,), (float("nan"),), (float("inf"),), (-float("inf"),), (None,)], "x double")
    assert got == [1.5, None, None, None, None]


def test_clip_keeps_null(spark):
    got = one(spark, nulls.clip(F.col("x"), 0, 1), [(-1.0,), (0.25,), (3.0,), (None,)], "x double")
    assert got == [0.0, 0.25, 1.0, None]
    assert one(spark, nulls.at_least(F.col("x"), 0), [(-1.0,), (2.0,), (None,)], "x double") == [0.0, 2.0, None]


def test_period_arguments():
    assert C.parse_years("2015-2060") == (2015, 2060) and C.parse_years("2020") == (2020, 2020)
    assert C.parse_months("") == list(range(1, 13)) and C.parse_months("1, 2,7") == [1, 2, 7]
    with pytest.raises(ValueError):
        C.parse_years("2020-2015")
    with pytest.raises(ValueError):
        C.parse_months("0,13")


def test_month_tables(spark):
    rows = [(m,) for m in range(1, 13)]
    before = one(spark, C.steps_before_month(F.col("m")), rows, "m int")
    length = one(spark, C.steps_in_month(F.col("m")), rows, "m int")
    assert sum(length) == 8760 and length[1] == 672
    assert before == [sum(length[:i]) for i in range(12)]


# Published Fourier coefficients (cosine minus i times sine) of the angle of the day, from order 0.
DECLINATION = np.array([0.006918, -0.399912 - 0.070257j, -0.006758 - 0.000907j, -0.002697 - 0.00148j])
TIME_EQUATION = np.array([0.000075, 0.001868 + 0.032077j, -0.014615 + 0.040849j])
EARTH_DISTANCE = np.array([1.00011, 0.034221 - 0.00128j, 0.000719 - 0.000077j])
#: Pieces of the diffuse share: from which clearness on, and the polynomial, highest power first.
DIFFUSE = ((-np.inf, [1.0]), (0.0, [-0.09, 1.0]), (0.22, [12.336, -16.638, 4.388, -0.1604, 0.9511]), (0.8, [0.165]))


def series(coefficients, day):
    """Real part of a polynomial in exp(i angle)."""
    return np.polyval(coefficients[::-1], np.exp(2j * np.pi * (day - 1) / 365)).real


def direction(east_of_south, height):
    return np.stack([np.cos(height) * np.cos(east_of_south), np.cos(height) * np.sin(east_of_south), np.sin(height) + 0 * east_of_south])


def numpy_sun(doy, hour, lat, lon):
    """Cosine of the zenith: the product of the unit vectors to the sun and to the zenith."""
    minutes = 60 * hour + 4 * lon + 229.18 * series(TIME_EQUATION, doy)
    turned = np.pi * (minutes / 720 - 1)
    to_sun, up = direction(turned, series(DECLINATION, doy)), direction(0 * turned, np.radians(lat))
    return (to_sun * up).sum(0).clip(0)


def numpy_solar(doy, hour, lat, lon, ghi, tas, u, v):
    height = numpy_sun(doy, hour, lat, lon)
    outside = 1.367 * series(EARTH_DISTANCE, doy) * height
    clear = np.divide(ghi, outside, out=np.zeros_like(outside), where=outside > 1e-6).clip(0, 1)
    share = np.empty_like(clear)
    for start, powers in DIFFUSE:
        inside = clear > start
        share[inside] = np.polyval(powers, clear[inside]).clip(0, 1)
    diffuse = share * ghi
    beam = np.divide((ghi - diffuse).clip(0), height, out=np.zeros_like(height), where=height > 1e-4)
    on_panel = (height > 0) * (beam + diffuse * (1 + height) / 2)
    warmth = np.stack([np.ones_like(tas), tas, 1000 * on_panel, np.hypot(u, v)])
    heated = np.array([4.3, 0.943, 0.028, -1.528]) @ warmth - 25
    return (0.8056 * on_panel * (1 - 0.005 * heated).clip(0)).clip(0, 1)


@pytest.fixture(scope="module")
def weather():
    rng = np.random.default_rng(3)
    n = 4000
    return dict(
        doy=rng.integers(1, 367, n), hour=rng.uniform(0, 24, n), lat=rng.uniform(-90, 90, n), lon=rng.uniform(-180, 360, n),
        ghi=rng.uniform(0, 1.3, n) * (rng.random(n) > 0.2), tas=rng.uniform(-40, 45, n), u=rng.normal(0, 8, n), v=rng.normal(0, 8, n))


def as_rows(spark, weather):
    import pandas as pd

    pdf = pd.DataFrame(weather | {"i": np.arange(len(weather["doy"]))})
    return spark.createDataFrame(pdf.assign(doy=pdf.doy.astype("int32")))


@pytest.mark.parametrize("whole_days", [True, False])
def test_solar_chain_equals_numpy(spark, weather, whole_days):
    rows = as_rows(spark, weather)
    out = photovoltaic.add_solar_cf(rows, "ghi", "tas", "u", "v", doy="doy", hour="hour", whole_days=whole_days).orderBy("i").toPandas()
    expected = numpy_solar(*[weather[k] for k in ("doy", "hour", "lat", "lon", "ghi", "tas", "u", "v")])
    np.testing.assert_allclose(out["cf"], expected, atol=1e-9)
    assert out["cf"].between(0, 1).all() and (expected > 0).any()


def test_day_table_equals_series(spark):
    days = spark.range(1, 367).select(F.col("id").cast("int").alias("doy"))
    rows = days.select(
        *[solar.cos_zenith(F.col("doy"), F.lit(10.0), F.lit(47.0), F.lit(8.0), w).alias(str(w)) for w in (True, False)],
        *[solar.extraterrestrial_kw(F.col("doy"), F.lit(1.0), w).alias(f"e{w}") for w in (True, False)]).toPandas()
    np.testing.assert_allclose(rows["True"], rows["False"], atol=1e-12)
    np.testing.assert_allclose(rows["eTrue"], rows["eFalse"], atol=1e-12)


def test_sun_is_overhead_at_the_subsolar_point(spark):
    # day 81: declination about 0; at the equator near noon the sun stands at the zenith
    got = one(spark, solar.cos_zenith(F.lit(81), F.lit(12.0), F.lit(0.0), F.lit(0.0)))[0]
    assert got > 0.998
    assert one(spark, solar.cos_zenith(F.lit(81), F.lit(0.0), F.lit(0.0), F.lit(0.0)))[0] == 0.0


def test_missing_wind_policies(spark):
    rows = spark.createDataFrame([(172, 12.0, 30.0, 0.0, 0.8, 20.0, None, 1.0)],
                                 "doy int, hour double, lat double, lon double, ghi_kw double, tas_c double, uas double, vas double")
    zero = photovoltaic.add_solar_cf(rows, doy="doy", hour="hour").first()["cf"]
    calm = photovoltaic.add_solar_cf(rows, doy="doy", hour="hour", missing_wind="zero_wind").first()["cf"]
    assert zero == 0.0 and calm > 0.3
    with pytest.raises(ValueError):
        photovoltaic.add_solar_cf(rows, missing_wind="other")


@pytest.mark.parametrize("column", ["ghi_kw", "tas_c"])
def test_missing_irradiance_or_temperature_gives_zero(spark, column):
    rows = spark.createDataFrame([(172, 12.0, 30.0, 0.0, 0.8, 20.0, 2.0, 1.0)],
                                 "doy int, hour double, lat double, lon double, ghi_kw double, tas_c double, uas double, vas double")
    cf = photovoltaic.add_solar_cf(rows.withColumn(column, F.lit(None).cast("double")), doy="doy", hour="hour").first()["cf"]
    assert cf == 0.0


def test_units(spark):
    ddl = "v double, u string"
    kw = units.irradiance_kw(F.col("v"), F.col("u"), F.lit(True))
    assert one(spark, kw, [(500.0, "W m-2"), (0.5, "kW m-2"), (500.0, None), (None, "W m-2"), (-3.0, "W m**-2")], ddl) == [0.5, 0.5, 0.5, 0.0, 0.0]
    celsius = units.temperature_celsius(F.col("v"), F.col("u"), F.lit(False))
    got = one(spark, celsius, [(273.15, "K"), (10.0, "degC"), (10.0, "deg K"), (10.0, ""), (None, "K")], ddl)
    assert got == [0.0, 10.0, 10.0, 10.0, None]
    ms = units.wind_ms(F.col("v"), F.col("u"))
    assert one(spark, ms, [(36.0, "km/h"), (36.0, "km h-1"), (36.0, "kmhr-1"), (36.0, "m s-1"), (None, "m s-1")], ddl) == [10.0, 10.0, 10.0, 36.0, 0.0]


def test_quantile_test_is_exact(spark):
    rng = np.random.default_rng(5)
    rows, expected = [], {}
    for k in range(300):
        n = int(rng.integers(1, 40))
        values = rng.choice([9.9, 10.0, 10.1, 10.5, 9.0, 30.0], n) if k % 2 else rng.uniform(9.9, 10.1, n)
        q = [0.5, 0.99][k % 2]
        expected[k] = bool(np.percentile(values, q * 100) > 10)
        rows += [(k, float(x)) for x in values] + [(k, None), (k, float("nan"))]
    df = spark.createDataFrame(rows, "k int, v double")
    for parity, q in [(0, 0.5), (1, 0.99)]:
        got = {r["k"]: r["x"] for r in df.where(F.col("k") % 2 == parity).groupBy("k").agg(
            unit_flags.quantile_exceeds(F.col("v"), q, 10.0).alias("x")).collect()}
        assert got == {k: e for k, e in expected.items() if k % 2 == parity}
    assert spark.createDataFrame([(None,)], "v double").agg(unit_flags.quantile_exceeds(F.col("v"), 0.5, 1)).first()[0] is False


def test_power_curve(spark):
    prepared = windpower.prepare_power_curves(
        spark.createDataFrame([("T", x, y * 1000) for x, y in CURVE] + [("T", 28.0, 0.0)], "turbine string, ws double, power_w double"))
    knots = windpower.curve_knots(prepared)
    assert knots[-1] == (25.0, 2500.0) and len(knots) == 5 + 10
    xs = np.concatenate([np.random.default_rng(1).uniform(0, 40, 3000), [0, 3, 5, 13, 25.0, 25.005, 25.01, 30]])
    df = spark.createDataFrame([(float(x),) for x in xs], "ws double")
    got = [r[0] for r in df.select(wind.curve_power(F.col("ws"), knots)).collect()]
    px = [0.0, *[k[0] for k in knots], 25.01]
    py = [0.0, *[k[1] for k in knots], 0.0]
    np.testing.assert_allclose(got, np.interp(xs, px, py), atol=1e-6)
    assert got[-4] == 2500.0 and abs(got[-3] - 1250.0) < 1e-6 and got[-1] == 0.0
    assert one(spark, wind.curve_power(F.lit(None).cast("double"), knots)) == [None]


def test_power_curve_with_power_at_zero_speed(spark):
    # two knots at 0: the later one counts from 0 on
    assert one(spark, wind.curve_power(F.col("x"), [(0.0, 5.0), (2.0, 9.0)]), [(-1.0,), (0.0,), (1.0,)], "x double") == [0.0, 5.0, 7.0]


@pytest.mark.parametrize("last, extra", [(20.0, 10), (24.3, 2), (24.7, 1), (25.0, 0), (24.5, 1)])
def test_power_curve_extension(spark, last, extra):
    df = spark.createDataFrame([("T", 3.0, 0.0), ("T", last, 9000.0), ("T", 26.0, 1.0)], "turbine string, ws double, power_w double")
    knots = windpower.curve_knots(windpower.prepare_power_curves(df))
    assert knots[-1] == (25.0, 9.0) and len(knots) == 2 + extra


def test_wind_cf_missing_wind_is_calm(spark):
    df = spark.createDataFrame([(None, 1.0), (8.0, 6.0)], "uas double, vas double")
    got = [r["cf"] for r in windpower.add_wind_cf(df, CURVE, 2500.0).collect()]
    calm = 1.0 * wind.power_law_ratio() / 3.0 * 20.0 / 2500.0
    assert abs(got[0] - calm) < 1e-12 and got[1] == 1.0
    assert abs(wind.power_law_ratio() - 10 ** (1 / 7)) < 1e-15


def test_longitudes(spark):
    ddl, rows = "x double", [(0.0,), (180.0,), (359.9,), (-0.1,), (360.0,), (359.9999,), (-180.0,)]
    assert np.allclose(one(spark, geo.lon_180(F.col("x")), rows, ddl), [0, -180, -0.1, -0.1, 0, -0.0001, -180])
    assert np.allclose(one(spark, geo.lon_0360(F.col("x")), rows, ddl), [0, 180, 359.9, 359.9, 0, 0, 180])


def test_nearest_on_lattice_equals_search(spark):
    rng = np.random.default_rng(2)
    lat, lon = rng.uniform(-91, 91, 2000), np.concatenate([rng.uniform(0, 360, 1997), [359.97, 359.94, 0.04]])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(lat, lon)], "lat double, lon double")
    got = df.select(geo.nearest_lat_idx(F.col("lat")), geo.nearest_lon_idx(F.col("lon")), geo.nearest_lon_idx(F.col("lon"), True)).collect()
    lats, lons = np.round(90 - np.arange(1801) * 0.1, 1), np.round(np.arange(3600) * 0.1, 1)
    for row, a, b in zip(got, lat, lon):
        assert abs(lats[row[0]] - a) <= np.abs(lats - a).min() + 1e-9
        assert abs(lons[row[1]] - b) <= np.abs(lons - b).min() + 1e-9
    assert got[-3][1] == 3599 and got[-3][2] == 0


def test_lattice_tie_takes_the_smaller_value(spark):
    # 0.25 is exactly between 0.2 and 0.3 only in binary-friendly steps; use 0.5 steps of 0.1 around 0.05
    got = spark.createDataFrame([(0.05, 0.05)], "lat double, lon double").select(
        geo.nearest_lat_idx(F.col("lat")), geo.nearest_lon_idx(F.col("lon"))).first()
    assert got[0] == 900 and got[1] == 0


def test_calendar_features(spark):
    got = spark.sql("select timestamp '2024-03-01 13:30:36' as t").select(C.day_of_year(F.col("t")), C.hour_decimal(F.col("t")), C.step_of_month(F.col("t"))).first()
    assert got[0] == 61 and math.isclose(got[1], 13.51) and got[2] == 13
