"""Neighbour search, interpolation and running totals against brute force."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridyield.operators import accumulation, alignment, climate, filters, interpolation
from gridyield.operators.neighbours import bracket, with_previous

T0 = datetime(2020, 1, 1)


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2020-01-01 {text}:00")


@pytest.fixture(scope="module")
def skewed():
    """One key with a third of all rows, others with gaps of months."""
    rng = np.random.default_rng(11)
    rows = []
    for cell in range(12):
        n = 3000 if cell == 0 else 550
        hours = np.sort(rng.choice(24 * 400, n, replace=False))
        hours = hours[(hours < 24 * 60) | (hours > 24 * 150)] if cell % 3 else hours
        rows += [(cell, T0 + timedelta(hours=int(h)), None if rng.random() < 0.1 else float(rng.normal())) for h in hours]
    return pd.DataFrame(rows, columns=["cell", "t", "v"])


def test_previous_row_equals_brute_force(spark, skewed):
    df = spark.createDataFrame(skewed)
    got = with_previous(df, ["cell"], "t", ["v", "t"], F.trunc("t", "month")).toPandas().sort_values(["cell", "t"])
    want = skewed.sort_values(["cell", "t"])
    lagged = want.groupby("cell")[["v", "t"]].shift(1)
    assert (got["has_previous"].values == lagged["t"].notna().values).all()
    assert (got["previous_t"].astype("datetime64[ns]").values == lagged["t"].astype("datetime64[ns]").values)[got["has_previous"].values].all()
    np.testing.assert_array_equal(got["previous_v"].values.astype(float), lagged["v"].values.astype(float))
    assert len(got) == len(want)


def brute(src, tgt, policy):
    out = []
    for cell, group in tgt.groupby("cell"):
        s = src[src.cell == cell].sort_values("t")
        times, values = s["t"].values.astype("datetime64[us]").astype(np.int64), s["v"].values.astype(float)
        for t in group["t"].values.astype("datetime64[us]").astype(np.int64):
            right = np.clip(np.searchsorted(times, t, side="left"), 0, len(times) - 1)
            left = np.clip(right - 1, 0, len(times) - 1)
            if times[right] == t:
                left = right
            if policy == "nearest" and t <= times[0]:
                left = right = 0
            if policy == "nearest" and t >= times[-1]:
                left = right = len(times) - 1
            w = (t - times[left]) / (times[right] - times[left]) if times[right] != times[left] else 0.0
            value = values[left] * (1 - w) + values[right] * w
            out.append((cell, t, np.nan if policy == "nan" and (t <= times[0] or t >= times[-1]) else value))
    return pd.DataFrame(out, columns=["cell", "t", "v"]).sort_values(["cell", "t"])


@pytest.mark.parametrize("policy", ["nearest", "nan"])
@pytest.mark.parametrize("chunk", [None, "day"])
def test_interpolation_equals_brute_force(spark, skewed, policy, chunk):
    rng = np.random.default_rng(4)
    targets = pd.DataFrame(
        [(int(c), T0 + timedelta(minutes=int(m))) for c in range(12) for m in rng.choice(60 * 24 * 420, 250, replace=False) - 60 * 24 * 5]
        + list(skewed[["cell", "t"]].itertuples(index=False, name=None))[::7]
        + [(c, g["t"].min()) for c, g in skewed.groupby("cell")] + [(c, g["t"].max()) for c, g in skewed.groupby("cell")],
        columns=["cell", "t"]).drop_duplicates()
    source, goals = spark.createDataFrame(skewed), spark.createDataFrame(targets)
    expression = F.to_date("t") if chunk else None
    got = interpolation.interpolate(goals, source, ["v"], policy=policy, chunk=expression).toPandas().sort_values(["cell", "t"])
    want = brute(skewed, targets, policy)
    assert len(got) == len(want)
    np.testing.assert_allclose(got["v"].values.astype(float), want["v"].values, atol=1e-9)


def test_interpolation_hand_cases(spark):
    source = spark.createDataFrame([(1, at("03:00"), 10.0), (1, at("06:00"), 16.0)], "cell int, t timestamp, v double")
    goals = spark.createDataFrame([(1, at(h)) for h in ("04:30", "01:30", "07:30", "03:00")], "cell int, t timestamp")
    near = {r["t"]: r["v"] for r in interpolation.interpolate(goals, source, ["v"]).collect()}
    none = {r["t"]: r["v"] for r in interpolation.interpolate(goals, source, ["v"], policy="nan").collect()}
    assert near == {at("04:30"): 13.0, at("01:30"): 10.0, at("07:30"): 16.0, at("03:00"): 10.0}
    assert none == {at("04:30"): 13.0, at("01:30"): None, at("07:30"): None, at("03:00"): None}
    with pytest.raises(ValueError):
        interpolation.interpolate(goals, source, ["v"], policy="spline")


@pytest.mark.parametrize("policy", ["nearest", "nan"])
def test_shared_axis_equals_own_axes_on_a_dense_grid(spark, policy):
    hours = [T0 + timedelta(hours=3 * k) for k in range(24 * 20)]
    source = pd.DataFrame([(c, t, float(np.sin(i + c)) if (i + c) % 17 else None, float(i * c)) for c in range(5) for i, t in enumerate(hours)],
                          columns=["cell", "t", "a", "b"])
    goals = pd.DataFrame([(c, T0 + timedelta(minutes=90 + 180 * k - 400)) for c in range(5) for k in range(24 * 20 + 4)]
                         + [(c, t) for c in range(5) for t in (hours[0], hours[5], hours[-1])], columns=["cell", "t"])
    s, g = spark.createDataFrame(source), spark.createDataFrame(goals)
    own = interpolation.interpolate(g, s, ["a", "b"], policy=policy)
    table = interpolation.bracket_table(g.select("t").distinct(), s.select("t").distinct(), policy=policy)
    shared = g.join(interpolation.interpolate_shared_axis(table, s, ["a", "b"]), ["cell", "t"], "left")
    a, b = (x.toPandas().sort_values(["cell", "t"]).reset_index(drop=True) for x in (own, shared))
    assert len(a) == len(b) == len(goals)
    for c in ("a", "b"):
        np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), atol=1e-9)


def test_bracket_finds_rows_across_empty_chunks(spark):
    source = spark.createDataFrame([("k", 5.0, "x"), ("k", 995.0, "y")], "k string, o double, name string")
    goals = spark.createDataFrame([("k", 500.0), ("k", 1.0), ("k", 2000.0), ("z", 1.0)], "k string, o double")
    rows = bracket(goals, source, ["k"], "o", ["name"], F.floor(F.col("o") / 10)).collect()
    got = {(r["k"], r["o"]): (r["left"] and r["left"]["name"], r["right"] and r["right"]["name"]) for r in rows}
    assert got == {("k", 500.0): ("x", "y"), ("k", 1.0): (None, "x"), ("k", 2000.0): ("y", None), ("z", 1.0): (None, None)}


@pytest.mark.parametrize("policy, expected", [("zero", [0.0, 5.0, 4.0, 8.0]), ("nan", [None, 5.0, 4.0, 8.0]), ("current", [100.0, 5.0, 4.0, 8.0])])
def test_deaccumulation_hand_cases(spark, policy, expected):
    rows = [(1, at(h), v) for h, v in (("00:00", 100.0), ("01:00", 5.0), ("02:00", 9.0), ("03:00", 8.0))]
    df = spark.createDataFrame(rows, "cell int, t timestamp, ssrd double")
    got = accumulation.deaccumulate(df, "ssrd", policy=policy).orderBy("t").collect()
    assert [r["increment"] for r in got] == expected


def test_accumulate_then_deaccumulate_returns_the_increments(spark):
    rng = np.random.default_rng(8)
    rows, truth = [], {}
    for cell in range(4):
        total = 0.0
        for h in range(24 * 70):
            t = T0 + timedelta(hours=h + 1)
            inc = float(rng.uniform(0, 1000))
            total = inc if t.hour == 1 else total + inc
            rows.append((cell, t, total))
            truth[(cell, t)] = inc
    df = spark.createDataFrame(rows, "cell int, t timestamp, ssrd double")
    for r in accumulation.deaccumulate(df, "ssrd").collect():
        assert abs(r["increment"] - truth[(r["cell"], r["t"])]) < 1e-6


def test_monthly_difference_starts_from_zero_every_month(spark):
    rows = [(1, datetime(2020, 1, 31, 23), 50.0), (1, datetime(2020, 2, 1, 0), 60.0), (1, datetime(2020, 2, 1, 1), 10.0), (1, datetime(2020, 2, 1, 2), None)]
    df = spark.createDataFrame(rows, "cell int, t timestamp, ssrd double")
    got = [r["increment"] for r in accumulation.monthly_difference(df, "ssrd").orderBy("t").collect()]
    assert got == [50.0, 60.0, 0.0, None]


def test_monotonic_violations(spark):
    rows = [("a", i, T0 + timedelta(hours=h)) for i, h in enumerate([0, 1, 2, 2, 5, 4])] + [("b", i, T0 + timedelta(hours=i)) for i in range(6)]
    df = spark.createDataFrame(rows, "file string, step int, t timestamp")
    for block in (1, 2, 100):
        got = {r["file"]: (r["n_steps"], r["n_violations"]) for r in alignment.monotonic_violations(df, ["file"], "step", "t", block).collect()}
        assert got == {"a": (6, 2), "b": (6, 0)}


def test_grid_checks(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, T0), (2, 1.0, 1.0, T0)], "cell int, lat double, lon double, t timestamp")
    b = spark.createDataFrame([(1, 0.0, 5e-7, T0), (2, 1.1, 1.0, T0 + timedelta(hours=1))], "cell int, lat double, lon double, t timestamp")
    assert alignment.grid_report(a, a).isEmpty()
    got = {(r["axis"], r["cell"], r["issue"]) for r in alignment.grid_report(a, b).collect()}
    assert got == {("time", None, "missing_in_reference"), ("cell", 2, "latitude_differs")}
    alignment.require_same_grid(a, {"same": a})
    with pytest.raises(ValueError):
        alignment.require_same_grid(a, {"b": b})


def test_step_index_over_months(spark):
    times = [T0 + timedelta(hours=7 * k) for k in range(500)]
    df = spark.createDataFrame([(t,) for t in times] * 2, "t timestamp")
    got = [(r["t"], r["step"]) for r in filters.step_index(df).orderBy("t").collect()]
    assert got == list(zip(times, range(500)))


def test_period_needs_rows(spark):
    df = spark.createDataFrame([(T0,)], "t timestamp")
    assert filters.select_period(df, "2020", "1").count() == 1
    with pytest.raises(ValueError):
        filters.select_period(df, "2021", require_rows=True)


def test_block_means(spark):
    rows = [(1, i, float(i) if i != 4 else None) for i in range(8)]
    got = filters.block_means(spark.createDataFrame(rows, "cell int, step int, v double"), ["v"]).orderBy("block").collect()
    assert [(r["block"], r["v"]) for r in got] == [(0, 1.0), (1, None)]


@pytest.mark.parametrize("how", ["calendar", "axis", "row"])
def test_mean_year_of_hourly_data(spark, how):
    frames = []
    for year in (2019, 2020):  # 2020 has 29 February
        t = pd.date_range(f"{year}-01-01", f"{year}-12-31 23:00", freq="h")
        frames.append(pd.DataFrame({"cell": 1, "t": t, "cf": (t.month * 1000 + (t.day - 1) * 24 + t.hour) / 1e5 + (year - 2019) * 0.1}))
    df = spark.createDataFrame(pd.concat(frames))
    profile = climate.mean_profile(df, how=how)
    merged = climate.merge_months(profile).toPandas().sort_values("hour_of_year")
    assert list(merged["hour_of_year"]) == list(range(8760)) and (merged["n_years"] == 2).all()
    np.testing.assert_allclose(merged["cf"], (merged["month"] * 1000 + merged["position"]) / 1e5 + 0.05)
    climate.require_twelve_months(profile)
    with pytest.raises(ValueError):
        climate.require_twelve_months(profile.where("month <> 3"))
    with pytest.raises(ValueError):
        climate.mean_profile(df, how="guess")


def test_profile_masks_ocean_and_skips_missing(spark):
    rows = [(1, datetime(y, 1, 1), v) for y, v in ((2018, 0.2), (2019, None), (2020, 0.4))] + [(2, datetime(2018, 1, 1), 0.9)]
    df = spark.createDataFrame(rows, "cell int, t timestamp, cf double")
    mask = spark.createDataFrame([(1, True), (2, False)], "cell int, is_land boolean")
    got = {r["cell"]: (r["cf"], r["n_years"]) for r in climate.mean_profile(df, mask=mask).collect()}
    assert got[1][1] == 2 and abs(got[1][0] - 0.3) < 1e-12 and got[2] == (None, 1)


@pytest.mark.parametrize("rule, hours", [("monthly", 3.0), ("reset", 3.5)])
def test_sunshine_hours(spark, rule, hours):
    # two days with running totals reset at 01:00; sunny increments of 200 W at fixed hours
    sunny, rows, total = {1, 8, 9}, [], 0.0
    for h in range(48):
        t = datetime(2021, 6, 1) + timedelta(hours=h)
        inc = 200 * 3600.0 if (t.hour in sunny or (h == 36)) else 0.0
        total = inc if t.hour == 1 else total + inc
        rows.append((1, t, total))
    df = spark.createDataFrame(rows, "cell int, t timestamp, ssrd double")
    got = climate.mean_sunshine_hours(df, rule=rule).first()["value"]
    # monthly rule: the total falls at 01:00 of the second day, so that hour is lost
    assert got == hours


def test_interpolation_on_a_calendar_without_leap_days(spark):
    # days since an epoch; both axes on the same absolute axis, across what would be 29 February
    source = spark.createDataFrame([(1, 58.0 + k * 0.125, float(k)) for k in range(16)], "cell int, t_days double, v double")
    goals = spark.createDataFrame([(1, 58.0625), (1, 59.0), (1, 40.0), (1, 90.0)], "cell int, t_days double")
    own = interpolation.interpolate(goals, source, ["v"], t="t_days")
    assert {r["t_days"]: r["v"] for r in own.collect()} == {58.0625: 0.5, 59.0: 8.0, 40.0: 0.0, 90.0: 15.0}
    table = interpolation.bracket_table(goals.select("t_days"), source.select("t_days"), t="t_days")
    shared = interpolation.interpolate_shared_axis(table, source, ["v"], t="t_days")
    assert {r["t_days"]: r["v"] for r in shared.collect()} == {58.0625: 0.5, 59.0: 8.0, 40.0: 0.0, 90.0: 15.0}
