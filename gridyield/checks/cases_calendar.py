"""Axes of calendars without leap days: numbers of days since a date."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridyield.checks.registry import case
from gridyield.functions.calendars import calendar_of, with_calendar
from gridyield.operators import accumulation, climate, regions

# The hourly table moved to a day axis that starts 55 days earlier, in December of a year without a leap day.
SINCE, SHIFT = (2023, 11, 20), 55
NOLEAP, DAYS_360 = calendar_of("noleap", SINCE), calendar_of("360_day", SINCE)
START = "timestamp '2024-01-01 00:00:00'"
HOURS = f"(date_diff('hour', {START}, t) + {24 * SHIFT})"


def noleap_sql(table: str = "accum_months") -> str:
    """Year, month, day and hour by arithmetic on whole hours."""
    days = f"(h // 24 + {2023 * 365 + 304 + 19})"
    doy = f"({days} % 365)"
    starts = (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)
    month = "case " + " ".join(f"when {doy} >= {n} then {m}" for m, n in reversed(list(enumerate(starts, 1)))) + " end"
    before = "case " + " ".join(f"when {doy} >= {n} then {n}" for n in reversed(starts)) + " end"
    return f"""select cell, h / 24.0e0 as t, h, rsds, ssrd, {days} // 365 as year, {month} as month, {doy} + 1 as doy,
        {doy} - {before} + 1 as day, h % 24 as hour from (select a.cell, {HOURS} as h, a.ssrd, a.tas as rsds from {table} a) x"""


def on_days(df):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    hours = (F.unix_timestamp("t") - F.unix_timestamp(start)) / 3600 + 24 * SHIFT
    return df.withColumnRenamed("tas", "rsds").withColumn("t", hours / 24.0)


@case("calendar_noleap", "accum_months", "cell ~t #year #month #doy ~hour", f"select cell, t, year, month, doy, cast(hour as double) as hour from ({noleap_sql()}) x")
def _(d):
    return with_calendar(on_days(d.accum_months), NOLEAP)


@case("calendar_360_day", "accum_months", "cell ~t #year #month #doy", f"""
    select cell, h / 24.0e0 as t, n // 360 as year, n % 360 // 30 + 1 as month, n % 360 + 1 as doy
    from (select cell, h, h // 24 + {2023 * 360 + 10 * 30 + 19} as n from (select cell, {HOURS} as h from accum_months) x) y""")
def _(d):
    return with_calendar(on_days(d.accum_months), DAYS_360)


@case("deaccumulate_noleap", "accum_months", "cell ~t ~increment", f"""
    select cell, t, case when raw is not null then greatest(case when raw < 0 then ssrd else raw end, 0.0e0) end as increment from (
      select *, case when hour = 1 then ssrd when prev_n is null or year * 12 + month - prev_n > 1 then ssrd else ssrd - prev end as raw from (
        select *, lag(ssrd) over w as prev, lag(year * 12 + month) over w as prev_n from ({noleap_sql()}) n
        window w as (partition by cell order by h)) p) q""")
def _(d):
    return accumulation.deaccumulate(on_days(d.accum_months), "ssrd", policy="current", calendar=NOLEAP)


@case("month_position_noleap", "accum_months", "cell ~t #year #month #position", f"select cell, t, year, month, (day - 1) * 24 + hour as position from ({noleap_sql()}) n")
def _(d):
    return climate.month_position(on_days(d.accum_months), ["cell"], "t", "calendar", 24, NOLEAP)


@case("annual_mean_noleap", "accum_months", "cell #year ~rsds", f"select cell, year, avg(rsds) as rsds from ({noleap_sql()}) n group by 1, 2")
def _(d):
    return regions.cell_year_mean(with_calendar(on_days(d.accum_months), NOLEAP), (), "rsds")


@case("mean_sunshine_hours_noleap", "accum_months", "cell ~value", f"""
    select cell, avg(s) as value from (
      select cell, year, month, day, count(*) filter (where inc / 3600.0e0 > 120.0e0) as s from (
        select *, greatest(ssrd - coalesce(lag(ssrd) over (partition by cell, year, month order by h), 0.0e0), 0.0e0) as inc
        from ({noleap_sql()}) n) x group by 1, 2, 3, 4 having count(ssrd) > 0) y group by cell""")
def _(d):
    return climate.mean_sunshine_hours(on_days(d.accum_months), calendar=NOLEAP)
