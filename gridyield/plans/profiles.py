"""Mean year of 8760 hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.operators.climate import mean_profile, merge_months, require_twelve_months
from gridyield.operators.filters import select_period
from gridyield.session import ensure_checkpoint_dir


def mean_year(
    cf: DataFrame, mask: DataFrame | None, years=None, how: str = "calendar", steps_per_day: int = 24,
    keys=("energy", "cell"), merge: bool = True,
) -> DataFrame:
    rows = select_period(cf, years) if years else cf
    profile = mean_profile(rows, keys=keys, mask=mask, how=how, steps_per_day=steps_per_day)
    named = profile
    if merge:
        # One mean year at most; the check and the result read what was computed once.
        ensure_checkpoint_dir(cf.sparkSession)
        profile = profile.checkpoint()
        require_twelve_months(profile)
        named = merge_months(profile, steps_per_day)
    return named.withColumnRenamed("position", "hour_of_month").withColumn("cf", F.col("cf").cast("float"))
