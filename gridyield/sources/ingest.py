"""From tables as delivered to the canonical tall form."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.functions.nulls import finite

# Accepted names, in order of preference.
TIME_NAMES = ("time", "valid_time", "t")
LAT_NAMES = ("lat", "latitude")
LON_NAMES = ("lon", "longitude")
CF_NAMES = {
    "solar": ("solar_cf", "pv_cf", "cf"),
    "wind": ("wind_cf", "onshore_wind_cf", "cf"),
    "auto": ("solar_cf", "wind_cf", "pv_cf", "onshore_wind_cf", "cf"),
}


@dataclass(frozen=True)
class NameRule:
    """How a column is recognised: exact names in order, then optionally a part of the name, then being alone."""

    exact: tuple[str, ...]
    part: str | None = None
    alone: bool = False

    def guesses(self, available: list[str]) -> Iterator[list[str]]:
        """Lists of columns, best guess first; a list of one decides."""
        yield from ([n] for n in self.exact if n in available)
        if self.part is not None:
            yield [n for n in available if self.part in n.lower()]
        if self.alone:
            yield available


def resolve(available: Iterable[str], rule: NameRule, what: str) -> str:
    """The column a rule points to; KeyError when none or several are left."""
    have = list(available)
    certain = next((guess for guess in rule.guesses(have) if len(guess) == 1), None)
    if certain is None:
        raise KeyError(f"cannot tell {what} among {have}")
    return certain[0]


def pick_name(available: Iterable[str], candidates: Sequence[str]) -> str:
    return resolve(available, NameRule(tuple(candidates)), f"one of {list(candidates)}")


def pick_variable(available: Iterable[str], preferred: str, suffix: str = "_bcsd") -> str:
    """``<preferred>_bcsd``, else the plain name, else the only variable."""
    return resolve(available, NameRule((preferred + suffix, preferred), alone=True), f"variable {preferred}")


def pick_cf_variable(available: Iterable[str], technology: str = "auto") -> str:
    """Known names of the technology, else the only name with ``cf``, else the only variable."""
    return resolve(available, NameRule(CF_NAMES[technology], part="cf", alone=True), "the capacity factor")


def canonical_coordinates(df: DataFrame) -> DataFrame:
    names = df.columns
    return df.withColumnsRenamed(
        {
            pick_name(names, TIME_NAMES): "t",
            pick_name(names, LAT_NAMES): "lat",
            pick_name(names, LON_NAMES): "lon",
        }
    )


def several_values(df: DataFrame, extra: Sequence[str], file: Sequence[str] = ()) -> DataFrame:
    """Per file whether an extra dimension has more than one value. Extremes merge map-side, so one huge file is no hot spot."""
    return df.groupBy(*file).agg(*[F.coalesce(F.min(c) != F.max(c), F.lit(False)).alias(c) for c in extra])


def squeeze(df: DataFrame, extra: Sequence[str], file: Sequence[str] = ()) -> DataFrame:
    """Drop extra dimensions after checking that each has one value per file."""
    if not extra:
        return df
    condition = F.lit(False)
    for c in extra:
        condition = condition | F.col(c)
    bad = several_values(df, extra, file).where(condition).head(1)
    if bad:
        raise ValueError(f"extra dimensions are not single-valued: {bad}")
    return df.drop(*extra)


def canonical_values(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """NaN and infinities to NULL."""
    return df.withColumns({v: finite(F.col(v)) for v in values})


def canonical_table(df: DataFrame, preferred: str, dimensions: Sequence[str] = ("cell",), file: Sequence[str] = ()) -> DataFrame:
    """One variable in canonical form: coordinates renamed, extra dimensions gone, value named ``preferred``."""
    named = canonical_coordinates(df)
    known = {"t", "lat", "lon", *dimensions, *file}
    numeric = {"float", "double"}
    variables = [c for c, kind in named.dtypes if c not in known and kind in numeric]
    variable = pick_variable(variables, preferred)
    extra = [c for c in named.columns if c not in known and c not in variables]
    plain = squeeze(named, extra, file)
    kept = [c for c in plain.columns if c in known]
    return canonical_values(plain.select(*kept, F.col(variable).alias(preferred)), [preferred])


def cells_of(df: DataFrame) -> DataFrame:
    """The lattice of a table: one row per cell."""
    return df.groupBy("cell").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
