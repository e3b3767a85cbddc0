"""Registration of a query together with its SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.checks.relations import Data, with_clause

DIGITS = 6
# Means of short decimals often end exactly half-way between two rounded values, where the last bit
# of a sum decides. Both sides are shifted by the same amount before rounding, which moves the
# half-way points to numbers that do not occur.
SHIFT = 1.3e-8
ALWAYS_INTEGER = {"cell"}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def finish(df: DataFrame) -> DataFrame:
    """Comparable form: doubles at six digits (ties moved, no negative zero), wall-clock timestamps, plain integers."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind in ("double", "float"):
            c = F.round(c.cast("double") + F.lit(SHIFT), DIGITS) + F.lit(0.0)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        columns.append(c.alias(name))
    return df.select(*columns)


def rounded(needs: str, columns: str, body: str) -> str:
    """SQL of a case. ``columns``: names, doubles marked ``~``, integers ``#``."""
    shown = []
    for item in columns.split():
        name = item.strip("~#")
        if item.startswith("~"):
            shown.append(f"round({name} + {SHIFT}, {DIGITS}) + 0.0e0 as {name}")
        elif item.startswith("#") or name in ALWAYS_INTEGER:
            shown.append(f"cast({name} as bigint) as {name}")
        else:
            shown.append(name)
    return f"{with_clause(needs.split())}select {', '.join(shown)} from ({body}) result"


def case(name: str, needs: str = "", columns: str = "", sql: str | None = None):
    """Register ``function(data) -> DataFrame`` under a key, with the SQL that must give the same rows."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        names = [c.strip("~#") for c in columns.split()]
        QUERIES[name] = lambda spark, folder: finish(function(Data(spark, folder)).select(*names))
        if sql is not None:
            ORACLES[name] = rounded(needs, columns, sql)
        return function

    return register
