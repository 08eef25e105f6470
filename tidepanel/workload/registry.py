"""The queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def tidy(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Doubles rounded so that engines can be compared; ``other`` names columns with their own digits.

    A mean of 32 prices ends in an exact half at the seventh digit, which the last bit of a
    sum tips either way. A nudge far below the rounding step sends all halves up.
    """

    def rounded(name: str) -> Column:
        d = other.get(name, digits)
        return F.round(F.col(f"`{name}`") + F.lit(float(f"37e-{d + 3}")), d) + F.lit(0.0)

    return df.withColumns({f.name: rounded(f.name) for f in df.schema.fields if isinstance(f.dataType, DoubleType)})
