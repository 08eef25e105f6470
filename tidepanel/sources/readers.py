"""Sources: raw text tables and cleaned panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidepanel.spec import ENERGY, PanelSpec


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_raw(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Semicolon-separated UTF-8 text with a header, every column as text.

    Types are settled by the cast step; inferring them here would read the data twice and
    hide values such as ``ND``. Without ``columns`` the names come from the header.
    """
    reader = spark.read.option("sep", ";").option("header", True).option("encoding", "UTF-8")
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return reader.csv(path)


def clean_schema(spec: PanelSpec = ENERGY) -> StructType:
    """Schema of the cleaned panel."""
    rates = [c for c in spec.renames.values() if any(m in c for m in spec.rate_marks)]
    double, integer, text = DoubleType(), IntegerType(), StringType()
    fields = [(spec.entity, text), (spec.ts, TimestampNTZType())]
    fields += [(c, double) for c in (*spec.measures, *rates)]
    fields += [(spec.label, text)] if spec.label else []
    fields += [(c, integer) for c in ("Year", "Month", "Day", "Hour", "DayOfWeek", "IsWeekend", "Quarter")]
    fields += [("Season", text)]
    fields += [
        (c, double)
        for c in ("Production_totale_MW", "Production_renouvelable_MW", "Part_renouvelable", "Balance_MW")
    ]
    return StructType([StructField(n, t) for n, t in fields])


def read_panel(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A cleaned panel as Parquet (the hand-off between stages) or CSV.

    Parquet files bring their own types; ``schema`` picks and types columns by name. CSV needs a
    schema (default: the cleaned panel's), whose names must be the header's, in its order.
    """
    if fmt == "parquet":
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return spark.read.schema(schema or clean_schema()).option("header", True).option("enforceSchema", False).csv(path)
