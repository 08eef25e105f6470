"""Nulls, completeness, column profiles and validation rules, each in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidepanel.functions import columns as fx
from tidepanel.operators.ordering import hash_sample
from tidepanel.spec import PanelSpec


def _null(c: str) -> Column:
    return F.col(f"`{c}`").isNull()


def _one_row_each(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Aggregate once, then one row per struct."""
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null cells and percentage of every column."""
    share = lambda c: F.try_divide(F.count_if(_null(c)) * 100.0, F.count("*"))
    return _one_row_each(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(_null(c)).alias("nulls"),
                share(c).alias("percent"),
            )
            for c in columns or df.columns
        ],
    )


def null_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """Columns that hold nulls, most nulls first."""
    found = null_counts(df).where("nulls > 0").orderBy(F.desc("nulls"), "column")
    return found if top is None else found.limit(top)


def completeness(df: DataFrame) -> DataFrame:
    """Rows, columns, cells, null cells and completeness in percent."""
    width = len(df.columns)
    nulls = sum((F.count_if(_null(c)) for c in df.columns), F.lit(0))
    return df.agg(F.count("*").alias("n_rows"), nulls.alias("null_cells")).select(
        "n_rows",
        F.lit(width).alias("n_columns"),
        (F.col("n_rows") * width).alias("cells"),
        "null_cells",
        F.try_divide((F.col("n_rows") * width - F.col("null_cells")) * 100.0, F.col("n_rows") * width)
        .alias("completeness"),
    )


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, filled cells and completeness of two tables."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        return completeness(df).select(
            F.lit(name).alias("stage"), "n_rows",
            (F.col("cells") - F.col("null_cells")).alias("filled_cells"), "completeness",
        )

    return stage(before, "before").unionByName(stage(after, "after"))


def null_categories(
    df: DataFrame, categories: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Nulls per named group of columns and its share of all of them.

    A member is a column name, or with a trailing ``*`` any column holding that text.
    """
    def members(names: Sequence[str]) -> list[str]:
        return [
            c for c in df.columns
            if any(n[:-1] in c if n.endswith("*") else n == c for n in names)
        ]

    table = [
        F.struct(
            F.lit(category).alias("category"),
            sum((F.count_if(_null(c)) for c in members(names)), F.lit(0).cast("long")).alias("nulls"),
        )
        for category, names in categories.items()
    ]
    counted = df.agg(F.array(*table).alias("rows"))
    total = F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + r["nulls"])
    return counted.select(total.alias("_total"), F.inline("rows")).select(
        "category", "nulls", F.try_divide(F.col("nulls") * 100.0, "_total").alias("share")
    )


def null_by_month(df: DataFrame, date: str, helper_columns: int = 2) -> DataFrame:
    """Null share of all cells per month of a text date; unreadable dates drop.

    ``helper_columns`` widens the denominator by the filled helper columns (parsed date
    and month) that the original computation counts along.
    """
    width = len(df.columns) + helper_columns
    day = fx.lenient_date(date)
    nulls = sum((F.sum(_null(c).cast("long")) for c in df.columns), F.lit(0))
    return (
        df.withColumn("_month", F.trunc(day, "month").cast("timestamp_ntz"))
        .where(F.col("_month").isNotNull())
        .groupBy(F.col("_month").alias("month"))
        .agg((nulls * 100.0 / (F.count("*") * width)).alias("null_percent"))
    )


def null_indicators(df: DataFrame, keys: Sequence[str], sample: int | None = None, seed: int = 42) -> DataFrame:
    """Cell by cell 0/1 null flags in long form, for the columns that hold any null.

    ``sample`` draws that many rows first, as a null map does for display.
    """
    rows = df if sample is None else hash_sample(df, keys, sample, seed)
    values = [c for c in df.columns if c not in keys]
    flags = rows.select(*keys, *[_null(c).cast("int").alias(c) for c in values])
    long = flags.unpivot(list(keys), values, "column", "is_null")
    holding = null_counts(rows, values).where("nulls > 0").select("column")
    return long.join(F.broadcast(holding), "column", "left_semi")  # a row per column at most


def column_profile(df: DataFrame, approximate: float | None = None) -> DataFrame:
    """Type, filled cells and distinct values of every column.

    Exact counts go through (column, value) pairs, so they take one shuffle of distinct
    values; ``approximate`` gives a relative error for a sketch that shuffles none.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if approximate is not None:
        return _one_row_each(
            df,
            [
                F.struct(
                    F.lit(c).alias("column"), F.lit(t).alias("type"),
                    F.count(F.col(f"`{c}`")).alias("non_null"),
                    F.approx_count_distinct(F.col(f"`{c}`"), approximate).alias("distinct"),
                )
                for c, t in types.items()
            ],
        )
    def cell(f) -> Column:
        # 0.0 and -0.0 are one value, but two texts.
        value = F.col(f"`{f.name}`")
        return (value + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (DoubleType, FloatType)) else value).cast("string")

    text = df.select([cell(f).alias(f.name) for f in df.schema.fields])
    cells = text.unpivot([], list(types), "column", "value")
    per_value = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    typed = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return (
        per_value.groupBy("column")
        .agg(
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
            F.count("value").alias("distinct"),
        )
        .select("column", typed[F.col("column")].alias("type"), "non_null", "distinct")
    )


def validate(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per rule and column: how many rows break it."""
    rules = [("non_negative", c, F.col(c) < 0) for c in spec.nonnegative if c in df.columns]
    rules += [("filled", c, _null(c)) for c in df.columns]
    checked = _one_row_each(
        df,
        [
            F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"),
                     F.count_if(broken).alias("violations"))
            for rule, c, broken in rules
        ],
    )
    return checked.withColumn("passed", F.col("violations") == 0)


def overview(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Size, period, entity count and the key means of a cleaned panel (one row)."""
    means = [c for c in (spec.target, "Production_totale_MW", "Part_renouvelable") if c in df.columns]
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min(spec.ts).alias("first_ts"),
        F.max(spec.ts).alias("last_ts"),
        F.count_distinct(spec.entity).alias("n_entities"),
        *[F.avg(c).alias(f"mean_{c}") for c in means],
    )
