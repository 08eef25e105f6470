"""From raw text columns to a typed, hourly, gap-free panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.operators.ordering import interpolate, with_neighbours
from tidepanel.spec import PanelSpec


def rename_and_drop(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Readable names; unwanted columns go. Names that are absent are ignored."""
    return df.withColumnsRenamed(spec.renames).drop(*spec.unwanted)


def cast_numbers(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Text measures and rates to double (decimal comma allowed, bad text to null)."""
    return df.withColumns({c: fx.locale_number(c) for c in spec.numeric(df)})


def cast_losses(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells that would turn null: read as they are, and after the decimal-comma fix."""
    counts = []
    for c in columns:
        filled = F.col(c).isNotNull()
        counts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(filled & fx.point_number(c).isNull()).alias("lost_plain"),
                F.count_if(filled & fx.locale_number(c).isNull()).alias("lost_locale"),
            )
        )
    return df.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def assemble_timestamp(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Timestamp from Date and Heure, else from Date_Heure; neither is an error."""
    if {"Date", "Heure"} <= set(df.columns):
        return df.withColumn(spec.ts, fx.joined_timestamp("Date", "Heure"))
    if "Date_Heure" in df.columns:
        return df.withColumn(spec.ts, F.to_timestamp_ntz(F.col("Date_Heure")))
    raise ValueError(f"no Date/Heure or Date_Heure column to build {spec.ts} from: {df.columns}")


def row_gaps(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Seconds to the previous row of the entity; null on its first row."""

    def gap(w: Window) -> list[dict[str, Column]]:
        # Zone-less timestamps subtract to an interval without passing through a zone.
        step = F.col(spec.ts) - F.lag(spec.ts).over(w)
        seconds = step.cast("interval second").cast("decimal(20,6)").cast("double")
        return [{"gap_seconds": seconds}]

    return with_neighbours(df, spec, 1, gap)


def granularity(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The most frequent gap, the smallest of them on a tie (one row).

    Counting the gaps first keeps the state at one row per distinct gap in every task.
    """
    gaps = row_gaps(df.select(spec.entity, spec.ts, *spec.tie_break), spec)
    counts = gaps.where("gap_seconds is not null").groupBy("gap_seconds").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "gap_seconds").limit(1)


def regularise(df: DataFrame, spec: PanelSpec, seconds: int = 3600, chunk: int = 1000) -> DataFrame:
    """A row for each step between an entity's first and last time, with nulls where it had none.

    What goes by position, such as interpolation and lags, then goes by time. Rows between the steps
    and rows without an entity or a time stay; several rows of one time stay too. An entity's
    steps are made ``chunk`` at a time, so that a long period is no long array.
    """
    e, t = spec.entity, spec.ts
    ends = df.where(F.col(e).isNotNull() & F.col(t).isNotNull()).groupBy(e).agg(F.min(t).alias("_a"), F.max(t).alias("_b"))
    length = (F.col("_b") - F.col("_a")).cast("interval second").cast("decimal(20,6)").cast("double")
    zero = F.lit(0).cast("long")
    cut = ends.select(e, "_a", F.floor(length / seconds).alias("_n")).select("*", F.explode(F.sequence(zero, F.col("_n"), F.lit(chunk).cast("long"))).alias("_k"))
    step = F.explode(F.sequence("_k", F.least(F.col("_k") + chunk - 1, F.col("_n")))).alias("_k")
    later = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("_k") * seconds).cast("decimal(18,6)"))
    grid = cut.select(e, "_a", step).select(e, (F.col("_a") + later).alias(t))
    return grid.join(df, [e, t], "full").select(df.columns)


def hourly_rollup(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Half-hourly rows to hours: energy = half the sum, rates averaged, first label kept.

    A measure that is null throughout an hour gives 0, a rate gives null. Rows whose
    entity or timestamp is null drop. The aggregation is partial before its one shuffle,
    so a hot entity shrinks to its hours inside each task.
    """
    measures = [c for c in spec.measures if c in df.columns]
    aggs = [(F.coalesce(F.sum(c), F.lit(0.0)) / 2).alias(c) for c in measures]
    aggs += [F.avg(c).alias(c) for c in spec.rates(df)]
    if spec.label in df.columns:
        when = F.when(F.col(spec.label).isNotNull(), F.struct(spec.ts, *spec.tie_break))
        aggs.append(F.min_by(spec.label, when).alias(spec.label))
    rows = df.where(F.col(spec.entity).isNotNull() & F.col(spec.ts).isNotNull())
    return (
        rows.groupBy(spec.entity, fx.floor_to(spec.ts, 60).alias("_hour"))
        .agg(*aggs)
        .withColumnRenamed("_hour", spec.ts)
        .select(spec.entity, spec.ts, *[a for a in df.columns if a in {*measures, *spec.rates(df), spec.label}])
    )


def zero_idle_rates(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """A rate is 0 where the measure it belongs to (``TCO_x`` to ``x_MW``) is 0 or null."""
    changed = {}
    for c in spec.rates(df):
        parts = c.split("_")
        source = f"{parts[1]}_MW" if len(parts) > 1 else None
        if source in df.columns:
            idle = F.col(source).isNull() | (F.col(source) == 0)
            changed[c] = F.when(idle, 0.0).otherwise(F.col(c))
    return df.withColumns(changed)


def fill_zero(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.na.fill(0.0, spec.numeric(df))


def fill_gaps(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Idle rates, then interpolated sources, then zeros, in this order."""
    ruled = zero_idle_rates(df, spec)
    sources = [c for c in spec.sources if c in df.columns]
    return fill_zero(interpolate(ruled, spec, sources), spec)


def derive(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Calendar columns, total and renewable production, renewable share, balance."""
    total = fx.sum_present([c for c in spec.sources if c in df.columns])
    renewable = fx.sum_present([c for c in spec.renewables if c in df.columns])
    return (
        df.withColumns(fx.calendar(spec.ts))
        .withColumns({"Production_totale_MW": total, "Production_renouvelable_MW": renewable})
        .withColumns(
            {
                "Part_renouvelable": fx.share("Production_renouvelable_MW", "Production_totale_MW"),
                "Balance_MW": F.col("Production_totale_MW") - F.col(spec.target),
            }
        )
    )
