"""Grouped summaries, top-k entities, distribution summaries."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.operators.ordering import quantiles, value_ladder
from tidepanel.session import write_table


def mean_by(
    df: DataFrame, keys: Mapping[str, Column] | Sequence[str], measures: Sequence[str], spread: bool = False
) -> DataFrame:
    """Means (and sample standard deviations) of measures by group."""
    if isinstance(keys, Mapping):
        groups = [c.alias(n) for n, c in keys.items()]
    else:
        groups = [F.col(k) for k in keys]
    aggs = [F.avg(m).alias(f"mean_{m}") for m in measures]
    if spread:
        aggs += [F.stddev_samp(m).alias(f"std_{m}") for m in measures]
    return df.groupBy(*groups).agg(*aggs)


def yearly(df: DataFrame, ts: str, measures: Sequence[str]) -> DataFrame:
    return mean_by(df, {"year": F.year(ts)}, measures)


def seasonal(df: DataFrame, ts: str, measures: Sequence[str]) -> DataFrame:
    """Mean and sample deviation per season, in season order number; error bar = std / 100."""
    number = fx.season_number(fx.season(F.month(ts)))
    found = mean_by(df, {"season_num": number}, measures, spread=True)
    return found.withColumns({f"bar_{m}": F.col(f"std_{m}") / 100 for m in measures})


def weekly(df: DataFrame, ts: str, measures: Sequence[str]) -> DataFrame:
    return mean_by(df, {"weekday": F.weekday(ts)}, measures)


def hourly(df: DataFrame, ts: str, measures: Sequence[str]) -> DataFrame:
    return mean_by(df, {"hour": F.hour(ts)}, measures)


def hourly_by_season(
    df: DataFrame, ts: str, measure: str, seasons: Sequence[str] = ("Winter", "Summer")
) -> DataFrame:
    """Mean by hour for the given seasons, in one pass."""
    named = df.withColumn("season", fx.season(F.month(ts))).where(F.col("season").isin(*seasons))
    return mean_by(named, {"season": F.col("season"), "hour": F.hour(ts)}, [measure])


def hourly_for(df: DataFrame, entity: str, ts: str, measure: str, names: Sequence[str]) -> DataFrame:
    """Mean by hour for entities found by name regardless of accents and case."""
    wanted = [fx.accent_key(F.lit(n)) for n in names]
    chosen = df.withColumn("key", fx.accent_key(entity)).where(F.col("key").isin(*wanted))
    return mean_by(chosen, {"key": F.col("key"), "hour": F.hour(ts)}, [measure])


def balance(df: DataFrame, entity: str, measure: str) -> DataFrame:
    """Mean, deviation, sign and error bar (std / 10) per entity, lowest mean first."""
    found = mean_by(df, [entity], [measure], spread=True)
    return found.withColumns(
        {
            "direction": fx.sign_name(f"mean_{measure}"),
            "bar": F.col(f"std_{measure}") / 10,
        }
    ).orderBy(f"mean_{measure}", entity)


def top_entities(df: DataFrame, entity: str, measure: str, k: int) -> DataFrame:
    """The k entities with the largest mean (k rows leave each task)."""
    means = df.groupBy(entity).agg(F.avg(measure).alias("mean"))
    return means.where("mean is not null").orderBy(F.desc("mean"), entity).limit(k)


def rows_of_top(df: DataFrame, entity: str, measure: str, k: int) -> DataFrame:
    """Rows of the k top entities; k rows are broadcast."""
    return df.join(F.broadcast(top_entities(df, entity, measure, k).select(entity)), entity, "left_semi")


def row_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every column as percentage of the row's sum (null where the sum is 0)."""
    total = fx.sum_present(columns)
    return df.withColumns({c: F.try_divide(F.col(c), total) * 100 for c in columns})


def mix_of_top(df: DataFrame, entity: str, rank_by: str, sources: Sequence[str], k: int = 3) -> DataFrame:
    """Mean of each source for the k top entities, as shares of their row."""
    # One pass: the ranking mean and the source means come from the same aggregate.
    means = df.groupBy(entity).agg(F.avg(rank_by).alias("_rank"), *[F.avg(s).alias(s) for s in sources])
    best = means.where("_rank is not null").orderBy(F.desc("_rank"), entity).limit(k)
    return row_shares(best.drop("_rank"), sources)


def overall_mix(df: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Mean of each source over the table and its share of the sum of means."""
    means = df.agg(*[F.avg(s).alias(s) for s in sources])
    long = means.withColumn("_total", fx.sum_present(sources)).unpivot(
        ["_total"], list(sources), "source", "mean"
    )
    return long.select("source", "mean", F.try_divide("mean", "_total").alias("share")).withColumn(
        "share", F.col("share") * 100
    )


def extent(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Mean, minimum and maximum of measures (one row each)."""
    rows = [
        F.struct(F.lit(m).alias("measure"), F.avg(m).alias("mean"),
                 F.min(m).cast("double").alias("min"), F.max(m).cast("double").alias("max"))
        for m in measures
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The mode of a column, the lowest on ties; values are counted before the top-1."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(1)


def _fenced(df: DataFrame, group: str, measure: str) -> tuple[DataFrame, DataFrame]:
    """The ladder of values per group, and the quartiles with the fences 1.5 IQR beyond them."""
    ladder = value_ladder(df.where(F.col(group).isNotNull()), [group], measure)
    found = quantiles(ladder, [group], measure, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fences = found.withColumns(
        {
            "_low": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
            "_high": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
        }
    )
    # Written, the fences have a known size: Spark broadcasts them if they are small and
    # splits a hot group in a sort-merge join if they are not.
    fences = write_table(fences, "fences")
    return ladder, fences


def box_summary(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Box plot numbers per group: mean, quartiles, whiskers (1.5 IQR) and outlier count.

    Everything after the first count runs on distinct values, and the quartiles are read
    off an ordered ladder, so no task has to hold a whole group.
    """
    ladder, fences = _fenced(df, group, measure)
    v, n = F.col(measure), F.col("n_at")
    inside = v.between(F.col("_low"), F.col("_high"))
    return (
        ladder.drop("total").join(fences, group)
        .groupBy(group, "n", "q1", "median", "q3")
        .agg(
            (F.sum(v * n) / F.sum(n)).alias("mean"),
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(n)).alias("outliers"),
        )
    )


def box_fliers(df: DataFrame, group: str, measure: str) -> DataFrame:
    """(group, value, n): the different values outside the whiskers of :func:`box_summary` and their rows."""
    ladder, fences = _fenced(df, group, measure)
    v = F.col(measure)
    outside = ladder.join(fences.select(group, "_low", "_high"), group).where(~v.between(F.col("_low"), F.col("_high")))
    return outside.select(group, measure, F.col("n_at").alias("n"))


def violin_summary(df: DataFrame, group: str, measure: str, k: int = 5, points: int = 100) -> DataFrame:
    """Density curves of the k groups with the largest mean, on ``points`` grid points.

    Gaussian kernel, Scott bandwidth. The grid is evaluated on distinct values with their
    counts, in Arrow batches: a task hands on its sums, a row per group and grid point.
    """
    chosen = rows_of_top(df, group, measure, k)
    ladder = value_ladder(chosen, [group], measure)
    middle = quantiles(ladder, [group], measure, {"median": 0.5}).drop("n")
    v, n = F.col(measure), F.col("n_at")
    # Values have been merged into counts: the moments are weighted ones.
    # Every table by group has at most k rows, which bounds the broadcasts.
    size = ladder.groupBy(group).agg(
        F.sum(n).alias("n"), (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.min(v).alias("lo"), F.max(v).alias("hi"),
    )
    spread = (
        ladder.join(F.broadcast(size), group)
        .groupBy(group, "n", "mean", "lo", "hi")
        .agg(F.sum((v - F.col("mean")) ** 2 * n).alias("_ss"))
        .withColumn("h", F.sqrt(F.try_divide("_ss", F.col("n") - 1)) * F.pow("n", F.lit(-0.2)))
        .join(F.broadcast(middle), group)
    )
    spread = write_table(spread, "violins")  # k rows, used twice
    step = (F.col("hi") - F.col("lo")) / F.lit(points - 1)
    norm = F.col("n") * F.col("h") * F.sqrt(2 * F.pi())

    fields = [group, "n", "mean", "median", "lo", "hi", "h"]
    given = ladder.join(F.broadcast(spread), group).select(group, F.col(measure).cast("double").alias("v"), F.col("n_at").cast("double"), "lo", "hi", "h")
    kind = df.schema[group].dataType.simpleString()
    parts = given.mapInArrow(_kernel_sums(points), f"{NAME} {kind}, point int, s double")
    totals = parts.groupBy(NAME, "point").agg(F.sum("s").alias("_sum"))
    named = spread.select(F.col(group).alias(NAME), *[c for c in fields if c != group])
    sums = totals.join(F.broadcast(named), NAME).withColumnRenamed(NAME, group)
    return (
        sums.withColumn("x", F.col("lo") + F.col("point") * step)
        .withColumn("density", F.try_divide("_sum", norm))
        .select(group, "n", "mean", "median", "lo", "hi", "point", "x", "density")
    )


NAME = "_group"


def _kernel_sums(points: int):
    """Sums of the kernels of a task's values (group, v, n, lo, hi, h) at every grid point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, kind = {}, None
        for batch in batches:
            codes, kind = batch.column(0).dictionary_encode(), batch.column(0).type
            v, n, lo, hi, h = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[1:])
            for i, name in enumerate(codes.dictionary.to_pylist()):
                own = np.flatnonzero(codes.indices.to_numpy() == i)
                one = own[0]
                grid = lo[one] + np.arange(points) * ((hi[one] - lo[one]) / (points - 1))
                here = sums.setdefault(name, np.zeros(points))
                for at in range(0, len(own), 2048):  # a block of values by grid points in memory
                    part = own[at : at + 2048]
                    with np.errstate(divide="ignore", invalid="ignore"):  # no spread, no density
                        here += np.exp(-0.5 * ((grid[:, None] - v[part]) / h[one]) ** 2) @ n[part]
        for name, total in sums.items():
            columns = [pa.array([name] * points, kind), pa.array(range(points), pa.int32()), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, [NAME, "point", "s"])

    return run


def histogram(df: DataFrame, measure: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the range of a measure; the last bin is closed.

    Every bin is listed, empty ones with 0; ``density`` integrates to 1.
    """
    rows = df.where(F.col(measure).isNotNull()).select(F.col(measure).cast("double").alias("_v"))
    ends = rows.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("n")).alias("e"))
    e = ends.scalar()
    width = (e["hi"] - e["lo"]) / bins
    # A constant measure has no width; it falls into the first bin.
    place = F.coalesce(F.floor(F.try_divide(F.col("_v") - e["lo"], width)), F.lit(0))
    placed = rows.select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
    counted = placed.groupBy("bin").agg(F.count("*").alias("count"))
    # The ends are one scalar subquery, computed once for both uses.
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), e.alias("e"))
    step = (F.col("e.hi") - F.col("e.lo")) / bins
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.col("e.lo") + F.col("bin") * step).alias("left"),
        (F.col("e.lo") + (F.col("bin") + 1) * step).alias("right"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.try_divide(F.coalesce("count", F.lit(0)), F.col("e.n") * step).alias("density"),
    )


def first_rows_of_mode(df: DataFrame, entity: str, ts: str, n: int = 168, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first n rows, in time, of the most frequent entity; ``tie_break`` orders rows of one time."""
    mode = most_frequent(df, entity).select(entity)
    return df.join(F.broadcast(mode), entity, "left_semi").orderBy(ts, *tie_break).limit(n)


def percent_of_total(df: DataFrame, value: str, name: str = "percent") -> DataFrame:
    """Share of a column's sum; for small result tables."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value) * 100.0, total))


def ranked(df: DataFrame, by: str, name: str = "place", descending: bool = True) -> DataFrame:
    """Number the rows of a small result table from its best row."""
    order = F.desc(by) if descending else F.asc(by)
    return df.withColumn(name, F.row_number().over(Window.orderBy(order)))
