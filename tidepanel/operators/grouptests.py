"""Tests of a measure between the groups of a category.

Every function takes a list of (measure, category) pairs and answers all of them from
group moments or value counts; the values of a group are never gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.functions.tails import tail
from tidepanel.operators.ordering import average_rank, value_ladder
from tidepanel.operators.profiles import rows_of_top
from tidepanel.session import write_table

Test = tuple[str, str]
_NAMES = ["quantitative", "qualitative"]


def _long(df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(m).alias("quantitative"), F.lit(c).alias("qualitative"),
            F.col(c).cast("string").alias("group"), fx.missing_if_nan(m).alias("value"),
        )
        for m, c in tests
    ]
    return df.select(F.inline(F.array(*rows))).where(F.col("value").isNotNull())


def group_moments(df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """Count, mean and population variance per test and group."""
    return _long(df, tests).groupBy(*_NAMES, "group").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var")
    )


def anova(df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """F with its degrees of freedom, and eta squared with its label.

    Rows without a group enter the total sum of squares only, as in the original.
    """
    moments = group_moments(df, tests)
    n, m, v = F.col("n"), F.col("mean"), F.col("var")
    grouped = F.col("group").isNotNull()
    inside = F.when(grouped, n)
    grand = moments.groupBy(*_NAMES).agg(
        (F.sum(inside * m) / F.sum(inside)).alias("mean_grouped"),
        (F.sum(n * m) / F.sum(n)).alias("mean_all"),
    )
    sums = (
        moments.join(grand, _NAMES)
        .groupBy(*_NAMES)
        .agg(
            F.sum(inside).alias("n"),
            F.count_if(grouped).alias("n_groups"),
            F.sum(inside * (m - F.col("mean_grouped")) ** 2).alias("between"),
            F.sum(inside * v).alias("within"),
            F.sum(inside * (m - F.col("mean_all")) ** 2).alias("ssb"),
            F.sum(n * (v + (m - F.col("mean_all")) ** 2)).alias("sst"),
        )
    )
    d1, d2 = F.col("n_groups") - 1, F.col("n") - F.col("n_groups")
    eta = F.try_divide("ssb", "sst")
    ratio = F.try_divide(F.try_divide("between", d1), F.try_divide("within", d2))
    return sums.select(
        *_NAMES, "n", "n_groups", ratio.alias("anova_f"),
        eta.alias("eta_squared"), fx.effect(eta).alias("effect_size"),
    )


def with_anova_p(found: DataFrame) -> DataFrame:
    d1, d2 = F.col("n_groups") - 1, F.col("n") - F.col("n_groups")
    return found.withColumn("anova_p", tail("f_upper", "anova_f", d1, d2))


def kruskal(df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """Kruskal-Wallis H, corrected for ties, as (n - 1) times the explained share of ranks."""
    cells = write_table(
        _long(df, tests).where("group is not null").groupBy(*_NAMES, "group", "value").agg(F.count("*").alias("w")), "cells"
    )
    ladder = value_ladder(cells, _NAMES, "value", weight="w")
    rungs = ladder.select(*_NAMES, "value", "n_at", average_rank().alias("rank"), F.col("total").alias("n"))
    middle = (F.col("n") + 1) / 2.0
    total = rungs.groupBy(*_NAMES, "n").agg(
        F.sum(F.col("n_at") * (F.col("rank") - middle) ** 2).alias("sst")
    )
    groups = (
        cells.join(rungs.drop("n"), [*_NAMES, "value"])
        .groupBy(*_NAMES, "group")
        .agg(F.sum("w").alias("w"), (F.sum(F.col("w") * F.col("rank")) / F.sum("w")).alias("mean_rank"))
    )
    between = (
        groups.join(total, _NAMES)
        .groupBy(*_NAMES, "n", "sst")
        .agg(
            F.count("*").alias("n_groups"),
            F.sum(F.col("w") * (F.col("mean_rank") - middle) ** 2).alias("ssb"),
        )
    )
    h = (F.col("n") - 1) * F.try_divide("ssb", "sst")
    return between.select(*_NAMES, "n", "n_groups", h.alias("kruskal_h"))


def with_kruskal_p(found: DataFrame) -> DataFrame:
    return found.withColumn("kruskal_p", tail("chi2_upper", "kruskal_h", F.col("n_groups") - 1))


def tukey(df: DataFrame, measure: str, category: str, top: int | None = None, block_groups: int = 500) -> DataFrame:
    """All pairs of group means with the studentised range q (``top``: best groups only).

    The group table is dealt into blocks of about ``block_groups`` groups; each pair of blocks
    is joined by itself, so any number of groups spreads over the tasks.
    """
    rows = df if top is None else rows_of_top(df, category, measure, top)
    groups = write_table(group_moments(rows, [(measure, category)]).where("group is not null"), "groups")
    sizes = groups.groupBy(*_NAMES).agg(
        F.count("*").cast("int").alias("k"), F.sum("n").alias("n_all"), F.sum(F.col("n") * F.col("var")).alias("within")
    )
    blocks = max(1, -(-groups.count() // block_groups))
    own = groups.withColumn("block", F.pmod(F.xxhash64("group"), F.lit(blocks)).cast("int"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))  # each block meets every other
    left = own.select(*_NAMES, F.col("block").alias("i"), spread.alias("j"), F.struct("group", "n", "mean").alias("a"))
    right = own.select(*_NAMES, spread.alias("i"), F.col("block").alias("j"), F.struct("group", "n", "mean").alias("b"))
    pairs = left.join(right, [*_NAMES, "i", "j"]).where(F.col("a.group") < F.col("b.group")).join(F.broadcast(sizes), _NAMES)
    pairs = pairs.withColumn("dof", F.col("n_all") - F.col("k"))
    error = F.sqrt(
        F.try_divide("within", "dof") / 2 * (F.try_divide(F.lit(1.0), F.col("a.n")) + F.try_divide(F.lit(1.0), F.col("b.n")))
    )
    difference = F.col("b.mean") - F.col("a.mean")
    return pairs.select(
        *_NAMES, F.col("a.group").alias("group1"), F.col("b.group").alias("group2"),
        difference.alias("mean_diff"), error.alias("std_error"),
        F.try_divide(F.abs(difference), error).alias("q"), "k", "dof",
    )


def with_tukey_p(found: DataFrame, alpha: float = 0.05) -> DataFrame:
    """p, confidence bounds and the decision at ``alpha``."""
    half = F.col("q_critical") * F.col("std_error")
    return (
        found.withColumn("p", tail("studentized_range_upper", "q", "k", "dof"))
        .withColumn("q_critical", tail("studentized_range_critical", "k", "dof", F.lit(alpha)))
        .withColumns({"lower": F.col("mean_diff") - half, "upper": F.col("mean_diff") + half})
        .withColumn("reject", F.col("p") < alpha)
    )


def count_significant(p: Column | str, alpha: float = 0.05) -> Column:
    return F.count_if((F.col(p) if isinstance(p, str) else p) < alpha)
