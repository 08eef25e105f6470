"""Summaries that are stored per period and merged later, without going back to the rows.

Distinct counts are theta sketches and quantiles KLL sketches. A table of them, one row per key and
month, answers for any set of keys and months with the errors below, beside the exact answers of the
value ladder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_NOMINAL = 14  # 16,384 hashes: a standard error of 0.8 %
KLL_SIZE = 400
DISTINCT_ERROR = 3 / 2 ** (LOG_NOMINAL / 2)  # three standard errors
RANK_ERROR = 0.012  # of a rank at KLL_SIZE, in 99 of 100 sketches, doubled for the merge


def monthly(df: DataFrame, keys: Sequence[str], ts: str, item: str, value: str) -> DataFrame:
    """A row per key and month: rows ``n``, sketch ``items`` of different ``item`` and sketch
    ``spread`` of ``value``. Missing items and values are not in the sketches."""
    return df.groupBy(*keys, F.trunc(F.col(ts).cast("date"), "month").alias("month")).agg(
        F.count("*").alias("n"), F.theta_sketch_agg(item, LOG_NOMINAL).alias("items"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_SIZE).alias("spread"),
    )


def merged(stored: DataFrame, keys: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """Stored sketches brought together by ``keys``: rows, distinct items, quantiles by name.

    The sketches of a key are one per month, of bounded size each.
    """
    spread = F.collect_list("spread")
    one = F.reduce(F.slice(spread, 2, F.size(spread)), spread[0], F.kll_sketch_merge_double)
    found = stored.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.theta_sketch_estimate(F.theta_union_agg("items", LOG_NOMINAL)).alias("distinct"), one.alias("spread"),
    )
    return found.select(*keys, "n", "distinct", *[F.kll_sketch_get_quantile_double("spread", F.lit(p)).alias(c) for c, p in probs.items()])
