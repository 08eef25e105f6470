"""Statistics of the last k rows in constant time a row, whatever k is.

Rows are cut in blocks of k. The last k rows of a place are the end of one block and the start of
the next, and both parts are frames that only grow, which Spark updates row by row: starts in
rising order, ends in falling order. Their counts, means and central sums are merged without any
subtraction of sums, so that a frame depends on its own rows only and levels cost no digits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, START, END = "__block", "__start", "__end"


def _growing(frame, values: Sequence[Column], crossed: bool) -> Column:
    """Count, means and central sums of rows that all ``values`` have, as they grow."""
    known = values[0].isNotNull()
    for v in values[1:]:
        known = known & v.isNotNull()
    own = [F.when(known, v) for v in values]
    count = F.count(own[0]).over(frame)
    parts = [count.alias("n")]
    for i, v in enumerate(own):
        low, mean = F.min(v).over(frame), F.avg(v).over(frame)
        # Of equal values the mean is that value, to the last digit.
        parts += [F.when(low == F.max(v).over(frame), low).otherwise(mean).alias(f"mean_{i}"), (F.var_pop(v).over(frame) * count).alias(f"sum_{i}")]
    if crossed:
        parts.append((F.covar_pop(*own).over(frame) * count).alias("cross"))
    return F.struct(*parts)


def _merged(a: Column, b: Column, size: int, crossed: bool) -> Column:
    """Two disjoint parts as one; a missing or empty part adds nothing."""
    n = a["n"] + b["n"]
    weight = a["n"] * (b["n"] / n)
    gap = [b[f"mean_{i}"] - a[f"mean_{i}"] for i in range(size)]
    parts = [n.alias("n")]
    for i, d in enumerate(gap):
        parts += [(a[f"mean_{i}"] + d * (b["n"] / n)).alias(f"mean_{i}"), (a[f"sum_{i}"] + b[f"sum_{i}"] + d * d * weight).alias(f"sum_{i}")]
    if crossed:
        parts.append((a["cross"] + b["cross"] + gap[0] * gap[1] * weight).alias("cross"))
    both = F.struct(*parts)
    return F.when(b.isNull() | (b["n"] == 0), a).when(a["n"] == 0, b).otherwise(both)


def trailing(
    wide: DataFrame, part: Sequence[str], index: str, k: int, values: Mapping[str, Sequence[str]],
    result: Callable[[Callable[[str, int], Column]], dict[str, Column]],
) -> DataFrame:
    """Add columns made from the moments of the last ``k`` rows of each place.

    ``values`` names groups of one or two columns; a group's struct has ``n``, ``mean_0``,
    ``sum_0`` (squared deviations) and for two columns ``mean_1``, ``sum_1`` and ``cross``, over the
    rows in which the whole group is known. ``result`` gets a function of a group's name and of
    a number of rows to go back, and returns the columns to add. ``index`` numbers the rows of
    each ``part`` without holes.
    """
    place = F.col(index) % k
    wide = wide.withColumn(BLOCK, F.floor(F.col(index) / k))
    blocks, upto = Window.partitionBy(*part, BLOCK), (Window.unboundedPreceding, 0)
    falling, rising = blocks.orderBy(F.desc(index)).rowsBetween(*upto), blocks.orderBy(index).rowsBetween(*upto)
    groups = {name: [F.col(c) for c in columns] for name, columns in values.items()}
    for side, frame in ((END, falling), (START, rising)):
        wide = wide.select("*", *[_growing(frame, cs, len(cs) == 2).alias(f"{side}_{name}") for name, cs in groups.items()])
    # Blocks follow the index: this is its order too, and the one that the rows are in.
    order = Window.partitionBy(*part).orderBy(BLOCK, index)
    before = [F.when(place < k - 1, F.lag(f"{END}_{name}", k - 1).over(order)).alias(f"__before_{name}") for name in groups]
    wide = wide.select("*", *before)
    merged = {name: _merged(F.col(f"{START}_{name}"), F.col(f"__before_{name}"), len(cs), len(cs) == 2) for name, cs in groups.items()}
    wide = wide.select("*", *[m.alias(f"__last_{name}") for name, m in merged.items()])

    def moments(name: str, back: int = 0) -> Column:
        return F.lag(f"__last_{name}", back).over(order) if back else F.col(f"__last_{name}")

    out = wide.select("*", *[c.alias(n) for n, c in result(moments).items()])
    helpers = [f"{mark}_{name}" for mark in (START, END, "__before", "__last") for name in groups]
    return out.drop(BLOCK, *helpers)
