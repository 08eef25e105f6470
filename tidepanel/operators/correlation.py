"""Correlation: matrices, pair batteries, ranks, rolling and partial correlation.

Pairwise complete throughout: a row counts for a pair when both its values are present.
A constant variable gives a null coefficient (SQL ``corr`` would raise).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidepanel.functions import columns as fx
from tidepanel.functions.tails import tail
from tidepanel.operators.frames import trailing
from tidepanel.operators.ordering import (
    BUCKET,
    CHUNK_ROWS,
    SLOT,
    average_rank,
    range_layout,
    value_ladder,
    with_neighbours,
)
from tidepanel.session import write_table
from tidepanel.spec import CALENDAR_EXCLUDED, PanelSpec

Pair = tuple[str, str]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = CALENDAR_EXCLUDED) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in exclude
    ]


def pair_name(x: str, y: str) -> str:
    return f"{x} vs {y}"


def _masked(a: Column, b: Column) -> tuple[Column, Column]:
    """Both values, null unless both are present."""
    return F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)


def _numbers(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Adds the pairs' columns as doubles named ``_column``, NaN made null."""
    names = list(dict.fromkeys(c for p in pairs for c in p))
    return df.select("*", *[fx.missing_if_nan(c).alias(f"_{c}") for c in names])


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson's r of two columns masked to common rows, null where one is constant."""
    return _bounded(F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y))))


def _bounded(r: Column) -> Column:
    """A coefficient that rounding carried past 1 is set to 1."""
    return F.when(F.abs(r) > 1, F.signum(r)).otherwise(r)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs of columns in long form: ``var1, var2, n, corr`` (both triangles).

    Each task reduces its rows to one centred cross-product per pair with four matrix
    products per Arrow batch, so m(m+1)/2 rows per task are shuffled, never row pairs.
    """
    names = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    parts = numbers.mapInPandas(
        _partial_products,
        "i int, j int, n double, mi double, mj double, si double, sj double, sij double",
    )
    n = F.col("n")
    merged = parts.groupBy("i", "j").agg(
        F.sum(n).alias("n"),
        (F.sum("si") + F.sum(n * F.col("mi") ** 2) - F.sum(n * F.col("mi")) ** 2 / F.sum(n)).alias("si"),
        (F.sum("sj") + F.sum(n * F.col("mj") ** 2) - F.sum(n * F.col("mj")) ** 2 / F.sum(n)).alias("sj"),
        (
            F.sum("sij") + F.sum(n * F.col("mi") * F.col("mj"))
            - F.sum(n * F.col("mi")) * F.sum(n * F.col("mj")) / F.sum(n)
        ).alias("sij"),
        # A constant variable has one mean in all parts and no spread inside them.
        (F.max("si") + F.max("mi") - F.min("mi") > 0).alias("varies_i"),
        (F.max("sj") + F.max("mj") - F.min("mj") > 0).alias("varies_j"),
    )
    r = F.when(
        F.col("varies_i") & F.col("varies_j"),
        F.when(F.col("i") == F.col("j"), 1.0).otherwise(
            _bounded(F.try_divide("sij", F.sqrt("si") * F.sqrt("sj")))
        ),
    )
    label = F.array(*[F.lit(c) for c in names])
    one = merged.select("i", "j", F.col("n").cast("long").alias("n"), r.alias("corr"))
    flipped = F.when(
        F.col("i") == F.col("j"), F.array(F.struct("i", "j"))
    ).otherwise(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return one.select(F.explode(flipped).alias("p"), "n", "corr").select(
        label[F.col("p.i")].alias("var1"), label[F.col("p.j")].alias("var2"), "n", "corr"
    )


def _partial_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shift = None
    for batch in batches:
        x = batch.to_numpy(dtype=float)
        if not len(x):
            continue
        if shift is None:
            # Any fixed shift is exact; a value of the column keeps the digits and makes
            # a constant column exactly zero.
            m = x.shape[1]
            first = np.argmax(~np.isnan(x), axis=0)
            shift = np.nan_to_num(x[first, np.arange(m)])
            n, s, ss, sxy = (np.zeros((m, m)) for _ in range(4))
        seen = ~np.isnan(x)
        x = np.where(seen, x - shift, 0.0)
        seen = seen.astype(float)
        n += seen.T @ seen
        s += x.T @ seen
        ss += (x * x).T @ seen
        sxy += x.T @ x
    if shift is None:
        return
    i, j = np.tril_indices(len(shift))
    keep = n[i, j] > 0
    i, j = i[keep], j[keep]
    count = n[i, j]

    def spread(total: np.ndarray, squares: np.ndarray) -> np.ndarray:
        rest = squares - total**2 / count
        return np.where(rest <= 1e-12 * squares, 0.0, rest)  # below that only rounding is left

    yield pd.DataFrame(
        {
            "i": i.astype("int32"), "j": j.astype("int32"), "n": count,
            "mi": shift[i] + s[i, j] / count, "mj": shift[j] + s[j, i] / count,
            "si": spread(s[i, j], ss[i, j]), "sj": spread(s[j, i], ss[j, i]),
            "sij": sxy[i, j] - s[i, j] * s[j, i] / count,
        }
    )


def lower_triangle(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every pair once, the later column as ``var1``."""
    place = F.create_map(*[F.lit(x) for k, c in enumerate(columns) for x in (c, k)])
    return matrix.where(place[F.col("var1")] > place[F.col("var2")])


def strongest_pairs(pairs: DataFrame, top: int | None = None, above: float | None = None) -> DataFrame:
    """Pairs by falling |r|, the first ``top`` of them or those with |r| > ``above``."""
    size = F.abs("corr")
    found = pairs if above is None else pairs.where(size > above)
    found = found.where(F.col("corr").isNotNull()).orderBy(size.desc(), "var1", "var2")
    return found if top is None else found.limit(top)


def category_matrix(matrix: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Mean |r| between categories of variables: 1 on the diagonal, 0 where none is present.

    Null if any pair of the two categories has no correlation (a constant variable).
    """
    of = F.create_map(*[F.lit(x) for cat, vs in categories.items() for v in vs for x in (v, cat)])
    means = (
        matrix.select(of[F.col("var1")].alias("cat1"), of[F.col("var2")].alias("cat2"), "corr")
        .where(F.col("cat1").isNotNull() & F.col("cat2").isNotNull())
        .groupBy("cat1", "cat2").agg(F.avg(F.abs("corr")).alias("m"), (F.count("corr") < F.count("*")).alias("gap"))
    )
    names = F.array(*[F.lit(c) for c in categories])
    grid = matrix.sparkSession.range(1).select(F.explode(names).alias("cat1")).select(
        "cat1", F.explode(names).alias("cat2")
    )
    value = F.when(F.col("cat1") == F.col("cat2"), 1.0).when(~F.coalesce("gap", F.lit(False)), F.coalesce("m", F.lit(0.0)))
    return grid.join(means, ["cat1", "cat2"], "left").select("cat1", "cat2", value.alias("mean_abs_corr"))


def mask_insignificant(matrix: DataFrame, n_rows: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Coefficients below the critical |r| for the table's row count become 0."""
    n = n_rows.select(F.count("*").alias("n"))
    critical = n.select("n", tail("t_critical", F.col("n") - 2, F.lit(alpha)).alias("t")).select(
        (F.col("t") / F.sqrt(F.col("n") - 2 + F.col("t") ** 2)).alias("r")
    )
    limit = critical.scalar()
    return matrix.withColumn("r_critical", limit).withColumn(
        "corr_significant", F.when(F.abs("corr") < F.col("r_critical"), 0.0).otherwise(F.col("corr"))
    )


# --- pair batteries -------------------------------------------------------------------


def pearson(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """r, t, p, R², the regression line and its range for every pair, in one aggregate."""
    # Values are masked in a projection of their own, so that the many aggregates of a pair
    # read two columns instead of repeating the expressions behind them.
    masked, rows = {}, []
    for k, (x, y) in enumerate(pairs):
        masked[f"x{k}"], masked[f"y{k}"] = _masked(F.col(f"_{x}"), F.col(f"_{y}"))
        a, b = F.col(f"x{k}"), F.col(f"y{k}")
        rows.append(
            F.struct(
                F.lit(pair_name(x, y)).alias("pair"),
                F.count(a).alias("n"),
                safe_corr(a, b).alias("r"),
                F.try_divide(F.covar_pop(a, b), F.var_pop(a)).alias("slope"),
                F.avg(a).alias("mean_x"),
                F.avg(b).alias("mean_y"),
                F.min(f"_{x}").alias("x_min"),
                F.max(f"_{x}").alias("x_max"),
            )
        )
    wide = _numbers(df, pairs).select("*", *[c.alias(n) for n, c in masked.items()])
    found = wide.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    left = 1 - F.col("r") ** 2
    return found.withColumns(
        {
            "intercept": F.col("mean_y") - F.col("slope") * F.col("mean_x"),
            "r_squared": F.col("r") ** 2,
            "t": F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, F.nullif(left, F.lit(0.0)))),
        }
    ).drop("mean_x", "mean_y")


def with_pearson_p(found: DataFrame) -> DataFrame:
    return found.withColumn("p", tail("t_two_sided", "t", F.col("n") - 2))


def with_labels(found: DataFrame) -> DataFrame:
    """Strength, significance stars and variance explained of a pair table."""
    return found.withColumns(
        {
            "strength": fx.strength("r"),
            "stars": fx.stars("p"),
            "variance_explained": F.col("r_squared") * 100,
        }
    )


def regression_line(found: DataFrame, points: int = 100) -> DataFrame:
    """The fitted line of every pair on ``points`` positions over the range of x."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    spread = found.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.col("x_min") + F.col("point") * step
    return spread.select("pair", "point", x.alias("x"), (F.col("intercept") + F.col("slope") * x).alias("y"))


def with_residual(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Residuals ``y - (intercept + slope x)`` of every pair: ``pair, residual`` rows."""
    cells = [
        F.struct(F.lit(pair_name(x, y)).alias("pair"), F.col(f"_{x}").alias("_a"), F.col(f"_{y}").alias("_b"))
        for x, y in pairs
    ]
    long = _numbers(df, pairs).select(*df.columns, F.inline(F.array(*cells)))
    lines = F.broadcast(pearson(df, pairs).select("pair", "intercept", "slope"))  # a row per pair
    value = F.col("_b") - (F.col("intercept") + F.col("slope") * F.col("_a"))
    found = long.join(lines, "pair").select(*df.columns, "pair", value.alias("residual"))
    return found.where(F.col("residual").isNotNull())


def partial_correlation(df: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """r of x and y given z, with t and p on n - 3 (null where z explains one fully)."""
    pairs = {"r_xy": (x, y), "r_xz": (x, z), "r_yz": (y, z)}
    out = [safe_corr(*_masked(F.col(f"_{u}"), F.col(f"_{v}"))).alias(n) for n, (u, v) in pairs.items()]
    base = _numbers(df, list(pairs.values())).agg(F.count("*").alias("n"), *out)
    left_x, left_y = 1 - F.col("r_xz") ** 2, 1 - F.col("r_yz") ** 2
    # What z leaves unexplained is only rounding below this.
    rest = F.when(F.least(left_x, left_y) > 1e-12, F.sqrt(left_x * left_y))
    r = _bounded(F.try_divide(F.col("r_xy") - F.col("r_xz") * F.col("r_yz"), rest))
    t = F.col("r_partial") * F.sqrt(
        F.try_divide(F.col("n") - 3, 1 - F.col("r_partial") ** 2)
    )
    found = base.withColumn("r_partial", r).withColumn("t", t)
    return found.withColumn("p", tail("t_two_sided", "t", F.col("n") - 3))


# --- rank correlation -----------------------------------------------------------------


def pair_cells(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Distinct (x, y) of every pair with their count, written for reuse."""
    rows = [
        F.struct(F.lit(pair_name(x, y)).alias("pair"), F.col(f"_{x}").alias("x"), F.col(f"_{y}").alias("y"))
        for x, y in pairs
    ]
    long = _numbers(df, pairs).select(F.inline(F.array(*rows)))
    long = long.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    return write_table(long.groupBy("pair", "x", "y").agg(F.count("*").alias("w")), "cells")


def pair_ladders(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Value ladders of x and of y, from one ordered layout."""
    sides = F.array(
        F.struct(F.lit("x").alias("side"), F.col("x").alias("v")),
        F.struct(F.lit("y").alias("side"), F.col("y").alias("v")),
    )
    long = cells.select("pair", F.inline(sides), "w")
    ladder = value_ladder(long, ["pair", "side"], "v", weight="w")

    def side(name: str) -> DataFrame:
        return ladder.where(F.col("side") == name).select(
            "pair", F.col("v").alias(name), F.col("n_at").alias(f"n_{name}"),
            average_rank().alias(f"rank_{name}"), F.col("dense").alias(f"dense_{name}"),
        )

    return side("x"), side("y")


COMMON = 1000  # a value in more than one of so many rows is common; there are fewer such values


def spearman(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Spearman's rho with t on n - 2: Pearson's r of average ranks.

    A column is ranked once for all pairs whose other column is there wherever it is. The side
    with fewer values gives its ranks to the rows; summed by value of the other side they meet
    that side's ranks, so rows are joined once a pair and cells are never formed. Ranks are
    centred, which sums of their products need to keep their digits.
    """
    names = list(dict.fromkeys(c for p in pairs for c in p))
    numbers = write_table(_numbers(df, pairs).select(*[f"_{c}" for c in names]), "numbers")
    both = [F.count(F.when(F.col(f"_{x}").isNotNull(), F.col(f"_{y}"))).alias(f"p{k}") for k, (x, y) in enumerate(pairs)]
    known = numbers.agg(*[F.count(f"_{c}").alias(f"_{c}") for c in names], *both).first()
    # Sides by number: the column, and the column that has to be there as well if that leaves rows out.
    sides: dict[tuple[str, str | None], int] = {}
    ends = []
    for k, (x, y) in enumerate(pairs):
        keys = [(c, None if known[f"p{k}"] == known[f"_{c}"] else other) for c, other in ((x, y), (y, x))]
        ends.append([sides.setdefault(key, len(sides)) for key in keys])
    values = [F.col(f"_{c}") if other is None else F.when(F.col(f"_{other}").isNotNull(), F.col(f"_{c}")) for c, other in sides]
    long = numbers.select(F.inline(F.array(*[F.struct(F.lit(i).alias("side"), v.alias("v")) for i, v in enumerate(values)])))
    ladder = value_ladder(long, ["side"], "v")
    ranks = write_table(ladder.select("side", "v", "n_at", "total", (average_rank() - (F.col("total") + 1) / 2.0).alias("rank")), "ranks")
    n_at, rank = F.col("n_at"), F.col("rank")
    sizes = {r["side"]: r for r in ranks.groupBy("side").agg(  # a row per side
        F.count("*").alias("values"), F.first("total").alias("n"), F.sum(n_at * rank * rank).alias("squares")).collect()}
    ends = [sorted(e, key=lambda i: sizes[i]["values"] if i in sizes else 0) for e in ends]
    wide = numbers.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    for i in sorted({few for few, _ in ends}):
        wide = _with_rank(wide, ranks.where((F.col("side") == i)), i, sizes[i]["values"] if i in sizes else 0)
    cells = [
        F.struct(F.lit(k).alias("k"), F.lit(many).alias("side"), F.col(f"v{many}").alias("v"), F.col(f"r{few}").alias("a"))
        for k, (few, many) in enumerate(ends)
    ]
    met = wide.select(F.inline(F.array(*cells))).where(F.col("v").isNotNull() & F.col("a").isNotNull())
    sums = met.groupBy("k", "side", "v").agg(F.sum("a").alias("a"))
    products = sums.join(ranks.select("side", "v", "rank"), ["side", "v"]).groupBy("k").agg(F.sum(F.col("a") * rank).alias("top"))
    rows = [
        (k, pair_name(*pairs[k]), sizes[e[0]]["n"], math.sqrt(sizes[e[0]]["squares"]) * math.sqrt(sizes[e[1]]["squares"]))
        for k, e in enumerate(ends) if e[0] in sizes
    ]
    named = df.sparkSession.createDataFrame(rows, "k int, pair string, n long, rest double")
    rho = _bounded(F.try_divide("top", "rest"))
    return _with_t(F.broadcast(named).join(products, "k").select("pair", "n", rho.alias("rho")))


def _with_rank(wide: DataFrame, ranks: DataFrame, i: int, size: int) -> DataFrame:
    """Adds the rank ``r{i}`` of the value ``v{i}``; rows without the value keep a null.

    Common values are sent to the rows, so that no task gets all rows of one; the rest are
    joined. A side of few values is sent whole.
    """
    v, r = f"v{i}", f"r{i}"
    own = ranks.select(F.col("v").alias(v), F.col("rank").alias(r), "n_at", "total")
    if size <= COMMON:
        return wide.join(F.broadcast(own.select(v, r)), v, "left")
    common = own.where(F.col("n_at") * COMMON > F.col("total")).select(v, r)
    marked = wide.join(F.broadcast(common), v, "left")
    rest = marked.where(F.col(v).isNotNull() & F.col(r).isNull()).drop(r)
    return marked.where(F.col(v).isNull() | F.col(r).isNotNull()).unionByName(rest.join(own.select(v, r), v))


def _with_t(found: DataFrame) -> DataFrame:
    t = F.col("rho") * F.sqrt(F.try_divide(F.col("n") - 2, F.nullif(1 - F.col("rho") ** 2, F.lit(0.0))))
    return found.withColumn("t", t)


def spearman_of(cells: DataFrame, xs: DataFrame, ys: DataFrame) -> DataFrame:
    ranked = cells.join(xs, ["pair", "x"]).join(ys, ["pair", "y"])
    w, a, b = F.col("w"), F.col("rank_x"), F.col("rank_y")
    sums = ranked.groupBy("pair").agg(
        F.sum(w).alias("n"), F.sum(w * a).alias("sa"), F.sum(w * b).alias("sb"),
        F.sum(w * a * a).alias("saa"), F.sum(w * b * b).alias("sbb"), F.sum(w * a * b).alias("sab"),
    )
    n = F.col("n")
    top = F.col("sab") - F.col("sa") * F.col("sb") / n
    rest = F.sqrt(F.col("saa") - F.col("sa") ** 2 / n) * F.sqrt(F.col("sbb") - F.col("sb") ** 2 / n)
    return _with_t(sums.select("pair", "n", F.try_divide(top, rest).alias("rho")))


def kendall(df: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """Kendall's tau-b over all rows, with its normal score."""
    cells = pair_cells(df, pairs)
    return kendall_of(cells, *pair_ladders(cells))


def kendall_of(cells: DataFrame, xs: DataFrame, ys: DataFrame) -> DataFrame:
    """Tau-b without forming pairs: O(n log n) counting over the bits of y's rank.

    Rows stand in the order (x rising, y's rank falling), so that a later row with a larger
    y is a concordant pair and ties in x count for nothing. Two ranks differ first at one bit:
    among rows that agree above it, each row with bit 1 meets the earlier rows with bit 0.
    The running count of zeros is split into the ordered layout's partitions, so no group
    of rows is ever gathered whole.
    """
    # Tau is symmetric: the side with fewer distinct values gives the bits (a row per pair).
    tops = xs.groupBy("pair").agg(F.max("dense_x").alias("x")).join(
        ys.groupBy("pair").agg(F.max("dense_y").alias("y")), "pair"
    ).collect()
    levels = {r["pair"]: max(1, int(min(r["x"], r["y"])).bit_length()) for r in tops}
    if not levels:
        levels = {"": 1}
    swapped = F.col("pair").isin([r["pair"] for r in tops if r["x"] < r["y"]])
    ranks = ys.where(~swapped).select("pair", F.col("y").alias("v"), F.col("dense_y").alias("rank")).unionByName(
        xs.where(swapped).select("pair", F.col("x").alias("v"), F.col("dense_x").alias("rank"))
    )
    sided = cells.select(
        "pair", F.when(swapped, F.col("y")).otherwise(F.col("x")).alias("key"),
        F.when(swapped, F.col("x")).otherwise(F.col("y")).alias("v"), "w",
    )
    ranked = sided.join(ranks, ["pair", "v"]).select("pair", "key", "rank", "w")
    laid = range_layout(ranked, ["pair", "key", F.desc("rank")])
    last_level = F.create_map(*[F.lit(v) for p, n in levels.items() for v in (p, n - 1)])[F.col("pair")]
    bits = laid.select(
        "pair", BUCKET, SLOT, "w", "rank",
        F.explode(F.sequence(F.lit(0), last_level)).alias("level"),
    ).select(
        "pair", BUCKET, SLOT, "w", "level",
        F.expr("shiftright(rank, level + 1)").alias("head"),
        F.expr("shiftright(rank, level) & 1").alias("bit"),
    )
    zero = F.when(F.col("bit") == 0, F.col("w")).otherwise(0)
    one = F.when(F.col("bit") == 1, F.col("w")).otherwise(0)
    wide = "decimal(38,0)"
    earlier = (Window.unboundedPreceding, -1)
    blocks = bits.groupBy("pair", "level", "head", BUCKET).agg(F.sum(zero).alias("z"), F.sum(one).alias("o"))
    before = Window.partitionBy("pair", "level", "head").orderBy(BUCKET).rowsBetween(*earlier)
    across = blocks.select("pair", "o", F.sum("z").over(before).alias("zb"))
    here = Window.partitionBy("pair", "level", "head", BUCKET).orderBy(SLOT).rowsBetween(*earlier)
    within = bits.select("pair", one.alias("o"), F.sum(zero).over(here).alias("zb"))
    concordant = (
        across.unionByName(within)
        .groupBy("pair")
        .agg(F.sum(F.col("o").cast("decimal(18,0)") * F.col("zb").cast("decimal(19,0)")).cast(wide).alias("c"))
    )

    def ties(df: DataFrame, count: str, mark: str) -> DataFrame:
        t = F.col(count).cast("double")
        return df.groupBy("pair").agg(
            F.sum(t * (t - 1) / 2).alias(f"t_{mark}"),
            F.sum(t * (t - 1) * (t - 2)).alias(f"t3_{mark}"),
            F.sum(t * (t - 1) * (2 * t + 5)).alias(f"tv_{mark}"),
        )

    size = cells.groupBy("pair").agg(F.sum("w").alias("n"))
    joined = (
        size.join(ties(cells, "w", "xy").select("pair", "t_xy"), "pair")
        .join(ties(xs, "n_x", "x"), "pair")
        .join(ties(ys, "n_y", "y"), "pair")
        .join(concordant, "pair", "left")
    )
    n = F.col("n").cast("double")
    both = n * (n - 1)
    untied = both / 2 - F.col("t_x") - F.col("t_y") + F.col("t_xy")
    s = 2 * F.coalesce(F.col("c").cast("double"), F.lit(0.0)) - untied
    norm = F.sqrt(both / 2 - F.col("t_x")) * F.sqrt(both / 2 - F.col("t_y"))
    variance = (
        (both * (2 * n + 5) - F.col("tv_x") - F.col("tv_y")) / 18
        + F.try_divide(2 * F.col("t_x") * F.col("t_y"), both)
        + F.coalesce(F.try_divide(F.col("t3_x") * F.col("t3_y"), 9 * both * (n - 2)), F.lit(0.0))
    )
    return joined.select(
        "pair", "n", F.try_divide(s, norm).alias("tau"), F.try_divide(s, F.sqrt(variance)).alias("z")
    )


# --- rolling correlation --------------------------------------------------------------


def rolling_correlation(
    df: DataFrame, spec: PanelSpec, pairs: Sequence[Pair], window: int = 720,
    across_entities: bool = False, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Correlation over the last ``window`` rows; null until that many are filled.

    Frames stay inside an entity, or run over the whole (entity, timestamp) order with
    ``across_entities``. A frame in which a variable never changes gives null.
    """
    used = list(dict.fromkeys(c for p in pairs for c in p))
    groups = {f"{x}__{y}": [f"__v_{x}", f"__v_{y}"] for x, y in pairs}

    def columns(moments) -> dict[str, Column]:
        result = {}
        for name in groups:
            m = moments(name, 0)
            spread = F.sqrt(m["sum_0"]) * F.sqrt(m["sum_1"])  # 0 exactly for a constant
            result[f"corr_{name}"] = F.when(m["n"] == window, F.try_divide(m["cross"], spread))
        return result

    def stages(w: Window) -> list:
        return [
            {f"__v_{c}": fx.missing_if_nan(c) for c in used},
            lambda wide, part, index: trailing(wide, part, index, window, groups, columns),
        ]

    order = [spec.entity, spec.ts, *spec.tie_break] if across_entities else None
    return with_neighbours(df, spec, window, stages, chunk_rows, table_order=order)
