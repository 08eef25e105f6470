"""Time dependence: Granger causality, Ljung-Box, residual normality."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.functions.tails import tail
from tidepanel.operators.ordering import CHUNK_ROWS, value_ladder, with_neighbours, with_place
from tidepanel.spec import PanelSpec


def ljung_box(
    df: DataFrame, spec: PanelSpec, value: str, lags: int = 24,
    table_order: Sequence[str] | None = None, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Autocorrelation and Q for lags 1..``lags`` per entity, or over the whole table in
    ``table_order``; p is added by :func:`with_ljung_box_p`."""
    keys = [] if table_order else [spec.entity]
    rows = df.where(F.col(value).isNotNull())
    # Products around a mean far from the entity's own would lose the digits that differ.
    if keys:
        rows = rows.join(rows.groupBy(*keys).agg(F.avg(value).alias("_mean")), keys)
        rows = rows.withColumn("_e", F.col(value) - F.col("_mean")).drop("_mean")
    else:
        rows = rows.withColumn("_e", F.col(value) - F.lit(rows.agg(F.avg(value)).first()[0] or 0.0))

    def stages(w: Window) -> list[dict[str, Column]]:
        return [{f"_e{k}": F.lag("_e", k).over(w) for k in range(1, lags + 1)}]

    wide = with_neighbours(rows, spec, lags, stages, chunk_rows, table_order)
    e = F.col("_e")
    cells = []
    for k in range(1, lags + 1):
        past = F.col(f"_e{k}")
        pairs = F.struct(
            F.sum(e * past).alias("ab"), F.sum(F.when(past.isNotNull(), e)).alias("a"), F.sum(past).alias("b")
        )
        cells.append(F.struct(F.lit(k).alias("lag"), pairs.alias("p")))
    sums = wide.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg("_e").alias("_m"), F.var_pop("_e").alias("_var"), F.array(*cells).alias("_cells")
    )
    m, p = F.col("_m"), F.col("p")
    moved = p["ab"] - m * (p["a"] + p["b"]) + (F.col("n") - F.col("lag")) * m * m
    long = sums.select(*keys, "n", "_m", "_var", F.inline("_cells")).withColumns(
        {"_c": F.coalesce(moved, F.lit(0.0)), "_c0": F.col("_var") * F.col("n")}
    )
    rho = long.select(
        *keys, "n", "lag", F.try_divide("_c", "_c0").alias("rho")
    ).where("lag < n")
    # At most ``lags`` rows per entity stand in this window.
    upto = Window.partitionBy(*keys, "n").orderBy("lag").rowsBetween(Window.unboundedPreceding, 0)
    term = F.col("rho") ** 2 / (F.col("n") - F.col("lag"))
    return rho.withColumn("q", F.col("n") * (F.col("n") + 2.0) * F.sum(term).over(upto))


def with_ljung_box_p(found: DataFrame) -> DataFrame:
    return found.withColumn("p", tail("chi2_upper", "q", "lag"))


def significant_lags(found: DataFrame, keys: Sequence[str] = (), alpha: float = 0.05, first: int = 5) -> DataFrame:
    """How many lags are significant and the first few of them."""
    hits = found.where(F.col("p") < alpha)
    return hits.groupBy(*keys).agg(
        F.count("*").alias("n_significant"),
        F.slice(F.array_sort(F.collect_list("lag")), 1, first).alias("first_lags"),
    )


# --- Granger --------------------------------------------------------------------------


def granger(
    df: DataFrame, spec: PanelSpec, effect: str, cause: str, max_lag: int = 24,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Does ``cause`` help to predict ``effect`` beyond its own past? F per entity and lag.

    The normal equations of every lag follow from the sums of lagged products (about
    4 x max_lag numbers per entity, one aggregate) once the few products at both ends of
    the series are taken off. Only those sums and the 2 x max_lag end rows reach Python, where
    one factorisation per lag serves all entities of a batch.
    """
    entity = spec.entity
    rows = df.where(F.col(effect).isNotNull() & F.col(cause).isNotNull())
    # Any origin is exact (the model has an intercept); the entity's means keep the digits.
    means = rows.groupBy(entity).agg(F.avg(effect).alias("_y"), F.avg(cause).alias("_x"))
    shifted = rows.join(means, entity).select(
        entity, spec.ts, *spec.tie_break,
        (F.col(effect) - F.col("_y")).alias("y"), (F.col(cause) - F.col("_x")).alias("x"),
    )
    numbered = with_place(shifted, spec)

    def stages(w: Window) -> list[dict[str, Column]]:
        past = {f"__{v}{h}": F.lag(v, h).over(w) for v in "yx" for h in range(1, max_lag + 1)}
        products = {}
        for a in "yx":
            for b in "yx":
                for h in range(max_lag + 1):
                    other = F.col(b) if h == 0 else F.col(f"__{b}{h}")
                    products[f"{a}{b}{h}"] = F.col(a) * other
        return [past, products]

    wide = with_neighbours(numbered, spec, max_lag, stages, chunk_rows, place="place")
    names = [f"{a}{b}{h}" for a in "yx" for b in "yx" for h in range(max_lag + 1)]
    sums = wide.groupBy(entity).agg(
        F.count("*").alias("n"), F.array(F.sum("y"), F.sum("x")).alias("totals"),
        F.array(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in names]).alias("products"),
    )
    ends = (
        numbered.where((F.col("place") < max_lag) | (F.col("place") >= F.col("n") - max_lag))
        .groupBy(entity)
        .agg(F.array_sort(F.collect_list(F.struct("place", "y", "x"))).alias("ends"))
    )
    kind = df.schema[entity].dataType.simpleString()
    compact = sums.join(ends, entity).select(
        F.col(entity).alias("entity"), "n", "totals", "products",
        F.col("ends.place").alias("place"), F.col("ends.y").alias("y"), F.col("ends.x").alias("x"),
    )
    solved = compact.mapInPandas(
        _solver(max_lag), f"entity {kind}, lag int, n long, f double, df_num int, df_den long"
    )
    return solved.withColumnRenamed("entity", entity)


def granger_first(
    df: DataFrame, order: Sequence[str], effect: str, cause: str, max_lag: int = 24, first: int = 5000
) -> DataFrame:
    """:func:`granger` of the ``first`` rows of the whole table in ``order``, as one series.

    Every task keeps that many rows at most, and so does the one that orders them.
    """
    known = df.where(F.col(effect).isNotNull() & F.col(cause).isNotNull())
    rows = known.select(*order, F.col(effect).alias("_effect"), F.col(cause).alias("_cause")).orderBy(*order).limit(first)
    spec = PanelSpec(entity="_all", ts=order[0], target="_effect", tie_break=tuple(order[1:]), hourly=True)
    return granger(rows.withColumn("_all", F.lit(0)), spec, "_effect", "_cause", max_lag).drop("_all")


def with_granger_p(found: DataFrame) -> DataFrame:
    return found.withColumn("p", tail("f_upper", "f", "df_num", "df_den"))


def _solver(max_lag: int):
    """Entities in Arrow batches; all entities of a batch are solved together, lag by lag."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            n = batch["n"].to_numpy(np.int64)
            sums = np.stack(batch["products"].to_numpy()).astype(float).reshape(-1, 2, 2, max_lag + 1)
            totals = np.stack(batch["totals"].to_numpy()).astype(float)
            ends = np.zeros((len(batch), 2, 2 * max_lag + 1))
            for e, row in enumerate(batch.itertuples(index=False)):
                place = np.asarray(row.place, dtype=int)
                for k, series in enumerate((row.y, row.x)):
                    values = np.asarray(series, dtype=float)
                    ends[e, k, np.where(place < max_lag, place, place - n[e])] = values
                    # A series shorter than both ends fills them from the same rows.
                    late = place >= n[e] - max_lag
                    ends[e, k, place[late] - n[e]] = values[late]
            edges = _edge_sums(ends, max_lag)
            out = []
            for p in range(1, max_lag + 1):
                dof = n - 3 * p - 1
                own = np.flatnonzero(dof > 0)
                if len(own):
                    f = _f_statistics(sums[own], totals[own], ends[own], [x[own] for x in edges], n[own], p, dof[own])
                    out.append(pd.DataFrame({
                        "entity": batch["entity"].to_numpy()[own], "lag": p, "n": n[own] - p, "f": f, "df_num": p, "df_den": dof[own],
                    }))
            yield pd.concat(out) if out else pd.DataFrame(columns=["entity", "lag", "n", "f", "df_num", "df_den"])

    return solve


def _edge_sums(ends: np.ndarray, max_lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of lagged products over the first m rows and over the last m, by (entity, series, series, lag, m)."""
    first, last = ends[:, :, :max_lag], ends[:, :, ::-1][:, :, :max_lag]  # last row first
    head, back = (np.zeros((len(ends), 2, 2, max_lag + 1, max_lag + 1)) for _ in range(2))
    for s in range(2):
        for u in range(2):
            for h in range(max_lag):
                head[:, s, u, h, h + 1 :] = np.cumsum(first[:, s, h:] * first[:, u, : max_lag - h], axis=1)
                back[:, s, u, h, 1 : max_lag - h + 1] = np.cumsum(last[:, s, : max_lag - h] * last[:, u, h:], axis=1)
    return head, back


def _f_statistics(
    sums: np.ndarray, totals: np.ndarray, ends: np.ndarray, edges: Sequence[np.ndarray], n: np.ndarray, p: int, dof: np.ndarray
) -> np.ndarray:
    """F of lag p per entity from full lag products, less the products outside rows p+1..n.

    The cross-products are put in the order own lags, intercept, the cause's lags, effect. The last
    row of their Cholesky factor then holds what each regressor explains of the effect when it
    joins those before it, and what none explains: both residuals come from one factor.
    """
    # Regressors (series, shift): effect first, its lags, the cause's lags, intercept.
    series = np.array([0] * (p + 1) + [1] * p)
    shift = np.array([*range(p + 1), *range(1, p + 1)])
    size = len(shift) + 1
    i, j = np.meshgrid(shift, shift, indexing="ij")
    s, u = np.meshgrid(series, series, indexing="ij")
    swap = i > j
    i, j, s, u = (np.where(swap, b, a) for a, b in ((i, j), (j, i), (s, u), (u, s)))
    gram = np.zeros((len(n), size, size))
    gram[:, :-1, :-1] = sums[:, s, u, j - i] - edges[0][:, s, u, j - i, p - i] - edges[1][:, s, u, j - i, i]
    for r, (own, k) in enumerate(zip(series, shift)):
        late = ends[:, own, -k:].sum(axis=1) if k else 0.0
        gram[:, r, -1] = gram[:, -1, r] = totals[:, own] - ends[:, own, : p - k].sum(axis=1) - late
    gram[:, -1, -1] = n - p
    order = [*range(1, p + 1), size - 1, *range(p + 1, size - 1), 0]
    gram = gram[:, order][:, :, order]
    scale = np.sqrt(np.maximum(np.diagonal(gram, axis1=1, axis2=2), 1e-300))
    unit = gram / (scale[:, :, None] * scale[:, None, :])
    try:
        factor = np.linalg.cholesky(unit)
        last = factor[:, -1].copy()
        # A pivot this small is what rounding leaves of a regressor that the others determine.
        weak = (np.diagonal(factor, axis1=1, axis2=2) ** 2).min(axis=1) < 1e-11
    except np.linalg.LinAlgError:
        last, weak = np.zeros((len(n), size)), np.ones(len(n), bool)
    full, gained = last[:, -1] ** 2, (last[:, p + 1 : -1] ** 2).sum(axis=1)
    for e in np.flatnonzero(weak):
        full[e], gained[e] = _dependent(unit[e], p)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(full > 0, gained / p / (full / dof), np.nan)


def _dependent(unit: np.ndarray, p: int) -> tuple[float, float]:
    """The residual of all regressors and what the cause adds, where some determine others."""

    def residual(columns: int) -> float:
        g, b = unit[:columns, :columns], unit[:columns, -1]
        beta = np.linalg.lstsq(g, b, rcond=1e-13)[0]
        return unit[-1, -1] - 2 * beta @ b + beta @ g @ beta

    small, full = residual(p + 1), residual(len(unit) - 1)
    return full, small - full


# --- normality ------------------------------------------------------------------------


def jarque_bera(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Skewness, kurtosis excess, the Jarque-Bera statistic and p over all rows."""
    found = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.skewness(value).alias("skewness"), F.kurtosis(value).alias("kurtosis")
    )
    jb = F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4)
    return found.withColumn("jb", jb).withColumn("p", F.exp(-F.col("jb") / 2))


def normality(df: DataFrame, value: str, keys: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """Jarque-Bera and D'Agostino-Pearson K² of all rows per key, from one moment aggregate.

    Both statistics have p = exp(-x / 2). K² joins the normal scores of skewness and kurtosis,
    which hold from 8 and 20 rows; it is null below 20. ``normal`` is K²'s decision at
    ``alpha`` (Jarque-Bera's where K² is null); null for constant values.
    """
    found = jarque_bera(df.where(F.col(value).isNotNull()), value, keys).withColumnRenamed("p", "jb_p")
    n = F.col("n").cast("double")
    y = F.col("skewness") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    scaled = y / F.sqrt(2 / (w2 - 1))
    skew_score = F.log(scaled + F.sqrt(scaled * scaled + 1)) / F.sqrt(F.log(w2) / 2)
    mean = 3 * (n - 1) / (n + 1) - 3
    spread = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (F.col("kurtosis") - mean) / F.sqrt(spread)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    base = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    cubic = F.signum(base) * F.pow(F.abs(base), 1 / 3)
    kurtosis_score = (1 - 2 / (9 * a) - cubic) / F.sqrt(2 / (9 * a))
    k2 = F.when((n >= 20) & F.col("skewness").isNotNull() & ~F.isnan("skewness"), skew_score**2 + kurtosis_score**2)
    found = found.withColumn("k2", k2).withColumn("k2_p", F.exp(-F.col("k2") / 2))
    return found.withColumn("normal", F.coalesce("k2_p", F.nanvl("jb_p", F.lit(None).cast("double"))) > alpha)


RANK_STEP = 4096  # ranks of one value that a row is multiplied by at once


def shapiro_francia(df: DataFrame, value: str, keys: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """Shapiro-Francia W' over all rows per key, with Royston's normal score of log(1 - W') and p.

    W' is the squared correlation of the ordered values with the expected normal scores of their
    ranks. Ranks come from the ladder of distinct values, so no sort has to hold a key; tied rows
    take all their ranks, in pieces of ``RANK_STEP``. Missing and NaN values are left out; below 5
    rows and for constant values everything but ``n`` is null. Royston fitted his score on 5 to 5000
    rows; beyond, its formula is carried on.
    """
    rows = df.select(*keys, fx.missing_if_nan(value).alias("v"))
    ladder = value_ladder(rows, list(keys), "v")
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_at") - 1) / RANK_STEP)))
    cut = ladder.select(*keys, "v", "n_at", "below", F.col("total").alias("n"), piece.alias("piece"))
    first = F.col("piece") * RANK_STEP + 1
    ranks = F.sequence(F.col("below") + first, F.col("below") + F.least(first + RANK_STEP - 1, F.col("n_at")))
    placed = cut.select(*keys, "v", "n", F.explode(ranks).alias("rank"))
    score = fx.normal_quantile((F.col("rank") - 0.375) / (F.col("n") + 0.25))
    scored = placed.withColumn("m", score)
    spread = F.stddev_pop("v") * F.stddev_pop("m")  # 0 for a constant
    found = scored.groupBy(*keys, "n").agg(F.covar_pop("v", "m").alias("c"), spread.alias("s"), (F.min("v") < F.max("v")).alias("varies"))
    r = F.when(F.col("varies") & (F.col("n") >= 5), F.try_divide("c", "s"))
    u = F.log(F.col("n").cast("double"))
    mean, spread = -1.2725 + 1.0521 * (F.log(u) - u), 1.0308 - 0.26758 * (F.log(u) + 2 / u)  # Royston 1993
    z = (F.log(1 - F.least(r * r, F.lit(1 - 1e-16))) - mean) / spread
    found = found.select(*keys, "n", (r * r).alias("w"), z.alias("z"))
    two = tail("normal_two_sided", "z")
    p = F.when(F.col("z") >= 0, two / 2).otherwise(1 - two / 2)
    return found.withColumn("p", p).withColumn("normal", F.col("p") > alpha)
