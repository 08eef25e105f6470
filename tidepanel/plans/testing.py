"""Stage C: the test tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.functions.tails import tail
from tidepanel.operators import correlation as corr
from tidepanel.operators import grouptests, serial
from tidepanel.operators.profiles import histogram
from tidepanel.session import write_table
from tidepanel.spec import ENERGY, HEATMAP_VARIABLES, TESTED_GROUPS, TESTED_PAIRS, PanelSpec


def pair_tests(
    df: DataFrame, pairs: Sequence[corr.Pair] = TESTED_PAIRS
) -> DataFrame:
    """Pearson, Spearman, Kendall, R² and residual normality of every pair, over all rows."""
    line = corr.with_pearson_p(corr.pearson(df, pairs))
    cells = corr.pair_cells(df, pairs)
    xs, ys = corr.pair_ladders(cells)
    rho = corr.spearman_of(cells, xs, ys).select(
        "pair", "rho", tail("t_two_sided", "t", F.col("n") - 2).alias("spearman_p")
    )
    tau = corr.kendall_of(cells, xs, ys).select("pair", "tau", tail("normal_two_sided", "z").alias("kendall_p"))
    normal = serial.normality(corr.with_residual(df, pairs), "residual", ["pair"])
    found = (
        line.join(rho, "pair").join(tau, "pair")
        .join(normal.select("pair", F.col("normal").alias("residuals_normal")), "pair", "left")
    )
    return found.select(
        "pair", "n", F.col("r").alias("pearson_r"), F.col("p").alias("pearson_p"),
        F.col("rho").alias("spearman_rho"), "spearman_p",
        F.col("tau").alias("kendall_tau"), "kendall_p", "r_squared", "residuals_normal",
        fx.strength("r").alias("strength"), fx.stars("p").alias("stars"),
        fx.nonlinear("r", "rho").alias("nonlinear"),
    )


def residual_normality(df: DataFrame, pairs: Sequence[corr.Pair] = TESTED_PAIRS, alpha: float = 0.05) -> DataFrame:
    """Shapiro-Francia of every pair's residuals, over all rows."""
    return serial.shapiro_francia(corr.with_residual(df, pairs), "residual", ["pair"], alpha)


def group_tests(df: DataFrame, tests: Sequence[grouptests.Test] = TESTED_GROUPS) -> DataFrame:
    """ANOVA, Kruskal-Wallis and effect size of every measure by category."""
    names = ["quantitative", "qualitative"]
    ranks = grouptests.with_kruskal_p(grouptests.kruskal(df, tests)).select(*names, "kruskal_h", "kruskal_p")
    found = grouptests.with_anova_p(grouptests.anova(df, tests)).join(ranks, names, "left")
    return found.select(
        *names, "n", "n_groups", "anova_f", "anova_p", "kruskal_h", "kruskal_p", "eta_squared",
        "effect_size", fx.stars("anova_p", "").alias("stars"),
    )


def post_hoc(
    df: DataFrame, found: DataFrame, spec: PanelSpec = ENERGY,
    categories: Sequence[str] = ("Region", "Season", "DayOfWeek"), alpha: float = 0.05, top_entities: int | None = None,
) -> dict[tuple[str, str], DataFrame]:
    """Tukey pairs for the significant tests on listed categories; ``top_entities``: of the best ones only."""
    out = {}
    for row in found.where(F.col("anova_p") < alpha).collect():  # a row per test
        m, c = row["quantitative"], row["qualitative"]
        if c in categories:
            top = top_entities if c == spec.entity else None
            out[m, c] = grouptests.with_tukey_p(grouptests.tukey(df, m, c, top), alpha)
    return out


def p_values(pairs: DataFrame, groups: DataFrame, bins: int = 20) -> DataFrame:
    """Histogram of all tests' p-values."""
    p = pairs.select(F.col("pearson_p").alias("p")).unionByName(groups.select(F.col("anova_p").alias("p")))
    # A row per test: written, so that the bins do not run the tests again.
    return histogram(write_table(p, "p-values"), "p", bins)


def conclusions(pairs: DataFrame, groups: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Tests run, tests significant, strongest pair and largest effect (one row)."""
    a = pairs.agg(
        F.count("*").alias("n_pairs"), grouptests.count_significant("pearson_p", alpha).alias("sig_pairs"),
        F.max_by(F.struct("pair", "pearson_r"), F.abs("pearson_r")).alias("strongest"),
    )
    b = groups.agg(
        F.count("*").alias("n_groups"), grouptests.count_significant("anova_p", alpha).alias("sig_groups"),
        F.max_by(
            F.struct("quantitative", "qualitative", "eta_squared"), F.col("eta_squared")
        ).alias("largest"),
    )
    pair = F.struct("n_pairs", "sig_pairs", "strongest")
    other = b.select(F.struct("n_groups", "sig_groups", "largest")).scalar()
    return a.select(pair.alias("a"), other.alias("b")).select(
        (F.col("a.n_pairs") + F.col("b.n_groups")).alias("n_tests"),
        (F.col("a.sig_pairs") + F.col("b.sig_groups")).alias("n_significant"),
        F.col("a.strongest.pair").alias("strongest_pair"),
        F.col("a.strongest.pearson_r").alias("strongest_r"),
        F.concat_ws(" par ", "b.largest.quantitative", "b.largest.qualitative").alias("largest_effect"),
        F.col("b.largest.eta_squared").alias("largest_eta_squared"),
    )


def masked_matrix(df: DataFrame, variables: Sequence[str] = HEATMAP_VARIABLES, alpha: float = 0.05) -> DataFrame:
    """The correlation matrix of the key variables; coefficients below the critical |r| are 0."""
    return corr.mask_insignificant(corr.correlation_matrix(df, list(variables)), df, alpha)


def granger_tests(df: DataFrame, spec: PanelSpec, effect: str, cause: str, max_lag: int = 24, alpha: float = 0.05) -> dict[str, DataFrame]:
    """F and p of every lag per entity, and the significant lags."""
    found = write_table(serial.with_granger_p(serial.granger(df, spec, effect, cause, max_lag)), "granger")
    return {"granger": found, "granger_lags": serial.significant_lags(found, [spec.entity], alpha)}


def all_tests(
    panel: DataFrame, spec: PanelSpec = ENERGY, partial: tuple[str, str, str] = ("Consommation_MW", "Production_totale_MW", "Hour"),
    causes: tuple[str, str] = ("Production_totale_MW", "Consommation_MW"), max_lag: int = 24,
) -> dict[str, DataFrame]:
    """Stage C in one call: both batteries, post-hoc pairs, partial correlation, Granger, masked
    matrix, p-value histogram and conclusions. ``panel`` should be a written table."""
    pairs, groups = write_table(pair_tests(panel), "pairs"), write_table(group_tests(panel), "groups")
    out = {"pairs": pairs, "groups": groups, "p_values": p_values(pairs, groups), "conclusions": conclusions(pairs, groups)}
    out |= {f"tukey {m} by {c}": t for (m, c), t in post_hoc(panel, groups, spec).items()}
    out["residuals"] = residual_normality(panel)
    out["partial"] = corr.partial_correlation(panel, *partial)
    out["matrix"] = masked_matrix(panel)
    hourly = spec.at(hourly=True)
    return out | granger_tests(panel, hourly, *causes, max_lag)
