"""Stage B: the tables behind the exploration figures, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators import correlation, profiles, quality
from tidepanel.spec import (
    CORRELATION_CATEGORIES,
    ENERGY,
    KEY_VARIABLES,
    NULL_CATEGORIES,
    ROLLING_PAIRS,
    PanelSpec,
)

# Entities of the day curves and the sources of the mix.
TYPICAL = ("Ile-de-France", "Auvergne-Rhone-Alpes", "Bretagne")
MIX = ("Nucleaire_MW", "Hydraulique_MW", "Eolien_MW", "Solaire_MW", "Thermique_MW")


def explore(panel: DataFrame, spec: PanelSpec = ENERGY) -> dict[str, DataFrame]:
    """Every summary of a cleaned panel. All are lazy but the box and violin tables."""
    e, t, y = spec.entity, spec.ts, spec.target
    total = "Production_totale_MW"
    out = {
        "yearly": profiles.yearly(panel, t, [y, total, "Part_renouvelable"]),
        "seasonal": profiles.seasonal(panel, t, [y, total]),
        "weekly": profiles.weekly(panel, t, [y, "Nucleaire_MW", "Eolien_MW", "Solaire_MW"]),
        "hourly": profiles.hourly(panel, t, [y]),
        "hourly_by_season": profiles.hourly_by_season(panel, t, y),
        "typical_entities": profiles.hourly_for(panel, e, t, y, TYPICAL),
        "top_entities": profiles.top_entities(panel, e, y, 5),
        "mix_of_top": profiles.mix_of_top(panel, e, y, MIX, 3),
        "overall_mix": profiles.overall_mix(panel, [*MIX, "Bioenergies_MW"]),
        "balance": profiles.balance(panel, e, "Balance_MW"),
        "share_histogram": profiles.histogram(panel, "Part_renouvelable", 50),
        "first_week": profiles.first_rows_of_mode(panel, e, t, 168, spec.tie_break),
    }
    out |= {f"box_{v}": profiles.box_summary(panel, e, v) for v in KEY_VARIABLES}
    out |= {f"violin_{v}": profiles.violin_summary(panel, e, v) for v in spec.sources}
    return out


def correlations(panel: DataFrame, spec: PanelSpec = ENERGY) -> dict[str, DataFrame]:
    names = correlation.numeric_columns(panel)
    matrix = correlation.correlation_matrix(panel, names)
    pairs = correlation.lower_triangle(matrix, names)
    return {
        "matrix": matrix,
        "top_pairs": correlation.strongest_pairs(pairs, top=15),
        "strong_pairs": correlation.strongest_pairs(pairs, above=0.5),
        "categories": correlation.category_matrix(matrix, CORRELATION_CATEGORIES),
        "rolling": correlation.rolling_correlation(panel, spec.at(hourly=True), ROLLING_PAIRS),
    }


def null_maps(raw: DataFrame, panel: DataFrame) -> dict[str, DataFrame]:
    """Null analysis of the raw table, and the raw table against the cleaned one."""
    return {
        "by_column": quality.null_profile(raw),
        "by_category": quality.null_categories(raw, NULL_CATEGORIES),
        "by_month": quality.null_by_month(raw, "Date"),
        "before_after": quality.before_after(raw, panel),
    }


def exploration_report(panel: DataFrame, spec: PanelSpec = ENERGY) -> DataFrame:
    """Variables, period, entities and the number of strong pairs (one row)."""
    names = correlation.numeric_columns(panel)
    pairs = correlation.lower_triangle(correlation.correlation_matrix(panel, names), names)
    strong = pairs.where(F.abs("corr") > 0.5).agg(F.count("*")).scalar()
    return panel.agg(
        F.min(spec.ts).alias("first_ts"), F.max(spec.ts).alias("last_ts"),
        F.count_distinct(spec.entity).alias("n_entities"),
    ).select(F.lit(len(KEY_VARIABLES)).alias("n_variables"), "*", strong.alias("n_strong_pairs"))
