"""Model inputs: encodings, lags, rolling statistics, interactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.operators.frames import trailing
from tidepanel.operators.ordering import CHUNK_ROWS, with_neighbours
from tidepanel.spec import LAGS, ROLLING_WINDOWS, PanelSpec


def with_cyclic(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Sine and cosine of hour, weekday, month and day of year, plus the day of year."""
    day = F.dayofyear(spec.ts)
    parts = {
        "hour": fx.cyclic("Hour", 24),
        "dow": fx.cyclic("DayOfWeek", 7),
        "month": fx.cyclic("Month", 12),
        "doy": fx.cyclic(day, 365),
    }
    added = {"day_of_year": day}
    for name, (sine, cosine) in parts.items():
        added |= {f"{name}_sin": sine, f"{name}_cos": cosine}
    return df.withColumns(added)


def _lag_columns(w: Window, target: str, lags: Sequence[int]) -> dict[str, Column]:
    return {f"{target}_lag_{k}": F.lag(target, k).over(w) for k in lags}


def _rolling_stages(target: str, windows: Sequence[int]) -> list:
    """Means and deviations of the previous k rows. NaN and infinite values count as missing."""
    value = F.col(target).cast("double")
    finite = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)

    def frame(k: int):
        def columns(moments) -> dict[str, Column]:
            m = moments("v", 1)
            spread = F.when(m["n"] > 1, F.sqrt(m["sum_0"] / (m["n"] - 1)))
            return {f"{target}_rolling_mean_{k}": m["mean_0"], f"{target}_rolling_std_{k}": spread}

        return lambda wide, part, index: trailing(wide, part, index, k, {"v": ["__v"]}, columns)

    return [{"__v": finite}, *[frame(k) for k in windows]]


def with_lags(
    df: DataFrame, spec: PanelSpec, target: str | None = None, lags: Sequence[int] = LAGS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The target k rows earlier, per entity."""
    t = target or spec.target
    return with_neighbours(df, spec, max(lags), lambda w: [_lag_columns(w, t, lags)], chunk_rows)


def with_rolling(
    df: DataFrame, spec: PanelSpec, target: str | None = None,
    windows: Sequence[int] = ROLLING_WINDOWS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Mean and sample deviation of up to k previous rows, without the current one."""
    t = target or spec.target
    return with_neighbours(df, spec, max(windows), lambda w: _rolling_stages(t, windows), chunk_rows)


def with_interactions(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Hour x weekend, production to last consumption, renewable to nuclear."""
    return df.withColumns(
        {
            "Hour_IsWeekend": F.col("Hour") * F.col("IsWeekend"),
            "Production_Conso_Ratio": fx.ratio_to_next("Production_totale_MW", f"{spec.target}_lag_1"),
            "Renew_Nuclear_Ratio": fx.ratio_to_next("Production_renouvelable_MW", "Nucleaire_MW"),
        }
    )


def features(
    df: DataFrame, spec: PanelSpec, lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING_WINDOWS, noise_seed: int | None = None,
) -> DataFrame:
    """All 23 model inputs; lags and rolling statistics share one shuffle.

    Rows with any null (the first rows of every entity) drop.
    """
    t = spec.target
    wide = with_neighbours(
        df, spec, max(*lags, *windows),
        lambda w: [_lag_columns(w, t, lags), *_rolling_stages(t, windows)],
    )
    wide = with_interactions(with_cyclic(wide, spec), spec)
    temperature = fx.harmonic_temperature("day_of_year", "Hour", noise_seed, [spec.entity, spec.ts, *spec.tie_break])
    return wide.withColumn("Temperature_simulated", temperature).na.drop("any")
