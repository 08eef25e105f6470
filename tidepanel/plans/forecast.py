"""Stage D: features, chronological split, model grid, diagnostics of the best model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators import features, modelling, serial
from tidepanel.operators.ordering import chronological_split, with_row_index
from tidepanel.operators.profiles import histogram
from tidepanel.session import write_table
from tidepanel.sources import writers
from tidepanel.spec import ENERGY, FEATURE_SETS, PanelSpec


def prepared(
    panel: DataFrame, spec: PanelSpec = ENERGY, lags: Sequence[int] | None = None,
    windows: Sequence[int] | None = None, noise_seed: int | None = 42,
) -> DataFrame:
    """Model inputs with the column ``split``: the first 80 % of rows in time train."""
    options = {k: v for k, v in {"lags": lags, "windows": windows}.items() if v}
    wide = features.features(panel, spec.at(hourly=True), noise_seed=noise_seed, **options)
    return chronological_split(write_table(wide, "features"), [spec.ts, spec.entity])


def forecast(
    panel: DataFrame, spec: PanelSpec = ENERGY,
    feature_sets: Mapping[str, Sequence[str]] = FEATURE_SETS, models: Sequence[str] | None = None,
    make=modelling.estimators,
) -> tuple[DataFrame, dict]:
    return modelling.model_grid(prepared(panel, spec), spec.target, spec.entity, feature_sets, models, make)


def best_fit(results: DataFrame, fits: dict) -> tuple[str, str]:
    """(feature set, model) of the fit with the largest test R²."""
    best = modelling.best_model(results).first()
    return best["feature_set"], best["model"]


def save(results: DataFrame, fits: dict, folder: str) -> str:
    """Write the result table and the best fit's pipeline; returns the pipeline's path."""
    writers.write_results(results, f"{folder.rstrip('/')}/model_results")
    chosen = best_fit(results, fits)
    return writers.save_pipeline(fits[chosen].model, folder, chosen[1])


def diagnostics(
    predicted: DataFrame, spec: PanelSpec = ENERGY, slice_from: int = 1000, slice_rows: int = 168
) -> dict[str, DataFrame]:
    """Error tables of one model's predictions on the test rows.

    The predictions are written once; every table below reads them from there.
    """
    needed = [spec.entity, spec.ts, "Hour", spec.target, "prediction"]
    test = write_table(predicted.where(F.col("split") == "test").select(needed), "predictions")
    errors = modelling.with_error(test, spec.target)
    order = [spec.ts, spec.entity]
    numbered = with_row_index(test.select(*order, spec.target, "prediction"), order, "place")
    box = serial.with_ljung_box_p(serial.ljung_box(errors, spec, "error", table_order=order))
    return {
        "by_hour": modelling.error_by_hour(errors),
        "histogram": histogram(errors, "error", 50),
        "normal_fit": modelling.normal_fit(errors),
        "by_entity": modelling.entity_errors(test, spec.entity, spec.target),
        "perfect_line": modelling.perfect_line(test, spec.target),
        "week": numbered.where(F.col("place").between(slice_from, slice_from + slice_rows - 1)),
        "normality": serial.normality(errors, "error"),
        "shapiro_francia": serial.shapiro_francia(errors, "error"),
        "ljung_box": box,
        "significant_lags": serial.significant_lags(box),
    }
