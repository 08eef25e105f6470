"""Stage A: raw text table to cleaned panel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidepanel.operators import cleaning
from tidepanel.spec import ENERGY, PanelSpec

HALF_HOUR = 1800.0


def typed(raw: DataFrame, spec: PanelSpec = ENERGY) -> DataFrame:
    """Renamed, cast and timestamped rows at the grain of the source."""
    return cleaning.assemble_timestamp(cleaning.cast_numbers(cleaning.rename_and_drop(raw, spec), spec), spec)


def clean(raw: DataFrame, spec: PanelSpec = ENERGY, halves: bool | None = None, regular: bool = False) -> DataFrame:
    """The cleaned panel.

    Whether the source is half-hourly is read from the data (one small job) unless
    ``halves`` says so; only then are rows rolled up to hours. With ``regular`` the hours that an
    entity lacks between its first and last are added before gaps are filled; the rows are then
    taken as hourly.
    """
    rows = typed(raw, spec)
    if halves is None:
        found = cleaning.granularity(rows, spec).first()
        halves = found is not None and found["gap_seconds"] == HALF_HOUR
    if halves:
        rows = cleaning.hourly_rollup(rows, spec)
    if regular:
        rows = cleaning.regularise(rows, spec)
    return cleaning.derive(cleaning.fill_gaps(rows, spec.at(hourly=halves or regular or spec.hourly)), spec)
