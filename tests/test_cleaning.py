from datetime import datetime, timedelta

import pytest

from tidepanel.operators import cleaning, quality
from tidepanel.operators.ordering import interpolate
from tidepanel.plans import clean as stage
from tidepanel.spec import ENERGY, PanelSpec

T0 = datetime(2024, 1, 1)


def panel(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def half_hours(spark, values, column="Consommation_MW"):
    rows = [("A", T0 + timedelta(minutes=30 * k), v, label) for k, (v, label) in enumerate(values)]
    return panel(spark, rows, f"Region string, Datetime timestamp_ntz, {column} double, Nature string")


@pytest.mark.parametrize("pair, expected", [((10.0, 20.0), 15.0), ((None, 20.0), 10.0), ((None, None), 0.0)])
def test_rollup_halves_the_sum(spark, pair, expected):
    df = half_hours(spark, [(v, "x") for v in pair])
    assert cleaning.hourly_rollup(df, ENERGY).first()["Consommation_MW"] == expected


def test_rollup_averages_rates_and_keeps_null(spark):
    df = half_hours(spark, [(None, "x"), (None, "x"), (4.0, "x"), (None, "x")], "TCO_Thermique")
    rows = cleaning.hourly_rollup(df, ENERGY).orderBy("Datetime").collect()
    assert [r["TCO_Thermique"] for r in rows] == [None, 4.0]


def test_rollup_takes_first_filled_label_and_drops_null_keys(spark):
    df = half_hours(spark, [(1.0, None), (1.0, "b")])
    lost = panel(spark, [(None, T0, 5.0, "z"), ("A", None, 5.0, "z")], df.schema)
    rows = cleaning.hourly_rollup(df.unionByName(lost), ENERGY).collect()
    assert [(r["Nature"], r["Consommation_MW"]) for r in rows] == [("b", 1.0)]


@pytest.mark.parametrize("hourly", [True, False])
def test_granularity_takes_the_lowest_mode(spark, hourly):
    minutes = [0, 30, 90, 120, 180]
    df = panel(spark, [("A", T0 + timedelta(minutes=m)) for m in minutes], "Region string, Datetime timestamp_ntz")
    assert cleaning.granularity(df, ENERGY.at(hourly=hourly)).first()["gap_seconds"] == 1800.0


def test_gaps_stay_inside_an_entity(spark):
    rows = [("A", T0), ("A", T0 + timedelta(hours=1)), ("B", T0 + timedelta(minutes=5)), ("B", T0 + timedelta(minutes=6))]
    df = panel(spark, rows, "Region string, Datetime timestamp_ntz")
    gaps = sorted(r["gap_seconds"] for r in cleaning.row_gaps(df, ENERGY).where("gap_seconds is not null").collect())
    assert gaps == [60.0, 3600.0]


@pytest.mark.parametrize("hourly", [True, False])
@pytest.mark.parametrize(
    "values, expected",
    [
        ([None, 1.0, None, None, 7.0, None], [1, 1, 3, 5, 7, 7]),
        ([None, None], [None, None]),
        ([2.0, 4.0], [2, 4]),
        ([None] * 9 + [3.0] + [None] * 9, [3] * 19),
    ],
)
def test_interpolation_by_position(spark, values, expected, hourly):
    rows = [("A", T0 + timedelta(hours=k * k), v) for k, v in enumerate(values)] + [("B", T0, 99.0)]
    df = panel(spark, rows, "Region string, Datetime timestamp_ntz, v double")
    got = interpolate(df, ENERGY.at(hourly=hourly), ["v"], chunk_rows=2).where("Region = 'A'").orderBy("Datetime")
    assert [r["v"] for r in got.collect()] == expected


def test_idle_rates(spark):
    df = panel(spark, [(0.0, 7.0), (None, 7.0), (5.0, None)], "Thermique_MW double, TCO_Thermique double")
    assert [r["TCO_Thermique"] for r in cleaning.zero_idle_rates(df, ENERGY).collect()] == [0.0, 0.0, None]


def test_rate_without_its_source_is_left_alone(spark):
    df = panel(spark, [(3.0,)], "TCO_Vague double")
    assert cleaning.zero_idle_rates(df, ENERGY).first()[0] == 3.0


def test_timestamp_from_fallback_or_error(spark):
    df = panel(spark, [("2024-01-01 10:30:00",)], "Date_Heure string")
    assert cleaning.assemble_timestamp(df, ENERGY).first()["Datetime"] == datetime(2024, 1, 1, 10, 30)
    with pytest.raises(ValueError, match="Consommation_MW"):
        cleaning.assemble_timestamp(panel(spark, [(1.0,)], "Consommation_MW double"), ENERGY)


def test_stage_reads_the_granularity(spark):
    rows = [("A", "N", "2024-01-01", f"{k // 2:02d}:{30 * (k % 2):02d}", "10,5", "4") for k in range(8)]
    raw = panel(spark, rows, "`Région` string, Nature string, Date string, Heure string, `Consommation (MW)` string, `Thermique (MW)` string")
    rolled = stage.clean(raw).orderBy("Datetime").collect()
    assert len(rolled) == 4 and rolled[0]["Consommation_MW"] == 10.5 and rolled[0]["Balance_MW"] == -6.5
    hourly = panel(spark, [r for r in rows if r[3].endswith("00")], raw.schema)
    kept = stage.clean(hourly).collect()
    assert len(kept) == 4 and {r["Consommation_MW"] for r in kept} == {10.5}


def test_interpolation_only_acts_without_rollup(spark):
    rows = [("A", "N", "2024-01-01", f"{h:02d}:00", "1", v) for h, v in enumerate(["2", None, "6", "ND"])]
    raw = panel(spark, rows, "`Région` string, Nature string, Date string, Heure string, `Consommation (MW)` string, `Thermique (MW)` string")
    got = stage.clean(raw, halves=False).orderBy("Datetime").collect()
    assert [r["Thermique_MW"] for r in got] == [2.0, 4.0, 6.0, 6.0]


def test_quality_tables(spark):
    df = panel(spark, [(1.0, None, "a"), (-2.0, None, "a"), (None, 3.0, None)], "Consommation_MW double, y double, z string")
    assert [(r["column"], r["nulls"]) for r in quality.null_profile(df).collect()] == [
        ("y", 2), ("Consommation_MW", 1), ("z", 1)
    ]
    size = quality.completeness(df).first()
    assert (size["n_rows"], size["n_columns"], size["cells"], size["null_cells"]) == (3, 3, 9, 4)
    assert size["completeness"] == pytest.approx(500 / 9)
    profile = {r["column"]: (r["type"], r["non_null"], r["distinct"]) for r in quality.column_profile(df).collect()}
    assert profile == {"Consommation_MW": ("double", 2, 2), "y": ("double", 1, 1), "z": ("string", 2, 1)}
    rules = {(r["rule"], r["column"]): (r["violations"], r["passed"]) for r in quality.validate(df, ENERGY).collect()}
    assert rules["non_negative", "Consommation_MW"] == (1, False) and rules["filled", "y"] == (2, False)


def test_null_months_ignore_unreadable_dates(spark):
    df = panel(spark, [("2024-01-05", None), ("2024-01-06", "x"), ("junk", None), ("2024-02-01", None)], "Date string, v string")
    got = {r["month"].month: r["null_percent"] for r in quality.null_by_month(df, "Date").collect()}
    assert got == {1: pytest.approx(100 / 8), 2: pytest.approx(100 / 4)}


def test_null_indicators_keep_only_columns_with_nulls(spark):
    df = panel(spark, [(1, 1.0, None), (2, None, None), (3, 1.0, 2.0)], "id int, a double, b double").selectExpr("*", "1 c")
    got = sorted((r["id"], r["column"], r["is_null"]) for r in quality.null_indicators(df, ["id"]).collect())
    assert got == [(1, "a", 0), (1, "b", 1), (2, "a", 1), (2, "b", 1), (3, "a", 0), (3, "b", 0)]


def test_spec_needs_no_energy_columns(spark):
    spec = PanelSpec(entity="meter", ts="at", target="load", measures=("load",))
    df = panel(spark, [("m", T0, 3.0), ("m", T0 + timedelta(minutes=30), 5.0)], "meter string, at timestamp_ntz, load double")
    assert cleaning.hourly_rollup(df, spec).first()["load"] == 4.0
