import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx


def one(spark, column, **values):
    cells = [F.lit(v).alias(k) if v is not None else F.lit(None).cast("double").alias(k) for k, v in values.items()]
    return spark.range(1).select(*cells).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [("1,5", 1.5), (" 12 ", 12.0), ("ND", None), ("-", None), ("nan", None), ("12d", None), ("inf", None),
     ("-3.25", -3.25), ("1e3", 1000.0), (".5", 0.5), ("", None)],
)
def test_locale_number(spark, text, expected):
    assert one(spark, fx.locale_number("t"), t=text) == expected


def test_locale_number_of_null(spark):
    assert spark.sql("select cast(null as string) t").select(fx.locale_number("t")).first()[0] is None


def test_calendar_monday_is_zero(spark):
    row = spark.sql("select timestamp_ntz'2024-01-01 05:00:00' t").select(
        *[c.alias(n) for n, c in fx.calendar("t").items()]
    ).first()
    assert row.asDict() == dict(
        Year=2024, Month=1, Day=1, Hour=5, DayOfWeek=0, IsWeekend=0, Quarter=1, Season="Winter"
    )


@pytest.mark.parametrize("month, name, number", [(12, "Winter", 1), (3, "Spring", 2), (8, "Summer", 3), (11, "Autumn", 4)])
def test_seasons(spark, month, name, number):
    assert one(spark, fx.season("m"), m=month) == name
    assert one(spark, fx.season_number(fx.season("m")), m=month) == number


def test_unknown_season_has_no_number(spark):
    assert one(spark, fx.season_number("s"), s="Monsoon") is None


def test_row_sum_skips_nulls(spark):
    df = spark.createDataFrame([(None, 2.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(fx.sum_present(["a", "b"])).collect()] == [2.0, 0.0]


def test_share_is_guarded(spark):
    assert one(spark, fx.share("p", "t"), p=3.0, t=0.0) == 0.0
    assert one(spark, fx.share("p", "t"), p=1.0, t=4.0) == 25.0


def test_ratio_is_null_on_zero_denominator(spark):
    assert one(spark, fx.ratio_to_next("a", "b"), a=1.0, b=-1.0) is None


def test_accent_key(spark):
    assert one(spark, fx.accent_key("t"), t="Île-de-France") == "ile-de-france"
    assert one(spark, fx.accent_key("t"), t="Ilê ÇA Ångström") == "ile ca angstrom"


@pytest.mark.parametrize("eta, label", [(0.06, "Small"), (0.07, "Medium"), (0.14, "Medium"), (0.15, "Large")])
def test_effect_bounds_are_strict(spark, eta, label):
    assert one(spark, fx.effect("e"), e=eta) == label


@pytest.mark.parametrize(
    "r, label", [(0.05, "Négligeable"), (0.1, "Faible"), (-0.3, "Modérée"), (0.5, "Forte"), (-0.7, "Très forte")]
)
def test_strength_takes_the_upper_class(spark, r, label):
    assert one(spark, fx.strength("r"), r=r) == label


def test_stars(spark):
    got = [one(spark, fx.stars("p"), p=p) for p in (0.0005, 0.005, 0.04, 0.05)]
    assert got == ["***", "**", "*", "ns"]
    assert one(spark, fx.stars("p", ""), p=0.5) == ""


def test_floor_is_independent_of_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        # 02:30 does not exist in Paris on that day.
        df = spark.sql("select timestamp_ntz'2024-03-31 02:41:07.25' t")
        row = df.select(fx.floor_to("t", 60), fx.floor_to("t", 30)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert list(row) == [datetime(2024, 3, 31, 2), datetime(2024, 3, 31, 2, 30)]


def test_timestamp_raises_on_bad_text_and_date_does_not(spark):
    df = spark.createDataFrame([("2024-01-05", "10:30")], "d string, h string")
    assert df.select(fx.joined_timestamp("d", "h")).first()[0] == datetime(2024, 1, 5, 10, 30)
    bad = spark.createDataFrame([("junk", "10:30")], "d string, h string")
    with pytest.raises(Exception):
        bad.select(fx.joined_timestamp("d", "h")).collect()
    assert bad.select(fx.lenient_date("d")).first()[0] is None


def test_temperature_without_noise(spark):
    got = one(spark, fx.harmonic_temperature("d", "h"), d=100, h=12)
    want = 15 + 10 * math.sin(2 * math.pi * 100 / 365 - math.pi / 2) + 5 * math.sin(math.pi - math.pi / 3)
    assert got == pytest.approx(want)


def test_text_labels(spark):
    assert one(spark, fx.shortened("t", 4), t="abcdef") == "abcd..."
    assert one(spark, fx.shortened("t", 6), t="abcdef") == "abcdef"
    assert one(spark, fx.first_token("t"), t="Eolien_MW") == "Eolien"
