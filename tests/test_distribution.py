"""Normal quantiles, Shapiro-Francia, regular hours, samples by threshold, sketches, report texts."""

from datetime import datetime, timedelta
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.operators import cleaning, ordering, profiles, quality, serial, sketches
from tidepanel.sources import writers
from tidepanel.spec import PanelSpec

SPEC = PanelSpec(entity="e", ts="t", target="v", measures=("v",))


def test_normal_quantile(spark):
    ps = [1e-300, 1e-20, 1e-9, 0.001, 0.0749, 0.0751, 0.3, 0.5, 0.77, 0.9999, 1 - 1e-12]
    df = spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0, None]], "p double")
    got = [r[0] for r in df.select(fx.normal_quantile("p")).collect()]
    assert got[len(ps):] == [None, None, None]
    np.testing.assert_allclose(got[: len(ps)], [NormalDist().inv_cdf(p) for p in ps], rtol=1e-13, atol=1e-15)


def brute_w(x):
    x = np.sort(x)
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (len(x) + 0.25)) for i in range(1, len(x) + 1)])
    return np.corrcoef(x, m)[0, 1] ** 2


@pytest.mark.parametrize("step", [4096, 7])
def test_shapiro_francia_with_ties(spark, monkeypatch, step):
    monkeypatch.setattr(serial, "RANK_STEP", step)
    rng = np.random.default_rng(8)
    rows = [("ties", float(v)) for v in rng.integers(0, 4, 200)] + [("level", float(1e9 + v)) for v in rng.normal(size=120)]
    rows += [("flat", 2.0)] * 9 + [("few", v) for v in (1.0, 2.0, 4.0)] + [("level", None), ("level", float("nan"))]
    got = serial.shapiro_francia(spark.createDataFrame(rows, "g string, v double"), "v", ["g"]).toPandas().set_index("g")
    for g in ("ties", "level"):
        own = np.array([v for k, v in rows if k == g and v is not None and v == v])
        assert got["n"][g] == len(own) and got["w"][g] == pytest.approx(brute_w(own), rel=1e-6)
    assert got["w"][["flat", "few"]].isna().all() and got["p"]["ties"] < 1e-4 < 0.001 < got["p"]["level"]
    whole = serial.shapiro_francia(spark.createDataFrame(rows[:200], "g string, v double"), "v").first()
    assert whole["w"] == pytest.approx(got["w"]["ties"])


def test_shapiro_francia_p_is_even_under_normality(spark):
    rng = np.random.default_rng(1)
    rows = pd.DataFrame({"g": np.repeat(np.arange(200), 60), "v": rng.normal(size=12_000)})
    p = serial.shapiro_francia(spark.createDataFrame(rows), "v", ["g"]).toPandas()["p"]
    assert abs(p.mean() - 0.5) < 0.07 and (p < 0.05).mean() < 0.1 and np.histogram(p, 4, (0, 1))[0].min() > 30


@pytest.mark.parametrize("chunk", [1000, 3])
def test_regular_hours(spark, chunk):
    t0 = datetime(2024, 3, 30, 20)
    at = lambda h: t0 + timedelta(hours=h)
    rows = [("a", at(0), 1.0), ("a", at(1.5), 9.0), ("a", at(4), 5.0), ("b", at(2), 7.0), ("a", None, 3.0), (None, at(1), 4.0)]
    df = spark.createDataFrame(rows, "e string, t timestamp_ntz, v double")
    got = sorted(map(tuple, cleaning.regularise(df, SPEC, chunk=chunk).collect()), key=str)
    want = [*rows, ("a", at(1), None), ("a", at(2), None), ("a", at(3), None)]
    assert got == sorted(want, key=str)
    assert cleaning.regularise(df.limit(0), SPEC).count() == 0


def test_threshold_samples_equal_the_smallest_hashes(spark):
    rows = [(i, ["hot", "warm", None][0 if i % 5 else 1 if i % 3 else 2]) for i in range(4000)] + [(9000 + i, f"small{i % 40}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, g string").repartition(6)
    for k in (3, 60, 1000):
        got = {(r["id"], r["g"]) for r in ordering.hash_sample_by(df, ["g"], ["id"], k).collect()}
        drawn = df.withColumn("d", F.md5(F.concat_ws("|", F.lit("42"), F.col("id").cast("string")))).toPandas()
        want = {(r.id, r.g) for _, own in drawn.groupby("g", dropna=False) for r in own.sort_values(["d", "id"]).head(k).itertuples()}
        assert {(i, g if isinstance(g, str) else None) for i, g in want} == got


def test_groups_that_the_threshold_leaves_short_are_taken_whole(spark, monkeypatch):
    # Equal keys have equal hashes: all rows of a group lie above its threshold, or none.
    df = spark.createDataFrame([(1, f"g{i % 30}", i) for i in range(30_000)], "id int, g string, x int")
    got = ordering.hash_sample_by(df, ["g"], ["id"], 20).groupBy("g").count().collect()
    assert [r["count"] for r in got] == [20] * 30


def test_sketches_merge_upward(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], n), "t": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 300, n), "D"),
                        "u": rng.integers(0, 3000, n), "v": rng.normal(size=n)})
    stored = sketches.monthly(spark.createDataFrame(pdf), ["k"], "t", "u", "v")
    assert stored.count() == 20
    got = sketches.merged(stored, ["k"], {"median": 0.5, "high": 0.9}).toPandas().set_index("k")
    for k, own in pdf.groupby("k"):
        assert got["n"][k] == len(own) and abs(got["distinct"][k] / own["u"].nunique() - 1) <= sketches.DISTINCT_ERROR
        for name, p in (("median", 0.5), ("high", 0.9)):
            assert abs((own["v"] <= got[name][k]).mean() - p) <= sketches.RANK_ERROR


def test_zero_and_minus_zero_are_one_value(spark):
    df = spark.createDataFrame([(0.0, "x"), (-0.0, "x"), (1.0, None), (float("nan"), "y")], "v double, s string")
    got = {r["column"]: (r["non_null"], r["distinct"]) for r in quality.column_profile(df).collect()}
    assert got == {"v": (4, 3), "s": (3, 2)}


def test_first_rows_of_the_mode_take_the_tie_break(spark):
    df = spark.createDataFrame([("a", 1, i) for i in range(50)] + [("b", 0, 0)], "e string, t int, id int").repartition(5)
    got = [r["id"] for r in profiles.first_rows_of_mode(df, "e", "t", 7, ["id"]).collect()]
    assert got == list(range(7))


def test_report_of_tests_as_text(spark, tmp_path):
    pairs = spark.createDataFrame([("a vs b", 0.91, 0.0001)], "pair string, pearson_r double, pearson_p double")
    groups = spark.createDataFrame([("a", "g", 0.2)], "quantitative string, qualitative string, anova_p double")
    done = spark.createDataFrame([(2, 1, "a vs b", 0.91, "a par g", 0.25)],
                                 "n_tests int, n_significant int, strongest_pair string, strongest_r double, largest_effect string, largest_eta_squared double")
    text = writers.test_report(pairs, groups, done)
    assert text.startswith("1 of 2 tests significant; strongest pair a vs b (r 0.910); largest effect a par g (eta squared 0.250)")
    assert "pearson_r" in text and "anova_p" in text and text.endswith("\n")
    writers.write_text(pairs, text, f"file://{tmp_path}/report")
    assert spark.read.text(f"file://{tmp_path}/report", wholetext=True).first()[0].strip() == text.strip()


def test_buckets_follow_the_tables_read(spark, sf_dir, monkeypatch):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ordering.bucket_count(lines) == partitions
    monkeypatch.setattr(ordering, "BUCKET_BYTES", 10_000)
    assert ordering.bucket_count(lines) > partitions
    assert ordering.bucket_count(spark.createDataFrame([(1,)], "x int")) == partitions
