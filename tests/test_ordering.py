import itertools
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import correlation, features, ordering, profiles, serial
from tidepanel.spec import PanelSpec

SPEC = PanelSpec(entity="e", ts="t", target="v", tie_break=("id",))


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one entity, a third of the values equal, nulls."""
    rng = random.Random(7)
    t0 = datetime(2024, 1, 1)
    rows = []
    for k in range(900):
        e = "hot" if rng.random() < 0.66 else rng.choice("abc")
        v = 0.0 if rng.random() < 0.33 else round(rng.gauss(5, 3), 2)
        rows.append((k, e, t0 + timedelta(minutes=rng.randrange(4000)), v, float(rng.randrange(9))))
    df = spark.createDataFrame(rows, "id int, e string, t timestamp_ntz, v double, x double")
    pdf = pd.DataFrame(rows, columns=["id", "e", "t", "v", "x"]).sort_values(["e", "t", "id"]).reset_index(drop=True)
    return df.repartition(5), pdf


def aligned(df, pdf, *columns):
    got = df.toPandas().set_index("id").loc[pdf["id"]]
    return [got[c].to_numpy(dtype=float) for c in columns]


def test_row_index_is_the_sorted_position(skewed):
    df, pdf = skewed
    (got,) = aligned(ordering.with_row_index(df, ["e", "t", "id"]), pdf, "row_index")
    assert (got == np.arange(len(pdf))).all()


def test_entity_index_restarts(skewed):
    df, pdf = skewed
    (got,) = aligned(ordering.with_entity_index(df, ["e"], ["t", "id"]), pdf, "entity_index")
    assert (got == pdf.groupby("e").cumcount()).all()


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_index_does_not_depend_on_the_bucket_count(skewed, buckets):
    df, pdf = skewed
    (got,) = aligned(ordering.with_row_index(df, ["e", "t", "id"], buckets=buckets), pdf, "row_index")
    assert (got == np.arange(len(pdf))).all()


def test_average_ranks(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (7.0,), (None,)], "v double").withColumn("k", F.lit(1))
    ladder = ordering.value_ladder(df, ["k"], "v").withColumn("r", ordering.average_rank())
    assert {(r["v"], r["n_at"], r["r"], r["dense"]) for r in ladder.collect()} == {(5.0, 2, 1.5, 0), (7.0, 1, 3.0, 1)}


def test_ranks_and_quantiles_per_group(skewed):
    df, pdf = skewed
    ladder = ordering.value_ladder(df, ["e"], "v").withColumn("r", ordering.average_rank()).toPandas()
    want = pdf.assign(r=pdf.groupby("e")["v"].rank()).drop_duplicates(["e", "v"])
    both = ladder.merge(want[["e", "v", "r"]], on=["e", "v"], suffixes=("", "_want"))
    assert len(both) == len(want) == len(ladder) and (both["r"] == both["r_want"]).all()
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.99, "e1": 1.0}
    found = ordering.quantiles(ordering.value_ladder(df, ["e"], "v"), ["e"], "v", probs).toPandas().set_index("e")
    for name, p in probs.items():
        expected = pdf.groupby("e")["v"].quantile(p)
        assert np.allclose(found[name].sort_index(), expected.sort_index())


@pytest.mark.parametrize("chunk_rows", [1, 7, 40, 10_000])
def test_chunked_lags_and_rolling_match_pandas(skewed, chunk_rows):
    df, pdf = skewed
    spec = SPEC
    wide = features.with_rolling(
        features.with_lags(df, spec, lags=[1, 5], chunk_rows=chunk_rows), spec, windows=[6], chunk_rows=chunk_rows
    )
    g = pdf.groupby("e")["v"]
    roll = lambda fn: g.transform(lambda s: getattr(s.shift(1).rolling(6, min_periods=1), fn)())
    got = aligned(wide, pdf, "v_lag_1", "v_lag_5", "v_rolling_mean_6", "v_rolling_std_6")
    for a, b in zip(got, [g.shift(1), g.shift(5), roll("mean"), roll("std")]):
        assert np.allclose(a, b.to_numpy(dtype=float), equal_nan=True, atol=1e-7)


def test_plain_and_chunked_windows_agree(skewed):
    df, pdf = skewed
    a = aligned(features.with_lags(df, SPEC, lags=[3], chunk_rows=10), pdf, "v_lag_3")
    b = aligned(features.with_lags(df, SPEC.at(hourly=True), lags=[3]), pdf, "v_lag_3")
    assert np.array_equal(a[0], b[0], equal_nan=True)


def test_rolling_fixture(spark):
    t0 = datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, "a", t0 + timedelta(hours=k), v) for k, v in enumerate([1.0, 3.0, 5.0, 9.0])],
                               "id int, e string, t timestamp_ntz, v double")
    rows = features.with_rolling(df, SPEC.at(hourly=True), windows=[2]).orderBy("t").collect()
    assert [r["v_rolling_mean_2"] for r in rows] == [None, 1.0, 2.0, 4.0]
    assert [r["v_rolling_std_2"] for r in rows] == [None, None, pytest.approx(math.sqrt(2)), pytest.approx(math.sqrt(2))]


@pytest.mark.parametrize("across", [False, True])
def test_rolling_correlation_matches_pandas(skewed, across):
    df, pdf = skewed
    found = correlation.rolling_correlation(df, SPEC, [("v", "x")], window=20, across_entities=across, chunk_rows=50)
    (got,) = aligned(found, pdf, "corr_v__x")
    if across:
        want = pdf["v"].rolling(20).corr(pdf["x"])
    else:
        want = pd.concat([g["v"].rolling(20).corr(g["x"]) for _, g in pdf.groupby("e")])
    assert np.allclose(got, want.to_numpy(), equal_nan=True, atol=1e-9)


def test_rolling_correlation_of_a_flat_stretch_is_null(spark):
    t0 = datetime(2024, 1, 1)
    values = [0.1, 0.7, 0.3, 0.3, 0.3, 0.3, 0.9]
    df = spark.createDataFrame([(k, "a", t0 + timedelta(hours=k), v, float(k)) for k, v in enumerate(values)],
                               "id int, e string, t timestamp_ntz, v double, x double")
    rows = correlation.rolling_correlation(df, SPEC, [("v", "x")], window=3, chunk_rows=3).orderBy("t").collect()
    assert [r["corr_v__x"] is None for r in rows] == [True, True, False, False, True, True, False]


@pytest.mark.parametrize("n, train", [(11, 8), (10, 8), (1, 0), (5, 4)])
def test_split_counts(spark, n, train):
    df = spark.range(n).withColumn("t", F.col("id") % 3)
    got = ordering.chronological_split(df, ["t", "id"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got if r["count"]} == {k: v for k, v in (("train", train), ("test", n - train)) if v}


def test_split_is_chronological(skewed):
    df, pdf = skewed
    got = ordering.chronological_split(df, ["t", "id"]).toPandas()
    assert got[got.split == "train"]["t"].max() <= got[got.split == "test"]["t"].min()


def test_kendall_matches_all_pairs(skewed):
    df, pdf = skewed
    found = correlation.kendall(df, [("v", "x")]).first()
    v, x = pdf["v"].to_numpy(), pdf["x"].to_numpy()
    s = ties_v = ties_x = 0
    for i, j in itertools.combinations(range(len(v)), 2):
        a, b = np.sign(v[i] - v[j]), np.sign(x[i] - x[j])
        s, ties_v, ties_x = s + a * b, ties_v + (a == 0), ties_x + (b == 0)
    n0 = len(v) * (len(v) - 1) / 2
    assert found["tau"] == pytest.approx(s / math.sqrt((n0 - ties_v) * (n0 - ties_x)), abs=1e-12)


def test_spearman_is_pearson_of_ranks_on_common_rows(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 9, 300).astype(float), "b": rng.normal(size=300)})
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::11, "b"] = np.nan
    found = correlation.spearman(spark.createDataFrame(pdf), [("a", "b")]).first()
    both = pdf.dropna().rank()
    assert found["n"] == len(both) and found["rho"] == pytest.approx(both.corr().iloc[0, 1])


def test_spearman_ranks_shared_columns_once(spark, monkeypatch):
    """Pairs with shared columns, gaps, common values, a constant and a pair without rows; one ladder with a
    side per column, or per pair where a gap leaves rows out, and no distinct pairs of values."""
    rng = np.random.default_rng(8)
    n = 6000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "q": rng.integers(0, 5, n).astype(float), "one": 7.0, "none": np.nan})
    pdf["b"] = np.where(rng.random(n) < 0.4, 0.0, pdf["a"] + rng.normal(size=n))
    pdf["c"] = np.where(pdf.index % 7 == 0, np.nan, pdf["b"] + rng.normal(size=n))
    pairs = [("a", "b"), ("q", "b"), ("b", "a"), ("c", "b"), ("a", "c"), ("one", "a"), ("a", "none")]
    ladder, counted = correlation.value_ladder, []

    def counting(df, keys, value, weight=None):
        out = ladder(df, keys, value, weight)
        counted.append(out.select("side").distinct().count())
        return out

    monkeypatch.setattr(correlation, "value_ladder", counting)
    monkeypatch.setattr(correlation, "pair_cells", None)
    found = {r["pair"]: r for r in correlation.spearman(spark.createDataFrame(pdf), pairs).collect()}
    assert counted == [7]  # a, b, q, c and one whole, b where c is, a where c is
    assert len(found) == len(pairs) - 1
    for x, y in pairs[:-2]:
        both = pdf[[x, y]].dropna().rank()
        r = found[f"{x} vs {y}"]
        assert r["n"] == len(both) and r["rho"] == pytest.approx(both.corr().iloc[0, 1], abs=1e-12)
    assert found["one vs a"]["n"] == n and found["one vs a"]["rho"] is None


def test_samples_are_exact_and_repeatable(skewed):
    df, pdf = skewed
    a = {r["id"] for r in ordering.hash_sample(df, ["id"], 100).collect()}
    b = {r["id"] for r in ordering.hash_sample(df.repartition(3), ["id"], 100).collect()}
    assert a == b and len(a) == 100
    assert ordering.hash_sample(df, ["id"], 5000).count() == len(pdf)
    sizes = {r["e"]: r["count"] for r in ordering.hash_sample_by(df, ["e"], ["id"], 110).groupBy("e").count().collect()}
    assert sizes == {e: min(110, n) for e, n in pdf["e"].value_counts().items()}


def test_box_fixture(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double")
    r = profiles.box_summary(df, "g", "v").first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["outliers"], r["n"]) == (2, 3, 4, 1, 4, 1, 5)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    rows = profiles.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 2, 2, 2, 3]
    assert sum(r["density"] * 2 for r in rows) == pytest.approx(1)
    flat = profiles.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 5)
    assert [r["count"] for r in flat.orderBy("bin").collect()] == [4, 0, 0, 0, 0]


def test_ljung_box_over_chunks(skewed):
    df, pdf = skewed
    found = serial.ljung_box(df, SPEC, "v", lags=5, chunk_rows=30).where("e = 'hot'").orderBy("lag").toPandas()
    e = pdf[pdf.e == "hot"]["v"].to_numpy()
    d, n = e - e.mean(), len(e)
    rho = np.array([(d[k:] * d[:-k]).sum() / (d * d).sum() for k in range(1, 6)])
    assert np.allclose(found["rho"], rho) and np.allclose(found["q"], n * (n + 2) * np.cumsum(rho**2 / (n - np.arange(1, 6))))


@pytest.mark.parametrize("hourly", [True, False])
def test_granger_matches_least_squares(skewed, hourly):
    df, pdf = skewed
    found = serial.granger(df, SPEC.at(hourly=hourly), "v", "x", max_lag=4, chunk_rows=25).toPandas()
    for e, g in pdf.groupby("e"):
        y, x, n = g["v"].to_numpy(), g["x"].to_numpy(), len(g)
        for p in range(1, 5):
            own = np.column_stack([y[p - i:n - i] for i in range(1, p + 1)] + [np.ones(n - p)])
            both = np.column_stack([own] + [x[p - i:n - i] for i in range(1, p + 1)])
            ssr = [((y[p:] - m @ np.linalg.lstsq(m, y[p:], rcond=None)[0]) ** 2).sum() for m in (own, both)]
            want = (ssr[0] - ssr[1]) / p / (ssr[1] / (n - 3 * p - 1))
            got = found[(found.e == e) & (found.lag == p)]
            assert got["f"].iloc[0] == pytest.approx(want, rel=1e-6) and got["n"].iloc[0] == n - p


def test_layout_survives_a_changed_input_order(skewed):
    df, pdf = skewed
    a = ordering.with_row_index(df.repartition(7), ["t", "id"]).select("id", "row_index")
    b = ordering.with_row_index(df.coalesce(1), ["t", "id"]).select("id", "row_index")
    assert a.exceptAll(b).count() == 0
