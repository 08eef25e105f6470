import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.functions import tails
from tidepanel.operators import correlation, grouptests, serial
from tidepanel.plans import testing


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 400
    pdf = pd.DataFrame({
        "id": np.arange(n), "g": rng.choice(list("abc"), n, p=[0.7, 0.2, 0.1]),
        "a": rng.normal(1000, 1, n), "k": np.full(n, 0.1),
    })
    pdf["b"] = 2 * pdf["a"] + rng.normal(size=n)
    pdf["c"] = rng.integers(0, 4, n).astype(float)
    pdf.loc[::9, "c"] = np.nan
    pdf["a"] += (pdf["g"] == "b") * 0.5
    return spark.createDataFrame(pdf).repartition(5), pdf


@pytest.mark.parametrize(
    "name, args, expected",
    [
        ("t_two_sided", (2.0, 10), 0.07338803477074046),
        ("t_two_sided", (0.0, 5), 1.0),
        ("chi2_upper", (10, 4), 0.04042768199451279),
        ("chi2_upper", (655.940058, 6), 1.984782e-138),
        ("chi2_upper", (124.497382, 1), 6.556558e-29),
        ("f_upper", (3, 2, 20), 0.07253815028640583),
        ("f_upper", (53.322366, 6, 1060697), 4.465284e-66),
        ("f_upper", (35.745616, 1, 1060702), 2.249089e-09),
        ("t_critical", (10, 0.05), 2.2281388519649385),
        ("studentized_range_critical", (3, 20, 0.05), 3.577935),
        ("normal_two_sided", (1.959963984540054,), 0.05),
    ],
)
def test_tails(name, args, expected):
    assert getattr(tails, name)(*args) == pytest.approx(expected, rel=1e-6)


def test_tails_of_extreme_arguments():
    assert tails.t_two_sided(500.0, 1e6) == 0.0
    assert tails.f_upper(math.inf, 2, 10) == 0.0
    assert math.isnan(tails.t_two_sided(math.nan, 10))
    assert tails.t_two_sided(2.0, 1e9) == pytest.approx(tails.t_two_sided(2.0, 9e7), rel=1e-6)


def test_effect_size_and_f_agree_with_the_published_pair():
    eta, n, k = 0.736175, 1060704, 12
    assert eta / (1 - eta) * (n - k) / (k - 1) == pytest.approx(269068.35, rel=1e-4)


def test_matrix_matches_pandas_pairwise(data):
    df, pdf = data
    columns = ["a", "b", "c", "k"]
    got = correlation.correlation_matrix(df, columns).toPandas()
    assert len(got) == 16
    want = pdf[columns].corr()
    for r in got.itertuples():
        expected = want.loc[r.var1, r.var2]
        assert (r.corr is None or math.isnan(r.corr)) if "k" in (r.var1, r.var2) else r.corr == pytest.approx(expected, abs=1e-9)
        assert r.n == pdf[[r.var1, r.var2]].dropna().shape[0]


def test_pearson_of_a_constant_is_null(data):
    df, _ = data
    row = correlation.with_pearson_p(correlation.pearson(df, [("a", "k")])).first()
    assert row["r"] is None and row["p"] is None and row["n"] == 400


def test_regression_and_residuals(data):
    df, pdf = data
    slope, intercept = np.polyfit(pdf["a"], pdf["b"], 1)
    found = correlation.pearson(df, [("a", "b")])
    row = found.first()
    assert (row["slope"], row["intercept"]) == (pytest.approx(slope), pytest.approx(intercept, rel=1e-6))
    got = correlation.with_residual(df, [("a", "b")]).toPandas().set_index("id")["residual"].sort_index()
    assert np.allclose(got, pdf["b"] - (intercept + slope * pdf["a"]), atol=1e-6)
    line = correlation.regression_line(found).orderBy("point").toPandas()
    assert len(line) == 100 and line["x"].iloc[-1] == pytest.approx(pdf["a"].max())


def test_partial_correlation(data):
    df, pdf = data
    def residual(y, z):
        m = np.column_stack([z, np.ones(len(z))])
        return y - m @ np.linalg.lstsq(m, y, rcond=None)[0]
    z = (pdf["g"] == "b").astype(float).to_numpy()
    want = np.corrcoef(residual(pdf["a"].to_numpy(), z), residual(pdf["b"].to_numpy(), z))[0, 1]
    row = correlation.partial_correlation(df.withColumn("z", (F.col("g") == "b").cast("double")), "a", "b", "z").first()
    assert row["r_partial"] == pytest.approx(want, abs=1e-9)
    gone = correlation.partial_correlation(df, "a", "b", "a").first()
    assert gone["r_partial"] is None and gone["p"] is None


def test_anova_kruskal_tukey(data):
    df, pdf = data
    groups = [g["a"].to_numpy() for _, g in pdf.groupby("g")]
    n, k, mean = len(pdf), 3, pdf["a"].mean()
    between = sum(len(g) * (g.mean() - mean) ** 2 for g in groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups)
    row = grouptests.with_anova_p(grouptests.anova(df, [("a", "g")])).first()
    assert row["anova_f"] == pytest.approx((between / 2) / (within / (n - k)), rel=1e-6)
    assert row["eta_squared"] == pytest.approx(between / (between + within), rel=1e-6)
    ranks = pdf["a"].rank()
    h = 12 / (n * (n + 1)) * sum(len(r) * r.mean() ** 2 for _, r in ranks.groupby(pdf["g"])) - 3 * (n + 1)
    assert grouptests.kruskal(df, [("a", "g")]).first()["kruskal_h"] == pytest.approx(h, rel=1e-6)
    pairs = grouptests.with_tukey_p(grouptests.tukey(df, "a", "g")).orderBy("group1", "group2").toPandas()
    assert list(zip(pairs["group1"], pairs["group2"])) == [("a", "b"), ("a", "c"), ("b", "c")]
    q = abs(groups[0].mean() - groups[1].mean()) / math.sqrt(within / (n - k) / 2 * (1 / len(groups[0]) + 1 / len(groups[1])))
    assert pairs["q"].iloc[0] == pytest.approx(q, rel=1e-6)
    assert (pairs["reject"] == (pairs["p"] < 0.05)).all() and ((pairs["lower"] * pairs["upper"] > 0) == pairs["reject"]).all()


def test_kruskal_with_ties_and_a_single_group(data):
    df, pdf = data
    both = pdf.dropna(subset=["c"])
    ranks, n = both["c"].rank(), len(both)
    h = 12 / (n * (n + 1)) * sum(len(r) * r.mean() ** 2 for _, r in ranks.groupby(both["g"])) - 3 * (n + 1)
    ties = both["c"].value_counts()
    h /= 1 - (ties**3 - ties).sum() / (n**3 - n)
    assert grouptests.kruskal(df, [("c", "g")]).first()["kruskal_h"] == pytest.approx(h, rel=1e-9)
    alone = grouptests.with_anova_p(grouptests.anova(df.withColumn("one", F.lit("x")), [("a", "one")])).first()
    assert alone["anova_f"] is None and alone["anova_p"] is None


def test_battery_tables(data):
    df, _ = data
    pairs = testing.pair_tests(df, [("a", "b"), ("a", "c")])
    groups = testing.group_tests(df, [("a", "g"), ("c", "g")])
    assert pairs.count() == 2 and groups.count() == 2
    row = pairs.where("pair = 'a vs b'").first()
    assert row["strength"] == "Très forte" and row["stars"] == "***" and row["residuals_normal"] in (True, False)
    end = testing.conclusions(pairs, groups).first()
    assert end["n_tests"] == 4 and end["strongest_pair"] == "a vs b" and end["largest_effect"] == "a par g"
    assert testing.p_values(pairs, groups).agg(F.sum("count")).first()[0] == 4
    post = testing.post_hoc(df, groups, categories=["g"])
    assert ("a", "g") in post and post["a", "g"].count() == 3


def test_normality_of_all_rows(spark):
    rng = np.random.default_rng(5)
    rows = [("normal", float(v)) for v in rng.normal(1e6, 2, 9000)] + [("skewed", float(v)) for v in rng.exponential(3, 9000)]
    rows += [("constant", 4.0)] * 30 + [("few", float(v)) for v in range(9)]
    found = serial.normality(spark.createDataFrame(rows, "g string, v double"), "v", ["g"]).toPandas().set_index("g")
    assert found.loc["normal", "normal"] and not found.loc["skewed", "normal"] and found["n"].sum() == 18039
    assert found.loc["normal", "k2_p"] == pytest.approx(math.exp(-found.loc["normal", "k2"] / 2))
    assert math.isnan(found.loc["few", "k2"]) and found.loc["few", "normal"]


LEVELS = [0.0, 1e6, -1e7]


def _levels(spark, n=400):
    rng = np.random.default_rng(9)
    rows = []
    for k, level in enumerate(LEVELS):
        walk = rng.normal(size=n)
        for i in range(1, n):
            walk[i] += 0.4 * walk[i - 1]
        rows += [(f"e{k}", i, float(level + walk[i]), float(rng.normal() + 0.5 * walk[i - 1] - level)) for i in range(n)]
    pdf = pd.DataFrame(rows, columns=["e", "t", "y", "x"])
    return spark.createDataFrame(pdf), pdf


def _spec():
    from tidepanel.spec import PanelSpec

    return PanelSpec(entity="e", ts="t", target="y", measures=("y", "x"), tie_break=())


@pytest.mark.parametrize("chunk", [50, 170, 50_000])
def test_rolling_statistics_hold_at_any_level(spark, chunk):
    from tidepanel.operators import features

    df, pdf = _levels(spark)
    pdf.loc[(pdf.e == "e1") & (pdf.t == 0), "y"] = 0.0
    pdf.loc[(pdf.e == "e2") & (pdf.t == 60), "y"] = np.nan
    pdf.loc[(pdf.e == "e2") & (pdf.t == 90), "y"] = np.inf
    df = spark.createDataFrame(pdf)
    got = features.with_rolling(df, _spec(), windows=(6, 24), chunk_rows=chunk).toPandas().sort_values(["e", "t"])
    for k in (6, 24):
        for e, own in pdf.groupby("e"):
            past = own["y"].replace([np.inf, -np.inf], np.nan).shift(1).reset_index(drop=True)
            frames = [past.iloc[max(0, i - k + 1) : i + 1].dropna() for i in range(len(past))]
            mine = got[got.e == e]
            np.testing.assert_allclose(mine[f"y_rolling_mean_{k}"], [f.mean() if len(f) else np.nan for f in frames], rtol=1e-12)
            np.testing.assert_allclose(mine[f"y_rolling_std_{k}"], [f.std() if len(f) > 1 else np.nan for f in frames], rtol=1e-6, atol=1e-12)
    corr = correlation.rolling_correlation(df, _spec(), [("y", "x")], window=30, chunk_rows=chunk).toPandas().sort_values(["e", "t"])
    own = pdf[pdf.e == "e0"].reset_index(drop=True)
    want = [np.nan if i < 29 else np.corrcoef(own["y"][i - 29 : i + 1], own["x"][i - 29 : i + 1])[0, 1] for i in range(len(own))]
    np.testing.assert_allclose(corr[corr.e == "e0"]["corr_y__x"].astype(float), want, rtol=1e-9)


def test_serial_tests_hold_at_any_level(spark):
    df, pdf = _levels(spark)
    box = serial.ljung_box(df, _spec(), "y", lags=4).toPandas().set_index(["e", "lag"])["rho"]
    found = serial.granger(df, _spec(), "y", "x", 3).toPandas().set_index(["e", "lag"])["f"]
    for e, own in pdf.groupby("e"):
        d = (own["y"] - own["y"].mean()).to_numpy()
        for k in range(1, 5):
            assert box[e, k] == pytest.approx((d[k:] * d[:-k]).sum() / (d * d).sum(), rel=1e-6)
        y, x, n = own["y"].to_numpy() - own["y"].mean(), own["x"].to_numpy() - own["x"].mean(), len(own)
        for p in (1, 2, 3):
            past = [s[p - i : n - i] for s in (y, x) for i in range(1, p + 1)]
            both, alone = (np.column_stack([*c, np.ones(n - p)]) for c in (past, past[:p]))
            rss = [((y[p:] - m @ np.linalg.lstsq(m, y[p:], rcond=None)[0]) ** 2).sum() for m in (alone, both)]
            assert found[e, p] == pytest.approx((rss[0] - rss[1]) / p / (rss[1] / (n - 3 * p - 1)), rel=1e-6)


def test_noise_does_not_change_with_the_partitions(spark):
    from tidepanel.functions import columns as fx

    df = spark.range(5000)
    noise = [df.repartition(n).select("id", fx.hash_normal(["id"], 7).alias("z")).orderBy("id").toPandas() for n in (2, 7)]
    assert noise[0].equals(noise[1])
    assert abs(noise[0]["z"].mean()) < 0.05 and abs(noise[0]["z"].std() - 1) < 0.05


def test_tukey_over_blocks_gives_all_pairs(data):
    df, _ = data
    wide = df.withColumn("many", F.concat(F.col("g"), (F.col("id") % 7).cast("string")))
    one = grouptests.tukey(wide, "a", "many").toPandas().sort_values(["group1", "group2"])
    cut = grouptests.tukey(wide, "a", "many", block_groups=4).toPandas().sort_values(["group1", "group2"])
    assert len(one) == 21 * 20 // 2 and one["q"].tolist() == cut["q"].tolist()


def test_category_matrix(data):
    df, pdf = data
    matrix = correlation.correlation_matrix(df, ["a", "b", "c"])
    got = {(r["cat1"], r["cat2"]): r["mean_abs_corr"]
           for r in correlation.category_matrix(matrix, {"X": ["a"], "Y": ["b", "c"], "Z": ["missing"]}).collect()}
    assert len(got) == 9 and got["X", "X"] == 1 and got["X", "Z"] == 0
    want = pdf[["a", "b", "c"]].corr().abs().loc["a", ["b", "c"]].mean()
    assert got["X", "Y"] == pytest.approx(want, abs=1e-9) == got["Y", "X"]
