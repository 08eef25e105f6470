"""The regressions from cross-products against the estimators of pyspark.ml and closed forms."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidepanel.operators import linear, modelling


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    n = 400
    pdf = pd.DataFrame({
        "id": np.arange(n), "x1": rng.normal(50, 10, n), "x2": rng.normal(0, 2, n) + 1e6, "flat": 3.0,
        "g": rng.choice(["a", "b'c", "d\\e", "f"], n),
    })
    pdf["y"] = 3 * pdf["x1"] - 40 * (pdf["x2"] - 1e6) + (pdf["g"] == "f") * 25 + rng.normal(0, 20, n)
    pdf["split"] = np.where(pdf.index < 320, "train", "test")
    pdf.loc[399, "g"], pdf.loc[398, "g"] = "unseen", None
    return spark.createDataFrame(pdf).repartition(3).cache(), pdf


def test_equal_to_the_estimators(rows):
    df, pdf = rows
    # Only levels and columns that the estimators take: no null level, no constant column.
    df = df.where("g is not null")
    stats = modelling.TargetStats.of(df.where("split = 'train'"), "y")
    sets = {"one": ["x1"], "two": ["x1", "x2"]}
    fits = modelling.linear_fits(df, "y", "g", sets)
    scores = modelling.linear_scores(df, fits, "y")
    for (s, m), result in fits.items():
        other = modelling.fit(modelling.estimators("y", stats)[m], df, stats.n, sets[s], "g")
        both = result.predicted.select("id", "prediction").join(other.predicted.select("id", F.col("prediction").alias("p")), "id").toPandas()
        np.testing.assert_allclose(both["prediction"], both["p"], rtol=1e-6 if m != linear.LASSO else 1e-4)
        row = modelling.score(result, "y", m, s).first()
        np.testing.assert_allclose(scores[s, m], [row[f"{a}_{b}"] for a in ("train", "test") for b in modelling.METRICS], rtol=1e-9)


def test_closed_forms_with_constant_column_and_any_level(rows):
    df, pdf = rows
    g = linear.gram(df.where("split = 'train'"), ["x1", "x2", "flat"], "y", "g")
    train = (pdf.split == "train").to_numpy()
    x = pdf[["x1", "x2", "flat"]].to_numpy()
    z = (x - x[train].mean(0)) / np.where(x[train].std(0) > 0, x[train].std(0), 1)
    design = np.column_stack([z, *[(pdf["g"] == v).to_numpy(float) for v in sorted(set(pdf["g"][train]))[1:]]])
    c, y = design[train] - design[train].mean(0), pdf["y"].to_numpy()
    b = c.T @ (y[train] - y[train].mean())
    want = {
        linear.ORDINARY: np.linalg.lstsq(c, y[train] - y[train].mean(), rcond=None)[0],
        linear.RIDGE: np.linalg.solve(c.T @ c + np.eye(c.shape[1]), b),
    }
    for name, beta in want.items():
        line = linear.solve(g, ["x1", "x2", "flat"], name)
        np.testing.assert_allclose(line.standard, beta, rtol=1e-6, atol=1e-7)
        got = line.pipeline("g").transform(df).select("id", "prediction").toPandas().set_index("id")["prediction"].sort_index()
        np.testing.assert_allclose(got, (design - design[train].mean(0)) @ beta + y[train].mean(), rtol=1e-7)
    line = linear.solve(g, ["x1", "x2", "flat"], linear.LASSO)
    slope = (b - c.T @ c @ line.standard) / train.sum()
    for w, d in zip(line.standard, slope):
        assert d == pytest.approx(np.sign(w), abs=1e-8) if w else abs(d) <= 1 + 1e-8


def test_saved_line_predicts_the_same(rows, tmp_path):
    df, _ = rows
    line = linear.solve(linear.gram(df.where("split = 'train'"), ["x1", "x2"], "y", "g"), ["x1", "x2"], linear.RIDGE)
    model = line.pipeline("g")
    model.write().overwrite().save(f"file://{tmp_path}/line")
    again = PipelineModel.load(f"file://{tmp_path}/line")
    a, b = (m.transform(df).select("id", "prediction").orderBy("id").collect() for m in (model, again))
    assert a == b


def test_moments_merge_like_one(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1e9, 1, (100, 3))
    parts = [linear.Moments.of(p) for p in np.array_split(x, 7)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.merged(p)
    np.testing.assert_allclose(whole.cross / 100, np.cov(x.T, bias=True), atol=1e-6)
    with pytest.raises(ValueError):
        linear.gram(spark.createDataFrame([], "x double, y double, g string"), ["x"], "y", "g")


def test_constants_whose_mean_rounds_weigh_nothing(spark):
    """The sine and cosine of a month are constants over a month of rows; their rounded means differ from
    them and from level to level, which made the lasso diverge to NaN. A share may vary in its last digit."""
    rng = np.random.default_rng(4)
    n = 2208
    pdf = pd.DataFrame({
        "x": rng.normal(50, 10, n), "sin": np.sin(2 * np.pi / 12), "cos": np.cos(2 * np.pi / 12), "big": 1e9 / 3, "ulp": 200 / 3 + 2.0**-46 * rng.integers(0, 2, n), "g": rng.choice(list("abcde"), n),
    })
    pdf["y"] = 100 * pdf["x"] + (pdf["g"] == "b") * 25 + rng.normal(0, 20, n)
    pdf["split"] = np.where(pdf.index < 1800, "train", "test")
    df, names = spark.createDataFrame(pdf).repartition(7).cache(), ["x", "sin", "cos", "big", "ulp"]
    g = linear.gram(df.where("split = 'train'"), names, "y", "g")
    for c in names[1:4]:
        i = names.index(c)
        assert g.total.mean[i] == pdf[c][0] and not g.total.cross[i].any()
    fits = modelling.linear_fits(df, "y", "g", {"with": names, "without": ["x"]})
    scores = modelling.linear_scores(df, fits, "y")
    for m in linear.LINEAR:
        assert not linear.solve(g, names, m).standard[1:5].any()
        np.testing.assert_allclose(scores["with", m], scores["without", m], rtol=1e-9)


def test_grid_has_every_pair_once_in_order(rows):
    df, _ = rows
    small = lambda t, s: modelling.estimators(t, s, trees=3, rounds=2, forest_depth=3)
    results, fits = modelling.model_grid(df.where("g is not null"), "y", "g", {"one": ["x1"], "two": ["x1", "x2"]}, make=small)
    got = [(r["feature_set"], r["model"]) for r in results.collect()]
    assert got == list(fits) == [(s, m) for s in ("one", "two") for m in small("y", modelling.TargetStats(1, 1.0))]
    for key, result in fits.items():
        assert {"id", "split", "y", "prediction"} <= set(result.predicted.columns) and "features" not in result.predicted.columns
        row = modelling.score(result, "y", key[1], key[0]).first()
        assert row["test_rmse"] == pytest.approx(results.where(f"feature_set = '{key[0]}' and model = '{key[1]}'").first()["test_rmse"], rel=1e-9)
        assert result.seconds > 0 and result.model.transform(df.where("g is not null")).count() == result.predicted.count()


@pytest.mark.parametrize("name", ["Decision Tree", "Random Forest", "Gradient Boosting"])
def test_node_table_gives_the_models_importances(rows, tmp_path, name):
    df, _ = rows
    df = df.where("g is not null")
    stats = modelling.TargetStats.of(df.where("split = 'train'"), "y")
    model = modelling.fit(modelling.estimators("y", stats, trees=5, rounds=4, forest_depth=5)[name], df, stats.n, ["x1", "x2"], "g").model.stages[-1]
    path = f"file://{tmp_path}/model"
    model.write().overwrite().save(path)
    nodes = modelling.tree_nodes(df.sparkSession, path)
    table = modelling.node_importances(nodes, per_tree=name != "Gradient Boosting").toPandas().set_index("feature")
    want = model.featureImportances.toArray()
    got = np.zeros(len(want))
    got[table.index] = table["importance"]
    np.testing.assert_allclose(got, want, rtol=1e-9)
    trees = getattr(model, "trees", [model])
    assert nodes.count() == sum(t.numNodes for t in trees) and table["splits"].sum() == sum((t.numNodes - 1) // 2 for t in trees)
    # A row walks from the root by the thresholds to the leaf that predicts it.
    if name != "Decision Tree":
        return
    one = {r["node"]: r for r in nodes.collect()}
    train = df.where("split = 'train'")
    ready = modelling.Pipeline(stages=modelling.preprocessing(train, stats.n, ["x1", "x2"], "g")).fit(train)
    for r in model.transform(ready.transform(df)).collect():
        at = one[0]
        while at["left"] is not None:
            v = r["features"][at["feature"]]
            left = v <= at["threshold"] if at["threshold"] is not None else v in at["left_categories"]
            at = one[at["left"] if left else at["right"]]
        assert at["prediction"] == r["prediction"]
