import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import modelling
from tidepanel.plans import forecast
from tidepanel.spec import FEATURE_SETS


@pytest.fixture(scope="module")
def split(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({
        "id": np.arange(n), "x1": rng.normal(50, 10, n), "x2": rng.normal(0, 2, n), "g": rng.choice(list("abc"), n),
    })
    pdf["y"] = 3 * pdf["x1"] - 40 * pdf["x2"] + (pdf["g"] == "b") * 25 + rng.normal(0, 20, n)
    pdf["split"] = np.where(pdf.index < 240, "train", "test")
    pdf.loc[299, "g"] = "unseen"
    return spark.createDataFrame(pdf).coalesce(2).cache(), pdf


def design(pdf):
    train = pdf[pdf.split == "train"]
    x = pdf[["x1", "x2"]].to_numpy()
    mean, sd = train[["x1", "x2"]].mean().to_numpy(), train[["x1", "x2"]].std(ddof=0).to_numpy()
    hot = np.column_stack([(pdf["g"] == c).to_numpy(float) for c in "cb"])  # levels from the last; a dropped
    return np.column_stack([(x - mean) / sd, hot]), (pdf.split == "train").to_numpy()


def predictions(split_df, name, pdf):
    stats = modelling.TargetStats.of(split_df.where("split = 'train'"), "y")
    model = modelling.estimators("y", stats)[name]
    result = modelling.fit(model, split_df, stats.n, ["x1", "x2"], "g")
    return result, result.predicted.toPandas().set_index("id")["prediction"].sort_index().to_numpy()


def test_linear_regression_and_unseen_level(split):
    df, pdf = split
    z, train = design(pdf)
    m = np.column_stack([z, np.ones(len(z))])
    beta = np.linalg.lstsq(m[train], pdf["y"][train], rcond=None)[0]
    _, got = predictions(df, "Linear Regression", pdf)
    assert np.allclose(got, m @ beta, rtol=1e-8)


def test_ridge_closed_form(split):
    df, pdf = split
    z, train = design(pdf)
    mean, y = z[train].mean(axis=0), pdf["y"].to_numpy()
    c = z[train] - mean
    beta = np.linalg.solve(c.T @ c + np.eye(c.shape[1]), c.T @ (y[train] - y[train].mean()))
    _, got = predictions(df, "Ridge Regression", pdf)
    assert np.allclose(got, (z - mean) @ beta + y[train].mean(), rtol=1e-7)


def test_lasso_optimality(split):
    df, pdf = split
    z, train = design(pdf)
    result, got = predictions(df, "Lasso Regression", pdf)
    beta = result.model.stages[-1].coefficients.toArray()
    mean, y = z[train].mean(axis=0), pdf["y"].to_numpy()[train]
    gradient = (z[train] - mean).T @ (y - got[train]) / train.sum()
    for b, g in zip(beta, gradient):
        assert g == pytest.approx(np.sign(b), abs=1e-4) if abs(b) > 1e-9 else abs(g) <= 1 + 1e-6


@pytest.mark.parametrize("name, bound", [("Decision Tree", 0.6), ("Random Forest", 0.6), ("Gradient Boosting", 0.6)])
def test_tree_models_learn(split, name, bound):
    df, pdf = split
    stats = modelling.TargetStats.of(df.where("split = 'train'"), "y")
    model = modelling.estimators("y", stats, trees=10, rounds=10, forest_depth=6)[name]
    result = modelling.fit(model, df, stats.n, ["x1", "x2"], "g")
    row = modelling.score(result, "y", name, "all").first()
    assert row["train_r2"] > bound and row["train_r2"] >= row["test_r2"] and row["train_time"] > 0
    table = modelling.importances(result.model, ["x1", "x2"], "g", df.sparkSession)
    assert table.first()["feature"] == "x2" and table.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert {r["feature"] for r in table.collect()} == {"x1", "x2", "g_b", "g_c"}


def test_metrics_and_zero_targets(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 1.0), (4.0, 5.0)], "y double, prediction double")
    row = modelling.metrics(df, "y").first()
    assert row["rmse"] == pytest.approx(np.sqrt(2 / 3)) and row["mae"] == pytest.approx(2 / 3)
    assert row["r2"] == pytest.approx(1 - 2 / 8) and row["mape"] == pytest.approx((0.5 + 0.25) / 3 * 100)
    huge = spark.createDataFrame([(0.0, 1.0)], "y double, prediction double")
    assert modelling.metrics(huge, "y").first()["mape"] > 1e15


def test_grid_best_and_tables(split):
    df, _ = split
    results, fits = modelling.model_grid(
        df, "y", "g", {"one": ["x1"], "two": ["x1", "x2"]}, ["Linear Regression", "Decision Tree"]
    )
    assert results.count() == 4 and set(fits) == {(s, m) for s in ("one", "two") for m in ("Linear Regression", "Decision Tree")}
    assert modelling.best_model(results).first()["feature_set"] == "two"
    pivot = modelling.metric_pivot(results, "test_rmse", ["one", "two"])
    assert pivot.columns == ["model", "one", "two"] and pivot.count() == 2
    summary = modelling.model_summary(results).collect()
    assert summary[0]["test_r2"] >= summary[1]["test_r2"]


def test_feature_sets_have_the_published_sizes():
    assert {k: len(v) for k, v in FEATURE_SETS.items()} == {"Basique": 6, "Cyclique": 12, "SansLag": 16, "Complet": 20}


def test_stage_end_to_end(spark, sf_dir):
    from tidepanel.workload import tables
    panel = tables.stored_clean_panel(spark, sf_dir)
    wide = forecast.prepared(panel, lags=[1, 24], windows=[24])
    counts = {r["split"]: r["count"] for r in wide.groupBy("split").count().collect()}
    assert counts["train"] == int(0.8 * sum(counts.values()))
    sets = {"Basique": FEATURE_SETS["Basique"]}
    results, fits = modelling.model_grid(wide, "Consommation_MW", "Region", sets, ["Ridge Regression"])
    tables_ = forecast.diagnostics(fits["Basique", "Ridge Regression"].predicted, slice_from=0, slice_rows=24)
    assert tables_["week"].count() == 24 and tables_["by_entity"].count() == 5
    assert tables_["ljung_box"].count() == 24 and tables_["normal_fit"].count() == 100
