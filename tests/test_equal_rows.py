"""Tree fits on rows of which many are equal."""

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tidepanel.operators import modelling

NAMES = ["Decision Tree", "Random Forest", "Gradient Boosting"]


@pytest.fixture(scope="module")
def split(spark):
    ids = spark.range(3000).select(
        "id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5 - 2).cast("double").alias("b"), (F.col("id") % 1013 / 7).alias("wide"),
        F.when(F.col("id") % 3 == 0, "p").otherwise("q").alias("g"), F.when(F.col("id") % 10 < 8, "train").otherwise("test").alias("split"))
    # Three targets in every cell, unequally often: no tree hits them all, and weights tell.
    noise = F.when(F.col("id") % 11 == 0, 9.0).when(F.col("id") % 11 < 4, 2.0).otherwise(0.0)
    return ids.withColumn("y", F.col("a") * F.col("a") - 4 * F.col("b") + F.when(F.col("g") == "p", 5.0).otherwise(0.0) + noise).repartition(3).cache()


def fits(split, monkeypatch, features):
    """The fits by model and the rows that each was given."""
    seen = {}
    for kind, name in zip((DecisionTreeRegressor, RandomForestRegressor, GBTRegressor), NAMES):
        def counted(self, rows, name=name, plain=kind._fit):
            seen[name] = rows.count()
            return plain(self, rows)
        monkeypatch.setattr(kind, "_fit", counted)
    stats = modelling.TargetStats.of(split.where("split = 'train'"), "y")
    made = {k: v for k, v in modelling.estimators("y", stats, trees=3, rounds=5, forest_depth=4).items() if k in NAMES}
    found = modelling.tree_fits(split, stats.n, "y", "g", {"set": features}, made)
    return {name: found["set", name][0] for name in NAMES}, seen, stats, made


def test_equal_rows_are_fitted_as_weights(split, monkeypatch):
    got, seen, stats, made = fits(split, monkeypatch, ["a", "b"])
    distinct = split.where("split = 'train'").select("a", "b", "g", "y").distinct().count()
    assert distinct < stats.n / 2 and seen == {"Decision Tree": distinct, "Gradient Boosting": distinct, "Random Forest": stats.n}
    for name in ("Decision Tree", "Gradient Boosting"):
        plain = modelling.fit(made[name], split, stats.n, ["a", "b"], "g").predicted
        both = got[name].predicted.select("id", "prediction").join(plain.select("id", F.col("prediction").alias("p")), "id")
        assert both.count() == 3000 and both.agg(F.max(F.abs(F.col("prediction") - F.col("p")))).first()[0] < 1e-9


def test_distinct_rows_are_left_as_they_are(split, monkeypatch):
    got, seen, stats, _ = fits(split, monkeypatch, ["a", "wide"])
    assert set(seen.values()) == {stats.n} and got["Decision Tree"].predicted.count() == 3000


def test_equal_rows_counts_nulls_and_bounds(spark):
    rows = spark.createDataFrame([(1.0, None)] * 3 + [(1.0, "x")] * 2 + [(2.0, "x")], "a double, g string")
    found = modelling.equal_rows(rows, ["a", "g"], 6)
    assert {(r["a"], r["g"], r["_weight"]) for r in found.collect()} == {(1.0, None, 3.0), (1.0, "x", 2.0), (2.0, "x", 1.0)}
    assert modelling.equal_rows(rows, ["a", "g"], 5) is None


def test_estimators_that_draw_or_hold_back_rows_keep_them():
    assert modelling._takes_weights(DecisionTreeRegressor()) and modelling._takes_weights(GBTRegressor())
    others = [
        RandomForestRegressor(), GBTRegressor(subsamplingRate=0.5), GBTRegressor(validationIndicatorCol="v"),
        DecisionTreeRegressor(weightCol="w"), DecisionTreeRegressor(minInstancesPerNode=2),
    ]
    assert not any(modelling._takes_weights(e) for e in others)
