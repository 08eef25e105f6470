"""Regression pipelines on ``pyspark.ml`` and the evaluation of their predictions."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.operators import linear
from tidepanel.session import write_table

EPSILON = 2.220446049250313e-16  # smallest denominator of a relative error
METRICS = ("rmse", "mae", "r2", "mape")


@dataclass(frozen=True)
class TargetStats:
    """Size of the training rows and population deviation of the target."""

    n: int
    std: float

    @staticmethod
    def of(train: DataFrame, target: str) -> TargetStats:
        row = train.agg(F.count("*"), F.stddev_pop(target)).first()
        return TargetStats(row[0], row[1] or 0.0)


def estimators(
    target: str, stats: TargetStats, trees: int = 100, rounds: int = 100, forest_depth: int = 15
) -> dict[str, Estimator]:
    """The six models by name.

    Penalties are stated per row: the L2 weight that equals ``alpha`` on the sum of squares
    is ``alpha * sd(target) / n`` because the solver scales the target to unit deviation.
    """
    io = {"labelCol": target, "featuresCol": "features"}
    linear = {**io, "standardization": False}
    return {
        "Linear Regression": LinearRegression(**io, regParam=0.0, solver="normal"),
        "Ridge Regression": LinearRegression(
            **linear, regParam=1.0 * stats.std / stats.n, elasticNetParam=0.0, solver="normal"
        ),
        "Lasso Regression": LinearRegression(
            **linear, regParam=1.0, elasticNetParam=1.0, maxIter=1000, tol=1e-10
        ),
        "Decision Tree": DecisionTreeRegressor(**io, maxDepth=10, maxBins=64, seed=42),
        "Random Forest": RandomForestRegressor(
            **io, numTrees=trees, maxDepth=forest_depth, featureSubsetStrategy="all",
            subsamplingRate=1.0, seed=42, cacheNodeIds=True, maxMemoryInMB=512,
        ),
        "Gradient Boosting": GBTRegressor(
            **io, maxIter=rounds, maxDepth=6, stepSize=0.1, seed=42
        ),
    }


def preprocessing(train: DataFrame, n: int, numeric: Sequence[str], category: str) -> list:
    """Standardised numbers (population deviation) and one-hot categories.

    The first level alphabetically is dropped and a level not seen in training becomes all
    zeros: levels are indexed from the last, unknown ones get an index of their own behind
    them, and the slicer leaves out the first level.
    """
    indexer = StringIndexer(
        inputCol=category, outputCol="_level", stringOrderType="alphabetDesc", handleInvalid="keep"
    ).fit(train.select(category))
    levels = len(indexer.labels)
    stages = [
        VectorAssembler(inputCols=list(numeric), outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="_scaled", outputCol="_standard",
            scalingVec=Vectors.dense([math.sqrt(n / max(n - 1, 1))] * len(numeric)),
        ),
    ]
    blocks = ["_standard"]
    if levels > 1:
        stages += [
            indexer,
            OneHotEncoder(inputCol="_level", outputCol="_hot", dropLast=True),
            VectorSlicer(inputCol="_hot", outputCol="_category", indices=list(range(levels - 1))),
        ]
        blocks.append("_category")
    return [*stages, VectorAssembler(inputCols=blocks, outputCol="features")]


def feature_names(model: PipelineModel, numeric: Sequence[str], category: str) -> list[str]:
    """Names of the assembled vector's slots, in order."""
    names = list(numeric)
    for stage in model.stages:
        if hasattr(stage, "labels"):
            names += [f"{category}_{level}" for level in list(stage.labels)[:-1]]
    return names


def absolute_percentage(y: Column, prediction: Column) -> Column:
    return F.abs(y - prediction) / F.greatest(F.abs(y), F.lit(EPSILON))


def metrics(predicted: DataFrame, target: str, prediction: str = "prediction", keys: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R² and MAPE (percent) in one aggregate, per key."""
    y, p = F.col(target), F.col(prediction)
    found = predicted.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg((y - p) ** 2)).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg((y - p) ** 2).alias("_mse"),
        F.var_pop(y).alias("_var"),
        (F.avg(absolute_percentage(y, p)) * 100).alias("mape"),
    )
    return found.select(*keys, "n", "rmse", "mae", (1 - F.try_divide("_mse", "_var")).alias("r2"), "mape")


@dataclass
class Fit:
    model: PipelineModel
    seconds: float
    predicted: DataFrame


def fit(estimator: Estimator, split: DataFrame, n: int, numeric: Sequence[str], category: str) -> Fit:
    """Fit on the train rows and predict all rows (``split`` holds the column split)."""
    train = split.where(F.col("split") == "train")
    pipeline = Pipeline(stages=[*preprocessing(train, n, numeric, category), estimator])
    start = time.perf_counter()
    model = pipeline.fit(train)
    seconds = time.perf_counter() - start
    helpers = [c for c in ("_numbers", "_scaled", "_standard", "_level", "_hot", "_category", "features")]
    return Fit(model, seconds, model.transform(split).drop(*helpers))


def score(result: Fit, target: str, model: str, feature_set: str) -> DataFrame:
    """One result row: the metrics on both splits and the training time."""
    by_split = metrics(result.predicted, target, keys=["split"])
    return by_split.agg(*_picks()).select(
        F.lit(model).alias("model"), F.lit(feature_set).alias("feature_set"), "*",
        F.lit(result.seconds).alias("train_time"),
    )


PART_BYTES = 4_000_000  # training numbers per partition: a tree fit reads them some hundred times
MERGED_ROWS = 10_000  # up to so many rows MLlib reads them all, not a sample, for the thresholds of trees
_FEATURES, _WEIGHT = "features", "_weight"


def _picks() -> list[Column]:
    return [F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in ("train", "test") for m in METRICS]


def linear_fits(
    split: DataFrame, target: str, category: str, feature_sets: Mapping[str, Sequence[str]], models: Sequence[str] = linear.LINEAR
) -> dict[tuple[str, str], Fit]:
    """The linear models on all feature sets from one pass over the training rows.

    A fit's time is its share of that pass and its own solution.
    """
    used = list(dict.fromkeys(c for s in feature_sets.values() for c in s))
    g = linear.gram(split.where(F.col("split") == "train"), used, target, category)
    fits = {}
    for set_name, numeric in feature_sets.items():
        for name in models:
            start = time.perf_counter()
            model = linear.solve(g, numeric, name).pipeline(category)
            seconds = time.perf_counter() - start + g.seconds / (len(feature_sets) * len(models))
            fits[set_name, name] = Fit(model, seconds, model.transform(split))
    return fits


def linear_scores(split: DataFrame, fits: Mapping[tuple[str, str], Fit], target: str) -> dict[tuple[str, str], list[float]]:
    """The metrics of all ``linear_fits`` on both splits, in one aggregate."""
    keys, wide = list(fits), split
    for i, key in enumerate(keys):
        wide = fits[key].model.transform(wide).withColumnRenamed("prediction", f"_p{i}")
    each = F.array(*[F.struct(F.lit(i).alias("fit"), F.col(f"_p{i}").alias("prediction")) for i in range(len(keys))])
    long = wide.select("split", target, F.inline(each))
    rows = metrics(long, target, keys=["fit", "split"]).groupBy("fit").agg(*_picks()).collect()  # a row per fit
    return {keys[r["fit"]]: list(r)[1:] for r in rows}


def equal_rows(train: DataFrame, columns: Sequence[str], n: int) -> DataFrame | None:
    """The distinct rows of ``columns`` with their number in ``train``, its weight; None if they are
    more than ``MERGED_ROWS`` or half of the ``n`` rows, as with measured inputs."""
    most = min(MERGED_ROWS, n // 2)
    # An estimate first, without a shuffle: most inputs are distinct in nearly every row.
    if train.agg(F.approx_count_distinct(F.struct(*columns))).first()[0] > 1.2 * most:
        return None
    found = write_table(train.groupBy(*columns).agg(F.count("*").cast("double").alias(_WEIGHT)), "equal-rows")
    return found if found.count() <= most else None


def _takes_weights(estimator: Estimator) -> bool:
    """True if ``k`` equal rows are the same to the estimator as one of weight ``k``: not where it draws
    rows (a forest draws each on its own), holds some back or has weights already."""
    draws = estimator.hasParam("bootstrap") and estimator.getOrDefault("bootstrap")
    part = estimator.hasParam("subsamplingRate") and estimator.getOrDefault("subsamplingRate") < 1
    marked = any(estimator.hasParam(p) and estimator.isDefined(p) for p in ("weightCol", "validationIndicatorCol"))
    fewest = estimator.getOrDefault("minInstancesPerNode") > 1  # counted in rows, not in weight
    return not (draws or part or marked or fewest)


def tree_fits(
    split: DataFrame, n: int, target: str, category: str, feature_sets: Mapping[str, Sequence[str]],
    models: Mapping[str, Estimator], threads: int = 8,
) -> dict[tuple[str, str], tuple[Fit, list[float]]]:
    """Tree models with their scores. A feature set is prepared and written once for all its models;
    fits run in ``threads`` at a time, each as jobs of its own, which the scheduler may share out.

    The written rows come in as many partitions as their numbers need, since a fit reads
    them once per level and tree round. Where inputs and target have few different values together,
    a single tree and boosting are fitted on the distinct rows, weighted by their number; a forest
    draws from the rows themselves.
    """
    train = split.where(F.col("split") == "train")

    def prepare(item):
        set_name, numeric = item
        start = time.perf_counter()
        stages = Pipeline(stages=preprocessing(train, n, numeric, category)).fit(train)
        helpers = ["_numbers", "_scaled", "_standard", "_level", "_hot", "_category"]
        parts = max(1, -(-n * (len(numeric) + 1) * 8 // PART_BYTES))
        rows = write_table(stages.transform(split).drop(*helpers).coalesce(parts), "inputs")
        few = equal_rows(train, list(dict.fromkeys([*numeric, category, target])), n)
        few = None if few is None else stages.transform(few).select(_FEATURES, target, _WEIGHT).coalesce(1)
        return set_name, (stages, rows, few, parts, time.perf_counter() - start)

    def run(job):
        (set_name, model_name), estimator = job
        stages, rows, few, parts, before = prepared[set_name]
        start = time.perf_counter()
        if few is not None and _takes_weights(estimator):
            model = estimator.copy().setWeightCol(_WEIGHT).fit(few)
        else:
            model = estimator.fit(rows.where(F.col("split") == "train").coalesce(parts))
        seconds = time.perf_counter() - start + before
        predicted = model.transform(rows)
        found = metrics(predicted, target, keys=["split"]).agg(*_picks()).first()
        return (set_name, model_name), (Fit(PipelineModel([*stages.stages, model]), seconds, predicted.drop(_FEATURES)), list(found))

    with ThreadPoolExecutor(threads) as pool:
        # A call on its own per task: each thread takes over the session's local properties.
        def all_of(fn, items):
            return dict(f.result() for f in [pool.submit(inheritable_thread_target(split.sparkSession)(fn), i) for i in items])

        prepared = all_of(prepare, feature_sets.items())
        # The longest first, so that none is left alone at the end.
        jobs = sorted((((s, m), e) for s in feature_sets for m, e in models.items()), key=lambda j: -_effort(j[1]))
        return all_of(run, jobs)


def _effort(estimator: Estimator) -> int:
    rounds = estimator.getOrDefault("maxIter") if estimator.hasParam("maxIter") else 1
    return rounds * estimator.getOrDefault("maxDepth")


def model_grid(
    split: DataFrame,
    target: str,
    category: str,
    feature_sets: Mapping[str, Sequence[str]],
    models: Sequence[str] | None = None,
    make: Callable[[str, TargetStats], dict[str, Estimator]] = estimators,
    threads: int = 8,
) -> tuple[DataFrame, dict[tuple[str, str], Fit]]:
    """Every model on every feature set; the result table and the fits by (set, model).

    The rows are written once. Linear models come from one table of cross-products, trees from
    concurrent fits on vectors written once per feature set.
    """
    split = write_table(split, "training")
    stats = TargetStats.of(split.where(F.col("split") == "train"), target)
    chosen = {k: v for k, v in make(target, stats).items() if models is None or k in models}
    straight = [m for m in chosen if m in linear.LINEAR]
    fits, scores = {}, {}
    if straight:
        fits |= linear_fits(split, target, category, feature_sets, straight)
        scores |= linear_scores(split, fits, target)
    trees = {k: v for k, v in chosen.items() if k not in straight}
    for key, (result, found) in (tree_fits(split, stats.n, target, category, feature_sets, trees, threads) if trees else {}).items():
        fits[key], scores[key] = result, found
    keys = [(s, m) for s in feature_sets for m in chosen]
    records = [(m, s, *scores[s, m], fits[s, m].seconds) for s, m in keys]
    columns = "model string, feature_set string, " + ", ".join(
        f"{s}_{m} double" for s in ("train", "test") for m in METRICS
    ) + ", train_time double"
    return split.sparkSession.createDataFrame(records, columns), {k: fits[k] for k in keys}


def best_model(results: DataFrame) -> DataFrame:
    """The row with the largest test R²."""
    return results.orderBy(F.desc("test_r2"), "feature_set", "model").limit(1)


def metric_pivot(results: DataFrame, metric: str, feature_sets: Sequence[str]) -> DataFrame:
    """Models by feature sets."""
    return results.groupBy("model").pivot("feature_set", list(feature_sets)).agg(F.first(metric))


def model_summary(results: DataFrame) -> DataFrame:
    """Mean test metrics per model, best mean R² first."""
    means = [F.round(F.avg(f"test_{m}"), 3).alias(f"test_{m}") for m in ("rmse", "r2", "mape")]
    return results.groupBy("model").agg(*means).orderBy(F.desc("test_r2"), "model")


def importances(model: PipelineModel, numeric: Sequence[str], category: str, spark, top: int = 20) -> DataFrame:
    """The most important features of a tree ensemble, by impurity gain."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    names = feature_names(model, numeric, category)
    table = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def tree_nodes(spark, path: str) -> DataFrame:
    """The nodes of a saved tree model as a table: tree, node, n (rows), prediction, impurity, gain,
    feature, threshold or left_categories, left and right. Leaves have a null feature and gain and no
    children; a row goes left up to the threshold, or if its category is among the left ones."""
    saved = spark.read.parquet(f"{path.rstrip('/')}/data")
    flat = saved.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in saved.columns else saved.select(F.lit(0).alias("tree"), "*")
    inner, kinds = F.col("leftChild") >= 0, F.col("split.numCategories") >= 0
    return flat.select(
        "tree", F.col("id").alias("node"), F.col("impurityStats")[0].alias("n"), "prediction", "impurity", F.when(inner, F.col("gain")).alias("gain"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ~kinds, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner & kinds, F.col("split.leftCategoriesOrThreshold")).alias("left_categories"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
    )


def node_importances(nodes: DataFrame, per_tree: bool = True) -> DataFrame:
    """By feature: splits, cover (rows that pass its splits) and importance of an ensemble's nodes.

    A feature's importance in a tree is its share of the gain summed over the tree's rows; over
    the ensemble it is the mean over trees that split at all, as forests report it. Without
    ``per_tree`` it is the share of the gain of all trees together, as boosting reports it.
    """
    inner = nodes.where("feature is not null")
    each = inner.groupBy("tree", "feature").agg(
        F.count("*").alias("splits"), F.sum("n").alias("cover"), F.sum(F.col("gain") * F.col("n")).alias("gain"))
    whole = each.groupBy("tree").agg(F.sum("gain").alias("_all"))
    shares = each.join(whole, "tree").withColumn("share", F.try_divide("gain", "_all") if per_tree else F.col("gain"))
    found = shares.groupBy("feature").agg(F.sum("splits").alias("splits"), F.sum("cover").alias("cover"), F.sum("share").alias("share"))
    total = found.agg(F.sum("share")).scalar()
    return found.select("feature", "splits", "cover", F.try_divide("share", total).alias("importance"))


# --- diagnostics of the best model's predictions --------------------------------------


def with_error(predicted: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    return predicted.withColumn("error", F.col(target) - F.col(prediction))


def error_by_hour(errors: DataFrame, hour: str = "Hour") -> DataFrame:
    return errors.groupBy(hour).agg(
        F.avg("error").alias("mean_error"), F.stddev_samp("error").alias("std_error")
    )


def normal_fit(errors: DataFrame, points: int = 100) -> DataFrame:
    """The normal curve with the errors' mean and population deviation over their range."""
    base = errors.agg(
        F.avg("error").alias("mu"), F.stddev_pop("error").alias("sigma"),
        F.min("error").alias("lo"), F.max("error").alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    grid = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.col("lo") + F.col("point") * step
    z = F.try_divide(x - F.col("mu"), F.col("sigma"))
    density = F.try_divide(F.exp(-(z**2) / 2), F.col("sigma") * math.sqrt(2 * math.pi))
    return grid.select("point", "mu", "sigma", x.alias("x"), density.alias("density"))


def entity_errors(predicted: DataFrame, entity: str, target: str, prediction: str = "prediction") -> DataFrame:
    """RMSE, MAPE and rows per entity, lowest RMSE first."""
    found = metrics(predicted, target, prediction, [entity])
    return found.select(entity, "rmse", "mape", "n").orderBy("rmse", entity)


def perfect_line(predicted: DataFrame, target: str) -> DataFrame:
    """End points of the line where prediction equals truth."""
    return predicted.agg(F.min(target).alias("lowest"), F.max(target).alias("highest"))
