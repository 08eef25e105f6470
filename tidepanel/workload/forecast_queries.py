"""Stage D queries: models, their metrics and the diagnostics of predictions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.operators import linear, modelling, profiles, serial
from tidepanel.operators.ordering import chronological_split, with_row_index
from tidepanel.plans import forecast
from tidepanel.session import new_path, write_table
from tidepanel.sources import writers
from tidepanel.spec import ENERGY, FEATURE_SETS
from tidepanel.workload import sql as s
from tidepanel.workload import tables as tb
from tidepanel.workload.clean_queries import FEATURES_SQL
from tidepanel.workload.registry import query, tidy

LINEAR = list(linear.LINEAR)

# --- models on one feature over all orders, where closed forms exist ---------------------

_SPLIT = """o AS (SELECT o_orderkey, o_orderdate, o_totalprice AS y, CAST(o_custkey AS DOUBLE) AS x FROM orders),
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 < floor(0.8 * (SELECT count(*) FROM o))
  THEN 'train' ELSE 'test' END AS split FROM o),
st AS (SELECT count(*) AS n, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) / stddev_pop(x) AS c FROM sp WHERE split = 'train'),
b AS (SELECT 'Linear Regression' AS model, c AS beta FROM st
  UNION ALL SELECT 'Ridge Regression', n * c / (n + 1) FROM st
  UNION ALL SELECT 'Lasso Regression', sign(c) * greatest(abs(c) - 1, 0) FROM st)"""


def _metrics_sql(keys: str, table: str) -> str:
    return (
        f"SELECT {keys}, count(*) AS n, sqrt(avg(pow(y - p, 2))) AS rmse, avg(abs(y - p)) AS mae, "
        "1 - avg(pow(y - p, 2)) / var_pop(y) AS r2, avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16::DOUBLE)) * 100 AS mape "
        f"FROM {table} GROUP BY ALL"
    )


def _tidy_metrics(found: DataFrame, keys: list[str]) -> DataFrame:
    return tidy(found.select(*keys, "n", "rmse", "mae", "r2", "mape"), rmse=2, mae=2)


_METRIC_COLUMNS = f"n, {s.r('rmse', 2)} AS rmse, {s.r('mae', 2)} AS mae, {s.r('r2')} AS r2, {s.r('mape')} AS mape"


def _orders_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tb.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").alias("y"),
        F.col("o_custkey").cast("double").alias("x"), F.lit("all").alias("kind"),
    )
    return chronological_split(orders, ["o_orderdate", "o_orderkey"])


@query(
    f"WITH {_SPLIT}, pr AS (SELECT model, split, y, my + beta * (x - mx) / sx AS p FROM sp, st, b), "
    f"m AS ({_metrics_sql('model, split', 'pr')}) SELECT model, split, {_METRIC_COLUMNS} FROM m"
)
def linear_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OLS, ridge and lasso pipelines over all orders, against their closed forms."""
    split = write_table(_orders_split(spark, sf_dir), "training")
    fits = modelling.linear_fits(split, "y", "kind", {"x": ["x"]})
    out = None
    for _, name in fits:
        rows = modelling.metrics(fits["x", name].predicted, "y", keys=["split"]).select(F.lit(name).alias("model"), "*")
        out = rows if out is None else out.unionByName(rows)
    return _tidy_metrics(out, ["model", "split"])


@query(
    """WITH o AS (SELECT o_orderkey, o_orderdate, o_totalprice AS y, CAST(o_custkey AS DOUBLE) AS x1,
  CAST(month(o_orderdate) AS DOUBLE) AS x2, o_orderpriority AS g FROM orders),
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 < floor(0.8 * (SELECT count(*) FROM o))
  THEN 'train' ELSE 'test' END AS split FROM o),
mg AS (SELECT g, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM sp WHERE split = 'train' GROUP BY 1),
c AS (SELECT sum((x1 - m1) * (x1 - m1)) AS s11, sum((x1 - m1) * (x2 - m2)) AS s12, sum((x2 - m2) * (x2 - m2)) AS s22,
  sum((x1 - m1) * (y - my)) AS t1, sum((x2 - m2) * (y - my)) AS t2 FROM sp JOIN mg USING (g) WHERE split = 'train'),
b AS (SELECT (t1 * s22 - t2 * s12) / (s11 * s22 - s12 * s12) AS b1, (t2 * s11 - t1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c),
pr AS (SELECT split, y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p FROM sp JOIN mg USING (g), b), """
    f"m AS ({_metrics_sql('split', 'pr')}) SELECT split, {_METRIC_COLUMNS} FROM m"
)
def linear_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares on two numbers and a category of five levels, over all orders."""
    orders = tb.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").alias("y"), F.col("o_custkey").cast("double").alias("x1"),
        F.month("o_orderdate").cast("double").alias("x2"), F.col("o_orderpriority").alias("g"),
    )
    split = write_table(chronological_split(orders, ["o_orderdate", "o_orderkey"]), "training")
    fits = modelling.linear_fits(split, "y", "g", {"both": ["x1", "x2"]}, [linear.ORDINARY])
    return _tidy_metrics(modelling.metrics(fits["both", linear.ORDINARY].predicted, "y", keys=["split"]), ["split"])


# A target that two splits explain: trees of any kind must find them and hit every row.
_STEP = "CASE WHEN month(o_orderdate) > 6 THEN 100 ELSE 0 END + CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 10 ELSE 0 END"
TREES = ["Decision Tree", "Random Forest", "Gradient Boosting"]


def _step_fits(spark: SparkSession, sf_dir: str, models: list[str]) -> dict:
    orders = tb.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.month("o_orderdate").alias("month"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.lit("all").alias("kind"), F.expr(f"CAST({_STEP} AS DOUBLE)").alias("y"),
    )
    split = write_table(chronological_split(orders, ["o_orderdate", "o_orderkey"]), "training")
    stats = modelling.TargetStats.of(split.where("split = 'train'"), "y")
    trees = {k: v for k, v in modelling.estimators("y", stats).items() if k in models}
    return modelling.tree_fits(split, stats.n, "y", "kind", {"steps": ["month", "priority"]}, trees)


@query(
    f"WITH o AS (SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, "
    f"CAST({_STEP} AS DOUBLE) AS y FROM orders) SELECT model, month, priority, count(*) AS n, min(y) AS lowest, max(y) AS highest "
    f"FROM o, (VALUES {', '.join(f'({chr(39)}{m}{chr(39)})' for m in TREES)}) t(model) GROUP BY 1, 2, 3"
)
def tree_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree, a forest and boosting on a step function of two columns of all orders: least and
    largest prediction by cell."""
    fits = _step_fits(spark, sf_dir, TREES)
    out = None
    for (_, name), (result, _) in fits.items():
        cells = result.predicted.groupBy("month", "priority").agg(
            F.count("*").alias("n"), F.min("prediction").alias("lowest"), F.max("prediction").alias("highest"))
        cells = cells.select(F.lit(name).alias("model"), "*")
        out = cells if out is None else out.unionByName(cells)
    return tidy(out, 4)


@query(
    "WITH o AS (SELECT o_orderkey, o_orderdate, month(o_orderdate) > 6 AS late, CAST(" + _STEP + " AS DOUBLE) AS y FROM orders), "
    "sp AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 < floor(0.8 * (SELECT count(*) FROM o)) AS train FROM o), "
    "t AS (SELECT count(*) AS n, var_pop(y) AS v FROM sp WHERE train), "
    "h AS (SELECT sum(n * v) / sum(n) AS inside FROM (SELECT count(*) AS n, var_pop(y) AS v FROM sp WHERE train GROUP BY late)) "
    f"SELECT 'month' AS feature, 1::BIGINT AS splits, n::DOUBLE AS cover, {s.r('1 - inside / v')} AS importance FROM t, h UNION ALL "
    f"SELECT 'priority', 2::BIGINT, n::DOUBLE, {s.r('inside / v')} FROM t, h"
)
def stored_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of ``tree_steps`` saved and read back as a table of nodes: one split by month, then one by
    priority on either side, with the rows that pass them and their share of the gain."""
    fits = _step_fits(spark, sf_dir, TREES[:1])
    path = new_path(spark, "tree")
    fits["steps", TREES[0]][0].model.stages[-1].write().overwrite().save(path)
    found = modelling.node_importances(modelling.tree_nodes(spark, path))
    return tidy(found.select(F.when(F.col("feature") == 0, "month").otherwise("priority").alias("feature"), "splits", "cover", "importance"))


# --- the model grid on the cleaned panel -------------------------------------------------


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.prepared(tb.clean_panel(spark, sf_dir))


def _grid(spark: SparkSession, sf_dir: str, models: list[str], sets: list[str]) -> tuple[DataFrame, dict]:
    chosen = {k: FEATURE_SETS[k] for k in sets}
    return modelling.model_grid(_prepared(spark, sf_dir), ENERGY.target, ENERGY.entity, chosen, models)


@query()
def model_grid_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three linear models on all four feature sets."""
    return _grid(spark, sf_dir, LINEAR, list(FEATURE_SETS))[0]


@query()
def model_grid_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decision tree on all four feature sets."""
    return _grid(spark, sf_dir, ["Decision Tree"], list(FEATURE_SETS))[0]


@query()
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest on all four feature sets."""
    return _grid(spark, sf_dir, ["Random Forest"], list(FEATURE_SETS))[0]


@query()
def gradient_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees on all four feature sets."""
    return _grid(spark, sf_dir, ["Gradient Boosting"], list(FEATURE_SETS))[0]


@query()
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 inputs of a tree on the complete feature set."""
    _, fits = _grid(spark, sf_dir, ["Decision Tree"], ["Complet"])
    model = fits["Complet", "Decision Tree"].model
    return modelling.importances(model, FEATURE_SETS["Complet"], ENERGY.entity, spark)


@query()
def model_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six models on all four feature sets; the stored result table read back."""
    results, fits = _whole_grid(spark, sf_dir)
    folder = new_path(spark, "models")
    forecast.save(results, fits, folder)
    return spark.read.schema(results.schema).option("header", True).csv(f"{folder}/model_results")


@query()
def ensemble_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 inputs of a forest and of boosting on the complete feature set."""
    names = ["Random Forest", "Gradient Boosting"]
    _, fits = _grid(spark, sf_dir, names, ["Complet"])
    tables = [
        modelling.importances(fits["Complet", n].model, FEATURE_SETS["Complet"], ENERGY.entity, spark).withColumn("model", F.lit(n))
        for n in names
    ]
    return tables[0].unionByName(tables[1])


def _whole_grid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    return modelling.model_grid(_prepared(spark, sf_dir), ENERGY.target, ENERGY.entity, FEATURE_SETS)


@query()
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of all 24 fits by test R²."""
    return modelling.best_model(_whole_grid(spark, sf_dir)[0])


@query()
def best_model_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error summary per entity of the best of all fits on its own test rows."""
    results, fits = _whole_grid(spark, sf_dir)
    return forecast.diagnostics(fits[forecast.best_fit(results, fits)].predicted)["by_entity"]


@query(f"WITH {FEATURES_SQL} SELECT count(*) AS n, 0::DOUBLE AS max_change FROM split")
def pipeline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted pipeline stored, loaded and applied again: largest change of a prediction."""
    split = _prepared(spark, sf_dir)
    stats = modelling.TargetStats.of(split.where("split = 'train'"), ENERGY.target)
    estimator = modelling.estimators(ENERGY.target, stats)["Ridge Regression"]
    result = modelling.fit(estimator, split, stats.n, FEATURE_SETS["Basique"], ENERGY.entity)
    path = writers.save_pipeline(result.model, new_path(spark, "pipeline"), "Ridge Regression")
    again = PipelineModel.load(path).transform(split)
    keys = [ENERGY.entity, ENERGY.ts]
    both = result.predicted.select(*keys, "prediction").join(
        again.select(*keys, F.col("prediction").alias("reloaded")), keys
    )
    return tidy(both.agg(F.count("*").alias("n"), F.max(F.abs(F.col("prediction") - F.col("reloaded"))).alias("max_change")))


@query()
def residual_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ljung-Box lags of the ridge model's test errors, in test order."""
    _, fits = _grid(spark, sf_dir, ["Ridge Regression"], ["Complet"])
    return forecast.diagnostics(fits["Complet", "Ridge Regression"].predicted)["ljung_box"]


# --- metrics and diagnostics of given predictions, over all events ------------------------

_P = "ev AS (SELECT *, value AS y, 30 + hour(ts) + user_id % 7 AS p, CAST(hour(ts) AS INTEGER) AS \"Hour\", value - (30 + hour(ts) + user_id % 7) AS error FROM events)"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tb.load(spark, sf_dir, "events").drop("props").withColumn("Hour", F.hour("ts"))
    guess = (30 + F.col("Hour") + F.col("user_id") % 7).cast("double")
    return modelling.with_error(events.withColumn("prediction", guess), "value")


@query(
    f"WITH {_P}, " + s.normality("SELECT event_type, error AS e FROM ev", "event_type")
)
def error_normality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jarque-Bera and K² of the errors of a given prediction, all rows of every entity."""
    return tidy(serial.normality(_scored(spark, sf_dir), "error", ["event_type"]), 4)


@query(f"WITH {_P}, m AS ({_metrics_sql('event_type', 'ev')}) SELECT event_type, {_METRIC_COLUMNS} FROM m")
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidy_metrics(modelling.metrics(_scored(spark, sf_dir), "value", keys=["event_type"]), ["event_type"])


@query(
    f"WITH {_P}, m AS ({_metrics_sql('event_type', 'ev')}) SELECT event_type, {s.r('rmse', 4)} AS rmse, {s.r('mape', 4)} AS mape, n FROM m"
)
def entity_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(modelling.entity_errors(_scored(spark, sf_dir), "event_type", "value"), 4)


@query(f"WITH {_P} SELECT \"Hour\", {s.r('avg(error)')} AS mean_error, {s.r('stddev_samp(error)')} AS std_error FROM ev GROUP BY 1")
def error_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(modelling.error_by_hour(_scored(spark, sf_dir)))


@query(
    f"WITH {_P}, b AS (SELECT avg(error) AS mu, stddev_pop(error) AS sigma, min(error) AS lo, max(error) AS hi FROM ev), "
    "g AS (SELECT *, CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 99 AS gx FROM b, range(100) r(i)) "
    f"SELECT point, {s.rounded(['mu', 'sigma'])}, {s.r('gx')} AS x, {s.r('exp(-pow((gx - mu) / sigma, 2) / 2) / (sigma * sqrt(2 * pi()))', 9)} AS density FROM g"
)
def normal_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = modelling.normal_fit(_scored(spark, sf_dir))
    return tidy(found, density=9)


@query(
    f"""WITH {_P}, e AS (SELECT min(error) AS lo, max(error) AS hi, count(*) AS n FROM ev),
b AS (SELECT least(floor((error - lo) / ((hi - lo) / 50)), 49) AS b, count(*) AS c FROM ev, e GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, coalesce(c, 0) AS count, {s.r('coalesce(c, 0) / (n * ((hi - lo) / 50))', 9)} AS density
FROM range(50) r(i) CROSS JOIN e LEFT JOIN b ON b = i"""
)
def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(profiles.histogram(_scored(spark, sf_dir), "error", 50).select("bin", "count", "density"), 9)


@query(f"WITH {_P} SELECT min(value) AS lowest, max(value) AS highest FROM ev")
def perfect_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling.perfect_line(_scored(spark, sf_dir), "value")


@query(
    f"WITH {_P}, n AS (SELECT event_id, ts, value, p AS prediction, row_number() OVER (ORDER BY ts, event_id) - 1 AS place FROM ev) "
    "SELECT event_id, ts, value, CAST(prediction AS DOUBLE) AS prediction, place FROM n WHERE place BETWEEN 1000 AND 1167"
)
def prediction_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 1000 to 1167 in time order, a week of hourly predictions."""
    rows = _scored(spark, sf_dir).select("event_id", "ts", "value", "prediction")
    return with_row_index(rows, ["ts", "event_id"], "place").where(F.col("place").between(1000, 1167))


# A result table to pivot and rank: metrics per event type (as model) and weekday parity.
_RESULTS = (
    f"{_P}, res AS ({_metrics_sql('event_type AS model, CASE WHEN isodow(ts) >= 6 THEN $$weekend$$ ELSE $$week$$ END AS feature_set', 'ev')})"
).replace("$$", "'")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir).withColumns(
        {"model": F.col("event_type"), "feature_set": F.when(F.weekday("ts") >= 5, "weekend").otherwise("week")}
    )
    found = modelling.metrics(rows, "value", keys=["model", "feature_set"])
    return found.withColumnsRenamed({m: f"test_{m}" for m in modelling.METRICS})


@query(
    f"WITH {_RESULTS} SELECT model, {s.r('max(rmse) FILTER (WHERE feature_set = ' + repr('week') + ')')} AS week, "
    f"{s.r('max(rmse) FILTER (WHERE feature_set = ' + repr('weekend') + ')')} AS weekend FROM res GROUP BY 1"
)
def metric_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(modelling.metric_pivot(_results(spark, sf_dir), "test_rmse", ["week", "weekend"]))


@query(
    f"WITH {_RESULTS} SELECT model, round(avg(rmse), 3) AS test_rmse, round(avg(r2), 3) AS test_r2, round(avg(mape), 3) AS test_mape FROM res GROUP BY 1"
)
def model_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling.model_summary(_results(spark, sf_dir))


@query(
    f"WITH {_RESULTS} SELECT model, feature_set, {s.r('r2')} AS test_r2 FROM res ORDER BY r2 DESC, feature_set, model LIMIT 1"
)
def best_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(modelling.best_model(_results(spark, sf_dir)).select("model", "feature_set", "test_r2"))
