"""Sinks: panels, result tables, text reports, fitted pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.operators import quality
from tidepanel.spec import ENERGY, PanelSpec


def write_panel(
    df: DataFrame, path: str, spec: PanelSpec = ENERGY, fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a panel as Parquet, or as CSV with a header.

    Rows are range-partitioned on (entity, time) and sorted: few files per entity, pruned by
    their minima and maxima, and a large entity spreads over several files. Entities are no
    directories, so there may be any number of them, and columns keep their types and places.
    ``partition_by`` is for columns with few values.
    """
    ordered = df.repartitionByRange(spec.entity, spec.ts).sortWithinPartitions(spec.entity, spec.ts)
    writer = ordered.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_results(results: DataFrame, path: str) -> None:
    """The model result table (a row per feature set and model) as CSV."""
    write_csv(results.orderBy("feature_set", "model"), path)


def panel_head(df: DataFrame, spec: PanelSpec = ENERGY, n: int = 1000) -> DataFrame:
    """The first n rows in (entity, time) order, for a quick look."""
    return df.orderBy(spec.entity, spec.ts, *spec.tie_break).limit(n)


def write_profile(df: DataFrame, path: str) -> None:
    write_csv(quality.column_profile(df), path)


def null_report(df: DataFrame) -> str:
    """Null cells, completeness and nulls per column as text (a line per column with nulls)."""
    size = quality.completeness(df).first()
    place = {c: k for k, c in enumerate(df.columns)}
    rows = sorted(quality.null_profile(df).collect(), key=lambda r: place[r["column"]])
    head = f"{size['null_cells']:,} null cells, {size['completeness']:.2f} % of all cells filled"
    body = [f"{r['column']}: {r['nulls']:,}" for r in rows] or ["no column has nulls"]
    return "\n".join([head, *body]) + "\n"


def exploration_report(summary: DataFrame) -> str:
    r = summary.first()
    return (
        f"{r['n_variables']} variables of {r['n_entities']} entities from {r['first_ts']} to {r['last_ts']}; "
        f"{r['n_strong_pairs']} pairs correlate above 0.5\n"
    )


def test_report(pairs: DataFrame, groups: DataFrame, conclusions: DataFrame) -> str:
    """Both test tables and the conclusions as text (a row per test)."""
    c = conclusions.first()
    summary = (
        f"{c['n_significant']} of {c['n_tests']} tests significant; strongest pair {c['strongest_pair']} "
        f"(r {c['strongest_r']:.3f}); largest effect {c['largest_effect']} (eta squared {c['largest_eta_squared']:.3f})"
    )
    return "\n\n".join([summary, pairs.toPandas().to_string(), groups.toPandas().to_string()]) + "\n"


def write_text(df_like: DataFrame, text: str, path: str) -> None:
    """A short report as one text file next to the tables (any file system Spark can write)."""
    spark = df_like.sparkSession
    one = spark.range(1).select(F.lit(text.rstrip("\n")).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)


def save_pipeline(model: PipelineModel, folder: str, name: str) -> str:
    """Store a fitted pipeline under a path made from its model's name."""
    path = f"{folder.rstrip('/')}/best_model_{name.replace(' ', '_')}"
    model.write().overwrite().save(path)
    return path
