"""Panels derived from the given tables.

``raw_panel`` turns the event stream into a half-hourly raw table with the headers, text
numbers, decimal commas, bad tokens and gaps of the energy preset, so that all stages can
run on it. All counts per cell come from one partial aggregation over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions import columns as fx
from tidepanel.operators.cleaning import cast_numbers
from tidepanel.plans import clean as stage
from tidepanel.session import write_table
from tidepanel.spec import ENERGY, PanelSpec

# Which events feed which measure: residue of event_id modulo 6, in header order.
SOURCES = {"Thermique": 0, "Nucléaire": 1, "Eolien": 2, "Solaire": 3, "Hydraulique": 4, "Bioénergies": 5}

EVENTS = PanelSpec(entity="event_type", ts="ts", target="value", measures=("value",), tie_break=("event_id",))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_panel(spark: SparkSession, sf_dir: str, entity: str = "event_type", minutes: int = 30) -> DataFrame:
    events = load(spark, sf_dir, "events").select(
        F.col(entity).cast("string").alias("Région"),
        fx.floor_to("ts", minutes).alias("slot"),
        "event_id", "user_id", "value",
        F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("int").alias("k"),
    )
    value, k, event = F.col("value"), F.col("k"), F.col("event_id")

    def text(c: Column, digits: int = 2) -> Column:
        return c.cast(f"decimal(18,{digits})").cast("string")

    def at(modulus: int, rest: int) -> Column:
        return F.when(event % modulus == rest, value)

    # A number stands for the label until the rows are grouped: text would force Spark to
    # sort the events where it can hash them.
    nature = F.min_by(F.col("user_id") % 3, F.when(event % 5 != 0, event))
    cells = {
        "Nature": F.concat(F.lit("N"), nature.cast("string")),
        "Consommation (MW)": F.when(F.min(event) % 11 == 0, "ND").otherwise(
            F.replace(text(F.sum(value)), F.lit("."), F.lit(","))
        ),
    }
    cells |= {f"{s} (MW)": text(F.sum(at(6, r))) for s, r in SOURCES.items()}
    cells |= {
        "Pompage (MW)": text(F.sum(-at(10, 0))),
        "Ech. physiques (MW)": text(F.sum(value - 50)),
        "Stockage batterie": text(F.sum(at(50, 0))),
        "Déstockage batterie": text(F.sum(at(50, 1))),
        "Eolien terrestre": text(F.sum(at(12, 2))),
        "Eolien offshore": text(F.sum(at(12, 8))),
    }
    for s, r in SOURCES.items():
        cells[f"TCO {s} (%)"] = text(F.sum(F.when(event % 6 == r, k)), 1)
        cells[f"TCH {s} (%)"] = text(F.max(F.when((event % 6 == r) & (k < 50), k)), 1)
    grouped = events.groupBy("Région", "slot").agg(*[c.alias(n) for n, c in cells.items()])
    slot = F.col("slot").cast("string")  # 2024-01-01 00:30:00, without a zone
    return grouped.select(
        F.length("Région").cast("string").alias("Code INSEE région"),
        "Région", "Nature",
        F.substring(slot, 1, 10).alias("Date"), F.substring(slot, 12, 5).alias("Heure"),
        *[F.col(f"`{n}`") for n in cells if n != "Nature"],
        F.lit(None).cast("string").alias("Column 30"),
    )


def hourly_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table at hourly grain, without about one hour in eleven."""
    raw = raw_panel(spark, sf_dir, minutes=60)
    return raw.where((F.substring("Date", 9, 2).cast("int") + F.substring("Heure", 1, 2).cast("int")) % 11 != 0)


def typed_panel(spark: SparkSession, sf_dir: str, entity: str = "event_type") -> DataFrame:
    return stage.typed(raw_panel(spark, sf_dir, entity))


def clean_panel(spark: SparkSession, sf_dir: str, entity: str = "event_type") -> DataFrame:
    """The cleaned hourly panel; the raw one is half-hourly by construction."""
    return stage.clean(raw_panel(spark, sf_dir, entity), halves=True)


def stored_clean_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned panel written once, as the stages hand it on."""
    return write_table(clean_panel(spark, sf_dir), "panel")


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with every seventh value missing."""
    return load(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("event_id") % 7 != 0, F.col("value"))
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with derived money columns."""
    return load(spark, sf_dir, "lineitem").withColumns(
        {
            "net": F.col("l_extendedprice") * (1 - F.col("l_discount")),
            "charge": F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),
        }
    )


__all__ = ["EVENTS", "ENERGY", "cast_numbers", "clean_panel", "gappy_events", "hourly_source", "lines", "load", "raw_panel",
           "stored_clean_panel", "typed_panel"]
