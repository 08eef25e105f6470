"""The hourly rollup over files as they arrive.

State is one row per entity and hour that the watermark has not passed; the sink is a folder of
Parquet files, to which every hour is written once, when it is closed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepanel.spec import PanelSpec

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
END = "\0end"  # entity of the row that closes all hours


def _instant(ts: str) -> Column:
    """A time without a zone as the instant with that clock in UTC: watermarks need instants, and
    must not skip or repeat an hour where the session's zone does."""
    seconds = (F.col(ts) - F.expr(_EPOCH)).cast("interval second").cast("decimal(20,6)")
    return F.timestamp_seconds(seconds)


def rolled(stream: DataFrame, spec: PanelSpec, delay: str = "2 hours") -> DataFrame:
    """``cleaning.hourly_rollup`` as a streaming aggregate; rows more than ``delay`` late are dropped.

    Rows without an entity or a time drop. A label is the first in time of its hour.
    """
    measures = [c for c in spec.measures if c in stream.columns]
    aggs = [(F.coalesce(F.sum(c), F.lit(0.0)) / 2).alias(c) for c in measures]
    aggs += [F.avg(c).alias(c) for c in spec.rates(stream)]
    if spec.label in stream.columns:
        when = F.when(F.col(spec.label).isNotNull(), F.struct(spec.ts, *spec.tie_break))
        aggs.append(F.min_by(spec.label, when).alias(spec.label))
    rows = stream.where(F.col(spec.entity).isNotNull() & F.col(spec.ts).isNotNull())
    timed = rows.withColumn("_at", _instant(spec.ts)).withWatermark("_at", delay)
    grouped = timed.groupBy(spec.entity, F.window("_at", "1 hour").alias("_hour")).agg(*aggs)
    start = F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_micros("_hour.start").cast("decimal(24,6)") / 1_000_000)
    kept = [a for a in stream.columns if a in {*measures, *spec.rates(stream), spec.label}]
    return grouped.select(spec.entity, start.alias(spec.ts), *kept)


def drain(spark: SparkSession, schema: StructType, source: str, sink: str, state: str, spec: PanelSpec, delay: str = "2 hours", files: int = 1000) -> None:
    """Take in what has arrived in ``source`` since the last call and write the hours that closed.

    ``state`` holds offsets and open hours; a call that is lost half-way is repeated from there,
    and the sink's log keeps each hour from being written twice.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    query = (
        rolled(stream, spec, delay).writeStream.format("parquet").option("path", sink)
        .option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def close(spark: SparkSession, schema: StructType, source: str, spec: PanelSpec, after: str) -> None:
    """Send a row later than all others, which lets the watermark pass them; it is never written out
    itself, since nothing comes behind it."""
    cells = [F.lit(END).alias(c) if c == spec.entity else F.expr(f"TIMESTAMP_NTZ'{after}'").alias(c) if c == spec.ts
             else F.lit(None).cast(schema[c].dataType).alias(c) for c in schema.names]
    spark.range(1).select(*cells).coalesce(1).write.mode("append").parquet(source)
