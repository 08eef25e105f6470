"""The streaming rollup against the one over the whole table."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from tidepanel.operators import cleaning
from tidepanel.spec import PanelSpec
from tidepanel.streaming import rollup

SPEC = PanelSpec(entity="e", ts="t", target="v", measures=("v", "w"), label="name", rate_marks=("TC",))
SCHEMA = "e string, t timestamp_ntz, v double, w double, TC_x double, name string"


def test_hours_arrive_once_and_equal_the_table(spark, tmp_path):
    rng = np.random.default_rng(5)
    t0 = datetime(2024, 3, 30, 12)
    rows = [(str(rng.choice(["a", "b"])), t0 + timedelta(minutes=30 * k), float(k), None if k % 3 else 1.0, float(k % 7), f"n{k}" if k % 4 else None) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    source, sink, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    for part in range(3):
        df.where(F.floor((F.col("v")) / 100) == part).repartition(2).write.mode("append").parquet(source)
        rollup.drain(spark, df.schema, source, sink, state, SPEC, "3 hours")
        if part == 0:
            early = spark.read.parquet(sink)
            assert 0 < early.count() < cleaning.hourly_rollup(df.where("v < 100"), SPEC).count()  # the last hours are open
    late = [("a", t0, 5000.0, 1.0, 1.0, "late")]  # behind the watermark: dropped
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    rollup.close(spark, df.schema, source, SPEC, "2031-01-01 00:00:00")
    rollup.drain(spark, df.schema, source, sink, state, SPEC, "3 hours")
    got, want = (sorted(map(tuple, x.collect())) for x in (spark.read.parquet(sink), cleaning.hourly_rollup(df, SPEC)))
    assert got == want
