"""Suffix statistics cover all labelled urls, however few the trees are fitted on."""

import math

from pyspark.sql import functions as F

from tidepanel.llm import urls


def test_suffixes_are_counted_over_all_labelled_urls(spark):
    rows = [(f"http://h{k}.s{k % 40}/p{k}", int(k % 40 < 10)) for k in range(400)]
    df = spark.createDataFrame(rows, "url string, label int")
    host, path = urls.parts(F.col("url"))
    model = urls.train(df.select("url", host.alias("host"), path.alias("path"), "label"), max_rows=60, rounds=2)
    got = {r["suffix"]: r for r in model.suffixes.collect()}
    assert len(got) == 40 and model.rate == 0.25 and model.trees is not None
    for k in range(40):
        assert math.isclose(got[f"s{k}"]["suffix_seen"], math.log(11))
        assert math.isclose(got[f"s{k}"]["suffix_rate"], (10 * (k < 10) + 1.25) / 15)
