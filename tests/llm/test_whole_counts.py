"""What is counted over all rows, not over a sample."""

from pyspark.sql import functions as F

from tidepanel.llm import toxicity


def test_toxicity_counts_all_labelled_rows(spark, monkeypatch):
    docs = spark.range(90_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 100, F.lit(" x"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 9 == 0).cast("int").alias("toxic"))
    seen, count = [], toxicity.pair_counts
    monkeypatch.setattr(toxicity, "pair_counts", lambda rows: seen.append(rows.count()) or count(rows))
    toxicity.fit(docs, labels)
    quarter = F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(4))
    assert seen == [docs.where(quarter != 0).count()] and seen[0] > 60_000
