"""Quality rules with cross-document line frequency, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import SPACE_CLASS, SPACES, bind, id_key, lower_ascii, row_hash
from tidepanel.session import write_table

SYMBOLS = "#*$%&|<>"


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, _id, _row and a text's own measures; see :func:`judge`."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    found = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+", -1))
    symbols = sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(s), F.lit(""))) for s in SYMBOLS), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    first = bind(documents.select("doc_id", id_key("doc_id").alias("_id"), row_hash("text").alias("_row"), "text"),
                 words=found, n_symbols=symbols.cast("long"), lines=lines).drop("text")
    first = bind(first, n_words=F.size("words").cast("long"), word_chars=F.length(F.array_join("words", "")).cast("long"),
                 n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
                 h=F.transform("words", lambda w: F.xxhash64(w))).drop("words", "lines")
    n = F.size("h")
    windows = F.transform(F.arrays_zip(F.col("h"), F.slice("h", 2, n).alias("i"), F.slice("h", 3, n).alias("j")),
                          lambda x: F.xxhash64(x["h"], x["i"], x["j"]))
    first = bind(first, win=F.when(n >= 3, F.slice(windows, 1, n - 2)).otherwise(F.array().cast("array<bigint>"))).drop("h")
    # Only texts with a repeated window sort them, to find the words that such windows cover.
    many = F.size("win") != F.size(F.array_distinct("win"))
    first = bind(first, at=F.when(many, F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("win")
    near = F.zip_with(F.slice("at", 1, F.size("at") - 1), F.slice("at", 2, F.size("at") - 1),
                      lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    starts = F.array_distinct(F.flatten(near))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
    repeated = F.when(F.col("at").isNotNull(), F.size(covered)).otherwise(0).cast("long")
    return first.select("doc_id", "_id", "_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"))


def line_rows(documents: DataFrame, host: str) -> DataFrame:
    """(_id, _row, host, k1, k2, chars) of each line with a word; hashes stand for host and line."""
    rows = documents.select(
        id_key("doc_id").alias("_id"), row_hash("text").alias("_row"), F.xxhash64(F.coalesce(host, F.lit("\0null"))).alias("host"),
        F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"),
    )
    rows = rows.withColumn("line", F.btrim("line", F.lit(SPACES))).where(F.col("line") != "")
    rows = rows.withColumn("line", lower_ascii(F.col("line")))
    return rows.select("_id", "_row", "host", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"),
                       F.length("line").cast("long").alias("chars"))


def judge(
    documents: DataFrame, host: str = "source", min_words: int = 50, max_repeat_percent: int = 50,
    max_docs: int = 20, min_chars: int = 10, min_left_percent: int = 50,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, left_percent, base_failed, kept.

    A document fails at base with under ``min_words`` words or with over ``max_repeat_percent`` of
    its words in 3-word windows that it repeats. Across documents, a normalised line of
    ``min_chars`` characters or more that over ``max_docs`` different documents of one host hold
    is removed; a document is depleted if under ``min_left_percent`` of its lines' characters are
    left. Documents that fail or are depleted are not kept.

    A null text is empty; a null host is a host of its own; a null doc_id is one document more;
    repeated rows count as one document and are each returned; an empty table gives no rows;
    other columns are ignored; a very long text is measured whole, with 16 bytes a window of its words.
    No text is shuffled: a line is two hashes, a host one. Counts are
    partial sums in two steps, so neither a hot host nor a hot line is a hot key.
    """
    lines = write_table(line_rows(documents, host), "lines")
    holders = lines.where(F.col("chars") >= min_chars).groupBy("host", "k1", "k2", "_id").agg(F.lit(1).alias("one"))
    common = holders.groupBy("host", "k1", "k2").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs)
    # Written, so that both sides of the join are dealt anew and a hot line can be split.
    common = write_table(common.withColumn("gone", F.lit(1).cast("long")).drop("docs"), "common")
    left = lines.join(common, ["host", "k1", "k2"], "left").groupBy("_id", "_row").agg(
        F.sum("chars").alias("chars"), F.sum(F.col("chars") * (1 - F.coalesce("gone", F.lit(0)))).alias("left"))
    base = measures(documents).join(left, ["_id", "_row"], "left")
    share = F.when(F.coalesce("chars", F.lit(0)) > 0, F.col("left") * 100 / F.col("chars")).otherwise(100.0)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    base = base.withColumns({"left_percent": share.cast("double"), "base_failed": failed})
    return base.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "left_percent", "base_failed",
        (~F.col("base_failed") & (F.col("left_percent") >= min_left_percent)).alias("kept"),
    )
