"""Line deduplication over the whole corpus, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import SPACES, bind, id_key, lower_ascii, row_hash
from tidepanel.session import write_table


def line_keys(documents: DataFrame, min_chars: int) -> DataFrame:
    """(_id, _row, pos, k1, k2) of each line whose key has ``min_chars`` code points.

    The key is the line stripped and with A-Z lower-cased. Two 64-bit hashes with different
    seeds stand for it; no text is shuffled.
    """
    found = documents.select(
        id_key("doc_id").alias("_id"), row_hash("text").alias("_row"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"),
    )
    key = F.btrim("line", F.lit(SPACES))
    found = found.select("_id", "_row", "pos", key.alias("key")).where(F.length("key") >= min_chars)
    found = found.withColumn("key", lower_ascii(F.col("key")))
    return found.select("_id", "_row", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))


def dedup_lines(documents: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The documents with ``text`` reduced, and ``n_lines`` and ``n_dropped`` added.

    A line whose key is found in ``min_docs`` documents or more goes, except in the document with
    the smallest doc_id that holds it. The other lines stay in place, joined by newlines;
    ``n_chars``, if there is such a column, follows the text.

    A null or empty text is one empty line (a null text stays null). A null doc_id counts as the
    smallest id. Rows that repeat a doc_id are one document; each row is returned. Other columns go
    through unseen, whatever their names; a former ``n_lines`` or ``n_dropped`` is replaced. An
    empty table gives no rows.

    Exploded rows hold two hashes, the id and the position; hashes are counted in two steps with
    partial sums, so a line found in a third of all documents is no hot key. The text is shuffled
    once, to meet its dropped positions; a very long one is split and joined in one row.
    """
    lines = write_table(line_keys(documents, min_chars), "lines")
    holders = lines.groupBy("k1", "k2", "_id").agg(F.lit(1).alias("one"))
    shared = holders.groupBy("k1", "k2").agg(F.min("_id").alias("first"), F.count("*").alias("holders"))
    # Written, so that both sides of the join are dealt anew and a hot line can be split.
    shared = write_table(shared.where(F.col("holders") >= min_docs).drop("holders"), "shared")
    drops = lines.join(shared, ["k1", "k2"]).where(F.col("_id") != F.col("first"))
    drops = drops.groupBy("_id", "_row").agg(F.collect_set("pos").alias("_drop"))

    place = {c: f"column_{k}" for k, c in enumerate(documents.columns)}  # no clash with names used here
    given = F.col(place["text"])
    text = F.coalesce(given, F.lit(""))
    whole = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in place.items()])
    whole = whole.withColumns({"_id": id_key(place["doc_id"]), "_row": row_hash(given)})
    whole = whole.join(drops.hint("shuffle_hash"), ["_id", "_row"], "left")
    hit = F.col("_drop").isNotNull()
    whole = bind(whole, lines=F.when(hit, F.split(text, "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "_drop")
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n")
    whole = bind(
        whole,
        n_lines=(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long"),
        n_dropped=F.when(hit, F.size("_drop")).otherwise(0).cast("long"),
        kept=F.when(hit, kept).otherwise(given),
    )
    new = {"text": F.col("kept")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length("kept").cast(documents.schema["n_chars"].dataType)
    own = [c for c in documents.columns if c not in ("n_lines", "n_dropped")]
    return whole.select(*[new.get(c, F.col(place[c])).alias(c) for c in own], "n_lines", "n_dropped")
