"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import decontaminate, language, lines, packing, simhash
from tidepanel.llm.queries import language_model, tokenizer_path
from tidepanel.llm.text import load
from tidepanel.session import write_table

MIN_SHARE = 0.4  # of a document's letters in its main language


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without a main language, go. Columns stay as they are."""
    found = language.identify(docs, language_model(docs), with_spans=False)
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SHARE)
    return found.where(kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 10 code points or more stay in the smallest doc_id that holds them; n_chars follows."""
    return lines.dedup_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints over 3-word shingles are linked at 2 or fewer differing bits the
    smallest doc_id stays; of the texts that line dedup has emptied, which share a fingerprint, one stays."""
    return simhash.keep_found(docs, simhash.near_duplicates(docs, shingle=3, bits=2))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % of the 5-word shingles of a test item go."""
    return decontaminate.without_items(docs, load(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two length, each from one document."""
    return packing.pack(docs, tokenizer_path(), end_id=1, largest=2048)


STAGES = [
    ("language id", language_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # language models, fingerprint links, MinHash and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each is written and read again as the next one's input.

    A stage handles null and repeated rows, empty texts and empty tables as its operator says.
    """
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
