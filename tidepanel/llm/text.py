"""What the text operators share: table access, words, row keys, Arrow batches."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
NO_ID = -(2**63)  # stands for a null id where ids are compared; sorts first


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other letters as they are."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def id_key(doc_id: Column | str) -> Column:
    return F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(NO_ID))


def row_hash(text: Column | str) -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("\0null")))


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the split into learning and held-out rows."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(0)).cast("string").cast("binary")) % modulus


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions must read, not repeat.

    A projection may be merged into the lambda of a following one, which would then split a
    text again for each of its words. A generator is never merged.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def words(text: str | None) -> list[bytes]:
    """The runs of [^\\x20\\x09-\\x0D] with A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split() if text else []


def rows_of(batches: Iterator[pa.RecordBatch], limit: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is derived from one stays small too."""
    for batch in batches:
        for start in range(0, batch.num_rows, limit):
            yield batch.slice(start, limit)


def crc(raw: bytes) -> int:
    return zlib.crc32(raw) & 0xFFFFFFFF


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit integers for each seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
