"""Packing by powers of two: no sequence crosses a document and none is padded.

Each document (its ids and an end id) is cut into pieces of the largest allowed power of two
and then the binary digits of the rest, longest first. A piece is a sequence of its own;
sequences of one length form a bucket from which batches are drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.text import crc, rows_of
from tidepanel.llm.tokens import TokenIds
from tidepanel.session import write_table

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, slot long"


def binary_lengths(n: int, largest: int) -> list[int]:
    """``largest`` as often as it fits, then the binary digits of the rest."""
    rest = n % largest
    return [largest] * (n // largest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(documents: DataFrame, tokenizer: str, end_id: int, largest: int, with_ids: bool) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in its task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, used = TokenIds.at(tokenizer), TaskContext.get().partitionId(), {}
        for batch in rows_of(batches):
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.with_end(batch.column(1).to_pylist(), end_id)):
                start, wide = 0, memoryview(ids.astype("<u4").tobytes())
                for n in binary_lengths(len(ids), largest):
                    slot = used[n] = used.get(n, -1) + 1
                    row = (doc, start, n, crc(wide[4 * start : 4 * (start + n)]), len(ids), task, slot)
                    out.append(row + (ids[start : start + n].astype("<i4"),) if with_ids else row)
                    start += n
            if out:
                columns = list(zip(*out))
                arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.int32(), pa.int64()])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "slot"]
                if with_ids:
                    ends = np.cumsum([0] + [len(p) for p in columns[7]]).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(columns[7]))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = PIECE + (", ids array<int>" if with_ids else "")
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def pack(
    documents: DataFrame, tokenizer: str, end_id: int = 1, largest: int = 2048, with_ids: bool = True
) -> DataFrame:
    """Rows of (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    ``length`` is a power of two and the whole sequence, so ``offset`` is 0. Sequence ids are
    numbered without gaps, bucket by bucket from the longest, so a bucket is a range of ids and
    a batch of equal lengths a shorter one; inside a bucket they follow the input's splits.
    ``ids`` are the piece's token ids.

    A null or empty text is its end id alone; a null doc_id stays null; repeated rows are packed
    each on its own; an empty table gives no rows; other columns are ignored.
    Nothing but the rank table (tasks x lengths rows) is shuffled while that is of broadcast size.
    """
    if largest & (largest - 1):
        raise ValueError("largest must be a power of two")
    cut = write_table(pieces(documents, tokenizer, end_id, largest, with_ids), "pieces")
    used = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    longer = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    used = write_table(used.select("length", "task", F.coalesce(longer, F.lit(0)).alias("before")), "ranks")
    totals = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # 12 rows
    first, base = {}, 0
    for length in sorted(totals, reverse=True):
        first[length], base = base, base + totals[length]
    at = F.lit(0).cast("long")
    for length, n in first.items():
        at = F.when(F.col("length") == length, F.lit(n).cast("long")).otherwise(at)
    if used.count() <= 1_000_000:  # 20 MB; a larger rank table is joined by shuffle
        used = F.broadcast(used)
    return cut.join(used, ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (at + F.col("before") + F.col("slot")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
