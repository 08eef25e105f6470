"""Benchmark decontamination: size-partitioned MinHash search for contained test items.

A test item is short and a document may be long, so their Jaccard similarity says little. Items
are put in size classes (powers of two of their shingles). For each class a document is cut into
windows of twice the class's size, one class size apart, so that a contained item lies whole in
some window and its similarity to that window is at least about 0.2 whatever the document's
length. An item and a window that agree in any of the MinHash values are a candidate; the share
of the item's shingles that the whole document holds decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import mix, rows_of

PERMUTATIONS = 64

_words = re.compile(r"\w+").findall


def shingles(text: str | None, size: int) -> np.ndarray:
    """The hashes of a text's word shingles in order; words are runs of letters and digits."""
    found = [w.encode("utf-8", "replace") for w in _words(text.lower())] if text else []
    if not found:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= size:
        return np.array([digest(joined)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found])
    pairs = zip([0, *ends[:-1].tolist()], (ends[size - 1 :] - 1).tolist())
    return np.array([digest(joined[a:b]) for a, b in pairs], np.uint64)


_odd = mix(np.arange(PERMUTATIONS)) | np.uint64(1)  # multiplying by an odd number permutes 64-bit integers


def block_minima(hashes: np.ndarray, starts: np.ndarray, rows: int = 1 << 15) -> np.ndarray:
    """For each block (from its start to the next) the least value under each permutation."""
    out = np.empty((len(starts), PERMUTATIONS), np.uint64)
    bounds = np.append(starts, len(hashes))
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + rows, "right")) - 1)
        part, cuts = hashes[bounds[a] : bounds[b]], bounds[a:b] - bounds[a]
        with np.errstate(over="ignore"):
            for j, odd in enumerate(_odd):
                out[a:b, j] = np.minimum.reduceat(part * odd, cuts)
        a = b
    return out


class Items:
    """A block of test items: their shingles, and their MinHash values by size class."""

    def __init__(self, ids: list, texts: list[str | None], size: int):
        kept = [(i, np.unique(shingles(t, size))) for i, t in zip(ids, texts)]
        kept = [(i, s) for i, s in kept if len(s)]
        self.ids, self.sets = [i for i, _ in kept], [s for _, s in kept]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        if not len(self.sizes):
            return
        values = block_minima(np.concatenate(self.sets), np.cumsum(self.sizes) - self.sizes)
        of = np.maximum(2, 1 << np.ceil(np.log2(self.sizes)).astype(np.int64))
        for width in np.unique(of):
            own = np.flatnonzero(of == width)
            keys = self.keys(values[own]).reshape(-1)
            at = np.argsort(keys, kind="stable")
            bits = max(16, int(8 * len(keys) - 1).bit_length())
            flags = np.zeros(1 << bits, bool)
            flags[(keys & np.uint64(len(flags) - 1)).astype(np.int64)] = True
            self.classes[int(width)] = (keys[at], np.repeat(own, PERMUTATIONS)[at], flags)

    @staticmethod
    def keys(values: np.ndarray) -> np.ndarray:
        """MinHash values told apart by their permutation."""
        return values ^ _odd[None, :]

    def candidates(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(text, item) pairs, each once, for texts with ``sizes`` of all ``hashes``."""
        if not self.classes or not len(hashes):
            return np.zeros((0, 2), np.int64)
        found = []
        base = min(self.classes)
        many = -(-sizes // base)  # blocks a text
        text = np.repeat(np.arange(len(sizes)), many)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        minima = block_minima(hashes, (np.cumsum(sizes) - sizes)[text] + nth * base)
        width = base
        while True:
            same = np.append(text[1:] == text[:-1], False)  # the next block is of the same text
            if width in self.classes:
                keys, item, flags = self.classes[width]
                window = self.keys(np.where(same[:, None], np.minimum(minima, np.roll(minima, -1, 0)), minima))
                row, column = np.nonzero(flags[(window & np.uint64(len(flags) - 1)).astype(np.int64)])
                value = window[row, column]
                first, last = np.searchsorted(keys, value), np.searchsorted(keys, value, "right")
                count = last - first
                at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                found.append(np.column_stack([np.repeat(text[row], count), item[at]]))
            if width >= max(self.classes):
                break
            nth = np.arange(len(text)) - np.searchsorted(text, text)
            even = nth % 2 == 0
            minima = np.where((same & even)[:, None], np.minimum(minima, np.roll(minima, -1, 0)), minima)[even]
            text, width = text[even], width * 2
        return np.unique(np.concatenate(found), axis=0)

    def contained(self, texts: list[str | None], size: int, share: float) -> Iterator[tuple[int, int, int]]:
        """(text, item, shingles of the item that the text holds) where they reach ``share``."""
        hashes = [shingles(t, size) for t in texts]
        sizes = np.array([len(h) for h in hashes], np.int64)
        pairs = self.candidates(np.concatenate(hashes), sizes) if len(hashes) else []
        last, own = -1, None
        for k, i in pairs:
            if k != last:
                last, own = k, np.sort(hashes[k])
            at = np.minimum(np.searchsorted(own, self.sets[i]), len(own) - 1)
            held = int((own[at] == self.sets[i]).sum())
            if held >= share * self.sizes[i] - 1e-9:
                yield int(k), int(i), held


def item_blocks(benchmark: DataFrame, size: int, block_chars: int) -> Iterator[Items]:
    """All items, in blocks of about ``block_chars`` characters, which bounds what tasks are sent."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull()).distinct()
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-chars // block_chars))
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = own.collect()
        if rows:
            yield Items([r["item_id"] for r in rows], [r["text"] for r in rows], size)


def contamination(
    documents: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8, block_chars: int = 10_000_000
) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of each contained item.

    An item is contained if the document holds ``share`` of its different shingles of ``size``
    words (a shorter text is one shingle). A null or empty text has no shingle and neither holds
    nor is held; repeated rows of the benchmark count once, repeated documents each; null ids
    stay null; empty tables give no rows; other columns are ignored. Documents are never
    shuffled: each task gets the items, block by block, of which each has a bounded size.
    """
    schema = "doc_id long, item_id long, shared long, item_shingles long, containment double"
    out = documents.sparkSession.createDataFrame([], schema)
    for items in item_blocks(benchmark, size, block_chars):
        out = out.unionByName(_search(documents, items, size, share, schema))
    return out


def _search(documents: DataFrame, items: Items, size: int, share: float, schema: str) -> DataFrame:
    sent = documents.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 256):
            docs, own = batch.column(0).to_pylist(), sent.value
            rows = [
                (docs[k], own.ids[i], held, int(own.sizes[i]), held / float(own.sizes[i]))
                for k, i, held in own.contained(batch.column(1).to_pylist(), size, share)
            ]
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.float64()])]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "shared", "item_shingles", "containment"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def without_items(
    documents: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8, block_chars: int = 10_000_000
) -> DataFrame:
    """The documents that contain no item; columns and the rules of :func:`contamination` hold."""
    for items in item_blocks(benchmark, size, block_chars):
        sent = documents.sparkSession.sparkContext.broadcast(items)
        place = documents.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch], sent=sent, place=place) -> Iterator[pa.RecordBatch]:
            for batch in rows_of(batches, 256):
                keep = np.ones(batch.num_rows, bool)
                for k, _, _ in sent.value.contained(batch.column(place).to_pylist(), size, share):
                    keep[k] = False
                yield batch.filter(pa.array(keep))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
