"""Ranked lexical search: the best documents of each query item over an FP-tree of documents.

A document's terms are restricted to those of the items and put in order of falling document
frequency, so that documents share the first steps of their paths in a trie. Documents sorted by
path are that trie: a node is a run of documents with a common prefix. The largest frequency of
each term and the smallest length norm in a subtree bound the score of all its documents; an item
goes down only where the bound can still reach its best ones.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.text import NO_ID, id_key, rows_of
from tidepanel.session import write_table

# Letters, digits and everything beyond ASCII are parts of terms; A-Z is lower-cased.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
LEAF, TREE_ROWS, TREE_CELLS, ITEM_STEP = 64, 8192, 2_000_000, 256
EXACT = 1 << 53  # integers up to here are exact as doubles


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Grows with ``tf``, falls with ``m``; always below a million."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _vectors(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """A row per document with terms (id, n, its item terms and their counts), and one with the
    sums of each task: (documents, terms in all, documents by item term)."""
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, docs, total = sent.value, Counter(), 0, 0
        names = ["kind", "id", "n", "terms", "counts"]

        def batch_of(rows):
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in rows_of(batches, 256):
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms(text)
                if found:
                    held = Counter(map(known.get, found))
                    held.pop(None, None)
                    seen.update(held.keys())
                    docs, total = docs + 1, total + len(found)
                    rows.append((0, key, len(found), list(held.keys()), list(held.values())))
            if rows:
                yield batch_of(rows)
        if docs:
            yield batch_of([(1, docs, total, list(seen.keys()), list(seen.values()))])

    schema = "kind int, id long, n long, terms array<int>, counts array<long>"
    out = write_table(documents.select(id_key("doc_id").cast("long").alias("id"), "text").mapInArrow(run, schema), "term-vectors")
    sent.destroy()
    return out


class Items:
    """The items' terms by rank of document frequency, weighted, as one sparse table."""

    def __init__(self, texts: list[list[bytes]], vocabulary: dict[bytes, int], held: dict[int, int], docs: int, total: int):
        order = sorted(vocabulary.items(), key=lambda x: (-held.get(x[1], 0), x[0]))
        self.rank = np.zeros(len(vocabulary), np.int64)
        self.rank[[t for _, t in order]] = np.arange(len(order))
        self.docs, self.total, self.count = docs, total, len(texts)
        ranks, weights, ends = [], [], [0]
        for found in texts:
            for term, k in Counter(found).items():
                df = held.get(vocabulary[term], 0)
                if df:
                    ranks.append(self.rank[vocabulary[term]])
                    weights.append(k * math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1))))
            ends.append(len(ranks))
        self.ranks, self.weights, self.ends = np.array(ranks, np.int64), np.array(weights, np.int64), np.array(ends)
        largest = max((int(self.weights[a:b].sum()) for a, b in zip(ends, ends[1:])), default=0)
        self.kind = np.float64 if largest * 1_000_000 < EXACT else np.int64


class Best:
    """The k best documents of each item so far, and the score to reach."""

    def __init__(self, items: Items, k: int):
        self.k, self.rows = k, [[] for _ in range(items.count)]
        self.least = np.zeros(items.count, np.int64)
        self.last = np.full(items.count, np.iinfo(np.int64).min)  # id of the k-th, which a tie must be below

    def open(self, item: np.ndarray, bound: np.ndarray, first_id: int) -> np.ndarray:
        return (bound > self.least[item]) | ((bound == self.least[item]) & (bound > 0) & (first_id < self.last[item]))

    def take(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        merged = sorted([*self.rows[item], *zip((-scores).tolist(), ids.tolist())])[: self.k]
        self.rows[item] = merged
        if len(merged) == self.k:
            self.least[item], self.last[item] = -merged[-1][0], merged[-1][1]


class Tree:
    """Documents sorted by path; a node is (first, behind the last, length of the common prefix)."""

    def __init__(self, items: Items, ids: np.ndarray, m: np.ndarray, ends: np.ndarray, ranks: np.ndarray, counts: np.ndarray):
        paths = [ranks[a:b].astype(">u4").tobytes() for a, b in zip(ends, ends[1:])]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), np.int64)
        sizes = np.diff(ends)[order]
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        cells = np.repeat(ends[:-1][order] - self.ends[:-1], sizes) + np.arange(self.ends[-1])
        self.ranks, self.counts = ranks[cells], counts[cells]
        self.ids, self.m, self.items = ids[order], m[order], items
        self.width = len(items.rank)

    def children(self, lo: int, hi: int, depth: int) -> list[tuple[int, int, int]]:
        """Runs that differ at ``depth``, neighbouring small ones together; paths that end there come first."""
        starts = self.ends[lo:hi] + depth
        step = np.where(starts < self.ends[lo + 1 : hi + 1], self.ranks[np.minimum(starts, len(self.ranks) - 1)], -1)
        cuts = [0, *(np.flatnonzero(step[1:] != step[:-1]) + 1).tolist(), hi - lo]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            if step[a] < 0:  # whole paths: nothing left to tell them apart
                out += [(lo + at, min(lo + at + LEAF, lo + b), -1) for at in range(a, b, LEAF)]
            elif out and out[-1][2] == -1 and lo + b - out[-1][0] <= LEAF:
                out[-1] = (out[-1][0], lo + b, -1)
            else:
                out.append((lo + a, lo + b, -1 if b - a <= LEAF else depth + 1))
        return out

    def bounds(self, lo: int, hi: int, cells: slice, first: np.ndarray) -> np.ndarray:
        """What no document of the run can exceed, for each item of the step."""
        most = np.zeros(self.width, np.int64)
        own = slice(self.ends[lo], self.ends[hi])
        np.maximum.at(most, self.ranks[own], self.counts[own])
        top = saturation(most, self.m[lo:hi].min())
        return np.add.reduceat(np.append(self.items.weights[cells] * top[self.items.ranks[cells]], 0), first)

    def search(self, best: Best) -> None:
        """Depth first, all items of a step at once; an item leaves a branch that can't reach its best."""
        items = self.items
        alive_all = np.flatnonzero(np.diff(items.ends) > 0)  # an item without a known term has no document
        for at in range(0, len(alive_all), ITEM_STEP):
            step = alive_all[at : at + ITEM_STEP]
            cells = slice(items.ends[step[0]], items.ends[step[-1] + 1])
            first = items.ends[step] - items.ends[step[0]]
            stack = [(0, len(self.ids), 0, np.arange(len(step)))]
            while stack:
                lo, hi, depth, alive = stack.pop()
                bound = self.bounds(lo, hi, cells, first)[alive]
                alive = alive[best.open(step[alive], bound, self.ids[lo:hi].min())]
                if not len(alive):
                    continue
                if depth < 0 or hi - lo <= LEAF:
                    self.score(lo, hi, step[alive], best)
                    continue
                below = self.children(lo, hi, depth)
                while len(below) == 1 and below[0][2] >= 0:
                    below = self.children(*below[0])
                stack += [(*node, alive) for node in reversed(below)]

    def score(self, lo: int, hi: int, alive: np.ndarray, best: Best) -> None:
        items, own = self.items, slice(self.ends[lo], self.ends[hi])
        columns, place = np.unique(self.ranks[own], return_inverse=True)
        if not len(columns):
            return
        row = np.repeat(np.arange(hi - lo), np.diff(self.ends[lo : hi + 1]))
        held = np.zeros((hi - lo, len(columns)), items.kind)
        held[row, place] = saturation(self.counts[own], self.m[lo:hi][row])
        sizes = items.ends[alive + 1] - items.ends[alive]
        cells = np.repeat(items.ends[alive] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        column = np.minimum(np.searchsorted(columns, items.ranks[cells]), len(columns) - 1)
        here = columns[column] == items.ranks[cells]
        wanted = np.zeros((len(alive), len(columns)), items.kind)
        wanted[np.repeat(np.arange(len(alive)), sizes)[here], column[here]] = items.weights[cells][here]
        scores = (wanted @ held.T).astype(np.int64)
        reach = (scores > 0) & (scores >= best.least[alive][:, None])
        for i in np.flatnonzero(reach.any(1)).tolist():
            best.take(int(alive[i]), scores[i, reach[i]], self.ids[lo:hi][reach[i]])


def _search(vectors: DataFrame, items: Items, keys: list[tuple[int, int]], k: int, tasks: int) -> DataFrame:
    sent = vectors.sparkSession.sparkContext.broadcast((items, keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, keys = sent.value
        best, held, cells = Best(items, k), [], 0

        def grow():
            table = pa.Table.from_batches(held)
            ids, n = (table.column(c).to_numpy() for c in ("id", "n"))
            lists = table.column("terms").combine_chunks(), table.column("counts").combine_chunks()
            ends = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            ranks, counts = items.rank[lists[0].flatten().to_numpy()], lists[1].flatten().to_numpy()
            order = np.lexsort((ranks, np.repeat(np.arange(len(ids)), np.diff(ends))))
            # In Python integers where 25 * n * N leaves 64 bits.
            m = np.array([75 + 25 * int(x) * items.docs // items.total for x in n], np.int64)
            Tree(items, ids, m, ends, ranks[order], counts[order]).search(best)

        for batch in batches:
            for part in rows_of(iter([batch]), 1024):
                held.append(part)
                cells += len(part.column(2).flatten())
                if cells >= TREE_CELLS or sum(map(len, held)) >= TREE_ROWS:
                    grow()
                    held, cells = [], 0
        if held:
            grow()
        rows = [(*keys[i], key, -score) for i, found in enumerate(best.rows) for score, key in found]
        if rows:
            types = [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["number", "item_id", "id", "score"])

    schema = "number long, item_id long, id long, score long"
    given = vectors.where("kind = 0").select("id", "n", "terms", "counts")
    out = write_table(given.coalesce(tasks).mapInArrow(run, schema), "best-documents")
    sent.destroy()
    return out


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """All different items with a text, in blocks of about ``block_chars`` characters."""
    own = items.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull()).distinct()
    chars = own.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-chars // block_chars))
    for b in range(blocks):
        rows = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        if rows:
            yield sorted(((r["item_id"], r["text"]) for r in rows), key=lambda x: (x[0] is not None, x[0], x[1]))


def search(
    documents: DataFrame, items: DataFrame, k: int = 20, block_chars: int = 4_000_000, task_rows: int = 8192, most_tasks: int = 4096
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of each item.

    Null texts have no term; documents without one don't count and items without one find
    nothing; repeated rows of ``items`` count once, different texts under one item_id are ranked
    each; repeated documents are ranked each; equal scores go by ascending doc_id, a null id
    first; empty tables give no rows; other columns are ignored; texts are taken whole.

    Documents aren't shuffled. Tasks are sent one block of items, of ``block_chars`` characters
    at most or one item; a task keeps a tree of bounded size and k documents for each item, over all
    its rows. Only those move: tasks x items x k rows, with at most ``most_tasks`` tasks.
    """
    spark, out = documents.sparkSession, None
    for block in item_blocks(items, block_chars):
        texts = [terms(text) for _, text in block]
        vocabulary = {t: i for i, t in enumerate(sorted({t for found in texts for t in found}))}
        vectors = _vectors(documents, vocabulary)
        sums = vectors.where("kind = 1")
        size = sums.agg(F.sum("id").alias("docs"), F.sum("n").alias("terms")).first()
        if not size["docs"]:
            continue
        pairs = sums.select(F.explode(F.arrays_zip("terms", "counts")).alias("p")).groupBy("p.terms").agg(F.sum("p.counts").alias("df"))
        held = {r["terms"]: r["df"] for r in pairs.collect()}  # at most one row per term of the block
        own = Items(texts, vocabulary, held, size["docs"], size["terms"])
        keys = [(i, item) for i, (item, _) in enumerate(block)]
        tasks = min(most_tasks, -(-size["docs"] // task_rows))
        found = _search(vectors, own, keys, k, tasks)
        order = Window.partitionBy("number").orderBy(F.desc("score"), "id")
        ranked = found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
        ranked = ranked.select("item_id", "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
