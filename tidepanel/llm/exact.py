"""Exact duplicates through a cuckoo-filter index of live digests.

A text's digest is the SHA-256 of its bytes without white space. Digests are dealt by hash to
shards of bounded size. A shard keeps a cuckoo filter and its stored keys: the live digests with
the number of their rows and the row that stays. An arriving digest that the filter doesn't hold
is new; a hit is verified against the stored keys. A filter that overflows is doubled and filled
again from the stored keys. Deletion takes rows away and frees a digest's place with its last row.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import SPACES, id_key, rows_of
from tidepanel.session import write_table

SHARD_KEYS = 100_000  # live digests of a shard, some 40 MB in the one task that holds it
PLACES, KICKS = 4, 200
FILTER, ENTRY, ADD, REMOVE = range(4)
STATE = (
    "shard int, kind int, digest binary, n long, chars long, id long, batch int, row long, "
    "buckets int, slots binary, misled long"
)


class CuckooFilter:
    """Fingerprints of ``bits`` bits in buckets of four; each has two possible buckets."""

    def __init__(self, buckets: int = 64, bits: int = 16, slots: bytes | None = None):
        self.mask, self.bits = buckets - 1, bits
        self.slots = array("H", slots if slots is not None else bytes(2 * PLACES * buckets))
        self.turn = 0

    def _place(self, digest: bytes) -> tuple[int, int]:
        mark = int.from_bytes(digest[:4], "little") % ((1 << self.bits) - 1) + 1
        return mark, int.from_bytes(digest[8:16], "little") & self.mask

    def _other(self, mark: int, bucket: int) -> int:
        return (bucket ^ (mark * 0x9E3779B1 >> 7)) & self.mask

    def _find(self, mark: int, bucket: int) -> int:
        for at in range(PLACES * bucket, PLACES * bucket + PLACES):
            if self.slots[at] == mark:
                return at
        return -1

    def holds(self, digest: bytes) -> bool:
        mark, bucket = self._place(digest)
        return self._find(mark, bucket) >= 0 or self._find(mark, self._other(mark, bucket)) >= 0

    def add(self, digest: bytes) -> bool:
        """False on overflow; the filter must then be built again, a fingerprint has lost its place."""
        mark, bucket = self._place(digest)
        for b in (bucket, self._other(mark, bucket)):
            at = self._find(0, b)
            if at >= 0:
                self.slots[at] = mark
                return True
        for _ in range(KICKS):
            self.turn = (self.turn + 1) % PLACES
            at = PLACES * bucket + self.turn
            mark, self.slots[at] = self.slots[at], mark
            bucket = self._other(mark, bucket)
            at = self._find(0, bucket)
            if at >= 0:
                self.slots[at] = mark
                return True
        return False

    def remove(self, digest: bytes) -> None:
        """Of a digest that was added; both of its buckets hold equal fingerprints in equal right."""
        mark, bucket = self._place(digest)
        for b in (bucket, self._other(mark, bucket)):
            at = self._find(mark, b)
            if at >= 0:
                self.slots[at] = 0
                return
        raise KeyError("the digest was never added")


class Shard:
    """A filter and its stored keys: digest to (rows, -chars, id, batch, row) of the row that stays."""

    def __init__(self, bits: int):
        self.filter, self.keys, self.misled, self.bits = CuckooFilter(bits=bits), {}, 0, bits

    def rebuild(self, buckets: int) -> None:
        while True:
            fresh = CuckooFilter(buckets, self.bits)
            if all(fresh.add(d) for d in self.keys):
                self.filter = fresh
                return
            buckets *= 2

    def known(self, digest: bytes) -> bool:
        if not self.filter.holds(digest):
            return False
        if digest in self.keys:
            return True
        self.misled += 1  # the fingerprint of another digest
        return False

    def add(self, digest: bytes, n: int, best: tuple) -> None:
        if self.known(digest):
            had, kept = self.keys[digest]
            self.keys[digest] = (had + n, min(kept, best))
            return
        self.keys[digest] = (n, best)
        if not self.filter.add(digest):
            self.rebuild(2 * (self.filter.mask + 1))

    def remove(self, digest: bytes, n: int, best: tuple) -> None:
        if not self.known(digest):
            return
        left = self.keys[digest][0] - n
        if left > 0:
            self.keys[digest] = (left, best)
        else:
            self.filter.remove(digest)
            del self.keys[digest]


@dataclass(frozen=True)
class Index:
    """Written tables: the shards' filters and keys, and the live rows without their texts."""

    state: DataFrame
    rows: DataFrame
    shards: int
    batches: int
    bits: int


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _apply(stored: DataFrame | None, changes: DataFrame, shards: int, bits: int) -> DataFrame:
    """Bring ``changes`` into the shards, each in one task that streams its rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, given = None, None, False

        def out():
            rows = [(now, FILTER, None, None, None, None, None, None, own.filter.mask + 1, own.filter.slots.tobytes(), own.misled)]
            rows += [(now, ENTRY, d, n, -b[0], b[1], b[2], b[3], None, None, None) for d, (n, b) in own.keys.items()]
            for at in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 10_000]), types)], names)

        types = [pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
        names = [c.split()[0] for c in STATE.split(", ")]
        for batch in rows_of(batches, 8192):
            for shard, kind, digest, n, chars, key, part, row, buckets, slots, misled in zip(*[c.to_pylist() for c in batch.columns]):
                if shard != now:
                    if own is not None:
                        yield from out()
                    now, own, given = shard, Shard(bits), False
                if kind == FILTER:
                    own.filter, own.misled, given = CuckooFilter(buckets, bits, slots), misled, True
                    continue
                best = None if chars is None else (-chars, key, part, row)
                if kind == ENTRY:
                    own.keys[digest] = (n, best)
                    if not given and not own.filter.add(digest):  # the shards were dealt anew
                        own.rebuild(2 * (own.filter.mask + 1))
                elif kind == ADD:
                    own.add(digest, n, best)
                else:
                    own.remove(digest, n, best)
        if own is not None:
            yield from out()

    rows = changes.select(_shard(shards).alias("shard"), "kind", "digest", "n", "chars", "id", "batch", "row")
    names = [c.split()[0] for c in STATE.split(", ")]
    if stored is not None:
        rows = rows.unionByName(stored, allowMissingColumns=True)
    else:
        rows = rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("buckets", "int"), ("slots", "binary"), ("misled", "long"))])
    dealt = rows.select(names).repartition("shard").sortWithinPartitions("shard", "kind")
    return write_table(dealt.mapInArrow(run, STATE), "cuckoo")


def _best():
    """Most code points, then the smallest id; of repeated rows the first."""
    return F.min(F.struct((-F.col("chars")).alias("chars"), "id", "batch", "row")).alias("best")


def _opened(df: DataFrame, kind: int) -> DataFrame:
    best = [F.col(f"best.{c}").alias(c) for c in ("id", "batch", "row")]
    return df.select(F.lit(kind).alias("kind"), "digest", "n", (-F.col("best.chars")).alias("chars"), *best)


def insert(documents: DataFrame, index: Index | None = None, shard_keys: int = SHARD_KEYS, bits: int = 16) -> Index:
    """The index with the rows of ``documents`` (doc_id, text) added.

    Null texts count as empty; null ids are one id that comes first; repeated rows are rows of
    their own; other columns are ignored; very long texts are hashed by the JVM, only their digests
    move. An empty table gives an index without keys. Copies are counted per input partition
    before they move, so that a digest of a third of all rows is a row per partition. More keys
    than ``shard_keys`` per shard double the number of shards, and their filters are filled again
    from the stored keys.
    """
    batch = index.batches if index else 0
    bare = F.translate(F.coalesce("text", F.lit("")), SPACES, "")
    rows = write_table(
        documents.select(
            id_key("doc_id").cast("long").alias("id"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"),
            F.unhex(F.sha2(bare.cast("binary"), 256)).alias("digest"), F.lit(batch).alias("batch"),
            F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("row"),
        ),
        "exact-rows",
    )
    counted = rows.groupBy("digest", "block").agg(F.count("*").alias("n"), _best())
    live = rows if index is None else index.rows.unionByName(rows)
    shards = 1 if index is None else index.shards
    needed = live.count()
    while shards * shard_keys < needed:
        shards *= 2
    stored = None
    if index is not None:
        stored = index.state
        if shards != index.shards:
            stored = stored.where(F.col("kind") == ENTRY).withColumn("shard", _shard(shards))
        bits = index.bits
    return Index(_apply(stored, _opened(counted, ADD), shards, bits), live, shards, batch + 1, bits)


def delete(index: Index, gone: DataFrame) -> Index:
    """The index without the rows whose doc_id is in ``gone``; ids that it doesn't hold do nothing.

    Where the row that stayed goes, the best of the rows left takes its place.
    """
    ids = gone.select(id_key("doc_id").cast("long").alias("id")).distinct()
    left = write_table(index.rows.join(ids, "id", "left_anti").select(index.rows.columns), "exact-rows")
    lost = write_table(index.rows.join(ids, "id", "left_semi").groupBy("digest").agg(F.count("*").alias("n")), "exact-lost")
    best = left.join(lost.select("digest"), "digest", "left_semi").groupBy("digest").agg(_best())
    return Index(
        _apply(index.state, _opened(lost.join(best, "digest", "left"), REMOVE), index.shards, index.bits),
        left, index.shards, index.batches, index.bits,
    )


def groups(index: Index) -> DataFrame:
    """(id, digest, keep_id, group_size, kept) for every live row; ``NO_ID`` stands for a null id.

    The stored keys are joined to one row per digest and block, then to the block's rows: no key
    of either join has more rows than a block.
    """
    keys = index.state.where(F.col("kind") == ENTRY).select(
        "digest", F.col("n").alias("group_size"), F.col("id").alias("keep_id"), F.col("batch").alias("keep_batch"), F.col("row").alias("keep_row")
    )
    place = ["digest", "batch", "block"]
    dealt = index.rows.select(place).distinct().join(keys, "digest")
    kept = (F.col("row") == F.col("keep_row")) & (F.col("batch") == F.col("keep_batch"))
    return index.rows.join(dealt, place).select("id", "digest", "keep_id", "group_size", kept.alias("kept"))


def exact_duplicates(documents: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """:func:`groups` of one table, indexed in one batch; the cases are those of :func:`insert`."""
    return groups(insert(documents, shard_keys=shard_keys))
