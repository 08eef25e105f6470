"""Token-id shards with a minimal perfect hash index: keyed access in constant time.

A store is a folder with

* ``shards``: raw ids, little-endian, documents one after the other by ascending doc_id, after a
  header of 16 bytes (``TIDS``, id width, number of ids);
* ``index``: one file per bucket of keys. A minimal perfect hash (levels of bit arrays; a key
  lives on the first level where no other key falls on its bit, its slot is the bit's rank)
  leads to a slot with a stored fingerprint, the shard, the offset and the number of ids;
* ``directory`` and ``buckets``: Parquet tables that name the files that count.

Files get names of their own for each attempt of a task and count only once the attempt's rows
are committed, so a task that is lost or runs twice leaves at most a file that nobody names.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.llm.text import NO_ID, crc, id_key, mix, row_hash, rows_of
from tidepanel.llm.tokens import TokenIds
from tidepanel.session import new_path

HEAD, HEAD_SIZE = "<4sIQ", 16
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u8")])


def uri_of(path: str) -> str:
    """Hadoop's names of object stores as pyarrow knows them."""
    scheme, colon, rest = path.partition("://")
    return {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + colon + rest


def _files(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri_of(path))


def write_file(path: str, *parts: bytes) -> None:
    system, at = _files(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at) as out:
        for part in parts:
            out.write(part)


def read_file(path: str, start: int = 0, size: int | None = None) -> bytes:
    system, at = _files(path)
    with system.open_input_file(at) as file:
        return file.read_at(size if size is not None else file.size() - start, start)


def key_of(doc_id: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """A 64-bit key for the nth row with a doc_id; distinct for distinct ids."""
    with np.errstate(over="ignore"):
        return mix(mix(doc_id.astype(np.int64).view(np.uint64)) + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 7)


# --- the hash ------------------------------------------------------------------------------

class PerfectHash:
    """Keys (distinct 64-bit integers) to 0..n-1, in about 4 bits a key."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.cumsum(bits, dtype=np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 2.0) -> PerfectHash:
        sizes, arrays = [], []
        while len(keys):
            if len(sizes) > 200:
                raise ValueError("the keys are not distinct")
            size = max(64, int(room * len(keys) + 7) // 8 * 8)
            at = (mix(keys, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            arrays.append(alone)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(arrays) if arrays else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot or -1 for a key that was not in the set."""
        slot = np.full(len(keys), -1, np.int64)
        for level, size in enumerate(self.sizes):
            left = np.flatnonzero(slot < 0)
            if not len(left):
                break
            at = self.base[level] + (mix(keys[left], level + 1) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            slot[left[hit]] = self.rank[at[hit]] - 1
        return slot

    def to_bytes(self) -> bytes:
        head = struct.pack("<I", len(self.sizes)) + np.array(self.sizes, "<u8").tobytes()
        return head + np.packbits(self.bits, bitorder="little").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        levels = struct.unpack_from("<I", raw)[0]
        sizes = np.frombuffer(raw, "<u8", levels, 4).astype(int).tolist()
        packed = np.frombuffer(raw, np.uint8, offset=4 + 8 * levels)
        return cls(sizes, np.unpackbits(packed, bitorder="little")[: sum(sizes)].astype(bool))


def fingerprint_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 99) >> np.uint64(32)).astype(np.uint32)


class Index:
    """One bucket's hash and slots."""

    def __init__(self, raw: bytes):
        _, hash_bytes, _ = struct.unpack_from(HEAD, raw)
        self.hash = PerfectHash.from_bytes(raw[HEAD_SIZE : HEAD_SIZE + hash_bytes])
        self.table = np.frombuffer(raw, SLOT, offset=HEAD_SIZE + hash_bytes)

    @staticmethod
    def to_bytes(keys: np.ndarray, shard: np.ndarray, offset: np.ndarray, n: np.ndarray) -> bytes:
        found = PerfectHash.build(keys)
        table = np.zeros(len(keys), SLOT)
        slot = found.slots(keys)
        for name, values in (("fingerprint", fingerprint_of(keys)), ("shard", shard), ("offset", offset), ("n", n)):
            table[name][slot] = values
        raw = found.to_bytes()
        return struct.pack(HEAD, b"TIDX", len(raw), len(keys)) + raw + table.tobytes()

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, slot rows); a key that was never stored fails on its fingerprint."""
        slot = self.hash.slots(keys)
        if not len(self.table):
            return np.zeros(len(keys), bool), np.zeros(len(keys), SLOT)
        rows = self.table[slot]
        return (slot >= 0) & (rows["fingerprint"] == fingerprint_of(keys)), rows


# --- writing -------------------------------------------------------------------------------

def write_ids(
    documents: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None,
    shard_ids: int = 8_000_000, index_keys: int = 500_000,
) -> str:
    """Encode every whole text and write a store; returns its folder.

    Documents lie in ascending doc_id order over all shards; a null doc_id counts as the
    smallest, rows that repeat a doc_id follow each other by text hash and are told apart by
    their number. A null or empty text is its end id alone; an empty table gives an empty store;
    other columns are ignored. The text is range-partitioned once; a task closes a shard after
    ``shard_ids`` ids, so memory is bounded whatever a partition holds.
    """
    spark = documents.sparkSession
    path = path or new_path(spark, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = TokenIds.at(tokenizer), TaskContext.get().partitionId()
        width = np.dtype(encoder.dtype).itemsize
        shard, held, parts, name, last, nth = 0, 0, [], uuid.uuid4().hex, None, 0

        def close() -> None:
            nonlocal shard, held, parts, name
            if parts:
                write_file(f"{path}/shards/{name}.ids", struct.pack(HEAD, b"TIDS", width, held), *parts)
                shard, held, parts, name = shard + 1, 0, [], uuid.uuid4().hex

        for batch in rows_of(batches):
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.with_end(batch.column(1).to_pylist(), end_id)):
                if held and held + len(ids) > shard_ids:
                    close()
                nth = nth + 1 if doc == last else 0
                last = doc
                out.append((doc, nth, task, shard, name, held, len(ids), width))
                parts.append(ids.tobytes())
                held += len(ids)
            if out:
                doc, n, *rest = zip(*out)
                keys = key_of(np.array(doc), np.array(n)).view(np.int64)
                types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
                arrays = [pa.array(keys), pa.array(doc, pa.int64()), *(pa.array(c, t) for c, t in zip(rest, types))]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "doc_id", "task", "nth_shard", "file", "offset", "n", "width"])
        close()

    keyed = documents.select(id_key("doc_id").cast("long").alias("_id"), "text")
    dealt = keyed.repartitionByRange("_id").withColumn("_row", row_hash("text")).sortWithinPartitions("_id", "_row")
    dealt.select("_id", "text").mapInArrow(
        write, "key long, doc_id long, task int, nth_shard int, file string, offset long, n long, width int"
    ).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")

    order = Window.orderBy("task", "nth_shard")  # one row per shard
    shards = entries.groupBy("task", "nth_shard", "file", "width").agg(F.sum("n").alias("n_ids"), F.count("*").alias("n_docs"))
    shards.select(
        (F.row_number().over(order) - 1).alias("shard"), "task", "nth_shard", "file", "width", "n_ids",
        (F.sum("n_ids").over(order) - F.col("n_ids")).alias("first_id"),
    ).write.parquet(f"{path}/directory")
    directory = spark.read.parquet(f"{path}/directory")

    buckets = max(1, -(-entries.count() // index_keys))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        name = uuid.uuid4().hex
        raw = Index.to_bytes(pdf["key"].to_numpy(np.int64).view(np.uint64), *(pdf[c].to_numpy() for c in ("shard", "offset", "n")))
        write_file(f"{path}/index/{name}.idx", raw)
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "buckets": [buckets], "file": [name], "keys": [len(pdf)]})

    placed = entries.join(directory.select("task", "nth_shard", "shard"), ["task", "nth_shard"])
    placed = placed.select(F.pmod("key", F.lit(buckets).cast("long")).alias("bucket"), "key", "shard", "offset", "n")
    placed.groupBy("bucket").applyInPandas(build, "bucket long, buckets long, file string, keys long").write.parquet(f"{path}/buckets")
    return path


# --- reading -------------------------------------------------------------------------------

class TokenStore:
    """Single documents of a store; files are opened when first needed."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self.directory = {r["shard"]: r for r in spark.read.parquet(f"{path}/directory").collect()}
        self.files = {r["bucket"]: r for r in spark.read.parquet(f"{path}/buckets").collect()}
        self.open: dict[int, Index] = {}

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        """The ids of the nth row with this doc_id, or None; one slot and one read."""
        key = key_of(np.array([NO_ID if doc_id is None else doc_id]), np.array([nth]))
        if not self.files:
            return None
        bucket = int(key.view(np.int64)[0]) % next(iter(self.files.values()))["buckets"]
        if bucket not in self.files:
            return None
        if bucket not in self.open:
            self.open[bucket] = Index(read_file(f"{self.path}/index/{self.files[bucket]['file']}.idx"))
        found, rows = self.open[bucket].get(key)
        if not found[0]:
            return None
        shard = self.directory[int(rows["shard"][0])]
        width, start, n = shard["width"], int(rows["offset"][0]), int(rows["n"][0])
        raw = read_file(f"{self.path}/shards/{shard['file']}.ids", HEAD_SIZE + start * width, n * width)
        return np.frombuffer(raw, f"<u{width}")


def read_ids(spark: SparkSession, path: str, doc_ids: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) for all rows stored under ``doc_ids``.

    The ids go through the index: keys meet their bucket, slots with the right fingerprint lead
    to shards, and each shard is read once by the task that has its slots. ``start`` counts the
    ids of all documents before. Ids that are not stored give no row.
    """
    counted = doc_ids.groupBy(id_key("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("rows"))
    wanted = counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("nth"))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            key = key_of(pdf["doc_id"].to_numpy(), pdf["nth"].to_numpy()).view(np.int64)
            yield pd.DataFrame({"key": key, "doc_id": pdf["doc_id"]})

    def look_up(pdf: pd.DataFrame) -> pd.DataFrame:
        index = Index(read_file(f"{path}/index/{pdf['file'].iloc[0]}.idx"))
        found, rows = index.get(pdf["key"].to_numpy(np.int64).view(np.uint64))
        rows = rows[found]
        return pd.DataFrame({
            "doc_id": pdf["doc_id"].to_numpy()[found], "shard": rows["shard"].astype(np.int64),
            "offset": rows["offset"].astype(np.int64), "n": rows["n"].astype(np.int64),
        })

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        first, file, width = pdf["first_id"].iloc[0], pdf["file"].iloc[0], pdf["width"].iloc[0]
        ids = np.frombuffer(read_file(f"{path}/shards/{file}.ids", HEAD_SIZE), f"<u{width}")
        parts = [ids[a : a + n] for a, n in zip(pdf["offset"], pdf["n"])]
        out = pd.DataFrame({
            "doc_id": pdf["doc_id"], "start": first + pdf["offset"], "n_tokens": pdf["n"],
            "ids_crc32": [crc(p.astype("<u4").tobytes()) for p in parts],
        })
        if with_ids:
            out["ids"] = [p.astype(np.int32) for p in parts]
        return out

    buckets = spark.read.parquet(f"{path}/buckets")
    total = F.coalesce(F.lit(next((r["buckets"] for r in buckets.limit(1).collect()), 1)), F.lit(1)).cast("long")
    keys = wanted.mapInPandas(keyed, "key long, doc_id long").withColumn("bucket", F.pmod("key", total))
    places = keys.join(buckets.select("bucket", "file"), "bucket").groupBy("bucket").applyInPandas(
        look_up, "doc_id long, shard long, offset long, n long"
    )
    directory = spark.read.parquet(f"{path}/directory").select(F.col("shard").cast("long"), "file", "width", "first_id")
    rows = places.join(directory, "shard").groupBy("shard").applyInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    )
    return rows.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
