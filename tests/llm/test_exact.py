"""Operator 11 against dictionaries of whole texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import exact
from tidepanel.llm.text import NO_ID, SPACES
from tests.llm.test_operators import HOSTILE, SCHEMA


def bare(text):
    return (text or "").translate({ord(c): None for c in SPACES})


def brute(rows):
    """{(doc_id, text): {(keep_id, size)}} and the number of rows that stay."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(bare(text), []).append((-len(text or ""), NO_ID if doc_id is None else doc_id))
    return sorted((i, min(g)[1], len(g), hashlib.sha256(t.encode()).digest()) for t, g in groups.items() for _, i in g), len(groups)


def read(index):
    got = exact.groups(index).collect()
    return sorted((r["id"], r["keep_id"], r["group_size"], bytes(r["digest"])) for r in got), sum(r["kept"] for r in got)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def some_rows(n, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["a b", "ab", "a  b\n", "", None, f"text {rng.randrange(n // 3)}", f"text\t{rng.randrange(n // 3)} "])) for i in range(n)]


def test_filter_holds_what_was_added_and_not_removed():
    own, keys = exact.CuckooFilter(256), [hashlib.sha256(str(i).encode()).digest() for i in range(900)]
    assert all(own.add(k) for k in keys)  # 88 % full
    assert all(own.holds(k) for k in keys)
    for k in keys[:450]:
        own.remove(k)
    assert all(own.holds(k) for k in keys[450:])
    assert sum(own.holds(k) for k in keys[:450]) < 5
    with pytest.raises(KeyError):
        for k in keys[:450]:
            own.remove(k)
    small = exact.CuckooFilter(64)
    assert not all(small.add(k) for k in keys)  # overflow is told


@pytest.mark.parametrize(("shard_keys", "bits"), [(100_000, 16), (20, 16), (50, 4)])
def test_groups_against_whole_texts(spark, shard_keys, bits):
    rows = some_rows(2400)
    index = exact.insert(frame(spark, rows), shard_keys=shard_keys, bits=bits)
    assert read(index) == brute(rows)
    sums = index.state.where(F.col("kind") == exact.FILTER).agg(F.sum("misled").alias("m"), F.max("buckets").alias("b")).first()
    assert (index.shards > 1) == (shard_keys < 2400)
    assert shard_keys < 2400 or sums["b"] > 64  # the filter has overflowed and was built again
    assert bits == 16 or sums["m"] > 0  # hits of other digests were found out


def test_insert_and_delete_in_batches(spark):
    first, second = some_rows(300), [(i + 300, t) for i, t in some_rows(500, seed=2)]
    index = exact.insert(frame(spark, first), shard_keys=100)
    index = exact.insert(frame(spark, second), index, shard_keys=100)  # the shards are dealt anew
    assert read(index) == brute(first + second)
    gone = {i for i, _ in first + second if i % 3 == 0} | {10**6}
    index = exact.delete(index, frame(spark, [(i, "") for i in gone]))
    left = [(i, t) for i, t in first + second if i not in gone]
    assert read(index) == brute(left)
    index = exact.insert(frame(spark, first[:50]), index, shard_keys=100)
    assert read(index) == brute(left + first[:50])
    none = exact.delete(index, frame(spark, left + first))
    assert read(none) == ([], 0) and none.state.where(F.col("kind") == exact.ENTRY).count() == 0
    assert read(exact.insert(frame(spark, second), none, shard_keys=100)) == brute(second)


def test_exact_duplicates_of_hostile_rows(spark):
    docs = spark.createDataFrame(HOSTILE, SCHEMA).repartition(3)
    assert read(exact.insert(docs)) == brute([(r[0], r[1]) for r in HOSTILE])
    assert read(exact.insert(docs.limit(0))) == ([], 0)
    assert exact.exact_duplicates(docs.withColumns({"digest": F.lit("x"), "block": F.lit(1), "kept": F.lit(0), "n": F.lit(0)})).count() == len(HOSTILE)
