"""SimHash near-duplicates: fingerprints partitioned by vantage points, linked exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.graph import components
from tidepanel.llm.text import NO_ID, id_key, mix, row_hash, rows_of, words
from tidepanel.session import write_table

SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit i is 1 if it is set in over half of the shingles' hashes; 0 without words."""
    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = [0, *ends[:-1].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    ones, step = np.zeros(64, np.int64), 1 << 16
    for at in range(0, len(hashes), step):
        raw = np.array(hashes[at : at + step], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int) -> DataFrame:
    """(id, row, fp) of every document; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["id", "row", "fp"]
            )

    keyed = documents.select(id_key("doc_id").cast("long").alias("id"), row_hash("text").alias("row"), "text")
    return keyed.mapInArrow(run, "id long, row long, fp long")


# --- vantage points ------------------------------------------------------------------------

def _split(points: np.ndarray, bits: int) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that leave the least to compare on both sides.

    Points within the radius are inside, the others outside. Two points on different sides can
    be ``bits`` apart only if the inner one lies in the last ``bits`` shells, by the triangle
    bound; those shells go to both sides.
    """
    best, n = None, len(points)
    for vantage in points[:: max(1, n // 8)][:8]:
        shells = np.bincount(np.bitwise_count(points ^ vantage), minlength=65)
        inside = np.cumsum(shells)
        border = inside - np.concatenate([np.zeros(min(bits, 65), np.int64), inside[:-bits] if bits else inside])[:65]
        outside = n - inside + border
        cost = inside.astype(float) ** 2 + outside.astype(float) ** 2
        cost[inside == n] = np.inf
        radius = int(np.argmin(cost))
        if best is None or cost[radius] < best[0]:
            best = (cost[radius], vantage, radius)
    return (best[1], best[2]) if best[0] < 0.8 * float(n) ** 2 else None


def _sides(points: np.ndarray, split: tuple[np.uint64, int], bits: int) -> tuple[np.ndarray, np.ndarray]:
    away = np.bitwise_count(points ^ split[0]).astype(np.int64)
    return away <= split[1], away > split[1] - bits


def grow(points: np.ndarray, bits: int, leaf: int) -> list[tuple]:
    """A tree as a list of (vantage, radius, inside, outside); a negative child -k-1 is leaf k."""
    nodes: list[tuple] = []
    leaves = 0

    def build(own: np.ndarray) -> int:
        nonlocal leaves
        split = _split(own, bits) if len(own) > leaf else None
        if split is None:
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append(())
        inner, outer = _sides(own, split, bits)
        nodes[at] = (*split, build(own[inner]), build(own[outer]))
        return at

    build(points)
    return nodes


def route(nodes: list[tuple], points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, indices of the points that it gets)."""
    stack = [(0 if nodes else -1, np.arange(len(points)))]
    while stack:
        at, own = stack.pop()
        if not len(own):
            continue
        if at < 0:
            yield -at - 1, own
            continue
        vantage, radius, inside, outside = nodes[at]
        inner, outer = _sides(points[own], (vantage, radius), bits)
        stack += [(inside, own[inner]), (outside, own[outer])]


def local_links(points: np.ndarray, bits: int, small: int = 256) -> np.ndarray:
    """For each point the index of the first point that links of ``bits`` or fewer reach here."""
    label, buffer, held = np.arange(len(points)), [], 0

    def settle() -> None:
        nonlocal label, buffer, held
        if buffer:
            left, right = (np.concatenate(x) for x in zip(*buffer))
            while True:
                low = np.minimum(label[left], label[right])
                if (label[left] == low).all() and (label[right] == low).all():
                    break
                np.minimum.at(label, label[left], low)
                np.minimum.at(label, label[right], low)
                while (label[label] != label).any():
                    label = label[label]
        buffer, held = [], 0

    stack = [np.arange(len(points))]
    while stack:
        own = stack.pop()
        split = _split(points[own], bits) if len(own) > small else None
        if split is not None:
            inner, outer = _sides(points[own], split, bits)
            stack += [own[inner], own[outer]]
            continue
        for i in range(0, len(own), 1024):  # one block, unless no vantage point divides the points
            for j in range(i, len(own), 1024):
                a, b = own[i : i + 1024], own[j : j + 1024]
                near = np.bitwise_count(points[a][:, None] ^ points[b][None, :]) <= bits
                if i == j:
                    near = np.triu(near, 1)
                x, y = np.nonzero(near)
                if len(x):
                    buffer.append((a[x], b[y]))
                    held += len(x)
                if held > 2_000_000:
                    settle()
    settle()
    return label


# --- the operator --------------------------------------------------------------------------

def links(classes: DataFrame, bits: int, max_sample: int, leaf_rows: int) -> DataFrame:
    """(a, b): ids tied to the smallest id that they reach inside one leaf.

    ``classes`` (fp, id) has one row per fingerprint. The vantage points are fitted to a sample
    of at most about ``max_sample`` fingerprints chosen by hash; every fingerprint is routed.
    A leaf that is too large for a task gets a tree of its own (:func:`_divided`).
    """
    total = classes.count()
    share = min(1.0, max_sample / max(total, 1))
    chosen = classes.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = np.sort(np.array([r[0] for r in chosen.select("fp").limit(2 * max_sample).collect()], np.int64))
    nodes = grow(sample.view(np.uint64), bits, max(8, int(leaf_rows * share)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            points = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            for leaf, own in route(nodes, points, bits):
                yield pd.DataFrame({"leaf": np.int32(leaf), "fp": pdf["fp"].to_numpy()[own], "id": pdf["id"].to_numpy()[own]})

    routed = write_table(classes.mapInPandas(deal, "leaf int, fp long, id long"), "routed")
    dealt = _divided(routed.withColumn("leaf", F.col("leaf").cast("long")), bits, max_sample, leaf_rows)

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        label = local_links(pdf["fp"].to_numpy(np.int64).view(np.uint64), bits)
        tied = label != np.arange(len(label))
        return pd.DataFrame({"a": ids[tied], "b": ids[label[tied]]})

    return dealt.groupBy("leaf", "part").applyInPandas(link, "a long, b long")


PACK = 32_768  # fingerprints of a large leaf that are routed at once
ROUNDS = 16  # of trees in leaves; whatever is still too large goes to blocks


def _divided(routed: DataFrame, bits: int, max_sample: int, leaf_rows: int) -> DataFrame:
    """(leaf, part, fp, id): all leaves, none of more than 32 ``leaf_rows`` rows to a task.

    Each large leaf grows a tree from a sample of its own rows, one task a leaf; its rows are routed
    in packs, each joined with that tree, and what is still too large goes on to the next round. So
    the number of leaves grows with the rows, and their size does not. A leaf that no vantage point
    divides is dealt in blocks, each pair of blocks to a task.
    """
    most = 32 * leaf_rows
    settled, rounds = None, 0
    while True:
        sizes = write_table(routed.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > most), "large")
        if sizes.isEmpty():
            last = routed.withColumn("part", F.lit(0).cast("long"))
            return last if settled is None else settled.unionByName(last)
        small = routed.join(sizes, "leaf", "left_anti").withColumn("part", F.lit(0).cast("long"))
        large = routed.join(sizes, "leaf")
        trees = _trees(large, bits, max_sample, leaf_rows)
        divided = F.col("tree").isNotNull() & F.lit(rounds < ROUNDS)
        blocks = _blocks(large.join(trees.where(~divided).select("leaf"), "leaf", "left_semi"), most)
        done = small.unionByName(blocks)
        settled = done if settled is None else settled.unionByName(done)
        routed = write_table(_rerouted(large, trees.where(divided), bits), "routed")
        rounds += 1


def _trees(large: DataFrame, bits: int, max_sample: int, leaf_rows: int) -> DataFrame:
    """(leaf, tree) of large leaves (leaf, fp, id, n): vantage points fitted to some ``max_sample`` of a
    leaf's rows; null where no vantage point divides them."""
    share = F.least(F.lit(1.0), F.lit(float(max_sample)) / F.col("n"))
    sample = large.where(F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(1 << 30)) <= share * (1 << 30))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.sort(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
        nodes = grow(points, bits, max(8, int(leaf_rows * len(points) / pdf["n"].iloc[0])))
        tree = np.array([[v, r, i, o] for v, r, i, o in nodes], object) if nodes else None
        packed = None if tree is None else np.column_stack(
            [tree[:, 0].astype(np.uint64).view(np.int64), *[tree[:, k].astype(np.int64) for k in (1, 2, 3)]]).tobytes()
        return pd.DataFrame({"leaf": pdf["leaf"].iloc[:1], "tree": [packed]})

    fitted = sample.groupBy("leaf").applyInPandas(fit, "leaf long, tree binary")
    # A leaf so unlucky that the hash takes none of its rows is dealt in blocks.
    return write_table(large.select("leaf").distinct().join(fitted, "leaf", "left"), "trees")


def _rerouted(large: DataFrame, trees: DataFrame, bits: int) -> DataFrame:
    """(leaf, fp, id) of the rows of large leaves in the leaves of their trees."""
    pack = F.pmod(F.xxhash64("id", F.lit(11)), F.ceil(F.col("n") / PACK).cast("long"))
    packs = large.groupBy("leaf", pack.alias("pack")).agg(F.collect_list(F.struct("fp", "id")).alias("rows"))
    given = packs.join(trees, "leaf").select("leaf", F.col("rows.fp").alias("fp"), F.col("rows.id").alias("id"), "tree")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1):
            above = np.array(batch.column(0).to_numpy(), np.int64).view(np.uint64)
            fp, key = (batch.column(k).flatten().to_numpy() for k in (1, 2))
            table = np.frombuffer(batch.column(3)[0].as_py(), np.int64).reshape(-1, 4)
            nodes = [(np.int64(v).astype(np.uint64), r, i, o) for v, r, i, o in table.tolist()]
            for leaf, own in route(nodes, fp.view(np.uint64), bits):
                # Two leaves of one number would only be searched together.
                below = int(mix(above ^ mix(np.array([leaf], np.uint64), 2), 4).view(np.int64)[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), below)), pa.array(fp[own]), pa.array(key[own])], ["leaf", "fp", "id"])

    return given.mapInArrow(deal, "leaf long, fp long, id long")


def _blocks(stuck: DataFrame, most: int) -> DataFrame:
    """(leaf, part, fp, id): the rows of leaves that nothing divides once for each pair of their blocks."""
    count = F.ceil(F.col("n") / most).cast("long")
    rows = stuck.withColumn("own", F.pmod(F.xxhash64("id"), count)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    part = F.least("own", "other") * 1_000_003 + F.greatest("own", "other")
    return rows.select("leaf", part.alias("part"), "fp", "id")


def near_duplicates(
    documents: DataFrame, shingle: int = 3, bits: int = 2, max_sample: int = 20_000, leaf_rows: int = 8_192
) -> DataFrame:
    """(id, row, fp, component) per document: component is the smallest id that links reach.

    Two fingerprints link at ``bits`` or fewer differing bits; equal ones always do, so copies
    are one class from the first aggregate on and are never paired. Classes go to the leaves of
    a vantage-point tree; those near a boundary go to both sides, so each pair of linked classes
    meets in some leaf. A leaf hands on one tie per class, not its pairs.

    A text without words has fingerprint 0 and links like any other; a null doc_id counts as the
    smallest id (``NO_ID``); rows that repeat a doc_id are one document; an empty table gives no
    rows; other columns are ignored. A very long text is hashed whole, at some 40 bytes a word.
    """
    fps = write_table(fingerprints(documents, shingle), "fingerprints")
    classes = write_table(fps.groupBy("fp").agg(F.min("id").alias("id")), "classes")
    # Classes that share their smallest id (rows that repeat a doc_id) are tied by that id.
    repeated = fps.groupBy("id", "fp").agg(F.lit(1).alias("one")).groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    ties = fps.join(repeated, "id").join(classes.select("fp", F.col("id").alias("first")), "fp")
    ties = ties.select(F.col("id").alias("a"), F.col("first").alias("b")).where("a <> b")
    tied = components(links(classes, bits, max_sample, leaf_rows).unionByName(ties))
    classes = classes.join(tied.withColumnRenamed("node", "id"), "id", "left")
    classes = classes.select("fp", F.coalesce("component", "id").alias("component"))
    return fps.join(classes, "fp").select("id", "row", "fp", "component")


def keep_first(documents: DataFrame, **options) -> DataFrame:
    """The documents without near-duplicates: of each component the smallest doc_id stays.

    Rows that repeat that doc_id are reduced to one (the smallest text hash). Columns are kept.
    """
    return keep_found(documents, near_duplicates(documents, **options))


def keep_found(documents: DataFrame, found: DataFrame) -> DataFrame:
    """:func:`keep_first` for given components (id, row, component)."""
    found = found.where(F.col("id") == F.col("component"))
    first = found.groupBy("id").agg(F.min("row").alias("row"), F.count("*").alias("copies"))
    place = {c: f"column_{k}" for k, c in enumerate(documents.columns)}  # no clash with names used here
    whole = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in place.items()])
    whole = whole.withColumns({"id": id_key(place["doc_id"]).cast("long"), "row": row_hash(place["text"])})
    kept = whole.join(first.hint("shuffle_hash"), ["id", "row"])
    one = F.row_number().over(Window.partitionBy("id", "row").orderBy("copies"))
    again = kept.where(F.col("copies") > 1).withColumn("nth", one).where(F.col("nth") == 1).drop("nth")
    kept = kept.where(F.col("copies") == 1).unionByName(again)
    return kept.select(*[F.col(n).alias(c) for c, n in place.items()])


__all__ = ["NO_ID", "fingerprint", "keep_first", "keep_found", "near_duplicates"]
