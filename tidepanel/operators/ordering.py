"""Positions, ranks and neighbours over a total order, without a single-task sort.

``Window.orderBy`` without a partition moves the whole table into one task, and
``Window.partitionBy(entity)`` moves one entity there. Both are replaced by one idea:

1. *Layout.* The rows are range-partitioned on the full sort key and sorted inside each
   partition (Spark samples the key, so a hot entity or value spreads over many
   partitions). The table is written with its partition number and slot, which pins both.
2. *Directory.* One row per partition (and entity) with its row count; a running sum over
   this small table turns slots into positions.
3. *Chunks.* Row frames of a fixed length need only the rows just before a chunk: those
   are copied into the chunk, used by the window and dropped again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import write_table
from tidepanel.spec import PanelSpec

BUCKET, SLOT = "_bucket", "_slot"
_FIRST = (Window.unboundedPreceding, -1)
BUCKET_BYTES = 64_000_000  # of the tables read, for each bucket of a layout
CHUNK_ROWS = 50_000  # rows of an entity per window; far more than any halo, few enough to sort in memory


def bucket_count(df: DataFrame) -> int:
    """The session's shuffle partitions, or more where the tables that ``df`` reads are larger than
    ``BUCKET_BYTES`` for each of them. Sources of unknown size don't count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [float(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(s for s in sizes if s < 2.0**60)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(read // BUCKET_BYTES))


def range_layout(df: DataFrame, keys: Sequence[str | Column], buckets: int | None = None) -> DataFrame:
    """``df`` written in the order of ``keys`` with its partition number and slot."""
    n = buckets or bucket_count(df)
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    numbered = ordered.withColumn(SLOT, F.monotonically_increasing_id())
    # The id holds the partition number above bit 33 and the row number below.
    return write_table(
        numbered.withColumn(BUCKET, F.shiftright(SLOT, 33).cast("int"))
        .withColumn(SLOT, F.col(SLOT).bitwiseAND(F.lit((1 << 33) - 1))),
        "layout",
    )


def with_row_index(
    df: DataFrame, keys: Sequence[str | Column], name: str = "row_index", buckets: int | None = None
) -> DataFrame:
    """Number the rows 0, 1, 2, … in the order of ``keys`` (make it a total order)."""
    laid = range_layout(df, keys, buckets)
    sizes = laid.groupBy(BUCKET).agg(F.count("*").alias("_n"))
    # At most one row per partition of the layout, so the global window is tiny.
    before = F.sum("_n").over(Window.orderBy(BUCKET).rowsBetween(*_FIRST))
    starts = sizes.select(BUCKET, F.coalesce(before, F.lit(0)).alias("_start"))
    return (
        laid.join(F.broadcast(starts), BUCKET)
        .withColumn(name, F.col("_start") + F.col(SLOT))
        .drop(BUCKET, SLOT, "_start")
    )


def with_entity_index(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str | Column],
    name: str = "entity_index",
    size: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Number the rows of every entity 0, 1, 2, … and, with ``size``, add its row count.

    Rows with a null entity drop.
    """
    laid = range_layout(df, [*entity, *order], buckets)
    runs = laid.groupBy(*entity, BUCKET).agg(
        F.count("*").alias("_n"), F.min(SLOT).alias("_first")
    )
    each = Window.partitionBy(*entity)
    before = F.sum("_n").over(each.orderBy(BUCKET).rowsBetween(*_FIRST))
    starts = runs.select(
        *entity, BUCKET, "_first", F.coalesce(before, F.lit(0)).alias("_prior"),
        *([F.sum("_n").over(each).alias(size)] if size else []),
    )
    return (
        laid.join(starts, [*entity, BUCKET])
        .withColumn(name, F.col("_prior") + F.col(SLOT) - F.col("_first"))
        .drop(BUCKET, SLOT, "_first", "_prior")
    )


def with_place(df: DataFrame, spec: PanelSpec, name: str = "place", size: str = "n") -> DataFrame:
    """Position of a row in its entity and the entity's size, at either grain."""
    order = [spec.ts, *spec.tie_break]
    if not spec.hourly:
        return with_entity_index(df, [spec.entity], order, name, size)
    each = Window.partitionBy(spec.entity)
    place = (F.row_number().over(each.orderBy(*order)) - 1).cast("long")
    return df.select("*", place.alias(name), F.count("*").over(each).alias(size))


def value_ladder(
    df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """Distinct values of every key with their count and the rows below them.

    Columns: keys, value, ``n_at``, ``below`` (rows with a smaller value), ``dense``
    (distinct smaller values) and ``total`` (rows of the key). Values are counted before
    anything is ordered, so a value that fills a third of the table is one row here.
    """
    rows = F.count("*") if weight is None else F.sum(weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(rows.alias("n_at"))
    laid = range_layout(counts, [*keys, value])
    blocks = laid.groupBy(*keys, BUCKET).agg(
        F.sum("n_at").alias("_n"), F.count("*").alias("_d"), F.min(SLOT).alias("_first")
    )
    each = Window.partitionBy(*keys)
    earlier = each.orderBy(BUCKET).rowsBetween(*_FIRST)
    starts = blocks.select(
        *keys, BUCKET, "_first", F.sum("_n").over(each).alias("total"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_d").over(earlier), F.lit(0)).alias("_d_before"),
    )
    inside = Window.partitionBy(*keys, BUCKET).orderBy(value).rowsBetween(*_FIRST)
    return laid.join(starts, [*keys, BUCKET]).select(
        *keys, value, "n_at",
        (F.col("_n_before") + F.coalesce(F.sum("n_at").over(inside), F.lit(0))).alias("below"),
        (F.col("_d_before") + F.col(SLOT) - F.col("_first")).alias("dense"),
        "total",
    )


def average_rank() -> Column:
    """Rank of a ladder value, ties sharing their mean rank."""
    return F.col("below") + (F.col("n_at") + 1) / F.lit(2.0)


def quantiles(ladder: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles per key, linear between the two neighbouring rows."""
    rung = ladder.withColumnRenamed("total", "n")
    picks = []
    for name, p in probs.items():
        place = (F.col("n") - 1) * F.lit(p)
        for side, position in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("below") <= position) & (position < F.col("below") + F.col("n_at"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{side}"))
    found = rung.groupBy(*keys, "n").agg(*picks)
    out = []
    for name, p in probs.items():
        place = (F.col("n") - 1) * F.lit(p)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*keys, "n", *out)


def with_chunks(
    df: DataFrame, index: str, halo: int, chunk_rows: int, after: bool = False
) -> DataFrame:
    """Cut a numbered table into chunks; copy ``halo`` rows into the neighbouring chunk.

    Adds ``_chunk`` and ``_copy``. The copies are the rows before each chunk, or with
    ``after`` the rows behind it. ``chunk_rows`` is raised to ``halo`` when smaller, so
    that one neighbour always suffices.
    """
    size = max(chunk_rows, halo, 1)
    chunk = F.floor(F.col(index) / size)
    offset = F.col(index) % size
    if after:
        lend, target = (offset < halo) & (chunk > 0), chunk - 1
    else:
        lend, target = offset >= size - halo, chunk + 1
    own = F.struct(chunk.alias("_chunk"), F.lit(False).alias("_copy"))
    lent = F.struct(target.alias("_chunk"), F.lit(True).alias("_copy"))
    homes = F.when(lend, F.array(own, lent)).otherwise(F.array(own))
    return df.withColumn("_home", F.explode(homes)).select(*df.columns, "_home.*")


def with_neighbours(
    df: DataFrame,
    spec: PanelSpec,
    halo: int,
    stages: Callable[[Window], list[dict[str, Column] | Callable[[DataFrame, list[str], str], DataFrame]]],
    chunk_rows: int = CHUNK_ROWS,
    table_order: Sequence[str] | None = None,
    place: str | None = None,
) -> DataFrame:
    """Add window columns that look back at most ``halo`` rows.

    ``stages`` gets the window and returns the columns to add, step by step, or functions of
    the table, the columns that part its rows and the number of a row among them; columns
    whose name starts with two underscores are helpers and dropped at the end.

    The frames stay inside an entity. An hourly panel uses one window per entity, whose
    size is bounded by the period; at event grain each entity is numbered, cut into chunks
    and the window runs per chunk. With ``table_order`` the frames run over the whole
    table in that order, across entities, again chunk by chunk. ``place`` names the column
    of :func:`with_place` when the rows are numbered already.
    """
    order = [spec.ts, *spec.tie_break]
    if table_order is None and spec.hourly:
        index, part, window = "__index", [spec.entity], Window.partitionBy(spec.entity).orderBy(*order)
        wide = df
    else:
        index, part = place or "__index", [spec.entity] if table_order is None else []
        if place is not None:
            numbered = df
        elif table_order is None:
            numbered = with_entity_index(df, part, order, index)
        else:
            numbered = with_row_index(df, table_order, index)
        wide = with_chunks(numbered, index, halo, chunk_rows)
        part = [*part, "_chunk"]
        window = Window.partitionBy(*part).orderBy(index)
    steps = stages(window)
    if index not in wide.columns and any(map(callable, steps)):
        wide = wide.withColumn(index, (F.row_number().over(window) - 1).cast("long"))
    for added in steps:
        if callable(added):
            wide = added(wide, part, index)
            continue
        wide = wide.select("*", *[c.alias(n) for n, c in added.items()])
    if "_copy" in wide.columns:
        wide = wide.where(~F.col("_copy")).drop("_chunk", "_copy")
    return wide.drop(*[c for c in wide.columns if c.startswith("__")])


def interpolate(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Fill nulls linearly by row position inside each entity.

    Leading and trailing nulls take the nearest value; a column that is null throughout an
    entity stays null.
    """
    order = [spec.ts, *spec.tie_break]
    if spec.hourly:
        w = Window.partitionBy(spec.entity).orderBy(*order)
        numbered = df.withColumn("_index", F.row_number().over(w))
        part = [spec.entity]
    else:
        numbered = with_entity_index(df, [spec.entity], order, "_index")
        numbered = numbered.withColumn("_chunk", F.floor(F.col("_index") / chunk_rows))
        part = [spec.entity, "_chunk"]
    # Looking ahead is looking back in falling order: Spark re-reads the rest of the
    # partition for every row of a frame that ends at its end.
    upto = (Window.unboundedPreceding, 0)
    back = Window.partitionBy(*part).orderBy("_index").rowsBetween(*upto)
    ahead = Window.partitionBy(*part).orderBy(F.desc("_index")).rowsBetween(*upto)
    points = {c: F.when(F.col(c).isNotNull(), F.struct("_index", F.col(c).alias("v"))) for c in columns}
    wide = numbered.select(
        "*",
        *[F.last(p, True).over(back).alias(f"_prev_{c}") for c, p in points.items()],
        *[F.last(p, True).over(ahead).alias(f"_next_{c}") for c, p in points.items()],
    )
    if not spec.hourly:
        # The nearest value may lie any number of chunks away: carry it through a table
        # with one row per chunk.
        here = {c: F.when(F.col(c).isNotNull(), F.col("_index")) for c in columns}
        edges = numbered.groupBy(*part).agg(
            *[F.max(at).alias(f"_li_{c}") for c, at in here.items()],
            *[F.max_by(F.col(c), at).alias(f"_lv_{c}") for c, at in here.items()],
            *[F.min(at).alias(f"_fi_{c}") for c, at in here.items()],
            *[F.min_by(F.col(c), at).alias(f"_fv_{c}") for c, at in here.items()],
        )

        def point(c: str, side: str) -> Column:
            index, value = F.col(f"_{side}i_{c}"), F.col(f"_{side}v_{c}")
            return F.when(index.isNotNull(), F.struct(index.alias("_index"), value.alias("v")))

        by_entity = Window.partitionBy(spec.entity)
        before = by_entity.orderBy("_chunk").rowsBetween(*_FIRST)
        behind = by_entity.orderBy(F.desc("_chunk")).rowsBetween(*_FIRST)
        carried = edges.select(
            *part,
            *[F.last(point(c, "l"), True).over(before).alias(f"_b_{c}") for c in columns],
            *[F.last(point(c, "f"), True).over(behind).alias(f"_a_{c}") for c in columns],
        )
        wide = wide.join(carried, part)
        for c in columns:
            wide = wide.withColumn(f"_prev_{c}", F.coalesce(f"_prev_{c}", f"_b_{c}"))
            wide = wide.withColumn(f"_next_{c}", F.coalesce(f"_next_{c}", f"_a_{c}"))
    filled = {}
    for c in columns:
        prev, nxt = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        step = F.try_divide(F.col("_index") - prev["_index"], nxt["_index"] - prev["_index"])
        between = prev["v"] + (nxt["v"] - prev["v"]) * step
        filled[c] = F.coalesce(F.col(c), between, prev["v"], nxt["v"])
    return wide.withColumns(filled).select(*df.columns)


def chronological_split(
    df: DataFrame, order: Sequence[str], fraction: float = 0.8, name: str = "split"
) -> DataFrame:
    """Label the first ``int(fraction * n)`` rows in ``order`` train and the rest test.

    Rows are counted per value of the first key; only those of the value in which the cut
    falls are put in order. The table itself is neither shuffled nor written: each row is
    compared with the last key of the training part. Nulls of a key come first.
    """
    key, rest = order[0], list(order[1:])
    sizes = df.agg(F.count("*").alias("n"), F.count(key).alias("known")).first()
    cut = int(float(sizes["n"]) * fraction) - (sizes["n"] - sizes["known"])  # as a float multiplication gives it
    if cut <= 0 and sizes["n"] != sizes["known"]:
        here, inside, before = F.col(key).isNull(), cut + sizes["n"] - sizes["known"], F.lit(False)
    else:
        rungs = value_ladder(df.select(key), [], key)
        rung = rungs.where((F.col("below") <= cut) & (F.lit(cut) < F.col("below") + F.col("n_at"))).first()
        if rung is None:  # all rows or none
            return df.withColumn(name, F.lit("train" if cut > 0 else "test"))
        at = F.lit(rung[key]).cast(df.schema[key].dataType)
        here, inside, before = F.col(key) == at, cut - rung["below"], F.col(key).isNull() | (F.col(key) < at)
    early = F.lit(False)
    if inside > 0 and rest:
        last = with_row_index(df.where(here).select(*rest), rest).where(F.col("row_index") == inside - 1).first()
        early, same = F.lit(False), F.lit(True)
        for c in rest:
            mark = F.lit(last[c]).cast(df.schema[c].dataType)
            less = F.col(c).isNull() if last[c] is None else F.col(c).isNull() | (F.col(c) < mark)
            early = early | (same & (F.lit(False) if last[c] is None else less))
            same = same & F.col(c).eqNullSafe(mark)
        early = early | same
    first = F.coalesce(before, F.lit(False)) | (F.coalesce(here, F.lit(False)) & early)
    return df.withColumn(name, F.when(first, "train").otherwise("test"))


def hash_sample(df: DataFrame, keys: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(k, n)`` rows, drawn without replacement and repeatable.

    The rows with the k smallest hashes of their key: a top-k, so each task keeps k rows.
    """
    return df.orderBy(_draw(keys, seed), *keys).limit(k)


def hash_sample_by(df: DataFrame, group: Sequence[str], keys: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """``min(k, n)`` rows of every group, those with the smallest hashes of their keys.

    Groups are counted; a threshold on the hash leaves a little over k rows of each, and only
    these move to be put in order. A group that the threshold leaves with too few rows, which
    a few in a million do, is taken whole. A null in ``group`` is a value.
    """
    at = [f"_g{i}" for i in range(len(group))]
    named = dict(zip(group, at))
    sizes = write_table(df.groupBy(*[F.col(g).alias(a) for g, a in named.items()]).agg(F.count("*").alias("_n")), "group-sizes")
    wanted = k + 5 * math.sqrt(k) + 15
    # Hashes are hexadecimal texts: twelve digits tell the share of them that lie below.
    share = F.least(F.lit(wanted) / F.col("_n"), F.lit(1.0))
    limit = F.when(share < 1, F.lpad(F.hex(F.floor(share * float(16**12)).cast("long")), 12, "0"))
    drawn = df.withColumn("_draw", _draw(keys, seed))
    same = lambda other: _all(drawn[g].eqNullSafe(other[a]) for g, a in named.items())
    bound = sizes.select(*at, F.lower(limit).alias("_limit"))
    few = drawn.join(bound, same(bound)).where(F.col("_limit").isNull() | (F.col("_draw") < F.col("_limit"))).drop("_limit")
    few = write_table(few, "candidates")
    left = few.groupBy(*at).agg(F.count("*").alias("_c"))
    lacking = sizes.join(left, _all(sizes[a].eqNullSafe(left[a]) for a in at), "left")
    lacking = lacking.where(F.coalesce("_c", F.lit(0)) < F.least("_n", F.lit(k))).select(*[sizes[a] for a in at])
    lacking = write_table(lacking, "lacking")
    if lacking.limit(1).count():
        enough = few.join(lacking, _all(few[a].eqNullSafe(lacking[a]) for a in at), "left_anti")
        few = enough.unionByName(drawn.join(lacking, same(lacking)))
    order = Window.partitionBy(*at).orderBy(F.col("_draw"), *[F.col(c) for c in keys])
    placed = few.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
    return placed.drop("_draw", "_place", *at)


def _all(conditions: Iterable[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _draw(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys]))
