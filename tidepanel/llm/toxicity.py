"""Toxicity by class-conditional Kneser-Ney models over words.

Each class has an interpolated bigram model whose unigrams are continuation counts (in how many
different contexts a word was seen) and which backs off to the continuation counts of both
classes together. An expression - a word, or a word after another - enters a comparison of the
classes only if its counts differ between them beyond chance; all rarer or neutral expressions
take the shared backoff in both models and cancel. So what scoring needs is one number for each
telling expression: the log of the ratio of its two probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import mix, rows_of
from tidepanel.session import write_table

START = 2  # stands before the first word

_words = re.compile(r"\w+").findall


def words(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def word_key(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))


SALTS = 8  # parts into which the pairs of a frequent word are dealt
BUFFER = 500_000  # pairs that a task reduces at once


def pair_counts(labelled: DataFrame) -> DataFrame:
    """(w, h, t, n): in how many toxic and ordinary texts word w follows word h, as hashes.

    The pairs of a word are dealt to ``SALTS`` places by the word before.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def drain() -> pa.RecordBatch:
            pairs = list(held[0].keys() | held[1].keys())
            keys = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            sums = [np.fromiter((c[p] for p in pairs), np.int32, len(pairs)) for c in held]
            for c in held:
                c.clear()
            order = np.lexsort((keys[:, 0], keys[:, 1]))  # words together, which shuffles smaller
            return pa.RecordBatch.from_arrays([pa.array(a[order]) for a in (keys[:, 1], keys[:, 0], *sums)], ["w", "h", "t", "n"])

        memo: dict[str, int] = {}
        for batch in rows_of(batches):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                for w in found:
                    if w not in memo:
                        memo[w] = word_key(w)
                keys = [memo[w] for w in found]
                held[0 if toxic else 1].update(set(zip([START, *keys], keys)))
            if len(memo) > 1_000_000:
                memo.clear()
            if len(held[0]) + len(held[1]) > 400_000:
                yield drain()
        yield drain()

    found = labelled.select("text", "toxic").mapInArrow(count, "w long, h long, t int, n int")
    dealt = found.withColumn("salt", F.pmod("h", F.lit(SALTS))).repartition("w", "salt")
    return dealt.groupBy("w", "salt", "h").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).drop("salt")


def expressions(pairs: DataFrame, least: int) -> DataFrame:
    """All counts of the models in one table, from one pass over the pairs.

    kind 1: word a, x1..x3 the contexts it follows in toxic, ordinary and any texts; kind 2:
    context a, x1 and x2 its occurrences and x3 and x4 its different words in either class;
    kind 3: word b after a, in ``least`` texts or more, x1 and x2 as counted. Kind 3 is written
    where it was counted; of the others sums move.
    """
    names = ["kind", "a", "b", "x1", "x2", "x3", "x4"]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def drain() -> Iterator[pa.RecordBatch]:
            w, h, t, n = (pa.chunked_array([b.column(i) for b in held]).to_numpy() for i in range(4))
            held.clear()
            toxic, plain, one = (t > 0).astype(np.int64), (n > 0).astype(np.int64), np.ones(len(t), np.int64)

            def batch(kind: int, a: np.ndarray, b: np.ndarray, *x: np.ndarray) -> pa.RecordBatch:
                columns = [np.full(len(a), kind, np.int32), a, b, *x, *[np.zeros(len(a), np.int64)] * (4 - len(x))]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

            for kind, key, cells in ((1, w, (toxic, plain, one)), (2, h, (t, n, toxic, plain))):
                order = np.argsort(key, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
                yield batch(kind, key[order][first], np.zeros(len(first), np.int64), *[np.add.reduceat(c[order], first) for c in cells])
            often = t + n >= least
            yield batch(3, h[often], w[often], t[often], n[often])

        for batch_ in batches:
            held.append(batch_)
            if sum(b.num_rows for b in held) >= BUFFER:
                yield from drain()
        if any(b.num_rows for b in held):
            yield from drain()

    schema = "kind int, a long, b long, x1 long, x2 long, x3 long, x4 long"
    parts = write_table(pairs.select("w", "h", "t", "n").mapInArrow(reduce, schema), "expression-parts")
    sums = parts.where("kind < 3").groupBy("kind", "a", "b").agg(*[F.sum(x).alias(x) for x in ("x1", "x2", "x3", "x4")])
    return write_table(sums, "expressions").unionByName(parts.where("kind = 3"))


def differs(t: Column, n: Column, all_t: float, all_n: float) -> Column:
    """The likelihood ratio statistic for t of all_t against n of all_n."""
    rate = (t + n) / (all_t + all_n)

    def part(k: Column, total: float) -> Column:
        k = k.cast("double")
        hit = F.when(k > 0, k * F.log(k / total / rate)).otherwise(0.0)
        return hit + F.when(k < total, (total - k) * F.log((1 - k / total) / (1 - rate))).otherwise(0.0)

    return 2 * (part(t, all_t) + part(n, all_n))


def ratios(counts: DataFrame, discount: float, chance: float, least: int) -> DataFrame:
    """(h, w, r): log P(w | h, toxic) - log P(w | h, ordinary) of the telling expressions; h null: any."""
    of = lambda kind: counts.where(F.col("kind") == kind)
    sums = of(1).agg(
        *[F.sum(x).alias(x) for x in ("x1", "x2", "x3")], F.count("*").alias("kinds"),
        *[F.sum(F.when(F.col(x) > 0, 1).otherwise(0)).alias(f"k{x}") for x in ("x1", "x2")],
    ).first()
    if not sums["x1"] or not sums["x2"]:
        return counts.select(F.col("a").alias("h"), F.col("a").alias("w"), F.lit(0.0).alias("r")).limit(0)
    both = of(2).agg(F.sum("x1").alias("x1"), F.sum("x2").alias("x2")).first()  # all pairs, rare ones too
    total, rest = (sums["x1"], sums["x2"]), [discount * sums[k] / sums[x] for k, x in (("kx1", "x1"), ("kx2", "x2"))]
    even = discount / sums["x3"]  # what the shared model leaves for each word, spread evenly
    shared = (F.col("x3") - discount) / sums["x3"] + even
    unigram = [F.greatest(F.col(x) - discount, F.lit(0.0)) / m + r * shared for x, m, r in zip(("x1", "x2"), total, rest)]
    telling = (F.col("x1") + F.col("x2") >= least) & (differs(F.col("x1"), F.col("x2"), *total) > chance)
    single = of(1).select(
        F.col("a").alias("w"), unigram[0].alias("p1"), unigram[1].alias("p2"),
        F.when(telling, F.log(unigram[0] / unigram[1])).alias("r"),
    )
    found = single.where(F.col("r").isNotNull()).select(F.lit(None).cast("long").alias("h"), "w", "r")
    if not both["x1"] or not both["x2"]:
        return found
    pair = of(3).where(differs(F.col("x1"), F.col("x2"), both["x1"], both["x2"]) > chance)
    pair = pair.select(F.col("a").alias("h"), F.col("b").alias("w"), F.col("x1").alias("c1"), F.col("x2").alias("c2"))
    pair = pair.join(of(2).withColumnRenamed("a", "h"), "h").join(single.withColumnRenamed("r", "single"), "w")

    def bigram(c: str, x: str, k: str, p: str) -> Column:
        own = F.greatest(F.col(c) - discount, F.lit(0.0)) / F.col(x) + discount * F.col(k) / F.col(x) * F.col(p)
        return F.when(F.col(x) > 0, own).otherwise(F.col(p))

    r = F.log(bigram("c1", "x1", "x3", "p1") / bigram("c2", "x2", "x4", "p2")) - F.coalesce("single", F.lit(0.0))
    return found.unionByName(pair.select("h", "w", r.alias("r")))


def told(texts: list[str | None], memo: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word of the texts the number of its text, its key and that of the word after the one
    before; and of each text the number of its different words, at least 1."""
    split = [words(t) for t in texts]
    for w in set().union(*split) - memo.keys():
        memo[w] = word_key(w)
    sizes = [len(ws) for ws in split]
    keys = np.fromiter((memo[w] for ws in split for w in ws), np.uint64, sum(sizes))
    before = np.concatenate([np.array([START], np.uint64), keys[:-1]]) if len(keys) else keys
    before[np.cumsum([0, *sizes[:-1]])[np.array(sizes) > 0] if sizes else []] = START
    many = np.array([max(1, len(set(ws))) for ws in split], np.int64)
    return np.repeat(np.arange(len(split)), sizes), keys, Model.pair(before, keys), many


class Model:
    """The telling expressions as sorted keys with ratios, and the weights of the score."""

    def __init__(self, h: np.ndarray, known: np.ndarray, w: np.ndarray, r: np.ndarray):
        keys = np.where(known, self.pair(h, w), w)
        at = np.argsort(keys)
        self.keys, self.ratios = keys[at], r[at].astype(np.float64)
        self.weight = np.array([-1.0, 0.0])
        self.memo: dict[str, int] = {}

    @classmethod
    def of(cls, found: DataFrame) -> Model:
        """From (h, w, r); a null h is told apart in Spark, where it can't turn the column into floats."""
        table = found.select(F.col("h").isNotNull().alias("known"), F.coalesce("h", F.lit(0).cast("long")).alias("h"), "w", "r").toPandas()
        h, w = (table[c].to_numpy(np.int64).view(np.uint64) for c in ("h", "w"))
        return cls(h, table["known"].to_numpy(bool), w, table["r"].to_numpy(float))

    @staticmethod
    def pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
        return mix(mix(h, 3) ^ w, 5)

    def features(self, texts: list[str | None], memo_words: int = 1_000_000) -> np.ndarray:
        """Per text the summed ratio of its different expressions by the root of its different words.

        Neutral words add noise that grows with the root of their number, so that texts of all
        lengths compare.
        """
        if len(self.memo) > memo_words:
            self.memo.clear()
        text, keys, pairs, many = told(texts, self.memo)
        sums = np.zeros(len(texts))
        for found in (keys, pairs):
            if len(self.keys) and len(found):
                at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
                hit = np.flatnonzero(self.keys[at] == found)
                once = np.unique(np.column_stack([text[hit], at[hit]]), axis=0)
                np.add.at(sums, once[:, 0], self.ratios[once[:, 1]])
        return (sums / np.sqrt(many))[:, None]

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = self.features(texts)
        return 1 / (1 + np.exp(-np.clip(self.weight[0] + x @ self.weight[1:], -30, 30)))


@dataclass
class StoredModel:
    """The telling expressions as a written table (key, r), where tasks can't be sent them all."""

    table: DataFrame
    weight: np.ndarray

    @classmethod
    def of(cls, found: DataFrame) -> StoredModel:
        def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known, h, w = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:3])
                keys = np.where(known, Model.pair(h.view(np.uint64), w.view(np.uint64)), w.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(3)], ["key", "r"])

        given = found.select(F.col("h").isNotNull(), F.coalesce("h", F.lit(0).cast("long")), "w", "r")
        return cls(write_table(given.mapInArrow(key, "key long, r double"), "telling-keys"), np.array([-1.0, 0.0]))

    def features(self, texts: DataFrame) -> DataFrame:
        """(mark, x) of the texts (mark, text) that hold a telling expression, as :meth:`Model.features`.

        ``mark`` is a digest of the text, so that copies are one text. Expressions meet the table by
        a shuffle of 30 bytes each; only those that it holds move on.
        """

        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo: dict[str, int] = {}
            for batch in rows_of(batches, 64):
                if len(memo) > 1_000_000:
                    memo.clear()
                text, keys, pairs, many = told(batch.column(1).to_pylist(), memo)
                once = np.unique(np.rec.fromarrays([np.concatenate([text, text]), np.concatenate([keys, pairs])]))
                of = once["f0"]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of)), pa.array(many[of]), pa.array(once["f1"].view(np.int64))], ["mark", "many", "key"]
                )

        hits = texts.mapInArrow(explode, "mark binary, many long, key long").join(self.table, "key")
        once = hits.groupBy("mark", "many", "key").agg(F.max("r").alias("r"))
        return once.groupBy("mark").agg((F.sum("r") / F.sqrt(F.max("many"))).alias("x"))

    def add(self, documents: DataFrame, x: str) -> DataFrame:
        """``documents`` with their feature ``x``; there is no other column named ``mark``."""
        marked = documents.withColumn("mark", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
        found = self.features(marked.select("mark", "text")).withColumnRenamed("x", x)
        return marked.join(found, "mark", "left").drop("mark").withColumn(x, F.coalesce(x, F.lit(0.0)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 60) -> np.ndarray:
    """Weights (constant first) by Newton steps on standardised columns."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += np.clip(step, -3, 3)
    return np.concatenate([[w[0] - (w[1:] * mean / scale).sum()], w[1:] / scale])


def fit(
    documents: DataFrame, labels: DataFrame, discount: float = 0.75, chance: float = 10.83, least: int = 3,
    max_calibration: int = 60_000, max_broadcast: int = 1_000_000, max_expressions: int = 2_000_000,
) -> Model | StoredModel:
    """Learn from the documents that ``labels`` (doc_id, toxic) marks; null labels and ids are passed over.

    By a hash of their text three quarters of the labelled documents are counted, all of them, and
    one calibrates the score. ``max_calibration`` bounds only the latter: if there are more labelled
    ids, that many, chosen by a hash of the id, give the quarter that calibrates. ``chance`` is the
    least likelihood ratio statistic (10.83: one in a thousand) and ``least`` the least number of
    texts or contexts of a telling expression. Up to ``max_broadcast`` labelled ids are sent to
    the texts; more are joined by a shuffle. Up to ``max_expressions`` telling expressions, of 16
    bytes, are sent to the tasks that score; more stay a table that texts are joined with. Repeated rows are texts of their own; very long texts
    are taken whole.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = write_table(known, "labels")
    share = min(1.0, max_calibration / max(1, known.count()))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) < int(share * (1 << 30))
    texts = documents.select("doc_id", "text")
    quarter = F.pmod(F.xxhash64(F.lit(5), F.coalesce("text", F.lit(""))), F.lit(4))
    # Labels go to the texts while they are few; else both meet by id.
    known = F.broadcast(known) if known.count() <= max_broadcast else known
    labelled = texts.where(quarter != 0).join(known, "doc_id").select("text", "toxic")
    calibrating = texts.where((quarter == 0) & chosen).join(known.where(chosen), "doc_id").select("text", "toxic")
    counts = expressions(pair_counts(labelled), least)
    found = write_table(ratios(counts, discount, chance, least), "telling")
    if found.count() > max_expressions:
        stored = StoredModel.of(found)
        held = stored.add(calibrating, "x").select("x", F.col("toxic").cast("double").alias("y")).toPandas()
        if held["y"].nunique() == 2:
            stored.weight = logistic(held[["x"]].to_numpy(), held["y"].to_numpy())
        return stored
    model = Model.of(found)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            x = sent.value.features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), batch.column(1).cast(pa.float64())], ["x", "y"])

    held = calibrating.mapInArrow(measure, "x double, y double").toPandas()
    if held["y"].nunique() == 2:
        model.weight = logistic(held[["x"]].to_numpy(), held["y"].to_numpy())
    model.memo = {}
    return model


def score(documents: DataFrame, model: Model | StoredModel) -> DataFrame:
    """All columns, and ``score`` (0 to 1, higher for toxic) and ``predicted`` (1 if score >= 0.5).

    The score is a logistic function of the text's length-normalised log likelihood ratio. A null
    or empty text has ratio 0 and the score of the constant; so has every text if a class was
    never seen. Repeated rows are scored each; a very long text is taken whole, at some 100 bytes a word.
    Former columns of these names are replaced; an empty table gives no rows. Nothing
    is shuffled, unless the model is stored as a table.
    """
    names = [c for c in documents.columns if c not in ("score", "predicted")]
    place = names.index("text")
    if isinstance(model, StoredModel):
        inner = ["text" if k == place else f"column_{k}" for k in range(len(names))]  # no clash with names used here
        scored = model.add(documents.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(names, inner)]), "x")
        sure = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(model.weight[0])) + F.col("x") * F.lit(float(model.weight[1]))))
        chance = 1 / (1 + F.exp(-sure))
        return scored.select(*[F.col(n).alias(c) for c, n in zip(names, inner)], chance.alias("score"), (chance >= 0.5).cast("int").alias("predicted"))
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            s = sent.value.score(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    kept = documents.select(*[F.col(f"`{c}`") for c in names])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, schema + ", score double, predicted int")
