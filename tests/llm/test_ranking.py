"""Operator 12 against the scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.llm import ranking
from tidepanel.llm.text import NO_ID
from tests.llm.test_operators import HOSTILE, SCHEMA

UPPER = {c: c + 32 for c in range(65, 91)}


def brute_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items, k):
    held = [(i, Counter(brute_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        asked, scores = Counter(brute_terms(text)), []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if score > 0:
                scores.append((-score, NO_ID if i is None else i))
        out += [(item, place + 1, None if i == NO_ID else i, -s) for place, (s, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def found(docs, items, **options):
    return Counter(tuple(r) for r in ranking.search(docs, items, **options).collect())


def text(rng, size, words=60):
    return " ".join(f"w{int(rng.expovariate(0.08)) % words}" for _ in range(size))


def tables(spark, docs, items, parts=5):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(parts), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("blocks", [4_000_000, 200])
def test_all_scores_over_small_trees(spark, monkeypatch, blocks):
    rng = random.Random(3)
    docs = [(i, text(rng, rng.choice([0, 3, 20, 80]))) for i in range(700)]
    docs += [(i + 1000, docs[5][1]) for i in range(150)]  # a hot text, and ties by doc_id
    items = [(i, text(rng, rng.choice([1, 4, 12]))) for i in range(30)] + [(40, "Unknown terms"), (41, None), (42, "w0 w0 W0"), (42, "w1"), (42, "w1")]
    given = tables(spark, docs, items)
    assert found(*given, k=5, block_chars=blocks, task_rows=300) == brute(docs, items, 5)


def test_search_in_the_process(monkeypatch):
    """Small leaves, trees and steps; every item against every document, with exact and wide numbers."""
    rng = random.Random(5)
    monkeypatch.setattr(ranking, "LEAF", 3)
    monkeypatch.setattr(ranking, "ITEM_STEP", 4)
    docs = [(i, text(rng, rng.choice([1, 8, 30]), 25)) for i in range(400)]
    items = [(i, text(rng, 5, 25)) for i in range(11)]
    texts = [ranking.terms(t) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted({t for ts in texts for t in ts}))}
    held = [(i, Counter(t for t in ranking.terms(t) if t in vocabulary), len(ranking.terms(t))) for i, t in docs]
    df = Counter(vocabulary[t] for _, c, _ in held for t in c)
    for kind in (np.float64, np.int64):
        own = ranking.Items(texts, vocabulary, df, len(docs), sum(n for *_, n in held))
        own.kind = kind
        best = ranking.Best(own, 7)
        for at in range(0, 400, 130):
            part = held[at : at + 130]
            paths = [sorted((own.rank[vocabulary[t]], n) for t, n in c.items()) for _, c, _ in part]
            ends = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
            flat = np.array([x for p in paths for x in p], np.int64).reshape(-1, 2)
            m = np.array([75 + 25 * n * own.docs // own.total for *_, n in part])
            ranking.Tree(own, np.array([i for i, *_ in part]), m, ends, flat[:, 0], flat[:, 1]).search(best)
        got = Counter((items[i][0], place + 1, d, -s) for i, rows in enumerate(best.rows) for place, (s, d) in enumerate(rows))
        assert got == brute(docs, items, 7)


def test_bounds_are_never_below_a_score():
    tf, m = np.arange(1, 2000), np.arange(75, 2074)
    assert (np.diff(ranking.saturation(tf, np.full(len(tf), 90))) >= 0).all() and (np.diff(ranking.saturation(np.full(len(m), 7), m)) <= 0).all()
    assert ranking.saturation(np.array([2**31]), np.array([75]))[0] < 1_000_000


def test_search_of_hostile_rows(spark):
    docs = spark.createDataFrame(HOSTILE, SCHEMA).withColumns({"terms": F.lit(1), "score": F.lit("x"), "rank": F.lit(2)})
    items = [(1, "one line ünïcode 語"), (None, "alpha beta"), (3, None), (4, ""), (5, "...")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = brute([(r[0], r[1]) for r in HOSTILE], [(i, t) for i, t in items if t], 20)
    assert found(docs, asked) == want
    assert found(docs.limit(0), asked) == found(docs, asked.limit(0)) == Counter()
