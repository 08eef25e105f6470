"""Operator 2 against models computed from lists of word pairs."""

import re
from collections import Counter

import numpy as np
import pytest

from tidepanel.llm import toxicity

DISCOUNT, CHANCE, LEAST = 0.75, 10.83, 3


def brute_ratios(texts):
    """{(h or None, w): r} of the telling expressions; ``texts``: (text, toxic)."""
    pairs = [Counter(), Counter()]
    for text, toxic in texts:
        found = re.findall(r"\w+", text.lower())
        pairs[0 if toxic else 1].update(set(zip(["^", *found], found)))
    vocabulary = {w for c in pairs for _, w in c}
    contexts = [Counter(w for _, w in c) for c in pairs]
    anywhere = Counter(w for _, w in pairs[0].keys() | pairs[1].keys())
    after = [Counter(), Counter()]
    kinds = [Counter(h for h, _ in c) for c in pairs]
    for k, c in enumerate(pairs):
        for (h, _), n in c.items():
            after[k][h] += n
    totals, whole = [sum(c.values()) for c in contexts], sum(anywhere.values())

    def single(k, w):
        shared = (anywhere[w] - DISCOUNT) / whole + DISCOUNT / whole
        return max(contexts[k][w] - DISCOUNT, 0) / totals[k] + DISCOUNT * len(contexts[k]) / totals[k] * shared

    def double(k, h, w):
        if not after[k][h]:
            return single(k, w)
        return max(pairs[k][h, w] - DISCOUNT, 0) / after[k][h] + DISCOUNT * kinds[k][h] / after[k][h] * single(k, w)

    def differs(a, b, all_a, all_b):
        rate, out = (a + b) / (all_a + all_b), 0
        for x, n in ((a, all_a), (b, all_b)):
            out += (x * np.log(x / n / rate) if x else 0) + ((n - x) * np.log((1 - x / n) / (1 - rate)) if x < n else 0)
        return 2 * out

    found = {}
    for w in vocabulary:
        a, b = contexts[0][w], contexts[1][w]
        if a + b >= LEAST and differs(a, b, *totals) > CHANCE:
            found[None, w] = np.log(single(0, w) / single(1, w))
    sizes = [sum(c.values()) for c in pairs]
    for h, w in pairs[0].keys() | pairs[1].keys():
        a, b = pairs[0][h, w], pairs[1][h, w]
        if a + b >= LEAST and differs(a, b, *sizes) > CHANCE:
            found[h, w] = np.log(double(0, h, w) / double(1, h, w)) - found.get((None, w), 0)
    return found


def corpus():
    rng = np.random.default_rng(4)
    plain = [f"w{k}" for k in range(40)]
    rows = []
    for k in range(500):
        ws = list(rng.choice(plain, int(rng.integers(4, 40))))
        if k % 5 == 0:
            ws[2:2] = ["you", "are", rng.choice(["vile", "rotten"])]
            ws.append("vile")
        elif k % 7 == 0:
            ws[1:1] = ["you", "are", "kind"]
        rows.append((" ".join(ws), int(k % 5 == 0)))
    return rows


def key(word):
    return toxicity.START if word == "^" else toxicity.word_key(word)


@pytest.mark.parametrize("buffer", [500_000, 200])
def test_all_ratios_and_scores(spark, monkeypatch, buffer):
    monkeypatch.setattr(toxicity, "BUFFER", buffer)
    rows = corpus()
    df = spark.createDataFrame(rows, "text string, toxic int").repartition(5)
    counts = toxicity.expressions(toxicity.pair_counts(df), LEAST)
    found = toxicity.ratios(counts, DISCOUNT, CHANCE, LEAST)
    want = brute_ratios(rows)
    signed = lambda k: int(np.uint64(k).astype(np.int64))
    got = {(r["h"], r["w"]): r["r"] for r in found.collect()}
    named = {(None if h is None else signed(key(h)), signed(key(w))): r for (h, w), r in want.items()}
    assert len([k for k in want if k[0]]) >= 3 and len([k for k in want if not k[0]]) >= 1
    assert got.keys() == named.keys() and all(got[k] == pytest.approx(named[k], rel=1e-9) for k in got)

    model = toxicity.Model.of(found)
    for text in [*(t for t, _ in rows[:60]), "", None, "you are vile vile vile"]:
        found = re.findall(r"\w+", (text or "").lower())
        told = {(None, w) for w in found} | set(zip(["^", *found], found))
        x = sum(want.get(e, 0) for e in told) / np.sqrt(max(1, len(set(found))))
        assert model.features([text])[0, 0] == pytest.approx(x, rel=1e-9, abs=1e-12)


def test_labels_by_broadcast_and_by_join_agree(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(corpus())]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    a, b = (toxicity.fit(docs, labels, max_broadcast=n) for n in (10**6, 0))
    assert (a.keys == b.keys).all() and np.allclose(a.ratios, b.ratios) and np.allclose(a.weight, b.weight)


def test_expressions_sent_and_joined_agree(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(corpus())]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    sent, stored = (toxicity.fit(docs, labels, max_expressions=n) for n in (10**6, 0))
    assert isinstance(stored, toxicity.StoredModel) and np.allclose(sent.weight, stored.weight)
    odd = [(None, None), (7, ""), (8, "you are vile"), (8, "you are vile"), (9, "you are vile " * 20_000), (9, "...")]
    mixed = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    for table in (mixed.selectExpr("doc_id", "text", "1 AS mark", "2 AS x", "'old' AS score"), docs.limit(0)):
        a, b = (toxicity.score(table, m) for m in (sent, stored))
        assert a.dtypes == b.dtypes
        a, b = (sorted(map(tuple, df.select("doc_id", "text", "predicted", "score").fillna({"doc_id": -1, "text": ""}).collect())) for df in (a, b))
        assert [r[:3] for r in a] == [r[:3] for r in b] and np.allclose([r[3] for r in a], [r[3] for r in b])


def test_no_expression_is_told(spark):
    """One class only: the table of expressions is empty, both ways."""
    docs = spark.createDataFrame([(i, f"w{i} fine") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")
    for most in (10, -1):
        got = toxicity.score(docs, toxicity.fit(docs, labels, max_expressions=most))
        assert got.where("predicted = 0").count() == 20
