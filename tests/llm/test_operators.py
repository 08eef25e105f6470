"""Each operator against a brute-force version, and on the cases that its docstring defines."""

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidepanel.llm import chat, decontaminate, language, lines, packing, quality, queries, simhash, tokenfile, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, row long, fp string, pos int, words string"
LONG = "alpha beta gamma " * 60_000

# Nulls in every column, empty and very long texts, ties, repeated rows; columns with clashing names.
HOSTILE = [
    (1, "One line here\nsecond line there\n\nOne line here", "en", "a", 3, "x", 1, "f", 1, "w"),
    (2, "one LINE here  \nsecond line there", "en", "a", 3, None, 1, "f", 1, "w"),
    (2, "one LINE here  \nsecond line there", "en", "a", 3, None, 1, "f", 1, "w"),
    (3, None, None, None, None, None, None, None, None, None),
    (None, "text without an id <|im_end|>", "fr", None, 1, "", 0, "", 0, ""),
    (None, None, None, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, "x", 1, "f", 1, "w"),
    (5, " \t\n\r\x0b", "en", "b", 0, "x", 1, "f", 1, "w"),
    (6, LONG, "en", "b", len(LONG), "x", 1, "f", 1, "w"),
    (7, "Ünïcode ŒUVRE straße\nıİ 語 12 <\\|x|>", "de", "b", 3, "x", 1, "f", 1, "w"),
]


@pytest.fixture(scope="module")
def hostile(spark):
    return spark.createDataFrame(HOSTILE, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text, lang FROM documents").fetchall()


def ids_of(text, end):
    from tokenizers import Tokenizer

    if not hasattr(ids_of, "t"):
        ids_of.t = Tokenizer.from_file(queries.tokenizer_path())
    return ids_of.t.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# --- 1 chat ----------------------------------------------------------------------------------

def brute_paths(rows):
    """{tree: (score, path)} of the best root-to-leaf path."""
    out = {}
    for tree in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in own.values()}
        best = None
        for node in own:
            if node in parents:
                continue
            path, at, seen = [], node, set()
            while at in own and at not in seen:
                seen.add(at)
                path.append(at)
                at = own[at][2]
            if at in seen:
                continue
            key = (sum(own[n][5] or 0 for n in path), len(path), -node)
            if best is None or key > best[0]:
                best = (key, path[::-1])
        if best:
            out[tree] = best[1]
    return out


def test_best_paths_of_reply_trees(spark):
    rng = np.random.default_rng(3)
    rows = []
    for tree in range(6):
        for node in range(1, 40):
            parent = None if node == 1 else int(rng.integers(max(1, node - 4), node))
            rows.append((tree, node, parent, "assistant" if node % 2 else "user", f"t{tree} <|im_end|> n{node}\n%0A", float(rng.integers(-3, 5))))
    rows += [(9, 1, 2, "user", "circle", 1.0), (9, 2, 1, "user", "circle", 1.0), (9, 3, None, None, None, None)]
    rows += [(10, k, k - 1 if k else None, "a\n<|im_start|>%0A", str(k), 0.0) for k in range(300)]
    df = spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, role string, text string, score double")
    got = chat.read_turns(chat.format_trees(df.repartition(5))).toPandas()
    want = brute_paths(rows)
    texts = {(r[0], r[1]): (r[3] or "", r[4] or "") for r in rows}
    assert set(got["tree_id"]) == set(want)
    for r in got.itertuples():
        path = [texts[r.tree_id, n] for n in want[r.tree_id]]
        assert [(t["role"], t["text"]) for t in r.turns] == path
        assert r.learned == "".join(t for role, t in path if role == "assistant")
        assert r.formatted.count("<|im_start|>") == len(path) == r.formatted.count("<|im_end|>")
    two = chat.format_trees(df, top=2).groupBy("tree_id").count().toPandas().set_index("tree_id")["count"]
    assert two[10] == 1 and two[0] == 2


def test_conversations_with_nulls_repeats_and_no_rows(spark):
    schema = "tree_id long, turn long, role string, text string, t string, pos int"
    rows = [(1, 2, None, None, "x", 1), (1, 1, "user", "a", "x", 1), (1, 1, "user", "a", "x", 1), (None, None, "user", "b", None, None)]
    got = chat.read_turns(chat.format_turns(spark.createDataFrame(rows, schema))).toPandas()
    turns = {r.tree_id if r.tree_id == r.tree_id else None: [(t["role"], t["text"]) for t in r.turns] for r in got.itertuples()}
    assert turns == {1: [("user", "a"), ("user", "a"), ("", "")], None: [("user", "b")]}
    assert chat.format_turns(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("text", ["<|im_end|>", "<\\|", "<\\\\|im_start|>", "<<||", "", "|<", "a<|b<\\|c"])
def test_escapes_are_reversible(spark, text):
    row = spark.range(1).select(F.lit(text).alias("t")).select(
        chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"),
        chat.unescape_role(chat.escape_role(F.concat("t", F.lit("\n%0A%25")))).alias("r"),
    ).first()
    assert row["u"] == text and "<|" not in row["e"] and row["r"] == text + "\n%0A%25"


# --- 2 toxicity ------------------------------------------------------------------------------

def test_toxic_words_are_learned_and_clean_texts_left(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(900):
        ws = list(rng.choice(vocabulary, int(rng.integers(10, 120))))
        toxic = int(k % 6 == 0)
        if toxic:
            ws[3:3] = list(rng.choice(["vile", "rotten", "awful"], 2))
        rows.append((k, " ".join(ws), toxic))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if i % 5] + [(None, 1), (3, None), (7, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).toPandas()
    held = got[got.doc_id % 5 == 0]
    truth = (held.doc_id % 6 == 0).astype(int)
    assert (held.predicted == truth).mean() > 0.97 and held.score.between(0, 1).all()


def test_toxicity_of_hostile_rows(spark, hostile, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(hostile, none)
    got = toxicity.score(hostile.withColumn("score", F.lit("old")), model)
    assert got.count() == len(HOSTILE) and got.where("score between 0 and 1 and predicted = 0").count() == len(HOSTILE)
    assert toxicity.score(empty, model).count() == 0 and got.columns[-2:] == ["score", "predicted"]
    toxicity.fit(empty, none)


def test_ratios_follow_the_definition(spark):
    """The telling words' ratios, computed again from sets of word pairs."""
    toxic = ["bad day bad luck", "a bad man", "so bad", "very bad", "how bad", "what bad", "no bad", "is bad"]
    fine = [f"x{k} good y{k} fine" for k in range(60)]
    rows = spark.createDataFrame([(t, 1) for t in toxic] + [(t, 0) for t in fine], "text string, toxic int")
    counts = toxicity.expressions(toxicity.pair_counts(rows), 3)
    got = {r["w"]: r["r"] for r in toxicity.ratios(counts, 0.75, 10.83, 3).where("h is null").collect()}
    pairs = [{p for t in ts for p in zip(["^", *t.split()], t.split())} for ts in (toxic, fine)]
    follows = [pd.Series([w for _, w in p]).value_counts() for p in pairs]
    both = pd.Series([w for _, w in pairs[0] | pairs[1]]).value_counts()

    def p(k, w):
        own, n = follows[k], follows[k].sum()
        shared = (both[w] - 0.75) / both.sum() + 0.75 / both.sum()
        return max(own.get(w, 0) - 0.75, 0) / n + 0.75 * len(own) / n * shared

    key = np.array([toxicity.word_key("bad")], np.uint64).view(np.int64)[0]
    assert got[key] == pytest.approx(np.log(p(0, "bad") / p(1, "bad")))


# --- 3 token file ----------------------------------------------------------------------------

def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    found = tokenfile.PerfectHash.from_bytes(tokenfile.PerfectHash.build(keys).to_bytes())
    assert sorted(found.slots(keys)) == list(range(len(keys)))
    index = tokenfile.Index(tokenfile.Index.to_bytes(keys, keys % 7, keys % 1000, keys % 90))
    hit, rows = index.get(keys)
    assert hit.all() and (rows["offset"] == keys % 1000).all()
    assert not index.get(keys + np.uint64(1))[0][~np.isin(keys + np.uint64(1), keys)].any()
    assert not tokenfile.Index(tokenfile.Index.to_bytes(keys[:0], keys[:0], keys[:0], keys[:0])).get(keys)[0].any()
    with pytest.raises(ValueError):
        tokenfile.PerfectHash.build(np.array([5, 5], np.uint64))


def test_token_store_of_hostile_rows(spark, hostile, empty):
    path = tokenfile.write_ids(hostile, queries.tokenizer_path(), end_id=2, shard_ids=50_000, index_keys=3)
    got = tokenfile.read_ids(spark, path, hostile.select("doc_id")).toPandas().sort_values("start")
    order = sorted(HOSTILE, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(HOSTILE) and got["start"].tolist() == np.cumsum([0, *got["n_tokens"]])[:-1].tolist()
    assert sorted(got["ids_crc32"]) == sorted(crc(ids_of(r[1], 2)) for r in order)
    assert [None if i != i else int(i) for i in got["doc_id"]] == [r[0] for r in order]
    store = tokenfile.TokenStore(spark, path)
    assert store.get(7).tolist() == ids_of(HOSTILE[-1][1], 2) and store.get(2, 1).tolist() == ids_of(HOSTILE[1][1], 2)
    assert store.get(99) is None and store.get(2, 2) is None and store.get(None) is not None
    assert len(store.get(6)) == 180_001
    none = tokenfile.write_ids(empty, queries.tokenizer_path())
    assert tokenfile.read_ids(spark, none, hostile.select("doc_id")).count() == 0
    assert tokenfile.TokenStore(spark, none).get(1) is None


def test_op3_and_op7_against_the_tokenizer(spark, sf_dir, documents):
    at, want = 0, {}
    for doc, text, _ in sorted(documents):
        ids = ids_of(text, 2)
        want[doc] = (at, len(ids), crc(ids))
        at += len(ids)
    got = contract.queries()["op3_token_file"](spark, sf_dir).toPandas()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got.itertuples()} == want
    pieces = contract.queries()["op7_packing"](spark, sf_dir).toPandas().sort_values(["doc_id", "start"])
    texts = {d: t for d, t, _ in documents}
    for doc, own in pieces.groupby("doc_id"):
        ids = ids_of(texts[doc], 1)
        assert own["length"].sum() == len(ids) == own["doc_tokens"].iloc[0]
        assert own["start"].tolist() == np.cumsum([0, *own["length"]])[:-1].tolist()
        assert all(crc(ids[s : s + n]) == c for s, n, c in zip(own["start"], own["length"], own["ids_crc32"]))
    assert set(pieces["doc_id"]) == set(texts) and (pieces["offset"] == 0).all()
    assert ((pieces["length"] & (pieces["length"] - 1)) == 0).all() and pieces["length"].max() <= 2048
    assert sorted(pieces["sequence_id"]) == list(range(len(pieces)))
    assert pieces.sort_values("sequence_id")["length"].is_monotonic_decreasing


# --- 4, 5 lines and quality ------------------------------------------------------------------

def test_line_dedup_of_hostile_rows(hostile, empty):
    got = lines.dedup_lines(hostile).toPandas()
    assert len(got) == len(HOSTILE) and list(got.columns) == [*SCHEMA.replace(",", "").split()[::2], "n_lines", "n_dropped"]
    assert got[got.doc_id == 2]["text"].tolist() == ["", ""] and got[got.doc_id == 2]["n_dropped"].tolist() == [2, 2]
    one = got[got.doc_id == 1].iloc[0]
    assert one["text"] == HOSTILE[0][1] and one["n_lines"] == 4 and one["n_chars"] == len(HOSTILE[0][1])
    assert got[got.doc_id == 3]["text"].iloc[0] is None and got[got.doc_id == 3]["n_lines"].iloc[0] == 1
    assert lines.dedup_lines(empty).count() == 0


def test_line_limits(spark):
    rows = [(k, f"shared by all\nshort\nown line of {k}\nshared by all") for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["n_dropped"] for r in lines.dedup_lines(df, min_docs=5).collect()} == {0}
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df, min_docs=4).collect()}
    assert got[0] == rows[0][1] and got[3] == "short\nown line of 3"


def test_quality_of_hostile_rows(hostile, empty):
    got = quality.judge(hostile).toPandas()
    assert len(got) == len(HOSTILE) and not got["kept"].any()
    long = got[got.doc_id == 6].iloc[0]
    assert long["n_words"] == 180_000 == long["n_repeat_words"] and long["word_chars"] == len(LONG.replace(" ", ""))
    assert got[got.doc_id == 5]["n_words"].iloc[0] == 0 and got[got.doc_id == 7]["n_symbols"].iloc[0] == 4
    assert quality.judge(empty).count() == 0


def test_lines_common_on_one_host_deplete_documents(spark):
    def body(k):
        return " ".join(f"word{k}x{i}" for i in range(60))
    menu = "\n".join(f"menu{i} entry{i} number{i} of{i} the{i} site{i}" for i in range(20))
    rows = [(k, menu + "\n" + body(k)[: 400 if k % 2 else None], "a") for k in range(30)] + [(100, menu + "\n" + body(100)[:400], "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality.judge(df, max_docs=20).collect()}
    assert not got[1]["kept"] and not got[1]["base_failed"] and got[100]["kept"] and got[100]["left_percent"] == 100
    assert got[1]["left_percent"] < 50 and all(r["kept"] for r in quality.judge(df, max_docs=40).collect())


# --- 6 SimHash -------------------------------------------------------------------------------

def brute_fingerprint(text, k=3):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + k]), 42) for i in range(max(1, len(ws) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(points, ids, bits=2):
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= bits
    label = np.array(ids)
    while True:
        low = np.where(near, label[None, :], np.iinfo(np.int64).max).min(1)
        if (low == label).all():
            return label
        label = low


def clouds(seed, centres=60, size=12):
    rng = np.random.default_rng(seed)
    out = [rng.integers(0, 2**63, centres, dtype=np.uint64)]
    for _ in range(size):
        flips = np.zeros(centres, np.uint64)
        for _ in range(int(rng.integers(1, 4))):
            flips |= np.uint64(1) << rng.integers(0, 64, centres, dtype=np.uint64)
        out.append(out[-1] ^ flips)
    return np.unique(np.concatenate(out))


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_routing_brings_all_links_together(bits):
    points = np.random.default_rng(4).permutation(clouds(4))
    near = np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= bits, 1)
    nodes = simhash.grow(points[:200], bits, 20)
    seen = np.zeros_like(near)
    for _, own in simhash.route(nodes, points, bits):
        own = np.sort(own)
        seen[np.ix_(own, own)] = True
    assert len(nodes) > 3 and (seen | ~near).all()
    label = simhash.local_links(points, bits, small=16)
    assert (label == brute_components(points, np.arange(len(points)), bits)).all()


def test_links_over_small_leaves_and_blocks(spark):
    points = clouds(6, 80, 6)
    ids = np.random.default_rng(6).permutation(len(points)) + 10
    classes = spark.createDataFrame(pd.DataFrame({"fp": points.view(np.int64), "id": ids}))
    from tidepanel.llm.graph import components

    want = brute_components(points, ids)
    for leaf in (4, 10_000):
        found = components(simhash.links(classes, 2, 100, leaf))
        got = {r["node"]: r["component"] for r in found.collect()}
        assert [got.get(i, i) for i in ids] == want.tolist()


@pytest.mark.parametrize("kind", ["clouds", "ball", "rounds"])
def test_trees_in_large_leaves(spark, monkeypatch, kind):
    """Leaves of over 32 rows get trees of their own; what nothing divides goes to blocks."""
    from tidepanel.llm.graph import components

    ball = np.uint64(2**63 - 7) ^ np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    points = ball if kind == "ball" else np.unique(np.concatenate([clouds(8, 60, 5), ball]))
    ids = np.random.default_rng(9).permutation(len(points)) + 10
    classes = spark.createDataFrame(pd.DataFrame({"fp": points.view(np.int64), "id": ids}))
    seen = {"_rerouted": 0, "_blocks": 0}
    for name in seen:
        def counted(rows, *rest, own=getattr(simhash, name), name=name):
            seen[name] += rows.count() if name == "_blocks" else rows.join(rest[0], "leaf").count()
            return own(rows, *rest)

        monkeypatch.setattr(simhash, name, counted)
    monkeypatch.setattr(simhash, "PACK", 50)
    if kind == "rounds":
        monkeypatch.setattr(simhash, "ROUNDS", 0)
    got = {r["node"]: r["component"] for r in components(simhash.links(classes, 2, 12, 1)).collect()}
    assert [got.get(i, i) for i in ids] == brute_components(points, ids).tolist()
    assert (seen["_rerouted"] > 0) == (kind == "clouds") and seen["_blocks"] > 0


def test_components_of_a_long_chain(spark):
    from tidepanel.llm.graph import components

    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 99), (99, 99)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 1 for k in range(2, 61)) and got[100] == 99
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_op6_against_brute_force(spark, sf_dir, documents):
    points = np.array([brute_fingerprint(t) for _, t, _ in documents], np.uint64)
    ids = np.array([d for d, _, _ in documents])
    want = {int(d): (format(int(p), "016x"), int(c)) for d, p, c in zip(ids, points, brute_components(points, ids))}
    got = contract.queries()["op6_simhash"](spark, sf_dir).toPandas()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got.itertuples()} == want


def test_near_duplicates_of_hostile_rows(hostile, empty):
    got = simhash.near_duplicates(hostile).toPandas()
    assert len(got) == len(HOSTILE)
    # Texts without words share fingerprint 0; the null id counts as the smallest, and the two rows
    # without an id are one document.
    assert set(got[got.id.isin([3, 4, 5])]["component"]) == {simhash.NO_ID}
    kept = simhash.keep_first(hostile).toPandas()
    assert sorted(kept["doc_id"].dropna()) == [1, 2, 6, 7] or sorted(kept["doc_id"].dropna()) == [1, 6, 7]
    assert kept["doc_id"].isna().sum() == 1 and list(kept.columns) == hostile.columns
    assert simhash.keep_first(empty).count() == 0


# --- 7 packing -------------------------------------------------------------------------------

def test_binary_lengths():
    for n in range(0, 5000, 7):
        own = packing.binary_lengths(n, 256)
        assert sum(own) == n and all(p & (p - 1) == 0 and p <= 256 for p in own) and own == sorted(own, reverse=True)


def test_packing_of_hostile_rows(spark, hostile, empty):
    got = packing.pack(hostile, queries.tokenizer_path(), largest=512).toPandas()
    assert got["length"].sum() == sum(len(ids_of(r[1], 1)) for r in HOSTILE) and len(got["sequence_id"].unique()) == len(got)
    assert all(crc(list(r.ids)) == r.ids_crc32 and len(r.ids) == r.length for r in got.itertuples())
    assert (got[got.doc_id == 3]["length"] == 1).all()
    assert packing.pack(empty, queries.tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(hostile, queries.tokenizer_path(), largest=1000)


# --- 8 language ------------------------------------------------------------------------------

def test_languages_held_out(spark, sf_dir, documents):
    got = contract.queries()["op8_language_id"](spark, sf_dir).toPandas().set_index("doc_id")
    truth = {d: lang for d, _, lang in documents}
    held = got[got.held_out]
    assert set(held.index) == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == truth[r.Index] for r in held.itertuples()]) > 0.97 and got.score.between(0, 1).all()


def brute_viterbi(scores, penalty):
    best, back = scores[0].copy(), []
    for row in scores[1:]:
        step = best[None, :] - penalty * (1 - np.eye(len(best)))
        back.append(step.argmax(1))
        best = step.max(1) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_viterbi_matches_the_recursion():
    rng = np.random.default_rng(8)
    sizes = np.array([0, 1, 7, 40, 0, 13])
    scores = rng.normal(scale=3, size=(sizes.sum(), 4)).astype(np.float32)
    got, at = language.viterbi(scores, sizes, 4.0), 0
    for n in sizes:
        if n:
            own = scores[at : at + n].astype(float)
            value = lambda path: sum(own[k][s] for k, s in enumerate(path)) - 4.0 * sum(a != b for a, b in zip(path, path[1:]))
            assert value(got[at : at + n].tolist()) == pytest.approx(value(brute_viterbi(own, 4.0)), abs=1e-3)
        at += n


def test_word_scores_do_not_depend_on_the_step():
    found = language.Words(["Ein kleines Wort", None, "", "encore une phrase ŒUVRE", "12 34"])
    assert found.per_text.tolist() == [3, 0, 0, 4, 0]
    table = np.random.default_rng(1).normal(size=(language.BUCKETS, 2)).astype(np.float32)
    np.testing.assert_allclose(found.scores(table, 5), found.scores(table), rtol=1e-5, atol=1e-5)


def test_too_many_languages_are_an_error(spark):
    rows = spark.createDataFrame([(f"some words {k}", f"l{k % 4}") for k in range(12)], "text string, lang string")
    with pytest.raises(ValueError, match="more than 3 languages"):
        language.fit(rows, max_languages=3)
    assert language.fit(rows, max_languages=4).languages == ["l0", "l1", "l2", "l3"]


def test_mixed_texts_and_scripts(spark, hostile, empty):
    rows = [(f"the cat and the dog went over there again and then some {k}", "en") for k in range(40)]
    rows += [(f"кошка и собака пошли туда снова и потом ещё {k}", "ru") for k in range(40)]
    rows += [(f"le chat et le chien sont allés là encore une fois {k}", "fr") for k in range(40)] + [(None, "xx"), ("abc", None)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    texts = [("the dog went there again and the cat собака пошли туда снова", 1), ("λόγος", 2), ("123 !", 3), (None, 4)]
    got = {r["k"]: r for r in language.identify(spark.createDataFrame(texts, "text string, k int"), model).collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "ru"] and got[1]["spans"][0]["words"] == 8
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == "und" and got[3]["score"] == 0 and got[2]["lang_pred"] in ("en", "fr", "ru")
    assert language.identify(hostile, model).count() == len(HOSTILE)
    none = language.fit(empty)
    assert {r["lang_pred"] for r in language.identify(hostile, none).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


# --- 9 urls ----------------------------------------------------------------------------------

def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (verdict, rule) for verdict, rule in queries.URL_RULES
        if (host == rule.split("/", 1)[0] or host.endswith("." + rule.split("/", 1)[0])) and path.startswith("/" + rule.split("/", 1)[1])
    ]
    return host, path, max(fits, key=lambda f: len(f[1])) if fits else None


URLS = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/ES/x", "http://example.org/es/", "https://a.example.org/en/12?x=1#y", "http://ÉX.org/",
    "http://org", "http://notexample.org/es/1", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com?/de/", "http://a.com#/fr/", "x://y://z/org/",
    "http://x.com/de/1", "http://long.com/" + "a/b-1?" * 20_000,
]


def test_urls_against_brute_force(spark):
    rows = [(k, u) for k, u in enumerate(URLS)] + [(None, "http://n.net/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("h"), "label": F.lit(9), "prediction": F.lit("p")})
    got = urls.filter_urls(df, queries.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule = brute_url(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule[1] if rule else None)
        assert r["verdict"] == rule[0] if rule else r["verdict"] in ("allow", "block")
    assert urls.filter_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_url_trees_learn_from_labelled_urls(spark):
    rows = [(f"http://www.site{k}.{'zip' if k % 3 == 0 else 'net'}/page/{k}", int(k % 3 == 0)) for k in range(300)]
    df = spark.createDataFrame(rows, "url string, label int")
    host, path = urls.parts(F.col("url"))
    known = df.withColumns({"host": host, "path": path})
    model = urls.train(known.where("url like '%1' or url like '%2' or url like '%3' or url like '%4'"))
    assert model.blocks(known).where("blocked = (label = 1)").count() > 290
    assert model.features(known).where("entropy <= 0 or entropy > 8 or depth <> 2").count() == 0


# --- 10 decontamination ----------------------------------------------------------------------

def brute_contained(documents, items, share=0.8):
    def cut(text):
        ws = re.findall(r"\w+", text.lower()) if text else []
        return {" ".join(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()
    sets = [(i, cut(t)) for i, t in items]
    out = {}
    for doc, text in documents:
        own = cut(text)
        for i, s in sets:
            if s and len(own & s) >= share * len(s) - 1e-9:
                out[doc, i] = len(own & s)
    return out


def test_op10_against_brute_force(spark, sf_dir, duck, documents):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = contract.queries()["op10_decontamination"](spark, sf_dir).toPandas()
    assert {(r.doc_id, r.item_id): r.shared for r in got.itertuples()} == brute_contained([d[:2] for d in documents], items)


def test_items_hidden_in_long_texts(spark, hostile, empty):
    rng = np.random.default_rng(12)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(5, 200))))) for k in range(60)]
    docs = []
    for k in range(60):
        ws = items[k][1].upper().split()
        if k % 3 == 0 and len(ws) > 60:
            ws[len(ws) // 2] = "changed"
        at = int(rng.integers(0, 4000))
        body = list(rng.choice(vocabulary, 4000))
        docs.append((k, " ".join(body[:at] + ws + body[at:]) if k % 4 else " ".join(body)))
    want = brute_contained(docs, items)
    assert len(want) > 30
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*items, items[0], (99, None), (98, " ")], "item_id long, text string")
    for chars in (10_000_000, 5_000):
        got = decontaminate.contamination(df, bench, block_chars=chars).collect()
        assert len(got) == len(want) and {(r["doc_id"], r["item_id"]): r["shared"] for r in got} == want
    left = decontaminate.without_items(df, bench, block_chars=5_000)
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.contamination(empty, bench).count() == 0 == decontaminate.contamination(df, bench.limit(0)).count()
    assert decontaminate.without_items(hostile, bench).count() == len(HOSTILE)


# --- digests of the queries that SQL covers too ------------------------------------------------

def test_op1_reads_back_the_hostile_conversation(spark, sf_dir):
    row = contract.queries()["op1_chat_format"](spark, sf_dir).where("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    whole = f"user\n{text}\nassistant\n{text}\n"
    assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest() and row["n_turns"] == 2
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and row["loss_chars"] == len(text)
