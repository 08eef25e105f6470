"""The corpus pipeline stage by stage against brute-force versions."""

import zlib

import numpy as np

import corpus_pipeline
from tidepanel.llm import queries
from tidepanel.session import write_table
from tests.llm.test_operators import HOSTILE, SCHEMA, brute_components, brute_contained, brute_fingerprint, ids_of


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_each_stage_on_its_input(spark, sf_dir, duck):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        docs = write_table(stage(spark, docs, sf_dir), "stage")
        seen.append(name)
        if name == "packing":
            break
        after = rows_of(docs)
        assert docs.columns == columns and docs.count() == len(after)
        if name == "language id":
            assert len(after) >= 0.98 * len(before) and all(after[d] == before[d] for d in after)
        elif name == "line dedup":
            first = {}
            key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            for d in sorted(before):
                for line in before[d].split("\n"):
                    first.setdefault(key(line), d)
            want = {d: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == d) for d, t in before.items()}
            assert after == want
        elif name == "near duplicates":
            ids = np.array(sorted(before))
            points = np.array([brute_fingerprint(before[d]) for d in ids], np.uint64)
            assert set(after) == set(brute_components(points, ids).tolist())
        else:
            items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
            assert set(after) == set(before) - {d for d, _ in brute_contained(before.items(), items)}
    packed = docs.toPandas()
    assert seen == ["language id", "line dedup", "near duplicates", "decontamination", "packing"]
    assert packed.groupby("doc_id")["length"].sum().to_dict() == {d: len(ids_of(t, 1)) for d, t in before.items()}
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in packed.itertuples())


def test_hostile_rows_pass_through_all_stages(spark, sf_dir):
    docs = spark.createDataFrame(HOSTILE, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            rows = write_table(stage(spark, rows, sf_dir), "stage")
        assert rows.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert set(dict(corpus_pipeline.STAGES)) and queries.tokenizer_path().endswith(".json")
