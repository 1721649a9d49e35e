"""The pipeline against its stages done by hand, and the registered queries."""

from __future__ import annotations

import random

from llm_data import SF, passage

import __spark_entry__
import corpus_pipeline
from starflat.llm import queries
from starflat.llm.common import staged

NAMES = [f"op{n}_" for n in range(1, 14)]


def write(spark, folder):
    rng = random.Random(1)
    item = passage(rng, 4)
    rows, labels = [], []
    for i in range(400):
        words = passage(rng, 5).split()
        bad = i % 8 == 0
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["grolmus", "grolmina", "vexarog", "vexarilk"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows.append((1000, rows[1][1]))  # an exact copy
    rows.append((1001, passage(rng, 3) + " " + item))  # a benchmark passage
    rows.append((1002, passage(rng, 3) + ' token = "' + "0123456789abcdef" * 2 + '"'))
    full = [(i, t, "en", "src0", len(t)) for i, t in rows]
    spark.createDataFrame(full, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id LONG, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    return {i for i, _, bad in labels if bad}


def test_each_stage_takes_effect(spark, tmp_path):
    folder = str(tmp_path)
    toxic = write(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, folder), name)
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == columns
        if name == "secrets":
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    everything = set(range(400)) | {1000, 1001, 1002}
    clean = everything - toxic
    assert len(clean - kept[0]) <= 2 and len(kept[0] - clean) <= 3
    assert kept[1] == kept[0] - {1000}
    assert kept[2] == kept[1] - {1001}
    assert kept[3] == kept[2] and "0123456789abcdef" not in texts[1002] and "<SECRET>" in texts[1002]
    assert kept[4] == kept[3]
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == kept[4]
    assert sorted(map(tuple, rows), key=str)[0] is not None


def test_every_operator_is_registered():
    registered = __spark_entry__.queries()
    for n in NAMES:
        assert sum(q.startswith(n) for q in registered) == 1
    assert "pipeline" in registered and "op4_topk" in __spark_entry__.oracle_sql()


def test_top_k_equals_sql(spark):
    import duckdb

    found = {tuple(r) for r in queries.op4_topk(spark, SF).collect()}
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert found == set(connection.execute(queries.LLM_ORACLES["op4_topk"]).fetchall())
