"""The pipeline stage by stage: each against SQL or brute force over its own input."""

import hashlib

import corpus_pipeline
import duckdb
import pyarrow.parquet as pq

from tallyhouse.llm import pieces
from tallyhouse.llm.oracle import ORACLE
from tallyhouse.llm.queries import QUERIES, piece_model

SMALL = "/root/testdata/sf0.001"


def judged(name, table):
    connection = duckdb.connect()
    connection.register("documents", table)
    connection.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SMALL}/benchmark.parquet'")
    return {row["doc_id"]: row for row in connection.sql(ORACLE[name]).to_arrow_table().to_pylist()}


def texts_of(table):
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


def test_stages(spark, tmp_path):
    tables = [pq.read_table(f"{SMALL}/documents.parquet")]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        tables.append(docs.toArrow())
    given, clean, single, cut, tested, encoded = tables
    assert all(t.column_names == given.column_names for t in (clean, single, cut, tested))

    toxic = {r["doc_id"] for r in QUERIES["op4_toxicity"](spark, SMALL).collect() if r["predicted"]}
    assert toxic and set(texts_of(clean)) == set(texts_of(given)) - toxic

    kept = {doc for doc, row in judged("op7_minhash_neardup", clean).items() if row["kept"]}
    assert len(kept) < len(clean) and set(texts_of(single)) == kept

    rule, before, after = judged("op2_substring_dedup", single), texts_of(single), texts_of(cut)
    assert set(after) == kept and any(row["n_removed"] for row in rule.values())
    for doc, row in rule.items():
        if row["n_removed"]:
            assert hashlib.sha256(after[doc].encode()).hexdigest() == row["kept_sha256"]
        else:
            assert after[doc] == before[doc]
    sizes = dict(zip(cut["doc_id"].to_pylist(), cut["n_chars"].to_pylist()))
    assert all(sizes[doc] == len(after[doc]) for doc in after)

    rule = judged("op1_decontaminate", cut)
    assert set(texts_of(tested)) == {doc for doc, row in rule.items() if not row["contaminated"]}

    vocabulary = pieces.Vocabulary.of(piece_model())
    search = pieces.Viterbi(vocabulary)
    texts = texts_of(tested)
    for row in encoded.to_pylist():
        text = texts[row["doc_id"]]
        assert row["ids"] == (search.encode(" " + text) if text else []) and row["n_ids"] == len(row["ids"])
    assert encoded.num_rows == len(texts)


def test_run_returns_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "n_ids", "ids"] and 0 < rows.count() < 200
