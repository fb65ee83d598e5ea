"""The registered queries and the pipeline over the small tables."""

import hashlib

import duckdb
import pytest

import corpus_pipeline
from barsmith.llm import queries
from tools.check_oracle import compare, type_diff
SF_SMALL = "/root/testdata/sf0.001"


def test_names_and_sql():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_whole_results_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    frame, sql = queries.queries()[name](spark, SF_SMALL), queries.oracle_sql()[name]
    assert compare(frame.toPandas(), con.execute(sql).df()) is None
    assert type_diff(frame, con.sql(sql)) == []


def test_pipeline_stages_keep_the_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        after = corpus_pipeline.materialise(stage(spark, before, SF_SMALL), f"test-{k}")
        if k < len(corpus_pipeline.STAGES):
            assert set(after.columns) == set(docs.columns)
        if k <= 2:
            assert after.join(before, docs.columns, "left_anti").isEmpty() and 0 < after.count() < before.count()
        if k == 3:
            assert after.count() == before.count()
        before = after
    assert {"doc_id", "ids", "n_tokens"} <= set(before.columns) and before.where("n_tokens <> size(ids)").isEmpty()


def test_operators_answer_for_every_document(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    for name in ("op1_language_id", "op5_order_minhash", "op7_iblt_fingerprints", "op10_toxicity"):
        assert sorted(r.doc_id for r in queries.queries()[name](spark, SF_SMALL).collect()) == sorted(docs)
    got = {r.doc_id: r.decoded_sha256 for r in queries.op9_byte_bpe(spark, SF_SMALL).collect()}
    assert got == {i: hashlib.sha256(b).hexdigest() for i, b in docs.items()}


def test_realised_rows_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    for name, query in queries.more_queries().items():
        frame, sql = query(spark, SF_SMALL), queries.more_sql()[name]
        assert compare(frame.toPandas(), con.execute(sql).df()) is None
        assert type_diff(frame, con.sql(sql)) == []


def test_mixed_documents_are_written_by_block_and_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted((r.mix_block, r.mix_order, r.doc_id) for r in queries.op6_mixing_realised(spark, SF_SMALL).collect())
    assert [r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF_SMALL).collect()] == [r[2] for r in rows] and len({r[0] for r in rows}) > 32
