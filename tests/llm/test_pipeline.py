"""The corpus pipeline, stage by stage."""

import duckdb

import corpus_pipeline
from lumenlog.llm import decontaminate
from lumenlog.llm.common import stored, table
from test_operators import brute_components, shingle_set

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    before = {}
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        rows = [r.asDict() for r in docs.collect()]
        out = stored(f(spark, docs, SF), "test-stage")
        if k < 4:
            assert out.columns == columns, name
        ids = [r.doc_id for r in out.collect()]
        given = {r["doc_id"]: r["text"] for r in rows}
        assert set(ids) <= set(given) and ids
        if k == 1:
            comp = brute_components({d: shingle_set(t) for d, t in given.items()}, corpus_pipeline.NEAR)
            assert sorted(ids) == sorted(d for d in comp if comp[d] == d)
        if k == 2:
            hit = {r.doc_id for r in decontaminate.report(docs, table(spark, SF, "benchmark")).where("contaminated").collect()}
            assert sorted(ids) == sorted(d for d in given if d not in hit)
        if k == 4:
            assert len(ids) == len(rows)
        before[name] = len(ids)
        docs = out
    labels = duckdb.sql(f"select doc_id from '{SF}/labels.parquet' where quality = 1 and toxic = 0").fetchall()
    kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, table(spark, SF, "documents"), SF).collect()}
    assert sum(d in kept for (d,) in labels) >= 0.98 * len(labels)


def test_run(spark):
    df = corpus_pipeline.run(spark, SF)
    assert df.count() > 0 and df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
