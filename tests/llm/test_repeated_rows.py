"""Repeated rows: urls against their twin, decontamination of repeated documents."""

import duckdb
from pyspark.sql import functions as F

from lumenlog.llm import decontaminate, urls
from lumenlog.llm.common import table

SF = "/root/testdata/sf0.01"


def test_repeated_pages_and_null_ids_equal_the_twin(spark):
    pages = table(spark, SF, "pages").select("page_id", "url")
    more = pages.where("page_id % 5 = 0")
    for _ in range(3):
        pages = pages.unionByName(more)
    pages = pages.unionByName(more.select(F.lit(None).cast("long").alias("page_id"), "url"))
    pages = pages.unionByName(spark.createDataFrame([(None, None), (1, None), (1, "no scheme"), (1, None)], "page_id long, url string"))
    labels = table(spark, SF, "labels")
    got = sorted(map(tuple, urls.judge(pages, urls.document_labels(pages, labels)).drop("purity").collect()), key=str)
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    con.execute(f"create view labels as select * from '{SF}/labels.parquet'")
    want = sorted(con.execute(urls.ORACLE).fetchall(), key=str)
    assert len(got) == pages.count() and got == want


def test_repeated_documents_and_both_joins(spark, monkeypatch):
    w = [f"w{k}" for k in range(60)]
    docs = [(1, " ".join(w)), (1, " ".join(w)), (1, "other text"), (None, " ".join(w[:12])), (2, " ".join(w[5:14])), (3, " ".join(w[5:15]).upper() + "!"), (4, None), (5, "short")]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, gram string, h int")
    bench = spark.createDataFrame([(7, " ".join(w[3:20])), (7, " ".join(w[3:20])), (8, "short"), (9, None)], "item_id long, text string")

    def run():
        return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in decontaminate.report(df, bench).collect()), key=str)

    want = sorted([(1, 60, 17, 1), (1, 60, 17, 1), (1, 2, 0, 0), (None, 12, 0, 0), (2, 9, 0, 0), (3, 10, 10, 1), (4, 0, 0, 0), (5, 1, 1, 1)], key=str)
    assert run() == want
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_GRAMS", 0)
    assert run() == want
    for mode in ("documents", "spans"):
        assert decontaminate.remove(df.limit(0), bench, mode=mode).count() == 0
        assert decontaminate.remove(df, bench.limit(0), mode=mode).count() == len(docs)
