"""The pipeline's near-dedup stage links from 0.80 on, the op5 query from 0.85 on."""

import corpus_pipeline
from lumenlog.llm import neardup
from test_operators import shingle_set


def pair(k, n, changed):
    """Two texts of ``n`` words, the second with its last ``changed`` words replaced."""
    words = [f"t{k}w{i}" for i in range(n)]
    return " ".join(words), " ".join([*words[:n - changed], *(f"t{k}x{i}" for i in range(changed))])


def similarity(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b)


def test_stage_links_from_80_per_cent(spark):
    # shingles are n - 4 a text; the last `changed` of them differ
    cases = {0.80: (94, 10), 0.82: (104, 10), 0.79: (98, 11), 0.86: (104, 7), 0.30: (54, 27)}
    docs, like = [], {}
    for k, (n, changed) in enumerate(cases.values()):
        a, b = pair(k, n, changed)
        docs += [(10 * k, a), (10 * k + 1, b)]
        like[10 * k + 1] = similarity(a, b)
    assert like[1] == 0.80 and 0.80 < like[11] < 0.85 and 0.75 < like[21] < 0.80 and 0.85 < like[31]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, None).collect()}
    assert {d for d in like if d not in kept} == {d for d, s in like.items() if s >= 0.80} == {1, 11, 31}
    assert {r.doc_id for r in neardup.near_duplicates(df).where("not kept").collect()} == {31}


def test_crowded_nodes_at_80_per_cent(spark, monkeypatch):
    """Nodes of 2 documents at most, so pairs part on every level."""
    monkeypatch.setattr(neardup, "NODE", 2)
    docs = []
    for k in range(40):
        a, b = pair(k, 94, 10)
        docs += [(10 * k, a), (10 * k + 1, b), (10 * k + 2, a + " more"), (10 * k + 3, a + " and more")]
    got = {r.doc_id for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 80).where("kept").collect()}
    assert got == {10 * k for k in range(40)}


def test_stage_against_all_pairs_at_80_per_cent(spark):
    docs = neardup.table(spark, "/root/testdata/sf0.001", "documents")
    sets = {r.doc_id: shingle_set(r.text) for r in docs.collect()}
    up = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        before = dict(up)
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
        if up == before:
            break
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, None).collect())
    assert kept == sorted(d for d in up if up[d] == d)
