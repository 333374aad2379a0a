"""The language model counts every context and symbol, however rare in a large corpus."""

from collections import Counter

import numpy as np
import pytest

from lumenlog.llm import lm, ppm


def scored(spark, docs):
    rows = lm.scores(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    counts = Counter(w for d, t in docs if d != 6 for w in lm.tokens_of(t))
    trie = ppm.Trie(ppm.count(list(counts), np.array(list(counts.values()), float)))
    return {r.doc_id: r for r in rows}, lambda t: trie.score(lm.tokens_of(t)).sum()


def test_rare_contexts_count_beside_many_frequent_ones(spark):
    often = "harbour lantern window " * 70_000
    docs = [(d, often) for d in (1, 2, 3, 4)] + [(5, "zygote zygotic " * 2), (6, "zygote unseen lanterns")]
    got, want = scored(spark, docs)
    assert got[6].held_out and not got[5].held_out
    for d, t in docs:
        assert got[d].score == pytest.approx(want(t), rel=1e-9)


def test_groups_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 40)
    r = np.random.default_rng(5)
    docs = [(d, " ".join("".join(r.choice(list("abé\x00"), r.integers(1, 14))) for _ in range(60))) for d in (1, 2, 3, 4, 5, 6)]
    got, want = scored(spark, docs)
    for d, t in docs:
        assert got[d].score == pytest.approx(want(t), rel=1e-9)
