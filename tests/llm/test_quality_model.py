"""The quality model against its definition, and what it keeps on held-out labels."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lumenlog.llm import quality
from lumenlog.llm.common import table


class Brute:
    """Interpolated modified Kneser-Ney of order 2 over plain dictionaries."""

    def __init__(self, texts, least):
        self.least = least
        self.pairs, follows = Counter(), defaultdict(set)
        for t in texts:
            words = (t or "").lower().split()
            self.pairs.update(zip([None, *words], words))
        for p, w in self.pairs:
            follows[w].add(p)
        self.a = {w: len(p) for w, p in follows.items()}
        self.d, self.da = self.discounts(self.pairs.values()), self.discounts(self.a.values())
        self.context = defaultdict(lambda: [0, 0.0])
        for (p, _), n in self.pairs.items():
            self.context[p][0] += n
            self.context[p][1] += self.d[min(n, 3)] if n >= self.least else n
        total = sum(self.a.values())
        self.unknown = sum(self.da[min(n, 3)] for n in self.a.values()) / total / (len(self.a) + 1)
        self.uni = {w: (n - self.da[min(n, 3)]) / total + self.unknown for w, n in self.a.items()}

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        return {c: max(0.0, min(c, c - (c + 1) * y * n[c + 1] / n[c] if n[c] else 0.75 * c / (c + 1))) for c in (1, 2, 3)}

    def p(self, prev, w):
        low = self.uni.get(w, self.unknown)
        if prev not in self.context:
            return low
        total, taken = self.context[prev]
        n = self.pairs.get((prev, w), 0)
        return (n - self.d[min(n, 3)] if n >= self.least else 0) / total + taken / total * low


def texts(seed, n, words):
    r = random.Random(seed)
    return [" ".join(r.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=r.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("least", [1, 2])
def test_model_against_its_definition(spark, least):
    words = [f"w{k}" for k in range(80)]
    good, bad = texts(1, 120, words) + [None, "", "One ONE one"], texts(2, 60, words[::-1] + ["awful"] * 5)
    frame = lambda x: spark.createDataFrame([(t,) for t in x], "text string")      # noqa: E731
    g, b = quality.kneser_ney(frame(good), least), quality.kneser_ney(frame(bad), least)
    bg, bb = Brute(good, least), Brute(bad, least)
    assert g.unknown == pytest.approx(bg.unknown) and b.unknown == pytest.approx(bb.unknown)
    assert sorted(r.uni for r in g.words.collect() if r.uni is not None) == pytest.approx(sorted(bg.uni.values()))
    vocabulary = [*bg.uni, "<new>"]
    for prev in (None, "w0", "w7", "never"):
        assert sum(bg.p(prev, w) for w in vocabulary) == pytest.approx(1)
    docs = [(k, t, "en") for k, t in enumerate(texts(3, 50, words + ["new1", "awful"]) + ["", None, "w0"])]
    got = {r.doc_id: r for r in quality.code_lengths(spark.createDataFrame(docs, "doc_id long, text string, lang string"), g, b).collect()}
    for k, t, _ in docs:
        w = (t or "").split()
        assert got[k].n_words == len(w)
        assert got[k].length == pytest.approx(-sum(math.log10(bg.p(p, x)) for p, x in zip([None, *w], w)))
        peak = max((math.log10(bb.uni.get(x, bb.unknown) / bg.uni.get(x, bg.unknown)) for x in w), default=None)
        assert got[k].peak == (None if peak is None else pytest.approx(peak))


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    run = lambda: {r.doc_id: (r.n_words, round(r.perplexity, 6), round(r.peak, 9), r.kept) for r in quality.op8_quality_classifier(spark, sf).collect()}      # noqa: E731
    want = run()
    monkeypatch.setattr(quality, "MAX_ROWS", 0)
    assert run() == want and len(want) == table(spark, sf, "documents").count()


def test_held_out_labels(spark):
    """Trained without a fifth of the labels; of those clean text stays, most of the rest goes."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = quality.classify(docs, labels.where("doc_id % 5 <> 0")).join(labels.where("doc_id % 5 = 0"), "doc_id")
    kept = {(r.quality, r.toxic): (r.kept, r.n) for r in out.groupBy("quality", "toxic").agg(F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert kept[1, 0][0] >= 0.985 * kept[1, 0][1]
    assert kept[1, 1][0] <= 0.5 * kept[1, 1][1]
    assert kept[0, 0][0] <= 0.35 * kept[0, 0][1]
