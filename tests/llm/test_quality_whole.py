"""The quality models count every labelled document, and judge no trusted one by itself."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lumenlog.llm import quality


def corpus(n):
    rng = random.Random(5)
    return [(k, " ".join(rng.choices([f"w{i}" for i in range(60)], k=rng.randrange(3, 12)) + [f"only{k}"]), "en") for k in range(n)]


def test_models_count_every_document(spark):
    rows = corpus(5000)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = spark.range(5000).select(F.col("id").alias("doc_id"))
    good, bad = quality.train(docs, ids.where("doc_id < 2500"), ids.where("doc_id >= 2500"))
    for model, part in ((good, rows[:2500]), (bad, rows[2500:])):
        assert model.words.where("uni is not null").count() == len({w for _, t, _ in part for w in t.split()})


def test_folds_are_models_of_the_rest(spark):
    docs = spark.createDataFrame(corpus(300), "doc_id long, text string, lang string")
    texts = docs.select(quality.fold(F.col("doc_id")).alias("fold"), "text")
    got = quality.kneser_ney(texts)
    lengths = quality.code_lengths(docs, got, got).orderBy("doc_id").collect()
    for f in range(quality.FOLDS):
        rest = quality.kneser_ney(texts.where(F.col("fold") != f).drop("fold"))
        assert got.without[f] == pytest.approx(rest.unknown)
        for r, x in zip(lengths, quality.code_lengths(docs, rest, rest).orderBy("doc_id").collect(), strict=True):
            assert r[f"length_{f}"] == pytest.approx(x.length)


def test_trusted_documents_do_not_judge_themselves(spark):
    rows = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    texts = docs.select("doc_id", quality.fold(F.col("doc_id")).alias("fold"), "text")
    none = quality.kneser_ney(texts.where("false").select("text"))
    got = {r.doc_id: r.perplexity for r in quality.classify(docs, labels).collect()}
    for f in range(quality.FOLDS):
        rest = quality.kneser_ney(texts.where(F.col("fold") != f).select("text"))
        own = {r.doc_id: r for r in quality.code_lengths(docs.where(quality.fold(F.col("doc_id")) == f), rest, none).collect()}
        # the same mean is drawn in for all, so it can be found from each
        means = [((r.n_words + quality.PRIOR) * math.log10(got[d]) - r.length) / quality.PRIOR for d, r in own.items()]
        assert max(means) - min(means) < 1e-6
