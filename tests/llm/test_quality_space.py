"""What the quality classifier leaves on disk, and which words meet a join."""

import os

import numpy as np
from pyspark.sql import functions as F

from lumenlog.llm import quality
from lumenlog.llm.common import shared_dir


def test_tables_of_the_models_go(spark):
    rows = [(k, f"w{k % 7} w{k % 5} w{k % 3} only{k}", "en") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k < 40), 0) for k in range(60)], "doc_id long, quality int, toxic int")
    root = f"{shared_dir(spark).removeprefix('file://')}/llm"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    got = quality.classify(docs, labels)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before}
    assert left == {"good", "bad", "code-lengths", "trusted-lengths", "trusted-means", "bars"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert got.count() == 60


def test_marks_tell_keys_of_the_table(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    every = np.array([r.key for r in keys.collect()])
    bits = quality.marked(keys.where("pmod(key, 2) = 0"))
    low = every & (len(bits) * 8 - 1)
    found = (bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1
    assert found[every % 2 == 0].all() and found[every % 2 == 1].mean() < 0.15


def test_head_holds_the_most_frequent(spark):
    rows = spark.range(300).select(F.xxhash64("id").alias("key"), (F.col("id") % 10).alias("n"), F.rand(1).alias("u"))
    head, others = quality.head(rows, 70)
    assert len(head["key"]) == 60 and (np.diff(head["key"]) > 0).all() and others.count() == 240
    assert {r.key for r in rows.where("n >= 8").collect()} == set(head["key"].tolist())
