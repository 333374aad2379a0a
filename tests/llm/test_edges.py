"""Nulls, empty and very long texts, repeated rows, empty tables and clashing
columns: every operator has a defined result."""

import hashlib

import pytest

from lumenlog.llm import decontaminate, html, lm, mix, neardup, quality, rules, substrings, tokens, urls

LONG = " ".join(f"word{i % 997}x{i}" for i in range(60_000))
DOCS = [(1, "a b c d e f g h i j k l m n o", "en", "s"), (1, "a b c d e f g h i j k l m n o", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (4, " \n\t ", "fr", None),
        (None, "lost and found in the middle of it all with some words more", "en", "s"), (5, LONG, "de", "t"), (6, LONG, "de", "t"), (None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASH = ("w h spans items k t row kept size key bucket copies tie component_id node tree n n_words c token bits k1 k2 nth copy least more d gram text_key doc url host").split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASH if c not in df.columns))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, None), (5, 1, 0), (3, None, None), (None, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "e f g h i j k l m n"), (1, "e f g h i j k l m n"), (2, None), (3, ""), (None, "zz"), (4, "word0x0")], "item_id long, text string")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_substrings(docs):
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.deduplicated(clashing(docs)).collect()), key=str)
    null = " ".join(DOCS[5][1].split())
    assert got == sorted([(1, 15, 0, sha(DOCS[0][1]))] * 2 + [(2, 0, 0, sha("")), (3, 0, 0, sha("")), (4, 0, 0, sha("")), (None, 13, 0, sha(null)),
                         (5, 60000, 0, sha(LONG)), (6, 60000, 60000, sha("")), (None, 0, 0, sha(""))], key=str)


def test_rules(docs):
    got = rules.report(clashing(docs)).collect()
    assert sorted(r.n_words for r in got) == [0, 0, 0, 0, 13, 15, 15, 60000, 60000]
    assert {r.doc_id: r.base_failed for r in got if r.doc_id} == {1: False, 2: True, 3: True, 4: True, 5: False, 6: False}


def test_mix(docs):
    got = mix.report(clashing(docs)).collect()
    assert len(got) == len(DOCS) and all(0 <= r.taken <= 2 * r.size for r in got)
    out = mix.mix(clashing(docs))
    assert "row" in out.columns and set(CLASH) <= set(out.columns)
    assert out.count() == sum((r.taken // r.size) if r.size else 0 for r in got) + out.where("trim(coalesce(text, '')) = '' or text rlike '^\\\\s*$'").count()


def test_near_dedup(docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(clashing(docs)).collect()), key=str)
    assert got == sorted([(1, 11, 1, True)] * 2 + [(2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (None, 9, None, True), (5, 59996, 5, True), (6, 59996, 5, False), (None, 0, None, True)], key=str)
    kept = neardup.dedup(clashing(docs))
    assert set(CLASH) <= set(kept.columns)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, None, None], key=str)


def test_same_id_with_two_texts(spark):
    rows = [(1, "a b c d e f g h i j k l m n o p"), (1, "q r s t u v w x y z 1 2 3 4 5 6"), (2, "q r s t u v w x y z 1 2 3 4 5 6"), (3, "a b c d e f g h i j k l m n o p")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in neardup.near_duplicates(df).collect()} == {1}
    got = sorted((r.doc_id, r.n_removed) for r in substrings.deduplicated(df).collect())
    assert got == [(1, 0), (1, 0), (2, 16), (3, 16)]


def test_decontaminate(docs, bench):
    got = decontaminate.report(clashing(docs), clashing(bench)).collect()
    assert sorted(((r.doc_id, r.n_hit, r.n_items) for r in got), key=str) == sorted(
        [(1, 10, 1)] * 2 + [(2, 0, 0), (3, 0, 0), (4, 0, 0), (None, 0, 0), (None, 0, 0), (5, 1, 1), (6, 1, 1)], key=str)
    for mode, n in (("documents", 5), ("spans", len(DOCS))):
        out = decontaminate.remove(clashing(docs), bench, mode=mode)
        assert set(CLASH) <= set(out.columns) and out.count() == n


def test_lm(docs):
    got = lm.scores(clashing(docs)).collect()
    assert len(got) == len(DOCS)
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 1, 14, 16, 16, 60001, 60001]
    assert len({r.score for r in got if r.doc_id == 1}) == 1


def test_quality(docs, labels):
    got = quality.classify(clashing(docs), labels).collect()
    assert len(got) == len(DOCS)
    assert all(r.kept for r in got if r.n_bytes == 0)
    out = quality.accepted(clashing(docs), labels)
    assert set(CLASH) <= set(out.columns)


def test_quality_without_trusted_text(docs, labels):
    assert quality.classify(docs, labels.where("quality = 7")).where("not kept").count() == 0


def test_tokens(docs, spark, tmp_dir):
    tokens.write_tokens(clashing(docs), f"{tmp_dir}/t", tokens.tokenizer_file())
    got = sorted(((r.start, r.doc_id, r.n_tokens) for r in tokens.read_tokens(spark, f"{tmp_dir}/t").collect()))
    assert len(got) == len(DOCS) and [d for _, d, _ in got][:2] == [None, None]
    assert [s for s, _, _ in got] == [sum(n for _, _, n in got[:k]) for k in range(len(got))]
    assert {d: n for _, d, n in got if d in (2, 3, 4)} == {2: 1, 3: 1, 4: 1}


def test_pages(spark):
    rows = [(1, "http://a.b/c", "<p>x</p>"), (1, "http://a.b/c", "<p>x</p>"), (None, None, None), (2, "", ""), (3, "://", "<p>" + "long " * 100_000), (4, "http://a.b", "<div>" * 300 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.n_chars) for r in html.extract(clashing(pages)).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (None, 0), (2, 0), (3, 499_999), (4, 4)], key=str)
    none = spark.createDataFrame([], "page_id long, good int")
    assert urls.judge(clashing(pages), none).count() == len(rows)
    some = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "page_id long, good int")
    assert urls.judge(pages, some).count() == len(rows)


def test_empty_tables(spark, tmp_dir, labels, bench):
    docs = spark.createDataFrame([], SCHEMA)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert substrings.deduplicated(docs).count() == 0
    assert rules.report(docs).count() == 0
    assert mix.report(docs).count() == mix.mix(docs).count() == 0
    assert neardup.near_duplicates(docs).count() == neardup.dedup(docs).count() == 0
    assert decontaminate.report(docs, bench).count() == 0
    assert lm.scores(docs).count() == 0
    assert quality.classify(docs, labels).count() == 0
    assert html.extract(pages).count() == 0
    assert urls.judge(pages, spark.createDataFrame([], "page_id long, good int")).count() == 0
    tokens.write_tokens(docs, f"{tmp_dir}/t", tokens.tokenizer_file())
    assert tokens.read_tokens(spark, f"{tmp_dir}/t").count() == 0
    full = spark.createDataFrame(DOCS, SCHEMA)
    assert decontaminate.report(full, bench.where("false")).where("contaminated").count() == 0
    assert quality.classify(full, labels.where("false")).count() == len(DOCS)


def test_stray_surrogates_do_not_stop_the_row(spark):
    df = spark.createDataFrame([(1, "café \U0001f600 ‍ x")], "doc_id long, text string")
    assert lm.scores(df).count() == substrings.deduplicated(df).count() == 1
