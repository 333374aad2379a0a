"""Phrases: index and counts against brute force, the query against its twin, edges."""

import random
import re
from collections import Counter

import duckdb
import numpy as np

from lumenlog.llm import phrases

SF = "/root/testdata/sf0.001"


def test_index_counts_every_phrase():
    r = np.random.default_rng(6)
    text = np.concatenate([[0], r.integers(0, 6, 3000), [0]])
    fm = phrases.Index(phrases.transform(text))
    at = fm.words(np.array([False, True, True, True, False, True]))     # word 4 is not kept
    names = {int(w): (int(w),) for w in np.unique(at) if w >= 0}
    for d in range(2, 5):
        at, head, tail, count = fm.extend(at)
        names = {k: names[int(h)] + names[int(t)][-1:] for k, (h, t) in enumerate(zip(head, tail, strict=True))}
        want = Counter(g for g in (tuple(text[i:i + d].tolist()) for i in range(len(text) - d + 1)) if not {0, 4} & set(g))
        assert {names[k]: int(n) for k, n in enumerate(count)} == want


def brute(rows, min_count=30, contained=80, top=2000, depth=4):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for d in range(1, depth + 1):
                f.update((lang, tuple(w[i:i + d])) for i in range(len(w) - d + 1))
    cand = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= min_count}
    dropped = set()
    for (lang, w), n in cand.items():
        for d in range(2, len(w)):
            for i in range(len(w) - d + 1):
                inner = (lang, w[i:i + d])
                if 100 * n >= contained * f[inner]:
                    dropped.add(inner)
    out = []
    for lang in total:
        best = []
        for (g, w), a in cand.items():
            if g == lang and (g, w) not in dropped:
                score, _, left, right = min((2_000_000 * a // (f[g, w[:k]] + f[g, w[k:]]), k, f[g, w[:k]], f[g, w[k:]]) for k in range(1, len(w)))
                best.append((-score, -a, " ".join(w).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, total[lang], -s) for k, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def test_small_shards_against_brute_force(spark):
    r = random.Random(7)
    words = ["a", "B", "c", "Dé", "日本", "x-y", "z"]
    rows = [(r.choice(["en", "de", None]), "".join(r.choice(words) + r.choice(["  ", " ", " ", "\t", ". ", "\n", "!?"]) for _ in range(r.randrange(60)))) for _ in range(200)]
    rows += [("en", None), (None, ""), ("fr", "..."), ("en", "same row same row"), ("en", "same row same row"), ("de", "long text of many words " * 5000)]
    df = spark.createDataFrame([(*x, "clash", 3, 4) for x in rows], "lang string, text string, phrase string, n int, shard int").repartition(3)
    want = brute(rows)
    assert len({x[0] for x in want}) == 3 and any(len(x[2].split()) == 4 for x in want)
    for size in (1, 50, 1 << 21):
        assert sorted(map(tuple, phrases.collocations(df, shard_words=size).collect())) == want
    assert sorted(map(tuple, phrases.collocations(df, depth=3, min_count=5, contained=50, top=4).collect())) == brute(rows, 5, 50, 4, 3)


def test_empty(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("en", " ")], "lang string, text string")).count() == 0


def test_wide_products(spark, monkeypatch):
    """Counts whose products pass 64 bits are scored exactly."""
    big = 6_000_000_000_000_000_003
    totals = spark.createDataFrame([("en", big)], "lang string, n long")
    cols = "id long, lang string, phrase string, last string, f long, starts array<long>, ends array<long>, head long, tail long"
    one = spark.createDataFrame([(1, "en", "a", "a", big, [big], [big], None, None), (2, "en", "b", "b", big, [big], [big], None, None)], cols)
    two = spark.createDataFrame([(1, "en", "a b", "b", big - 7, [big, big - 7], [big, big - 7], 1, 2)], cols)
    monkeypatch.setattr(phrases, "counts", lambda *a: (totals, [one, two]))
    assert [tuple(r) for r in phrases.collocations(None, depth=2).collect()] == [("en", 1, "a b", big - 7, big, big, big, 2_000_000 * (big - 7) // (2 * big))]


def test_twin(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF}/documents.parquet'")
    want = duckdb.sql(phrases.ORACLE)
    got = phrases.op13_phrases(spark, SF)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
