"""Fill-in-middle: ranks and cuts against brute force, outputs against the twin, edges."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from lumenlog.llm import fim

SF = "/root/testdata/sf0.001"
EDGES = [(1, None), (2, ""), (3, "a <P> b"), (4, "<S>"), (5, "x<M>"), (6, "<"), (7, "<S <M P> <<<PSM>"), (8, " \n\n \t"), (9, "é日本😀" * 50), (10, "word " * 40_000), (10, "word " * 40_000), (None, "no id at all")]


def test_ranks():
    values = np.random.default_rng(1).integers(0, 6, 5000).astype(np.uint8)
    m = fim.WaveletMatrix(values)
    at = np.array([0, 1, 63, 64, 65, 127, 128, 4999, 5000])
    for v in range(8):
        assert m.rank(v, at).tolist() == [int((values[:i] == v).sum()) for i in at]
    assert fim.WaveletMatrix(np.zeros(0, np.uint8)).rank(0, np.array([0])).tolist() == [0]


def starts(text: str, unit: str) -> list[int]:
    if unit == "chars":
        return list(range(len(text)))
    if unit == "words":
        return [x.start() for x in re.finditer("[^ \t-\r]+", text)]
    return [k for k in range(len(text)) if k == 0 or text[k - 1] == "\n"]


@pytest.mark.parametrize("unit", ["chars", "words", "lines"])
def test_cuts(unit):
    r = random.Random(2)
    texts = ["".join(r.choice(" \n\tabé日😀") for _ in range(r.randrange(60))) for _ in range(400)] + ["", "\n", " ", "a"]
    h1, h2 = (np.array([r.randrange(1 << 32) for _ in texts]) for _ in range(2))
    n, first, second, cut1, cut2 = fim.cuts([t.encode() for t in texts], h1, h2, unit)
    for k, t in enumerate(texts):
        s = starts(t, unit)
        assert n[k] == len(s)
        want = sorted((int(h1[k]) % (len(s) + 1), int(h2[k]) % (len(s) + 1)))
        assert [first[k], second[k]] == want
        at = [0 if not x else s[x] if x < len(s) else len(t) for x in want]
        assert [cut1[k], cut2[k]] == [len(t[:x].encode()) for x in at]


def expected(doc_id, text):
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(t), "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    return (doc_id, len(t), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (doc_id, len(t), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_edges_and_round_trip(spark, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 1000)
    rows = EDGES + [(100 + k, "<" * (k % 7) + "S>P>M>" * (k % 5)) for k in range(200)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, digest string, n int")
    out = fim.restore(fim.transform(df)).collect()
    assert sorted((tuple(r)[:6] for r in out), key=str) == sorted((expected(*r) for r in rows), key=str)
    assert sorted(r.text for r in out) == sorted(t or "" for _, t in rows)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fim.transform(df.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["words", "lines"])
def test_units_restore(spark, unit):
    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    assert sorted(r.text for r in fim.restore(fim.transform(df, unit)).collect()) == sorted(t or "" for _, t in EDGES)


def test_twin(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF}/documents.parquet'")
    want = duckdb.sql(fim.ORACLE)
    got = fim.op12_fill_in_middle(spark, SF)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
