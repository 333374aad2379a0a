"""Every operator on the small tables: DuckDB twins or brute force in Python."""

import re
import zlib
from collections import Counter
from html import unescape

import duckdb
import numpy as np
import pytest

from lumenlog.llm import decontaminate, html, lm, mix, neardup, ppm, quality, queries, rules, substrings, tokens, urls

SF = "/root/testdata/sf0.001"
LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def close(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 1e-6 * max(1, abs(a))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, con, name):
    df = queries.queries()[name](spark, SF)
    rel = con.sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = rel.columns
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    want = sorted(rel.fetchall(), key=str)
    assert len(got) == len(want) > 0
    assert all(close(x, y) for a, b in zip(got, want, strict=True) for x, y in zip(a, b, strict=True))


def shingle_set(text, width=5):
    w = (text or "").encode().translate(LOW).split()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(sets, per_cent=85):
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= per_cent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}


def test_near_dedup_against_all_pairs(spark, con):
    sets = {d: shingle_set(t) for d, t in con.sql("select doc_id, text from documents").fetchall()}
    comp = brute_components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.queries()["op5_near_dedup"](spark, SF).collect()}
    assert got == {d: (len(s), comp[d], comp[d] == d) for d, s in sets.items()}


def test_near_dedup_large_groups(spark, monkeypatch):
    """A node that stays large on every level, cut into blocks of work."""
    monkeypatch.setattr(neardup, "NODE", 4)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    words = [f"w{i}" for i in range(200)]
    docs = [(k, " ".join([*words[:k], f"x{k}", *words[k + 1:]])) for k in range(60)] + [(100 + k, " ".join(f"y{k}z{i}" for i in range(50))) for k in range(5)]
    sets = {d: shingle_set(t) for d, t in docs}
    comp = brute_components(sets)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == comp and max(Counter(comp.values()).values()) > 50


def test_token_files_round_trip(spark, con, tmp_dir):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_file())
    want, start = {}, 0
    for d, text in con.sql("select doc_id, text from documents order by doc_id").fetchall():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want[d] = (start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
        start += len(ids)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    tokens.write_tokens(docs, f"{tmp_dir}/t", tokens.tokenizer_file())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in tokens.read_tokens(spark, f"{tmp_dir}/t", ids=True).collect()}
    assert got == want


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], list(range(0, 70000, 7))])
def test_coding_round_trip(values):
    r = np.array(values, np.uint32)
    counts = np.array([len(r), 0, 1, len(r)])
    control, data = tokens.pack(np.concatenate([r, [7], r]).astype(np.uint32), counts)
    assert len(control) == 2 * -(-len(r) // 4) + 1
    assert tokens.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), counts).tolist() == [*values, 7, *values]


def test_word_encoder_equals_whole_text():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_file())
    enc = tokens.Encoder(tokens.tokenizer_file())
    for text in ["Hello, World!! it's I'M don't 3.14 a_b e-mail", "x<|endoftext|>y <|ENDOFTEXT|>", "Élan naïve ß Ǆ İstanbul ﬁ", "tab\tnew\nline\x0bv\x0cf\rr\x1cs\x85n\xa0b",
                 "é ́ a‍b", "日本語 テスト。", "$$$ a$$$ b&&&c ...", "", "  ", "ABC.def, 'quoted' ''s 's", "Été, ÉTÉ! naïve. caf3 x2. ²a ªb", ". ,. !?"]:
        assert enc.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_lm_scores_against_brute_force(spark, con, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 500)
    docs = con.sql("select doc_id, text from documents").fetchall()
    toks = {d: lm.tokens_of(t) for d, t in docs}
    out = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in toks}
    c = Counter(w for d, ts in toks.items() if not out[d] for w in ts)
    n, v = sum(c.values()), len(c)
    grams = ppm.count(list(c), np.array(list(c.values()), float))
    least = max(1, lm.SHARE * sum(k * (len(w) + 1) for w, k in c.items()))
    trie = ppm.Trie([(a[b >= least], b[b >= least]) for a, b in grams])
    words = sorted({w for ts in toks.values() for w in ts})
    logp = dict(zip(words, trie.score(words), strict=True))
    got = {r.doc_id: r for r in queries.queries()["op3_lm_scores"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d, ts in toks.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[d], len(ts), sum(c[w] > 0 for w in ts), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts), abs=1e-6)
        assert r.score == pytest.approx(sum(logp[w] for w in ts), abs=1e-6)


def slow_ppm(c, word):
    """The model read off its definition, symbol by symbol."""
    def follow(ctx):
        return Counter({s: n for (x, s), n in table.items() if x == ctx})

    table = Counter()
    for w, n in c.items():
        stream = b" " + (w if w == b"\n" else w + b" ")
        for i in range(1, len(stream)):
            for k in range(min(i, ppm.ORDER) + 1):
                table[stream[i - k:i], stream[i]] += n
    total = 0.0
    stream = b" " + (word if word == b"\n" else word + b" ")
    for i in range(1, len(stream)):
        gone, done = set(), False
        for k in range(min(i, ppm.ORDER), -1, -1):
            seen = {s: n for s, n in follow(stream[i - k:i]).items() if s not in gone}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if stream[i] in seen:
                total += np.log10(seen[stream[i]] / whole)
                done = True
                break
            total += np.log10(len(seen) / whole)
            gone |= set(seen)
        if not done:
            total -= np.log10(256 - len(gone))
    return total


def test_ppm_against_definition():
    c = Counter({b"abra": 3, b"abracad": 2, b"cab": 1, b"\n": 4, "é".encode(): 1})
    trie = ppm.Trie(ppm.count(list(c), np.array(list(c.values()), float)))
    for w in [*c, b"abx", b"zzz", b"a", b"abracadabra"]:
        assert trie.score([w])[0] == pytest.approx(slow_ppm(c, w))


def test_ppm_distribution_sums_to_one():
    c = Counter({b"abra": 30, b"abracad": 20, b"cab": 1, b"\n": 4})
    for least in (1, 10):
        trie = ppm.Trie([(a[n >= least], n[n >= least]) for a, n in ppm.count(list(c), np.array(list(c.values()), float))])
        for prefix in (b" ", b" a", b" ab", b" q"):
            code = sum(b << (8 * (len(prefix) - k)) for k, b in enumerate(prefix))
            codes = np.array([code | s for s in range(256)], np.uint64)
            assert (10 ** trie._codes(codes, np.full(256, len(prefix)))).sum() == pytest.approx(1)


def test_main_text(spark, con):
    def simple(h):
        body = re.search(r"<article>(.*?)</article>", h or "", re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        return "\n".join(p for p in parts if p)

    want = {p: simple(h) for p, h in con.sql("select page_id, html from pages").fetchall()}
    got = {r.page_id: (r.text, r.n_chars) for r in queries.queries()["op6_main_text"](spark, SF).collect()}
    assert got == {p: (t, len(t)) for p, t in want.items()}


def test_main_text_of_other_layouts():
    page = ('<html><head><title>t</title></head><body><header><a href="/">Site</a></header><div class="menu">m1 m2</div><div id="cookie-notice">We use cookies</div>'
            '<main><h1>Head &amp; line</h1><p>one<br>two <b>bold</b><p>three &#233;</p><ul><li>i<li>j</ul><form><p>Your mail</p></form>'
            '<div class="comments"><p>first!</p></div></main><aside>side</aside><div class="ads">buy</div><script>var x = "<p>no</p>";</script><footer>f</footer></body></html>')
    assert [t for _, t in html.parse(page)[1]] == ["Head & line", "one two bold", "three é", "i", "j"]
    assert html.parse(None)[1] == [] and html.parse("just text")[1] == [(0, "just text")]


def test_simple_tree_matching():
    a, b = "(body(h1 div(p ) p ) )", "(body(nav h1 p ) )"
    partner = html.matched(a, b)
    assert partner == [0, 1, 3, -1, -1, 4]


def test_constant_slots_are_template(spark):
    rows = [(k, "http://h.org/x", f"<div><p>Share this page</p><p>story {k} of many</p><h2>Read more</h2></div>") for k in range(12)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"story {k} of many" for k in range(12)}


def test_url_rules_and_verdicts(spark):
    rows = [(0, "http://a.net/x"), (1, "https://www.example.net/en/5?x"), (2, "http://example.com/de/1.html#t"), (3, "http://x.org/fr/2"), (4, "http://x.org/en/2"),
            (5, None), (6, "no scheme"), (7, "http://EXAMPLE.com"), (8, "http://example.com/dex"), (9, "http://badnet/")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(
        spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([], "page_id long, good int")).collect()}
    assert got == {0: ("a.net", "/x", "net/", "block"), 1: ("www.example.net", "/en/5", "example.net/en/", "allow"), 2: ("example.com", "/de/1.html", "example.com/de/", "block"),
                   3: ("x.org", "/fr/2", "org/fr/", "allow"), 4: ("x.org", "/en/2", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
                   7: ("example.com", "", None, "allow"), 8: ("example.com", "/dex", None, "allow"), 9: ("badnet", "/", None, "allow")}


def test_url_templates_merge_and_reject(spark):
    pages, labels = [], []
    for k in range(300):
        kind = ("en", "fr", "spam")[k % 3]
        tail = f"{k}/deal/{k * 7}" if kind == "spam" else f"{k}"
        pages.append((k, f"http://h.org/{kind}/{tail}"))
        labels.append((k, 0 if kind == "spam" else 1))
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, good int"), rules=()).collect()}
    assert {got[k].verdict for k in range(0, 300, 3)} == {got[k].verdict for k in range(1, 300, 3)} == {"allow"}
    assert {got[k].verdict for k in range(2, 300, 3)} == {"block"}
    many = [(k, f"http://u.org/user{chr(97 + k % 26)}{chr(97 + k // 26)}/post") for k in range(200)]
    shapes = {r.template for r in urls.judge(spark.createDataFrame(many, "page_id long, url string"), spark.createDataFrame([], "page_id long, good int"), rules=()).collect()}
    assert shapes == {"/*/post/"}


def test_classifier_keeps_clean_and_rejects_junk(spark, con):
    sf = SF.replace("0.001", "0.01")
    got = {r.doc_id: r.kept for r in quality.op8_quality_classifier(spark, sf).collect()}
    labels = con.sql(f"select doc_id, quality, toxic from '{sf}/labels.parquet'").fetchall()
    clean = [got[d] for d, q, t in labels if q == 1 and t == 0]
    junk = [got[d] for d, q, t in labels if q == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.2 * len(junk)



def test_ablation(spark, con):
    led = rules.ledger(spark.read.parquet(f"{SF}/documents.parquet"))
    bits = [r.bits for r in led.select("bits").collect()]
    whole = rules.mask(rules.POLICIES["prose", 2])
    for r in rules.ablation(led, "prose", 2).collect():
        m = rules.mask([r.rule])
        assert r.failed == sum(b & m != 0 for b in bits)
        assert r.failed_alone == sum(b & whole == m for b in bits)
        assert r.kept_without == sum(b & (whole - m) == 0 for b in bits)


def test_mixture_meets_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rep = {r.doc_id: r for r in mix.report(docs).collect()}
    by = {}
    for r in rep.values():
        t = by.setdefault(r.source, [0, r.target, 0])
        t[0] += r.taken
        t[2] = max(t[2], r.size)
        assert r.taken <= 2 * r.size
    assert all(abs(taken - target) <= most for taken, target, most in by.values())
    copies = Counter(r.doc_id for r in mix.mix(docs).select("doc_id").collect())
    assert all(copies[d] * r.size == r.taken for d, r in rep.items())


def test_substrings_texts(spark):
    a = " ".join(f"w{i}" for i in range(40))
    docs = [(1, a), (2, "start " + a + " end"), (3, a), (4, "short"), (5, "x " * 30), (6, "y " + "x " * 30)]
    got = {r.doc_id: (r.n_removed, r.text) for r in substrings.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"), texts=True).collect()}
    assert got == {1: (0, a), 2: (40, "start end"), 3: (40, ""), 4: (0, "short"), 5: (0, ("x " * 30).strip()), 6: (30, "y")}


def test_spans_are_cut(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"(Before) {item.upper()}, after."), (2, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.remove(docs, bench, mode="spans").collect()}
    assert got == {1: "(Before) after.", 2: "clean"}
    assert [r.doc_id for r in decontaminate.remove(docs, bench).collect()] == [2]
