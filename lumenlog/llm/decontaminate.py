"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Every training text is scanned once.  Its token windows are hashed inside the
row, exploded as (position, length, hash) and probed against the hashes of the
benchmark's windows; the hits are stored, and the words of the documents that have
one are compared with the benchmark's.  The hash set is broadcast only while the
benchmark has at most ``MAX_BROADCAST_GRAMS`` windows (counted first); beyond that the
same join is a shuffled one.

Defined results: null or word-less texts have no windows and are never
contaminated; null, empty or word-less items match nothing; every input row of
the documents gives one output row, also repeated rows and null ids; repeated
items count once per distinct ``item_id``; other columns are ignored (or kept
by ``remove``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, packed, split_words, stored, table

WINDOW = 10
MAX_BROADCAST_GRAMS = 200_000
#: Bits of the filter for texts with a hit: bounds what is broadcast at any size.
BUCKETS = 1 << 20
#: Everything in ASCII that is neither a letter nor a digit, after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def norm_words(text):
    return split_words(lower_ascii(text), SEPARATORS)


def _hashes(words):
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_grams(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(h, gram, items): each distinct window of the benchmark with the sorted
    ids of the items that hold it.  An item shorter than ``n`` is one window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), norm_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    m = F.least(F.lit(n), F.size("w"))
    grams = items.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - m + 1), lambda i: F.slice("w", i, m))).alias("gram"))
    return (grams.groupBy("gram").agg(F.collect_set("item").alias("items"))
            .select(F.xxhash64(_hashes(F.col("gram"))).alias("h"), "gram", "items"))


def _windows(m: int):
    """Every window of ``m`` words as (position, length, hash)."""
    each = F.transform(F.sequence(F.lit(1), F.size("hw") - (m - 1)), lambda i: F.struct(
        i.alias("p"), F.lit(m).alias("m"), F.xxhash64(F.slice("hw", i, m)).alias("h")))
    return F.when(F.size("hw") >= m, each).otherwise(F.array().cast("array<struct<p:int,m:int,h:bigint>>"))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, spans (sorted
    hit windows as (start, end), 0-based word positions), items (sorted)."""
    grams = benchmark_grams(benchmark, n)
    sizes = grams.groupBy(F.size("gram").alias("m")).count().collect()      # at most n rows
    key = F.xxhash64("text").alias("text_key")
    base = docs.select("doc_id", key, norm_words(F.col("text")).alias("w"))
    counted = base.select("doc_id", "text_key", F.size("w").cast("long").alias("n_words"))
    if not sizes:
        return counted.withColumns({"spans": F.array().cast("array<struct<s:int,e:int>>"), "items": F.array().cast("array<string>")})
    probe = grams.select("h", "gram", "items")
    hashes = probe.select("h").distinct()
    if sum(r["count"] for r in sizes) <= MAX_BROADCAST_GRAMS:
        hashes = F.broadcast(hashes)
    windows = [_windows(m) for m in sorted(r["m"] for r in sizes)]
    # a window is a few numbers; the words of the documents with a hit follow for those alone
    found = stored(base.select("doc_id", "text_key", _hashes(F.col("w")).alias("hw"))
                   .select("doc_id", "text_key", F.inline(F.concat(*windows) if len(windows) > 1 else windows[0]))
                   .join(hashes, "h", "left_semi")
                   .groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("p", "m", "h")).alias("at"))
                   .select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "at"), "window-hits")
    # at most BUCKETS numbers tell which texts may have a hit; only those are shuffled
    bucket = lambda d, k: F.pmod(F.xxhash64(d, k), F.lit(BUCKETS))       # noqa: E731
    marked = F.broadcast(found.select(bucket("d", "k").alias("bucket")).distinct())
    few = docs.select("doc_id", key, "text").withColumn("bucket", bucket("doc_id", "text_key")).join(marked, "bucket", "left_semi")
    # one row per text, however often its document is repeated
    few = few.groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))
    texts = (few.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
             .select("d", "k", norm_words(F.col("text")).alias("w"), "at"))
    said = texts.select("d", "k", F.inline(F.transform("at", lambda x: F.struct(x["p"].alias("p"), x["m"].alias("m"), x["h"].alias("h"), F.slice("w", x["p"], x["m"]).alias("words")))))
    hits = (said.join(probe, "h").where(F.col("words") == F.col("gram"))
            .groupBy("d", "k")
            .agg(F.array_sort(F.collect_set(F.struct((F.col("p") - 1).alias("s"), (F.col("p") + F.col("m") - 1).alias("e")))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    return (counted.join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
            .select("doc_id", "text_key", "n_words",
                    F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def covered(spans):
    """Number of word positions inside at least one of the sorted spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(spans, zero, lambda a, x: F.struct(
        F.greatest(a["end"], x["e"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["end"], x["s"]))).alias("n")), lambda a: a["n"].cast("long"))


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Per document: words, hit words, items met and a digest of their ids."""
    return contamination(docs, benchmark, n).select(
        "doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, mode: str = "documents") -> DataFrame:
    """``docs`` without its contaminated documents (``mode="documents"``) or
    with the hit words cut from their texts, separators that follow them
    included (``mode="spans"``).  All columns are kept."""
    found = (contamination(docs, benchmark, n).where(F.size("spans") > 0)
             .groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans")))
    rows = packed(docs, k=F.col("doc_id"), t=F.xxhash64("text"))
    on = F.col("k").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key"))
    if mode == "documents":
        return rows.join(found, on, "left_anti").select("row.*")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    rest = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    text = F.col("row.text")
    pieces = F.regexp_extract_all(text, F.lit(f"({word}{rest})"), 1)
    kept = F.filter(F.transform(pieces, lambda x, i: F.when(F.exists("spans", lambda s: (s["s"] <= i) & (i < s["e"])), F.lit(None)).otherwise(x)),
                    lambda x: x.isNotNull())
    cut = F.concat(F.regexp_extract(text, f"^({rest})", 1), F.array_join(kept, ""))
    changed = F.col("row").withField("text", F.when(F.col("spans").isNull(), text).otherwise(cut))
    return rows.join(found, on, "left").select(changed.alias("row")).select("row.*")


def op9_decontaminate(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH lo AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
it AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, m, list_slice(w, i, i + m - 1) AS gram
      FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM it WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM g),
dw AS (SELECT doc_id, i, m, list_slice(w, i, i + m - 1) AS gram
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lo, sizes WHERE len(w) >= m)),
hit AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN g ON dw.m = g.m AND dw.gram = g.gram),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT lo.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM lo LEFT JOIN pos ON lo.doc_id = pos.doc_id LEFT JOIN its ON lo.doc_id = its.doc_id
"""
