"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one failure bit per rule; a policy is a named, versioned set of rules, so
applying or changing a policy is a bitwise test on the ledger and ablations are
aggregations over the few distinct bit patterns, with no text read again.

All is row-local: no shuffle and no Python.

Defined results: a null or empty text has 0 of everything and fails
``too_few_words``; every row gives one row, also repeated ones; other columns
are ignored.  Repeats of 5-word windows are found by 64-bit hashes of the words
inside one document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import split_words, table

MIN_WORDS = 10
SHINGLE = 5
#: rule name -> failure condition on the measurements; the position is the bit
RULES = {
    "too_few_words": "n_words < 10",
    "repeated_shingles": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 5 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "no_spaces": "n_words > 0 AND max_word_chars > 200",
    "upper_case": "2 * n_upper > word_chars",
}
BASE_RULES = ("too_few_words", "repeated_shingles")
#: (name, version) -> rules that reject
POLICIES = {
    ("base", 1): BASE_RULES,
    ("prose", 1): BASE_RULES + ("symbols", "duplicate_lines", "short_words", "long_words"),
    ("prose", 2): tuple(RULES),
}


def mask(rules) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def _repeat_words():
    """Words inside a 5-word window that occurs twice or more.

    Most texts have no repeated window: one primitive sort of the hashes tells.
    Only where two neighbours are equal, the windows are sorted again with
    their positions and the union of the repeated ones is measured."""
    hashes = F.when(F.size("hw") >= SHINGLE, F.transform(F.sequence(F.lit(1), F.size("hw") - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice("hw", i, SHINGLE)))
                    ).otherwise(F.array().cast("array<bigint>"))
    ordered = F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    flagged = F.transform("__o", lambda x, k: F.when(
        (F.get("__o", k - 1)["h"] == x["h"]) | (F.get("__o", k + 1)["h"] == x["h"]), x["i"]))
    starts = F.array_sort(F.filter("__f", lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    union = F.aggregate("__p", zero, lambda a, i: F.struct(
        (i + SHINGLE).alias("end"), (a["n"] + SHINGLE - F.greatest(F.lit(0), a["end"] - i)).alias("n")), lambda a: a["n"])
    return hashes, ordered, flagged, starts, union


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and every measurement that a rule uses."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashes, ordered, flagged, starts, union = _repeat_words()
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select("doc_id", text.alias("t"), split_words(F.col("text")).alias("w"))
    d = d.withColumns({
        "lines": lines, "joined": F.array_join("w", ""),
        "hw": F.transform("w", lambda x: F.xxhash64(x)),
    })
    d = d.select("doc_id", F.size("w").cast("long").alias("n_words"), F.length("joined").cast("long").alias("word_chars"),
                 F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                 F.regexp_count("joined", F.lit(r"[A-Z]")).cast("long").alias("n_upper"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.coalesce(F.array_max(F.transform("w", lambda x: F.length(x))), F.lit(0)).cast("long").alias("max_word_chars"),
                 hashes.alias("__h"))
    # an array that is its own distinct has no repeated window
    d = d.withColumn("__r", F.size("__h") != F.size(F.array_distinct("__h")))
    d = d.withColumn("__o", F.when(F.col("__r"), ordered)).withColumn("__f", F.when(F.col("__r"), flagged)).withColumn("__p", F.when(F.col("__r"), starts))
    return d.withColumn("n_repeat_words", F.when(F.col("__r"), union).otherwise(0).cast("long")).drop("__h", "__r", "__o", "__f", "__p")


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements plus ``bits``: bit k is set if rule k fails."""
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.expr(c), F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(RULES.values())])
    return measure(docs).withColumn("bits", bits)


def apply_policy(led: DataFrame, name: str = "prose", version: int = 1) -> DataFrame:
    """The ledger with ``kept`` under one policy."""
    return led.withColumn("kept", F.col("bits").bitwiseAND(F.lit(mask(POLICIES[name, version]))) == 0)


def ablation(led: DataFrame, name: str = "prose", version: int = 1) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and
    that the policy without it would keep.  One aggregation over bit patterns."""
    rules = POLICIES[name, version]
    whole = mask(rules)
    patterns = led.groupBy(F.col("bits").bitwiseAND(F.lit(whole)).alias("p")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).alias("m")) for r in rules]))
    hit = F.col("p").bitwiseAND(F.col("r.m")) != 0
    rest = F.col("p").bitwiseAND(F.lit(whole) - F.col("r.m")) == 0
    return (patterns.select("p", "n", each.alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(hit & rest, F.col("n")).otherwise(0)).alias("failed_alone"),
                 F.sum(F.when(rest, F.col("n")).otherwise(0)).alias("kept_without")))


def report(docs: DataFrame, name: str = "prose", version: int = 1) -> DataFrame:
    base = F.col("bits").bitwiseAND(F.lit(mask(BASE_RULES))) != 0
    return apply_policy(ledger(docs), name, version).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "bits")


def op2_quality_rules(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, i, list_slice(w, i, i + 4) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, s FROM g GROUP BY doc_id, s HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT g.doc_id, unnest(range(i, i + 5)) AS p FROM g JOIN twice ON g.doc_id = twice.doc_id AND g.s = twice.s) GROUP BY doc_id),
v AS (SELECT m.doc_id, n_words, word_chars, n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
      CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM m LEFT JOIN rep ON m.doc_id = rep.doc_id),
f AS (SELECT v.*, n_words < 10 AS b0, 100 * n_repeat_words > 20 * n_words AS b1, 10 * n_symbols > n_words AS b2, 10 * n_dup_lines > 5 * n_lines AS b3,
      word_chars < 2 * n_words AS b4, word_chars > 15 * n_words AS b5,
      n_words > 0 AND coalesce(list_max(list_transform(d.w, lambda x: length(x))), 0) > 200 AS b6,
      2 * len(regexp_extract_all(array_to_string(d.w, ''), '[A-Z]')) > word_chars AS b7 FROM v JOIN d ON v.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 OR b1 AS base_failed,
       NOT (b0 OR b1 OR b2 OR b3 OR b4 OR b5) AS kept,
       CAST(b0::INT + 2 * b1::INT + 4 * b2::INT + 8 * b3::INT + 16 * b4::INT + 32 * b5::INT + 64 * b6::INT + 128 * b7::INT AS INTEGER) AS bits
FROM f
"""
