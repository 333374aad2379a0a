"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a word target.  A source whose target is ``e`` and a bit times
its size gives ``e`` complete epochs; the rest is a weighted sample without
replacement: each document draws the exponential key ``-ln(u) / weight`` (u from
a hash of its id, weight its quality), and the documents with the smallest keys
are taken until their sizes fill the rest.

The prefix sum never sorts a whole source in one task.  Keys fall into
ordered buckets, ``STEPS`` to every doubling of the key whatever the weights are; sizes are
pre-aggregated per (source, bucket) and summed over the buckets; only the one bucket of
each source in which the rest runs out is sorted.  An exponential key of any
weight falls into one bucket with a chance of at most ln(2) / (e * ``STEPS``), 1 in 4,000.

Defined results: a null text has size 0; null sources are one source, ordered
last; a null or non-positive weight counts as the smallest weight ``MIN_WEIGHT``;
repeated ids draw equal keys and are ordered by text hash; identical rows are
interchangeable; other columns, also of clashing names, are ignored by ``report`` and
kept by ``mix``.  An empty table or a corpus without words takes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, packed, stored, table

SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2.0
STEPS = 1024
MIN_WEIGHT = 1e-6
#: Sources whose plan is broadcast to the documents; beyond, both are shuffled by source.
MAX_BROADCAST = 100_000


def word_count(text):
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("long")


def quality_weight(text):
    """A document's sampling weight: 1 for prose, less the more of its
    characters are symbols."""
    n = F.length(F.coalesce(text, F.lit("")))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * F.coalesce(F.regexp_count("text", F.lit(r"[#*$%&|<>]")), F.lit(0)) / F.greatest(n, F.lit(1)))


def targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, share: float = SHARE, most: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    With caps ``most * size``, the targets that reshare every excess by weight
    are ``min(cap, level * weight)`` for the one level at which they sum up to
    the whole.  Sources are capped in the order of cap / weight, so the level is
    found by running sums over the sources (one small row each).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.lit(most) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(1))
    s = (s.withColumn("total", F.lit(share) * F.sum("source_size").over(all_rows))
         .withColumn("capped", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("free", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("level", (F.col("total") - F.col("capped")) / F.col("free"))
         .withColumn("fits", F.col("level") * F.col("w") <= F.col("cap")))
    # the first source in this order that need not be capped gives the level of all
    s = s.withColumn("level", F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("w"), "level"))).over(all_rows)["level"])
    return s.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def sized(docs: DataFrame, seed: int = 0, weight=None) -> DataFrame:
    """Small rows (doc_id, tie, source, size, key, bucket) of ``docs``."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    weight = quality_weight(F.col("text")) if weight is None else weight
    weight = F.when(weight > MIN_WEIGHT, weight.cast("double")).otherwise(MIN_WEIGHT)
    key = -F.log(u) / weight
    # keys are between 2^-49 and 2^25, which bounds the number of buckets
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "source", word_count(F.col("text")).alias("size"), key.alias("key")).withColumn(
        "bucket", F.floor((F.log2("key") + 64.0) * STEPS).cast("int"))


def take(rows: DataFrame, weights=SOURCE_WEIGHTS, share: float = SHARE, most: float = MAX_EPOCHS) -> DataFrame:
    """``rows`` (as from ``sized``) with source_size, target and copies."""
    filled = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    filled = stored(filled, "mix-buckets")      # at most 75 * STEPS small rows per source
    plan = targets(filled.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    plan = (plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    run = Window.partitionBy("source").orderBy("bucket")
    cut = (filled.withColumn("upto", F.sum("words").over(run))
           .select(F.col("source").alias("__s"), "bucket", "words", "upto"))
    cut = (plan.join(cut, F.col("source").eqNullSafe(F.col("__s")))
           .where((F.col("upto") - F.col("words") < F.col("rest")))
           .groupBy("source", "source_size", "target", "epochs", "rest")
           .agg(F.max(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("last")))
    plan = (plan.select(F.col("source").alias("__s"), "source_size", "target", "epochs", "rest")
            .join(cut.select(F.col("source").alias("__c"), F.col("last.bucket").alias("cut"), F.col("last.before").alias("before")), F.col("__s").eqNullSafe(F.col("__c")), "left")
            .select("__s", "source_size", "target", "epochs", "rest", F.coalesce("cut", F.lit(-1)).alias("cut"), F.coalesce("before", F.lit(0)).alias("before")))
    if filled.select("source").distinct().count() <= MAX_BROADCAST:     # one small row per source
        plan = F.broadcast(plan)
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    edge = planned.where(F.col("bucket") == F.col("cut"))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a document is taken while at least half of it fits, so the error is at most half a document
    edge = edge.withColumn("upto", F.col("before") + F.sum("size").over(order)).withColumn(
        "copies", F.col("epochs") + (F.col("upto") - F.col("size") / 2 <= F.col("rest")).cast("int")).drop("upto")
    return planned.where(F.col("bucket") != F.col("cut")).withColumn(
        "copies", F.col("epochs") + (F.col("bucket") < F.col("cut")).cast("int")).unionByName(edge)


def report(docs: DataFrame, seed: int = 0, weight=None) -> DataFrame:
    rows = stored(sized(docs, seed, weight), "mix-sizes")
    return take(rows).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source")


def mix(docs: DataFrame, seed: int = 0, weight=None) -> DataFrame:
    """The mixture: every document as many times as it is taken, all columns.

    Equal rows (id, text and source) are counted together: their copies differ by
    one at most, so the first of them take one copy more."""
    rows = stored(sized(docs, seed, weight), "mix-sizes")
    keys = {"k1": F.xxhash64("doc_id", "tie", "source"), "k2": F.xxhash64("source", "tie", "doc_id", F.lit(1))}
    copies = (take(rows).select(*(c.alias(k) for k, c in keys.items()), "copies").groupBy("k1", "k2")
              .agg(F.min("copies").alias("least"), (F.sum("copies") - F.min("copies") * F.count("*")).alias("more")))
    tie = F.xxhash64("text")
    each = packed(docs, k1=F.xxhash64("doc_id", tie, "source"), k2=F.xxhash64("source", tie, "doc_id", F.lit(1)))
    each = each.withColumn("nth", F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(0))))
    n = F.col("least") + (F.col("nth") <= F.col("more")).cast("int")
    return each.join(copies, ["k1", "k2"]).where(n > 0).select("row", F.explode(F.sequence(F.lit(1), n)).alias("copy")).select("row.*")


def op4_mix(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
      1.0 / (1.0 + CAST(20.0 AS DOUBLE) * len(regexp_extract_all(t, '[#*$%&|<>]')) / greatest(length(t), 1)) AS wt,
      (CAST('0x' || substr(md5('0:' || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) + 0.5) / CAST(281474976710656 AS DOUBLE) AS u FROM d),
k AS (SELECT *, -ln(u) / CAST(wt AS DOUBLE) AS key FROM s),
src AS (SELECT source, sum(size) AS source_size FROM s GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)] AS w FROM src),
r AS (SELECT *, 2.0 * source_size AS cap, 1.5 * sum(source_size) OVER () AS total FROM w),
lv AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
       / sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
one AS (SELECT arg_min(level, cap / w) AS level FROM lv WHERE level * w <= cap),
tg AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, CAST(least(cap, one.level * w) AS DOUBLE) AS target FROM r, one),
e AS (SELECT *, floor(target / source_size) AS epochs FROM tg),
p AS (SELECT k.doc_id, k.source, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
      sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) AS upto
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken, source FROM p
"""
