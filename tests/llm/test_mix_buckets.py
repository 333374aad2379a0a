"""No bucket of keys holds much of a source, whatever the weights are."""

from pyspark.sql import functions as F

from lumenlog.llm import mix


def test_buckets_are_even_for_any_weights(spark):
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    for weight in (F.lit(1.0), F.lit(1e-5), F.when(F.col("doc_id") % 2 == 0, 0.05).otherwise(1.0), F.lit(0.0), F.lit(1e6)):
        rows = mix.sized(docs, weight=weight)
        most = rows.groupBy("bucket").count().agg(F.max("count")).first()[0]
        assert most < 0.001 * 60_000
        # buckets follow the keys
        assert rows.groupBy("bucket").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("bucket").selectExpr("hi <= lead(lo, 1, hi) over (order by bucket) as ok").where("not ok").count() == 0


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string, bucket int, key int")
    assert mix.report(empty).count() == 0 and mix.mix(empty).columns == empty.columns
    nulls = spark.createDataFrame([(None, None, None, 1, 2), (None, None, None, 1, 2), (1, "", "s", 3, 4)], empty.schema)
    assert [r.taken for r in mix.report(nulls).collect()] == [0, 0, 0]
