"""A table laid out for lookups by incident id.

Rows are range-partitioned and sorted by id, so a file holds a range of ids of its own
and a row group a narrower one; Parquet Bloom filters on the id settle most of what
the ranges leave.  A lookup filters by equality: row groups whose range or Bloom filter
excludes the id are not read.  ``ranges`` keeps the first and last id of every file, and
a lookup opens the files whose range holds the id only, so its cost does not grow with
the number of files.

An id with very many rows spans files: the range boundaries come with a second key, so
it is cut into several of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a file and bytes of a row group.
FILE_ROWS, GROUP_BYTES = 2_000_000, 8 << 20


def write_lookup(df: DataFrame, path: str, key: str = "incident_id", files: int | None = None, spread: str = "event_time",
                 distinct_per_file: int = 500_000, group_bytes: int = GROUP_BYTES, file_rows: int = FILE_ROWS) -> None:
    """Write ``df`` (rows with a null key are left out: no lookup asks for them) below
    ``path``/rows and the files' ranges to ``path``/ranges."""
    rows = df.where(F.col(key).isNotNull())
    by = [F.col(key), F.col(spread)]
    dealt = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    (dealt.sortWithinPartitions(*by).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct_per_file))
     .option("parquet.block.size", str(group_bytes)).option("maxRecordsPerFile", str(file_rows)).parquet(f"{path}/rows"))
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    (written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("rows"))
     .coalesce(1).sortWithinPartitions("lo").write.mode("overwrite").parquet(f"{path}/ranges"))


def lookup(spark: SparkSession, path: str, value: str, key: str = "incident_id") -> DataFrame:
    """The rows of one id.  What comes to the driver are the names of the files whose
    range holds it: one, or as many as the id's own rows fill."""
    ranges = spark.read.parquet(f"{path}/ranges")
    files = [r.file for r in ranges.where((F.col("lo") <= value) & (F.col("hi") >= value)).select("file").collect()]
    schema = spark.read.parquet(f"{path}/rows").schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(F.col(key) == value)


def lookup_many(spark: SparkSession, path: str, ids: DataFrame, key: str = "incident_id") -> DataFrame:
    """The rows of all ids of ``ids`` (one column, ``key``): a join on the key, planned by
    Spark's size checks; the files' ranges prune nothing here."""
    rows = spark.read.parquet(f"{path}/rows")
    return rows.join(ids.select(F.col(key).alias("__id")).distinct(), F.col(key) == F.col("__id"), "left_semi")
