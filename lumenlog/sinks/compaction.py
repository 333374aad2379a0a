"""Compaction of an hour-partitioned Parquet table through a manifest.

The streaming sink leaves small files, some hours many and some few.  ``compact_hours``
packs every hour by its own bytes: the rows of an hour go to as many files as its
bytes fill at ``target_bytes``, whatever the other hours have.  The packed files are a new
generation beside the old files, and its manifest line, written last, publishes it.
``read_hours`` reads the hours of the last generation from there and the other hours from
the live table, so a reader sees every row once, before, during and after a compaction.

Hours that still receive rows are not packed: a generation takes the hours before
``before`` that hold more files than they need, and the hours it takes over from earlier generations stay with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.files import path_exists

_MANIFEST = "hour string, files long, bytes long, folder string, generation long"


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    """(hour, files, bytes, folder): where the rows of every packed hour lie."""
    if not path_exists(spark, f"{root}/manifest"):
        return spark.createDataFrame([], "hour string, files long, bytes long, folder string")
    lines = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    last = lines.groupBy("hour").agg(F.max_by(F.struct("files", "bytes", "folder"), "generation").alias("m"))
    return last.select("hour", "m.files", "m.bytes", "m.folder")


def hour_sizes(spark: SparkSession, path: str, hour_col: str, schema: StructType) -> DataFrame:
    """(hour, files, bytes) of a table by a distributed look at its files' metadata."""
    each = spark.read.schema(StructType(list(schema.fields)).add(hour_col, "string")).parquet(path).select(F.col(hour_col).alias("hour"), "_metadata.file_path", "_metadata.file_size")
    return each.groupBy("hour", "file_path").agg(F.max("file_size").alias("size")).groupBy("hour").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def compact_hours(spark: SparkSession, path: str, root: str, schema: StructType, hour_col: str = "event_hour",
                  target_bytes: int = 128 << 20, before: str | None = None) -> DataFrame:
    """Pack the hours of the table at ``path``; the generation lies below ``root``.  Returns
    the manifest lines of the hours that were packed."""
    sizes = hour_sizes(spark, path, hour_col, schema).join(_manifest(spark, root).select("hour"), "hour", "left_anti")
    need = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("long")
    work = sizes.withColumn("need", need).where(F.col("files") > F.col("need"))
    if before is not None:
        work = work.where(F.col("hour") < before)
    folder = f"{root}/packed-{uuid.uuid4().hex[:12]}"
    # the plan of the work is one row per hour; it is written so that rows and manifest follow the same plan
    work.coalesce(1).write.parquet(f"{folder}/plan")
    plan = spark.read.parquet(f"{folder}/plan").select(F.col("hour").alias("__hour"), "need")
    total = plan.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    rows = spark.read.schema(StructType(list(schema.fields)).add(hour_col, "string")).parquet(path).join(plan, F.col(hour_col) == F.col("__hour"))
    # an hour's rows are dealt to its own number of files by a hash of the row
    spread = F.pmod(F.xxhash64(*schema.names), F.col("need"))
    (rows.withColumn("__file", spread).repartition(max(1, int(total)), hour_col, "__file").sortWithinPartitions(hour_col, "__file")
     .select(*schema.names, hour_col).write.partitionBy(hour_col).parquet(f"{folder}/rows"))
    packed = spark.read.parquet(f"{folder}/plan").select("hour", F.lit(f"{folder}/rows").alias("folder"))
    if total:
        got = hour_sizes(spark, f"{folder}/rows", hour_col, schema)
        generation = (spark.read.schema(_MANIFEST).parquet(f"{root}/manifest").agg(F.coalesce(F.max("generation"), F.lit(-1))).first()[0] + 1) if path_exists(spark, f"{root}/manifest") else 0
        lines = got.join(packed, "hour").select("hour", "files", "bytes", "folder")
        lines.coalesce(1).write.parquet(f"{root}/manifest/generation={generation}")
        return lines
    return spark.createDataFrame([], "hour string, files long, bytes long, folder string")


def read_hours(spark: SparkSession, path: str, root: str, schema: StructType, hour_col: str = "event_hour") -> DataFrame:
    """Every row once: packed hours from their generation, the others from the live table.
    What comes to the driver are the folders of the generations in use."""
    whole = StructType(list(schema.fields)).add(hour_col, "string")
    manifest = _manifest(spark, root)
    out = spark.read.schema(whole).parquet(path).join(manifest.select(F.col("hour").alias("__hour")), F.col(hour_col) == F.col("__hour"), "left_anti")
    for r in manifest.select("folder").distinct().collect():
        mine = manifest.where(F.col("folder") == r.folder).select(F.col("hour").alias("__hour"))
        out = out.unionByName(spark.read.schema(whole).parquet(r.folder).join(mine, F.col(hour_col) == F.col("__hour"), "left_semi"))
    return out
