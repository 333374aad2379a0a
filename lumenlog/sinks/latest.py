"""The latest row of every incident id as a maintained table.

Ids are hashed to ``buckets`` folders.  A micro-batch is reduced to one row per id,
merged with the present rows of the buckets it touches, and those buckets are written
anew in a folder of the batch; its manifest line comes last and publishes it.  A bucket's present version is that of the
last published batch that wrote it.  Batches may come in any order of event time: the merge is a
minimum over an order, so it does not matter.  A batch that is done again reads the
versions before its own and replaces its own folder, so it leaves the same table.

The cost of a batch is the buckets it touches, not the table; ``vacuum`` removes folders that
no bucket's present version needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.feed import latest_per_incident
from ..sources.files import _file_system, path_exists

BUCKETS = 64


def _versions(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(bucket, version): the present version of every bucket, of the batches before ``before``."""
    if not path_exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], "bucket int, version long")
    lines = spark.read.schema("bucket int, batch long").parquet(f"{path}/manifest")
    if before is not None:
        lines = lines.where(F.col("batch") < before)
    return lines.groupBy("bucket").agg(F.max("batch").alias("version"))


def _rows(spark: SparkSession, path: str, schema: StructType, versions: DataFrame) -> DataFrame:
    if not path_exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], schema)
    whole = StructType(list(schema.fields)).add("version", "long").add("bucket", "integer")
    # version and bucket are partition columns: other folders are not read
    rows = spark.read.schema(whole).parquet(f"{path}/rows")
    return rows.join(versions, ["version", "bucket"], "left_semi").select(*schema.names)


def upsert(batch: DataFrame, batch_id: int, path: str, buckets: int = BUCKETS, tiebreak: list[str] | None = None) -> None:
    """Merge one batch of rows into the table; usable as a foreachBatch handler."""
    spark = batch.sparkSession
    schema = batch.schema
    bucket = F.pmod(F.xxhash64("incident_id"), F.lit(buckets)).cast("int")
    new = latest_per_incident(batch, tiebreak).persist()
    try:
        touched = new.select(bucket.alias("bucket")).distinct()
        present = _versions(spark, path, batch_id).join(touched, "bucket", "left_semi")
        merged = latest_per_incident(_rows(spark, path, schema, present).unionByName(new), tiebreak)
        (merged.withColumn("bucket", bucket).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows/version={batch_id}"))
        touched.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch={batch_id}")
    finally:
        new.unpersist()


def start_latest(incidents: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS, trigger: dict | None = None, tiebreak: list[str] | None = None):
    """Keep the table at ``path`` from a stream."""
    return (incidents.writeStream.foreachBatch(lambda batch, batch_id: upsert(batch, batch_id, path, buckets, tiebreak))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})).start())


def read_latest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The present table; empty before the first batch."""
    return _rows(spark, path, schema, _versions(spark, path))


def latest_of(spark: SparkSession, path: str, schema: StructType, incident_id: str, buckets: int = BUCKETS) -> DataFrame:
    """The latest row of one id: one bucket of one version is read."""
    mine = F.pmod(F.xxhash64(F.lit(incident_id)), F.lit(buckets)).cast("int")
    return _rows(spark, path, schema, _versions(spark, path).where(F.col("bucket") == mine)).where(F.col("incident_id") == incident_id)


def vacuum(spark: SparkSession, path: str) -> list[int]:
    """Remove the version folders that hold no bucket's present rows; their numbers.
    The versions in use are at most one per bucket.  Readers that started before may still
    read a removed folder, so this belongs between batches."""
    used = {r.version for r in _versions(spark, path).select("version").distinct().collect()}
    fs, p = _file_system(spark, f"{path}/rows")
    gone = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("version=") and used and int(name[8:]) < max(used) and int(name[8:]) not in used:
            fs.delete(status.getPath(), True)
            gone.append(int(name[8:]))
    return sorted(gone)
