"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import os
import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: the separators between words.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
#: The same case mapping for bytes.
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, separators: str = SPACE) -> Column:
    """Array of the words of ``text``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where that is unset a local session gets a folder of its own, registered so that
    ``checkpoint()`` works too; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_dir.isDefined():
            root = os.path.dirname(set_dir.get().rstrip("/"))
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one for a table that one run writes."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder (or ``folder``) and read back: cuts the
    lineage, and every later use reads the table instead of computing again."""
    path = f"{folder}/{name}" if folder else scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files go with the query that wrote them: for steps whose results are all stored."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of ``scratch`` that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` as one struct ``row`` beside ``keys``: whatever columns a caller
    has, none can clash with the keys.  ``select("row.*")`` unpacks."""
    return docs.select(F.struct("*").alias("row"), *(c.alias(name) for name, c in keys.items()))
