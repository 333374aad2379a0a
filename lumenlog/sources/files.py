"""Batch scans of an incident directory (CSV with header, or Parquet).

CSV files are grouped by their header line and each group is one scan, so a
column is taken by its name whatever its place, and a column that a file lacks
reads as null.  A missing directory yields an empty typed frame; every other
storage error is raised.  Files of at most ``min_bytes`` hold no CSV record and
are left out; unreadable files fail the query unless ``skip_unreadable`` asks
otherwise, and ``skipped_files`` lists what a scan leaves out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import ENRICHED_SCHEMA

# Text form: event_time stays a string until parsed by ``feed.clean_feed``.
ENRICHED_TEXT_SCHEMA = StructType([
    StructField(f.name, StringType(), True) if f.name == "event_time" else f
    for f in ENRICHED_SCHEMA.fields
])

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',            # quotes inside a field are doubled (RFC 4180)
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Metadata check through the Hadoop FileSystem of ``path`` (no data read).
    A storage that cannot be asked raises."""
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, path: str, suffix: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files under ``path``, as Spark would list them."""
    fs, p = _file_system(spark, path)
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        name = str(f.getPath().toString())
        parts = name[len(path.rstrip("/")):].split("/")
        if name.endswith(suffix) and not any(x.startswith((".", "_")) and "=" not in x for x in parts):
            found.append((name, int(f.getLen())))
    return sorted(found)


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in a CSV file's first line."""
    import csv
    fs, p = _file_system(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader([line or ""]), ()))


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def skipped_files(spark: SparkSession, path: str, fmt: str = "csv", min_bytes: int = 10) -> DataFrame:
    """(path, bytes, reason) of the files that ``read_incident_dir`` leaves out:
    CSV files too small for a record, and with ``skip_unreadable`` Parquet files
    whose footer cannot be read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, bytes long, reason string")
    rows = []
    for name, size in list_files(spark, path, f".{fmt}"):
        if fmt == "csv" and size <= min_bytes:
            rows.append((name, size, "too small"))
        elif fmt == "parquet":
            try:
                spark.read.parquet(name).schema     # the footer only
            except Exception as e:  # noqa: BLE001 — reported, not swallowed
                rows.append((name, size, f"unreadable: {type(e).__name__}"))
    return spark.createDataFrame(rows, "path string, bytes long, reason string")


def _read_csv(spark: SparkSession, path: str, schema: StructType, min_bytes: int, multi_line: bool) -> DataFrame | None:
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, size in list_files(spark, path, ".csv"):
        if size > min_bytes:
            groups.setdefault(header_of(spark, name), []).append(name)
    out = None
    types = {f.name: f for f in schema.fields}
    for header, names in groups.items():
        by_place = StructType([types.get(c, StructField(c, StringType(), True)) for c in header])
        df = (spark.read.schema(by_place).options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower())
              .option("basePath", path).csv(names))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_incident_dir(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: StructType | None = None, min_bytes: int = 10,
                      na_values: list[str] | None = None,
                      hour_range: tuple[str, str] | None = None,
                      hour_col: str = "ingest_hour", multi_line: bool = False,
                      skip_unreadable: bool = False) -> DataFrame:
    """All incident files under ``path`` as one DataFrame.

    CSV keeps ``event_time`` as text (parse with ``feed.clean_feed``);
    Parquet reads the typed schema.  A column that a file lacks reads as null.
    ``na_values`` optionally lists extra text tokens meaning missing.
    ``multi_line`` allows line ends inside quoted CSV fields, at the price that
    one file is one task.

    Flat folders of files and hour-partitioned sink output
    (``<hour_col>=yyyy-MM-dd_HH/``) both work.  ``hour_range`` (inclusive
    ``yyyy-MM-dd_HH`` bounds) filters on the partition column, so only the
    matching hour folders are read (partition pruning).
    """
    if schema is None:
        schema = ENRICHED_TEXT_SCHEMA if fmt == "csv" else ENRICHED_SCHEMA
    if not path_exists(spark, path):
        return empty_frame(spark, schema)
    if fmt == "csv":
        df = _read_csv(spark, path, schema, min_bytes, multi_line)
        if df is None:
            return empty_frame(spark, schema)
    else:
        df = (spark.read.schema(schema).option("ignoreCorruptFiles", str(skip_unreadable).lower())
              .option("pathGlobFilter", "*.parquet").parquet(path))
    if hour_range is not None:
        df = df.where(F.col(hour_col).between(*hour_range))
    df = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    if na_values:
        df = df.select(*[F.when(F.col(f.name).isin(na_values), None).otherwise(F.col(f.name)).alias(f.name)
                         if isinstance(f.dataType, StringType) else F.col(f.name)
                         for f in schema.fields])
    return df
