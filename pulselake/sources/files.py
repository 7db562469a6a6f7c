"""Scans of raw captures laid out as ``{root}/{source}/{collection}/dt=YYYY-MM-DD/{file}``.

Sidecars (``*.meta.json``) lie beside payloads and are never read as payloads:
the file-name predicate is pruned at the scan, so they are not even opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import csv_cells
from ..functions.exprs import text_lines as text_lines_of

PAYLOAD = "filename string, j string"
SIDECAR = "source string, collection string, fetched_at string, fetched_at_unix_ms bigint, byte_size bigint, sha256 string, stored_encoding string, schema_version string, http_status int, content_type string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _pattern(root: str, source: str, collection: str) -> str:
    return f"{root}/{source}/{collection}/dt=*/*"


def _payload_file() -> Column:
    return ~F.endswith(F.col("_metadata.file_name"), F.lit(".meta.json"))


def payloads(spark: SparkSession, root: str, source: str, collection: str) -> DataFrame:
    """``(filename, j)``: one row per payload file; typed and empty if there is none."""
    path = _pattern(root, source, collection)
    if not exists(spark, path):
        return spark.createDataFrame([], PAYLOAD)
    return spark.read.text(path, wholetext=True).where(_payload_file()).select(F.col("_metadata.file_path").alias("filename"), F.col("value").alias("j"))


def malformed(df: DataFrame) -> DataFrame:
    """Payloads that are no JSON: a strict build fails when this has rows."""
    return df.where(F.json_object_keys("j").isNull() & F.json_array_length("j").isNull())


def csv_rows(spark: SparkSession, root: str, source: str, collection: str, columns: dict[str, str]) -> DataFrame:
    """Named columns of CSV files by header, all text, with ``filename``.

    One scan of whole files, each read by its own header in its own task, so
    neither files nor headers are listed on the driver and files of different
    headers need no passes of their own. A column a file lacks and an empty cell
    are null; a line break inside quotes ends the line.
    """
    schema = T.StructType([T.StructField(a, T.StringType()) for a in columns] + [T.StructField("filename", T.StringType())])
    path = _pattern(root, source, collection)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    whole = spark.read.text(path, wholetext=True).where(_payload_file()).select(text_lines_of(F.regexp_replace("value", "^\ufeff", "")).alias("lines"), F.col("_metadata.file_path").alias("filename"))
    headed = whole.withColumn("head", csv_cells(F.get("lines", F.lit(0))))
    rows = headed.select("filename", "head", F.explode(F.slice("lines", F.lit(2), F.greatest(F.size("lines"), F.lit(1)))).alias("line")).withColumn("cells", csv_cells(F.col("line")))
    return rows.select(*[F.nullif(F.get("cells", F.array_position("head", F.lit(h)).cast("int") - 1), F.lit("")).alias(a) for a, h in columns.items()], "filename")


def text_lines(spark: SparkSession, root: str, source: str, collection: str) -> DataFrame:
    """``(filename, line)``: one row per line that is not blank."""
    path = _pattern(root, source, collection)
    if not exists(spark, path):
        return spark.createDataFrame([], "filename string, line string")
    rows = spark.read.text(path).where(_payload_file())
    return rows.where(F.trim(F.col("value")) != "").select(F.col("_metadata.file_path").alias("filename"), F.col("value").alias("line"))


def rows_of_day(lines: DataFrame, yyyymmdd: str) -> DataFrame:
    """Lines whose second field is the day, verbatim."""
    return lines.where(F.get(F.split(F.trim("line"), r"\s+"), 1) == yyyymmdd)


def parquet_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or a typed empty one while it has not been written yet."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def sidecars(spark: SparkSession, root: str, source: str = "*", collection: str = "*") -> DataFrame:
    path = _pattern(root, source, collection) + ".meta.json"
    if not exists(spark, path):
        return spark.createDataFrame([], f"stem string, {SIDECAR}")
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.col("_metadata.file_path"), r"(\.json|\.csv|\.txt)?\.meta\.json$", "").alias("stem"), F.from_json("value", SIDECAR).alias("m"))
    return raw.select("stem", "m.*")


def captures(spark: SparkSession, root: str, source: str = "*", collection: str = "*") -> DataFrame:
    """Payload bytes with their sidecar: path, source, collection, day, stem, content and provenance.

    Spark does not read files of no bytes. Such a payload, or one that is gone,
    shows as its sidecar with empty content and the path without ending.
    """
    path = _pattern(root, source, collection)
    if not exists(spark, path):
        return spark.createDataFrame([], f"path string, source_name string, collection_name string, dt date, file_fetched_ms bigint, content binary, stem string, {SIDECAR}, has_sidecar boolean")
    place = r"/([^/]+)/([^/]+)/dt=(\d{4}-\d{2}-\d{2})/[^/]+$"
    raw = spark.read.format("binaryFile").load(path).where(~F.endswith("path", F.lit(".meta.json"))).select("path", "content", F.regexp_replace("path", r"\.[A-Za-z0-9]+(\.gz)?$", "").alias("stem"))
    side = sidecars(spark, root, source, collection).withColumn("has_sidecar", F.lit(True))
    both = raw.join(side, "stem", "full_outer").withColumns({"path": F.coalesce("path", "stem"), "content": F.coalesce("content", F.lit(b"")), "has_sidecar": F.coalesce("has_sidecar", F.lit(False))})
    return both.select(
        "path",
        F.regexp_extract("path", place, 1).alias("source_name"),
        F.regexp_extract("path", place, 2).alias("collection_name"),
        F.regexp_extract("path", place, 3).try_cast("date").alias("dt"),
        F.regexp_extract("path", r"_([0-9]{13})_", 1).try_cast("bigint").alias("file_fetched_ms"),
        "content",
        "stem",
        *[c for c in side.columns if c != "stem"],
    )
