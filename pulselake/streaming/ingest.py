"""Streaming forms: files once each, trailing re-capture, latest record per key."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import dedup_latest
from ..sources.files import exists
from ..sources.sinks import read_small, write_small


def new_files(spark: SparkSession, path: str) -> DataFrame:
    """A stream of ``(filename, j)``: each file once; the checkpoint is the ledger of those seen."""
    raw = spark.readStream.text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("filename"), F.col("value").alias("j")).where(~F.endswith("filename", F.lit(".meta.json")))


def ingest_available(stream: DataFrame, dest: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived and stop; a second run finds nothing new."""
    return stream.writeStream.format("parquet").option("path", dest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_latest(stream: DataFrame, dest: str, checkpoint: str, keys: list[str], latest_by: list[str], buckets: int = 256) -> StreamingQuery:
    """Keep the latest record per key at ``dest``; late corrections win by ``latest_by``.

    Keys fall into ``buckets`` by hash. A micro-batch reads and writes again only
    the buckets it touches; a manifest per batch names the folder of every
    bucket and is written last, by rename. A batch that is replayed after a
    failure starts from the manifest before its own, so it gives the same table.
    Folders no manifest but the two newest names are removed.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        marked = batch.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r[0] for r in marked.select("__bucket").distinct().collect()]  # at most ``buckets``
            if not touched:
                return
            held = _manifest(spark, dest, before=epoch)
            old = [held[str(b)] for b in touched if str(b) in held]
            both = marked if not old else marked.unionByName(spark.read.option("basePath", f"{dest}/data").parquet(*[f"{dest}/{x}" for x in old]).drop("__epoch"))
            latest = dedup_latest(both, [*keys, "__bucket"], latest_by)
            latest.repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{dest}/data/__epoch={epoch}")
            write_small(spark, f"{dest}/manifest-{epoch:012d}.json", json.dumps(held | {str(b): f"data/__epoch={epoch}/__bucket={b}" for b in touched}))
            _sweep(spark, dest)
        finally:
            marked.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _manifests(spark: SparkSession, dest: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{dest}/manifest-*.json")
    if not exists(spark, f"{dest}/manifest-*.json"):
        return []
    return sorted(s.getPath().toString() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def _manifest(spark: SparkSession, dest: str, before: int | None = None) -> dict[str, str]:
    """Folder of each bucket by the newest manifest (older than batch ``before``)."""
    found = [f for f in _manifests(spark, dest) if before is None or int(f[-17:-5]) < before]
    return json.loads(read_small(spark, found[-1])) if found else {}


def _sweep(spark: SparkSession, dest: str) -> None:
    """Remove manifests but the two newest, and the folders of buckets none of them names."""
    *gone, older, newest = ["", *_manifests(spark, dest)] if len(_manifests(spark, dest)) == 1 else _manifests(spark, dest)
    kept = {f for m in (older, newest) if m for f in json.loads(read_small(spark, m)).values()}
    dropped = {f for m in gone if m for f in json.loads(read_small(spark, m)).values()} - kept
    for path in [f"{dest}/{f}" for f in dropped] + [m for m in gone if m]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def current_table(spark: SparkSession, dest: str) -> DataFrame | None:
    """The table ``upsert_latest`` keeps; None before its first batch."""
    held = _manifest(spark, dest)
    return spark.read.option("basePath", f"{dest}/data").parquet(*[f"{dest}/{x}" for x in sorted(held.values())]).drop("__epoch", "__bucket") if held else None


def windowed_counts(events: DataFrame, ts: str, by: list[str], late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts per window with a watermark for late data; works on streams and tables."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size), *by).agg(F.count(F.lit(1)).alias("n"))


def unseen(batch: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the ledger yet."""
    return batch.join(ledger.select(key).distinct(), key, "left_anti")


def day_partitions(first: date, today: date, end_offset: int = 0) -> list[str]:
    """Daily partition keys from ``first``; ``end_offset`` 1 includes today."""
    return [(first + timedelta(days=i)).isoformat() for i in range((today - first).days + end_offset)]


def trailing_partitions(keys: list[str], n: int) -> list[str]:
    """The last ``n`` keys: what a trailing re-capture fetches again."""
    return keys[-n:] if n > 0 else []
