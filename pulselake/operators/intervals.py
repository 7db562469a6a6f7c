"""Problem 7: overlapping and gapped intervals to continuous periods and gaps.

The aggregate is a sorted list of disjoint intervals per entity with an
all-of-kind flag; two lists are combined by one linear merge, in any order and
grouping, so partial lists can be reduced in a tree:

* level 0, before any shuffle: each scan partition merges what it holds;
* level 1: lists of one entity and time bucket meet and are merged. Intervals
  are cut at bucket borders first, so buckets do not depend on each other and
  an entity with a third of all rows is spread over its buckets;
* level 2: only pieces that reach a bucket border (at most two per bucket) and
  one first-and-last row per bucket are gathered per entity, to join the pieces
  across borders and to find the gaps that span them.

Intervals that touch are one period, so a cut at a border is undone exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.planning import whole_groups
from ..session import shared_dir

BUCKET_MS = 32 * 86_400_000  # below 2**32, which merge_lists relies on

PIECE = "entity long, bucket long, begin_ms long, finish_ms long, only_kind boolean"
PART = "entity long, bucket long, begin_ms long, finish_ms long, only_kind boolean, role int"
PERIOD, GAP, OPEN, SUMMARY = 0, 1, 2, 3


def merge_lists(entity: np.ndarray, bucket: np.ndarray, begin: np.ndarray, finish: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """Linear merge of intervals, all within their bucket, into disjoint ones per (entity, bucket)."""
    order = np.lexsort((begin, bucket, entity))
    entity, bucket, begin, finish, kind = (x[order] for x in (entity, bucket, begin, finish, kind))
    if not len(entity):
        return entity, bucket, begin, finish, kind
    fresh = np.ones(len(entity), bool)
    fresh[1:] = (entity[1:] != entity[:-1]) | (bucket[1:] != bucket[:-1])
    group = np.cumsum(fresh) - 1
    origin, span = bucket * BUCKET_MS, np.int64(1) << 32
    reach = np.maximum.accumulate(finish - origin + group * span)
    fresh[1:] |= (begin - origin + group * span)[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    return entity[first], bucket[first], begin[first], np.maximum.reduceat(finish, first), np.minimum.reduceat(kind, first)


def _arrays(t: pa.Table) -> list[np.ndarray]:
    return [t.column(c).to_numpy() for c in ("entity", "bucket", "begin_ms", "finish_ms")] + [t.column("only_kind").to_numpy(zero_copy_only=False).astype(np.int8)]


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Level 0: merge every few batches of a scan partition."""
    held: list[pa.RecordBatch] = []

    def merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        e, b, s, f, k = merge_lists(*_arrays(pa.Table.from_batches(held)))
        return pa.RecordBatch.from_arrays([pa.array(e), pa.array(b), pa.array(s), pa.array(f), pa.array(k.astype(bool))], ["entity", "bucket", "begin_ms", "finish_ms", "only_kind"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= 500_000:
            yield merged(held)
            held = []
    if held:
        yield merged(held)


def _bucket_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Level 1: one merged list per entity and bucket, as periods, gaps, open pieces and a summary; sorted partitions are streamed some groups at a time."""
    for groups in whole_groups(batches, ["entity", "bucket"]):
        yield from _parts_of(*merge_lists(*_arrays(groups)))


def _parts_of(e: np.ndarray, b: np.ndarray, s: np.ndarray, f: np.ndarray, k: np.ndarray) -> Iterator[pa.RecordBatch]:
    n = len(e)
    if not n:
        return
    same = np.zeros(n, bool)
    same[1:] = (e[1:] == e[:-1]) & (b[1:] == b[:-1])
    open_ = (s == b * BUCKET_MS) | (f == (b + 1) * BUCKET_MS)
    at = np.flatnonzero(same)
    first = np.flatnonzero(~same)
    last = np.append(first[1:], n) - 1
    cols = [np.concatenate(x) for x in ((e, e[at], e[first]), (b, b[at], b[first]), (s, f[at - 1], s[first]), (f, s[at], f[last]), (k, k[at] * 0, k[first] * 0))]
    role = np.concatenate((np.where(open_, OPEN, PERIOD), np.full(len(at), GAP), np.full(len(first), SUMMARY))).astype(np.int32)
    step = 200_000
    for i in range(0, len(role), step):
        x = [c[i : i + step] for c in cols]
        yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x[:4]), pa.array(x[4].astype(bool)), pa.array(role[i : i + step])], ["entity", "bucket", "begin_ms", "finish_ms", "only_kind", "role"])


def periods_and_gaps(intervals: DataFrame, kind_name: str, other_name: str) -> DataFrame:
    """``(entity, period_kind, begin_ms, finish_ms)`` of all periods and the gaps between them.

    ``intervals`` has ``entity long, begin_ms long, finish_ms long, is_kind
    boolean``. A period is ``kind_name`` if made of such intervals only, else
    ``other_name``. Rows with a null entity or time, or that do not end after
    they begin, are left out; a null ``is_kind`` counts as false; repeated rows
    change nothing; no rows give no rows. The merged lists are kept as a table
    in the shared folder.
    """
    spark = intervals.sparkSession
    ok = F.col("entity").isNotNull() & (F.col("finish_ms") > F.col("begin_ms"))
    last_bucket = F.floor((F.col("finish_ms") - 1) / F.lit(BUCKET_MS).cast("long"))
    first_bucket = F.floor(F.col("begin_ms") / F.lit(BUCKET_MS).cast("long"))
    whole = intervals.where(ok).select("entity", "begin_ms", "finish_ms", F.coalesce("is_kind", F.lit(False)).alias("only_kind"), first_bucket.alias("__a"), last_bucket.alias("__b"))
    pieces = whole.select("entity", F.explode(F.sequence("__a", "__b")).alias("bucket"), "begin_ms", "finish_ms", "only_kind").select(
        "entity",
        "bucket",
        F.greatest("begin_ms", F.col("bucket") * BUCKET_MS).alias("begin_ms"),
        F.least("finish_ms", (F.col("bucket") + 1) * BUCKET_MS).alias("finish_ms"),
        "only_kind",
    )
    lists = pieces.mapInArrow(_combine, PIECE).repartition("entity", "bucket").sortWithinPartitions("entity", "bucket").mapInArrow(_bucket_parts, PART)
    path = shared_dir(spark, "intervals")
    lists.write.parquet(path)
    parts = spark.read.schema(PART).parquet(path)

    by = Window.partitionBy("entity").orderBy("begin_ms")
    opened = parts.where(F.col("role") == OPEN)
    chained = opened.withColumn("__new", F.coalesce(F.col("begin_ms") > F.lag("finish_ms").over(by), F.lit(True)).cast("int"))
    chained = chained.withColumn("__run", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    joined = chained.groupBy("entity", "__run").agg(F.min("begin_ms").alias("begin_ms"), F.max("finish_ms").alias("finish_ms"), F.bool_and("only_kind").alias("only_kind"))
    spanned = parts.where(F.col("role") == SUMMARY).select("entity", F.col("finish_ms").alias("__f"), F.lead("begin_ms").over(by).alias("__n"))
    outer = spanned.where(F.col("__n") > F.col("__f")).select("entity", F.lit("gap").alias("period_kind"), F.col("__f").alias("begin_ms"), F.col("__n").alias("finish_ms"))
    named = F.when(F.col("only_kind"), kind_name).otherwise(other_name)
    inner = parts.where(F.col("role").isin(PERIOD, GAP)).select("entity", F.when(F.col("role") == GAP, "gap").otherwise(named).alias("period_kind"), "begin_ms", "finish_ms")
    return inner.unionByName(joined.select("entity", named.alias("period_kind"), "begin_ms", "finish_ms")).unionByName(outer)
