"""Problem 5: keep exactly one copy of messages delivered at least once.

The index is a set of immutable *runs* in a folder all executors share. A run
holds, per hash prefix, one file of entries sorted by a 128-bit identifier
hash: the identifier, and the delivery that is its best so far. Messages are
read once and spooled by batch; then batch after batch is taken in:

1. on the way to the spool each scan partition keeps its best delivery of every
   identifier and batch and marks the others surplus at once, so a message that
   makes up a third of all rows leaves one row per partition; surplus rows are
   not shuffled at all;
2. the live rows of a batch meet by hash prefix, sorted by it, and are locally
   deduplicated prefix by prefix; no more than one prefix is held;
3. the best of each identifier is looked up by binary search in the sorted
   arrays of the runs, newest first, read from the shared folder: the index is
   never shuffled;
4. identifiers that are new, or whose delivery is better than the indexed one,
   become the next run; every loser, incoming or indexed, is surplus.

When there are more than ``max_runs`` runs they are merged into one. The number
of prefixes follows the number of messages, so the array of a prefix stays one
that a task can hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.planning import key_groups, where_computed
from ..session import shared_dir

NAMES = ["h1", "h2", "fetched_ms", "row_id"]
ENTRY = "h1 long, h2 long, fetched_ms long, row_id long"
OUT = f"kind int, prefix int, {ENTRY}"
SURPLUS, INDEXED = 0, 1
LEAST = np.iinfo(np.int64).min


def _columns(table: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in NAMES]


def _best_first(h1: np.ndarray, h2: np.ndarray, fetched: np.ndarray, row: np.ndarray, step: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order by identifier (within the batch, if given), then best delivery first; and which rows are the first of theirs."""
    order = np.lexsort((row, -fetched, h2, h1) if step is None else (row, -fetched, h2, h1, step))
    a, b = h1[order], h2[order]
    first = np.ones(len(order), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    if step is not None:
        first[1:] |= step[order][1:] != step[order][:-1]
    return order, first


SPOOL = f"{ENTRY}, step int, live boolean"


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def out() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        x, step = _columns(t), t.column("step").to_numpy()
        order, first = _best_first(*x, step)
        return pa.RecordBatch.from_arrays([*(pa.array(c[order]) for c in x), pa.array(step[order]), pa.array(first)], [*NAMES, "step", "live"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 500_000:
            yield out()
            held = []
    if held:
        yield out()


def _prefix(h1: np.ndarray, bits: int) -> np.ndarray:
    return ((h1 >> (64 - bits)) & ((1 << bits) - 1)).astype(np.int32)


def _read_run(run: str, prefix: int) -> list[np.ndarray] | None:
    fs, path = pafs.FileSystem.from_uri(run)
    folder = f"{path}/kind={INDEXED}/prefix={prefix}"
    if fs.get_file_info(folder).type == pafs.FileType.NotFound:
        return None
    t = pads.dataset(folder, filesystem=fs, format="parquet").to_table(columns=NAMES)
    return [t.column(c).to_numpy() for c in NAMES]


def search(sorted_h1: np.ndarray, sorted_h2: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Position of each identifier in a sorted run, or -1: a binary search on the first half, then on equal first halves."""
    at, end = np.searchsorted(sorted_h1, h1, "left"), np.searchsorted(sorted_h1, h1, "right")
    found = np.full(len(h1), -1, np.int64)
    while (live := np.flatnonzero((at < end) & (found < 0))).size:
        hit = live[sorted_h2[at[live]] == h2[live]]
        found[hit] = at[hit]
        at[live] += 1
    return found


def _take_in(runs: list[str], bits: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, ["prefix"]):
            prefix = group.column("prefix")[0].as_py()
            x = _columns(group)
            order, first = _best_first(*x)
            x = [c[order] for c in x]
            surplus = [[c[~first]] for c in x]
            best = [c[first] for c in x]
            keep, left = np.ones(len(best[0]), bool), np.arange(len(best[0]))
            for run in reversed(runs):
                entries = _read_run(run, prefix) if len(left) else None
                if entries is None:
                    continue
                at = search(entries[0], entries[1], best[0][left], best[1][left])
                hit, pos = left[at >= 0], at[at >= 0]
                new = (best[2][hit] > entries[2][pos]) | ((best[2][hit] == entries[2][pos]) & (best[3][hit] < entries[3][pos]))
                keep[hit[~new]] = False
                for k in range(4):
                    surplus[k] += [entries[k][pos[new]], best[k][hit[~new]]]
                left = left[at < 0]
            for kind, cols in ((SURPLUS, [np.concatenate(c) for c in surplus]), (INDEXED, [c[keep] for c in best])):
                for i in range(0, len(cols[0]), 200_000):
                    part = [c[i : i + 200_000] for c in cols]
                    n = len(part[0])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, prefix, np.int32)), *(pa.array(c) for c in part)], ["kind", "prefix", *NAMES])

    return task


class MessageIndex:
    """The runs of one kind of message, in a shared folder."""

    def __init__(self, spark: SparkSession, name: str, prefix_bits: int, max_runs: int = 2) -> None:
        self.spark, self.bits, self.max_runs = spark, prefix_bits, max_runs
        self.root = shared_dir(spark, f"message-index-{name}")
        self.runs: list[str] = []
        self.taken: list[str] = []
        self.merged = 0

    def _write(self, live: DataFrame, runs: list[str], name: str) -> str:
        """Take live entries in against ``runs`` and write the outcome; entries come out sorted by prefix and identifier."""
        path = f"{self.root}/{name}"
        prefix = F.shiftrightunsigned("h1", 64 - self.bits).cast("int")
        routed = live.select(*NAMES, prefix.alias("prefix")).repartition("prefix").sortWithinPartitions("prefix")
        routed.mapInArrow(_take_in(runs, self.bits), OUT).sortWithinPartitions("kind", "prefix", "h1", "h2").write.partitionBy("kind", "prefix").parquet(path)
        return path

    def take_in(self, batch: DataFrame) -> None:
        """Take in ``(h1, h2, fetched_ms, row_id)`` rows of one batch."""
        path = self._write(batch, self.runs, f"run-{len(self.taken)}")
        self.runs.append(path)
        self.taken.append(path)
        if len(self.runs) > self.max_runs:
            self.merge()

    def merge(self) -> None:
        """Merge all runs into one; of an identifier in several runs the best delivery stays."""
        self.merged += 1
        self.runs = [self._write(self._entries(self.runs), [], f"merged-{self.merged}")]

    def _read(self, paths: list[str], kind: int) -> DataFrame:
        parts = [self.spark.read.schema(OUT).parquet(p).where(F.col("kind") == kind) for p in paths]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole

    def _entries(self, paths: list[str]) -> DataFrame:
        return self._read(paths, INDEXED)

    def surplus(self) -> DataFrame:
        """``row_id`` of every delivery that is not the one to keep, over all batches so far."""
        return self._read(self.taken, SURPLUS).select("row_id")


def identity_hashes(*parts: Column) -> list[Column]:
    """Two independent 64-bit hashes of an identifier; null where a part is null."""
    known = parts[0].isNotNull()
    for p in parts[1:]:
        known = known & p.isNotNull()
    return [F.when(known, F.xxhash64(F.lit(seed), *parts)).alias(n) for seed, n in ((11, "h1"), (29, "h2"))]


def surplus_deliveries(messages: DataFrame, name: str, batch_column: str, batches: int = 4, ids_per_prefix: int = 2_000_000) -> DataFrame:
    """``row_id`` of all surplus rows of ``messages``.

    ``messages`` has ``h1, h2, fetched_ms, row_id`` and ``batch_column``, by
    whose ranges the rows are taken in, in order of arrival. Of one identifier
    the row with the greatest ``fetched_ms`` stays, then the smallest
    ``row_id``; a null ``fetched_ms`` is the smallest of all. Rows without an
    identifier are single; rows without a batch come with the first.
    """
    spark = messages.sparkSession
    lo, hi = messages.agg(F.min(batch_column), F.max(batch_column)).first()
    steps = 1 if lo is None or hi == lo else min(batches, hi - lo + 1)
    place = F.lit(0) if steps == 1 else F.coalesce(F.floor((F.col(batch_column) - lo) * steps / F.lit(float(hi - lo + 1))), F.lit(0))
    known = where_computed(messages.select("h1", "h2", F.coalesce("fetched_ms", F.lit(-(2**62))).alias("fetched_ms"), "row_id", place.cast("int").alias("step")), F.col("h1").isNotNull())
    path, seen = shared_dir(spark, f"message-spool-{name}"), Observation(f"spooled-{name}")
    known.mapInArrow(_local, SPOOL).observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy("step").parquet(path)
    spool = spark.read.schema(SPOOL).parquet(path)
    bits = int(max(3, np.ceil(np.log2(max(1, seen.get["n"]) / ids_per_prefix))))
    index = MessageIndex(spark, name, bits)
    for k in range(steps):
        index.take_in(spool.where((F.col("step") == k) & F.col("live")))
    return index.surplus().unionByName(spool.where(~F.col("live")).select("row_id"))
