"""Small helpers that shape plans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on an expensively computed column without recomputing it below.

    Catalyst pushes a filter through projections by copying the expressions it
    names into the filter; over a chain of parsing steps the copies multiply
    (a million characters of plan). A non-deterministic column, always true,
    keeps the filter above the projections that compute the values.
    """
    return df.withColumn("__fence", F.spark_partition_id()).where(condition & (F.col("__fence") >= 0)).drop("__fence")


def apart(c: Column) -> Column:
    """The same value, computed outside whole-stage code generation.

    A stage of many parsing steps becomes one generated method beyond the 8 kB
    that the JIT compiler takes, and then runs as interpreted bytecode. A
    projection that holds an expression without generated code (here an identity
    ``transform``) is planned on its own, where Spark splits its expressions
    into small methods.
    """
    return F.get(F.transform(F.array(c), lambda x: x), F.lit(0))


def key_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of one key at a time from batches sorted by integer keys, however the batches are cut; no more than one group is held."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(starts[:-1], starts[1:]):
            key = tuple(c[a] for c in cols)
            if current is not None and key != current:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 200_000) -> Iterator[pa.Table]:
    """Sorted batches as tables of about so many rows (or one larger group) that never cut a group of equal integer keys."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held)
        cols = [table.column(k).to_numpy() for k in keys]
        last = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols]))
        if not len(last):
            continue  # one group so far
        cut = int(last[-1]) + 1
        yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
        size = table.num_rows - cut
    if size:
        yield pa.Table.from_batches(held)
