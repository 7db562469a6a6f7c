"""Problem 8: whole texts into containers of a fixed number of tokens.

Bounded-space online best-fit: a fixed number of bins is open at a time, kept in
a bitset keyed by free space, so the tightest bin that still holds an item is
one shift and one lowest bit away; when one more must be opened, the fullest
closes first. Each partition packs its own stream of items, so no item ever
waits for another partition; the few bins still open at its end are packed once
more with those of neighbouring partitions (whole bins, never their texts, so
nothing is divided). A partition knows how full its closed bins are, so only the
texts of open bins are joined to anything.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

CAPACITY = 4096
OPEN_BINS = 64
NEIGHBOURS = 256  # partitions whose open bins are packed together


@functools.lru_cache(2)
def tokenizer(path: str | None):
    """The public byte-level BPE at ``path``, or where this machine keeps it."""
    import tiktoken

    if path is None:
        import public_tokenizers

        path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    else:
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str | None = None) -> int:
    return len(tokenizer(path).encode_ordinary(text)) if text else 0


class OpenBins:
    """At most ``most`` open bins of ``capacity``; ``put`` gives an item's bin."""

    def __init__(self, capacity: int, most: int) -> None:
        self.capacity, self.most = capacity, most
        self.bits = 0  # bit f is set if a bin with f free is open
        self.by_free: dict[int, list[int]] = {}
        self.open = self.made = 0
        self.closed: list[tuple[int, int]] = []

    def _take(self, free: int) -> int:
        same = self.by_free[free]
        k = same.pop()
        if not same:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.open -= 1
        return k

    def _keep(self, k: int, free: int) -> None:
        if free == 0:
            self.closed.append((k, 0))
            return
        self.by_free.setdefault(free, []).append(k)
        self.bits |= 1 << free
        self.open += 1

    def put(self, size: int) -> int:
        """The bin for an item; the tightest that holds it, else a new one."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            k = self._take(free)
        else:
            if self.open >= self.most:  # the fullest closes
                free = (self.bits & -self.bits).bit_length() - 1
                self.closed.append((self._take(free), free))
            k, free = self.made, self.capacity
            self.made += 1
        self._keep(k, free - size)
        return k

    def rest(self) -> list[tuple[int, int]]:
        """``(bin, free)`` of the bins still open."""
        return [(k, free) for free, ks in self.by_free.items() for k in ks]


PLACED = "doc_id long, piece int, tokens int, part long, bin long, used long, still_open boolean"


def pack_texts(documents: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, tokenizer_path: str | None = None) -> DataFrame:
    """``(doc_id, piece, tokens, container_id, filled)``: where each text goes.

    ``tokens`` are those of the piece, ``filled`` the share of its container in
    use. A text is divided only if it alone exceeds the capacity: into full
    pieces, each a container of its own, and a rest that is packed like a text.
    Null and empty texts have no tokens and join any container. Repeated rows
    are packed one by one. No rows give no rows. Items are placed in a table in
    the shared folder, from which the containers still open are packed again.
    """
    if capacity < 1 or open_bins < 1:
        raise ValueError("capacity and open_bins must be positive")
    spark = documents.sparkSession

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark

        part = pyspark.TaskContext.get().partitionId()
        encode = tokenizer(tokenizer_path).encode_ordinary
        bins = OpenBins(capacity, open_bins)
        docs, pieces, sizes, where = [], [], [], []

        for batch in batches:
            x = batch.to_pydict()
            for d, text in zip(x["doc_id"], x["text"]):
                n, piece = len(encode(text)) if text else 0, 0
                while n > capacity:
                    docs.append(d)
                    pieces.append(piece)
                    sizes.append(capacity)
                    where.append(bins.made)
                    bins.made += 1
                    n, piece = n - capacity, piece + 1
                docs.append(d)
                pieces.append(piece)
                sizes.append(n)
                where.append(bins.put(n))
        if docs:
            at, size = np.array(where, np.int64), np.array(sizes, np.int64)
            used = np.bincount(at, size, bins.made).astype(np.int64)
            opened = np.zeros(bins.made, bool)
            opened[[k for k, _ in bins.rest()]] = True
            columns = [pa.array(docs, pa.int64()), pa.array(pieces, pa.int32()), pa.array(size.astype(np.int32)), pa.array(np.full(len(docs), part, np.int64)), pa.array(at), pa.array(used[at]), pa.array(opened[at])]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PLACED.split(", ")])

    path = shared_dir(spark, "packing")
    documents.select("doc_id", "text").mapInArrow(place, PLACED).write.parquet(path)
    placed = spark.read.schema(PLACED).parquet(path)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_group: dict[int, list[tuple[int, int, int]]] = {}
        for batch in batches:
            for g, p, k, used in zip(*(batch.column(c).to_pylist() for c in ("group", "part", "bin", "used"))):
                by_group.setdefault(g, []).append((-used, p, k))
        for g, held in by_group.items():
            bins, total = OpenBins(capacity, open_bins), {}
            to = []
            for used, *_ in sorted(held):
                to.append(bins.put(-used))
                total[to[-1]] = total.get(to[-1], 0) - used
            _, parts, ks = zip(*sorted(held))
            yield pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.int64()), "bin": pa.array(ks, pa.int64()), "container_id": pa.array([f"t-{g}-{k}" for k in to]), "all_used": pa.array([total[k] for k in to], pa.int64())})

    share = lambda c: (F.col(c) / F.lit(float(capacity))).alias("filled")
    closed = placed.where(~F.col("still_open")).select("doc_id", "piece", "tokens", F.concat_ws("-", "part", "bin").alias("container_id"), share("used"))
    open_rows = placed.where("still_open")
    tails = open_rows.select(F.floor(F.col("part") / NEIGHBOURS).alias("group"), "part", "bin", "used").distinct()
    moved = tails.repartition("group").mapInArrow(again, "part long, bin long, container_id string, all_used long")
    return closed.unionByName(open_rows.join(moved, ["part", "bin"]).select("doc_id", "piece", "tokens", "container_id", share("all_used")))
