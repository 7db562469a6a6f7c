"""Problem 3: implausible spikes, stuck values and impossible readings per source.

* Quantile sketches (KLL) of each source, field, hour of day and span of 16 days
  are built per partition and merged: neighbouring spans into the context of a
  chunk, so the season is that of the reading, and all spans into what the
  source shows overall. Impossible values are left out of them.
* Each source's readings are cut into chunks of 32 days with a halo, so a source
  with a third of all rows is spread over its chunks, and the quartiles of a
  chunk's context travel to it in the same shuffle. Chunks are streamed one by
  one from sorted partitions.
* Within a chunk a reading is false if it is physically impossible; outside an
  expanded interquartile fence of its hour context; a short excursion, away at
  an implausible rate of change and back at once; or part of a standstill (zero
  variance) far longer than the runs of equal values the source otherwise shows.
  All limits are multiples of what the source itself shows; only the physical
  bounds have a unit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.planning import key_groups
from ..session import shared_dir

SPAN_H = 16 * 24
CHUNK_H = 2 * SPAN_H
HALO_H = 120  # standstills are told from ordinary runs within this many hours
MAX_EXCURSION = 3  # readings; a longer departure is weather that stays
MAX_GAP_H = 6
EXPANSION = 0.75  # interquartile ranges above the upper quartile
CHANGE = 1.0  # interquartile ranges of the hour that a neighbour must be away for an excursion
STEPS = 10  # smallest changes a source shows that its limit of change has at least: coarse resolution is no excursion


@dataclass(frozen=True)
class Limits:
    """What holds for one kind of measurement.

    ``low`` and ``high``: physical bounds. ``excursions``: whether a quick change
    and return is implausible; where quick changes are ordinary only the upper
    fence counts. ``fence``: what is added to the hour envelope for the upper
    fence, as shares of it and of the greatest envelope of the day. ``idle``: a
    value that may stand still.
    """

    low: float
    high: float
    excursions: bool = False
    fence: tuple[float, float] | None = None
    idle: float | None = None


def _runs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    first = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(v)))


def _around(x: np.ndarray) -> np.ndarray:
    """The greatest of an hour and its neighbours, unknown ones left out (0 if all are), so that dawn and dusk may move with the season."""
    x = np.nan_to_num(x)
    return np.maximum(np.maximum(x, np.roll(x, 1)), np.roll(x, -1))


def excursions(t: np.ndarray, v: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Readings of short departures: away by more than the limit and back at once.

    ``spread``: interquartile range per hour of day of the source's context. The
    limit is a multiple of it, or more where the source changes quickly or in
    coarse steps, and grows over missing hours. At an end of the data, or beside
    a long gap, the one neighbour left must differ by twice the limit.
    """
    n = len(v)
    bad = np.zeros(n, bool)
    if n < 3:
        return bad
    step, gap = np.abs(np.diff(v)), np.diff(t)
    least = STEPS * step[step > 0].min() if step.any() else 0.0
    near = step[gap == 1]
    if len(near) >= 8:
        q1, q3 = np.percentile(near, [25, 75])
        least = max(least, q3 + 5 * (q3 - q1))
    own = np.maximum(CHANGE * _around(spread)[t % 24], least)
    limit = np.maximum(own[1:], own[:-1]) * (1 + 0.2 * (np.minimum(gap, MAX_GAP_H) - 1))
    joined = gap <= MAX_GAP_H
    steep = joined & (step > limit)
    cut = np.flatnonzero(steep | ~joined)  # borders between i and i+1
    edges = np.concatenate(([-1], cut, [n - 1]))
    for a, b in zip(edges[:-1], edges[1:]):
        size = b - a
        if size > MAX_EXCURSION or size == n:
            continue
        left, right = a >= 0 and steep[a], b < n - 1 and steep[b]
        if left and right:
            level, other = v[a + 1 : b + 1], np.array([v[a], v[b + 1]])
            if bad[a]:  # the neighbour before is itself false; measure against the last good one
                good = np.flatnonzero(~bad[: a + 1])
                other[0] = v[good[-1]] if len(good) and t[a + 1] - t[good[-1]] <= MAX_GAP_H else other[1]
            away = np.minimum(np.abs(level - other[0]).min(), np.abs(level - other[1]).min())
            same = np.all(level > other.max()) or np.all(level < other.min())
            if same and away > own[a + 1 : b + 1].max() and abs(other[0] - other[1]) < away:
                bad[a + 1 : b + 1] = True
        elif (left and (b == n - 1 or not joined[b]) and step[a] > 2 * limit[a] and not bad[a]) or (right and (a < 0 or not joined[a]) and step[b] > 2 * limit[b]):
            bad[a + 1 : b + 1] = True
    return bad


def above_fence(t: np.ndarray, v: np.ndarray, q: np.ndarray, fence: tuple[float, float]) -> np.ndarray:
    """Readings beyond the expanded fence of their hour context.

    ``q``: both quartiles per hour of day, NaN where unknown. The fence is over
    the envelope of the hour and its neighbours. Quartiles, as a standstill of
    some days is among the rows.
    """
    envelope = _around(q[:, 1] + EXPANSION * (q[:, 1] - q[:, 0]))
    top = envelope + fence[0] * envelope + fence[1] * envelope.max()
    return (v > top[t % 24]) & ~np.isnan(q[:, 1])[t % 24]


def standstills(v: np.ndarray, idle: float | None, varies: bool) -> np.ndarray:
    """Readings in runs of equal values far longer than the other runs.

    Where there are no other runs to compare with, the longest limit holds, and
    only for a source that ``varies`` overall: one that is always the same has
    coarse resolution.
    """
    bad = np.zeros(len(v), bool)
    first, size = _runs(v)
    live = np.ones(len(first), bool) if idle is None else v[first] != idle
    if not live.any() or (live.sum() < 2 and not varies):
        return bad
    usual = np.percentile(size[live], 95, method="lower") if live.sum() > 1 else HALO_H
    least = min(max(9, 5 * usual), HALO_H)
    for a, n in zip(first[live], size[live]):
        if n >= least:
            bad[a : a + n] = True
    return bad


def false_readings(t: np.ndarray, v: np.ndarray, q: np.ndarray, lim: Limits, varies: bool = False) -> np.ndarray:
    """Which of a source's readings, sorted by hour ``t``, are false; repeated hours share a verdict per value."""
    bad = (v < lim.low) | (v > lim.high)
    at = np.flatnonzero(~bad & ~np.isnan(v))
    if not len(at):
        return bad
    once = at[np.append(True, t[at][1:] != t[at][:-1])]
    x, y = t[once], v[once]
    odd = excursions(x, y, q[:, 1] - q[:, 0]) if lim.excursions else np.zeros(len(y), bool)
    if lim.fence is not None:
        odd |= above_fence(x, y, q, lim.fence)
    rest = np.flatnonzero(~odd)
    odd[rest[standstills(y[rest], lim.idle, varies)]] = True
    verdict = odd[np.searchsorted(x, t[at])] & (v[at] == y[np.searchsorted(x, t[at])])
    bad[at[verdict]] = True
    return bad


# Rows of a chunk: its readings, both quartiles per hour of its context, both quartiles of the source overall.
READING, LOWER, UPPER, ALL_LOWER, ALL_UPPER = range(5)
LOST = -(10**9)  # chunks of readings without source or hour, this one and those below


def _quartile_rows(rows: DataFrame, limits: dict[str, Limits]) -> DataFrame:
    """``(source, chunk, part, hour, fields)``: the merged sketches of each chunk's context, as one row per quartile."""
    fields = list(limits)
    possible = [F.when(F.col(f).between(x.low, x.high), F.col(f)).alias(f) for f, x in limits.items()]
    spans = rows.where(F.col("placed")).select("source", F.floor(F.col("hour") / SPAN_H).alias("span"), (F.col("hour") % 24).alias("hour"), *possible)
    sketches = spans.groupBy("source", "span", "hour").agg(*[F.kll_sketch_agg_double(f, 200).alias(f) for f in fields])
    chunk = F.explode(F.sequence(F.floor((F.col("span") - 1) / 2), F.floor((F.col("span") + 1) / 2)))
    merged = lambda df, *keys: df.groupBy(*keys).agg(*[F.kll_merge_agg_double(f).alias(f) for f in fields])
    near = merged(sketches.select("source", chunk.alias("chunk"), "hour", *fields), "source", "chunk", "hour")
    whole = merged(sketches, "source")
    quartiles = lambda f: F.when(F.kll_sketch_get_n_double(f) > 0, F.kll_sketch_get_quantile_double(f, F.array(F.lit(0.25), F.lit(0.75))))

    def parts(df: DataFrame, low: int, high: int) -> DataFrame:
        both = df.withColumns({f: quartiles(f) for f in fields}).withColumn("part", F.explode(F.array(F.lit(low), F.lit(high))))
        return both.select("source", "chunk", "part", "hour", *[F.get(f, F.col("part") - low).alias(f) for f in fields])

    chunks = near.select("source", "chunk").distinct()
    return parts(near, LOWER, UPPER).unionByName(parts(chunks.join(whole, "source").withColumn("hour", F.lit(0).cast("long")), ALL_LOWER, ALL_UPPER))


def find_false_readings(df: DataFrame, limits: dict[str, Limits]) -> DataFrame:
    """``(row_id, field_name)`` of every false reading, repeated deliveries included.

    ``df`` has ``row_id long, source long, hour long`` (whole hours since 1970)
    and a double column per key of ``limits``. Null and NaN readings are no
    case; without source or hour only impossible values are found; a source
    with few readings has no fence and no standstill to compare with.
    """
    fields = list(limits)
    placed = F.col("source").isNotNull() & F.col("hour").isNotNull()
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "readings")
    df.select("row_id", F.coalesce("source", F.lit(0)).alias("source"), F.coalesce("hour", F.lit(0)).alias("hour"), placed.alias("placed"), *[F.col(f).cast("double").alias(f) for f in fields]).write.parquet(path)
    rows = spark.read.schema("row_id long, source long, hour long, placed boolean, " + ", ".join(f"{f} double" for f in fields)).parquet(path)
    first, last = F.floor((F.col("hour") - HALO_H) / CHUNK_H), F.floor((F.col("hour") + HALO_H) / CHUNK_H)
    chunks = F.when(F.col("placed"), F.sequence(first, last)).otherwise(F.array((LOST - F.abs(F.col("row_id")) % 64).cast("long")))
    data = rows.select("source", F.explode(chunks).alias("chunk"), F.lit(READING).alias("part"), "hour", "row_id", *fields)
    context = _quartile_rows(rows, limits).withColumn("row_id", F.lit(0).cast("long"))
    whole = data.unionByName(context).repartition("source", "chunk").sortWithinPartitions("source", "chunk", "part", "hour")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, ["source", "chunk"]):
            chunk = group.column("chunk")[0].as_py()
            part, hour, row = (group.column(c).to_numpy() for c in ("part", "hour", "row_id"))
            cuts = np.searchsorted(part, [READING, LOWER, UPPER, ALL_LOWER, ALL_UPPER, ALL_UPPER + 1])
            m = cuts[1]
            t, ids, names = hour[:m], [], []
            for f in fields:
                v = group.column(f).to_numpy()
                if chunk <= LOST:
                    hit = (v[:m] < limits[f].low) | (v[:m] > limits[f].high)
                else:
                    q = np.full((24, 2), np.nan)
                    for k, p in enumerate((LOWER, UPPER)):
                        q[hour[cuts[p] : cuts[p + 1]], k] = v[cuts[p] : cuts[p + 1]]
                    overall = [v[cuts[p]] if cuts[p] < cuts[p + 1] else np.nan for p in (ALL_LOWER, ALL_UPPER)]
                    hit = false_readings(t, v[:m], q, limits[f], bool(overall[1] > overall[0])) & (t // CHUNK_H == chunk)
                ids.append(row[:m][hit])
                names += [f] * int(hit.sum())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(names, pa.string())], ["row_id", "field_name"])

    return whole.mapInArrow(run, "row_id long, field_name string")
