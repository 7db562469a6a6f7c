"""Relational building blocks: latest records, spines, as-of joins, gaps and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: list[str], latest_by: list[str | Column]) -> DataFrame:
    """One row per key: the greatest by ``latest_by`` in turn, nulls last.

    Null keys form one group. Ties beyond ``latest_by`` leave an arbitrary row,
    so end the list with a unique column. A key with many rows is reduced per
    partition before the shuffle (``max_by`` over a struct is a partial
    aggregate), so a hot key costs one row per partition.
    """
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in latest_by])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("__row"))
    return best.select("__row.*")


def date_spine(bounds: DataFrame, lo: str, hi: str, name: str = "day") -> DataFrame:
    """Every day from ``lo`` to ``hi``; null or reversed bounds give none."""
    return bounds.where(F.col(lo) <= F.col(hi)).select(F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"))).alias(name))


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, keys: list[str], values: list[str], bucket: Column | None = None, tie: str | None = None) -> DataFrame:
    """Left rows with ``values`` of the latest right row at or before their time, null where there is none.

    ``bucket`` maps the column ``__t`` to a coarse time (default: its month).
    Within a bucket the latest row is found by a window over (key, bucket); what
    holds at the bucket's start comes from one last row per key and bucket, so
    neither a hot key nor the join without key gathers all rows in one task.
    Null times and null keys match nothing; ties on the right time are broken by ``tie``.
    """
    bucket = F.trunc(F.col("__t").cast("date"), "MM") if bucket is None else bucket
    carried = F.struct(*values)
    by = [F.col(k) for k in keys] or [F.lit(0).alias("__all")]
    names = keys or ["__all"]
    r = right.where(F.col(right_time).isNotNull()).select(*by, F.col(right_time).alias("__t"), F.lit(0).alias("__side"), (F.col(tie) if tie else F.lit(0)).alias("__tie"), carried.alias("__v"), F.lit(None).alias("__l"))
    l = left.select(*by, F.col(left_time).alias("__t"), F.lit(1).alias("__side"), F.lit(None).alias("__tie"), F.lit(None).alias("__v"), F.struct(*left.columns).alias("__l"))
    rows = r.unionByName(l).withColumn("__b", bucket)
    inside = Window.partitionBy(*names, "__b").orderBy("__t", "__side", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumn("__hit", F.last("__v", ignorenulls=True).over(inside)).where(F.col("__side") == 1)
    ends = r.withColumn("__b", bucket).groupBy(*names, "__b").agg(F.max_by("__v", F.struct("__t", "__tie")).alias("__end"))
    placed = here.select(*names, "__b", F.lit(None).cast(ends.schema["__end"].dataType).alias("__end"))
    buckets = placed.unionByName(ends).groupBy(*names, "__b").agg(F.first("__end", ignorenulls=True).alias("__end"))
    before = Window.partitionBy(*names).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    start = buckets.withColumn("__start", F.last("__end", ignorenulls=True).over(before)).select(*[F.col(n).alias(f"__s_{n}") for n in (*names, "__b")], "__start")
    same = F.lit(True)
    for n in (*names, "__b"):
        same = same & F.col(n).eqNullSafe(F.col(f"__s_{n}"))
    joined = here.join(start, same, "left")
    matched = F.col("__t").isNotNull()
    for n in keys:
        matched = matched & F.col(n).isNotNull()
    timed = F.when(matched, F.coalesce(F.col("__hit"), F.col("__start")))
    return joined.select("__l.*", timed.alias("__m")).select(*left.columns, *[F.col(f"__m.{v}").alias(v) for v in values])


def full_outer_sources(a: DataFrame, b: DataFrame, key: str, flag_a: str, flag_b: str) -> DataFrame:
    """Both sides on ``key``, with flags telling which side a row has."""
    x, y = a.withColumn(flag_a, F.lit(True)), b.withColumn(flag_b, F.lit(True))
    return x.join(y, key, "full_outer").withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in (flag_a, flag_b)})


def explode_records(df: DataFrame, array: Column, name: str = "rec") -> DataFrame:
    """One row per element; null and non-array values give none."""
    return df.withColumn(name, F.explode(array))


def trailing_n(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` greatest distinct values: a top-k, its size is the feature."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(F.desc(column)).limit(n)


def spread_sample(df: DataFrame, group: str, order: list[str], n: int, bucket: Column | None = None) -> DataFrame:
    """Per group the rows at evenly spread places of its order, first and last included.

    ``bucket`` must not decrease along ``order``, e.g. a leading column divided
    down. Counts per group and bucket tell in which buckets the wanted places
    lie, and only rows of those are ranked, bucket by bucket, so a group with a
    third of all rows is never ranked in one task. Without it each group is one
    bucket, for groups known to be small. Groups of ``n`` rows or fewer stay whole;
    ``n`` of 1 takes the first row.
    """
    rows = df.withColumn("__b", F.lit(0) if bucket is None else bucket)
    sizes = rows.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(group)
    placed = sizes.withColumn("__n", F.sum("__c").over(w)).withColumn("__before", F.sum("__c").over(w.orderBy(F.col("__b").asc_nulls_first())) - F.col("__c"))
    spread = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * (F.col("__n") - 1) / F.lit(float(max(1, n - 1)))).cast("long"))
    every = F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)
    wanted = F.filter(F.when(F.col("__n") <= n, every).otherwise(F.array_distinct(spread)), lambda k: (k >= F.col("__before")) & (k < F.col("__before") + F.col("__c")))
    places = placed.select(F.col(group).alias("__g"), F.col("__b").alias("__gb"), "__before", wanted.alias("__want")).where(F.size("__want") > 0)
    hit = rows.join(places, rows[group].eqNullSafe(F.col("__g")) & rows["__b"].eqNullSafe(F.col("__gb")))
    rank = F.col("__before") + F.row_number().over(Window.partitionBy(group, "__b").orderBy(*order)) - 1
    return hit.withColumn("__k", rank).where(F.array_contains("__want", F.col("__k"))).select(*df.columns)


def date_gaps(df: DataFrame, day: str, groups: list[str], cadence: int = 1) -> DataFrame:
    """``(groups, before, after, missing)`` where consecutive distinct days are more than ``cadence`` apart."""
    days = df.where(F.col(day).isNotNull()).select(*groups, F.col(day).cast("date").alias("after")).distinct()
    w = Window.partitionBy(*groups).orderBy("after") if groups else Window.partitionBy(F.lit(0)).orderBy("after")
    delta = F.date_diff("after", "before")
    return days.withColumn("before", F.lag("after").over(w)).where(delta > cadence).select(*groups, "before", "after", (delta - 1).alias("missing"))


def trailing_count(df: DataFrame, keys: list[str], ts: str, seconds: int, name: str = "n", bucket_seconds: int = 86_400) -> DataFrame:
    """Rows with the number of rows of their key in the ``seconds`` up to and including their own time.

    Time is cut into buckets; a bucket also holds the rows before it that its
    windows still reach, so a hot key is spread over its buckets. A null time
    counts nothing and is counted by nothing (0); null keys are a key.
    """
    if bucket_seconds < seconds:
        raise ValueError("a bucket must be longer than the window")
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    size, reach = bucket_seconds * 1_000_000, seconds * 1_000_000
    own = F.floor(F.col("__us") / size)
    rows = df.withColumn("__us", us)
    spread = rows.withColumn("__b", F.explode(F.array_distinct(F.array(own, F.floor((F.col("__us") + reach) / size)))))
    inside = Window.partitionBy(*keys, "__b").orderBy("__us").rangeBetween(-reach, 0)
    counted = spread.withColumn(name, F.when(F.col("__us").isNull(), 0).otherwise(F.count("__us").over(inside)))
    return counted.where(F.col("__us").isNull() | (own == F.col("__b"))).drop("__us", "__b")
