"""Problem 2: totals over trailing periods, days without activity included.

Of every entity and day one row is left, so an entity has at most 366 rows a
year however many rows it came with. A year is a chunk; it carries the days of
the year before that its windows still reach, so chunks do not depend on each
other. Within a chunk a two-stack queue keeps each active window: only
``combine`` is needed, so maxima work as well as sums. ``TwoStackQueue`` is the
queue for any monoid, item by item; ``trailing`` is the same queue turned over
every ``w`` items, its stacks filled by array operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class TwoStackQueue:
    """First in, first out, with the combination of all that is inside.

    ``combine`` must be associative with ``identity``; it need not have an inverse.
    """

    __slots__ = ("back", "back_total", "combine", "front", "identity")

    def __init__(self, combine: Callable, identity: object) -> None:
        self.combine, self.identity = combine, identity
        self.front: list = []  # combinations of the older half, from each item to the newest of it
        self.back: list = []
        self.back_total = identity

    def push(self, item: object) -> None:
        self.back.append(item)
        self.back_total = self.combine(self.back_total, item)

    def pop(self) -> None:
        if not self.front:
            total = self.identity
            for item in reversed(self.back):
                total = self.combine(item, total)
                self.front.append(total)
            self.back.clear()
            self.back_total = self.identity
        self.front.pop()

    def total(self) -> object:
        return self.combine(self.front[-1], self.back_total) if self.front else self.back_total


COMBINERS: dict[str, tuple[np.ufunc, float]] = {"sum": (np.add, 0.0), "max": (np.maximum, float("-inf")), "min": (np.minimum, float("inf"))}


def trailing(values: np.ndarray, w: int, first: int, how: str = "sum") -> np.ndarray:
    """The combination of ``values`` over each window of ``w`` that ends at index ``first`` or later.

    The queue is turned over at every multiple of ``w``: the front stack holds
    the combinations from an item to the end of its block, the back stack those
    from the begin of the block to an item, and a window is one of each.
    """
    combine, identity = COMBINERS[how]
    n = len(values)
    padded = np.concatenate([np.full(w - 1, identity), values, np.full(-(n + w - 1) % w, identity)]).reshape(-1, w)
    front = combine.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    back = combine.accumulate(padded, axis=1).ravel()
    at = np.arange(first, n)  # begin of the window in the padded row
    whole = at % w == 0
    return np.where(whole, back[at + w - 1], combine(front[at], back[at + w - 1]))


def rolling_totals(df: DataFrame, entity: str, day: str, values: list[str], windows: list[int], latest_by: list[Column], how: str = "sum") -> DataFrame:
    """Per entity and calendar day, from its first to its last row: totals and averages of each value.

    Columns ``entity``, ``day``, ``month`` and per value v and window w
    ``{v}_{w}_total`` and ``{v}_{w}_avg``. Of several rows of an entity and day
    the one greatest by ``latest_by`` holds, nulls included. Nulls and absent
    days add nothing. The average is the total over the days of the window that
    lie within the entity's span. Rows with a null entity or day have no place
    and are left out; no rows give no rows. For ``max`` or ``min`` a window
    without values is null. A window reaches back a year at most.
    """
    reach = max(windows)
    if reach > 365:
        raise ValueError("a window reaches back a year at most")
    number = F.unix_date(F.col("day"))
    days = (
        df.where(F.col(entity).isNotNull() & F.col(day).isNotNull())
        .groupBy(F.col(entity).alias("entity"), F.col(day).cast("date").alias("day"))
        .agg(F.max_by(F.struct(*[F.col(v).cast("double").alias(v) for v in values]), F.struct(*latest_by)).alias("__v"))
    )
    held = F.collect_list(F.struct(number.alias("day"), *[F.col(f"__v.{v}").alias(v) for v in values])).alias("held")
    years = days.groupBy("entity", F.year("day").alias("year")).agg(held, F.min(number).alias("lo"), F.max(number).alias("hi"))
    by, whole = Window.partitionBy("entity").orderBy("year"), Window.partitionBy("entity")
    none = F.array().cast(dict(years.dtypes)["held"])
    spanned = years.select("entity", "year", "held", F.lead("year").over(by).alias("__next"), F.min("lo").over(whole).alias("first"), F.max("hi").over(whole).alias("last"), F.lag("year").over(by).alias("__before"), F.lag("held").over(by).alias("__old"))
    # a year without any row between two others still has its days
    filled = spanned.select("entity", F.explode(F.sequence("year", F.greatest(F.col("year"), F.coalesce(F.col("__next") - 1, F.col("year"))))).alias("chunk"), "year", "held", "first", "last", "__before", "__old")
    tail = lambda rows: F.filter(rows, lambda r: r["day"] > F.unix_date(F.make_date(F.col("chunk"), F.lit(1), F.lit(1))) - reach)
    own = F.col("chunk") == F.col("year")
    inside = F.when(own, F.concat(F.when(F.col("__before") == F.col("year") - 1, tail(F.col("__old"))).otherwise(none), F.col("held"))).when(F.col("chunk") == F.col("year") + 1, tail(F.col("held"))).otherwise(none)
    begin = F.greatest(F.unix_date(F.make_date(F.col("chunk"), F.lit(1), F.lit(1))), F.col("first"))
    end = F.least(F.unix_date(F.make_date(F.col("chunk"), F.lit(12), F.lit(31))), F.col("last"))
    chunks = filled.select("entity", begin.alias("begin"), end.alias("end"), "first", inside.alias("held"))
    names = [f"{v}_{w}_{x}" for v in values for w in windows for x in ("total", "avg")]
    kind = dict(df.dtypes)[entity]
    _, identity = COMBINERS[how]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, end, first = (batch.column(c).to_numpy() for c in ("begin", "end", "first"))
            lists = batch.column("held")
            offsets, rows = lists.offsets.to_numpy(), lists.values
            at = rows.field("day").to_numpy()
            given = {v: rows.field(v).to_numpy(zero_copy_only=False) for v in values}
            made: dict[str, list[np.ndarray]] = {n: [] for n in names}
            span, out_days = end - begin + 1, []
            for k in range(len(begin)):
                a, b, start = offsets[k], offsets[k + 1], begin[k] - reach + 1
                index = at[a:b] - start
                here = np.arange(begin[k], end[k] + 1)
                out_days.append(here)
                known = here - first[k] + 1
                for v in values:
                    x = given[v][a:b]
                    real = ~np.isnan(x)
                    dense = np.full(end[k] - start + 1, identity)
                    dense[index[real]] = x[real]
                    for w in windows:
                        t = trailing(dense, w, reach - 1, how)
                        if how != "sum":
                            t[np.isinf(t)] = np.nan
                        made[f"{v}_{w}_total"].append(t)
                        made[f"{v}_{w}_avg"].append(t / np.minimum(known, w) if how == "sum" else t)
            if not out_days:
                continue
            day_of = pa.array(np.concatenate(out_days).astype(np.int32)).cast(pa.date32())
            entity_of = batch.column("entity").take(pa.array(np.repeat(np.arange(len(begin)), span)))
            yield pa.RecordBatch.from_arrays([entity_of, day_of, *(pa.array(np.concatenate(made[n]), from_pandas=True) for n in names)], ["entity", "day", *names])

    made = chunks.mapInArrow(run, f"entity {kind}, day date, " + ", ".join(f"{n} double" for n in names))
    return made.select("entity", "day", F.trunc("day", "MM").alias("month"), *names)


def greatest_days(totals: DataFrame, values: list[str], windows: list[int]) -> DataFrame:
    """``(entity, day, field_name, window_days, total)``: per entity, month, value and window the days, ties included, whose total is greatest and above zero."""
    by = Window.partitionBy("entity", "month")
    pairs = [(v, w) for v in values for w in windows]
    best = totals.select("entity", "day", "month", *[f"{v}_{w}_total" for v, w in pairs]).select("*", *[F.max(f"{v}_{w}_total").over(by).alias(f"__{v}_{w}") for v, w in pairs])
    cases = [F.when((F.col(f"{v}_{w}_total") > 0) & (F.col(f"{v}_{w}_total") == F.col(f"__{v}_{w}")), F.struct(F.lit(v).alias("field_name"), F.lit(w).alias("window_days"), F.col(f"{v}_{w}_total").alias("total"))) for v, w in pairs]
    hits = best.select("entity", "day", F.explode(F.array_compact(F.array(*cases))).alias("__h"))
    return hits.select("entity", "day", "__h.field_name", "__h.window_days", "__h.total")
