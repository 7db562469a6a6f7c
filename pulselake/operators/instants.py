"""Problem 1: mixed timestamp spellings and zones to one unambiguous form.

Two halves:

* ``normalise_days`` / ``normalise_instants`` read every spelling and convert a
  clock by an *offset history*: the zone that holds for the row.
* ``estimate_zone_history`` finds that history where no zone is declared. For
  every entity and period it tries each candidate zone and counts violations:
  instants implied by the local clock that do not agree with what is known of
  the order of events (an end before its start or after the row was fetched, a
  local day that differs from the day the zone shows at the known instant). The
  zone with the fewest violations per period is chosen, a change of zone between
  neighbouring periods costing ``switch_cost`` violations (Viterbi over periods).

Evidence is aggregated per entity, period and candidate before anything is
gathered, so an entity with a third of all rows costs no more than others: only
one row per entity, period and candidate is left for the path search.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.planning import where_computed
from ..functions.timeparse import add_when, iso_day, iso_instant, valid_zone, wall_to_utc

NORMAL_DAY = r"^\d{4}-\d{2}-\d{2}$"
NORMAL_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$"


def add_day(df: DataFrame, out: str, text: Column, month_first: Column, zone: Column | None = None) -> DataFrame:
    """Add ``out``: the calendar day ``text`` denotes, or null.

    A text naming an instant means its day in ``zone`` (UTC if none); a clock
    without zone means the day it shows.
    """
    plain = F.trim(text)
    normal = F.coalesce(plain.rlike(NORMAL_DAY), F.lit(False))
    df = add_when(df, "__w", F.when(~normal, text), month_first)
    at = F.col("__w_utc") if zone is None else F.convert_timezone(F.lit("UTC"), F.coalesce(valid_zone(zone), F.lit("UTC")), F.col("__w_utc"))
    day = F.when(normal, plain.try_cast("date")).otherwise(F.coalesce(F.col("__w_day"), F.to_date(at), F.to_date(F.col("__w_wall"))))
    return df.withColumn(out, day).drop("__w_day", "__w_wall", "__w_shift", "__w_utc")


def add_instant(df: DataFrame, out: str, text: Column, month_first: Column, zone: Column) -> DataFrame:
    """Add ``out``: the instant ``text`` denotes as a naive UTC timestamp, or null.

    A zone in the text counts; a clock without one is read by ``zone``, or UTC
    where that is null; a day alone is its midnight by that clock. A clock time
    shown twice means the earlier instant, one never shown means nothing.
    """
    plain = F.trim(text)
    normal = F.coalesce(plain.rlike(NORMAL_INSTANT), F.lit(False))
    df = add_when(df, "__w", F.when(~normal, text), month_first)
    local = F.coalesce(F.col("__w_wall"), F.col("__w_day").cast("timestamp_ntz"))
    read = F.coalesce(F.col("__w_utc"), F.when(F.col("__w_shift").isNull(), wall_to_utc(local, F.coalesce(valid_zone(zone), F.lit("UTC")))))
    return df.withColumn(out, F.when(normal, plain.try_cast("timestamp_ntz")).otherwise(read)).drop("__w_day", "__w_wall", "__w_shift", "__w_utc")


def normalise_days(df: DataFrame, row_id: str, text: str, field_name: str, month_first: Column, zone: Column | None = None) -> DataFrame:
    """``(field_name, row_id, norm)`` of every value that denotes a day and is not in normal form.

    Null, empty and unreadable values and days that do not exist give no row;
    repeated rows are each reported; other columns of ``df`` do not matter.
    """
    raw = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("__t"), month_first.alias("__m"), (zone if zone is not None else F.lit(None).cast("string")).alias("__z"))
    raw = raw.where(F.col("__t").isNotNull() & ~F.col("__t").rlike(NORMAL_DAY))
    day = add_day(raw, "__d", F.col("__t"), F.col("__m"), None if zone is None else F.col("__z"))
    return where_computed(day, F.col("__d").isNotNull()).select(F.lit(field_name).alias("field_name"), "row_id", iso_day(F.col("__d")).alias("norm"))


def normalise_instants(df: DataFrame, row_id: str, text: str, field_name: str, month_first: Column, zone: Column) -> DataFrame:
    """``(field_name, row_id, norm)`` of every value that denotes an instant and is not in normal form."""
    raw = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("__t"), month_first.alias("__m"), zone.alias("__z"))
    raw = raw.where(F.col("__t").isNotNull() & ~F.col("__t").rlike(NORMAL_INSTANT))
    at = add_instant(raw, "__i", F.col("__t"), F.col("__m"), F.col("__z"))
    return where_computed(at, F.col("__i").isNotNull()).select(F.lit(field_name).alias("field_name"), "row_id", iso_instant(F.col("__i")).alias("norm"))


def count_zone_violations(df: DataFrame, entity: str, period: Column, candidates: DataFrame, violation: Column, weight: Column | None = None) -> DataFrame:
    """``(entity, period, zone, seen, bad)``: evidence against each candidate zone.

    ``candidates`` has one column ``zone`` and a few dozen rows (a list of zone
    names, not data). ``violation`` may refer to ``zone``; null is no evidence.
    ``weight``: how many rows a row of ``df`` stands for.
    """
    weight = F.lit(1) if weight is None else weight
    zones = [r["zone"] for r in candidates.limit(601).collect()]
    if len(zones) > 600:
        raise ValueError("candidate zones are a list of zone names; more than 600 cannot be")
    rows = df.withColumn("__period", period).withColumn("zone", F.explode(F.array(*[F.lit(z) for z in zones]) if zones else F.array().cast("array<string>")))
    return (
        rows.withColumn("__bad", violation)
        .where(F.col("__bad").isNotNull() & F.col(entity).isNotNull() & F.col("__period").isNotNull())
        .groupBy(F.col(entity).alias("entity"), F.col("__period").alias("period"), "zone")
        .agg(F.sum(weight).cast("long").alias("seen"), F.sum(F.col("__bad").cast("double") * weight).alias("bad"))
    )


def best_history(bad: np.ndarray, switch_cost: float) -> list[int]:
    """The candidate per period with the least violations plus switches (ties: the first)."""
    cost, back = bad[0].copy(), []
    for row in bad[1:]:
        stay, jump = cost, cost.min() + switch_cost
        from_best = int(cost.argmin())
        back.append(np.where(stay <= jump, np.arange(len(cost)), from_best))
        cost = np.minimum(stay, jump) + row
    k = int(cost.argmin())
    path = [k]
    for step in reversed(back):
        k = int(step[k])
        path.append(k)
    return path[::-1]


def estimate_zone_history(evidence: DataFrame, switch_cost: float = 3.0) -> DataFrame:
    """``(entity, period, zone, seen, bad)``: the history of zones with the fewest violations.

    Where even the best zone is violated by most rows the zone is null. Input is
    what ``count_zone_violations`` gives. One entity has a row per
    period and candidate zone, so its group is bounded by the calendar.
    """

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot_table(index="period", columns="zone", values="bad", aggfunc="sum").sort_index()
        seen = pdf.groupby("period")["seen"].max().reindex(wide.index)
        cost = wide.fillna(wide.max().max() + 1).to_numpy()
        path = best_history(cost, switch_cost)
        bad = np.array([cost[i, k] for i, k in enumerate(path)])
        fits = bad * 2 <= seen.to_numpy()  # else no candidate explains the rows
        return pd.DataFrame({"entity": pdf["entity"].iloc[0], "period": wide.index, "zone": [wide.columns[k] if ok else None for k, ok in zip(path, fits)], "seen": seen.to_numpy(), "bad": bad})

    kinds = dict(evidence.dtypes)
    schema = f"entity {kinds['entity']}, period {kinds['period']}, zone string, seen long, bad double"
    return evidence.groupBy("entity").applyInPandas(search, schema)
