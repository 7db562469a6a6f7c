"""The two daily marts over a continuous spine of days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import fahrenheit
from ..operators.relational import asof_join, date_spine, dedup_latest

# Unit conversions, glucose band and weather thresholds.
LB_PER_KG, KJ_PER_KCAL, MM_PER_INCH = 2.20462, 4.184, 25.4
IN_RANGE = (70, 140)
GDD_BASE_F, FROST_F, HARD_FREEZE_F = 50, 32, 28
DEPTHS = (5, 10, 20, 50, 100)

# Columns read from each silver table, for a typed empty relation while one is missing.
WELLNESS_INPUTS = {
    "sleep": "night_date date, garmin_sleep_score int, garmin_total_min double, garmin_rhr int, whoop_performance_pct double, whoop_efficiency_pct double",
    "recovery": "cycle_id bigint, recovery_date date, created_at timestamp_ntz, recovery_score double, resting_heart_rate double, hrv_rmssd_milli double, spo2_percentage double",
    "workouts": "activity_date date, duration_sec double, distance_m double, calories double",
    "glucose": "reading_date date, mgdl int",
    "strain": "cycle_id bigint, strain_date date, day_strain double, kilojoules double, avg_heart_rate int, max_heart_rate int",
    "daily": "activity_date date, total_steps int, active_kilocalories double, total_distance_m double, floors_ascended double, moderate_intensity_min int, vigorous_intensity_min int, avg_stress_level int, body_battery_high int, body_battery_low int",
    "body": "measured_date date, weight_kg double, bmi double, body_fat_pct double",
}
_DAY_OF = {"sleep": "night_date", "recovery": "recovery_date", "workouts": "activity_date", "glucose": "reading_date", "strain": "strain_date", "daily": "activity_date"}


def daily_wellness(silver: dict[str, DataFrame]) -> DataFrame:
    """One row per local day from the first to the last of the inputs (body excepted), 45 columns.

    Missing inputs count as empty; without any there are no rows.
    """
    spark = next(iter(silver.values())).sparkSession
    t = {n: silver[n] if n in silver else spark.createDataFrame([], s) for n, s in WELLNESS_INPUTS.items()}
    ends = reduce(DataFrame.unionByName, [t[n].agg(F.min(d).alias("lo"), F.max(d).alias("hi")) for n, d in _DAY_OF.items()])
    spine = date_spine(ends.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "lo", "hi")
    sleep = t["sleep"].select(F.col("night_date").alias("day"), *[c for c in t["sleep"].columns if c in WELLNESS_INPUTS["sleep"] and c != "night_date"], F.lit(True).alias("has_sleep"))
    rec = dedup_latest(t["recovery"].where(F.col("recovery_date").isNotNull()), ["recovery_date"], ["created_at", "cycle_id"]).select(F.col("recovery_date").alias("day"), "cycle_id", "recovery_score", "resting_heart_rate", "hrv_rmssd_milli", "spo2_percentage", F.col("cycle_id").isNotNull().alias("has_recovery"))
    strain = t["strain"].select("cycle_id", "day_strain", (F.col("kilojoules") / KJ_PER_KCAL).alias("strain_kilocalories"), F.col("avg_heart_rate").alias("strain_avg_hr"), F.col("max_heart_rate").alias("strain_max_hr"), F.lit(True).alias("has_strain"))
    daily = t["daily"].select(
        F.col("activity_date").alias("day"), F.col("total_steps").alias("steps"), F.col("active_kilocalories").alias("active_calories"), (F.col("total_distance_m") / 1000.0).alias("distance_km"), F.col("floors_ascended").alias("floors"), (F.col("moderate_intensity_min") + F.col("vigorous_intensity_min")).alias("intensity_minutes"),
        F.col("avg_stress_level").alias("avg_stress"), "body_battery_high", "body_battery_low", F.lit(True).alias("has_daily"),
    )
    work = t["workouts"].groupBy(F.col("activity_date").alias("day")).agg(F.count(F.lit(1)).alias("workout_count"), (F.sum("duration_sec") / 60.0).alias("workout_total_min"), (F.sum("distance_m") / 1000.0).alias("workout_distance_km"), F.sum("calories").alias("workout_calories"), F.lit(True).alias("has_workout"))
    low, high, n = F.col("mgdl") < IN_RANGE[0], F.col("mgdl") > IN_RANGE[1], F.count(F.lit(1))
    share = lambda c: F.lit(100.0).cast("double") * F.count_if(c) / n
    glu = t["glucose"].where(F.col("mgdl").isNotNull()).groupBy(F.col("reading_date").alias("day")).agg(
        n.alias("glucose_readings"), F.avg("mgdl").alias("glucose_mean"), F.min("mgdl").alias("glucose_min"), F.max("mgdl").alias("glucose_max"), F.stddev_samp("mgdl").alias("glucose_std"),
        share(F.col("mgdl").between(*IN_RANGE)).alias("glucose_tir_pct"), share(low).alias("glucose_pct_below"), share(high).alias("glucose_pct_above"), F.lit(True).alias("has_glucose"),
    )
    day = spine.join(sleep, "day", "left").join(rec, "day", "left").join(strain, "cycle_id", "left").join(daily, "day", "left").join(work, "day", "left").join(glu, "day", "left")
    day = asof_join(day, t["body"], "day", "measured_date", [], ["measured_date", "weight_kg", "bmi", "body_fat_pct"])
    flags = ["has_sleep", "has_recovery", "has_strain", "has_daily", "has_workout", "has_glucose"]
    return day.select(
        "day", "garmin_sleep_score", "garmin_total_min", "garmin_rhr", "whoop_performance_pct", "whoop_efficiency_pct", "recovery_score", "resting_heart_rate", "hrv_rmssd_milli", "spo2_percentage", "day_strain", "strain_kilocalories", "strain_avg_hr", "strain_max_hr",
        "steps", "active_calories", "distance_km", "floors", "intensity_minutes", "avg_stress", "body_battery_high", "body_battery_low", F.coalesce("workout_count", F.lit(0)).alias("workout_count"), "workout_total_min", "workout_distance_km", "workout_calories",
        "glucose_readings", "glucose_mean", "glucose_min", "glucose_max", "glucose_std", "glucose_tir_pct", "glucose_pct_below", "glucose_pct_above", "weight_kg", (F.col("weight_kg") * LB_PER_KG).alias("weight_lb"), F.col("bmi").alias("body_bmi"), "body_fat_pct",
        *[F.coalesce(f, F.lit(False)).alias(f) for f in flags], F.col("measured_date").isNotNull().alias("has_weight"),
    )


def daily_weather(weather: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per local day (and station, if ``keys``) of the weather table's span, 25 columns.

    A day with observations but no temperatures has ``gdd50`` 0 and null
    ``frost``; a day without observations is null throughout, ``hours_observed`` 0.
    """
    keys = keys or []
    top, low = fahrenheit(F.max("air_temp_max_c")), fahrenheit(F.min("air_temp_min_c"))
    by_day = weather.where(F.col("obs_date_local").isNotNull()).groupBy(*keys, F.col("obs_date_local").alias("day")).agg(
        top.alias("air_temp_max_f"), low.alias("air_temp_min_f"), fahrenheit(F.avg("air_temp_c")).alias("air_temp_avg_f"), F.greatest(F.lit(0.0), (top + low) / 2.0 - GDD_BASE_F).alias("gdd50"), (low <= FROST_F).alias("frost"), (low <= HARD_FREEZE_F).alias("hard_freeze"),
        (F.sum("precip_mm") / MM_PER_INCH).alias("precip_total_in"), F.avg("solar_rad_wm2").alias("solar_rad_mean_wm2"), F.max("solar_rad_wm2").alias("solar_rad_max_wm2"), fahrenheit(F.max("surface_temp_max_c")).alias("surface_temp_max_f"), fahrenheit(F.min("surface_temp_min_c")).alias("surface_temp_min_f"), F.avg("rh_pct").alias("rh_mean_pct"),
        *[fahrenheit(F.avg(f"soil_temp_{d}")).alias(f"soil_temp_{d}_f_mean") for d in DEPTHS], *[F.avg(f"soil_moisture_{d}").alias(f"soil_moisture_{d}_mean") for d in DEPTHS],
        F.count(F.lit(1)).alias("__hours"),
    )
    ends = by_day.groupBy(*keys).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    spine = ends.where(F.col("lo") <= F.col("hi")).select(*keys, F.explode(F.sequence("lo", "hi")).alias("day"))
    joined = spine.join(by_day, [*keys, "day"], "left")
    return joined.withColumns({"hours_observed": F.coalesce("__hours", F.lit(0)), "has_weather": F.col("__hours").isNotNull()}).drop("__hours")
